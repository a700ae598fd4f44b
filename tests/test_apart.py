import datetime
import random

import pytest
from pyspark.sql import functions as F

from postlake import schema
from postlake.operators import bronze, dedup, silver
from postlake.plans.catalog import registry
from postlake.sources import testtables
from postlake.sources.testtables import FRAGMENTS
from postlake.streaming import posts as stream_posts

FACTS = "doc_id long, post_id string, subreddit string, author string, created_utc long, score int"


@pytest.fixture
def apart(spark, tmp_path):
    """Events and documents with keys that repeat and nulls: (folder, facts, texts)."""
    day = datetime.datetime(2024, 1, 5, 3)
    events = [(0, day, 1, "a", 3.5), (1, day, 2, "b", None), (1, day, 2, "b", 9.0), (2, None, None, "a", 7.0), (6, day, 3, None, 8.0), (None, day, 1, "a", 1.0)]
    docs = [
        (0, "Die und hand\nA body"), (0, "Die und hand\nB body"), (0, "Two\nB body"), (0, None),
        (1, None), (2, "one line"), (2, "les \n"), (None, "no key\nbody"),
    ]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    facts = [
        (d, p, s, "u", 1704400000, n)
        for d, p, s, n in [(0, "x", "a", 1), (0, "x", "a", 1), (0, "x", "b", 1), (0, "y", None, None), (1, "z", "a", 50), (9, "lost", "a", 900), (2, None, "a", 800), (2, "w", "b", 20)]
    ]
    return str(tmp_path), spark.createDataFrame(facts, FACTS), testtables.texts(spark, str(tmp_path))


def rows(df):
    return sorted(map(str, df.collect()))


def test_silver_of_texts_kept_apart_equals_silver_of_whole_posts(spark, apart):
    _, facts, texts = apart
    loaded = F.timestamp_seconds(F.lit(1706745600))
    whole = silver.build(bronze.build(facts.join(texts, "doc_id"), "b", ingested_at=loaded), FRAGMENTS)
    assert [r["body"] for r in whole.filter("post_id = 'x'").collect()] == ["B body"]
    built = silver.build_apart(bronze.add_partitions(bronze.stamp(facts, "b", ingested_at=loaded)), texts, "doc_id", FRAGMENTS)
    assert built.schema.names == whole.schema.names and rows(built) == rows(whole) and len(rows(built)) == 4


def test_queries_prepare_texts_before_they_join_them(spark, apart):
    folder, _, _ = apart
    posts = registry.raw_posts(spark, folder)
    whole = silver.build(registry.bronze_posts(spark, folder), FRAGMENTS)
    assert rows(registry.built_silver(spark, folder)) == rows(whole)
    stored = registry.silver_posts(spark, folder)
    assert not {"title", "body", "title_cleaned", "body_cleaned"} & set(stored.columns)
    assert rows(stored) == rows(whole.select(*stored.columns))
    timed = posts.withColumn("kafka_ingestion_time", F.timestamp_seconds("created_utc"))
    streamed = stream_posts.enrich(timed, FRAGMENTS, processed_at=F.timestamp_seconds(F.col("created_utc") + F.col("score")))
    assert rows(registry.streamed_rows(spark, folder)) == rows(streamed)
    views = registry.streamed_posts(spark, folder)
    assert "body_cleaned" not in views.columns and rows(views) == rows(streamed.select(*views.columns))
    prepared = testtables.posts(spark, folder, lambda texts: silver.add_text_features(silver.add_clean_text(texts)))
    assert rows(prepared) == rows(silver.add_text_features(silver.add_clean_text(posts)))
    # cleaning stands below the join
    plan = prepared._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("regexp_replace")


def test_latest_of_stored_rows_equals_that_of_whole_rows(spark, tmp_path):
    """Equal rows, ties that only a text or a column after it settles, nulls, and rows without a key."""
    rng = random.Random(17)
    rows = [
        (rng.choice(["p1", "p2", "p3", "p4", None]), rng.choice(["x", None]), rng.choice(["t1", "", None]), rng.choice(["b1", "b2", None]),
         rng.choice(["u", None]), 1704067200, rng.choice([None, 3]))
        for _ in range(300)
    ]
    posts = bronze.build(spark.createDataFrame(rows, schema.POST), "batch", ingested_at=F.lit("2024-02-01").cast("timestamp")).cache()
    want = sorted(map(repr, dedup.drop_duplicates(posts).collect()))
    for name, df in (("ties", posts), ("none", posts.limit(0)), ("twice", posts.limit(3).unionAll(posts.limit(3)))):
        found = dedup.drop_duplicates(df, stage=f"{tmp_path}/{name}")
        assert sorted(map(repr, found.collect())) == sorted(map(repr, dedup.drop_duplicates(df).collect()))
    plan = dedup.latest_stored(spark.read.schema(posts.schema).parquet(f"{tmp_path}/ties"))._jdf.queryExecution().executedPlan().toString()
    assert len(want) == 4 and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan

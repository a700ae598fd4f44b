import datetime as dt

import pytest
from pyspark.sql import functions as F

from postlake import schema
from postlake.operators import gold, summaries, warehouse

DAY = dt.datetime(2024, 1, 1)


def post(**given):
    row = {name: None for name in schema.SILVER.names}
    row |= dict(
        post_id="1", subreddit="s", author="u", score=5, created_datetime=DAY, hour_of_day=0, topics=["x"],
        primary_topic="x", entities=[], entity_count=0, sentiment="neutral", sentiment_polarity=0.0,
        title_word_count=1, has_body=True, engagement_category="low", time_period="night",
    )
    return tuple((row | given)[name] for name in schema.SILVER.names)


def frame(spark, *posts):
    return spark.createDataFrame(list(posts), schema.SILVER)


def test_one_row_group_has_no_deviation_and_no_growth(spark):
    row = gold.daily_stats(frame(spark, post())).first()
    assert (row["score_std"], row["posts_growth_rate"], row["median_score"]) == (None, None, 5)
    series = gold.sentiment_timeseries(frame(spark, post())).first()
    assert (series["polarity_std"], series["is_volatile"], series["positive_percentage"]) == (None, None, 0.0)


def test_trending_is_three_valued(spark):
    def day(n, count):
        return [post(created_datetime=DAY + dt.timedelta(days=n))] * count

    def flags(*counts):
        posts = [p for n, count in enumerate(counts) for p in day(n, count)]
        table = gold.trending_topics(frame(spark, *posts)).orderBy("date")
        return [(r["mention_growth_rate"], r["is_trending"]) for r in table.collect()]

    assert flags(4, 6) == [(None, False), (50.0, False)]
    assert flags(4, 7) == [(None, False), (75.0, True)]
    assert flags(6) == [(None, None)]


def test_user_engagement(spark):
    posts = frame(
        spark, post(primary_topic="b", hour_of_day=3), post(primary_topic="a", hour_of_day=1, score=7),
        post(primary_topic="a", hour_of_day=3), post(primary_topic="b", hour_of_day=9),
    )
    row = gold.with_active_hours(gold.user_engagement(posts, power=3)).first()
    assert (row["post_count"], row["max_score"], row["most_common_topic"]) == (4, 7, "a")
    assert (row["active_hours"], row["unique_hours"], row["is_power_user"]) == ([1, 3, 3, 9], 3, True)


def test_pivot(spark):
    posts = frame(spark, post(subreddit="a", score=4), post(subreddit="b", score=0, topics=["x", "y"]))
    compared = gold.cross_comparison(posts)
    assert sorted((r["topic"], r["subreddit"], r["mentions"]) for r in compared.collect())[0] == ("x", "a", 1)
    rows = {r["topic"]: r.asDict() for r in gold.cross_comparison_wide(compared).collect()}
    assert rows["x"]["a_mentions"] == 1 and rows["x"]["a_avg_score"] == 4.0
    assert rows["y"]["a_mentions"] == 0 and rows["y"]["a_avg_score"] == 0.0
    kept = {r["topic"]: r for r in gold.cross_comparison_wide(compared, ["a", "b"], fill=None).collect()}
    assert kept["y"]["a_avg_score"] is None and kept["y"]["b_avg_score"] == 0.0
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    try:
        with pytest.raises(ValueError):
            gold.cross_comparison_wide(compared)
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_pivot_leaves_no_value_out(spark):
    df = spark.createDataFrame([("d", "a", 1), ("d", "b", 2), ("d", None, 3)], "date string, s string, v int")
    total = {"n": F.sum("v")}
    for given, rows in ((["a"], df.filter("s IS NOT NULL")), (["a", "b"], df)):
        with pytest.raises(Exception, match="was not given"):
            gold.pivoted(rows, ["date"], "s", total, given).collect()
    with pytest.raises(ValueError):
        gold.pivoted(df, ["date"], "s", total)
    named = spark.createDataFrame([("d", "date", 1), ("d", "a", 2)], "date string, s string, v int")
    assert gold.pivoted(named, ["date"], "s", total).first().asDict() == {"date": "d", "a_n": 2, "date_n": 1}


def test_values_in_no_list_count(spark):
    posts = frame(spark, *[post(primary_topic="new", sentiment="odd", entities=["a", "b"]) for _ in range(3)], post(primary_topic="a", entities=["a", "b"]))
    assert gold.user_engagement(posts).first()["most_common_topic"] == "new"
    assert gold.entity_network(posts).first()["dominant_sentiment"] == "odd"


def test_peak_hours(spark):
    posts = [post(hour_of_day=h) for h, count in zip((1, 2, 3, 4, 5), (1, 2, 3, 4, 9)) for _ in range(count)]
    hourly = gold.hourly_patterns(frame(spark, *posts))
    assert gold.peak_hours(hourly).first()["peak_hours"] == [4, 5]


def test_entity_network(spark):
    posts = frame(
        spark, post(post_id="1", entities=["us", "china"], sentiment="negative", score=3),
        post(post_id="2", entities=["china", "us", "iran"], sentiment="negative", score=4),
        post(post_id="3", entities=["us"]), post(post_id="4", entities=[]), post(post_id="5", entities=None),
    )
    pairs = sorted(map(tuple, gold.entity_pairs(posts, "post_id").collect()))
    assert pairs == [("1", "china", "us"), ("2", "china", "iran"), ("2", "china", "us"), ("2", "iran", "us")]
    rows = [tuple(r) for r in gold.entity_network(posts).collect()]
    assert rows == [("china", "us", 2, 3.5, "negative", 7.0)]
    empty = gold.entity_network(posts.limit(0))
    assert empty.columns == gold.entity_network(posts).columns and empty.count() == 0


def test_pairs_equal_the_self_join(spark):
    names = ["a", "b", "c", "d", "e", "f"]
    posts = spark.range(500).select(
        F.col("id").cast("string").alias("post_id"),
        F.filter(F.array(*map(F.lit, names)), lambda n: F.pmod(F.xxhash64("id", n), F.lit(3)) == 0).alias("entities"),
    )
    exploded = posts.select("post_id", F.explode("entities").alias("e"))
    a, b = exploded.alias("a"), exploded.alias("b")
    joined = a.join(b, (F.col("a.post_id") == F.col("b.post_id")) & (F.col("a.e") < F.col("b.e")))
    want = joined.select("a.post_id", F.col("a.e"), F.col("b.e")).collect()
    got = gold.entity_pairs(posts, "post_id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and got


def test_mentions_add_up(spark):
    posts = frame(spark, post(topics=["x", "y"]), post(topics=["y"], subreddit="t"), post(topics=[]))
    mentions = gold.trending_topics(posts).agg(F.sum("mention_count")).first()[0]
    assert mentions == posts.agg(F.sum(F.size("topics"))).first()[0] == 3


def test_empty_input_keeps_every_schema(spark):
    one, none = frame(spark, post()), frame(spark)
    for name, table in summaries.gold_tables(none).items():
        assert table.schema.names == summaries.gold_tables(one)[name].schema.names
        assert table.count() == 0, name
    assert summaries.insights(none).first()["total_posts"] == 0
    assert summaries.global_stats(none).first()["body_percentage"] is None
    assert summaries.manifest(none, "b", "s").first()["total_records"] == 0


def test_reading_order(spark):
    posts = frame(spark, post(subreddit="b"), post(subreddit="a"), post(subreddit="a", created_datetime=DAY - dt.timedelta(days=1)))
    rows = gold.in_reading_order(gold.daily_stats(posts), "daily_subreddit_stats").collect()
    assert [(r["subreddit"], r["date"].day) for r in rows] == [("a", 31), ("a", 1), ("b", 1)]


def test_early_cut_changes_no_row(spark):
    from postlake.operators import dedup

    df = spark.range(300).selectExpr("cast(id % 40 AS string) AS post_id", "cast(id % 7 AS int) AS score", "id")
    rows = [sorted(map(tuple, dedup.drop_duplicates(df, early_cut=cut).collect())) for cut in (True, False)]
    assert rows[0] == rows[1] and len(rows[0]) == 40
    plans = [dedup.drop_duplicates(df, early_cut=cut)._jdf.queryExecution().executedPlan().toString() for cut in (True, False)]
    assert ["WindowGroupLimit" in plan for plan in plans] == [True, False]


def test_insights_ties(spark):
    posts = frame(spark, post(primary_topic="b", score=2), post(primary_topic="a", score=2, hour_of_day=4))
    row = summaries.insights(posts).first()
    assert (row["best_topic"], row["best_avg"], row["pct_above_mean"], row["peak_hour"], row["peak_count"]) == ("a", 2.0, 0.0, 0, 1)
    assert [(t["topic"], t["count"]) for t in row["top_topics"]] == [("a", 1), ("b", 1)]
    assert [t["topic"] for t in summaries.insights(posts, k=1).first()["top_topics"]] == ["a"]
    assert row["n_subreddits"] == 1
    assert summaries.insight_texts(summaries.insights(posts)).count() == 2


def test_quality_metrics(spark):
    rows = [("t", "neutral", None, DAY, DAY + dt.timedelta(seconds=3)), (None, None, "x", DAY, DAY + dt.timedelta(seconds=1.5)),
            ("old", "neutral", "x", DAY, DAY - dt.timedelta(hours=30))]
    posts = spark.createDataFrame(
        rows, "title_cleaned string, sentiment string, topic string, kafka_ingestion_time timestamp, processing_timestamp timestamp"
    )
    metrics = warehouse.quality_metrics(posts, 24, F.lit("2024-01-01 12:00:00").cast("timestamp"))
    assert {r[0]: r[1] for r in metrics.collect()} == {
        "total_records": 2.0, "null_titles": 1.0, "null_sentiment": 1.0, "null_topic": 1.0,
        "avg_processing_delay_seconds": 2.25,
    }
    shown = warehouse.metric_rows(metrics, job="nightly").first()
    assert shown["metadata"] == '{"job":"nightly"}' and shown["metric_timestamp"] is not None

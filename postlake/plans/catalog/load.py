"""Loading: messages, bronze, deduplication, silver, whole layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import schema
from postlake.functions import text
from postlake.operators import bronze, dedup, silver, summaries
from postlake.plans import layers
from postlake.plans.catalog import registry, sql
from postlake.plans.catalog.registry import query
from postlake.session import shared_folder
from postlake.sinks import files as sink
from postlake.sinks.keyed import KeyedTable
from postlake.sources import files, messages
from postlake.sources.testtables import FRAGMENTS
from postlake.streaming import sinks as stream_sinks

MALFORMED = """
  SELECT text AS raw_value, 'unreadable' AS reason FROM documents
  UNION ALL SELECT props, 'missing_key' FROM events
"""


@query(f"WITH {sql.POSTS} SELECT * FROM posts")
def posts(spark: SparkSession, folder: str) -> DataFrame:
    return registry.raw_posts(spark, folder)


@query(f"WITH {sql.POSTS} SELECT * FROM posts")
def message_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Posts as JSON messages and back."""
    encoded = messages.encode(registry.raw_posts(spark, folder))
    return messages.good_rows(messages.decode(encoded))


@query("""
  SELECT (SELECT count(*) FROM events) AS success,
         (SELECT count(*) FROM documents) + (SELECT count(*) FROM events) AS failed,
         (SELECT count(*) FROM documents) + 2 * (SELECT count(*) FROM events) AS total
""")
def parse_counts(spark: SparkSession, folder: str) -> DataFrame:
    return messages.parse_counts(messages.decode(registry.mixed_messages(spark, folder)))


@query(MALFORMED)
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return messages.quarantine(messages.decode(registry.mixed_messages(spark, folder)))


@query(f"WITH {sql.BRONZE} SELECT * FROM dated")
def bronze_layer(spark: SparkSession, folder: str) -> DataFrame:
    return registry.bronze_posts(spark, folder)


@query(f"""
  WITH {sql.BRONZE}
  SELECT 'batch_1' AS batch_id, 'events' AS source, count(*) AS total_records,
         count(DISTINCT subreddit) AS n_subreddits, min(created_datetime) AS min_date,
         max(created_datetime) AS max_date, '1.0' AS schema_version FROM dated
""")
def manifest(spark: SparkSession, folder: str) -> DataFrame:
    row = summaries.manifest(registry.bronze_posts(spark, folder), "batch_1", "events")
    return row.drop("ingestion_time", "spark_version")


@query(f"""
  WITH {sql.BRONZE} SELECT subreddit, count(*) AS n, min(created_datetime) AS first, max(created_datetime) AS last
  FROM dated GROUP BY subreddit
""")
def manifest_counts(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.manifest_counts(registry.bronze_posts(spark, folder))


@query(f"""
  WITH {sql.BRONZE}, per_key AS (SELECT subreddit, count(*) AS n FROM dated GROUP BY subreddit)
  SELECT 'batch_1' AS batch_id, cast(sum(n) AS bigint) AS total_records,
    '{{' || string_agg('"' || subreddit || '":' || n, ',' ORDER BY subreddit) || '}}' AS subreddits FROM per_key
""")
def manifest_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The written manifest of a load read back, its map of subreddits in order."""
    path = shared_folder(spark, "manifest")
    sink.write_document(summaries.manifest_document(registry.bronze_posts(spark, folder), "batch_1", "events"), path)
    row = files.read_document(spark, path, "batch_id string, total_records bigint, subreddits map<string,bigint>")
    ordered = F.map_from_entries(F.array_sort(F.map_entries("subreddits")))
    return row.withColumn("subreddits", F.to_json(ordered))


@query(f"""
  WITH {sql.BRONZE} SELECT subreddit, partition_year, partition_month, partition_day, count(*) AS count
  FROM dated GROUP BY ALL
""")
def partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.partition_counts(registry.bronze_posts(spark, folder))


@query(f"""
  WITH {sql.POSTS} SELECT subreddit, count(post_id) AS total_posts, avg(score) AS avg_score
  FROM posts GROUP BY subreddit
""")
def subreddit_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.subreddit_summary(registry.raw_posts(spark, folder))


def _polled_again(spark: SparkSession, folder: str) -> DataFrame:
    """Every post three times: loaded twice alike, and once with another score and load time."""
    first = registry.bronze_posts(spark, folder)
    later = F.timestamp_seconds(F.lit(1706745600) + (F.col("score") - 50) * 60)
    again = registry.raw_posts(spark, folder).withColumn("score", F.col("score") + 1)
    second = bronze.build(again, "batch_2", ingested_at=later)
    return first.unionByName(first).unionByName(second)


REPEATED = f"""{sql.BRONZE}, again AS (
  SELECT * REPLACE (score + 1 AS score, 'batch_2' AS batch_id,
    make_timestamp((1706745600::bigint + (score + 1 - 50) * 60) * 1000000) AS ingestion_timestamp) FROM dated
), repeated AS (
  SELECT * FROM dated UNION ALL SELECT * FROM dated UNION ALL SELECT * FROM again
)"""


@query(f"""
  WITH {REPEATED} SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY post_id ORDER BY ingestion_timestamp DESC, row_hash DESC, score DESC) AS rn
    FROM repeated
  ) WHERE rn = 1
""")
def deduplicated(spark: SparkSession, folder: str) -> DataFrame:
    stage = f"{shared_folder(spark, 'deduplicated')}/rows"
    return dedup.drop_duplicates(_polled_again(spark, folder), stage=stage)


@query(f"""
  WITH {REPEATED} SELECT count(*) AS before, count(DISTINCT post_id) AS after,
         count(*) - count(DISTINCT post_id) AS removed FROM repeated
""")
def duplicate_counts(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.duplicate_counts(_polled_again(spark, folder))


@query(f"""
  WITH {sql.silver()} SELECT * EXCLUDE (date) REPLACE (
    {sql.listed('topics')} AS topics, {sql.listed('entities')} AS entities,
    {sql.rounded('sentiment_polarity', 6)} AS sentiment_polarity,
    {sql.rounded('score_normalized', 6)} AS score_normalized) FROM silver
""")
def silver_layer(spark: SparkSession, folder: str) -> DataFrame:
    """Deduplication, text, time and score features of whole posts."""
    built = registry.built_silver(spark, folder)
    return built.withColumns({
        "topics": text.array_text(F.col("topics")),
        "entities": text.array_text(F.col("entities")),
        "sentiment_polarity": F.round("sentiment_polarity", 6),
        "score_normalized": F.round("score_normalized", 6),
    })


@query(f"""
  WITH {sql.silver()}, pairs AS (
    SELECT a.e AS e1, b.e AS e2, count(*) AS n
    FROM (SELECT post_id, unnest(entities) AS e FROM silver) a
    JOIN (SELECT post_id, unnest(entities) AS e FROM silver) b ON a.post_id = b.post_id AND a.e < b.e
    GROUP BY ALL HAVING count(*) >= 2
  ), exploded AS (SELECT date, subreddit, unnest(topics) AS topic FROM silver)
  SELECT 'bronze' AS table_name, count(*) AS row_count FROM silver
  UNION ALL SELECT 'silver', count(*) FROM silver
  UNION ALL SELECT 'quarantine', (SELECT count(*) FROM documents) + (SELECT count(*) FROM events)
  UNION ALL SELECT 'daily_subreddit_stats', count(*) FROM (SELECT DISTINCT subreddit, date FROM silver)
  UNION ALL SELECT 'trending_topics', count(*) FROM (SELECT DISTINCT date, topic, subreddit FROM exploded)
  UNION ALL SELECT 'user_engagement', count(*) FROM (SELECT DISTINCT author, subreddit, date FROM silver)
  UNION ALL SELECT 'cross_subreddit_comparison', count(*) FROM (SELECT DISTINCT date, topic, subreddit FROM exploded)
  UNION ALL SELECT 'hourly_patterns', count(*) FROM (SELECT DISTINCT subreddit, hour_of_day FROM silver)
  UNION ALL SELECT 'entity_network', count(*) FROM pairs
  UNION ALL SELECT 'sentiment_timeseries', count(*) FROM (SELECT DISTINCT subreddit, date, hour_of_day FROM silver)
""")
def layer_counts(spark: SparkSession, folder: str) -> DataFrame:
    """A full reload from good and malformed messages; the rows of every table it wrote."""
    layout = registry.new_layout(spark, "layers")
    incoming = registry.mixed_messages(spark, folder)
    layers.run_layers(spark, incoming, layout.root, "batch_1", lexicon=FRAGMENTS)
    tables = {"bronze": layout.bronze, "silver": layout.silver, "quarantine": layout.quarantine}
    tables |= {name: f"{layout.gold}/{name}" for name in layers.GOLD_TABLES}
    counts = None
    for name, path in tables.items():
        one = files.read_table(spark, path).agg(F.count(F.lit(1)).alias("row_count"))
        one = one.select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionAll(one)
    return counts


def _bronze_and_quarantine(spark: SparkSession, layout: layers.Layout) -> DataFrame:
    """All that the loads of a layout have kept, as (table_name, item)."""
    good = layers.read_bronze(spark, layout).select(F.lit("bronze").alias("table_name"), F.col("post_id").alias("item"))
    bad = layers.read_quarantine(spark, layout).select(F.lit("quarantine"), F.col("raw_value"))
    return good.unionAll(bad)


@query("""
  SELECT 'quarantine' AS table_name, text AS item FROM documents UNION ALL SELECT 'quarantine', props FROM events
""")
def all_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """A load without a single good message."""
    layout = registry.new_layout(spark, "all-malformed")
    bad = messages.quarantine(messages.decode(registry.mixed_messages(spark, folder)))
    layers.load_bronze(bad.select(F.col("raw_value").alias("value")), layout, "batch_1")
    return _bronze_and_quarantine(spark, layout)


@query("""
  SELECT 'bronze' AS table_name, cast(event_id AS varchar) AS item FROM events, range(2)
  UNION ALL SELECT 'quarantine', text FROM documents UNION ALL SELECT 'quarantine', props FROM events
""")
def append_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """A load with malformed messages, one without, and the first one again: what it rejected stays, once."""
    layout = registry.new_layout(spark, "append-quarantine")
    mixed = registry.mixed_messages(spark, folder)
    good = messages.encode(registry.raw_posts(spark, folder))
    for batch, load in ((mixed, "batch_1"), (good, "batch_2"), (mixed, "batch_1")):
        layers.load_bronze(batch, layout, load)
    return _bronze_and_quarantine(spark, layout)


@query(f"""
  WITH {sql.streamed()} SELECT post_id, score - 1 AS score, kafka_ingestion_time + INTERVAL 1 DAY AS kafka_ingestion_time, 2 AS batches
  FROM streamed UNION ALL SELECT post_id, score - 1, kafka_ingestion_time + INTERVAL 1 DAY, 1 FROM streamed
""")
def merged_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Two versions of each post, the later one with the smaller score, merged into a stored table: at once, and one after
    the other, after which the earlier batch comes late and the later one again."""
    early = registry.streamed_rows(spark, folder)
    later = early.withColumns({"score": F.col("score") - 1, "kafka_ingestion_time": F.col("kafka_ingestion_time") + F.expr("INTERVAL 1 DAY")})
    found = None
    for batches in ([early.unionByName(later)], [early, later, early, later]):
        table = KeyedTable(spark, shared_folder(spark, "merged"), schema.STREAM_ROW, buckets=8)
        for number, batch in enumerate(batches):
            stream_sinks.merge_into(table)(batch, number)
        rows = table.read().select("post_id", "score", "kafka_ingestion_time", F.lit(min(len(batches), 2)).alias("batches"))
        found = rows if found is None else found.unionByName(rows)
    return found

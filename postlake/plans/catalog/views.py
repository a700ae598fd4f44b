"""Views, rollups and quality metrics over the streamed posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import features
from postlake.operators import warehouse
from postlake.plans.catalog import registry, sql
from postlake.plans.catalog.registry import query
from postlake.session import shared_folder
from postlake.sources import files

STREAMED = sql.streamed()
MADE_AT = "2024-02-01 00:00:00"  # of the rollups here
R = sql.rounded
S = sql.steady


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Unrounded means depend on the order of summing in their last digits; compare six."""
    return df.withColumns({name: features.steady_round(F.col(name), 6) for name in columns})


@query(f"""
  WITH {STREAMED} SELECT subreddit, cast(created_datetime AS date) AS date, count(*) AS total_posts,
    cast(sum(score) AS bigint) AS total_score, {S('avg(score)', 6)} AS avg_score, max(score) AS max_score,
    {S('stddev_samp(score)', 6)} AS score_stddev, {S('avg(sentiment_score)', 6)} AS avg_sentiment,
    {S('avg(title_word_count)', 6)} AS avg_title_length, count(*) FILTER (has_body) AS posts_with_body,
    count(DISTINCT author) AS unique_authors
  FROM streamed GROUP BY ALL
""")
def mv_daily(spark: SparkSession, folder: str) -> DataFrame:
    view = warehouse.daily_view(registry.streamed_posts(spark, folder))
    return _rounded(view, "avg_score", "score_stddev", "avg_sentiment", "avg_title_length")


@query(f"""
  WITH {STREAMED} SELECT date_trunc('hour', created_datetime) AS hour, subreddit, sentiment,
    count(*) AS count, {S('avg(sentiment_score)', 6)} AS avg_score, {S('avg(score)', 6)} AS avg_engagement
  FROM streamed GROUP BY ALL
""")
def mv_hourly_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    view = warehouse.hourly_sentiment_view(registry.streamed_posts(spark, folder))
    return _rounded(view, "avg_score", "avg_engagement")


@query(f"""
  WITH {STREAMED} SELECT topic, subreddit, count(*) AS mention_count, {S('avg(score)', 6)} AS avg_score,
    {S('avg(sentiment_score)', 6)} AS avg_sentiment, count(DISTINCT author) AS unique_authors,
    max(created_datetime) AS last_mention
  FROM streamed GROUP BY ALL
""")
def mv_topic(spark: SparkSession, folder: str) -> DataFrame:
    view = warehouse.topic_view(registry.streamed_posts(spark, folder))
    return _rounded(view, "avg_score", "avg_sentiment")


@query(f"""
  WITH {STREAMED} SELECT subreddit, count(*) AS total_posts, cast(sum(score) AS bigint) AS total_score,
    {R('avg(score)', 2)} AS avg_score, max(score) AS max_score, count(DISTINCT author) AS unique_authors,
    max(created_datetime) AS last_post_time, TIMESTAMP '2024-02-01 00:00:00' AS last_updated
  FROM streamed GROUP BY subreddit
""")
def rollup_subreddit(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.subreddit_rollup(registry.streamed_posts(spark, folder), F.lit(MADE_AT).cast("timestamp"))


@query(f"""
  WITH {STREAMED} SELECT topic, count(*) AS total_mentions, {R('avg(score)', 2)} AS avg_score,
    {S('avg(sentiment_score)', 3)} AS avg_sentiment, TIMESTAMP '2024-02-01 00:00:00' AS last_updated
  FROM streamed GROUP BY topic
""")
def rollup_topic(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.topic_rollup(registry.streamed_posts(spark, folder), F.lit(MADE_AT).cast("timestamp"))


METRICS = f"""{STREAMED}, lately AS (
  SELECT * FROM streamed
  WHERE processing_timestamp >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 24 HOUR
), metrics AS (
  SELECT 'total_records' AS metric_name, count(*)::double AS metric_value FROM lately
  UNION ALL SELECT 'null_titles', count(*) FILTER (title_cleaned IS NULL) FROM lately
  UNION ALL SELECT 'null_sentiment', count(*) FILTER (sentiment IS NULL) FROM lately
  UNION ALL SELECT 'null_topic', count(*) FILTER (topic IS NULL) FROM lately
  UNION ALL SELECT 'avg_processing_delay_seconds',
    avg(epoch(processing_timestamp) - epoch(kafka_ingestion_time)) FROM lately
)"""


def _metrics(spark, folder):
    as_of = F.lit("2024-01-30 00:00:00").cast("timestamp")
    return warehouse.quality_metrics(registry.streamed_posts(spark, folder), 24, as_of)


@query(f"WITH {METRICS} SELECT metric_name, {S('metric_value', 6)} AS metric_value FROM metrics")
def quality_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_metrics(spark, folder), "metric_value")


@query(f"""
  WITH {METRICS} SELECT TIMESTAMP '2024-01-30 00:00:00' AS metric_timestamp, metric_name,
    {S('metric_value', 6)} AS metric_value, '{{"table":"posts"}}' AS metadata FROM metrics
""")
def metric_rows(spark: SparkSession, folder: str) -> DataFrame:
    at = F.lit("2024-01-30 00:00:00").cast("timestamp")
    return _rounded(warehouse.metric_rows(_metrics(spark, folder), at, table="posts"), "metric_value")


@query(f"""
  WITH {STREAMED}
  SELECT 'mv_daily_subreddit_stats' AS view_name, count(*) AS row_count
  FROM (SELECT DISTINCT subreddit, cast(created_datetime AS date) FROM streamed)
  UNION ALL SELECT 'mv_hourly_sentiment', count(*)
  FROM (SELECT DISTINCT date_trunc('hour', created_datetime), subreddit, sentiment FROM streamed)
  UNION ALL SELECT 'mv_topic_performance', count(*) FROM (SELECT DISTINCT topic, subreddit FROM streamed)
""")
def refresh_all(spark: SparkSession, folder: str) -> DataFrame:
    """All views recomputed and written; the rows of each table."""
    tables = warehouse.refresh_all(registry.streamed_posts(spark, folder), shared_folder(spark, "views"))
    counts = None
    for name, path in tables.items():
        rows = files.read_table(spark, path).agg(F.count(F.lit(1)).alias("row_count"))
        rows = rows.select(F.lit(name).alias("view_name"), "row_count")
        counts = rows if counts is None else counts.unionAll(rows)
    return counts

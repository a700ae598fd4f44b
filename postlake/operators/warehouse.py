"""Derived tables over the streamed posts table: views, rollups and quality metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import features


def _rows():
    return F.count(F.lit(1))


def daily_view(posts: DataFrame) -> DataFrame:
    """Unrounded statistics per subreddit and day, with distinct authors."""
    return posts.groupBy("subreddit", F.to_date("created_datetime").alias("date")).agg(
        _rows().alias("total_posts"),
        F.sum("score").alias("total_score"),
        F.avg("score").alias("avg_score"),
        F.max("score").alias("max_score"),
        F.stddev("score").alias("score_stddev"),
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.avg("title_word_count").alias("avg_title_length"),
        F.count_if("has_body").alias("posts_with_body"),
        F.count_distinct("author").alias("unique_authors"),
    )


def hourly_sentiment_view(posts: DataFrame) -> DataFrame:
    """Per hour, subreddit and label; ``avg_score`` is of sentiment, ``avg_engagement`` of the score."""
    hour = F.date_trunc("hour", "created_datetime").alias("hour")
    return posts.groupBy(hour, "subreddit", "sentiment").agg(
        _rows().alias("count"),
        F.avg("sentiment_score").alias("avg_score"),
        F.avg("score").alias("avg_engagement"),
    )


def topic_view(posts: DataFrame) -> DataFrame:
    return posts.groupBy("topic", "subreddit").agg(
        _rows().alias("mention_count"),
        F.avg("score").alias("avg_score"),
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.count_distinct("author").alias("unique_authors"),
        F.max("created_datetime").alias("last_mention"),
    )


VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "mv_daily_subreddit_stats": daily_view,
    "mv_hourly_sentiment": hourly_sentiment_view,
    "mv_topic_performance": topic_view,
}


def refresh_all(posts: DataFrame, path: str) -> dict[str, str]:
    """Recompute every view and overwrite its table below ``path``. Gives the table folders."""
    folders = {name: f"{path}/{name}" for name in VIEWS}
    for name, view in VIEWS.items():
        view(posts).write.mode("overwrite").parquet(folders[name])
    return folders


def _updated(rollup: DataFrame, at: Column | None) -> DataFrame:
    return rollup.withColumn("last_updated", F.current_timestamp() if at is None else at)


def subreddit_rollup(posts: DataFrame, at: Column | None = None) -> DataFrame:
    """Totals per subreddit, with the time they were made (``at``, default: now)."""
    return _updated(posts.groupBy("subreddit").agg(
        _rows().alias("total_posts"),
        F.sum("score").alias("total_score"),
        F.round(F.avg("score"), 2).alias("avg_score"),
        F.max("score").alias("max_score"),
        F.count_distinct("author").alias("unique_authors"),
        F.max("created_datetime").alias("last_post_time"),
    ), at)


def topic_rollup(posts: DataFrame, at: Column | None = None) -> DataFrame:
    """Totals per topic, with the time they were made. A trending score is not defined anywhere and so is not made up here."""
    return _updated(posts.groupBy("topic").agg(
        _rows().alias("total_mentions"),
        F.round(F.avg("score"), 2).alias("avg_score"),
        features.steady_round(F.avg("sentiment_score"), 3).alias("avg_sentiment"),
    ), at)


def recent(df: DataFrame, time: str, hours: int, as_of: Column | None = None) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of`` (default: now)."""
    now = F.current_timestamp() if as_of is None else as_of
    return df.filter(F.col(time) >= now - F.make_interval(hours=F.lit(hours)))


def quality_metrics(posts: DataFrame, hours: int = 24, as_of: Column | None = None) -> DataFrame:
    """Quality of the rows processed lately, as (metric_name, metric_value). One pass over the rows."""
    delay = F.unix_micros("processing_timestamp") - F.unix_micros("kafka_ingestion_time")
    measured = recent(posts, "processing_timestamp", hours, as_of).agg(
        _rows().cast("double").alias("total_records"),
        F.count_if(F.col("title_cleaned").isNull()).cast("double").alias("null_titles"),
        F.count_if(F.col("sentiment").isNull()).cast("double").alias("null_sentiment"),
        F.count_if(F.col("topic").isNull()).cast("double").alias("null_topic"),
        F.avg(delay / 1_000_000).alias("avg_processing_delay_seconds"),
    )
    return measured.unpivot([], measured.columns, "metric_name", "metric_value")


def metric_rows(metrics: DataFrame, at: Column | None = None, **metadata: str) -> DataFrame:
    """Metrics as rows of a monitoring table, with a time and JSON metadata."""
    notes = F.struct(*[F.lit(value).alias(name) for name, value in metadata.items()]) if metadata else None
    return metrics.select(
        (F.current_timestamp() if at is None else at).alias("metric_timestamp"),
        "metric_name",
        "metric_value",
        (F.lit(None).cast("string") if notes is None else F.to_json(notes)).alias("metadata"),
    )

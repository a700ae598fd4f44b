"""Layers and views that are kept up to date load by load, against the SQL of the full run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import text
from postlake.operators import bronze
from postlake.operators.states import Views
from postlake.operators.titleindex import TitleIndex
from postlake.plans.catalog import registry, sql, tables, texts, views  # noqa: F401
from postlake.plans.catalog.registry import CATALOG, query
from postlake.plans.increments import Increments
from postlake.sources.testtables import FRAGMENTS

AGAIN = "e.event_id % 10 = 0"  # posts that the second load brings once more, with a larger score


def _changed(statement: str) -> str:
    """The SQL of a full run over the posts as they are after both loads."""
    score = "cast(floor(e.value) AS int) AS score"
    if score not in statement:
        raise ValueError("the posts are made otherwise now")
    return statement.replace(score, f"cast(floor(e.value) AS int) + CASE WHEN {AGAIN} THEN 1000 ELSE 0 END AS score")


def _layers(spark: SparkSession, folder: str) -> Increments:
    """The posts of the first half of the month, then the others together with every tenth one of all with a larger score."""

    def write(root: str) -> None:
        found = Increments(spark, root, FRAGMENTS, buckets=8)
        posts = registry.raw_posts(spark, folder)
        early = F.col("created_utc") < F.unix_seconds(F.lit("2024-01-16").cast("timestamp"))
        stamped = lambda rows, name, at: bronze.build(rows, name, ingested_at=F.timestamp_seconds(F.lit(at)))
        found.add("load_1", stamped(posts.filter(early), "batch_1", 1706745600))
        again = posts.filter(F.col("post_id").cast("long") % 10 == 0).withColumn("score", F.col("score") + 1000)
        second = stamped(posts.filter(~early), "batch_2", 1706832000).unionByName(stamped(again, "batch_2", 1706832060))
        found.add("load_2", second)
        found.add("load_2", second)

    return Increments(spark, registry._once(spark, folder, "incremental", write), FRAGMENTS, buckets=8)


@query(f"""
  WITH {_changed(sql.silver())} SELECT * EXCLUDE (date, ingestion_timestamp, batch_id) REPLACE (
    {sql.listed('topics')} AS topics, {sql.listed('entities')} AS entities,
    {sql.rounded('sentiment_polarity', 6)} AS sentiment_polarity,
    {sql.rounded('score_normalized', 6)} AS score_normalized) FROM silver
""")
def incremental_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Silver after two loads, of which the second changes posts of the first one and the range of scores."""
    found = _layers(spark, folder).silver().drop("ingestion_timestamp", "batch_id")
    return found.withColumns({
        "topics": text.array_text(F.col("topics")),
        "entities": text.array_text(F.col("entities")),
        "sentiment_polarity": F.round("sentiment_polarity", 6),
        "score_normalized": F.round("score_normalized", 6),
    })


@query(_changed(CATALOG["daily_stats"].sql))
def incremental_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _layers(spark, folder).gold("daily_subreddit_stats")


@query(_changed(CATALOG["trending_topics"].sql))
def incremental_trending(spark: SparkSession, folder: str) -> DataFrame:
    return _layers(spark, folder).gold("trending_topics")


@query(_changed(CATALOG["hourly_patterns"].sql))
def incremental_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Hours over all days, from the sums of each day."""
    return _layers(spark, folder).gold("hourly_patterns")


@query(_changed(CATALOG["entity_network"].sql))
def incremental_network(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs over all days, from the sums of each day."""
    return _layers(spark, folder).gold("entity_network")


@query(_changed(CATALOG["sentiment_timeseries"].sql))
def incremental_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    return _layers(spark, folder).gold("sentiment_timeseries")


def _views(spark: SparkSession, folder: str) -> Views:
    """States of all views, refreshed with three loads, one of them twice."""

    def write(root: str) -> None:
        found = Views(spark, root)
        posts = registry.streamed_posts(spark, folder)
        for load in (0, 1, 2, 1):
            found.refresh(f"load_{load}", posts.filter(F.col("post_id").cast("long") % 3 == load))

    return Views(spark, registry._once(spark, folder, "view-states", write))


@query(CATALOG["mv_daily"].sql)
def mv_daily_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    view = _views(spark, folder).view("mv_daily_subreddit_stats")
    return views._rounded(view, "avg_score", "score_stddev", "avg_sentiment", "avg_title_length")


@query(CATALOG["mv_hourly_sentiment"].sql)
def mv_hourly_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    return views._rounded(_views(spark, folder).view("mv_hourly_sentiment"), "avg_score", "avg_engagement")


@query(CATALOG["mv_topic"].sql)
def mv_topic_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    return views._rounded(_views(spark, folder).view("mv_topic_performance"), "avg_score", "avg_sentiment")


@query(CATALOG["rollup_subreddit"].sql)
def rollup_subreddit_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    return _views(spark, folder).view("subreddit_rollup", at=F.lit(views.MADE_AT).cast("timestamp"))


@query(CATALOG["rollup_topic"].sql)
def rollup_topic_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    return _views(spark, folder).view("topic_rollup", at=F.lit(views.MADE_AT).cast("timestamp"))


def _titles(spark: SparkSession, folder: str) -> TitleIndex:
    """An index of all titles, added in two loads."""

    def write(root: str) -> None:
        found = TitleIndex(spark, root)
        posts = registry.raw_posts(spark, folder).select("post_id", "title")
        for load in (0, 1):
            found.add(f"load_{load}", posts.filter(F.col("post_id").cast("long") % 2 == load))

    return TitleIndex(spark, registry._once(spark, folder, "titles", write))


@query(CATALOG["title_search"].sql)
def title_search_indexed(spark: SparkSession, folder: str) -> DataFrame:
    return _titles(spark, folder).search(registry.raw_posts(spark, folder), ["the", "of"]).select("post_id", "title")


@query(CATALOG["title_search_any"].sql)
def title_search_any_indexed(spark: SparkSession, folder: str) -> DataFrame:
    return _titles(spark, folder).search(registry.raw_posts(spark, folder), ["der", "que"], every=False).select("post_id", "title")

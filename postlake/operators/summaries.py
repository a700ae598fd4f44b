"""Counts, distributions, top lists and the insights row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake import fixed
from postlake.operators import gold


def top(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """The ``k`` rows with the largest ``by``. ``ties`` should make the order unique."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(k)


def partition_counts(bronze: DataFrame, keys: Sequence[str] = fixed.BRONZE_PARTITIONS) -> DataFrame:
    return bronze.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def subreddit_summary(posts: DataFrame) -> DataFrame:
    return posts.groupBy("subreddit").agg(
        F.count("post_id").alias("total_posts"), F.avg("score").alias("avg_score")
    )


def distributions(posts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of the values of several columns, as (feature, value, count).

    One pass: rows are first counted by all columns together, which leaves few rows as long as the
    columns are bucket names, and these are then split up.
    """
    joint = posts.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    parts = F.array(*[
        F.struct(F.lit(name).alias("feature"), F.col(name).cast("string").alias("value")) for name in columns
    ])
    split = joint.select(F.explode(parts).alias("part"), "n")
    return split.groupBy("part.feature", "part.value").agg(F.sum("n").alias("count"))


def top_entities(posts: DataFrame, k: int = 10) -> DataFrame:
    counts = posts.select(F.explode("entities").alias("entity")).groupBy("entity").count()
    return top(counts, "count", k, "entity")


def top_trending(trending: DataFrame, k: int = 5) -> DataFrame:
    """The fastest growing topics among those flagged."""
    shown = trending.filter("is_trending").select(
        "date", "topic", "subreddit", "mention_count", "mention_growth_rate"
    )
    return top(shown, "mention_growth_rate", k, "topic", "subreddit", "date")


def top_contributors(users: DataFrame, k: int = 5) -> DataFrame:
    shown = users.select("author", "subreddit", "date", "post_count", "avg_score")
    return top(shown, "post_count", k, "author", "subreddit", "date")


def top_pairs(network: DataFrame, k: int = 5) -> DataFrame:
    return top(network, "co_occurrence_count", k, "entity_1", "entity_2")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def global_stats(posts: DataFrame) -> DataFrame:
    """Totals over all posts in one pass."""
    total, with_body = F.count(F.lit(1)), F.count_if("has_body")
    return posts.agg(
        total.alias("total_posts"),
        F.min("created_datetime").alias("first_post"),
        F.max("created_datetime").alias("last_post"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.round(F.avg("title_word_count"), 1).alias("avg_title_words"),
        with_body.alias("posts_with_body"),
        F.round(F.try_divide(with_body * 100, total), 1).alias("body_percentage"),
    )


def manifest_counts(bronze: DataFrame) -> DataFrame:
    """The posts and the time range of each subreddit of a load, a row for each."""
    return bronze.groupBy("subreddit").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("created_datetime").alias("first"),
        F.max("created_datetime").alias("last"),
    )


def _manifest(bronze: DataFrame, batch_id: str, source: str, *more: Column) -> DataFrame:
    return manifest_counts(bronze).agg(
        F.lit(batch_id).alias("batch_id"),
        F.current_timestamp().alias("ingestion_time"),
        F.lit(source).alias("source"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count(F.lit(1)).alias("n_subreddits"),
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
        F.lit(fixed.MANIFEST_VERSION).alias("schema_version"),
        F.version().alias("spark_version"),
        *more,
    )


def manifest(bronze: DataFrame, batch_id: str, source: str) -> DataFrame:
    """One row on a load: totals, time range, versions. The counts of the subreddits are a table (``manifest_counts``)."""
    return _manifest(bronze, batch_id, source)


def manifest_document(bronze: DataFrame, batch_id: str, source: str) -> DataFrame:
    """The manifest for export, with a map of the posts of each subreddit: as large as their number."""
    counts = F.sort_array(F.collect_list(F.struct("subreddit", "n")))
    return _manifest(bronze, batch_id, source, F.map_from_entries(F.filter(counts, lambda c: c["subreddit"].isNotNull())).alias("subreddits"))


def insights(posts: DataFrame, k: int = 5) -> DataFrame:
    """One row: totals, number of subreddits, time range, top topics, best topic and busiest hour.

    Posts are read once and counted into a small cube (topic x subreddit x hour); grouping sets over the
    cube give every figure. Best topic compares rounded means, as shown; ties go to the smallest topic
    or hour. Of the topics only the first ``k`` are gathered: the rank filter runs in every task first.
    """
    cube = posts.groupBy("primary_topic", "hour_of_day", "subreddit").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("score").alias("points"),
        F.count("score").alias("scored"),
        F.min("created_datetime").alias("first"),
        F.max("created_datetime").alias("last"),
    )
    topic, hour, subreddit = F.col("primary_topic"), F.col("hour_of_day"), F.col("subreddit")
    figures = cube.groupingSets([[topic], [hour], [subreddit], []], topic, hour, subreddit).agg(
        F.grouping_id().alias("grouping"),
        F.sum("n").alias("n"),
        F.try_divide(F.sum("points"), F.sum("scored")).alias("exact"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    ).withColumn("mean", F.round("exact", 2))
    # The id has a bit for each column that is not grouped by.
    per_topic, per_hour, per_subreddit, overall = (F.col("grouping") == g for g in (0b011, 0b101, 0b110, 0b111))

    by_mean = F.struct((-F.col("mean")).alias("rank"), topic.alias("topic"), F.col("mean").alias("mean"))
    by_count = F.struct((-F.col("n")).alias("rank"), hour.alias("hour"), F.col("n").alias("n"))
    totals = figures.agg(
        F.coalesce(F.max(F.when(overall, F.col("n"))), F.lit(0)).alias("total_posts"),
        F.count_if(per_subreddit).alias("n_subreddits"),
        F.min("first").alias("start"),
        F.max("last").alias("end"),
        F.min(F.when(per_topic & F.col("mean").isNotNull(), by_mean)).alias("best"),
        F.min(F.when(per_hour, by_count)).alias("peak"),
        F.max(F.when(overall, F.col("exact"))).alias("overall"),
    )
    counted = cube.groupBy(topic.alias("topic")).agg(F.sum("n").alias("count"))
    ranked = F.struct((-F.col("count")).alias("rank"), "topic", "count")
    first = counted.orderBy(F.col("count").desc(), "topic").limit(k).agg(F.sort_array(F.collect_list(ranked)).alias("ranked"))
    row = totals.unionByName(first, allowMissingColumns=True)
    row = row.agg(*[F.max(name).alias(name) for name in totals.columns], F.flatten(F.collect_list("ranked")).alias("ranked"))
    listed = F.transform("ranked", lambda t: F.struct(t["topic"].alias("topic"), t["count"].alias("count")))
    above = (F.try_divide(F.col("best.mean"), F.col("overall")) - 1) * 100
    return row.select(
        "total_posts", "n_subreddits", "start", "end",
        listed.alias("top_topics"),
        F.col("best.topic").alias("best_topic"),
        F.col("best.mean").alias("best_avg"),
        F.bround(above, 0).alias("pct_above_mean"),
        F.col("peak.hour").alias("peak_hour"),
        F.col("peak.n").alias("peak_count"),
    )


def _findings() -> Column:
    """The two findings as a list of (type, title, description)."""
    engagement = F.struct(
        F.lit("engagement").alias("type"),
        F.concat(F.lit(fixed.BEST_TITLE), "best_topic").alias("title"),
        F.format_string(
            fixed.BEST_TEXT, "best_topic", F.col("best_avg").cast("string"), F.col("pct_above_mean").cast("long").cast("string")
        ).alias("description"),
    )
    timing = F.struct(
        F.lit("timing").alias("type"),
        F.format_string(fixed.PEAK_TITLE, "peak_hour").alias("title"),
        F.format_string(fixed.PEAK_TEXT, "peak_hour", "peak_count").alias("description"),
    )
    return F.array(engagement, timing)


def insight_texts(insight: DataFrame) -> DataFrame:
    """The two findings of ``insights`` as (type, title, description) rows."""
    return insight.select(F.explode(_findings()).alias("i")).select("i.*")


def insights_document(posts: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """The insights as they are stored: the figures, when and by which version they were made, and the findings."""
    at = F.current_timestamp() if generated_at is None else generated_at
    return insights(posts).select(
        at.alias("generated_at"), F.version().alias("spark_version"), "*", _findings().alias("key_insights")
    )


def gold_tables(posts: DataFrame) -> dict[str, DataFrame]:
    """The seven gold tables under their stored names."""
    return {
        "daily_subreddit_stats": gold.daily_stats(posts),
        "trending_topics": gold.trending_topics(posts),
        "user_engagement": gold.user_engagement(posts),
        "cross_subreddit_comparison": gold.cross_comparison(posts),
        "hourly_patterns": gold.hourly_patterns(posts),
        "entity_network": gold.entity_network(posts),
        "sentiment_timeseries": gold.sentiment_timeseries(posts),
    }

"""Gold layer: the seven analytics tables.

Every table is one grouping of silver rows with partial aggregation, so a key that holds a large share
of the rows is combined before the shuffle. Windows run over the grouped rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake import fixed
from postlake.functions import features

# Reading order of each table as (column, ascending).
READING_ORDER = {
    "daily_subreddit_stats": (("subreddit", True), ("date", True)),
    "trending_topics": (("date", False), ("mention_count", False), ("topic", True), ("subreddit", True)),
    "user_engagement": (("post_count", False), ("author", True), ("subreddit", True), ("date", True)),
    "cross_subreddit_comparison": (("date", True), ("topic", True), ("subreddit", True)),
    "hourly_patterns": (("subreddit", True), ("hour_of_day", True)),
    "entity_network": (("co_occurrence_count", False), ("entity_1", True), ("entity_2", True)),
    "sentiment_timeseries": (("subreddit", True), ("date", True), ("hour", True)),
}


def reading_order(name: str) -> list[Column]:
    return [F.col(c).asc() if up else F.col(c).desc() for c, up in READING_ORDER[name]]


def in_reading_order(table: DataFrame, name: str) -> DataFrame:
    """Rows sorted for a report. Stored tables are not sorted: the sort would only be shuffled away."""
    return table.orderBy(*reading_order(name))


def _rows():
    return F.count(F.lit(1))


def _mean(column: str, digits: int):
    """Mean of a whole-number column, the sum of which is exact."""
    return F.round(F.avg(column), digits)


def _mean_sentiment():
    return features.steady_round(F.avg("sentiment_polarity"), 3)


def daily_stats(
    posts: DataFrame,
    key: str = "subreddit",
    time: str = "created_datetime",
    score: str = "score",
    calendar: bool = False,
) -> DataFrame:
    """Statistics per key and day, with growth of the post count."""
    return with_growth(daily_base(posts, key, time, score), "total_posts", "posts_growth_rate", [key], calendar)


def with_growth(table: DataFrame, value: str, name: str, keys: Sequence[str], calendar: bool = False) -> DataFrame:
    """A table of days with the growth of ``value`` from day to day."""
    return table.withColumn(name, features.growth_rate(value, keys, calendar=calendar))


def daily_base(posts: DataFrame, key: str = "subreddit", time: str = "created_datetime", score: str = "score") -> DataFrame:
    """``daily_stats`` without the growth: what a day's own rows give."""
    return posts.groupBy(key, F.to_date(time).alias("date")).agg(
        _rows().alias("total_posts"),
        F.sum(score).alias("total_score"),
        _mean(score, 2).alias("avg_score"),
        F.percentile_approx(score, 0.5).alias("median_score"),
        F.max(score).alias("max_score"),
        features.steady_round(F.stddev(score), 2).alias("score_std"),
        _mean_sentiment().alias("avg_sentiment"),
        _mean("title_word_count", 1).alias("avg_title_length"),
        _mean("entity_count", 1).alias("avg_entity_count"),
        F.count_if("has_body").alias("posts_with_body"),
    )


def _without_empty(exploded: DataFrame, column: str) -> DataFrame:
    """Drop what ``explode_outer`` gives for an empty list.

    Plain ``explode`` makes Spark test the list for being empty further down, below the step that
    computes it, and so compute it twice where it is not a stored column.
    """
    return exploded.filter(F.col(column).isNotNull())


def exploded_topics(posts: DataFrame, time: str = "created_datetime") -> DataFrame:
    """One row per post and topic."""
    exploded = posts.select(
        "subreddit",
        F.to_date(time).alias("date"),
        F.explode_outer("topics").alias("topic"),
        "score",
        "sentiment_polarity",
        "entity_count",
    )
    return _without_empty(exploded, "topic")


def trending_topics(
    posts: DataFrame, growth: float = 50, volume: int = 5, calendar: bool = False
) -> DataFrame:
    """Topic mentions per day and subreddit. Trending: growth above ``growth`` percent and more than
    ``volume`` mentions; NULL on the first day of a topic that has the volume."""
    return with_trend(topic_base(posts), growth, volume, calendar)


def topic_base(posts: DataFrame) -> DataFrame:
    """``trending_topics`` without the growth: what a day's own rows give."""
    return exploded_topics(posts).groupBy("date", "topic", "subreddit").agg(
        _rows().alias("mention_count"),
        _mean("score", 2).alias("avg_score"),
        F.sum("score").alias("total_score"),
        _mean_sentiment().alias("avg_sentiment"),
        _mean("entity_count", 1).alias("avg_entities"),
    )


def with_trend(stats: DataFrame, growth: float = 50, volume: int = 5, calendar: bool = False) -> DataFrame:
    grown = with_growth(stats, "mention_count", "mention_growth_rate", ["topic", "subreddit"], calendar)
    hot = (F.col("mention_growth_rate") > growth) & (F.col("mention_count") > volume)
    return grown.withColumn("is_trending", hot)


def user_engagement(posts: DataFrame, power: int = 5) -> DataFrame:
    """Posting patterns per author, subreddit and day, the hours as 24 counts (see ``with_active_hours``)."""
    users = posts.groupBy("author", "subreddit", F.to_date("created_datetime").alias("date")).agg(
        _rows().alias("post_count"),
        F.sum("score").alias("total_score"),
        _mean("score", 2).alias("avg_score"),
        F.max("score").alias("max_score"),
        _mean_sentiment().alias("avg_sentiment"),
        features.dominant(F.col("primary_topic")).alias("most_common_topic"),
        features.hour_counts(F.col("hour_of_day")).alias("hour_counts"),
        features.distinct_hours(F.col("hour_of_day")).alias("unique_hours"),
    )
    return users.withColumn("is_power_user", F.col("post_count") > power)


def with_active_hours(users: DataFrame) -> DataFrame:
    """The list of posting hours, one entry per post, in place of the 24 counts."""
    return users.withColumn("hour_counts", features.hours_list(F.col("hour_counts"))).withColumnRenamed("hour_counts", "active_hours")


def pivot_values(df: DataFrame, column: str) -> list[str]:
    """The sorted values a pivot makes columns of. Too many of them, or NULL among them, is an error: none is left out."""
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = df.select(column).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} values (spark.sql.pivotMaxValues)")
    if any(row[0] is None for row in rows):
        raise ValueError(f"{column} has NULL, which is no column name: fill or filter it first")
    return sorted(row[0] for row in rows)


def pivoted(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    measures: dict[str, object],
    values: Sequence[str] | None = None,
    fill: float | None = 0,
) -> DataFrame:
    """Pivot with several measures; columns are ``{value}_{measure}``. ``fill=None`` keeps NULLs.

    A wide form for export: its columns grow with the values. Give ``values`` where they are known:
    looking them up is a job of its own. A row whose value is not among them, or NULL, stops the query.
    """
    values = pivot_values(df, column) if values is None else list(values)
    given = F.col(column).isin(values)
    message = F.concat(F.lit(f"{column} has a value that was not given: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))
    checked = df.withColumn(column, F.when(given, F.col(column)).otherwise(F.raise_error(message).cast(df.schema[column].dataType)))
    # With two aggregates or more, Spark itself names the columns {value}_{name}.
    aggregates = [measure.alias(name) for name, measure in measures.items()] + [_rows().alias("__rows")]
    wide = checked.groupBy(*keys).pivot(column, values).agg(*aggregates).drop(*[f"{value}___rows" for value in values])
    return wide if fill is None else wide.fillna(fill, [name for name in wide.columns if name not in keys])


def cross_comparison(posts: DataFrame) -> DataFrame:
    """Mentions, mean score and mean sentiment of each topic by day and subreddit."""
    return exploded_topics(posts).groupBy("date", "topic", "subreddit").agg(
        _rows().alias("mentions"), _mean("score", 2).alias("avg_score"), _mean_sentiment().alias("sentiment")
    )


def cross_comparison_wide(
    compared: DataFrame, values: Sequence[str] | None = None, fill: float | None = 0
) -> DataFrame:
    """``cross_comparison`` for export: the subreddits of a topic and day side by side."""
    measures = {name: F.first(name) for name in ("mentions", "avg_score", "sentiment")}
    return pivoted(compared, ["date", "topic"], "subreddit", measures, values, fill)


def hourly_patterns(posts: DataFrame, quantile: float = 0.75) -> DataFrame:
    """Posts per subreddit and hour of day; peak hours reach the subreddit's ``quantile``."""
    hourly = posts.groupBy("subreddit", "hour_of_day").agg(
        _rows().alias("post_count"),
        _mean("score", 2).alias("avg_score"),
        F.sum("score").alias("total_score"),
        _mean_sentiment().alias("avg_sentiment"),
        F.count_if(F.col("engagement_category") == fixed.TOP_ENGAGEMENT).alias("viral_posts"),
    )
    return with_peaks(hourly, quantile)


def with_peaks(hourly: DataFrame, quantile: float = 0.75) -> DataFrame:
    level = F.percentile_approx("post_count", quantile).over(Window.partitionBy("subreddit"))
    return hourly.withColumn("is_peak_hour", F.col("post_count") >= level)


def hourly_parts(posts: DataFrame, *by: str) -> DataFrame:
    """Sums, for each value of ``by``, from which ``hourly_from_parts`` makes ``hourly_patterns``."""
    return posts.groupBy(*by, "subreddit", "hour_of_day").agg(
        _rows().alias("post_count"),
        F.count("score").alias("scored"),
        F.sum("score").alias("total_score"),
        F.count("sentiment_polarity").alias("felt"),
        F.sum("sentiment_polarity").alias("sentiment_sum"),
        F.count_if(F.col("engagement_category") == fixed.TOP_ENGAGEMENT).alias("viral_posts"),
    )


def hourly_from_parts(parts: DataFrame, quantile: float = 0.75) -> DataFrame:
    sums = parts.groupBy("subreddit", "hour_of_day").agg(*[F.sum(c).alias(c) for c in ("post_count", "scored", "total_score", "felt", "sentiment_sum", "viral_posts")])
    hourly = sums.select(
        "subreddit", "hour_of_day", "post_count", F.round(F.try_divide("total_score", "scored"), 2).alias("avg_score"), "total_score",
        features.steady_round(F.try_divide("sentiment_sum", "felt"), 3).alias("avg_sentiment"), "viral_posts",
    )
    return with_peaks(hourly, quantile)


def peak_hours(hourly: DataFrame) -> DataFrame:
    """The peak hours of each subreddit as a list (24 at most)."""
    peaks = hourly.filter("is_peak_hour").groupBy("subreddit")
    return peaks.agg(F.sort_array(F.collect_list("hour_of_day")).alias("peak_hours"))


def entity_pairs(posts: DataFrame, *carried: str) -> DataFrame:
    """Each pair of entities named together in a post, smaller name first.

    Pairs are made inside the row, so no join on the post is needed. A row has n * (n - 1) / 2 of them, n being
    the lexicon names in it: 276 at most for the 24 default names. A lexicon of thousands wants the few
    that matter picked first.
    """
    ordered = posts.select(*carried, F.sort_array(F.array_distinct("entities")).alias("__names"))
    first = ordered.select(*carried, "__names", F.posexplode_outer("__names").alias("__at", "entity_1"))
    others = F.slice("__names", F.col("__at") + 2, F.size("__names"))
    pairs = first.select(*carried, "entity_1", F.explode_outer(others).alias("entity_2"))
    return _without_empty(pairs, "entity_2")


def entity_network(posts: DataFrame, min_count: int = 2) -> DataFrame:
    """How often two entities share a post, and how such posts fare."""
    pairs = entity_pairs(posts, "score", "sentiment").groupBy("entity_1", "entity_2").agg(
        _rows().alias("co_occurrence_count"),
        _mean("score", 2).alias("avg_score"),
        features.dominant(F.col("sentiment")).alias("dominant_sentiment"),
    )
    return with_strength(pairs, min_count)


def with_strength(pairs: DataFrame, min_count: int = 2) -> DataFrame:
    strength = F.round(F.col("co_occurrence_count") * F.col("avg_score"), 2)
    return pairs.filter(F.col("co_occurrence_count") >= min_count).withColumn("relationship_strength", strength)


def network_parts(posts: DataFrame, *by: str) -> DataFrame:
    """Sums, for each value of ``by``, from which ``network_from_parts`` makes ``entity_network``."""
    return entity_pairs(posts, *by, "score", "sentiment").groupBy(*by, "entity_1", "entity_2", "sentiment").agg(
        _rows().alias("posts"), F.count("score").alias("scored"), F.sum("score").alias("total_score")
    )


def network_from_parts(parts: DataFrame, min_count: int = 2) -> DataFrame:
    """The most frequent sentiment, of equal ones the first, is the largest count with the smallest name."""
    labels = parts.groupBy("entity_1", "entity_2", "sentiment").agg(*[F.sum(c).alias(c) for c in ("posts", "scored", "total_score")])
    rank = F.when(F.col("sentiment").isNotNull(), F.struct((-F.col("posts")).alias("n"), "sentiment"))
    pairs = labels.groupBy("entity_1", "entity_2").agg(
        F.sum("posts").alias("co_occurrence_count"),
        F.round(F.try_divide(F.sum("total_score"), F.sum("scored")), 2).alias("avg_score"),
        F.min(rank)["sentiment"].alias("dominant_sentiment"),
    )
    return with_strength(pairs, min_count)


def sentiment_timeseries(posts: DataFrame, volatile: float = 0.3) -> DataFrame:
    """Sentiment per subreddit, day and hour."""
    hourly = posts.groupBy(
        "subreddit", F.to_date("created_datetime").alias("date"), F.col("hour_of_day").alias("hour")
    ).agg(
        _mean_sentiment().alias("avg_polarity"),
        features.steady_round(F.stddev("sentiment_polarity"), 3).alias("polarity_std"),
        _rows().alias("post_count"),
        F.round(
            features.percent(F.count_if(F.col("sentiment") == "positive"), _rows()), 1
        ).alias("positive_percentage"),
    )
    return hourly.withColumn("is_volatile", F.col("polarity_std") > volatile)

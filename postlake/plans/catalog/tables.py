"""The gold tables, their reports, and insights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import fixed
from postlake.functions import text
from postlake.operators import gold, summaries
from postlake.plans.catalog import registry, sql
from postlake.plans.catalog.registry import query
from postlake.session import shared_folder
from postlake.sinks import files as sink
from postlake.sources import files

SUBREDDITS = ("click", "error", "purchase", "signup", "view")  # the event types of the test tables, for the checking SQL

SILVER = sql.silver()
R = sql.rounded
S = sql.steady

DAILY = f"""{SILVER}, daily AS (
  SELECT subreddit, date, count(*) AS total_posts, cast(sum(score) AS bigint) AS total_score,
    {R('avg(score)', 2)} AS avg_score, quantile_disc(score, 0.5) AS median_score, max(score) AS max_score,
    {S('stddev_samp(score)', 2)} AS score_std, {S('avg(sentiment_polarity)', 3)} AS avg_sentiment,
    {R('avg(title_word_count)', 1)} AS avg_title_length, {R('avg(entity_count)', 1)} AS avg_entity_count,
    count(*) FILTER (has_body) AS posts_with_body
  FROM silver GROUP BY subreddit, date
)"""

TRENDING = f"""{SILVER}, exploded AS (
  SELECT subreddit, date, unnest(topics) AS topic, score, sentiment_polarity, entity_count FROM silver
), mentioned AS (
  SELECT date, topic, subreddit, count(*) AS mention_count, {R('avg(score)', 2)} AS avg_score,
    cast(sum(score) AS bigint) AS total_score, {S('avg(sentiment_polarity)', 3)} AS avg_sentiment,
    {R('avg(entity_count)', 1)} AS avg_entities
  FROM exploded GROUP BY date, topic, subreddit
), grown AS (
  SELECT *, {sql.growth('mention_count', 'topic, subreddit')} AS mention_growth_rate FROM mentioned
), trending AS (
  SELECT *, mention_growth_rate > 50 AND mention_count > 5 AS is_trending FROM grown
)"""

USERS = f"""{SILVER}, named AS (
  SELECT author, subreddit, date, primary_topic, row_number() OVER (
    PARTITION BY author, subreddit, date ORDER BY count(*) DESC, primary_topic) AS place
  FROM silver GROUP BY author, subreddit, date, primary_topic
), grouped AS (
  SELECT author, subreddit, date, count(*) AS post_count, cast(sum(score) AS bigint) AS total_score,
    {R('avg(score)', 2)} AS avg_score, max(score) AS max_score,
    {S('avg(sentiment_polarity)', 3)} AS avg_sentiment,
    {sql.listed('list_sort(list(hour_of_day))')} AS active_hours,
    cast(count(DISTINCT hour_of_day) AS int) AS unique_hours, count(*) > 2 AS is_power_user
  FROM silver GROUP BY author, subreddit, date
), users AS (
  SELECT g.*, n.primary_topic AS most_common_topic FROM grouped g
  JOIN named n USING (author, subreddit, date) WHERE n.place = 1
)"""

HOURLY = f"""{SILVER}, counted AS (
  SELECT subreddit, hour_of_day, count(*) AS post_count, {R('avg(score)', 2)} AS avg_score,
    cast(sum(score) AS bigint) AS total_score, {S('avg(sentiment_polarity)', 3)} AS avg_sentiment,
    count(*) FILTER (engagement_category = 'viral') AS viral_posts
  FROM silver GROUP BY subreddit, hour_of_day
), hourly AS (
  SELECT *, post_count >= quantile_disc(post_count, 0.75) OVER (PARTITION BY subreddit) AS is_peak_hour
  FROM counted
)"""

PAIRS = f"""{SILVER}, named AS (
  SELECT post_id, score, sentiment, unnest(entities) AS entity FROM silver
), pairs AS (
  SELECT a.post_id, a.score, a.sentiment, a.entity AS entity_1, b.entity AS entity_2
  FROM named a JOIN named b ON a.post_id = b.post_id AND a.entity < b.entity
)"""

NETWORK = f"""{PAIRS}, moods AS (
  SELECT entity_1, entity_2, sentiment, row_number() OVER (
    PARTITION BY entity_1, entity_2 ORDER BY count(*) DESC, sentiment) AS place
  FROM pairs GROUP BY entity_1, entity_2, sentiment
), linked AS (
  SELECT entity_1, entity_2, count(*) AS co_occurrence_count, {R('avg(score)', 2)} AS avg_score
  FROM pairs GROUP BY entity_1, entity_2 HAVING count(*) >= 2
), network AS (
  SELECT l.*, m.sentiment AS dominant_sentiment,
    {R('l.co_occurrence_count * l.avg_score', 2)} AS relationship_strength
  FROM linked l JOIN moods m USING (entity_1, entity_2) WHERE m.place = 1
)"""


@query(f"WITH {DAILY} SELECT *, {sql.growth('total_posts', 'subreddit')} AS posts_growth_rate FROM daily")
def daily_stats(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily_stats(registry.silver_posts(spark, folder))


@query(f"""
  WITH {DAILY} SELECT subreddit, date, total_posts,
    CASE WHEN lag(date) OVER (PARTITION BY subreddit ORDER BY date) + 1 = date
    THEN {sql.growth('total_posts', 'subreddit')} END AS posts_growth_rate FROM daily
""")
def daily_growth_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Growth only where the day before has posts."""
    stats = gold.daily_stats(registry.silver_posts(spark, folder), calendar=True)
    return stats.select("subreddit", "date", "total_posts", "posts_growth_rate")


@query(f"WITH {TRENDING} SELECT * FROM trending")
def trending_topics(spark: SparkSession, folder: str) -> DataFrame:
    return gold.trending_topics(registry.silver_posts(spark, folder))


@query(f"""
  WITH {TRENDING} SELECT date, topic, subreddit, mention_count, mention_growth_rate FROM trending
  WHERE is_trending ORDER BY mention_growth_rate DESC, topic, subreddit, date LIMIT 5
""")
def top_trending(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.top_trending(gold.trending_topics(registry.silver_posts(spark, folder)))


def _users(spark, folder):
    return gold.user_engagement(registry.silver_posts(spark, folder), power=2)


@query(f"WITH {USERS} SELECT * FROM users")
def user_engagement(spark: SparkSession, folder: str) -> DataFrame:
    """Power users post more than twice a day here: the test authors post little."""
    hours = text.array_text(F.col("active_hours").cast("array<string>"))
    return gold.with_active_hours(_users(spark, folder)).withColumn("active_hours", hours)


@query(f"""
  WITH {SILVER} SELECT author, subreddit, date, {sql.listed("[" + ", ".join(
    f"count(*) FILTER (hour_of_day = {h})" for h in range(24)) + "]")} AS hour_counts
  FROM silver GROUP BY author, subreddit, date
""")
def hour_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The posts of each author, subreddit and day in each hour, as stored."""
    counts = text.array_text(F.col("hour_counts").cast("array<string>"))
    return _users(spark, folder).select("author", "subreddit", "date", counts.alias("hour_counts"))


@query(f"""
  WITH {USERS} SELECT author, subreddit, date, post_count, avg_score FROM users
  ORDER BY post_count DESC, author, subreddit, date LIMIT 5
""")
def top_contributors(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.top_contributors(_users(spark, folder))


@query(f"""
  WITH {SILVER}, exploded AS (
    SELECT subreddit, date, unnest(topics) AS topic, score, sentiment_polarity FROM silver
  )
  SELECT date, topic, {", ".join(
    f"count(*) FILTER (subreddit = '{s}') AS {s}_mentions, "
    f"coalesce({R(f"avg(score) FILTER (subreddit = '{s}')", 2)}, 0) AS {s}_avg_score, "
    f"coalesce({S(f"avg(sentiment_polarity) FILTER (subreddit = '{s}')", 3)}, 0) AS {s}_sentiment"
    for s in SUBREDDITS)}
  FROM exploded GROUP BY date, topic
""")
def cross_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """The wide form, its columns looked up."""
    return gold.cross_comparison_wide(gold.cross_comparison(registry.silver_posts(spark, folder)))


@query(f"""
  WITH {SILVER}, exploded AS (
    SELECT subreddit, date, unnest(topics) AS topic, score, sentiment_polarity FROM silver
  )
  SELECT date, topic, subreddit, count(*) AS mentions, {R('avg(score)', 2)} AS avg_score,
    {S('avg(sentiment_polarity)', 3)} AS sentiment FROM exploded GROUP BY ALL
""")
def cross_comparison_long(spark: SparkSession, folder: str) -> DataFrame:
    """The stored form: a row for each day, topic and subreddit, whatever the subreddits are."""
    return gold.cross_comparison(registry.silver_posts(spark, folder))


@query(f"""
  WITH {SILVER}, exploded AS (SELECT subreddit, unnest(topics) AS topic, score FROM silver)
  SELECT topic, {", ".join(
    f"{R(f"avg(score) FILTER (subreddit = '{s}')", 2)} AS {s}_avg_score" for s in SUBREDDITS)}
  FROM exploded GROUP BY topic
""")
def score_pivot(spark: SparkSession, folder: str) -> DataFrame:
    """A pivot of one measure, with its values looked up and missing cells left NULL."""
    exploded = gold.exploded_topics(registry.silver_posts(spark, folder))
    measures = {"avg_score": F.round(F.avg("score"), 2)}
    return gold.pivoted(exploded, ["topic"], "subreddit", measures, fill=None)


@query(f"WITH {HOURLY} SELECT * FROM hourly")
def hourly_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return gold.hourly_patterns(registry.silver_posts(spark, folder))


@query(f"""
  WITH {HOURLY} SELECT subreddit, {sql.listed('list_sort(list(hour_of_day))')} AS peak_hours
  FROM hourly WHERE is_peak_hour GROUP BY subreddit
""")
def peak_hours(spark: SparkSession, folder: str) -> DataFrame:
    peaks = gold.peak_hours(gold.hourly_patterns(registry.silver_posts(spark, folder)))
    return peaks.withColumn("peak_hours", text.array_text(F.col("peak_hours").cast("array<string>")))


@query(f"WITH {PAIRS} SELECT post_id, entity_1, entity_2 FROM pairs")
def entity_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs made inside each row, checked against the self-join on the post."""
    return gold.entity_pairs(registry.silver_posts(spark, folder), "post_id")


@query(f"WITH {NETWORK} SELECT * FROM network")
def entity_network(spark: SparkSession, folder: str) -> DataFrame:
    return gold.entity_network(registry.silver_posts(spark, folder))


@query(f"""
  WITH {NETWORK} SELECT * FROM network ORDER BY co_occurrence_count DESC, entity_1, entity_2 LIMIT 5
""")
def top_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.top_pairs(gold.entity_network(registry.silver_posts(spark, folder)))


@query(f"""
  WITH {SILVER}, series AS (
    SELECT subreddit, date, hour_of_day AS hour, {S('avg(sentiment_polarity)', 3)} AS avg_polarity,
      {S('stddev_samp(sentiment_polarity)', 3)} AS polarity_std, count(*) AS post_count,
      {R("count(*) FILTER (sentiment = 'positive') * 100.0::double / count(*)", 1)} AS positive_percentage
    FROM silver GROUP BY subreddit, date, hour_of_day
  ) SELECT *, polarity_std > 0.3 AS is_volatile FROM series
""")
def sentiment_timeseries(spark: SparkSession, folder: str) -> DataFrame:
    return gold.sentiment_timeseries(registry.silver_posts(spark, folder))


FEATURES = ("sentiment", "primary_topic", "time_period", "engagement_category")


@query(f"WITH {SILVER} " + " UNION ALL ".join(
    f"SELECT '{name}' AS feature, {name} AS value, count(*) AS count FROM silver GROUP BY {name}"
    for name in FEATURES
))
def distributions(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.distributions(registry.silver_posts(spark, folder), FEATURES)


@query(f"""
  WITH {SILVER} SELECT entity, count(*) AS count FROM (SELECT unnest(entities) AS entity FROM silver)
  GROUP BY entity ORDER BY count(*) DESC, entity LIMIT 10
""")
def top_entities(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.top_entities(registry.silver_posts(spark, folder))


@query(f"WITH {SILVER} SELECT DISTINCT subreddit FROM silver")
def distinct_subreddits(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.distinct_values(registry.silver_posts(spark, folder), "subreddit")


@query(f"""
  WITH {SILVER} SELECT count(*) AS total_posts, min(created_datetime) AS first_post,
    max(created_datetime) AS last_post, min(score) AS min_score, max(score) AS max_score,
    {R('avg(title_word_count)', 1)} AS avg_title_words, count(*) FILTER (has_body) AS posts_with_body,
    {R('count(*) FILTER (has_body) * 100.0::double / count(*)', 1)} AS body_percentage FROM silver
""")
def global_stats(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.global_stats(registry.silver_posts(spark, folder))


INSIGHTS = f"""{SILVER}, by_topic AS (
  SELECT primary_topic AS topic, count(*) AS n, {R('avg(score)', 2)} AS mean FROM silver GROUP BY primary_topic
), best AS (
  SELECT topic, mean FROM by_topic ORDER BY mean DESC, topic LIMIT 1
), peak AS (
  SELECT hour_of_day AS hour, count(*) AS n FROM silver GROUP BY hour_of_day ORDER BY n DESC, hour LIMIT 1
), listed AS (
  SELECT topic, n FROM by_topic ORDER BY n DESC, topic LIMIT 5
), insights AS (
  SELECT count(*) AS total_posts, count(DISTINCT subreddit) AS n_subreddits,
    min(created_datetime) AS start, max(created_datetime) AS end,
    (SELECT string_agg(topic || '=' || n, ',' ORDER BY n DESC, topic) FROM listed) AS top_topics,
    (SELECT topic FROM best) AS best_topic, (SELECT mean FROM best) AS best_avg,
    round_even(((SELECT mean FROM best) / avg(score) - 1) * 100, 0) AS pct_above_mean,
    (SELECT hour FROM peak) AS peak_hour, (SELECT n FROM peak) AS peak_count
  FROM silver
)"""


@query(f"WITH {INSIGHTS} SELECT * FROM insights")
def insights(spark: SparkSession, folder: str) -> DataFrame:
    row = summaries.insights(registry.silver_posts(spark, folder))
    pairs = F.transform("top_topics", lambda t: F.concat(t["topic"], F.lit("="), t["count"].cast("string")))
    return row.withColumn("top_topics", F.concat_ws(",", pairs))


FINDINGS = f"""
  WITH {INSIGHTS}
  SELECT 'engagement' AS type, 'Highest Engagement: ' || best_topic AS title,
    'Posts about ' || best_topic || ' receive avg score of ' || best_avg || ', '
    || cast(pct_above_mean AS bigint) || '% above average' AS description FROM insights
  UNION ALL
  SELECT 'timing', 'Peak Activity at ' || peak_hour || ':00',
    'Most posts created around ' || peak_hour || ':00 UTC (' || peak_count || ' posts)' FROM insights
"""


@query(FINDINGS)
def insights_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The findings out of the written insights document."""
    path = shared_folder(spark, "insights")
    sink.write_document(summaries.insights_document(registry.silver_posts(spark, folder)), path)
    document = files.read_document(spark, path, "key_insights array<struct<type:string,title:string,description:string>>")
    return document.select(F.explode("key_insights").alias("i")).select("i.*")


def _report(table: DataFrame, name: str) -> DataFrame:
    path = shared_folder(table.sparkSession, f"report-{name}")
    return sink.write_report(table, path, gold.reading_order(name))


@query(f"""
  WITH {NETWORK} SELECT entity_1, entity_2, co_occurrence_count,
    row_number() OVER (ORDER BY co_occurrence_count DESC, entity_1, entity_2) AS position FROM network
""")
def report_order_network(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each row of a table in its reading order."""
    report = _report(gold.entity_network(registry.silver_posts(spark, folder)), "entity_network")
    return report.select("entity_1", "entity_2", "co_occurrence_count", "position")


@query(f"""
  WITH {TRENDING} SELECT date, topic, subreddit, mention_count,
    row_number() OVER (ORDER BY date DESC, mention_count DESC, topic, subreddit) AS position FROM trending
""")
def report_order_trending(spark: SparkSession, folder: str) -> DataFrame:
    report = _report(gold.trending_topics(registry.silver_posts(spark, folder)), "trending_topics")
    return report.select("date", "topic", "subreddit", "mention_count", "position")


@query(FINDINGS)
def insight_texts(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.insight_texts(summaries.insights(registry.silver_posts(spark, folder)))


@query(f"""
  WITH {sql.silver(fixed.BATCH)}, exploded AS (SELECT unnest(topics) AS topic, score FROM silver)
  SELECT topic, count(*) AS mentions, cast(sum(score) AS bigint) AS total_score FROM exploded GROUP BY topic
""")
def topic_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Mentions by the default word lists, text features computed on the way."""
    from postlake.operators import silver

    exploded = gold.exploded_topics(silver.enrich(registry.bronze_posts(spark, folder)))
    return exploded.groupBy("topic").agg(F.count(F.lit(1)).alias("mentions"), F.sum("score").alias("total_score"))

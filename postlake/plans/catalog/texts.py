"""Text, time and score functions on whole posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import fixed
from postlake.functions import features, text
from postlake.operators import lexicons, search, silver, warehouse
from postlake.plans.catalog import registry, sql
from postlake.plans.catalog.registry import query
from postlake.sources import testtables
from postlake.sources.testtables import FRAGMENTS


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Posts with their cleaned texts; a document is cleaned once, however many posts have it."""
    return testtables.posts(spark, folder, silver.add_clean_text)


CLEANED = f"""{sql.POSTS}, cleaned AS (
  SELECT *, {sql.clean('title')} AS title_cleaned, {sql.clean('body')} AS body_cleaned FROM posts
)"""


@query(f"WITH {CLEANED} SELECT post_id, title_cleaned, body_cleaned FROM cleaned")
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder).select("post_id", "title_cleaned", "body_cleaned")


@query(f"""
  SELECT doc_id, {sql.clean('text')} AS cleaned, {sql.words(sql.clean('text'))} AS words FROM documents
""")
def clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents cleaned and counted."""
    cleaned = testtables.documents(spark, folder).select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))
    return cleaned.withColumn("words", text.word_count(F.col("cleaned")))


def _sentiment_sql(lexicon):
    return f"""
      WITH {CLEANED}, scored AS (
        SELECT post_id, {sql.polarity('title_cleaned', lexicon)} AS p FROM cleaned
      )
      SELECT post_id, {sql.rounded('p', 6)} AS sentiment_polarity, {sql.label('p')} AS sentiment,
             0.5::double AS sentiment_subjectivity FROM scored
    """


def _sentiment(spark, folder, lexicon):
    scored = silver.add_sentiment(_cleaned(spark, folder), lexicon)
    return scored.select(
        "post_id", F.round("sentiment_polarity", 6).alias("sentiment_polarity"), "sentiment",
        "sentiment_subjectivity",
    )


@query(_sentiment_sql(fixed.BATCH))
def sentiment(spark: SparkSession, folder: str) -> DataFrame:
    return _sentiment(spark, folder, fixed.BATCH)


@query(_sentiment_sql(FRAGMENTS))
def sentiment_fragments(spark: SparkSession, folder: str) -> DataFrame:
    return _sentiment(spark, folder, FRAGMENTS)


def _topics_sql(lexicon, cleaned="title_cleaned", pad=""):
    found = sql.topics(cleaned, lexicon, pad)
    return f"""
      WITH {CLEANED}, found AS (SELECT post_id, {found} AS topics FROM cleaned)
      SELECT post_id, {sql.listed('topics')} AS topics, topics[1] AS primary_topic FROM found
    """


def _topics(spark, folder, lexicon, match="substring"):
    found = silver.add_topics(_cleaned(spark, folder), lexicon, match)
    return found.select("post_id", text.array_text(F.col("topics")).alias("topics"), "primary_topic")


@query(_topics_sql(fixed.BATCH))
def topics(spark: SparkSession, folder: str) -> DataFrame:
    return _topics(spark, folder, fixed.BATCH)


@query(_topics_sql(FRAGMENTS))
def topics_fragments(spark: SparkSession, folder: str) -> DataFrame:
    return _topics(spark, folder, FRAGMENTS)


@query(_topics_sql(fixed.BATCH, sql.padded("title_cleaned"), " "))
def topics_whole_words(spark: SparkSession, folder: str) -> DataFrame:
    return _topics(spark, folder, fixed.BATCH, "word")


def _entities_sql(lexicon, raw="lower(title)", pad=""):
    return f"""
      WITH {sql.POSTS}, found AS (SELECT post_id, {sql.entities(raw, lexicon, pad)} AS entities FROM posts)
      SELECT post_id, {sql.listed('entities')} AS entities, cast(len(entities) AS int) AS entity_count FROM found
    """


def _entities(spark, folder, lexicon, match="substring"):
    found = silver.add_entities(registry.raw_posts(spark, folder), lexicon, match)
    return found.select("post_id", text.array_text(F.col("entities")).alias("entities"), "entity_count")


@query(_entities_sql(fixed.BATCH))
def entities(spark: SparkSession, folder: str) -> DataFrame:
    return _entities(spark, folder, fixed.BATCH)


@query(_entities_sql(FRAGMENTS))
def entities_fragments(spark: SparkSession, folder: str) -> DataFrame:
    return _entities(spark, folder, FRAGMENTS)


@query(_entities_sql(fixed.BATCH, sql.padded("lower(title)"), " "))
def entities_whole_words(spark: SparkSession, folder: str) -> DataFrame:
    return _entities(spark, folder, fixed.BATCH, "word")


@query(f"""
  WITH {CLEANED} SELECT post_id, {sql.words('title_cleaned')} AS title_word_count,
    {sql.words('body_cleaned')} AS body_word_count, body_cleaned <> '' AS has_body,
    cast(length(title_cleaned) AS int) AS title_char_count FROM cleaned
""")
def text_features(spark: SparkSession, folder: str) -> DataFrame:
    featured = testtables.posts(spark, folder, lambda texts: silver.add_text_features(silver.add_clean_text(texts)))
    return featured.select("post_id", "title_word_count", "body_word_count", "has_body", "title_char_count")


@query(f"""
  WITH {CLEANED} SELECT post_id, cast(len(string_split(title_cleaned, ' ')) AS int) AS title_word_count,
    cast(len(string_split(body_cleaned, ' ')) AS int) AS body_word_count, true AS has_body FROM cleaned
""")
def text_features_compat(spark: SparkSession, folder: str) -> DataFrame:
    """The counts in which an empty text has one word."""
    featured = testtables.posts(
        spark, folder, lambda texts: silver.add_text_features(silver.add_clean_text(texts), reference_compat=True)
    )
    return featured.select("post_id", "title_word_count", "body_word_count", "has_body")


@query(f"""
  WITH {sql.BRONZE} SELECT post_id, cast(hour(created_datetime) AS int) AS hour_of_day,
    cast(dayofweek(created_datetime) + 1 AS int) AS day_of_week, dayname(created_datetime) AS day_name,
    dayofweek(created_datetime) + 1 IN (1, 7) AS is_weekend,
    {sql.PERIOD.format('hour(created_datetime)')} AS time_period FROM bronze
""")
def time_features(spark: SparkSession, folder: str) -> DataFrame:
    featured = silver.add_time_features(registry.bronze_posts(spark, folder))
    return featured.select("post_id", "hour_of_day", "day_of_week", "day_name", "is_weekend", "time_period")


@query(f"WITH {sql.POSTS} SELECT post_id, score, {sql.BUCKET.format('score')} AS engagement_category FROM posts")
def engagement(spark: SparkSession, folder: str) -> DataFrame:
    return silver.add_engagement(registry.raw_posts(spark, folder)).select("post_id", "score", "engagement_category")


@query(f"""
  WITH {sql.POSTS}, ends AS (SELECT min(score) AS low, max(score) AS high FROM posts)
  SELECT post_id, {sql.rounded('(score - low)::double / (high - low) * 100', 6)} AS score_normalized
  FROM posts, ends
""")
def score_normalized(spark: SparkSession, folder: str) -> DataFrame:
    placed = silver.add_normalized_score(registry.raw_posts(spark, folder))
    return placed.select("post_id", F.round("score_normalized", 6).alias("score_normalized"))


WORDS = f"list_filter(string_split(regexp_replace(lower(title), '{fixed.NON_WORD}', ' ', 'g'), ' '), lambda x: x <> '')"


@query(f"""
  WITH {sql.POSTS}, tokens AS (SELECT post_id, title, {WORDS} AS words FROM posts)
  SELECT post_id, title FROM tokens WHERE list_contains(words, 'the') AND list_contains(words, 'of')
""")
def title_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(registry.raw_posts(spark, folder), ["the", "of"]).select("post_id", "title")


@query(f"""
  WITH {sql.POSTS}, tokens AS (SELECT post_id, title, {WORDS} AS words FROM posts)
  SELECT post_id, title FROM tokens WHERE list_contains(words, 'der') OR list_contains(words, 'que')
""")
def title_search_any(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(registry.raw_posts(spark, folder), ["der", "que"], every=False).select("post_id", "title")


ITEM_WORDS = f"""SELECT word, 'item' || min(item_id) AS label FROM (SELECT item_id, unnest(list_filter(string_split(
    regexp_replace(lower(text), '{fixed.NON_WORD}', ' ', 'g'), ' '), lambda x: x <> '')) AS word FROM benchmark) GROUP BY word"""


def _item_words(spark: SparkSession, folder: str) -> DataFrame:
    """A lexicon that is itself a table: the words of the benchmark items, each with the first item that has it."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    words = items.select(F.explode(text.tokens(F.col("text"))).alias("word"), "item_id")
    return words.groupBy("word").agg(F.concat(F.lit("item"), F.min("item_id")).alias("label"))


@query(f"""
  WITH {sql.POSTS}, tokens AS (SELECT post_id, unnest({WORDS}) AS word FROM posts),
  lexicon AS (SELECT DISTINCT unnest(list_filter(string_split(regexp_replace(lower(text), '{fixed.NON_WORD}',
    ' ', 'g'), ' '), lambda x: x <> '')) AS word, 'item' || item_id AS label FROM benchmark)
  SELECT DISTINCT post_id, label FROM tokens JOIN lexicon USING (word)
""")
def lexicon_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Posts against a lexicon that is itself a table: the words of the benchmark items, each with every item that has it."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    words = items.select(F.explode(text.tokens(F.col("text"))).alias("word"), "item_id")
    lexicon = words.select("word", F.concat(F.lit("item"), "item_id").alias("label"))
    return search.lexicon_matches(registry.raw_posts(spark, folder), lexicon)


LONG_WORDS = f"""lexicon AS (SELECT * FROM ({ITEM_WORDS}) WHERE length(word) >= 6),
  hits AS (SELECT doc_id, word, label FROM documents JOIN lexicon ON contains(lower(text), word))"""


def _long_words(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The words of six letters and more, and where whole lower-case texts have them, inside of other words as well."""
    lexicon = _item_words(spark, folder).filter(F.length("word") >= 6)
    docs = testtables.documents(spark, folder).select("doc_id", F.lower("text").alias("text"))
    return lexicon, lexicons.substring_matches(docs, lexicon, "doc_id", "text")


@query(f"WITH {LONG_WORDS} SELECT doc_id, word FROM hits")
def lexicon_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return _long_words(spark, folder)[1].select("doc_id", "word")


@query(f"WITH {LONG_WORDS} SELECT doc_id, label, count(*) AS words FROM hits GROUP BY doc_id, label")
def lexicon_labels(spark: SparkSession, folder: str) -> DataFrame:
    lexicon, matches = _long_words(spark, folder)
    return lexicons.labels_found(matches, lexicon, "doc_id")


@query(f"""
  WITH split AS (
    SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
  ), kept AS (
    SELECT doc_id, len(parts) AS given, list_filter(list_transform(parts,
      lambda x: regexp_replace(x, '{fixed.EDGE_SPACE}', '', 'g')), lambda x: x <> '') AS comments FROM split
  )
  SELECT doc_id, cast(given AS int) AS given, cast(len(comments) AS int) AS kept, array_to_string(comments, '|') AS comments FROM kept
""")
def comment_items(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of a document as a list of comments, stripped and without blank ones."""
    lines = testtables.documents(spark, folder).select("doc_id", F.split("text", "\n").alias("parts"))
    kept = lines.withColumn("items", text.kept_items(F.col("parts")))
    return kept.select(
        "doc_id", F.size("parts").alias("given"), F.size("items").alias("kept"),
        F.concat_ws("|", "items").alias("comments"),
    )


@query(f"""
  WITH {sql.BRONZE} SELECT post_id, created_datetime FROM bronze
  WHERE created_datetime >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 48 HOUR
""")
def recent_posts(spark: SparkSession, folder: str) -> DataFrame:
    recent = warehouse.recent(
        registry.bronze_posts(spark, folder), "created_datetime", 48, F.lit("2024-01-30 00:00:00").cast("timestamp")
    )
    return recent.select("post_id", "created_datetime")


@query(f"""
  WITH {sql.BRONZE} SELECT post_id, row_hash, cast(hour(created_datetime) AS int) AS hour FROM bronze
""")
def row_hashes(spark: SparkSession, folder: str) -> DataFrame:
    posts = registry.raw_posts(spark, folder)
    time = features.event_time(F.col("created_utc"))
    hashed = features.row_hash(F.col("post_id"), F.col("created_utc"))
    return posts.select("post_id", hashed.alias("row_hash"), F.hour(time).alias("hour"))

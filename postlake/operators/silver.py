"""Silver layer: one enriched row per post."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake import fixed, schema
from postlake.fixed import Lexicon
from postlake.functions import features, text
from postlake.operators import dedup


def add_clean_text(posts: DataFrame) -> DataFrame:
    return posts.withColumns({
        "title_cleaned": text.clean_text(F.col("title")),
        "body_cleaned": text.clean_text(F.col("body")),
    })


def add_sentiment(posts: DataFrame, lexicon: Lexicon = fixed.BATCH, match: str = "substring") -> DataFrame:
    scored = posts.withColumn("sentiment_polarity", text.polarity(F.col("title_cleaned"), lexicon, match))
    return scored.withColumns({
        "sentiment": text.sentiment_label(F.col("sentiment_polarity")),
        "sentiment_subjectivity": F.lit(fixed.SUBJECTIVITY),
    })


def add_topics(posts: DataFrame, lexicon: Lexicon = fixed.BATCH, match: str = "substring") -> DataFrame:
    found = posts.withColumn("topics", text.topics(F.col("title_cleaned"), lexicon, match))
    return found.withColumn("primary_topic", F.get("topics", F.lit(0)))


def add_entities(posts: DataFrame, lexicon: Lexicon = fixed.BATCH, match: str = "substring") -> DataFrame:
    """Entities come from the raw title, not the cleaned one."""
    found = posts.withColumn("entities", text.entities(F.col("title"), lexicon, match))
    return found.withColumn("entity_count", F.size("entities"))


def add_text_features(posts: DataFrame, reference_compat: bool = False) -> DataFrame:
    """Word and character counts. With ``reference_compat`` the empty text counts one word, so that
    ``has_body`` is always true."""
    counted = posts.withColumns({
        "title_word_count": text.word_count(F.col("title_cleaned"), reference_compat),
        "body_word_count": text.word_count(F.col("body_cleaned"), reference_compat),
        "title_char_count": F.length("title_cleaned"),
    })
    body = F.lit(True) if reference_compat else text.has_text(F.col("body_cleaned"))
    return counted.withColumn("has_body", body)


def add_time_features(posts: DataFrame, reference_compat: bool = False) -> DataFrame:
    null_bucket = fixed.LAST_PERIOD if reference_compat else None
    return posts.withColumns(features.time_features(F.col("created_datetime"), null_bucket))


def add_engagement(posts: DataFrame, reference_compat: bool = False) -> DataFrame:
    null_bucket = fixed.TOP_ENGAGEMENT if reference_compat else None
    return posts.withColumn("engagement_category", features.engagement(F.col("score"), null_bucket))


def enrich_texts(
    texts: DataFrame,
    lexicon: Lexicon = fixed.BATCH,
    match: str = "substring",
    reference_compat: bool = False,
) -> DataFrame:
    """All features that need nothing but title and body."""
    texts = add_clean_text(texts)
    texts = add_sentiment(texts, lexicon, match)
    texts = add_topics(texts, lexicon, match)
    texts = add_entities(texts, lexicon, match)
    return add_text_features(texts, reference_compat)


def enrich(
    posts: DataFrame,
    lexicon: Lexicon = fixed.BATCH,
    match: str = "substring",
    reference_compat: bool = False,
) -> DataFrame:
    """All features that need nothing but the row itself."""
    posts = enrich_texts(posts, lexicon, match, reference_compat)
    posts = add_time_features(posts, reference_compat)
    return add_engagement(posts, reference_compat)


def add_normalized_score(
    posts: DataFrame,
    column: str = "score",
    name: str = "score_normalized",
    over: DataFrame | None = None,
) -> DataFrame:
    """Score on 0..100 between the smallest and largest one of ``over`` (default: the same rows).

    The range is a one-row scalar subquery: no join, and nothing but two numbers leaves the executors.
    """
    ends = F.struct(F.min(column).alias("low"), F.max(column).alias("high"))
    ranged = posts.withColumn("__range", (posts if over is None else over).agg(ends).scalar())
    place = features.min_max(F.col(column), F.col("__range.low"), F.col("__range.high"))
    return ranged.withColumn(name, place).drop("__range")


def build(
    bronze: DataFrame,
    lexicon: Lexicon = fixed.BATCH,
    match: str = "substring",
    reference_compat: bool = False,
    spread_by: Sequence[str] = (),
    stored: bool = False,
) -> DataFrame:
    """Deduplicated, enriched and normalised posts. Say ``stored`` if ``bronze`` is just read from Parquet files: texts are not
    moved for the deduplication then.

    The range is taken over the kept rows. Finding it needs only the columns that lead the dedup order,
    so the second pass reads four narrow columns and never the texts.

    For a table in folders, ``spread_by`` names the folder columns: rows are gathered by them before the
    features are added, which moves half the bytes that doing so at the write would.
    """
    kept = dedup.latest_stored(bronze) if stored else dedup.drop_duplicates(bronze)
    narrow = bronze.select("post_id", "ingestion_timestamp", "row_hash", "score")
    scored = add_normalized_score(kept, over=dedup.drop_duplicates(narrow))
    if spread_by:
        scored = scored.hint("rebalance", *spread_by)
    return enrich(scored, lexicon, match, reference_compat).select(*schema.SILVER.names)


def build_apart(
    bronze: DataFrame,
    texts: DataFrame,
    key: str,
    lexicon: Lexicon = fixed.BATCH,
    match: str = "substring",
    reference_compat: bool = False,
) -> DataFrame:
    """``build`` for posts whose title and body stand in ``texts``, where ``key`` names them: the same rows as from both joined.

    Deduplication and the score range move posts without texts, and a text is cleaned once, however many posts have
    it. All versions of a post have the same key. Of several texts of a key that one counts which ``build`` would keep
    on, and posts whose key is in no text are left out, as an inner join does.
    """
    order = [F.col("body").desc_nulls_last(), F.col("title").desc_nulls_last()]
    once = dedup.drop_duplicates(texts, key, order, early_cut=False)
    kept = dedup.drop_duplicates(bronze.join(texts.select(key).hint("merge"), key, "left_semi"))
    posts = add_engagement(add_time_features(add_normalized_score(kept), reference_compat), reference_compat)
    read = enrich_texts(once, lexicon, match, reference_compat).hint("merge")
    return posts.join(read, key).select(*schema.SILVER.names)

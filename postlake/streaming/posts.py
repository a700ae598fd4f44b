"""The post stream: decode, enrich, drop repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake import fixed, schema
from postlake.fixed import Lexicon
from postlake.functions import features, text
from postlake.sources import messages


def decode(stream: DataFrame) -> DataFrame:
    """Messages as post columns plus the time the topic took them in."""
    timed = stream.withColumn("kafka_ingestion_time", F.col("timestamp"))
    return messages.decode(timed, schema.STREAM_POST, keep=["kafka_ingestion_time"])


def enrich_texts(texts: DataFrame, lexicon: Lexicon = fixed.STREAM, match: str = "substring") -> DataFrame:
    """What title and body give of the stored row."""
    cleaned = texts.withColumns({
        "title_cleaned": text.clean_text(F.col("title")),
        "body_cleaned": text.clean_text(F.col("body")),
        "entities": text.entities(F.col("title"), lexicon, match),
    })
    scored = cleaned.withColumn("sentiment_score", text.polarity(F.col("title_cleaned"), lexicon, match))
    return scored.withColumns({
        "sentiment": text.sentiment_label(F.col("sentiment_score")),
        "topic": text.first_topic(F.col("title_cleaned"), lexicon, match),
        "entities_str": text.array_text(F.col("entities")),
        "entity_count": F.size("entities"),
        "title_word_count": text.word_count(F.col("title_cleaned")),
        "has_body": text.has_text(F.col("body_cleaned")),
    })


def stored(read: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """The stored row of posts whose texts have been read (``enrich_texts``)."""
    return read.withColumns({
        "processing_timestamp": F.current_timestamp() if processed_at is None else processed_at,
        "created_datetime": features.event_time(F.col("created_utc")),
        "engagement_category": features.engagement(F.col("score")),
    }).select(*schema.STREAM_ROW.names)


def enrich(
    posts: DataFrame,
    lexicon: Lexicon = fixed.STREAM,
    match: str = "substring",
    processed_at: Column | None = None,
) -> DataFrame:
    """The stored row of a streamed post. Stateless, and the same in batch and in a stream."""
    return stored(enrich_texts(posts, lexicon, match), processed_at)


def drop_repeats(
    stream: DataFrame, time: str, delay: str, key: str = "post_id", salt: Column | None = None
) -> DataFrame:
    """Each post once, however often it is polled again within ``delay``.

    State is bounded by the watermark, not by a number of ids. The first arrival wins, whereas a batch
    keeps the latest load. For a post that makes up much of the stream, ``salt`` (say a few values taken
    from the message offset) spreads its copies over tasks before the final step.
    """
    marked = stream.withWatermark(time, delay)
    if salt is not None:
        marked = marked.withColumn("__salt", salt).dropDuplicatesWithinWatermark([key, "__salt"]).drop("__salt")
    return marked.dropDuplicatesWithinWatermark([key])

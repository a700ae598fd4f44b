"""Row types of posts, of the messages that carry them, and of the layer tables."""

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())


def _row(*start: T.StructField, **columns) -> T.StructType:
    """Fields from name=type, after those in ``start``. All may be NULL."""
    row = T.StructType(list(start))
    for name, kind in columns.items():
        row = row.add(name, kind)
    return row


POST = _row(
    post_id="string", subreddit="string", title="string", body="string", author="string",
    created_utc="long", score="integer",
)

POST_WITH_COMMENTS = _row(*POST.fields, comments=STRINGS)

STREAM_POST = _row(*POST.fields, kafka_timestamp="string", producer_id="string")

# What a topic read gives, cut down to the columns used here.
MESSAGE = _row(key="binary", value="binary", timestamp="timestamp")

BRONZE = _row(
    *POST.fields,
    ingestion_timestamp="timestamp", batch_id="string", source_api="string", data_quality_flag="string",
    row_hash="string", created_datetime="timestamp", partition_date="date", partition_year="integer",
    partition_month="integer", partition_day="integer",
)

QUARANTINE = _row(raw_value="string", reason="string")

SILVER = _row(
    *BRONZE.fields,
    title_cleaned="string", body_cleaned="string", sentiment_polarity="double", sentiment="string",
    sentiment_subjectivity="double", topics=STRINGS, primary_topic="string", entities=STRINGS,
    entity_count="integer", title_word_count="integer", body_word_count="integer", has_body="boolean",
    title_char_count="integer", hour_of_day="integer", day_of_week="integer", day_name="string",
    is_weekend="boolean", time_period="string", score_normalized="double", engagement_category="string",
)

#: Silver without the texts: what the gold tables are made from.
SILVER_FACTS = T.StructType([f for f in SILVER.fields if f.name not in ("title", "body", "title_cleaned", "body_cleaned")])

STREAM_ROW = _row(
    post_id="string", subreddit="string", title="string", title_cleaned="string", body="string",
    body_cleaned="string", author="string", created_utc="long", created_datetime="timestamp",
    score="integer", sentiment_score="double", sentiment="string", topic="string",
    entities_str="string", entity_count="integer", title_word_count="integer", has_body="boolean",
    engagement_category="string", kafka_ingestion_time="timestamp", processing_timestamp="timestamp",
)

#: Stored rows of the stream as far as the views read them.
STREAM_FACTS = T.StructType([f for f in STREAM_ROW.fields if f.name not in ("title", "body", "body_cleaned")])

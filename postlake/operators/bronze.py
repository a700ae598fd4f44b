"""Bronze layer: posts with load stamps and partition columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake import fixed, schema
from postlake.functions import features


def stamp(
    posts: DataFrame,
    batch_id: str,
    source: str = fixed.SOURCE_API,
    flag: str = fixed.RAW_FLAG,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Load time, batch, source, quality flag and row hash."""
    return posts.withColumns({
        "ingestion_timestamp": F.current_timestamp() if ingested_at is None else ingested_at,
        "batch_id": F.lit(batch_id),
        "source_api": F.lit(source),
        "data_quality_flag": F.lit(flag),
        "row_hash": features.row_hash(F.col("post_id"), F.col("created_utc")),
    })


def add_partitions(posts: DataFrame) -> DataFrame:
    """Event time from epoch seconds, and the date parts that tables are laid out by."""
    time = features.event_time(F.col("created_utc"))
    return posts.withColumns({
        "created_datetime": time,
        "partition_date": F.to_date(time),
        "partition_year": F.year(time),
        "partition_month": F.month(time),
        "partition_day": F.dayofmonth(time),
    })


def build(posts: DataFrame, batch_id: str, **stamps) -> DataFrame:
    return add_partitions(stamp(posts, batch_id, **stamps)).select(*schema.BRONZE.names)

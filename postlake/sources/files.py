"""Posts and layer tables in files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from postlake import schema


def read_jsonl(spark: SparkSession, path: str, row_type: T.StructType = schema.POST) -> DataFrame:
    """JSON lines with a fixed row type; nothing is inferred."""
    return spark.read.schema(row_type).json(path)


def read_jsonl_messages(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as undecoded messages, for a load that keeps malformed lines apart."""
    return spark.read.text(path)


def read_document(spark: SparkSession, path: str, row_type: str | T.StructType) -> DataFrame:
    """A document that a load has written (manifest, insights), or the fields of it that are named."""
    return spark.read.schema(row_type).json(path)


def read_table(
    spark: SparkSession, path: str, view: str | None = None, row_type: T.StructType | None = None
) -> DataFrame:
    """A Parquet table, registered as a SQL view when ``view`` names one.

    Give ``row_type`` for a table in folders: without it Spark guesses the type of the folder columns,
    and a subreddit called 007 would come back as 7.
    """
    reader = spark.read if row_type is None else spark.read.schema(row_type)
    table = reader.parquet(path)
    if view:
        table.createOrReplaceTempView(view)
    return table

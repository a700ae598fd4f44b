"""Layer tables and exports in files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake import fixed


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    mode: str = "overwrite",
    dynamic: bool = False,
    spread: bool = True,
    codec: str = "snappy",
) -> None:
    """Parquet with one folder per key value.

    The rebalance hint gathers the rows of a folder into few files, and adaptive execution splits the
    folders that hold far more rows than others. Say ``spread=False`` for rows that already are gathered.
    With ``dynamic`` an overwrite replaces only the folders it has rows for.
    """
    gathered = df.hint("rebalance", *keys) if spread else df
    writer = gathered.write.mode(mode).partitionBy(*keys).option("compression", codec)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_bronze(bronze: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = False) -> None:
    """Bronze rows by subreddit and day. ``path`` is the table, or the folder of one load in it.

    Rows stay in the task that has them and are not shuffled, as they hold whole texts: a folder has a file for each
    task with rows of it. Silver gathers them.
    """
    write_partitioned(bronze, path, fixed.BRONZE_PARTITIONS, mode, dynamic, spread=False, codec="zstd")


def write_silver(silver: DataFrame, path: str, mode: str = "overwrite", spread: bool = True) -> None:
    write_partitioned(silver, path, fixed.SILVER_PARTITIONS, mode, spread=spread)


def write_tables(tables: dict[str, DataFrame], path: str) -> dict[str, str]:
    """One folder per table. Gives the folders."""
    folders = {name: f"{path}/{name}" for name in tables}
    for name, table in tables.items():
        table.write.mode("overwrite").option("compression", "snappy").parquet(folders[name])
    return folders


def write_report(table: DataFrame, path: str, order: Sequence[Column]) -> DataFrame:
    """Write a table in order, and give it back with the ``position`` of each row, from 1.

    Rows are placed within the sorted parts, and a part begins after those before it, so no task sees all rows.
    The parts are those of the written table and stay the same however often it is read.
    """
    table.orderBy(*order).withColumn("__part", F.spark_partition_id()).write.mode("overwrite").parquet(path)
    stored = table.sparkSession.read.schema(T.StructType([*table.schema.fields, T.StructField("__part", T.IntegerType())])).parquet(path)
    placed = stored.withColumn("__row", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    joined = placed.join(starts, "__part").withColumn("position", F.col("__start") + F.col("__row"))
    return joined.drop("__part", "__row", "__start")


def write_per_key(df: DataFrame, path: str, key: str = "subreddit") -> None:
    """One table per key value: a folder each, all written by a single job."""
    write_partitioned(df, path, [key])


#: Rows of a compressed text file at most. Such a file is read by one task.
TEXT_ROWS = 100_000


def _text_writer(df: DataFrame, mode: str, codec: str | None) -> DataFrameWriter:
    writer = df.write.mode(mode)
    return writer.option("compression", codec).option("maxRecordsPerFile", TEXT_ROWS) if codec else writer


def write_jsonl(df: DataFrame, path: str, mode: str = "append", codec: str | None = None) -> None:
    """JSON lines with NULL fields written out; with ``codec`` (say ``gzip``) in compressed files of bounded length."""
    _text_writer(df, mode, codec).option("ignoreNullFields", "false").json(path)


# Quotes doubled, blanks kept: what spreadsheet programs and Python's csv module read.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def flat_columns(df: DataFrame) -> DataFrame:
    """List, map and struct columns as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[
        F.to_json(field.name).alias(field.name) if isinstance(field.dataType, nested) else F.col(field.name)
        for field in df.schema.fields
    ])


def _on_one_line(text):
    """Line breaks as ``\\n`` and ``\\r``, the backslash doubled."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _on_many_lines(text):
    """Undoes ``_on_one_line``: doubled backslashes, where a text has any, are set aside first."""
    def broken(part):
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    apart = F.array_join(F.transform(F.split(text, r"\\\\", -1), broken), "\\")
    return F.when(F.contains(text, F.lit("\\\\")), apart).otherwise(broken(text))


def _each_text(df: DataFrame, change) -> DataFrame:
    return df.select(*[
        change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields
    ])


def write_csv(df: DataFrame, path: str, mode: str = "append", one_line: bool = True, codec: str | None = None) -> None:
    """CSV with a header. With ``one_line`` each row is a line of the file, line breaks in texts being
    escaped, so that large files are read in parts; without it they stand as they are, within quotes. ``codec`` as in
    ``write_jsonl``."""
    flat = flat_columns(df)
    _text_writer(_each_text(flat, _on_one_line) if one_line else flat, mode, codec).options(**CSV_OPTIONS).csv(path)


def read_csv(spark, path: str, row_type: T.StructType, one_line: bool = True) -> DataFrame:
    """Rows written by ``write_csv`` with the same ``one_line``."""
    reader = spark.read.schema(row_type).options(**CSV_OPTIONS)
    if one_line:
        return _each_text(reader.csv(path), _on_many_lines)
    return reader.option("multiLine", "true").csv(path)


def write_document(df: DataFrame, path: str) -> None:
    """A small result (manifest, insights) as JSON."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)

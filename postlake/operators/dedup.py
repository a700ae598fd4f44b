"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.session import shared_folder


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Row number within each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, early_cut: bool = True
) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark turns the rank filter into a group limit that runs before the shuffle as well, so a hot key
    sends at most ``n`` rows per map task. That sorts all rows once more; without ``early_cut`` it is left
    out, for tables in which hardly a key repeats.
    """
    rank = F.col("__rank") if early_cut else F.abs("__rank")  # Spark cuts early by a plain rank only
    return ranked(df, keys, order, "__rank").filter(rank <= n).drop("__rank")


# What makes a row the latest: its load, or in a stream its arrival, then what settles equal times.
LATEST = ("ingestion_timestamp", "kafka_ingestion_time", "row_hash", "score")


def latest_order(df: DataFrame, key: str = "post_id", lead: Sequence[str] = LATEST) -> list[Column]:
    """The columns of ``lead`` that there are, largest first; the other columns settle what is still equal.

    The order is total up to rows equal in every column, so reruns keep the same row.
    """
    lead = [name for name in lead if name in df.columns]
    rest = sorted(set(df.columns) - set(lead) - {key})
    return [F.col(name).desc_nulls_last() for name in lead + rest]


def drop_duplicates(
    df: DataFrame, key: str = "post_id", order: Sequence[Column] | None = None, early_cut: bool = True,
    stage: str | None = None,
) -> DataFrame:
    """The latest row of every key. Rows without a key belong in quarantine and are not kept.

    With ``stage``, a new folder, the rows are written there once as they are, and ``latest_stored`` takes the latest ones from
    there: the same rows, but texts are not shuffled and sorted.
    """
    if stage is not None:
        df.write.option("compression", "zstd").parquet(stage)
        return latest_stored(df.sparkSession.read.schema(df.schema).parquet(stage), key)
    keyed = df.filter(F.col(key).isNotNull())
    return top_per_key(keyed, [key], order or latest_order(keyed, key), early_cut=early_cut)


#: Columns that hold whole texts.
TEXTS = ("title", "body", "title_cleaned", "body_cleaned")
#: Entries of a table of kept places, each for 64 rows in a row of a file, that are broadcast at most (some 60 bytes each).
PLACES = 2_000_000


def at_places(stored: DataFrame, places: DataFrame, others: bool = False) -> DataFrame:
    """The rows of a table in Parquet files that stand at some ``places`` (``file``, ``at``), with these columns; with ``others``
    all but these.

    The places of 64 rows are one number. If they are few enough they go to the tasks that read the files, and no row is
    moved; else Spark joins them as it sees fit.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    word = F.floor(F.col("at") / 64).alias("__word")
    masks = places.groupBy(F.col("file").alias("__file"), word).agg(F.bit_or(bit).alias("__mask"))
    masks = F.broadcast(masks) if masks.count() <= PLACES else masks
    rows = with_places(stored)
    same = (F.col("file") == F.col("__file")) & (F.floor(F.col("at") / 64) == F.col("__word"))
    found = rows.join(masks, same, "left" if others else "inner")
    there = F.coalesce(F.col("__mask").bitwiseAND(bit) != 0, F.lit(False))
    return found.filter(~there if others else there).select(*rows.columns)


def with_places(stored: DataFrame) -> DataFrame:
    """Rows with a hash of their file's name and their number in it."""
    return stored.select(*stored.columns, F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))


def latest_stored(stored: DataFrame, key: str = "post_id") -> DataFrame:
    """``drop_duplicates`` of a table just read from Parquet files, which moves no texts."""
    return at_places(stored, latest_places(stored, key)).select(*stored.columns)


def latest_places(stored: DataFrame, key: str = "post_id") -> DataFrame:
    """``file`` and ``at`` of the rows that ``latest_stored`` gives.

    The order's columns before the first text are compared, in narrow rows with the place of each. What is equal in them, and
    then in a digest of all other columns, is the same row. Rows of a key that differ in the digest only (usually
    none) are taken from the files and compared as a whole.
    """
    spark, names = stored.sparkSession, stored.columns
    lead = [c for c in LATEST if c in names]
    order = lead + sorted(set(names) - set(lead) - {key})
    cut = next((i for i, c in enumerate(order) if c in TEXTS), len(order))
    heads, rest = order[:cut], order[cut:]
    parts = [F.sha2(c, 256) if c in TEXTS else F.col(c).cast("string") for c in rest]
    digest = F.sha2(F.to_json(F.array(*parts)), 256) if parts else F.lit("")
    narrow = with_places(stored).filter(F.col(key).isNotNull()).select(key, *heads, digest.alias("__digest"), "file", "at")
    window = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in heads] or [F.lit(1)])
    tops = narrow.withColumn("__rank", F.rank().over(window)).filter("__rank = 1")
    alike = tops.groupBy(key, "__digest").agg(F.min(F.struct("file", "at")).alias("m"))
    found = alike.groupBy(key).agg(F.collect_list("m").alias("m"))
    path = shared_folder(spark, "places")
    found.select("m").write.mode("overwrite").parquet(path)
    found = spark.read.schema("m array<struct<file: bigint, at: bigint>>").parquet(path)
    places = found.filter(F.size("m") == 1).select(F.explode("m").alias("m")).select("m.*")
    several = found.filter(F.size("m") > 1)
    if not several.isEmpty():
        rivals = at_places(stored, several.select(F.explode("m").alias("m")).select("m.*"))
        best = top_per_key(rivals, [key], [F.col(c).desc_nulls_last() for c in order])
        places = places.unionAll(best.select("file", "at"))
    return places


def duplicate_counts(df: DataFrame, key: str = "post_id") -> DataFrame:
    """One row: rows before, after and removed by ``drop_duplicates``."""
    before, after = F.count(key), F.count_distinct(key)
    return df.agg(before.alias("before"), after.alias("after"), (before - after).alias("removed"))

"""Posts made of the test tables ``events`` and ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import schema
from postlake.fixed import Lexicon

LINE_END = "\n"

# Word lists for the invented prose of the test tables, which hardly has a word of the
# real lists. They are common fragments of its four languages.
FRAGMENTS = Lexicon(
    positive=("tion", "ment", "ung", "ción", "hein", "elle"),
    negative=("ing", "sch", "aux", "dad", "thor", "ndst"),
    topics=(
        ("articles", ("das ", "les ", "los ", "with ")),
        ("places", ("dans", "sur ", "from ", "zu ")),
        ("actions", ("ating", "ieren", "aban", "ontion")),
        ("people", ("ihr", "elle", "hehe", "este")),
        ("things", ("ntthe", "keit", "eaux", "orre")),
    ),
    entities=("anea", "eren", "hand", "ione", "oure", "quele", "schen", "thes", "und", "vier"),
)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Title and body of each document: its first line, and all that follows."""
    cut = F.instr("text", LINE_END)
    return documents(spark, folder).select(
        "doc_id",
        F.substring_index("text", LINE_END, 1).alias("title"),
        F.when(cut > 0, F.substr("text", cut + 1)).alias("body"),
    )


def facts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event: a post with the id of the document that it takes its texts from.

    Document ids run from 0, so event n takes document n mod the number of documents.
    """
    how_many = documents(spark, folder).agg(F.count(F.lit(1))).scalar()
    return events(spark, folder).select(
        (F.col("event_id") % how_many).alias("doc_id"),
        F.col("event_id").cast("string").alias("post_id"),
        F.col("event_type").alias("subreddit"),
        F.concat(F.lit("u"), "user_id").alias("author"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("created_utc"),
        F.floor("value").cast("int").alias("score"),
    )


def posts(spark: SparkSession, folder: str, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One post per event, with the title and body of its document.

    Titles and bodies are cut before the join, and a query that needs no body does not carry it along. ``prepare`` adds
    columns to the texts, also before the join: work on a text that several posts have is done once. Both tables grow, so
    neither is broadcast; the merge join also spreads the posts over tasks where a table is a single file.
    """
    lines = texts(spark, folder)
    added = prepare(lines) if prepare else lines
    more = [name for name in added.columns if name not in lines.columns]
    return facts(spark, folder).join(added.hint("merge"), "doc_id").select(*schema.POST.names, *more)

"""Keyword search and lexicon lookup on words."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions import text


def search(
    posts: DataFrame, terms: Sequence[str], column: str = "title", every: bool = True
) -> DataFrame:
    """Rows whose text has all the terms as words (any of them with ``every=False``). No stemming."""
    if not terms:
        raise ValueError("give at least one term")
    tested = posts.withColumn("__words", text.tokens(F.col(column)))
    hits = [F.array_contains("__words", term.lower()) for term in terms]
    return tested.filter(reduce(and_ if every else or_, hits)).drop("__words")


def lexicon_matches(
    posts: DataFrame, lexicon: DataFrame, key: str = "post_id", column: str = "title"
) -> DataFrame:
    """(key, label) for every lexicon word found in the text, for lexicons too long for literals.

    ``lexicon`` has columns word and label. The join carries no broadcast hint: Spark broadcasts the
    lexicon while it is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it beyond that, with
    words that are hot split by the adaptive skew join. Rows are dealt out by key before their words are looked
    up: with a broadcast lexicon the many labels of a key then meet in one task, and none are shuffled.
    """
    found = posts.select(key, text.tokens(F.col(column)).alias("__words")).repartition(key)
    words = found.select(key, F.explode("__words").alias("word"))
    return words.join(lexicon.select("word", "label"), "word").select(key, "label").distinct()

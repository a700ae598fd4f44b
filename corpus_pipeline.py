"""A corpus made ready for training: five stages over ``documents``, each a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import bpe, common, contamination, neardup, quality, sitelines

#: A source here is many sites, and no line of it is on a third of its documents, as a menu is on the pages of one site.
#: A line that one document in twenty repeats, and five at least, is not a document's own.
LINE_RATIO = 0.05


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that too large a share of their source's documents have; ``n_chars`` follows the text.

    Copies count as one document, as the next stage keeps one of them, whole.
    """
    out = sitelines.drop_boilerplate(docs, host="source", text="text", max_ratio=LINE_RATIO, once=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return neardup.keep_one(docs, length=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item of ``benchmark``."""
    return contamination.drop_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with how many there are and digests of ids and of the decoded text."""
    return bpe.digest(bpe.encoded(docs), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encoding),
]

#: The compression bands of the first stage have no SQL form; tests/llm checks all stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole table ``documents``."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Benchmark decontamination: size-partitioned MinHash containment search, verified on exact shingles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import common

SHINGLE = 5
THRESHOLD = 0.8
#: Least hash values kept of an item.
SKETCH = 16
#: Chance that an item at the threshold has fewer common values than its partition asks for.
MISS = 1e-9
NO_WORD = "[^\\p{L}\\p{N}]+"


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; none for a null text."""
    return F.coalesce(F.filter(F.split(F.lower(text), NO_WORD), lambda x: x != ""), F.array().cast("array<string>"))


def shingles(length: int) -> Column:
    """The distinct shingles of the column ``words`` as strings."""
    starts = F.expr(f"IF(size(words) >= {length}, sequence(1, size(words) - {length - 1}), CAST(array() AS array<int>))")
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(F.col("words"), i, length), " ")))


def hashed(rows: DataFrame, keep: list[str], length: int) -> DataFrame:
    """A row with the hash of each shingle of the column ``words``; made in the generated code, without an array of hashes."""
    at = F.expr(f"IF(size(words) >= {length}, sequence(0, size(words) - {length}), CAST(array() AS array<int>))")
    one = F.xxhash64(*[F.col("words")[F.col("at") + i] if i else F.col("words")[F.col("at")] for i in range(length)])
    # explode_outer: explode would have Spark filter on the array first and so make the words twice.
    return rows.select(*keep, "words", F.explode_outer(at).alias("at")).filter("at IS NOT NULL").select(*keep, one.alias("h"))


def needed(sizes: range, sketch: int, threshold: float, miss: float) -> int:
    """Common values that a partition asks for: fewer are met with a chance below ``miss`` by any contained item in it.

    Of n shingles of an item at the threshold, ceil(threshold * n) are in the document; how many of the ``sketch`` least
    ones are among them is hypergeometric.
    """
    asked = sketch
    for n in sizes:
        inside, drawn = math.ceil(threshold * n - 1e-9), min(sketch, n)
        below, k = 0.0, 0
        while k <= drawn:
            below += math.comb(inside, k) * math.comb(n - inside, drawn - k) / math.comb(n, drawn)
            if below > miss:
                break
            k += 1
        asked = min(asked, k)
    return max(1, asked)


def lone(key: Column, text: Column) -> Column:
    """What tells rows with a null key apart: a digest of the text; null where there is a key."""
    return F.when(key.isNull(), F.md5(text))


def item_table(items: DataFrame, key: str, text: str, length: int, sketch: int, threshold: float, miss: float) -> DataFrame:
    """Items with their exact shingles, and the sketch and the common values asked for by their size.

    An item of fewer than ``length`` words is one shingle, its whole sequence of ``k`` words; it is also in ``short``.
    Items are partitioned by size, from one power of two to the next. The last partition that is worked out holds all
    larger ones; there, drawing from more shingles changes next to nothing.
    """
    rows = items.select(items[key].alias("item"), lone(items[key], items[text]).alias("item_own"), words(items[text]).alias("words"))
    rows = rows.filter(F.size("words") > 0).withColumn("k", F.least(F.size("words"), F.lit(length)))
    none = F.array().cast("array<string>")
    rows = rows.withColumn("short", F.when(F.col("k") < length, F.array(F.array_join("words", " "))).otherwise(none))
    rows = rows.withColumn("exact", F.concat(shingles(length), "short")).withColumn("n", F.size("exact"))
    rows = rows.withColumn("band", F.least(F.floor(F.log2("n")), F.lit(11)).cast("int"))
    ask = F.lit(None).cast("int")
    for band in range(12):
        ask = F.when(F.col("band") == band, needed(range(1 << band, 2 << band), sketch, threshold, miss)).otherwise(ask)
    rows = rows.withColumn("asked", ask)
    # Behind the end of a short item ``get`` gives null, which the hash passes over.
    hashes = F.transform("exact", lambda s: F.xxhash64(*[F.get(F.split(s, " "), i) for i in range(length)]))
    return rows.withColumn("sketch", F.slice(F.array_sort(hashes), 1, sketch)).drop("words")


def _found(
    docs: DataFrame, items: DataFrame, key: str, text: str, item_key: str, item_text: str, length: int, threshold: float, sketch: int, miss: float,
) -> DataFrame:
    """The leaks as ``doc``, ``own`` (see ``lone``), ``item``, ``n``, ``shared``."""
    table = common.written(item_table(items, item_key, item_text, length, sketch, threshold, miss), "items")
    values = common.written(table.select("item", "item_own", "asked", "k", F.explode("sketch").alias("h")), "sketches")
    bound, lengths = values.agg(F.max("h"), F.sort_array(F.collect_set("k"))).first()  # at most ``length`` of them
    own = lone(docs[key], docs[text])
    rows = docs.select(docs[key].alias("doc"), own.alias("own"), words(docs[text]).alias("words"))
    low = hashed(rows, ["doc", "own"], length)
    for k in lengths:
        if k < length:
            low = low.unionAll(hashed(rows, ["doc", "own"], k))
    low = low.filter(F.col("h") <= F.lit(bound if bound is not None else -(2**63)).cast("long"))
    pair = ["doc", "own", "item", "item_own"]
    hits = low.join(values.drop("k"), "h").groupBy(*pair, "asked", "h").agg(F.lit(1).alias("x"))
    hits = hits.groupBy(*pair, "asked").agg(F.count("*").alias("common")).filter("common >= asked")
    pairs = common.written(hits.select(*pair), "candidates")

    wide = docs.select(docs[key].alias("d"), own.alias("o"), docs[text].alias("t"))
    one_doc = F.col("d").eqNullSafe(F.col("doc")) & F.col("o").eqNullSafe(F.col("own"))
    texts = wide.join(common.if_small(pairs), one_doc).select(*pair, words(F.col("t")).alias("words"))
    exact = table.select(F.col("item").alias("i"), F.col("item_own").alias("io"), "exact", "short")
    both = texts.join(exact, F.col("item").eqNullSafe(F.col("i")) & F.col("item_own").eqNullSafe(F.col("io")))
    spaced = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    held = F.filter("short", lambda s: F.contains(spaced(F.array_join("words", " ")), spaced(s)))
    same = both.select(*pair, "exact", F.concat(F.array_intersect("exact", shingles(length)), held).alias("same"))
    joined = same.groupBy(*pair).agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("same")))).alias("shared"),
        F.size(F.array_distinct(F.flatten(F.collect_set("exact")))).alias("n"),
    )
    return joined.filter(F.col("shared") >= F.lit(threshold) * F.col("n"))


def leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    length: int = SHINGLE, threshold: float = THRESHOLD, sketch: int = SKETCH, miss: float = MISS,
) -> DataFrame:
    """Pairs of a document and a test item of whose distinct shingles it holds at least ``threshold``.

    Returns ``key``, ``item_key``, ``n_item`` (shingles of the item), ``n_shared``, ``containment``.

    Search: a hash orders all shingles, and an item's sketch is its least values. A document is far larger than an item,
    so it has no sketch of fixed size: its side is all its values up to the largest one in any sketch, which is what a
    document of unknown size must keep to meet every item. The item's size partition says how many values must be
    common. Candidates are then verified on the exact shingles of whole texts. Nothing is paired but equal values, and
    an item copied into a third of all documents gives a pair for each of them.

    The sketches are joined by value: Spark broadcasts them as long as their table is below its threshold and shuffles
    otherwise. An item of fewer than ``length`` words is one shingle, its whole sequence, and the texts are read once more
    for every such number of words that there is. Null and empty texts are in no pair. Rows with the same key are parts
    of one document (or item). Rows with a null key each stand alone, those of equal text together; the key stays null.
    Empty tables give no pairs.
    """
    found = _found(docs, items, key, text, item_key, item_text, length, threshold, sketch, miss)
    return found.select(
        F.col("doc").alias(key), F.col("item").alias(item_key), F.col("n").alias("n_item"), F.col("shared").alias("n_shared"),
        (F.col("shared") / F.col("n")).alias("containment"),
    )


def drop_leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    length: int = SHINGLE, threshold: float = THRESHOLD, sketch: int = SKETCH, miss: float = MISS,
) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with their columns unchanged. All rows of a document go, or none; a
    row with a null key goes by its own text."""
    leaked, own = common.fresh(docs.columns, "leaked"), common.fresh(docs.columns, "lone")
    found = _found(docs, items, key, text, item_key, item_text, length, threshold, sketch, miss)
    found = common.written(found.select(F.col("doc").alias(leaked), F.col("own").alias(own)).distinct(), "leaked")
    same = docs[key].eqNullSafe(F.col(leaked)) & lone(docs[key], docs[text]).eqNullSafe(F.col(own))
    return docs.join(common.if_small(found), same, "left_anti")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(common.table(spark, folder, "documents"), common.table(spark, folder, "benchmark"))


def _sql() -> str:
    split = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    rows = "SELECT {0}, CASE WHEN {0} IS NULL THEN md5(text) END AS {1}, {2} AS ws FROM {3}"
    join = "{0} IS NOT DISTINCT FROM {1}"
    return f"""
WITH qw AS ({rows.format('item_id', 'io', split, 'benchmark')}), dw AS ({rows.format('doc_id', 'own', split, 'documents')}),
q AS (SELECT DISTINCT item_id, io, k, array_to_string(ws[i:i + k - 1], ' ') AS s
      FROM (SELECT *, least(len(ws), {SHINGLE}) AS k, unnest(range(1, len(ws) - least(len(ws), {SHINGLE}) + 2)) AS i FROM qw WHERE len(ws) > 0)),
n AS (SELECT item_id, io, count(*) AS n_item FROM q GROUP BY ALL), ks AS (SELECT DISTINCT k FROM q),
d AS (SELECT DISTINCT doc_id, own, array_to_string(ws[i:i + k - 1], ' ') AS s
      FROM (SELECT doc_id, own, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM dw, ks WHERE len(ws) >= k)),
o AS (SELECT doc_id, own, item_id, io, count(*) AS n_shared FROM (SELECT * FROM d WHERE s IN (SELECT s FROM q)) JOIN q USING (s) GROUP BY ALL)
SELECT doc_id, o.item_id, n_item, n_shared, n_shared / n_item AS containment
FROM o JOIN n ON {join.format('o.item_id', 'n.item_id')} AND {join.format('o.io', 'n.io')} WHERE n_shared >= {THRESHOLD} * n_item"""


SQL = _sql()

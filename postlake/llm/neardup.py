"""MinHash near-dedup: circulant signatures, banding, exact Jaccard on full shingle sets, components.

A pair that is similar enough shares a band but for a chance below 1e-6 (see ``circulant``). Every pair that shares a band
is then settled exactly, in three steps whose rows grow with the documents and not with their pairs:

1. Copies (the same words) are one document. In each bucket of a band all documents are compared with one of them.
2. Where a bucket still holds documents of several components, its members are compared by a sketch of their
   signatures, in blocks; what comes out of a block is which components may be linked, not which documents.
3. Components that may be linked come together, once for all their buckets, in blocks of texts, and all pairs
   between different components are compared there on full sets. Again only links that join components come out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import circulant, common
from postlake.llm.components import components

#: Documents of a block; a task holds two blocks.
BLOCK = 256
#: Coordinates of a signature in its sketch, one byte each.
SKETCH = 192
#: The share of them that is let through is lower than the similarity by this: over six standard deviations.
SLACK = 0.17
_SIGNED = "id bigint, copy binary, n bigint, bands array<bigint>, sketch binary"


def signed(docs: DataFrame, key: str, text: str, length: int, percent: int) -> DataFrame:
    """Key, digest of the words, set size, band keys and sketch of every row."""
    rows = circulant.rows_for(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data in common.as_bytes(batch.column(1)):
                words = circulant.words_of(data)
                shingles = circulant.shingle_set(words, length)
                bands, sketch = [], b""
                if len(shingles):
                    least = circulant.signature(shingles, rows)
                    bands = circulant.band_keys(least, rows)
                    sketch = (np.resize(least[:: max(1, len(least) // SKETCH)], SKETCH) & 0xFF).astype(np.uint8).tobytes()
                out.append((circulant.digest(words), len(shingles), bands, sketch))
            kinds = [pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            columns = list(zip(*out)) or [()] * 4
            common.give_back()
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["id", "copy", "n", "bands", "sketch"])

    return common.map_in_arrow(docs.select(docs[key].cast("long").alias("id"), docs[text].alias("t")), run, _SIGNED)


def similar(length: int, percent: int) -> Callable[..., Column]:
    """Whether the full sets of two texts have at least ``percent`` hundredths of their union in common."""

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(common.as_bytes(left), common.as_bytes(right)):
            a, b = (circulant.shingle_set(circulant.words_of(x), length) for x in (a, b))
            same = len(np.intersect1d(a, b, assume_unique=True))
            out.append(same > 0 and 100 * same >= percent * (len(a) + len(b) - same))
        return pa.array(out, pa.bool_())

    return common.arrow_udf(run, "boolean")


def dealt(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """Members (``g`` group, ``label``, other columns) with the ``cell`` and ``side`` of every comparison they take part in.

    The label with most members of a group is its main one. The others are dealt to blocks, and so are those of the main
    one; a cell is a pair of blocks, but none of two main blocks, whose members are of one label. Small groups are one cell.
    """
    counts = members.groupBy("g", "label").agg(F.count("*").alias("c"))
    sizes = counts.groupBy("g").agg(F.max(F.struct("c", "label")).alias("m"), F.sum("c").alias("all"))
    # Several labels may have most members; the largest of them is main.
    sizes = common.written(sizes.select("g", F.col("m.label").alias("main"), F.col("m.c").alias("n_main"), "all"), "sizes")
    rows = members.join(sizes, "g")
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(block))).cast("int")
    rows = rows.withColumn("is_main", F.col("label") == F.col("main"))
    rows = rows.withColumn("others", blocks(F.col("all") - F.col("n_main"))).withColumn("mains", blocks(F.col("n_main")))
    own = F.pmod(F.xxhash64("id", F.lit(7)), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others"))).cast("int")
    rows = rows.withColumn("own", own)
    # Cells are numbered (block of others, block of others from 0 on, or of main ones from -1 down).
    cell = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
    as_main = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda i: cell(i, -1 - F.col("own")))
    with_main = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda i: cell(F.col("own"), -1 - i))
    with_other = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda i: cell(F.least(F.col("own"), i), F.greatest(F.col("own"), i)))
    cells = F.when(F.col("all") <= 2 * block, F.array(cell(F.lit(0), F.lit(0)))).when(F.col("is_main"), as_main).otherwise(F.concat(with_main, with_other))
    return rows.withColumn("cell", F.explode(cells)).select(*members.columns, F.col("cell.x").alias("x"), F.col("cell.y").alias("y"))


def joined_in_cells(cells: DataFrame, payload: str, links: Callable[[list, list], Iterator[tuple[int, int]]]) -> DataFrame:
    """Runs ``links(payloads, labels)`` over each cell and gives pairs of ids that join its labels, at most one less than its labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids, labels, loads = None, [], [], []

        def closed() -> pa.RecordBatch:
            root = {x: x for x in labels}

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            out = []
            if len(root) > 1:
                for i, j in links(loads, labels):
                    a, b = find(labels[i]), find(labels[j])
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        out.append((ids[i], ids[j]))
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for g, x, y, own, label, load in zip(*[c.to_pylist() for c in batch.columns]):
                if (g, x, y) != place:
                    if len(ids) > 1:
                        yield closed()
                    place, ids, labels, loads = (g, x, y), [], [], []
                ids.append(own)
                labels.append(label)
                loads.append(load)
        if len(ids) > 1:
            yield closed()

    order = cells.select("g", "x", "y", "id", "label", payload).repartition("g", "x", "y").sortWithinPartitions("g", "x", "y", "id")
    return common.map_in_arrow(order, run, "a bigint, b bigint")


def sketch_links(percent: int) -> Callable[[list, list], Iterator[tuple[int, int]]]:
    """Pairs of different labels whose sketches agree in so many coordinates that they may be similar."""

    def run(sketches: list, labels: list) -> Iterator[tuple[int, int]]:
        table = np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(len(sketches), SKETCH)
        marks = np.array(labels)
        least = (percent / 100 - SLACK) * SKETCH
        for i in range(1, len(table)):
            may = (table[:i] == table[i]).sum(axis=1) >= least
            for j in np.flatnonzero(may & (marks[:i] != marks[i])).tolist():
                yield i, j

    return run


def text_links(length: int, percent: int) -> Callable[[list, list], Iterator[tuple[int, int]]]:
    """Pairs of different labels whose full sets are similar enough."""

    def run(texts: list, labels: list) -> Iterator[tuple[int, int]]:
        sets = [circulant.shingle_set(circulant.words_of((x or "").encode()), length) for x in texts]
        sizes, marks = np.array([len(x) for x in sets]), np.array(labels)
        distinct, at = np.unique(np.concatenate(sets), return_inverse=True)
        often = np.bincount(at) > 1
        column = np.cumsum(often) - 1
        owner = np.repeat(np.arange(len(sets)), sizes)[often[at]]
        at = column[at[often[at]]]
        # Only shingles of two documents or more count for what they have in common. Common ones, a slice at a time.
        same = np.zeros((len(sets), len(sets)), dtype=np.float32)
        for low in range(0, int(often.sum()), 8192):
            part = (at >= low) & (at < low + 8192)
            dense = np.zeros((len(sets), 8192), dtype=np.float32)
            dense[owner[part], at[part] - low] = 1
            same += dense @ dense.T
        union = sizes[:, None] + sizes[None, :] - same
        linked = (100 * same >= percent * union) & (same > 0) & (marks[:, None] != marks[None, :])
        yield from (tuple(x) for x in np.argwhere(np.triu(linked, 1)).tolist())

    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 3, percent: int = 85) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (the smallest key that links lead to) and ``kept`` of every row.

    Words are runs of anything but the six ASCII spaces, with A to Z in lower case. Two rows are linked if at least
    ``percent`` hundredths of all their distinct ``length``-word shingles (64-bit hashes of them) are in both; a text of
    fewer words has one shingle, its whole sequence. Null and empty texts have none and are linked with nothing. Rows
    with the same key are the same document, so what links one links the other. Rows with a null key are grouped
    with nothing; they have a null component and are kept. Repeated rows all stay in the result. An empty table
    gives an empty one; other columns are not read.
    """
    sig = common.written(signed(docs, key, text, length, percent), "signatures")
    known = sig.filter("id IS NOT NULL AND n > 0")
    # Copies: one row for each sequence of words stands for all of them.
    nodes = common.written(known.groupBy("copy").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "nodes")
    member = known.select("id", "copy").distinct().join(nodes.select("copy", "rep"), "copy").select("id", "rep")
    same_key = member.groupBy("id").agg(F.min("rep").alias("a")).join(member, "id").filter("a <> rep").select("a", F.col("rep").alias("b"))

    # Buckets of more than one node.
    rows = nodes.select(F.explode("bands").alias("g"), F.col("rep").alias("id"), "n")
    hubs = rows.groupBy("g").agg(F.min(F.struct("id", "n")).alias("hub"), F.count("*").alias("c")).filter("c > 1")
    # Written first: of a join of plain tables Spark can split a hot bucket.
    hubs = common.written(hubs.select("g", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n")), "hubs")
    buckets = common.written(rows.join(hubs, "g"), "buckets")

    # Everybody with the hub.
    close = F.col("id") != F.col("hub")
    close &= 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    stars = common.written(buckets.filter(close).select("id", "hub").distinct(), "stars")
    # Only documents that share a bucket are ever compared: their texts are gathered once, for all that follows.
    needed = common.written(buckets.select(F.col("id").alias("v")).distinct(), "needed")
    texts = docs.select(docs[key].cast("long").alias("k"), docs[text].alias("t"))
    texts = common.written(texts.join(common.if_small(needed), F.col("k") == F.col("v"), "left_semi"), "texts")
    left = common.if_small(stars).join(texts, F.col("id") == F.col("k")).select("id", "hub", F.col("t").alias("t1"))
    both = left.join(texts, F.col("hub") == F.col("k")).select("id", "hub", "t1", "t")
    first = both.filter(similar(length, percent)("t1", "t")).select(F.col("id").alias("a"), F.col("hub").alias("b"))
    first = common.written(first.unionAll(same_key), "links")
    labels = components(first)

    # Buckets with several components: which of these may be linked.
    labelled = lambda df: df.join(labels.withColumnRenamed("id", "v"), F.col("id") == F.col("v"), "left").withColumn("label", F.coalesce("component", "id")).drop("v", "component")
    inside = common.written(labelled(buckets.select("g", "id")), "labelled")
    mixed = inside.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("g")
    some = inside.join(common.written(mixed, "mixed"), "g").join(nodes.select(F.col("rep").alias("id"), "sketch"), "id")
    some = common.written(some.select("g", "id", "label", "sketch"), "members")
    may = joined_in_cells(dealt(some), "sketch", sketch_links(percent))
    may = common.written(may.distinct(), "may")
    ends = labelled(labelled(may.withColumnRenamed("a", "id")).select("b", F.col("label").alias("la")).withColumnRenamed("b", "id"))
    groups = components(ends.select(F.col("la").alias("a"), F.col("label").alias("b")))

    # Their members, all of them, on full sets.
    reps = labelled(nodes.select(F.col("rep").alias("id")).distinct())
    grouped = reps.join(groups.select(F.col("id").alias("label"), F.col("component").alias("g")), "label").select("g", "id", "label")
    cells = dealt(common.written(grouped, "groups"))
    last = joined_in_cells(cells.join(texts, F.col("id") == F.col("k")), "t", text_links(length, percent))
    final = components(common.written(first.unionAll(last), "links"))

    out = sig.select("id", "copy", "n").join(nodes.select(F.col("copy").alias("c"), "rep"), (F.col("copy") == F.col("c")) & (F.col("n") > 0) & F.col("id").isNotNull(), "left")
    out = out.join(final.withColumnRenamed("id", "v"), F.col("rep") == F.col("v"), "left")
    found = F.coalesce("component", "rep", "id")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), found.alias("component_id"), F.coalesce(F.col("id") == found, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates, with the columns unchanged: the one with the smallest key.

    Rows with a null key all stay. Of rows with the same key one stays (the first one by text), if any has a text with words.
    """
    found = common.written(near_duplicates(docs, key, text, length, percent), "near")
    name = common.fresh(docs.columns, "key")
    gone = found.filter(~F.col("kept")).select(F.col(key).alias(name)).distinct()
    gone = common.if_small(common.written(gone, "gone"))
    stay = docs.join(gone, docs[key] == gone[name], "left_anti")
    twice = found.filter(F.col("kept") & F.col(key).isNotNull()).groupBy(F.col(key).alias(name)).agg(F.count("*").alias("c"), F.max("n_shingles").alias("most"))
    twice = common.written(twice.filter("c > 1 AND most > 0").select(name), "repeated")
    if twice.isEmpty():
        return stay
    once = stay.join(twice, stay[key] == twice[name], "left_semi").dropDuplicates([key])
    return stay.join(twice, stay[key] == twice[name], "left_anti").unionByName(once)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(common.table(spark, folder, "documents"))

"""Substring dedup: shared k-mer seeds, collinear chains with gap costs, and alignment of the chains.

A passage of a document is a repeat if its words occur in an earlier document (of a smaller key), give or take some
words. Seeds are hashes of k words in a row, of which each window keeps the least one, so that equal passages of k +
window - 1 words share a seed wherever they stand. All occurrences of a seed are linked to the first one and not to
each other: the work is one row for each occurrence, however many copies there are. Seeds that this leaves in no passage are looked up
once more, by whole runs of words, of which again each occurrence is linked to the first one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm import circulant, common

#: Words of a seed, and the seeds of which one is kept.
K, WINDOW = 8, 18
#: Least words of a passage, and the least share of them that must be equal, in order, in the other one.
MIN_WORDS, IDENTITY = 50, 0.8
#: A chain may leave out so many words between two seeds. Each word passed on either side costs this much of a seed.
MAX_GAP, GAP_COST = 96, 0.02
#: Most words that an alignment leaves out at once, and the equal words in a row that end a gap.
SKIP, RESYNC = 10, 3
#: Words around a chain that are looked at to extend it; a passage that goes on beyond them without a seed ends there.
AROUND = 96
#: Pieces of the earlier document begin and end at multiples of this, so that many chains share a piece.
GRID = 128
#: Places of a run of equal windows that are given for its chain.
STEP = 32


def minimizers(words: list[bytes], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the kept seeds: the least of every ``window`` in a row.

    Where a text repeats itself within a window, only the first of the equal seeds in such a run is kept.
    """
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    hashes = circulant.word_hashes(words)
    total = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        total = circulant.mixed(total + hashes[i : n + i])
    least, width = total, 1
    while width < min(window, n):
        step = min(width, min(window, n) - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    # A seed is kept if it is the least of some window around it.
    padded = np.concatenate([np.zeros(width - 1, dtype=np.uint64), least, np.zeros(width - 1, dtype=np.uint64)])
    grown, size = padded, 1
    while size < width:
        step = min(size, width - size)
        grown = np.maximum(grown[: len(grown) - step], grown[step:])
        size += step
    around = grown[:n]
    at = np.flatnonzero(total <= around)
    order = np.lexsort((at, total[at]))
    hashes, places = total[at][order], at[order]
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(hashes) != 0) | (np.diff(places) >= window)]))
    lengths = places[np.concatenate([starts[1:], [len(places)]]) - 1] - places[starts]
    hashes, places = hashes[starts], places[starts]
    # A long run also has a seed for each length, doubled again and again, that it reaches: the first document with
    # this seed has a run at least as long.
    more_hashes, more_places = [hashes], [places]
    level, least = 1, MIN_WORDS - k
    while (long := lengths >= least).any():
        more_hashes.append(circulant.mixed(hashes[long] + np.uint64(level)))
        more_places.append(places[long])
        level, least = level + 1, least * 2
    return np.concatenate(more_hashes).view(np.int64), np.concatenate(more_places)


def seeds(docs: DataFrame, key: str, text: str, min_words: int = MIN_WORDS) -> DataFrame:
    """``h``, ``id``, ``pos`` of the seeds of every text that is long enough to hold a passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs, ids, places = [], [], []
            for name, data in zip(batch.column(0).to_pylist(), common.as_bytes(batch.column(1))):
                words = circulant.words_of(data)
                if len(words) >= min_words:
                    h, at = minimizers(words)
                    hs.append(h)
                    places.append(at)
                    ids.append(np.full(len(at), name, dtype=np.int64))
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (hs, ids, places)], ["h", "id", "pos"])

    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("t")).filter("id IS NOT NULL")
    return common.map_in_arrow(rows, run, "h bigint, id bigint, pos bigint")


class Fenwick:
    """Largest (value, index) over the places up to a given one."""

    def __init__(self, n: int):
        self.tree: list[tuple[float, int]] = [(-np.inf, -1)] * (n + 1)

    def put(self, at: int, item: tuple[float, int]) -> None:
        at += 1
        while at < len(self.tree):
            if item > self.tree[at]:
                self.tree[at] = item
            at += at & -at

    def best(self, upto: int) -> tuple[float, int]:
        found = (-np.inf, -1)
        while upto > 0:
            if self.tree[upto] > found:
                found = self.tree[upto]
            upto -= upto & -upto
        return found


def chains(matches: list[tuple[int, int]], max_gap: int = MAX_GAP, gap_cost: float = GAP_COST) -> Iterator[list[tuple[int, int]]]:
    """Chains of (position, position) matches that ascend on both sides, all matches being in one.

    A chain's score is its matches less ``gap_cost`` for each word passed on either side. That cost is a difference
    of coordinate sums, so the best match to go on from is a prefix maximum of score plus cost of the coordinates, which
    the Fenwick tree over the second side holds while the matches come in order of the first. A chain is cut afterwards
    where it steps over a longer gap than ``max_gap``.
    """
    points = sorted(set(matches))
    rank = {y: i for i, y in enumerate(sorted({y for _, y in points}))}
    tree, before, scores = Fenwick(len(rank)), [], []
    at = 0
    while at < len(points):
        row = at
        while at < len(points) and points[at][0] == points[row][0]:
            x, y = points[at]
            value, last = tree.best(rank[y])
            gain = value - gap_cost * (x + y)
            if last < 0 or gain <= 0:
                gain, last = 0.0, -1
            before.append(last)
            scores.append(1 + gain)
            at += 1
        for i in range(row, at):  # matches at one position don't follow each other
            tree.put(rank[points[i][1]], (scores[i] + gap_cost * (points[i][0] + points[i][1]), i))
    used = [False] * len(points)
    for i in sorted(range(len(points)), key=lambda i: (-scores[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(points[i])
            i = before[i]
        chain.reverse()
        start = 0
        for j in range(1, len(chain) + 1):
            if j == len(chain) or max(chain[j][0] - chain[j - 1][0], chain[j][1] - chain[j - 1][1]) > max_gap:
                yield chain[start:j]
                start = j


_CHAIN = "id bigint, rep bigint, d array<bigint>, r array<bigint>"


def chained(matches: DataFrame) -> DataFrame:
    """The chains of every pair of documents. A pair has one match at most for each seed of the later document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, points = None, []

        def closed() -> pa.RecordBatch:
            found = list(chains(points))
            ints = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays([
                pa.array([pair[0]] * len(found), pa.int64()), pa.array([pair[1]] * len(found), pa.int64()),
                pa.array([[x for x, _ in c] for c in found], ints), pa.array([[y for _, y in c] for c in found], ints),
            ], ["id", "rep", "d", "r"])

        for batch in batches:
            for own, rep, pos, rpos in zip(*[c.to_pylist() for c in batch.columns]):
                if (own, rep) != pair:
                    if points:
                        yield closed()
                    pair, points = (own, rep), []
                points.append((pos, rpos))
        if points:
            yield closed()

    order = matches.select("id", "rep", "pos", "rpos").repartition("id", "rep").sortWithinPartitions("id", "rep")
    return common.map_in_arrow(order, run, _CHAIN)


def extend(
    a: list, b: list, i: int, j: int, stop: tuple[int, int] | None = None, runs: list[tuple[int, int, int]] | None = None,
) -> tuple[int, int, int]:
    """Aligns ``a`` from ``i`` with ``b`` from ``j`` on: the ends reached, behind the last equal word, and the equal words.

    Equal words are passed at once; at a difference the smallest gap is taken after which ``RESYNC`` words are equal.
    Ends where there is none, or at ``stop``. The runs of equal words (both starts, length) are appended to ``runs``.
    """
    equal, end = 0, (i, j)
    n, m = len(a), len(b)
    while i < n and j < m:
        run, before = 1, equal
        while run <= 4096 and i + run <= n and j + run <= m and a[i : i + run] == b[j : j + run]:
            i, j, equal, run = i + run, j + run, equal + run, run * 2
        while i < n and j < m and a[i] == b[j]:
            i, j, equal = i + 1, j + 1, equal + 1
        end = (i, j)
        if runs is not None and equal > before:
            runs.append((i - equal + before, j - equal + before, equal - before))
        if i >= n or j >= m or (stop and i >= stop[0] and j >= stop[1]):
            break
        for gap in range(1, SKIP + 1):
            steps = [(gap, gap), *((gap, y) for y in range(gap)), *((x, gap) for x in range(gap))]
            ahead = next(((x, y) for x, y in steps if i + x + RESYNC <= n and j + y + RESYNC <= m and a[i + x : i + x + RESYNC] == b[j + y : j + y + RESYNC]), None)
            if ahead:
                break
        if not ahead:
            break
        i, j = i + ahead[0], j + ahead[1]
    return *end, equal


def backwards(a: list, b: list, i: int, j: int) -> list[tuple[int, int, int]]:
    """The runs of equal words, in order, when ``a`` before ``i`` is aligned with ``b`` before ``j``."""
    runs: list[tuple[int, int, int]] = []
    extend(a[:i][::-1], b[:j][::-1], 0, 0, runs=runs)
    return [(i - x - n, j - y - n, n) for x, y, n in reversed(runs)]


def aligned(a: list, b: list, d: list[int], r: list[int]) -> list[tuple[int, int, int]]:
    """The runs of equal words (start in ``a``, start in ``b``, length) around and along a chain, ascending on both sides.

    Where the alignment does not close a gap it goes on at the next seed, and back from there into the gap.
    """
    runs = backwards(a, b, d[0], r[0])
    i, j = d[0], r[0]
    for x, y in zip([*d[1:], None], [*r[1:], None]):
        i, j, _ = extend(a, b, i, j, (x, y) if x is not None else None, runs)
        if x is not None and x > i and y > j:
            runs += [(i + u, j + v, n) for u, v, n in backwards(a[i:x], b[j:y], x - i, y - j)]
            i, j = x, y
    return runs


def alike(runs: list[tuple[int, int, int]], min_words: int, identity: float) -> Iterator[tuple[int, int, int, int, int]]:
    """The passages along some runs: start and end in ``a`` and in ``b``, and the equal words.

    A passage goes from the start of a run to the end of one, is long and equal enough, and lies in no longer such one.
    Passages may overlap: of three runs the first and the second may be one passage, and the second and the third.
    """
    if not runs:
        return
    x, y, n = np.array(runs, dtype=np.int64).T
    total = np.concatenate([[0], np.cumsum(n)])
    last = -1
    for i in range(len(runs)):
        if last == len(runs) - 1:
            return
        start = max(i, last + 1)
        one, two, equal = (x + n)[start:] - x[i], (y + n)[start:] - y[i], total[start + 1 :] - total[i]
        good = np.flatnonzero((np.minimum(one, two) >= min_words) & (equal >= identity * np.maximum(one, two)))
        if len(good):
            last = start + int(good[-1])
            yield int(x[i]), int(x[last] + n[last]), int(y[i]), int(y[last] + n[last]), int(total[last + 1] - total[i])


def piece(words: list[bytes], start: int, end: int) -> bytes:
    return b" ".join(words[max(0, start) : end])


def cut(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """For each row (``id``, ``lo``, ``hi``) of ``ranges`` those words of the text. A text is split once, for all ranges of it."""

    def run(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        out = []
        for data, wanted in zip(common.as_bytes(texts), ranges.to_pylist()):
            words = circulant.words_of(data)
            out.append([piece(words, x["lo"], x["hi"]) for x in wanted])
        return pa.array(out, pa.list_(pa.binary()))

    take = common.arrow_udf(run, "array<binary>")
    lists = ranges.groupBy("id").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    rows = lists.join(texts, F.col("id") == F.col("k")).select("id", "ranges", take("t", "ranges").alias("pieces"))
    rows = rows.select("id", F.explode(F.arrays_zip("ranges", "pieces")).alias("z"))
    return rows.select("id", "z.ranges.lo", "z.ranges.hi", F.col("z.pieces").alias("piece"))


_PASSAGE = ("start", "end", "source_start", "source_end", "n_equal")


def passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, identity: float = IDENTITY,
) -> DataFrame:
    """Passages of documents that occur in an earlier one: ``key``, ``start``, ``end``, ``source_id``, ``source_start``,
    ``source_end`` (words, ends exclusive, A to Z in lower case) and ``n_equal``, the words equal in order.

    A passage has at least ``min_words`` words on both sides, of which at least ``identity`` (of the longer side) are equal.
    Where a chain as a whole has fewer, its parts between differences count, each as long as it can be; they may overlap.
    It is linked to the document in which its seeds come first; copies are not linked among each other. Where seeds are in no
    passage then, as their first documents have too little around them, all runs of ``min_words`` equal words around them are
    looked up, and linked to the document in which the whole run comes first. Fuzzy passages of less than about 25 equal words in a row may be
    missed, as no seed of theirs may be kept. Null, empty and short texts have no passages; rows with a null key are not
    compared; rows with the same key are parts of one document and not compared with each other.
    Repeated results are given once. An empty table has none.
    """
    found = common.written(seeds(docs, key, text, min_words), "seeds")
    first = found.groupBy("h").agg(F.min(F.struct("id", "pos")).alias("m"), F.max("id").alias("last"))
    first = first.filter(F.col("m.id") < F.col("last")).select(F.col("h").alias("g"), F.col("m.id").alias("rep"), F.col("m.pos").alias("rpos"))
    first = common.written(first, "first")  # of a join of plain tables Spark can split a hot seed
    shared = common.written(found.join(first, F.col("h") == F.col("g")).drop("g"), "shared")
    texts = docs.select(docs[key].cast("long").alias("k"), docs[text].alias("t"))
    got = common.written(along(texts, shared.filter("id > rep"), min_words, identity), "passages")
    more = along(texts, equal_windows(texts, left_open(shared, got), min_words), min_words, identity)
    got = got.unionAll(more).distinct()
    return got.select(F.col("id").alias(key), "start", "end", F.col("rep").alias("source_id"), "source_start", "source_end", "n_equal")


def left_open(shared: DataFrame, got: DataFrame) -> DataFrame:
    """``id``, ``pos`` of the seeds that some later document has outside its passages, in all documents that have them;
    ``free`` where it is so in the document itself."""
    spans = got.groupBy(F.col("id").alias("v")).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    within = F.exists("spans", lambda x: (x["start"] <= F.col("pos")) & (F.col("pos") + K <= x["end"]))
    free = (F.col("id") > F.col("rep")) & ~F.coalesce(within, F.lit(False))
    marked = common.written(shared.join(spans, F.col("id") == F.col("v"), "left").select("h", "id", "pos", free.alias("free")), "marked")
    wanted = common.written(marked.filter("free").select(F.col("h").alias("g")).distinct(), "open")
    return marked.join(wanted, F.col("h") == F.col("g"), "left_semi").select("id", "pos", "free")


def equal_windows(texts: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """Matches ``id``, ``rep``, ``pos``, ``rpos`` of ``size`` equal words around some seeds, with the first document that has
    all of them: that of a seed alone may have less. Only windows around a ``free`` place are matched. Of a run of matches its
    ends and those at multiples of ``STEP`` are given."""

    def run(texts: pa.Array, places: pa.Array) -> pa.Array:
        out = []
        for data, at in zip(common.as_bytes(texts), places.to_pylist()):
            words = circulant.words_of(data)
            n = len(words) - size + 1
            starts: dict[int, bool] = {}
            for x in at:
                for i in range(max(0, x["pos"] + K - size), min(n, x["pos"] + 1)):
                    starts[i] = starts.get(i, False) or x["free"]
            total = np.empty(0, dtype=np.uint64)
            if starts:
                hashes, total = circulant.word_hashes(words), np.full(n, size, dtype=np.uint64)
                for i in range(size):
                    total = circulant.mixed(total + hashes[i : n + i])
            total = total.view(np.int64)
            out.append([{"w": int(total[i]), "pos": i, "free": free} for i, free in starts.items()])
        return pa.array(out, pa.list_(pa.struct([("w", pa.int64()), ("pos", pa.int64()), ("free", pa.bool_())])))

    hashed = common.arrow_udf(run, "array<struct<w:bigint,pos:bigint,free:boolean>>")
    lists = places.groupBy("id").agg(F.collect_set(F.struct("pos", "free")).alias("places"))
    rows = lists.join(texts, F.col("id") == F.col("k")).select("id", hashed("t", "places").alias("x"))
    rows = common.written(rows.select("id", F.explode("x").alias("x")).select("id", "x.*"), "windows")
    first = rows.groupBy("w").agg(F.min(F.struct("id", "pos")).alias("m"), F.max("id").alias("last")).filter("m.id < last")
    first = common.written(first.select(F.col("w").alias("g"), F.col("m.id").alias("rep"), F.col("m.pos").alias("rpos")), "firsts")
    links = rows.join(first, F.col("w") == F.col("g")).filter("free AND id > rep").withColumn("off", F.col("pos") - F.col("rpos"))
    run_of = Window.partitionBy("id", "rep", "off").orderBy("pos")
    ends = links.withColumns({"before": F.lag("pos").over(run_of), "after": F.lead("pos").over(run_of)})
    kept = (F.col("pos") % STEP == 0) | F.col("before").isNull() | (F.col("before") < F.col("pos") - 1) | F.col("after").isNull() | (F.col("after") > F.col("pos") + 1)
    return ends.filter(kept).select("id", "rep", "pos", "rpos")


def along(texts: DataFrame, matches: DataFrame, min_words: int, identity: float) -> DataFrame:
    """The passages along the chains of some matches: ``id``, ``rep`` and ``_PASSAGE``."""
    lines = common.written(chained(matches).distinct(), "chains")
    span = lambda c: (F.element_at(c, 1), F.element_at(c, -1))
    (d0, d1), (r0, r1) = span("d"), span("r")
    lines = lines.withColumn("lo", F.greatest(F.lit(0), d0 - AROUND)).withColumn("hi", d1 + K + AROUND)
    lines = lines.withColumn("rlo", F.greatest(F.lit(0), F.floor((r0 - AROUND) / GRID) * GRID)).withColumn("rhi", F.ceil((r1 + K + AROUND) / GRID) * GRID)
    own = cut(texts, lines.select("id", "lo", "hi"))
    other = cut(texts, lines.select(F.col("rep").alias("id"), F.col("rlo").alias("lo"), F.col("rhi").alias("hi")))
    other = other.select(F.col("id").alias("rep"), F.col("lo").alias("rlo"), F.col("hi").alias("rhi"), F.col("piece").alias("rpiece"))
    both = lines.join(own, ["id", "lo", "hi"]).join(other, ["rep", "rlo", "rhi"])

    def run(left: pa.Array, right: pa.Array, d: pa.Array, r: pa.Array, lo: pa.Array, rlo: pa.Array) -> pa.Array:
        out = []
        for a, b, xs, ys, x0, y0 in zip(*[c.to_pylist() for c in (left, right, d, r, lo, rlo)]):
            a, b = a.split(), b.split()
            if [a[x - x0 : x - x0 + K] for x in xs[:1]] != [b[y - y0 : y - y0 + K] for y in ys[:1]]:
                out.append([])  # another part of a document with the same key, or a hash that two seeds share
                continue
            runs = aligned(a, b, [x - x0 for x in xs], [y - y0 for y in ys])
            found = alike(runs, min_words, identity)
            out.append([dict(zip(_PASSAGE, (s + x0, e + x0, rs + y0, re + y0, n))) for s, e, rs, re, n in found])
        return pa.array(out, pa.list_(pa.struct([(x, pa.int64()) for x in _PASSAGE])))

    align = common.arrow_udf(run, f"array<struct<{','.join(f'{x}:bigint' for x in _PASSAGE)}>>")
    got = both.select("id", "rep", align("piece", "rpiece", "d", "r", "lo", "rlo").alias("p"))
    # explode_outer: explode would have Spark filter on the array first and so align twice.
    got = got.select("id", "rep", F.explode_outer("p").alias("p")).filter("p IS NOT NULL")
    return got.select("id", "rep", "p.*").distinct()


def query(spark: SparkSession, folder: str) -> DataFrame:
    return passages(common.table(spark, folder, "documents"))

"""Phrase collocation mining: counts of all frequent phrases from sorted suffixes, and the phrases whose words belong together.

Every word position is a suffix, cut after ``DEPTH`` words or at the end of its piece. Tasks sort the suffixes of a block
of text, count equal ones, and route them by their leading words: boundaries taken from an even sample of the text split
all suffixes into ranges of about the same size, so that a word, or a pair of words, of a third of all text is split at the
words that follow. In each range a multikey three-way quicksort splits the suffixes word by word around a pivot; the size
of an equal partition is the count of a phrase, and a partition that is not frequent is abandoned with all that is in it.
Phrases that a boundary cuts are counted on both sides and summed.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm import common

#: Words of a phrase at most; occurrences of one at least; phrases that are returned of each language.
DEPTH, LEAST, TOP = 5, 100, 2000
#: Characters of text for each range of suffixes, and places of it that are looked at to find the boundaries.
RANGE, LOOKS = 1 << 23, 24
#: Bytes of text whose suffixes are sorted at once.
BLOCK = 1 << 21
#: Characters that are read at a place of the sample.
SNIPPET = 400
#: Suffixes that are counted at once when a partition is small.
SMALL = 4096
#: Both sides of this are parts of different phrases; tabs are spaces.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(BREAKS + b"\t", b"\n" * len(BREAKS) + b" ")
UNKNOWN = "und"
#: Exact for counts up to 10^17: products have 38 digits.
SCORE = "CAST((1000 * CAST(a AS DECIMAL(19, 0)) * n) div (CAST(l AS DECIMAL(19, 0)) * r) AS BIGINT)"


def pieces(data: bytes) -> list[list[bytes]]:
    """The words of each piece, A to Z in lower case."""
    return [x.split() for x in data.lower().translate(_TABLE).split(b"\n")]


def slices(texts: Iterator[bytes]) -> Iterator[bytes]:
    """Blocks of whole pieces; long texts are cut between pieces."""
    held, size = [], 0
    for data in texts:
        start = 0
        while start < len(data):
            end = len(data)
            if end - start > BLOCK:
                cuts = [x for x in (data.find(bytes([b]), start + BLOCK) for b in BREAKS) if x >= 0]
                end = min(cuts) + 1 if cuts else end
            held.append(data[start:end])
            size += end - start
            start = end
            if size >= BLOCK:
                yield b"\n".join(held)
                held, size = [], 0
    if held:
        yield b"\n".join(held)


def suffixes(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words in order, the distinct suffixes in order (a column of word numbers from 1 on, 0 behind the end
    of a piece, for each word), and how often each is there."""
    found = pieces(data)
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(found)), dtype=np.int64, count=int(lengths.sum()))
    del found
    words = sorted(numbers)
    if not words:
        return [], np.zeros((DEPTH, 0), dtype=np.int64), np.zeros(0, dtype=np.int64)
    rank = np.empty(len(words), dtype=np.int64)
    rank[np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))] = np.arange(1, len(words) + 1)
    ids = rank[ids]
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(ids))  # words up to the end of the piece
    padded = np.concatenate([ids, np.zeros(DEPTH, dtype=np.int64)])
    columns = np.stack([np.where(left > d, padded[d : d + len(ids)], 0) for d in range(DEPTH)])
    order = np.lexsort(columns[::-1]) if len(words) >= 1 << 21 else _packed_order(columns)
    columns = columns[:, order]
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(columns, axis=1) != 0).any(axis=0)]))
    return words, columns[:, starts], np.diff(np.append(starts, len(order)))


def _packed_order(columns: np.ndarray) -> np.ndarray:
    """The order of suffixes whose word numbers have 21 bits at most."""
    high = (columns[0] << 42) | (columns[1] << 21) | columns[2]
    return np.lexsort(((columns[3] << 21) | columns[4], high))


def place(words: list[bytes], columns: np.ndarray, boundary: tuple[bytes, ...]) -> int:
    """How many of the suffixes come before the boundary."""
    lo, hi = 0, columns.shape[1]
    for d, word in enumerate(boundary):
        at = bisect_left(words, word) + 1 if word else 0
        known = not word or at <= len(words) and words[at - 1] == word
        part = columns[d, lo:hi]
        first = lo + int(np.searchsorted(part, at, "left"))
        if not known:
            return first
        lo, hi = first, lo + int(np.searchsorted(part, at, "right"))
        if lo == hi:
            break
    return lo


def packed(words: list[bytes], columns: np.ndarray, weights: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Suffixes with the words that they use."""
    used = np.unique(columns)
    kind = np.uint16 if len(used) < 1 << 16 else np.uint32
    if used[0] != 0:
        used = np.concatenate([[0], used])
    numbers = np.searchsorted(used, columns).astype(kind)
    return b"\n".join(words[i - 1] for i in used[1:].tolist()), numbers.tobytes(), weights.astype(np.int64).tobytes()


def merged(blobs: list[tuple[bytes, bytes, bytes]]) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """The suffixes of several blocks with common word numbers; they are in no order."""
    lists = [x.split(b"\n") if x else [] for x, _, _ in blobs]
    words = sorted(set(chain.from_iterable(lists)))
    number = {w: i for i, w in enumerate(words, 1)}
    columns, weights = [], []
    for own, (_, data, times) in zip(lists, blobs):
        times = np.frombuffer(times, dtype=np.int64)
        kind = np.uint16 if len(own) + 1 < 1 << 16 else np.uint32
        table = np.array([0, *map(number.__getitem__, own)], dtype=np.uint32)
        columns.append(table[np.frombuffer(data, dtype=kind).reshape(DEPTH, len(times))])
        weights.append(times)
    return words, list(np.concatenate(columns, axis=1)), np.concatenate(weights)


def frequent(columns: list[np.ndarray], weights: np.ndarray, least: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Phrases (word numbers) of at least ``least`` occurrences and their counts: multikey three-way quicksort."""
    todo = [(np.arange(len(weights)), ())]
    while todo:
        rows, prefix = todo.pop()
        depth = len(prefix)
        column = columns[depth][rows]
        if len(rows) <= SMALL:  # small partitions: all words at once
            order = np.argsort(column, kind="stable")
            column, rows = column[order], rows[order]
            starts = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
            totals = np.add.reduceat(weights[rows], starts)
            ends = np.append(starts[1:], len(rows))
            equal = [(int(column[starts[i]]), rows[starts[i] : ends[i]], int(totals[i])) for i in np.flatnonzero(totals >= least)]
        else:
            middle = np.sort(column[:: max(1, len(column) // 64)])
            pivot = int(middle[len(middle) // 2])
            for part in (rows[column < pivot], rows[column > pivot]):
                if len(part) and weights[part].sum() >= least:
                    todo.append((part, prefix))
            same = rows[column == pivot]
            total = int(weights[same].sum())
            equal = [(pivot, same, total)] if total >= least else []
        for word, same, total in equal:
            if word:  # 0 is the end of a piece
                yield (*prefix, word), total
                if depth + 1 < DEPTH:
                    todo.append((same, (*prefix, word)))


def counts(lang: str, blobs: list[tuple[bytes, bytes, bytes]], least: int, edges: list[tuple[bytes, ...]]) -> Iterator[tuple[bytes, int, int]]:
    """Phrase, words and count of a range: the number of all words (no phrase), frequent phrases, and those that begin
    a boundary (``edges``) however often they are here."""
    words, columns, weights = merged(blobs)
    yield b"", 0, int(weights.sum())
    number = {w: i for i, w in enumerate(words, 1)}
    cut = set()
    for edge in edges:
        rows, phrase = np.arange(len(weights)), ()
        for d, word in enumerate(edge):
            if word not in number:  # the end of a piece too
                break
            rows, phrase = rows[columns[d][rows] == number[word]], (*phrase, number[word])
            if len(rows) and phrase not in cut:
                cut.add(phrase)
                yield b" ".join(edge[: d + 1]), d + 1, int(weights[rows].sum())
    for phrase, total in frequent(columns, weights, least):
        if phrase not in cut:
            yield b" ".join(words[i - 1] for i in phrase), len(phrase), total


def boundaries(rows: DataFrame, size: int = RANGE, looks: int = LOOKS) -> list[tuple]:
    """Language and words of the first suffix of every range but the first one, in order.

    The text is looked at in a place of every ``size / looks`` characters; equal places count once. ``looks`` suffixes
    for each range of ``size`` characters go to the driver, and one of them is kept.
    """
    step = max(1, size // looks)
    starts = F.sequence(F.pmod(F.xxhash64("t"), F.lit(step)) + 1, F.length("t").cast("long"), F.lit(step).cast("long"))
    starts = F.when(F.pmod(F.xxhash64("t"), F.lit(step)) < F.length("t"), starts).otherwise(F.array().cast("array<bigint>"))
    some = rows.select("lang", F.explode(F.transform(starts, lambda i: F.substring("t", i, F.lit(SNIPPET)))).alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, data in zip(batch.column(0).to_pylist(), common.as_bytes(batch.column(1))):
                first = next((x for x in pieces(data.partition(b" ")[2]) if x), [])[:DEPTH]
                out.append((lang, *first, *[b""] * (DEPTH - len(first))))
            columns = list(zip(*out)) or [()] * (DEPTH + 1)
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["lang", *[f"w{d}" for d in range(DEPTH)]])

    found = common.map_in_arrow(some, run, ", ".join(["lang string", *[f"w{d} binary" for d in range(DEPTH)]])).distinct()
    sample = sorted((x.lang.encode(), *[bytes(w) for w in x[1:]]) for x in found.toLocalIterator())
    ranges = len(sample) // looks
    return sorted({sample[i * len(sample) // (ranges + 1)] for i in range(1, ranges + 1)})


def _route(edges: list[tuple]):
    langs = [x[0] for x in edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for lang in sorted(set(names)):
                lo, hi = bisect_left(langs, lang.encode()), bisect_right(langs, lang.encode())
                mine = batch.column(1).filter(pa.array([x == lang for x in names]))
                for data in slices(common.as_bytes(mine)):
                    words, columns, weights = suffixes(data)
                    cuts = [0, *[place(words, columns, edge[1:]) for edge in edges[lo:hi]], len(weights)]
                    out = [(lo + i, lang, *packed(words, columns[:, a:b], weights[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                    columns = list(zip(*out)) or [()] * 5
                    kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "lang", "words", "data", "times"])
            common.give_back()

    return run


def _count(edges: list[tuple], least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, blobs = None, []

        def closed() -> Iterator[pa.RecordBatch]:
            bucket, lang = place
            near = [x[1:] for x in edges[max(0, bucket - 1) : bucket + 1] if x[0] == lang.encode()]
            found = list(counts(lang, blobs, least, near))
            columns = [[lang] * len(found), [p.decode() for p, _, _ in found], [d for _, d, _ in found], [n for _, _, n in found]]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "phrase", "d", "f"])

        for batch in batches:
            for i in range(batch.num_rows):
                bucket, lang, *blob = [c[i].as_py() for c in batch.columns]
                if (bucket, lang) != place:
                    if blobs:
                        yield from closed()
                    place, blobs = (bucket, lang), []
                    common.give_back()
                blobs.append(tuple(blob))
        if blobs:
            yield from closed()

    return run


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, size: int = RANGE) -> DataFrame:
    """``lang``, ``phrase``, ``d`` (words) and ``f`` of all phrases of 1 to ``DEPTH`` words that occur at least ``least``
    times in a language, and with an empty phrase and ``d`` 0 the number of all its words.

    A null language is ``und``; a null or empty text has no words. Repeated rows count each. An empty table gives an
    empty one; other columns are not read.
    """
    rows = docs.select(F.coalesce(docs[lang].cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(docs[text], F.lit("")).alias("t"))
    edges = boundaries(rows, size)
    blobs = common.map_in_arrow(rows, _route(edges), "bucket bigint, lang string, words binary, data binary, times binary")
    blobs = blobs.repartition("bucket").sortWithinPartitions("bucket", "lang")
    parts = common.map_in_arrow(blobs, _count(edges, least), "lang string, phrase string, d int, f bigint")
    found = parts.groupBy("lang", "phrase", "d").agg(F.sum("f").alias("f"))
    return found.filter((F.col("d") == 0) | (F.col("f") >= least))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, size: int = RANGE) -> DataFrame:
    """The first ``top`` phrases of each language by score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    ``a`` is the count of the phrase, ``n`` that of all words, ``l`` and ``r`` those of its two parts where they are cut so
    that the score, 1000 a n / (l r) rounded down, is least (at the first such place). Phrases whose words stand in a longer
    one of the same count are left out. Ties go to the larger ``a``, then to the phrase first in UTF-8. See ``phrases`` for
    words, nulls and repeated rows. An empty table gives an empty one.
    """
    found = common.written(phrases(docs, text, lang, least, size), "phrases")
    total = found.filter("d = 0").select(F.col("lang").alias("nl"), F.col("f").alias("n"))
    known = found.filter("d > 0").select(F.col("lang").alias("pl"), F.col("phrase").alias("p"), F.col("f").alias("pf"))
    long = found.filter("d > 1").withColumn("w", F.split("phrase", " "))
    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    # A longer phrase of the same count exists only if there is one with one word more.
    inner = long.filter("d > 2").select(F.col("lang").alias("il"), F.explode(F.array(part(F.lit(1), F.col("d") - 1), part(F.lit(2), F.col("d") - 1))).alias("ip"), "f")
    inner = inner.groupBy("il", "ip").agg(F.max("f").alias("longer"))
    long = long.join(inner, (F.col("lang") == F.col("il")) & (F.col("phrase") == F.col("ip")), "left").filter("longer IS NULL OR longer < f")
    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("d") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("d") - F.col("k")).alias("right"))
    side = lambda rows, name, as_: rows.join(known, (F.col("lang") == F.col("pl")) & (F.col(name) == F.col("p"))).withColumnRenamed("pf", as_).drop("pl", "p", name)
    cuts = side(side(cuts, "left", "l"), "right", "r").join(total, F.col("lang") == F.col("nl")).drop("nl")
    best = cuts.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    best = best.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(common.table(spark, folder, "documents"))


SQL = """
WITH words AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, w, i, unnest(range(1, 6)) AS d FROM spots),
counted AS (
  SELECT lang, array_to_string(w[i:i + d - 1], ' ') AS phrase, d, count(*)::HUGEINT AS f
  FROM grams WHERE i + d - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
split AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE d > 1),
inner_ones AS (
  SELECT lang, unnest([array_to_string(w[1:d - 1], ' '), array_to_string(w[2:d], ' ')]) AS phrase, f FROM split),
longer AS (SELECT lang, phrase, max(f) AS f FROM inner_ones GROUP BY lang, phrase),
cuts AS (
  SELECT s.lang, s.phrase, s.f AS a, k, array_to_string(w[1:k], ' ') AS one, array_to_string(w[k + 1:d], ' ') AS two
  FROM (SELECT *, unnest(range(1, d)) AS k FROM split) AS s LEFT JOIN longer AS g ON g.lang = s.lang AND g.phrase = s.phrase
  WHERE g.f IS NULL OR g.f < s.f),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n, (1000 * c.a * n) // (x.f * y.f) AS score
  FROM cuts AS c JOIN counted AS x ON x.lang = c.lang AND x.phrase = c.one JOIN counted AS y ON y.lang = c.lang AND y.phrase = c.two
  JOIN total AS t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best) WHERE rank <= 2000"""

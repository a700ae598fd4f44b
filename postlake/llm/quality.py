"""Quality rules: base counts of words, symbols and repeats, and zstandard compression bands."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import common

#: (bytes below which the band holds, least ratio, largest ratio); a ratio is raw size by compressed size.
#: Short texts compress little because of the frame and the empty window, so their limits are lower.
BANDS = (
    (256, 0.80, 2.6),
    (1024, 1.05, 3.0),
    (4096, 1.20, 3.4),
    (16384, 1.35, 3.8),
    (float("inf"), 1.45, 4.6),
)
CHUNK_BYTES = 4096
MAX_BAD_SHARE = 0.3
LEVEL = 3
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\r\x0b\f"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = "struct<" + ",".join(f"{x}:bigint" for x in _COUNTS) + ",base_failed:boolean,kept:boolean,ratio:double,n_chunks:bigint,n_bad_chunks:bigint>"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur at least twice in the text, the first occurrence included.

    Equal windows get equal ranks by doubling: the rank of 2k words is that of the pair of its halves. Exact.
    """
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    if len(seen) == n:
        return 0
    width = 1
    while width < window:
        step = min(width, window - width)
        pairs = rank[: len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        distinct, rank = np.unique(pairs, return_inverse=True)
        width += step
        if len(distinct) == len(rank):
            return 0
    often = np.flatnonzero(np.bincount(rank)[rank] > 1)
    covered = np.zeros(n + 1, dtype=np.int64)
    np.add.at(covered, often, 1)
    np.add.at(covered, often + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def band(size: int, bands=BANDS) -> tuple[float, float]:
    return next((low, high) for below, low, high in bands if size < below)


def chunks(data: bytes, size: int) -> list[bytes]:
    """Fixed chunks; a rest of less than half a chunk stays with the chunk before it."""
    if not data:
        return []
    count = max(1, (len(data) + size // 2) // size)
    return [data[i * size : (i + 1) * size if i < count - 1 else len(data)] for i in range(count)]


def outside(data: bytes, compressor, bands) -> tuple[float, bool]:
    ratio = len(data) / len(compressor.compress(data))
    low, high = band(len(data), bands)
    return ratio, not low <= ratio <= high


def measure(data: bytes, compressor, bands=BANDS, chunk_bytes=CHUNK_BYTES, max_bad_share=MAX_BAD_SHARE) -> tuple:
    """All values of one text, in the order of ``RESULT``."""
    words = data.split()
    spaces = len(data) - len(data.translate(None, _SPACES))
    continued = len(data.translate(None, bytes(range(0x80, 0xC0))))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    n_repeat = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * n_repeat > MAX_REPEATED_PERCENT * len(words)
    ratio, whole_out = outside(data, compressor, bands) if data else (0.0, True)
    parts = chunks(data, chunk_bytes)
    bad = int(whole_out) if len(parts) == 1 else sum(outside(x, compressor, bands)[1] for x in parts)
    kept = not failed and not whole_out and bad <= max_bad_share * len(parts)
    return (
        len(words), continued - spaces, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), n_repeat,
        failed, kept, ratio, len(parts), bad,
    )


def verdict(text: Column | str, bands=BANDS, chunk_bytes: int = CHUNK_BYTES, max_bad_share: float = MAX_BAD_SHARE, level: int = LEVEL) -> Column:
    """Counts and verdict of each whole text as a struct (see ``RESULT``).

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in 8-word windows that occur again.
    ``kept``: not ``base_failed``, the whole text compresses within the band of its length, and at most
    ``max_bad_share`` of its chunks lie outside the band of theirs. Too high a ratio is repetition, too low a
    ratio is noise. Null counts as the empty text: no words, ``base_failed``, not kept. Texts of any length are
    read whole; other columns, ties and repeated rows play no part, as each row is judged alone.
    """

    def run(texts: pa.Array) -> pa.Array:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=level)
        rows = [measure(x, compressor, bands, chunk_bytes, max_bad_share) for x in common.as_bytes(texts)]
        common.give_back()
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2
        names = [*_COUNTS, "base_failed", "kept", "ratio", "n_chunks", "n_bad_chunks"]
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return common.struct_column(common.arrow_udf(run, RESULT), text)


def keep_good(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with their columns unchanged."""
    return docs.filter(verdict(docs[text], **limits)["kept"])


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    seen = docs.select("doc_id", verdict(docs["text"]).alias("q"))
    return seen.select("doc_id", *[f"q.{x}" for x in (*_COUNTS, "base_failed", "kept", "n_chunks", "n_bad_chunks")])

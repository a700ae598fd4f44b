"""Token ids as flat binary files with 64-bit document offsets.

Format, for each part ``p`` of a folder (all integers little-endian):

* ``tokens-<p>-<attempt>.bin``  ids of all documents of the part, unsigned 16-bit if every id fits, else 32-bit;
* ``docs-<p>-<attempt>.bin``    signed 64-bit key of each document (the least integer stands for a null key);
* ``lengths-<p>-<attempt>.bin`` unsigned 64-bit count of ids of each document;
* ``offsets-<p>-<attempt>.bin`` unsigned 64-bit start of each document among the ids of *all* parts, and the end.

Parts follow each other in key order. The table ``manifest`` names the files of each part with its counts and base.
A task that runs again writes files of its own, and only those of the attempt that Spark accepted are in the manifest.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm import common

VOCABULARY = "word_bpe_49k.json"
END = 2
#: Words, and units of words, that a Python worker keeps; beyond that, new ones are kept for their block of texts only.
MEMO = 400_000
#: Splitting of lower-cased printable ASCII words into units, for the rules of the vocabulary files known to be split so.
_CASELESS = """'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+"""
ASCII_RULES = {
    (
        json.dumps({"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}),
        json.dumps({"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ]}),
    ): re.compile(_CASELESS).findall,
}
#: Ids read at once.
BLOCK = 4_000_000
NULL_KEY = -(2**63)
_PART = "part int, tokens string, docs string, lengths string, width int, n_docs bigint, n_tokens bigint"


def _open(path: str):
    """The file system of a path or address, and the path in it. Local ones need no driver; others go through Arrow."""
    from pyarrow import fs

    place = urlparse(path)
    if place.scheme in ("", "file"):
        return None, place.path
    return fs.FileSystem.from_uri(path)


def _write(path: str, write) -> None:
    system, name = _open(path)
    if system is None:
        os.makedirs(os.path.dirname(name), exist_ok=True)
        with open(name, "wb") as out:
            write(out)
    else:
        system.create_dir(os.path.dirname(name), recursive=True)
        with system.open_output_stream(name) as out:
            write(out)


def _map(path: str, dtype: str) -> np.ndarray:
    """The integers of a file, memory-mapped where the file system is local or mounted."""
    system, name = _open(path)
    if system is None:
        return np.memmap(name, dtype=dtype, mode="r") if os.path.getsize(name) else np.empty(0, dtype=dtype)
    with system.open_input_file(name) as source:
        return np.frombuffer(source.read(), dtype=dtype)


class WordCoder:
    """Encoding with the tokenizers library, once for each word that a Python worker has not kept.

    Right for vocabularies that drop white space: no token, merge or rule reaches across the six ASCII spaces, so the
    ids of a text are those of its words in order. Words of printable ASCII go to the library's merges as the units
    its rules would split them into; all others go through the library whole.
    """

    def __init__(self, path: str, memo: int = MEMO):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merge = self.library.model.tokenize
        self.code, self.dtype = ("H", "<u2") if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else ("I", "<u4")
        self.special = re.compile("|".join(re.escape(x["content"]) for x in spec["added_tokens"]) or "(?!)").search
        self.plain = ASCII_RULES.get((json.dumps(spec["normalizer"]), json.dumps(spec["pre_tokenizer"])))
        self.memo: dict[bytes, bytes] = {}
        self.units: dict[str, bytes] = {}
        self.most = memo

    def unit(self, unit: str) -> bytes:
        got = array(self.code, [x.id for x in self.merge(unit)]).tobytes()
        if len(self.units) < self.most:
            self.units[unit] = got
        return got

    def new(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words."""
        found, others, known = {}, [], self.units.get
        for word in words:
            if self.plain and word.isascii() and (text := word.decode()).isprintable() and not self.special(text):
                found[word] = b"".join([known(x) or self.unit(x) for x in self.plain(text.lower())])
            else:
                others.append(word)
        for at in range(0, len(others), 5000):
            some = others[at : at + 5000]
            coded = self.library.encode_batch_fast([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)
            found.update((w, array(self.code, x.ids).tobytes()) for w, x in zip(some, coded))
        return found

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text."""
        for some in common.blocks(texts):
            rows = [x.split() for x in some]
            memo = self.memo
            found = self.new(list({w for row in rows for w in row if w not in memo}))
            if len(memo) < self.most:
                memo.update(found)
                found = {}
            if found:
                get, other = memo.get, found.get
                yield from (b"".join([get(w) or other(w) for w in row]) for row in rows)
            else:
                yield from (b"".join([memo[w] for w in row]) for row in rows)


_coders: dict[str, WordCoder] = {}


def coder_of(path: str) -> WordCoder:
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


def write_tokens(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", path: str | None = None, end: int = END, parts: int | None = None) -> DataFrame:
    """Encode every whole text and write the ids to ``folder`` in ascending key order; returns the manifest.

    Null texts count as empty: they have the end id alone. Rows with equal keys are all written, ordered by text, and
    spread over several parts if there are many; null keys come first. An empty table gives an empty manifest. Other
    columns are not read. ``parts`` is the number of range partitions (default: the session's shuffle partitions).
    """
    spark = docs.sparkSession
    path = path or common.tokenizer_path(VOCABULARY)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        context = TaskContext.get()
        coder = coder_of(path)
        tail = np.array([end], dtype=coder.dtype).tobytes()
        keys, lengths, width = [], [], np.dtype(coder.dtype).itemsize
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}.bin"

        def tokens(out) -> None:
            for batch in batches:
                keys.append(np.array([NULL_KEY if x is None else x for x in batch.column(0).to_pylist()], dtype="<i8"))
                sizes = []
                for ids in coder.encode(common.as_bytes(batch.column(1))):
                    out.write(ids)
                    out.write(tail)
                    sizes.append(len(ids) // width + 1)
                lengths.append(np.array(sizes, dtype="<u8"))

        _write(f"{folder}/tokens-{name}", tokens)
        if not keys:
            return
        counts = np.concatenate(lengths)
        _write(f"{folder}/docs-{name}", lambda out: out.write(np.concatenate(keys).tobytes()))
        _write(f"{folder}/lengths-{name}", lambda out: out.write(counts.tobytes()))
        row = [context.partitionId(), f"tokens-{name}", f"docs-{name}", f"lengths-{name}", width, len(counts), int(counts.sum())]
        names = [x.split()[0] for x in _PART.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, [pa.int32(), *[pa.string()] * 3, pa.int32(), pa.int64(), pa.int64()])], names)

    rows = docs.select(docs[key].cast("long").alias("k"), docs[text].alias("t"))
    order = rows.repartitionByRange(parts, F.col("k"), F.xxhash64("t")).sortWithinPartitions("k", F.xxhash64("t"), "t")
    common.map_in_arrow(order, encode, _PART).write.mode("overwrite").parquet(f"{folder}/parts")

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = spark.read.schema(_PART).parquet(f"{folder}/parts").withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = []
            for row in batch.to_pylist():
                counts = _map(f"{folder}/{row['lengths']}", "<u8")
                starts = row["base"] + np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
                names.append(row["lengths"].replace("lengths-", "offsets-"))
                _write(f"{folder}/{names[-1]}", lambda out, s=starts: out.write(s.astype("<u8").tobytes()))
            yield batch.append_column("offsets", pa.array(names, pa.string()))

    spread = bases.repartition(parts, "part")  # the bases come from one task, the files from many
    common.map_in_arrow(spread, offsets, _PART + ", base bigint, offsets string").write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_PART + ", base bigint, offsets string").parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str, parts: int | None = None) -> DataFrame:
    """Every document of the files: key, start, and its ids as little-endian unsigned 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = _map(f"{folder}/{row['tokens']}", f"<u{row['width']}")
                keys = _map(f"{folder}/{row['docs']}", "<i8")
                starts = _map(f"{folder}/{row['offsets']}", "<u8").astype(np.int64)
                at = 0
                while at < len(keys):
                    upto = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK, side="right")) - 1)
                    upto = min(upto, len(keys))
                    cut = starts[at : upto + 1] - row["base"]
                    block = np.asarray(ids[cut[0] : cut[-1]]).astype("<u4").tobytes()
                    cut = 4 * (cut - cut[0])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[at:upto], pa.int64(), mask=keys[at:upto] == NULL_KEY),
                        pa.array(starts[at:upto], pa.int64()),
                        pa.array([block[a:b] for a, b in zip(cut, cut[1:])], pa.binary()),
                    ], ["doc_id", "start", "ids"])
                    at = upto

    manifest = read_manifest(spark, folder)
    spread = manifest.repartition(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
    return common.map_in_arrow(spread, read, "doc_id bigint, start bigint, ids binary")


def query(spark: SparkSession, folder: str) -> DataFrame:
    files = common.working_folder(spark, "tokens")
    write_tokens(common.table(spark, folder, "documents"), files)
    return read_tokens(spark, files).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
    )

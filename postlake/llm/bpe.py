"""Byte-level BPE by forced boundaries: encoding to ids and decoding back."""

from __future__ import annotations

import functools
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import common

VOCABULARY = "byte_bpe_50k.json"
#: How the byte-level pre-tokenizer splits text; fixed by the vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Blocks whose letters and numbers have long been settled. Texts with others are split by the library, as its
#: Unicode tables and those of the regex package may be of different versions.
SETTLED = "\x00-ԯ‐-₀　-鿿가-힣＀-￯\U0001f000-\U0001faff"
#: Pretokens kept in the memo of a task; it starts anew beyond that, so memory stays bounded.
MEMO = 200_000


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary: itself where printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Coder:
    """Encoding and decoding with one vocabulary file; one for each task."""

    def __init__(self, path: str, memo: int = MEMO):
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path = path
        self.letters = byte_letters()
        back = {c: b for b, c in self.letters.items()}
        self.pieces: list[bytes] = [b""] * (1 + max([*spec["model"]["vocab"].values(), *(x["id"] for x in spec["added_tokens"])]))
        inside = np.zeros((256, 256), dtype=bool)
        ranks = {}
        for token, number in spec["model"]["vocab"].items():
            piece = bytes(back[c] for c in token)
            self.pieces[number] = piece
            ranks[piece] = number
            if len(piece) > 1:
                row = np.frombuffer(piece, dtype=np.uint8)
                inside[row[:-1], row[1:]] = True
        #: Pairs of bytes that no token has inside: every merge stops there, so the text can be cut there.
        self.forced = ~inside
        self.stops = [x.tobytes() for x in self.forced]
        # Ids are merge ranks in this vocabulary, so a rank coder with one piece for a whole fragment merges alike.
        self.merge = tiktoken.Encoding("fragments", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        for content, number in self.special.items():
            self.pieces[number] = content.encode()
        self.to_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.split = regex.compile(SPLIT).findall
        self.unsettled = regex.compile(f"[^{SETTLED}]").search
        self.translate = "".join(self.letters[b] for b in range(256))
        self.memo: dict[str, bytes] = {}
        self.most = memo
        self.lengths = np.array([len(x) for x in self.pieces], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.joined = np.frombuffer(b"".join(self.pieces), dtype=np.uint8)

    @functools.cached_property
    def library(self):
        """The library's own tokenizer, which rare texts and fragments go through; loaded when the first one comes."""
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.no_truncation()
        found.no_padding()
        return found

    def pretokens(self, text: str) -> list[str]:
        if self.unsettled(text) is None:
            return self.split(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def cut(self, data: bytes) -> list[bytes]:
        """The fragments between forced boundaries."""
        if len(data) < 64:
            stops = self.stops
            at = [i for i, (a, b) in enumerate(zip(data, data[1:]), 1) if stops[a][b]]
        else:
            row = np.frombuffer(data, dtype=np.uint8)
            at = (np.flatnonzero(self.forced[row[:-1], row[1:]]) + 1).tolist()
        if not at:
            return [data]
        ends = [0, *at, len(data)]
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def fragment(self, data: bytes) -> bytes:
        try:
            ids = self.merge(data.decode())
        except UnicodeDecodeError:  # cut inside a character
            ids = [t.id for t in self.library.model.tokenize(data.decode("latin-1").translate(self.translate))]
        return array("i", ids).tobytes()

    def pretoken(self, text: str) -> bytes:
        parts = self.cut(text.encode())
        got = self.fragment(parts[0]) if len(parts) == 1 else b"".join(map(self.fragment, parts))
        if len(self.memo) >= self.most:
            self.memo.clear()
        self.memo[text] = got
        return got

    def ordinary(self, text: str) -> bytes:
        memo, miss = self.memo.get, self.pretoken
        return b"".join([memo(x) or miss(x) for x in self.pretokens(text)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers. Special strings of the vocabulary are their own tokens."""
        if self.to_special is None or not any(x in text for x in self.special):
            return self.ordinary(text)
        out, done = [], 0
        for found in self.to_special.finditer(text):
            out += [self.ordinary(text[done : found.start()]), np.int32(self.special[found.group()]).tobytes()]
            done = found.end()
        return b"".join([*out, self.ordinary(text[done:])])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all tokens; special ones as their strings."""
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.joined[shift + np.arange(ends[-1])].tobytes()


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def _encoded(texts: pa.Array, own: Coder) -> pa.ListArray:
    coded, ends = bytearray(), [0]
    for text in common.as_texts(texts):
        coded += own.encode(text)
        ends.append(len(coded) // 4)
    ids = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(coded)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)


def _decoded(lists: pa.ListArray, own: Coder) -> pa.StringArray:
    texts, ends = bytearray(), [0]
    for row in lists:
        numbers = row.values.to_numpy() if row.is_valid else np.empty(0, dtype=np.int32)
        texts += own.decode(numbers).decode("utf-8", "replace").encode()
        ends.append(len(texts))
    return pa.StringArray.from_buffers(len(lists), pa.py_buffer(np.array(ends, dtype=np.int32)), pa.py_buffer(texts))


def encode(text: Column | str, path: str | None = None) -> Column:
    """Ids of each whole text, as the tokenizers library gives with ``add_special_tokens=False``.

    Null and empty texts have no ids. Each row is worked alone, so repeated rows, ties and other columns play no part.
    """
    path = path or common.tokenizer_path(VOCABULARY)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in common.slices(batches):
            yield _encoded(texts, coder(path))

    return common.struct_column(common.arrow_udf(run, "array<int>"), text)


def decode(ids: Column | str, path: str | None = None) -> Column:
    """The text of each list of ids; bytes that are no UTF-8 become U+FFFD. Null gives the empty text."""
    path = path or common.tokenizer_path(VOCABULARY)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in common.slices(batches):
            yield _decoded(lists, coder(path))

    return common.struct_column(common.arrow_udf(run, "string"), ids)


def round_trip(text: Column | str, path: str | None = None) -> Column:
    """``encode`` and ``decode`` of each text as a struct (``ids``, ``decoded``), in one Python worker instead of two.

    Ids take more bytes than the text. Results go out slice by slice, so no task holds those of a whole batch.
    """
    path = path or common.tokenizer_path(VOCABULARY)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in common.slices(batches):
            ids = _encoded(texts, coder(path))
            yield pa.StructArray.from_arrays([ids, _decoded(ids, coder(path))], ["ids", "decoded"])
        common.give_back()

    return common.struct_column(common.arrow_udf(run, "struct<ids:array<int>,decoded:string>"), text)


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key``, ids and decoded text of each row."""
    coded = docs.select(docs[key], round_trip(docs[text], path).alias("coded"))
    return coded.select(coded[key], "coded.ids", "coded.decoded")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return digest(encoded(common.table(spark, folder, "documents")))


def digest(coded: DataFrame, *more: str) -> DataFrame:
    """Count and digests of what ``encoded`` gives, and the columns named."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *more,
    )

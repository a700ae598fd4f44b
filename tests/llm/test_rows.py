"""Operators that judge each row alone: quality rules, BPE, token counts, token files."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlake.llm import bpe, common, quality, queries, tokenfiles, unigram

ODD = [None, "", " ", "\n\t", "a", "a a " * 30, "É é ́ 漢字՘\U0001f600 x", "<|endoftext|> it's 'S <|startoftext|>", "b" * 3000, "İ ΣΑΣ a\x1cb\x0bc"]


def rows(df, *names):
    return {r[0]: r[1:] for r in df.select(*names).collect()}


def plain_quality(text):
    words = re.findall(common.WORD_PATTERN, text)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    often = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(common.WORD_PATTERN, x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 20 or 100 * len(often) > 30 * len(words)
    data = text.encode()

    def bad(x):
        ratio = len(x) / len(zstandard.ZstdCompressor(level=3).compress(x))
        low, high = [(a, b) for n, a, b in quality.BANDS if len(x) < n][0]
        return not low <= ratio <= high

    size = quality.CHUNK_BYTES
    parts = [data[i : i + size] for i in range(0, len(data), size)]
    if len(parts) > 1 and len(parts[-1]) < size / 2:
        parts[-2:] = [parts[-2] + parts[-1]]
    kept = not failed and not bad(data) and sum(map(bad, parts)) <= quality.MAX_BAD_SHARE * len(parts)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(often), failed, kept


def test_quality_equals_plain(spark, folder, texts):
    got = rows(queries.QUERIES["op7_quality"](spark, folder), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert got == {k: plain_quality(v) for k, v in texts.items()}


def test_quality_of_odd_texts(make):
    got = rows(make(ODD).select("doc_id", quality.verdict("text").alias("q")).select("doc_id", "q.*"), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert got == {i: plain_quality(t or "") for i, t in enumerate(ODD)}


def test_quality_bands(make):
    rng = random.Random(1)
    prose = " ".join("".join(rng.choice(["the", "ar", "ing", "o", "st", "en"]) for _ in range(rng.randint(1, 4))) for _ in range(900))
    noise = " ".join("".join(chr(rng.randint(33, 126)) for _ in range(40)) for _ in range(300))
    stutter = " ".join(f"{w} " * 7 for w in prose.split())
    assert [r.text for r in quality.keep_good(make([prose, noise, stutter, None])).collect()] == [prose]


def test_quality_keeps_columns_and_empty_tables(make):
    docs = make(["word " * 3]).withColumn("kept", F.lit(1)).withColumn("ratio", F.lit(2))
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(docs.limit(0)).collect() == []


@pytest.mark.parametrize("column", [lambda c: bpe.encode(c), lambda c: unigram.counts(c), lambda c: quality.verdict(c)])
def test_columns_on_an_empty_table(make, column):
    assert make(["x"]).limit(0).select(column("text")).collect() == []


def test_bpe_equals_library(spark, folder, texts, make):
    library = Tokenizer.from_file(common.tokenizer_path(bpe.VOCABULARY))

    def plain(text):
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    names = "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    assert rows(queries.QUERIES["op6_bpe"](spark, folder), *names) == {k: plain(v) for k, v in texts.items()}
    assert rows(bpe.digest(bpe.encoded(make(ODD))), *names) == {i: plain(t or "") for i, t in enumerate(ODD)}


def test_decoding_by_itself(make):
    df = make(ODD).select("doc_id", bpe.encode("text").alias("ids")).select("doc_id", bpe.decode("ids").alias("back"))
    assert rows(df, "doc_id", "back") == {i: (t or "",) for i, t in enumerate(ODD)}


def test_bpe_results_go_out_in_slices(monkeypatch):
    monkeypatch.setattr(common, "arrow_udf", lambda run, kind: lambda *columns: run)
    texts = pa.array([f"text {i}" for i in range(3 * common.SLICE)])
    parts = list(bpe.round_trip("text")(iter([texts, texts.slice(0, 0), texts.slice(0, 5)])))
    assert max(map(len, parts)) <= common.SLICE
    assert [x["decoded"] for part in parts for x in part.to_pylist()] == texts.to_pylist() + texts.to_pylist()[:5]


def test_forced_boundaries():
    coder = bpe.Coder(common.tokenizer_path(bpe.VOCABULARY))
    rng = random.Random(2)
    for _ in range(500):
        data = bytes(rng.randrange(256) for _ in range(rng.randint(1, 90)))
        assert b"".join(coder.cut(data)) == data
        whole = [t.id for t in coder.library.model.tokenize(data.decode("latin-1").translate(coder.translate))]
        parts = b"".join(coder.fragment(x) for x in coder.cut(data))
        assert np.frombuffer(parts, dtype=np.int32).tolist() == whole
    assert len(coder.cut("\x00日".encode() * 40)) > 1


def test_unigram_equals_dynamic_programme(spark, folder, texts, make):
    costs, byte_cost = unigram.pieces(common.tokenizer_path(unigram.VOCABULARY))
    longest = max(map(len, costs))

    def best(word):
        table = [(0, 0)] + [None] * len(word)
        for i in range(1, len(word) + 1):
            n = len(word[i - 1].encode())
            options = [] if word[i - 1] in costs else [(table[i - 1][0] + n * byte_cost, table[i - 1][1] + n)]
            options += [(table[j][0] + costs[word[j:i]], table[j][1] + 1) for j in range(max(0, i - longest), i) if word[j:i] in costs]
            table[i] = min(options)
        return table[-1]

    def plain(text):
        words = re.findall(common.WORD_PATTERN, text)
        found = [best("▁" + w) for w in words]
        return len(words), sum(x[1] for x in found), sum(x[0] for x in found)

    some = {k: v for k, v in texts.items() if k % 5 == 0}
    got = rows(queries.QUERIES["op8_token_counts"](spark, folder), "doc_id", "n_words", "n_tokens", "score")
    assert len(got) == len(texts) and all(got[k] == plain(v) for k, v in some.items())
    got = make(ODD).select("doc_id", unigram.counts("text").alias("c")).select("doc_id", "c.*")
    assert rows(got, "doc_id", "n_words", "n_tokens", "score") == {i: plain(t or "") for i, t in enumerate(ODD)}


def plain_files(items):
    library = Tokenizer.from_file(common.tokenizer_path(tokenfiles.VOCABULARY))
    start, out = 0, {}
    for key, text in sorted(items):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out[key] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    return out


def test_token_files_equal_library(spark, folder, texts):
    got = rows(queries.QUERIES["op2_token_files"](spark, folder), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == plain_files(texts.items())


def test_token_files_of_odd_rows(spark, make, tmp_path):
    docs = make(ODD).withColumn("part", F.lit(1)).withColumn("base", F.lit("x"))
    doubled = docs.unionAll(docs.filter("doc_id = 4")).unionAll(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    tokenfiles.write_tokens(doubled, str(tmp_path / "a"), parts=5)
    got = tokenfiles.read_tokens(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 0, 1, 2, 3, 4, 4, 5, 6, 7, 8, 9]
    ends = np.cumsum([len(r.ids) // 4 for r in got])
    assert [r.start for r in got] == [0, *ends[:-1].tolist()]
    assert got[5].ids == got[6].ids and got[0].ids == got[7].ids
    tokenfiles.write_tokens(docs.limit(0), str(tmp_path / "b"))
    assert tokenfiles.read_tokens(spark, str(tmp_path / "b")).collect() == []

"""Collocations: against plain counting, with many ranges, hot words and odd rows."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import collocations, queries


def plain(rows, least=100, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for d in range(1, 6):
                counts[lang].update(tuple(words[i : i + d]) for i in range(len(words) - d + 1))
    out = []
    for lang, found in counts.items():
        often = {p: a for p, a in found.items() if a >= least and len(p) > 1}
        inside = set()
        for longer, f in often.items():
            for i in range(len(longer)):
                for j in range(i + 2, len(longer) + 1):
                    if j - i < len(longer) and 100 * f >= 100 * found[longer[i:j]]:
                        inside.add(longer[i:j])
        rows = []
        for phrase, a in often.items():
            if phrase in inside:
                continue
            cuts = [(Fraction(1000 * a * totals[lang], found[phrase[:k]] * found[phrase[k:]]).__floor__(), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(phrase).encode(), found[phrase[:k]], found[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def texts(rng, n, words):
    common = ["of the", "New York city", "new york", "a b c d e f", "the of"]
    out = []
    for _ in range(n):
        parts = [rng.choice(common) if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randint(0, 60))]
        out.append("".join(p + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  ", "\r\n", "\x0b"]) for p in parts))
    return out


@pytest.mark.parametrize("size, looks, block", [(400, 2, 1 << 22), (3000, 24, 2000), (1 << 24, 24, 1 << 22)])
def test_equals_plain_counting(make, monkeypatch, size, looks, block):
    monkeypatch.setattr(collocations, "BLOCK", block)
    monkeypatch.setattr(collocations, "SMALL", 16)
    monkeypatch.setattr(collocations.boundaries, "__defaults__", (size, looks))
    rng = random.Random(size)
    words = [f"w{i}" for i in range(20)] + ["é", "ÉA", "日本", "\x00", "\x1f", "the", "of", "x\xa0y"]
    found = texts(rng, 120, words) + [None, "", "the of " * 4000, "x" * 9000, "of the. " * 500]
    langs = [rng.choice(["en", "de", None, "und", ""]) for _ in found]
    docs = make(found).drop("lang").join(make(found).sparkSession.createDataFrame(list(enumerate(langs)), "doc_id long, lang string"), "doc_id")
    docs = docs.withColumn("phrase", F.lit("x")).withColumn("w", F.lit(1)).withColumn("t", F.lit(1))
    rows = [(r.lang, r.text) for r in docs.collect()]
    if size < 1000:
        assert len(collocations.boundaries(docs.select("lang", F.coalesce("text", F.lit("")).alias("t")).fillna("und"), size)) > 20
    for least, top in ((5, 40), (100, 2000)):
        assert got(collocations.collocations(docs, least=least, top=top, size=size)) == plain(rows, least, top)


def test_query_equals_plain(spark, folder):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()]
    found = got(queries.QUERIES["op12_collocations"](spark, folder))
    assert found and found == plain(rows)


def test_quicksort_counts_what_is_frequent():
    rng = np.random.default_rng(2)
    columns = [rng.integers(0, 6, 20_000) for _ in range(5)]
    weights = rng.integers(1, 4, 20_000)
    want = Counter()
    for row, w in zip(zip(*[c.tolist() for c in columns]), weights.tolist()):
        for d in range(1, 6):
            if 0 in row[:d]:
                break
            want[row[:d]] += w
    assert dict(collocations.frequent(columns, weights, 50)) == {p: n for p, n in want.items() if n >= 50}


def test_scores_beyond_64_bits(spark, make):
    """The counts are as of a large corpus: what comes after them is exact."""
    assert 1000 * 10**12 * 10**14 > 2**63
    row = spark.range(1).selectExpr("1000000000000L AS a", "100000000000007L AS n", "3000000000001L AS l", "2000000000003L AS r")
    assert row.selectExpr(f"{collocations.SCORE} AS s").first().s == 1000 * 10**12 * 100000000000007 // (3000000000001 * 2000000000003)


def test_empty_table_and_empty_texts(make):
    assert got(collocations.collocations(make([]))) == []
    assert got(collocations.collocations(make([None, "", " . "]), least=1)) == []

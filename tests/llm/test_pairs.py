"""Near duplicates, passages and components: against plain Python and on planted rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import circulant, common, neardup, passages, queries
from postlake.llm.components import components


def vocabulary(seed, n=4000):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def plain_sets(texts, length):
    out = {}
    for key, text in texts.items():
        words = re.findall(common.WORD_PATTERN, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        out[key] = {tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1))} if words else set()
    return out


def plain_components(texts, length=3, percent=85):
    sets = plain_sets(texts, length)
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                a2, b2 = find(a), find(b)
                root[max(a2, b2)] = min(a2, b2)
    return {k: (len(sets[k]), find(k), find(k) == k) for k in keys}


def got(df, key="doc_id"):
    return {r[key]: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_near_duplicates_equal_plain(spark, folder, texts):
    assert got(queries.QUERIES["op10_near_duplicates"](spark, folder)) == plain_components(texts)


def test_a_large_group_of_near_copies(make, monkeypatch):
    """Copies of one text with few to many changes: most pairs are near the limit, and the text itself is not there."""
    monkeypatch.setattr(neardup.dealt, "__defaults__", (16,))
    rng = random.Random(4)
    words = vocabulary(1)
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for _ in range(120):
        copy = base[:]
        for i in rng.sample(range(150), rng.randint(1, 9)):
            copy[i] = rng.choice(words)
        rows.append(" ".join(copy))
    rows += [" ".join(rng.choice(words) for _ in range(60)) for _ in range(40)]
    want = plain_components(dict(enumerate(rows)))
    assert len({c for _, c, _ in want.values()}) > 60
    assert got(neardup.near_duplicates(make(rows))) == want


def test_near_duplicates_of_odd_rows(make):
    texts = ["a b c d", "A  b\nc d", None, "", "", "a", "A", "a b", "x y z", "x y z", "x" * 5000, "a a a a a a", "a a a"]
    docs = make(texts).withColumn("id", F.lit(1)).withColumn("rep", F.lit(1)).withColumn("g", F.lit(1))
    docs = docs.unionAll(docs.filter("doc_id = 8")).unionAll(docs.filter("doc_id = 8").withColumn("doc_id", F.lit(None).cast("long")))
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == 15
    want = plain_components(dict(enumerate(texts))) | {None: (1, None, True)}
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == want
    kept = neardup.keep_one(docs, length=3, percent=85)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, x) for x in (0, 2, 3, 4, 5, 7, 8, 10, 11)] + [(True, 0)]
    assert neardup.near_duplicates(docs.limit(0)).collect() == [] and neardup.keep_one(docs.limit(0)).collect() == []


def test_rows_with_one_key_are_one_document(make):
    docs = make(["a b c d e f", "q r s t u v", "q r s t u v", "a b c d e f"]).withColumn("doc_id", F.expr("CASE doc_id WHEN 1 THEN 0 ELSE doc_id END"))
    rows = neardup.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in rows} == {0: 0, 2: 0, 3: 0}
    assert [r.doc_id for r in neardup.keep_one(docs, length=3).collect()] == [0]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    for share in (0.5, 0.8):
        both = rng.integers(0, 2**63, 400, dtype=np.uint64)
        n = int(400 * (1 - share) / (2 * share))
        a, b = (np.concatenate([both, rng.integers(0, 2**63, n, dtype=np.uint64)]) for _ in range(2))
        same = (circulant.signature(a, 8) == circulant.signature(b, 8)).mean()
        assert abs(same - 400 / (400 + 2 * n)) < 0.08


def test_bands_follow_the_similarity():
    assert [circulant.rows_for(s) for s in (0.85, 0.8)] == [8, 6]
    assert all((1 - s ** circulant.rows_for(s)) ** circulant.BANDS <= 1e-6 for s in (0.5, 0.7, 0.8, 0.85, 0.95))


def test_components_of_paths_and_stars(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, 1000 + i) for i in range(50)] + [(7000, 6999), (None, 3)]
    edges += [(rng.randint(2000, 2200), rng.randint(2000, 2200)) for _ in range(150)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.id: r.component for r in found.collect()} == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_passages_on_planted_rows(make):
    rng = random.Random(8)
    words = vocabulary(2)
    some = lambda n: [rng.choice(words) for _ in range(n)]
    passage = some(80)
    fuzzy = passage[:]
    fuzzy[20] = "changed"
    del fuzzy[45]
    fuzzy.insert(60, "put in")
    first = some(300) + passage + some(100)
    rows = [
        " ".join(first), " ".join(some(50) + passage + some(70)), " ".join(some(40) + fuzzy + some(10)).upper(), " ".join(some(400)),
        " ".join(some(30) + passage[:40] + some(100)), None, "", "a " * 3000, "a " * 2500, " ".join(first), "short",
    ]
    docs = make(rows).withColumn("k", F.lit(1)).withColumn("lo", F.lit(1)).withColumn("source_id", F.lit(1))
    docs = docs.unionAll(docs.filter("doc_id = 1")).unionAll(docs.filter("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long")))
    found = {}
    for r in passages.passages(docs).collect():
        found.setdefault((r.doc_id, r.source_id), []).append((r.start, r.end, r.source_start, r.source_end, r.n_equal))
    assert found[1, 0] == [(50, 130, 300, 380, 80)]
    assert found[2, 0] == [(40, 121, 300, 380, 78)]
    assert found[9, 0] == [(0, 480, 0, 480, 480)]
    assert (8, 7) in found and not any(a in (0, 3, 4, 5, 6, 10, None) for a, _ in found)
    assert passages.passages(docs.limit(0)).collect() == []


def test_passages_with_a_gap_between_them(make):
    """Two equal passages, 30 to 75 differing words apart: one row for both if 0.8 of it is equal, else each by itself."""
    rng = random.Random(12)
    words = vocabulary(5)
    some = lambda n: [rng.choice(words) for _ in range(n)]
    other = lambda n, sign: [f"{sign}{rng.random()}" for _ in range(n)]
    rows, want, whole = [], {}, {}
    for gap in (10, 20, 30, 35, 50, 75):
        for a, b in ((60, 60), (60, 140), (150, 70)):
            one, two, near = some(a), some(b), len(rows)
            rows.append(" ".join(["x"] + one + other(gap, "p") + two + ["y"]))
            rows.append(" ".join(["u"] + one + other(gap, "q") + two + ["v"]))
            want[near + 1] = [(1, 1 + a, a), (1 + a + gap, 1 + a + gap + b, b)]
            if a + b >= 0.8 * (a + gap + b):
                whole[near + 1] = [(1, 1 + a + gap + b, a + b)]
    found = {}
    for r in passages.passages(make(rows)).collect():
        assert (r.source_id, r.source_start, r.source_end) == (r.doc_id - 1, r.start, r.end)
        found.setdefault(r.doc_id, []).append((r.start, r.end, r.n_equal))
    # Where the gap costs more than the seeds of a part are worth, the parts are chains of their own.
    assert all(sorted(found.get(k, [])) in ([v] if k not in whole else [v, whole[k]]) for k, v in want.items())
    assert set(found) == set(want) and any(found[k] == v for k, v in whole.items())


def test_alike_passages_are_all_and_longest():
    rng = random.Random(13)
    for _ in range(300):
        runs, x, y = [], 0, 0
        for _ in range(rng.randint(0, 12)):
            x, y, n = x + rng.randint(0, 20), y + rng.randint(0, 20), rng.randint(1, 60)
            runs.append((x, y, n))
            x, y = x + n, y + n
        good = []
        for i in range(len(runs)):
            for j in range(i, len(runs)):
                s, t, e, f = *runs[i][:2], runs[j][0] + runs[j][2], runs[j][1] + runs[j][2]
                equal = sum(n for _, _, n in runs[i : j + 1])
                if min(e - s, f - t) >= 50 and equal >= 0.8 * max(e - s, f - t):
                    good.append((s, e, t, f, equal))
        longest = [p for p in good if not any(q != p and q[0] <= p[0] and p[1] <= q[1] for q in good)]
        assert list(passages.alike(runs, 50, 0.8)) == longest


def plain_chain_score(points):
    points = sorted(set(points))
    best = []
    for i, (x, y) in enumerate(points):
        gain = 0.0
        for j in range(i):
            if points[j][0] < x and points[j][1] < y:
                gain = max(gain, best[j] - passages.GAP_COST * (x - points[j][0] + y - points[j][1]))
        best.append(1 + gain)
    return max(best)


def test_chains_are_best_and_hold_every_match():
    rng = random.Random(9)
    for _ in range(200):
        points = [(rng.randint(0, 30), rng.randint(0, 30)) for _ in range(rng.randint(1, 25))]
        found = list(passages.chains(points, max_gap=10**9))
        assert sorted(p for c in found for p in c) == sorted(set(points))
        cost = lambda c: sum(passages.GAP_COST * (b[0] - a[0] + b[1] - a[1]) for a, b in zip(c, c[1:]))
        assert abs(len(found[0]) - cost(found[0]) - plain_chain_score(points)) < 1e-9
        assert all(a[0] < b[0] and a[1] < b[1] for c in found for a, b in zip(c, c[1:]))


def test_equal_passages_share_a_seed():
    rng = random.Random(10)
    words = [w.encode() for w in vocabulary(3)]
    for _ in range(100):
        passage = [rng.choice(words) for _ in range(passages.K + passages.WINDOW - 1)]
        one, two = ([rng.choice(words) for _ in range(30)] + passage + [rng.choice(words) for _ in range(30)] for _ in range(2))
        assert set(passages.minimizers(one)[0]) & set(passages.minimizers(two)[0])


@pytest.mark.parametrize("size", [1, 5, 70])
def test_extend_reaches_the_end(size):
    a = list(range(size))
    assert passages.extend(a, a, 0, 0) == (size, size, size)


def test_a_chain_is_cut_at_a_long_gap_only():
    points = [(10 * i, 10 * i) for i in range(40)] + [(600 + 10 * i, 600 + 10 * i) for i in range(20)]
    assert [(c[0][0], c[-1][0]) for c in passages.chains(points, max_gap=48)] == [(0, 390), (600, 790)]
    assert len(list(passages.chains(points, max_gap=300))) == 1


def test_passages_that_the_first_documents_of_their_seeds_lack(make):
    """Two early documents have a part each, too short for a passage; the whole of it is in a third one, and in later ones."""
    rng = random.Random(21)
    words = vocabulary(6)
    some = lambda n: [rng.choice(words) for _ in range(n)]
    for size in (50, 60, 80):
        whole = some(size)
        half = size // 2 + 5
        rows = [
            some(60) + whole[:half] + some(60), some(60) + whole[-half:] + some(60), some(30) + whole + some(30),
            some(10) + whole + some(20), some(70), some(5) + whole,
        ]
        found = passages.passages(make([" ".join(x) for x in rows])).collect()
        got = {(r.doc_id, r.source_id, r.start, r.end, r.source_start, r.n_equal) for r in found}
        assert (3, 2, 10, 10 + size, 30, size) in got, size
        assert got & {(5, 2, 5, 5 + size, 30, size), (5, 3, 5, 5 + size, 10, size)}, size  # a seed at the edge may come first in the fourth
        assert all(a in (3, 5) and b in (2, 3) and e - s >= 50 for a, b, s, e, _, _ in got), size

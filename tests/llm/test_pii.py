"""Personal data: patterns against plain regular expressions, the tagger's mathematics, and held-out spans."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import pii, queries
from postlake.llm.tagger import Tagger


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 12 <= len(digits) <= 19 and (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    for _ in range(8000):
        text = "".join(rng.choice("a.@-+1250 ()%é_\n") for _ in range(rng.randrange(50)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("a" * 200_000 + " " + "1" * 200_000 + "@") == []


def test_windows_cover_every_trigger():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("abcdefgh ") if rng.random() < 0.97 else rng.choice("1@9") for _ in range(rng.randrange(700)))
        held = [(a, b) for a, b, _, _ in pii.windows(text)]
        assert all(b - a <= pii.WINDOW for a, b in held)
        for i, c in enumerate(text):
            if c in "1@9":
                low, high = max(0, i - pii.AROUND), min(len(text), i + 1 + pii.AROUND)
                assert set(range(low, high)) <= {j for a, b in held for j in range(a, b)}


def small(labels=5):
    tagger = Tagger.new(labels, embed=3, hidden=2, seed=3)
    tagger.weights["T"][:] = np.random.default_rng(4).normal(size=(labels, labels))
    return tagger


def test_likelihood_and_decoding_equal_enumeration():
    tagger = small(3)
    x, y = np.array([[5, 6, 7, 0]]), np.array([[0, 2, 1, 0]])
    em, _ = tagger.emissions(x)
    score = lambda p: sum(em[0, i, k] for i, k in enumerate(p)) + sum(tagger.weights["T"][a, b] for a, b in zip(p, p[1:]))
    paths = list(itertools.product(range(3), repeat=3))
    loss, _ = tagger.loss_and_gradient(x, y)
    assert loss == pytest.approx(np.log(sum(np.exp(score(p)) for p in paths)) - score((0, 2, 1)))
    assert tuple(tagger.decode(x)[0][0][:3]) == max(paths, key=score)


def test_gradient_equals_differences():
    tagger = small()
    x, y = np.array([[5, 6, 7, 0], [8, 9, 10, 11]]), np.array([[0, 1, 2, 0], [3, 4, 0, 1]])
    _, gradient = tagger.loss_and_gradient(x, y)
    for name, values in gradient.items():
        at = np.unravel_index(np.abs(values).argmax(), values.shape)
        sides = []
        for step in (1e-5, -1e-5):
            tagger.weights[name][at] += step
            sides.append(tagger.loss_and_gradient(x, y)[0])
            tagger.weights[name][at] -= step
        assert values[at] == pytest.approx((sides[0] - sides[1]) / 2e-5, rel=1e-4)


def test_reconciling_takes_the_best_set():
    rng = random.Random(5)
    for _ in range(200):
        found = [(a := rng.randint(0, 20), rng.randint(0, 3), a + rng.randint(1, 8), rng.random()) for _ in range(rng.randint(1, 8))]
        fixed = [(a := rng.randint(0, 20), 0, a + 2) for _ in range(rng.randint(0, 2))]
        got = pii.reconciled(found, fixed)
        worth = {}
        for a, k, b, s in found:
            worth[a, k, b] = max(worth.get((a, k, b), 0), s * (b - a))
        apart = lambda spans: all(p[2] <= q[0] or q[2] <= p[0] for p, q in itertools.combinations(spans, 2))
        free = [x for x in worth if all(x[2] <= f[0] or f[2] <= x[0] for f in fixed)]
        best = max(sum(worth[x] for x in some) for n in range(len(free) + 1) for some in itertools.combinations(free, n) if apart(some))
        assert apart(got) and sum(worth[x] for x in got) == pytest.approx(best)


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.fitted(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 2 = 0"))


def test_held_out_variants(spark, tagger):
    """Documents that were not trained on, their addresses and phones written another way: found, and nothing else."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 2 = 1 AND text LIKE '%@%'").collect()
    rng, hits, wanted, given = random.Random(7), 0, 0, 0
    for row in rows:
        spans = pii.base_spans(row.text)
        text, moved = pii.variants(row.text, [s for s in spans if s[1] in (0, 3)], rng)
        base = pii.base_spans(text)
        new = {s for s in moved if s not in base}
        found = set(pii.tagged([text], [base], tagger)[0])
        hits, wanted, given = hits + len(found & new), wanted + len(new), given + len(found)
    assert wanted > 50 and hits / wanted > 0.8 and hits / given > 0.9


def test_clean_texts_get_no_spans(spark, tagger):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 10 = 1").collect()
    texts = [r.text for r in rows] + ["on 2021-05-12 10:22:31 at 12.5 percent, 1234567890 and 4111111111111112", "see you at noon, room 12-34"]
    base = [pii.base_spans(t) for t in texts]
    added = pii.tagged(texts, base, tagger)
    assert sum(map(len, added)) <= 0.001 * len(texts)


def test_query_and_odd_rows(spark, folder, texts, make, tagger):
    rows = queries.QUERIES["op3_personal_data"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in base) for i in range(4))
        marks = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(marks).encode()).hexdigest()
        assert set(marks) <= set(filter(None, r.spans.split(",")))
    odd = ["", None, "é joe@example.com 1.2.3.4 x 4111 1111 1111 1111 +1 (017) 555-7713", "joe@example.com", "joe@example.com", "1" * 5000]
    docs = make(odd).withColumn("base", F.lit(1)).withColumn("s", F.lit(1))
    got = {r.doc_id: r for r in pii.digest(docs, tagger).collect()}
    assert got[0].spans == got[1].spans == "" and got[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[2].spans == "email:2:17,ip:18:25,card:28:47,phone:48:65" and got[3].spans == got[4].spans == "email:0:15"
    assert pii.digest(docs.limit(0), pii.fitted(docs.limit(0))).collect() == []


def test_long_written_forms_lie_in_one_region():
    local, domain = "a" * 70, " dot ".join(["host" * 12, "site", "com"])
    for form in (f"{local} (at) {domain}", f"{local}[at]{domain}", f"{local} at {domain}"):
        text = "x " * 100 + form + " y" * 100
        at = text.index(form)
        assert any(a <= at and at + len(form) <= b for a, b in pii.regions(text))
    # long runs of triggers, dots and letters take linear time
    for text in ("a1" * 200_000, "a." * 200_000 + "1", "1.a dot " * 100_000, "(at)a" * 100_000, "plain words " * 10):
        assert all(a < b for a, b in pii.regions(text))


def test_windows_cover_the_whole_text(tagger, monkeypatch):
    """Forms that the check accepts are looked at wherever they stand, and a window left out would have added nothing."""
    for text in ("plain words without any sign " * 20, "x", "write to joe at example.com or not " + "words " * 40):
        assert {j for a, b, _, _ in pii.windows(text) for j in range(a, b)} == set(range(len(text)))
    forms = ["joe at example.com", "ann.lee at host[dot]org", "bob (at) site{dot}net", "joe at example dot com", "sue[at]mail.example.org", "555 867 5309", "(017) 555-7713", "12.34.56.78.90", "a at b.c"]
    rng = random.Random(8)
    word = lambda: rng.choice(["look", "at", "dot", "(at)", "at the", "12", "7.", "me.", "and", "é", "3-4"])
    texts = [" ".join([*(word() for _ in range(rng.randrange(60))), rng.choice(forms), *(word() for _ in range(rng.randrange(60)))]) for _ in range(150)]
    for text in texts:
        possible = pii.may_have_form(text)
        for a, b, _, _ in pii.windows(text):
            part = text[max(0, a - 2) : b + 2]
            written = pii._WRITTEN_EMAIL.search(part) or any(sum(c.isdigit() for c in m.group()) >= 9 for m in pii._WRITTEN_PHONE.finditer(part))
            assert possible(a, b) or not written, part
    base = [pii.base_spans(t) for t in texts]
    found = pii.tagged(texts, base, tagger)
    assert sum(map(len, found)) > 20
    assert any(text[a:b] == "joe at example.com" for text, spans in zip(texts, found) for a, _, b in spans)
    monkeypatch.setattr(pii, "may_have_form", lambda text: lambda a, b: True)
    assert pii.tagged(texts, base, tagger) == found
    for text in ("a at b" * 100_000, "at " * 100_000, "a at " + "b" * 300_000):
        pii.may_have_form(text)

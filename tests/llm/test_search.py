"""License scan, line dedup and decontamination: against SQL and on planted rows."""

import duckdb
import oracle
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from postlake.llm import contamination, licenses, sitelines


@pytest.fixture(scope="module")
def con(folder):
    return oracle.duck(folder)


@pytest.mark.parametrize("name", ["op1_licenses", "op5_site_lines", "op9_leaks"])
def test_query_equals_sql(spark, con, folder, name):
    assert oracle.compare(spark, con, name, folder) is None


@pytest.mark.parametrize("name", ["op1_licenses", "op9_leaks"])
def test_native_queries_have_no_python(spark, folder, name):
    plan = entry.queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_licenses_on_odd_texts(make):
    mit = dict(reversed(licenses.TEMPLATES))["MIT"]
    wrapped = "\n".join(mit[i : i + 60] for i in range(0, len(mit), 60))
    texts = [None, "", "x", "\n\n", "released under the mit licence", mit, "text\n" + mit.upper() + "\nmore", "word " * 500, wrapped]
    docs = make(texts).withColumn("line", F.lit(9)).withColumn("words", F.lit("z"))
    docs = docs.unionAll(docs.filter("doc_id = 5")).unionAll(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    got = {(r.doc_id, r.line): (r.license, r.dice) for r in licenses.scan(docs).collect()}
    whole = {k: v for k, v in got.items() if v == ("MIT", 1.0)}
    assert (5, 1) in whole and (None, 1) in whole and (6, 2) in whole
    assert got[8, 0][0] == "MIT" and not any(k in got for k in [(0, 1), (7, 1), (2, 1)])
    assert licenses.scan(docs.limit(0)).collect() == []


def test_license_anchors_lose_nothing():
    for _, text in licenses.TEMPLATES:
        bag = licenses.template_bigrams(text)
        n, least = sum(bag.values()), licenses.size_bounds(sum(bag.values()), 0.8)[0]
        assert sum(bag[x] for x in licenses.anchors(bag, 0.8)) > n - least


def test_lines_by_site(make):
    texts = [f"menu \nown line {i}\nmenu\n\nend {i % 2}" for i in range(10)] + ["menu\nx", None, "", "only"]
    sources = ["a"] * 10 + ["b", "a", "a", None]
    docs = make(texts, sources).withColumn("marks", F.lit(1)).withColumn("host", F.lit(2))
    got = {r.doc_id: r.text for r in sitelines.drop_boilerplate(docs, "source", "text").collect()}
    assert got[0] == "own line 0\n" and got[10] == "menu\nx" and got[11] is None and got[12] == "" and got[13] == "only"
    assert sitelines.drop_boilerplate(docs, "source", "text").columns == docs.columns
    assert sitelines.drop_boilerplate(docs.limit(0), "source", "text").collect() == []
    twice = docs.unionAll(docs)
    assert sitelines.drop_boilerplate(twice, "source", "text", max_ratio=0.99).filter("text LIKE '%menu%'").count() > 0


def test_hosts_and_pages(spark):
    rows = [("HTTPS://u:p@A.example.com:80/x?y", "<head><title>t</title></head><p>a <b>b</b></p><script>p()</script><div>&lt;c&amp;</div>"), ("nothing", None), (None, "<p>")]
    df = spark.createDataFrame(rows, "url string, html string")
    got = df.select(sitelines.host_of(F.col("url")), sitelines.html_text(F.col("html"))).collect()
    assert got[0][0] == "a.example.com" and [x.strip() for x in got[0][1].split("\n") if x.strip()] == ["a b", "<c&"]
    assert got[1] == (None, None) and got[2][0] is None


def test_leaks_on_planted_rows(make, spark):
    words = [f"w{i}" for i in range(400)]
    item = " ".join(words[100:130])
    items = spark.createDataFrame([(1, item), (2, "a b c"), (3, None), (None, " ".join(words[200:260])), (1, item)], "item_id long, text string")
    broken = words[100:112] + ["zz"] + words[113:130]
    texts = [" ".join(words), "x " * 50 + item.upper().replace(" ", ", "), " ".join(broken), " ".join(words[100:115]), None, "", item, item]
    docs = make(texts).withColumn("item", F.lit(5)).withColumn("h", F.lit(5))
    docs = docs.unionAll(docs.filter("doc_id = 6")).unionAll(docs.filter("doc_id = 7").withColumn("doc_id", F.lit(None).cast("long")))
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in contamination.leaks(docs, items).collect()}
    assert got == {(0, 1): (26, 26), (0, None): (56, 56), (1, 1): (26, 26), (2, 1): (21, 26), (6, 1): (26, 26), (7, 1): (26, 26), (None, 1): (26, 26)}
    clean = contamination.drop_leaks(docs, items)
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5] and clean.columns == docs.columns
    assert contamination.leaks(docs.limit(0), items).collect() == []
    assert contamination.leaks(docs, items.limit(0)).collect() == []


def from_sql(sql, docs, items=None):
    con = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", items)):
        if df is not None:
            rows = pa.table({c: [r[c] for r in df.collect()] for c in df.columns})  # noqa: F841
            con.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
    return sorted(map(str, con.execute(sql).fetchall()))


def test_short_items_and_rows_without_keys(make, spark):
    """Items of one to four words; null-key rows by themselves; query, stage and SQL agree."""
    long = " ".join(f"v{i}" for i in range(20))
    rows = [(1, "What is it now?"), (2, "xylophone"), (3, "red green blue"), (4, long), (4, "tail end"), (None, "odd one"), (None, "even one"), (5, " . ")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    texts = ["so what is it, NOW then", "what is it not now", "xylophone", "xylophones", "the red green", "red green blue", long, long + " tail end", "odd one", None, ""]
    docs = make(texts)
    alone = make([long + " tail end", "clean text of nobody", "xylophone", "xylophone", None]).withColumn("doc_id", F.lit(None).cast("long"))
    parts = make(["v0 v1 v2 v3 v4 v5 v6 v7 v8 v9 v10 v11", " ".join(f"v{i}" for i in range(7, 20)) + " tail end"]).withColumn("doc_id", F.lit(20).cast("long"))
    docs = docs.unionAll(alone).unionAll(parts)
    got = contamination.leaks(docs, items).select("doc_id", "item_id", "n_item", "n_shared", "containment").collect()
    found = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got}
    assert found == {(0, 1, 1, 1), (2, 2, 1, 1), (5, 3, 1, 1), (6, 4, 16, 17), (7, 4, 17, 17), (8, None, 1, 1), (None, 4, 17, 17), (None, 2, 1, 1), (20, 4, 17, 17)}
    assert len(got) == len(found)
    assert sorted(map(str, map(tuple, got))) == from_sql(contamination.SQL, docs, items)
    kept = contamination.drop_leaks(docs, items).collect()
    assert sorted((r.doc_id is None, r.text or "") for r in kept) == sorted(
        [(False, texts[i] or "") for i in (1, 3, 4, 9, 10)] + [(True, "clean text of nobody"), (True, "")])


def test_licenses_of_rows_with_one_key_or_none(make):
    texts = ["released under the MIT license", "licensed under CC BY 4.0", "licensed under CC BY 4.0", "Licensed under CC BY-SA 4.0.", "x\nreleased under the MIT license"]
    for key in (7, None):
        docs = make(texts).withColumn("doc_id", F.lit(key).cast("long"))
        got = [tuple(r) for r in licenses.scan(docs).collect()]
        assert sorted((r[1], r[3]) for r in got) == [(0, "MIT"), (1, "CC-BY-4.0"), (1, "CC-BY-SA-4.0"), (1, "MIT"), (2, "MIT")]
        assert sorted(map(str, got)) == from_sql(licenses.SQL, docs)


def test_asked_values():
    assert contamination.needed(range(4, 8), 16, 0.8, 1e-9) >= 3
    assert 1 <= contamination.needed(range(32, 64), 16, 0.8, 1e-9) <= 8

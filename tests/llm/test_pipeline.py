"""The pipeline, stage by stage, against plain Python."""

from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from postlake.llm import contamination, sitelines
from test_pairs import plain_components
from test_rows import plain_quality


@pytest.fixture(scope="module")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, folder, documents):
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    assert names == ["quality rules", "line dedup", "near-duplicate removal", "benchmark decontamination", "BPE encoding and decoding"]
    docs, last = documents, by_id(documents)
    for name in names[:-1]:
        out = stages[name](spark, docs, folder)
        assert out.columns == documents.columns and out.dtypes == documents.dtypes
        out = spark.createDataFrame(out.collect(), documents.schema)
        rows = by_id(out)
        if name == "quality rules":
            assert set(rows) == {k for k, r in last.items() if plain_quality(r.text)[-1]}
        if name == "line dedup":
            pages, lines = Counter(r.source for r in last.values()), defaultdict(Counter)
            for r in last.values():
                lines[r.source].update({x.strip(" ") for x in r.text.split("\n")} - {""})
            bad = {s: {x for x, n in c.items() if n >= sitelines.MIN_PAGES and n > sitelines.MAX_RATIO * pages[s]} for s, c in lines.items()}
            want = {k: "\n".join(x for x in r.text.split("\n") if x.strip(" ") not in bad[r.source]) for k, r in last.items()}
            assert {k: r.text for k, r in rows.items()} == want and all(r.n_chars == len(r.text) for r in rows.values())
        if name == "near-duplicate removal":
            want = plain_components({k: r.text for k, r in last.items()}, 5, 80)
            assert set(rows) == {k for k, v in want.items() if v[2]}
        if name == "benchmark decontamination":
            con = duckdb.connect()
            con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{folder}/benchmark.parquet'")
            con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
            con.executemany("INSERT INTO documents VALUES (?, ?)", [(k, r.text) for k, r in last.items()])
            leaked = {r[0] for r in con.execute(contamination.SQL).fetchall()}
            assert set(rows) == set(last) - leaked
        docs, last = out, rows
    coded = stages[names[-1]](spark, docs, folder).collect()
    assert {r.doc_id for r in coded} == set(last) and all(r.n_tokens == len(r.ids) > 0 for r in coded)
    whole = corpus_pipeline.run(spark, folder)
    assert {(r.doc_id, r.ids_sha256) for r in whole.collect()} == {(r.doc_id, r.ids_sha256) for r in coded}


def test_a_group_of_copies_leaves_one_whole_text(spark, folder, documents, make):
    """Copies that are 40 % of a source: one row with the full text comes out, and no empty one."""
    good = [r.text for r in documents.orderBy("doc_id").collect() if plain_quality(r.text)[-1]]
    good = list(dict.fromkeys(good))[:13]
    docs = make([good[0]] * 8 + good[1:])
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
    found = [r.text for r in docs.collect()]
    assert found.count(good[0]) == 1 and "" not in found


def test_lines_of_a_source_of_many_sites(spark, folder, make):
    """A line on 8 % of the documents goes, those on 4 % or on four documents stay."""
    rows = [f"own {i}\n{'repeated' if i < 16 else 'not'} {'' if i < 16 else i}\n{'seldom' if i % 25 < 1 else f'line {i}'}" for i in range(200)]
    docs = make(rows + ["few", "few\na", "few\nb", "few\nc", "d"], ["many"] * 200 + ["small"] * 5)
    out = by_id(dict(corpus_pipeline.STAGES)["line dedup"](spark, docs, folder))
    assert not any("repeated" in r.text for r in out.values()) and out[3].text == "own 3\nline 3"
    assert sum("seldom" in r.text for r in out.values()) == 8 and sum("few" in r.text for r in out.values()) == 4
    assert all(out[i].text == rows[i] for i in range(16, 200)) and all(r.n_chars == len(r.text) for r in out.values())


def test_stages_on_odd_rows(spark, folder, make):
    docs = make([None, "", "word " * 40, "x" * 3000, "one two three four five six seven eight nine ten " * 3])
    docs = docs.unionAll(docs)
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = spark.createDataFrame(stage(spark, rows, folder).collect() or [], rows.schema) if stage is not corpus_pipeline.STAGES[-1][1] else stage(spark, rows, folder)
        rows.collect()

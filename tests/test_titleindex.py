"""The title index: the same rows as a scan, pruned reads, compaction."""

import pytest
from pyspark.sql import functions as F

from postlake.operators import search
from postlake.operators.titleindex import TitleIndex

TITLES = ["The war of words", "peace, at last", "THE end; of it", None, "", "war and war", "of the of the", "théâtre of the absurd"]


def ids(df):
    return sorted(r.post_id for r in df.collect())


def test_search_equals_a_scan_and_reads_only_its_buckets(spark, tmp_path):
    rows = [(f"p{i}", TITLES[i % len(TITLES)]) for i in range(40)] + [(None, "the war of nobody")]
    posts = spark.createDataFrame(rows, "post_id string, title string")
    index = TitleIndex(spark, str(tmp_path), buckets=32)
    early = F.col("post_id") < "p2"
    index.add("a", posts.filter(early))
    index.add("b", posts.filter(~early | F.col("post_id").isNull()))
    number = index.snapshots.read().number
    assert index.add("b", posts).number == number
    keyed = posts.filter("post_id IS NOT NULL")
    for terms in (["the", "of"], ["War"], ["war", "peace"], ["nothing"], ["the", "the"], ["two words"], ["théâtre"]):
        for every in (True, False):
            assert ids(index.search(posts, terms, every)) == ids(search.search(keyed, terms, every=every)), terms
    read = index.postings(["war"]).inputFiles()
    assert 0 < len(read) <= 2 and len(index.snapshots.rows(index.snapshots.read(), index.row_type).inputFiles()) > 10
    before = {r for r in map(tuple, index.snapshots.rows(index.snapshots.read(), index.row_type).collect())}
    old = index.postings(["of"])
    index.compact()
    assert {r for r in map(tuple, index.snapshots.rows(index.snapshots.read(), index.row_type).collect())} == before
    assert len(index.postings(["war"]).inputFiles()) == 1 and old.count() > 0
    with pytest.raises(ValueError):
        TitleIndex(spark, str(tmp_path), buckets=8).postings(["war"])
    with pytest.raises(ValueError):
        index.search(posts, [])
    # A changed title: the old posting is there, the row is not found by it.
    changed = posts.withColumn("title", F.when(F.col("post_id") == "p0", "new words").otherwise(F.col("title")))
    index.add("c", changed.filter("post_id = 'p0'"))
    assert ids(index.search(changed, ["war"])) == ids(search.search(changed.filter("post_id IS NOT NULL"), ["war"]))
    assert "p0" in ids(index.search(changed, ["new"]))

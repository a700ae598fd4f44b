"""Substring matches of large lexicons: against plain Python, against the column functions, plans."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from postlake import fixed
from postlake.functions import text
from postlake.operators import lexicons
from postlake.plans.catalog import CATALOG


def plain(rows, words):
    found = {}
    for key, body in rows:
        for word in set(words):
            if body and word:
                n = sum(body.startswith(word, i) for i in range(len(body)))
                if n:
                    found[key, word] = found.get((key, word), 0) + n
    return found


def got(df):
    return {(r[0], r.word): r.n for r in df.collect()}


@pytest.mark.parametrize("part", [lexicons.PART, 250])
def test_random_texts(spark, part):
    draw = random.Random(5)
    letters = "aab cdé😀"
    word = lambda n: "".join(draw.choice(letters) for _ in range(n))
    words = [word(draw.choice([1, 2, 3, 4, 5, 6, 9])) for _ in range(150)] + ["", None, "aaaa", "aaaaa", "x", "nowhere", "long" * 60]
    bodies = [word(draw.choice([0, 1, 3, 30, 400])) for _ in range(40)] + [None, "aaaaaaaa", "😀" * 9, "y" * 1000 + "long" * 130 + "x"]
    bodies += [word(3000), "b" * 1021 + "aaaaaa" + "b" * 1021]
    rows = list(enumerate(bodies)) + [(0, "aab"), (None, "aaaa"), (None, "aaaa")]
    df = spark.createDataFrame(rows, "id long, body string").withColumn("word", F.lit("z")).withColumn("gram", F.lit(1)).repartition(5)
    lexicon = spark.createDataFrame([(w,) for w in words + words[:9]], "word string")
    assert got(lexicons.substring_matches(df, lexicon, "id", "body", part=part)) == plain(rows, words)


def test_empty_tables(spark):
    rows = spark.createDataFrame([(1, "abc")], "id long, body string")
    lexicon = spark.createDataFrame([("b",)], "word string")
    assert got(lexicons.substring_matches(rows, lexicon.limit(0), "id", "body")) == {}
    assert got(lexicons.substring_matches(rows.limit(0), lexicon, "id", "body")) == {}
    assert lexicons.substring_matches(rows, lexicon.limit(0), "id", "body").columns == ["id", "word", "n"]


def test_the_fixed_lexicons_give_what_the_columns_give(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.lower("text").alias("body"))
    extra = [" and ", "good", "the ", "ion"]
    docs = docs.withColumn("body", F.concat("body", F.element_at(F.array(*map(F.lit, extra)), (F.col("doc_id") % 4 + 1).cast("int"))))
    some = fixed.BATCH
    rows = [(w, "positive") for w in some.positive] + [(w, "negative") for w in some.negative] + [(w, "name") for w in some.entities]
    lexicon = spark.createDataFrame(rows, "word string, label string")
    matches = lexicons.substring_matches(docs, lexicon, "doc_id", "body")
    names = matches.filter(F.col("word").isin(list(some.entities)))
    want = docs.select("doc_id", text.polarity(F.col("body"), some).alias("p"), F.sort_array(F.array_distinct(text.entities(F.col("body"), some))).alias("e")).collect()
    assert {r.doc_id: r.names for r in lexicons.names_found(names, "doc_id").collect()} == {r.doc_id: r.e for r in want if r.e}
    polarity = {r.doc_id: r.polarity for r in lexicons.polarity_found(matches, lexicon, "doc_id").collect()}
    assert all(polarity.get(r.doc_id, 0.0) == pytest.approx(r.p) for r in want) and polarity


def test_a_lexicon_of_100000_names(spark, folder):
    """Nothing is paired but equal seeds: no product in the plan, no Python; the words planted are found, no others."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.concat("text", F.lit(" name"), F.col("doc_id") * 7, F.lit(";")).alias("body"))
    lexicon = spark.range(100_000).select(F.concat(F.lit("name"), "id", F.lit(";")).alias("word"))
    matches = lexicons.substring_matches(docs, lexicon, "doc_id", "body")
    plan = matches._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
    assert got(matches) == {(r.doc_id, f"name{r.doc_id * 7};"): 1 for r in docs.select("doc_id").collect()}


def test_a_word_has_the_labels_of_all_items_with_it(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([(0, at, 1, "a", 1.0), (1, at, 1, "a", 1.0)], "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(0, "Red fish\nbody"), (1, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "red"), (2, "a RED, red one"), (3, "fish"), (4, "body"), (5, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = CATALOG["lexicon_matches"].run(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [("0", "item1"), ("0", "item2"), ("0", "item3")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "label" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)

import random

import pytest
from pyspark.sql import functions as F

import plain
from postlake import fixed
from postlake.functions import text
from postlake.operators import search, silver

# title, cleaned, polarity, topics, entities by the default word lists (substring match)
TITLES = [
    ("Trade deal: US & China agree! https://x.y/z", "trade deal us china agree!", 0.0, ["trade_economy"], ["us", "china"]),
    ("Award for Russia report", "award for russia report", -1.0, ["war_conflict"], ["us", "russia"]),
    ("Peace summit a great success in France", "peace summit a great success in france", 1.0, ["diplomacy"], ["france"]),
    ("Élection à Paris — café", "élection à paris café", 0.0, ["other"], []),
    ("", "", 0.0, ["other"], []),
    (None, "", 0.0, ["other"], []),
    ("Said the bank: www.bank.example ban", "said the bank ban", -1.0, ["technology"], []),
    ("Troops attack near Iran border, peace hopes", "troops attack near iran border, peace hopes", 0.0,
     ["war_conflict", "migration"], ["iran"]),
]


def test_fixed_titles(spark):
    rows = spark.createDataFrame([(i, t[0]) for i, t in enumerate(TITLES)], "i int, title string")
    posts = silver.add_clean_text(rows.withColumn("body", F.lit(None).cast("string")))
    posts = silver.add_entities(silver.add_topics(silver.add_sentiment(posts)))
    got = posts.orderBy("i").select("title_cleaned", "sentiment_polarity", "topics", "entities").collect()
    assert [tuple(row) for row in got] == [t[1:] for t in TITLES]


PIECES = [
    "war", "Peace ", "GOOD", "http://a.b/c?d", "HTTPS", "www", "www.", "wwwx", "www\r", "www\n", "é", "ÉCOLE", "ß", "İ",
    "中国", "عربي", "١٢", "½", "Ⅷ", "é", "👍", "_", "-", "--", ".", ",", "!", "?", ";", ":", "'", '"', "$", "€",
    " ", "  ", "\t", "\n", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", " ", " ",
    " ", " ", "​", " ", " ", " ", " ", "　", "﻿", "\x00", "\x7f", "us", "uk ",
]


def test_random_texts_against_plain_python(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(4000)] + PIECES
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    cleaned = rows.withColumn("cleaned", text.clean_text(F.col("raw")))
    got = cleaned.select(
        "i", "cleaned", text.polarity(F.col("cleaned")), text.topics(F.col("cleaned")),
        text.entities(F.col("raw")), text.word_count(F.col("cleaned")),
    ).orderBy("i").collect()
    for raw, row in zip(texts, got):
        want = plain.clean(raw)
        assert row[1] == want, (raw, row[1], want)
        assert row[2] == pytest.approx(plain.polarity(want, fixed.BATCH), abs=1e-12)
        assert row[3] == plain.topics(want, fixed.BATCH)
        assert row[4] == plain.entities(raw, fixed.BATCH)
        assert row[5] == len(want.split())


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


def test_word_match_needs_whole_words(spark):
    x = F.col("x")
    assert one(spark, text.topics(x, match="word"), "award for the us") == ["other"]
    assert one(spark, text.topics(x, match="word"), "a war, at last") == ["war_conflict"]
    assert one(spark, text.entities(x, match="word"), "Russia-US talks") == ["us", "russia"]
    assert one(spark, text.entities(x, match="word"), "Russian talks") == []
    with pytest.raises(ValueError):
        text.topics(x, match="stem")


def test_first_topic_takes_the_first_hit(spark):
    x = F.col("x")
    assert one(spark, text.first_topic(x), "president of the troops") == "war_conflict"
    assert one(spark, text.first_topic(x), "a law on trade") == "trade_economy"
    assert one(spark, text.first_topic(x), "a law") == "policy"
    assert one(spark, text.first_topic(x), "nothing") == "other"


def test_sentiment_label_edges(spark):
    label = text.sentiment_label(F.col("x"))
    got = [one(spark, label, value, "double") for value in (0.1, 0.11, -0.1, -0.11, 0.0, None)]
    assert got == ["neutral", "positive", "neutral", "negative", "neutral", None]


def test_empty_text_counts(spark):
    posts = spark.createDataFrame([("", ""), ("a b", "c")], "title_cleaned string, body_cleaned string")
    shown = ["title_word_count", "body_word_count", "has_body", "title_char_count"]
    assert sorted(map(tuple, silver.add_text_features(posts).select(*shown).collect())) == [(0, 0, False, 0), (2, 1, True, 3)]
    compat = silver.add_text_features(posts, reference_compat=True).select(*shown).collect()
    assert sorted(map(tuple, compat)) == [(1, 1, True, 0), (2, 1, True, 3)]


def test_kept_items_and_array_text(spark):
    items = spark.createDataFrame([(["  a ", "", None, "　", "b\n"],), ([],), (None,)], "x array<string>")
    kept = [row[0] for row in items.select(text.kept_items(F.col("x"))).collect()]
    assert kept == [["a", "b"], [], None]
    assert one(spark, text.array_text(F.col("x")), ["a", "b"], "array<string>") == "[a,b]"
    assert one(spark, text.array_text(F.col("x")), [], "array<string>") == "[]"


def test_search(spark):
    posts = spark.createDataFrame([("1", "War and peace"), ("2", "Warship at peace"), ("3", None)], "post_id string, title string")
    assert [r[0] for r in search.search(posts, ["war", "PEACE"]).collect()] == ["1"]
    assert [r[0] for r in search.search(posts, ["war", "warship"], every=False).orderBy("post_id").collect()] == ["1", "2"]
    with pytest.raises(ValueError):
        search.search(posts, [])


def test_lexicon_table(spark):
    posts = spark.createDataFrame([("1", "War war in Iran"), ("2", "award")], "post_id string, title string")
    lexicon = spark.createDataFrame([("war", "conflict"), ("iran", "place"), ("iran", "country")], "word string, label string")
    got = sorted(map(tuple, search.lexicon_matches(posts, lexicon).collect()))
    assert got == [("1", "conflict"), ("1", "country"), ("1", "place")]

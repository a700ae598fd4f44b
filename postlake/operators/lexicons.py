"""Large lexicons: words found anywhere in texts, by q-gram seeds.

``functions.text`` tests one word after the other, which is the quickest way for some dozens of words. Here every word is
known by one of its q-grams, the rarest one in the texts; q-grams of the texts are joined with these seeds, and a word counts where
the text around the seed is the word. Words shorter than ``q`` are their own seeds. All steps are joins and grouped counts.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.session import shared_folder

#: Length of a seed in characters.
Q = 4
#: Characters of a text that are cut into q-grams together.
WINDOW = 1024
#: Rows of a part of the lexicon's q-grams or seeds, some 40 MB; each part is broadcast by itself.
PART = 500_000


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_folder(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _parts(rows: DataFrame, most: int) -> Iterator[DataFrame]:
    """A stored table in parts by hash of ``gram``, of about ``most`` rows each."""
    parts = max(1, -(-rows.count() // most))
    for part in range(parts):
        yield rows.filter(F.pmod(F.xxhash64(F.lit(3), "gram"), F.lit(parts)) == part) if parts > 1 else rows


def _text_grams(rows: DataFrame, key: str, column: str, sizes: list[int], longest: int) -> DataFrame:
    """(key, piece, at, gram): every q-gram of the sizes given, with its place in a piece of the text around it.

    A text is cut into windows, each with as much before and behind it as a word may reach, so what is read of
    a text for one q-gram does not grow with the text. Every place of the text is in one window.
    """
    windows = F.sequence(F.lit(0), F.floor((F.length(F.col(column)) - 1) / WINDOW).cast("int"))
    cut = rows.filter(F.length(F.col(column)) > 0).select(F.col(key), F.col(column).alias("text"), F.explode_outer(windows).alias("w"))
    start = F.greatest(F.col("w") * WINDOW - (longest - 1), F.lit(0))
    cut = cut.withColumn("lead", (F.col("w") * WINDOW - start).cast("int"))
    piece = F.substring(F.col("text"), start + 1, F.col("lead") + WINDOW + longest - 1)
    cut = cut.select(key, "lead", piece.alias("piece")).withColumn("chars", F.split("piece", ""))
    places = F.sequence(F.col("lead"), F.least(F.col("lead") + WINDOW, F.size("chars")) - 1)
    placed = cut.select(key, "piece", "chars", F.explode_outer(places).alias("at"))

    def gram(size: int) -> Column:
        # Behind the end of the text ``get`` gives NULL, and so the whole is NULL and joins with nothing.
        return F.xxhash64(F.concat(*[F.get("chars", F.col("at") + i) for i in range(size)]), F.lit(size))

    inside = lambda size: F.col("at") + size <= F.size("chars")
    grams = F.array(*[F.when(inside(size), gram(size)) for size in sizes])
    return placed.select(key, "piece", "at", F.explode_outer(grams).alias("gram"))


def seeds(rows: DataFrame, lexicon: DataFrame, column: str, q: int = Q, part: int = PART) -> tuple[DataFrame, list[int], int]:
    """One seed (``word``, ``gram``, ``offset``) for every word that may occur, the sizes of the seeds, and the longest word.

    The seed is the q-gram of the word that is rarest in the texts, so what a seed brings up stays near what is found.
    A word of which a q-gram occurs nowhere is left out.
    """
    words = lexicon.filter(F.length("word") > 0).select("word").distinct()
    size = F.least(F.lit(q), F.length("word"))
    offsets = F.sequence(F.lit(0), F.length("word") - size)
    grams = words.select("word", size.alias("size"), F.explode(offsets).alias("offset"))
    cut = F.substring(F.col("word"), F.col("offset") + 1, F.col("size"))
    grams = _stored(grams.withColumn("gram", F.xxhash64(cut, F.col("size"))), "lexicon-grams")
    found = grams.agg(F.sort_array(F.collect_set("size")), F.max(F.length("word"))).first()  # at most q sizes
    sizes, longest = found[0], found[1] or 1
    if not sizes:
        return grams.select("word", "gram", "offset"), sizes, longest
    asked = _stored(grams.select("gram").distinct(), "lexicon-asked")
    numbered = rows.select(F.lit(0).alias("k"), F.col(column).alias("text"))
    counts = None
    for some in _parts(asked, part):
        met = _text_grams(numbered, "k", "text", sizes, longest).select("gram").join(F.broadcast(some), "gram")
        count = met.groupBy("gram").count()
        counts = count if counts is None else counts.unionAll(count)
    rarest = F.min_by(F.struct("gram", "offset"), F.struct(F.coalesce("count", F.lit(0)), "offset")).alias("m")
    chosen = grams.join(counts, "gram", "left").groupBy("word").agg(rarest, F.min(F.coalesce("count", F.lit(0))).alias("least"))
    chosen = chosen.filter("least > 0").select("word", "m.gram", "m.offset")
    return _stored(chosen, "lexicon-seeds"), sizes, longest


def substring_matches(
    rows: DataFrame, lexicon: DataFrame, key: str = "post_id", column: str = "title", q: int = Q, part: int = PART
) -> DataFrame:
    """(key, word, n): how often every word of ``lexicon`` (column ``word``) occurs anywhere in the text, overlaps included.

    Text and words are compared as they are; lower-case both before if case is not to count, and pad both with a space
    for whole words. NULL and empty texts and words match nothing, words given twice count once, and rows with the same
    key are one text each whose counts are added. The texts are read once to choose the seeds and once for each
    ``part`` seeds, which are broadcast; no text is shuffled.
    """
    chosen, sizes, longest = seeds(rows, lexicon, column, q, part)
    if not sizes:
        return rows.select(key).limit(0).withColumns({"word": F.lit(""), "n": F.lit(0).cast("long")})
    own = rows.select(F.col(key).alias("__key"), F.col(column).alias("__text"))
    found = None
    for some in _parts(chosen, part):
        grams = _text_grams(own, "__key", "__text", sizes, longest)
        begin = F.col("at") - F.col("offset")
        same = (begin >= 0) & (F.substring(F.col("piece"), begin + 1, F.length("word")) == F.col("word"))
        hits = grams.join(F.broadcast(some), "gram").filter(same).groupBy("__key", "word").agg(F.count("*").alias("n"))
        found = hits if found is None else found.unionAll(hits)
    return found.select(F.col("__key").alias(key), "word", "n")


def names_found(matches: DataFrame, key: str = "post_id") -> DataFrame:
    """(key, names): the words found in each text, in order. Texts with none are not among them."""
    return matches.groupBy(key).agg(F.sort_array(F.collect_set("word")).alias("names"))


def labels_found(matches: DataFrame, lexicon: DataFrame, key: str = "post_id") -> DataFrame:
    """(key, label, words): how many different words of each label (topic, sentiment) of ``lexicon`` a text has."""
    labelled = matches.select(key, "word").join(lexicon.select("word", "label").distinct(), "word")
    return labelled.groupBy(key, "label").agg(F.count("*").alias("words"))


def polarity_found(matches: DataFrame, lexicon: DataFrame, key: str = "post_id") -> DataFrame:
    """(key, polarity) by the words labelled positive and negative: (p - n) / (p + n), for texts that have one of them."""
    counts = labels_found(matches, lexicon, key).filter(F.col("label").isin("positive", "negative"))
    signed = F.sum(F.when(F.col("label") == "positive", F.col("words")).otherwise(-F.col("words")))
    return counts.groupBy(key).agg((signed / F.sum("words")).alias("polarity"))

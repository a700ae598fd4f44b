"""Text functions. All are Column expressions: no Python runs per row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake import fixed
from postlake.fixed import Lexicon


# Neither a kept character nor a plain space. Characters named one by one are looked up in a table of bits by
# Java, so most of a text passes at the first test; other letters and digits are told by their category.
OTHER = r"[^abcdefghijklmnopqrstuvwxyz0123456789 .,_!?\-\p{L}\p{N}]"


def clean_text(text: Column) -> Column:
    """Lower case, no URLs, only letters, digits, ``_ . , ! ? -`` and single spaces. NULL gives ''.

    Cleaning is the bulk of the work on texts, so passes that have nothing to do are skipped, and
    ``OTHER`` passes common characters at the first test. (Class intersections looked faster on one core,
    but on eight they were five times slower with Java 17.)
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    may_link = reduce(or_, [F.contains(lowered, F.lit(start)) for start in fixed.URL_STARTS])
    unlinked = F.when(may_link, F.regexp_replace(lowered, fixed.URLS, "")).otherwise(lowered)
    spaced = F.regexp_replace(unlinked, f"{OTHER}(?<=[{fixed.SPACE}])", " ")
    kept = F.regexp_replace(spaced, OTHER, "")
    single = F.when(F.contains(kept, F.lit("  ")), F.regexp_replace(kept, " {2,}", " ")).otherwise(kept)
    return F.trim(single)


def word_count(cleaned: Column, empty_is_one: bool = False) -> Column:
    """Words of a cleaned text. The empty text has none, or one with ``empty_is_one``."""
    words = F.length(cleaned) - F.length(F.replace(cleaned, F.lit(" "), F.lit(""))) + 1
    return words if empty_is_one else F.when(cleaned == "", 0).otherwise(words)


def has_text(cleaned: Column) -> Column:
    return F.coalesce(cleaned != "", F.lit(False))


def _haystack(text: Column, match: str) -> Column:
    if match == "substring":
        return text
    if match == "word":
        return F.concat(F.lit(" "), F.regexp_replace(text, fixed.NON_WORD, " "), F.lit(" "))
    raise ValueError(f"match must be 'substring' or 'word', not {match!r}")


def _needle(word: str, match: str) -> Column:
    return F.lit(f" {word} " if match == "word" else word)


def _hits(text: Column, words: Sequence[str], match: str) -> list[Column]:
    haystack = _haystack(text, match)
    return [F.contains(haystack, _needle(word, match)) for word in words]


def hit_count(text: Column, words: Sequence[str], match: str = "substring") -> Column:
    """How many of ``words`` occur, each counted once."""
    return reduce(add, [hit.cast("int") for hit in _hits(text, words, match)], F.lit(0))


def polarity(text: Column, lexicon: Lexicon = fixed.BATCH, match: str = "substring") -> Column:
    """(positive - negative) / (positive + negative) word hits; 0 when there are none."""
    good = hit_count(text, lexicon.positive, match)
    bad = hit_count(text, lexicon.negative, match)
    return F.coalesce(F.try_divide(good - bad, good + bad), F.lit(0.0))


def sentiment_label(score: Column, cut: float = fixed.SENTIMENT_CUT) -> Column:
    return (
        F.when(score > cut, "positive")
        .when(score < -cut, "negative")
        .when(score.isNotNull(), "neutral")
    )


def _kept(names: Sequence[str], hits: Sequence[Column]) -> Column:
    """The names whose hit is true, in order. ``array_remove`` keeps this inside generated code."""
    marked = [F.when(hit, F.lit(name)).otherwise(F.lit("")) for name, hit in zip(names, hits)]
    return F.array_remove(F.array(*marked), "")


def topics(text: Column, lexicon: Lexicon = fixed.BATCH, match: str = "substring") -> Column:
    """Every topic with a word in the text, in lexicon order; the fallback topic when there is none."""
    hits = [reduce(or_, _hits(text, words, match)) for _, words in lexicon.topics]
    found = _kept([name for name, _ in lexicon.topics], hits)
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(lexicon.fallback_topic)))


def first_topic(text: Column, lexicon: Lexicon = fixed.STREAM, match: str = "substring") -> Column:
    """The first topic with a word in the text."""
    picked = F
    for name, words in lexicon.topics:
        picked = picked.when(reduce(or_, _hits(text, words, match)), name)
    return picked.otherwise(lexicon.fallback_topic)


def entities(raw: Column, lexicon: Lexicon = fixed.BATCH, match: str = "substring") -> Column:
    """Lexicon names found in the raw text, in lexicon order. NULL gives an empty array."""
    lowered = F.lower(F.coalesce(raw, F.lit("")))
    return _kept(lexicon.entities, _hits(lowered, lexicon.entities, match))


def tokens(text: Column) -> Column:
    """Distinct lower-case words of a text."""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), fixed.NON_WORD, " "))
    return F.array_remove(F.array_distinct(F.split(words, " ")), "")


def kept_items(items: Column) -> Column:
    """List items stripped of white space, without NULL and blank ones."""
    stripped = F.transform(items, lambda item: F.regexp_replace(item, fixed.EDGE_SPACE, ""))
    return F.filter(stripped, lambda item: item != "")


def array_text(items: Column) -> Column:
    """``[a,b]`` for sinks that hold no arrays."""
    return F.concat(F.lit("["), F.concat_ws(",", items), F.lit("]"))

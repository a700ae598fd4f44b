"""The text rules in plain Python, to compare the Spark expressions with.

Written from the rules as FIXTURES.md states them: characters are told apart by their Unicode category.
"""

import re
import unicodedata

# Fixed value: what counts as a link.
LINK = re.compile(r"http\S+|www.\S+")


def _stays(char):
    return char in "_.,!?-" or unicodedata.category(char)[0] in "LN" or char.isspace()


def clean(text):
    """Lower case; links go, then every character but letters, digits, ``_.,!?-`` and white space; blanks become one."""
    unlinked = LINK.sub("", (text or "").lower())
    return " ".join("".join(filter(_stays, unlinked)).split())


def polarity(text, lexicon):
    good = sum(word in text for word in lexicon.positive)
    bad = sum(word in text for word in lexicon.negative)
    return (good - bad) / (good + bad) if good + bad else 0.0


def topics(text, lexicon):
    found = [name for name, words in lexicon.topics if any(word in text for word in words)]
    return found or [lexicon.fallback_topic]


def entities(raw, lexicon):
    return [name for name in lexicon.entities if name in (raw or "").lower()]

"""Word lists, cut points and column orders that results depend on.

Everything here is data, not logic. The order of the topic lists matters: the first topic that hits is
the primary one, and entities come out in list order.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lexicon:
    """Word lists used by the text operators. ``topics`` is an ordered tuple of (name, words)."""

    positive: tuple[str, ...]
    negative: tuple[str, ...]
    topics: tuple[tuple[str, tuple[str, ...]], ...]
    entities: tuple[str, ...]
    fallback_topic: str = "other"

    @property
    def topic_names(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.topics) + (self.fallback_topic,)


# The batch word lists.
BATCH = Lexicon(
    positive=("good", "great", "support", "peace", "agreement", "success", "win", "positive"),
    negative=("war", "conflict", "death", "attack", "ban", "restrict", "threat", "crisis"),
    topics=(
        ("war_conflict", ("war", "military", "conflict", "attack", "troops", "defense", "battle", "invasion")),
        ("trade_economy", ("trade", "economy", "gdp", "tariff", "export", "import", "market", "deal")),
        ("politics", ("election", "president", "government", "minister", "political", "vote", "congress")),
        ("climate", ("climate", "environment", "carbon", "renewable", "pollution", "emissions")),
        ("technology", ("tech", "ai", "cyber", "digital", "software", "data", "internet")),
        ("healthcare", ("health", "covid", "vaccine", "hospital", "medical", "pandemic")),
        ("diplomacy", ("diplomat", "foreign", "embassy", "treaty", "alliance", "summit")),
        ("migration", ("refugee", "migration", "border", "asylum", "immigrant")),
    ),
    entities=(
        "usa", "us", "america", "china", "russia", "ukraine", "israel", "palestine",
        "uk", "britain", "france", "germany", "india", "pakistan", "iran", "turkey",
        "saudi", "canada", "australia", "japan", "korea", "mexico", "brazil", "greenland",
    ),
)

# The streaming word lists (one topic per post, first hit wins).
STREAM = Lexicon(
    positive=("good", "great", "support", "peace", "success", "win"),
    negative=("war", "conflict", "death", "attack", "ban", "threat"),
    topics=(
        ("war_conflict", ("war", "military", "troops", "defense")),
        ("politics", ("trump", "president", "election", "minister")),
        ("trade_economy", ("trade", "economy", "deal")),
        ("policy", ("ban", "restrict", "law")),
    ),
    entities=(
        "usa", "us", "china", "russia", "ukraine", "israel",
        "uk", "iran", "india", "pakistan", "greenland",
    ),
)

# Sentiment labels and the cut around zero.
SENTIMENT_CUT = 0.1
SUBJECTIVITY = 0.5

# Bucket edges as (last value inside, name); anything above gets the final name.
TIME_PERIODS = ((6, "night"), (12, "morning"), (18, "afternoon"))
LAST_PERIOD = "evening"
ENGAGEMENT = ((10, "low"), (50, "medium"), (100, "high"))
TOP_ENGAGEMENT = "viral"

# Load stamps.
SOURCE_API = "reddit"
RAW_FLAG = "raw"
MANIFEST_VERSION = "1.0"

# The sentences of the insights.
BEST_TITLE = "Highest Engagement: "
BEST_TEXT = "Posts about %s receive avg score of %s, %s%% above average"
PEAK_TITLE = "Peak Activity at %d:00"
PEAK_TEXT = "Most posts created around %d:00 UTC (%d posts)"

# White space as Unicode knows it. Java and RE2 take \s and \w as ASCII, so the wider set
# is spelled out, and letters and digits are named by category.
SPACE = (
    r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
URLS = rf"http[^{SPACE}]+|www[^\n][^{SPACE}]+"
URL_STARTS = ("http", "www")
KEPT = r"\p{L}\p{N}_.,!?\-"
DROPPED = f"[^{KEPT}{SPACE}]"
SPACES = f"[{SPACE}]+"
NON_WORD = r"[^\p{L}\p{N}_]+"
EDGE_SPACE = f"^[{SPACE}]+|[{SPACE}]+$"

# How bronze and silver are laid out.
SILVER_PARTITIONS = ("subreddit",)
BRONZE_PARTITIONS = ("subreddit", "partition_year", "partition_month", "partition_day")

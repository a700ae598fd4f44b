"""Pieces of the checking SQL (DuckDB dialect)."""

from __future__ import annotations

from postlake import fixed
from postlake.fixed import Lexicon
from postlake.sources.testtables import FRAGMENTS


def rounded(value: str, digits: int) -> str:
    """Round half up on the decimal text of a double, as Spark does."""
    return f"cast(round(cast(cast({value} AS varchar) AS decimal(38,18)), {digits}) AS double)"


def steady(value: str, digits: int) -> str:
    """Round to 12 digits first: means of fractions differ in their last bits from run to run."""
    return rounded(rounded(value, 12), digits)


def clean(column: str) -> str:
    text = f"lower(coalesce({column}, ''))"
    for pattern, by in ((fixed.URLS, ""), (fixed.DROPPED, ""), (fixed.SPACES, " ")):
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return f"trim({text}, ' ')"


def padded(column: str) -> str:
    return f"(' ' || regexp_replace({column}, '{fixed.NON_WORD}', ' ', 'g') || ' ')"


def _hit(text: str, word: str) -> str:
    return f"contains({text}, '{word}')"


def hits(text: str, words: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"{_hit(text, word)}::int" for word in words) + ")"


def polarity(text: str, lexicon: Lexicon) -> str:
    good, bad = hits(text, lexicon.positive), hits(text, lexicon.negative)
    return f"CASE WHEN {good} + {bad} = 0 THEN 0.0::double ELSE ({good} - {bad})::double / ({good} + {bad}) END"


LABEL = "CASE WHEN {0} > 0.1 THEN 'positive' WHEN {0} < -0.1 THEN 'negative' ELSE 'neutral' END"


def label(score: str) -> str:
    return LABEL.format(score)


def _any(text: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(_hit(text, word) for word in words) + ")"


def topics(text: str, lexicon: Lexicon, pad: str = "") -> str:
    marks = ", ".join(
        f"CASE WHEN {_any(text, tuple(pad + w + pad for w in words))} THEN '{name}' END"
        for name, words in lexicon.topics
    )
    found = f"list_filter([{marks}], lambda x: x IS NOT NULL)"
    return f"CASE WHEN len({found}) > 0 THEN {found} ELSE ['{lexicon.fallback_topic}'] END"


def first_topic(text: str, lexicon: Lexicon) -> str:
    cases = " ".join(f"WHEN {_any(text, words)} THEN '{name}'" for name, words in lexicon.topics)
    return f"CASE {cases} ELSE '{lexicon.fallback_topic}' END"


def entities(raw: str, lexicon: Lexicon, pad: str = "") -> str:
    names = ", ".join(f"'{name}'" for name in lexicon.entities)
    word = f"'{pad}' || x || '{pad}'" if pad else "x"
    return f"list_filter([{names}], lambda x: contains({raw}, {word}))"


def listed(items: str) -> str:
    return f"('[' || array_to_string({items}, ',') || ']')"


def words(text: str) -> str:
    return f"cast(CASE WHEN {text} = '' THEN 0 ELSE len(string_split({text}, ' ')) END AS int)"


PERIOD = (
    "CASE WHEN {0} <= 6 THEN 'night' WHEN {0} <= 12 THEN 'morning' WHEN {0} <= 18 THEN 'afternoon' ELSE 'evening' END"
)
BUCKET = "CASE WHEN {0} < 10 THEN 'low' WHEN {0} < 50 THEN 'medium' WHEN {0} < 100 THEN 'high' ELSE 'viral' END"

POSTS = """posts AS (
  SELECT cast(e.event_id AS varchar) AS post_id, e.event_type AS subreddit,
         split_part(d.text, chr(10), 1) AS title,
         CASE WHEN contains(d.text, chr(10)) THEN substr(d.text, instr(d.text, chr(10)) + 1) END AS body,
         'u' || e.user_id AS author,
         cast(floor(epoch(e.ts)) AS bigint) AS created_utc,
         cast(floor(e.value) AS int) AS score
  FROM (SELECT *, event_id % (SELECT count(*) FROM documents) AS place FROM events) e
  JOIN documents d ON d.doc_id = e.place
)"""

BRONZE = f"""{POSTS}, bronze AS (
  SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp, 'batch_1' AS batch_id,
         'reddit' AS source_api, 'raw' AS data_quality_flag,
         md5(post_id || '_' || created_utc) AS row_hash,
         make_timestamp(created_utc * 1000000) AS created_datetime
  FROM posts
), dated AS (
  SELECT *, cast(created_datetime AS date) AS partition_date,
         cast(year(created_datetime) AS int) AS partition_year,
         cast(month(created_datetime) AS int) AS partition_month,
         cast(day(created_datetime) AS int) AS partition_day
  FROM bronze
)"""


def silver(lexicon: Lexicon = FRAGMENTS) -> str:
    """The enriched posts as CTE ``silver``."""
    return f"""{BRONZE}, cleaned AS (
  SELECT *, {clean('title')} AS title_cleaned, {clean('body')} AS body_cleaned, lower(title) AS title_lower
  FROM dated
), scored AS (
  SELECT *, {polarity('title_cleaned', lexicon)} AS sentiment_polarity,
         {topics('title_cleaned', lexicon)} AS topics,
         {entities('title_lower', lexicon)} AS entities,
         cast(hour(created_datetime) AS int) AS hour_of_day,
         cast(dayofweek(created_datetime) + 1 AS int) AS day_of_week
  FROM cleaned
), silver AS (
  SELECT * EXCLUDE (title_lower), {label('sentiment_polarity')} AS sentiment,
         0.5::double AS sentiment_subjectivity,
         topics[1] AS primary_topic, cast(len(entities) AS int) AS entity_count,
         cast({words('title_cleaned')} AS int) AS title_word_count,
         cast({words('body_cleaned')} AS int) AS body_word_count,
         body_cleaned <> '' AS has_body, cast(length(title_cleaned) AS int) AS title_char_count,
         dayname(created_datetime) AS day_name, day_of_week IN (1, 7) AS is_weekend,
         {PERIOD.format('hour_of_day')} AS time_period,
         (score - min(score) OVER ())::double / (max(score) OVER () - min(score) OVER ()) * 100
           AS score_normalized,
         {BUCKET.format('score')} AS engagement_category,
         cast(created_datetime AS date) AS date
  FROM scored
)"""


def streamed(lexicon: Lexicon = FRAGMENTS) -> str:
    """The streamed posts as CTE ``streamed``."""
    return f"""{POSTS}, cleaned AS (
  SELECT *, {clean('title')} AS title_cleaned, {clean('body')} AS body_cleaned,
         make_timestamp(created_utc * 1000000) AS created_datetime,
         {entities('lower(title)', lexicon)} AS entities
  FROM posts
), scored AS (
  SELECT *, {polarity('title_cleaned', lexicon)} AS sentiment_score FROM cleaned
), streamed AS (
  SELECT post_id, subreddit, title, title_cleaned, body, body_cleaned, author, created_utc,
         created_datetime, score, sentiment_score, {label('sentiment_score')} AS sentiment,
         {first_topic('title_cleaned', lexicon)} AS topic, {listed('entities')} AS entities_str,
         cast(len(entities) AS int) AS entity_count,
         cast({words('title_cleaned')} AS int) AS title_word_count,
         body_cleaned <> '' AS has_body, {BUCKET.format('score')} AS engagement_category,
         created_datetime AS kafka_ingestion_time,
         make_timestamp((created_utc + score) * 1000000) AS processing_timestamp
  FROM scored
)"""


def growth(value: str, keys: str, order: str = "date") -> str:
    before = f"lag({value}) OVER (PARTITION BY {keys} ORDER BY {order})"
    return rounded(f"({value} - {before}) / nullif({before}, 0)::double * 100", 2)

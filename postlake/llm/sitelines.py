"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import common

#: A line is boilerplate of its host if more than this share of the host's pages have it ...
MAX_RATIO = 0.3
#: ... and at least so many pages, as any line of a site of one or two pages is on a large share of them.
MIN_PAGES = 5
HIDDEN = "(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<head[ >].*?</head>"
BLOCKS = (
    "(?i)</?(?:p|div|li|ul|ol|dl|dt|dd|h[1-6]|br|hr|tr|td|th|table|nav|article|section|header|footer|main|aside|title|"
    "body|html|pre|blockquote|form)(?:[ /][^>]*)?>"
)
TAGS = "<[^>]*>"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
HOST = "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The host of an address in lower case; null where there is none."""
    return F.nullif(F.regexp_extract(F.lower(url), HOST, 1), F.lit(""))


def html_text(html: Column) -> Column:
    """The text of a page, a line for each block; scripts, styles, comments and the head are left out."""
    text = F.regexp_replace(html, HIDDEN, " ")
    text = F.regexp_replace(F.regexp_replace(text, BLOCKS, "\n"), TAGS, "")
    for name, sign in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def _lines(text: Column) -> Column:
    """The lines of a text with blanks trimmed, in order; null text has none."""
    return F.coalesce(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), F.array().cast("array<string>"))


def _mark(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(1)).alias("b"))


def boilerplate(
    rows: DataFrame, host: Column, text: Column, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, once: bool = False,
) -> DataFrame:
    """For each host the marks of its boilerplate lines; with ``once``, pages of the same lines count as one page.

    A line counts once for each page that has it. Each task counts its own pages first, so a host or a line that a
    third of all pages have is one row of each task in the shuffle. A host has at most (mean lines of a page) /
    ``max_ratio`` such lines, so the list of a host is bounded by the size of a page, not by that of the site.
    """
    # Each page gives its distinct lines and, under a null mark, itself: counts and totals come from one shuffle.
    seen = F.array_distinct(F.transform(F.filter(_lines(text), lambda x: x != ""), _mark))
    pages = rows.select(host.alias("host"), seen.alias("seen"))
    if once:
        pages = pages.withColumns({"a": F.xxhash64("seen"), "b": F.xxhash64(F.lit(1), "seen")}).dropDuplicates(["host", "a", "b"])
    own = F.concat("seen", F.array(F.lit(None).cast("struct<a:bigint,b:bigint>")))
    # explode_outer: explode would have Spark filter on the array first and so make it twice.
    pages = pages.select("host", F.explode_outer(own).alias("mark")).filter("host IS NOT NULL")
    counts = pages.groupBy("host", "mark").agg(F.count("*").alias("n")).filter((F.col("n") >= min_pages) | F.col("mark").isNull())
    counts = common.written(counts, "line-counts")  # read twice, and far smaller than the texts
    totals = counts.filter("mark IS NULL").select("host", F.col("n").alias("total"))
    often = counts.filter("mark IS NOT NULL").join(totals, "host").filter(F.col("n") > max_ratio * F.col("total"))
    # Written, so that the join with the pages reads two plain tables: only then can Spark split the pages of a large host.
    return common.written(often.groupBy("host").agg(F.collect_list("mark").alias("marks")), "marks")


def drop_boilerplate(
    rows: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
    removed: str | None = None, once: bool = False,
) -> DataFrame:
    """``rows`` without the boilerplate lines of their hosts, with the columns unchanged.

    For every host, the pages with a line are divided by all pages of the host, and lines above ``max_ratio`` go from
    every page, all their occurrences. Lines are compared without blanks around them; empty ones stay. Rows without a
    host are left as they are; a null text stays null and counts as a page without lines; repeated rows count as a page
    each, or with ``once`` all pages of a host that have the same lines as a single one, so that copies don't make their
    text boilerplate. An empty table gives an empty one. ``removed`` names a column for the number of lines taken away.
    """
    names = rows.columns
    marked = boilerplate(rows, rows[host], rows[text], max_ratio, min_pages, once)
    site, marks, kept, gone = (common.fresh(names, x) for x in ("site", "marks", "kept", "gone"))
    marked = marked.select(F.col("host").alias(site), F.col("marks").alias(marks))
    joined = rows.join(marked, rows[host] == F.col(site), "left")
    lines = F.split(F.col(f"`{text}`"), "\n")
    stays = F.filter(lines, lambda x: ~F.array_contains(F.col(marks), _mark(F.trim(x))) | (F.trim(x) == ""))
    out = joined.withColumn(kept, F.when(F.col(marks).isNull(), lines).otherwise(stays))
    out = out.withColumn(gone, F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).cast("long"))
    columns = [F.array_join(kept, "\n").alias(c) if c == text else F.col(f"`{c}`") for c in names]
    return out.select(*columns, *([F.col(gone).alias(removed)] if removed else []))


def query(spark: SparkSession, folder: str) -> DataFrame:
    pages = common.table(spark, folder, "pages")
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), html_text(F.col("html")).alias("text"))
    lines = F.filter(_lines(F.col("text")), lambda x: x != "")
    rows = rows.withColumn("text", F.array_join(lines, "\n"))
    kept = drop_boilerplate(rows, "host", "text", removed="n_dropped")
    return kept.select("page_id", "host", "n_dropped", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


def _sql() -> str:
    text = f"regexp_replace(html, '{HIDDEN}', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{BLOCKS}', chr(10), 'g'), '{TAGS}', '', 'g')"
    for name, sign in ENTITIES:
        text = f"replace({text}, '{name}', '{sign.replace(chr(39), chr(39) * 2)}')".replace("'&#39;'", "'&#39;'")
    return f"""
WITH p AS (
  SELECT page_id, nullif(regexp_extract(lower(url), '{HOST}', 1), '') AS host,
         list_filter(list_transform(string_split(coalesce({text}, ''), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS ls
  FROM pages),
t AS (SELECT host, count(*) AS total FROM p WHERE host IS NOT NULL GROUP BY host),
c AS (SELECT host, l, count(*) AS n FROM (SELECT host, unnest(list_distinct(ls)) AS l FROM p WHERE host IS NOT NULL) GROUP BY host, l),
b AS (SELECT host, list(l) AS bad FROM c JOIN t USING (host) WHERE n >= {MIN_PAGES} AND n > {MAX_RATIO} * total GROUP BY host),
k AS (
  SELECT p.page_id, p.host, p.ls, CASE WHEN b.bad IS NULL THEN p.ls ELSE list_filter(p.ls, lambda x: NOT list_contains(b.bad, x)) END AS kept
  FROM p LEFT JOIN b ON p.host = b.host)
SELECT page_id, host, len(ls) - len(kept) AS n_dropped, md5(array_to_string(kept, chr(10))) AS text_md5,
       length(array_to_string(kept, chr(10))) AS n_chars
FROM k"""


SQL = _sql()

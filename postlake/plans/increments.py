"""Silver and gold kept up to date load by load.

Silver lies in days. A load changes some posts: those that are new, and those of which it has a later version. A narrow table
of keyed versions tells on which day each post stands, so only the days that changed posts come to or leave are read
and written anew; all other folders stay as they are. Gold is stored as what the posts of each day give (``STATES``),
made anew for the same days; growth between days, peaks and totals over all days are taken from these small tables on
reading. Silver and gold of a load become visible together, with one snapshot. The result is that of a full run.

Scores are normalised on reading: their range over all posts follows from the smallest and the largest one of each day,
which the snapshot holds, so a new extreme rewrites nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake import fixed, schema
from postlake.fixed import Lexicon
from postlake.functions import features
from postlake.operators import dedup, gold, silver
from postlake.sinks.keyed import KeyedTable
from postlake.sinks.snapshots import Snapshot, Snapshots

_LEAD = [c for c in dedup.LATEST if c in schema.BRONZE.names]
_INDEX = T.StructType([schema.BRONZE["post_id"], *[schema.BRONZE[c] for c in _LEAD], T.StructField("slot", T.StringType())])
_STORED = T.StructType([f for f in schema.SILVER.fields if f.name != "score_normalized"])

_same = lambda stored: stored

#: For each gold table what a day's posts give, and the table from the days.
STATES: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]] = {
    "daily_subreddit_stats": (gold.daily_base, lambda s: gold.with_growth(s, "total_posts", "posts_growth_rate", ["subreddit"])),
    "trending_topics": (gold.topic_base, gold.with_trend),
    "user_engagement": (gold.user_engagement, _same),
    "cross_subreddit_comparison": (gold.cross_comparison, _same),
    "hourly_patterns": (lambda p: gold.hourly_parts(p, "partition_date"), gold.hourly_from_parts),
    "entity_network": (lambda p: gold.network_parts(p, "partition_date"), gold.network_from_parts),
    "sentiment_timeseries": (gold.sentiment_timeseries, _same),
}


def slot_of(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit("none"))


class Increments:
    """Incremental silver and gold below ``root``. ``buckets`` are those of the table of versions."""

    def __init__(
        self, spark: SparkSession, root: str, lexicon: Lexicon = fixed.BATCH, match: str = "substring",
        reference_compat: bool = False, buckets: int = 64,
    ):
        self.spark, self.enrich = spark, lambda posts: silver.enrich(posts, lexicon, match, reference_compat)
        self.snapshots = Snapshots(spark, f"{root}/increments")
        self.versions = KeyedTable(spark, f"{root}/increments/versions", _INDEX, lead=_LEAD, buckets=buckets)

    def _days(self, snapshot: Snapshot, table: str, row_type: T.StructType, days=None) -> DataFrame:
        chosen = [x for x in snapshot.slots if x.startswith(f"{table}/") and (days is None or x.split("/", 1)[1] in days)]
        return self.snapshots.rows(snapshot, row_type, chosen)

    def add(self, load: str, bronze: DataFrame) -> Snapshot:
        """Take in the bronze rows of a load. One that is in already is left alone."""
        before = self.snapshots.read()
        if load in before.meta.get("loads", []):
            return before
        stage = self.snapshots.new_folder()
        try:
            return self._add(load, bronze, before, stage)
        finally:
            self.snapshots.remove(stage)

    def _add(self, load: str, bronze: DataFrame, before: Snapshot, stage: str) -> Snapshot:
        spark, root = self.spark, self.snapshots.root
        names = schema.BRONZE.names

        def staged(rows: DataFrame, name: str) -> DataFrame:
            rows.write.parquet(f"{root}/{stage}/{name}")
            return spark.read.schema(rows.schema).parquet(f"{root}/{stage}/{name}")

        # Texts stay in their files: what is compared and joined are narrow columns and places.
        raw = staged(bronze.select(*names), "raw")
        fresh = dedup.at_places(raw, dedup.latest_places(raw)).select("post_id", *_LEAD, slot_of(F.col("partition_date")).alias("to"), "file", "at")
        index = before.meta.get("versions", 0)
        known = self.versions.matching(fresh, index).select(F.col("post_id").alias("known"), F.struct(*_LEAD).alias("held"), F.col("slot").alias("from"))
        # Equal versions go on too: their other columns decide.
        changed = fresh.join(known, F.col("post_id") == F.col("known"), "left").filter(F.col("held").isNull() | (F.struct(*_LEAD) >= F.col("held")))
        changed = staged(changed.select("post_id", "from", "to", "file", "at"), "changed")
        days = {x[0] for x in changed.select(F.explode(F.array_compact(F.array("from", "to")))).distinct().collect()}
        if not days:
            return self.snapshots.commit(before, before.slots, before.meta | {"loads": [*before.meta.get("loads", []), load]})

        stored = self._days(before, "silver", _STORED, days)
        winners = dedup.at_places(raw, changed).select(*names)
        held = any(x.startswith("silver/") and x.split("/", 1)[1] in days for x in before.slots)
        if held:
            old = staged(dedup.with_places(stored).join(changed.select("post_id"), "post_id", "left_semi").select("file", "at"), "old")
            rivals = dedup.at_places(stored, old).select(*names).unionByName(winners)
            winners = dedup.latest_stored(staged(rivals, "rivals"))
            stored = dedup.at_places(stored, old, others=True)
        new = self.enrich(winners.hint("rebalance", "partition_date")).select(*_STORED.names)
        rows = (stored.select(*_STORED.names).unionByName(new) if held else new).withColumn("slot", slot_of(F.col("partition_date")))
        folder = self.snapshots.new_folder()
        # New rows are gathered by day, and stored ones lie in days.
        rows.write.partitionBy("slot").parquet(f"{root}/{folder}/silver")

        slots = {k: v for k, v in before.slots.items() if k.split("/", 1)[1] not in days}
        ranges = {k: v for k, v in before.meta.get("ranges", {}).items() if k not in days}
        written = spark.read.schema(T.StructType([*_STORED.fields, T.StructField("slot", T.StringType())])).parquet(f"{root}/{folder}/silver")
        for day, low, high in written.groupBy("slot").agg(F.min("score"), F.max("score")).collect():
            slots[f"silver/{day}"], ranges[day] = f"{folder}/silver/slot={day}", [low, high]
        for name, (state, _) in STATES.items():
            rows = state(written.drop("slot"))
            day = slot_of(F.col("date" if "date" in rows.columns else "partition_date"))
            rows.withColumn("slot", day).hint("rebalance", "slot").write.partitionBy("slot").parquet(f"{root}/{folder}/{name}")
            for part in self.snapshots.parts(f"{folder}/{name}"):  # days without rows have none
                slots[f"{name}/{part.removeprefix('slot=')}"] = f"{folder}/{name}/{part}"
        versions = self.versions.merge(winners.select("post_id", *_LEAD, slot_of(F.col("partition_date")).alias("slot")), index, replace=True)
        meta = {"loads": [*before.meta.get("loads", []), load], "ranges": ranges, "versions": versions.number}
        return self.snapshots.commit(before, slots, meta)

    def silver(self) -> DataFrame:
        """The silver table, scores normalised over all of it."""
        snapshot = self.snapshots.read()
        ends = [x for pair in snapshot.meta.get("ranges", {}).values() for x in pair if x is not None]
        kind = schema.SILVER["score"].dataType
        low, high = (F.lit(f(ends) if ends else None).cast(kind) for f in (min, max))
        rows = self._days(snapshot, "silver", _STORED)
        return rows.withColumn("score_normalized", features.min_max(F.col("score"), low, high)).select(*schema.SILVER.names)

    def gold(self, name: str) -> DataFrame:
        """A gold table, from what is stored of each day."""
        state, whole = STATES[name]
        row_type = state(self.spark.createDataFrame([], _STORED)).schema
        return whole(self._days(self.snapshots.read(), name, row_type))

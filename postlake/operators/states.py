"""Views and rollups from mergeable states: counts, sums, squares, extremes and author sketches of each group.

States of two sets of posts merge into that of both, so a refresh reads the new posts and the old states, not the old posts.
Whole-number columns come out exactly as from all posts at once; the deviation of scores is taken from exact sums.
Distinct authors are estimated from a sketch (standard error about 1.04 / sqrt(2^k), 1.6 % with k = 12), or counted in a
table of the pairs seen, which is kept beside the states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake import schema
from postlake.functions import features
from postlake.operators import warehouse
from postlake.sinks.snapshots import Snapshot, Snapshots

#: 2^k counters of a sketch.
SKETCH_K = 12


def _measures() -> dict[str, tuple[Column, Column]]:
    """What is kept of a group: as made of posts, and as made of states."""
    squares = F.col("score").cast("decimal(19,0)") * F.col("score")
    made = {
        "rows": F.count(F.lit(1)), "scored": F.count("score"), "score_sum": F.sum("score"), "score_squares": F.sum(squares).cast("decimal(38,0)"),
        "felt": F.count("sentiment_score"), "feeling_sum": F.sum("sentiment_score"),
        "worded": F.count("title_word_count"), "words_sum": F.sum("title_word_count"), "with_body": F.count_if("has_body"),
    }
    out = {name: (make, F.sum(name)) for name, make in made.items()}
    out["score_squares"] = (made["score_squares"], F.sum("score_squares").cast("decimal(38,0)"))
    out |= {"score_max": (F.max("score"), F.max("score_max")), "last": (F.max("created_datetime"), F.max("last"))}
    return out | {"authors": (F.hll_sketch_agg("author", SKETCH_K), F.hll_union_agg("authors"))}


#: Group columns of each view.
KEYS: dict[str, dict[str, str]] = {
    "mv_daily_subreddit_stats": {"subreddit": "subreddit", "date": "to_date(created_datetime)"},
    "mv_hourly_sentiment": {"hour": "date_trunc('hour', created_datetime)", "subreddit": "subreddit", "sentiment": "sentiment"},
    "mv_topic_performance": {"topic": "topic", "subreddit": "subreddit"},
    "subreddit_rollup": {"subreddit": "subreddit"},
    "topic_rollup": {"topic": "topic"},
}
#: Those that count authors.
WITH_AUTHORS = ("mv_daily_subreddit_stats", "mv_topic_performance", "subreddit_rollup")


def state(posts: DataFrame, view: str) -> DataFrame:
    made = {name: make for name, (make, _) in _measures().items() if name != "authors" or view in WITH_AUTHORS}
    return posts.groupBy(*[F.expr(c).alias(n) for n, c in KEYS[view].items()]).agg(*[c.alias(n) for n, c in made.items()])


def merged(states: DataFrame, view: str) -> DataFrame:
    """One state for each group, of states of disjoint sets of posts."""
    return states.groupBy(*KEYS[view]).agg(*[merge.alias(name) for name, (_, merge) in _measures().items() if name in states.columns])


def author_pairs(posts: DataFrame, view: str) -> DataFrame:
    """The authors of each group, once."""
    return posts.filter("author IS NOT NULL").select(*[F.expr(c).alias(n) for n, c in KEYS[view].items()], "author").distinct()


def view_of(states: DataFrame, view: str, pairs: DataFrame | None = None, at: Column | None = None) -> DataFrame:
    """The view from its merged states. Authors are counted in ``pairs``, or estimated without them."""
    keys = list(KEYS[view])
    if view in WITH_AUTHORS and pairs is None:
        states = states.withColumn("unique_authors", F.hll_sketch_estimate("authors"))
    elif view in WITH_AUTHORS:
        counted = pairs.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
        same = [states[k].eqNullSafe(counted[f"__{k}"]) for k in keys]
        states = states.join(counted, same, "left").withColumn("unique_authors", F.coalesce("__n", F.lit(0)))
    mean = lambda total, n: F.try_divide(F.col(total).cast("double"), F.col(n))
    n, total = F.col("scored").cast("decimal(38,0)"), F.col("score_sum").cast("decimal(38,0)")
    spread = F.sqrt(F.try_divide((n * F.col("score_squares") - total * total).cast("double"), (n * (n - 1)).cast("double")))
    score, feeling = mean("score_sum", "scored"), mean("feeling_sum", "felt")
    columns = {
        "mv_daily_subreddit_stats": {
            "total_posts": F.col("rows"), "total_score": F.col("score_sum"), "avg_score": score, "max_score": F.col("score_max"),
            "score_stddev": spread, "avg_sentiment": feeling, "avg_title_length": mean("words_sum", "worded"),
            "posts_with_body": F.col("with_body"), "unique_authors": F.col("unique_authors"),
        },
        "mv_hourly_sentiment": {"count": F.col("rows"), "avg_score": feeling, "avg_engagement": score},
        "mv_topic_performance": {
            "mention_count": F.col("rows"), "avg_score": score, "avg_sentiment": feeling, "unique_authors": F.col("unique_authors"), "last_mention": F.col("last"),
        },
        "subreddit_rollup": {
            "total_posts": F.col("rows"), "total_score": F.col("score_sum"), "avg_score": F.round(score, 2), "max_score": F.col("score_max"),
            "unique_authors": F.col("unique_authors"), "last_post_time": F.col("last"), "last_updated": F.current_timestamp() if at is None else at,
        },
        "topic_rollup": {
            "total_mentions": F.col("rows"), "avg_score": F.round(score, 2), "avg_sentiment": features.steady_round(feeling, 3),
            "last_updated": F.current_timestamp() if at is None else at,
        },
    }
    return states.select(*keys, *[c.alias(name) for name, c in columns[view].items()])


class Views:
    """The states of all views below ``root``, refreshed load by load."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.snapshots = spark, Snapshots(spark, f"{root}/views")

    def _type(self, view: str, make) -> T.StructType:
        return make(self.spark.createDataFrame([], schema.STREAM_ROW), view).schema

    def _states(self, snapshot: Snapshot, view: str) -> DataFrame:
        return self.snapshots.rows(snapshot, self._type(view, state), [f"state/{view}"])

    def _pairs(self, snapshot: Snapshot, view: str) -> DataFrame:
        parts = [x for x in snapshot.slots if x.startswith(f"authors/{view}/")]
        return self.snapshots.rows(snapshot, self._type(view, author_pairs), parts)

    def refresh(self, load: str, posts: DataFrame) -> Snapshot:
        """Take in the posts of a load, each of which must be new. A load that is in already is left alone.

        States are written anew, one row for each group; of authors only the pairs that are new, in a folder of the load.
        All views change together.
        """
        before = self.snapshots.read()
        loads = before.meta.get("loads", [])
        if load in loads:
            return before
        folder, slots = self.snapshots.new_folder(), dict(before.slots)
        for view in KEYS:
            both = self._states(before, view).unionByName(state(posts, view))
            merged(both, view).write.parquet(f"{self.snapshots.root}/{folder}/{view}")
            slots[f"state/{view}"] = f"{folder}/{view}"
        for view in WITH_AUTHORS:
            old = self._pairs(before, view)
            new = author_pairs(posts, view)
            # A set difference: nulls of the keys are equal here.
            new.exceptAll(old).write.parquet(f"{self.snapshots.root}/{folder}/authors-{view}")
            slots[f"authors/{view}/{load}"] = f"{folder}/authors-{view}"
        return self.snapshots.commit(before, slots, {"loads": [*loads, load]})

    def view(self, name: str, exact: bool = True, at: Column | None = None) -> DataFrame:
        """A view or rollup as of the last refresh, its authors counted or estimated. ``at`` is the time a rollup bears."""
        snapshot = self.snapshots.read()
        pairs = self._pairs(snapshot, name) if exact and name in WITH_AUTHORS else None
        return view_of(self._states(snapshot, name), name, pairs, at)


FULL = {**warehouse.VIEWS, "subreddit_rollup": warehouse.subreddit_rollup, "topic_rollup": warehouse.topic_rollup}

"""View states: merged load by load against a full recompute."""

import random

from pyspark.sql import functions as F

from postlake import schema
from postlake.operators import states
from postlake.operators.states import FULL, Views

def made_at():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def posts_of(spark, rng, n):
    pick = rng.choice
    rows = [(i, pick(["a", "b", None]), pick([f"u{rng.randint(0, 3000)}", "hot", None]), 1704067200 + 3600 * rng.randint(0, 60), pick([None, 0, 7, 2_000_000_000, -5]), pick([None, 0.25, -0.125]),
             pick(["positive", "negative", None]), pick(["x", "y", None]), pick([None, 3, 4]), pick([True, False, None])) for i in range(n)]
    df = spark.createDataFrame(rows, "post_id long, subreddit string, author string, at long, score int, sentiment_score double, sentiment string, topic string, title_word_count int, has_body boolean")
    df = df.withColumn("created_datetime", F.timestamp_seconds("at"))
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.STREAM_ROW.fields])


def rows_of(df):
    """Doubles to twelve digits: the last ones depend on the order of summing."""
    return sorted(repr([f"{r[n]:.12g}" if isinstance(r[n], float) else r[n] for n in sorted(df.columns)]) for r in df.collect())


def full(posts, name):
    return FULL[name](posts, made_at()) if name.endswith("rollup") else FULL[name](posts)


def test_refreshes_equal_a_full_recompute(spark, tmp_path):
    posts = posts_of(spark, random.Random(3), 6000).cache()
    views = Views(spark, str(tmp_path))
    parts = [posts.filter(F.col("post_id") % 3 == i) for i in range(3)]
    for number, part in enumerate([*parts, parts[0].limit(0)]):
        views.refresh(f"load_{number}", part)
    number = views.snapshots.read().number
    assert views.refresh("load_1", parts[1]).number == number == 4
    for name in states.KEYS:
        assert rows_of(views.view(name, at=made_at())) == rows_of(full(posts, name)), name
        assert views.view(name, at=made_at()).dtypes == full(posts, name).dtypes
    for name in states.WITH_AUTHORS:
        exact = {tuple(r[k] for k in states.KEYS[name]): r.unique_authors for r in views.view(name).collect()}
        about = {tuple(r[k] for k in states.KEYS[name]): r.unique_authors for r in views.view(name, exact=False).collect()}
        assert max(exact.values()) > 200 and exact.keys() == about.keys()
        assert all(abs(about[k] - n) <= 1 + 0.066 * n for k, n in exact.items())  # four standard errors
    part = views.snapshots.rows(views.snapshots.read(), views._type("subreddit_rollup", states.author_pairs), ["authors/subreddit_rollup/load_2"])
    assert 0 < part.count() < states.author_pairs(parts[2], "subreddit_rollup").count()  # only pairs not seen before

"""Increments: the same rows as a full run, and what is read and written for them."""

import random

import pytest
from pyspark.sql import functions as F

from postlake import schema
from postlake.operators import bronze, silver, summaries
from postlake.plans.increments import STATES, Increments
from postlake.sources.testtables import FRAGMENTS

TITLES = ["with the hand and eren ungern", "und thes anea schen elle", "ating from thor ment", "", None, "les keit eaux dans und hand", "nothing here"]


def loads_of(spark, rng, n_loads, days):
    """Loads with new posts, and later, earlier and equal versions of old ones, some of them on another day."""
    out = []
    for number in range(n_loads):
        rows = []
        for _ in range(60):
            day = rng.choice(days)
            rows.append((
                f"p{rng.randint(0, 80)}", rng.choice(["a", "b", None]), rng.choice(TITLES), rng.choice(["text body", "", None]),
                rng.choice(["u1", "u2", "u3"]), None if day is None else 1704067200 + 86400 * day + 3600 * rng.randint(0, 23), rng.choice([None, 1, 2, 50, 3000 + number, -number]),
            ))
        posts = spark.createDataFrame(rows, schema.POST)
        at = F.timestamp_seconds(F.lit(1706745600 + 60 * rng.choice([0, number, number])))
        out.append(bronze.build(posts, f"batch_{number}", ingested_at=at).cache())
    return out


def rows_of(df):
    names = sorted(df.columns)
    return sorted(repr([r[n] for n in names]) for r in df.collect())


def check(found, loads):
    bronze_rows = loads[0]
    for load in loads[1:]:
        bronze_rows = bronze_rows.unionByName(load)
    full = silver.build(bronze_rows, FRAGMENTS).cache()
    assert rows_of(found.silver()) == rows_of(full)
    for name, table in summaries.gold_tables(full).items():
        assert rows_of(found.gold(name)) == rows_of(table), name


def test_loads_one_by_one_equal_a_full_run(spark, tmp_path):
    rng = random.Random(1)
    loads = loads_of(spark, rng, 3, [0, 1, 2, None])
    found = Increments(spark, str(tmp_path), FRAGMENTS, buckets=4)
    assert found.silver().count() == 0
    for number, load in enumerate(loads):
        found.add(f"load_{number}", load)
    check(found, loads)
    number = found.snapshots.read().number
    assert found.add("load_1", loads[1]).number == number  # it is in


def test_untouched_days_stay_and_are_not_read(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    (first,) = loads_of(spark, rng, 1, [0, 1, 2, 3])
    found = Increments(spark, str(tmp_path), FRAGMENTS, buckets=4)
    before = found.add("first", first)
    moved = first.filter("partition_date = '2024-01-02'").limit(1).withColumn("ingestion_timestamp", F.current_timestamp())
    moved = moved.withColumn("created_datetime", F.lit("2024-01-04 05:00:00").cast("timestamp")).withColumn("partition_date", F.lit("2024-01-04").cast("date")).cache()
    moved.count()
    read = []
    original = type(found.snapshots).rows

    def seen(self, snapshot, row_type, slots=None):
        df = original(self, snapshot, row_type, slots)
        if self is found.snapshots:
            read.extend(df.inputFiles())
        return df

    monkeypatch.setattr(type(found.snapshots), "rows", seen)
    after = found.add("second", moved)
    touched = {"2024-01-02", "2024-01-04"}
    assert {f.split("slot=")[1][:10] for f in read} == touched
    for slot in before.slots | after.slots:
        same = before.slots.get(slot) == after.slots.get(slot)
        assert same == (slot.split("/")[1] not in touched), slot
    assert set(STATES) == {x.split("/")[0] for x in after.slots} - {"silver"}
    monkeypatch.undo()
    check(found, [first, moved])


def test_a_failed_load_leaves_the_tables_as_they_were(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    loads = loads_of(spark, rng, 2, [0, 1])
    found = Increments(spark, str(tmp_path), FRAGMENTS, buckets=4)
    before = found.add("load_0", loads[0])

    def broken(*_):
        raise OSError("lost")

    # The versions are merged already; the snapshot that names them is not there.
    with monkeypatch.context() as patch:
        patch.setattr(found.snapshots, "commit", broken)
        with pytest.raises(OSError):
            found.add("load_1", loads[1])
    assert found.snapshots.read() == before
    check(found, loads[:1])
    found.add("load_1", loads[1])
    check(found, loads)


def test_loads_without_rows(spark, tmp_path):
    found = Increments(spark, str(tmp_path), FRAGMENTS)
    (load,) = loads_of(spark, random.Random(1), 1, [0])
    found.add("none", load.limit(0))
    assert found.silver().count() == 0 and found.gold("entity_network").count() == 0
    found.add("some", load)
    check(found, [load])

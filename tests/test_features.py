import datetime as dt

from pyspark.sql import functions as F

from postlake.functions import features
from postlake.operators import bronze, dedup, silver

POST = "post_id string, subreddit string, title string, body string, author string, created_utc long, score int"


def values(spark, column, given, kind):
    rows = [(i, value) for i, value in enumerate(given)]
    return [r[0] for r in spark.createDataFrame(rows, f"i int, x {kind}").orderBy("i").select(column).collect()]


def test_engagement_edges(spark):
    scores = [-5, 9, 10, 49, 50, 99, 100, None]
    got = values(spark, features.engagement(F.col("x")), scores, "int")
    assert got == ["low", "low", "medium", "medium", "high", "high", "viral", None]
    assert values(spark, features.engagement(F.col("x"), "viral"), [None], "int") == ["viral"]


def test_time_period_edges(spark):
    hours = [0, 6, 7, 12, 13, 18, 19, 23, None]
    got = values(spark, features.time_period(F.col("x")), hours, "int")
    assert got == ["night", "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", None]
    assert values(spark, features.time_period(F.col("x"), "evening"), [None], "int") == ["evening"]


def test_time_features(spark):
    posts = bronze.add_partitions(spark.createDataFrame([(1704067200,), (1704585599,)], "created_utc long"))
    got = silver.add_time_features(posts).orderBy("created_utc")
    rows = got.select("hour_of_day", "day_of_week", "day_name", "is_weekend", "partition_date").collect()
    assert tuple(rows[0]) == (0, 2, "Monday", False, dt.date(2024, 1, 1))
    assert tuple(rows[1]) == (23, 7, "Saturday", True, dt.date(2024, 1, 6))


def test_normalized_score(spark):
    def placed(scores):
        df = spark.createDataFrame([(s,) for s in scores], "score int")
        return [r[0] for r in silver.add_normalized_score(df).orderBy("score").select("score_normalized").collect()]

    assert placed([0, 5, 10]) == [0.0, 50.0, 100.0]
    assert placed([7, 7]) == [0.0, 0.0]
    assert placed([None, 1, 3]) == [None, 0.0, 100.0]
    assert placed([]) == []


def test_growth_and_calendar(spark):
    days = [("a", dt.date(2024, 1, 1), 4), ("a", dt.date(2024, 1, 3), 6), ("a", dt.date(2024, 1, 4), 0),
            ("a", dt.date(2024, 1, 5), 5), ("b", dt.date(2024, 1, 1), 1)]
    df = spark.createDataFrame(days, "key string, date date, n int")
    grown = df.select("key", "date", features.growth_rate("n", ["key"]).alias("g"),
                      features.growth_rate("n", ["key"], calendar=True).alias("c"))
    got = [tuple(r)[2:] for r in grown.orderBy("key", "date").collect()]
    assert got == [(None, None), (50.0, None), (-100.0, -100.0), (None, None), (None, None)]


def test_dominant_ties_to_smallest(spark):
    df = spark.createDataFrame([(v,) for v in ("b", "a", "a", "b", None)], "x string")
    x = F.col("x")
    assert df.agg(features.dominant(x)).first()[0] == "a"
    assert df.filter(x.isNull()).agg(features.dominant(x)).first()[0] is None


def test_hours(spark):
    df = spark.createDataFrame([(h,) for h in (23, 0, 5, 5, None)], "h int")
    def of(rows):
        counted = rows.agg(features.hour_counts(F.col("h")).alias("n"), features.distinct_hours(F.col("h")).alias("d"))
        return tuple(counted.select(F.size("n"), features.hours_list(F.col("n")), "d").first())

    assert of(df) == (24, [0, 5, 5, 23], 3)
    assert of(df.filter("h is null")) == (24, [], 0)


def test_steady_round(spark):
    got = values(spark, features.steady_round(F.col("x"), 3), [0.31249999999999994, 0.3125, 1.0005], "double")
    assert got == [0.313, 0.313, 1.001]


def load(spark, rows, batch, seconds):
    at = F.timestamp_seconds(F.lit(seconds))
    return bronze.build(spark.createDataFrame(rows, POST), batch, ingested_at=at)


def test_latest_row_is_kept(spark):
    early = load(spark, [("1", "s", "old", None, "u", 5, 1), ("2", "s", "two", None, "u", 5, 1), (None, "s", "x", None, "u", 5, 1)], "b1", 10)
    late = load(spark, [("1", "s", "new", None, "u", 5, 0), ("1", "s", "newer", None, "u", 5, 3)], "b2", 20)
    both = early.unionByName(late)
    kept = dedup.drop_duplicates(both).orderBy("post_id").select("post_id", "title").collect()
    assert [tuple(r) for r in kept] == [("1", "newer"), ("2", "two")]
    assert tuple(dedup.duplicate_counts(both).first()) == (4, 2, 2)


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("post_id"), F.col("id").alias("score")
    )
    kept = dedup.drop_duplicates(rows)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan
    assert kept.filter("post_id = 'hot'").first()["score"] == 19998
    assert kept.count() == rows.select("post_id").distinct().count()


def test_bronze_stamps(spark):
    row = load(spark, [("1", "s", "t", None, "u", 1704067200, 1)], "b1", 10).first()
    assert row["row_hash"] == "fe1ec65a777b216407bb4393c6a6c8de"
    assert (row["batch_id"], row["source_api"], row["data_quality_flag"]) == ("b1", "reddit", "raw")
    assert (row["partition_year"], row["partition_month"], row["partition_day"]) == (2024, 1, 1)

"""Files written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import schema
from postlake.plans.catalog import registry, sql
from postlake.plans.catalog.registry import query
from postlake.session import shared_folder
from postlake.sinks import files as sink
from postlake.sources import files

POSTS = f"WITH {sql.POSTS} SELECT * FROM posts"

COMMENTED = f"""
  WITH {sql.POSTS} SELECT *, list_aggregate(list_transform(string_split(title, '.'),
    lambda x: x), 'string_agg', '|') AS comments FROM posts
"""


def _commented(spark: SparkSession, folder: str) -> DataFrame:
    """Posts with a list column: the sentences of the title as comments."""
    return registry.raw_posts(spark, folder).withColumn("comments", F.split("title", r"\."))


@query(COMMENTED)
def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "jsonl")
    sink.write_jsonl(_commented(spark, folder), path, codec="gzip")
    back = files.read_jsonl(spark, path, schema.POST_WITH_COMMENTS)
    return back.withColumn("comments", F.concat_ws("|", "comments"))


@query(COMMENTED)
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """CSV with a header; the list column travels as JSON text. Whole texts are compressed by lz4, which takes little time."""
    path = shared_folder(spark, "csv")
    posts = _commented(spark, folder)
    sink.write_csv(posts, path, codec="lz4")
    back = sink.read_csv(spark, path, sink.flat_columns(posts).schema)
    return back.withColumn("comments", F.concat_ws("|", F.from_json("comments", "array<string>")))


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _bronze_table(spark: SparkSession, folder: str) -> str:
    """Bronze written by subreddit and day, in the query's own session.

    For the write a task sorts its rows by folder, with their whole texts, and a document is in many posts. Half the usual
    input of a task keeps that sort in memory; a size that the caller has set stands.
    """
    if ADVISORY not in spark.conf.getAll:
        spark.conf.set(ADVISORY, "32m")
    path = shared_folder(spark, "bronze")
    sink.write_bronze(registry.bronze_posts(spark, folder), path)
    return path


@query(f"WITH {sql.BRONZE} SELECT * FROM dated WHERE subreddit = 'view' AND partition_day = 15")
def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze written by subreddit and day, and one folder of it read by partition filters."""
    path = _bronze_table(spark, folder)
    table = files.read_table(spark, path, row_type=schema.BRONZE)
    return table.filter((F.col("subreddit") == "view") & (F.col("partition_day") == 15))


@query(f"WITH {sql.BRONZE} SELECT subreddit, count(*) AS posts, cast(sum(score) AS bigint) AS points FROM dated GROUP BY subreddit")
def sql_view(spark: SparkSession, folder: str) -> DataFrame:
    """A written table registered as a SQL view and queried by SQL."""
    path = _bronze_table(spark, folder)
    files.read_table(spark, path, view="posts", row_type=schema.BRONZE)
    return spark.sql("SELECT subreddit, count(*) AS posts, sum(score) AS points FROM posts GROUP BY subreddit")


@query(f"WITH {sql.POSTS} SELECT post_id, subreddit, score FROM posts")
def tables_per_subreddit(spark: SparkSession, folder: str) -> DataFrame:
    """One folder per subreddit, all written by one job, read back together."""
    path = shared_folder(spark, "per-subreddit")
    sink.write_per_key(registry.raw_posts(spark, folder).select("post_id", "subreddit", "score"), path)
    return files.read_table(spark, path).select("post_id", "subreddit", "score")

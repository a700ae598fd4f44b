"""An inverted index for title search: postings of every word, in hash buckets of the word.

Loads add folders of their own, so an increment reads its own posts only. A search reads the folders of its terms' buckets,
within which rows lie in the order of the words, and checks what it finds against the titles as they are now.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions import text
from postlake.operators import search
from postlake.sinks.snapshots import Snapshot, Snapshots


class TitleIndex:
    """The index below ``root`` of the words of ``column``. ``buckets`` must stay as they were at the first load."""

    def __init__(self, spark: SparkSession, root: str, key: str = "post_id", column: str = "title", buckets: int = 64):
        self.spark, self.key, self.column, self.buckets = spark, key, column, buckets
        self.snapshots = Snapshots(spark, f"{root}/titles")
        self.row_type = T.StructType([T.StructField("term", T.StringType()), T.StructField(key, T.StringType())])

    def _current(self) -> Snapshot:
        found = self.snapshots.read()
        if found.number and found.meta["buckets"] != self.buckets:
            raise ValueError(f"the index has {found.meta['buckets']} buckets, not {self.buckets}")
        return found

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _write(self, postings: DataFrame, name: str) -> dict[str, str]:
        """Postings by bucket. The rebalance hint splits the bucket of a word that most titles have over several files."""
        folder = self.snapshots.new_folder()
        rows = postings.withColumn("bucket", self._bucket(F.col("term"))).hint("rebalance", "bucket")
        rows.sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{self.snapshots.root}/{folder}")
        return {f"{part.removeprefix('bucket=')}/{name}": f"{folder}/{part}" for part in self.snapshots.parts(folder)}

    def add(self, load: str, posts: DataFrame) -> Snapshot:
        """Index the posts of a load. One that is in already is left alone; posts without a key are not indexed.

        A post that comes again with another title keeps its old postings too: ``search`` checks its hits.
        """
        before = self._current()
        loads = before.meta.get("loads", [])
        if load in loads:
            return before
        rows = posts.filter(F.col(self.key).isNotNull()).select(F.explode_outer(text.tokens(F.col(self.column))).alias("term"), F.col(self.key).cast("string").alias(self.key))
        slots = self._write(rows.filter("term IS NOT NULL").distinct(), load)
        return self.snapshots.commit(before, before.slots | slots, {"buckets": self.buckets, "loads": [*loads, load]})

    def compact(self) -> Snapshot:
        """All loads in one folder for each bucket, a posting once. Readers of older snapshots are not disturbed."""
        before = self._current()
        rows = self.snapshots.rows(before, self.row_type).distinct()
        return self.snapshots.commit(before, self._write(rows, "all"), before.meta)

    def postings(self, terms: Sequence[str]) -> DataFrame:
        """The postings of some words, from the folders of their buckets only."""
        terms = sorted({x.lower() for x in terms})
        numbers = self.spark.range(1).select(F.array(*[self._bucket(F.lit(x)) for x in terms])).first()[0]
        snapshot, wanted = self._current(), {str(x) for x in numbers}
        chosen = [x for x in snapshot.slots if x.split("/", 1)[0] in wanted]
        return self.snapshots.rows(snapshot, self.row_type, chosen).filter(F.col("term").isin(terms))

    def search(self, posts: DataFrame, terms: Sequence[str], every: bool = True) -> DataFrame:
        """The rows of ``posts``, of those indexed, whose title has all the terms as words (any of them with
        ``every=False``): the rows that ``search.search`` finds, without cutting up all titles."""
        if not terms:
            raise ValueError("give at least one term")
        found = self.postings(terms).distinct().groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))
        if every:
            found = found.filter(F.col("n") == len({x.lower() for x in terms}))
        ids = found.select(F.col(self.key).alias("__id"))
        hits = posts.join(ids, posts[self.key].cast("string") == F.col("__id"), "left_semi")
        return search.search(hits, terms, self.column, every)

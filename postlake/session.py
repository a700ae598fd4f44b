"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Days and hours are those of UTC, whatever the machine says."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Settings that make text work faster; they change no result.
# Methods above 8000 bytes are never compiled by the JVM, so such plans are better run in smaller pieces.
# Text costs much per byte, so small shuffles are not packed into one or two tasks while cores stand idle.
TUNING = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Texts are most of what is written; zstd takes less than half the bytes of snappy.
    "spark.sql.parquet.compression.codec": "zstd",
    # The ids that a stream has seen are kept on disk, not on the heap of the executors.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    """UTC and the settings above, for a session of one's own."""
    for name, value in TUNING.items():
        spark.conf.set(name, value)
    return use_utc(spark)


def tuned_copy(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, on the same cluster, with UTC and the settings above.

    It starts from the caller's SQL settings. These and the caller's views stay as they are.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    return tune(own)


def build_session(app: str = "postlake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with UTC and adaptive execution. Partition counts are left to the caller and to AQE."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for ``name``, removed when the driver ends.

    It is below the folder the cluster gives in ``spark.checkpoint.dir``, or else below the warehouse:
    both are places that executors on other machines reach too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/working"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return path.toString()

"""What several operators share: tables, working folders, text batches, exact word rules."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.session import shared_folder

#: Words are runs of anything but these six ASCII characters; ``bytes.split()`` splits at exactly these.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
TOKENIZERS = "/opt/tokenizers"
#: Rows of two ids each that may be broadcast: about 16 MB.
SMALL = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def working_folder(spark: SparkSession, name: str) -> str:
    """A place for a new table or file in the shared folder (``session.shared_folder``); removed when the driver ends."""
    return f"{shared_folder(spark, f'llm-{name}')}/data"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps don't compute it again, whatever is lost."""
    spark = df.sparkSession
    path = working_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def if_small(ids: DataFrame, most: int = SMALL) -> DataFrame:
    """A written table of ids, to be broadcast if it has at most ``most`` rows; else Spark joins it as it sees fit."""
    return F.broadcast(ids) if ids.count() <= most else ids


def tokenizer_path(name: str) -> str:
    return f"{TOKENIZERS}/{name}"


#: Rows of a batch that are turned into Python objects at once.
SLICE = 256


def as_bytes(texts: pa.Array) -> Iterator[bytes]:
    """UTF-8 of each text, null as empty. The batch itself is not copied."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    column = texts.cast(kind)
    for start in range(0, len(column), SLICE):
        yield from (x or b"" for x in column.slice(start, SLICE).to_pylist())


def as_texts(texts: pa.Array) -> Iterator[str]:
    """Each text, null as empty."""
    for start in range(0, len(texts), SLICE):
        yield from (x or "" for x in texts.slice(start, SLICE).to_pylist())


def slices(batches: Iterable[pa.Array], rows: int = SLICE) -> Iterator[pa.Array]:
    """The batches in pieces of at most ``rows`` rows, which are not copied."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)


def give_back() -> None:
    """Returns what Arrow holds of finished batches to the system: workers live on into the next stage."""
    pa.default_memory_pool().release_unused()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers of all executors, once for each application.

    It goes through the shared folder as a zip file, so nothing need be installed on the executors. A package that
    came out of a zip file itself is with them already.
    """
    application = spark.sparkContext.applicationId
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if application in _shipped or not os.path.isdir(top):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{working_folder(spark, 'code')}/{os.path.basename(top)}.zip")
    file = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    file.write(packed.getvalue())
    file.close()
    spark.sparkContext.addPyFile(path.toString())
    _shipped.add(application)


def arrow_udf(run: Callable, kind: str) -> Callable[..., Column]:
    """A function over Arrow arrays that uses this package."""
    ship(SparkSession.active())
    return F.arrow_udf(run, kind)


def map_in_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """A function over Arrow batches that uses this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def struct_column(udf: Callable[..., Column], *inputs: Column | str) -> Column:
    return udf(*[F.col(x) if isinstance(x, str) else x for x in inputs])


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, lengthened until it clashes with none of ``taken`` (column names are compared without case)."""
    used = {x.lower() for x in taken}
    while name.lower() in used:
        name += "_"
    return name


def blocks(texts: Iterable[bytes], most: int = 1 << 23) -> Iterator[list[bytes]]:
    """Runs of texts of about ``most`` bytes."""
    run, size = [], 0
    for x in texts:
        run.append(x)
        size += len(x)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run

import pyarrow.dataset as ds
import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts: numbered from 0, one source."""

    def build(texts, sources=None):
        rows = [(i, t, "en", sources[i] if sources else "s", len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return build


@pytest.fixture(scope="session")
def texts(folder):
    rows = ds.dataset(f"{folder}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] for r in rows}

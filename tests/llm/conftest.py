import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from texts (ids 0, 1, ...) or from (id, text) pairs."""
    def make(rows, partitions=3):
        rows = [r if isinstance(r, tuple) else (k, r) for k, r in enumerate(rows)]
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)
    return make


@pytest.fixture(scope="session")
def clashing(docs):
    """The same with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    def make(rows):
        out = docs(rows)
        for name in ("start", "key", "id", "n", "bucket", "digest", "word", "row", "kept", "label",
                     "component", "piece", "spans", "text_hash", "unit", "_id", "_hash", "_units", "_removed",
                     "_kept_id", "rank", "again", "removed", "salt", "counts", "part", "hash", "text_r",
                     "kept_id"):
            out = out.withColumn(name, F.lit("x"))
        return out
    return make

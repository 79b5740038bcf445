"""What the operators share: Arrow word splitting, hashing, scratch tables.

Words are split with Arrow's ASCII white space (0x20, 0x09-0x0D) and turned
into dictionary codes, so per-word work happens once per distinct word of a
batch and the rest is numpy over codes. Functions take whole Arrow batches
and are bounded by the batch (or by one document, if that is larger).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangewise.session import scratch_path, ship_package

#: Text bytes handled at once inside a task.
CHUNK_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) alone: other columns never enter an operator, so their
    names cannot clash. Null text is kept as null."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def written(spark: SparkSession, df: DataFrame, name: str, part: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here, and a lost
    executor re-reads files instead of recomputing."""
    ship_package(spark)
    path = scratch_path(spark, f"llm-{name}")
    w = df.write.mode("overwrite")
    (w.partitionBy(part) if part else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of ``column`` (one
    row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        lengths = np.nan_to_num(
            pc.binary_length(b.column(column)).to_numpy(zero_copy_only=False).astype(float))
        at = np.floor(np.cumsum(lengths) / size)
        cuts = np.flatnonzero(np.diff(at)) + 1
        for s, e in zip([0, *cuts], [*cuts, b.num_rows]):
            yield b.slice(s, e - s)


def plain(arr: pa.Array) -> pa.Array:
    """Nulls as empty texts, in an array with no offset of its own."""
    return pa.concat_arrays([pc.fill_null(arr.cast(pa.large_string()), "")])


def raw_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values of a ``plain`` array and their offsets (n + 1)."""
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64, len(arr) + 1, arr.offset * 8)
    if data is None:
        return np.empty(0, np.uint8), offsets
    return np.frombuffer(data, np.uint8), offsets


def mapped(arr: pa.Array, table: np.ndarray) -> pa.Array:
    """Each byte of each value put through ``table`` (256 entries). Only for
    tables that keep every byte of a multi-byte character."""
    data, offsets = raw_bytes(arr)
    out = table[data] if len(data) else data
    return pa.LargeStringArray.from_buffers(
        len(arr), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(out))


def words(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Codes of all words in a row, offsets per text (n + 1), and the distinct
    words the codes stand for."""
    lists = pc.ascii_split_whitespace(arr)
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    flat = lists.flatten()
    offsets = offsets - offsets[0]
    keep = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not keep.all():
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        flat = flat.filter(pa.array(keep))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets, coded.dictionary


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def word_hashes(vocab: pa.Array) -> np.ndarray:
    """A 64-bit hash per distinct word, the same in every process."""
    if not len(vocab):
        return np.empty(0, np.uint64)
    return pd.util.hash_array(np.array(vocab.to_pylist(), dtype=object), categorize=False)


def shingle_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` consecutive word hashes."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + m]
            out ^= out >> np.uint64(29)
    return mix(out)


#: A-Z as a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

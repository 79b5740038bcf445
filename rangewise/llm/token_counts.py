"""Token counts of flat, unindexed token files by a separator scan.

A file is nothing but ids of one width, a separator id after each document.
Files are cut into blocks of bytes; each block is searched with one
vectorised comparison, which gives its separators' places. A prefix scan
over a file's blocks (separators before, last separator before) stitches the
documents that cross a block's edge: a document's tokens are its separator's
place less the previous one's, wherever that lies.

Tasks hold one block; the scan sees a row per block. Nothing depends on
how long a document is or how many blocks it crosses.

Defined cases: null and empty texts have no tokens; rows of a null id and rows that
repeat an id are counted one by one; extra columns are not read; an empty
document in a file has no tokens; ids after a file's last
separator are a last document (``closed`` is false); an empty file has no
documents; no files give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rangewise.llm.common import chunks, texts, written
from rangewise.llm.files import opened, replacing
from rangewise.llm.tokens import default_path, encoder
from rangewise.session import scratch_path, ship_package

#: Bytes of a block.
BLOCK_BYTES = 4 << 20
#: The separator of ``word_bpe_49k.json``; texts are encoded so that they never hold it.
END_OF_DOCUMENT = 49407

BLOCKS = "path string, block long, n_ids long, separators array<long>"


def separators(ids: np.ndarray, separator: int, base: int) -> np.ndarray:
    """Places in the file of the separators in a block that begins at ``base``."""
    return np.flatnonzero(ids == separator) + base


def token_counts(spark: SparkSession, path: str, separator: int = END_OF_DOCUMENT,
                 width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, ordinal, start, n_tokens, closed): one row per document of the
    files in folder ``path``, ids of ``width`` bytes."""
    ids_per_block = block_bytes // width
    size = ids_per_block * width
    # the content column is never read: Spark only lists the files
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(path)
              .select("path", "length"))
    blocks = (listed.where(F.col("length") > 0)
              .select("path", F.explode(F.sequence(
                  F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))).alias("block"))
              .repartition(F.col("path"), F.col("block")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, k in zip(*(b.column(c).to_pylist() for c in ("path", "block"))):
                with opened(name) as source:
                    data = source.read_at(min(size, source.size() - k * size), k * size)
                ids = np.frombuffer(data, f"<u{width}")
                found = separators(ids, separator, k * ids_per_block)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name]), pa.array([k]), pa.array([len(ids)]),
                    pa.array([found], pa.list_(pa.int64()))],
                    names=["path", "block", "n_ids", "separators"])

    ship_package(spark)
    scanned = written(spark, blocks.mapInArrow(scan, BLOCKS), "separators")
    # the prefix scan of a file sees three numbers a block, not its separators
    by_file = Window.partitionBy("path").orderBy("block")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    offsets = scanned.select(
        "path", "block", F.size("separators").alias("n"), F.array_max("separators").alias("last")).select(
            "path", "block", F.lead("block").over(by_file).isNull().alias("is_last"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs_before"),
            F.coalesce(F.max("last").over(before), F.lit(-1)).alias("previous"))
    stitched = scanned.join(offsets, ["path", "block"]).withColumn(
        "end", F.col("block") * ids_per_block + F.col("n_ids"))
    last = F.coalesce(F.array_max("separators"), F.col("previous"))
    ends = F.when(F.col("is_last") & (last < F.col("end") - 1),
                  F.concat("separators", F.array(F.col("end")))).otherwise(F.col("separators"))
    starts = F.transform(F.concat(F.array("previous"), F.col("separators")), lambda x: x + 1)
    return (stitched.withColumn("ends", ends).withColumn("starts", starts)
            .select("path", "docs_before", "end", F.posexplode(F.arrays_zip("starts", "ends")))
            .where(F.col("col.ends").isNotNull())
            .select("path", (F.col("docs_before") + F.col("pos")).alias("ordinal"),
                    F.col("col.starts").alias("start"),
                    (F.col("col.ends") - F.col("col.starts")).alias("n_tokens"),
                    (F.col("col.ends") < F.col("end")).alias("closed")))


def write_flat(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
               vocabulary: str | None = None, separator: int = END_OF_DOCUMENT,
               width: int = 2) -> DataFrame:
    """Write each input split's documents as one flat file under ``path``.
    The rows (part, ordinal, doc_id) tell the caller, not the files, which
    document was written where. A split is read in one order always, so a
    task that is run again writes the same file."""
    vocabulary = vocabulary or default_path()

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, special_as_text=True)
        if max(coder.size - 1, separator) >= 1 << (8 * width):
            raise ValueError(f"ids of this vocabulary do not fit {width} bytes")
        part, n = TaskContext.get().partitionId(), 0
        with replacing(f"{path}/part-{part:06d}.ids") as out:
            for b in chunks(batches):
                ids, offsets = coder.encode(b.column("text"))
                out.write(np.insert(ids, offsets[1:], separator).astype(f"<u{width}").tobytes())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(b.num_rows, part)),
                    pa.array(np.arange(n, n + b.num_rows)), b.column("doc_id")],
                    names=["part", "ordinal", "doc_id"])
                n += b.num_rows

    ship_package(docs.sparkSession)
    return texts(docs, doc_id, text).mapInArrow(put, "part long, ordinal long, doc_id long")


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and start of each document, found by scanning flat
    files that are written from the documents first."""
    spark = docs.sparkSession
    path = scratch_path(spark, "llm-flat")
    placed = written(spark, write_flat(docs, path), "flat-placed")
    if not placed.take(1):
        return spark.createDataFrame([], "doc_id long, n_tokens long, part long, start long")
    found = token_counts(spark, path).select(
        F.regexp_extract("path", r"part-(\d+)\.ids$", 1).cast("long").alias("part"),
        "ordinal", "start", "n_tokens")
    # as many rows as documents: never to be broadcast, however small as files
    return found.join(placed.hint("merge"), ["part", "ordinal"]).select(
        "doc_id", "n_tokens", "part", "start")

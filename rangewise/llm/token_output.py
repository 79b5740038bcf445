"""Token ids in bit-packed files, and reading them back.

File format (little-endian):

* ``HEAD``: magic, version, bits per id, ids per block;
* blocks: each id in ``bits`` bits, the least number that holds the
  vocabulary; 64 ids fill ``bits`` 64-bit words; the last block of a file is
  padded with zeros to a multiple of 64 ids;
* index: document ids, the place of each document's first id (n + 1), the
  byte offset of each block (n + 1), all 64-bit;
* ``TAIL``: documents, ids, blocks, byte offset of the index.

Block offsets give random access; a block is unpacked with 64 vectorised
shifts. Documents are dealt out by ranges of ``doc_id`` and sorted, so file
k's documents all come before file k + 1's, and a document's place among all
ids is its place in the file plus the ids of the files before (one number per
file reaches the driver).

Defined cases: null and empty texts hold the end id alone; rows with one id
are ordered by text; a null document id is stored as the least 64-bit
integer and read back as null, first in order; an empty table has no file
and no rows; extra columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from rangewise.llm.common import chunks, texts, written
from rangewise.llm.files import opened, replacing
from rangewise.llm.tokens import default_path, encoder
from rangewise.session import scratch_path, ship_package

MAGIC, VERSION = b"RWTB", 1
HEAD, TAIL = struct.Struct("<4sHHQ"), struct.Struct("<QQQQ")
#: Ids in a block; a multiple of 64.
BLOCK_IDS = 1 << 16
NO_ID = -(1 << 63)

FILES = "part long, path string, n_docs long, n_ids long"
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    """Least bits that hold every id under ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, padded to a multiple of 64 ids."""
    columns = np.zeros((64, -(-len(ids) // 64)), np.uint64)
    full = np.zeros(columns.size, np.uint64)
    full[:len(ids)] = ids
    columns[:] = full.reshape(-1, 64).T
    out = np.zeros((bits, columns.shape[1]), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[word] |= columns[j] << np.uint64(shift)
        if shift + bits > 64:
            out[word + 1] |= columns[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed data."""
    packed = np.ascontiguousarray(np.frombuffer(data, "<u8").reshape(-1, bits).T)
    out = np.empty((64, packed.shape[1]), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        x = packed[word] >> np.uint64(shift)
        if shift + bits > 64:
            x = x | (packed[word + 1] << np.uint64(64 - shift))
        out[j] = x & mask
    return np.ascontiguousarray(out.T).ravel()[:n]


class Writer:
    """Writes one file, holding one block and the documents' index."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.at = out.write(HEAD.pack(MAGIC, VERSION, bits, block_ids)) or HEAD.size
        self.docs: list[int] = []
        self.starts, self.blocks = [0], [HEAD.size]
        self.at, self.rest = HEAD.size, np.empty(0, np.uint32)

    def add(self, docs: list[int], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.docs += docs
        self.starts += (self.starts[-1] + np.cumsum(lengths)).tolist()
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) - len(ids) % self.block_ids
        for s in range(0, whole, self.block_ids):
            self._block(ids[s:s + self.block_ids])
        self.rest = ids[whole:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.out.write(data)
        self.at += len(data)
        self.blocks.append(self.at)

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        for x in (self.docs, self.starts, self.blocks):
            self.out.write(np.array(x, "<i8").tobytes())
        self.out.write(TAIL.pack(len(self.docs), self.starts[-1], len(self.blocks) - 1, self.at))


class Reader:
    """Random access to the ids of one file."""

    def __init__(self, source):
        self.source = source
        magic, version, self.bits, self.block_ids = HEAD.unpack(source.read_at(HEAD.size, 0))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"not a token file of version {VERSION}: {magic!r}, {version}")
        end = source.size()
        n, self.n_ids, blocks, index = TAIL.unpack(source.read_at(TAIL.size, end - TAIL.size))
        found = np.frombuffer(source.read_at(end - TAIL.size - index, index), "<i8")
        self.docs, self.starts, self.blocks = np.split(found, [n, 2 * n + 1])
        if len(self.blocks) != blocks + 1:
            raise ValueError("the token file's index is cut short")

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids [start, end) of the file; only their blocks are read."""
        if end <= start:
            return np.empty(0, np.uint32)
        a, b = start // self.block_ids, -(-end // self.block_ids)
        s = int(self.blocks[a])
        data = self.source.read_at(int(self.blocks[b]) - s, s)
        base = a * self.block_ids
        return unpack(data, self.bits, end - base)[start - base:]


def write(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text",
          vocabulary: str | None = None, end_id: int = 1, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write token files in ascending ``doc_id`` order under ``path`` (a fresh
    folder in the shared one by default); one row per file (``FILES``)."""
    spark = docs.sparkSession
    vocabulary = vocabulary or default_path()
    path = path or scratch_path(spark, "llm-tokens")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        coder = encoder(vocabulary)
        bits = max(bits_for(coder.size), bits_for(end_id + 1))
        part = TaskContext.get().partitionId()
        name = f"{path}/part-{part:06d}.ids"
        with replacing(name) as out:
            w = Writer(out, bits, block_ids)
            for b in chunks((x for s in ([first], batches) for x in s)):
                ids, offsets = coder.encode(b.column("text"))
                ids = np.insert(ids, offsets[1:], end_id)
                keys = b.column("doc_id").fill_null(NO_ID).to_pylist()
                w.add(keys, ids, np.diff(offsets) + 1)
            w.close()
        yield pa.RecordBatch.from_pydict({"part": [part], "path": [name], "n_docs": [len(w.docs)],
                                          "n_ids": [w.starts[-1]]})

    ordered = (texts(docs, doc_id, text).repartitionByRange("doc_id")
               .sortWithinPartitions("doc_id", "text"))
    ship_package(spark)
    return written(spark, ordered.mapInArrow(put, FILES), "token-files")


def read(spark: SparkSession, files: DataFrame, window: int = 1 << 20) -> DataFrame:
    """One row per document of the files, in any order (columns: ``SCHEMA``).
    A task unpacks ``window`` ids at a time."""
    manifest, before = [], 0
    for f in sorted(files.select("part", "path", "n_ids").collect()):  # a row per file
        manifest.append((f.path, before))
        before += f.n_ids

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(*(b.column(k).to_pylist() for k in ("path", "base"))):
                with opened(path) as source:
                    r = Reader(source)
                    yield _digests(r, base, window)

    ship_package(spark)
    listed = spark.createDataFrame(manifest, "path string, base long")
    return listed.repartition(max(1, len(manifest))).mapInArrow(get, SCHEMA)


def _digests(r: Reader, base: int, window: int) -> pa.RecordBatch:
    sums = [0] * len(r.docs)
    for s in range(0, r.n_ids, window):
        e = min(s + window, r.n_ids)
        data = memoryview(np.ascontiguousarray(r.ids(s, e)).astype("<u4")).cast("B")
        first = int(np.searchsorted(r.starts, s, side="right")) - 1
        last = int(np.searchsorted(r.starts, e, side="left"))
        edges = (np.clip(r.starts[first:last + 1], s, e) - s) * 4
        for d, (a, z) in enumerate(zip(edges.tolist(), edges[1:].tolist()), first):
            sums[d] = zlib.crc32(data[a:z], sums[d])
    return pa.RecordBatch.from_arrays([
        pa.array(r.docs, mask=r.docs == NO_ID), pa.array(r.starts[:-1] + base),
        pa.array(np.diff(r.starts)), pa.array(sums, pa.int64())],
        names=["doc_id", "start", "n_tokens", "ids_crc32"])


def round_trip(docs: DataFrame) -> DataFrame:
    """Write the documents' ids, then answer from the files."""
    return read(docs.sparkSession, write(docs))

"""Exact top-k inner-product search over a bit-sliced index.

Each component of a vector is quantised to an integer (``floor(scale * x)``).
Rows are dealt into blocks; a block keeps, for every component and every bit
of its offset from the block's least value, one bitmap over its rows (a
slice). The score of all rows of a block against a query is a sum of slices:
every set bit of a query's component adds that component's slices, moved up
by the bit's place, and a negative component adds their complements. Slices
of one place are added three at a time by bitmap logic (sum and carry), so a
score is itself a set of slices, exact in every bit.

The best k rows are then picked from the most significant score slice
downward: rows certainly in, and rows still level with the boundary. What is
level after the last slice has one and the same score, and is resolved
exactly by the smaller id. Each block gives at most k rows per query; a window
per query over these few rows picks the final k.

Shape of the job: the index is a table of blocks in the shared folder, the
queries are files of bounded size there. A task takes blocks and reads the
query files one after the other, so nothing is broadcast, no row meets
another in a join, and a block's work is the queries it is given. Blocks are
repeated over shares of the queries when there are fewer blocks than cores.

Defined cases: a vector that is null, or holds a null or non-finite component,
takes no part, nor does a row with a null id, nor one with a component so large
that a score could leave 64 bits (``limit``). Vectors of different lengths do
not meet. An empty vector scores 0 with every empty vector. Equal scores go to the smaller id. Repeated rows
are rows of their own as candidates; as queries, rows equal in id and vector
are one query, and rows equal only in id are answered apart. A query's own rows
are all rows with its id. An empty table, or one without queries, gives no rows.
Other columns never enter the operator.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rangewise.llm.common import written
from rangewise.llm.files import opened, replacing
from rangewise.session import scratch_path, ship_package

#: Rows of a block; a bitmap of one slice has so many bits.
BLOCK_ROWS = 16384
#: Vectors of a query file, which a task holds at once.
QUERY_ROWS = 2048
#: Quantisation steps per unit of a component.
SCALE = 256
#: Answers per query.
TOP = 5

BLOCKS = "dims int, width int, ids binary, low binary, slices binary"
_QUERY = pa.schema([("id", pa.int64()), ("vector", pa.large_list(pa.int64()))])


def limit(dims: int) -> int:
    """Largest size of a quantised component: with it no sum or partial sum
    of ``dims`` products leaves 62 bits."""
    return math.isqrt((1 << 60) // max(dims, 1))


def _quantised(b: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer matrix) per vector length of a batch of (id, vector)."""
    b = b.filter(pc.and_(pc.is_valid(b.column("id")), pc.is_valid(b.column("vector"))))
    if not b.num_rows:
        return
    ids = b.column("id").to_numpy(zero_copy_only=False)
    lists = b.column("vector")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: NaN
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    for dims in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dims)
        x = flat[starts[rows][:, None] + np.arange(dims)]
        with np.errstate(invalid="ignore", over="ignore"):
            v = np.floor(x * scale)
            good = (np.isfinite(x) & (np.abs(v) <= limit(dims))).all(axis=1)
        yield ids[rows[good]], v[good].astype(np.int64)


def slices_of(v: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(width, least value per component, slices) of an integer matrix with a
    row per vector: bitmaps of ``width`` bits per component, lowest first, as
    rows of 64-bit words."""
    n, dims = v.shape
    low = v.min(axis=0) if n else np.zeros(dims, np.int64)
    u = (v - low).T.astype(np.uint64)
    width = int(u.max()).bit_length() if u.size else 0
    padded = np.zeros((dims, -(-n // 64) * 64), np.uint64)
    padded[:, :n] = u
    out = np.empty((dims, width, padded.shape[1] // 64), np.uint64)
    for i in range(width):
        bits = (padded >> np.uint64(i) & np.uint64(1)).astype(np.uint8)
        out[:, i] = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    return width, low, out.reshape(dims * width, padded.shape[1] // 64)


def add_slices(places: list[np.ndarray]) -> list[np.ndarray]:
    """Sum of bitmaps: ``places[p]`` holds those that count 2**p. Returns one
    bitmap per place, lowest first."""
    out, carried, p = [], [], 0
    while p < len(places) or carried:
        level = ([places[p]] if p < len(places) and len(places[p]) else []) + carried
        carried = []
        col = np.concatenate(level) if level else None
        while col is not None and len(col) > 1:
            k = len(col) // 3
            if k:
                a, b, c = col[:k], col[k:2 * k], col[2 * k:3 * k]
                t = a ^ b
                carried.append(a & b | t & c)
                col = np.concatenate([t ^ c, col[3 * k:]])
            else:
                carried.append(col[:1] & col[1:])
                col = col[:1] ^ col[1:]
        out.append(None if col is None else col[0])
        p += 1
    return out


def best_rows(score: list[np.ndarray | None], among: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k rows with the highest scores among those of a bitmap
    (all, if fewer); rows level at the boundary by row number."""
    sure, level, need = np.zeros_like(among), among, k
    for s in reversed(score):
        high = np.zeros_like(among) if s is None else level & s
        n = int(np.bitwise_count(high).sum())
        if n > need:
            level = high
        else:
            sure |= high
            need -= n
            level = level & ~high
        if not need:
            break
    rows = [_set_bits(sure)]
    if need:
        rows.append(_set_bits(level, need))
    return np.concatenate(rows)


def _set_bits(bitmap: np.ndarray, first: int | None = None) -> np.ndarray:
    """Numbers of the set bits (the first so many), words without any skipped."""
    words = np.flatnonzero(bitmap)[:first]
    bits = np.unpackbits(bitmap[words].astype("<u8").view(np.uint8), bitorder="little")
    at = np.flatnonzero(bits)[:first]
    return words[at // 64] * 64 + at % 64


class Block:
    """A block of the index, opened for searching. Rows are in id order."""

    def __init__(self, dims: int, width: int, ids: bytes, low: bytes, slices: bytes):
        self.dims, self.width = dims, width
        self.ids = np.frombuffer(ids, "<i8")
        self.low = np.frombuffer(low, "<i8")
        words = -(-len(self.ids) // 64)
        plain = np.frombuffer(slices, "<u8").reshape(dims * width, words)
        self.slices = np.concatenate([plain, ~plain])  # complements after
        self.valid = np.packbits(np.arange(words * 64) < len(self.ids), bitorder="little").view("<u8")

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best k rows but the query's own."""
        size, w = np.abs(q), self.width
        # q * v = q * (u + low); below 0: |q| * (ones - u) - |q| * (ones + low)
        base = int(np.where(q < 0, -size * ((1 << w) - 1 + self.low), q * self.low).sum())
        top = int(size.max(initial=0)).bit_length()
        of, bit = np.nonzero(size[:, None] >> np.arange(top) & 1)
        place = (bit[:, None] + np.arange(w)).ravel()
        row = ((of + (q[of] < 0) * self.dims)[:, None] * w + np.arange(w)).ravel()
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(top + w))
        score = add_slices([self.slices[r] for r in np.split(row[order], cuts[1:])]
                           if len(row) else [])
        among = self.valid.copy()
        a, z = np.searchsorted(self.ids, [query_id, query_id + 1])
        for r in range(a, z):
            among[r // 64] &= ~np.uint64(1 << (r % 64))
        best = best_rows(score, among, k)
        total = np.full(len(best), base, np.int64)
        for p, s in enumerate(score):
            if s is not None:
                total += (s[best // 64] >> (best % 64).astype(np.uint64) & np.uint64(1)).astype(np.int64) << p
        return self.ids[best], total


def _input(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    return vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"))


def build(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The index as a written table with a row per block (``BLOCKS``)."""
    found = _input(vectors, vec_id, vector)
    n = found.select("id").count()

    def slice_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def block(dims: int) -> pa.RecordBatch:
            ids, v = (np.concatenate(x) for x in held.pop(dims))
            if len(ids) > block_rows:  # the rest waits
                held[dims] = [ids[block_rows:]], [v[block_rows:]]
                ids, v = ids[:block_rows], v[:block_rows]
            order = np.argsort(ids, kind="stable")
            width, low, slices = slices_of(v[order])
            return pa.RecordBatch.from_pydict(
                {"dims": pa.array([dims], pa.int32()), "width": pa.array([width], pa.int32()),
                 "ids": [ids[order].astype("<i8").tobytes()], "low": [low.astype("<i8").tobytes()],
                 "slices": [slices.astype("<u8").tobytes()]})

        for b in batches:
            for ids, v in _quantised(b, scale):
                if len(ids):
                    into = held.setdefault(v.shape[1], ([], []))
                    into[0].append(ids)
                    into[1].append(v)
                    while sum(map(len, held.get(v.shape[1], ([],))[0])) >= block_rows:
                        yield block(v.shape[1])
        while held:
            yield block(next(iter(held)))

    ship_package(vectors.sparkSession)
    dealt = found.repartition(max(1, -(-n // block_rows)))
    return written(vectors.sparkSession, dealt.mapInArrow(slice_up, BLOCKS), "bit-slices")


def put_queries(queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                scale: int = SCALE, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Quantised query vectors as files in the shared folder; one row (path)
    per file."""
    spark = queries.sparkSession
    folder = scratch_path(spark, "llm-vector-queries")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            for ids, v in _quantised(b, scale):
                for s in range(0, len(ids), query_rows):
                    m = v[s:s + query_rows]
                    offsets = pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int64())
                    table = pa.RecordBatch.from_arrays(
                        [pa.array(ids[s:s + query_rows]),
                         pa.LargeListArray.from_arrays(offsets, pa.array(m.ravel()))], schema=_QUERY)
                    path = f"{folder}/part-{part:06d}-{k:06d}.arrow"
                    with replacing(path) as out, pa.ipc.new_stream(out, _QUERY) as w:
                        w.write_batch(table)
                    k += 1
                    yield pa.RecordBatch.from_pydict({"path": [path], "n": [len(m)]})

    ship_package(spark)
    distinct = _input(queries, vec_id, vector).distinct()
    return written(spark, distinct.mapInArrow(put, "path string, n long"), "vector-query-files")


def _read_queries(path: str) -> tuple[np.ndarray, list[np.ndarray]]:
    with opened(path) as source, pa.ipc.open_stream(source) as r:
        t = r.read_all().combine_chunks()
    ids = t.column("id").to_numpy()
    return ids, [row.values.to_numpy() for row in t.column("vector")]


def search(index: DataFrame, query_files: DataFrame, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` highest scores."""
    spark = index.sparkSession
    paths = sorted(r.path for r in query_files.collect())  # a row per file of query vectors
    shares = 1
    if paths:
        blocks = index.count()
        shares = max(1, -(-4 * spark.sparkContext.defaultParallelism // max(blocks, 1)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in b.schema.names}
                share = row.pop("share")
                block = Block(**row)
                for path in paths:
                    ids, vectors = _read_queries(path)
                    out: list[list] = [[], [], [], []]
                    for i in range(share, len(ids), shares):
                        q = vectors[i]
                        if len(q) != block.dims:
                            continue
                        hit, score = block.search(int(ids[i]), q, k)
                        for column, x in zip(out, (np.repeat(ids[i], len(hit)), hit, score)):
                            column.append(x)
                        out[3] += [q.tobytes()] * len(hit)
                    if out[3]:
                        query, hit, score = (np.concatenate(x) for x in out[:3])
                        yield pa.RecordBatch.from_pydict(
                            {"query_id": query, "vector": pa.array(out[3], pa.binary()),
                             "vec_id": hit, "score": score})

    ship_package(spark)
    dealt = index.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    if shares > 1:  # few blocks: a task for each (block, share)
        dealt = dealt.repartition(shares * max(blocks, 1))
    found = dealt.mapInArrow(find, "query_id long, vector binary, vec_id long, score long")
    best = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("vector", F.xxhash64("vector"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, vec_id: str = "vec_id",
          vector: str = "embedding", scale: int = SCALE, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` best rows for every row that ``is_query`` (an expression over
    ``vectors``) names, among all rows but its own."""
    index = build(vectors, vec_id, vector, scale, block_rows)
    files = put_queries(vectors.where(is_query), vec_id, vector, scale, query_rows)
    return search(index, files, k)

"""Record-owning splits of text files, as a Spark data source.

A file is cut into byte ranges. A record (a line, which an escaped line feed
continues) belongs to the range that its first byte lies in; the range's task
reads on past its end until that record ends. So a record is assembled once, in one task,
whatever the cuts, and nothing is glued afterwards. Batches leave as Arrow.

A line feed ends a record unless an odd number of backslashes stands before
it. A task that begins inside a file looks for the first such line feed at or
after the byte before its range, counting backslashes back across the range's start if need be.
A file's first line is its header. The last record may end without a line feed.
A task takes as many ranges as give every core some, reads no further than its ranges
and their last records need, and holds one block of its file (or one record, if that is longer).
A gzip file has no places to begin at: it is one range, decompressed a block at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rangewise.session import ship_package

#: Bytes of a range, and of the blocks that a task reads.
RANGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
#: Least bytes that a task reads at once, and tasks to a core while files are small.
LEAST_READ, TASKS = 64 << 10, 16
#: Bytes of records that leave a task at once at least, however small its ranges.
LEAST_BATCH = 1 << 20
#: Schemes of paths that tasks can open by themselves.
SCHEMES = ("", "file", "hdfs", "s3", "s3a", "gs")

_NEWLINE, _BACKSLASH = 10, 92


def _located(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def opened(path: str):
    """A file for random access, from within a task or the driver."""
    system, name = _located(path)
    return system.open_input_file(name)


def created(path: str, data: bytes) -> None:
    """A whole file under its name at once, so a task that runs again replaces it."""
    system, name = _located(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    temporary = f"{name}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(temporary) as out:
        out.write(data)
    system.move(temporary, name)


def record_ends(data: np.ndarray, escaped: bool = False) -> np.ndarray:
    """Places of the line feeds that end records. ``escaped``: an odd number
    of backslashes stands before the data."""
    ends = np.flatnonzero(data == _NEWLINE)
    run = np.zeros(len(ends), np.int64)
    back, live = ends - 1, np.arange(len(ends))
    while len(live):  # as often as the longest run of backslashes before one
        at = back[live]
        live = live[(at >= 0) & (data[at] == _BACKSLASH)]
        run[live] += 1
        back[live] -= 1
    odd = run % 2 == 1
    if escaped:
        odd ^= back < 0
    return ends[~odd]


def _odd_before(source, at: int) -> bool:
    """True if an odd number of backslashes ends right before byte ``at``."""
    n = 0
    while at > 0:
        step = min(at, 4096)
        block = source.read_at(step, at - step)
        kept = block.rstrip(b"\\")
        n += len(block) - len(kept)
        if kept:
            break
        at -= step
    return n % 2 == 1


def _batch(data: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    """Records that end at ``ends`` (line feeds, or the data's end)."""
    keep = np.ones(len(data), bool)
    keep[ends[ends < len(data)]] = False
    offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
    text = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data[keep]))
    return pa.RecordBatch.from_arrays([text], names=["record"])


def owned(path: str, start: int, end: int, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of the records that begin in [start, end) of a file."""
    with opened(path) as source:
        size = source.size()

        def read(at: int) -> bytes:
            """Up to the range's end at once, then in small steps."""
            return source.read_at(min(block_bytes, max(end - at, LEAST_READ), size - at), at)
        at = start
        if start:  # after the first line feed from the byte before that ends a record
            at, escaped = start - 1, _odd_before(source, start - 1)
        else:
            escaped = False
        first = None
        while first is None and at < size:
            held = read(at)
            block = np.frombuffer(held, np.uint8)
            # the header ends at its line feed, whatever stands before
            ends = record_ends(block, escaped) if start else np.flatnonzero(block == _NEWLINE)
            if len(ends):
                first = at + int(ends[0]) + 1
                held = held[int(ends[0]) + 1:]
            at += len(block)
            if first is None:
                escaped = _odd_before(source, at) if start else False
        if first is None or first >= min(end, size):
            return

        def blocks() -> Iterator[tuple[bytes, bool]]:
            place, block = at, held
            while True:
                yield block, place >= size
                block = read(place)
                place += len(block)
        yield from _records(blocks(), min(end, size) - first)


def streamed(path: str, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of the records of a whole gzip file."""
    system, name = _located(path)

    def blocks(source) -> Iterator[tuple[bytes, bool]]:
        header, block = True, source.read(block_bytes)
        while block:
            following = source.read(block_bytes)
            if header:  # it ends at its line feed, whatever stands before
                at = block.find(b"\n")
                header, block = at < 0, block[at + 1:] if at >= 0 else b""
            yield block, not following
            block = following
    with system.open_input_stream(name, compression="gzip") as source:
        yield from _records(blocks(source))


def _records(blocks: Iterator[tuple[bytes, bool]], end: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of the records that begin before byte ``end`` (all, if not given) of
    consecutive blocks. The first begins with a record; the file's last is marked."""
    held, begin = b"", 0  # bytes from record start ``begin`` on
    for block, last in blocks:
        held += block
        data = np.frombuffer(held, np.uint8)
        ends = record_ends(data)
        if last and len(data) and (not len(ends) or ends[-1] < len(data) - 1):
            # the file's last record ends with it, or with a line feed that looks escaped
            tail = len(data) - 1 if data[-1] == _NEWLINE else len(data)
            ends = np.append(ends, tail)
        starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        mine = ends if end is None else ends[begin + starts < end]
        if len(mine):
            yield _batch(data[:mine[-1]], mine)
        if last or len(mine) < len(ends):
            return
        if len(ends):
            begin += int(ends[-1]) + 1
            held = held[int(ends[-1]) + 1:]
            if end is not None and begin >= end:
                return


def joined(batches: Iterator[pa.RecordBatch], least: int = LEAST_BATCH) -> Iterator[pa.RecordBatch]:
    """The same records in batches of ``least`` bytes or more: each costs some milliseconds."""
    held: list[pa.RecordBatch] = []
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        if held:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([b.column(0) for b in held])], names=["record"])
    for b in batches:
        if b.nbytes >= least:
            yield from out()
            yield b
            held, size = [], 0
            continue
        held.append(b)
        size += b.nbytes
        if size >= least:
            yield from out()
            held, size = [], 0
    yield from out()


class _Range(InputPartition):
    """Bytes [start, end) of a file, in ranges; a whole gzip file has no end."""

    def __init__(self, path: str, start: int, end: int | None):
        super().__init__((path, start, end))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.files = json.loads(options["files"])
        self.range_bytes, self.tasks = int(options["range_bytes"]), int(options["tasks"])

    def partitions(self) -> list[InputPartition]:
        plain = [(path, size) for path, size in self.files if not packed(path)]
        step = share(sum(size for _, size in plain), self.range_bytes, self.tasks)
        return [*(_Range(path, s, min(s + step, size)) for path, size in plain for s in range(0, size, step)),
                *(_Range(path, 0, None) for path, _ in self.files if packed(path))] or [_Range("", 0, 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, start, end = partition.value
        if path and end is None:
            yield from streamed(path)
        elif path:
            yield from joined(b for s in range(start, end, self.range_bytes)
                              for b in owned(path, s, min(s + self.range_bytes, end)))


class EscapedRecords(DataSource):
    """Records of plain or gzip text files (options: files, range_bytes, tasks)."""

    @classmethod
    def name(cls) -> str:
        return "escaped_records"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def share(total: int, range_bytes: int, tasks: int) -> int:
    """Bytes for a task: whole ranges that give ``tasks`` tasks some, up to ``RANGE_BYTES``."""
    return max(min(total // tasks, RANGE_BYTES) // range_bytes, 1) * range_bytes


def packed(path: str) -> bool:
    return path.lower().endswith(".gz")


def readable(path: str) -> bool:
    """True for paths whose scheme tasks can open."""
    return (path.split(":", 1)[0] if ":" in path else "") in SCHEMES


def read_records(spark: SparkSession, paths: list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records (without headers) of plain or gzip files, one row each."""
    ship_package(spark)
    spark.dataSource.register(EscapedRecords)
    listed = spark.read.format("binaryFile").load(paths).select("path", "length")  # no content is read
    files = sorted((r.path, r.length) for r in listed.collect())  # a row per file
    return (spark.read.format("escaped_records").option("files", json.dumps(files))
            .option("range_bytes", str(range_bytes))
            .option("tasks", str(TASKS * spark.sparkContext.defaultParallelism)).load())

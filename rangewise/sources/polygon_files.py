"""Binary polygon layers: the public shape (``.shp``), index (``.shx``) and
attribute (``.dbf``) record formats, as a Spark data source and a writer.

A layer is one trio of files or a folder of them. Reading is driven by the
index: a task has byte ranges of a shape file; of each it finds the records that begin in
it by bisection of the index, and reads these, their index entries and their
attribute rows, a block at a time (or one record, if that is longer). Nothing but file
lengths reaches the driver.

Every record is checked: its number and length against the index, its shape
type, its parts and points against its length, and the attribute row for a
deletion mark. What does not fit fails the job, named by file and record; nothing is dropped.

A null shape has NULL rings, a shape without parts none. Z and M ordinates are
left out, as in text. Attribute values are text without surrounding blanks, NULL where
blank (the format cannot tell an empty text); ``layer.build_layer`` casts
them. Attribute names have ten characters at most; ``read_layer`` gives
declared columns their full names. Text is read in the ``.cpg`` file's encoding, else in ``encoding``.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rangewise.schemas import SPECIES_GEOSPATIAL_RAW
from rangewise.session import ship_package
from rangewise.sources.records import BLOCK_BYTES, RANGE_BYTES, TASKS, created, opened, share

# --- fixed values of the formats -----------------------------------------------
FILE_CODE, VERSION = 9994, 1000
HEAD_BYTES = 100           # of .shp and .shx
NULL_SHAPE, POLYGON_TYPES = 0, (5, 15, 25)  # plain, with Z, with M
NAME_CHARS, TEXT_BYTES = 10, 254
DBF_FIELD, DBF_END = 32, b"\r"

_RINGS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


class LayerError(ValueError):
    """A file that is not as its format says."""


def _fields(source, path: str) -> tuple[int, int, list[tuple[str, int]]]:
    """(rows begin at, bytes of a row, (name, bytes) of each field)."""
    head, size = struct.unpack_from("<HH", source.read_at(12, 0), 8)
    raw = source.read_at(head - DBF_FIELD, DBF_FIELD)
    out = []
    for k in range(0, len(raw) - DBF_FIELD + 1, DBF_FIELD):
        if raw[k:k + 1] == DBF_END:
            break
        out.append((raw[k:k + 11].split(b"\0")[0].decode("ascii").lower(), raw[k + 16]))
    if sum(n for _, n in out) + 1 != size:
        raise LayerError(f"{path}: fields do not fill a row")
    return head, size, out


def _attributes(rows: bytes, size: int, fields: list[tuple[str, int]], encoding: str) -> list[pa.Array]:
    table = np.frombuffer(rows, np.uint8).reshape(-1, size)
    out, at = [], 1  # after the deletion mark
    for _, n in fields:
        raw = pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(n), len(table), [None, pa.py_buffer(np.ascontiguousarray(table[:, at:at + n]))])
        if encoding in ("utf-8", "utf8", "ascii"):
            text = raw.cast(pa.binary()).cast(pa.string())
        else:
            text = pa.array([v.decode(encoding) for v in raw.to_pylist()], pa.string())
        text = pc.utf8_trim(text, " \0")
        out.append(pc.if_else(pc.equal(pc.binary_length(text), 0), pa.scalar(None, pa.string()), text))
        at += n
    return out


def _rings(data: bytes, entries: np.ndarray, first: int, path: str) -> pa.Array:
    """Rings of consecutive records, ``entries`` (offset, content bytes) of the
    index, the first being record ``first`` (from 0)."""
    base = int(entries[0, 0])
    points, ring_sizes, row_sizes, null = [], [], [], []
    for k, (offset, length) in enumerate(entries.tolist()):
        at, number = offset - base, first + k + 1

        def fail(why: str):
            raise LayerError(f"{path}, record {number}: {why}")
        if len(data) < at + 8 + length:
            fail("cut short")
        found, words = struct.unpack_from(">ii", data, at)
        if (found, 2 * words) != (number, length):
            fail(f"number {found} and {2 * words} bytes, where the index says {length}")
        if length < 4:
            fail("no shape type")
        kind, = struct.unpack_from("<i", data, at + 8)
        null.append(kind == NULL_SHAPE)
        if kind == NULL_SHAPE:
            row_sizes.append(0)
            continue
        if kind not in POLYGON_TYPES or length < 44:
            fail(f"shape type {kind} is no polygon")
        parts, n = struct.unpack_from("<ii", data, at + 44)
        if parts < 0 or n < 0 or 44 + 4 * parts + 16 * n > length:
            fail(f"{parts} parts and {n} points do not fit {length} bytes")
        starts = np.frombuffer(data, "<i4", parts, at + 52)
        edges = np.append(starts, n)
        if parts and (starts[0] != 0 or (np.diff(edges) < 0).any()) or not parts and n:
            fail("parts are out of order")
        points.append(np.frombuffer(data, "<f8", 2 * n, at + 52 + 4 * parts).reshape(n, 2))
        ring_sizes.append(np.diff(edges))
        row_sizes.append(parts)
    xy = np.concatenate(points) if points else np.empty((0, 2))
    sizes = np.concatenate(ring_sizes) if ring_sizes else np.empty(0, np.int64)
    vertices = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[:, 0])),
                                           pa.array(np.ascontiguousarray(xy[:, 1]))], names=["x", "y"])
    rings = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), vertices)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *row_sizes]).astype(np.int32)), rings,
                                    mask=pa.array(null, pa.bool_()))


def records(stem: str, start: int, end: int, columns: list[str], encoding: str,
            block_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of the records that begin in bytes [start, end) of a shape file."""
    with opened(f"{stem}.shp") as shp, opened(f"{stem}.shx") as shx, opened(f"{stem}.dbf") as dbf:
        total = (shx.size() - HEAD_BYTES) // 8
        head, size, fields = _fields(dbf, f"{stem}.dbf")
        held, = struct.unpack("<I", dbf.read_at(4, 4))
        if held != total or dbf.size() < head + size * total:
            raise LayerError(f"{stem}: {total} shapes, {held} attribute rows")
        if [name for name, _ in fields] != columns:
            raise LayerError(f"{stem}.dbf: fields {[n for n, _ in fields]}, not {columns}")

        def index(a: int, z: int) -> np.ndarray:
            raw = np.frombuffer(shx.read_at(8 * (z - a), HEAD_BYTES + 8 * a), ">i4").reshape(-1, 2)
            return raw.astype(np.int64) * 2

        def first_at(byte: int) -> int:
            low, high = 0, total
            while low < high:
                mid = (low + high) // 2
                if index(mid, mid + 1)[0, 0] < byte:
                    low = mid + 1
                else:
                    high = mid
            return low

        k, stop = first_at(start), first_at(end)
        while k < stop:
            entries = index(k, min(stop, k + 8192))
            if (np.diff(entries[:, 0]) <= 0).any():
                raise LayerError(f"{stem}.shx: offsets out of order after record {k + 1}")
            ends = entries[:, 0] + 8 + entries[:, 1]
            n = max(1, int(np.searchsorted(ends, entries[0, 0] + block_bytes, side="right")))
            data = shp.read_at(int(ends[n - 1] - entries[0, 0]), int(entries[0, 0]))
            rows = dbf.read_at(size * n, head + size * k)
            if any(rows[i] != 32 for i in range(0, len(rows), size)):
                raise LayerError(f"{stem}.dbf: a row after record {k + 1} is marked as deleted")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(k + 1, k + n + 1)), *_attributes(rows, size, fields, encoding),
                 _rings(data, entries[:n], k, f"{stem}.shp")], names=["record", *columns, "rings"])
            k += n


class _Range(InputPartition):
    def __init__(self, *value):
        super().__init__(value)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.files, self.columns = json.loads(options["files"]), json.loads(options["columns"])
        self.range_bytes, self.tasks = int(options["range_bytes"]), int(options["tasks"])

    def partitions(self) -> list[InputPartition]:
        step = share(sum(size for _, size, _ in self.files), self.range_bytes, self.tasks)
        return [_Range(stem, s, min(s + step, size), encoding)
                for stem, size, encoding in self.files for s in range(0, size, step)] or [_Range()]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value:
            stem, start, end, encoding = partition.value
            for s in range(start, end, self.range_bytes):
                yield from records(stem, s, min(s + self.range_bytes, end), self.columns, encoding)


class PolygonFiles(DataSource):
    """Records of binary polygon layers (options: files, columns, range_bytes, tasks)."""

    @classmethod
    def name(cls) -> str:
        return "polygon_files"

    def schema(self) -> str:
        names = "".join(f", `{c}` string" for c in json.loads(self.options["columns"]))
        return f"record long{names}, rings array<array<struct<x:double,y:double>>>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_polygons(spark: SparkSession, path: str, encoding: str = "utf-8",
                  range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``record`` (its number in its file), the attributes as text, ``rings``."""
    ship_package(spark)
    spark.dataSource.register(PolygonFiles)
    folder = path[:-4] + ".*" if path.lower().endswith(".shp") else path
    found = {r.path: r.length for r in spark.read.format("binaryFile").load(folder)
             .select("path", "length").collect()}  # lengths alone; a row per file
    files, columns = [], None
    for name in sorted(p for p in found if p.endswith(".shp")):
        stem = name[:-4]
        if missing := [x for x in (".shx", ".dbf") if stem + x not in found]:
            raise LayerError(f"{name} has no {missing[0]}")
        with opened(stem + ".shp") as f:
            code, = struct.unpack(">i", f.read_at(4, 0))
            words, = struct.unpack(">i", f.read_at(4, 24))
        if code != FILE_CODE or 2 * words != found[name]:
            raise LayerError(f"{name} is no whole shape file: code {code}, {found[name]} of {2 * words} bytes")
        with opened(stem + ".dbf") as f:
            columns = columns or [n for n, _ in _fields(f, stem + ".dbf")[2]]
        text = encoding
        if stem + ".cpg" in found:
            with opened(stem + ".cpg") as f:
                text = f.read_at(found[stem + ".cpg"], 0).decode("ascii").strip().lower()
        files.append((stem, found[name], text))
    if not files:
        raise LayerError(f"no shape files under {path}")
    return (spark.read.format("polygon_files").option("files", json.dumps(files))
            .option("columns", json.dumps(columns)).option("range_bytes", str(range_bytes))
            .option("tasks", str(TASKS * spark.sparkContext.defaultParallelism)).load())


def read_layer(spark: SparkSession, path: str, **options) -> DataFrame:
    """``read_polygons`` with declared columns under their full names, for
    ``layer.build_layer(..., rings_col="rings")``."""
    short = {f.name[:NAME_CHARS]: f.name for f in SPECIES_GEOSPATIAL_RAW.fields}
    found = read_polygons(spark, path, **options)
    return found.select(*[F.col(f"`{c}`").alias(short.get(c, c)) for c in found.columns])


def write_polygons(df: DataFrame, folder: str, rings: str = "rings") -> DataFrame:
    """Write ``df`` as a trio of files per task under ``folder``; columns but
    ``rings`` become text attributes. A task holds its own files' bytes. Texts over
    the format's 254 bytes fail the job. Returns (path, records) per trio once run."""
    columns = [c for c in df.columns if c != rings]
    names = [c[:NAME_CHARS] for c in columns]
    if len({n.lower() for n in names}) < len(names):
        raise LayerError(f"names are not distinct in {NAME_CHARS} characters: {columns}")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, texts = [], [[] for _ in columns]
        box = [np.inf, np.inf, -np.inf, -np.inf]
        for b in batches:
            for row in b.column(rings).to_pylist():
                shapes.append(_content(row, box))
            for out, c in zip(texts, columns):
                out += [b"" if v is None else v.encode() for v in b.column(c).to_pylist()]
        if not shapes:
            return
        sizes = [max([1, *map(len, t)]) for t in texts]
        if max(sizes, default=0) > TEXT_BYTES:
            raise LayerError(f"a text of {max(sizes)} bytes is beyond the format's {TEXT_BYTES}")
        at, index, body = HEAD_BYTES, [], []
        for k, content in enumerate(shapes, 1):
            index.append(struct.pack(">ii", at // 2, len(content) // 2))
            body.append(struct.pack(">ii", k, len(content) // 2) + content)
            at += 8 + len(content)
        bounds = box if box[0] <= box[2] else [0.0] * 4

        def head(size: int) -> bytes:
            return struct.pack(">i20xi", FILE_CODE, size // 2) + struct.pack("<ii8d", VERSION, 5, *bounds, 0, 0, 0, 0)
        fields = b"".join(struct.pack("<11sc4xB15x", n.encode("ascii"), b"C", s) for n, s in zip(names, sizes))
        row_bytes = 1 + sum(sizes)
        rows = b"".join(b" " + b"".join(v.ljust(s) for v, s in zip(r, sizes)) for r in zip(*texts)) \
            if columns else b" " * len(shapes)
        dbf = struct.pack("<B3BIHH20x", 3, 95, 1, 1, len(shapes), DBF_FIELD + len(fields) + 1, row_bytes)
        stem = f"{folder}/part-{TaskContext.get().partitionId():05d}"
        for name, data in ((".shp", head(at) + b"".join(body)),
                           (".shx", head(HEAD_BYTES + 8 * len(index)) + b"".join(index)),
                           (".dbf", dbf + fields + DBF_END + rows + b"\x1a"), (".cpg", b"UTF-8")):
            created(stem + name, data)
        yield pa.RecordBatch.from_pydict({"path": [stem], "records": [len(shapes)]})

    ship_package(df.sparkSession)
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns], rings).mapInArrow(
        put, "path string, records long")


def _content(row, box: list[float]) -> bytes:
    if row is None:
        return struct.pack("<i", NULL_SHAPE)
    xy = np.array([(v["x"], v["y"]) for ring in row for v in ring], "<f8").reshape(-1, 2)
    starts = np.concatenate([[0], np.cumsum([len(r) for r in row])]).astype("<i4")[:len(row)]
    own = [*xy.min(axis=0), *xy.max(axis=0)] if len(xy) else [0.0] * 4
    if len(xy):
        box[:] = [*np.minimum(box[:2], own[:2]), *np.maximum(box[2:], own[2:])]
    return struct.pack("<i4dii", 5, *own, len(row), len(xy)) + starts.tobytes() + xy.tobytes()

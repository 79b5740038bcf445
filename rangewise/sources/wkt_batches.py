"""Polygon text read in batches of arrays, as ``functions.geo.wkt_rings_sql`` reads it row by row.

Interpreted for every vertex, that expression is most of a large layer's load. Here the
bytes of many texts are classified at once, numbers are cast as one column, and edges, boxes,
lengths and areas are array arithmetic in the order of the expressions.

Only texts that are plainly right are read so: a tag of letters and spaces, numbers,
spaces, commas and parentheses in their places. Any other (NULL, EMPTY, tabs, faults, very
long ones) is handed on unread, for the expression to read or to refuse.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rangewise.session import ship_package

#: Bytes of text read at once, and of a text that is left to the expression.
TOGETHER_BYTES, LONGEST_BYTES = 8 << 20, 64 << 20

_XY = pa.struct([(c, pa.float64()) for c in ("x", "y")])
_SIDE = pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])
#: What is added to the rows: columns and types, in Spark and in Arrow.
READ = {
    "_read": ("boolean", pa.bool_()),
    "_read_rings": ("array<array<struct<x:double,y:double>>>", pa.list_(pa.list_(_XY))),
    "_read_edges": ("array<struct<x1:double,y1:double,x2:double,y2:double>>", pa.list_(_SIDE)),
    **{f"_read_{c}": ("double", pa.float64()) for c in ("xmin", "ymin", "xmax", "ymax", "leng", "area")},
}

_TAG = re.compile(r" *(MULTI)?POLYGON *(ZM|Z|M)? *", re.I | re.A)
_RING_LIST = r"\(\(\)(,\(\))*\)"
_OUTLINE = {False: re.compile(_RING_LIST), True: re.compile(rf"\({_RING_LIST}(,{_RING_LIST})*\)")}

_OTHER, _NUMBER, _BLANK, _COMMA, _OPEN, _CLOSE = range(6)
_KIND = np.zeros(256, np.uint8)
_KIND[list(b"0123456789.-+eE")] = _NUMBER
_KIND[list(b" ")], _KIND[list(b",")], _KIND[list(b"(")], _KIND[list(b")")] = _BLANK, _COMMA, _OPEN, _CLOSE


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts without NULLs, and where each begins and the last ends."""
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    at = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[at[0]:at[-1]], at - at[0]


def tagged(texts: pa.Array) -> list[tuple[bool, int, np.ndarray]]:
    """(multi, numbers of a vertex, rows) of the rows whose tag is plain."""
    first = pc.find_substring(texts, "(").to_numpy(zero_copy_only=False)
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero((first > 0) & (first < 40) & (lengths <= LONGEST_BYTES))
    tags = pc.utf8_slice_codeunits(texts.take(pa.array(rows)), 0, 40).to_pylist()
    found: dict[tuple[bool, int], list[int]] = {}
    meant: dict[str, tuple[bool, int] | None] = {}
    for row, text in zip(rows.tolist(), tags):
        tag = text[:text.find("(")]
        if tag not in meant:
            m = _TAG.fullmatch(tag)
            meant[tag] = (m[1] is not None, 2 + len(m[2] or "")) if m else None
        if meant[tag]:
            found.setdefault(meant[tag], []).append(row)
    return [(multi, d, np.array(at)) for (multi, d), at in found.items()]


def _within(sorted_places: np.ndarray, opened: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many places lie in each group, and which lie in any."""
    lo, hi = np.searchsorted(sorted_places, opened), np.searchsorted(sorted_places, closed)
    n = len(sorted_places) + 1
    change = np.bincount(lo, minlength=n) - np.bincount(hi, minlength=n)
    return hi - lo, np.cumsum(change[:-1]) > 0


def parsed(texts: pa.Array, multi: bool, d: int):
    """Texts of one kind of tag -> (rows read, ordinates x and y, vertices of each ring,
    rings of each row read). Rows with anything unusual are not among them."""
    rows = np.arange(len(texts))
    while len(rows):
        data, at = _bytes(texts.take(pa.array(rows)))
        kind = _KIND[data]
        first = np.searchsorted(opens := np.flatnonzero(kind == _OPEN), at[:-1])
        for a, b in zip(at[:-1].tolist(), opens[first].tolist()):
            kind[a:b] = _BLANK

        def without(places: np.ndarray) -> np.ndarray:
            return np.delete(rows, np.unique(np.searchsorted(at, places, "right") - 1))
        odd = np.concatenate([np.flatnonzero(kind == _OTHER), at[1:][kind[at[1:] - 1] != _CLOSE] - 1])
        if len(odd):
            rows = without(odd)
            continue
        paren = np.flatnonzero(kind >= _OPEN)
        is_open = kind[paren] == _OPEN
        ring = np.flatnonzero(is_open[:-1] & ~is_open[1:])
        opened, closed = paren[ring], paren[ring + 1]
        comma = np.flatnonzero(kind == _COMMA)
        commas, inside = _within(comma, opened, closed)
        # what is left without the rings' own: few characters a ring
        outline = np.sort(np.concatenate([paren, comma[~inside]]))
        text = np.frombuffer(b"   ,()", np.uint8)[kind[outline]].tobytes()
        cut = np.searchsorted(outline, at).tolist()
        right: dict[bytes, bool] = {}
        wrong = []
        for row, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            if text[a:b] not in right:
                right[text[a:b]] = bool(_OUTLINE[multi].fullmatch(text[a:b].decode()))
            if not right[text[a:b]]:
                wrong.append(row)
        if wrong:
            rows = np.delete(rows, wrong)
            continue
        number = kind == _NUMBER
        edge = np.diff(number.view(np.int8))
        begins, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        tokens, held = _within(begins, opened, closed)
        odd = np.concatenate([begins[~held], opened[tokens != d * (commas + 1)]])
        if len(odd):
            rows = without(odd)
            continue
        # one comma after each vertex but a ring's last, none within a vertex
        sizes = commas + 1
        more = np.ones(int(sizes.sum()), bool)
        more[np.cumsum(sizes) - 1] = False
        v, between = np.flatnonzero(more), comma[inside]
        odd = between[(ends[v * d + d - 1] > between) | (begins[v * d + d] < between)]
        if len(odd):
            rows = without(odd)
            continue
        offsets = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
        column = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(data[number]))
        try:
            values = column.cast(pa.float64()).to_numpy()
        except pa.ArrowInvalid:
            return rows[:0], *[np.empty(0)] * 2, *[np.empty(0, np.int64)] * 2
        rings = np.diff(np.searchsorted(opened, at))
        return rows, np.ascontiguousarray(values[::d]), np.ascontiguousarray(values[1::d]), sizes, rings
    return rows, *[np.empty(0)] * 2, *[np.empty(0, np.int64)] * 2


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(_offsets(sizes)), values)


def _structs(**columns: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def measured(xs: np.ndarray, ys: np.ndarray, sizes: np.ndarray, rings: np.ndarray) -> list[pa.Array]:
    """The columns of ``READ`` after the flag: rings, edges (the closing one added where it is
    missing), box, length and area of each row."""
    n, last = len(xs), np.cumsum(sizes) - 1
    follows = np.arange(1, n + 1)
    first = last - sizes + 1
    follows[last] = first
    keep = np.ones(n, bool)
    keep[last[(sizes < 2) | ((xs[first] == xs[last]) & (ys[first] == ys[last]))]] = False
    x1, y1, x2, y2 = xs[keep], ys[keep], xs[follows][keep], ys[follows][keep]
    a = _offsets(np.add.reduceat(_edges_of_rings(keep, sizes), _offsets(rings)[:-1]) if len(rings) else rings)
    lo, hi = a[:-1], a[1:]
    some = hi > lo
    box = []
    for f, u, v in ((np.minimum, x1, x2), (np.minimum, y1, y2), (np.maximum, x1, x2), (np.maximum, y1, y2)):
        out = np.zeros(len(lo))
        if some.any():
            out[some] = f.reduceat(f(u, v), lo[some])
        box.append(pa.array(out, mask=~some))
    dx, dy = x2 - x1, y2 - y1
    # added up one after the other, as an aggregate does
    long, turn = np.sqrt(dx * dx + dy * dy), x1 * y2 - x2 * y1
    total = [np.array([np.cumsum(v[i:j])[-1] if j > i else 0.0 for i, j in zip(lo.tolist(), hi.tolist())])
             for v in (long, turn)]
    return [_lists(rings, _lists(sizes, _structs(x=xs, y=ys))),
            _lists(hi - lo, _structs(x1=x1, y1=y1, x2=x2, y2=y2)),
            *box, pa.array(total[0]), pa.array(np.abs(total[1] / 2))]


def _edges_of_rings(keep: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many vertices of each ring begin an edge."""
    return np.add.reduceat(keep.astype(np.int64), np.cumsum(sizes) - sizes)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows [start, end) of some ``TOGETHER_BYTES`` of text each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(size):
        before = size[start - 1] if start else 0
        end = max(int(np.searchsorted(size, before + TOGETHER_BYTES, "right")), start + 1)
        yield start, end
        start = end


def _rows(b: pa.RecordBatch, text: str, at: np.ndarray, new: list[pa.Array] | None) -> pa.RecordBatch:
    """Rows ``at`` with what was read of their texts, which then go; without it, texts stay."""
    taken = pa.array(at)
    columns = {c: pa.nulls(len(at), b.column(c).type) if new and c == text else b.column(c).take(taken)
               for c in b.schema.names}
    flag = pa.array(np.full(len(at), new is not None))
    kinds = [kind for _, kind in READ.values()]
    added = [flag, *([v.cast(kind) for v, kind in zip(new, kinds[1:])] if new else
                     [pa.nulls(len(at), kind) for kind in kinds[1:]])]
    return pa.RecordBatch.from_arrays([*columns.values(), *added], names=[*columns, *READ])


def read_in_batches(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the columns of ``READ``; ``text`` becomes NULL where it was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, end in _chunks(whole.column(text)):
                b = whole.slice(start, end - start)
                texts, unread = b.column(text), np.ones(len(b), bool)
                for multi, d, at in tagged(texts):
                    rows, *found = parsed(texts.take(pa.array(at)), multi, d)
                    if len(rows):
                        unread[at[rows]] = False
                        yield _rows(b, text, at[rows], measured(*found))
                if unread.any():
                    yield _rows(b, text, np.flatnonzero(unread), None)

    ship_package(df.sparkSession)
    added = ", ".join(f"{c} {kind}" for c, (kind, _) in READ.items())
    return df.mapInArrow(run, T.StructType([*df.schema, *T.StructType.fromDDL(added)]))

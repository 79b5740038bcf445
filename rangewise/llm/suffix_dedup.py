"""Exact substring dedup over bytes: every byte that a 100-byte string covers
which also starts earlier is removed.

Suffix arrays decide, built by linear Lyndon grouping
(``lyndon_suffixes``); Spark deals texts out so that no array has to hold
the corpus:

1. Each 100-byte string belongs to its anchor, the 32-byte gram of least hash
   in it. Equal strings have equal anchors, and the strings of one anchor
   occurrence start at consecutive places, so an occurrence is a segment of
   100 to 168 bytes. A map pass emits segments as (anchor, segment hash,
   place), without text, packed column-wise. Segments that repeat within the
   task are settled there: all but the first go.
2. Per anchor, equal segments are settled the same way over the whole corpus.
   Only anchors with different segments left go on, a segment once each.
3. Documents meet those requests and send the segments' bytes to the anchor's
   bucket, where the different segments of an anchor form one text, and a
   suffix array of it groups equal 100-byte strings; all but the first of a
   group go.
4. Documents meet the spans to be removed.

A group of copies thus costs a segment per task, not per copy. An anchor with
over ``HOT_VARIANTS`` different segments is divided by a second anchor inside
each segment, chosen by another hash. Documents are shuffled once (one
exchange serves 3 and 4). Tasks hold a bucket of documents or segments; there
are ``8 * spark.sql.shuffle.partitions`` buckets, so that setting sizes them.

Equal segments are told by hashes of 40 and 64 bits together; strings inside
the suffix arrays are compared by their bytes.

Defined cases: null and empty texts have no bytes; texts of under 100 bytes
lose nothing; rows that repeat id and text are one document, each row getting
its result (two texts under one id are not told apart); rows of a null id are
not compared and lose nothing; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangewise.llm.common import chunks, mix, plain, raw_bytes, texts, written
from rangewise.llm.lyndon_suffixes import END, _ranges, suffix_arrays
from rangewise.session import ship_package

#: Bytes of a string that counts as repeated, and of an anchor.
LENGTH, GRAM = 100, 32
#: Different segments of an anchor above which it is divided.
HOT_VARIANTS = 2000
#: Bytes hashed at once, and symbols in one batch of suffix arrays.
HASH_BYTES, SORT_SYMBOLS = 1 << 20, 2 << 20

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
PACKED = "bucket long, kind int, n long, body binary"
ANCHORS, SPANS, WANTS, SEGMENTS = range(4)

_FACTOR = 0x9E3779B97F4A7C15
_PLACE_BITS = 24
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _planes(*columns: np.ndarray) -> bytes:
    """Columns byte plane by byte plane, which compresses well."""
    return b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes()
                    for c in columns)


def _columns(body: bytes, n: int, kinds: tuple[str, ...]) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        dtype = np.dtype(kind)
        size = dtype.itemsize * n
        planes = np.frombuffer(body, np.uint8, size, at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).ravel())
        at += size
    return out


_KINDS = {ANCHORS: ("<u8", "<u8", "<i8", "<i4", "u1"), SPANS: ("<i8", "<i4", "<i4"),
          WANTS: ("<u8", "<i8", "<i4", "u1", "u1")}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        size = 1 << int(n - 1).bit_length()
        both = []
        for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
            x = np.full(size, f, np.uint64)
            x[0] = 1
            with np.errstate(over="ignore"):
                both.append(np.cumprod(x))
        _POWERS[:] = [tuple(both)]
    return _POWERS[0]


class _Hasher:
    """Hashes of any substring of ``data``."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(len(data) + 1)
        symbols = mix(np.arange(1, 257, dtype=np.uint64))
        self.run = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(symbols[data] * powers[:len(data)], out=self.run[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.run[end] - self.run[start]) * self.inverse[start])

    def grams(self, k: int) -> np.ndarray:
        n = max(len(self.run) - k, 0)
        with np.errstate(over="ignore"):
            return mix((self.run[k:] - self.run[:n]) * self.inverse[:n])


def anchors(data: np.ndarray, offsets: np.ndarray, salt: int = 0):
    """(text, first start in data, starts, anchor hash, segment hash) of the
    segments of texts that lie back to back in ``data``."""
    sizes = np.diff(offsets)
    usable = np.flatnonzero(sizes >= LENGTH)
    empty = np.empty(0, np.int64)
    if not len(usable):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    assert len(data) < 1 << _PLACE_BITS  # a place must leave the hash bits alone
    hasher = _Hasher(data)
    gram = hasher.grams(GRAM)
    order = mix(gram + np.uint64(salt)) if salt else gram
    # of equal least grams the first: the place is part of what is compared
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = (order & ~low) | np.arange(len(gram), dtype=np.uint64)
    width, span = LENGTH - GRAM + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:-(width - span)], least[width - span:])
    starts = _ranges(offsets[usable], sizes[usable] - LENGTH + 1)
    place = (least[starts] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    n = np.diff(np.append(first, len(starts)))
    start = starts[first]
    text = np.searchsorted(offsets, start, side="right") - 1
    return text, start, n, gram[place[first]], hasher(start, start + n + (LENGTH - 1))


def _anchors_by_part(data: np.ndarray, offsets: np.ndarray, salt: int = 0) -> list[np.ndarray]:
    """``anchors`` of short texts of any total size, about ``HASH_BYTES`` at a
    time."""
    cut = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(offsets[1:] // HASH_BYTES)) + 1,
                                    [len(offsets) - 1]]))
    found = []
    for a, b in zip(cut, cut[1:]):
        text, start, *rest = anchors(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], salt)
        found.append((text + a, start + offsets[a], *rest))
    return [np.concatenate(x) for x in zip(*found)]


def _pieces(arr: pa.Array, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, id and base of each text) with at most about
    ``HASH_BYTES`` bytes and a text of at most as many; a longer text comes by
    itself, in pieces that overlap so that each 100-byte string lies in one."""
    data, offsets = raw_bytes(arr)
    lengths = np.diff(offsets)
    long = np.flatnonzero(lengths > HASH_BYTES)
    cut = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(lengths) // HASH_BYTES)) + 1,
                                    long, long + 1, [len(arr)]]))
    for a, b in zip(cut, cut[1:]):
        if lengths[a] > HASH_BYTES:
            for s in range(0, int(lengths[a]) - LENGTH + 1, HASH_BYTES):
                x = data[offsets[a] + s:min(offsets[a] + s + HASH_BYTES + LENGTH - 1, offsets[b])]
                yield x, np.array([0, len(x)]), ids[a:b], np.array([s])
        elif b > a:
            yield (data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], ids[a:b],
                   np.zeros(b - a, np.int64))


def _row(bucket: int, kind: int, n: int, body: bytes) -> tuple[int, int, int, bytes]:
    return int(bucket), kind, int(n), body


def _batches(rows: Iterator[tuple[int, int, int, bytes]], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
            names=["bucket", "kind", "n", "body"])

    for r in rows:
        out.append(r)
        size += len(r[3]) + 32
        if size > most:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def _dealt(bucket: np.ndarray, kind: int, *columns: np.ndarray):
    """Rows of PACKED, one per bucket."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    columns = [c[order] for c in columns]
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    for s, e in zip(edge.tolist(), np.append(edge[1:], len(bucket)).tolist()):
        yield _row(bucket[s], kind, e - s, _planes(*(c[s:e] for c in columns)))


def _doc_bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _spans(doc: np.ndarray, start: np.ndarray, n: np.ndarray, buckets: int):
    """Rows of runs of starts to be removed; runs that touch become one."""
    if not len(doc):
        return
    order = np.lexsort((start, doc))
    doc, start, n = doc[order], start[order].astype(np.int64), n[order].astype(np.int64)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + n[:-1])
    first = np.flatnonzero(new)
    total = np.add.reduceat(n, first)
    doc = doc[first]
    yield from _dealt(_doc_bucket(doc, buckets), SPANS, doc.astype("<i8"),
                      start[first].astype("<i4"), total.astype("<i4"))


def _settle(key, seg, doc, start):
    """Order of the rows by (anchor, segment, place), whether each is the
    first of its (anchor, segment), and whether it is at a later place. A row
    that repeats the first place is neither."""
    with np.errstate(over="ignore"):
        joint = mix(key) + seg
    order = np.lexsort((start, doc, seg, joint))
    key, seg, doc, start = key[order], seg[order], doc[order], start[order]
    first = np.ones(len(order), bool)
    first[1:] = (key[1:] != key[:-1]) | (seg[1:] != seg[:-1])
    head = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    again = ~first & ((doc != doc[head]) | (start != start[head]))
    return order, first, again


def _collected(batches: Iterator[pa.RecordBatch], kind: int):
    """Columns of all rows of a kind; rows of other kinds as they are."""
    found, others = [], []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[1] == kind:
                found.append(_columns(row[3], row[2], _KINDS[kind]))
            else:
                others.append(row)
    columns = [np.concatenate(x) for x in zip(*found)] if found else None
    return columns, others


def _find(docs: DataFrame, buckets: int) -> DataFrame:
    """Step 1: anchors, and spans settled inside a task."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for b in chunks(batches):
            b = b.filter(b.column("doc_id").is_valid())
            for data, offsets, ids, base in _pieces(
                    plain(b.column("text")), b.column("doc_id").to_numpy(zero_copy_only=False)):
                text, start, n, key, seg = anchors(data, offsets)
                found.append((key >> np.uint64(_PLACE_BITS), seg, ids[text].astype("<i8"),
                              (start - offsets[text] + base[text]).astype("<i4"), n.astype("u1")))
        if not found:
            return
        columns = [np.concatenate(x) for x in zip(*found)]
        del found
        order, first, gone = _settle(*columns[:4])
        columns = [c[order] for c in columns]
        yield from _batches(_spans(*(c[gone] for c in columns[2:]), buckets))
        columns = [c[first] for c in columns]
        yield from _batches(_dealt((columns[0] % np.uint64(buckets)).astype(np.int64), ANCHORS, *columns))

    return docs.mapInArrow(find, PACKED)


def _match(found: DataFrame, buckets: int, hot: int) -> DataFrame:
    """Step 2: equal segments settled, and requests for the bytes of others."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, others = _collected(batches, ANCHORS)
        yield from _batches(iter(others))
        if columns is None:
            return
        order, first, gone = _settle(*columns[:4])
        columns = [c[order] for c in columns]
        yield from _batches(_spans(*(c[gone] for c in columns[2:]), buckets))
        key, _, doc, start, n = (c[first] for c in columns)
        order = np.argsort(key, kind="stable")
        key, doc, start, n = key[order], doc[order], start[order], n[order]
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        variants = np.diff(np.append(edge, len(key)))
        variants = np.repeat(variants, variants)
        more = variants > 1
        yield from _batches(_dealt(_doc_bucket(doc[more], buckets), WANTS, key[more], doc[more],
                                   start[more], n[more], (variants[more] > hot).astype("u1")))

    return found.repartition("bucket").mapInArrow(match, PACKED)


def _texts_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = raw_bytes(plain(table.column("text").combine_chunks()
                                    if table.num_rows else pa.array([], pa.string())))
    return data, offsets, table.column("doc_id").to_numpy()


def _asked(right: pa.Table, kind: int) -> list[np.ndarray] | None:
    return _collected(iter(right.select(["bucket", "kind", "n", "body"]).to_batches()), kind)[0]


def _send(left: pa.Table, right: pa.Table, buckets: int) -> pa.Table:
    """Step 3 at the documents: the segments that were asked for."""
    asked = _asked(right, WANTS)
    schema = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("n", pa.int64()),
                        ("body", pa.binary())])
    left = left.filter(left.column("doc_id").is_valid())
    if asked is None or not left.num_rows:
        return schema.empty_table()
    key, doc, start, n, hot = asked
    data, offsets, ids = _texts_of(left)
    rank = np.argsort(ids, kind="stable")
    rank = rank[np.searchsorted(ids[rank], doc)]  # the first row of each id asked for
    begin = offsets[rank] + start
    n = n.astype(np.int64)
    size = n + (LENGTH - 1)
    hot = hot.astype(bool)
    if hot.any():  # second anchors inside the segments of hot ones
        parts = data[_ranges(begin[hot], size[hot])]
        cut = np.concatenate([[0], np.cumsum(size[hot])])
        text, at, count, gram, _ = _anchors_by_part(parts, cut, salt=1)
        within = at - cut[text]
        with np.errstate(over="ignore"):
            new = mix(key[hot][text] + (gram >> np.uint64(1)))
        key = np.concatenate([key[~hot], new])
        doc = np.concatenate([doc[~hot], doc[hot][text]])
        start = np.concatenate([start[~hot], (start[hot][text] + within).astype("<i4")])
        begin = np.concatenate([begin[~hot], begin[hot][text] + within])
        n = np.concatenate([n[~hot], count])
        size = n + (LENGTH - 1)
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    rows = []
    for s, e in zip(edge.tolist(), np.append(edge[1:], len(bucket)).tolist()):
        k = order[s:e]
        rows.append(_row(bucket[s], SEGMENTS, e - s, _planes(
            key[k], doc[k], start[k], n[k].astype("u1"))
            + data[_ranges(begin[k], size[k])].tobytes()))
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)


_SEGMENT = ("<u8", "<i8", "<i4", "u1")


def repeated_starts(key: np.ndarray, doc: np.ndarray, start: np.ndarray, n: np.ndarray,
                    data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, start) of the 100-byte strings of segments, sorted by key,
    that another segment of the key holds at an earlier place."""
    size = n + (LENGTH - 1)
    at = np.cumsum(size) - size
    # one text per key: symbols from 2, a 1 after each segment, END after the last
    slot = at + np.arange(len(size))
    text = np.empty(len(data) + len(size), np.int16)
    text[_ranges(slot, size)] = data.astype(np.int16) + 2
    last = np.append(key[1:] != key[:-1], True)
    text[slot + size] = np.where(last, END, 1)
    low = np.concatenate([[0], slot[last] + size[last] + 1])
    order = suffix_arrays(text, low)
    owner = np.full(len(text), -1, np.int32)
    owner[_ranges(slot, n)] = np.repeat(np.arange(len(n), dtype=np.int32), n)
    order = order[owner[order] >= 0]
    segment = owner[order].astype(np.int64)
    within = order - slot[segment]
    strings = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    equal = np.zeros(len(order), bool)
    for s in range(1, len(order), 1 << 18):  # neighbours in the suffix array
        here = strings[(at[segment] + within)[s - 1:s + (1 << 18)]]
        equal[s:s + len(here) - 1] = (here[1:] == here[:-1]).all(axis=1)
    equal[1:] &= key[segment[1:]] == key[segment[:-1]]
    group = np.cumsum(~equal)
    several = equal.copy()
    several[:-1] |= equal[1:]
    group, segment, within = group[several], segment[several], within[several]
    place, owner_doc = start[segment] + within, doc[segment]
    order = np.lexsort((place, owner_doc, group))
    group, place, owner_doc = group[order], place[order], owner_doc[order]
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    head = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    later = ~first & ((owner_doc != owner_doc[head]) | (place != place[head]))
    return owner_doc[later], place[later]


def _sort(segments: DataFrame, buckets: int) -> DataFrame:
    """Step 3 at the anchors: suffix arrays of their segments."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for b in batches:
            for count, body in zip(b.column("n").to_pylist(), b.column("body").to_pylist()):
                columns = _columns(body, count, _SEGMENT)
                head = sum(np.dtype(k).itemsize for k in _SEGMENT) * count
                found.append((*columns, np.frombuffer(body, np.uint8, offset=head)))
        if not found:
            return
        key, doc, start, n, data = (np.concatenate(x) for x in zip(*found))
        del found
        n = n.astype(np.int64)
        size = n + (LENGTH - 1)
        begin = np.cumsum(size) - size
        # whole keys per batch, about SORT_SYMBOLS symbols each; keys of like
        # size together, as a batch takes as many steps as its largest text
        order = np.argsort(key, kind="stable")
        edge = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        weight = np.empty(len(order), np.int64)
        weight[order] = np.repeat(np.add.reduceat(size[order], edge), np.diff(np.append(edge, len(order))))
        order = np.lexsort((key, weight))
        total = np.cumsum(size[order])
        edge = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        turn = (total[edge] // SORT_SYMBOLS)
        cuts = [*edge[np.flatnonzero(np.append(True, turn[1:] != turn[:-1]))].tolist(), len(order)]
        docs, places = [], []
        for s, e in zip(cuts, cuts[1:]):
            k = order[s:e]
            d, p = repeated_starts(key[k], doc[k], start[k], n[k], data[_ranges(begin[k], size[k])])
            docs.append(d)
            places.append(p)
        doc, place = np.concatenate(docs), np.concatenate(places)
        yield from _batches(_spans(doc, place, np.ones(len(doc), np.int64), buckets))

    return segments.repartition("bucket").mapInArrow(sort, PACKED)


def _cut(left: pa.Table, right: pa.Table, keep_text: bool) -> pa.Table:
    """Step 4: each document's removed bytes and what is left."""
    data, offsets, _ = _texts_of(left)
    ids = left.column("doc_id").to_pylist()
    asked = _asked(right, SPANS)
    by_doc: dict[int, tuple[int, int]] = {}
    if asked is not None:
        order = np.argsort(asked[0], kind="stable")
        doc, start, n = (c[order].astype(np.int64) for c in asked)
        edge = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        by_doc = dict(zip(doc[edge].tolist(), zip(edge.tolist(), np.append(edge[1:], len(doc)).tolist())))
    rows = []
    for k, i in enumerate(ids):
        text = data[offsets[k]:offsets[k + 1]]
        removed = spans = 0
        if i in by_doc:
            s, e = by_doc[i]
            size = len(text)
            step = (np.bincount(np.minimum(start[s:e], size), minlength=size + 1)
                    - np.bincount(np.minimum(start[s:e] + n[s:e] + (LENGTH - 1), size), minlength=size + 1))
            gone = np.cumsum(step)[:size] > 0
            removed = int(gone.sum())
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            text, size = text[~gone], size
        else:
            size = len(text)
        left_over = text.tobytes()
        rows.append((i, size, removed, spans, hashlib.sha256(left_over).hexdigest(),
                     *([left_over] if keep_text else [])))
    names = [c.split()[0] for c in SCHEMA.split(", ")] + ["kept"] * keep_text
    types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * keep_text
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=names)


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 hot_variants: int = HOT_VARIANTS, keep_text: bool = False) -> DataFrame:
    """One row per document (columns: ``SCHEMA``; with ``keep_text`` also
    ``kept``, the bytes left, which a cut may have left off a character's
    edge)."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = texts(docs, doc_id, text)
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    matched = written(spark, _match(_find(docs, buckets), buckets, hot_variants), "suffix-matched")

    def bucket_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            # rows of a null id are compared with nothing: dealt by their place
            ids = pc.if_else(b.column("doc_id").is_valid(), b.column("doc_id"),
                             pa.array(row + np.arange(b.num_rows))).to_numpy()
            row += b.num_rows
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(_doc_bucket(ids.astype("<i8"), buckets))],
                names=["doc_id", "text", "bucket"])

    dealt = docs.mapInArrow(bucket_of, "doc_id long, text string, bucket long")
    segments = (dealt.groupBy("bucket").cogroup(matched.where(F.col("kind") == WANTS).groupBy("bucket"))
                .applyInArrow(lambda left, right: _send(left, right, buckets), PACKED))
    spans = matched.where(F.col("kind") == SPANS).unionByName(_sort(segments, buckets))
    return (dealt.groupBy("bucket").cogroup(spans.groupBy("bucket"))
            .applyInArrow(lambda left, right: _cut(left, right, keep_text),
                          SCHEMA + ", kept binary" * keep_text))

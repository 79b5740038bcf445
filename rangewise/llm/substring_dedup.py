"""Line dedup with sub-units: normalised pieces of lines are hashed, equal
digests are grouped over all documents, the earliest ranked occurrence stays,
and long enough runs of later ones go.

Units. A line (``\\n``-separated) is cut before every word whose checksum is
less than those of the ``REACH`` words on either side of it in the line, and
every ``LONGEST`` words where no such word comes. So cuts depend on nearby words alone: a
passage that stands in the middle of other lines is cut as it is elsewhere, but
for a few words at its ends. The normal form of a unit has A-Z in lower case and
runs of ASCII white space as one space. Units tile their line; what has no
words belongs to no unit and is kept.

Rule. A unit is a repeat if an earlier document, or an earlier place in its own,
has it. Consecutive repeats of a document form a run, and a run goes if it has
``RUN_WORDS`` words or ``RUN_BYTES`` bytes of normal form (for text without
spaces). Shorter runs stay: a stock phrase is no passage. A line that goes whole takes its
line break with it. Rank is (doc_id, unit number), a null id before all others; rows
of one id are level and take nothing from each other, so the result does not
depend on partitioning.

Shape of the job: a map pass makes (digest, rank) rows in numpy; counts and the
least rank per digest are combined map-side in fixed-size buffers; only repeated
digests are written. A digest with more rows than a task's share is
salted on both sides of the join that marks the later units. Texts move
once, to meet the numbers of their repeated units; offsets are computed again there
rather than shuffled.

Defined cases: null text has no units and stays null; empty text has none and stays;
rows equal in id and text get the same result; a document that goes whole
keeps its row with an empty text; texts of any length are taken whole; an empty
table gives no rows; extra columns pass through ``remove`` whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangewise.llm.common import LOWER, chunks, fresh, mapped, mix, plain, raw_bytes, words, written
from rangewise.operators.joins import salted_by_count
from rangewise.session import ship_package

#: A cut has the least checksum among so many words on either side.
REACH = 3
#: Words after which a unit is cut anyway.
LONGEST = 32
#: Least words, or bytes of normal form, of a run of repeats that goes.
RUN_WORDS = 24
RUN_BYTES = 200
#: Rows of one digest in a task: so many at least, and one in ``HOT_DIGESTS`` of all
#: repeated ones, which bounds the list of digests above it.
SALT_ROWS = 1000
HOT_DIGESTS = 100_000

#: Text bytes whose units a task holds at once (or one text, if larger).
PASS_BYTES = 2 << 20

UNITS = "rank long, text_hash long, unit int, again boolean, d1 long, d2 long"

_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True


class Units(NamedTuple):
    """Units of the texts of a batch, in order: whose they are (row), their
    number there, words, bytes of normal form, byte range within the batch's data,
    whether they begin and end their line, and a digest of two numbers."""
    row: np.ndarray
    number: np.ndarray
    words: np.ndarray
    size: np.ndarray
    start: np.ndarray
    end: np.ndarray
    line: np.ndarray
    digest: tuple[np.ndarray, np.ndarray]


def checksums(vocab: pa.Array) -> np.ndarray:
    """Leading 64 bits of each word's MD5."""
    return np.frombuffer(b"".join(hashlib.md5(w.encode()).digest()[:8] for w in vocab.to_pylist()),
                         ">u8").astype(np.uint64)


def cuts(h: np.ndarray, line: np.ndarray, reach: int = REACH, longest: int = LONGEST) -> np.ndarray:
    """True for words that begin a unit."""
    n = len(h)
    cut = np.ones(n, bool)
    for d in range(1, min(reach, n - 1) + 1):
        apart = line[d:] != line[:-d]
        cut[d:] &= apart | (h[d:] < h[:-d])
        cut[:-d] &= apart | (h[:-d] < h[d:])
    if n:
        cut[0] = True
        cut[1:] |= line[1:] != line[:-1]
        at = np.flatnonzero(cut)
        place = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
        cut |= place % longest == 0
    return cut


def units_of(arr: pa.Array) -> Units:
    """Units of all texts of a ``plain`` array."""
    arr = mapped(arr, LOWER)
    data, offsets = raw_bytes(arr)
    data, offsets = data[:offsets[-1]], np.asarray(offsets)
    codes, _, vocab = words(arr)
    white = _WHITE[data]
    solid = ~white
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= white[:-1]
    ends[:-1] &= white[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]  # texts meet without white space
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, first, side="right") - 1
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, first) + row
    h = checksums(vocab)[codes]
    at = np.flatnonzero(cuts(h, line))
    if not len(at):
        none = np.empty(0, np.int64)
        return Units(none, none, none, none, none, none, none, (none, none))
    n_words = np.diff(np.append(at, len(h)))
    place = (np.arange(len(h)) - np.repeat(at, n_words) + 1).astype(np.uint64)
    with np.errstate(over="ignore"):
        digest = tuple(np.add.reduceat(mix(h ^ mix(place * np.uint64(k))), at).view(np.int64)
                       for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
    u_row, u_line = row[at], line[at]
    size = np.add.reduceat(last - first, at) + n_words - 1
    # a unit reaches to the next one in its line; the line's ends are its outer bounds
    edges = np.concatenate([[-1], breaks, [len(data)]])
    k = np.searchsorted(breaks, first[at])
    line_start = np.maximum(edges[k] + 1, offsets[u_row])
    line_end = np.minimum(edges[k + 1], offsets[u_row + 1])
    new_line = np.concatenate([[True], u_line[1:] != u_line[:-1]])
    start = np.where(new_line, line_start, first[at])
    end = np.where(np.append(new_line[1:], True), line_end, np.append(start[1:], 0))
    number = np.arange(len(at)) - np.searchsorted(u_row, u_row)
    return Units(u_row, number, n_words, size, start, end, u_line, digest)


def _again(u: Units) -> np.ndarray:
    """True for units that their own text has before."""
    order = np.lexsort((u.number, u.digest[1], u.digest[0], u.row))
    same = np.ones(max(len(order) - 1, 0), bool)
    for x in (u.row, *u.digest):
        same &= x[order][1:] == x[order][:-1]
    out = np.zeros(len(order), bool)
    out[order[1:]] = same
    return out


def units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per unit: its document, number, whether its text has it before,
    and its digest."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, size=PASS_BYTES):
            u = units_of(plain(b.column("text")))
            at = pa.array(u.row)
            yield pa.RecordBatch.from_arrays(
                [b.column("rank").take(at), b.column("text_hash").take(at),
                 pa.array(u.number.astype(np.int32)), pa.array(_again(u)),
                 pa.array(u.digest[0]), pa.array(u.digest[1])],
                names=[c.split()[0] for c in UNITS.split(", ")])

    ship_package(docs.sparkSession)
    return docs.select(_rank(doc_id).alias("rank"), F.xxhash64(F.col(text)).alias("text_hash"),
                       F.col(text).alias("text")).mapInArrow(split, UNITS)


def _rank(doc_id: str):
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """rank, text_hash, again: numbers of a document's units that an earlier
    document, or an earlier place in it, has."""
    found = units(docs, doc_id, text)
    first = written(docs.sparkSession, found.groupBy("d1", "d2").agg(
        F.min("rank").alias("least"), F.max("rank").alias("most"), F.max("again").alias("twice"),
        F.count("*").alias("rows")).where("least < most OR twice").select("d1", "d2", "least", "rows"),
        "repeated-units")
    total = first.agg(F.sum("rows")).first()[0] or 0
    big, small = salted_by_count(found, first, ["d1", "d2"], "rows", F.xxhash64("rank", "text_hash", "unit"),
                        max(SALT_ROWS, total // HOT_DIGESTS))
    later = (big.join(small, ["d1", "d2", "salt"])
             .where((F.col("least") < F.col("rank")) | F.col("again")))
    return later.groupBy("rank", "text_hash").agg(F.collect_set("unit").alias("again"))


def passages(u: Units, repeated: np.ndarray, run_words: int = RUN_WORDS,
             run_bytes: int = RUN_BYTES) -> np.ndarray:
    """True for units that go: those in a long enough run of repeated ones."""
    gone = np.zeros(len(repeated), bool)
    at = np.flatnonzero(repeated)
    if len(at):
        begins = np.flatnonzero(np.concatenate(
            [[True], (np.diff(at) > 1) | (np.diff(u.row[at]) > 0)]))
        long = ((np.add.reduceat(u.words[at], begins) >= run_words)
                | (np.add.reduceat(u.size[at], begins) >= run_bytes))
        gone[at] = np.repeat(long, np.diff(np.append(begins, len(at))))
    return gone


def _without(arr: pa.Array, u: Units, gone: np.ndarray) -> list[bytes]:
    """The texts without those units, and without lines that went whole."""
    data, offsets = raw_bytes(arr)
    data = data[:offsets[-1]]
    change = np.zeros(len(data) + 1, np.int64)
    np.add.at(change, u.start[gone], 1)
    np.add.at(change, u.end[gone], -1)
    first = np.flatnonzero(np.concatenate([[True], np.diff(u.line) > 0]))
    last = np.append(first[1:], len(u.line)) - 1
    whole = np.add.reduceat(gone.astype(np.int64), first) == last - first + 1
    ends = u.end[last[whole]]
    inside = ends < offsets[u.row[last[whole]] + 1]  # followed by its line break
    np.add.at(change, ends[inside], 1)
    np.add.at(change, ends[inside] + 1, -1)
    keep = np.cumsum(change[:-1]) == 0
    cut_last = set(u.row[last[whole]][~inside].tolist())  # the last line went
    out = []
    for k, (s, e) in enumerate(zip(offsets, offsets[1:])):
        x = data[s:e][keep[s:e]].tobytes()
        out.append(x[:-1] if k in cut_last and x.endswith(b"\n") else x)
    return out


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with repeated passages cut from ``text``, and the name of one
    more column, struct<n_units, n_removed, spans>: the document's units, those that
    went, and their byte ranges (start, end) in the original text, joined where they touch.
    The name is one that ``docs`` does not have."""
    rank, key, again = (fresh(docs, x) for x in ("rank", "text_hash", "again"))
    name = fresh(docs, "removed")
    gone = repeats(docs, doc_id, text).select(
        F.col("rank").alias(rank), F.col("text_hash").alias(key), F.col("again").alias(again))
    joined = docs.join(gone, (_rank(doc_id) == F.col(rank)) & (F.xxhash64(F.col(text)) == F.col(key)),
                       "left").drop(rank, key)
    at = docs.columns.index(text)
    span = "struct<n_units:long,n_removed:long,spans:array<struct<start:long,end:long>>>"
    out = joined.withColumn(name, F.lit(None).cast(span)).drop(again)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, text, PASS_BYTES):
            yield _cut(b, at, name)

    return joined.mapInArrow(cut, out.schema), name


def _cut(b: pa.RecordBatch, at: int, name: str) -> pa.RecordBatch:
    """A batch whose last column has the numbers of repeated units, cut."""
    lists, old = b.column(b.num_columns - 1), b.column(at)
    arr = plain(old)
    u = units_of(arr)
    offsets = raw_bytes(arr)[1]
    first = np.searchsorted(u.row, np.arange(b.num_rows + 1))
    sizes = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(float))
    repeated = np.zeros(len(u.row), bool)
    numbers = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    repeated[np.repeat(first[:-1], sizes.astype(np.int64)) + numbers] = True
    gone = passages(u, repeated)
    new = old
    if gone.any():
        touched = np.zeros(b.num_rows, bool)
        touched[u.row[gone]] = True
        new = pa.array([t.decode() if cut else v.as_py() for t, cut, v in zip(
            _without(arr, u, gone), touched.tolist(), old)], old.type)
    g = np.flatnonzero(gone)
    joins = np.concatenate([[True], (u.start[g][1:] != u.end[g][:-1]) | (np.diff(u.row[g]) > 0)])[:len(g)]
    j = np.flatnonzero(joins)
    s_row = u.row[g][j]
    starts = u.start[g][j] - offsets[s_row]
    ends = u.end[g][np.append(j[1:], len(g)) - 1] - offsets[s_row] if len(g) else starts
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(s_row, np.arange(b.num_rows + 1)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(starts.astype(np.int64)), pa.array(ends.astype(np.int64))],
                                   ["start", "end"]))
    counts = pa.StructArray.from_arrays(
        [pa.array(np.diff(first).astype(np.int64)),
         pa.array(np.bincount(u.row[gone], minlength=b.num_rows).astype(np.int64)), spans],
        ["n_units", "n_removed", "spans"])
    columns = list(b.columns[:-1])
    columns[at] = new
    return pa.RecordBatch.from_arrays([*columns, counts], names=[*b.schema.names[:-1], name])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts, original byte ranges of what went, and the text left."""
    out, c = remove(docs.select("doc_id", "text"))
    spans = F.col(c)["spans"]
    return out.select(
        "doc_id", F.col(c)["n_units"].alias("n_units"), F.col(c)["n_removed"].alias("n_removed"),
        F.aggregate(spans, F.lit(0).cast("long"),
                    lambda a, x: a + x["end"] - x["start"]).alias("removed_bytes"),
        F.array_join(F.transform(spans, lambda x: F.concat_ws(
            "-", x["start"].cast("string"), x["end"].cast("string"))), ",").alias("removed_spans"),
        "text")


def deduped(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages gone and ``n_chars`` made to fit."""
    out, c = remove(docs)
    return out.select(*[
        F.when(F.col(c)["n_removed"] == 0, F.col(x)).otherwise(
            F.char_length("text").cast("long")).alias(x) if x == "n_chars" else F.col(x)
        for x in docs.columns])

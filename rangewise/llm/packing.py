"""Best-fit packing of documents into fixed-length sequences by a
configuration linear program over the length histogram.

The histogram has at most ``CAPACITY`` lengths, so the program's size does
not depend on the corpus. A configuration is a multiset of lengths that fits
a sequence. Multiplicative weights solve the covering program: each round a
bounded-knapsack dynamic program prices the lengths and gives the most
valuable configuration, it is taken as often as its scarcest length allows,
and the weights of the lengths it covers shrink. The fractional counts are
then rounded down, and the program is solved again for what stays uncovered,
at any size of table, until no packing can be better (the sequences reach the
volume bound) or rounding takes under one in ``LEAST`` of what is left. So the
solutions are at most some LEAST * ln(pieces). Best-fit decreasing (on the
histogram, so its work follows distinct sequences) places what rounding left;
``Plan.bound`` tells how few sequences any packing needs.

Spark does the per-row part: pieces are measured in one map pass, their
histogram is a ``groupBy``, each piece's rank within its length comes from a
range-partitioned sort (hot lengths span partitions; per-partition counts
are the only driver state), and a lookup in the plan turns (length, rank)
into (sequence, offset). Pieces of full length need no plan: each is its own
sequence.

Defined cases: null and empty texts hold the end id alone; rows that share
an id are separate documents, ordered by their checksum (equal ones are
interchangeable); an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangewise.llm.common import chunks, texts, written
from rangewise.llm.tokens import default_path, encoder
from rangewise.session import ship_package

#: Ids in a sequence.
CAPACITY = 2048
#: Rounds of multiplicative weights in one solution of the program.
ROUNDS = 200
#: How fast a covered length's weight falls.
RATE = 0.5
#: A solution that places under one in so many of the pieces left is the last.
LEAST = 200

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def knapsack(lengths: np.ndarray, most: np.ndarray, value: np.ndarray, capacity: int) -> np.ndarray:
    """How often to take each length (at most ``most``) for the greatest
    value within ``capacity``: dynamic program over the capacity, with each
    length split into 1, 2, 4, ... copies."""
    items: list[tuple[int, int]] = []
    for k, (n, m) in enumerate(zip(lengths.tolist(), most.tolist())):
        left, step = min(m, capacity // n), 1
        while left > 0:
            c = min(step, left)
            items.append((k, c))
            left, step = left - c, 2 * step
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(items), capacity + 1), bool)
    sizes = lengths.tolist()
    for j, (k, c) in enumerate(items):
        w = c * sizes[k]
        gain = best[:capacity + 1 - w] + c * value[k]
        better = gain > best[w:]
        taken[j, w:] = better
        np.copyto(best[w:], gain, where=better)
    out = np.zeros(len(lengths), np.int64)
    room = capacity
    for j in range(len(items) - 1, -1, -1):
        if taken[j, room]:
            k, c = items[j]
            out[k] += c
            room -= c * sizes[k]
    return out


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int,
               rounds: int = ROUNDS, rate: float = RATE) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often to take each, by multiplicative weights.
    Weights start at each length's volume; the result is scaled so that the
    volume it covers is the histogram's."""
    weight = np.ones(len(lengths))
    # a little over proportional: of full configurations, one of longer pieces
    worth = lengths * (1 + lengths / (20 * capacity))
    found: dict[bytes, list] = {}
    volume = 0.0
    most = counts
    for _ in range(rounds):
        config = knapsack(lengths, most, worth * weight, capacity)
        used = config > 0
        if not used.any():
            break
        step = float((counts[used] / config[used]).min())
        found.setdefault(config.tobytes(), [config, 0.0])[1] += step
        volume += step * float((config * lengths).sum())
        weight[used] *= np.exp(-rate * step * config[used] / counts[used])
        weight /= weight.max()
    scale = float((counts * lengths).sum()) / volume if volume else 0.0
    return [(c, x * min(scale, 1.0)) for c, x in found.values()]


def best_fit(lengths: np.ndarray, counts: np.ndarray,
             capacity: int) -> list[tuple[np.ndarray, int]]:
    """Best-fit decreasing over a histogram: (contents, how many) of the
    sequences it makes. Sequences with equal contents are handled as one, so
    the work follows the distinct ones."""
    rooms: dict[int, list[list]] = {}  # room left -> [contents, how many]
    free = np.zeros(capacity + 1, np.int64)

    def put(room: int, config: tuple, times: int) -> None:
        rooms.setdefault(room, []).append([config, times])
        free[room] += 1

    for k in np.argsort(-lengths, kind="stable").tolist():
        n, left = int(lengths[k]), int(counts[k])
        while left:
            fits = np.flatnonzero(free[n:])
            if not len(fits):
                each = capacity // n
                if left >= each:
                    put(capacity - each * n, ((k, each),), left // each)
                    left %= each
                else:
                    put(capacity - left * n, ((k, left),), 1)
                    left = 0
                continue
            room = n + int(fits[0])
            config, times = rooms[room].pop()
            free[room] -= 1
            each = min(room // n, left)
            use = min(times, left // each)
            if use < times:
                put(room, config, times - use)
            put(room - each * n, config + ((k, each),), use)
            left -= use * each
    out = []
    for kept in rooms.values():
        for config, times in kept:
            whole = np.zeros(len(lengths), np.int64)
            for k, c in config:
                whole[k] += c
            out.append((whole, times))
    return out


@dataclass
class Plan:
    """Where the r-th piece of a length goes: per length, slots in order."""

    capacity: int
    sequences: int
    bound: int  # sequences that any packing needs, by volume
    first: dict[int, np.ndarray]  # length -> first rank of each entry
    base: dict[int, np.ndarray]   # first sequence of the entry's configuration
    copies: dict[int, np.ndarray]
    place: dict[int, np.ndarray]  # offset of the length's first copy

    def at(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces of one length."""
        k = np.searchsorted(self.first[length], rank, side="right") - 1
        within = rank - self.first[length][k]
        copies = self.copies[length][k]
        return (self.base[length][k] + within // copies,
                self.place[length][k] + within % copies * length)


def solve(histogram: dict[int, int], capacity: int = CAPACITY,
          rounds: int = ROUNDS) -> Plan:
    """The packing plan of a length histogram."""
    lengths = np.array(sorted(n for n, c in histogram.items() if c and n < capacity), np.int64)
    left = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    taken: list[tuple[np.ndarray, int]] = []

    def take(config: np.ndarray, times: int) -> None:
        if times > 0:
            taken.append((config, times))
            left[:] -= config * times

    bound = -(-int((lengths * left).sum()) // capacity)
    while left.any():
        live, before = left > 0, int(left.sum())
        for config, x in sorted(fractional(lengths[live], left[live], capacity, rounds),
                                key=lambda c: -c[1]):
            whole = np.zeros(len(lengths), np.int64)
            whole[live] = config
            used = whole > 0
            take(whole, min(int(x + 1e-9), int((left[used] // whole[used]).min())))
        rest = list(best_fit(lengths, left, capacity))
        if (LEAST * (before - left.sum()) < before
                or sum(times for _, times in [*taken, *rest]) == bound):
            for config, times in rest:
                take(config, times)
            break
    return _plan(lengths, taken, capacity, bound)


def _plan(lengths: np.ndarray, taken: list[tuple[np.ndarray, int]], capacity: int, bound: int) -> Plan:
    entries: dict[int, list[tuple[int, int, int, int]]] = {n: [] for n in lengths.tolist()}
    rank = dict.fromkeys(lengths.tolist(), 0)
    sequence = 0
    for config, times in taken:
        place = 0
        for k in np.flatnonzero(config)[::-1].tolist():
            n, c = int(lengths[k]), int(config[k])
            entries[n].append((rank[n], sequence, c, place))
            rank[n] += c * times
            place += c * n
        sequence += times
    columns = {n: np.array(e, np.int64).reshape(-1, 4).T for n, e in entries.items()}
    return Plan(capacity, sequence, bound, *({n: c[j] for n, c in columns.items()} for j in range(4)))


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents (columns: ``PIECES``): a document's ids with
    the end id, cut every ``capacity`` ids."""
    vocabulary = vocabulary or default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for b in chunks(batches):
            coder = coder or encoder(vocabulary)
            ids, offsets = coder.encode(b.column("text"))
            data = memoryview(np.insert(ids, offsets[1:], end_id).astype("<u4")).cast("B")
            sizes = np.diff(offsets) + 1
            base = np.cumsum(sizes) - sizes
            n = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(sizes[row] - start, capacity)
            at = 4 * (base[row] + start)
            sums = [zlib.crc32(data[a:z]) for a, z in zip(at.tolist(), (at + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)),
                pa.array(start), pa.array(length), pa.array(sums, pa.int64())],
                names=[c.split()[0] for c in PIECES.split(", ")])

    ship_package(docs.sparkSession)
    return texts(docs, doc_id, text).mapInArrow(cut, PIECES)


_ROW = 33  # monotonically_increasing_id: partition << 33 | row


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Pieces with their sequence and offset there; sequences are gapless
    from 0. Two small tables of pieces (no texts) are written on the way."""
    spark = docs.sparkSession
    cut = written(spark, pieces(docs, doc_id, text, capacity, end_id, vocabulary), "pieces")
    ordered = written(spark, cut.repartitionByRange("length", "doc_id", "piece", "ids_crc32")
                      .sortWithinPartitions("length", "doc_id", "piece", "ids_crc32")
                      .withColumn("_row", F.monotonically_increasing_id()), "pieces-by-length")
    # one row per (partition, length); sorted, so a few per partition
    counts = sorted((r.part, r.length, r["count"]) for r in ordered.groupBy(
        F.shiftright("_row", _ROW).alias("part"), "length").count().collect())
    histogram: dict[int, int] = {}
    base: dict[int, int] = {}  # rows before each partition
    total = 0
    for part, length, n in counts:
        base.setdefault(part, total)
        histogram[length] = histogram.get(length, 0) + n
        total += n
    plan = solve(histogram, capacity)
    order = np.array(sorted(histogram), np.int64)
    sizes = np.array([histogram[n] for n in order.tolist()], np.int64)
    before = dict(zip(order.tolist(), (np.cumsum(sizes) - sizes).tolist()))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row = b.column("_row").to_numpy()
            length = b.column("length").to_numpy()
            rank = (np.array([base[p] for p in (row >> _ROW).tolist()], np.int64)
                    + (row & ((1 << _ROW) - 1)))
            sequence = np.zeros(len(row), np.int64)
            offset = np.zeros(len(row), np.int64)
            for n in np.unique(length).tolist():
                here = length == n
                r = rank[here] - before[n]
                if n == plan.capacity:
                    sequence[here] = plan.sequences + r
                else:
                    sequence[here], offset[here] = plan.at(n, r)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(sequence), pa.array(offset)],
                names=[*b.schema.names[:-1], "sequence_id", "offset"])

    return ordered.mapInArrow(assign, PIECES + ", sequence_id long, offset long")

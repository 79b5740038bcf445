"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items go into one automaton (one per block of items
when the items are many). Document words stream through it and the longest
matching length is tracked at each word; where it reaches the window (10
words, or a whole shorter item) the window's words are hit.

Only words that could matter are streamed: numpy marks neighbouring words
that are neighbours in some item, and runs of such pairs as long as the
shortest window go to the automaton. Everything else cannot hold a window.

Documents are never shuffled or joined. Items are split into blocks of at most
``BLOCK_BYTES`` of text (or one item), files in the shared folder that tasks
read, so an automaton is bounded whatever the benchmark's size and neither the
driver nor a closure holds the items. With more than ``HELD_BLOCKS`` of them a
task holds about ``GROUP_BYTES`` of documents, matches one block after the other
against them and merges the spans row by row; rows that share an id, or have
none, stay apart.

Defined cases: null or wordless texts have no words and no hits; null item
ids are left out, as are null and wordless items; the same item twice counts
once, and all texts of one id are searched; equal items under two ids both count; an empty benchmark or document
table gives no hits or no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangewise.llm.common import chunks, mapped, plain, raw_bytes, texts, words, written
from rangewise.llm.files import opened, replacing
from rangewise.session import scratch_path, ship_package

#: Words in a window.
WINDOW = 10
#: Most text bytes of items in one automaton.
BLOCK_BYTES = 1 << 20
#: Bytes of documents that a task matches against one block after the other.
GROUP_BYTES = 64 << 20
#: Automata that a process keeps built.
HELD_BLOCKS = 2

#: Lower-cases A-Z and turns every other byte that is no word byte
#: ([0-9a-z] and all of multi-byte characters) into a space.
WORD_BYTES = np.array(
    [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
     for b in range(256)], dtype=np.uint8)

_ITEMS = pa.schema([("item_id", pa.string()), ("text", pa.string())])
SPANS = "array<struct<word_start: long, word_end: long, byte_start: long, byte_end: long>>"
SCHEMA = f"doc_id long, n_words long, spans {SPANS}, items array<string>"


class Automaton:
    """Generalised suffix automaton over sequences of word codes."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = [(item, codes, self._insert(codes)) for item, codes in items]
        self.items: list[set[str]] = [set() for _ in self.link]
        self.whole: dict[int, dict[int, set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, codes, end in ends:
            state = 0
            for c in codes:
                state = self.next[state][c]
                self.items[state].add(item)
            if len(codes) < window:
                self.whole[end][len(codes)].add(item)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.length[self.link[s]] >= window:  # shorter ones are never asked
                self.items[self.link[s]] |= self.items[s]

    def _insert(self, codes: list[int]) -> int:
        last = 0
        for c in codes:
            last = self._step(last, c)
        state = 0  # the state that holds the whole sequence, after all splits
        for c in codes:
            state = self.next[state][c]
        return state

    def _state(self, length: int, link: int, nxt: dict[int, int]) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, c: int) -> int:
        """The state of p's longest string and c, made if c leads further."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _step(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, c)
        return new

    def stream(self, codes: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(last word, words, items) of each window that ends in ``codes``."""
        state = matched = 0
        for at, c in enumerate(codes):
            while state and c not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if c not in self.next[state]:
                continue
            state = self.next[state][c]
            matched += 1
            s = state
            while self.length[self.link[s]] >= self.window:
                s = self.link[s]
            if matched >= self.window:
                yield at, self.window, self.items[s]
            while self.whole and s > 0:
                for n, found in self.whole.get(s, {}).items():
                    if n <= matched:
                        yield at, n, found
                s = self.link[s]


class Matcher:
    """The automaton of one block, with the tables that choose what to stream."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        codes, offsets, vocab = words(mapped(plain(pa.array([t for _, t in items], pa.string())),
                                             WORD_BYTES))
        by_item = [(i, codes[s:e].tolist()) for (i, _), s, e in zip(items, offsets, offsets[1:])
                   if e > s]
        self.vocab = vocab
        self.least = min((min(len(c), window) for _, c in by_item), default=window)
        inside = np.ones(max(len(codes) - 1, 0), bool)
        inside[offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(codes))] - 1] = False
        self.base = len(vocab) + 1
        self.pairs = np.unique(codes[:-1][inside] * self.base + codes[1:][inside])
        self.automaton = Automaton(by_item, window)

    def _runs(self, codes: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """[start, end) of runs of known word pairs, as long as a window."""
        n = len(codes)
        if not n or not len(self.vocab):
            return []
        joined = (codes[:-1] >= 0) & (codes[1:] >= 0)
        cut = offsets[1:-1]
        joined[cut[(cut > 0) & (cut < n)] - 1] = False
        at = np.flatnonzero(joined)
        key = codes[at] * self.base + codes[at + 1]
        place = np.searchsorted(self.pairs, key)
        hit = np.zeros(len(at), bool)
        inside = place < len(self.pairs)
        hit[inside] = self.pairs[place[inside]] == key[inside]
        joined[at[~hit]] = False
        edge = np.flatnonzero(~joined)
        starts = np.concatenate([[0], edge + 1])
        ends = np.concatenate([edge + 1, [n]])
        long = (ends - starts >= self.least) & (codes[starts] >= 0)
        return list(zip(starts[long].tolist(), ends[long].tolist()))

    def find(self, arr: pa.Array):
        """(document in the array, merged word spans, items) of each document
        with a hit, and the words of every document."""
        codes, offsets, vocab = words(arr)
        known = pc.fill_null(pc.index_in(vocab, value_set=self.vocab.cast(vocab.type)), -1)
        codes = known.to_numpy(zero_copy_only=False).astype(np.int64)[codes]
        found: dict[int, tuple[list, set]] = {}
        for s, e in self._runs(codes, offsets):
            for last, n, items in self.automaton.stream(codes[s:e].tolist()):
                doc = int(np.searchsorted(offsets, s, side="right")) - 1
                spans, seen = found.setdefault(doc, ([], set()))
                spans.append((s + last + 1 - n - int(offsets[doc]), s + last + 1 - int(offsets[doc])))
                seen |= items
        return np.diff(offsets), {d: (merged(s), i) for d, (s, i) in found.items()}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of [start, end) spans."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _word_edges(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of one mapped text."""
    inside = np.concatenate([[False], text != 32, [False]])
    return np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> list[str]:
    """Files of at most ``block_bytes`` of items (or one item) in the shared
    folder; only their names reach the driver and the tasks' closures."""
    spark = benchmark.sparkSession
    folder = scratch_path(spark, "llm-benchmark")
    items = (benchmark.select(F.col(item_id).cast("string").alias("item_id"),
                              F.col(text).alias("text"))
             .dropna().dropDuplicates(["item_id", "text"]))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        held: list[dict] = []
        size = 0

        def block() -> pa.RecordBatch:
            path = f"{folder}/part-{part:06d}-{k:06d}.arrow"
            with replacing(path) as out, pa.ipc.new_stream(out, _ITEMS) as w:
                w.write_batch(pa.RecordBatch.from_pylist(held, _ITEMS))
            return pa.RecordBatch.from_pydict({"path": [path]})

        for b in batches:
            for item in b.to_pylist():
                n = len(item["text"].encode())
                if held and size + n > block_bytes:
                    yield block()
                    held, size, k = [], 0, k + 1
                held.append(item)
                size += n
        if held:
            yield block()

    # in few blocks where the items are few, each near its full size
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = items.repartition(max(1, -(-total // (4 * block_bytes)))).sortWithinPartitions("item_id", "text")
    return sorted(r.path for r in written(spark, dealt.mapInArrow(put, "path string"), "benchmark-blocks").collect())


@lru_cache(maxsize=HELD_BLOCKS)
def _matcher(path: str | None, window: int) -> Matcher:
    """The automaton of a block's items, kept by a process for the next use."""
    if path is None:
        return Matcher([], window)
    with opened(path) as source, pa.ipc.open_stream(source) as r:
        t = r.read_all()
    return Matcher(list(zip(t.column("item_id").to_pylist(), t.column("text").to_pylist())), window)


def _matched(batches: Iterator[pa.RecordBatch], blocks: list[str], window: int):
    """(batch, its mapped texts, words of every row, spans and items of each
    row with a hit)."""
    few = len(blocks) <= HELD_BLOCKS  # all stay built: no need to hold documents

    def settled(held: list[pa.RecordBatch]):
        out = [[b, mapped(plain(b.column("text")), WORD_BYTES), None, {}] for b in held]
        for path in blocks or [None]:
            matcher = _matcher(path, window)
            for row in out:
                row[2], found = matcher.find(row[1])
                for d, (spans, seen) in found.items():
                    before, known = row[3].get(d, ([], set()))
                    row[3][d] = merged(before + spans), known | seen
        return out

    held: list[pa.RecordBatch] = []
    size = 0
    for b in chunks(batches):
        held.append(b)
        size += b.nbytes
        if few or size >= GROUP_BYTES:
            yield from settled(held)
            held, size = [], 0
    if held:
        yield from settled(held)


def _byte_spans(arr: pa.Array, found: dict) -> dict[int, list[tuple[int, int]]]:
    """Byte spans of the word spans of each row with a hit."""
    data, offsets = raw_bytes(arr)
    out = {}
    for d, (spans, _) in found.items():
        first, last = _word_edges(data[offsets[d]:offsets[d + 1]])
        out[d] = [(int(first[s]), int(last[e - 1])) for s, e in spans]
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: its words, the merged hit spans (in words and in
    bytes of the text) and the items found (columns: ``SCHEMA``)."""
    ship_package(docs.sparkSession)
    blocks = _blocks(benchmark, item_id, item_text, block_bytes)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, arr, n_words, found in _matched(batches, blocks, window):
            places = _byte_spans(arr, found)
            spans = [[{"word_start": s, "word_end": e, "byte_start": x, "byte_end": y}
                      for (s, e), (x, y) in zip(found[d][0], places[d])] if d in found else []
                     for d in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(n_words),
                pa.array(spans, pa.list_(pa.struct([(k, pa.int64()) for k in (
                    "word_start", "word_end", "byte_start", "byte_end")]))),
                pa.array([sorted(found[d][1]) if d in found else []
                          for d in range(b.num_rows)], pa.list_(pa.string())),
            ], names=["doc_id", "n_words", "spans", "items"])

    return texts(docs, doc_id, text).mapInArrow(match, SCHEMA)


def cleaned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the hit spans cut out of ``text`` in the pass that finds
    them, and ``n_chars`` made to fit; rows without a hit are returned as they
    are, and a row whose every word was hit is dropped."""
    ship_package(docs.sparkSession)
    blocks = _blocks(benchmark, "item_id", "text", block_bytes)
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, arr, n_words, found in _matched(batches, blocks, window):
            keep = np.ones(b.num_rows, bool)
            new, sizes = b.column(at).to_pylist(), {}
            for d, spans in _byte_spans(arr, found).items():
                keep[d] = sum(e - s for s, e in found[d][0]) < n_words[d]
                raw, end, left = new[d].encode(), 0, []
                for s, e in spans:
                    left.append(raw[end:s])
                    end = e
                new[d] = b"".join([*left, raw[end:]]).decode()
                sizes[d] = len(new[d])
            columns = list(b.columns)
            columns[at] = pa.array(new, b.schema.field(at).type)
            if chars is not None and sizes:
                columns[chars] = pa.array([sizes.get(d, n) for d, n in enumerate(
                    b.column(chars).to_pylist())], b.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names).filter(pa.array(keep))

    return docs.mapInArrow(cut, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``decontaminate``'s rows."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"),
                        lambda a, x: a + x["word_end"] - x["word_start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))

"""Grouping of spelling variants: words one edit apart, found by the distance
of their letter counts.

A corpus pass counts words (maximal letter runs, A-Z in lower case), in numpy
over each batch's distinct runs. Contract detail: a run whose checksum with its
document's id is a multiple of ``EDIT_EVERY`` loses one letter first. Checksums
of ``id:run`` are joined from those of the id and of the run (CRC is linear),
so no string is built per word.

Two words one edit apart have letter counts at a squared distance of 1 (a letter
more) or 2 (a letter replaced). Words are dealt into blocks by how many letters
they have of each of ``CLASSES`` letter classes; together these give the length, so
blocks refine length blocks. One edit leaves a word in its block or takes it to
one where a class has one letter more or one letter moved class: each unordered
pair of such blocks meets once. For a pair of blocks, a NumPy product of their
letter-count matrices (the Gram matrix) gives all squared distances; pairs at
most two apart are kept and verified letter by letter.

Shape of the job: blocks above ``TILE`` words are divided into tiles by a hash of
the word, and tiles meet tiles, so a group is two tiles whatever a block holds.
Which blocks exist, and how many tiles they have, comes from a join with their
counts. Only verified pairs leave a task. Nothing is collected but the largest
count, which bounds the rounds that follow forms to their root (each step is
at least ``FORM_TIMES`` times as frequent, so they double up fast).

Defined cases: null and empty texts have no words; a null id counts as an
empty one in the checksum; repeated rows count as often as they stand; a run or word
of any length is taken whole; among equally frequent near words the least in
code-point order is the form; an empty table gives no rows; other columns never
enter the operator.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangewise.llm.common import LOWER, chunks, plain, raw_bytes, texts, words, written
from rangewise.session import ship_package

#: Least code points of a word, and least occurrences.
LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A run loses a letter if this divides its checksum.
EDIT_EVERY = 199
#: A form is at least so many times as frequent as its variant.
FORM_TIMES = 5
#: Letter classes that blocks are made of: code point modulo this.
CLASSES = 5
#: Words of one side of a group.
TILE = 1024
#: Words up to this length are verified in numpy, longer ones one by one.
SHORT = 48

LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))

# -- counts ---------------------------------------------------------------------

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF


def runs(arr: pa.Array) -> pa.Array:
    """Texts with A-Z in lower case and a space for all that is no letter."""
    data, offsets = raw_bytes(arr)
    if not len(data):
        return arr
    wide = data == _LEAD
    keep = _LETTER[data] | wide
    keep[1:] |= wide[:-1]
    return pa.LargeStringArray.from_buffers(
        len(arr), pa.py_buffer(np.ascontiguousarray(offsets)),
        pa.py_buffer(np.where(keep, LOWER[data], np.uint8(32))))


class _Zeros:
    """What n zero bytes do to a CRC-32, as a linear map."""

    def __init__(self):
        basis = (np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None])
        one = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            one = np.where(one & 1, one >> 1 ^ np.uint32(0xEDB88320), one >> 1)
        self.maps = [(basis >> np.uint32(8)) ^ one[basis & 0xFF]]

    @staticmethod
    def _apply(m: np.ndarray, x: np.ndarray) -> np.ndarray:
        return m[0][x & 0xFF] ^ m[1][x >> 8 & 0xFF] ^ m[2][x >> 16 & 0xFF] ^ m[3][x >> 24]

    def after(self, x: np.ndarray, n: int) -> np.ndarray:
        """``x`` followed by n zero bytes."""
        for k in range(n.bit_length()):
            while k >= len(self.maps):
                self.maps.append(self._apply(self.maps[-1], self.maps[-1]))
            if n >> k & 1:
                x = self._apply(self.maps[k], x)
        return x


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           edit_every: int | None = EDIT_EVERY, least_letters: int = LEAST_LETTERS,
           least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: words of the whole corpus. ``edit_every=None`` edits nothing."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zeros = _Zeros()
        for b in chunks(batches):
            codes, offsets, vocab = words(plain(runs(plain(b.column("text")))))
            found = vocab.to_pylist()
            letters = np.fromiter(map(len, found), np.int64, len(found))
            edited: list[str] = []
            if edit_every and len(found):
                raw = [w.encode() for w in found]
                own = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw))
                sizes, which = np.unique(np.fromiter(map(len, raw), np.int64, len(raw)),
                                         return_inverse=True)
                ids = ["" if i is None else str(i) for i in b.column("doc_id").to_pylist()]
                head = np.fromiter((zlib.crc32(f"{i}:".encode()) for i in ids), np.uint32, len(ids))
                moved = np.stack([zeros.after(head, int(s)) for s in sizes])
                doc = np.repeat(np.arange(len(ids)), np.diff(offsets))
                h = moved[which[codes], doc] ^ own[codes]
                hit = h % np.uint32(edit_every) == 0
                for c, x in zip(codes[hit].tolist(), h[hit].tolist()):
                    k = x % len(found[c])
                    edited.append(found[c][:k] + found[c][k + 1:])
                codes = codes[~hit]
            n = np.bincount(codes, minlength=len(found))
            at = np.flatnonzero((n > 0) & (letters >= least_letters))
            edited = [w for w in edited if len(w) >= least_letters]
            yield pa.RecordBatch.from_arrays(
                [pa.array([found[i] for i in at.tolist()] + edited, pa.string()),
                 pa.array(np.concatenate([n[at], np.ones(len(edited), np.int64)]))], names=["word", "n"])

    ship_package(docs.sparkSession)
    return (texts(docs, doc_id, text).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


# -- pairs ----------------------------------------------------------------------

def steps() -> list[tuple[int, ...]]:
    """What one edit adds to a block's class counts, one of each direction:
    nothing, a letter of a class, or a letter of one class for another's."""
    def unit(*at: tuple[int, int]) -> tuple[int, ...]:
        return tuple(sum(v for k, v in at if k == c) for c in range(CLASSES))
    return ([unit()] + [unit((c, 1)) for c in range(CLASSES)]
            + [unit((c, 1), (d, -1)) for c in range(CLASSES) for d in range(c + 1, CLASSES)])


def block(word: str) -> Column:
    """Letters of each class."""
    w = F.col(word)
    return F.array(*[F.length(w) - F.length(F.translate(w, "".join(
        x for x in LETTERS if ord(x) % CLASSES == c), "")) for c in range(CLASSES)])


def meetings(found: DataFrame, tile: int = TILE) -> DataFrame:
    """``found`` (word, n) dealt to groups: a row per word and group, with the
    side it is on. A group is (first block, step, tile of each side)."""
    placed = found.withColumn("block", block("word"))
    sizes = placed.groupBy("block").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    placed = placed.join(sizes, "block").withColumn(
        "tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    options = []
    for k, d in enumerate(steps()):
        for side in (0, 1):
            sign = -1 if side else 1
            options.append(F.struct(
                F.lit(k).alias("step"), F.lit(side).alias("side"),
                F.array(*[F.col("block")[c] + sign * d[c] for c in range(CLASSES)]).alias("other")))
    dealt = (placed.select("word", "n", "block", "tile", F.explode(F.array(*options)).alias("o"))
             .select("word", "n", "block", "tile", "o.*")
             .join(sizes.select(F.col("block").alias("other"), F.col("tiles").alias("there")), "other"))
    dealt = dealt.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("there") - 1)))
    # within a block, a pair of tiles meets once: the first side has the lower tile
    dealt = dealt.where((F.col("step") > 0)
                        | F.when(F.col("side") == 0, F.col("tile") <= F.col("partner"))
                        .otherwise(F.col("partner") < F.col("tile")))
    first = F.col("side") == 0
    return dealt.select(
        F.concat_ws(":", F.concat_ws(",", F.when(first, F.col("block")).otherwise(F.col("other"))), "step",
                    F.when(first, F.col("tile")).otherwise(F.col("partner")),
                    F.when(first, F.col("partner")).otherwise(F.col("tile"))).alias("meet"),
        "side", "word", "n")


def _letter_counts(found: list[str]) -> np.ndarray:
    """Occurrences of each letter, a row per word; float32 where exact."""
    flat = np.frombuffer("".join(found).encode("latin-1"), np.uint8).astype(np.int64)
    letter = np.where(flat < 0x80, flat - 0x61, flat - 0xC0 + 26)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    row = np.repeat(np.arange(len(found)), sizes)
    out = np.bincount(row * len(LETTERS) + letter, minlength=len(found) * len(LETTERS))
    exact = np.float32 if sizes.max(initial=0) < 2048 else np.float64
    return out.reshape(len(found), len(LETTERS)).astype(exact)


def _one_edit(a: str, b: str) -> bool:
    """True if exactly one letter is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def _verified(a: list[str], b: list[str]) -> np.ndarray:
    """``_one_edit`` for words paired by position, lengths at most one apart."""
    la, lb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    out = np.zeros(len(a), bool)
    long = np.maximum(la, lb) > SHORT
    for i in np.flatnonzero(long).tolist():
        out[i] = _one_edit(a[i], b[i])
    at = np.flatnonzero(~long)
    if not len(at):
        return out
    swap = la[at] > lb[at]
    small, large = ([y if s else x for x, y, s in zip((p[i] for i in at), (q[i] for i in at), swap)]
                    for p, q in ((a, b), (b, a)))
    width = SHORT + 1

    def letters(x: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(w.encode("latin-1").ljust(width, b"\0") for w in x),
                             np.uint8).reshape(len(x), width)
    s, l = letters(small), letters(large)
    n = np.minimum(la[at], lb[at])
    differ = s != l
    replaced = differ.sum(axis=1) == 1
    head = np.argmax(differ, axis=1)  # a longer word differs at its end at least
    inside = np.arange(width - 1) < n[:, None]
    wrong = (s[:, :-1] != l[:, 1:]) & inside & (np.arange(width - 1) >= head[:, None])
    out[at] = np.where(la[at] == lb[at], replaced, ~wrong.any(axis=1))
    return out


def _near(left: list[str], right: list[str] | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of near pairs of two sides (of one, if ``right`` is None)."""
    a = _letter_counts(left)
    b = a if right is None else _letter_counts(right)
    gram = a @ b.T
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * gram
    close = (d <= 2) & (d > 0)  # equal counts: never one edit apart
    if right is None:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    ok = _verified([left[x] for x in i.tolist()], [(left if right is None else right)[x] for x in j.tolist()])
    return i[ok], j[ok]


def pairs(found: DataFrame, tile: int = TILE) -> DataFrame:
    """word, n, other, other_n: every two near words, in both directions."""

    def near_in(key: str, sides: tuple[list, list]) -> list[tuple]:
        _, step, i, j = key.split(":")
        left, right = sides
        alone = step == "0" and i == j  # a tile with itself
        if not left or not (alone or right):
            return []
        x, y = _near([w for w, _ in left], None if alone else [w for w, _ in right])
        other = left if alone else right
        found = [(left[p], other[q]) for p, q in zip(x.tolist(), y.tolist())]
        return [(*p, *q) for p, q in found] + [(*q, *p) for p, q in found]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides, out = None, ([], []), []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [(), (), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()) * 2)],
                names=["word", "n", "other", "other_n"])

        for b in batches:
            for meet, side, w, n in zip(*(b.column(c).to_pylist() for c in ("meet", "side", "word", "n"))):
                if meet != key:
                    if key is not None:
                        out += near_in(key, sides)
                    key, sides = meet, ([], [])
                sides[side].append((w, n))
            yield flush()
        if key is not None:
            out += near_in(key, sides)
            yield flush()

    ship_package(found.sparkSession)
    return (meetings(found, tile).repartition("meet").sortWithinPartitions("meet")
            .mapInArrow(find, "word string, n long, other string, other_n long"))


# -- forms ----------------------------------------------------------------------

def roots(forms: DataFrame, largest: int) -> DataFrame:
    """word, root: from (word, form), forms followed to the last. A step
    multiplies the count by ``FORM_TIMES``, which bounds the steps by the
    ``largest`` count; each round doubles the steps taken."""
    most = max(1, math.ceil(math.log(max(largest, FORM_TIMES), FORM_TIMES)))
    out = forms.select("word", F.col("form").alias("root"))
    for _ in range(most.bit_length()):
        out = written(forms.sparkSession, out, "spelling-roots")
        on = out.select(F.col("word").alias("root"), F.col("root").alias("further"))
        out = out.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return out


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tile: int = TILE,
             **options) -> DataFrame:
    """word, form, root, n, n_near, form_n (see the module)."""
    spark = docs.sparkSession
    found = written(spark, counts(docs, doc_id, text, **options), "spelling-words")
    near = (pairs(found, tile).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("other_n"), "other")).alias("most")))
    most = F.col("most")
    enough = -most["col1"] >= FORM_TIMES * F.col("n")
    out = found.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, most["other"]).alias("form"), F.when(enough, -most["col1"]).alias("form_n"))
    out = written(spark, out, "spelling-forms")
    largest = found.agg(F.max("n")).first()[0] or 1
    followed = roots(out.where(F.col("form").isNotNull()), largest)
    return out.join(followed, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""MinHash near-dedup: one-permutation hashing with optimal densification,
banded buckets, star-shaped candidate edges, links confirmed on full sets.

1. A map pass makes each text's set of distinct 5-word shingles (64-bit
   hashes), its signature of ``BINS`` bins from one permutation (an empty bin
   copies the first filled bin of its own fixed random probe order), the
   signature's bands, a one-bit sketch, and a digest of the whole set.
2. Equal sets are one class (a map-side combined ``min``), represented by the
   least id; only representatives go on. Copies cost no pair.
3. Members of a bucket (band, value) are joined to its least id, the hub: a
   bucket of n gives n - 1 edges, never n^2.
4. Edges that size or sketch rule out are dropped; the others are confirmed
   by intersecting the full sets of both texts.
5. A bucket whose members are then not all connected is not finished: its
   members outside its largest component are compared with all its members,
   in bounded tiles that intersect full sets as bit sets and return only the
   components they join. So bounding the stars loses no link between
   documents that share a bucket, and no pairs are emitted for it.

Joins on a bucket, a hub or a set are salted by the rows counted for it, so a
hot one spans tasks. Components are least ids, found by alternating large-
and small-star steps on edge tables in the shared folder. Only counts reach
the driver.

A pair of similarity s shares a bucket with probability
1 - (1 - s^4)^40: over 0.9999997 at 0.75 and rising.

Defined cases: null, empty and wordless texts have no shingles and stand
alone; a text of one to four words is one shingle; rows that share an id are
one document if their texts' sets are equal, and else are linked as that
id's; an empty table gives no rows; extra columns are not read. Ids are
expected not to be null (a null id's rows stand alone).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangewise.llm.common import (
    LOWER,
    chunks,
    mapped,
    mix,
    plain,
    shingle_hashes,
    texts,
    word_hashes,
    words,
    written,
)
from rangewise.operators.joins import salted_by_count
from rangewise.session import ship_package

SHINGLE = 5
#: Least similarity, in percent.
PERCENT = 75
#: Signature: bands of rows.
BANDS, ROWS = 40, 4
BINS = BANDS * ROWS
#: Sets of this many shingles or more are compared by sketch first, and may
#: differ in so many of the sketch's ``BINS`` bits (a similarity of 0.75 gives 20 on
#: average; 52 is over five standard deviations more).
SKETCH_FROM, SKETCH_BITS = 128, 52
#: Rows of a join key above which it is salted, without and with texts; more
#: where there would be more hot keys than so many.
SALT_ROWS, SALT_TEXTS, HOT_KEYS = 50_000, 2_000, 1_000_000
#: Most rows (expected) and columns of a tile.
TILE_ROWS, TILE_COLUMNS = 512, 2048

SIGNED = ("doc_id long, n_shingles long, set_key binary, "
          "s0 long, s1 long, s2 long, bands array<long>")


def shingle_sets(arr: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    codes, offsets, vocab = words(mapped(plain(arr), LOWER))
    h = word_hashes(vocab)[codes]
    all_windows = shingle_hashes(h, size)
    out = []
    for s, e in zip(offsets.tolist(), offsets[1:].tolist()):
        if e - s >= size:
            out.append(np.unique(all_windows[s:e - size + 1]))
        elif e > s:
            out.append(mix(shingle_hashes(h[s:e], e - s) + np.uint64(e - s)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values per non-empty set."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    place = ((flat >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    cell = row * bins + place  # does not fall, as sets are sorted
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    out = np.zeros((len(sets), bins), np.uint64)
    filled = np.zeros((len(sets), bins), bool)
    out.ravel()[cell[first]] = flat[first]
    filled.ravel()[cell[first]] = True
    own = out.copy()
    rows, empty = np.nonzero(~filled)
    attempt = 0
    while len(rows):
        attempt += 1
        probe = (mix(np.arange(bins, dtype=np.uint64) + np.uint64(attempt << 20))
                 % np.uint64(bins)).astype(np.int64)[empty]
        hit = filled[rows, probe]
        out[rows[hit], empty[hit]] = own[rows[hit], probe[hit]]
        rows, empty = rows[~hit], empty[~hit]
    return out


def _signed(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    n = len(sets)
    some = [k for k, x in enumerate(sets) if len(x)]
    sketch = np.zeros((n, 3), np.int64)
    bands = np.zeros((len(some), BANDS), np.uint64)
    if some:
        values = signatures([sets[k] for k in some])
        bits = np.zeros((len(some), 192), np.uint8)
        bits[:, :BINS] = mix(values) & np.uint64(1)
        sketch[some] = np.packbits(bits, axis=1).view("<i8")
        with np.errstate(over="ignore"):
            bands += np.arange(1, BANDS + 1, dtype=np.uint64)
            for j in range(ROWS):
                bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + values[:, j::ROWS])
    sizes = np.zeros(n + 1, np.int64)
    sizes[1:][some] = BANDS
    keys = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
    return pa.RecordBatch.from_arrays([
        ids, pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.binary()),
        *(pa.array(np.ascontiguousarray(sketch[:, j])) for j in range(3)),
        pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)),
                                 pa.array(bands.ravel().view(np.int64)))],
        names=[c.split()[0] for c in SIGNED.split(", ")])


def signed(docs: DataFrame, rows: int = 4096) -> DataFrame:
    """Set size, set digest, sketch and bands of each (doc_id, text) row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            for s in range(0, b.num_rows, rows):
                part = b.slice(s, rows)
                yield _signed(part.column("doc_id"), shingle_sets(part.column("text")))

    ship_package(docs.sparkSession)
    return docs.mapInArrow(sign, SIGNED)


def _salted(big: DataFrame, small: DataFrame, key: str, by: Column, least: int,
            more: DataFrame | None = None) -> DataFrame:
    """``big`` joined with ``small``, a written table with a row per key that
    counts the key's rows in ``big`` as ``times``, and with ``more``."""
    total = small.agg(F.sum("times")).first()[0] or 0
    dealt, spread = salted_by_count(big, small, [key], "times", by, max(least, total // HOT_KEYS))
    if more is not None:
        spread = spread.join(more, key)
    return dealt.join(spread, [key, "salt"]).drop("salt", "times")


def _confirmed(pairs: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. Pairs that set
    sizes or sketches rule out are dropped before sets are made."""
    a, b = (bodies.select(*[F.col(c).alias(k if c == "id" else f"{c}_{k}") for c in bodies.columns])
            for k in "ab")
    hubs = written(pairs.sparkSession, pairs.groupBy("a").agg(F.count("*").alias("times")), "hubs")
    pairs = _salted(pairs.join(b, "b"), hubs, "a", F.xxhash64("b"), SALT_TEXTS, a)
    differ = sum((F.bit_count(F.col(f"s{j}_a").bitwiseXOR(F.col(f"s{j}_b"))) for j in range(3)), F.lit(0))
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    both = pairs.where((100 * small >= percent * large)
                       & ((small < SKETCH_FROM) | (differ <= SKETCH_BITS)))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, np.ndarray] | None = None  # hubs come in runs
        for big in batches:
            for s in range(0, big.num_rows, 512):
                b = big.slice(s, 512)
                a_ids = b.column("a").to_pylist()
                fresh = [k for k in range(len(a_ids))
                         if a_ids[k] != (a_ids[k - 1] if k else last and last[0])]
                of_a = iter(shingle_sets(b.column("text_a").take(pa.array(fresh, pa.int64()))))
                keep = []
                starts = set(fresh)
                for k, y in enumerate(shingle_sets(b.column("text_b"))):
                    if k in starts:
                        last = (a_ids[k], next(of_a))
                    x = last[1]
                    common = len(x) + len(y) - len(np.union1d(x, y))
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
                yield b.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def _is_forest(edges: DataFrame) -> bool:
    """Whether each u has one v and no v is a u: then stars are components."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("child")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("child")))
    return not (ends.groupBy("x").agg(F.sum("child").alias("parents"), F.count("*").alias("n"))
                .where("parents > 1 or (parents = 1 and n > 1)").take(1))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in the edges (a, b): the least id that can
    be reached. Alternates large-star and small-star until stars are left."""
    spark = edges.sparkSession
    now = written(spark, edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _is_forest(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(spark, small.unionByName(least.select("u", F.col("m").alias("v")))
                      .where("u <> v").distinct(), "star")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _unfinished(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, id, component, minor, n_minor, n) of buckets with members apart.
    ``minor``: not of the bucket's largest component."""
    now = shared.join(labels, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component"))
    each = now.groupBy("key", "component").count()
    sizes = (each.groupBy("key").agg(
        F.max_by("component", F.struct("count", "component")).alias("major"),
        F.max("count").alias("most"), F.sum("count").alias("n"))
        .where("most < n and n > 2"))
    return now.join(sizes, "key").select(
        "key", "id", "component", (F.col("component") != F.col("major")).alias("minor"),
        (F.col("n") - F.col("most")).alias("n_minor"), "n")


def _tiles(rest: DataFrame) -> DataFrame:
    """Members dealt to tiles of their bucket: tile (i, j) holds block i of
    the minor members as rows and block j of all members as columns, so a
    tile is bounded and each pair with a minor member is in one tile."""
    def block(n, size: int, salt: int):
        count = F.ceil(F.col(n) / size)
        return count, F.pmod(F.xxhash64("id", F.lit(salt)), count)

    (n_rows, row), (n_columns, column) = block("n_minor", TILE_ROWS, 1), block("n", TILE_COLUMNS, 2)
    up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    base = ["key", "id", "component"]
    return (rest.select(*base, up_to(n_rows).alias("i"), column.alias("j"), F.lit(False).alias("row"))
            .unionByName(rest.where("minor").select(
                *base, row.alias("i"), up_to(n_columns).alias("j"), F.lit(True).alias("row"))))


def similar_pairs(rows: list[np.ndarray], columns: list[np.ndarray],
                  percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of sets that are similar enough, by intersecting bit
    sets over the shingles that two or more of the sets hold."""
    sets = rows + columns
    sizes = np.array([len(x) for x in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    useful = times > 1
    number = np.cumsum(useful) - 1
    keep = useful[place]
    owner, place = owner[keep], number[place[keep]]
    total = int(useful.sum())
    common = np.zeros((len(rows), len(columns)), np.int64)
    width = max(64, (32 << 20) // max(len(sets), 1) // 64 * 64)
    for s in range(0, total, width):
        here = (place >= s) & (place < s + width)
        n = min(width, total - s)
        flags = np.zeros((len(sets), -(-n // 64) * 64), bool)
        flags[owner[here], place[here] - s] = True
        bits = np.packbits(flags, axis=1).view(np.uint64)
        del flags
        for r in range(len(rows)):
            common[r] += np.bitwise_count(bits[len(rows):] & bits[r]).sum(axis=1, dtype=np.int64)
    both = sizes[:len(rows), None] + sizes[None, len(rows):]
    return np.nonzero(100 * common >= percent * (both - common))


def _joined(ids: list[int], parts: list[int], is_row: list[bool], sets: list[np.ndarray],
            percent: int) -> list[tuple[int, int]]:
    """Pairs of components of a tile that a link joins, none twice over."""
    rows = [k for k, r in enumerate(is_row) if r]
    columns = [k for k, r in enumerate(is_row) if not r]
    if not rows or not columns:
        return []
    found: list[tuple[int, int]] = []
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    r, c = similar_pairs([sets[k] for k in rows], [sets[k] for k in columns], percent)
    for x, y in zip(r.tolist(), c.tolist()):
        a, b = parts[rows[x]], parts[columns[y]]
        if a != b and top(a) != top(b):
            root[top(a)] = top(b)
            found.append((a, b))
    return found


def _tile_links(tiles: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    """(a, b): components that links of a tile join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [], [])
        out: list[tuple[int, int]] = []
        for big in batches:
            for s in range(0, big.num_rows, 2048):
                b = big.slice(s, 2048)
                sets = shingle_sets(b.column("text"))
                columns = [b.column(c).to_pylist() for c in ("key", "i", "j", "id", "component", "row")]
                for k, (key, i, j, *values) in enumerate(zip(*columns)):
                    if (key, i, j) != now:
                        out += _joined(*held, percent)
                        now, held = (key, i, j), ([], [], [], [])
                    for x, v in zip(held, (*values, sets[k])):
                        x.append(v)
        out += _joined(*held, percent)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)],
                                         names=["a", "b"])

    dealt = (tiles.join(bodies, "id").repartition("key", "i", "j")
             .sortWithinPartitions("key", "i", "j"))
    return dealt.select("key", "i", "j", "id", "component", "row", "text").mapInArrow(run, "a long, b long")


def linked(reps: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, component) of representatives that are linked. ``reps``: signed
    rows; ``docs``: (doc_id, text)."""
    spark = docs.sparkSession
    bands = reps.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    hubs = written(spark, bands.groupBy("key").agg(
        F.min("id").alias("hub"), F.max("id").alias("other"), F.count("*").alias("times"))
        .where("hub <> other").select("key", "hub", "times"), "band-hubs")
    shared = written(spark, _salted(bands, hubs, "key", F.xxhash64("id"), SALT_ROWS)
                     .select("key", "id", "hub"), "buckets")
    star = shared.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    met = shared.select("id").distinct()
    known = reps.join(met, F.col("doc_id") == F.col("id"), "left_semi").select(
        F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "s0", "s1", "s2")
    bodies = written(spark, docs.join(known, F.col("doc_id") == F.col("id"))
                     .select("id", "text", "n", "s0", "s1", "s2").dropDuplicates(["id"]), "bodies")
    labels = components(_confirmed(star, bodies, percent))
    rest = written(spark, _unfinished(shared.select("key", "id"), labels), "apart")
    more = written(spark, _tile_links(_tiles(rest), bodies.select("id", "text"), percent), "tile-links")
    if not more.take(1):
        return labels
    again = components(more).toDF("component", "joined")
    every = labels.unionByName(  # representatives that only a tile linked
        more.select(F.col("a").alias("id")).unionByName(more.select(F.col("b").alias("id")))
        .distinct().join(labels, "id", "left_anti").select("id", F.col("id").alias("component")))
    return written(spark, every.join(again, "component", "left").select(
        "id", F.coalesce("joined", "component").alias("component")), "joined")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    spark = docs.sparkSession
    docs = texts(docs, doc_id, text)
    sig = written(spark, signed(docs), "signed")
    classes = (sig.where("n_shingles > 0 and doc_id is not null").groupBy("set_key")
               .agg(F.min("doc_id").alias("rep"), F.count("*").alias("times")))
    reps = sig.join(classes.select(F.col("rep").alias("doc_id"), "set_key"), ["doc_id", "set_key"],
                    "left_semi").dropDuplicates(["doc_id", "set_key"])
    labels = linked(reps, docs, percent).withColumnRenamed("id", "rep")
    named = classes.join(labels, "rep", "left").select(
        "set_key", "times", F.coalesce("component", "rep").alias("component"))
    rows = sig.select("doc_id", "n_shingles", "set_key")
    placed = "set_key is not null and doc_id is not null"
    alone = rows.where(~F.expr(placed)).withColumn("component", F.lit(None).cast("long"))
    return (_salted(rows.where(placed), written(spark, named, "named"), "set_key",
                    F.xxhash64("doc_id", F.monotonically_increasing_id()), SALT_ROWS)
            .select(*alone.columns).unionByName(alone)
            .select("doc_id", "n_shingles",
                    F.coalesce("component", "doc_id").alias("component_id"),
                    F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept")))

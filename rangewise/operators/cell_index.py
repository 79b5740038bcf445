"""Adaptive cell index of range polygons for a spatially partitioned join.

Each geometry row gets a quadtree of square cells whose sides are powers of
two (in degrees), so cell borders are exact in doubles and in decimals. A cell
that edges touch is divided until at most ``edge_bound`` edges do; a cell that
none touches lies wholly inside (kept) or outside (left out). So a point meets
one cell of a geometry at most, and tests no more edges than the bound.

A cell is tested by its own edges alone. It carries the parity of the crossings of a
ray to the right of its upper right corner (``ref``). A point's parity is that one, changed by
the cell's edges that cross the way from the point to the cell's right border, and by
those that cross that border from there up to the corner:

* a point counts an edge if the edge crosses its height (one end above, the
  other not) strictly to its right, which is the parity just above and to the right of it;
* an edge crosses the border if one end is right of it and the other not, at a
  height where a rising edge through a point counts as above it.

With sides of edges decided exactly (``functions.geo.side_sql``), this is the
parity of the full edge list in every case, also on borders and corners.

Shape of the job: a geometry row of up to ``WHOLE_EDGES`` edges is divided to the end in
one task, in arrays of many rows at once; only its cells leave. Larger rows, and rows that share
a key, go by rounds, one per ``LEVELS`` levels. Edges of too full cells are dealt to
the children they touch; child parities and counts are aggregates, combined map-side, so
no cell's edges are ever gathered before they are few enough. A too full cell with
very many edges is salted where edges meet its counts. Each round is written
(a lost executor repeats one round at most), and rounds end when no cell is too full.
A cell of the least size may hold more edges than the bound, if so many meet there.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangewise.functions.geo import left_of_sql, on_edge_sql, side_sql
from rangewise.operators.joins import salted_by_count
from rangewise.session import scratch_path, ship_package
from rangewise.sources.parallel import spread

#: Edges that a point tests at most.
EDGE_BOUND = 64
#: Exponent of the least cell side: 2**-12 degrees, about 27 m, and 12 decimals.
LEAST_EXPONENT = -12
#: Levels that a too full cell is divided by in one round.
LEVELS = 2
#: Edges of one cell in a task.
SALT_EDGES = 200_000
#: Edges of a geometry row that one task divides to the end.
WHOLE_EDGES = 200_000
#: Edges (of one row or of many) that are divided side by side, and dealt to children at once.
TOGETHER_EDGES, BLOCK_EDGES = 1 << 16, 1 << 13

CELL = ["taxon_name", "geom_row_id", "k", "ix", "iy"]
_EDGE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
DEALT = ("taxon_name string, geom_row_id long, k int, ix long, iy long, "
         "s struct<x1:double,y1:double,x2:double,y2:double>, odd int, touch boolean")


def size_sql(k: str = "k") -> str:
    return f"power(2D, {k})"


def _above_sql(x: str, y: str, e: str = "s") -> str:
    """True if edge ``e`` crosses the vertical through ``x`` above ``y``; asked
    only of edges that cross it. Through (x, y), a rising edge does."""
    side = side_sql(x, y, e)
    return (f"CASE WHEN {y} < least({e}.y1, {e}.y2) THEN true WHEN {y} > greatest({e}.y1, {e}.y2) THEN false "
            f"WHEN {side} = 0 THEN {e}.y1 <> {e}.y2 AND ({e}.y2 > {e}.y1) = ({e}.x2 > {e}.x1) "
            f"ELSE {side} = CASE WHEN {e}.x2 > {e}.x1 THEN -1 ELSE 1 END END")


def changes_sql(x: str, y: str, right: str, top: str, e: str = "s") -> str:
    """How often edge ``e`` changes the parity between (x, y) and the corner
    (right, top), by way of (right, y): 0, 1 or 2."""
    level = f"({e}.y1 > {y}) <> ({e}.y2 > {y}) AND {left_of_sql(x, y, e)} AND NOT ({left_of_sql(right, y, e)})"
    border = (f"({e}.x1 > {right}) <> ({e}.x2 > {right}) AND {_above_sql(right, y, e)}"
              f" AND NOT ({_above_sql(right, top, e)})")
    return f"(CASE WHEN {level} THEN 1 ELSE 0 END + CASE WHEN {border} THEN 1 ELSE 0 END)"


# -- the same in tasks, for whole batches of edges -------------------------------------
#
# In generated code these tests outgrow what the JVM compiles; as higher-order
# functions they are interpreted for every edge and child. Arrays of a batch take
# them all at once, with the comparisons and the exact sides of ``functions.geo``.

Edges = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _units(v: float) -> int | None:
    """A coordinate in units of its 14th decimal; None where ``side_sql`` has no decimal."""
    if not abs(v) < 1000:
        return None
    return int(Decimal(repr(v)).quantize(Decimal("1e-14"), ROUND_HALF_UP).scaleb(14))


def side(x: np.ndarray, y: np.ndarray, e: Edges) -> np.ndarray:
    """``side_sql`` of points and edges of one shape."""
    x1, y1, x2, y2 = e
    d = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    near = 1e-12 * (np.abs(x2 - x1) + np.abs(y - y1) + np.abs(y2 - y1) + np.abs(x - x1))
    out = np.where(d > near, 1, np.where(-d > near, -1, 0))
    # no decimals where both products have a factor that is nothing
    none = ((x2 == x1) | (y == y1)) & ((y2 == y1) | (x == x1))
    for i in np.flatnonzero((np.abs(d) <= near) & ~none):
        units = [_units(float(v[i])) for v in (x1, y1, x2, y2, x, y)]
        if None in units:
            out[i] = np.sign(d[i])
        else:
            a, b, a2, b2, u, v = units
            p, q = (a2 - a) * (v - b), (b2 - b) * (u - a)
            out[i] = (p > q) - (p < q)
    return out


def _decided(asked: np.ndarray, known: np.ndarray, open_: np.ndarray, x: np.ndarray, y: np.ndarray,
             e: Edges, by_side) -> np.ndarray:
    """``known``, but by the side of the edge where that is ``open_`` and asked for."""
    at = np.nonzero(asked & open_)
    if len(at[0]):
        e = tuple(np.broadcast_to(v, asked.shape)[at] for v in e)
        known[at] = by_side(side(*(np.broadcast_to(v, asked.shape)[at] for v in (x, y)), e), e)
    return known


def left_of(asked: np.ndarray, x: np.ndarray, y: np.ndarray, e: Edges) -> np.ndarray:
    """``left_of_sql`` where ``asked``."""
    x1, _, x2, _ = e
    first = np.broadcast_to(x < np.minimum(x1, x2), asked.shape)
    return _decided(asked, first.copy(), ~first & (x < np.maximum(x1, x2)), x, y, e,
                    lambda s, e: s == np.where(e[3] > e[1], 1, -1))


def above(asked: np.ndarray, x: np.ndarray, y: np.ndarray, e: Edges) -> np.ndarray:
    """``_above_sql`` where ``asked``."""
    _, y1, _, y2 = e
    first = np.broadcast_to(y < np.minimum(y1, y2), asked.shape)
    return _decided(asked, first.copy(), ~first & (y <= np.maximum(y1, y2)), x, y, e, lambda s, e: np.where(
        s == 0, (e[1] != e[3]) & ((e[3] > e[1]) == (e[2] > e[0])), s == np.where(e[2] > e[0], -1, 1)))


def changes(x: np.ndarray, y: np.ndarray, right: np.ndarray, top: np.ndarray, e: Edges) -> np.ndarray:
    """``changes_sql`` of (children, edges): how often an edge changes the parity."""
    x1, y1, x2, y2 = e
    level = (y1 > y) != (y2 > y)
    level &= left_of(level, x, y, e)
    level &= ~left_of(level, right, y, e)
    border = np.broadcast_to((x1 > right) != (x2 > right), level.shape).copy()
    border &= above(border, right, y, e)
    border &= ~above(border, right, top, e)
    return level.astype(np.int32) + border


def touches(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, e: Edges) -> np.ndarray:
    """True if the edge meets the closed box (may be true a hair beside it)."""
    ax, ay, bx, by = e
    corners = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x in (x0, x1) for y in (y0, y1)]
    near = 1e-12 * (np.abs(bx - ax) + np.abs(by - ay) + x1 - x0 + 1)
    return ((np.minimum(ax, bx) <= x1) & (np.maximum(ax, bx) >= x0)
            & (np.minimum(ay, by) <= y1) & (np.maximum(ay, by) >= y0)
            & (np.minimum.reduce(corners) <= near) & (np.maximum.reduce(corners) >= -near))


def _edges_of(b: pa.RecordBatch) -> Edges:
    return tuple(b.column("s").field(c).to_numpy(zero_copy_only=False) for c in ("x1", "y1", "x2", "y2"))


def _dealt(b: pa.RecordBatch, at: np.ndarray, k, ix, iy, odd: np.ndarray, touch: np.ndarray) -> pa.RecordBatch:
    """Rows ``at`` of a batch in the cells given."""
    rows = pa.array(at)
    return pa.RecordBatch.from_arrays(
        [b.column("taxon_name").take(rows), b.column("geom_row_id").take(rows), pa.array(k.astype(np.int32)),
         pa.array(ix), pa.array(iy), b.column("s").take(rows), pa.array(odd.astype(np.int32)), pa.array(touch)],
        names=[*CELL, "s", "odd", "touch"])


def _to_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges by root cell: whether they change the corner's parity or touch the cell."""
    for b in batches:
        e = _edges_of(b)
        k, ix, iy = (b.column(c).to_numpy() for c in CELL[2:])
        size = 2.0 ** k
        right, top = (ix + 1) * size, (iy + 1) * size
        odd = (e[1] > top) != (e[3] > top)
        odd &= left_of(odd, right, top, e)
        yield _dealt(b, np.arange(len(k)), k, ix, iy, odd, touches(ix * size, iy * size, right, top, e))


def _to_children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of too full cells by child: those that change its parity or touch it."""
    across = 1 << LEVELS
    dx, dy = (v.reshape(-1, 1) for v in np.divmod(np.arange(across * across), across))
    for b in batches:
        e = _edges_of(b)
        k, ix, iy = (b.column(c).to_numpy() for c in CELL[2:])
        size, part = 2.0 ** k, 2.0 ** (k - LEVELS)
        cx, cy = across * ix + dx, across * iy + dy
        x, y = (cx + 1) * part, (cy + 1) * part
        odd = changes(x, y, (ix + 1) * size, (iy + 1) * size, e) % 2
        touch = touches(x - part, y - part, x, y, e)
        child, at = np.nonzero((odd == 1) | touch)
        yield _dealt(b, at, k[at] - LEVELS, cx[child, at], cy[child, at], odd[child, at], touch[child, at])


def _spans(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


class _Cells:
    """Cells of some geometry rows: of which row, k, ix, iy, parity, and the edges that touch
    them (places, in the cells' order, and how many of each)."""

    def __init__(self, row, k, ix, iy, ref, n, edges):
        self.row, self.k, self.ix, self.iy, self.ref, self.n, self.edges = row, k, ix, iy, ref, n, edges

    def some(self, which: np.ndarray) -> _Cells:
        return _Cells(*(v[which] for v in (self.row, self.k, self.ix, self.iy, self.ref, self.n)),
                      self.edges[np.repeat(which, self.n)])


def _row_roots(k, box: Edges, first: np.ndarray, count: np.ndarray, e: Edges) -> _Cells:
    """The root cells of rows with edges [first, first + count) each."""
    size = 2.0 ** k
    low, high = ([np.floor(v / size).astype(np.int64) for v in b] for b in (box[:2], box[2:]))
    wide, tall = high[0] - low[0] + 1, high[1] - low[1] + 1
    row = np.repeat(np.arange(len(k)), wide * tall)
    nth = _spans(wide * tall)
    ix, iy = low[0][row] + nth // tall[row], low[1][row] + nth % tall[row]
    of = np.repeat(np.arange(len(row)), count[row])
    at = first[row][of] + _spans(count[row])
    size = size[row]
    right, top = ((ix + 1) * size)[of], ((iy + 1) * size)[of]
    own = tuple(v[at] for v in e)
    odd = (own[1] > top) != (own[3] > top)
    odd &= left_of(odd, right, top, own)
    touch = touches((ix * size)[of], (iy * size)[of], right, top, own)
    return _Cells(row, k[row], ix, iy, np.bincount(of[odd], minlength=len(row)) % 2,
                  np.bincount(of[touch], minlength=len(row)), at[touch])


def _row_children(cells: _Cells, e: Edges) -> _Cells:
    """The children of cells. An edge is tested only for children whose box it meets, and for
    corners on whose height it crosses, or if it crosses its cell's right border."""
    across = 1 << LEVELS
    each = across * across
    step = np.arange(across)[:, None]
    of = np.repeat(np.arange(len(cells.k)), cells.n)
    odd, found, held = np.zeros(len(cells.k) * each, np.int64), [], []
    for start in range(0, len(of), BLOCK_EDGES):
        at, c = cells.edges[start:start + BLOCK_EDGES], of[start:start + BLOCK_EDGES]
        x1, y1, x2, y2 = own = tuple(v[at] for v in e)
        size, part = 2.0 ** cells.k[c], 2.0 ** (cells.k[c] - LEVELS)
        left, low = across * cells.ix[c], across * cells.iy[c]
        right, top = (cells.ix[c] + 1) * size, (cells.iy[c] + 1) * size
        y = (low + step + 1) * part
        j, i = np.nonzero((y1 > y) != (y2 > y))
        some, asked = tuple(v[i] for v in own), np.ones((across, len(i)), bool)
        level = left_of(asked, (left[i] + step + 1) * part[i], y[j, i], some)
        level &= ~left_of(level, right[i], y[j, i], some)
        column, q = np.nonzero(level)
        turned = [c[i[q]] * each + column * across + j[q]]
        i = np.flatnonzero((x1 > right) != (x2 > right))
        some, asked = tuple(v[i] for v in own), np.ones((across, len(i)), bool)
        border = above(asked, right[i], y[:, i], some)
        border &= ~above(border, right[i], top[i], some)
        j, q = np.nonzero(border)
        turned += [c[i[q]] * each + column * across + j for column in range(across)]
        odd += np.bincount(np.concatenate(turned), minlength=len(odd))
        # the boxes are closed; their borders are exact
        spans = [(np.clip(np.ceil(np.minimum(u, v) / part) - 1 - o, 0, across).astype(np.int64),
                  np.clip(np.floor(np.maximum(u, v) / part) - o, -1, across - 1).astype(np.int64))
                 for u, v, o in ((x1, x2, left), (y1, y2, low))]
        (cx, wide), (cy, tall) = ((lo, np.maximum(hi - lo + 1, 0)) for lo, hi in spans)
        i, nth = np.repeat(np.arange(len(c)), wide * tall), _spans(wide * tall)
        jx, jy = cx[i] + nth // tall[i], cy[i] + nth % tall[i]
        x, y, near = (left[i] + jx) * part[i], (low[i] + jy) * part[i], tuple(v[i] for v in own)
        meets = touches(x, y, x + part[i], y + part[i], near)
        found.append((c[i] * each + jx * across + jy)[meets])
        held.append(at[i[meets]])
    child, edges = np.concatenate(found), np.concatenate(held)
    order = np.argsort(child, kind="stable")
    row, k = np.repeat(cells.row, each), np.repeat(cells.k - LEVELS, each)
    dx, dy = np.divmod(np.arange(each), across)
    ix, iy = ((across * v[:, None] + d).ravel() for v, d in ((cells.ix, dx), (cells.iy, dy)))
    return _Cells(row, k, ix, iy, (np.repeat(cells.ref, each) + odd) % 2,
                  np.bincount(child, minlength=len(row)), edges[order])


def _divided_rows(b: pa.RecordBatch, edge_bound: int, least: int) -> Iterator[pa.RecordBatch]:
    """The index rows of geometry rows (none without edges), each divided to the end."""
    lists = b.column("edges")
    first = lists.offsets.to_numpy().astype(np.int64)
    first, count = first[:-1] - first[0], np.diff(first)
    sides = lists.flatten()
    e = tuple(sides.field(c).to_numpy(zero_copy_only=False) for c in ("x1", "y1", "x2", "y2"))
    box = tuple(b.column(c).to_numpy(zero_copy_only=False) for c in ("xmin", "ymin", "xmax", "ymax"))
    cells = _row_roots(b.column("k").to_numpy().astype(np.int64), box, first, count, e)
    while len(cells.k):
        full = (cells.n > edge_bound) & (cells.k > least)
        done = cells.some(~full & ((cells.n > 0) | (cells.ref == 1)))
        row = pa.array(done.row)
        offsets = pa.array(np.concatenate([[0], np.cumsum(done.n)]).astype(np.int32))
        edges = pa.ListArray.from_arrays(offsets, sides.take(pa.array(done.edges)), mask=pa.array(done.n == 0))
        yield pa.RecordBatch.from_arrays(
            [b.column("taxon_name").take(row), b.column("geom_row_id").take(row), pa.array(done.k.astype(np.int32)),
             pa.array(done.ix), pa.array(done.iy), pa.array(done.ref.astype(np.int32)), edges],
            names=[*CELL, "ref", "edges"])
        over = cells.some(full)
        if not len(over.k):
            break
        cells = _row_children(over, e)


def _whole_rows(geo: DataFrame, edge_bound: int, least: int, whole_edges: int) -> DataFrame:
    """The index of rows of up to ``whole_edges`` edges; a row without ``k`` for each larger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count = np.diff(b.column("edges").offsets.to_numpy())
            large = np.flatnonzero(count > whole_edges)
            if len(large):
                rows = pa.array(large)
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).take(rows) for c in CELL[:2]] + [pa.nulls(len(large), t) for t in (
                        pa.int32(), pa.int64(), pa.int64(), pa.int32(), b.schema.field("edges").type)],
                    names=[*CELL, "ref", "edges"])
            rest = np.flatnonzero(count <= whole_edges)
            share = np.cumsum(count[rest].astype(np.int64)) // TOGETHER_EDGES
            for rows in np.split(rest, np.flatnonzero(np.diff(share)) + 1):
                if len(rows):
                    yield from _divided_rows(b.take(pa.array(rows)), edge_bound, least)

    ship_package(geo.sparkSession)
    g = spread(geo.where("size(edges) > 0"), scan=False).select(
        *CELL[:2], "edges", "xmin", "ymin", "xmax", "ymax", _root_exponent(least).alias("k"))
    return g.mapInArrow(run, f"taxon_name string, geom_row_id long, k int, ix long, iy long, ref int, edges {_EDGE}")


def within_cell(lon: str, lat: str, edges: str = "edges", ref: str = "ref", k: str = "k",
                ix: str = "ix", iy: str = "iy") -> Column:
    """Strict point-in-polygon within the point's cell; true in a cell without
    edges (only those inside are kept)."""
    right, top = (f"(({i} + 1) * {size_sql(k)})" for i in (ix, iy))
    # an edge beside, above or below both ways cannot matter
    return F.expr(f"""CASE
        WHEN isnan({lon}) OR isnan({lat}) THEN false
        WHEN {edges} IS NULL THEN true
        ELSE aggregate({edges}, {ref}, (a, s) -> CASE
          WHEN a < 0 OR greatest(s.x1, s.x2) < {lon} OR greatest(s.y1, s.y2) < {lat} THEN a
          WHEN {on_edge_sql(lon, lat)} THEN -1
          ELSE a + {changes_sql(lon, lat, right, top)} END,
          a -> a > 0 AND a % 2 = 1) END""")


def written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"cells-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _root_exponent(least: int) -> Column:
    k = F.greatest(F.lit(least), F.coalesce(F.ceil(F.log2(
        F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")))).cast("int"), F.lit(least)))
    return F.ceil((k - least) / LEVELS).cast("int") * LEVELS + least  # whole rounds from the least


def _roots(geo: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Cells as large as each geometry (four at most cover it) with parity and
    count of touching edges, and those edges."""
    g = spread(geo.where("size(edges) > 0"), scan=False).withColumn("k", _root_exponent(least))

    def span(axis: str) -> Column:
        return F.expr(f"sequence(cast(floor({axis}min / {size_sql()}) AS BIGINT),"
                      f" cast(floor({axis}max / {size_sql()}) AS BIGINT))")
    dealt = (g.withColumn("ix", F.explode(span("x"))).withColumn("iy", F.explode(span("y")))
             .select(*CELL, F.explode("edges").alias("s")))
    ship_package(geo.sparkSession)
    e = written(dealt.mapInArrow(_to_roots, DEALT).where("odd = 1 OR touch"), "edges")
    cells = e.groupBy(*CELL).agg(F.bit_xor("odd").alias("ref"), F.count_if("touch").alias("n"))
    return written(cells, "roots"), e.where("touch").select(*CELL, "s")


def _divided(full: DataFrame, edges: DataFrame, salt_edges: int) -> tuple[DataFrame, DataFrame]:
    """Children of the too full cells, and their edges."""
    across = 1 << LEVELS
    children = F.expr(f"""array({", ".join(
        f"named_struct('k', k - {LEVELS}, 'ix', {across} * ix + {dx}, 'iy', {across} * iy + {dy})"
        for dx in range(across) for dy in range(across))})""")
    child = ["taxon_name", "geom_row_id", "c.k", "c.ix", "c.iy"]
    big, small = salted_by_count(spread(edges, scan=False), full.select(*CELL, "n"), CELL, "n",
                                 F.xxhash64("s.x1", "s.y1", "s.x2", "s.y2"), salt_edges)
    ship_package(edges.sparkSession)
    e = written(big.join(small.select(*CELL, "salt"), [*CELL, "salt"]).select(*CELL, "s")
                 .mapInArrow(_to_children, DEALT), "dealt")
    # every child, with the cell's parity to start from
    start = full.withColumn("c", F.explode(children)).select(
        *child, F.col("ref").alias("odd"), F.lit(False).alias("touch"))
    cells = start.unionByName(e.select(*CELL, "odd", "touch")).groupBy(*CELL).agg(
        F.bit_xor("odd").alias("ref"), F.count_if("touch").alias("n"))
    return written(cells, "cells"), e.where("touch").select(*CELL, "s")


def cell_index(geo: DataFrame, edge_bound: int = EDGE_BOUND, least_exponent: int = LEAST_EXPONENT,
               salt_edges: int = SALT_EDGES, whole_edges: int = WHOLE_EDGES) -> DataFrame:
    """``geo`` (taxon_name, geom_row_id, edges, xmin, ymin, xmax, ymax) -> a row
    per cell that holds edges (``edges``, at most ``edge_bound``) or lies inside
    (``edges`` NULL): taxon_name, geom_row_id, k, ix, iy, ref, edges."""
    row = CELL[:2]
    # rows under one key are one geometry, which rounds put together
    shared = written(geo.select(*row).groupBy(*row).agg(F.count(F.lit(1)).alias("n")).where(
        " OR ".join(["n > 1", *(f"{c} IS NULL" for c in row)])).select(*row), "shared")

    def of(keys: DataFrame, how: str) -> DataFrame:
        keys = keys.toDF(*(f"_{c}" for c in row)).distinct()
        return geo.join(keys, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in row]), how)
    none = shared.isEmpty()
    index = written(_whole_rows(geo if none else of(shared, "left_anti"), edge_bound, least_exponent, whole_edges),
                    "whole")
    apart = index.where("k IS NULL").select(*row)
    index = index.where("k IS NOT NULL")
    apart = apart if none else apart.unionByName(shared)
    if apart.isEmpty():
        return index
    return written(reduce(DataFrame.unionByName, [
        index, *_by_rounds(of(apart, "left_semi"), edge_bound, least_exponent, salt_edges)]), "index")


def _by_rounds(geo: DataFrame, edge_bound: int, least_exponent: int, salt_edges: int) -> list[DataFrame]:
    cells, edges = _roots(geo, least_exponent)
    found: list[DataFrame] = []
    while True:
        held = F.col("n") > 0
        full = (F.col("n") > edge_bound) & (F.col("k") > least_exponent)
        found.append(cells.where(~held & (F.col("ref") == 1)).select(
            *CELL, "ref", F.lit(None).cast(_EDGE).alias("edges")))
        done = cells.where(held & ~full).select(*CELL, "ref")
        found.append(edges.join(done, CELL).groupBy(*CELL, "ref").agg(F.collect_list("s").alias("edges")))
        over = cells.where(full)
        if over.isEmpty():
            return found
        cells, edges = _divided(over, edges, salt_edges)


def cell_report(index: DataFrame) -> DataFrame:
    """Per species: cells inside and on the boundary, the most edges of a cell,
    the sizes in use."""
    return index.groupBy("taxon_name").agg(
        F.count_if(F.col("edges").isNull()).alias("inside_cells"),
        F.count_if(F.col("edges").isNotNull()).alias("boundary_cells"),
        F.coalesce(F.max(F.size("edges")), F.lit(0)).alias("most_edges"),
        F.min("k").alias("least_exponent"), F.max("k").alias("largest_exponent"))

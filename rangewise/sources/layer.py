"""Species-range polygon layer: from delivered rows (attributes + WKT) to the
staging table ``species_geospatial_raw``.

A layer arrives as any Spark source (Parquet, CSV, JSON...) with a WKT column,
or in the binary polygon formats (``sources.polygon_files``). Parsing, edge building,
bounding boxes, length and area are all column expressions, so the build is
one narrow (shuffle-free) stage however large the layer is.

Optional vertex reduction is a Douglas-Peucker pass per ring, either with a
given tolerance or automatically (the load's automatic simplification): only
geometry rows above a vertex limit are reduced, each with the smallest
tolerance that makes it fit. It runs in ``mapInArrow``: per geometry row,
no grouping, no shuffle, and only the ring column leaves Arrow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangewise.functions.geo import (edges_area_sql, edges_bbox_sql, edges_length_sql,
                                     rings_to_edges_sql, wkt_fault, wkt_rings_sql)
from rangewise.schemas import LAYER_ATTRIBUTES, SPECIES_GEOSPATIAL_RAW
from rangewise.session import ship_package
from rangewise.sources.wkt_batches import read_in_batches

#: Bytes of an edge in an array of structs (a pointer, null bits, four
#: doubles) and of a geometry row besides; both for size bounds.
EDGE_BYTES, BASE_BYTES = 48, 64


def build_layer(src: DataFrame, wkt_col: str = "wkt", *, rings_col: str | None = None,
                simplify_tolerance: float | None = None, simplify_min_vertices: int = 64,
                simplify_max_vertices: int | None = None, in_batches: bool = False) -> DataFrame:
    """Delivered layer rows -> staging layer rows (one per geometry row).

    Geometry is text in ``wkt_col`` or, if ``rings_col`` is given (a binary
    layer), rings. ``in_batches``: text is read by ``sources.wkt_batches``, for a
    layer that is staged whole; the expressions read what that leaves.

    ``geom_row_id`` is kept when the source has one, else generated; the
    declared key ``id_no`` is not unique per geometry row, so every
    per-geometry computation keys on ``geom_row_id``. The projections are
    SQL text (one parse per step rather than one driver call per function).
    """
    w = f"`{wkt_col}`"
    rid = "geom_row_id" if "geom_row_id" in src.columns else "monotonically_increasing_id()"
    # A vertex takes at least 4 characters of WKT ("0 0,") and yields at most
    # one edge; a ring's closing edge goes with its "(", ")" and "," at least.
    # So an edge per 3 characters is a bound computable without parsing.
    rings, bound = wkt_rings_sql(wkt_col), f"coalesce(length({w}), 0) * {EDGE_BYTES // 3}"
    if rings_col:
        wkt_col, rings = rings_col, f"`{rings_col}`"
        bound = f"coalesce(aggregate({rings}, 0, (a, r) -> a + size(r) + 1), 0) * {EDGE_BYTES}"
    given, columns = src.columns, ["*", f"{rid} AS _rid", f"{BASE_BYTES} + {bound} AS _geom_bytes"]
    simplified = simplify_tolerance is not None or simplify_max_vertices is not None
    if in_batches := in_batches and not rings_col:
        df = read_in_batches(src.selectExpr(*columns), wkt_col).selectExpr(
            "*", f"CASE WHEN _read THEN _read_rings ELSE {rings} END AS _rings")
    else:
        df = src.selectExpr(*columns, f"{rings} AS _rings")

    def edge_based(name: str, e: str) -> str:
        return f"CASE WHEN _read THEN _read_{name} ELSE {e} END" if in_batches and not simplified else e
    if simplified:
        df = simplify_rings(df.drop(wkt_col), simplify_tolerance, simplify_min_vertices,
                            simplify_max_vertices, rings="_rings", bound="_geom_bytes")
    df = df.selectExpr("*", f"{edge_based('edges', rings_to_edges_sql('_rings'))} AS _edges")
    cols = []
    for f in SPECIES_GEOSPATIAL_RAW.fields:
        t = f.dataType.simpleString()
        if f.name == "geom_row_id":
            e = "_rid"
        elif f.name in ("rings", "edges", "geom_bytes"):
            e = f"_{f.name}"
        elif f.name in ("xmin", "ymin", "xmax", "ymax"):
            e = edge_based(f.name, edges_bbox_sql("_edges")[f.name])
        elif f.name == "shape_leng":
            base = f"CAST(`{f.name}` AS double)" if f.name in given else "NULL"
            e = f"coalesce({base}, {edge_based('leng', edges_length_sql('_edges'))})"
        elif f.name == "shape_area":
            base = f"CAST(`{f.name}` AS double)" if f.name in given else "NULL"
            e = f"coalesce({base}, {edge_based('area', edges_area_sql('_edges'))})"
        elif f.name in given:
            e = f"`{f.name}`"
        else:
            e = "NULL"
        cols.append(f"CAST({e} AS {t}) AS `{f.name}`")
    return df.selectExpr(*cols)


def layer_parse_errors(src: DataFrame, wkt_col: str = "wkt") -> DataFrame:
    """The rows whose text ``build_layer`` would refuse, with ``fault`` (``tag``,
    ``outline`` or ``vertex``) and ``wkt_start``: a report to read before a load that would fail."""
    fault, start = "fault", "wkt_start"
    rest = [c for c in src.columns if c not in (wkt_col, fault, start)]
    return src.withColumns({fault: wkt_fault(wkt_col), start: F.substring(F.col(wkt_col), 1, 80)}).where(
        F.col(fault).isNotNull()).select(*rest, fault, start)


def layer_from_parquet(spark, path: str, wkt_col: str = "wkt", **kw) -> DataFrame:
    """Read a delivered layer (Parquet with a WKT column) and build it."""
    return build_layer(spark.read.parquet(path), wkt_col=wkt_col, **kw)


# -- vertex reduction -----------------------------------------------------------

#: A closed ring of an area has at least this many vertices.
_LEAST_RING = 4


def _douglas_peucker(xs: np.ndarray, ys: np.ndarray, tol: float) -> np.ndarray:
    """Indices of the vertices kept by Douglas-Peucker (iterative, numpy)."""
    n = len(xs)
    keep = np.zeros(n, dtype=bool)
    keep[0] = keep[n - 1] = True
    stack = [(0, n - 1)]
    while stack:
        i, j = stack.pop()
        if j <= i + 1:
            continue
        px, py = xs[i + 1:j], ys[i + 1:j]
        dx, dy = xs[j] - xs[i], ys[j] - ys[i]
        seg = np.hypot(dx, dy)
        if seg == 0.0:  # closed ring: distance to the anchor point
            d = np.hypot(px - xs[i], py - ys[i])
        else:
            d = np.abs(dy * (px - xs[i]) - dx * (py - ys[i])) / seg
        k = int(np.argmax(d))
        if d[k] > tol:
            m = i + 1 + k
            keep[m] = True
            stack.append((i, m))
            stack.append((m, j))
    return np.flatnonzero(keep)


def _simplify_ring(xs, ys, tol: float, min_vertices: int):
    if len(xs) <= min_vertices:
        return xs, ys
    idx = _douglas_peucker(xs, ys, tol)
    if len(idx) < 4:
        # too coarse: keep a minimal ring instead - the first vertex, the one
        # farthest from it, and the one farthest from that chord (+ closure)
        n = len(xs)
        k1 = int(np.argmax(np.hypot(xs - xs[0], ys - ys[0])))
        dx, dy = xs[k1] - xs[0], ys[k1] - ys[0]
        k2 = int(np.argmax(np.abs(dy * (xs - xs[0]) - dx * (ys - ys[0]))))
        idx = np.array(sorted({0, k1, k2, n - 1}))
        if len(idx) < 4:  # degenerate ring (collinear / repeated points)
            return xs, ys
    return xs[idx], ys[idx]


def significance(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """The tolerance at which Douglas-Peucker drops each vertex (infinite for
    the ends): it stays while its own distance, and that of every vertex its
    stretch was divided at before, is above the tolerance. One full division
    tells what a reduction with any tolerance keeps."""
    out = np.zeros(len(xs))
    out[[0, -1]] = np.inf
    stack = [(0, len(xs) - 1, np.inf)]
    while stack:
        i, j, most = stack.pop()
        if j <= i + 1:
            continue
        px, py = xs[i + 1:j], ys[i + 1:j]
        dx, dy = xs[j] - xs[i], ys[j] - ys[i]
        seg = np.hypot(dx, dy)
        if seg == 0.0:  # closed ring: distance to the anchor point
            d = np.hypot(px - xs[i], py - ys[i])
        else:
            d = np.abs(dy * (px - xs[i]) - dx * (py - ys[i])) / seg
        k = int(np.argmax(d))
        m, own = i + 1 + k, min(float(d[k]), most)
        if own > 0.0:  # else nothing in the stretch ever stays
            out[m] = own
            stack += [(i, m, own), (m, j, own)]
    return out


#: Vertices divided side by side.
TOGETHER = 1 << 17


def significances(rings: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """``significance`` of many rings: the stretches of all of them are divided
    side by side, a level at a time, ``TOGETHER`` vertices (or one ring) at once."""
    out: list[np.ndarray] = []
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for ring in rings:
        if held and size + len(ring[0]) > TOGETHER:
            out += _side_by_side(held)
            held, size = [], 0
        held.append(ring)
        size += len(ring[0])
    return out + (_side_by_side(held) if held else [])


def _side_by_side(rings: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    xs, ys = (np.concatenate([r[k] for r in rings]) for k in (0, 1))
    if not (np.isfinite(xs).all() and np.isfinite(ys).all()):
        return [significance(x, y) for x, y in rings]
    sizes = np.array([len(x) for x, _ in rings])
    ends = np.cumsum(sizes)
    i, j = (ends - sizes)[sizes > 0], (ends - 1)[sizes > 0]
    out = np.zeros(len(xs))
    out[i] = out[j] = np.inf
    most = np.full(len(i), np.inf)
    while True:
        some = j > i + 1
        i, j, most = i[some], j[some], most[some]
        if not len(i):
            break
        inner = j - i - 1
        first = np.cumsum(inner) - inner
        of = np.repeat(np.arange(len(i)), inner)
        at = np.arange(len(of)) + (i + 1 - first)[of]
        dx, dy = xs[j] - xs[i], ys[j] - ys[i]
        seg = np.hypot(dx, dy)
        px, py = xs[at] - xs[i][of], ys[at] - ys[i][of]
        closed = seg == 0.0  # distance to the anchor point
        d = np.abs(dy[of] * px - dx[of] * py) / np.where(closed, 1.0, seg)[of]
        if closed.any():
            d = np.where(closed[of], np.hypot(px, py), d)
        top = np.maximum.reduceat(d, first)
        hit = np.flatnonzero(d == top[of])
        m = at[hit[np.unique(of[hit], return_index=True)[1]]]  # the first of each stretch
        own = np.minimum(top, most)
        keep = own > 0.0  # else nothing in the stretch ever stays
        i, j, m, own = i[keep], j[keep], m[keep], own[keep]
        out[m] = own
        i, j, most = np.concatenate([i, m]), np.concatenate([m, j]), np.concatenate([own, own])
    return np.split(out, ends[:-1])


def _least_ring(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Vertices that any reduction keeps: all of a ring of up to ``_LEAST_RING``
    or of one without area; else the first, the one farthest from it, the one
    farthest from that chord, and the closure."""
    n = len(xs)
    k1 = int(np.argmax(np.hypot(xs - xs[0], ys - ys[0])))
    dx, dy = xs[k1] - xs[0], ys[k1] - ys[0]
    k2 = int(np.argmax(np.abs(dy * (xs - xs[0]) - dx * (ys - ys[0]))))
    least = np.array(sorted({0, k1, k2, n - 1}))
    return np.arange(n) if n <= _LEAST_RING or len(least) < 4 else least


def _fitted(rings, max_vertices: int, significant: list[np.ndarray] | None = None):
    """Rings with the smallest tolerance that leaves at most ``max_vertices``
    vertices, by one division per ring and a selection over all
    significances; the same rings if they fit. A row whose rings do not fit even at their
    least fails the job. ``significant``: the rings' significances, if known."""
    total = sum(len(x) for x, _ in rings)
    if total <= max_vertices:
        return rings
    least = [_least_ring(x, y) for x, y in rings]
    orders = [np.zeros(len(x)) if len(x) <= _LEAST_RING else significance(x, y) if significant is None else significant[k]
              for k, (x, y) in enumerate(rings)]
    # a ring's four most significant vertices are its least; each further one that stays counts
    more = np.concatenate([np.sort(o)[:-4] if len(keep) == 4 and len(o) > 4 else np.empty(0)
                           for o, keep in zip(orders, least)])
    # a ring without area stays whole until four of its vertices are significant
    spare = max_vertices - sum(map(len, least))
    if spare < 0:
        raise ValueError(f"a geometry row of {len(rings)} rings and {total} vertices cannot be "
                         f"simplified to {max_vertices} vertices")
    tolerance = 0.0 if spare >= len(more) else float(np.partition(more, -spare - 1)[-spare - 1])
    out = []
    for (x, y), order, keep in zip(rings, orders, least):
        stays = np.flatnonzero(order > tolerance)
        at = stays if len(stays) >= 4 and len(x) > _LEAST_RING else keep
        out.append((x[at], y[at]))
    return out


def _ring_arrays(column: pa.Array) -> list[list[tuple[np.ndarray, np.ndarray]] | None]:
    """Rings of each row as coordinate arrays (None for a NULL geometry)."""
    column = pa.concat_arrays([column])
    rows, rings = column.offsets.to_numpy(), column.values.offsets.to_numpy()
    vertices = column.values.values
    xs, ys = (vertices.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    return [[(xs[s:e], ys[s:e]) for s, e in zip(rings[a:b], rings[a + 1:b + 1])] if valid else None
            for a, b, valid in zip(rows[:-1], rows[1:], column.is_valid().to_pylist())]


def _ring_column(rows, kind: pa.DataType) -> pa.Array:
    """The reverse of ``_ring_arrays``."""
    flat = [r for row in rows if row is not None for r in row]
    sizes = [0 if row is None else len(row) for row in rows]
    join = (lambda k: np.concatenate([r[k] for r in flat]) if flat else np.empty(0))
    vertex = kind.value_type.value_type
    vertices = pa.StructArray.from_arrays([pa.array(join(0)), pa.array(join(1))],
                                          fields=[vertex.field(0), vertex.field(1)])
    rings = pa.ListArray.from_arrays(
        pa.array(np.cumsum([0] + [len(x) for x, _ in flat]).astype(np.int32)), vertices)
    return pa.ListArray.from_arrays(
        pa.array(np.cumsum([0] + sizes).astype(np.int32)), rings,
        mask=pa.array([row is None for row in rows])).cast(kind)


def simplify_rings(df: DataFrame, tolerance: float | None, min_vertices: int = 64,
                   max_vertices: int | None = None, rings: str = "rings",
                   bound: str | None = None) -> DataFrame:
    """Reduce the vertices of column ``rings``.

    With a ``tolerance`` every ring longer than ``min_vertices`` is simplified
    with it (planar units). With ``tolerance=None`` and ``max_vertices``
    (automatic mode) only geometry rows above ``max_vertices`` vertices are
    simplified, each with the smallest tolerance that makes it fit,
    whatever its rings' sizes. ``bound`` names a column of size bounds
    (bytes) to be renewed for simplified rows. All other columns stay Arrow
    data and are handed through.
    """
    at = df.columns.index(rings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            before = _ring_arrays(b.column(at))
            after = []
            long = [] if tolerance is not None else [
                row for row in before if row and sum(len(x) for x, _ in row) > max_vertices]
            orders = iter(significances([ring for row in long for ring in row]))
            for row in before:
                if row and tolerance is None:
                    if sum(len(x) for x, _ in row) > max_vertices:
                        row = _fitted(row, max_vertices, [next(orders) for _ in row])
                elif row and tolerance > 0:
                    row = [_simplify_ring(x, y, tolerance, min_vertices) for x, y in row]
                after.append(row)
            columns = list(b.columns)
            columns[at] = _ring_column(after, b.schema.field(at).type)
            if bound:
                k = b.schema.names.index(bound)
                columns[k] = pa.array([
                    old if new is was else BASE_BYTES + EDGE_BYTES * sum(len(x) + 1 for x, _ in new)
                    for old, was, new in zip(b.column(k).to_pylist(), before, after)],
                    b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    ship_package(df.sparkSession)
    return df.mapInArrow(run, df.schema)


__all__ = ["build_layer", "layer_from_parquet", "layer_parse_errors", "simplify_rings", "LAYER_ATTRIBUTES"]

"""Planar geometry as Spark column expressions.

Geometry travels as plain arrays so every test runs JVM-side on executors:

* ``rings``: ``array<array<struct<x,y>>>`` - every ring of every part of a
  (multi)polygon, in file order.
* ``edges``: ``array<struct<x1,y1,x2,y2>>`` - the closed boundary segments of
  all rings. Even-odd over all rings treats holes and multiple parts alike.

``within`` is the strict-interior test: a point on an edge or a vertex is not
within; a NULL coordinate or a NULL geometry gives NULL. It is one pass of
``aggregate`` over the edge array, behind a bounding-box guard. Which side of
an edge a point lies on is decided exactly (``side_sql``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rangewise.schemas import WGS84_SRID

_EDGE_T = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def _sql(c: Column | str) -> str:
    """Column name -> backquoted SQL identifier (expressions pass through)."""
    if isinstance(c, str):
        return ".".join(f"`{p}`" for p in c.split("."))
    raise TypeError("pass column names to the SQL-built geometry helpers")


def wkt_rings(wkt_col: str) -> Column:
    return F.expr(wkt_rings_sql(wkt_col))


# One ordinate, and the tag with its optional dimension (a space before it or not).
_NUMBER = r"[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]+)?"
_SPACE = "[ \\\\t\\\\r\\\\n]+"
_BLANKS = r"[ \t\r\n]+"  # between the numbers of a vertex; a letter is none
_TAG = r"^\s*(MULTI)?POLYGON\s*(ZM|Z|M)?\s*"


def _lit(pattern: str) -> str:
    """A pattern as a raw SQL literal."""
    return f"r'{pattern}'"


def wkt_fault(wkt_col: str) -> Column:
    """Why ``wkt_rings`` would refuse a text: ``tag``, ``outline`` (its
    parentheses) or ``vertex``; NULL for a text that it reads, or none."""
    w = _sql(wkt_col)
    read = wkt_rings_sql(wkt_col, fail="NULL")
    return F.expr(f"""transform(array({read}), r -> CASE
        WHEN {w} IS NULL THEN NULL
        WHEN NOT {w} RLIKE {_lit('(?i)' + _TAG + '([(]|EMPTY)')} THEN 'tag'
        WHEN r IS NULL THEN 'outline'
        WHEN exists(r, g -> exists(g, v -> v IS NULL)) THEN 'vertex' END)[0]""")


def wkt_rings_sql(wkt_col: str, fail: str | None = None) -> str:
    """Parse POLYGON / MULTIPOLYGON WKT text into rings; NULL stays NULL.

    Each innermost parenthesised group is one ring's vertex list, so nesting
    depth (parts, holes) does not matter for even-odd containment. Z / M
    ordinates are read and left out; ``EMPTY`` has no rings.

    Whatever is not such text fails the job in both ANSI modes: another tag,
    unbalanced or misplaced parentheses, a vertex without exactly the number
    of numbers that the tag asks for, anything after the end. ``fail`` is
    what stands for such a text or vertex instead of an error.
    """
    w = _sql(wkt_col)
    tag = f"upper(regexp_extract({w}, {_lit('(?i)' + _TAG)}, 0))"
    fail = fail or f"raise_error(concat('malformed polygon text: ', left({w}, 80)))"
    # Bound once per row: s.d numbers a vertex, s.body the text after the tag.
    bound = (f"named_struct('d', 2 + length(regexp_extract({tag}, {_lit('(ZM|Z|M)?[ ]*$')}, 1)), "
             f"'multi', {tag} LIKE '%MULTI%', "
             f"'body', trim(regexp_replace({w}, {_lit('(?i)' + _TAG)}, '')))")
    # Rings replaced by a letter, then lists folded: what is left must be one
    # ring in one polygon (in one multipolygon).
    outline = (f"replace(replace(regexp_replace(regexp_replace(s.body, {_lit('[(][^()]*[)]')}, 'R'), "
               f"{_lit(_SPACE)}, ''), ',R', ''), ',(R)', '')")
    vertex = {d: _lit(r"^\s*" + _NUMBER + (r"(\s+" + _NUMBER + "){%d}" % (d - 1)) + r"\s*$")
              for d in (2, 3, 4)}
    whole = " ".join(f"WHEN s.d = {d} THEN v RLIKE {vertex[d]}" for d in vertex)
    point = (f"CASE WHEN (CASE {whole} END) THEN transform(array(split(trim(v), ' ')), "
             f"c -> named_struct('x', cast(c[0] AS double), 'y', cast(c[1] AS double)))[0] "
             f"ELSE {fail} END")
    # runs of blanks become one in a pass over the ring: a vertex is then split at a
    # plain character, which needs no pattern to be compiled for each
    rings = (f"transform(regexp_extract_all(s.body, {_lit('[(]([^()]*)[)]')}, 1), "
             f"r -> transform(split(regexp_replace(r, {_lit(_BLANKS)}, ' '), ','), v -> {point}))")
    none = "cast(array() AS array<array<struct<x:double,y:double>>>)"
    return (f"""CASE WHEN {w} IS NULL THEN NULL
        WHEN NOT {w} RLIKE {_lit('(?i)' + _TAG + '([(]|EMPTY)')} THEN {fail}
        ELSE transform(array({bound}), s ->
          CASE WHEN upper(s.body) = 'EMPTY' THEN {none}
               WHEN {outline} = CASE WHEN s.multi THEN '((R))' ELSE '(R)' END THEN {rings}
               ELSE {fail} END)[0] END""")


def rings_to_edges(rings_col: str) -> Column:
    """Rings -> closed boundary segments (closing segment added if missing)."""
    return F.expr(rings_to_edges_sql(rings_col))


def rings_to_edges_sql(rings_col: str) -> str:
    r = _sql(rings_col)
    return (
        f"""flatten(transform({r}, r ->
              CASE WHEN size(r) < 2 THEN cast(array() AS {_EDGE_T})
              ELSE concat(
                transform(sequence(0, size(r) - 2), i -> named_struct(
                  'x1', r[i].x, 'y1', r[i].y, 'x2', r[i + 1].x, 'y2', r[i + 1].y)),
                CASE WHEN r[0].x = r[size(r) - 1].x AND r[0].y = r[size(r) - 1].y
                     THEN cast(array() AS {_EDGE_T})
                     ELSE array(named_struct('x1', r[size(r) - 1].x, 'y1', r[size(r) - 1].y,
                                             'x2', r[0].x, 'y2', r[0].y)) END)
              END))"""
    )


def edges_bbox(edges_col: str) -> dict[str, Column]:
    """Bounding box of an edge array (NULL for NULL / empty geometry)."""
    return {k: F.expr(v) for k, v in edges_bbox_sql(edges_col).items()}


def edges_bbox_sql(edges_col: str) -> dict[str, str]:
    e = _sql(edges_col)
    return {
        "xmin": f"array_min(transform({e}, s -> least(s.x1, s.x2)))",
        "ymin": f"array_min(transform({e}, s -> least(s.y1, s.y2)))",
        "xmax": f"array_max(transform({e}, s -> greatest(s.x1, s.x2)))",
        "ymax": f"array_max(transform({e}, s -> greatest(s.y1, s.y2)))",
    }


def edges_length(edges_col: str) -> Column:
    """Total boundary length (planar units)."""
    return F.expr(edges_length_sql(edges_col))


def edges_length_sql(edges_col: str) -> str:
    e = _sql(edges_col)
    return (
        f"aggregate({e}, 0D, (a, s) -> a + sqrt((s.x2 - s.x1) * (s.x2 - s.x1)"
        f" + (s.y2 - s.y1) * (s.y2 - s.y1)))"
    )


def edges_area(edges_col: str) -> Column:
    """Area by the shoelace sum over all rings.

    Holes count negative when they wind opposite to their shell, which is
    the convention of shapefile and OGC polygons.
    """
    return F.expr(edges_area_sql(edges_col))


def edges_area_sql(edges_col: str) -> str:
    e = _sql(edges_col)
    return f"abs(aggregate({e}, 0D, (a, s) -> a + (s.x1 * s.y2 - s.x2 * s.y1)) / 2)"


def point(lon: str, lat: str) -> Column:
    """Observation point with its SRID; NULL when a coordinate is missing."""
    return F.when(F.col(lon).isNull() | F.col(lat).isNull(), F.lit(None)).otherwise(
        F.struct(F.col(lon).alias("lon"), F.col(lat).alias("lat"),
                 F.lit(WGS84_SRID).alias("srid"))
    )


# -- exact side of an edge --------------------------------------------------------
#
# Coordinates are decimals (up to 3 + 14 digits: a nanometre on the ground) held
# as doubles. The sign of the cross product is taken from doubles where it is
# beyond any rounding, of the inputs too: with u = 2^-53 and coordinates under 1000,
# that error is under 4u * (1024 * (sum of the four differences) + sum of the two
# products) < 1e-12 * the sum of the differences. What is closer to the edge's
# line is decided in decimals, whose products fit 37 digits. Larger
# coordinates (another planar unit) keep the sign of the doubles.

_NEAR = "1e-12D"
_DECIMAL = "DECIMAL(17, 14)"


def side_sql(x: str, y: str, e: str = "s") -> str:
    """Side of edge ``e`` that point (x, y) lies on: 1 left of the direction
    from its first to its second end, -1 right, 0 on its line."""
    p = f"({e}.x2 - {e}.x1) * ({y} - {e}.y1)"
    q = f"({e}.y2 - {e}.y1) * ({x} - {e}.x1)"
    near = (f"{_NEAR} * (abs({e}.x2 - {e}.x1) + abs({y} - {e}.y1) + abs({e}.y2 - {e}.y1)"
            f" + abs({x} - {e}.x1))")

    def d(v: str) -> str:
        return f"try_cast({v} AS {_DECIMAL})"
    dp = f"({d(e + '.x2')} - {d(e + '.x1')}) * ({d(y)} - {d(e + '.y1')})"
    dq = f"({d(e + '.y2')} - {d(e + '.y1')}) * ({d(x)} - {d(e + '.x1')})"
    return (f"CASE WHEN {p} - {q} > {near} THEN 1 WHEN {q} - {p} > {near} THEN -1 "
            f"WHEN {dp} > {dq} THEN 1 WHEN {dp} < {dq} THEN -1 WHEN {dp} = {dq} THEN 0 "
            f"ELSE CAST(signum({p} - {q}) AS INT) END")


def left_of_sql(x: str, y: str, e: str = "s") -> str:
    """True if (x, y) lies strictly left of where the edge crosses the height
    y; asked only of edges that cross it."""
    return (f"CASE WHEN {x} < least({e}.x1, {e}.x2) THEN true "
            f"WHEN {x} >= greatest({e}.x1, {e}.x2) THEN false "
            f"ELSE {side_sql(x, y, e)} = CASE WHEN {e}.y2 > {e}.y1 THEN 1 ELSE -1 END END")


def on_edge_sql(x: str, y: str, e: str = "s") -> str:
    return (f"{x} BETWEEN least({e}.x1, {e}.x2) AND greatest({e}.x1, {e}.x2) "
            f"AND {y} BETWEEN least({e}.y1, {e}.y2) AND greatest({e}.y1, {e}.y2) "
            f"AND {side_sql(x, y, e)} = 0")


# Only an edge whose box holds the point needs a side; all others are settled by
# comparing coordinates.
_PIP_STEP = """(a, s) ->
            CASE
              WHEN a < 0 OR {y} < least(s.y1, s.y2) OR {y} > greatest(s.y1, s.y2)
                   OR {x} > greatest(s.x1, s.x2) THEN a
              WHEN {on} THEN -1
              WHEN (s.y1 > {y}) <> (s.y2 > {y}) AND {left} THEN a + 1
              ELSE a
            END,
            a -> a > 0 AND a % 2 = 1"""


def _pip_step(x: str, y: str) -> str:
    return _PIP_STEP.format(x=x, y=y, on=on_edge_sql(x, y), left=left_of_sql(x, y))


def within(lon: str, lat: str, edges: str, xmin: str = "xmin", ymin: str = "ymin",
           xmax: str = "xmax", ymax: str = "ymax") -> Column:
    """Strict point-in-polygon over an edge array (even-odd rule).

    One pass: the accumulator counts ray crossings to the right of the point
    and turns negative (sticky) once the point lies on a segment, which
    forces ``false``.
    """
    x, y, e = _sql(lon), _sql(lat), _sql(edges)
    bx0, by0, bx1, by1 = _sql(xmin), _sql(ymin), _sql(xmax), _sql(ymax)
    step = _pip_step(x, y)
    return F.expr(
        f"""CASE
          WHEN {x} IS NULL OR {y} IS NULL OR {e} IS NULL THEN CAST(NULL AS BOOLEAN)
          WHEN size({e}) = 0 OR {x} < {bx0} OR {x} > {bx1} OR {y} < {by0} OR {y} > {by1}
            THEN false
          ELSE aggregate({e}, 0, {step})
        END"""
    )


def band_of(value_sql: str, ymin: str, band_h: str, n_bands: str) -> str:
    """Band index of a y value: floor((y - ymin) / h) clamped to [0, n - 1]
    (monotone in y, so an edge's band range covers every y on it)."""
    return (f"CASE WHEN {band_h} > 0 THEN least(greatest(CAST(floor(({value_sql} - {ymin}) / "
            f"{band_h}) AS INT), 0), {n_bands} - 1) ELSE 0 END")


def within_banded(lon: str, lat: str, bands: str, band_h: str = "band_h",
                  xmin: str = "xmin", ymin: str = "ymin", xmax: str = "xmax",
                  ymax: str = "ymax") -> Column:
    """:func:`within` over a banded edge index (``array<array<edge>>``).

    A horizontal ray from the point only meets edges whose y-span holds the
    point's y, and each edge is stored in every band its span touches, so
    testing the point's own band gives the same answer with ~E / bands work.
    """
    x, y, b = _sql(lon), _sql(lat), _sql(bands)
    bx0, by0, bx1, by1, h = _sql(xmin), _sql(ymin), _sql(xmax), _sql(ymax), _sql(band_h)
    step = _pip_step(x, y)
    idx = band_of(y, by0, h, f"size({b})")
    return F.expr(
        f"""CASE
          WHEN {x} IS NULL OR {y} IS NULL OR {b} IS NULL THEN CAST(NULL AS BOOLEAN)
          WHEN size({b}) = 0 OR {x} < {bx0} OR {x} > {bx1} OR {y} < {by0} OR {y} > {by1}
            THEN false
          ELSE aggregate({b}[{idx}], 0, {step})
        END"""
    )

"""Point-in-polygon: hand cases at the boundaries, then random polygons
against a brute-force ray cast in exact rational arithmetic."""

from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rangewise.functions.geo import edges_area, edges_bbox, edges_length, rings_to_edges, within, wkt_fault, wkt_rings

SQUARE_WITH_HOLE = ("POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))")
TWO_PARTS = "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((5 5, 7 5, 7 7, 5 7, 5 5)))"
L_SHAPE = "POLYGON ((0 0, 60 0, 60 20, 20 20, 20 40, 0 40, 0 0))"


def _flags(spark, rows):
    df = spark.createDataFrame(rows, "wkt string, lon double, lat double")
    g = df.withColumn("rings", wkt_rings("wkt")).withColumn("edges", rings_to_edges("rings"))
    g = g.withColumns(edges_bbox("edges"))
    return [r["f"] for r in g.select(within("lon", "lat", "edges").alias("f")).collect()]


def test_boundary_cases(spark):
    rows = [
        (L_SHAPE, 10.5, 10.5),   # interior
        (L_SHAPE, 40.5, 30.5),   # notch of the L, inside bbox: outside
        (L_SHAPE, 30.0, 0.0),    # on the bottom edge
        (L_SHAPE, 60.0, 20.0),   # on a vertex
        (L_SHAPE, 20.0, 30.0),   # on the inner vertical edge
        (L_SHAPE, -5.0, 20.0),   # left of a horizontal edge, same y: outside
        (L_SHAPE, 10.0, 20.0),   # inside, level with the horizontal edge
        (SQUARE_WITH_HOLE, 5.0, 5.0),   # in the hole
        (SQUARE_WITH_HOLE, 4.0, 5.0),   # on the hole's edge
        (SQUARE_WITH_HOLE, 2.0, 5.0),   # between shell and hole
        (TWO_PARTS, 6.0, 6.0),   # in the second part
        (TWO_PARTS, 3.5, 3.5),   # between the parts (inside bbox)
        (L_SHAPE, 10.0, None),   # NULL latitude
        (None, 10.0, 10.0),      # NULL geometry
        (L_SHAPE, 100.0, 100.0),  # outside the bbox
    ]
    assert _flags(spark, rows) == [True, False, False, False, False, False, True, False, False,
                                   True, True, False, None, None, False]


def test_length_area(spark):
    df = spark.createDataFrame([(L_SHAPE,), (SQUARE_WITH_HOLE,)], "wkt string")
    g = df.withColumn("rings", wkt_rings("wkt")).withColumn("edges", rings_to_edges("rings"))
    out = g.select(edges_length("edges").alias("l"), edges_area("edges").alias("a")).collect()
    assert (out[0]["l"], out[0]["a"]) == (200.0, 1600.0)
    assert out[1]["l"] == 48.0
    # the hole winds the same way as the shell here, so the signed sum adds it
    assert out[1]["a"] in (96.0, 104.0)


def _brute(poly, x, y):
    """Exact even-odd test; None on the boundary."""
    x, y = Fraction(x), Fraction(y)
    inside = False
    n = len(poly)
    for i in range(n):
        (x1, y1), (x2, y2) = poly[i], poly[(i + 1) % n]
        x1, y1, x2, y2 = map(Fraction, (x1, y1, x2, y2))
        if ((x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2)
                and min(y1, y2) <= y <= max(y1, y2)):
            return None
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


coord = st.integers(min_value=-20, max_value=20)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(coord, coord), min_size=3, max_size=8, unique=True),
       st.lists(st.tuples(coord, coord), min_size=5, max_size=20))
def test_random_polygons_against_brute_force(spark, poly, points):
    ring = poly + poly[:1]
    wkt = "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in ring) + "))"
    pts = [(wkt, float(px) + 0.25 * (i % 3), float(py) + 0.5 * (i % 2)) for i, (px, py) in
           enumerate(points)]
    got = _flags(spark, pts)
    for (w, px, py), g in zip(pts, got):
        exp = _brute(poly, px, py)
        assert g == (False if exp is None else exp), (poly, px, py)


def test_banded_equals_full_on_a_grid_with_band_boundaries(spark):
    """Grid points hit band boundaries exactly; a notched polygon with
    negative coordinates and a zero-height polygon; one edge per band."""
    from pyspark.sql import functions as F

    from rangewise.functions.geo import within_banded
    from rangewise.operators.spatial_index import band_index
    from rangewise.sources.layer import build_layer

    src = spark.createDataFrame([
        (1, "POLYGON ((-3 -3, 3 -3, 3 3, -1 0.5, -3 3, -3 -3))"),
        (2, "POLYGON ((0 1, 5 1, 0 1))"),
    ], "id_no int, wkt string")
    geo = build_layer(src).select("geom_row_id", "edges", "xmin", "ymin", "xmax", "ymax")
    g = geo.join(band_index(geo, target_edges=1).select("geom_row_id", "bands", "band_h"),
                 "geom_row_id")
    ids = [r["geom_row_id"] for r in geo.select("geom_row_id").collect()]
    pts = spark.createDataFrame([(i, x / 2.0, y / 4.0) for i in ids
                                 for x in range(-8, 9) for y in range(-16, 17)],
                                "geom_row_id long, lon double, lat double")
    out = pts.join(g, "geom_row_id").select(
        within("lon", "lat", "edges").alias("a"), within_banded("lon", "lat", "bands").alias("b"))
    assert out.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    assert out.filter("a").count() > 0


def test_blanks_of_any_kind_and_number_part_a_vertex(spark):
    """Runs of blanks are folded once a ring, also those that begin a vertex."""
    texts = ["POLYGON ((0 0,\n  4 0,\n\t4\t 4,\r\n0   0))", "POLYGON Z (( 0 0 7,4  0 7 , 4 4 7,0 0 7 ))"]
    df = spark.createDataFrame([(t,) for t in texts], "wkt string")
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)]
    for row in df.select(wkt_rings("wkt").alias("r")).collect():
        assert [[tuple(p) for p in r] for r in row["r"]] == [ring]
    bad = spark.createDataFrame([("POLYGON ((0 0, 4t0, 4 4, 0 0))",), ("POLYGON ((0 0, 4 0n, 4 4, 0 0))",)], "wkt string")
    assert [r[0] for r in bad.select(wkt_fault("wkt")).collect()] == ["vertex"] * 2
    with pytest.raises(Exception, match="malformed polygon text"):
        bad.select(wkt_rings("wkt")).collect()

"""The exact side of an edge, and the adaptive cell index against the full
edge list."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rangewise.functions.geo import side_sql, within
from rangewise.operators import cell_index as C
from rangewise.sources.layer import build_layer


def test_side_is_that_of_the_decimals(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(3000):
        places = rng.choice([1, 2, 4, 7, 12])
        unit = 10 ** places

        def whole():
            return rng.randint(-180 * unit, 180 * unit)
        ax, ay, dx, dy = whole(), whole(), rng.randint(-50, 50), rng.randint(-50, 50)
        n = rng.randint(2, min(900, 10 * unit))
        t = rng.randint(0, n)
        off = rng.choice([0, 0, 1, -1])
        ends = [ax, ay, ax + n * dx, ay + n * dy, ax + t * dx, ay + t * dy + off]
        exact = (ends[2] - ends[0]) * (ends[5] - ends[1]) - (ends[3] - ends[1]) * (ends[4] - ends[0])
        rows.append([float(Fraction(v, unit)) for v in ends] + [(exact > 0) - (exact < 0)])
    df = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double, x double, y double, want int")
    got = df.select(F.struct("x1", "y1", "x2", "y2").alias("s"), "x", "y", "want").select(
        "want", F.expr(side_sql("x", "y")).alias("got"), F.expr(
            "cast(signum((s.x2 - s.x1) * (y - s.y1) - (s.y2 - s.y1) * (x - s.x1)) as int)").alias("plain"))
    assert got.where("want <> got").count() == 0
    assert got.where("want <> plain").count() > 100  # what doubles alone say


def test_side_of_coordinates_beyond_degrees(spark):
    df = spark.createDataFrame([(0.0, 0.0, 5e6, 5e6, 2e6, 3e6), (0.0, 0.0, 5e6, 5e6, 3e6, 3e6)],
                               "x1 double, y1 double, x2 double, y2 double, x double, y double")
    s = F.struct("x1", "y1", "x2", "y2").alias("s")
    assert [r[0] for r in df.select(s, "x", "y").select(F.expr(side_sql("x", "y"))).collect()] == [1, 0]


def star(n, cx, cy, r1, r2, seed):
    """A ring of n vertices with two decimals."""
    import math
    rng = random.Random(seed)
    ring = []
    for k in range(n):
        r = (r1 if k % 2 else r2) * rng.uniform(0.7, 1.0)
        a = 2 * math.pi * k / n
        ring.append((round(cx + r * math.cos(a), 2), round(cy + r * math.sin(a), 2)))
    return "(" + ", ".join(f"{x} {y}" for x, y in ring + ring[:1]) + ")"


SHAPES = [
    f"POLYGON ({star(400, -3, 2, 20, 6, 1)}, {star(60, -3, 2, 3, 2, 2)})",
    f"MULTIPOLYGON (({star(150, 100, 60, 9, 2, 3)}), ({star(150, 90, 70, 9, 2, 4)}))",
    # vertices, sides and a notch on cell borders
    "POLYGON ((0 0, 16 0, 16 16, 8 16, 8 8, 4 8, 4 16, 0 16, 0 0))",
    "POLYGON ((-4 -4, 4 4, 4 -4, -4 4, -4 -4))",  # crosses itself in a corner of cells
    "POLYGON ((0 0, 8 4, 16 0, 16 16, 12 8, 8 16, 4 8, 0 16, 0 0))",
    "POLYGON ((5 5, 5 5, 5 5))", "POLYGON ((1 1, 9 1, 1 1))", "POLYGON EMPTY", None,
]


@pytest.fixture(scope="module")
def geo(spark):
    src = spark.createDataFrame(list(enumerate(SHAPES)), "id_no int, wkt string").withColumn(
        "binomial", F.concat(F.lit("s"), "id_no"))
    out = build_layer(src).select("geom_row_id", F.col("binomial").alias("taxon_name"), "edges",
                                  "xmin", "ymin", "xmax", "ymax")
    return out


@pytest.mark.parametrize("bound,salt", [(1, 5), (4, 200_000), (64, 200_000)])
def test_cells_equal_the_full_edge_list(spark, geo, bound, salt):
    rng = random.Random(bound)
    index = C.cell_index(geo, bound, least_exponent=-6, salt_edges=salt)
    points = [(rng.uniform(-25, 20), rng.uniform(-20, 24)) for _ in range(600)]
    points += [(round(rng.uniform(80, 110), 2), round(rng.uniform(50, 80), 2)) for _ in range(600)]
    points += [(x / 2, y / 2) for x in range(-12, 36) for y in range(-12, 36)]  # borders and corners
    points += [(float("nan"), 1.0), (float("inf"), 1.0), (1.0, float("-inf"))]
    pts = spark.createDataFrame([(k, *p) for k, p in enumerate(points)], "p long, lon double, lat double")
    every = pts.join(geo, F.lit(True)).select("p", "geom_row_id", within("lon", "lat", "edges").alias("want"))
    k = F.pow(F.lit(2.0), "k")
    met = pts.join(index, (F.floor(F.col("lon") / k) == F.col("ix")) & (F.floor(F.col("lat") / k) == F.col("iy")))
    found = met.select("p", "geom_row_id", C.within_cell("lon", "lat").alias("got"))
    assert found.groupBy("p", "geom_row_id").count().where("count > 1").count() == 0  # cells do not overlap
    wrong = every.join(found, ["p", "geom_row_id"], "left").where(
        F.coalesce("want", F.lit(False)) != F.coalesce("got", F.lit(False)))
    assert wrong.collect() == []
    full = index.where((F.size("edges") > bound) & (F.col("k") > -6))
    assert full.count() == 0
    report = {r.taxon_name: r for r in C.cell_report(index).collect()}
    assert set(report) == {f"s{i}" for i in range(7)}
    if bound == 4:
        assert report["s0"].inside_cells > 10 and report["s0"].most_edges <= 4
        # a point of the widest shape meets a handful of edges instead of 460
        tests = met.where("taxon_name = 's0'").agg(F.avg(F.coalesce(F.size("edges"), F.lit(0)))).first()[0]
        assert tests <= 4


def test_index_of_nothing(spark, geo):
    assert C.cell_index(geo.where("false")).count() == 0
    assert C.cell_index(geo.where("edges is null")).count() == 0


def test_batches_of_edges_are_judged_as_by_sql(spark):
    """The array forms of the tests by which edges are dealt to cells."""
    import numpy as np

    rng = np.random.default_rng(9)
    n = 4000
    ends = rng.integers(-24, 25, (4, n)) / rng.choice([1.0, 2.0, 10.0], n)
    at = rng.integers(-24, 25, (4, n)) / rng.choice([1.0, 4.0], n)
    x, y = np.minimum(at[0], at[2]), np.minimum(at[1], at[3])
    right, top = np.maximum(at[0], at[2]), np.maximum(at[1], at[3])
    half = np.arange(n) % 3 == 0  # points halfway along an edge, and beside by one decimal
    x = np.where(half, (ends[0] + ends[2]) / 2, x) + np.where(np.arange(n) % 6 == 0, 1e-13, 0.0)
    y = np.where(half, (ends[1] + ends[3]) / 2, y)
    right, top = np.maximum(x, right), np.maximum(y, top)
    big = np.arange(n) % 50 == 0  # beyond degrees
    e = tuple(np.where(big, v * 1e5, v) for v in ends)
    x, y, right, top = (np.where(big, v * 1e5, v) for v in (x, y, right, top))
    df = spark.createDataFrame(
        [(i, *map(float, r)) for i, r in enumerate(zip(*e, x, y, right, top))],
        "i int, x1 double, y1 double, x2 double, y2 double, x double, y double, r double, t double")
    rows = df.select("i", F.struct("x1", "y1", "x2", "y2").alias("s"), "x", "y", "r", "t").select(
        F.expr(side_sql("x", "y")), F.expr(C.changes_sql("x", "y", "r", "t")), "i").orderBy("i").collect()
    sides = C.side(x, y, e)
    assert sides.tolist() == [r[0] for r in rows] and (sides == 0).sum() > 100
    assert C.changes(x, y, right, top, e).tolist() == [r[1] for r in rows]
    meets = C.touches(x, y, right, top, e)
    inside = (x <= e[0]) & (e[0] <= right) & (y <= e[1]) & (e[1] <= top)
    apart = (np.maximum(e[0], e[2]) < x) | (np.minimum(e[1], e[3]) > top)
    assert meets[inside].all() and not meets[apart].any() and inside.any() and apart.any()


def test_edges_are_dealt_without_a_row_for_every_child(spark):
    """What is interpreted or repeated for each edge and child was nine tenths of the time."""
    geo = build_layer(spark.createDataFrame(
        [(1, "a", f"POLYGON ({star(300, 0, 0, 5, 9, 3)})")], "geom_row_id long, binomial string, wkt string"))
    geo = geo.withColumnRenamed("binomial", "taxon_name")
    cells, edges = C._roots(geo, C.LEAST_EXPONENT)
    made = []
    write = C.written

    def kept(df, name):
        made.append(df._jdf.queryExecution().toString())
        return write(df, name)
    C.written = kept
    try:
        C._divided(cells.where("n > 64"), edges, C.SALT_EDGES)
    finally:
        C.written = write
    dealt = made[0].split("== Physical Plan ==")[1]
    assert "MapInArrow" in dealt and "transform(" not in dealt and "explode(array(named_struct" not in dealt


def test_the_layer_is_read_once_for_the_cells(spark, monkeypatch):
    """Index and flag of the cell path read the geometry from one written copy."""
    from rangewise.operators import observations
    from rangewise.sources.fixtures import raw_tables
    from rangewise.operators.taxa import explode_ancestry

    read = []
    index = observations.cell_index
    monkeypatch.setattr(observations, "cell_index", lambda geo, bound: read.append(geo) or index(geo, bound))
    raw = raw_tables(spark, "/root/testdata/sf0.001")
    observations.species_observations(raw.observations_raw, explode_ancestry(raw.taxa_raw),
                                      raw.species_geospatial_raw, force_shuffle=True, with_point=False)
    assert all("cells-geometry" in f for f in read[0].inputFiles())

"""Loads are lossless or loud: polygon text, escaped TSV, simplification, scratch."""

import math
import re

import pytest
from pyspark.sql import functions as F

from rangewise import session
from rangewise.functions.geo import wkt_rings
from rangewise.operators.observations import species_observations
from rangewise.plans.model import build
from rangewise.sources.layer import build_layer
from rangewise.sources.tsv import read_escaped_tsv, write_escaped_tsv

GOOD = {
    "POLYGON ((0 0, 1 0, 1 1, 0 0))": [4],
    "polygon((0 0,1 0,1 1,0 0),(0.1 .1, 2e-1 +0.1, -0.2 0.2))": [4, 3],
    "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5),(5 5,6 5,6 6)))": [4, 4, 3],
    "POLYGONZ ((0 0 9, 1 0 9, 1 1 9, 0 0 9))": [4], "POLYGON ZM((0 0 9 8, 1 0 9 8))": [2],
    "  MULTIPOLYGON M (((0 0 1, 2 2 2)))  ": [2], "POLYGON EMPTY": [], None: None,
}
BAD = ["POLYGON ((0 0, abc 0, 4 4, 0 4, 0 0))", "NOT A GEOMETRY", "POLYGON ((0 0 1, 1 1 1))",
       "POINT (1 2)", "POLYGON ((0 0, 1 1)", "POLYGON (0 0, 1 1)", "MULTIPOLYGON ((0 0, 1 1))",
       "POLYGON ((0 0, 1 1)) x", "", "POLYGON Z ((0 0, 1 1))", "POLYGON ((0 0,, 1 1))",
       "POLYGON ((NaN 0, 1 1))", "POLYGON", "POLYGON ((0 0, 1 1) (0 0, 1 1))", "POLYGON ()"]


def test_polygon_text(spark):
    df = spark.createDataFrame([(w,) for w in GOOD], "w string")
    got = {r.w: None if r.r is None else [len(x) for x in r.r]
           for r in df.select("w", wkt_rings("w").alias("r")).collect()}
    assert got == GOOD


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_polygon_text_fails(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for w in BAD:
            with pytest.raises(Exception, match="malformed polygon text"):
                spark.createDataFrame([(w,)], "w string").select(wkt_rings("w")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_tsv_keeps_control_characters(spark, tmp_dir):
    rows = [(k, s) for k, s in enumerate(
        ["\x01", "\x02", "\x010", "\x011\x012", "a\tb\\c\nd", "\\", "\\N", "\\\\N", "\t", "\n", "", None,
         "\x01\\\t\x01\n", "\r", "x\\"])]
    df = spark.createDataFrame(rows, "k int, s string")
    write_escaped_tsv(df, tmp_dir + "/t")
    assert sorted(map(tuple, read_escaped_tsv(spark, tmp_dir + "/t", df.schema).collect())) == sorted(rows)


def _ring(n, cx=0.0):
    pts = [(round(cx + math.cos(2 * math.pi * i / n), 6), round(math.sin(2 * math.pi * i / n), 6))
           for i in range(n - 1)]
    return "(" + ", ".join(f"{x} {y}" for x, y in [*pts, pts[0]]) + ")"


def test_automatic_simplification_counts_small_rings_and_is_loud(spark):
    many = "MULTIPOLYGON (" + ", ".join(f"({_ring(50, 3.0 * k)})" for k in range(20)) + ")"
    big = 9007199254740993
    src = spark.createDataFrame([(1, many, big), (2, "POLYGON EMPTY", None), (3, None, None)],
                                "id_no int, wkt string, generalised long")
    rows = {r.id_no: r for r in build_layer(src, simplify_max_vertices=200).collect()}
    plain = {r.id_no: r for r in build_layer(src).collect()}
    assert sum(map(len, rows[1].rings)) <= 200 < sum(map(len, plain[1].rings))
    assert rows[1].generalised == big and rows[1].geom_bytes < plain[1].geom_bytes
    assert rows[2].rings == [] and rows[3].rings is None
    with pytest.raises(Exception, match="cannot be simplified to 50"):
        build_layer(src, simplify_max_vertices=50).collect()


def test_no_private_scratch_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir is not set"):
        session.shared_dir(Session())


def test_scratch_is_cleared(spark):
    import os
    path = session.scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    others = tuple(p for p in session._SCRATCH if p != path)
    assert os.path.exists(local) and session.clear_scratch(spark, keep=others) == 1
    assert not os.path.exists(local)


def test_band_path_plans_without_a_job_and_without_a_name_join(spark):
    w = build(spark, "/root/testdata/sf0.001")
    taxa, layer, obs = w.taxa, w.raw.species_geospatial_raw, w.raw.observations_raw
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("band-plan", "")
    fact = species_observations(obs, taxa, layer, geometry_fits=False, band_edges=32,
                                band_height=1.0)
    assert not tracker.getJobIdsForGroup("band-plan")
    spark.sparkContext.setJobGroup("rest", "")
    fact.collect()
    final = fact._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("lineitem.parquet") <= 2  # hot keys are counted once for both sides
    for keys in re.findall(r"SortMergeJoin \[([^\]]*)\]", final):
        assert "taxon_name" not in keys


def test_index_growth_is_bounded(spark):
    from rangewise.operators.spatial_index import INDEX_GROWTH, band_index
    zigzag = [(i * 0.1, 100.0 * (i % 2)) for i in range(200)]
    wkt = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in [*zigzag, (19.9, -1), (0, -1), zigzag[0]]) + "))"
    layer = build_layer(spark.createDataFrame([(1, wkt), (2, "POLYGON ((" + _ring(400)[1:] + ")")],
                                              "id_no int, wkt string"))
    for r in band_index(layer.select("geom_row_id", "edges", "xmin", "ymin", "xmax", "ymax"), 8).withColumn(
            "n", F.expr("aggregate(bands, 0, (a, b) -> a + size(b))")).collect():
        edges = len(layer.where(F.col("geom_row_id") == r.geom_row_id).first().edges)
        assert r.n <= INDEX_GROWTH * edges

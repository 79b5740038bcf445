"""Geometry rows divided whole in a task: the cells of rounds."""

import random

import pytest
from pyspark.sql import functions as F

from rangewise.operators import cell_index as C
from rangewise.sources.layer import build_layer

BOX = "POLYGON ((0 0, 8 0, 8 8, 0 8, 0 0))"


def _geo(spark, texts):
    rows = [(k, f"s{k}", t) for k, t in texts]
    return build_layer(spark.createDataFrame(rows, "geom_row_id long, binomial string, wkt string")).select(
        "geom_row_id", F.col("binomial").alias("taxon_name"), "edges", "xmin", "ymin", "xmax", "ymax")


def _cells(index):
    return sorted((r.taxon_name, r.geom_row_id, r.k, r.ix, r.iy, r.ref, None if r.edges is None else
                   sorted(map(tuple, r.edges))) for r in index.collect())


def _star(n, rng):
    from math import cos, pi, sin
    v = [(rng.uniform(3, 9) * cos(2 * pi * i / n), rng.uniform(3, 9) * sin(2 * pi * i / n)) for i in range(n)]
    return "POLYGON ((" + ", ".join(f"{x:.4f} {y:.4f}" for x, y in [*v, v[0]]) + "))"


def _shapes():
    rng = random.Random(7)
    return [*enumerate([_star(90, rng), _star(7, rng), BOX, "POLYGON ((0 0, 16 0, 16 16, 8 16, 8 8, 4 8, 4 16, 0 16, 0 0))",
                        "POLYGON ((-4 -4, 4 4, 4 -4, -4 4, -4 -4))", "POLYGON ((5 5, 5 5))", "POLYGON EMPTY", None])]


@pytest.mark.parametrize("bound", [2, 16])
def test_rows_divided_whole_have_the_cells_of_rounds(spark, bound, monkeypatch):
    geo = _geo(spark, _shapes()).localCheckpoint()
    made = []
    write = C.written
    monkeypatch.setattr(C, "written", lambda df, name: made.append(name) or write(df, name))
    whole = _cells(C.cell_index(geo, bound, least_exponent=-4))
    assert made == ["shared", "whole"]  # no round
    rounds = _cells(C.cell_index(geo, bound, least_exponent=-4, whole_edges=0))
    some = _cells(C.cell_index(geo, bound, least_exponent=-4, whole_edges=50))
    assert whole == rounds == some and len(whole) > 30
    # rows under one key are one geometry, as in rounds
    twice = _geo(spark, [*_shapes(), (0, BOX), (2, BOX)])
    assert _cells(C.cell_index(twice, bound, least_exponent=-4)) == _cells(
        C.cell_index(twice, bound, least_exponent=-4, whole_edges=0))

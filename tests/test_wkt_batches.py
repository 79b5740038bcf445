"""Polygon text read in batches: the rows, and the refusals, of the expression."""

import random

import pyarrow as pa
import pytest

from rangewise.sources import fixtures, wkt_batches
from rangewise.sources.layer import build_layer

BOX = "POLYGON ((0 0, 8 0, 8 8, 0 8, 0 0))"


def _number(rng):
    return rng.choice([str(rng.randint(-180, 180)), repr(rng.uniform(-180, 180)), f"{rng.uniform(-1, 1):.3e}", "1.",
                       "-.5", "+5", "2.E+1", "12345678901234567890.123456789012345678"])


def _ring(rng, d):
    vertices = [" ".join(_number(rng) for _ in range(d)) for _ in range(rng.randint(1, 6))]
    vertices += vertices[:1] if rng.random() < 0.7 else []
    return "(" + rng.choice(["", " "]) + rng.choice([",", ", ", " ,  "]).join(vertices) + rng.choice(["", " "]) + ")"


def _text(rng):
    d, tag = rng.choice([(2, ""), (2, ""), (3, " Z"), (3, "M"), (4, " ZM")])

    def polygon():
        return "(" + rng.choice([", ", ","]).join(_ring(rng, d) for _ in range(rng.randint(1, 3))) + ")"
    if rng.random() < 0.4:
        return f"MULTIPOLYGON{tag} (" + ", ".join(polygon() for _ in range(rng.randint(1, 3))) + ")"
    return rng.choice(["POLYGON", "Polygon", " polygon"]) + tag + rng.choice(["", " ", "  "]) + polygon()


def test_texts_read_in_batches_are_those_of_the_expression(spark):
    rng = random.Random(4)
    odd = [None, "POLYGON EMPTY", "MULTIPOLYGON Z EMPTY", BOX + " ", "POLYGON ((0 0,\t1 0, 1 1))"]
    rows = list(enumerate([*(_text(rng) for _ in range(700)), *odd]))
    src = spark.createDataFrame(rows, "geom_row_id long, wkt string").repartition(3)
    plain, batches = build_layer(src), build_layer(src, in_batches=True)
    assert plain.schema == batches.schema
    want = {r.geom_row_id: r for r in plain.collect()}
    got = {r.geom_row_id: r for r in batches.collect()}
    assert [(want[k], got.get(k)) for k in want if str(want[k]) != str(got.get(k))] == []
    read = wkt_batches.read_in_batches(src, "wkt")
    assert {r.geom_row_id for r in read.where("NOT _read").collect()} == {700 + k for k in range(len(odd))}
    assert read.where("_read AND wkt IS NOT NULL").isEmpty()


@pytest.mark.parametrize("text", [
    "POLYGN ((0 0, 1 0, 1 1))", "POLYGON ((0 0, 1 0, 1 1)", "POLYGON ((0 0, 7 1 0, 1 1))", "POLYGON ((0 0, 1 o, 1 1))",
    "POLYGON ((0 0,, 1 0, 1 1))", "POLYGON ((0 0, 1 0, 1 1)5)", "POLYGON ((0 0, 1 0 1, 1))", "POLYGON (0 0, 1 0)",
    "POLYGON ((0 0, 1 0, 1 1,))", "POLYGON ((0 0, 1-2 0, 1 1))", "POLYGON (())", "POLYGON ((,0 0))", "POLYGON ((0 0)) x",
    "MULTIPOLYGON ((0 0, 1 1, 2 0))", "POLYGON 5((0 0, 1 1))", "POLYGON ((0 0, 1 1), )", "POLYGON ((0 0), (1 1)(2 2))",
    "POLYGON ((0 0 1 1, 2, 0))", "POLYGON ((0 0), 5 (2 2))", "POLYGON ((0 0, . 1))", "POLYGON ((0 0, 1e 1))",
    "POLYGON Z ((0 0, 1 1))", "POLYGON ((1.2.3 0, 1 1))"])
def test_a_faulty_text_is_not_read_in_a_batch(text):
    texts = pa.array([BOX, text, BOX])
    read = [(int(at[k])) for multi, d, at in wkt_batches.tagged(texts)
            for k in wkt_batches.parsed(texts.take(pa.array(at)), multi, d)[0]]
    assert 1 not in read


def test_a_faulty_text_fails_the_load_in_batches(spark):
    src = spark.createDataFrame([(1, BOX), (2, "POLYGON ((0 0, 1 0, 1 1,))")], "geom_row_id long, wkt string")
    with pytest.raises(Exception, match="malformed polygon text"):
        build_layer(src, in_batches=True).collect()


def test_case_layer_is_read_in_batches(spark, tmp_path, monkeypatch):
    """Interpreted for every vertex, making and reading its text was a third and more of the time."""
    from rangewise.plans import jobs

    plans = []
    build = jobs.build_layer
    monkeypatch.setattr(jobs, "build_layer", lambda *a, **b: plans.append(build(*a, **b)) or plans[-1])
    jobs.geometry_cases(spark, "/root/testdata/sf0.001")
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan


def test_case_text_is_that_of_vertex_by_vertex(spark, tmp_path):
    keys = [5, 11, 2, 3, 4, 6, 7, 20_003, 20_009]
    spark.createDataFrame([(k, "b", "t", 1) for k in keys], "p_partkey long, p_brand string, p_type string, p_size int") \
        .write.parquet(f"{tmp_path}/part.parquet")
    n = fixtures.CASE_SIDE_VERTICES
    step = f"cast(i AS double) * 10 / {n}"
    sides = ", ".join(f"transform(sequence(0, {n - 1}), i -> concat({x}, ' ', {y}))" for x, y in (
        (f"x0 + {step}", "y0"), ("x0 + 10", f"y0 + {step}"), (f"x0 + 10 - {step}", "y0 + 10"), ("x0", f"y0 + 10 - {step}")))
    want = spark.createDataFrame([(k,) for k in keys if k % 6 == 5], "p long").selectExpr(
        "p", "p * 7 % 40 - 20 AS x0", "p * 11 % 30 - 15 AS y0").selectExpr(
        "p", f"concat('POLYGON ((', concat_ws(', ', {sides}, concat(x0, ' ', y0)), '))') AS wkt")
    got = fixtures.case_layer_source(spark, str(tmp_path)).where("geom_row_id % 6 = 5").select("geom_row_id", "wkt")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 4

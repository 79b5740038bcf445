"""Binary polygon layers: round trip, any cuts, format features, corrupt files."""

import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from rangewise.sources.layer import build_layer
from rangewise.sources.polygon_files import read_layer, read_polygons, records, write_polygons

WKT = ["POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))",
       "MULTIPOLYGON (((0.1 0.2, 2.5 0, 2 2, 0.1 0.2)), ((5 5, 7 5, 7 7, 5 5)))", None, "POLYGON EMPTY",
       "POLYGON ((" + ", ".join(f"{x} {x * x}" for x in range(300)) + ", 0 0))"]


@pytest.fixture
def layer(spark):
    rnd = random.Random(3)
    rows = [(k, rnd.choice(["Rana", "Bufo  b", None, "Čolek", ""]), rnd.choice(WKT)) for k in range(60)]
    return build_layer(spark.createDataFrame(rows, "id_no int, binomial string, wkt string").coalesce(2))


def written(df, folder):
    return write_polygons(df.select("id_no", "binomial", "rings"), folder).collect()


def test_round_trip_equals_the_text_layer(spark, layer, tmp_dir):
    trios = written(layer, tmp_dir)
    assert sum(r.records for r in trios) == 60
    back = build_layer(read_layer(spark, tmp_dir, range_bytes=3000), rings_col="rings")
    skipped = {"geom_row_id", "geom_bytes", "binomial"}
    same = [c for c in layer.columns if c not in skipped]
    name = F.nullif(F.col("binomial"), F.lit("")).alias("binomial")  # the format has no empty text
    a, b = (d.select(*[F.to_json(F.struct(c)).alias(c) for c in same], name) for d in (layer, back))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    bound = back.where("rings is not null").select(F.expr("geom_bytes >= 64 + 48 * size(edges)").alias("ok"))
    assert {r.ok for r in bound.collect()} == {True}


def test_every_cut_gives_each_record_once(layer, tmp_dir):
    stem = written(layer.coalesce(1), tmp_dir)[0].path
    size = os.path.getsize(stem + ".shp")
    for step, block in ((1_000_000, 4 << 20), (997, 100), (3000, 1)):
        got = [n for s in range(0, size, step)
               for b in records(stem, s, s + step, ["id_no", "binomial"], "utf-8", block)
               for n in b.column("record").to_pylist()]
        assert got == list(range(1, 61))


def test_one_file_other_encoding_and_measures(spark, tmp_dir):
    """A trio made by hand: Latin-1 text, a Z shape, a null shape."""
    ring = [0.0, 0.0, 1.0, 0.0, 1.0, 1.0, 0.0, 0.0]
    z = struct.pack("<i4dii", 15, 0, 0, 1, 1, 1, 4) + struct.pack("<i", 0) + struct.pack("<8d", *ring) \
        + struct.pack("<2d4d", 0, 9, 0, 3, 6, 9)
    contents, at, shp, shx = [z, struct.pack("<i", 0)], 100, b"", b""
    for k, c in enumerate(contents, 1):
        shx += struct.pack(">ii", at // 2, len(c) // 2)
        shp += struct.pack(">ii", k, len(c) // 2) + c
        at += 8 + len(c)
    head = struct.pack(">i20xi", 9994, at // 2) + struct.pack("<ii8d", 1000, 15, 0, 0, 1, 1, 0, 9, 0, 0)
    field = struct.pack("<11sc4xB15x", b"BINOMIAL", b"C", 6)
    dbf = struct.pack("<B3BIHH20x", 3, 95, 1, 1, 2, 65, 7) + field + b"\r" + " Ção   \0\0\0\0\0\0".encode("latin-1").ljust(14) + b"\x1a"
    dbf = dbf[:65] + b" " + "Ção".encode("latin-1").ljust(6) + b" " + b"\0" * 6 + b"\x1a"
    for name, data in ((".shp", head + shp), (".shx", head[:24] + head[24:] + shx), (".dbf", dbf)):
        with open(os.path.join(tmp_dir, "one" + name), "wb") as f:
            f.write(data)
    got = read_polygons(spark, os.path.join(tmp_dir, "one.shp"), encoding="latin-1").orderBy("record").collect()
    assert [(r.record, r.binomial) for r in got] == [(1, "Ção"), (2, None)]
    assert [tuple(v) for v in got[0].rings[0]] == list(zip(ring[::2], ring[1::2])) and got[1].rings is None


@pytest.mark.parametrize("part,at,value,why", [
    (".shp", 100, struct.pack(">i", 7), "number 7"),
    (".shp", 104, struct.pack(">i", 2), "bytes, where the index says"),
    (".shp", 108, struct.pack("<i", 3), "shape type 3"),
    (".shp", 144, struct.pack("<i", 10_000), "do not fit"),
    (".shp", 152, struct.pack("<i", 5), "out of order"),
    (".shx", 100, struct.pack(">i", 90_000), "out of order|cut short|number|no whole"),
    (".dbf", 97, b"*", "deleted"),
    (".dbf", 4, struct.pack("<I", 3), "attribute rows"),
    (".shp", 0, b"\0", None), (".shp", 0, struct.pack(">i", 1), "no whole shape file"),
])
def test_corrupt_files_fail(spark, tmp_dir, part, at, value, why):
    src = build_layer(spark.createDataFrame([(k, "a", WKT[0]) for k in range(4)],
                                            "id_no int, binomial string, wkt string").coalesce(1))
    stem = written(src, tmp_dir)[0].path
    with open(stem + part, "r+b") as f:
        f.seek(at)
        f.write(value)
    if why is None:
        assert read_polygons(spark, tmp_dir).count() == 4
        return
    with pytest.raises(Exception, match=why):
        read_polygons(spark, tmp_dir).collect()


def test_cut_or_missing_files_fail(spark, tmp_dir):
    src = build_layer(spark.createDataFrame([(1, "a", WKT[0])], "id_no int, binomial string, wkt string"))
    stem = written(src.coalesce(1), tmp_dir)[0].path
    with open(stem + ".shp", "r+b") as f:
        f.truncate(150)
    with pytest.raises(Exception, match="no whole shape file"):
        read_polygons(spark, tmp_dir)
    os.rename(stem + ".shx", stem + ".other")
    with pytest.raises(Exception, match="has no .shx"):
        read_polygons(spark, tmp_dir)


def test_long_texts_and_clashing_names_are_refused(spark, tmp_dir):
    rows = spark.createDataFrame([("x" * 255,)], "binomial string").withColumn(
        "rings", F.lit(None).cast("array<array<struct<x:double,y:double>>>"))
    with pytest.raises(Exception, match="beyond the format"):
        write_polygons(rows, tmp_dir).collect()
    with pytest.raises(Exception, match="not distinct"):
        write_polygons(rows.selectExpr("binomial as a123456789x", "binomial as a123456789y", "rings"), tmp_dir)

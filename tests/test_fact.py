"""Fact build: several ranges per species, duplicates, NULLs, dropped species,
and the salted shuffle path agreeing with the broadcast path."""

import datetime as dt

from rangewise.operators.observations import species_observations
from rangewise.operators.observers import observers_first_seen
from rangewise.operators.ranges import species_ranges
from rangewise.operators.taxa import explode_ancestry
from rangewise.schemas import OBSERVATIONS_RAW, OBSERVERS_RAW, TAXA_RAW
from rangewise.sources.fixtures import ClassScope
from rangewise.sources.layer import build_layer

SCOPE = ClassScope(class_id=1001, path_prefix="48460/1001", ancestors=(48460,))
D = dt.date(2000, 1, 1)


def _world(spark):
    taxa_raw = spark.createDataFrame([
        (48460, "", 100.0, "stateofmatter", "Life", True),
        (1001, "48460", 50.0, "class", "C", True),
        (10, "48460/1001", 10.0, "species", "sp_a", True),
        (11, "48460/1001", 10.0, "species", "sp_b", True),
        (12, "48460/1001", 10.0, "species", "sp_nogeo", True),
        (13, "48460/1001", 10.0, "species", "sp_dup", True),
        (14, "48460/1001", 10.0, "species", "sp_dup", True),  # duplicate name
    ], TAXA_RAW)
    layer_src = spark.createDataFrame([
        (1, "sp_a", "DD", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"),
        (1, "sp_a", "DD", "POLYGON ((20 20, 30 20, 30 30, 20 30, 20 20))"),
        (2, "sp_b", "XX", None),  # NULL geometry row
        (2, "sp_b", "XX", "POLYGON ((0 0, 1 0, 1 1, 0 0))"),
        (3, "sp_dup", "LC", "POLYGON ((0 0, 5 0, 5 5, 0 5, 0 0))"),
    ], "id_no int, binomial string, category string, wkt string")
    obs = spark.createDataFrame([
        ("u1", 1, 5.0, 5.0, 3, 10, "research", D),     # in first range
        ("u2", 1, 25.0, 25.0, 3, 10, "research", D),   # in second range
        ("u3", 2, 50.0, 50.0, 3, 10, "casual", D),     # in none
        ("u3", 2, 50.0, 50.0, 3, 10, "casual", D),     # exact duplicate
        ("u4", 2, 0.5, 0.5, 3, 11, "needs_id", D),     # NULL row + false row -> false
        ("u5", 3, None, 0.5, 3, 10, "casual", None),   # NULL latitude, NULL date
        (None, 3, 1.0, 1.0, 3, 10, "casual", D),       # NULL uuid: dropped
        ("u6", 3, 1.0, 1.0, 3, 12, "casual", D),       # species without geometry: dropped
        ("u7", 4, 1.0, 1.0, 3, 13, "casual", D),       # duplicate species name
    ], OBSERVATIONS_RAW)
    taxa = explode_ancestry(taxa_raw, SCOPE)
    layer = build_layer(layer_src)
    return taxa, layer, obs


def test_flags_and_rows(spark):
    taxa, layer, obs = _world(spark)
    fact = species_observations(obs, taxa, layer, SCOPE)
    got = {r["observation_uuid"]: r["observed_in_known_area"] for r in fact.collect()}
    assert got == {"u1": True, "u2": True, "u3": False, "u4": False, "u5": None, "u7": True}
    assert fact.count() == 6  # duplicate collapsed, NULL uuid and no-geometry species dropped
    r = fact.filter("observation_uuid = 'u5'").first()
    assert r["observation_geom_point"] is None and r["observation_date"] is None


def test_salted_shuffle_path_matches(spark):
    taxa, layer, obs = _world(spark)
    a = species_observations(obs, taxa, layer, SCOPE)
    b = species_observations(obs, taxa, layer, SCOPE, force_shuffle=True)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_salting_spreads_a_hot_key(spark):
    from pyspark.sql import functions as F
    from rangewise.operators.joins import salted_join_keys
    big = spark.range(0, 5000).select(F.lit("hot").alias("k"), F.col("id"))
    small = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    b, s = salted_join_keys(big, small, "k", F.col("id"), target_rows=1000)
    assert b.select("_salt").distinct().count() == 5
    assert s.filter("k = 'hot'").count() == 5 and s.filter("k = 'cold'").count() == 1
    assert b.join(s, ["k", "_salt"]).count() == 5000  # every row meets its partner once


def test_ranges_categories_and_fanout(spark):
    taxa, layer, _ = _world(spark)
    rows = species_ranges(layer, taxa, SCOPE, with_geometry=False).collect()
    names = {(r["iucn_id"], r["taxon_id"]): r["iucn_category_name"] for r in rows}
    assert names[(1, 10)] == "data deficient"
    assert names[(2, 11)] is None  # unknown code
    assert {t for (i, t) in names if i == 3} == {13, 14}  # duplicate name fans out
    assert len(rows) == 6


def test_observers_first_seen(spark):
    taxa, layer, obs = _world(spark)
    fact = species_observations(obs, taxa, layer, SCOPE)
    observers = spark.createDataFrame([(1, "a", "A"), (2, "b", "B"), (3, "c", "C"), (9, "z", "Z"),
                                       (1, "a", "A")], OBSERVERS_RAW)
    out = {r["observer_id"]: r["first_observation_date"]
           for r in observers_first_seen(observers, fact).collect()}
    # observer 9 has no fact row; the duplicate raw row of observer 1 collapses;
    # observer 3's only fact row has no date, so the first date is NULL
    assert out == {1: D, 2: D, 3: None}


def test_banded_index_matches_full_edge_lists(spark):
    """Large random polygons: the banded test equals the full-edge test."""
    import math
    import random

    from rangewise.schemas import OBSERVATIONS_RAW as OBS

    rnd = random.Random(11)
    wkts, obs, first_vertex = [], [], None
    for s_id, name in ((10, "sp_a"), (11, "sp_b")):
        for k in range(3):
            n = rnd.randint(40, 90)
            cx, cy = rnd.uniform(-20, 20), rnd.uniform(-20, 20)
            pts = []
            for i in range(n):  # a star-shaped, very non-convex ring
                a = 2 * math.pi * i / n
                r = rnd.uniform(2, 12)
                pts.append((round(cx + r * math.cos(a), 3), round(cy + r * math.sin(a), 3)))
            pts.append(pts[0])
            first_vertex = first_vertex or pts[0]
            wkts.append((s_id, name, "DD", "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in pts) + "))"))
        for i in range(300):
            obs.append((f"{name}-{i}", 1, rnd.uniform(-35, 35), rnd.uniform(-35, 35), 1, s_id,
                        "research", D))
    # a point exactly on a vertex of the first polygon: not within
    obs.append(("vertex", 1, first_vertex[1], first_vertex[0], 1, 10, "research", D))
    taxa, _, _ = _world(spark)
    layer = build_layer(spark.createDataFrame(
        wkts, "id_no int, binomial string, category string, wkt string"))
    o = spark.createDataFrame(obs, OBS)
    full = species_observations(o, taxa, layer, SCOPE)
    banded = species_observations(o, taxa, layer, SCOPE, band_edges=4)
    # the path of a layer too large to broadcast: bands through a salted shuffle
    banded_shuffled = species_observations(o, taxa, layer, SCOPE, band_edges=4,
                                           force_shuffle=True, salt_target_rows=50)
    a = {r["observation_uuid"]: r["observed_in_known_area"] for r in full.collect()}
    b = {r["observation_uuid"]: r["observed_in_known_area"] for r in banded.collect()}
    c = {r["observation_uuid"]: r["observed_in_known_area"] for r in banded_shuffled.collect()}
    assert a == b == c and len(a) == 601
    assert a["vertex"] is False and 0 < sum(a.values()) < 600


def test_hot_species_salted_equals_broadcast(spark):
    """One species holding most rows: the salted shuffle join spreads it and
    still gives the broadcast join's answer."""
    from rangewise.schemas import OBSERVATIONS_RAW as OBS

    taxa, layer, _ = _world(spark)
    rows = [(f"h{i}", i % 7, float(i % 40) - 5.5, float(i % 30) - 2.5, 1, 10, "research", D)
            for i in range(3000)]
    rows += [(f"c{i}", 1, 0.25, 0.25, 1, 11, "casual", D) for i in range(20)]
    obs = spark.createDataFrame(rows, OBS)
    a = species_observations(obs, taxa, layer, SCOPE)
    b = species_observations(obs, taxa, layer, SCOPE, force_shuffle=True, salt_target_rows=200)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan  # only the bounded hot-key list is broadcast


def test_refresh_registers_tables(spark, tmp_dir):
    from rangewise.plans.refresh import refresh
    from rangewise.sources.fixtures import raw_tables

    res = refresh(spark, raw_tables(spark, "/root/testdata/sf0.001"), root=tmp_dir + "/wh",
                  register=True)
    assert {r["table_name"] for r in res.production_checks} == {
        "taxa", "species_geospatial", "observers", "species_observations"}
    n = spark.sql("SELECT count(*) AS n FROM production.species_observations").first()["n"]
    assert n == next(r["records"] for r in res.production_checks
                     if r["table_name"] == "species_observations")
    props = {r["key"]: r["value"] for r in
             spark.sql("SHOW TBLPROPERTIES staging.observations_raw").collect()}
    assert props.get("primary_key") == "observation_uuid"


def test_band_partitioned_join_on_fixture(spark):
    """The shuffle path (layer too large to broadcast) gives the broadcast
    path's fact on the driver-derived fixture, at several band heights."""
    from rangewise.plans.model import build

    w = build(spark, "/root/testdata/sf0.001")
    raw, taxa = w.raw, w.taxa
    a = sorted(map(tuple, species_observations(
        raw.observations_raw, taxa, raw.species_geospatial_raw, with_point=False).collect()))
    for h in (0.5, 7.0, 100.0):
        b = sorted(map(tuple, species_observations(
            raw.observations_raw, taxa, raw.species_geospatial_raw, with_point=False,
            force_shuffle=True, band_height=h, salt_target_rows=20).collect()))
        assert a == b, h


def test_written_tables_follow_the_declared_schemas(spark, tmp_dir):
    from rangewise.plans.refresh import refresh
    from rangewise.schemas import SCHEMAS
    from rangewise.sources.fixtures import raw_tables

    root = refresh(spark, raw_tables(spark, "/root/testdata/sf0.001"), root=tmp_dir + "/wh").root
    for (layer, name), schema in SCHEMAS.items():
        got = spark.read.parquet(f"{root}/{layer}/{name}").schema
        assert [(f.name, f.dataType) for f in got.fields] == \
            [(f.name, f.dataType) for f in schema.fields], (layer, name)


def test_hot_observer_first_seen(spark):
    """One observer holds a third of the fact: the per-observer fold happens
    map-side and the first date is still exact."""
    import datetime as dt2

    from rangewise.schemas import OBSERVERS_RAW, SPECIES_OBSERVATIONS

    rows = []
    for i in range(3000):
        obs_id = 1 if i % 3 == 0 else 2 + i % 50
        day = dt2.date(2000, 1, 1) + dt2.timedelta(days=(i * 7) % 400)
        rows.append((f"u{i}", obs_id, 0.0, 0.0, 1.0, 10, "casual", day, None, False))
    fact = spark.createDataFrame(rows, SPECIES_OBSERVATIONS).repartition(8)
    observers = spark.createDataFrame([(k, f"l{k}", f"n{k}") for k in range(1, 60)], OBSERVERS_RAW)
    got = {r["observer_id"]: r["first_observation_date"]
           for r in observers_first_seen(observers, fact).collect()}
    expected = {}
    for r in rows:
        expected[r[1]] = min(expected.get(r[1], r[7]), r[7])
    assert got == expected

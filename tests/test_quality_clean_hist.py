"""Quality gates, column cleaning, histogram bins, ring simplification."""

import numpy as np
import pytest

from rangewise.operators import quality
from rangewise.operators.clean import clean, profile
from rangewise.operators.histogram import histogram
from rangewise.schemas import OBSERVERS_RAW, STAGING
from rangewise.sources.layer import _douglas_peucker


def test_gates(spark):
    ok = spark.createDataFrame([(1, "a", "b")], OBSERVERS_RAW)
    empty = spark.createDataFrame([], OBSERVERS_RAW)
    nullkey = spark.createDataFrame([(None, "a", "b")], OBSERVERS_RAW)
    assert quality.run_checks(STAGING, {"observers_raw": ok})[0]["records"] == 1
    with pytest.raises(quality.DataQualityError, match="empty"):
        quality.run_checks(STAGING, {"observers_raw": empty})
    with pytest.raises(quality.DataQualityError, match="NULL"):
        quality.run_checks(STAGING, {"observers_raw": nullkey})
    with pytest.raises(quality.DataQualityError, match="no key registered"):
        quality.run_checks(STAGING, {"nope": ok})


def test_clean_only_flagged_columns(spark):
    df = spark.createDataFrame([
        ("Crème brûlée", "a\r\nb", "plain"),
        ("Straße Œuvre", "c\nd\re", "ascii"),
        (None, None, "x"),
    ], "a string, b string, c string")
    prof = {r["column_name"]: r["needs_cleaning"] for r in profile(df, "t").collect()}
    assert prof == {"a": True, "b": True, "c": False}
    out = clean(df).collect()
    assert out[0]["a"] == "Creme brulee" and out[0]["b"] == "ab"
    assert out[1]["a"] == "Strasse OEuvre" and out[1]["b"] == "cd\re"  # lone CR stays
    assert out[2]["a"] is None and out[2]["b"] is None  # NULL stays NULL
    assert [r["c"] for r in out] == ["plain", "ascii", "x"]


def test_no_letter_vanishes(spark):
    from rangewise.functions.text import clean_text, unmapped
    from pyspark.sql import functions as F

    names = {"Ștefan": "Stefan", "Nguyễn": "Nguyen", "Ḥasan": "Hasan", "Γεώργιος": "Georgios",
             "王伟": "王伟", "Щукин": "Shchukin", "Ёлка": "Yolka", "Łódź": "Lodz", "e\u0301": "e",
             "naïve – “x”…": 'naive - "x"...', "ﬁ ½ №": "fi 1/2 No", "क": "क", None: None}
    df = spark.createDataFrame([(k,) for k in names], "a string")
    out = df.select("a", clean_text(F.col("a")).alias("b"), unmapped(F.col("a")).alias("n")).collect()
    assert {r.a: r.b for r in out} == names
    assert {r.a: r.n for r in out if r.n} == {"王伟": 2, "क": 1}


def test_histogram_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 2, 10]], "v double")
    h = {r["bin"]: r["frequency"] for r in histogram(spark, df, "v", 5).collect()}
    assert h == {0: 2, 1: 2, 2: 0, 3: 0, 4: 1}  # the maximum lands in the last bin
    one = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    h1 = histogram(spark, one, "v", 50).filter("frequency > 0").collect()
    assert len(h1) == 1 and h1[0]["bin"] == 25 and h1[0]["frequency"] == 2
    counts = np.histogram([0, 1, 2, 2, 10], bins=5)[0].tolist()
    assert [h[i] for i in range(5)] == counts


def test_douglas_peucker_matches_brute_force():
    rng = np.random.default_rng(7)
    for _ in range(30):
        n = int(rng.integers(5, 40))
        xs, ys = np.cumsum(rng.normal(size=n)), np.cumsum(rng.normal(size=n))
        keep = _douglas_peucker(xs, ys, 0.5)

        def rec(i, j, out):
            if j <= i + 1:
                return
            best, bd = None, -1.0
            for k in range(i + 1, j):
                dx, dy = xs[j] - xs[i], ys[j] - ys[i]
                seg = (dx * dx + dy * dy) ** 0.5
                d = (abs(dy * (xs[k] - xs[i]) - dx * (ys[k] - ys[i])) / seg if seg else
                     ((xs[k] - xs[i]) ** 2 + (ys[k] - ys[i]) ** 2) ** 0.5)
                if d > bd:
                    best, bd = k, d
            if bd > 0.5:
                out.add(best)
                rec(i, best, out)
                rec(best, j, out)

        exp = {0, n - 1}
        rec(0, n - 1, exp)
        assert sorted(keep.tolist()) == sorted(exp)


def test_refresh_stops_at_the_staging_gate(spark, tmp_dir):
    import os

    from rangewise.plans.refresh import refresh
    from rangewise.sources import fixtures as FX

    sf = "/root/testdata/sf0.001"
    raw = FX.RawTables(
        taxa_raw=lambda: FX.taxa_raw(spark, sf),
        observations_raw=lambda: FX.observations_raw(spark, sf),
        observers_raw=lambda: FX.observers_raw(spark, sf).limit(0),  # empty delivery
        species_geospatial_raw=lambda: FX.species_geospatial_raw(spark, sf),
    )
    with pytest.raises(quality.DataQualityError, match="observers_raw is empty"):
        refresh(spark, raw, root=tmp_dir + "/wh")
    assert not os.path.exists(tmp_dir + "/wh/production")


def test_clean_layer_job(spark, tmp_dir):
    from rangewise.plans.jobs import clean_layer

    src = spark.createDataFrame([
        (1, "Sánchez\r\net al.", "Ok", "POLYGON ((0 0, 1 0, 1 1, 0 0))"),
        (2, "Müller", "Fine", None),
    ], "id_no int, compiler string, citation string, wkt string")
    back = {r["id_no"]: r for r in clean_layer(src, tmp_dir + "/clean").collect()}
    assert spark.read.parquet(tmp_dir + "/clean").columns == src.columns
    assert back[1]["compiler"] == "Sanchezet al." and back[2]["compiler"] == "Muller"
    assert back[1]["citation"] == "Ok" and back[1]["wkt"].startswith("POLYGON")


def test_automatic_simplification_fits_the_limit(spark):
    import math

    from rangewise.sources.layer import build_layer

    n = 400
    pts = [(round(10 * math.cos(2 * math.pi * i / n) + 0.3 * math.sin(37 * i), 6),
            round(10 * math.sin(2 * math.pi * i / n), 6)) for i in range(n)]
    big = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in pts + pts[:1]) + "))"
    small = "POLYGON ((0 0, 1 0, 1 1, 0 0))"
    src = spark.createDataFrame([(1, big), (2, small)], "id_no int, wkt string")
    out = {r["id_no"]: r for r in build_layer(src, simplify_max_vertices=60,
                                              simplify_min_vertices=4).collect()}
    v_big = sum(len(r) for r in out[1]["rings"])
    assert 4 <= v_big <= 60  # reduced to fit
    assert sum(len(r) for r in out[2]["rings"]) == 4  # under the limit: untouched
    assert abs(out[1]["shape_area"] - math.pi * 100) / (math.pi * 100) < 0.1


def test_publish_switches_only_after_a_gated_refresh(spark, tmp_dir):
    from rangewise.plans.refresh import current_root, refresh
    from rangewise.sources import fixtures as FX

    sf = "/root/testdata/sf0.001"
    ptr = tmp_dir + "/pointers"
    assert current_root(spark, ptr) is None
    first = refresh(spark, FX.raw_tables(spark, sf), root=tmp_dir + "/a", publish_to=ptr).root
    assert current_root(spark, ptr) == first
    bad = FX.RawTables(
        taxa_raw=lambda: FX.taxa_raw(spark, sf),
        observations_raw=lambda: FX.observations_raw(spark, sf),
        observers_raw=lambda: FX.observers_raw(spark, sf).limit(0),
        species_geospatial_raw=lambda: FX.species_geospatial_raw(spark, sf),
    )
    with pytest.raises(quality.DataQualityError):
        refresh(spark, bad, root=tmp_dir + "/b", publish_to=ptr)
    assert current_root(spark, ptr) == first  # the failed run did not switch readers
    second = refresh(spark, FX.raw_tables(spark, sf), root=tmp_dir + "/c", publish_to=ptr).root
    assert current_root(spark, ptr) == second


def test_significance_tells_every_reduction():
    from rangewise.sources.layer import significance

    rng = np.random.default_rng(8)
    for _ in range(30):
        n = int(rng.integers(2, 80))
        xs, ys = rng.integers(0, 12, n).astype(float), rng.integers(0, 12, n).astype(float)
        order = significance(xs, ys)
        for tol in (0.0, 0.3, 1.0, 2.5, 7.0, 40.0):
            assert np.flatnonzero(order > tol).tolist() == _douglas_peucker(xs, ys, tol).tolist()


def test_automatic_reduction_divides_each_ring_once(monkeypatch):
    from rangewise.sources import layer

    rng = np.random.default_rng(3)

    def ring(n):
        a = np.sort(rng.uniform(0, 2 * np.pi, n))
        r = rng.uniform(5, 9, n)
        return np.append(r * np.cos(a), r[0] * np.cos(a[0])), np.append(r * np.sin(a), r[0] * np.sin(a[0]))

    calls = []
    plain = layer.significance
    monkeypatch.setattr(layer, "significance", lambda x, y: calls.append(len(x)) or plain(x, y))
    rings = [ring(300), ring(40), ring(3)]
    for limit in (12, 13, 50, 200, 345):
        calls.clear()
        out = layer._fitted(rings, limit)
        left = [len(x) for x, _ in out]
        assert sum(left) == limit and min(left) >= 4 and calls == [301, 41]
    assert layer._fitted(rings, 400) is rings
    with pytest.raises(ValueError, match="cannot be simplified"):
        layer._fitted(rings, 11)


@pytest.mark.parametrize("values", [[], [3], [3, 3], [1, 2, 2, 9], [5, 1, 1, 1, 8, 8, 30, 31], [None, 4, 7]])
def test_counts_of_counts_equal_the_plain_measures(spark, values):
    from pyspark.sql import functions as F

    from rangewise.operators.histogram import fanout, histogram_of_counts

    df = spark.createDataFrame([(v,) for v in values], "cnt long")
    want = df.agg(F.min("cnt"), F.max("cnt"), F.avg("cnt"), F.median("cnt")).first()
    assert tuple(fanout(df, "cnt").first()) == tuple(want)
    for bins in (1, 7):
        assert (sorted(map(tuple, histogram_of_counts(df, "cnt", bins).collect()))
                == sorted(map(tuple, histogram(spark, df, "cnt", bins).collect())))


def test_histogram_of_the_fact_reads_the_observations_once(spark):
    from rangewise.plans import reports
    from rangewise.plans.model import build

    df = reports.hist_taxon(spark, build(spark, "/root/testdata/sf0.001"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("lineitem.parquet") == 1


def test_observers_per_period_shuffles_bitmaps_not_observers(spark):
    import datetime as dt
    import random

    from rangewise.plans import reports
    from rangewise.plans.model import Warehouse

    rnd = random.Random(6)
    rows = [(rnd.choice([0, 5, 32_767, 32_768, 2_000_000_000, None, rnd.randint(0, 99)]),
             rnd.choice([None, dt.date(2020, 1, 31), dt.date(2020, 2, 1), dt.date(2021, 2, 1)])) for _ in range(500)]
    fact = spark.createDataFrame(rows, "observer_id int, observation_date date")
    df = reports.observers_per_period(Warehouse(None, tables={"species_observations": fact}))
    want = {}
    for who, day in rows:
        for kind, cut in (("day", None), ("month", 1), ("year", 1)):
            p = day and (day if cut is None else day.replace(day=1) if kind == "month" else day.replace(month=1, day=1))
            if who is not None:
                want.setdefault((kind, p), set()).add(who)
    assert {(r.kind, r.period): r.observers for r in df.collect()} == {k: len(v) for k, v in want.items()}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "partial_bitmap_construct_agg" in plan
    assert not any("observer_id" in line for line in plan.splitlines() if "Exchange" in line)


def test_scripts_spelled_by_rule(spark):
    import unicodedata

    from pyspark.sql import functions as F

    from rangewise.functions.text import spellings, transliterate, unmapped

    rows = {"カタカナ ひらがな": "katakana hiragana", "ｶﾅ": "kana", "서울 한강": "seoul hangang", "አማ": "amaa",
            "ᏣᎳᎩ": "tsalagi", "ㄅㄆ": "bp", "が。": "ga.", "漢字": "漢字", "😀x": "😀x", "": "", None: None,
            "Ά́ßé": "Asse", "a\x00b": "a\x00b"}
    df = spark.createDataFrame([(k,) for k in rows], "s string")
    got = df.select("s", transliterate(F.col("s")).alias("t"), unmapped(F.col("s")).alias("n")).collect()
    assert {r.s: r.t for r in got} == rows
    assert {r.s: r.n for r in got if r.n} == {"漢字": 2, "😀x": 1}
    # every Korean syllable as Unicode names it, every other spelling as the table has it
    every = [chr(k) for k in range(0xAC00, 0xAC00 + 11172)]
    want = {c: unicodedata.name(c).split()[-1].lower() for c in every} | spellings()
    out = spark.createDataFrame([(c,) for c in want], "s string").select("s", transliterate(F.col("s")).alias("t"))
    assert {r.s: r.t for r in out.collect()} == want


def test_wkt_faults_are_those_that_a_load_refuses(spark):
    from test_lossless import BAD, GOOD

    from rangewise.sources.layer import layer_parse_errors

    df = spark.createDataFrame([(k, w, "x") for k, w in enumerate([*GOOD, *BAD])], "k int, wkt string, fault string")
    got = {r.k: r.fault for r in layer_parse_errors(df).collect()}
    assert set(got) == set(range(len(GOOD), len(GOOD) + len(BAD)))
    assert set(got.values()) == {"tag", "outline", "vertex"} and got[len(GOOD) + 1] == "tag"


def test_key_report_of_several_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 3), (2, None)], "taxon_id int, ancestry_position int")
    rows = quality.key_report("production", {"taxa": df}, {"taxa": ("ancestry_position", "taxon_id")}).collect()
    assert [(r.key_position, r.key_column, r.null_keys, r.records, r.distinct_keys) for r in rows] == [
        (1, "ancestry_position", 1, 5, 2), (2, "taxon_id", 1, 5, 2)]

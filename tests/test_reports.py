"""Report semantics on a hand-made warehouse: NULL year last, date bound,
tie-break of top-k, IS false excludes NULL flags."""

import datetime as dt

from rangewise.plans import reports as R
from rangewise.plans.model import Warehouse
from rangewise.schemas import SPECIES_OBSERVATIONS, TAXA
from rangewise.sources.fixtures import RawTables


def _w(spark):
    d1, d2 = dt.date(1997, 5, 1), dt.date(1999, 2, 3)
    fact = spark.createDataFrame([
        ("a", 1, 0.0, 0.0, 1.0, 10, "research", d1, None, False),
        ("b", 2, 0.0, 0.0, 1.0, 10, "research", d2, None, False),
        ("c", 2, 0.0, 0.0, 1.0, 11, "research", d2, None, False),
        ("d", 3, 0.0, 0.0, 1.0, 11, "research", None, None, None),   # NULL date and flag
        ("e", 3, 0.0, 0.0, 1.0, 12, "casual", d2, None, False),
    ], SPECIES_OBSERVATIONS)
    taxa = spark.createDataFrame([
        (t, "species", 10, f"sp{t}", True, "48460/1001", 1001, 2, "class", 50, "C", True)
        for t in (10, 11, 12)], TAXA)
    ranges = spark.createDataFrame([(t, "DD", "data deficient") for t in (10, 11, 12)],
                                   "taxon_id int, iucn_category_id string, iucn_category_name string")
    observers = spark.createDataFrame([(1, "l1", "n1", d1), (2, "l2", "n2", d2), (3, "l3", "n3", d2)],
                                      "observer_id int, login_name string, observer_name string, "
                                      "first_observation_date date")
    raw = RawTables(None, None, None, None)
    return Warehouse(raw, tables={"taxa": taxa, "species_geospatial": ranges,
                                  "species_observations": fact, "observers": observers})


def test_observers_per_year_null_last(spark):
    rows = R.observers_per_year(_w(spark)).collect()
    assert [(r["year"], r["observers"]) for r in rows] == [(1997, 1), (1999, 2), (None, 1)]


def test_date_bound_drops_null_dates(spark):
    rows = {r["taxon_id"]: r["records"] for r in R.obs_per_taxon(_w(spark)).collect()}
    assert rows == {10: 1, 11: 1, 12: 1}  # d1 (1997) and the NULL date are out


def test_top5_is_false_and_tie_break(spark):
    rows = R.dd_out_of_range_top5(_w(spark)).collect()
    # 10 has two research rows flagged false, 11 one (its NULL flag is not
    # counted: IS false); 12 has casual rows only
    assert [(r["taxon_id"], r["observations"]) for r in rows] == [(10, 2), (11, 1)]


def test_top_observers_of_species(spark):
    rows = R.species_top_observers(_w(spark), taxon_id=11).collect()
    assert [(r["observer_id"], r["total_observations"]) for r in rows] == [(2, 1), (3, 1)]


def test_histogram_of_counts(spark):
    h = R.hist_taxon(spark, _w(spark)).filter("frequency > 0").collect()
    assert len(h) == 1 and h[0]["frequency"] == 3 and h[0]["bin"] == 25

"""Figures recorded in FIXTURES.md (section 3, 'Values seen') for sf0.01,
checked against the library directly (independent of the oracle SQL)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rangewise.plans import reports as R
from rangewise.plans.model import build

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def w(spark):
    return build(spark, SF)


def test_table_sizes(w):
    assert w.taxa.count() == 1211
    assert w.species_geospatial.count() == 600
    assert w.species_observations.count() == 12103


def test_grade_by_known_area(w):
    got = {(r["quality_grade"], r["observed_in_known_area"]): r["observations"]
           for r in R.known_area_counts(w).collect()}
    assert got == {("casual", False): 3674, ("casual", True): 341,
                   ("needs_id", False): 3672, ("needs_id", True): 377,
                   ("research", False): 3693, ("research", True): 346}


def test_observers(w):
    assert w.observers.count() == 1498
    assert w.observers.agg(F.min("first_observation_date")).first()[0] == dt.date(1995, 1, 2)
    per_year = [r["observers"] for r in R.observers_per_year(w).collect()]
    assert per_year == [1041, 982, 1018, 1033, 991, 1000, 910]


def test_top5_data_deficient(w):
    got = [(r["taxon_id"], r["observations"]) for r in R.dd_out_of_range_top5(w).collect()]
    assert got == [(100136, 17), (100181, 14), (100361, 14), (101126, 13), (101576, 13)]


def test_distinct_months_and_days(w):
    f = w.species_observations
    assert f.select(F.trunc("observation_date", "month")).distinct().count() == 83
    assert f.select("observation_date").distinct().count() == 2486


def test_species_of_top_observers_report(w):
    assert w.species_observations.filter("taxon_id = 100656").count() == 47

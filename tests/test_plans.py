"""Plan properties the design relies on, read from the physical plans."""

import re

from rangewise.plans import reports as R
from rangewise.plans.model import build, load
from rangewise.plans.refresh import refresh
from rangewise.sources.fixtures import raw_tables

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_joins_are_broadcast_and_one_aggregate_shuffle(spark):
    fact = build(spark, SF).species_observations
    plan = _plan(fact)
    assert plan.count("BroadcastHashJoin") >= 3  # orders, species, geometry
    hashed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # the 8-key aggregate is the one key-based exchange of observations; the
    # other is the id-hash spread of the one-row-group input
    agg = [h for h in hashed if "observation_uuid" in h]
    assert len(agg) == 1 and "quality_grade" in agg[0]
    assert "SortMergeJoin" not in plan


def test_warehouse_reports_push_filters_into_the_scan(spark, tmp_dir):
    root = refresh(spark, raw_tables(spark, SF), root=tmp_dir + "/wh").root
    w = load(spark, root)
    plan = _plan(R.species_top_observers(w, taxon_id=100001))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(taxon_id,100001\)", plan)
    plan = _plan(R.obs_per_taxon(w))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(observation_date", plan)
    assert re.search(r"ReadSchema: struct<taxon_id:int,observation_date:date>", plan)


def test_large_layer_path_is_a_band_keyed_shuffle_join(spark):
    from rangewise.operators.observations import species_observations

    w = build(spark, SF)
    fact = species_observations(w.raw.observations_raw, w.taxa, w.raw.species_geospatial_raw,
                                force_shuffle=True)
    plan = _plan(fact)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    # the geometry side is joined on the (species, band) key plus salt
    assert re.search(r"(SortMergeJoin|ShuffledHashJoin) \[_k#\d+, _salt#\d+\]", plan)
    assert re.search(r"LeftOuter", plan)

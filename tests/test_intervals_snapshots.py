"""Interval labels against the exploded table; snapshots under readers and writers."""

import pytest

from rangewise.operators import intervals
from rangewise.operators.taxa import explode_ancestry
from rangewise.plans import snapshots
from rangewise.plans.refresh import refresh
from rangewise.schemas import SCHEMAS
from rangewise.sources.fixtures import ClassScope, RawTables, raw_tables
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SF = "/root/testdata/sf0.001"
TAXA = "taxon_id int, ancestry string, rank_level double, rank string, name string, active boolean"


def taxa(spark, rows):
    return spark.createDataFrame([(i, a, 10.0, r, "n", True) for i, a, r in rows], TAXA)


ROWS = [(1, "", "life"), (2, "1", "class"), (20, "1", "class"), (3, "1/2", "genus"), (30, "1/20", "genus"),
        (4, "1/2/3", "species"), (5, "1/2/3", "species"), (5, "1/2/3", "species"), (6, "1/ 20 /30", None),
        (7, None, "species"), (8, "1/2/3/2", "species"), (9, "1/2/99", "species"), (2_000_000_000, "1/2", "species")]


def test_rollup_equals_the_exploded_table(spark):
    t, scope = taxa(spark, ROWS), ClassScope(class_id=2, path_prefix="1", ancestors=(1,))
    exploded = (explode_ancestry(t, scope).where("ancestry_id is not null").groupBy("ancestry_id", "taxon_rank")
                .agg(F.countDistinct("taxon_id").alias("taxa")))
    want = sorted(map(str, exploded.collect()))
    got = intervals.rollup(t, scope).select(exploded.columns)
    assert sorted(map(str, got.collect())) == want and len(want) > 8
    assert dict(got.dtypes) == dict(exploded.dtypes)
    assert intervals.rollup(t.where("false"), scope).count() == 0


def test_a_range_holds_what_is_below(spark):
    t = taxa(spark, ROWS)
    for path in ("1", "1/2", "1/2/3", "1/20", "5"):
        below = {r.taxon_id for r in intervals.taxa_below(t, path).collect()}
        assert below == {i for i, a, _ in ROWS if a is not None
                         and "/".join(x.strip() for x in a.split("/")).startswith(path)
                         and (a.replace(" ", "") + "/").startswith(path + "/")}


def test_labels_sort_in_pre_order(spark):
    t = intervals.labelled(taxa(spark, ROWS))
    got = [r.ancestry for r in t.where("ancestry is not null").orderBy("path_label").select("ancestry").distinct()
           .orderBy(intervals.label(F.col("ancestry"))).collect()]
    assert got == sorted({a for _, a, _ in ROWS if a is not None},
                         key=lambda a: [int(x) for x in a.split("/") if x.strip()])
    assert t.where("ancestry is null").first().path_label is None


@pytest.mark.parametrize("path", ["1/x", "1//2", "1/", "-1"])
def test_malformed_paths_fail(spark, path):
    with pytest.raises(Exception, match="malformed ancestry id"):
        intervals.labelled(taxa(spark, [(1, path, "genus")])).collect()


@pytest.fixture(scope="module")
def roots(spark):
    raw = raw_tables(spark, SF)
    fewer = RawTables(raw.taxa_raw, raw.observations_raw.where("quality_grade = 'research'"), raw.observers_raw,
                      raw.species_geospatial_raw)
    return [refresh(spark, r).root for r in (raw, fewer)]


def counts(w):
    return w.species_observations.count(), w.raw.observations_raw.count(), w.observers.count()


def test_readers_see_one_version(spark, roots, tmp_dir):
    assert snapshots.snapshot(spark, tmp_dir + "/m") is None
    first = snapshots.commit(spark, tmp_dir + "/m", roots[0])
    reader = snapshots.snapshot(spark, tmp_dir + "/m").warehouse(spark)
    facts = reader.species_observations.count()  # before the second commit
    second = snapshots.commit(spark, tmp_dir + "/m", roots[1])
    after = snapshots.snapshot(spark, tmp_dir + "/m").warehouse(spark)
    assert (first.version, second.version) == (1, 2) and len(first.tables) == len(SCHEMAS)
    old, new = counts(reader), counts(after)
    assert old[0] == facts and old[0] > new[0] and old[1] > new[1]
    assert counts(snapshots.snapshot(spark, tmp_dir + "/m", 1).warehouse(spark)) == old


def test_of_two_writers_one_fails(spark, roots, tmp_dir):
    folder = tmp_dir + "/m"
    snapshots.commit(spark, folder, roots[0], after=0)
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, folder, roots[1], after=0)
    assert snapshots.versions(spark, folder) == [1]
    assert snapshots.snapshot(spark, folder).tables["production.taxa"].startswith(roots[0])


def test_an_incomplete_root_is_not_committed(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        snapshots.commit(spark, tmp_dir + "/m", tmp_dir + "/nothing")
    assert snapshots.versions(spark, tmp_dir + "/m") == []


def test_retention_keeps_what_is_named(spark, tmp_dir):
    def root(name):
        for (layer, table), schema in SCHEMAS.items():
            spark.createDataFrame([], StructType()).select(
                *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).write.parquet(
                f"{tmp_dir}/{name}/{layer}/{table}")
        return f"{tmp_dir}/{name}"

    folder, a, b = tmp_dir + "/m", root("a"), root("b")
    for r in (a, b, b, b):
        snapshots.commit(spark, folder, r)
    with pytest.raises(ValueError):
        snapshots.retain(spark, folder, 0)
    gone = snapshots.retain(spark, folder, 2)
    assert snapshots.versions(spark, folder) == [3, 4] and len(gone) == len(SCHEMAS)
    assert all(p.startswith(a) for p in gone)
    assert snapshots.snapshot(spark, folder).frame(spark, "production", "taxa").count() == 0

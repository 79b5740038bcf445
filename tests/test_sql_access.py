"""SQL on the registered production tables: questions of the tests' own, held
against plain Python over the same rows or against hand-made rows."""

import datetime as dt
from collections import Counter, defaultdict

import pytest

from rangewise.plans.refresh import catalog_tables, refresh, register_tables
from rangewise.sources.fixtures import raw_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    return refresh(spark, raw_tables(spark, SF), root=str(tmp_path_factory.mktemp("wh")),
                   register=True).root


def test_taxa_under_each_ancestor(spark, warehouse):
    rows = spark.sql("SELECT ancestry_id, count(DISTINCT taxon_id) FROM production.taxa "
                     "WHERE taxon_rank = 'species' GROUP BY ancestry_id").collect()
    below = defaultdict(set)
    for t in spark.read.parquet(f"{warehouse}/staging/taxa_raw").collect():
        if t.rank == "species" and t.ancestry.startswith("48460/1001"):
            for a in t.ancestry.split("/"):
                below[int(a)].add(t.taxon_id)
    assert dict(map(tuple, rows)) == {k: len(v) for k, v in below.items()}


def test_share_outside_range_by_category(spark, warehouse):
    rows = spark.sql("""
        SELECT g.iucn_category_id, avg(CASE WHEN NOT f.observed_in_known_area THEN 1.0 ELSE 0 END)
        FROM production.species_observations f
        LEFT SEMI JOIN production.observers USING (observer_id)
        JOIN (SELECT taxon_id, min(iucn_category_id) AS iucn_category_id
              FROM production.species_geospatial GROUP BY taxon_id) g USING (taxon_id)
        GROUP BY g.iucn_category_id""").collect()
    kind = {r.taxon_id: r.iucn_category_id
            for r in spark.read.parquet(f"{warehouse}/production/species_geospatial").collect()}
    seen, out = Counter(), Counter()
    for r in spark.read.parquet(f"{warehouse}/production/species_observations").collect():
        seen[kind[r.taxon_id]] += 1
        out[kind[r.taxon_id]] += r.observed_in_known_area is False
    assert {k: pytest.approx(float(v), abs=1e-4) for k, v in rows} == {k: out[k] / n for k, n in seen.items()}


def test_registered_again_points_at_the_new_folder(spark, warehouse, tmp_path):
    other = str(tmp_path / "other")
    for layer, name in (("production", "observers"), ("production", "taxa")):
        spark.read.parquet(f"{warehouse}/{layer}/{name}").limit(1).write.parquet(f"{other}/{layer}/{name}")
    before = spark.table("production.observers").count()
    register_tables(spark, other)
    assert spark.table("production.observers").count() == 1 < before
    register_tables(spark, warehouse)
    assert spark.table("production.observers").count() == before


def test_catalog_declares_types_and_keys(spark, warehouse):
    rows = {(r.table_name, r.column_name): r for r in catalog_tables(spark).collect()}
    assert rows["observers_raw", "login"].data_type == "varchar(256)"
    assert rows["species_geospatial", "iucn_category_id"].data_type == "varchar(2)"
    assert rows["species_observations", "observation_uuid"].key_position == 1
    assert rows["species_observations", "taxon_id"].key_position is None


def boxes(folder, columns):
    """Per file: (least, largest) of each column, from the footers."""
    import glob

    import pyarrow.parquet as pq

    out = []
    for f in glob.glob(f"{folder}/*.parquet"):
        m = pq.ParquetFile(f).metadata
        box = {}
        for c in columns:
            k = m.schema.names.index(c)
            stats = [m.row_group(g).column(k).statistics for g in range(m.num_row_groups)]
            if stats:
                box[c] = min(s.min for s in stats), max(s.max for s in stats)
        if box:
            out.append(box)
    return out


def opened(files, column, low, high):
    return sum(lo <= high and hi >= low for lo, hi in (f[column] for f in files))


def test_fact_files_serve_bounds_on_dates_and_on_species(spark, warehouse):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        root = refresh(spark, raw_tables(spark, SF), root=warehouse + "-wide").root
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    files = boxes(f"{root}/production/species_observations", ["observation_date", "taxon_id"])
    fact = spark.read.parquet(f"{root}/production/species_observations")
    dates = sorted(r[0] for r in fact.select("observation_date").collect())
    assert len(files) >= 48
    one_date = [opened(files, "observation_date", d, d) for d in dates[::97]]
    late = opened(files, "observation_date", dates[len(dates) * 9 // 10], dates[-1])
    species = [opened(files, "taxon_id", r[0], r[0]) for r in fact.select("taxon_id").distinct().collect()]
    # a tenth of the dates, one date, one species: each far below all files
    assert late <= len(files) * 0.3
    assert max(one_date) <= len(files) * 0.3
    assert max(species) <= len(files) * 0.4 and sum(species) / len(species) <= len(files) * 0.3
    assert fact.count() == spark.read.parquet(f"{warehouse}/production/species_observations").count()


def test_layout_divides_a_hot_date_and_keeps_nulls(spark, tmp_path):
    from pyspark.sql import functions as F

    from rangewise.operators import layout

    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 77).when(F.col("id") % 101 == 0, None).otherwise(
            F.col("id") * 37 % 1000).cast("int").alias("day"),
        (F.col("id") * 91 % 500).cast("int").alias("taxon"), F.col("id").cast("string").alias("key"))
    columns = {"day": F.col("day"), "taxon": F.col("taxon")}
    bounds = layout.class_bounds(rows, columns)
    assert len(bounds["taxon"]) > 55 and bounds["day"].count(77) == 1 and len(bounds["day"]) < 50
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.laid_out(rows, columns, bounds, ("key",)).write.parquet(str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.exceptAll(rows).count() == 0 and back.count() == 6000
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1200
    assert layout.class_bounds(rows.where("false"), columns) == {"day": [], "taxon": []}


def test_rank_and_morton(spark):
    from pyspark.sql import functions as F

    from rangewise.operators.layout import morton, rank_of

    df = spark.createDataFrame([(v,) for v in [-5, 0, 1, 3, 4, 99, None]], "v long")
    assert [r[0] for r in df.select(rank_of(F.col("v"), [0, 3, 4])).collect()] == [0, 1, 1, 2, 3, 3, 3]
    pairs = spark.range(16).select(F.shiftright("id", 2).alias("a"), F.col("id").bitwiseAND(3).alias("b"))
    got = {(r.a, r.b): r.z for r in pairs.select("a", "b", morton([F.col("a"), F.col("b")], 2).alias("z")).collect()}
    assert sorted(got.values()) == list(range(16))
    assert got[0, 1] == 1 and got[1, 0] == 2 and got[1, 1] == 3 and got[2, 0] == 8 and got[3, 3] == 15


def test_gate_rejects_values_longer_than_declared(spark, tmp_path):
    from pyspark.sql import functions as F

    from rangewise.operators.quality import DataQualityError
    from rangewise.sources import fixtures as FX
    raw = FX.RawTables(
        taxa_raw=lambda: FX.taxa_raw(spark, SF),
        observations_raw=lambda: FX.observations_raw(spark, SF),
        observers_raw=lambda: FX.observers_raw(spark, SF).withColumn(
            "login", F.when(F.col("observer_id") == 1, F.repeat(F.lit("x"), F.lit(257)))
            .otherwise(F.col("login"))),
        species_geospatial_raw=lambda: FX.species_geospatial_raw(spark, SF))
    with pytest.raises(DataQualityError, match="longer than 256"):
        refresh(spark, raw, root=str(tmp_path / "wh"))

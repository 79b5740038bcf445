"""The monthly full refresh: stage -> gate -> transform -> gate.

Every run rewrites every table (upstream records can change at any time, so
there is no incremental path). Each stage is written before the next one
reads it, which cuts lineage at every table boundary: a lost executor
recomputes at most one stage, and no plan reads the table it overwrites.
Tables go to ``{root}/{layer}/{table}`` under a shared folder (by default a
fresh folder below ``spark.checkpoint.dir``) and can be registered in the
session catalog with their declared keys.

Layout, per the distribution notes of the model:
* taxa: sorted by (rank, ancestor) inside files - small, broadcast on read;
* species ranges: sorted by category;
* observers: sorted by first date;
* fact: range-partitioned by a space-filling key over (date rank, taxon rank),
  so each file holds a box of both, and a bound on either skips most files; a
  hot cell is divided by the observation id. The range exchange is one
  shuffle of the finished fact more, paid once per refresh; class bounds come
  from one aggregate over two columns.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rangewise.operators import layout, quality
from rangewise.operators.observations import species_observations
from rangewise.operators.observers import observers_first_seen
from rangewise.operators.ranges import species_ranges
from rangewise.operators.sizing import from_metrics, layer_metrics, taxa_metrics
from rangewise.operators.spatial_index import DEFAULT_TARGET_EDGES
from rangewise.operators.taxa import explode_ancestry, species_dim
from rangewise.schemas import (LAYOUT, PRIMARY_KEYS, PRODUCTION, SCHEMAS, STAGING, WIDTHS,
                               declared_type)
from rangewise.session import scratch_path, shared_dir
from rangewise.sources.fixtures import DEFAULT_SCOPE, ClassScope, RawTables


@dataclass
class RefreshResult:
    root: str
    staging_checks: list[dict] = field(default_factory=list)
    production_checks: list[dict] = field(default_factory=list)


def _ordinal(df: DataFrame, column: str) -> Column:
    """A date's day number, or an integer column as it is."""
    return F.unix_date(column) if dict(df.dtypes)[column] == "date" else F.col(column)


def _space_bounds(df: DataFrame, table: str) -> dict[str, list[int]]:
    """Class bounds of a table's space-filling key, from ``df`` with its columns."""
    return layout.class_bounds(df, {c: _ordinal(df, c) for c in LAYOUT[table]["space"]})


def _laid_out(df: DataFrame, table: str | None, bounds: dict[str, list[int]] | None = None) -> DataFrame:
    """``df`` dealt out and sorted as its table's layout says."""
    lay = LAYOUT.get(table or "", {})
    if "space" in lay:
        df = layout.laid_out(df, {c: _ordinal(df, c) for c in lay["space"]},
                             bounds or _space_bounds(df, table), lay["divided"])
    if "sort" in lay:
        df = df.sortWithinPartitions(*lay["sort"])
    return df


def _run_parallel(tasks, max_workers: int = 4) -> None:
    """Submit independent write jobs concurrently (Spark schedules jobs from
    several threads side by side); the first failure is re-raised."""
    if len(tasks) == 1:
        tasks[0]()
        return
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        for f in [pool.submit(t) for t in tasks]:
            f.result()


def register_tables(spark: SparkSession, root: str) -> None:
    """Catalog tables for the written folders: both databases and every table
    are created if they are not there, with declared types and the key as a
    property; a table that exists is pointed at the new folder, so readers
    never find it missing."""
    for layer in (STAGING, PRODUCTION):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for (layer, name), schema in SCHEMAS.items():
        cols = ", ".join(f"`{f.name}` {declared_type(layer, name, f)}" for f in schema.fields)
        keys = ",".join(PRIMARY_KEYS[(layer, name)])
        widths = ",".join(f"{c}:{n}" for c, n in WIDTHS[(layer, name)].items())
        location = f"{root}/{layer}/{name}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {layer}.{name} ({cols}) USING parquet "
            f"LOCATION '{location}' "
            f"TBLPROPERTIES ('primary_key' = '{keys}', 'text_widths' = '{widths}')")
        # SET LOCATION makes varchar columns strings in the catalog; the widths
        # stay declared in the property
        spark.sql(f"ALTER TABLE {layer}.{name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(f"{layer}.{name}")


def catalog_tables(spark: SparkSession) -> DataFrame:
    """One row per column of the registered tables: its declared type, its
    place in the key (NULL if it is no key column) and the table's rows."""
    parts = []
    for layer, name in SCHEMAS:
        described = spark.sql(f"DESCRIBE TABLE {layer}.{name}").where("col_name not like '#%'")
        facts = spark.sql(f"SHOW TBLPROPERTIES {layer}.{name}").groupBy().agg(
            F.split(F.max(F.when(F.col("key") == "primary_key", F.col("value"))), ",").alias("_keys"),
            F.str_to_map(F.max(F.when(F.col("key") == "text_widths", F.col("value"))),
                         F.lit(","), F.lit(":")).alias("_widths"))
        records = spark.table(f"{layer}.{name}").agg(F.count(F.lit(1)).alias("records"))
        # a table's columns beside two one-row facts about it
        one = F.lit(1)
        rows = described.withColumn("_one", one).join(facts.withColumn("_one", one), "_one").join(
            records.withColumn("_one", one), "_one")
        width = F.element_at("_widths", F.col("col_name"))
        parts.append(rows.select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
            F.col("col_name").alias("column_name"),
            F.coalesce(F.concat(F.lit("varchar("), width, F.lit(")")), F.col("data_type"))
            .alias("data_type"),
            F.nullif(F.array_position("_keys", F.col("col_name")), F.lit(0))
            .cast("int").alias("key_position"), "records"))
    return reduce(DataFrame.unionByName, parts)


def _pointer_dir(spark: SparkSession, pointers: str | None) -> str:
    return pointers or f"{shared_dir(spark)}/warehouse-pointers"


def publish(spark: SparkSession, root: str, pointers: str | None = None) -> str:
    """Make ``root`` the current warehouse: add a pointer entry named by time
    (never overwrite one), so readers switch only after a complete, gated
    refresh and a failed run leaves the previous warehouse current."""
    name = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    spark.range(1).select(F.lit(root).alias("value")).write.text(
        f"{_pointer_dir(spark, pointers)}/{name}")
    return name


def current_root(spark: SparkSession, pointers: str | None = None) -> str | None:
    """The most recently published warehouse root (None if none yet)."""
    path = _pointer_dir(spark, pointers)
    try:
        entries = spark.read.text(f"{path}/*").select(
            "value", F.input_file_name().alias("f"))
        latest = entries.orderBy(F.desc("f")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # else: nothing published yet
            raise
        return None
    return latest["value"] if latest else None


def refresh(spark: SparkSession, raw: RawTables, root: str | None = None,
            scope: ClassScope = DEFAULT_SCOPE, register: bool = False,
            publish_to: str | None = None) -> RefreshResult:
    """Stage, gate, transform, gate. The gate metrics and the broadcast size
    bounds are observed while the tables are written (``DataFrame.observe``),
    so they need no job of their own."""
    root = root or scratch_path(spark, "warehouse")
    res = RefreshResult(root)

    def rd(layer: str, name: str) -> DataFrame:
        # the declared schema: planning needs no footer reads
        return spark.read.schema(SCHEMAS[(layer, name)]).parquet(f"{root}/{layer}/{name}")

    def write_observed(layer, name, df, extra=None, table=None, bounds=None):
        # observed last: the sampling of a range partitioning must not count
        out, ob = quality.observed(layer, name, _laid_out(df, table, bounds), extra)
        out.write.mode("overwrite").parquet(f"{root}/{layer}/{name}")
        return ob

    # 1. stage (full replace), gate metrics and size bounds observed on the way
    staged = {
        "observers_raw": (raw.observers_raw, None),
        "observations_raw": (raw.observations_raw, None),
        "taxa_raw": (raw.taxa_raw, taxa_metrics(scope)),
        "species_geospatial_raw": (raw.species_geospatial_raw, layer_metrics()),
    }
    obs = {}

    def stage(name):
        df, extra = staged[name]
        obs[name] = write_observed(STAGING, name, df, extra)

    _run_parallel([(lambda n=n: stage(n)) for n in staged])

    # 2. gate on staging (no job: metrics came with the writes)
    res.staging_checks = [r for n in staged for r in quality.check_observed(STAGING, n, obs[n])]
    metrics = {**obs["taxa_raw"].get, **obs["species_geospatial_raw"].get}
    sizes = from_metrics(metrics)

    raw_w = RawTables(*(rd(STAGING, n) for n in
                        ("taxa_raw", "observations_raw", "observers_raw", "species_geospatial_raw")))

    # 3. taxa first: ranges and fact read it
    prod = {}
    prod["taxa"] = write_observed(
        PRODUCTION, "taxa",
        explode_ancestry(raw_w.taxa_raw, scope, broadcast_lookup=sizes.lookup_fits),
        table="taxa")
    taxa = rd(PRODUCTION, "taxa")
    species_dim(taxa, scope, fits=sizes.species_fits)

    # 4. ranges and fact (independent, run side by side), then observers
    ranges = species_ranges(raw_w.species_geospatial_raw, taxa, scope)
    fact_df = species_observations(raw_w.observations_raw, taxa, raw_w.species_geospatial_raw,
                                   scope, geometry_fits=sizes.geometry_fits,
                                   band_edges=DEFAULT_TARGET_EDGES if sizes.band_geometry else None)

    def write_prod(name, df, bounds=None):
        prod[name] = write_observed(PRODUCTION, name, df, table=name, bounds=bounds)

    def write_fact():
        # bounds from two columns of the class's staged rows: the fact is not computed for them
        keys = raw_w.observations_raw.join(species_dim(taxa, scope), "taxon_id").select(
            F.col("observed_on").alias("observation_date"), "taxon_id")
        write_prod("species_observations", fact_df, _space_bounds(keys, "species_observations"))

    _run_parallel([lambda: write_prod("species_geospatial", ranges), write_fact])
    fact = rd(PRODUCTION, "species_observations")
    write_prod("observers", observers_first_seen(raw_w.observers_raw, fact))

    # 5. gate on production
    res.production_checks = [r for n in ("taxa", "species_geospatial", "observers",
                                         "species_observations")
                             for r in quality.check_observed(PRODUCTION, n, prod[n])]
    if register:
        register_tables(spark, root)
    if publish_to is not None:
        publish(spark, root, publish_to or None)
    return res

"""Analyst reports over the star schema, one function per question.

Every report takes a :class:`~rangewise.plans.model.Warehouse` and returns a
lazy DataFrame. Dimensions are small and joined by broadcast after a size
check; the fact is filtered and partially aggregated before any shuffle.
Top-k reports break ties on the id so results are deterministic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangewise.operators import intervals
from rangewise.operators.histogram import fanout, histogram_of_counts
from rangewise.operators.taxa import class_species
from rangewise.plans.model import Warehouse

# --- fixed values -----------------------------------------------------------
# Lower date bound of the distribution profiles. The driver data spans
# 1995-2001, so the bound sits inside that span.
DEFAULT_SINCE = dt.date(1998, 1, 1)
# Species of the "top observers" report: the species with most fact rows at sf0.01.
DEFAULT_SPECIES = 100656
HIST_BINS = 50
GRID_DEGREES = 10


# -- R1-R3: the analyst questions ----------------------------------------------

def observers_per_year(w: Warehouse) -> DataFrame:
    """Distinct observers per observation year, NULL year sorted last."""
    return (w.species_observations
            .groupBy(F.year("observation_date").cast("int").alias("year"))
            .agg(F.countDistinct("observer_id").alias("observers"))
            .select("observers", "year")
            .orderBy(F.col("year").asc_nulls_last()))


def observers_per_period(w: Warehouse) -> DataFrame:
    """Distinct observers of each day, month and year, exactly, from one set of
    bitmaps per day that are united for the longer periods: rows of the fact fold
    into a bitmap per (day, 32,768 observer ids) before any shuffle, and no
    (period, observer) row exists. A NULL date is a period of its own."""
    daily = (w.species_observations.where(F.col("observer_id").isNotNull())
             .groupBy(F.col("observation_date").alias("day"), F.bitmap_bucket_number("observer_id").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("observer_id")).alias("seen")))
    periods = F.array(*[F.struct(F.lit(k).alias("kind"), start.alias("period")) for k, start in (
        ("day", F.col("day")), ("month", F.trunc("day", "month")), ("year", F.trunc("day", "year")))])
    united = (daily.select("bucket", "seen", F.explode(periods).alias("p")).groupBy("p.kind", "p.period", "bucket")
              .agg(F.bitmap_or_agg("seen").alias("seen")))
    return united.groupBy("kind", "period").agg(F.sum(F.bitmap_count("seen")).alias("observers"))


def dd_out_of_range_top5(w: Warehouse, category: str = "DD", grade: str = "research",
                         k: int = 5) -> DataFrame:
    """Species of one Red List category most often seen outside their range.

    The fact is folded to one row per taxon first (partial aggregates on the
    map side), so the joins with the category list and the species names are
    small x small and AQE picks their strategy from measured sizes.
    """
    cats = (w.species_geospatial.filter(F.col("iucn_category_id") == category)
            .select("taxon_id", "iucn_category_id", "iucn_category_name").distinct())
    sp = class_species(w.taxa, w.scope).select("taxon_id", "taxon_name")
    per_taxon = (w.species_observations
                 .filter((F.col("quality_grade") == grade)
                         & F.col("observed_in_known_area").eqNullSafe(False))
                 .groupBy("taxon_id").agg(F.count("observation_uuid").alias("n")))
    return (per_taxon.join(cats, "taxon_id").join(sp, "taxon_id")
            .groupBy("taxon_id", "taxon_name", "iucn_category_name")
            .agg(F.sum("n").alias("observations"))
            .select("observations", "taxon_id", F.col("taxon_name").alias("species_name"),
                    "iucn_category_name")
            .orderBy(F.desc("observations"), F.asc("taxon_id"))
            .limit(k))


def species_top_observers(w: Warehouse, taxon_id: int = DEFAULT_SPECIES, k: int = 5) -> DataFrame:
    """Observers with most observations of one species."""
    fact = w.species_observations.filter(F.col("taxon_id") == taxon_id)
    per_observer = fact.groupBy("observer_id").agg(
        F.count("observation_uuid").alias("total_observations"))
    return (per_observer.join(w.observers, "observer_id")
            .groupBy("observer_id", "login_name", "observer_name")
            .agg(F.sum("total_observations").alias("total_observations"))
            .select("total_observations", "observer_id", "login_name", "observer_name")
            .orderBy(F.desc("total_observations"), F.asc("observer_id"))
            .limit(k))


# -- R4: table totals ------------------------------------------------------------

def observation_total(w: Warehouse) -> DataFrame:
    return w.species_observations.agg(F.count(F.lit(1)).alias("records"))


def taxa_total(w: Warehouse) -> DataFrame:
    return w.taxa.agg(F.count(F.lit(1)).alias("records"))


def observer_total(w: Warehouse) -> DataFrame:
    return w.observers.agg(F.count("observer_id").alias("records"))


def layer_total(w: Warehouse) -> DataFrame:
    return w.raw.species_geospatial_raw.agg(F.count(F.lit(1)).alias("records"))


# -- R5-R7: distribution profiles ----------------------------------------------

def _since(w: Warehouse, since: dt.date) -> DataFrame:
    return w.species_observations.filter(F.col("observation_date") >= F.lit(since))


def obs_per_taxon(w: Warehouse, since: dt.date = DEFAULT_SINCE) -> DataFrame:
    return _since(w, since).groupBy("taxon_id").agg(F.count(F.lit(1)).alias("records")) \
        .select("records", "taxon_id")


def obs_per_month(w: Warehouse, since: dt.date = DEFAULT_SINCE) -> DataFrame:
    return _since(w, since).groupBy(F.date_trunc("month", F.col("observation_date").cast("timestamp_ntz")).alias("month")) \
        .agg(F.count(F.lit(1)).alias("total_observations")).select("total_observations", "month")


def obs_per_day(w: Warehouse, since: dt.date = DEFAULT_SINCE) -> DataFrame:
    return _since(w, since).groupBy("observation_date") \
        .agg(F.count(F.lit(1)).alias("total_observations")) \
        .select("total_observations", "observation_date")


def hist_taxon(spark: SparkSession, w: Warehouse, since: dt.date = DEFAULT_SINCE) -> DataFrame:
    return histogram_of_counts(obs_per_taxon(w, since), "records", HIST_BINS)


def hist_month(spark: SparkSession, w: Warehouse, since: dt.date = DEFAULT_SINCE) -> DataFrame:
    return histogram_of_counts(obs_per_month(w, since), "total_observations", HIST_BINS)


def hist_day(spark: SparkSession, w: Warehouse, since: dt.date = DEFAULT_SINCE) -> DataFrame:
    return histogram_of_counts(obs_per_day(w, since), "total_observations", HIST_BINS)


# -- R8-R9: taxonomy roll-ups ----------------------------------------------------

def rank_rollup(w: Warehouse) -> DataFrame:
    """Distinct taxa of each rank below each ancestor (e.g. species per class)."""
    return (w.taxa.filter(F.col("ancestry_id").isNotNull())
            .groupBy("ancestry_id", "taxon_rank")
            .agg(F.countDistinct("taxon_id").alias("taxa")))


def rank_rollup_intervals(w: Warehouse) -> DataFrame:
    """The same from taxa counted per path, without the exploded table."""
    return intervals.rollup(w.raw.taxa_raw, w.scope)


def taxa_below_class(w: Warehouse) -> DataFrame:
    """Taxa below the class, by the range of its interval label."""
    return intervals.taxa_below(w.raw.taxa_raw, w.scope.path_prefix)


def taxa_fanout(w: Warehouse) -> DataFrame:
    """How many exploded rows each taxon has: min / max / mean / median."""
    per = w.taxa.groupBy("taxon_id").agg(F.count(F.lit(1)).alias("cnt"))
    return fanout(per, "cnt")


# -- R10-R12: exploration of the raw inputs ---------------------------------------

def taxon_lookup(w: Warehouse, name: str = "AMERICA") -> DataFrame:
    return w.raw.taxa_raw.filter(F.col("name") == name)


def active_species(w: Warehouse, needle: str | None = None) -> DataFrame:
    """Active species whose ancestry mentions the class id (substring, any case).

    Rows without ancestry are dropped first.
    """
    needle = needle or str(w.scope.class_id)
    t = w.raw.taxa_raw.dropna(subset=["ancestry"])
    return t.filter(F.lower("ancestry").contains(needle.lower())
                    & (F.col("rank") == "species") & (F.col("active") == F.lit(True)))


def taxa_by_ancestry_pattern(w: Warehouse, pattern: str | None = None) -> DataFrame:
    """Taxa whose ancestry matches a regular expression anywhere, any case
    (the general form of ``active_species``' substring); by default paths on
    which the class id is a whole step."""
    pattern = pattern or rf"(^|/){w.scope.class_id}(/|$)"
    return w.raw.taxa_raw.dropna(subset=["ancestry"]).filter(
        F.col("ancestry").rlike(f"(?i){pattern}"))


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in the order of a key (the limit is the feature:
    a top-n, so no full sort)."""
    return df.orderBy(*order).limit(n)


def taxa_preview(w: Warehouse, n: int = 5) -> DataFrame:
    return preview(w.taxa, ["taxon_id", "ancestry_position"], n)


def active_species_ids(w: Warehouse, needle: str | None = None) -> DataFrame:
    """The active species' ids as a one-column frame: the set stays on the
    executors and is used as a semi-join source, never a driver-side list."""
    return active_species(w, needle).select("taxon_id").distinct()


def active_species_observations(w: Warehouse) -> DataFrame:
    """Fact rows per active species of the class (semi join on the id set)."""
    return (w.species_observations.join(active_species_ids(w), "taxon_id", "left_semi")
            .groupBy("taxon_id").agg(F.count(F.lit(1)).alias("records")))


def distinct_ranks(w: Warehouse) -> DataFrame:
    return w.raw.taxa_raw.dropna(subset=["ancestry"]).select("rank").distinct()


def distinct_grades(w: Warehouse) -> DataFrame:
    return w.raw.observations_raw.select("quality_grade").distinct()


def layer_species_counts(w: Warehouse) -> DataFrame:
    """Geometry rows vs distinct species names (a NULL name counts as one)."""
    return w.raw.species_geospatial_raw.agg(
        F.count(F.lit(1)).alias("geometry_rows"),
        (F.countDistinct("binomial")
         + F.coalesce(F.max(F.col("binomial").isNull().cast("int")), F.lit(0)))
        .cast("long").alias("species"),
    )


def layer_by_order(w: Warehouse, order: str = "ANURA") -> DataFrame:
    return w.raw.species_geospatial_raw.filter(F.col("order_") == order).select(
        "id_no", "binomial", "order_", "category", "shape_leng", "shape_area")


def layer_by_species(w: Warehouse, binomial: str = "species_656") -> DataFrame:
    return w.raw.species_geospatial_raw.filter(F.col("binomial") == binomial).select(
        "id_no", "binomial", "order_", "category", "xmin", "ymin", "xmax", "ymax")


# -- R13-R15: stated questions ------------------------------------------------------

def obs_by_category(w: Warehouse) -> DataFrame:
    cats = w.species_geospatial.select("taxon_id", "iucn_category_id", "iucn_category_name").distinct()
    per_taxon = w.species_observations.groupBy("taxon_id").agg(F.count(F.lit(1)).alias("n"))
    return (per_taxon.join(cats, "taxon_id")
            .groupBy("iucn_category_id", "iucn_category_name")
            .agg(F.sum("n").alias("observations")))


def obs_grid_density(w: Warehouse, degrees: int = GRID_DEGREES) -> DataFrame:
    """Observations per lon/lat grid cell (cell = lower-left corner)."""
    f = w.species_observations.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    return f.groupBy(
        (F.floor(F.col("longitude") / degrees) * degrees).cast("int").alias("cell_lon"),
        (F.floor(F.col("latitude") / degrees) * degrees).cast("int").alias("cell_lat"),
    ).agg(F.count(F.lit(1)).alias("observations"))


def out_of_range_share(w: Warehouse) -> DataFrame:
    """Per species: observations, how many fall outside the known range, share."""
    return (w.species_observations.groupBy("taxon_id")
            .agg(F.count(F.lit(1)).alias("observations"),
                 F.count(F.when(F.col("observed_in_known_area").eqNullSafe(False), 1))
                 .alias("out_of_range"))
            .withColumn("out_of_range_share", F.col("out_of_range") / F.col("observations")))


def known_area_counts(w: Warehouse) -> DataFrame:
    """Flagship: fact rows by quality grade and known-area flag."""
    return (w.species_observations.groupBy("quality_grade", "observed_in_known_area")
            .agg(F.count(F.lit(1)).alias("observations")))

"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry rebuilds the warehouse lazily from the driver tables in
``sf_dir`` and runs one job or report over the whole of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangewise.operators import clean as clean_ops
from rangewise.operators import quality
from rangewise.plans import reports as R
from rangewise.plans.model import Warehouse, build, load
from rangewise.plans.refresh import refresh
from rangewise.schemas import PRODUCTION, STAGING
from rangewise.sources.fixtures import raw_tables
from rangewise.sources.parallel import spread

Query = Callable[[SparkSession, str], DataFrame]


def _w(fn: Callable[[Warehouse], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(build(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _ws(fn: Callable[[SparkSession, Warehouse], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, build(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


def _layers(w: Warehouse) -> dict[str, dict[str, DataFrame]]:
    return {
        STAGING: {
            "observers_raw": w.raw.observers_raw,
            "observations_raw": w.raw.observations_raw,
            "taxa_raw": w.raw.taxa_raw,
            "species_geospatial_raw": w.raw.species_geospatial_raw,
        },
        PRODUCTION: {
            "taxa": w.taxa,
            "species_geospatial": w.species_geospatial,
            "observers": w.observers,
            "species_observations": w.species_observations,
        },
    }


def _written(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse as a refresh writes it, so that measuring its tables
    reads them instead of building each from the inputs again."""
    return load(spark, refresh(spark, raw_tables(spark, sf_dir)).root)


def pk_null_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate measurements (rows, NULL keys) for all eight tables."""
    lay = _layers(_written(spark, sf_dir))
    return quality.measure(STAGING, lay[STAGING]).unionByName(
        quality.measure(PRODUCTION, lay[PRODUCTION]))


#: Keys of several columns that are unique where the declared key is not.
WHOLE_KEYS = {"taxa": ("taxon_id", "ancestry_position"),
              "species_geospatial_raw": ("id_no", "geom_row_id")}


def composite_key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key columns by position, NULLs and distinct whole keys."""
    w = build(spark, sf_dir)
    return quality.key_report(PRODUCTION, {"taxa": w.taxa}, WHOLE_KEYS).unionByName(
        quality.key_report(STAGING, {"species_geospatial_raw": w.raw.species_geospatial_raw,
                                     "observers_raw": w.raw.observers_raw}, WHOLE_KEYS))


def row_count_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lay = _layers(_written(spark, sf_dir))
    return quality.row_count_checks(STAGING, lay[STAGING]).unionByName(
        quality.row_count_checks(PRODUCTION, lay[PRODUCTION]))


def text_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return clean_ops.profile(docs, "documents", ["text", "lang", "source"]).unionByName(
        clean_ops.profile(part, "part", ["p_name", "p_brand", "p_type"]))


# Letters that the two alphabets spell with one Latin letter, in the same order.
_LATIN_GREEK = ("adegiklmnoprstzyfx", "άδέγίκλμνόπρστζύφξ")
_LATIN_CYRILLIC = ("abvgdeziklmnoprstuf", "абвгдезиклмнопрстуф")
# Vowels that syllabaries have a sign of their own for.
_LATIN_KANA = ("aiueoN", "あイうエおＮ")
_LATIN_HANGUL = ("aeiou", "아에이오우")


def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cleaned, also after spelling them in Greek and Cyrillic
    letters, kana and Korean syllables (which cleaning must undo)."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars"))
    docs = docs.withColumns({f"text_{k}": F.translate("text", *pair) for k, pair in (
        ("greek", _LATIN_GREEK), ("cyrillic", _LATIN_CYRILLIC),
        ("kana", _LATIN_KANA), ("hangul", _LATIN_HANGUL))})
    return clean_ops.clean(docs)


def _fact(w: Warehouse) -> DataFrame:
    """The fact, its point as text."""
    p = F.col("observation_geom_point")
    return w.species_observations.withColumn("observation_geom_point", F.concat_ws(
        " ", p["srid"].cast("string"), p["lon"].cast("decimal(9,2)").cast("string"),
        p["lat"].cast("decimal(9,2)").cast("string")))


def _ranges(w: Warehouse) -> DataFrame:
    """The ranges, their geometry as its number of vertices."""
    return w.species_geospatial.withColumn("geometry", F.expr(
        "aggregate(geometry, 0, (a, r) -> a + size(r))"))


def queries() -> dict[str, Query]:
    from rangewise.plans import jobs  # TSV round trip, simplification, refresh

    return {
        "known_area_counts": _w(R.known_area_counts),
        "taxa_ancestry": _w(lambda w: w.taxa),
        "species_ranges": _w(_ranges),
        "species_observations": _w(_fact),
        "species_observations_partitioned": jobs.species_observations_partitioned,
        "geometry_cases": jobs.geometry_cases,
        "geometry_cases_partitioned": lambda s, d: jobs.geometry_cases(s, d, "bands"),
        "geometry_cases_cells": lambda s, d: jobs.geometry_cases(s, d, "cells"),
        "geometry_oblique_cases": jobs.geometry_oblique_cases,
        "species_observations_cells": jobs.species_observations_cells,
        "observers_first_seen": _w(lambda w: w.observers),
        "observers_per_year": _w(R.observers_per_year),
        "observers_per_period": _w(R.observers_per_period),
        "dd_out_of_range_top5": _w(R.dd_out_of_range_top5),
        "species_top_observers": _w(R.species_top_observers),
        "observation_total": _w(R.observation_total),
        "taxa_total": _w(R.taxa_total),
        "observer_total": _w(R.observer_total),
        "layer_total": _w(R.layer_total),
        "obs_per_taxon": _w(R.obs_per_taxon),
        "obs_per_month": _w(R.obs_per_month),
        "obs_per_day": _w(R.obs_per_day),
        "hist_taxon": _ws(R.hist_taxon),
        "hist_month": _ws(R.hist_month),
        "hist_day": _ws(R.hist_day),
        "rank_rollup": _w(R.rank_rollup),
        "rank_rollup_intervals": _w(R.rank_rollup_intervals),
        "taxa_below_class": _w(R.taxa_below_class),
        "snapshot_tables": jobs.snapshot_tables,
        "taxa_fanout": _w(R.taxa_fanout),
        "taxon_lookup": _w(R.taxon_lookup),
        "active_species": _w(R.active_species),
        "active_species_observations": _w(R.active_species_observations),
        "taxa_by_ancestry_pattern": _w(R.taxa_by_ancestry_pattern),
        "taxa_preview": _w(R.taxa_preview),
        "distinct_ranks": _w(R.distinct_ranks),
        "distinct_grades": _w(R.distinct_grades),
        "layer_species_counts": _w(R.layer_species_counts),
        "layer_by_order": _w(R.layer_by_order),
        "layer_by_species": _w(R.layer_by_species),
        "obs_by_category": _w(R.obs_by_category),
        "obs_grid_density": _w(R.obs_grid_density),
        "out_of_range_share": _w(R.out_of_range_share),
        "row_count_checks": row_count_checks,
        "pk_null_checks": pk_null_checks,
        "composite_key_checks": composite_key_checks,
        "layer_parse_errors": jobs.malformed_layer,
        "text_profile": text_profile,
        "text_clean": text_clean,
        "tsv_load_roundtrip": jobs.tsv_load_roundtrip,
        "layer_binary_load": jobs.layer_binary_load,
        "tsv_plain_roundtrip": jobs.tsv_plain_roundtrip,
        "ring_simplify": jobs.ring_simplify,
        "ring_simplify_auto": jobs.ring_simplify_auto,
        "clean_layer": jobs.cleaned_layer,
        "explore_tsv": jobs.explore_export,
        "catalog_tables": jobs.catalog,
        "refresh_idempotent": jobs.refresh_idempotent,
        "refresh_from_files": jobs.refresh_from_files,
    }

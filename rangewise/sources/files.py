"""The delivered inputs, as files: three escaped gzip TSV exports found by
object prefix (``observers*``, ``observations*``, ``taxa*``) and a range
layer with a WKT geometry column (Parquet by default, any Spark format)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rangewise.schemas import OBSERVATIONS_RAW, OBSERVERS_RAW, TAXA_RAW
from rangewise.sources.fixtures import RawTables
from rangewise.sources.layer import build_layer
from rangewise.sources.polygon_files import read_layer
from rangewise.sources.tsv import read_prefix, write_escaped_tsv


def raw_from_files(spark: SparkSession, base: str, layer_path: str, *,
                   layer_format: str = "parquet", wkt_col: str = "wkt",
                   simplify_tolerance: float | None = None,
                   simplify_max_vertices: int | None = None) -> RawTables:
    """``simplify_max_vertices`` turns on the automatic simplification of
    geometry rows above that many vertices (the load's SIMPLIFY AUTO).
    ``layer_format="polygon_files"`` loads a binary layer."""
    def layer() -> DataFrame:
        reduced = {"simplify_tolerance": simplify_tolerance, "simplify_max_vertices": simplify_max_vertices}
        if layer_format == "polygon_files":
            return build_layer(read_layer(spark, layer_path), rings_col="rings", **reduced)
        return build_layer(spark.read.format(layer_format).load(layer_path), wkt_col=wkt_col, **reduced)

    return RawTables(
        taxa_raw=lambda: read_prefix(spark, base, "taxa", TAXA_RAW),
        observations_raw=lambda: read_prefix(spark, base, "observations", OBSERVATIONS_RAW),
        observers_raw=lambda: read_prefix(spark, base, "observers", OBSERVERS_RAW),
        species_geospatial_raw=layer,
    )


def export_files(raw: RawTables, layer_src: DataFrame, base: str, layer_path: str) -> None:
    """Write inputs in the delivered formats (used to exercise the file path)."""
    write_escaped_tsv(raw.taxa_raw, f"{base}/taxa")
    write_escaped_tsv(raw.observations_raw, f"{base}/observations")
    write_escaped_tsv(raw.observers_raw, f"{base}/observers")
    layer_src.write.mode("overwrite").parquet(layer_path)

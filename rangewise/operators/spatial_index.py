"""Banded edge index for large range polygons.

A geometry row with E edges is cut into B = ceil(E / target) horizontal
bands of equal height between its ymin and ymax; each edge is stored in every
band its y-span touches. ``within_banded`` then tests a point against its own
band only: the same answer as the full edge list (a horizontal ray meets only
edges spanning the point's y), with ~target edge tests instead of E.

Small rows (B = 1) keep their edge list as the single band, without any
shuffle. Large rows are exploded to (row, band, edge), grouped per (row,
band), then regrouped per row - two shuffles over layer-side data only, each
group bounded by one geometry row. The fact never moves for this.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangewise.functions.geo import band_of

DEFAULT_TARGET_EDGES = 32
# An index holds at most so many times the edges of the geometry.
INDEX_GROWTH = 3


def band_index(geo: DataFrame, target_edges: int = DEFAULT_TARGET_EDGES) -> DataFrame:
    """``geo`` (geom_row_id, edges, xmin, ymin, xmax, ymax, + attributes) ->
    same attributes + ``bands: array<array<edge>>`` + ``band_h``; drops ``edges``."""
    attrs = [c for c in geo.columns if c != "edges"]
    # An edge of y-span s lies in at most s / band_h + 2 bands. So no more bands
    # than (edges * height / sum of spans) keep the index under 3 edges per edge.
    spans = F.aggregate("edges", F.lit(0.0), lambda a, e: a + F.abs(e["y2"] - e["y1"]))
    room = F.floor(F.size("edges") * (F.col("ymax") - F.col("ymin")) / F.nullif(spans, F.lit(0.0)))
    g = geo.withColumn("_n", F.greatest(F.lit(1), F.least(
        F.ceil(F.size("edges") / target_edges), F.coalesce(room, F.lit(1)))).cast("int")) \
           .withColumn("band_h", (F.col("ymax") - F.col("ymin")) / F.col("_n"))
    small = g.filter((F.col("_n") <= 1) | F.col("edges").isNull()).select(
        *attrs, "band_h",
        F.when(F.col("edges").isNull(), F.lit(None)).otherwise(F.array("edges")).alias("bands"))
    big = g.filter((F.col("_n") > 1) & F.col("edges").isNotNull())
    keys = attrs + ["band_h", "_n"]
    lo = band_of("least(_e.y1, _e.y2)", "ymin", "band_h", "_n")
    hi = band_of("greatest(_e.y1, _e.y2)", "ymin", "band_h", "_n")
    per_edge = big.select(*keys, F.explode("edges").alias("_e")).select(
        *keys, "_e", F.explode(F.expr(f"sequence({lo}, {hi})")).alias("_band"))
    # one empty entry per band, so that every band exists after grouping
    skeleton = big.select(*keys, F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_band"),
                          F.lit(None).cast(per_edge.schema["_e"].dataType).alias("_e"))
    per_band = per_edge.unionByName(skeleton).groupBy(*keys, "_band").agg(
        F.collect_list("_e").alias("_edges"))  # NULL placeholders are skipped
    per_row = per_band.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_band", "_edges"))).alias("_sorted"))
    banded = per_row.select(*attrs, "band_h",
                            F.expr("transform(_sorted, s -> s._edges)").alias("bands"))
    return small.unionByName(banded)


DEFAULT_BAND_DEGREES = 1.0


def band_rows(geo: DataFrame, band_height: float = DEFAULT_BAND_DEGREES) -> DataFrame:
    """Cut geometry rows into global latitude bands for a partitioned join.

    ``geo`` (taxon_name, geom_row_id, edges, xmin, ymin, xmax, ymax) -> one row
    per (geometry row, band it spans) with only the edges whose y-span touches
    the band; band = floor(y / band_height). Every band inside a row's
    y-range holds at least two edges (the boundary crosses it), so a point
    of that band is tested exactly as against the whole edge list.
    """
    keys = ["taxon_name", "geom_row_id", "xmin", "ymin", "xmax", "ymax"]
    h = float(band_height)
    per_edge = geo.filter(F.col("edges").isNotNull()).select(
        *keys, F.explode("edges").alias("_e"))
    per_band = per_edge.select(
        *keys, "_e",
        F.explode(F.sequence(F.floor(F.least("_e.y1", "_e.y2") / h),
                             F.floor(F.greatest("_e.y1", "_e.y2") / h))).alias("_band"))
    return per_band.groupBy(*keys, "_band").agg(F.collect_list("_e").alias("edges"))

"""Species-range dimension: layer rows matched to the class's species.

Inner join on species name; taxa are first reduced to one row per species of
the class. Duplicate species names in the taxonomy fan out (kept as is).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangewise.operators.taxa import species_dim
from rangewise.schemas import IUCN_CATEGORIES
from rangewise.sources.fixtures import DEFAULT_SCOPE, ClassScope


def category_name(code: Column) -> Column:
    """Red List code -> label; unknown codes give NULL (no ELSE arm)."""
    expr = None
    for c, label in IUCN_CATEGORIES:
        expr = F.when(code == c, label) if expr is None else expr.when(code == c, label)
    return expr


def species_ranges(layer: DataFrame, taxa: DataFrame, scope: ClassScope = DEFAULT_SCOPE,
                   with_geometry: bool = True) -> DataFrame:
    sp = species_dim(taxa, scope)
    out = layer.join(sp, layer["binomial"] == sp["taxon_name"]).select(
        F.col("id_no").alias("iucn_id"),
        "taxon_id",
        F.col("compiler").alias("compiled_by"),
        "citation",
        F.col("yrcompiled").alias("year_compiled"),
        F.col("category").alias("iucn_category_id"),
        category_name(F.col("category")).alias("iucn_category_name"),
        "marine",
        "terrestrial",
        "freshwater",
        F.col("shape_leng").alias("shape_length"),
        "shape_area",
        F.col("rings").alias("geometry"),
    )
    return out if with_geometry else out.drop("geometry")

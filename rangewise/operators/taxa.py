"""Taxa dimension: one row per (taxon, ancestor on its path).

The ancestry path ``'48460/1/2/...'`` (root first, parent last, self
excluded) is exploded with a generator - no row-number join - and each
ancestor's own attributes are looked up in the raw taxa table. The lookup
never matches a taxon to itself (the row is kept with NULL attributes).
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangewise.operators.joins import bounded_broadcast, salted_join_keys
from rangewise.sources.fixtures import DEFAULT_SCOPE, ClassScope


def in_scope_condition(scope: ClassScope = DEFAULT_SCOPE) -> F.Column:
    """Taxa below the class (by path prefix) plus the listed higher taxa.

    The default prefix test has no trailing slash, so a sibling id sharing the
    leading digits also matches; ``strict_prefix`` closes that gap.
    """
    anc = F.col("ancestry")
    if scope.strict_prefix:
        match = (anc == scope.path_prefix) | anc.startswith(scope.path_prefix + "/")
    else:
        match = anc.startswith(scope.path_prefix)
    return match | F.col("taxon_id").isin(list(scope.ancestors))


def in_scope(taxa_raw: DataFrame, scope: ClassScope = DEFAULT_SCOPE) -> DataFrame:
    return taxa_raw.filter(in_scope_condition(scope))


def explode_ancestry(taxa_raw: DataFrame, scope: ClassScope = DEFAULT_SCOPE,
                     broadcast_lookup: bool | None = None,
                     salt_target_rows: int = 2_000_000) -> DataFrame:
    """Build ``production.taxa`` from ``staging.taxa_raw``.

    * ``ancestry = ''`` (the root) gives one row, position 1, NULL ancestor.
    * ``ancestry IS NULL`` gives no row.
    * Every position is kept (no cap on depth).
    * An id that is not a number (e.g. after a trailing slash) fails the job,
      whatever the session's ANSI setting.
    """
    m = in_scope(taxa_raw, scope).select(
        "taxon_id", "ancestry", "rank_level", "rank", "name", "active",
        F.posexplode(F.split(F.col("ancestry"), "/")).alias("_pos", "_elem"),
    ).select(
        "*",
        F.when(F.col("ancestry") == "", F.lit(None).cast("int"))
        .when(F.trim(F.col("_elem")).try_cast("int").isNull(), F.raise_error(
            F.concat(F.lit("malformed ancestry id in path "), F.col("ancestry"))).cast("int"))
        .otherwise(F.trim(F.col("_elem")).try_cast("int")).alias("ancestry_id"),
        (F.col("_pos") + 1).cast("int").alias("ancestry_position"),
    )
    lookup = taxa_raw.select(
        F.col("taxon_id").alias("_a_id"),
        F.col("rank").alias("ancestry_rank"),
        F.bround("rank_level").cast("int").alias("ancestry_rank_level"),
        F.col("name").alias("ancestry_name"),
        F.col("active").alias("ancestry_active"),
    )
    # The taxonomy is a bounded dimension; broadcast it when it fits, else a
    # shuffle join with the hot ancestors (the root is on every path) salted.
    if broadcast_lookup is None:
        lookup, broadcast_lookup = bounded_broadcast(lookup)
    other = F.col("ancestry_id") != F.col("taxon_id")
    if broadcast_lookup:
        joined = m.join(F.broadcast(lookup), (F.col("ancestry_id") == F.col("_a_id")) & other, "left")
    else:
        m, lookup = salted_join_keys(
            m.withColumn("_k", F.col("ancestry_id")), lookup.withColumnRenamed("_a_id", "_k"), "_k",
            F.struct("taxon_id", "ancestry_position"), target_rows=salt_target_rows)
        lookup = lookup.withColumnsRenamed({"_k": "_a_id", "_salt": "_a_salt"})
        joined = m.join(lookup, (F.col("ancestry_id") == F.col("_a_id"))
                        & (F.col("_salt") == F.col("_a_salt")) & other, "left")
    return joined.select(
        "taxon_id",
        F.col("rank").alias("taxon_rank"),
        F.bround("rank_level").cast("int").alias("taxon_rank_level"),
        F.col("name").alias("taxon_name"),
        F.col("active").alias("taxon_active"),
        F.col("ancestry").alias("taxon_ancestry"),
        "ancestry_id",
        "ancestry_position",
        "ancestry_rank",
        "ancestry_rank_level",
        "ancestry_name",
        "ancestry_active",
    )


def class_species(taxa: DataFrame, scope: ClassScope = DEFAULT_SCOPE) -> DataFrame:
    """One row per species of the class: fixing the ancestor to the class id
    picks exactly one exploded row per species (the sort keys of the taxa
    table make this filter a row-group skip)."""
    return taxa.filter((F.col("taxon_rank") == "species") & (F.col("ancestry_id") == scope.class_id))


_SPECIES_DIM: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def species_dim(taxa: DataFrame, scope: ClassScope = DEFAULT_SCOPE,
                fits: bool | None = None) -> DataFrame:
    """``(taxon_id, taxon_name)`` of the class's species, broadcast-hinted when
    its size fits the budget (``fits`` from a prior measurement, else measured
    here). The decision is made once per taxa frame and shared by every job
    built on it."""
    per_taxa = _SPECIES_DIM.setdefault(taxa, {})
    if scope not in per_taxa:
        sp = class_species(taxa, scope).select("taxon_id", "taxon_name")
        if fits is None:
            fits = bounded_broadcast(sp)[1]
        per_taxa[scope] = F.broadcast(sp) if fits else sp
        _HINTED[per_taxa[scope]] = fits
    return per_taxa[scope]


_HINTED: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def with_hint_of(side: DataFrame, df: DataFrame) -> DataFrame:
    """``df`` (no more and no much wider rows than ``side``, a species
    dimension) broadcast-hinted if ``side`` is."""
    return F.broadcast(df) if _HINTED.get(side) else df

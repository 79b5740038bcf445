"""Interval labels of the taxonomy: "below an ancestor" as a range predicate.

A path's label is its ids at a fixed width, one after the other. Labels sort in
pre-order, and the paths below a node are exactly those whose label lies in
``[label, label || END)``. So the taxa below an ancestor are one range of a
column (which a table sorted by it serves by file and row-group bounds), and no
row per (taxon, ancestor) is made.

Defined cases: the root's path is empty and has the empty label; a NULL path
has no label; an id that is not a whole number from 0 fails the job, as in
``taxa.explode_ancestry``. An id that comes twice on a path counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangewise.operators.taxa import in_scope
from rangewise.sources.fixtures import DEFAULT_SCOPE, ClassScope

#: Characters of an id in a label, and a character after all digits in one.
WIDTH, END = 8, "G"


def steps(path: Column) -> Column:
    """The ids of a path, root first (none for the empty path)."""
    def number(x: Column) -> Column:
        n = F.trim(x).try_cast("int")
        return F.when(n >= 0, n).otherwise(F.raise_error(
            F.concat(F.lit("malformed ancestry id in path "), path)).cast("int"))
    return F.when(path == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(path, "/"), number))


def label(path: Column) -> Column:
    """The label of a path (from the root, last id included)."""
    return F.array_join(F.transform(steps(path), lambda n: F.lpad(F.hex(n), WIDTH, "0")), "")


def labelled(taxa_raw: DataFrame, name: str = "path_label") -> DataFrame:
    """``taxa_raw`` with the label of each taxon's ancestry as a last column."""
    return taxa_raw.withColumn(name, label(F.col("ancestry")))


def taxa_below(taxa_raw: DataFrame, path: str) -> DataFrame:
    """The taxa below the node at ``path`` (its id last), by one range."""
    low = "".join(f"{int(x):0{WIDTH}X}" for x in path.split("/"))
    at = label(F.col("ancestry"))
    return taxa_raw.where((at >= low) & (at < low + END))


def rollup(taxa_raw: DataFrame, scope: ClassScope = DEFAULT_SCOPE) -> DataFrame:
    """Distinct taxa of each rank below each ancestor, from taxa counted per
    (path, rank). Only these counts are spread over a path's nodes, so what is
    shuffled follows the taxonomy's inner nodes, not its species. A taxon has one
    path (its id is the key); repeated rows of it count once."""
    counted = (in_scope(taxa_raw, scope).where("ancestry <> ''")
               .select("ancestry", F.col("rank").alias("taxon_rank"), "taxon_id")
               .groupBy("ancestry", "taxon_rank").agg(F.countDistinct("taxon_id").alias("taxa")))
    return (counted.select(F.explode(F.array_distinct(steps(F.col("ancestry")))).alias("ancestry_id"),
                           "taxon_rank", "taxa")
            .groupBy("ancestry_id", "taxon_rank").agg(F.sum("taxa").alias("taxa")))

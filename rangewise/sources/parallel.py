"""Keep every core busy on inputs with too few splits.

A file scan yields one task per split (a Parquet row group at most). An
input delivered as a few large row groups would run a whole narrow pipeline
- join, projection, per-row geometry tests, partial aggregation - in one
task. ``spread`` round-robins such an input across the cluster's cores;
inputs whose rows already lie evenly in at least that many splits pass
through untouched, so no shuffle is added there. Splits alone do not tell: a
row group has one, however many splits its bytes are cut into, so the rows of
a scan are counted by split (without a filter, from the files' footers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _even(df: DataFrame, target: int) -> bool:
    """True if no split of a scan holds over twice a core's share of its rows."""
    found = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("total"), F.max("n").alias("most")).first()
    return not found["total"] or found["most"] * target <= 2 * found["total"]


def spread(df: DataFrame, min_partitions: int | None = None, scan: bool = True) -> DataFrame:
    """Hash-distribute on the row's position in its split: uniform even if a
    third of the rows are identical copies, and reproducible on a retried task
    (the id is split index + row offset over a deterministic scan), without the
    per-split sort that makes a round-robin repartition retry-safe. ``scan``: the
    frame reads files and does little else, so that its rows can be counted first."""
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target and (not scan or _even(df, target)):
        return df
    return (df.withColumn("_spread", F.monotonically_increasing_id())
            .repartition(target, "_spread").drop("_spread"))

"""Equal-width frequency histogram of a numeric column.

Bins follow the plotting convention: ``n`` bins spanning [min, max], the
last bin closed on the right (the maximum lands in bin n-1, not n); when
min = max the range widens to [v - 0.5, v + 0.5]. The range is a scalar
subquery over the same frame as the counts, so the whole is one lazy plan and
the shuffle that groups the input is made once and reused. Empty bins are
reported with frequency 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def histogram(spark: SparkSession, df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Rows ``(bin, bin_lo, bin_hi, frequency)`` for ``bins`` bins (over
    [0, 1] when there is no value). ``df`` is usually a grouped count (one
    row per taxon / day / month)."""
    values = df.select(F.col(col).cast("double").alias("v"))
    lo, hi = F.min("v"), F.max("v")
    half = F.when(lo == hi, 0.5).otherwise(0.0)
    span = values.agg(F.struct(F.coalesce(lo - half, F.lit(0.0)).alias("lo"),
                               F.coalesce(hi + half, F.lit(1.0)).alias("hi")).alias("r"))
    r = span.scalar()
    width = (r["hi"] - r["lo"]) / bins
    index = F.least(F.floor((F.col("v") - r["lo"]) * bins / (r["hi"] - r["lo"])), F.lit(bins - 1))
    counts = (values.where(F.col("v").isNotNull()).select(index.cast("int").alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("frequency")))
    edges = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"), (r["lo"] + F.col("id") * width).alias("bin_lo"),
        (r["lo"] + (F.col("id") + 1) * width).alias("bin_hi"))
    # one row per bin at most
    return edges.join(F.broadcast(counts), "bin", "left").select(
        "bin", "bin_lo", "bin_hi", F.coalesce("frequency", F.lit(0)).cast("long").alias("frequency"))


# -- counts of counts -------------------------------------------------------------
#
# Grouped counts are folded once more, to how often each count occurs. Counts
# that differ add up to all rows, so N rows have at most sqrt(2 N) different
# counts (1.4 million for 10^12 rows): one task can order them all.

def count_of_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n): how many rows of a grouped count have each value."""
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("long").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))


def fanout(df: DataFrame, col: str) -> DataFrame:
    """min_cnt, max_cnt, avg_cnt and the exact median_cnt of a grouped count:
    the values that the middle ranks fall on, by running totals."""
    order = Window.orderBy("value")
    ranked = count_of_counts(df, col).select(
        "value", "n", F.sum("n").over(order).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("total"))

    def at(rank):
        return F.min(F.when(F.col("upto") >= rank, F.col("value")))
    return ranked.agg(
        F.min("value").alias("min_cnt"), F.max("value").alias("max_cnt"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("avg_cnt"),
        ((at(F.floor((F.col("total") + 1) / 2)) + at(F.floor(F.col("total") / 2) + 1)) / 2).alias("median_cnt"))


def histogram_of_counts(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """``histogram`` of a grouped count: its input is computed once, in one
    branch of the plan, as range and bins both come from the counts of counts."""
    every = Window.partitionBy()
    v = F.col("value").cast("double")
    lo, hi = F.min(v).over(every), F.max(v).over(every)
    half = F.when(lo == hi, 0.5).otherwise(0.0)
    ranged = count_of_counts(df, col).select(v.alias("v"), "n", (lo - half).alias("lo"), (hi + half).alias("hi"))
    index = F.least(F.floor((F.col("v") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1))
    binned = ranged.groupBy(index.cast("int").alias("bin"), "lo", "hi").agg(F.sum("n").alias("n"))
    one = binned.agg(F.coalesce(F.max("lo"), F.lit(0.0)).alias("lo"), F.coalesce(F.max("hi"), F.lit(1.0)).alias("hi"),
                     F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found"))
    width = (F.col("hi") - F.col("lo")) / bins
    return one.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")).select(
        "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.element_at("found", F.col("bin")), F.lit(0)).cast("long").alias("frequency"))

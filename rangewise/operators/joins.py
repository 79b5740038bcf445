"""Join helpers: broadcast only behind a measured size, salt hot keys.

A broadcast side is measured before it is hinted, by a row count or by a
byte estimate, either aggregated on the executors. Above the budget the join is left
to a shuffle, where AQE's skew handling and :func:`salted_join_keys` keep a
hot key from landing in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Budget for one broadcast relation (bytes, estimated). Well below Spark's
# 8 GB hard cap and small enough to ship to a thousand executors.
BROADCAST_BUDGET = 128 * 1024 * 1024

# Bytes a text column of a dimension may take in a row (its declared width).
TEXT_BYTES = 256


def _row_bytes(df: DataFrame) -> int:
    """Per-row width from the schema: strings at their longest (names of up to
    256 characters), arrays at 32 bytes (measure those by ``size_expr``)."""
    total = 16
    for f in df.schema.fields:
        s = f.dataType.simpleString()
        if s in ("int", "float", "date"):
            total += 4
        elif s in ("bigint", "double", "timestamp", "timestamp_ntz"):
            total += 8
        elif s == "boolean":
            total += 1
        elif s.startswith(("string", "varchar", "char")):
            total += TEXT_BYTES
        else:
            total += 32
    return total


def bounded_broadcast(df: DataFrame, budget: int = BROADCAST_BUDGET,
                      size_expr: Column | None = None) -> tuple[DataFrame, bool]:
    """Return ``(broadcast(df), True)`` when ``df`` fits the budget, else ``(df, False)``.

    ``size_expr`` (per-row bytes) is summed on the executors for rows with
    variable-width payload such as edge arrays; otherwise rows are counted up
    to the cap implied by the schema width.
    """
    if size_expr is not None:
        total = df.agg(F.sum(size_expr).alias("b")).first()["b"] or 0
        fits = total <= budget
    else:
        # a count per task; no row moves
        fits = df.agg(F.count(F.lit(1))).first()[0] * _row_bytes(df) <= budget
    return (F.broadcast(df), True) if fits else (df, False)


def hot_key_salts(big: DataFrame, key: str, target_rows: int) -> DataFrame:
    """Keys of ``big`` holding more than ``target_rows`` rows, with a salt count.

    The result has at most ``count(big) / target_rows`` rows of a key and a
    number (a few MB for 10^11 rows at the default target), so it is bounded
    by construction and safe to broadcast.
    """
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > target_rows).select(
        key, F.ceil(F.col("_n") / target_rows).cast("int").alias("_salts"))


def salted_join_keys(big: DataFrame, small: DataFrame, key: str, row_id: Column,
                     target_rows: int = 2_000_000,
                     counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Add a ``_salt`` column to both sides so a hot ``key`` spreads over tasks.

    Rows of a hot key on the big side get ``pmod(hash(row_id), salts)``; the
    small side's rows of that key are replicated once per salt. Cold keys use
    salt 0 and are not replicated. Join on ``(key, _salt)``. ``counted``: a
    cheaper frame with the big side's keys (or more) to count them on.
    """
    salts = F.broadcast(hot_key_salts(big if counted is None else counted, key, target_rows))
    b = big.join(salts, key, "left").withColumn(
        "_salt", F.when(F.col("_salts").isNull(), F.lit(0))
        .otherwise(F.pmod(F.xxhash64(row_id), F.col("_salts")).cast("int"))
    ).drop("_salts")
    s = small.join(salts, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    ).drop("_salts")
    return b, s


def salted_by_count(big: DataFrame, small: DataFrame, keys: list[str], rows: str, by: Column,
                    share: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of an equi-join with a column ``salt`` to join on as well.

    ``small`` has a row per key and knows the key's ``rows`` in ``big``, so
    nothing is counted again. A key with more rows than ``share`` is dealt over as
    many salts as that takes, by the hash ``by``. Keys above the share are
    broadcast: there are at most rows(big) / share of them.
    """
    salts = F.ceil(F.col(rows) / share).cast("int")
    hot = F.broadcast(small.select(*keys, salts.alias("salts")).where("salts > 1"))
    dealt = big.join(hot, keys, "left").withColumn(
        "salt", F.coalesce(F.pmod(by, F.col("salts")), F.lit(0)).cast("int")).drop("salts")
    spread = small.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt, spread

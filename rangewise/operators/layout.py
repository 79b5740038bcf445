"""Space-filling layout: rows dealt to files by a key that serves bounds on
several columns at once.

Each column is ranked into ``2**bits`` classes of about equal size (class
bounds from one aggregate with mergeable sketches; that many values per column
reach the driver, whatever the table's size). The bits of the ranks, taken in
turn, form the Morton key. Rows near in the key are near in every column, so a
file holds a box of them: a bound on one of d columns meets about N^((d-1)/d) of N files
instead of all for every column but the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per column: 64 classes.
BITS = 6


def class_bounds(df: DataFrame, columns: dict[str, Column], bits: int = BITS) -> dict[str, list[int]]:
    """For each named integer expression, the least values of its classes but
    the first (fewer where a value fills classes). One job."""
    parts = 1 << bits
    at = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    row = df.agg(*[F.percentile_approx(c.cast("long"), at, F.lit(20 * parts)).alias(name)
                   for name, c in columns.items()]).first()
    return {name: sorted(set(row[name] or [])) for name in columns}


def rank_of(value: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below ``value``, by a balanced tree of
    comparisons; NULL ranks last."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < bounds[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return tree(0, len(bounds))


def morton(ranks: list[Column], bits: int = BITS) -> Column:
    """The ranks' bits in turn, the first column's first."""
    out = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for r in ranks:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(r, b).bitwiseAND(F.lit(1)))
    return out


def laid_out(df: DataFrame, columns: dict[str, Column], bounds: dict[str, list[int]],
             divided_by: tuple[str, ...] = (), bits: int = BITS) -> DataFrame:
    """``df`` range-partitioned by the Morton key of ``columns``; rows of one
    key are divided further by their order in the columns themselves and in
    ``divided_by``, so no class, however large, is bound to one file."""
    key = morton([rank_of(c.cast("long"), bounds[name]) for name, c in columns.items()], bits)
    return df.repartitionByRange(key, *columns.values(), *divided_by)

"""Column profiling and cleaning of text columns.

``profile`` finds, in one aggregation pass, which string columns hold any
value with a character outside 0x1F..0x7F (a report of its own). ``clean``
rewrites the values that need it (transliteration + line-break removal) in
one lazy pass: a value without such a character is its own clean form, so no
column has to be examined first and nothing reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangewise.functions.text import cleaned, needs_cleaning, unmapped

#: Columns that hold geometry as text; they are no prose and stay untouched.
GEOMETRY_COLUMNS = ("wkt", "geometry")


def string_columns(df: DataFrame, exclude: Sequence[str] = GEOMETRY_COLUMNS) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() == "string" and f.name not in exclude]


def profile(df: DataFrame, table_name: str, columns: list[str] | None = None) -> DataFrame:
    """Rows ``(table_name, column_name, needs_cleaning)``, lazily."""
    return _stacked(df, table_name, columns, "needs_cleaning",
                    lambda c: F.coalesce(F.max(needs_cleaning(c)), F.lit(False)))


def left_over(df: DataFrame, table_name: str, columns: list[str] | None = None) -> DataFrame:
    """Rows ``(table_name, column_name, unmapped)``: characters outside ASCII
    that cleaning would leave, as no spelling is known for them."""
    return _stacked(df, table_name, columns, "unmapped",
                    lambda c: F.coalesce(F.sum(unmapped(c)), F.lit(0)).cast("long"))


def _stacked(df: DataFrame, table_name: str, columns, name: str, measure) -> DataFrame:
    cols = columns or string_columns(df)
    agg = df.agg(*[measure(F.col(c)).alias(f"_f{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', `_f{i}`" for i, c in enumerate(cols))
    return agg.select(F.lit(table_name).alias("table_name"),
                      F.expr(f"stack({len(cols)}, {stack}) AS (column_name, {name})"))


def clean(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``df`` with the string columns (of ``columns``, default all but
    geometry text) cleaned."""
    return df.withColumns({c: cleaned(F.col(c)) for c in (columns or string_columns(df))})

"""Data-quality gates run between the refresh stages.

Check 1: a table is not empty. Check 2: no declared key column (or column
declared NOT NULL) holds NULL. Check 3: no text is longer than declared.
They are measured in one aggregation per table (a single scan, partial
aggregates on the executors); only a handful of numbers reach the driver.
The declared keys come from the registry in :mod:`rangewise.schemas`, never
from a catalog lookup, and every key column is checked.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rangewise.schemas import NOT_NULL, PRIMARY_KEYS, WIDTHS


class DataQualityError(ValueError):
    """A gate failed; the refresh stops before anything downstream runs."""


def key_columns(layer: str, table: str) -> tuple[str, ...]:
    try:
        return PRIMARY_KEYS[(layer, table)]
    except KeyError:
        raise DataQualityError(f"no key registered for {layer}.{table}") from None


def measure(layer: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per (table, key column): row count and NULL-key count."""
    parts = []
    for name, df in tables.items():
        keys = key_columns(layer, name)
        agg = df.agg(
            F.count(F.lit(1)).alias("records"),
            *[F.count(F.when(F.col(k).isNull(), 1)).alias(f"_null_{i}") for i, k in enumerate(keys)],
        )
        stack = ", ".join(f"'{k}', `_null_{i}`" for i, k in enumerate(keys))
        parts.append(agg.select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "records",
            F.expr(f"stack({len(keys)}, {stack}) AS (key_column, null_keys)"),
        ))
    return reduce(DataFrame.unionByName, parts)


def key_report(layer: str, tables: Mapping[str, DataFrame],
               keys: Mapping[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per key column, in the key's order: its position, its NULLs, and
    how many rows and distinct whole keys the table has. ``keys``: keys of
    several columns for tables whose declared one is not unique."""
    parts = []
    for name, df in tables.items():
        key = (keys or {}).get(name) or key_columns(layer, name)
        # folded by key first, so distinct keys need no second pass
        folded = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
        agg = folded.agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("records"),
            F.count_if(reduce(Column.__and__, [F.col(k).isNotNull() for k in key])).alias("distinct_keys"),
            *[F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("_rows"))), F.lit(0)).alias(f"_null_{i}")
              for i, k in enumerate(key)])
        stack = ", ".join(f"{i + 1}, '{k}', `_null_{i}`" for i, k in enumerate(key))
        parts.append(agg.select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "records", "distinct_keys",
            F.expr(f"stack({len(key)}, {stack}) AS (key_position, key_column, null_keys)")))
    return reduce(DataFrame.unionByName, parts)


def row_count_checks(layer: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "records")
        for name, df in tables.items()])


def run_checks(layer: str, tables: Mapping[str, DataFrame]) -> list[dict]:
    """Raise :class:`DataQualityError` on an empty table or a NULL key."""
    rows = [r.asDict() for r in measure(layer, tables).collect()]
    for r in rows:
        if r["records"] == 0:
            raise DataQualityError(f"{layer}.{r['table_name']} is empty")
        if r["null_keys"]:
            raise DataQualityError(
                f"{layer}.{r['table_name']} has {r['null_keys']} rows with NULL "
                f"in key column {r['key_column']}")
    return rows


def observed(layer: str, table: str, df: DataFrame,
             extra: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Attach the gate's metrics (and ``extra`` aggregates) to ``df``: they
    are collected while the next action - the table's write - runs, so the
    gate costs no job of its own."""
    keys = key_columns(layer, table)
    ob = Observation(f"{layer}.{table}.{uuid.uuid4().hex[:8]}")
    exprs = [F.count(F.lit(1)).alias("records")]
    exprs += [F.count(F.when(F.col(k).isNull(), 1)).alias(f"null:{k}")
              for k in (*keys, *NOT_NULL.get((layer, table), ()))]
    exprs += [F.count(F.when(F.char_length(c) > n, 1)).alias(f"long:{c}")
              for c, n in WIDTHS[(layer, table)].items() if c in df.columns]
    exprs += [c.alias(k) for k, c in (extra or {}).items()]
    return df.observe(ob, *exprs), ob


def check_observed(layer: str, table: str, ob: Observation) -> list[dict]:
    """Gate on metrics observed during the write; raise like :func:`run_checks`."""
    m = ob.get
    rows = [{"layer": layer, "table_name": table, "records": m["records"], "key_column": k,
             "null_keys": m[f"null:{k}"]} for k in key_columns(layer, table)]
    for r in rows:
        if r["records"] == 0:
            raise DataQualityError(f"{layer}.{table} is empty")
        if r["null_keys"]:
            raise DataQualityError(
                f"{layer}.{table} has {r['null_keys']} rows with NULL in key column "
                f"{r['key_column']}")
    for name, n in m.items():
        kind, _, column = name.partition(":")
        if n and kind == "long":
            raise DataQualityError(
                f"{layer}.{table} has {n} values of {column} longer than "
                f"{WIDTHS[(layer, table)][column]} characters")
        if n and kind == "null":
            raise DataQualityError(f"{layer}.{table} has {n} rows with NULL in {column}")
    return rows

"""Observer dimension: observers with at least one fact row, and the date of
their first observation.

The fact is folded to one row per observer before the join (a partial
aggregate on the map side, so even an observer owning a third of all rows
costs one row per task), then joined to the raw observers. The final
grouping on (id, login, name) reuses the join's hash partitioning on the id:
no further shuffle. It collapses exact duplicate observer rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def observers_first_seen(observers_raw: DataFrame, fact: DataFrame) -> DataFrame:
    firsts = fact.groupBy("observer_id").agg(F.min("observation_date").alias("_first"))
    joined = observers_raw.join(firsts, "observer_id")
    return joined.groupBy("observer_id", "login", "name").agg(
        F.min("_first").alias("first_observation_date")
    ).select(
        "observer_id",
        F.col("login").alias("login_name"),
        F.col("name").alias("observer_name"),
        "first_observation_date",
    )

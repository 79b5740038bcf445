"""One measuring job for every broadcast decision of a warehouse build.

The three dimension-side relations joined into the big tables are bounded
from the raw inputs, in a single job (two aggregates under one union):

* ancestor lookup = the raw taxa projection: its row count;
* class species = one row per occurrence of the class id on an in-scope
  species path: counted exactly from the raw taxa, no explode or join;
* class geometry = a semi-filtered subset of the layer: bounded by the sum
  of the layer's per-row ``geom_bytes`` bound, no geometry parsing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from rangewise.operators.joins import BROADCAST_BUDGET, TEXT_BYTES
from rangewise.operators.spatial_index import INDEX_GROWTH
from rangewise.sources.fixtures import DEFAULT_SCOPE, ClassScope, RawTables

# Per-row in-memory width used for the two row-counted relations (bytes):
# (int id, 2 strings, int, boolean) and (int id, string).
LOOKUP_ROW_BYTES = 16 + 4 + TEXT_BYTES + 4 + TEXT_BYTES + 1
# Geometry rows whose size bound exceeds this get a banded edge index.
BAND_ABOVE_BYTES = 16 * 1024
SPECIES_ROW_BYTES = 16 + 4 + TEXT_BYTES


@dataclass(frozen=True)
class DimensionSizes:
    taxa_rows: int
    species_rows: int
    geometry_bytes: int
    max_geometry_row_bytes: int = 0
    budget: int = BROADCAST_BUDGET
    band_above_bytes: int = BAND_ABOVE_BYTES

    @property
    def lookup_fits(self) -> bool:
        return self.taxa_rows * LOOKUP_ROW_BYTES <= self.budget

    @property
    def species_fits(self) -> bool:
        return self.species_rows * SPECIES_ROW_BYTES <= self.budget

    @property
    def geometry_fits(self) -> bool:
        return self.geometry_bytes <= self.budget

    @property
    def band_geometry(self) -> bool:
        """Index large polygons by y-bands (see operators.spatial_index), if
        the index is sure to fit too."""
        return (self.max_geometry_row_bytes > self.band_above_bytes
                and INDEX_GROWTH * self.geometry_bytes <= self.budget)


def taxa_metrics(scope: ClassScope = DEFAULT_SCOPE) -> dict[str, F.Column]:
    """Aggregates over the raw taxa that bound the lookup and species sides."""
    from rangewise.operators.taxa import in_scope_condition

    occurrences = F.expr(
        "size(filter(split(ancestry, '/'), x -> try_cast(trim(x) AS INT) = "
        f"{int(scope.class_id)}))")
    is_species = in_scope_condition(scope) & (F.col("rank") == "species")
    return {
        "taxa_rows": F.count(F.lit(1)).cast("long"),
        "species_rows": F.coalesce(F.sum(F.when(is_species, occurrences).otherwise(0)),
                                   F.lit(0)).cast("long"),
    }


def layer_metrics() -> dict[str, F.Column]:
    """Aggregates over the layer that bound the geometry side."""
    return {
        "geometry_bytes": F.coalesce(F.sum("geom_bytes"), F.lit(0)).cast("long"),
        "max_geometry_row_bytes": F.coalesce(F.max("geom_bytes"), F.lit(0)).cast("long"),
    }


def from_metrics(metrics: dict, budget: int = BROADCAST_BUDGET) -> DimensionSizes:
    """Sizes from metrics already gathered (e.g. observed while staging)."""
    return DimensionSizes(taxa_rows=metrics["taxa_rows"], species_rows=metrics["species_rows"],
                          geometry_bytes=metrics["geometry_bytes"],
                          max_geometry_row_bytes=metrics["max_geometry_row_bytes"],
                          budget=budget)


_MEASURED: dict[tuple, dict] = {}


# Inputs with more files than this are measured every time rather than keyed
# (one status call per file from the driver would cost more than the job).
_MAX_KEYED_FILES = 64


def _input_identity(*dfs) -> tuple | None:
    """(path, length, modification time) of every file the frames read, via
    the Hadoop file system; None when a frame has no file inputs to key on
    or too many to stat cheaply."""
    out = []
    for df in dfs:
        files = df.inputFiles()
        if not files or len(files) > _MAX_KEYED_FILES:
            return None
        jvm = df.sparkSession.sparkContext._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for f in sorted(files):
            path = jvm.org.apache.hadoop.fs.Path(f)
            st = path.getFileSystem(conf).getFileStatus(path)
            out.append((f, st.getLen(), st.getModificationTime()))
    return tuple(out)


def measure(raw: RawTables, scope: ClassScope = DEFAULT_SCOPE,
            budget: int = BROADCAST_BUDGET) -> DimensionSizes:
    """Run the measuring job: both aggregates under one union, one action.

    The result is kept per (input files with length and modification time,
    plans, scope), like table statistics: unchanged inputs are not measured
    twice; any change to a file measures again."""
    ident = _input_identity(raw.taxa_raw, raw.species_geospatial_raw)
    key = None
    if ident is not None:
        plans = (raw.taxa_raw.semanticHash(), raw.species_geospatial_raw.semanticHash())
        key = (ident, plans, scope)
        if key in _MEASURED:
            return from_metrics(_MEASURED[key], budget)
    t = raw.taxa_raw.agg(*[c.alias(k) for k, c in taxa_metrics(scope).items()])
    g = raw.species_geospatial_raw.agg(*[c.alias(k) for k, c in layer_metrics().items()])
    rows = t.select(F.lit("taxa").alias("k"), F.col("taxa_rows").alias("a"),
                    F.col("species_rows").alias("b")) \
        .unionByName(g.select(F.lit("geo").alias("k"), F.col("geometry_bytes").alias("a"),
                              F.col("max_geometry_row_bytes").alias("b"))) \
        .collect()
    got = {r["k"]: r for r in rows}
    metrics = {"taxa_rows": got["taxa"]["a"], "species_rows": got["taxa"]["b"],
               "geometry_bytes": got["geo"]["a"], "max_geometry_row_bytes": got["geo"]["b"]}
    if key is not None:
        _MEASURED[key] = metrics
    return from_metrics(metrics, budget)

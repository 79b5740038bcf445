"""The star schema as lazy DataFrames.

``Warehouse`` bundles the four raw (staging) inputs and the four production
tables. ``build`` derives everything from a driver data folder without
writing anything (Catalyst sees one plan per report and prunes / pushes
filters through the whole chain); ``load`` reads tables written by the
refresh job instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rangewise.operators.observations import species_observations
from rangewise.operators.observers import observers_first_seen
from rangewise.operators.ranges import species_ranges
from rangewise.operators.sizing import DimensionSizes, measure
from rangewise.operators.spatial_index import DEFAULT_TARGET_EDGES
from rangewise.operators.taxa import explode_ancestry, species_dim
from rangewise.schemas import SCHEMAS
from rangewise.sources.fixtures import DEFAULT_SCOPE, ClassScope, RawTables, raw_tables


class Warehouse:
    """Raw inputs + the four production tables, built on first access.

    ``taxa`` comes first (ranges and fact read it), the observers dimension
    reads the fact; a report that reads only the fact never constructs the
    ranges or observers plans.
    """

    def __init__(self, raw: RawTables, scope: ClassScope = DEFAULT_SCOPE, *,
                 sizes: DimensionSizes | None = None, tables: dict | None = None):
        self.raw = raw
        self.scope = scope
        self._sizes = sizes
        self._tables: dict[str, DataFrame] = dict(tables or {})

    @property
    def sizes(self) -> DimensionSizes:
        if self._sizes is None:
            self._sizes = measure(self.raw, self.scope)
        return self._sizes

    def _get(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = getattr(self, f"_build_{name}")()
        return self._tables[name]

    def _build_taxa(self) -> DataFrame:
        taxa = explode_ancestry(self.raw.taxa_raw, self.scope,
                                broadcast_lookup=self.sizes.lookup_fits)
        species_dim(taxa, self.scope, fits=self.sizes.species_fits)
        return taxa

    def _build_species_geospatial(self) -> DataFrame:
        return species_ranges(self.raw.species_geospatial_raw, self.taxa, self.scope)

    def _build_species_observations(self) -> DataFrame:
        sz = self.sizes
        return species_observations(self.raw.observations_raw, self.taxa,
                                    self.raw.species_geospatial_raw, self.scope,
                                    geometry_fits=sz.geometry_fits,
                                    band_edges=DEFAULT_TARGET_EDGES if sz.band_geometry else None)

    def _build_observers(self) -> DataFrame:
        return observers_first_seen(self.raw.observers_raw, self.species_observations)

    taxa = property(lambda self: self._get("taxa"))
    species_geospatial = property(lambda self: self._get("species_geospatial"))
    species_observations = property(lambda self: self._get("species_observations"))
    observers = property(lambda self: self._get("observers"))


def transform(raw: RawTables, scope: ClassScope = DEFAULT_SCOPE,
              sizes: DimensionSizes | None = None) -> Warehouse:
    """Production tables from staging tables (lazily, in dependency order).

    All broadcast decisions come from one measuring job over the inputs.
    """
    return Warehouse(raw, scope, sizes=sizes)


def build(spark: SparkSession, sf_dir: str, scope: ClassScope = DEFAULT_SCOPE) -> Warehouse:
    return transform(raw_tables(spark, sf_dir), scope)


def load(spark: SparkSession, root: str, scope: ClassScope = DEFAULT_SCOPE) -> Warehouse:
    """Tables written by :func:`rangewise.plans.refresh.refresh` under ``root``."""
    def rd(layer: str, name: str) -> DataFrame:
        # written by the refresh with the declared schema
        return spark.read.schema(SCHEMAS[(layer, name)]).parquet(f"{root}/{layer}/{name}")

    raw = RawTables(
        taxa_raw=lambda: rd("staging", "taxa_raw"),
        observations_raw=lambda: rd("staging", "observations_raw"),
        observers_raw=lambda: rd("staging", "observers_raw"),
        species_geospatial_raw=lambda: rd("staging", "species_geospatial_raw"),
    )
    tables = {n: rd("production", n) for n in
              ("taxa", "species_geospatial", "species_observations", "observers")}
    return Warehouse(raw, scope, tables=tables)

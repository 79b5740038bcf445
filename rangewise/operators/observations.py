"""Fact table: observations of the class's species, flagged inside / outside
the species' known range.

Plan (when the geometry fits a broadcast: one shuffle of the fact):

1. observations x species of the class on ``taxon_id`` (broadcast, measured):
   keeps the class's observations and adds the species name;
2. x the class's range geometry rows on the name: a broadcast hash join when
   the geometry's size bound fits the budget (no shuffle of the fact, a hot
   species is harmless); else a spatially partitioned shuffle join on
   (species, cell of an adaptive index), where an observation tests a bounded
   number of edges and hot (species, cell) keys are salted. That path shuffles
   the observations twice: for the join and for the aggregate;
3. per (observation, geometry row) the strict point-in-polygon test;
4. GROUP BY the 8 observation columns with ``max(flag)``: collapses exact
   duplicate observation rows and ORs the geometry rows (NULL ignored). The
   pairs of one observation leave the join together, so the map-side partial
   aggregate already folds them; only distinct observations cross the shuffle.

Species without any geometry row drop out (inner join); a pair whose bbox
misses gives ``false``, never a lost row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangewise.functions.geo import point, within, within_banded
from rangewise.operators.joins import bounded_broadcast, hot_key_salts, salted_join_keys
from rangewise.operators.cell_index import EDGE_BOUND, cell_index, within_cell, written
from rangewise.operators.spatial_index import INDEX_GROWTH, band_index, band_rows
from rangewise.operators.taxa import species_dim, with_hint_of
from rangewise.sources.fixtures import DEFAULT_SCOPE, ClassScope

#: Under this salt target most species are above it: their cells are counted at once.
COUNT_SPECIES_FROM = 100_000

OBS_KEYS = ["observation_uuid", "observer_id", "latitude", "longitude", "positional_accuracy",
            "taxon_id", "quality_grade", "observed_on"]


def class_geometry(layer: DataFrame, taxa: DataFrame,
                   scope: ClassScope = DEFAULT_SCOPE) -> DataFrame:
    """Range geometry rows of the class's species, keyed by species name.

    A semi join: it only filters, so its size is bounded by the layer's and
    duplicate names in the taxonomy do not multiply geometry rows here.
    """
    sp = species_dim(taxa, scope)
    geo = layer.select("geom_row_id", F.col("binomial").alias("taxon_name"), "edges", "xmin",
                       "ymin", "xmax", "ymax", "geom_bytes")
    return geo.join(sp.select("taxon_name"), "taxon_name", "left_semi")


def species_observations(observations_raw: DataFrame, taxa: DataFrame, layer: DataFrame,
                         scope: ClassScope = DEFAULT_SCOPE, *, with_point: bool = True,
                         force_shuffle: bool = False,
                         geometry_fits: bool | None = None,
                         band_edges: int | None = None,
                         salt_target_rows: int = 2_000_000,
                         band_height: float | None = None,
                         edge_bound: int = EDGE_BOUND) -> DataFrame:
    """``band_edges``: build a banded edge index with about this many edges
    per band (for layers of large polygons); None or 0 tests full edge lists.
    A geometry side over the broadcast budget (or ``force_shuffle``) is
    shuffled by cells of an adaptive index (``edge_bound`` edges a cell), or, if
    ``band_height`` degrees are given, by latitude bands."""
    obs = observations_raw.select(*OBS_KEYS).filter(F.col("observation_uuid").isNotNull())
    geo = class_geometry(layer, taxa, scope)
    if not force_shuffle and geometry_fits is None:
        # an index holds at most INDEX_GROWTH times the edges it is built from
        size = F.col("geom_bytes") * (INDEX_GROWTH if band_edges else 1)
        geo, geometry_fits = bounded_broadcast(geo, size_expr=size)
    if force_shuffle or not geometry_fits:
        fact = (_cell_partitioned(obs, geo, taxa, scope, edge_bound, salt_target_rows)
                if band_height is None else
                _band_partitioned(obs, geo, taxa, scope, band_height, salt_target_rows))
    else:
        # observations of the class's species, with the species name
        obs = obs.join(species_dim(taxa, scope), "taxon_id")
        if band_edges:
            geo = band_index(geo, band_edges)
        pairs = obs.join(F.broadcast(geo), "taxon_name")
        test = (within_banded("longitude", "latitude", "bands") if band_edges
                else within("longitude", "latitude", "edges"))
        flagged = pairs.select(*OBS_KEYS, test.alias("_inside"))
        fact = flagged.groupBy(*OBS_KEYS).agg(F.max("_inside").alias("observed_in_known_area"))
    cols = [
        "observation_uuid", "observer_id", "latitude", "longitude",
        F.col("positional_accuracy").cast("double").alias("positional_accuracy_in_metres"),
        "taxon_id", "quality_grade",
        F.col("observed_on").alias("observation_date"),
    ]
    if with_point:
        # rebuilt after grouping (geometry is not a grouping key)
        cols.append(point("longitude", "latitude").alias("observation_geom_point"))
    cols.append("observed_in_known_area")
    return fact.select(*cols)


def _settled(agg: DataFrame) -> DataFrame:
    """Observations with ``_any`` (in some geometry row) and ``_has`` (its
    species has one): NULL without a coordinate or a geometry."""
    flag = (F.when(F.col("latitude").isNull() | F.col("longitude").isNull(), F.lit(None))
            .when(F.col("_any"), F.lit(True))
            .when(F.col("_has"), F.lit(False))
            .otherwise(F.lit(None)).cast("boolean"))
    return agg.select(*OBS_KEYS, flag.alias("observed_in_known_area"))


def _of_hot_species(obs: DataFrame, species: DataFrame, target_rows: int) -> tuple[DataFrame, bool]:
    """The observations among which a cell can have more than ``target_rows``
    rows, those of species that have, and whether there are such species (if not,
    the rows are of an empty table). A count per species is far smaller than one
    per cell, and is all that most inputs need."""
    if target_rows < COUNT_SPECIES_FROM:
        return obs, True
    # at most count(obs) / target_rows rows
    hot = written(hot_key_salts(obs, "taxon_id", target_rows).join(species, "taxon_id", "left_semi")
                  .select("taxon_id"), "hot-species")
    return (hot, False) if hot.isEmpty() else (obs.join(F.broadcast(hot), "taxon_id", "left_semi"), True)


def _cell_partitioned(obs: DataFrame, geo: DataFrame, taxa: DataFrame, scope: ClassScope,
                      edge_bound: int, salt_target_rows: int) -> DataFrame:
    """Join for a geometry side too large to broadcast, on (taxon, cell).

    An observation looks up its cell of every size that its species uses; the
    cells of a geometry row do not overlap, so at most one of them answers, with at
    most ``edge_bound`` edges to test. Look-ups that find no cell are dropped
    but for an observation's first, which keeps it in the fact (outside every
    range). Hot (taxon, cell) keys are salted by the row's position; cells are
    counted only for species above the salt target, where there are any. Species
    join by broadcast where small, with the sizes in use (at most some twenty).
    """
    geo = written(geo, "geometry")  # parsed once, read for the index and the flag
    index = cell_index(geo, edge_bound)
    has = geo.groupBy("taxon_name").agg(F.max(F.col("edges").isNotNull()).alias("_has_geometry"))
    sizes = index.groupBy("taxon_name").agg(F.collect_set("k").alias("_sizes"))
    species = species_dim(taxa, scope)
    info = with_hint_of(species, species.join(has, "taxon_name").join(sizes, "taxon_name", "left"))

    def key(x, y) -> F.Column:
        return F.concat_ws("#", *[F.col("taxon_id").cast("string"), F.col("k").cast("string"),
                                  x.cast("string"), y.cast("string")])

    def cell(ordinate: str) -> F.Column:
        return F.floor(F.col(ordinate) / F.pow(F.lit(2.0), F.col("k")))

    none = F.array(F.lit(0))  # a species without cells: one look-up that finds none

    def looked_up(rows: DataFrame) -> DataFrame:
        found = rows.join(info.select("taxon_id", "_has_geometry", "_sizes"), "taxon_id")
        return found.select(*found.columns, F.posexplode(F.coalesce("_sizes", none)).alias(
            "_look", "k")).drop("_sizes").withColumn("_k", key(cell("longitude"), cell("latitude")))

    g = index.join(species, "taxon_name").select(key(F.col("ix"), F.col("iy")).alias("_k"), "k", "ix", "iy",
                                                 "ref", "edges", F.lit(True).alias("_cell"))
    counted, some = _of_hot_species(obs, species, salt_target_rows)
    if not some:  # no rows to count, no key to deal over salts
        o, row = looked_up(obs).drop("k"), F.col("observation_uuid")
        counts = counted.select(F.col("taxon_id").cast("string").alias("_k"))
    else:
        o, row = looked_up(obs.withColumn("_position", F.monotonically_increasing_id())).drop("k"), F.col("_position")
        counts = looked_up(counted.select("taxon_id", "longitude", "latitude")).select("_k")
    o, g = salted_join_keys(o, g, "_k", row, target_rows=salt_target_rows, counted=counts)
    pairs = o.join(g, ["_k", "_salt"], "left").where(F.col("_cell") | (F.col("_look") == 0))
    flagged = pairs.select(*OBS_KEYS, "_has_geometry", F.when(
        F.col("_cell"), within_cell("longitude", "latitude")).alias("_inside"))
    return _settled(flagged.groupBy(*OBS_KEYS).agg(
        F.max("_inside").alias("_any"), F.max("_has_geometry").alias("_has")))


def _band_partitioned(obs: DataFrame, geo: DataFrame, taxa: DataFrame, scope: ClassScope,
                      band_height: float, salt_target_rows: int) -> DataFrame:
    """Spatially partitioned join for a geometry side too large to broadcast.

    Both sides meet on (taxon, latitude band): an observation is shuffled
    with the edges of its own band only. Hot (taxon, band) keys are salted by
    the row's position in its input split, so copies of one row spread too;
    they are counted on two columns of the observations. The join is a left
    join so that an observation whose band misses every geometry row of its
    species survives; it is then ``false`` when the species has any non-NULL
    geometry and NULL otherwise - the same answer as testing every geometry
    row. Species without geometry rows drop out: they are not in the species
    side, which is small x small and carries the "has geometry" flag.
    """
    has = geo.groupBy("taxon_name").agg(F.max(F.col("edges").isNotNull()).alias("_has_geometry"))
    species = species_dim(taxa, scope)
    info = with_hint_of(species, species.join(has, "taxon_name"))

    def band(y: str):
        return F.floor(F.col(y) / float(band_height))

    def key(band_column) -> F.Column:
        return F.concat_ws("#", F.col("taxon_id").cast("string"), band_column.cast("string"))

    counts = obs.select(key(band("latitude")).alias("_k"))
    o = (obs.withColumn("_position", F.monotonically_increasing_id())
         .join(info.select("taxon_id", "_has_geometry"), "taxon_id")
         .withColumn("_k", key(band("latitude"))))
    g = (band_rows(geo, band_height).join(species, "taxon_name")
         .select(key(F.col("_band")).alias("_k"), "edges", "xmin", "ymin", "xmax", "ymax"))
    o, g = salted_join_keys(o, g, "_k", F.col("_position"), target_rows=salt_target_rows,
                            counted=counts)
    pairs = o.join(g, ["_k", "_salt"], "left")
    flagged = pairs.select(*OBS_KEYS, "_has_geometry",
                           within("longitude", "latitude", "edges").alias("_inside"))
    return _settled(flagged.groupBy(*OBS_KEYS).agg(
        F.max("_inside").alias("_any"), F.max("_has_geometry").alias("_has")))

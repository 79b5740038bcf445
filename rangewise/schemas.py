"""Table schemas of the two warehouse layers, their declared keys, and the
fixed code lists the transforms rely on.

Staging tables hold the files as delivered (bound by position); production
tables form the star schema: one fact (``species_observations``) and three
dimensions (``taxa``, ``species_geospatial``, ``observers``).
"""

from __future__ import annotations

from pyspark.sql import types as T

STAGING = "staging"
PRODUCTION = "production"

EDGE = T.StructType([
    T.StructField("x1", T.DoubleType()),
    T.StructField("y1", T.DoubleType()),
    T.StructField("x2", T.DoubleType()),
    T.StructField("y2", T.DoubleType()),
])
VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(VERTEX))
POINT = T.StructType([
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("srid", T.IntegerType()),
])

OBSERVERS_RAW = T.StructType([
    T.StructField("observer_id", T.IntegerType()),
    T.StructField("login", T.StringType()),
    T.StructField("name", T.StringType()),
])

OBSERVATIONS_RAW = T.StructType([
    T.StructField("observation_uuid", T.StringType()),
    T.StructField("observer_id", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("positional_accuracy", T.IntegerType()),
    T.StructField("taxon_id", T.IntegerType()),
    T.StructField("quality_grade", T.StringType()),
    T.StructField("observed_on", T.DateType()),
])

TAXA_RAW = T.StructType([
    T.StructField("taxon_id", T.IntegerType()),
    T.StructField("ancestry", T.StringType()),
    T.StructField("rank_level", T.DoubleType()),
    T.StructField("rank", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("active", T.BooleanType()),
])

# Polygon layer attributes (geometry travels as rings, see functions.geo).
LAYER_ATTRIBUTES = T.StructType([
    T.StructField("id_no", T.IntegerType()),
    T.StructField("binomial", T.StringType()),
    T.StructField("presence", T.IntegerType()),
    T.StructField("origin", T.IntegerType()),
    T.StructField("seasonal", T.IntegerType()),
    T.StructField("compiler", T.StringType()),
    T.StructField("yrcompiled", T.IntegerType()),
    T.StructField("citation", T.StringType()),
    T.StructField("subspecies", T.StringType()),
    T.StructField("subpop", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("island", T.StringType()),
    T.StructField("tax_comm", T.StringType()),
    T.StructField("dist_comm", T.StringType()),
    T.StructField("generalised", T.LongType()),
    T.StructField("legend", T.StringType()),
    T.StructField("kingdom", T.StringType()),
    T.StructField("phylum", T.StringType()),
    T.StructField("class", T.StringType()),
    T.StructField("order_", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("genus", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("marine", T.BooleanType()),
    T.StructField("terrestrial", T.BooleanType()),
    T.StructField("freshwater", T.BooleanType()),
    T.StructField("shape_leng", T.DoubleType()),
    T.StructField("shape_area", T.DoubleType()),
])

# Staging layer: attributes + a row id per geometry row + parsed geometry.
SPECIES_GEOSPATIAL_RAW = T.StructType(
    [T.StructField("geom_row_id", T.LongType())]
    + list(LAYER_ATTRIBUTES.fields)
    + [
        T.StructField("rings", RINGS),
        T.StructField("edges", T.ArrayType(EDGE)),
        T.StructField("xmin", T.DoubleType()),
        T.StructField("ymin", T.DoubleType()),
        T.StructField("xmax", T.DoubleType()),
        T.StructField("ymax", T.DoubleType()),
        # upper bound of the row's in-memory geometry size (bytes), for
        # broadcast decisions that must not parse the geometry to decide
        T.StructField("geom_bytes", T.LongType()),
    ]
)

TAXA = T.StructType([
    T.StructField("taxon_id", T.IntegerType()),
    T.StructField("taxon_rank", T.StringType()),
    T.StructField("taxon_rank_level", T.IntegerType()),
    T.StructField("taxon_name", T.StringType()),
    T.StructField("taxon_active", T.BooleanType()),
    T.StructField("taxon_ancestry", T.StringType()),
    T.StructField("ancestry_id", T.IntegerType()),
    T.StructField("ancestry_position", T.IntegerType()),
    T.StructField("ancestry_rank", T.StringType()),
    T.StructField("ancestry_rank_level", T.IntegerType()),
    T.StructField("ancestry_name", T.StringType()),
    T.StructField("ancestry_active", T.BooleanType()),
])

SPECIES_GEOSPATIAL = T.StructType([
    T.StructField("iucn_id", T.IntegerType()),
    T.StructField("taxon_id", T.IntegerType()),
    T.StructField("compiled_by", T.StringType()),
    T.StructField("citation", T.StringType()),
    T.StructField("year_compiled", T.IntegerType()),
    T.StructField("iucn_category_id", T.StringType()),
    T.StructField("iucn_category_name", T.StringType()),
    T.StructField("marine", T.BooleanType()),
    T.StructField("terrestrial", T.BooleanType()),
    T.StructField("freshwater", T.BooleanType()),
    T.StructField("shape_length", T.DoubleType()),
    T.StructField("shape_area", T.DoubleType()),
    T.StructField("geometry", RINGS),
])

OBSERVERS = T.StructType([
    T.StructField("observer_id", T.IntegerType()),
    T.StructField("login_name", T.StringType()),
    T.StructField("observer_name", T.StringType()),
    T.StructField("first_observation_date", T.DateType()),
])

SPECIES_OBSERVATIONS = T.StructType([
    T.StructField("observation_uuid", T.StringType()),
    T.StructField("observer_id", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("positional_accuracy_in_metres", T.DoubleType()),
    T.StructField("taxon_id", T.IntegerType()),
    T.StructField("quality_grade", T.StringType()),
    T.StructField("observation_date", T.DateType()),
    T.StructField("observation_geom_point", POINT),
    T.StructField("observed_in_known_area", T.BooleanType()),
])

SCHEMAS = {
    (STAGING, "observers_raw"): OBSERVERS_RAW,
    (STAGING, "observations_raw"): OBSERVATIONS_RAW,
    (STAGING, "taxa_raw"): TAXA_RAW,
    (STAGING, "species_geospatial_raw"): SPECIES_GEOSPATIAL_RAW,
    (PRODUCTION, "taxa"): TAXA,
    (PRODUCTION, "species_geospatial"): SPECIES_GEOSPATIAL,
    (PRODUCTION, "observers"): OBSERVERS,
    (PRODUCTION, "species_observations"): SPECIES_OBSERVATIONS,
}

# Declared primary keys, in key-column order. The quality gate checks these
# for NULLs only; two of them are not unique by design (taxa has one row per
# (taxon, ancestor); a species may own several geometry rows).
PRIMARY_KEYS = {
    (STAGING, "observers_raw"): ("observer_id",),
    (STAGING, "observations_raw"): ("observation_uuid",),
    (STAGING, "taxa_raw"): ("taxon_id",),
    (STAGING, "species_geospatial_raw"): ("id_no",),
    (PRODUCTION, "taxa"): ("taxon_id",),
    (PRODUCTION, "species_geospatial"): ("iucn_id",),
    (PRODUCTION, "observers"): ("observer_id",),
    (PRODUCTION, "species_observations"): ("observation_uuid",),
}

# Declared widths of text columns (characters), by table; columns that are not
# listed are unbounded. The gates count values that are longer.
WIDTHS = {
    (STAGING, "observers_raw"): {"login": 256, "name": 256},
    (STAGING, "observations_raw"): {"observation_uuid": 50, "quality_grade": 50},
    (STAGING, "taxa_raw"): {"ancestry": 256, "rank": 20, "name": 256},
    (STAGING, "species_geospatial_raw"): {
        c: 256 for c in ("compiler", "subspecies", "subpop", "source", "island", "tax_comm",
                         "dist_comm", "legend", "kingdom", "phylum", "class", "order_", "family",
                         "genus", "category")},
    (PRODUCTION, "taxa"): {"taxon_rank": 100, "taxon_name": 256, "ancestry_rank": 100,
                           "ancestry_name": 256},
    (PRODUCTION, "species_geospatial"): {"iucn_category_id": 2, "iucn_category_name": 50},
    (PRODUCTION, "observers"): {},
    (PRODUCTION, "species_observations"): {"observation_uuid": 50, "quality_grade": 20},
}

# Columns besides the keys that must not be NULL.
NOT_NULL = {(PRODUCTION, "species_geospatial"): ("taxon_id",)}


def declared_type(layer: str, table: str, field: T.StructField) -> str:
    """A column's type as the catalog declares it."""
    width = WIDTHS[(layer, table)].get(field.name)
    return f"varchar({width})" if width else field.dataType.simpleString()


# Physical layout per production table: how it is written so later scans
# can skip data (range or space: which file, sort: where in it) and later joins avoid
# shuffles (broadcast).
LAYOUT = {
    "taxa": {"sort": ("taxon_rank", "ancestry_id"), "broadcast": True},
    "species_geospatial": {"sort": ("iucn_category_id",), "broadcast": True},
    "observers": {"sort": ("first_observation_date",), "broadcast": False},
    # the fact is dealt out by a space-filling key over (date, taxon), so a file
    # holds a box of both and a bound on either skips most files (a hot cell is
    # divided by the observation id); sorted inside them for row groups
    "species_observations": {"space": ("observation_date", "taxon_id"),
                             "divided": ("observation_uuid",),
                             "sort": ("taxon_id", "observation_date"), "broadcast": False},
}

# --- fixed values -----------------------------------------------------------
# Red List category codes and their names, in the order the transform tests
# them. A code outside this list maps to NULL (no ELSE arm).
IUCN_CATEGORIES = [
    ("NE", "not evaluated"),
    ("DD", "data deficient"),
    ("LC", "least concern"),
    ("NT", "near threatened"),
    ("VU", "vulnerable"),
    ("EN", "endangered"),
    ("CR", "critically endangered"),
    ("EW", "extinct in the wild"),
    ("EX", "extinct"),
]
# Spatial reference id of observation points (WGS 84 lon/lat).
WGS84_SRID = 4326

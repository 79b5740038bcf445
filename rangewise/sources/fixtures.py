"""Raw warehouse inputs derived, by plain arithmetic, from the driver's
TPC-H-like tables (see FIXTURES.md section 3).

The driver ships no taxonomy or geometry, so this module plays the part of
the upstream files: it maps regions/nations/parts to a 4-level taxonomy,
lineitems to observations, customers to observers and parts to range
polygons (as WKT text, parsed by :mod:`rangewise.sources.layer` exactly like
a delivered layer). Every frame is lazy and grows with the driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangewise.schemas import IUCN_CATEGORIES
from rangewise.sources.layer import build_layer
from rangewise.sources.parallel import spread

# --- fixed values -----------------------------------------------------------
ROOT_TAXON_ID = 48460        # "Life", ancestry ''
REGION_TAXON_BASE = 1000     # class level: 1000 + r_regionkey
NATION_TAXON_BASE = 2000     # genus level: 2000 + n_nationkey
PART_TAXON_BASE = 100000     # species level: 100000 + p_partkey
CLASS_ID = 1001              # the class the warehouse is built for (region 1)
CLASS_PATH = "48460/1001"    # its ancestry path prefix
CLASS_ANCESTORS = (48460,)   # taxa above the class that are kept too
ORDERS = ("ANURA", "CAUDATA", "GYMNOPHIONA")  # layer order_ by p % 3
# L-shaped hexagon, vertex offsets from (x0, y0), counter-clockwise.
POLYGON_OFFSETS = [(0, 0), (60, 0), (60, 20), (20, 20), (20, 40), (0, 40)]


@dataclass(frozen=True)
class ClassScope:
    """Which part of the taxonomy the warehouse is built for."""

    class_id: int = CLASS_ID
    path_prefix: str = CLASS_PATH
    ancestors: tuple[int, ...] = CLASS_ANCESTORS
    strict_prefix: bool = False  # True: match 'prefix/' only (no sibling ids)


DEFAULT_SCOPE = ClassScope()


# Driver table schemas (FIXTURES.md section 2). Given to the reader so that
# planning needs no footer reads for schema inference.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def taxa_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = _read(spark, sf_dir, "region")
    nation = _read(spark, sf_dir, "nation")
    part = _read(spark, sf_dir, "part")
    root = spark.range(1).selectExpr(
        f"CAST({ROOT_TAXON_ID} AS INT) AS taxon_id", "'' AS ancestry", "100.0D AS rank_level",
        "'stateofmatter' AS rank", "'Life' AS name", "true AS active")
    regions = region.selectExpr(
        f"CAST({REGION_TAXON_BASE} + r_regionkey AS INT) AS taxon_id",
        f"'{ROOT_TAXON_ID}' AS ancestry", "50.0D AS rank_level", "'class' AS rank",
        "r_name AS name", "true AS active")
    nations = nation.selectExpr(
        f"CAST({NATION_TAXON_BASE} + n_nationkey AS INT) AS taxon_id",
        f"concat_ws('/', '{ROOT_TAXON_ID}', CAST({REGION_TAXON_BASE} + n_regionkey AS STRING))"
        " AS ancestry",
        "20.0D AS rank_level", "'genus' AS rank", "n_name AS name", "true AS active")
    species = part.join(nation, F.expr("p_partkey % 25 = n_nationkey")).selectExpr(
        f"CAST({PART_TAXON_BASE} + p_partkey AS INT) AS taxon_id",
        f"concat_ws('/', '{ROOT_TAXON_ID}', CAST({REGION_TAXON_BASE} + n_regionkey AS STRING),"
        f" CAST({NATION_TAXON_BASE} + n_nationkey AS STRING)) AS ancestry",
        "10.0D AS rank_level", "'species' AS rank",
        "concat('species_', CAST(p_partkey AS STRING)) AS name", "p_size % 7 <> 0 AS active")
    return root.unionByName(regions).unionByName(nations).unionByName(species)


def observations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spread(_read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_shipdate"))
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING),"
        " CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING)) AS observation_uuid",
        "CAST(o_custkey AS INT) AS observer_id",
        "CAST((l_orderkey * 7 + l_partkey * 3 + l_linenumber * 13) % 120 - 60 + 0.5 AS DOUBLE)"
        " AS latitude",
        "CAST((l_orderkey * 11 + l_partkey * 5 + l_linenumber * 17) % 240 - 120 + 0.5 AS DOUBLE)"
        " AS longitude",
        "CAST(l_quantity AS INT) AS positional_accuracy",
        f"CAST({PART_TAXON_BASE} + l_partkey AS INT) AS taxon_id",
        "CASE l_returnflag WHEN 'R' THEN 'research' WHEN 'N' THEN 'needs_id' ELSE 'casual' END"
        " AS quality_grade",
        "to_date(l_shipdate) AS observed_on",
    )


def observers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS INT) AS observer_id", "c_name AS login", "c_mktsegment AS name")


def _sql_list(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def layer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range layer as delivered: attributes + WKT, one row per geometry."""
    part = spread(_read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
                  .filter("p_partkey % 5 <> 0"))
    # k = 0 for every part, k = 1 as a second geometry row for even parts
    rows = part.selectExpr("*", "explode(CASE WHEN p_partkey % 2 = 0 THEN array(0, 1)"
                                " ELSE array(0) END) AS k")
    x0 = "((p_partkey * 7) % 140 - 110 + k * 60)"
    y0 = "((p_partkey * 11) % 60 - 55 + k * 20)"
    vert_list = ", ".join(
        f"concat(CAST({x0} + {dx} AS STRING), ' ', CAST({y0} + {dy} AS STRING))"
        for dx, dy in POLYGON_OFFSETS + POLYGON_OFFSETS[:1])
    codes = _sql_list(c for c, _ in IUCN_CATEGORIES)
    return rows.selectExpr(
        "CAST(p_partkey * 2 + k AS BIGINT) AS geom_row_id",
        "CAST(p_partkey AS INT) AS id_no",
        "concat('species_', CAST(p_partkey AS STRING)) AS binomial",
        "1 AS presence", "1 AS origin", "CAST(k + 1 AS INT) AS seasonal",
        "p_brand AS compiler", "CAST(1990 + p_partkey % 30 AS INT) AS yrcompiled",
        "p_type AS citation",
        "CAST(NULL AS STRING) AS subspecies", "CAST(NULL AS STRING) AS subpop",
        "CAST(NULL AS STRING) AS source", "CAST(NULL AS STRING) AS island",
        "CAST(NULL AS STRING) AS tax_comm", "CAST(NULL AS STRING) AS dist_comm",
        "0L AS generalised", "'Extant (resident)' AS legend", "'ANIMALIA' AS kingdom",
        "'CHORDATA' AS phylum", "'AMPHIBIA' AS class",
        f"element_at({_sql_list(ORDERS)}, CAST(p_partkey % 3 + 1 AS INT)) AS order_",
        "concat('FAMILY_', CAST(p_partkey % 11 AS STRING)) AS family",
        "concat('GENUS_', CAST(p_partkey % 13 AS STRING)) AS genus",
        f"element_at({codes}, CAST(p_partkey % {len(IUCN_CATEGORIES)} + 1 AS INT)) AS category",
        "false AS marine", "p_size % 2 = 0 AS terrestrial", "p_size % 3 = 0 AS freshwater",
        "CAST(NULL AS DOUBLE) AS shape_leng", "CAST(NULL AS DOUBLE) AS shape_area",
        f"concat('POLYGON ((', concat_ws(', ', {vert_list}), '))') AS wkt",
    )


# -- awkward geometry and rows -------------------------------------------------

# Vertices on each side of the many-vertex square (its text is well above 16 KB).
CASE_SIDE_VERTICES = 400


def case_layer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One geometry row per part, its shape by ``p_partkey % 6``: 0 a square
    with a hole, 1 two parts, 2 with a third ordinate, 3 NULL, 4 EMPTY, 5 a
    square of very many vertices. Squares have side 10 and begin at (x0, y0)."""
    part = spread(_read(spark, sf_dir, "part").select("p_partkey")).selectExpr(
        "p_partkey", "p_partkey * 7 % 40 - 20 AS x0", "p_partkey * 11 % 30 - 15 AS y0")

    def ring(points, z: str = "") -> str:
        corner = [f"concat(x0 + {x}, ' ', y0 + {y}{z})" for x, y in [*points, points[0]]]
        return f"concat('(', concat_ws(', ', {', '.join(corner)}), ')')"

    def box(a: int, b: int):
        return [(a, a), (b, a), (b, b), (a, b)]

    # i * 10 / n for each vertex of a side, as literals; one ordinate of a side stands
    # still, so it is part of what joins the others
    n = CASE_SIDE_VERTICES
    steps = f"array({', '.join(f'{i * 10 / n!r}D' for i in range(n))})"

    def along_x(x: str, y: str) -> str:
        return f"concat(concat_ws(concat(' ', {y}, ', '), transform({steps}, step -> cast({x} AS string))), ' ', {y})"

    def along_y(x: str, y: str) -> str:
        return f"concat({x}, ' ', concat_ws(concat(', ', {x}, ' '), transform({steps}, step -> cast({y} AS string))))"

    dense = "concat_ws(', ', " + ", ".join((
        along_x("x0 + step", "y0"), along_y("x0 + 10", "y0 + step"),
        along_x("x0 + 10 - step", "y0 + 10"), along_y("x0", "y0 + 10 - step"))) + ", concat(x0, ' ', y0))"
    wkt = f"""CASE p_partkey % 6
        WHEN 0 THEN concat('POLYGON (', {ring(box(0, 10))}, ', ', {ring(box(3, 7))}, ')')
        WHEN 1 THEN concat('MULTIPOLYGON ((', {ring(box(0, 4))}, '), (', {ring(box(6, 10))}, '))')
        WHEN 2 THEN concat('POLYGON Z (', {ring(box(0, 10), ", ' 5'")}, ')')
        WHEN 4 THEN 'POLYGON EMPTY'
        WHEN 5 THEN concat('POLYGON ((', {dense}, '))') END"""
    return part.selectExpr("p_partkey AS geom_row_id", "CAST(p_partkey AS INT) AS id_no",
                           "concat('species_', p_partkey) AS binomial", "'DD' AS category",
                           f"{wkt} AS wkt")


def case_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations at whole coordinates, so that many lie on edges and
    vertices, with NULL ids, dates and coordinates, each row twice."""
    li = spread(_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate"))
    rows = li.selectExpr(
        "CASE WHEN l_orderkey % 19 <> 0 THEN concat_ws('-', l_orderkey, l_linenumber, l_partkey) END"
        " AS observation_uuid",
        "CAST(l_orderkey % 50 AS INT) AS observer_id",
        "CASE WHEN l_orderkey % 13 <> 0 THEN CAST(l_partkey * 11 % 30 - 15"
        " + (l_orderkey * 5 + l_linenumber * 7) % 13 - 1 AS DOUBLE) END AS latitude",
        "CASE WHEN l_orderkey % 17 <> 0 THEN CAST(l_partkey * 7 % 40 - 20"
        " + (l_orderkey * 3 + l_linenumber) % 13 - 1 AS DOUBLE) END AS longitude",
        "CAST(l_linenumber AS INT) AS positional_accuracy",
        f"CAST({PART_TAXON_BASE} + l_partkey AS INT) AS taxon_id", "'research' AS quality_grade",
        "CASE WHEN l_orderkey % 23 <> 0 THEN to_date(l_shipdate) END AS observed_on")
    return rows.unionByName(rows)


def species_geospatial_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_layer(layer_source(spark, sf_dir), wkt_col="wkt")


class RawTables:
    """The four staging inputs. Frames may be given directly or as zero-argument
    builders; a builder runs on first access, so a job only constructs the
    inputs it reads."""

    _NAMES = ("taxa_raw", "observations_raw", "observers_raw", "species_geospatial_raw")

    def __init__(self, taxa_raw, observations_raw, observers_raw, species_geospatial_raw):
        self._src = dict(zip(self._NAMES, (taxa_raw, observations_raw, observers_raw,
                                           species_geospatial_raw)))
        self._built: dict[str, DataFrame] = {}

    def _get(self, name: str) -> DataFrame:
        if name not in self._built:
            v = self._src[name]
            self._built[name] = v if isinstance(v, DataFrame) else v()
        return self._built[name]

    taxa_raw = property(lambda self: self._get("taxa_raw"))
    observations_raw = property(lambda self: self._get("observations_raw"))
    observers_raw = property(lambda self: self._get("observers_raw"))
    species_geospatial_raw = property(lambda self: self._get("species_geospatial_raw"))


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        taxa_raw=lambda: taxa_raw(spark, sf_dir),
        observations_raw=lambda: observations_raw(spark, sf_dir),
        observers_raw=lambda: observers_raw(spark, sf_dir),
        species_geospatial_raw=lambda: species_geospatial_raw(spark, sf_dir),
    )

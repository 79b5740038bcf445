"""Reference answers as DuckDB SQL over the driver's raw tables.

The oracle only sees the raw driver views, so every statement carries the
fixture derivations and the warehouse transforms as CTEs. The spatial flag
is computed the slow, obvious way here - one row per (observation, geometry
row, edge), crossings summed per pair - so it checks the Spark per-row
``aggregate`` form independently. Unreferenced CTEs cost nothing in DuckDB.
"""

from __future__ import annotations

import re

from rangewise.functions.text import NEEDS_CLEANING_PATTERN
from rangewise.plans.jobs import TSV_COLUMNS
from rangewise.schemas import IUCN_CATEGORIES
from rangewise.sources.fixtures import (CLASS_ANCESTORS, CLASS_ID, CLASS_PATH, ORDERS,
                                        POLYGON_OFFSETS)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _edge_values() -> str:
    pts = POLYGON_OFFSETS + POLYGON_OFFSETS[:1]
    return ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(pts, pts[1:]))


def _category_case(col: str) -> str:
    arms = " ".join(f"WHEN {col} = {_q(c)} THEN {_q(n)}" for c, n in IUCN_CATEGORIES)
    return f"CASE {arms} END"


_CODES = "[" + ", ".join(_q(c) for c, _ in IUCN_CATEGORIES) + "]"
_ORDERS = "[" + ", ".join(_q(o) for o in ORDERS) + "]"
_ANCESTORS = ", ".join(str(a) for a in CLASS_ANCESTORS)

CTES = f"""
taxa_raw AS (
  SELECT CAST(48460 AS INTEGER) AS taxon_id, '' AS ancestry, CAST(100.0 AS DOUBLE) AS rank_level,
         'stateofmatter' AS rank, 'Life' AS name, true AS active
  UNION ALL
  SELECT CAST(1000 + r_regionkey AS INTEGER), '48460', CAST(50.0 AS DOUBLE), 'class', r_name, true
  FROM region
  UNION ALL
  SELECT CAST(2000 + n_nationkey AS INTEGER), '48460/' || CAST(1000 + n_regionkey AS VARCHAR),
         CAST(20.0 AS DOUBLE), 'genus', n_name, true
  FROM nation
  UNION ALL
  SELECT CAST(100000 + p_partkey AS INTEGER),
         '48460/' || CAST(1000 + n_regionkey AS VARCHAR) || '/' || CAST(2000 + n_nationkey AS VARCHAR),
         CAST(10.0 AS DOUBLE), 'species', 'species_' || CAST(p_partkey AS VARCHAR), p_size % 7 <> 0
  FROM part JOIN nation ON n_nationkey = p_partkey % 25
),
obs_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
           || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS observation_uuid,
         CAST(o_custkey AS INTEGER) AS observer_id,
         CAST((l_orderkey * 7 + l_partkey * 3 + l_linenumber * 13) % 120 - 60 AS DOUBLE) + 0.5 AS latitude,
         CAST((l_orderkey * 11 + l_partkey * 5 + l_linenumber * 17) % 240 - 120 AS DOUBLE) + 0.5 AS longitude,
         CAST(l_quantity AS INTEGER) AS positional_accuracy,
         CAST(100000 + l_partkey AS INTEGER) AS taxon_id,
         CASE l_returnflag WHEN 'R' THEN 'research' WHEN 'N' THEN 'needs_id' ELSE 'casual' END
           AS quality_grade,
         CAST(l_shipdate AS DATE) AS observed_on
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
),
observers_raw AS (
  SELECT CAST(c_custkey AS INTEGER) AS observer_id, c_name AS login, c_mktsegment AS name
  FROM customer
),
geo_rows AS (
  SELECT p_partkey * 2 + k AS gid,
         (p_partkey * 7) % 140 - 110 + 60 * k AS x0,
         (p_partkey * 11) % 60 - 55 + 20 * k AS y0,
         CAST(p_partkey AS INTEGER) AS id_no,
         'species_' || CAST(p_partkey AS VARCHAR) AS binomial,
         p_brand AS compiler,
         CAST(1990 + p_partkey % 30 AS INTEGER) AS yrcompiled,
         p_type AS citation,
         {_CODES}[p_partkey % 9 + 1] AS category,
         {_ORDERS}[p_partkey % 3 + 1] AS order_,
         false AS marine, p_size % 2 = 0 AS terrestrial, p_size % 3 = 0 AS freshwater,
         CAST(200.0 AS DOUBLE) AS shape_leng, CAST(1600.0 AS DOUBLE) AS shape_area
  FROM part JOIN (SELECT unnest([0, 1]) AS k) ks ON k = 0 OR p_partkey % 2 = 0
  WHERE p_partkey % 5 <> 0
),
geo_edges AS (
  SELECT g.gid, g.x0 + e.dx1 AS x1, g.y0 + e.dy1 AS y1, g.x0 + e.dx2 AS x2, g.y0 + e.dy2 AS y2
  FROM geo_rows g JOIN (VALUES {_edge_values()}) e(dx1, dy1, dx2, dy2) ON true
),
tx AS (
  SELECT * FROM taxa_raw WHERE ancestry LIKE '{CLASS_PATH}%' OR taxon_id IN ({_ANCESTORS})
),
tm AS (
  SELECT *, CASE WHEN ancestry = '' THEN NULL
                 ELSE CAST(trim(string_split(ancestry, '/')[ancestry_position]) AS INTEGER) END
              AS ancestry_id
  FROM (SELECT tx.*, CAST(generate_subscripts(string_split(ancestry, '/'), 1) AS INTEGER)
                 AS ancestry_position FROM tx)
),
taxa_x AS (
  SELECT m.taxon_id, m.rank AS taxon_rank, CAST(round_even(m.rank_level, 0) AS INTEGER) AS taxon_rank_level,
         m.name AS taxon_name, m.active AS taxon_active, m.ancestry AS taxon_ancestry,
         m.ancestry_id, m.ancestry_position, t.rank AS ancestry_rank,
         CAST(round_even(t.rank_level, 0) AS INTEGER) AS ancestry_rank_level,
         t.name AS ancestry_name, t.active AS ancestry_active
  FROM tm m LEFT JOIN taxa_raw t ON m.ancestry_id = t.taxon_id AND m.ancestry_id <> m.taxon_id
),
species_cls AS (
  SELECT taxon_id, taxon_name FROM taxa_x WHERE taxon_rank = 'species' AND ancestry_id = {CLASS_ID}
),
ranges AS (
  SELECT g.id_no AS iucn_id, s.taxon_id, g.compiler AS compiled_by, g.citation,
         g.yrcompiled AS year_compiled, g.category AS iucn_category_id,
         {_category_case('g.category')} AS iucn_category_name,
         g.marine, g.terrestrial, g.freshwater, g.shape_leng AS shape_length, g.shape_area
  FROM geo_rows g JOIN species_cls s ON g.binomial = s.taxon_name
),
pairs AS (
  SELECT DISTINCT o.*, g.gid
  FROM obs_raw o JOIN species_cls s ON s.taxon_id = o.taxon_id
                 JOIN geo_rows g ON g.binomial = s.taxon_name
  WHERE o.observation_uuid IS NOT NULL
),
pair_flags AS (
  SELECT p.observation_uuid, p.observer_id, p.latitude, p.longitude, p.positional_accuracy,
         p.taxon_id, p.quality_grade, p.observed_on, p.gid,
         CASE WHEN p.latitude IS NULL OR p.longitude IS NULL THEN NULL
              WHEN bool_or((e.x2 - e.x1) * (p.latitude - e.y1) = (e.y2 - e.y1) * (p.longitude - e.x1)
                           AND p.longitude BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                           AND p.latitude BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))
                THEN false
              ELSE sum(CASE WHEN (e.y1 > p.latitude) <> (e.y2 > p.latitude)
                             AND p.longitude < (e.x2 - e.x1) * (p.latitude - e.y1) / (e.y2 - e.y1) + e.x1
                            THEN 1 ELSE 0 END) % 2 = 1
         END AS inside
  FROM pairs p JOIN geo_edges e ON e.gid = p.gid
  GROUP BY p.observation_uuid, p.observer_id, p.latitude, p.longitude, p.positional_accuracy,
           p.taxon_id, p.quality_grade, p.observed_on, p.gid
),
fact AS (
  SELECT observation_uuid, observer_id, latitude, longitude,
         CAST(positional_accuracy AS DOUBLE) AS positional_accuracy_in_metres, taxon_id,
         quality_grade, observed_on AS observation_date, bool_or(inside) AS observed_in_known_area
  FROM pair_flags
  GROUP BY observation_uuid, observer_id, latitude, longitude, positional_accuracy, taxon_id,
           quality_grade, observed_on
),
observers_dim AS (
  SELECT r.observer_id, r.login AS login_name, r.name AS observer_name,
         min(f.observation_date) AS first_observation_date
  FROM observers_raw r JOIN fact f ON r.observer_id = f.observer_id
  GROUP BY r.observer_id, r.login, r.name
)
"""


def with_ctes(body: str) -> str:
    return "WITH " + CTES.strip() + "\n" + body.strip()


SINCE = "DATE '1998-01-01'"


def _hist(values_sql: str, bins: int = 50) -> str:
    return f"""
, v AS ({values_sql}),
r AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v),
b AS (SELECT least(CAST(floor((x - lo) * {bins} / (hi - lo)) AS INTEGER), {bins - 1}) AS bin,
             count(*) AS frequency FROM v JOIN r ON true GROUP BY 1),
e AS (SELECT CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / {bins}) AS bin_lo,
             lo + (i + 1) * ((hi - lo) / {bins}) AS bin_hi
      FROM range({bins}) t(i) JOIN r ON true)
SELECT e.bin, e.bin_lo, e.bin_hi, CAST(coalesce(b.frequency, 0) AS BIGINT) AS frequency
FROM e LEFT JOIN b ON e.bin = b.bin
"""


def _with_hist(values_sql: str) -> str:
    return "WITH " + CTES.strip() + _hist(values_sql)


def _profile_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
        f"coalesce(bool_or(regexp_matches({c}, '{NEEDS_CLEANING_PATTERN}')), false) AS needs_cleaning "
        f"FROM {table}" for c in cols)


def _clean_sql() -> str:
    """DuckDB's own accent stripping, not the table of the code under test.
    The spellings in other scripts were made from the text letter by letter,
    so cleaning them must give the cleaned text again."""
    def cleaned(c: str) -> str:
        out = f"strip_accents(replace({c}, 'ß', 'ss'))"
        return f"replace(replace({out}, chr(13) || chr(10), ''), chr(10), '')"
    return (f"SELECT doc_id, {cleaned('text')} AS text, {cleaned('lang')} AS lang, "
            f"{cleaned('source')} AS source, n_chars, {cleaned('text')} AS text_greek, "
            f"{cleaned('text')} AS text_cyrillic, {cleaned('text')} AS text_kana, "
            f"{cleaned('text')} AS text_hangul FROM documents")


_STAGING_KEYS = [("observers_raw", "observers_raw", "observer_id"),
                 ("observations_raw", "obs_raw", "observation_uuid"),
                 ("taxa_raw", "taxa_raw", "taxon_id"),
                 ("species_geospatial_raw", "geo_rows", "id_no")]
_PROD_KEYS = [("taxa", "taxa_x", "taxon_id"),
              ("species_geospatial", "ranges", "iucn_id"),
              ("observers", "observers_dim", "observer_id"),
              ("species_observations", "fact", "observation_uuid")]


def _checks(with_keys: bool, compare: bool = False) -> str:
    parts = []
    for layer, items in (("staging", _STAGING_KEYS), ("production", _PROD_KEYS)):
        for name, cte, key in items:
            extra = (f", '{key}' AS key_column, count(*) FILTER (WHERE {key} IS NULL) AS null_keys"
                     if with_keys else "")
            if compare:
                extra = ", CAST(0 AS BIGINT) AS mismatched_rows"
            parts.append(f"SELECT '{layer}' AS layer, '{name}' AS table_name, "
                         f"count(*) AS records{extra} FROM {cte}")
    return with_ctes(" UNION ALL ".join(parts))


def _cases_sql() -> str:
    """Shapes are unions of squares, so strictly inside is plain comparisons."""
    dx, dy = "(longitude - (p * 7 % 40 - 20))", "(latitude - (p * 11 % 30 - 15))"

    def inside(a: int, b: int, op: str = "<") -> str:
        return f"({a} {op} {dx} AND {dx} {op} {b} AND {a} {op} {dy} AND {dy} {op} {b})"

    return with_ctes(f"""
    , case_rows AS (
      SELECT DISTINCT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS observation_uuid,
        CAST(l_orderkey % 50 AS INTEGER) AS observer_id,
        CASE WHEN l_orderkey % 13 <> 0 THEN CAST(l_partkey * 11 % 30 - 15
             + (l_orderkey * 5 + l_linenumber * 7) % 13 - 1 AS DOUBLE) END AS latitude,
        CASE WHEN l_orderkey % 17 <> 0 THEN CAST(l_partkey * 7 % 40 - 20
             + (l_orderkey * 3 + l_linenumber) % 13 - 1 AS DOUBLE) END AS longitude,
        CAST(l_linenumber AS DOUBLE) AS positional_accuracy_in_metres,
        CAST(100000 + l_partkey AS INTEGER) AS taxon_id, 'research' AS quality_grade,
        CASE WHEN l_orderkey % 23 <> 0 THEN CAST(l_shipdate AS DATE) END AS observation_date,
        l_partkey AS p
      FROM lineitem WHERE l_orderkey % 19 <> 0)
    SELECT * EXCLUDE (p), CASE
        WHEN latitude IS NULL OR longitude IS NULL OR p % 6 = 3 THEN NULL
        WHEN p % 6 = 4 THEN false
        WHEN p % 6 = 0 THEN {inside(0, 10)} AND NOT {inside(3, 7, "<=")}
        WHEN p % 6 = 1 THEN {inside(0, 4)} OR {inside(6, 10)}
        ELSE {inside(0, 10)} END AS observed_in_known_area
    FROM case_rows WHERE taxon_id IN (SELECT taxon_id FROM species_cls)""")


def _tsv_sql() -> str:
    a = "translate(translate(text, ' ,.', chr(9) || chr(92) || chr(10)), 't', chr(13))"
    b = "translate(text, 'aeo', chr(1) || chr(2) || chr(92))"
    n = "NULL::VARCHAR"

    def row(table: str, **columns: str) -> str:
        return f"SELECT '{table}' AS table_name, " + ", ".join(
            f"({columns.get(c, n)})::VARCHAR AS {c}" for c in TSV_COLUMNS) + " FROM documents"

    return " UNION ALL ".join([
        row("observers_raw", observer_id="doc_id", login=a, name=b),
        row("observations_raw", observation_uuid=a, observer_id="doc_id", latitude="(doc_id / 8)::DOUBLE",
            positional_accuracy="doc_id", taxon_id="doc_id", quality_grade=b,
            observed_on="DATE '1999-12-31' + doc_id::INTEGER"),
        row("taxa_raw", taxon_id="doc_id", ancestry=a, rank_level="(doc_id / 4)::DOUBLE", rank="lang",
            name=b, active="doc_id % 2 = 0")])


# The tables as declared (column type, in order; * marks key columns).
_DECLARED = {
    ("staging", "observers_raw", "observers_raw"):
        "observer_id int*, login varchar(256), name varchar(256)",
    ("staging", "observations_raw", "obs_raw"):
        "observation_uuid varchar(50)*, observer_id int, latitude double, longitude double, "
        "positional_accuracy int, taxon_id int, quality_grade varchar(50), observed_on date",
    ("staging", "taxa_raw", "taxa_raw"):
        "taxon_id int*, ancestry varchar(256), rank_level double, rank varchar(20), "
        "name varchar(256), active boolean",
    ("production", "taxa", "taxa_x"):
        "taxon_id int*, taxon_rank varchar(100), taxon_rank_level int, taxon_name varchar(256), "
        "taxon_active boolean, taxon_ancestry string, ancestry_id int, ancestry_position int, "
        "ancestry_rank varchar(100), ancestry_rank_level int, ancestry_name varchar(256), "
        "ancestry_active boolean",
    ("production", "observers", "observers_dim"):
        "observer_id int*, login_name string, observer_name string, first_observation_date date",
    ("production", "species_observations", "fact"):
        "observation_uuid varchar(50)*, observer_id int, latitude double, longitude double, "
        "positional_accuracy_in_metres double, taxon_id int, quality_grade varchar(20), "
        "observation_date date, observation_geom_point struct<lon:double,lat:double,srid:int>, "
        "observed_in_known_area boolean",
    ("production", "species_geospatial", "ranges"):
        "iucn_id int*, taxon_id int, compiled_by string, citation string, year_compiled int, "
        "iucn_category_id varchar(2), iucn_category_name varchar(50), marine boolean, "
        "terrestrial boolean, freshwater boolean, shape_length double, shape_area double, "
        "geometry array<array<struct<x:double,y:double>>>",
}


# The staged layer: its columns, declared here once more, and parsed geometry.
_LAYER_DECLARED = [
    ("geom_row_id", "bigint"), ("id_no", "int"), ("binomial", "string"), ("presence", "int"), ("origin", "int"),
    ("seasonal", "int"), ("compiler", "varchar(256)"), ("yrcompiled", "int"), ("citation", "string"),
    *[(c, "varchar(256)") for c in ("subspecies", "subpop", "source", "island", "tax_comm", "dist_comm")],
    ("generalised", "bigint"),
    *[(c, "varchar(256)") for c in ("legend", "kingdom", "phylum", "class", "order_", "family", "genus", "category")],
    ("marine", "boolean"), ("terrestrial", "boolean"), ("freshwater", "boolean"), ("shape_leng", "double"),
    ("shape_area", "double"), ("rings", "array<array<struct<x:double,y:double>>>"),
    ("edges", "array<struct<x1:double,y1:double,x2:double,y2:double>>"),
    *[(c, "double") for c in ("xmin", "ymin", "xmax", "ymax")], ("geom_bytes", "bigint")]


def _malformed_sql() -> str:
    """The faulty texts made again; a text is read if the whole of it is a
    polygon of pairs of numbers."""
    from rangewise.plans.jobs import WKT_FAULTS
    ring = ", ".join(f"(x0 + {x})::VARCHAR || ' ' || (y0 + {y})::VARCHAR" for x, y in
                     [*POLYGON_OFFSETS, POLYGON_OFFSETS[0]])
    changed = " ".join(f"WHEN {k} THEN regexp_replace(wkt, '{p}', '{by}', 'g')" for k, (p, by) in WKT_FAULTS.items())
    number = "[-+]?[0-9.]+"
    return with_ctes(f"""
SELECT geom_row_id, left(wkt, 80) AS wkt_start,
       CASE WHEN NOT regexp_matches(wkt, '^POLYGON') THEN 'tag'
            WHEN len(regexp_extract_all(wkt, '[(]')) <> len(regexp_extract_all(wkt, '[)]')) THEN 'outline'
            ELSE 'vertex' END AS fault
FROM (SELECT gid AS geom_row_id, CASE gid % 6 {changed} ELSE wkt END AS wkt
      FROM (SELECT gid, 'POLYGON ((' || concat_ws(', ', {ring}) || '))' AS wkt FROM geo_rows))
WHERE NOT regexp_full_match(wkt, 'POLYGON [(][(]{number} {number}(, {number} {number})*[)][)]')
""")


def _whole_keys_sql() -> str:
    parts = []
    for layer, name, cte, keys in (
            ("production", "taxa", "taxa_x", ("taxon_id", "ancestry_position")),
            ("staging", "species_geospatial_raw", "geo_rows", ("id_no", "gid")),
            ("staging", "observers_raw", "observers_raw", ("observer_id",))):
        whole = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        for n, k in enumerate(keys, 1):
            parts.append(
                f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS records, "
                f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {cte} WHERE {whole})) AS distinct_keys, "
                f"{n}::INTEGER AS key_position, '{'geom_row_id' if k == 'gid' else k}' AS key_column, "
                f"count(*) FILTER (WHERE {k} IS NULL) AS null_keys FROM {cte}")
    return with_ctes(" UNION ALL ".join(parts))


def _catalog_sql() -> str:
    parts = [f"SELECT 'staging' AS layer, 'species_geospatial_raw' AS table_name, '{c}' AS column_name, "
             f"'{t}' AS data_type, {'1' if c == 'id_no' else 'NULL'}::INTEGER AS key_position, "
             "(SELECT count(*) FROM geo_rows) AS records" for c, t in _LAYER_DECLARED]
    for (layer, name, cte), declared in _DECLARED.items():
        columns = re.findall(r"(\w+) ([^ ,*]+(?:,\w+:[^ *]+)?)(\*?)(?:, |$)", declared)
        for column, kind, key in columns:
            parts.append(
                f"SELECT '{layer}' AS layer, '{name}' AS table_name, '{column}' AS column_name, "
                f"'{kind}' AS data_type, {'1' if key else 'NULL'}::INTEGER AS key_position, "
                f"(SELECT count(*) FROM {cte}) AS records")
    return with_ctes(" UNION ALL ".join(parts))


def _oblique_sql() -> str:
    """In whole units: every product fits 64 bits."""
    from rangewise.plans.jobs import OBLIQUE, OBLIQUE_SHIFTS
    columns = ", ".join(f"({v})::BIGINT AS {k}" for k, v in OBLIQUE.items())
    shifts = ", ".join(map(str, OBLIQUE_SHIFTS))
    return f"""
WITH items AS (
  SELECT row_number() OVER () AS r, l_orderkey, l_linenumber, {columns} FROM lineitem
), points AS (
  SELECT r, l_orderkey, l_linenumber, shift, ax + t * dx AS px, ay + t * dy + shift AS py
  FROM items, (SELECT unnest([{shifts}])::INTEGER AS shift)
), sides AS (
  SELECT r, ax AS x1, ay AS y1, ax + t_all * dx AS x2, ay + t_all * dy AS y2 FROM items
  UNION ALL
  SELECT r, ax + t_all * dx, ay + t_all * dy, ax - t_all * dy, ay + t_all * dx FROM items
  UNION ALL
  SELECT r, ax - t_all * dy, ay + t_all * dx, ax, ay FROM items
), turned AS (
  SELECT p.*, x1, y1, x2, y2, (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) AS turn
  FROM points p JOIN sides USING (r)
)
SELECT l_orderkey, l_linenumber, shift,
       NOT bool_or(turn = 0 AND px BETWEEN least(x1, x2) AND greatest(x1, x2)
                   AND py BETWEEN least(y1, y2) AND greatest(y1, y2))
       AND count(*) FILTER (WHERE (y1 > py) <> (y2 > py) AND (turn > 0) = (y2 > y1)) % 2 = 1 AS inside
FROM turned GROUP BY r, l_orderkey, l_linenumber, shift
"""


def _rollup_sql() -> str:
    return with_ctes(
        "SELECT ancestry_id, taxon_rank, count(DISTINCT taxon_id) AS taxa FROM taxa_x "
        "WHERE ancestry_id IS NOT NULL GROUP BY ALL")


def _snapshot_sql() -> str:
    """Rows of the four production tables, for each of two versions."""
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS records FROM {cte}" for name, cte in (
            ("taxa", "taxa_x"), ("species_geospatial", "ranges"), ("observers", "observers_dim"),
            ("species_observations", "fact")))
    return with_ctes(f"SELECT version::INTEGER AS version, c.* FROM ({counts}) c, (VALUES (1), (2)) v(version)")


def oracle_sql() -> dict[str, str]:
    fact_cols = ("observation_uuid, observer_id, latitude, longitude, positional_accuracy_in_metres, "
                 "taxon_id, quality_grade, observation_date, observed_in_known_area")
    return {
        "known_area_counts": with_ctes(
            "SELECT quality_grade, observed_in_known_area, count(*) AS observations "
            "FROM fact GROUP BY ALL"),
        "refresh_from_files": with_ctes(
            "SELECT quality_grade, observed_in_known_area, count(*) AS observations "
            "FROM fact GROUP BY ALL"),
        "taxa_ancestry": with_ctes("SELECT * FROM taxa_x"),
        "species_ranges": with_ctes(
            "SELECT r.*, v.geometry FROM ranges r JOIN (SELECT DISTINCT id_no, (count(*) OVER (PARTITION BY gid) + 1)"
            "::INTEGER AS geometry FROM geo_rows JOIN geo_edges USING (gid)) v ON v.id_no = r.iucn_id"),
        "observers_per_period": with_ctes(" UNION ALL ".join(
            f"SELECT '{k}' AS kind, {p} AS period, count(DISTINCT observer_id) AS observers FROM fact GROUP BY 2"
            for k, p in (("day", "observation_date"), ("month", "date_trunc('month', observation_date)::DATE"),
                         ("year", "date_trunc('year', observation_date)::DATE")))),
        "species_observations": with_ctes(
            f"SELECT {fact_cols}, printf('4326 %.2f %.2f', longitude, latitude)"
            " AS observation_geom_point FROM fact"),
        "species_observations_partitioned": with_ctes(f"SELECT {fact_cols} FROM fact"),
        "geometry_cases": _cases_sql(),
        "geometry_cases_partitioned": _cases_sql(),
        "geometry_cases_cells": _cases_sql(),
        "geometry_oblique_cases": _oblique_sql(),
        "species_observations_cells": with_ctes(f"SELECT {fact_cols} FROM fact"),
        "observers_first_seen": with_ctes("SELECT * FROM observers_dim"),
        "observers_per_year": with_ctes(
            "SELECT count(DISTINCT observer_id) AS observers, "
            "CAST(date_part('year', observation_date) AS INTEGER) AS year FROM fact GROUP BY 2"),
        # outside sightings are counted per taxon first, names and labels looked up after
        "dd_out_of_range_top5": with_ctes("""
            , outside AS (SELECT taxon_id, count(observation_uuid) AS seen FROM fact
                          WHERE quality_grade = 'research' AND NOT observed_in_known_area GROUP BY 1)
            SELECT seen * (SELECT count(*) FROM species_cls s WHERE s.taxon_id = outside.taxon_id)
                     AS observations, taxon_id,
                   (SELECT min(s.taxon_name) FROM species_cls s WHERE s.taxon_id = outside.taxon_id)
                     AS species_name, 'data deficient' AS iucn_category_name
            FROM outside
            WHERE taxon_id IN (SELECT r.taxon_id FROM ranges r WHERE r.iucn_category_id = 'DD')
            ORDER BY 1 DESC, 2 LIMIT 5"""),
        "species_top_observers": with_ctes("""
            , sightings AS (SELECT observer_id, count(observation_uuid) AS n FROM fact
                            WHERE taxon_id = 100656 AND observer_id IS NOT NULL GROUP BY 1)
            SELECT n AS total_observations, observer_id, d.login_name, d.observer_name
            FROM observers_dim d SEMI JOIN sightings USING (observer_id)
            JOIN sightings USING (observer_id) ORDER BY n DESC, observer_id LIMIT 5"""),
        "observation_total": with_ctes("SELECT count(*) AS records FROM fact"),
        "taxa_total": with_ctes("SELECT count(*) AS records FROM taxa_x"),
        "observer_total": with_ctes("SELECT count(observer_id) AS records FROM observers_dim"),
        "layer_total": with_ctes("SELECT count(*) AS records FROM geo_rows"),
        "obs_per_taxon": with_ctes(
            f"SELECT count(*) AS records, taxon_id FROM fact WHERE observation_date >= {SINCE} "
            "GROUP BY taxon_id"),
        "obs_per_month": with_ctes(
            "SELECT count(*) AS total_observations, "
            "date_trunc('month', observation_date)::TIMESTAMP AS month FROM fact "
            f"WHERE observation_date >= {SINCE} GROUP BY 2"),
        "obs_per_day": with_ctes(
            "SELECT count(*) AS total_observations, observation_date FROM fact "
            f"WHERE observation_date >= {SINCE} GROUP BY 2"),
        "hist_taxon": _with_hist(
            f"SELECT CAST(count(*) AS DOUBLE) AS x FROM fact WHERE observation_date >= {SINCE} "
            "GROUP BY taxon_id"),
        "hist_month": _with_hist(
            f"SELECT CAST(count(*) AS DOUBLE) AS x FROM fact WHERE observation_date >= {SINCE} "
            "GROUP BY date_trunc('month', observation_date)"),
        "hist_day": _with_hist(
            f"SELECT CAST(count(*) AS DOUBLE) AS x FROM fact WHERE observation_date >= {SINCE} "
            "GROUP BY observation_date"),
        "rank_rollup": _rollup_sql(),
        "rank_rollup_intervals": _rollup_sql(),
        "taxa_below_class": with_ctes(
            f"SELECT * FROM taxa_raw WHERE starts_with(ancestry || '/', '{CLASS_PATH}/')"),
        "snapshot_tables": _snapshot_sql(),
        "taxa_fanout": with_ctes(
            "SELECT min(cnt) AS min_cnt, max(cnt) AS max_cnt, avg(cnt) AS avg_cnt, "
            "CAST(median(cnt) AS DOUBLE) AS median_cnt "
            "FROM (SELECT count(*) AS cnt FROM taxa_x GROUP BY taxon_id)"),
        "taxon_lookup": with_ctes("SELECT * FROM taxa_raw WHERE name = 'AMERICA'"),
        "active_species": with_ctes(
            f"SELECT * FROM taxa_raw WHERE ancestry IS NOT NULL "
            f"AND contains(lower(ancestry), '{CLASS_ID}') AND rank = 'species' AND active = true"),
        "active_species_observations": with_ctes(
            "SELECT taxon_id, count(*) AS records FROM fact WHERE taxon_id IN ("
            "SELECT taxon_id FROM taxa_raw WHERE ancestry IS NOT NULL "
            f"AND contains(lower(ancestry), '{CLASS_ID}') AND rank = 'species' AND active = true) "
            "GROUP BY taxon_id"),
        "distinct_ranks": with_ctes("SELECT DISTINCT rank FROM taxa_raw WHERE ancestry IS NOT NULL"),
        "distinct_grades": with_ctes("SELECT DISTINCT quality_grade FROM obs_raw"),
        "layer_species_counts": with_ctes(
            "SELECT count(*) AS geometry_rows, CAST(count(DISTINCT binomial) + "
            "max(CASE WHEN binomial IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS species FROM geo_rows"),
        "layer_by_order": with_ctes(
            "SELECT id_no, binomial, order_, category, shape_leng, shape_area FROM geo_rows "
            "WHERE order_ = 'ANURA'"),
        "layer_by_species": with_ctes(
            "SELECT id_no, binomial, order_, category, CAST(x0 AS DOUBLE) AS xmin, "
            "CAST(y0 AS DOUBLE) AS ymin, CAST(x0 + 60 AS DOUBLE) AS xmax, "
            "CAST(y0 + 40 AS DOUBLE) AS ymax FROM geo_rows WHERE binomial = 'species_656'"),
        "obs_by_category": with_ctes(
            "SELECT c.iucn_category_id, c.iucn_category_name, count(*) AS observations "
            "FROM fact f JOIN (SELECT DISTINCT taxon_id, iucn_category_id, iucn_category_name "
            "FROM ranges) c ON f.taxon_id = c.taxon_id GROUP BY ALL"),
        "obs_grid_density": with_ctes(
            "SELECT CAST(floor(longitude / 10) * 10 AS INTEGER) AS cell_lon, "
            "CAST(floor(latitude / 10) * 10 AS INTEGER) AS cell_lat, count(*) AS observations "
            "FROM fact WHERE longitude IS NOT NULL AND latitude IS NOT NULL GROUP BY 1, 2"),
        "out_of_range_share": with_ctes(
            "SELECT taxon_id, count(*) AS observations, "
            "count(*) FILTER (WHERE observed_in_known_area IS false) AS out_of_range, "
            "count(*) FILTER (WHERE observed_in_known_area IS false) / count(*) AS out_of_range_share "
            "FROM fact GROUP BY taxon_id"),
        "row_count_checks": _checks(False),
        "pk_null_checks": _checks(True),
        "text_profile": _profile_sql("documents", ["text", "lang", "source"]) + " UNION ALL "
        + _profile_sql("part", ["p_name", "p_brand", "p_type"]),
        "text_clean": _clean_sql(),
        "layer_binary_load": with_ctes(
            "SELECT g.gid AS geom_row_id, id_no, binomial, compiler, yrcompiled, citation, category, order_, "
            "NULL::VARCHAR AS subspecies, marine, terrestrial, freshwater, e.leng AS shape_leng, "
            "e.area AS shape_area, e.xmin, e.ymin, e.xmax, e.ymax, e.vertices FROM geo_rows g JOIN ("
            "SELECT gid, sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) AS leng, "
            "abs(sum(x1 * y2 - x2 * y1)) / 2.0 AS area, min(least(x1, x2))::DOUBLE AS xmin, "
            "min(least(y1, y2))::DOUBLE AS ymin, max(greatest(x1, x2))::DOUBLE AS xmax, "
            "max(greatest(y1, y2))::DOUBLE AS ymax, (count(*) + 1)::INTEGER AS vertices "
            "FROM geo_edges GROUP BY gid) e ON e.gid = g.gid"),
        "tsv_load_roundtrip": _tsv_sql(),
        "tsv_plain_roundtrip": _tsv_sql(),
        "ring_simplify_auto": (
            "SELECT p_partkey AS geom_row_id, p_partkey % 6 = 5 AS was_above, true AS fits, "
            "CASE p_partkey % 6 WHEN 0 THEN 116.0 WHEN 1 THEN 32.0 WHEN 3 THEN NULL "
            "WHEN 4 THEN 0.0 ELSE 100.0 END::DOUBLE AS shape_area FROM part"),
        "clean_layer": with_ctes(
            "SELECT gid AS geom_row_id, 'C' || compiler || 'ess' AS compiler, citation, "
            "CAST(length('POLYGON ((, , , , , , ))é') + (SELECT sum(length((x0 + dx)::VARCHAR || ' ' || "
            "(y0 + dy)::VARCHAR)) FROM (VALUES " + ", ".join(
                f"({x}, {y})" for x, y in POLYGON_OFFSETS + POLYGON_OFFSETS[:1])
            + ") v(dx, dy)) AS INTEGER) AS wkt_chars, true AS wkt_kept FROM geo_rows"),
        "explore_tsv": (
            "SELECT c_custkey, c_name, c_acctbal, c_mktsegment || chr(9) || '\"quoted\"' AS note, "
            "'double' AS balance_type FROM customer"),
        "catalog_tables": _catalog_sql(),
        "composite_key_checks": _whole_keys_sql(),
        "layer_parse_errors": _malformed_sql(),
        "taxa_by_ancestry_pattern": with_ctes(
            f"SELECT * FROM taxa_raw WHERE list_contains(string_split(ancestry, '/'), '{CLASS_ID}')"),
        "taxa_preview": with_ctes(
            "SELECT * FROM taxa_x ORDER BY taxon_id, ancestry_position LIMIT 5"),
        "ring_simplify": with_ctes(
            "SELECT gid AS geom_row_id, id_no, 7 AS vertices_before, 4 AS vertices_after, "
            "CAST(1200.0 AS DOUBLE) AS shape_area_after FROM geo_rows"),
        "refresh_idempotent": _checks(False, compare=True),
    }

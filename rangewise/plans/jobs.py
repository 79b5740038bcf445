"""Job-style queries: file round trip, vertex reduction, refresh idempotence.

These run a whole job (write, reload, compare) over the driver tables and
return a DataFrame describing the outcome, so they sit in the same query
registry as the reports.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangewise.functions.geo import edges_area, rings_to_edges
from rangewise.plans import snapshots
from rangewise.plans.refresh import refresh
from rangewise.schemas import OBSERVATIONS_RAW, OBSERVERS_RAW, PRODUCTION, STAGING, TAXA_RAW
from rangewise.session import drop_scratch, scratch_path
from rangewise.sources import fixtures
from rangewise.sources.layer import build_layer, simplify_rings
from rangewise.sources.parallel import spread
from rangewise.sources.tsv import read_escaped_tsv, write_escaped_tsv

SIMPLIFY_TOLERANCE = 25.0
SIMPLIFY_MIN_VERTICES = 4


# Characters put into the text for the round trip: TAB, backslash, line feed,
# carriage return, and control characters next to those.
TSV_ODD = [(" ,.", "\t\\\n"), ("aeo", "\x01\x02\\"), ("t", "\r")]


def _replaced(c: F.Column, odd: list[tuple[str, str]]) -> F.Column:
    """``translate`` of characters that none of the others becomes."""
    for what, by in odd:
        for x, y in zip(what, by, strict=True):
            c = F.replace(c, F.lit(x), F.lit(y))
    return c


def _tsv_tables(docs: DataFrame) -> dict[str, tuple[T.StructType, DataFrame]]:
    a, b = _replaced(F.col("text"), [TSV_ODD[0], TSV_ODD[2]]), _replaced(F.col("text"), [TSV_ODD[1]])
    number = F.col("doc_id").cast("int")
    tables = {
        "observers_raw": (OBSERVERS_RAW, docs.select(number, a, b)),
        "observations_raw": (OBSERVATIONS_RAW, docs.select(
            a, number, F.col("doc_id") / 8, F.lit(None).cast("double"), number, number, b,
            F.date_add(F.lit("1999-12-31").cast("date"), number))),
        "taxa_raw": (TAXA_RAW, docs.select(
            number, a, F.col("doc_id") / 4, "lang", b, F.col("doc_id") % 2 == 0)),
    }
    return {name: (schema, df.toDF(*schema.names)) for name, (schema, df) in tables.items()}


def _tsv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")


def _tsv_back(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # plain files: ranges so small that records and escapes span them
    return read_escaped_tsv(spark, path, schema, range_bytes=PLAIN_RANGE_BYTES)


def _tsv_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """The tables loaded back, as rows of one."""
    return reduce(DataFrame.unionByName, [
        back.select(F.lit(name).alias("table_name"), *[
            F.col(c).cast("string") if c in back.columns else F.lit(None).cast("string").alias(c)
            for c in TSV_COLUMNS]) for name, back in tables.items()])


def tsv_load_roundtrip(spark: SparkSession, sf_dir: str, compression: str = "gzip") -> DataFrame:
    """Export three tables as escaped TSV, their text columns made of
    document texts with TABs, backslashes, line breaks and control
    characters, and load them back by position."""
    found = {}
    for name, (schema, df) in _tsv_tables(spread(_tsv_documents(spark, sf_dir))).items():
        path = scratch_path(spark, f"tsv-{name}")
        write_escaped_tsv(df, path, compression)
        found[name] = _tsv_back(spark, path, schema)
    return _tsv_rows(found)


#: Bytes of document text that are exported as plain files at a time.
TSV_SLICE_BYTES = 2 << 30


def tsv_plain_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through plain files, each read by many tasks.

    Plain files of all tables take some eight times the documents' own files. So
    documents go in slices of ``TSV_SLICE_BYTES``; a table's plain files of a slice
    go when they are loaded, and what was loaded is kept as Parquet."""
    docs = _tsv_documents(spark, sf_dir)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = size // TSV_SLICE_BYTES + 1
    # by content, so that every slice finds the same rows however the scan is split
    of = F.pmod(F.xxhash64("doc_id", "text"), F.lit(slices))
    kept = {name: scratch_path(spark, f"tsv-{name}-loaded") for name in _tsv_tables(docs)}
    found = {}
    for k in range(slices):
        staged = scratch_path(spark, "tsv-documents")
        # shuffled once, not for every table
        spread(docs.where(of == k)).write.option("compression", "zstd").parquet(staged)
        for name, (schema, df) in _tsv_tables(spark.read.schema(docs.schema).parquet(staged)).items():
            path = scratch_path(spark, f"tsv-{name}")
            write_escaped_tsv(df, path, "none")
            back = _tsv_back(spark, path, schema)
            back.write.mode("append").option("compression", "zstd").parquet(kept[name])
            found[name] = spark.read.schema(back.schema).parquet(kept[name])
            drop_scratch(spark, path)
        drop_scratch(spark, staged)
    return _tsv_rows(found)


PLAIN_RANGE_BYTES = 100_000

TSV_COLUMNS = ["observer_id", "login", "name", "observation_uuid", "latitude", "longitude",
               "positional_accuracy", "taxon_id", "quality_grade", "observed_on", "ancestry",
               "rank_level", "rank", "active"]


def ring_simplify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertex counts and area before / after Douglas-Peucker reduction, in
    one pass over the layer (no self join)."""
    vertices = "aggregate(rings, 0, (a, r) -> a + size(r))"
    layer = build_layer(fixtures.layer_source(spark, sf_dir)).select(
        "geom_row_id", "id_no", "rings", F.expr(vertices).alias("vertices_before"))
    simplified = simplify_rings(layer, SIMPLIFY_TOLERANCE, SIMPLIFY_MIN_VERTICES)
    return simplified.withColumn("_edges", rings_to_edges("rings")).select(
        "geom_row_id", "id_no", "vertices_before", F.expr(vertices).alias("vertices_after"),
        edges_area("_edges").alias("shape_area_after"))


SIMPLIFY_MAX_VERTICES = 200


def ring_simplify_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Automatic simplification of the awkward layer: which rows were above
    the limit, whether they fit now, and their area."""
    vertices = "coalesce(aggregate(rings, 0, (a, r) -> a + size(r)), 0)"
    plain = build_layer(fixtures.case_layer_source(spark, sf_dir)).select(
        "geom_row_id", F.expr(f"{vertices} > {SIMPLIFY_MAX_VERTICES}").alias("was_above"))
    auto = build_layer(fixtures.case_layer_source(spark, sf_dir),
                       simplify_max_vertices=SIMPLIFY_MAX_VERTICES).select(
        "geom_row_id", F.expr(f"{vertices} <= {SIMPLIFY_MAX_VERTICES}").alias("fits"),
        F.round("shape_area", 6).alias("shape_area"))
    return plain.join(auto, "geom_row_id")


def geometry_cases(spark: SparkSession, sf_dir: str, path: str = "broadcast") -> DataFrame:
    """The fact over awkward geometry (holes, parts, a third ordinate, NULL,
    EMPTY, very many vertices) and awkward rows. ``path``: how points meet
    geometry (``broadcast``, ``bands`` or ``cells``)."""
    from rangewise.operators.observations import species_observations
    from rangewise.operators.spatial_index import DEFAULT_TARGET_EDGES
    from rangewise.plans.model import build

    w = build(spark, sf_dir)
    # staged first, as a refresh does: each use of the layer reads parsed rings
    layer = build_layer(fixtures.case_layer_source(spark, sf_dir), in_batches=True)
    staged = scratch_path(spark, "case-layer")
    layer.write.parquet(staged)
    shuffled = path != "broadcast"
    return species_observations(
        fixtures.case_observations(spark, sf_dir), w.taxa,
        spark.read.schema(layer.schema).parquet(staged),
        band_edges=DEFAULT_TARGET_EDGES, force_shuffle=shuffled, with_point=False,
        salt_target_rows=50 if shuffled else 2_000_000,
        band_height=3.0 if path == "bands" else None)


def layer_binary_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer written in the binary polygon formats and loaded from there,
    with ranges so small that a file has several tasks."""
    from rangewise.sources.polygon_files import read_layer, write_polygons

    src = build_layer(fixtures.layer_source(spark, sf_dir))
    folder = scratch_path(spark, "binary-layer")
    attributes = [c for c in src.columns if c not in (
        "edges", "xmin", "ymin", "xmax", "ymax", "geom_bytes", "shape_leng", "shape_area")]
    write_polygons(src.select(*attributes), folder).write.parquet(f"{folder}-written")
    back = build_layer(read_layer(spark, folder, range_bytes=20_000), rings_col="rings")
    return back.select(
        "geom_row_id", "id_no", "binomial", "compiler", "yrcompiled", "citation", "category", "order_",
        "subspecies", "marine", "terrestrial", "freshwater", "shape_leng", "shape_area", "xmin", "ymin",
        "xmax", "ymax", F.expr("aggregate(rings, 0, (a, r) -> a + size(r))").alias("vertices"))


# A triangle per line item, in units of 1/10000 degree: its first side runs T
# steps of (dx, dy), so a point of whole steps lies on that side exactly.
OBLIQUE = {
    "ax": "(l_orderkey * 7919 + l_partkey * 31) % 1700000 - 850000",
    "ay": "(l_orderkey * 104729 + l_suppkey * 17) % 800000 - 400000",
    "dx": "1 + (l_partkey * 13 + l_linenumber) % 97",
    "dy": "1 + (l_suppkey * 7 + l_partkey) % 89",
    "t_all": "50 + l_orderkey % 900",
    "t": "1 + (l_partkey * l_linenumber) % 49",
}
#: Points on the side, one unit inside of it, one outside.
OBLIQUE_SHIFTS = (0, 1, -1)


def geometry_oblique_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points on, and a ten thousandth of a degree beside, oblique sides of
    polygons: (line item, shift, inside)."""
    from rangewise.functions.geo import edges_bbox, within, wkt_rings

    def degrees(units) -> F.Column:
        return (units / 10000).cast("decimal(12,4)").cast("string")

    items = spread(spark.read.parquet(f"{sf_dir}/lineitem.parquet")).select(
        "l_orderkey", "l_linenumber", *[F.expr(f"CAST({v} AS BIGINT)").alias(k) for k, v in OBLIQUE.items()])
    ax, ay, dx, dy, n, t = (F.col(k) for k in OBLIQUE)
    corners = [(ax, ay), (ax + n * dx, ay + n * dy), (ax - n * dy, ay + n * dx), (ax, ay)]
    wkt = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[
        F.concat_ws(" ", degrees(x), degrees(y)) for x, y in corners]), F.lit("))"))
    shapes = items.withColumn("wkt", wkt).withColumn("rings", wkt_rings("wkt")).withColumn("edges", rings_to_edges("rings"))
    shapes = shapes.withColumns(edges_bbox("edges")).withColumn(
        "shift", F.explode(F.array(*map(F.lit, OBLIQUE_SHIFTS))))
    points = shapes.withColumns({"lon": (ax + t * dx) / 10000, "lat": (ay + t * dy + F.col("shift")) / 10000})
    return points.select("l_orderkey", "l_linenumber", "shift", within("lon", "lat", "edges").alias("inside"))


def species_observations_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact by the path of a layer too large to broadcast, with a salt
    target so small that the fixture has hot keys."""
    from rangewise.operators.observations import species_observations
    from rangewise.plans.model import build

    w = build(spark, sf_dir)
    return species_observations(w.raw.observations_raw, w.taxa, w.raw.species_geospatial_raw,
                                force_shuffle=True, salt_target_rows=20, band_height=7.0,
                                with_point=False)


def species_observations_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact by the adaptive cell index, with few edges to a cell and a salt
    target so small that the fixture has hot keys."""
    from rangewise.operators.observations import species_observations
    from rangewise.plans.model import build

    w = build(spark, sf_dir)
    return species_observations(w.raw.observations_raw, w.taxa, w.raw.species_geospatial_raw,
                                force_shuffle=True, salt_target_rows=20, edge_bound=2,
                                with_point=False)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh with registration, then what the catalog declares."""
    from rangewise.plans.refresh import catalog_tables
    refresh(spark, fixtures.raw_tables(spark, sf_dir), register=True)
    return catalog_tables(spark)


# What is done to a layer text by id % 6: (pattern, replacement) of a regular expression.
WKT_FAULTS = {1: ("POLYGON", "POLYGN"), 2: (r"\)\)$", ")"), 3: (r", ", " 7, "), 4: (r"0", "o")}


def malformed_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer with faults put into most of its texts: which rows a load
    would refuse, and why."""
    from rangewise.sources.layer import layer_parse_errors

    src = fixtures.layer_source(spark, sf_dir).select("geom_row_id", "wkt")
    wkt = F.col("wkt")
    for k, (pattern, by) in WKT_FAULTS.items():
        wkt = F.when(F.col("geom_row_id") % 6 == k, F.regexp_replace("wkt", pattern, by)).otherwise(wkt)
    return layer_parse_errors(src.withColumn("wkt", wkt))


def explore_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exploration read (header, quotes, inferred types) of a plain export."""
    from rangewise.sources.tsv import explore_tsv

    path = scratch_path(spark, "explore")
    spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_name", "c_acctbal",
        F.concat("c_mktsegment", F.lit('\t"quoted"')).alias("note")).write.csv(
        path, sep="\t", header=True, escape='"')
    found = explore_tsv(spark, path)
    return found.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_acctbal", "note",
                        F.lit(dict(found.dtypes)["c_acctbal"]).alias("balance_type"))


def cleaned_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer with accents and line breaks put into two columns, cleaned,
    written and read back; the geometry text must come through untouched."""
    src = fixtures.layer_source(spark, sf_dir).withColumns({
        "compiler": F.concat(F.lit("Č"), "compiler", F.lit("é\r\nß\n")),
        "wkt": F.concat("wkt", F.lit("é"))})
    return clean_layer(src, scratch_path(spark, "clean-layer")).select(
        "geom_row_id", "compiler", "citation", F.char_length("wkt").alias("wkt_chars"),
        F.col("wkt").endswith("é").alias("wkt_kept"))


#: Rows are summed up in so many buckets.
COMPARE_BUCKETS = 256


def _both(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows of both tables with ``_a`` and ``_b`` (1 and 0, or 0 and 1), their
    ``_bucket`` and 128 bits of hash in four ``_piece`` numbers. NULLs and nested
    values are told apart (a hash alone skips NULLs and does not see where arrays end)."""
    nested = ("array", "struct", "map")
    parts = [p for f in a.schema.fields for p in (
        F.to_json(F.struct(f"`{f.name}`")) if f.dataType.typeName() in nested else F.col(f"`{f.name}`"),
        F.col(f"`{f.name}`").isNull())]
    names = [f"_part{k}" for k in range(len(parts))]
    cols = [f"`{c}`" for c in a.columns]
    sides = [df.select(*cols, F.lit(x).alias("_a"), F.lit(y).alias("_b"), *[p.alias(n) for p, n in zip(parts, names)])
             for df, x, y in ((a, 1, 0), (b, 0, 1))]
    hashed = reduce(DataFrame.unionByName, sides).select(*cols, "_a", "_b", *[
        F.xxhash64(F.lit(seed), *names).alias(f"_hash{seed}") for seed in (0, 1)])
    low = F.lit(0xFFFFFFFF).cast("long")
    return hashed.select(
        *cols, "_a", "_b", F.pmod("_hash0", F.lit(COMPARE_BUCKETS)).cast("int").alias("_bucket"),
        *[piece.alias(f"_piece{2 * k + j}") for k in (0, 1) for j, piece in enumerate(
            (F.col(f"_hash{k}").bitwiseAND(low), F.shiftrightunsigned(f"_hash{k}", 32)))])


def _bucket_sums(a: DataFrame, b: DataFrame) -> DataFrame:
    """(bucket, records of ``a``, whether the tables differ in it): counts and sums
    of the rows' hashes, a row per bucket and task in the shuffle."""
    sign = F.col("_a") - F.col("_b")
    off = [F.sum(sign), *[F.sum(F.col(f"_piece{k}") * sign) for k in range(4)]]
    return _both(a, b).groupBy(F.col("_bucket").alias("bucket")).agg(
        F.sum("_a").alias("records"), reduce(F.Column.__or__, [s != 0 for s in off]).alias("differs"))


def _compare(a: DataFrame, b: DataFrame, sums: DataFrame) -> DataFrame:
    """Rows of ``a`` and how many rows differ between ``a`` and ``b`` (as
    multisets). ``sums``: their bucket sums. Only rows of buckets that differ are
    compared, by one grouped count over their whole columns, no pairwise comparison."""
    cols = [f"`{c}`" for c in a.columns]
    apart = F.broadcast(sums.where("differs").select(F.col("bucket").alias("_bucket")))
    per = _both(a, b).join(apart, "_bucket", "left_semi").groupBy(*cols).agg(
        F.sum("_a").alias("na"), F.sum("_b").alias("nb"))
    differ = per.agg(F.coalesce(F.sum(F.abs(F.col("na") - F.col("nb"))), F.lit(0)).cast("long").alias("n"))
    # one row each
    return sums.agg(F.sum("records").cast("long").alias("records")).crossJoin(F.broadcast(differ)).select(
        "records", F.when(F.col("records").isNotNull(), F.col("n")).alias("mismatched_rows"))


def refresh_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the full refresh twice; compare every table of the two runs."""
    r1 = refresh(spark, fixtures.raw_tables(spark, sf_dir))
    r2 = refresh(spark, fixtures.raw_tables(spark, sf_dir))
    names = [(STAGING, n) for n in ("observers_raw", "observations_raw", "taxa_raw",
                                    "species_geospatial_raw")]
    names += [(PRODUCTION, n) for n in ("taxa", "species_geospatial", "observers",
                                        "species_observations")]
    pairs = {(layer, name): [spark.read.parquet(f"{r.root}/{layer}/{name}") for r in (r1, r2)]
             for layer, name in names}

    def of_table(df: DataFrame, layer: str, name: str) -> DataFrame:
        return df.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "*")

    # written: read for the records and for the buckets that differ
    path = scratch_path(spark, "bucket-sums")
    reduce(DataFrame.unionByName, [of_table(_bucket_sums(*p), *t) for t, p in pairs.items()]).write.parquet(path)
    sums = spark.read.parquet(path)
    return reduce(DataFrame.unionByName, [
        of_table(_compare(*p, sums.where((F.col("layer") == t[0]) & (F.col("table_name") == t[1]))), *t)
        for t, p in pairs.items()])


def snapshot_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the production tables as a reader of each of two committed
    versions finds them; the first reader is there before the second commit."""
    folder = scratch_path(spark, "snapshots")
    held = []
    for _ in range(2):
        snapshots.commit(spark, folder, refresh(spark, fixtures.raw_tables(spark, sf_dir)).root)
        held.append(snapshots.snapshot(spark, folder))
    return reduce(DataFrame.unionByName, [
        s.frame(spark, PRODUCTION, n).agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(s.version).alias("version"), F.lit(n).alias("table_name"), "records")
        for s in held for n in ("taxa", "species_geospatial", "observers", "species_observations")])


def clean_layer(layer_src: DataFrame, out_path: str) -> DataFrame:
    """Stand-alone layer cleaning: one pass over the text columns (geometry
    text excluded), written with the source's schema and read back."""
    from rangewise.operators.clean import clean

    clean(layer_src).write.mode("overwrite").parquet(out_path)
    return layer_src.sparkSession.read.schema(layer_src.schema).parquet(out_path)


def refresh_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end through the delivered formats: export the raw inputs as
    escaped gzip TSV + a WKT layer, refresh the warehouse from those files,
    report fact rows by grade and known-area flag."""
    from rangewise.plans.model import load
    from rangewise.plans.reports import known_area_counts
    from rangewise.sources.files import export_files, raw_from_files

    base = scratch_path(spark, "delivered")
    export_files(fixtures.raw_tables(spark, sf_dir), fixtures.layer_source(spark, sf_dir),
                 base, f"{base}/layer")
    res = refresh(spark, raw_from_files(spark, base, f"{base}/layer"))
    return known_area_counts(load(spark, res.root))

"""The broadcast bounds: exact species count, geometry bound, and the
measurement cache keyed by input files."""

from rangewise.operators.sizing import measure
from rangewise.schemas import TAXA_RAW
from rangewise.sources.fixtures import ClassScope, RawTables
from rangewise.sources.layer import build_layer

SCOPE = ClassScope(class_id=1001, path_prefix="48460/1001", ancestors=(48460,))


def _raw(spark, tmp_dir, n_species):
    taxa = spark.createDataFrame(
        [(48460, "", 100.0, "stateofmatter", "Life", True)]
        + [(10 + i, "48460/1001", 10.0, "species", f"s{i}", True) for i in range(n_species)],
        TAXA_RAW)
    taxa.write.mode("overwrite").parquet(tmp_dir + "/taxa")
    layer = spark.createDataFrame([(1, "s0", "POLYGON ((0 0, 1 0, 1 1, 0 0))")],
                                  "id_no int, binomial string, wkt string")
    layer.write.mode("overwrite").parquet(tmp_dir + "/layer")
    return RawTables(taxa_raw=spark.read.parquet(tmp_dir + "/taxa"), observations_raw=None,
                     observers_raw=None,
                     species_geospatial_raw=build_layer(spark.read.parquet(tmp_dir + "/layer")))


def test_bounds_and_cache(spark, tmp_dir):
    s1 = measure(_raw(spark, tmp_dir, 3), SCOPE)
    assert (s1.taxa_rows, s1.species_rows) == (4, 3)
    wkt_len = len("POLYGON ((0 0, 1 0, 1 1, 0 0))")
    assert s1.geometry_bytes == 64 + 16 * wkt_len and s1.geometry_fits
    assert measure(_raw(spark, tmp_dir, 3), SCOPE) == s1  # rewritten but same content
    s2 = measure(_raw(spark, tmp_dir, 5), SCOPE)  # new files: measured again
    assert (s2.taxa_rows, s2.species_rows) == (6, 5)


def test_cluster_settings_sizes_partitions():
    from rangewise.session import cluster_settings

    big = cluster_settings(20 * 2**40, executors=1000, cores_per_executor=8)
    assert int(big["spark.sql.shuffle.partitions"]) == 20 * 2**40 // (256 * 2**20)
    small = cluster_settings(10 * 2**20, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # at least two waves
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"

"""Work that must grow no faster than the input: what tasks read, and how it is dealt."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from rangewise.sources import records

TEXT = b"head\n" + b"".join(b"%d\tab\\\ncd\\\\\n" % k for k in range(20_000))


def _rows(batches):
    return [v for b in batches for v in b.column("record").to_pylist()]


def test_a_range_reads_little_more_than_itself(tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    (tmp_path / "t").write_bytes(TEXT)
    plain, read = records.opened, []

    class Counted:
        def __init__(self, source):
            self.source = source

        def __enter__(self):
            self.source.__enter__()
            return self

        def __exit__(self, *error):
            return self.source.__exit__(*error)

        def size(self):
            return self.source.size()

        def read_at(self, n, at):
            read.append(n)
            return self.source.read_at(n, at)

    monkeypatch.setattr(records, "opened", lambda p: Counted(plain(p)))
    step = records.LEAST_READ
    found = [v for s in range(0, len(TEXT), step)
             for v in _rows(records.owned(path, s, min(s + step, len(TEXT))))]
    assert found == [f"{k}\tab\\\ncd\\\\" for k in range(20_000)]
    assert sum(read) < 4 * len(TEXT)


def test_small_ranges_share_tasks():
    reader = records._Reader({"files": f'[["/x", {60_000_000}]]', "range_bytes": "100000", "tasks": "8"})
    tasks = [p.value for p in reader.partitions()]
    assert len(tasks) <= 9
    assert [s for _, s, _ in tasks[1:]] == [e for _, _, e in tasks[:-1]] and tasks[-1][2] == 60_000_000
    assert all(s % 100_000 == 0 for _, s, _ in tasks)


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_gzip_files_are_records_too(tmp_path, block):
    rng = random.Random(block)
    lines = ["".join(rng.choices("a\\\n\t", k=rng.randrange(9))) for _ in range(60)]
    text = "he\\\n" + "\n".join(lines)
    (tmp_path / "t").write_bytes(text.encode())
    half = len(text) // 2  # two members
    (tmp_path / "t.gz").write_bytes(gzip.compress(text[:half].encode()) + gzip.compress(text[half:].encode()))
    whole = _rows(records.owned(str(tmp_path / "t"), 0, len(text)))
    assert _rows(records.streamed(str(tmp_path / "t.gz"), block)) == whole


def test_round_trip_is_written_by_every_core(spark, tmp_path, monkeypatch):
    from rangewise.plans import jobs

    paths = []
    write = jobs.write_escaped_tsv
    monkeypatch.setattr(jobs, "write_escaped_tsv", lambda df, path, c: (paths.append(path), write(df, path, c)))
    spark.range(200).select(F.col("id").alias("doc_id"), F.lit("a, t.\n").alias("text"),
                            F.lit("en").alias("lang")).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert jobs.tsv_load_roundtrip(spark, str(tmp_path)).count() == 600
    files = spark.read.text(paths[0]).inputFiles()
    assert len(files) == spark.sparkContext.defaultParallelism


def test_rings_divided_together_as_one_by_one():
    import numpy as np

    from rangewise.sources import layer

    rng = np.random.default_rng(3)
    rings = []
    for n in (0, 1, 2, 3, 4, 5, 17, 60, 400):
        x, y = rng.integers(0, 9, n).astype(float), rng.integers(0, 9, n).astype(float)
        rings += [(x, y), (np.append(x, x[:1]), np.append(y, y[:1])), (x / 7, y / 3), (x, x * 0)]
    ones = [layer.significance(x, y) if len(x) else x for x, y in rings]
    for a, b in zip(layer.significances(rings), ones, strict=True):
        assert a.tolist() == b.tolist()


def test_rows_of_one_row_group_are_spread(spark, tmp_path):
    """Splits that hold no row group do not count."""
    from rangewise.sources.parallel import spread

    path = str(tmp_path / "t.parquet")
    spark.range(0, 3_000_000, 1, 1).select(F.rand(1).alias("x")).write.option(
        "parquet.block.size", 1 << 30).parquet(path)
    df = spark.read.parquet(path)
    target = spark.sparkContext.defaultParallelism
    assert df.rdd.getNumPartitions() >= target
    held = spread(df).groupBy(F.spark_partition_id()).count().collect()
    assert len(held) == target and max(r["count"] for r in held) < 2 * 3_000_000 / target


def test_case_fixtures_use_every_core(spark):
    from rangewise.sources import fixtures

    n = spark.sparkContext.defaultParallelism
    for made in (fixtures.case_layer_source, fixtures.case_observations):
        assert made(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= n


def test_letters_spelled_by_one_letter_skip_the_look_up(spark):
    from rangewise.functions import text

    assert {len(v) for v in text._short()[1]} == {1} and "아" in text._short()[0]
    df = spark.createDataFrame([("άβ한あщé́", "avhanashche"), ("", ""), (None, None), ("中a", "中a")], "t string, x string")
    assert df.select(text.transliterate(df.t).eqNullSafe(df.x).alias("e")).where("e").count() == 4


def test_small_ranges_of_a_layer_share_tasks():
    from rangewise.sources import polygon_files

    reader = polygon_files._Reader({"files": f'[["/x", {60_000_000}, "utf-8"]]', "columns": "[]",
                                    "range_bytes": "20000", "tasks": "8"})
    tasks = [p.value for p in reader.partitions()]
    assert len(tasks) <= 9 and tasks[-1][2] == 60_000_000
    assert [t[1] for t in tasks[1:]] == [t[2] for t in tasks[:-1]] and all(t[1] % 20_000 == 0 for t in tasks)


# -- comparing two runs, hot cells ------------------------------------------------

_ROWS = [(1, "a", None, [[1.0, 2.0], [3.0]]), (1, None, "a", [[1.0], [2.0, 3.0]]), (2, "b", "c", None),
         (2, "b", "c", None), (3, "ab", "c", []), (4, "é", "", [[None]]), (None, None, None, [[0.0]])]


@pytest.mark.parametrize("change", [
    [], [(1, None, "a", [[1.0, 2.0], [3.0]])], [(2, "b", "c", None)], [(3, "a", "bc", [])],
    [(2, "b", "c", []), (2, "b", "c", [])]])
def test_compared_by_sums_as_by_rows(spark, tmp_path, change):
    import collections

    from rangewise.plans import jobs

    schema = "id int, s string, `t.u` string, r array<array<double>>"
    other = _ROWS[len(change):] + change
    for name, rows in (("a", _ROWS), ("b", other)):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    a, b = (spark.read.parquet(f"{tmp_path}/{n}") for n in "ab")
    jobs._bucket_sums(a, b).write.parquet(f"{tmp_path}/sums")
    found = jobs._compare(a, b, spark.read.parquet(f"{tmp_path}/sums"))
    x, y = (collections.Counter(map(repr, rows)) for rows in (_ROWS, other))
    wrong = sum(((x - y) + (y - x)).values())
    assert [tuple(r) for r in found.collect()] == [(len(_ROWS), wrong)]
    # equal tables are not read again, nor their rows shuffled
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert (f"{tmp_path}/a" in final) == bool(wrong)


def _cells_of(spark, target, monkeypatch):
    from rangewise.operators import observations
    from rangewise.plans.model import build

    counted = []
    salted = observations.salted_join_keys
    monkeypatch.setattr(observations, "salted_join_keys", lambda *a, **k: (
        counted.append(k["counted"].count()), salted(*a, **k))[1])
    w = build(spark, SF)
    fact = observations.species_observations(w.raw.observations_raw, w.taxa, w.raw.species_geospatial_raw,
                                             force_shuffle=True, with_point=False, salt_target_rows=target)
    return sorted(map(repr, fact.collect())), counted[0] > 0


SF = "/root/testdata/sf0.001"


def test_cells_are_counted_for_hot_species_only(spark, monkeypatch):
    from rangewise.operators import observations

    everything, counted = _cells_of(spark, 20, monkeypatch)
    assert counted and everything
    assert _cells_of(spark, 2_000_000, monkeypatch) == (everything, False)
    monkeypatch.setattr(observations, "COUNT_SPECIES_FROM", 0)
    assert _cells_of(spark, 20, monkeypatch) == (everything, True)

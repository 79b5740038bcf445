"""The plain round trip keeps plain files of one table and slice at a time."""

import os

from pyspark.sql import functions as F

from rangewise.plans import jobs
from rangewise.sources import records

TEXTS = ["a, tea.\n", "", None, "o\t\\o", "t. e", "\u0001, é", "plain"]


def _documents(spark, folder):
    rows = [(k if k % 9 else None, TEXTS[k % len(TEXTS)], "en" if k % 4 else None) for k in range(150)]
    spark.createDataFrame(rows + rows[:40], "doc_id long, text string, lang string").coalesce(2) \
        .write.parquet(f"{folder}/documents.parquet")


def test_plain_files_go_slice_by_slice(spark, tmp_path, monkeypatch):
    _documents(spark, tmp_path)
    want = sorted(map(str, jobs.tsv_load_roundtrip(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(jobs, "TSV_SLICE_BYTES", 200)
    paths, most = [], []
    write = jobs.write_escaped_tsv

    def written(df, path, compression):
        paths.append(path)
        write(df, path, compression)
        most.append(sum(os.path.isdir(p.removeprefix("file:")) for p in paths))
    monkeypatch.setattr(jobs, "write_escaped_tsv", written)
    got = jobs.tsv_plain_roundtrip(spark, str(tmp_path))
    assert len(paths) > 6 and set(most) == {1}
    assert not any(os.path.exists(p.removeprefix("file:")) for p in paths)
    assert len(want) == 570 and sorted(map(str, got.collect())) == want


def test_characters_are_replaced_as_by_translate(spark):
    text = F.col("t")
    df = spark.createDataFrame([(t,) for t in [*TEXTS, "t,. aeo\\\r"]], "t string")
    both = [(jobs._replaced(text, [jobs.TSV_ODD[0], jobs.TSV_ODD[2]]),
             F.translate(F.translate(text, *jobs.TSV_ODD[0]), *jobs.TSV_ODD[2])),
            (jobs._replaced(text, [jobs.TSV_ODD[1]]), F.translate(text, *jobs.TSV_ODD[1]))]
    for a, b in both:
        assert df.where(~a.eqNullSafe(b)).isEmpty()


def test_small_ranges_leave_in_few_batches(tmp_path):
    (tmp_path / "t").write_bytes(b"head\n" + b"".join(b"%d\tab\\\ncd\n" % k for k in range(20_000)))
    size = os.path.getsize(tmp_path / "t")
    found = [b for s in range(0, size, 1000) for b in records.owned(str(tmp_path / "t"), s, min(s + 1000, size))]
    few = list(records.joined(iter(found), 50_000))
    assert len(few) < 10 < len(found)
    assert [v for b in few for v in b.column("record").to_pylist()] == [f"{k}\tab\\\ncd" for k in range(20_000)]

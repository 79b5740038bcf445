"""Escaped TSV: header per file, escapes, NULL marker, empty fields, errors."""

import gzip
import os

import pytest
from pyspark.sql import types as T

from rangewise.sources.tsv import read_escaped_tsv, read_prefix, write_escaped_tsv

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("txt", T.StringType()),
                       T.StructField("x", T.DoubleType()), T.StructField("ok", T.BooleanType())])


def _write(path, text):
    with gzip.open(path, "wt", encoding="utf-8", newline="") as f:
        f.write(text)


def test_escapes_and_empties(spark, tmp_dir):
    body = ("id\ttxt\tx\tok\n"
            "1\t\t\tt\n"                      # empty text stays '', empty number NULL
            "2\t\"Life\t2.5\tf\n"              # bare quote is data
            "3\ta\\\\b\t\\N\ttrue\n"           # escaped backslash, NULL marker
            "4\tcol\\\tumn\t1\tfalse\n"        # escaped tab
            "5\tline\\\nnext\t2\tt\n")         # escaped newline continues the record
    _write(os.path.join(tmp_dir, "observers.csv.gz"), body)
    _write(os.path.join(tmp_dir, "observers_2.csv.gz"), "h1\th2\th3\th4\n6\tz\t3\tf\n")
    rows = {r["id"]: r for r in read_prefix(spark, tmp_dir, "observers", SCHEMA).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6]  # both headers dropped
    assert rows[1]["txt"] == "" and rows[1]["x"] is None
    assert rows[2]["txt"] == '"Life'
    assert rows[3]["txt"] == "a\\b" and rows[3]["x"] is None
    assert rows[4]["txt"] == "col\tumn"
    assert rows[5]["txt"] == "line\nnext" and rows[5]["ok"] is True


def test_wrong_field_count_fails(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "bad.gz"), "a\tb\tc\td\n1\tonly-two\n")
    with pytest.raises(Exception):
        read_escaped_tsv(spark, os.path.join(tmp_dir, "bad.gz"), SCHEMA).collect()


def test_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a\tb\\c\nd", 1.5, True), (2, "", None, None),
                                (3, None, -0.25, False)], SCHEMA)
    path = os.path.join(tmp_dir, "rt")
    write_escaped_tsv(df, path)
    back = read_escaped_tsv(spark, path, SCHEMA)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == \
        sorted(map(tuple, df.collect()), key=lambda r: r[0])


def test_exploration_read_honours_quotes_and_infers_types(spark, tmp_dir):
    from rangewise.sources.tsv import explore_tsv

    _write(os.path.join(tmp_dir, "obs.csv.gz"), 'id\tname\tx\n1\t"Life"\t2.5\n2\tplain\t3\n')
    df = explore_tsv(spark, os.path.join(tmp_dir, "obs.csv.gz"))
    assert dict(df.dtypes) == {"id": "int", "name": "string", "x": "double"}
    assert [r["name"] for r in df.orderBy("id").collect()] == ["Life", "plain"]


@pytest.mark.parametrize("opened", [True, False])
def test_plain_file_split_inside_records(spark, tmp_dir, monkeypatch, opened):
    """An uncompressed file cut into many small splits: records whose escaped
    line feeds straddle split boundaries come back whole, whether tasks own
    records or (where they cannot open the file) fragments are glued."""
    import random

    from rangewise.sources import tsv

    monkeypatch.setattr(tsv, "readable", lambda path: opened)

    rnd = random.Random(5)
    rows = []
    for i in range(400):
        parts = ["".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 12)))
                 for _ in range(rnd.choice([1, 1, 1, 2, 3, 4]))]
        rows.append((i, "\n".join(parts), float(i) / 4, i % 2 == 0))
    lines = ["id\ttxt\tx\tok"] + [
        f"{i}\t{t.replace(chr(10), chr(92) + chr(10))}\t{x}\t{'t' if ok else 'f'}"
        for i, t, x, ok in rows]
    path = os.path.join(tmp_dir, "plain.tsv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "173")
    try:
        df = read_escaped_tsv(spark, path, SCHEMA, range_bytes=173)
        assert df.rdd.getNumPartitions() > 20
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert ("MapInPandas" in plan) != opened and ("Union" in plan) != opened  # one pass
        got = sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(rows)


def test_malformed_number_fails_the_load(spark, tmp_dir):
    """Fail fast like the load does: a non-numeric id is an error, not a NULL."""
    _write(os.path.join(tmp_dir, "bad_num.gz"), "id\ttxt\tx\tok\nabc\tt\t1.0\tt\n")
    with pytest.raises(Exception):
        read_escaped_tsv(spark, os.path.join(tmp_dir, "bad_num.gz"), SCHEMA).collect()


def test_malformed_number_fails_without_ansi(spark, tmp_dir):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        _write(os.path.join(tmp_dir, "bad_num2.gz"), "id\ttxt\tx\tok\n1\tt\tnot-a-number\tt\n")
        with pytest.raises(Exception, match="malformed double in column x"):
            read_escaped_tsv(spark, os.path.join(tmp_dir, "bad_num2.gz"), SCHEMA).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_owned_records_whatever_the_cuts(tmp_dir):
    """Every cut of random bytes of backslashes, line feeds and letters gives
    the records of the whole, each once."""
    import random

    from rangewise.sources.records import owned

    def records(text):
        lines = text.split(b"\n")[1:]  # no header
        lines = lines[:-1] if lines and lines[-1] == b"" else lines
        out, carry = [], None
        for line in lines:
            carry = line if carry is None else carry + b"\n" + line
            if (len(line) - len(line.rstrip(b"\\"))) % 2 == 0:
                out.append(carry)
                carry = None
        return out if carry is None else [*out, carry]

    rnd = random.Random(11)
    path = os.path.join(tmp_dir, "cuts.tsv")
    for _ in range(400):
        text = b"h" * rnd.randint(0, 3) + b"\n" + b"".join(rnd.choice(
            [b"\\", b"\n", b"\n", b"a", "é\tc".encode(), b"\\\n", b"\\\\"]) for _ in range(rnd.randint(0, 40)))
        with open(path, "wb") as f:
            f.write(text)
        step, block = rnd.randint(1, 30), rnd.choice([1, 2, 3, 7, 100])
        got = [r for s in range(0, len(text), step)
               for b in owned(path, s, min(s + step, len(text)), block)
               for r in b.column(0).cast("binary").to_pylist()]
        assert got == records(text)


def test_plain_and_gzip_files_in_one_folder(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.tsv"), "w") as f:
        f.write("id\ttxt\tx\tok\n1\ta\t1.0\tt")
    _write(os.path.join(tmp_dir, "b.gz"), "id\ttxt\tx\tok\n2\tb\t2.0\tf\n")
    with open(os.path.join(tmp_dir, "empty.tsv"), "w") as f:
        f.write("")
    assert sorted(r.txt for r in read_escaped_tsv(spark, tmp_dir, SCHEMA).collect()) == ["a", "b"]

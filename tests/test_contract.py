"""The driver contract on the smallest data: entry runs, every query has a
stable schema, the oracle keys name registered queries, and a sample of
queries matches DuckDB."""

import duckdb

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "part", "orders", "lineitem", "documents"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["quality_grade", "observed_in_known_area", "observations"]
    assert sum(r["observations"] for r in rows) > 0


def test_oracle_keys_are_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


def test_sample_against_duckdb(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sqls = E.oracle_sql()
    for name in ["species_observations", "taxa_ancestry", "observers_first_seen",
                 "dd_out_of_range_top5", "hist_day", "text_clean"]:
        df = E.queries()[name](spark, SF)
        res = con.execute(sqls[name])
        cols = [d[0] for d in res.description]
        exp = [tuple(dict(zip(cols, r))[c] for c in df.columns) for r in res.fetchall()]
        assert _norm(map(tuple, df.collect())) == _norm(exp), name

"""The pipeline against the operators' brute-force versions, and the
registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from rangewise.llm import queries
from rangewise.llm.common import documents, written

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    names = list(E.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(set(queries.oracle_sql()) - {"op5_suffix_dedup"}))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[name](spark, SF)
    res = con.execute(queries.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(tuple(dict(zip(cols, r))[c] for c in df.columns) for r in res.fetchall())
    assert sorted(map(tuple, df.collect())) == want


def test_pipeline_stages(spark):
    import brute

    docs = documents(spark, SF)
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            out = written(spark, out, name)
        seen.append(out)
    texts = [{r.doc_id: r.text for r in d.collect()} for d in seen[:-1]]
    ruled, near, lines, clean = texts[1:]
    verdict = {r.doc_id: r.kept for r in queries.op6_quality_rules(spark, SF).collect()}
    assert ruled == {k: t for k, t in texts[0].items() if verdict[k]}
    assert near == {k: ruled[k] for k, (_, c) in brute.near_components(list(ruled.items())).items() if k == c}
    assert lines == {k: t for k, (_, _, t) in brute.line_dedup(list(near.items())).items()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for k, t in lines.items():
        n, hit, _ = brute.contamination(t, items)
        if hit == 0:
            assert clean[k] == t
        elif hit == n:
            assert k not in clean
        else:
            assert len(brute.WORD.findall(brute.low(clean[k]))) >= n - hit - len(items) and clean[k] != t
    packed = seen[-1].collect()
    assert {r.doc_id for r in packed} == set(clean)
    assert sum(r.length for r in packed) > len(clean)


def test_pipeline_of_empty_documents(spark):
    docs = documents(spark, SF).where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_pipeline_with_awkward_rows_and_clashing_columns(spark, clashing):
    texts = ["a clean text of more than ten words that nobody wrote before, I hope so", None, "",
             "another clean text of ten words and a few more words besides these ones"]
    out = clashing([*enumerate(texts), (0, texts[0]), (None, texts[3] + " or not at all")])
    columns = out.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, SF)
        assert out.columns == columns, name
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [
        (False, 0), (False, 0), (False, 3), (True, 0)]
    assert corpus_pipeline.STAGES[-1][1](spark, out, SF).count() == 4

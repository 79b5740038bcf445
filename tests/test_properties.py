"""Property tests: ancestry explode vs a plain-Python model, TSV round trip
over arbitrary text."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rangewise.operators.taxa import explode_ancestry
from rangewise.schemas import TAXA_RAW
from rangewise.sources.fixtures import ClassScope
from rangewise.sources.tsv import read_escaped_tsv, write_escaped_tsv

SCOPE = ClassScope(class_id=7, path_prefix="1/7", ancestors=(1,))

ids = st.integers(min_value=1, max_value=12)
paths = st.one_of(st.just(""), st.none(),
                  st.lists(ids, min_size=1, max_size=6).map(lambda xs: "/".join(map(str, xs))))


def _model(rows):
    """The reference semantics, row by row."""
    by_id = {}
    for t in rows:
        by_id.setdefault(t[0], []).append(t)
    out = []
    for tid, anc, lvl, rank, name, act in rows:
        if anc is None or not (anc.startswith(SCOPE.path_prefix) or tid in SCOPE.ancestors):
            continue
        parts = [""] if anc == "" else anc.split("/")
        for pos, p in enumerate(parts, start=1):
            aid = None if anc == "" else int(p.strip())
            matches = by_id.get(aid, []) if aid is not None and aid != tid else []
            for m in matches or [None]:
                out.append((tid, aid, pos, m[4] if m else None))
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(ids, paths), min_size=1, max_size=12))
def test_explode_matches_model(spark, items):
    rows = [(tid, anc, 10.0, "r", f"n{tid}_{i}", True) for i, (tid, anc) in enumerate(items)]
    got = explode_ancestry(spark.createDataFrame(rows, TAXA_RAW), SCOPE).select(
        "taxon_id", "ancestry_id", "ancestry_position", "ancestry_name").collect()
    assert sorted(map(tuple, got), key=repr) == _model(rows)


text = st.lists(st.sampled_from(list("ab\\\t\n\"' N\r") + ["é", "\\N"]), max_size=12).map("".join)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), text), st.one_of(st.none(), text)),
                min_size=1, max_size=15))
def test_tsv_round_trip_arbitrary_text(spark, tmp_dir, rows):
    data = [(i, a, b) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, a string, b string")
    path = os.path.join(tmp_dir, f"p{abs(hash(tuple(rows))) % 10**9}")
    write_escaped_tsv(df, path)
    back = read_escaped_tsv(spark, path, df.schema).collect()
    assert sorted(map(tuple, back), key=lambda r: r[0]) == data

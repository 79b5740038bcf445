"""Ancestry explode: root, NULL, depth, malformed ids, prefix rules, self ids."""

import pytest

from rangewise.operators.taxa import explode_ancestry
from rangewise.schemas import TAXA_RAW
from rangewise.sources.fixtures import ClassScope

SCOPE = ClassScope(class_id=1001, path_prefix="48460/1001", ancestors=(48460,))


def _taxa(spark, rows):
    return spark.createDataFrame(rows, TAXA_RAW)


def test_root_null_depth_and_lookup(spark):
    deep = "48460/1001/" + "/".join(str(3000 + i) for i in range(24))  # 26 ids
    rows = [
        (48460, "", 100.0, "stateofmatter", "Life", True),
        (1001, "48460", 50.0, "class", "Amphibia", True),
        (7, None, 10.0, "species", "no path", True),
        (2001, "48460/1001", 33.5, "genus", "G", True),
        (9999, deep, 10.0, "species", "deep", True),
        (3000, "48460/1001", 20.0, "genus", "first deep", False),
    ]
    out = explode_ancestry(_taxa(spark, rows), SCOPE, broadcast_lookup=True).collect()
    by = {}
    for r in out:
        by.setdefault(r["taxon_id"], []).append(r)
    root = by[48460]
    assert len(root) == 1 and root[0]["ancestry_position"] == 1 and root[0]["ancestry_id"] is None
    assert 7 not in by and 1001 not in by  # NULL path: no row; class itself: not in scope
    g = sorted(by[2001], key=lambda r: r["ancestry_position"])
    assert [r["ancestry_id"] for r in g] == [48460, 1001]
    assert g[1]["ancestry_name"] == "Amphibia" and g[1]["ancestry_rank_level"] == 50
    assert g[0]["taxon_rank_level"] == 34  # 33.5 rounds half-even
    d = sorted(by[9999], key=lambda r: r["ancestry_position"])
    assert len(d) == 26 and d[24]["ancestry_position"] == 25 and d[24]["ancestry_id"] == 3022
    assert d[2]["ancestry_name"] == "first deep"


def test_prefix_sibling_and_strict(spark):
    rows = [
        (48460, "", 100.0, "stateofmatter", "Life", True),
        (10011, "48460", 50.0, "class", "sibling", True),
        (5, "48460/10011", 10.0, "species", "sibling child", True),
        (6, "48460/1001", 10.0, "species", "child", True),
    ]
    loose = {r["taxon_id"] for r in explode_ancestry(_taxa(spark, rows), SCOPE).collect()}
    strict = {r["taxon_id"] for r in explode_ancestry(
        _taxa(spark, rows), ClassScope(strict_prefix=True)).collect()}
    assert loose == {48460, 5, 6}
    assert strict == {48460, 6}


def test_spaces_and_self_reference(spark):
    rows = [
        (48460, "", 100.0, "stateofmatter", "Life", True),
        (6, "48460/1001 / 6", 10.0, "species", "self", True),
        (1001, "48460", 50.0, "class", "C", True),
    ]
    out = sorted(explode_ancestry(_taxa(spark, rows), SCOPE).filter("taxon_id = 6").collect(),
                 key=lambda r: r["ancestry_position"])
    assert [r["ancestry_id"] for r in out] == [48460, 1001, 6]
    assert out[1]["ancestry_name"] == "C"
    assert out[2]["ancestry_name"] is None  # self id: row kept, attributes NULL


def test_trailing_slash_fails(spark):
    rows = [(6, "48460/1001/", 10.0, "species", "bad", True)]
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            with pytest.raises(Exception, match="malformed ancestry id"):
                explode_ancestry(_taxa(spark, rows), SCOPE).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_salted_lookup_equals_broadcast(spark):
    """A taxonomy too large to broadcast: hot ancestors are salted."""
    from rangewise.plans.model import build

    raw = build(spark, "/root/testdata/sf0.001").raw.taxa_raw
    a = explode_ancestry(raw, broadcast_lookup=True)
    b = explode_ancestry(raw, broadcast_lookup=False, salt_target_rows=5)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))

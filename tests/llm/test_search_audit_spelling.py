"""Bit-sliced search, the filter audit and spelling variants against brute force."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from rangewise.llm import bit_sliced, filter_audit, spelling_variants

# -- bit-sliced search ------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows],
                                 "vec_id long, embedding array<double>, id string").withColumn(
        "score", F.lit("x")).withColumn("share", F.lit("x"))


def searched(df, divisor=5, **options):
    return sorted(map(tuple, bit_sliced.top_k(df, F.col("vec_id") % divisor == 0, **options).collect()))


def test_add_slices_is_a_sum():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1000, (7, 130))
    places = [[] for _ in range(10)]
    for row in x:
        for p in range(10):
            bits = np.zeros(192, np.uint8)
            bits[:130] = row >> p & 1
            places[p].append(np.packbits(bits, bitorder="little").view("<u8"))
    total = sum(np.unpackbits(s.view(np.uint8), bitorder="little").astype(int)[:130] << p
                for p, s in enumerate(bit_sliced.add_slices([np.array(c) for c in places])) if s is not None)
    assert (total == x.sum(axis=0)).all()


@pytest.mark.parametrize("block_rows,query_rows", [(16384, 2048), (64, 3), (100, 1)])
def test_search_equals_brute_force(spark, block_rows, query_rows):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(9)]) for i in range(330)]
    got = searched(vectors(spark, rows), block_rows=block_rows, query_rows=query_rows)
    assert got == brute.top_k(rows, lambda i: i % 5 == 0)


def test_search_of_awkward_vectors(spark):
    same = [0.5, -0.25, 0.1]
    rows = ([(i, same) for i in range(90)]  # ties everywhere: a group of copies
            + [(90, None), (95, [None, 0.0, 1.0]), (100, [float("nan"), 0.0, 1.0]),
               (105, [float("inf"), 0.0, 1.0]), (None, same), (110, []), (111, []), (115, [1.0]),
               (120, [0.0, 0.0, 0.0]), (-5, [-3.0, 700.0, -0.001]), (121, same), (121, same), (125, same),
               (125, same)])
    assert searched(vectors(spark, rows), block_rows=64) == brute.top_k(rows, lambda i: i % 5 == 0)


def test_search_leaves_out_what_could_overflow(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e300, 0.0]), (2, [3.0, 1.0]), (5, [2e6, -1e6]), (6, [-1e6, 2e6])]
    assert searched(vectors(spark, rows)) == brute.top_k(rows[:1] + rows[2:], lambda i: i % 5 == 0)


def test_search_of_nothing(spark):
    assert searched(vectors(spark, [])) == []
    assert searched(vectors(spark, [(1, [1.0])])) == []
    assert searched(vectors(spark, [(0, [1.0])])) == []


# -- filter audit -------------------------------------------------------------------


@pytest.mark.parametrize("salt_rows", [3, 1000])
def test_audit_equals_brute_force(spark, clashing, salt_rows):
    rng = random.Random(5)
    long = " ".join(f"w{k}" for k in range(60))
    texts = [None, "", long, long + " #", "A B C", "same words " * 40, "x y\x0bz", long.upper(),
             "Straße | 中文 " * 30]
    rows = [(i, rng.choice(texts), rng.choice(["s0", "s1", None, ""])) for i in range(60)]
    rows += [(100 + i, long, "hot") for i in range(40)]  # one text, one part
    rows += [(100, long, "hot"), (100, long, "s0"), (None, long, "s0"), (None, None, None), (3, "other", "s1")]
    docs = clashing([(i, t) for i, t, _ in rows])
    # the fixture deals rows anew: a row's source follows from its id and text
    part = {}
    for i, t, p in rows:
        part.setdefault((i, t), p)
    rows = [(i, t, part[i, t]) for i, t, _ in rows]
    source = spark.createDataFrame([(i, t, p) for (i, t), p in part.items()], "i long, t string, p string")
    docs = docs.join(source, docs.doc_id.eqNullSafe(source.i) & docs.text.eqNullSafe(source.t)).withColumn(
        "source", F.col("p")).drop("i", "t", "p").withColumn("part", F.lit(7)).withColumn("hash", F.lit(7))
    labels = [(0, 1, 0), (0, 0, 1), (3, 1, None), (4, None, 1), (101, 1, 1), (None, 1, 1), (500, 1, 1), (7, 2, 0)]
    marks = ({(i, "quality") for i, q, _ in labels if q == 1 and i is not None}
             | {(i, "toxic") for i, _, t in labels if t == 1 and i is not None})
    df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("y"))
    got = sorted(map(tuple, filter_audit.audit(docs, df, salt_rows=salt_rows).collect()))
    assert got == brute.audit(rows, marks)


def test_audit_of_nothing(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs([]), labels).count() == 0
    assert filter_audit.audit(docs(["a"]), labels).count() == 600


# -- spelling variants ----------------------------------------------------------------


def spelled(df, **options):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0)
                  for r in spelling_variants.variants(df, **options).collect())


@pytest.mark.parametrize("tile", [1024, 3])
def test_spelling_equals_brute_force(clashing, tile):
    rng = random.Random(9)
    base = ["garden", "harbour", "fünfzig", "colour", "Straßenbahn", "letter", "×÷Àÿab"]

    def miss(w):
        k = rng.randrange(len(w) + 1)
        return rng.choice([w, w, w, w[:k] + rng.choice("abeé") + w[k:], w[:k] + w[k + 1:],
                           w[:k] + rng.choice("xyz") + w[k + 1:]])
    texts = [" ".join(miss(rng.choice(base)) for _ in range(60)) + "." for _ in range(60)]
    texts += [None, "", "12 34", "letters,letters;LETTERS letters letterz" * 9, "ab" * 3000 + " x " + "ab" * 3000 + "a"]
    texts += ["ab" * 3000 + " " + "ab" * 3000 + "a"] * 6  # words longer than any block of numpy takes
    rows = [*enumerate(texts), (None, "letter letters harbour " * 8), (2, texts[2]), (2, texts[2])]
    got = spelled(clashing(rows), tile=tile)
    assert got == brute.spelling(rows)
    assert sum(r[1] != "" for r in got) > 5 and any(r[4] for r in got if len(r[0]) > 5000)


def test_forms_are_followed_to_the_root(docs):
    words = {"aaaaaaaa": 625, "aaaaaaab": 125, "aaaaaabb": 25, "aaaaabbb": 5}
    got = spelled(docs([" ".join([w] * n) for w, n in words.items()]), edit_every=None)
    assert [(r[1], r[2]) for r in got] == [("", "aaaaaaaa"), ("aaaaaaaa", "aaaaaaaa"),
                                           ("aaaaaaab", "aaaaaaaa"), ("aaaaaabb", "aaaaaaaa")]


def test_equally_frequent_forms_by_code_point(docs):
    got = spelled(docs([" ".join(["zebras", "zebrat"] * 50 + ["zebraé"] * 50 + ["zebraxx"] * 5
                                 + ["zebrax"] * 5)]), edit_every=None)
    assert {r[0]: r[1] for r in got} == {"zebras": "", "zebrat": "", "zebraé": "", "zebrax": "zebras",
                                         "zebraxx": ""}


def test_spelling_of_nothing(docs):
    assert spelled(docs([])) == [] and spelled(docs([None, ""])) == []


def test_one_edit_vectorised():
    rng = random.Random(2)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(300)]
    left, right = zip(*((a, b) for a in words[:150] for b in words[150:] if abs(len(a) - len(b)) <= 1))
    want = [spelling_variants._one_edit(a, b) for a, b in zip(left, right)]
    assert spelling_variants._verified(list(left), list(right)).tolist() == want
    assert any(want)

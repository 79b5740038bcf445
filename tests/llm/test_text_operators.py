"""Operators that decide on texts, against brute force on small inputs with
nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random

import brute
import pytest

from rangewise.llm import (
    decontaminate,
    minhash,
    quality_rules,
    substring_dedup,
    suffix_dedup,
)

RND = random.Random(5)
VOCAB = ["the", "of", "Thon", "ering,", "éau", "Heit.", "ndin", "a", "12", "x-y", "ou", "stän"]


def shout(text):
    """A-Z only, as the operators fold case."""
    return "".join(c.upper() if c.isascii() else c for c in text)


def prose(n, vocab=VOCAB):
    return " ".join(RND.choice(vocab) for _ in range(n))


def varied(n):
    return " ".join("".join(RND.choice("abcdefgéh") for _ in range(RND.randint(2, 7))) for _ in range(n))


PASSAGE = varied(60)
ODD = [None, "", " \t\n ", "one", "\n\n\n", "a b c d", prose(3000), PASSAGE,
       varied(30) + "\n" + PASSAGE + "\n" + varied(20), varied(8) + " " + PASSAGE + " " + varied(9),
       shout(PASSAGE), "same five words in here", "Same  five\twords in HERE", "ü" * 300, "ab" * 200,
       "x\x00y z", varied(40)] + [varied(25) + "\nAll rights reserved by the owner.\n" + varied(12)
                                  for _ in range(5)]
ODD += [ODD[8], ODD[16], ODD[16]]


LONG_LINES = [varied(30) + " " + PASSAGE + " " + varied(30), varied(10) + "\n\n" + PASSAGE + " end\n",
              "and " * 300, "and " * 301 + "\nlast", PASSAGE + "\n" + PASSAGE, "\n" + PASSAGE + "\n\n" + PASSAGE,
              "これは空白のない長い段落です。" * 8, "x これは空白のない長い段落です。\n" + "これは空白のない長い段落です。" * 8,
              " \x0b" + PASSAGE.replace(" ", " \r ") + "\t\n é" + varied(5)]


@pytest.mark.parametrize("texts", [ODD + LONG_LINES, [], [None], [""]])
def test_line_dedup(docs, clashing, texts):
    got = {r.doc_id: r for r in substring_dedup.digest(clashing(texts)).collect()}
    want = brute.line_dedup(list(enumerate(texts)))
    assert {k: (r.n_units, r.n_removed, r.text) for k, r in got.items()} == want
    for k, r in got.items():
        raw = (texts[k] or "").encode()
        spans = [tuple(map(int, s.split("-"))) for s in r.removed_spans.split(",") if s]
        assert r.removed_bytes == sum(e - s for s, e in spans) and (r.n_removed == 0) == (not spans)
        left = raw
        for s, e in reversed(spans):
            left = left[:s] + left[e:]
        # what else went are the line breaks of lines that went whole
        assert left.replace(b"\n", b"") == (r.text or "").encode().replace(b"\n", b"")


def test_line_dedup_salts_a_hot_unit(docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SALT_ROWS", 3)
    rows = [*enumerate([PASSAGE, varied(9)] * 12 + [varied(20) + " " + PASSAGE + " " + varied(20)] * 6)]
    got = {r.doc_id: (r.n_units, r.n_removed, r.text) for r in substring_dedup.digest(docs(rows)).collect()}
    assert got == brute.line_dedup(rows)


def test_line_dedup_finds_passages_inside_lines(docs):
    rows = [varied(40) + " " + varied(5) for _ in range(20)]
    rows += [varied(RND.randint(5, 90)) + " " + PASSAGE + " " + varied(RND.randint(5, 90)) for _ in range(20)]
    out = {r.doc_id: r.n_removed for r in substring_dedup.digest(docs(rows)).collect()}
    assert [bool(out[k]) for k in range(40)] == [False] * 21 + [True] * 19


def test_line_dedup_repeated_rows_are_one_document(docs):
    text = PASSAGE + "\n" + varied(10)
    out = substring_dedup.digest(docs([(1, text), (1, text), (2, PASSAGE), (None, None), (None, PASSAGE),
                                       (None, PASSAGE + " x")])).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == [
        (0, ""), (0, PASSAGE), (0, PASSAGE + " x"), (1, text[len(PASSAGE) + 1:]), (1, text[len(PASSAGE) + 1:]),
        (2, "")]


def test_line_dedup_rows_of_one_id_are_level(docs):
    out = substring_dedup.digest(docs([(5, PASSAGE), (5, "And " + PASSAGE)])).collect()
    assert sorted(r.text for r in out) == ["And " + PASSAGE, PASSAGE]


def test_line_dedup_keeps_columns_and_counts_characters(docs):
    out = {r.doc_id: r for r in substring_dedup.deduped(docs([PASSAGE, varied(6) + "\n" + PASSAGE])).collect()}
    assert out[1].n_chars == len(out[1].text) < len(PASSAGE) and out[1].lang == "en"
    assert out[0].text == PASSAGE


ITEMS = [("7", varied(25)), ("10", varied(14)), ("9", "Short item, only five words"), ("3", ""),
         ("4", None), (None, PASSAGE), ("8", "solo"), ("11", None)]
ITEMS[1] = ("10", " ".join(ITEMS[0][1].split()[5:19]) + " tail")


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination(spark, clashing, block_bytes):
    long, tail = ITEMS[0][1], ITEMS[1][1]
    texts = ODD + [long, shout(long) + "!", varied(5) + " " + " ".join(long.split()[3:13]) + " " + varied(3),
                   " ".join(long.split()[:9]), "so short ITEM only five words!", "(solo)", tail + " " + long,
                   " ".join(long.split()[:12]) + " zz " + " ".join(long.split()[12:])]
    bench = spark.createDataFrame(ITEMS + ITEMS[:2], "item_id string, text string")
    found = decontaminate.decontaminate(clashing(texts), bench, block_bytes=block_bytes)
    got = {r.doc_id: r for r in decontaminate.digest(found).collect()}
    items = [(i, t) for i, t in ITEMS if i is not None]
    for k, t in enumerate(texts):
        n, hit, ids = brute.contamination(t, items)
        r = got[k]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(ids), hit > 0), t
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()


def test_contaminated_spans_are_cut(spark, docs):
    item = varied(20)
    texts = ["é before, " + item + "; after ü", item, varied(30), None, ""]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r.doc_id: r for r in decontaminate.cleaned(docs(texts), bench).collect()}
    assert out[0].text == "é before, ; after ü" and out[0].n_chars == len(out[0].text)
    assert 1 not in out and out[2].text == texts[2] and out[3].text is None and out[4].text == ""


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination_of_rows_that_share_an_id_or_have_none(spark, docs, block_bytes):
    one, two = varied(20), varied(20)
    bench = spark.createDataFrame([("1", one), ("2", two)], "item_id string, text string")
    rows = [(5, "a " + one), (5, "longer head here " + two + " b"), (5, "clean"),
            (None, "c " + two), (None, "d clean"), (None, one), (7, one + " e " + two)]
    found = decontaminate.decontaminate(docs(rows), bench, block_bytes=block_bytes).collect()
    want = [(i, *brute.contamination(t, [("1", one), ("2", two)])) for i, t in rows]
    assert sorted(((r.doc_id, r.n_words, sum(s.word_end - s.word_start for s in r.spans), r.items)
                   for r in found), key=str) == sorted(want, key=str)
    out = decontaminate.cleaned(docs(rows), bench, block_bytes=block_bytes).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted([
        (5, "a "), (5, "longer head here  b"), (5, "clean"), (None, "c "), (None, "d clean"), (7, " e ")], key=str)
    assert all(r.n_chars == len(r.text) and r.lang == "en" for r in out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination_by_all_texts_of_an_item(spark, docs, block_bytes):
    one, two = varied(20), varied(12)
    bench = spark.createDataFrame([("1", one), ("1", two), ("1", one)], "item_id string, text string")
    found = decontaminate.decontaminate(docs([one, "x " + two, "clean"]), bench, block_bytes=block_bytes)
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.digest(found).collect()}
    assert got == {0: (20, 1), 1: (12, 1), 2: (0, 0)}


def test_contamination_of_empty_tables(spark, docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(decontaminate.decontaminate(docs(["a b"]), empty)).first().n_hit == 0
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.decontaminate(docs([]), bench).count() == 0


@pytest.mark.parametrize("texts", [ODD, [], [None]])
def test_quality_rules(clashing, texts):
    looped = [" ".join(varied(12).split() * 3), varied(40) + " " + PASSAGE + " " + varied(5) + " " + PASSAGE,
              "a line here\na line here\n \n \na line here\nb"] if texts is ODD else []
    texts = texts + looped
    got = {r.doc_id: r for r in quality_rules.quality_rules(clashing(texts)).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        t = t or ""
        w, r = brute.SPACED.findall(t), got[k]
        lines = [x for x in t.split("\n") if brute.SPACED.search(x)]
        repeat = brute.repeat_cover(w, 5)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeat)
        assert r.base_failed == (len(w) < 10 or 100 * repeat > 20 * len(w))
        longest = max((n for n in range(5, len(w)) if brute.repeat_cover(w, n)), default=0) if len(w) < 400 else r.longest_repeat
        assert r.n_covered_words == brute.repeat_cover(w, 10) and r.longest_repeat == longest
        assert r.kept == (not r.base_failed and 100 * r.n_covered_words <= 15 * len(w) and longest <= 100)


def test_maximal_repeats_from_intervals():
    import numpy as np
    rng = np.random.default_rng(6)
    for _ in range(150):
        sizes = rng.integers(0, 30, rng.integers(1, 5))
        at = np.concatenate([[0], np.cumsum(sizes)])
        codes, least = rng.integers(0, rng.integers(1, 4), at[-1]), int(rng.integers(1, 4))
        if not len(codes):
            continue
        sa, levels = quality_rules.suffix_order(codes, at)
        lcp = quality_rules.neighbour_lcp(sa, levels, least)
        size, low, high, parent, _ = quality_rules.lcp_intervals(lcp)
        for v, a, z, up in zip(size, low, high, parent):  # runs that share v words and no more
            assert lcp[a + 1:z + 1].min() == v and lcp[a] < v and (z + 1 == len(lcp) or lcp[z + 1] < v)
            assert up < 0 or (size[up] < v and low[up] <= a and z <= high[up])
        got = np.zeros(len(codes), int)
        got[sa] = quality_rules.maximal_repeats(codes, at, sa, lcp)
        want = [x for a, z in zip(at, at[1:]) for x in brute.maximal_repeats(codes[a:z].tolist(), least)]
        assert got.tolist() == want


def test_one_long_repetitive_text(docs):
    text = " ".join(["round and round"] * 60_000)
    r = quality_rules.quality_rules(docs([text])).first()
    assert (r.n_words, r.n_repeat_words, r.longest_repeat, r.kept) == (180_000, 180_000, 179_997, False)


def test_quality_rules_filter_keeps_clean_rows(docs):
    table = docs([varied(50), "too short", None, " ".join(["again and again we say it"] * 9)])
    out = quality_rules.kept_documents(table)
    assert out.columns == table.columns and [r.doc_id for r in out.collect()] == [0]


def edited(text, times):
    w = text.split()
    for _ in range(times):
        w[RND.randrange(len(w))] = varied(1)
    return " ".join(w)


@pytest.mark.parametrize("texts", [ODD, [], [None]])
def test_near_duplicates(clashing, texts):
    base = [varied(120), varied(300)]
    texts = texts + ([edited(b, n) for b in base for n in (0, 1, 2, 3, 4, 6, 9)] + [shout(base[0])]
                     if texts is ODD else [])
    got = {r.doc_id: r for r in minhash.near_duplicates(clashing(texts)).collect()}
    want = brute.near_components(list(enumerate(texts)))
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_duplicates_beyond_the_hub(docs):
    """Copies of copies: most links do not touch their bucket's least id."""
    texts, rows = [varied(150)], []
    for _ in range(80):
        texts.append(edited(RND.choice(texts), 3))
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(rows)).collect()}
    assert got == {k: v[1] for k, v in brute.near_components(rows).items()}


def test_near_duplicates_near_the_limit(docs):
    """Many variants of one text, most pairs just under the limit: buckets
    hold members that no star links, and tiles must find the links left."""
    base = varied(130).split()
    rnd = random.Random(3)
    rows = []
    for k in range(90):
        w = list(base)
        for _ in range(4):
            w[rnd.randrange(len(w))] = f"v{k}x{rnd.randrange(9)}"
        rows.append((k, " ".join(w)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(rows)).collect()}
    want = {k: v[1] for k, v in brute.near_components(rows).items()}
    assert len(set(want.values())) > 3 and got == want


def test_near_duplicates_with_hot_keys(docs, monkeypatch):
    """A set, a bucket and a hub of many rows, and many rows without words or id."""
    monkeypatch.setattr(minhash, "SALT_ROWS", 2)
    monkeypatch.setattr(minhash, "SALT_TEXTS", 2)
    base, other = varied(150), varied(60)
    rows = [(k, base) for k in range(40)] + [(100 + k, edited(base, k % 4)) for k in range(40)]
    rows += [(200 + k, " " * k) for k in range(20)] + [(300, other), (301, edited(other, 1))]
    want = {k: v for k, v in brute.near_components(rows).items()}
    out = minhash.near_duplicates(docs([*rows, (5, base), *[(None, base)] * 9])).collect()
    assert len(out) == len(rows) + 10
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None} == want
    assert all(r.component_id is None and r.kept for r in out if r.doc_id is None)


def test_tiles_join_components(spark):
    """Members of a bucket in different components, without any star."""
    base = varied(60)
    texts = [varied(60), base, edited(base, 1), varied(60), edited(base, 2), base + " tail"]
    bodies = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    shared = spark.createDataFrame([(7, k) for k in range(6)] + [(8, 0), (8, 3), (8, 1)], "key long, id long")
    labels = spark.createDataFrame([(4, 4), (5, 4)], "id long, component long")
    rest = minhash._unfinished(shared, labels)
    assert {r.n for r in rest.collect()} == {6, 3}
    found = minhash._tile_links(minhash._tiles(rest), bodies, 75).collect()
    assert minhash.components(spark.createDataFrame(found, "a long, b long")).where(
        "id <> component").collect() != []
    joined = {frozenset((r.a, r.b)) for r in found}
    assert joined <= {frozenset(x) for x in ((1, 2), (1, 4), (2, 4))} and len(joined) >= 2


def test_near_duplicates_repeated_rows(docs):
    rows = [(5, PASSAGE), (5, PASSAGE), (9, shout(PASSAGE)), (7, None), (7, None), (None, "")]
    out = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.near_duplicates(docs(rows)).collect())
    assert out == [(0, 0, True), (5, 5, True), (5, 5, True), (7, 7, True), (7, 7, True), (9, 5, False)]


def test_bit_sets_count_intersections():
    import numpy as np
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(30)]
    r, c = minhash.similar_pairs(sets[:10], sets[10:], 40)
    want = {(a, b) for a in range(10) for b in range(20)
            if 100 * len(np.intersect1d(sets[a], sets[10 + b])) >= 40 * len(np.union1d(sets[a], sets[10 + b]))}
    assert set(zip(r.tolist(), c.tolist())) == want


@pytest.mark.parametrize("hot", [20_000, 2])
@pytest.mark.parametrize("texts", [ODD, [], [None]])
def test_suffix_dedup(clashing, texts, hot):
    if texts is ODD:
        texts = texts + [edited(varied(60) + " " + PASSAGE, 1) for _ in range(8)] + [
            PASSAGE * 2, varied(2) + PASSAGE[:99], varied(2) + PASSAGE[:100], "z" * 500, "z" * 130]
    got = {r.doc_id: r for r in suffix_dedup.suffix_dedup(clashing(texts), hot_variants=hot).collect()}
    want = brute.byte_dedup(list(enumerate(texts)))
    assert {k: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for k, r in got.items()} == {
        k: (*v[:3], hashlib.sha256(v[3]).hexdigest()) for k, v in want.items()}


def test_suffix_dedup_repeated_and_null_ids(docs):
    rows = [(4, PASSAGE), (4, PASSAGE), (6, PASSAGE), (None, PASSAGE)]
    out = suffix_dedup.suffix_dedup(docs(rows), keep_text=True).collect()
    assert sorted((r.doc_id or 0, bytes(r.kept).decode()) for r in out) == [
        (0, PASSAGE), (4, PASSAGE), (4, PASSAGE), (6, "")]


def test_suffix_dedup_deals_null_ids_over_buckets(spark, docs):
    big = 2 ** 62 + 1
    rows = [(None, PASSAGE + str(k)) for k in range(60)] + [(big, PASSAGE), (big + 1, "x" + PASSAGE)]
    out = suffix_dedup.suffix_dedup(docs(rows), keep_text=True)
    got = sorted((r.doc_id or 0, r.n_removed, bytes(r.kept).decode()) for r in out.collect())
    assert got == sorted([(0, 0, t) for _, t in rows[:60]] + [
        (big, 0, PASSAGE), (big + 1, len(PASSAGE.encode()), "x")])


def test_one_copy_of_a_segment_goes_on():
    import numpy as np
    key, seg = np.array([7] * 6 + [8], np.uint64), np.array([1] * 5 + [2, 1], np.uint64)
    doc, start = np.array([3, 1, 1, 2, 9, 1, 1]), np.array([0, 5, 5, 0, 0, 5, 5])
    order, first, gone = suffix_dedup._settle(key, seg, doc, start)
    rows = lambda k: sorted(zip(*(x[order][k].tolist() for x in (key, seg, doc))))
    assert rows(first) == [(7, 1, 1), (7, 2, 1), (8, 1, 1)] and rows(gone) == [(7, 1, 2), (7, 1, 3), (7, 1, 9)]


def test_suffix_dedup_of_a_text_in_pieces(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HASH_BYTES", 700)
    text = varied(500)
    rows = [(0, text), (1, varied(20) + text[:2000] + varied(20)), (2, text[900:])]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.suffix_dedup(docs(rows)).collect()}
    assert got == {k: v[1] for k, v in brute.byte_dedup(rows).items()}


def test_long_text_before_small_ones_is_cut(monkeypatch):
    """Places stay under 2 ** _PLACE_BITS, and every 100-byte string has the
    anchor that it has alone."""
    import numpy as np
    import pyarrow as pa

    from rangewise.llm.common import plain
    monkeypatch.setattr(suffix_dedup, "HASH_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "_PLACE_BITS", 12)
    texts = [varied(30), varied(1500), *(varied(40) for _ in range(8)), varied(300), varied(5)]
    seen = {}
    for data, offsets, ids, base in suffix_dedup._pieces(plain(pa.array(texts)), np.arange(len(texts))):
        assert len(data) < 1 << 12
        text, start, n, key, _ = suffix_dedup.anchors(data, offsets)
        for t, s, m, k in zip(text, start, n, key):
            for p in range(m):
                place = (int(ids[t]), int(s - offsets[t] + base[t]) + p)
                assert place not in seen
                seen[place] = k
    raw = [t.encode() for t in texts]
    assert set(seen) == {(i, p) for i, b in enumerate(raw) for p in range(len(b) - 99)}
    for (i, p), k in list(seen.items())[::50]:
        alone = np.frombuffer(raw[i][p:p + 100], np.uint8)
        assert suffix_dedup.anchors(alone, np.array([0, 100]))[3].tolist() == [k]


def test_second_anchors_of_many_segments(monkeypatch):
    import numpy as np
    parts = [varied(40).encode()[:130] for _ in range(60)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    cut = np.cumsum([0] + [len(x) for x in parts])
    want = suffix_dedup.anchors(data, cut, salt=1)
    monkeypatch.setattr(suffix_dedup, "HASH_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "_PLACE_BITS", 12)
    text, start, n, gram, seg = suffix_dedup._anchors_by_part(data, cut, salt=1)
    assert set(text.tolist()) == set(range(60)) and n.sum() == want[2].sum()
    assert (gram == np.concatenate([suffix_dedup.anchors(
        np.frombuffer(x, np.uint8), np.array([0, len(x)]), salt=1)[3] for x in parts])).all()


def test_lyndon_suffix_arrays():
    import numpy as np

    from rangewise.llm.lyndon_suffixes import END, suffix_arrays
    rng = np.random.default_rng(2)
    for _ in range(60):
        texts = [np.append(rng.integers(1, rng.integers(2, 6), rng.integers(0, 40)), END)
                 for _ in range(rng.integers(1, 5))]
        low = np.cumsum([0] + [len(x) for x in texts])
        got = suffix_arrays(np.concatenate(texts), low)
        for k, x in enumerate(texts):
            assert (got[low[k]:low[k + 1]] - low[k]).tolist() == sorted(
                range(len(x)), key=lambda i: tuple(x[i:]))

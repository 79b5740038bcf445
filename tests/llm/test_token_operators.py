"""Token files, packing, and the trained scorers: round trips against the
tokenizers library, invariants, brute force and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from rangewise.llm import (
    gru,
    lm_score,
    packing,
    quality_classifier,
    token_counts,
    token_output,
    tokens,
)

RND = random.Random(11)


def varied(n):
    return " ".join("".join(RND.choice("abcdefgéh") for _ in range(RND.randint(1, 7))) for _ in range(n))


ODD = [None, "", " \n", "don't it's 'tis o'clock", "<|endoftext|> a<|startoftext|>b, c", "naïve café, Éire. İ İ, x́.",
       "1st 2,3 a_b €,, …,. 中文,日本。 ª, ²,", "≠ a≠ b,̸ ﬁ, Ⅷ.", varied(3000), varied(9000), varied(40), varied(40),
       "word " * 2047, "a\x00b"]


def library_ids(text):
    t = tokens.encoder(tokens.default_path()).tokenizer
    return t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library():
    alphabet = "aB'st,. é É̸́<|>9²Ⅷ_ \n 中ΑΣςİ"
    texts = ODD + ["".join(RND.choice(alphabet) for _ in range(RND.randint(0, 40))) for _ in range(1500)]
    ids, at = tokens.Encoder(tokens.default_path()).encode(pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == library_ids(t), t


def test_encoder_cache_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    e = tokens.Encoder(tokens.default_path())
    for _ in range(4):
        texts = [varied(60) for _ in range(5)]
        ids, at = e.encode(pa.array(texts))
        assert all(ids[at[k]:at[k + 1]].tolist() == library_ids(t) for k, t in enumerate(texts))
    assert len(e.known.old) + len(e.known.young) < 900


@pytest.mark.parametrize("bits", [1, 5, 16, 17, 31, 32])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
    for n in (0, 1, 63, 64, 65, 1000):
        data = token_output.pack(ids[:n], bits)
        assert len(data) == -(-n // 64) * 8 * bits
        assert (token_output.unpack(data, bits, n) == ids[:n]).all()


@pytest.mark.parametrize("texts", [ODD, [], [None]])
def test_token_files(spark, clashing, texts):
    files = token_output.write(clashing(texts), block_ids=256)
    rows = {r.doc_id: r for r in token_output.read(spark, files, window=700).collect()}
    assert len(rows) == len(texts)
    start = 0
    for k, t in enumerate(texts):
        ids = [*library_ids(t), 1]
        assert (rows[k].start, rows[k].n_tokens, rows[k].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_file_random_access(docs):
    from rangewise.llm.files import opened
    path = token_output.write(docs(ODD, 1).coalesce(1), block_ids=128).first().path
    every = [i for t in ODD for i in [*library_ids(t), 1]]
    with opened(path) as source:
        r = token_output.Reader(source)
        assert r.bits == 16
        for _ in range(50):
            a, b = sorted(RND.randrange(r.n_ids + 1) for _ in range(2))
            assert len(r.ids(a, b)) == b - a
        if r.n_ids == len(every):
            assert r.ids(0, r.n_ids).tolist() == every


def test_token_files_of_null_and_repeated_ids(spark, docs):
    out = token_output.round_trip(docs([(3, "b"), (3, "a"), (None, "c")])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.start) for r in out) == [
        (False, 3, 2), (False, 3, 4), (True, 0, 0)]


@pytest.mark.parametrize("texts", [ODD, [], [None]])
def test_flat_token_counts(clashing, texts):
    rows = {r.doc_id: r for r in token_counts.counted(clashing(texts)).collect()}
    assert len(rows) == len(texts)
    coder = tokens.Encoder(tokens.default_path(), special_as_text=True).tokenizer
    for k, t in enumerate(texts):
        assert rows[k].n_tokens == len(coder.encode(t or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("block", [8, 64, 1 << 20])
def test_separator_scan_stitches_blocks(spark, tmp_dir, block):
    want = {}
    for f, ids in enumerate([[9, 9, 1, 2, 9, *range(100, 150), 9], [1, 2, 3], [9], [], [5] * 40 + [9, 7]]):
        np.array(ids, "<u2").tofile(f"{tmp_dir}/f{f}.ids")
        ends = [k for k, i in enumerate(ids) if i == 9] + ([len(ids)] if ids and ids[-1] != 9 else [])
        starts = [0, *(e + 1 for e in ends)]
        want |= {(f, k): (s, e - s, e < len(ids)) for k, (s, e) in enumerate(zip(starts, ends))}
    rows = token_counts.token_counts(spark, tmp_dir, separator=9, block_bytes=block).collect()
    assert {(int(r.path[-5]), r.ordinal): (r.start, r.n_tokens, r.closed) for r in rows} == want


def check_packing(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in places.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize("texts", [ODD, [], [None], ["copy of one text"] * 300 + ODD])
def test_packing(clashing, texts):
    rows = packing.pack(clashing(texts)).collect()
    got = {(r.doc_id, r.piece): r for r in rows}
    assert len(got) == len(rows)
    total = 0
    for k, t in enumerate(texts):
        ids = [*library_ids(t), 0]
        total += len(ids)
        for p in range(-(-len(ids) // 2048)):
            part, r = ids[p * 2048:(p + 1) * 2048], got.pop((k, p))
            assert (r.start, r.length, r.ids_crc32) == (p * 2048, len(part), crc(part))
    assert not got
    assert check_packing(rows, 2048) <= -(-total // 2048) + 1


def test_packing_plan_is_close_to_the_bound():
    rng = np.random.default_rng(0)
    n = np.minimum(rng.lognormal(6.4, 1, 120_000).astype(int) + 1, 5000)
    n = np.where(n > 2047, n % 2047 + 1, n)
    lengths, counts = np.unique(n, return_counts=True)
    plan = packing.solve(dict(zip(lengths.tolist(), counts.tolist())))
    assert plan.sequences <= 1.001 * (int(n.sum()) / 2048) + 2


def test_small_tables_are_packed_by_the_program(docs, monkeypatch):
    rest, whole = [], packing.best_fit

    def spied(lengths, counts, capacity):
        rest.append(int(counts.sum()))
        return whole(lengths, counts, capacity)

    monkeypatch.setattr(packing, "best_fit", spied)
    texts = ["word " * n for n in (300, 700, 900, 1100) for _ in range(30)]
    rows = packing.pack(docs(texts)).collect()
    check_packing(rows, 2048)
    assert len(rows) == 120 and rest[0] < 60
    # no configuration of this length is full
    assert packing.solve({1500: 100}).sequences == 100 and rest[1] <= 1


def test_knapsack_is_optimal():
    import itertools
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = np.unique(rng.integers(1, 12, 4))
        most, value = rng.integers(0, 5, len(n)), rng.random(len(n))
        got = packing.knapsack(n, most, value, 20)
        best = max(sum(c * v for c, v in zip(k, value)) for k in itertools.product(
            *(range(m + 1) for m in most)) if sum(c * x for c, x in zip(k, n)) <= 20)
        assert (got <= most).all() and (got * n).sum() <= 20 and abs((got * value).sum() - best) < 1e-9


def labelled(spark, docs, n=300):
    texts, marks = [], []
    for k in range(n):
        bad = k % 4 == 0
        body = varied(60)
        texts.append(body.upper().replace(" ", "!! ") if bad and k % 8 else body.replace(" ", "### ") if bad else body)
        marks.append((k, 0 if bad else 1, 0))
    texts += [None, ""]
    return docs(texts), spark.createDataFrame(
        [*marks, (n, 1, 0), (None, 1, 0), (5, None, 0), (99999, 0, 0)], "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_rows(spark, docs):
    table, labels = labelled(spark, docs)
    rows = {r.doc_id: r for r in quality_classifier.classify(table, labels).collect()}
    assert len(rows) == 302 and all(0 <= r.score <= 1 for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in rows.items())
    held = [(r.predicted, int(k % 4 != 0)) for k, r in rows.items() if r.held_out and k < 300]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(r.predicted == int(r.score >= 0.5) for r in rows.values())


def test_classifier_ignores_held_out_labels(spark, docs):
    from pyspark.sql import functions as F
    table, labels = labelled(spark, docs)
    out = quality_classifier.held_out(F.col("doc_id"), 3, 1)
    flipped = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality_classifier.classify(table, x).collect()} for x in (labels, flipped))
    assert a == b


def test_classifier_without_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_classifier.classify(docs(["a b", None]), none).collect()} == {0.5}
    assert quality_classifier.classify(docs([]), none).count() == 0


def test_gru_gradients():
    rng = np.random.default_rng(0)
    ids, offsets = rng.integers(0, gru.WORDS + 1, 60), np.array([0, 7, 7, 30, 41, 60])
    lanes = gru.Lanes.of(ids, offsets, 3)
    p = {k: v.astype(float) + rng.standard_normal(v.shape) * 0.3
         for k, v in gru.initial(np.arange(gru.WORDS) + 1, 500).items()}
    at, valid = next(lanes.windows())
    target, weight = lanes.target[at].ravel(), valid.ravel().astype(float)

    def loss(q):
        h = gru._run(q, lanes.given[at], np.zeros((at.shape[1], gru.UNITS)), None).astype(float)
        return -(gru._predict(q, h.reshape(-1, gru.UNITS), target, None)[0] * weight).sum()

    kept, grad = [], {k: np.zeros_like(v) for k, v in p.items()}
    h = gru._run(p, lanes.given[at], np.zeros((at.shape[1], gru.UNITS)), kept)
    _, back = gru._predict(p, h.reshape(-1, gru.UNITS), target, grad, weight)
    gru._backward(p, lanes.given[at], kept, back.reshape(h.shape), grad)
    for k in p:
        i = np.unravel_index(np.argmax(np.abs(grad[k])), grad[k].shape)
        up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
        up[k][i] += 1e-2
        down[k][i] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - grad[k][i]) < 1e-2 * max(1, abs(grad[k][i])), k


def test_gru_probabilities_sum_to_one_and_ignore_lanes():
    p = gru.initial(np.arange(gru.WORDS), 1000)
    p["class_w"] += 0.3
    total = 0.0
    for first in range(gru.WORDS + 1):
        ids = np.array([3, first])
        total += math.exp(gru.log_likelihood(p, gru.Lanes.of(ids, np.array([0, 2])), 1)[0]
                          - gru.log_likelihood(p, gru.Lanes.of(ids[:1], np.array([0, 1])), 1)[0])
    assert abs(total - 1) < 1e-3
    ids, offsets = np.arange(200) % (gru.WORDS + 1), np.array([0, 3, 3, 90, 200])
    a, b = (gru.log_likelihood(p, gru.Lanes.of(ids, offsets, n), 4) for n in (1, 3))
    assert np.allclose(a, b, rtol=1e-4)


@pytest.mark.parametrize("head", [5, 1 << 19])
@pytest.mark.parametrize("texts", [[varied(50) for _ in range(40)] + ODD, [], [None], ["a b a"]])
def test_lm_scores(clashing, texts, head):
    rows = {r.doc_id: r for r in lm_score.lm_score(clashing(texts), head_words=head).collect()}
    assert len(rows) == len(texts)
    words = {k: [*brute.SPACED.findall(brute.low(t)), None] for k, t in enumerate(texts)}
    out = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in words}
    count = Counter(w for k, x in words.items() if not out[k] for w in x)
    n, v = sum(count.values()), len(count)
    for k, x in words.items():
        r = rows[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            out[k], len(x), sum(count[w] > 0 for w in x), n)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in x)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0


def test_lm_vocabulary_follows_the_corpus(docs):
    """Words come in fixed pairs, none among the 256 most frequent alone."""
    rnd = random.Random(4)
    pairs = [f"a{k} b{k}" for k in range(450)]
    rows = [" ".join(rnd.choice(pairs) for _ in range(150)) for _ in range(300)]
    found = np.arange(1, 901, dtype=np.uint64)
    head = lm_score.Head(found, np.full(900, 50), 45_000)
    assert set(head.ids(found).tolist()) == set(range(1, 901)) and head.rest == 31 * 31
    held = [r for r in lm_score.lm_score(docs(rows)).collect() if r.held_out]
    assert len(held) > 20 and all(r.score > r.base_score for r in held)


def test_lm_score_token_by_token(docs, monkeypatch):
    """The score from the learned parameters, one number after the other."""
    kept, train = {}, lm_score.train

    def spied(table, head, total, **kw):
        kept.update(head=head, p=train(table, head, total, **kw))
        return kept["p"]

    monkeypatch.setattr(lm_score, "train", spied)
    monkeypatch.setattr(lm_score, "SHARE", 300)
    rnd = random.Random(8)
    pool = [f"w{k}" for k in range(700)]
    texts = [" ".join(rnd.choice(pool[:int(700 * rnd.random()) + 1]) for _ in range(70)) for _ in range(40)]
    texts += [None, "", "never seen words here"]
    rows = {r.doc_id: r for r in lm_score.lm_score(docs(texts)).collect()}
    head, p = kept["head"], kept["p"]
    tokens = {k: [*brute.SPACED.findall(brute.low(t)), None] for k, t in enumerate(texts)}
    count = Counter(w for k, x in tokens.items() if zlib.crc32(str(k).encode()) % 7 != 2 for w in x)
    names = sorted({w for x in tokens.values() for w in x if w is not None})
    hashed = lm_score.word_hashes(pa.array(names))
    ids = dict(zip([*names, None], head.ids(np.append(hashed, lm_score.END)).tolist()))
    rest = [w for w in count if ids[w] == head.rest]
    assert len(rest) > 100
    below = sum(count[w] for w in rest) + len(rest) + 1
    for k in [0, 5, 17, 39, 40, 41, 42]:
        x = [ids[w] for w in tokens[k]]
        want = sum(brute.gru_log10(p, x, head.size, gru.UNITS))
        want += sum(math.log10((count[w] + 1) / below) for w in tokens[k] if ids[w] == head.rest)
        assert abs(rows[k].score - want) < 1e-3 * max(1, abs(want)), k


def test_lm_scores_of_repeated_and_null_ids(docs):
    texts = [varied(30) for _ in range(12)]
    out = lm_score.lm_score(docs([*enumerate(texts), (3, texts[3]), (3, texts[4]), (None, texts[3]),
                                  (None, None)])).collect()
    assert len(out) == 16
    assert len({round(r.score, 3) for r in out if r.n_tokens == 31 and r.doc_id == 3}) == 2
    assert [(r.held_out, r.n_tokens) for r in out if r.doc_id is None and r.n_tokens == 1] == [(False, 1)]


def test_copies_are_averaged_in_a_tree():
    rng = np.random.default_rng(0)
    found = {(k, g): (int(rng.integers(1, 9)), rng.random(3).astype(np.float32)) for k in range(2) for g in range(200)}
    want = {k: sum(n * x.astype(float) for (j, _), (n, x) in found.items() if j == k)
            / sum(n for (j, _), (n, _) in found.items() if j == k) for k in range(2)}
    rows = [lm_score._blocks({(k, g // lm_score.FAN): v}) for (k, g), v in found.items()]
    for _ in range(lm_score.STEPS):
        rows = list(lm_score._average(iter(rows)))
    assert sum(b.num_rows for b in rows) == 2
    for b in rows:
        assert np.allclose(np.frombuffer(b["x"][0].as_py(), np.float32), want[b["k"][0].as_py()], rtol=1e-5)


def test_classifier_equals_plain_updates(spark, docs):
    """Every score from weights that plain loops learn on unhashed features."""
    table, labels = labelled(spark, docs, 120)
    text = {r.doc_id: r.text for r in table.collect()}
    learn = {r.doc_id: r.quality for r in labels.where("doc_id < 121 and quality is not null").collect()
             if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.doc_id in text}
    pairs = [(k, y) for k, y in learn.items()] + []
    order = np.argsort(quality_classifier.mix(np.array([k for k, _ in pairs], np.uint64)), kind="stable")
    rows = [(brute.quality_features(text[pairs[i][0]]), pairs[i][1]) for i in order]
    w = brute.regularised_leader(rows, quality_classifier.EPOCHS, quality_classifier.ALPHA, quality_classifier.BETA,
                                 quality_classifier.L1, quality_classifier.L2)
    got = {r.doc_id: r.score for r in quality_classifier.classify(table, labels).collect()}
    far = 0
    for k, t in text.items():
        dot = sum(w.get(f, 0.0) * v for f, v in brute.quality_features(t).items())
        far += abs(got[k] - 1 / (1 + math.exp(-dot))) > 0.02  # two features in one of 2^18 places
    assert len(got) == len(text) and far <= 0.05 * len(text)


def test_classifier_of_odd_rows(spark, clashing):
    texts = [*ODD, varied(40), varied(40)]
    table = clashing([*enumerate(texts), (3, texts[3]), (None, texts[3])])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(len(texts))], "doc_id long, quality int, toxic int")
    out = quality_classifier.classify(table, labels).collect()
    assert len(out) == len(texts) + 2 and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (3, None)}) == 1


def test_token_counts_of_null_and_repeated_ids(docs):
    rows = [(3, "b"), (3, "b"), (3, "a c"), (None, "c"), (None, None)]
    got = sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.counted(docs(rows)).collect())
    coder = tokens.Encoder(tokens.default_path(), special_as_text=True).tokenizer
    assert got == sorted((i or 0, len(coder.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)


def test_packing_of_null_and_repeated_ids(docs):
    long = "word " * 3000
    rows = packing.pack(docs([(3, long), (3, long), (3, "a"), (None, long), (None, None)])).collect()
    check_packing(rows, 2048)
    n = [len(library_ids(t)) + 1 for t in (long, "a", None)]
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length) for r in rows) == sorted(
        [(i, p, p * 2048, min(2048, n[0] - p * 2048)) for i in (0, 3, 3) for p in range(-(-n[0] // 2048))]
        + [(3, 0, 0, n[1]), (0, 0, 0, n[2])])


def test_packing_stops_at_the_volume_bound():
    plan = packing.solve({1024: 4000, 512: 4000})
    assert plan.sequences == plan.bound == 3000
    rng = np.random.default_rng(0)
    lengths, counts = np.unique(rng.integers(1, 2048, 300), return_counts=True)
    plan = packing.solve(dict(zip(lengths.tolist(), counts.tolist())))
    alone = sum(times for _, times in packing.best_fit(lengths, counts, 2048))
    assert plan.bound <= plan.sequences <= alone


def test_few_lanes_have_long_windows():
    """A long text beside short ones is not learned 16 words at a time; every
    word is in one window, in order."""
    offsets = np.cumsum([0, 9000, *[40] * 20])
    lanes = gru.Lanes.of(np.arange(offsets[-1]) % 200, offsets)
    windows = list(lanes.windows())
    assert len(windows) < 15
    places = np.concatenate([at[valid] for at, valid in windows])
    assert sorted(places.tolist()) == list(range(offsets[-1]))
    alone = np.concatenate([at[:, 0][valid[:, 0]] for at, valid in windows])
    assert (np.diff(alone) == 1).all() and len(alone) == 9000


def test_texts_of_several_batches_are_pooled(monkeypatch):
    monkeypatch.setattr(lm_score, "POOL", 10)
    sizes = [[3, 0, 4], [2], [9], [30, 1], [], [5]]
    parts = [(np.cumsum([0, *s]), np.full(sum(s), k, np.int32)) for k, s in enumerate(sizes)]
    pools = list(lm_score._pooled(iter(parts)))
    assert [len(pool) for pool in pools] == [2, 1, 1, 2]
    lanes = lm_score._lanes(pools[0])
    assert np.bincount(lanes.text, minlength=4).tolist() == [3, 0, 4, 2]
    assert lanes.target[lanes.text == 3].tolist() == [1, 1]


@pytest.mark.parametrize("scale", [1.0, 60.0])
def test_gru_probabilities_of_near_and_far_scores(scale):
    """Also where exponentials below the highest possible score would vanish."""
    rng = np.random.default_rng(1)
    p = gru.initial(np.arange(gru.WORDS) + 1, 500)
    p["class_w"] += rng.standard_normal(p["class_w"].shape).astype(np.float32) * np.float32(scale)
    p["word_w"] += rng.standard_normal(p["word_w"].shape).astype(np.float32) * np.float32(scale)
    h = np.tanh(rng.standard_normal((700, gru.UNITS))).astype(np.float32)
    target = rng.integers(0, gru.WORDS + 1, 700)
    size = len(p["word_b"])

    def log_softmax(x):
        x = x - x.max(axis=1, keepdims=True)
        return x - np.log(np.exp(x).sum(axis=1, keepdims=True))

    cls, word = np.divmod(target, size)
    k, h64 = np.arange(700), h.astype(float)
    want = log_softmax(h64 @ p["class_w"] + p["class_b"])[k, cls]
    for c in range(size):
        some = cls == c
        want[some] += log_softmax(h64[some] @ p["word_w"][c] + p["word_b"][c])[np.arange(some.sum()), word[some]]
    assert np.allclose(gru._predict(p, h, target, None)[0], want, rtol=1e-4, atol=1e-4 * scale)

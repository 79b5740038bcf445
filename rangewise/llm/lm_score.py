"""Scoring whole documents with a gated recurrent language model (``gru``).

1. Word counts of all training documents: a map-side count per task, then one
   ``groupBy``. The table is written and never leaves Spark whole.
2. The model is trained on every training document in ``TURNS`` turns, each
   over its share of the documents: tasks train copies, and the copies'
   parameters, in blocks, are averaged, weighted by tokens, in a tree that
   joins at most ``FAN`` copies a step before the last. Only the averaged
   parameters reach the driver. Every word that makes
   up one in ``SHARE`` training tokens, and occurs ``LEAST`` times, is in the
   model's vocabulary, so it has under ``SHARE`` words whatever the corpus.
3. Every document is scored whole: the model gives the probability of
   frequent words and of "another word"; that word's share of the others
   comes from its count. The ``HEAD`` most frequent words' counts go to the
   tasks (a fixed bound); rarer words meet the count table in a join.

Words are told apart by 64-bit hashes of their lower-cased bytes (A-Z only).

The model depends on how documents are split into tasks, since each task
trains a copy; counts and base scores do not.

Defined cases: null and empty texts are the end token alone; very long texts
are learned and scored whole, in windows that hand on the state; rows are scored
one by one, also when they repeat an id; rows of a null id train the model
(no checksum holds them out); without training documents all counts are zero;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangewise.llm import gru
from rangewise.llm.common import LOWER, chunks, mapped, plain, texts, word_hashes, words, written
from rangewise.llm.quality_classifier import held_out
from rangewise.session import ship_package

#: Most frequent words whose counts are sent to the tasks.
HEAD = 1 << 19
#: A word of the model's vocabulary is at least one in so many training
#: tokens, and occurs at least so often.
SHARE, LEAST = 1 << 18, 2
#: Tokens that a task trains on or scores side by side.
POOL = 1 << 22
#: Parameters in a block.
BLOCK = 1 << 16
BLOCKS = "k int, copies long, tokens long, x binary"
#: Copies averaged in one step of the tree, and its steps before the last.
FAN, STEPS = 64, 2
#: Turns of training; each document is in one of them.
TURNS = 2
#: The end token's place among word hashes.
END = np.uint64(0)


def _hashed(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word codes with an end token after each text, offsets, and the hash of
    each code (the end's last)."""
    codes, offsets, vocab = words(mapped(plain(arr), LOWER))
    h = word_hashes(vocab)
    h[h == END] = np.uint64(1)
    codes = np.insert(codes, offsets[1:], len(h))
    return codes, offsets + np.arange(len(offsets)), np.append(h, END)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c): occurrences of each word hash in the texts, ends included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, times = np.empty(0, np.uint64), np.empty(0, np.int64)
        for b in chunks(batches):
            codes, _, h = _hashed(b.column("text"))
            joined = np.concatenate([found, h])
            n = np.concatenate([times, np.bincount(codes, minlength=len(h))])
            found, back = np.unique(joined, return_inverse=True)
            times = np.bincount(back, n, minlength=len(found)).astype(np.int64)
            if len(found) > 1 << 20:  # hand on what is held
                yield _counts(found, times)
                found, times = found[:0], times[:0]
        yield _counts(found, times)

    ship_package(docs.sparkSession)
    return (docs.mapInArrow(count, "word long, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def _counts(found: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    some = times > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(found[some].view(np.int64)), pa.array(times[some])], names=["word", "c"])


class Head:
    """The most frequent words' counts, and the model's vocabulary in them."""

    def __init__(self, found: np.ndarray, times: np.ndarray, total: int):
        top = np.lexsort((found, -times))
        frequent = int((times >= max(LEAST, total / SHARE)).sum())
        self.size = gru.grid(frequent + 1)
        self.rest = self.size * self.size  # the model's id of any other word
        # the end is always in the vocabulary, then words by count
        chosen = [END] + [w for w in found[top[:self.rest]] if w != END][:self.rest - 1]
        order = np.argsort(found)
        self.words, self.counts = found[order], times[order]
        self.vocab = np.array(chosen, np.uint64)
        self.vocab_order = np.argsort(self.vocab)
        have = self.count(self.vocab)
        self.vocab_counts = np.zeros(self.rest, np.int64)
        self.vocab_counts[:len(have)] = np.maximum(have, 0)

    def count(self, h: np.ndarray) -> np.ndarray:
        """Counts of word hashes, -1 for those that are not here."""
        if not len(self.words):
            return np.full(len(h), -1, np.int64)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.counts[at], -1)

    def ids(self, h: np.ndarray) -> np.ndarray:
        """The model's id of each word hash."""
        at = np.minimum(np.searchsorted(self.vocab, h, sorter=self.vocab_order), len(self.vocab) - 1)
        at = self.vocab_order[at]
        return np.where(self.vocab[at] == h, at, self.rest).astype(np.int32)


def train(docs: DataFrame, head: Head, total: int, turns: int = TURNS) -> gru.Params:
    """Parameters averaged over tasks that each train on their documents."""
    params = gru.initial(head.vocab_counts, float(total - head.vocab_counts.sum()))
    for turn in range(turns):
        now = gru.flat(params)

        def learn(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            trainer = gru.Trainer(gru.unflat(now, head.size))
            coded = ((offsets, head.ids(h)[codes]) for codes, offsets, h in
                     (_hashed(b.column("text")) for b in chunks(batches)))
            for some in _pooled(coded):
                trainer.learn(_lanes(some))
            if trainer.tokens:
                x = gru.flat(trainer.p)
                task = TaskContext.get().partitionId()
                yield _blocks({(k, task // FAN): (trainer.tokens, x[k * BLOCK:(k + 1) * BLOCK])
                               for k in range(-(-len(x) // BLOCK))})

        share = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(turns)) == turn)
        copies = share.mapInArrow(learn, BLOCKS)
        for _ in range(STEPS):
            copies = copies.repartition("k", "copies").mapInArrow(_average, BLOCKS)
        rows = (copies.withColumn("copies", F.lit(0).cast("long")).repartition("k")
                .mapInArrow(_average, BLOCKS).toArrow().sort_by("k"))
        if rows.num_rows:  # one row per block
            params = gru.unflat(np.concatenate(
                [np.frombuffer(x, np.float32) for x in rows["x"].to_pylist()]), head.size)
    return params


def _pooled(parts: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Parts, each (offsets, ids, ...), in lists of ``POOL`` tokens or of one
    part: few long texts then keep many lanes waiting less often."""
    held, tokens = [], 0
    for part in parts:
        if held and tokens + len(part[1]) > POOL:
            yield held
            held, tokens = [], 0
        held.append(part)
        tokens += len(part[1])
    if held:
        yield held


def _lanes(parts: list[tuple]) -> gru.Lanes:
    """The texts of all ``parts`` in order."""
    sizes = np.concatenate([np.diff(part[0]) for part in parts])
    return gru.Lanes.of(np.concatenate([part[1] for part in parts]), np.append(0, np.cumsum(sizes)))


def _blocks(found: dict[tuple[int, int], tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Rows of (block, group of copies) -> (tokens, parameters)."""
    return pa.RecordBatch.from_arrays([
        pa.array([k for k, _ in found], pa.int32()), pa.array([g for _, g in found], pa.int64()),
        pa.array([n for n, _ in found.values()], pa.int64()),
        pa.array([x.astype(np.float32).tobytes() for _, x in found.values()], pa.binary())],
        names=["k", "copies", "tokens", "x"])


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block of a group of copies once, averaged by tokens, in the next
    step's group. What is held follows the groups of a task, not the copies."""
    total: dict[tuple[int, int], list] = {}
    for b in batches:
        for k, g, n, x in zip(*(c.to_pylist() for c in b.columns)):
            held = total.setdefault((k, g), [0, 0.0])
            held[0] += n
            held[1] = held[1] + np.frombuffer(x, np.float32).astype(float) * n
    for (k, g), (n, x) in total.items():
        yield _blocks({(k, g // FAN): (n, x / n)})


SCORED = ("row long, doc_id long, n_tokens long, n_known long, n_rest long, known_log double, "
          "rest_log double, model_log double, rare array<struct<word: long, n: int>>")


def _score(docs: DataFrame, head: Head, params: gru.Params) -> DataFrame:
    """Per row what needs no rare word's count, and the rare words."""
    weights = gru.flat(params)

    def counted(b: pa.RecordBatch) -> tuple:
        codes, offsets, h = _hashed(b.column("text"))
        n = len(offsets) - 1
        text = np.repeat(np.arange(n), np.diff(offsets))
        ids, count = head.ids(h), head.count(h)
        logs = np.where(count >= 0, np.log10(np.maximum(count, 0) + 1.0), 0.0)
        rest = ids == head.rest
        key, times = np.unique((text * len(h) + codes)[count[codes] < 0], return_counts=True)
        where = np.searchsorted(key // len(h), np.arange(n + 1))
        rare = pa.ListArray.from_arrays(
            pa.array(where.astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(h[key % len(h)].view(np.int64)),
                                        pa.array(times.astype(np.int32))], names=["word", "n"]))
        return (offsets, ids[codes], b.column("doc_id"),
                *(pa.array(np.bincount(text, x[codes], minlength=n).astype(t)) for x, t in (
                    (count > 0, np.int64), (rest, np.int64), (logs, float), (logs * rest, float))), rare)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = gru.unflat(weights, head.size)
        row = TaskContext.get().partitionId() << 40
        for some in _pooled(counted(b) for b in chunks(batches)):
            model = gru.log_likelihood(p, _lanes(some), sum(len(offsets) - 1 for offsets, *_ in some))
            for offsets, _, doc_id, *rest, rare in some:
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), doc_id, pa.array(np.diff(offsets)), *rest,
                     pa.array(model[:n] / np.log(10)), rare],
                    names=["row", "doc_id", "n_tokens", "n_known", "n_rest", "known_log", "rest_log",
                           "model_log", "rare"])
                model = model[n:]
                row += n

    return docs.mapInArrow(score, SCORED)


def lm_score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7,
             fold: int = 2, head_words: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    (both log10 probabilities of the whole text) of every document."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = texts(docs, doc_id, text)
    out = held_out(F.col("doc_id"), folds, fold)
    training = docs.where(~out)
    counts = written(spark, word_counts(training), "word-counts")
    total, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # at most head_words rows of two integers
    top = counts.orderBy(F.desc("c"), "word").limit(head_words).toArrow()
    head = Head(top["word"].to_numpy().view(np.uint64), top["c"].to_numpy(), int(total))
    scored = written(spark, _score(docs, head, train(training, head, total)), "lm-scored")
    rare = (scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
            .join(counts, "word")
            .groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_log"),
                                F.sum("n").alias("rare_known")))
    rest_tokens = int(total - head.vocab_counts.sum())
    rest_types = int(types - (head.vocab_counts > 0).sum())
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id", out.alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("known_log") + rare_log
         - F.col("n_tokens") * float(np.log10(total + types + 1))).alias("base_score"),
        (F.col("model_log") + F.col("rest_log") + rare_log
         - F.col("n_rest") * float(np.log10(rest_tokens + rest_types + 1))).alias("score"))

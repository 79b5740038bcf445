"""Quality classifier: logistic regression on hashed word n-grams, learned
with follow-the-regularised-leader updates.

Features are n-grams of words (A-Z lower-cased; 1 and 2 words) and of word
shapes (runs of upper-case letters, other letters, digits and each other
character; 1 to 3 words), hashed into 2^``BITS`` places. A text's vector is
its counts, scaled to length one. A score is the logistic function of a
sparse dot product.

The model is fitted on at most ``TRAIN_ROWS`` labelled training rows (those
of the least hashed id, so the choice does not depend on order or
partitioning); that bound holds whatever the corpus's size, and so does the
size of the weights that go to the tasks. Every document is scored, whole.
Labels, language, source and id are never features.

Defined cases: null, empty and wordless texts have the bias alone; very long
texts are scored whole, by themselves; repeated rows are scored, and learned
from, one by one; extra columns are not read; rows of a
null id are scored, and count as not held out; null labels are not learned
from; without any label every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangewise.llm.common import LOWER, chunks, mix, plain, texts, word_hashes, words
from rangewise.session import ship_package

#: Hash places, as a power of two; the last is the bias.
BITS = 18
#: Most labelled rows to learn from, and how often each is seen.
TRAIN_ROWS, EPOCHS = 6000, 4
#: Learning rate, its offset, and the L1 and L2 weights.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.1

_LOWER = LOWER.tobytes()
_SHAPE = bytes(ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128
               else ord("0") if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


def _grams(h: np.ndarray, ends: np.ndarray, n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(start word, hash) of the n-grams that lie in one text; ``ends`` is
    each word's text end."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    x = np.full(m, salt, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            x = mix(x * np.uint64(0x9E3779B97F4A7C15) + h[j:j + m])
    start = np.flatnonzero(np.arange(m) + n <= ends[:m])
    return start, x[start]


def vectors(arr: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of the texts: offsets (n + 1), places, values."""
    codes, offsets, vocab = words(arr)
    raw = [w.encode() for w in vocab.to_pylist()]
    lowered = word_hashes(pa.array([w.translate(_LOWER) for w in raw], pa.binary()))
    shapes = word_hashes(pa.array([_RUN.sub(rb"\1", w.translate(_SHAPE)) for w in raw], pa.binary()))
    text = np.repeat(np.arange(len(arr)), np.diff(offsets))
    ends = offsets[1:][text] if len(text) else text
    places = (1 << bits) - 1
    keys = [np.arange(len(arr)) << bits | places]  # the bias
    for h, most, salt in ((lowered, 2, 1), (shapes, 3, 17)):
        for n in range(1, most + 1):
            start, x = _grams(h[codes], ends, n, salt + n)
            keys.append(text[start] << bits | (x % np.uint64(places)).astype(np.int64))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    row, place, value = key >> bits, key & places, count.astype(float)
    norm = np.sqrt(np.bincount(row, value * value * (place != places), minlength=len(arr)))
    value = np.where(place == places, 1.0, value / np.maximum(norm[row], 1.0))
    return np.searchsorted(row, np.arange(len(arr) + 1)), place, value


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS,
        epochs: int = EPOCHS) -> np.ndarray:
    """Weights after follow-the-regularised-leader updates, row by row."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(at) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1)
                        / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for place, value, label in rows:
            w = weights(place)
            g = (1 / (1 + np.exp(-float(w @ value))) - label) * value
            root = np.sqrt(n[place])
            n[place] += g * g
            z[place] += g - (np.sqrt(n[place]) - root) / ALPHA * w
    return weights(slice(None))


def held_out(doc_id, folds: int, fold: int):
    """Whether a document's checksum puts it in the fold kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id",
          text: str = "text", folds: int = 3, fold: int = 1, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights learned from at most ``rows`` labelled rows outside the fold."""
    key = F.col(doc_id).cast("long")
    chosen = (labels.select(key.alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
              .where(~held_out(F.col("doc_id"), folds, fold))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows))
    sample = texts(docs, doc_id, text).join(F.broadcast(chosen), "doc_id")  # at most `rows` rows

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            at, place, value = vectors(plain(b.column("text")))
            cut = list(zip(at.tolist(), at[1:].tolist()))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("label"),
                pa.array([place[s:e].astype("<i4").tobytes() for s, e in cut], pa.binary()),
                pa.array([value[s:e].astype("<f4").tobytes() for s, e in cut], pa.binary())],
                names=["doc_id", "label", "place", "value"])

    ship_package(docs.sparkSession)
    found = sample.mapInArrow(sparse, "doc_id long, label int, place binary, value binary").toArrow()
    order = np.argsort(mix(found["doc_id"].to_numpy().astype(np.uint64)), kind="stable")
    return fit([(np.frombuffer(found["place"][i].as_buffer(), "<i4"),
                 np.frombuffer(found["value"][i].as_buffer(), "<f4").astype(float),
                 found["label"][i].as_py()) for i in order.tolist()])


def score(docs: DataFrame, weights: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every document."""
    small = weights.astype(np.float32)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            at, place, value = vectors(plain(b.column("text")))
            dot = np.add.reduceat(value * small[place], at[:-1])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(1 / (1 + np.exp(-dot)))], names=["doc_id", "score"])

    ship_package(docs.sparkSession)
    return texts(docs, doc_id, text).mapInArrow(rate, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted class of every document."""
    scored = score(docs, train(docs, labels, folds=folds, fold=fold))
    return scored.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))

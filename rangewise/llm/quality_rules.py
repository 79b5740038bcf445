"""Quality rules: repetition measured on a suffix array of each text's words.

The suffixes of a text (in words) are sorted by prefix doubling; only
suffixes whose rank is still shared are sorted again. Longest common prefixes
of neighbours come from the ranks kept per level. A stack over them finds the
longest-common-prefix intervals: runs of suffixes that share exactly so many
words. An interval whose suffixes do not all follow the same word is a
maximal repeated substring (it grows neither way without losing an
occurrence). Each suffix takes the deepest such interval that it lies in, and
the union of these spans is what substrings of ``m`` words or more that occur
twice cover: one that is not maximal lies inside one that is.

A text is rejected when its spans of ``COVER_WORDS`` words or more cover over
``MAX_COVERED`` percent of its words, or its longest repeat is over
``MAX_LONGEST`` words, or the base rule fails it.

All texts of a chunk are sorted in one array (no match crosses a text), so a
task holds one chunk, or one text if that is larger. There is no shuffle.

Defined cases: null text and text without words have zero counts, fail the
base rule and are not kept; a very long text is judged whole, by itself, and
holds some 4 bytes a word for each doubling of its longest repeat; repeated
rows are judged one by one; an empty table gives no rows; extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from rangewise.llm.common import chunks, plain, raw_bytes, texts, words
from rangewise.session import ship_package

#: Shortest repeat, in words, that counts as covering.
COVER_WORDS = 10
#: Most percent of a text's words that such repeats may cover.
MAX_COVERED = 15
#: Longest repeat, in words, that a kept text may have.
MAX_LONGEST = 100
#: The base rule's window, share in percent and least number of words.
BASE_WORDS, BASE_COVERED, BASE_LEAST = 5, 20, 10

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, "
          "n_covered_words long, longest_repeat long")


def _groups(order_key: np.ndarray) -> np.ndarray:
    """Index of the first of each run of equal values, for sorted values."""
    first = np.ones(len(order_key), bool)
    first[1:] = order_key[1:] != order_key[:-1]
    return np.maximum.accumulate(np.where(first, np.arange(len(order_key)), 0))


def suffix_order(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of each text (concatenated, text by text) and the
    ranks at depths 1, 2, 4, ...: two suffixes share a rank at depth h
    exactly when their first h words are the same words of the same text."""
    n = len(codes)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    end = offsets[1:][doc] if n else doc
    key = doc * (int(codes.max(initial=0)) + 1) + codes
    sa = np.argsort(key, kind="stable")
    start = _groups(key[sa])
    rank = np.empty(n, np.int64)
    rank[sa] = start
    levels, h = [rank.astype(np.int32)], 1
    live = np.arange(n)
    while True:
        size = np.bincount(start, minlength=n) if len(start) else np.empty(0, int)
        live = np.flatnonzero(size[rank] > 1) if h == 1 else live[size[rank[live]] > 1]
        if not len(live):
            return sa, levels
        at = live + h
        nxt = np.where(at < end[live], rank[np.minimum(at, n - 1)] + 1, 0)
        key = rank[live] * (n + 1) + nxt
        o = np.argsort(key, kind="stable")
        pos, key, old = live[o], key[o], rank[live][o]
        within = np.arange(len(pos)) - _groups(old)  # place in its former group
        sa[old + within] = pos
        new = old + within[_groups(key)]
        rank = rank.copy()
        rank[pos] = new
        start, h = new, 2 * h
        levels.append(rank.astype(np.int32))


def neighbour_lcp(sa: np.ndarray, levels: list[np.ndarray], least: int) -> np.ndarray:
    """Words that each suffix of the suffix array has in common with the one
    before it; 0 where these are under ``least``."""
    out = np.zeros(len(sa), np.int64)
    if not levels:
        return out
    depth = max(k for k in range(len(levels)) if 1 << k <= least)
    at = 1 + np.flatnonzero(levels[depth][sa[:-1]] == levels[depth][sa[1:]])
    a, b, lcp, n = sa[at - 1], sa[at], np.zeros(len(at), np.int64), len(sa)
    for k in range(len(levels) - 1, -1, -1):
        ia, ib = a + lcp, b + lcp
        ok = (ia < n) & (ib < n)
        eq = np.zeros(len(a), bool)
        eq[ok] = levels[k][ia[ok]] == levels[k][ib[ok]]
        lcp += eq * (1 << k)
    out[at] = np.where(lcp >= least, lcp, 0)
    return out


def lcp_intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The longest-common-prefix intervals above 0: (common words, first and
    last place in the suffix array, parent interval or -1), and the interval
    of each place's entry of ``lcp`` (-1 for 0). One pass with a stack; only
    runs of positive entries are walked."""
    size, low, high, parent = [], [], [], []
    owner = np.full(len(lcp), -1, np.int64)
    at = np.flatnonzero(lcp)
    owners = []
    stack: list[int] = []
    last = -1
    for j, v in zip(at.tolist(), lcp[at].tolist()):
        if j != last + 1:  # a zero lies between: nothing stays open
            for k, above in zip(stack, [-1, *stack]):
                high[k], parent[k] = last, above
            stack.clear()
        left = j - 1
        while stack and size[stack[-1]] > v:
            k = stack.pop()
            high[k], left = j - 1, low[k]
            parent[k] = stack[-1] if stack and size[stack[-1]] >= v else len(size)
        if not stack or size[stack[-1]] < v:
            stack.append(len(size))
            size.append(v)
            low.append(left)
            high.append(-1)
            parent.append(-1)
        owners.append(stack[-1])
        last = j
    for k, above in zip(stack, [-1, *stack]):
        high[k], parent[k] = last, above
    owner[at] = owners
    return *(np.array(x, np.int64) for x in (size, low, high, parent)), owner


def maximal_repeats(codes: np.ndarray, offsets: np.ndarray, sa: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Per place of the suffix array the words of the longest maximal
    repeated substring that starts there, 0 if none does."""
    size, low, high, parent, owner = lcp_intervals(lcp)
    if not len(size):
        return np.zeros(len(sa), np.int64)
    # the word before each suffix; a text's first suffix differs from all others
    before = np.empty(len(codes), np.int64)
    before[1:] = codes[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    before[first] = -1 - first
    change = np.zeros(len(sa), np.int64)
    change[1:] = before[sa[1:]] != before[sa[:-1]]
    change = np.cumsum(change)
    maximal = change[high] > change[low]
    # the nearest interval outwards that is maximal; the last entry stands for none
    none = len(size)
    nearest = np.append(np.where(maximal, np.arange(none), np.where(parent < 0, none, parent)), none)
    while True:
        further = nearest[nearest]
        if (further == nearest).all():
            break
        nearest = further
    after = np.append(lcp[1:], 0)
    deepest = np.where(lcp >= after, owner, np.append(owner[1:], -1))
    return np.append(size, 0)[nearest[deepest]]  # -1: the last entry


def _covered(start, size, n: int) -> np.ndarray:
    """Words covered by the union of the spans, as running counts (n + 1)."""
    step = np.bincount(start, minlength=n + 1) - np.bincount(start + size, minlength=n + 1)
    return np.concatenate([[0], np.cumsum(np.cumsum(step)[:n] > 0)])


def repetition(codes: np.ndarray, offsets: np.ndarray,
               cover_words: int = COVER_WORDS, base_words: int = BASE_WORDS):
    """Per text: words in repeats of ``base_words`` or more, words in repeats
    of ``cover_words`` or more, and the longest repeat (0 under base_words)."""
    n, docs = len(codes), len(offsets) - 1
    if not n:
        return np.zeros(docs, np.int64), np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    sa, levels = suffix_order(codes, offsets)
    size = maximal_repeats(codes, offsets, sa, neighbour_lcp(sa, levels, base_words))
    some = size > 0
    start, size = sa[some], size[some]
    per_doc = []
    for least in (base_words, cover_words):
        k = size >= least
        run = _covered(start[k], size[k], n)
        per_doc.append(run[offsets[1:]] - run[offsets[:-1]])
    longest = np.zeros(docs, np.int64)
    np.maximum.at(longest, np.searchsorted(offsets, start, side="right") - 1, size)
    return per_doc[0], per_doc[1], longest


_CHARS = np.array([(b & 0xC0) != 0x80 and b != 32 and not 9 <= b <= 13 for b in range(256)])
_SYMBOLS = np.array([chr(b) in "#*$%&|<>" for b in range(256)])


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(flags)])
    return run[offsets[1:]] - run[offsets[:-1]]


def repeated_lines(arr: pa.Array) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text."""
    lists = pc.split_pattern(arr, "\n")
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    coded = lists.flatten().dictionary_encode()
    worded = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(coded.dictionary)), 0)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(arr)), np.diff(offsets))
    keep = worded.to_numpy(zero_copy_only=False)[codes]
    distinct = np.unique(doc[keep] * (len(coded.dictionary) + 1) + codes[keep])
    return (np.bincount(doc[keep], minlength=len(arr))
            - np.bincount(distinct // (len(coded.dictionary) + 1), minlength=len(arr)))


def verdicts(column: pa.Array, cover_words: int, max_covered: int,
             max_longest: int) -> dict[str, np.ndarray]:
    """All of ``SCHEMA`` but the id, for an array of texts."""
    arr = plain(column)
    data, offsets = raw_bytes(arr)
    codes, at, _ = words(arr)
    n = np.diff(at)
    repeat, covered, longest = repetition(codes, at, cover_words)
    failed = (n < BASE_LEAST) | (100 * repeat > BASE_COVERED * n)
    return {
        "n_words": n, "word_chars": _per_text(_CHARS[data], offsets),
        "n_symbols": _per_text(_SYMBOLS[data], offsets), "n_dup_lines": repeated_lines(arr),
        "n_repeat_words": repeat, "base_failed": failed,
        "kept": ~failed & (100 * covered <= max_covered * n) & (longest <= max_longest),
        "n_covered_words": covered, "longest_repeat": longest}


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  cover_words: int = COVER_WORDS, max_covered: int = MAX_COVERED,
                  max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row per document with the base counts, both repetition measures
    and the verdict ``kept`` (columns: ``SCHEMA``)."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            found = verdicts(b.column("text"), cover_words, max_covered, max_longest)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, found.values())],
                                             names=["doc_id", *found])

    ship_package(docs.sparkSession)
    return texts(docs, doc_id, text).mapInArrow(judge, SCHEMA)


def kept_documents(docs: DataFrame, text: str = "text", cover_words: int = COVER_WORDS,
                   max_covered: int = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, text):
            found = verdicts(b.column(text), cover_words, max_covered, max_longest)
            yield b.filter(pa.array(found["kept"]))

    ship_package(docs.sparkSession)
    return docs.mapInArrow(keep, docs.schema)

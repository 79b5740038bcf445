"""Tokenising Arrow batches of text with a public tokenizer file.

A word-level BPE never joins tokens over white space, nor over a letter and
the ASCII punctuation after it (but for an apostrophe). So texts are cut
there, each distinct piece of a batch is encoded once, and its ids are
gathered for every occurrence. Texts that hold the string of a special token are encoded whole,
since such a string may contain a cut.

A process keeps ids of recent pieces between batches. Once
``CACHE_WORDS`` are held, those not asked for since the last such turn are
forgotten, so memory is bounded and frequent words stay.
"""

from __future__ import annotations

import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rangewise.llm.common import LOWER, plain, raw_bytes, words

#: Distinct pieces after which a process's cache forgets old ones.
CACHE_WORDS = 600_000

def default_path() -> str:
    """The installed vocabulary that the queries use."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# Bytes that end a letter: ASCII letters, and the second byte of the letters
# U+00C0-U+00FF (all but the signs at 0x97 and 0xB7); ASCII punctuation but
# for the apostrophe, which may begin a token that goes on with letters.
_LETTER = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])
_LATIN_END = np.array([0x80 <= b <= 0xBF and b not in (0x97, 0xB7) for b in range(256)])
_PUNCTUATION = np.array([33 <= b < 127 and not chr(b).isalnum() and b != 39 for b in range(256)])


def separated(arr: pa.Array) -> pa.Array:
    """Texts in lower case (A-Z) with a space between a letter and the
    punctuation after it, over which no token reaches."""
    data, offsets = raw_bytes(arr)
    if not len(data):
        return arr
    cut = np.zeros(len(data), bool)
    before = data[:-1]
    letter = _LETTER[before]
    letter[1:] |= _LATIN_END[before[1:]] & (before[:-1] == 0xC3)
    cut[1:] = letter & _PUNCTUATION[data[1:]]
    cut[offsets[:-1][offsets[:-1] < len(data)]] = False  # not over texts
    moved = np.cumsum(cut)
    out = np.full(len(data) + int(moved[-1]), 32, np.uint8)
    out[np.arange(len(data)) + moved] = LOWER[data]
    shift = np.concatenate([[0], moved])  # inserted up to and with byte k - 1
    return pa.LargeStringArray.from_buffers(
        len(arr), pa.py_buffer(np.ascontiguousarray(offsets + shift[offsets])), pa.py_buffer(out))


class _Recent:
    """Two generations of a cache: what is asked for moves to the young one."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def has(self, key: str) -> bool:
        if key in self.young:
            return True
        if key in self.old:
            self.young[key] = self.old[key]
            return True
        return False

    def age(self) -> None:
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}


class Encoder:
    """Ids of whole texts, equal to ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.size = self.tokenizer.get_vocab_size()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = "|".join(re.escape(t) for t in added)
        self.known = _Recent(CACHE_WORDS)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, as little-endian 32-bit integers."""
        out = []
        for s in range(0, len(pieces), 4096):
            got = [e.ids for e in self.tokenizer.encode_batch_fast(
                pieces[s:s + 4096], add_special_tokens=False)]
            ends = np.cumsum(np.fromiter(map(len, got), np.int64, len(got)) * 4).tolist()
            flat = np.fromiter(itertools.chain.from_iterable(got), "<u4").tobytes()
            out += [flat[a:b] for a, b in zip([0, *ends], ends)]
        return out

    def _pieces(self, vocab: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given pieces in a row, and offsets per piece (n + 1)."""
        known = self.known
        new = [w for w in vocab if not known.has(w)]
        known.young.update(zip(new, self._encode_pieces(new)))
        got = list(map(known.young.__getitem__, vocab))
        ends = np.cumsum(np.fromiter(map(len, got), np.int64, len(got)) // 4)
        known.age()
        return np.frombuffer(b"".join(got), "<u4"), np.concatenate([[0], ends])

    def encode(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32) and offsets per text (n + 1)."""
        arr = plain(arr)
        whole = np.zeros(len(arr), bool)
        if self.special:  # in lower case, as that is how pieces are encoded
            whole = pc.match_substring_regex(arr, self.special, ignore_case=True)
            whole = whole.to_numpy(zero_copy_only=False)
            if whole.any():
                direct = {i: np.array(self.tokenizer.encode(
                    arr[i].as_py(), add_special_tokens=False).ids, np.uint32)
                    for i in np.flatnonzero(whole).tolist()}
                arr = pc.if_else(pa.array(whole), pa.scalar("", arr.type), arr)
        codes, offsets, vocab = words(separated(plain(arr)))
        word_ids, word_at = self._pieces(vocab.to_pylist())
        sizes = np.diff(word_at)[codes]
        total = np.concatenate([[0], np.cumsum(sizes)])
        index = np.arange(total[-1]) + np.repeat(word_at[codes] - total[:-1], sizes)
        ids, ends = word_ids[index], total[offsets]
        if whole.any():
            cut = [ids[s:e] for s, e in zip(ends, ends[1:])]
            for i, x in direct.items():
                cut[i] = x
            ids = np.concatenate(cut) if cut else ids
            ends = np.concatenate([[0], np.cumsum([len(x) for x in cut])])
        return ids, ends


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """The process's encoder for a vocabulary file."""
    key = (path, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, special_as_text)
    return _ENCODERS[key]

"""Token ids of whole columns of text by a byte-level BPE file of the tokenizers library.

Byte-level BPE first cuts a text into pre-tokens and never merges across them,
so the pieces between certain pre-token edges can be encoded one by one, and
each different piece only once for a task.  Such edges here: before a single
space between two other characters, and between a letter and a punctuation
mark other than an apostrophe, outside of the strings of special tokens.  Where the bytes around leave any doubt (rare
kinds of white space share their first byte with other characters) there is no
cut, and the piece is longer.

Pieces are told apart by a 64-bit hash: two of a million different ones share
it with a chance of 3e-8.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .textbytes import blocks, hashes

KEPT_PIECES = 1_000_000
KEPT_IDS = 16_000_000
AT_ONCE = 20_000  # pieces the tokenizer is given at once: what it returns for each takes about 1 KB
BLOCK = 4 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_SOLID = np.zeros(256, bool)  # bytes of characters that are no white space
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xE1] = True
_SOLID[0xE4:] = True
_DOUBT = np.zeros(256, bool)  # first bytes of characters that may be white space
_DOUBT[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def piece_starts(data: np.ndarray, offsets: np.ndarray, whole: list[tuple[int, int]] = ()) -> np.ndarray:
    """Where pieces start: at each row's start, and at sure pre-token edges outside of the ranges ``whole``."""
    n = data.size
    start = np.zeros(n + 1, bool)
    if n:
        follow = (data & 0xC0) == 0x80
        doubt = _DOUBT[data]
        doubt[1:] |= doubt[:-1] & follow[1:]
        doubt[1:] |= doubt[:-1] & follow[1:]
        solid = (_SOLID[data] | follow) & ~doubt
        latin = np.zeros(n, bool)  # the last byte of a letter from U+00C0 to U+00FF
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        start[1:n] = (_LETTER[data] | latin)[:-1] & _MARK[data[1:]]
        start[1:n - 1] |= solid[:-2] & (data[1:-1] == 32) & solid[2:]
        for lo, hi in whole:
            start[lo:hi] = False
        start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(start[:n])


class Encoder:
    """The tokenizer of a task and the ids of the pieces it has met."""

    def __init__(self, path: str, specials: bool = True):
        """``specials``: strings of special tokens in a text become these (the tokenizer's default), or plain text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not specials
        added = self.tokenizer.get_added_tokens_decoder().values() if specials else ()
        self.whole = [t.content.encode() for t in added]  # strings that are never cut
        self._forget()

    def _forget(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes in order, and the piece of each
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of the piece's ids in ``ids``
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        sizes, flats = [], []
        for k in range(0, len(pieces), AT_ONCE):
            got = [e.ids for e in self.tokenizer.encode_batch_fast(pieces[k:k + AT_ONCE], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
            flats.append(np.fromiter((i for ids in got for i in ids), np.uint32, int(sizes[-1].sum())))
        size, flat = np.concatenate(sizes), np.concatenate(flats)
        self.first = np.r_[self.first, self.ids.size + np.cumsum(size) - size]
        self.size = np.r_[self.size, size]
        self.ids = np.r_[self.ids, flat]
        keys = np.r_[self.keys, keys]
        slots = np.r_[self.slots, self.slots.size + np.arange(size.size)]
        order = np.argsort(keys)
        self.keys, self.slots = keys[order], slots[order]

    def _inside(self, raw: bytes) -> list[tuple[int, int]]:
        """Byte ranges within special tokens' strings, after their first byte."""
        found = []
        for token in self.whole:
            i = raw.find(token)
            while i >= 0:
                found.append((i + 1, i + len(token)))
                i = raw.find(token, i + len(token))
        return found

    def encoded(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, offsets of each row's ids) of each block of a column; null is empty."""
        for lo, hi, data, at in blocks(column, BLOCK):
            raw = data.tobytes()
            start = piece_starts(data, at, self._inside(raw))
            end = np.r_[start[1:], data.size].astype(np.int64)
            if start.size:
                key, one, of = np.unique(hashes(data, start, end), return_index=True, return_inverse=True)
                if self.keys.size > KEPT_PIECES or self.ids.size > KEPT_IDS:
                    self._forget()
                k = np.minimum(np.searchsorted(self.keys, key), max(self.keys.size - 1, 0))
                new = self.keys[k] != key if self.keys.size else np.ones(key.size, bool)
                if new.any():
                    self._learn(key[new], [raw[start[i]:end[i]].decode("utf-8", "replace") for i in one[new]])
                    k = np.searchsorted(self.keys, key)
                slot = self.slots[k][of]
                size = self.size[slot]
                until = np.cumsum(size)
                ids = self.ids[np.arange(until[-1]) + np.repeat(self.first[slot] - until + size, size)]
                edge = np.r_[0, until][np.searchsorted(start, at)]
            else:
                ids, edge = np.zeros(0, np.uint32), np.zeros(hi - lo + 1, np.int64)
            yield lo, hi, ids, edge

    def encode(self, text: str) -> np.ndarray:
        """All ids of one text."""
        return next(self.encoded(pa.array([text], pa.string())))[2]

"""An FM-index over a text of whole numbers: its Burrows-Wheeler transform in a wavelet matrix of packed bits."""

from __future__ import annotations

import numpy as np

from tidemark.llm.arrays import U64
from tidemark.llm.suffixes import suffix_ranks

_ONE, _LOW = U64(1), U64(63)


class Bits:
    """A row of bits with counts of the ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (_ONE << (at.astype(U64) & _LOW)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Counts patterns in a text (symbols 1 or more) by backward search.

    `search` narrows ranges of suffixes in sorted order by one more symbol in front; `order` are the begins of these suffixes.
    """

    def __init__(self, text: np.ndarray):
        ranks = suffix_ranks(text)
        self.order = np.empty(len(text), np.int64)
        self.order[ranks - 1] = np.arange(len(text))
        last = np.concatenate([text[-1:], np.where(self.order > 0, text[self.order - 1], 0)])  # of the end suffix, then of the others
        self.size = len(last)
        most = int(text.max())
        self.before = np.searchsorted(np.sort(last), np.arange(most + 2))
        self.levels, self.zeros = [], []
        rest = last
        for level in range(most.bit_length() - 1, -1, -1):
            bit = (rest >> level & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(len(rest) - self.levels[-1].ones)
            rest = np.concatenate([rest[~bit], rest[bit]])
        every = np.arange(most + 1)
        self.first = self._down(every, np.zeros(len(every), np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where places go in the last level, following the bits of a symbol."""
        depth = len(self.levels)
        for level, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = (symbol >> (depth - 1 - level) & 1).astype(bool)
            ones = bits.rank(at)
            at = np.where(one, zeros + ones, at - ones)
        return at

    def search(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of suffixes that begin with `symbol` and go on as those of [low, high)."""
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        shift = self.before[symbol] - self.first[symbol]
        return both[: len(symbol)] + shift, both[len(symbol) :] + shift

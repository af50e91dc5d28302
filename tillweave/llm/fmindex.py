"""A compressed FM-index over words: suffix order, Burrows-Wheeler transform and a wavelet matrix, all in numpy."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector in 64-bit words with a count before each word; ranks of many places at once."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """A wavelet matrix: one bit vector per bit of the symbols, zeros before ones from level to level."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, Bits, int]] = []
        start = np.zeros(alphabet, dtype=np.int64)  # where a symbol's places begin after the last level
        letters = np.arange(alphabet)
        for shift in range(max(alphabet - 1, 1).bit_length() - 1, -1, -1):
            bit = (symbols >> shift) & 1
            bits, zeros = Bits(bit), int(len(bit) - bit.sum())
            ones = bits.rank(start)
            start = np.where((letters >> shift) & 1, zeros + ones, start - ones)
            self.levels.append((shift, bits, zeros))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.start = start

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at - self.start[symbol]


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Cyclic places sorted by their next ``depth`` symbols at least, by repeated doubling."""
    rank, have, order = symbols.astype(np.int64), 1, np.argsort(symbols, kind="stable")
    while have < depth:
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -have)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        have *= 2
    return order


class FMIndex:
    """Backward search for patterns of at most ``depth`` symbols; symbols are 0 .. alphabet - 1."""

    def __init__(self, symbols: np.ndarray, alphabet: int, depth: int):
        self.symbols = symbols
        # one symbol deeper than the patterns, so that rows of equal patterns are complete at every step
        self.order = suffix_order(symbols, depth + 1)
        self.first = np.zeros(alphabet + 1, dtype=np.int64)
        np.cumsum(np.bincount(symbols, minlength=alphabet), out=self.first[1:])
        self.wavelet = Wavelet(symbols[self.order - 1], alphabet)

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that begin with the symbol followed by what the given rows begin with."""
        base = self.first[symbol]
        return base + self.wavelet.rank(symbol, low), base + self.wavelet.rank(symbol, high)

    def matching(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(low, high, length matched) of the text that streams by at each place, read backwards from place + length - 1.

        A place whose rows shrink to its own one is left early: nothing else matches it.
        """
        low, high = np.zeros(len(at), dtype=np.int64), np.full(len(at), len(self.symbols), dtype=np.int64)
        matched, active = np.zeros(len(at), dtype=np.int64), np.arange(len(at))
        for k in range(length - 1, -1, -1):
            symbol = self.symbols[at[active] + k]
            a, b = self.step(symbol, low[active], high[active])
            low[active], high[active] = a, b
            matched[active] += 1
            active = active[b - a > 1]
            if not len(active):
                break
        return low, high, matched

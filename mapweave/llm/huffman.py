"""Canonical length-limited Huffman codes over integer symbols, in numpy.

Lengths come from package-merge, codes are assigned in order of (length, symbol),
and bits are written from the highest down. Symbols are coded in blocks that start
at known bit offsets, so all blocks of a payload are decoded side by side with one
table look-up per symbol.
"""

from __future__ import annotations

import numpy as np

# Bits that the longest code may have beyond what tells all symbols apart.
SPARE_BITS = 3
MAX_BITS = 24


def limit_for(symbols: int) -> int:
    """A length limit for so many used symbols, small enough for a table of all codes."""
    return min(MAX_BITS, symbols.bit_length() + SPARE_BITS)


def code_lengths(counts: np.ndarray, max_bits: int | None = None) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits``; 0 for symbols with count 0."""
    max_bits = max_bits or limit_for(int(np.count_nonzero(counts)))
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols do not fit in codes of {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    n = len(leaves)
    # From the deepest level up: pairs of the level below are merged with the leaves.
    merges, packages = [], np.empty(0)
    for _ in range(max_bits):
        weights = np.concatenate((leaves, packages))
        rank = np.argsort(weights, kind="stable")
        merges.append(rank < n)
        merged = weights[rank]
        paired = merged[: len(merged) // 2 * 2]
        packages = paired[0::2] + paired[1::2]
    # From the top down: of the first items of a level, each leaf gets one more bit.
    need = 2 * n - 2
    for is_leaf in reversed(merges):
        taken = int(is_leaf[:need].sum())
        lengths[order[:taken]] += 1
        need = 2 * (need - taken)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol, in the low bits."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        top = int(lengths[order[-1]])
        steps = np.left_shift(np.uint64(1), (top - lengths[order]).astype(np.uint64))
        starts = np.concatenate(([np.uint64(0)], np.cumsum(steps)[:-1]))
        codes[order] = np.right_shift(starts, (top - lengths[order]).astype(np.uint64))
    return codes


class Coder:
    """Encodes and decodes arrays of symbols by the lengths of their codes."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint8)
        self.top = max(1, int(self.lengths.max(initial=0)))
        # Codes that begin at the highest bit.
        spare = np.where(self.lengths > 0, 64 - self.lengths.astype(np.int64), 0).astype(np.uint64)
        self.codes = canonical_codes(self.lengths) << spare
        self._table: np.ndarray | None = None

    def __getstate__(self):
        return self.lengths

    def __setstate__(self, lengths):
        self.__init__(lengths)

    def encode(self, symbols: np.ndarray, block: int) -> tuple[bytes, np.ndarray]:
        """The bits of all symbols, and the bit offset at which each block begins."""
        if not len(symbols):
            return b"", np.empty(0, np.uint64)
        bits = self.lengths[symbols]
        if not bits.all():
            raise ValueError("a symbol has no code")
        ends = np.cumsum(bits, dtype=np.uint64)
        at = ends - bits
        codes = self.codes[symbols]
        word, within = at >> np.uint64(6), at & np.uint64(63)
        total = int(ends[-1])
        whole = np.zeros((total + 63 >> 6) + 1, dtype=np.uint64)
        first = np.flatnonzero(word[1:] != word[:-1]) + 1
        first = np.concatenate(([0], first))
        whole[word[first].astype(np.int64)] = np.bitwise_or.reduceat(codes >> within, first)
        # What reaches over the end of a 64-bit word; one symbol per word at most.
        over = np.flatnonzero(within + bits > 64)
        whole[word[over].astype(np.int64) + 1] |= codes[over] << (np.uint64(64) - within[over])
        return whole.astype(">u8").tobytes()[: total + 7 >> 3], at[::block]

    @property
    def table(self) -> np.ndarray:
        """Symbol and code length, in the low five bits, for every value of the next ``top`` bits."""
        if self._table is None:
            used = np.flatnonzero(self.lengths)
            order = used[np.argsort(self.codes[used], kind="stable")]
            spans = np.left_shift(1, self.top - self.lengths[order].astype(np.int64))
            # Bits that begin no code are met only behind the end of a payload.
            table = np.ones(1 << self.top, dtype=np.uint32)
            table[: int(spans.sum())] = np.repeat((order << 5) | self.lengths[order], spans)
            self._table = table
        return self._table

    def decode(self, payload: bytes, offsets: np.ndarray, count: int, block: int) -> np.ndarray:
        """``count`` symbols from blocks of ``block`` symbols that begin at ``offsets``."""
        if not count:
            return np.empty(0, np.uint32)
        table = self.table
        raw = np.frombuffer(payload + bytes(block * self.top // 8 + 8), np.uint8).astype(np.uint32)
        # The 32 bits from every byte on.
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        at = offsets.astype(np.uint32 if len(raw) < 1 << 29 else np.int64)
        out = np.empty((block, len(at)), dtype=np.uint32)
        rest, five = np.uint32(32 - self.top), np.uint32(31)
        for i in range(block):
            seen = window[at >> 3]
            seen <<= (at & 7).astype(np.uint32)
            seen >>= rest
            found = out[i]
            np.take(table, seen, out=found, mode="clip")
            at += found & five
        return (out.T.reshape(-1)[:count]) >> np.uint32(5)

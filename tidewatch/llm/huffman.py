"""Canonical Huffman codes of limited length over arrays of ids, with numpy."""

import numpy as np

# Codes stay this short unless there are too many ids for that: the decoding table has one entry
# for every string of as many bits.
MAX_BITS = 18
# A code and the bits of its first byte that belong to others must fit 32 bits.
MOST_BITS = 25
# Ids between two checkpoints.
STEP = 128


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Bits of the code of each id in an optimal prefix code without longer ones: package-merge.

    ``counts`` are positive. Every round merges the ids with the pairs of the round before; an id
    is as long as it is often among the cheapest of all rounds.
    """
    size = len(counts)
    if size < 2:
        return np.ones(size, dtype=np.int64)
    if size > 1 << max_bits:
        raise ValueError(f"{size} ids have no code of {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    rounds, last = [np.ones(size, dtype=bool)], weights
    for _ in range(max_bits - 1):
        pairs = last[: len(last) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        sorted_ = np.argsort(both, kind="stable")
        rounds.append(sorted_ < size)
        last = both[sorted_]
    lengths = np.zeros(size, dtype=np.int64)
    taken = 2 * size - 2
    for own in reversed(rounds):
        mine = int(np.count_nonzero(own[:taken]))
        lengths[order[:mine]] += 1
        taken = 2 * (taken - mine)
    return lengths


class Code:
    """The canonical code of ``symbols`` (ascending ids) and their lengths."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.symbols, self.lengths = symbols.astype(np.int64), lengths.astype(np.int64)
        self.bits = int(lengths.max(initial=1))
        order = np.lexsort((self.symbols, self.lengths))
        # As numbers of ``bits`` bits, codes in this order follow each other without a gap.
        widths = np.left_shift(np.int64(1), self.bits - self.lengths[order])
        starts = np.cumsum(widths) - widths
        codes = np.empty(len(order), dtype=np.int64)
        codes[order] = starts >> (self.bits - self.lengths[order])
        size = int(symbols.max(initial=-1)) + 1
        self._code, self._length = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self._code[self.symbols], self._length[self.symbols] = codes, self.lengths
        # An id may have 27 bits beside the five of its length.
        if size > 1 << 27:
            raise ValueError(f"ids up to {size - 1} do not fit the decoding table")
        table = np.zeros(1 << self.bits, dtype=np.uint32)
        entries = (self.symbols[order] << 5 | self.lengths[order]).astype(np.uint32)
        filled = np.repeat(entries, widths)
        table[: len(filled)] = filled
        self._table = table

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
        """For documents of ``counts`` ids in ``ids``: their bits, each from a byte of its own, and
        the bits of each of their lanes of ``STEP`` ids (the last may have fewer)."""
        if not len(ids):
            return [b""] * len(counts), [np.zeros(0, np.uint16)] * len(counts)
        length = self._length[ids]
        ends = np.cumsum(length)
        stops = np.cumsum(counts)
        doc_ends = np.concatenate([[np.uint64(0)], ends])[stops]
        doc_bits = np.diff(doc_ends, prepend=np.uint64(0))
        sizes = (doc_bits + np.uint64(7)) >> np.uint64(3)
        bases = np.cumsum(sizes) - sizes
        shift = (bases << np.uint64(3)) - (doc_ends - doc_bits)
        at = ends - length + np.repeat(shift, counts)
        word, inside = at >> np.uint64(5), at & np.uint64(31)
        placed = self._code[ids] << (np.uint64(64) - length - inside)
        # All codes that start in one word are put together, then what reaches into the next.
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        joined = np.bitwise_or.reduceat(placed, first)
        words = np.zeros(int(word[-1]) + 2, dtype=np.uint32)
        words[word[first]] = joined >> np.uint64(32)
        words[word[first] + np.uint64(1)] |= (joined & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        raw = words.astype(">u4").tobytes()
        payloads = [raw[a : a + n] for a, n in zip(bases.tolist(), sizes.tolist())]
        lanes = -(-counts // STEP)
        starts = np.repeat(stops - counts, lanes) + STEP * _places(lanes)
        lane_bits = np.add.reduceat(length, starts).astype(np.uint16)
        return payloads, np.split(lane_bits, np.cumsum(lanes)[:-1])

    def decode(self, payload: bytes, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The ids of all lanes, one after the other: ``counts`` ids each (``STEP`` at most) from the
        bit ``offsets``. The lanes go forward side by side, one id a step; what a shorter lane reads
        beyond its end is thrown away."""
        if not len(offsets):
            return np.zeros(0, dtype=np.uint32)
        steps = int(counts.max())
        padded = payload + bytes(steps * self.bits // 8 + 8)
        raw = np.frombuffer(padded, dtype=np.uint8).astype(np.uint32)
        windows = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
        out = np.empty((steps, len(offsets)), dtype=np.uint32)
        at = offsets.astype(np.int64)
        drop = np.uint32(32 - self.bits)
        for step in range(steps):
            # A shift of 32 bits loses the bits before the code.
            window = windows[at >> 3] << (at & 7).astype(np.uint32)
            entry = out[step] = self._table[window >> drop]
            at += entry & np.uint32(31)
        return out.T[np.arange(steps) < counts[:, None]] >> np.uint32(5)


def _places(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... in each of consecutive runs of these lengths."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def code_of(symbols: np.ndarray, counts: np.ndarray) -> Code:
    """The best code for ids that occur so often, of ``MAX_BITS`` bits or as few more as they need."""
    needed = max(1, int(len(symbols) - 1).bit_length() + 2) if len(symbols) else 1
    bits = max(MAX_BITS, needed)
    if bits > MOST_BITS:
        raise ValueError(f"{len(symbols)} different ids need codes of over {MOST_BITS} bits")
    order = np.argsort(symbols)
    return Code(symbols[order], code_lengths(counts[order], bits))

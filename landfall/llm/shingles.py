"""Word shingles of whole batches of texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
PIECE_BYTES = 1 << 20  # a longer row is read in pieces that end between words
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = _powers(int(_R), n)
            self.down = _powers(pow(int(_R), -1, 1 << 64), n)
        return self.up, self.down


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, word offsets per row) after lower-casing A-Z."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & (before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    up, down = powers.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data] + np.uint64(1)) * up[:n], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    h = mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return h, np.searchsorted(starts, offsets)


def row_word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes``, a single long row in pieces: the work arrays stay small."""
    if len(offsets) != 2 or len(data) <= 2 * PIECE_BYTES:
        return word_hashes(data, offsets, powers)
    out, start = [], 0
    while start < len(data):
        stop = min(start + PIECE_BYTES, len(data))
        while stop < len(data):  # on to the next white space
            gap = np.flatnonzero(_SPACE[data[stop:stop + PIECE_BYTES]])
            if len(gap):
                stop += int(gap[0])
                break
            stop = min(stop + PIECE_BYTES, len(data))
        out.append(word_hashes(data[start:stop], np.array([0, stop - start]), powers)[0])
        start = stop
    words = np.concatenate(out)
    return words, np.array([0, len(words)])


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every k-word shingle; a row with 1 to k-1 words has its
    whole sequence as its only one."""
    counts = np.diff(offsets)
    rows = np.repeat(np.arange(len(counts)), np.maximum(counts - k + 1, 0))
    n = len(words)
    if n >= k:
        h = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            h = mix64(h * np.uint64(0x2545F4914F6CDD1D) + words[j:n - k + 1 + j] + np.uint64(k))
        index = np.arange(n - k + 1)
        left = np.repeat(offsets[1:], counts)[:n - k + 1] - index
        h = h[left >= k]
    else:
        h = np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            here = counts[short] > j
            w = words[np.minimum(offsets[short] + j, n - 1)]
            step = mix64(extra * np.uint64(0x2545F4914F6CDD1D) + w + counts[short].astype(np.uint64))
            extra = np.where(here, step, extra)
        h, rows = np.concatenate([h, extra]), np.concatenate([rows, short])
    return h, rows


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int, powers: Powers,
                 rank=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, row offsets, set digests): each row's distinct shingles, ordered
    by ``rank(hash)`` (0 to 63) and hash. The digest depends on the set only."""
    words, at = row_word_hashes(data, offsets, powers)
    h, rows = shingle_hashes(words, at, k)
    n_rows = len(offsets) - 1
    ranks = np.zeros(len(h), np.uint64) if rank is None else rank(h).astype(np.uint64)
    # one sort by (row, rank, leading bits of the hash)
    bits = np.uint64(max(n_rows - 1, 1).bit_length() + 6)
    key = (rows.astype(np.uint64) << (np.uint64(64) - bits + np.uint64(6))
           | ranks << (np.uint64(64) - bits) | h >> bits)
    order = np.argsort(key)
    key, sorted_h = key[order], h[order]
    if ((key[1:] == key[:-1]) & (sorted_h[1:] != sorted_h[:-1])).any():  # the bits left out decide
        order = np.lexsort((h, ranks, rows))
        sorted_h = h[order]
    h, rows = sorted_h, rows[order]
    if len(h):
        new = np.append(True, (h[1:] != h[:-1]) | (rows[1:] != rows[:-1]))
        h, rows = h[new], rows[new]
    out = np.searchsorted(rows, np.arange(n_rows + 1))
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix64(h + np.uint64(0x632BE59BD9B4E019)), out=total[1:])
    digest = mix64(total[out[1:]] - total[out[:-1]] + np.diff(out).astype(np.uint64))
    return h, out, digest

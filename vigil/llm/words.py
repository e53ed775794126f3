"""Words of a batch of texts as arrays of 64-bit hashes; numpy over UTF-8 bytes, nothing per row.

Used inside tasks. The words of a text are the maximal runs of the bytes that a
``Words`` instance counts as word bytes; every byte of a character outside ASCII
is one, so the cut is the same as on characters.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20  # bytes handled at once: bounds the working memory, not the text


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit integers (a multiply-xorshift finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Cuts and hashes words. ``word_bytes``: 256 flags; A-Z are lower-cased before hashing."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, word_bytes):
        self.is_word = np.asarray(word_bytes, dtype=bool)
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.up = powers(self.BASE, PIECE + 1)
        self.down = powers(pow(self.BASE, -1, 1 << 64), PIECE + 1)

    def of_bytes(self, data: np.ndarray, cuts: np.ndarray):
        """(starts, ends, hashes) of the words of ``data``; no word crosses a position in ``cuts``."""
        inside = self.is_word[data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        before[cuts[cuts < len(data)]] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        closing = cuts[(cuts > 0) & (cuts < len(data))] - 1
        after[closing] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, self._hashes(data, starts, ends)

    def _hashes(self, data, starts, ends):
        out = np.empty(len(starts), dtype=np.uint64)
        first = 0
        while first < len(starts):
            origin = starts[first]
            last = max(first + 1, int(np.searchsorted(ends, origin + PIECE, side="right")))
            out[first:last] = self._of_piece(data[origin:ends[last - 1]], starts[first:last] - origin,
                                             ends[first:last] - origin)
            first = last
        return out

    def _of_piece(self, data, starts, ends):
        up, down = self.up, self.down
        if len(data) >= len(up):  # one word longer than a piece
            up, down = powers(self.BASE, len(data) + 1), powers(pow(self.BASE, -1, 1 << 64), len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((self.lower[data].astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
        return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def of_texts(self, texts):
        """(bytes, starts, ends, hashes, word offsets by text) of an Arrow string array; null is empty."""
        data, cuts = text_bytes(texts)
        starts, ends, hashes = self.of_bytes(data, cuts)
        return data, starts, ends, hashes, np.searchsorted(starts, cuts)


def text_bytes(texts):
    """UTF-8 bytes of an Arrow string array and the offsets of its texts (one more than texts)."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or len(texts) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[cuts[0]:cuts[-1]], cuts - cuts[0]


def row_groups(texts, size: int = 4 * PIECE):
    """(first row, last row + 1) of runs of texts that hold about ``size`` bytes, one text at least."""
    _, cuts = text_bytes(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + size, side="right")) - 1)
        yield first, last
        first = last


NOT_SPACE = [not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)]
ALPHANUMERIC = [0x30 <= b <= 0x39 or 0x61 <= (b | 0x20) <= 0x7A and b < 0x80 or b >= 0x80 for b in range(256)]


def shingles(hashes: np.ndarray, offsets: np.ndarray, size: int):
    """(shingle hashes, shingle offsets by text): runs of ``size`` words; a shorter text with words is one shingle."""
    counts = np.diff(offsets)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_offsets = np.concatenate([[0], np.cumsum(made)])
    factors = powers(0xD6E8FEB86659FD93, size)[::-1]
    n = len(hashes)
    rolling = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        rolling += hashes[k:n - size + 1 + k] * factors[k] if n >= size else 0
    long_rows = np.flatnonzero(counts >= size)
    out = np.empty(out_offsets[-1], dtype=np.uint64)
    if len(long_rows):
        take = np.ones(out_offsets[-1], dtype=bool)
        short = np.flatnonzero((counts > 0) & (counts < size))
        take[out_offsets[short]] = False
        run = np.repeat(offsets[long_rows] - out_offsets[long_rows], made[long_rows])
        where = np.flatnonzero(take)
        out[where] = rolling[where + run]
    for k in np.flatnonzero((counts > 0) & (counts < size)):
        value = np.uint64(counts[k])
        for h in hashes[offsets[k]:offsets[k + 1]]:
            value = mixed(np.array([value ^ h], dtype=np.uint64))[0]
        out[out_offsets[k]] = value
    return mixed(out), out_offsets

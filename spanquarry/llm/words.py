"""Words and word n-grams of a batch of texts as arrays: where they lie and 64-bit hashes of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once; bounds the memory of a task whatever the length of a text.
BLOCK = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i below n; ``base`` is odd."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    out = []
    for b in (base, inverse):
        steps = np.full(n, b, np.uint64)
        steps[:1] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


class Words:
    """The words of a batch: ``doc`` (row in the batch), byte range and hash of each, in order."""

    def __init__(self, texts: pa.Array, separators: bytes):
        texts = pc.fill_null(texts, "")
        wide = pa.types.is_large_string(texts.type)
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.bytes = raw[ends[0] : ends[-1]]
        ends -= ends[0]
        self.offsets = ends
        is_word = np.ones(256, bool)
        is_word[list(separators)] = False
        inside = is_word[self.bytes]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edges = ends[(ends > 0) & (ends < len(self.bytes))]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        self.begin = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.doc = (np.searchsorted(ends, self.begin, "right") - 1).astype(np.int32)
        self.of_doc = np.searchsorted(self.begin, ends)
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.begin), np.uint64)
        up, down = powers(_ODD, 64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.end, self.begin[i] + BLOCK)))
            a, b = int(self.begin[i]), int(self.end[j - 1])
            if b - a >= len(up):
                up, down = powers(_ODD, b - a + 1)
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(_BYTE[self.bytes[a:b]] * up[: b - a], out=sums[1:])
            x, y = self.begin[i:j] - a, self.end[i:j] - a
            out[i:j] = (sums[y] - sums[x]) * down[x] + (y - x).astype(np.uint64)
            i = j
        return mix(out)

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on, for all but the last n - 1 words of the batch."""
        size = max(0, len(self.hash) - n + 1)
        out = np.zeros(size, np.uint64)
        for j in range(n):
            out = out * _GRAM + self.hash[j : j + size]
        return mix(out)

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words from each word on belong to one text."""
        size = max(0, len(self.hash) - n + 1)
        return self.doc[:size] == self.doc[n - 1 : n - 1 + size]

    def span_hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words begin..end (exclusive) of each span."""
        up, down = powers(_GRAM, len(self.hash) + 1)
        sums = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(self.hash * up[:-1], out=sums[1:])
        return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * _ODD)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours."""
    size, held = len(x) - w + 1, 1
    if size <= 0:
        return x[:0]
    while 2 * held <= w:
        x = np.minimum(x[:-held], x[held:])
        held *= 2
    return np.minimum(x[:size], x[w - held : w - held + size])


def parts(texts: pa.Array, most: int = 4 << 20):
    """Slices (offset, length) of a batch of about so many bytes each; a longer text is a slice of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(sizes):
        done = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, done + most, "right")))
        yield begin, end - begin
        begin = end

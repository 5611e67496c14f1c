"""Words and word hashes of many texts at once, as numpy arrays over their UTF-8 bytes.

White space is U+0020 and U+0009 to U+000D and only A-Z are lower-cased. All of these are
single bytes in UTF-8, so words are found on bytes without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20  # text per numpy step, so that temporary arrays stay small

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over a 64-bit word (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base, mask = 0xD1342543DE82EF95, (1 << 64) - 1
    inverse = pow(base, -1, mask + 1)

    def table(p: int) -> np.ndarray:
        out = np.full(size, p & mask, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return table(base), table(inverse)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    step = 1 << max(20, int(size - 1).bit_length())
    return _powers(step)


class Texts:
    """Some texts as one byte array; `starts[i]:starts[i + 1]` are the bytes of text i."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        self.data = data
        self.starts = starts.astype(np.int64)

    def __len__(self) -> int:
        return len(self.starts) - 1


class Words:
    """The words of `texts`, in order.

    hashes: 64-bit hash of each lower-cased word; begin, end: its bytes; first[i]:first[i + 1]
    are the words of text i.
    """

    def __init__(self, texts: Texts, spaces: np.ndarray = SPACE, lower: np.ndarray = LOWER):
        data, n = texts.data, len(texts.data)
        solid = ~spaces[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[texts.starts] = True
        edge[n] = True
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= spaces[data[:-1]] | edge[1:n]
        ends[:-1] &= spaces[data[1:]] | edge[1:n]
        self.begin = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.begin, texts.starts)
        up, down = powers(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[lower[data]] * up[:n], out=total[1:])
        value = (total[self.end] - total[self.begin]) * down[self.begin]
        self.hashes = mix(value + (self.end - self.begin).astype(np.uint64))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text number of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def grams(hashes: np.ndarray, k: int, step: int = 1) -> np.ndarray:
    """Hashes of k words `step` apart, for each first word that has them all."""
    n = len(hashes) - (k - 1) * step
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(_ODD) + hashes[i * step : i * step + n] + np.uint64(k + 64 * step))
    return out


def as_texts(column: pa.Array) -> Texts:
    """A null counts as empty text."""
    column = pa.array([], pa.large_string()) if len(column) == 0 else column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return Texts(np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64))
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return Texts(raw[starts[0] : starts[-1]], starts - starts[0])


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most `most` bytes of text, or a single row."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = np.diff(as_texts(texts).starts)
    at, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > at and total + size > most:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += size
    if at < len(sizes):
        yield batch.slice(at)

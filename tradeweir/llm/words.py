"""Words of whole Arrow batches as 64-bit hashes, found on the UTF-8 bytes without a loop over texts.

A word is a run of ASCII letters, digits and characters outside ASCII; A-Z count as a-z. All bytes
of a character outside ASCII are 0x80 or more, so runs of bytes are runs of characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
_WORD_BYTE = IS_WORD[_LOWER]
_BYTE_VALUE = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """Words of a batch: hash, first byte and end byte of each, and where each document's words begin."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of len(documents) + 1

    def text(self, i: int, j: int) -> list[str]:
        """Words i to j, lower-cased as the hashes are."""
        return [
            _LOWER[self.data[a:b]].tobytes().decode("utf-8", "replace")
            for a, b in zip(self.starts[i:j], self.ends[i:j], strict=True)
        ]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offsets of each text; a null has no bytes."""
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string())
    texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    bytes_ = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, np.uint8)
    return bytes_, bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = _BASE
    return np.multiply.accumulate(out)


def words_of(texts: pa.Array) -> Words:
    data, bounds = utf8(texts)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD_BYTE[data]
    begins = inside[1:] & ~inside[:-1]
    begins[bounds[:-1]] |= inside[bounds[:-1] + 1] if len(bounds) > 1 else False
    starts = np.flatnonzero(begins[:-1])
    finish = inside[:-1] & ~inside[1:]
    edges = bounds[1:]
    finish[edges] |= inside[edges]
    ends = np.flatnonzero(finish)
    return Words(data, hash_runs(data, starts, ends), starts, ends, np.searchsorted(starts, bounds))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, blind to the case of A-Z."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    value = _BYTE_VALUE[data[np.repeat(starts, lengths) + place]] * powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that begin at each word, running on over the ends of documents."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        out = mix(out * _BASE + hashes[i : len(hashes) - n + 1 + i])
    return out

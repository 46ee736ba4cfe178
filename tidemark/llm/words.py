"""Words of whole texts as numpy arrays: one pass over the UTF-8 bytes of an Arrow column.

A word's hash is a polynomial over its bytes modulo 2**64, then mixed; a window's hash is a
polynomial over word hashes. Both are computed for a chunk of documents at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.work import CHUNK_BYTES

U64 = np.uint64
#: Bytes whose words are hashed at once.
PIECE_BYTES = 1 << 17
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240117)).integers(
    1, 2**64 - 1, 256, dtype=np.uint64
)
_powers = {1: np.ones(1, U64), -1: np.ones(1, U64)}


def powers(n: int, sign: int = 1) -> np.ndarray:
    """The first n powers of the multiplier (or of its inverse) modulo 2**64."""
    if len(_powers[sign]) < n:
        row = np.full(max(n, 1 << 16), _MULTIPLIER if sign > 0 else _INVERSE, U64)
        row[0] = 1
        _powers[sign] = np.multiply.accumulate(row)
    return _powers[sign][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit moves every output bit."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def byte_table(word: str, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, the byte after folding A-Z) for ``word`` in {"space", "alnum"}."""
    b = np.arange(256)
    folded = np.where((b >= 65) & (b <= 90), b + 32, b) if fold else b
    if word == "space":  # anything but blank, tab, line feed, vertical tab, form feed, return
        is_word = ~((b == 32) | ((b >= 9) & (b <= 13)))
    else:  # digits, a-z, and all bytes beyond ASCII
        is_word = ((folded >= 48) & (folded <= 57)) | ((folded >= 97) & (folded <= 122)) | (b > 127)
    return is_word, folded.astype(np.uint8)


@dataclass
class Words:
    """Words of a run of documents: word i has bytes data[starts[i]:ends[i]]."""

    first_row: int  # of the batch
    data: np.ndarray  # folded bytes
    bounds: np.ndarray  # byte offsets of the documents
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # word offsets of the documents

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, U64)
        values = np.empty(len(lengths), U64)
        pieces = np.searchsorted(self.starts, np.arange(0, len(self.data), PIECE_BYTES))
        cuts = np.unique(np.append(pieces, len(lengths)))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # one running sum each, small enough for a cache
            low, high = int(self.starts[a]), int(self.ends[b - 1])
            sums = np.zeros(high - low + 1, U64)
            np.cumsum(_BYTE_VALUES[self.data[low:high]] * powers(high - low), out=sums[1:])
            starts, ends = self.starts[a:b] - low, self.ends[a:b] - low
            values[a:b] = (sums[ends] - sums[starts]) * powers(high - low, -1)[starts]
        return mix(values + lengths.astype(U64))

    def room(self) -> np.ndarray:
        """For each word, the number of words from it to the end of its document."""
        n = np.diff(self.offsets)
        return np.repeat(self.offsets[1:], n) - np.arange(self.offsets[-1])


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on (the last size-1 are missing)."""
    n = len(h)
    if n < size:
        return np.zeros(0, U64)
    if size == 2:
        return mix(h[:-1] + h[1:] * powers(2)[1])
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(h * powers(n), dtype=U64)])
    return mix((sums[size:] - sums[:-size]) * powers(n - size + 1, -1))


def range_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the words starts[i]..ends[i] (exclusive)."""
    n = len(h)
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(h * powers(n), dtype=U64)])
    return mix((sums[ends] - sums[starts]) * powers(n + 1, -1)[starts] + (ends - starts).astype(U64))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def split(texts: pa.Array, word: str = "space", fold: bool = False) -> Iterator[Words]:
    """Words of all texts, in runs of whole documents of about CHUNK_BYTES."""
    is_word, folded = byte_table(word, fold)
    offsets, data = text_bytes(texts)
    row, rows = 0, len(texts)
    while row < rows:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        bounds = offsets[row : last + 1] - offsets[row]
        raw = data[offsets[row] : offsets[last]]
        inside = is_word[raw]
        starts_here = inside.copy()
        starts_here[1:] &= ~inside[:-1]
        breaks = bounds[:-1][bounds[:-1] < bounds[1:]]  # a document's first byte starts anew
        starts_here[breaks] = inside[breaks]
        ends_here = inside.copy()
        ends_here[:-1] &= ~inside[1:]
        lasts = bounds[1:][bounds[:-1] < bounds[1:]] - 1
        ends_here[lasts] = inside[lasts]
        starts, ends = np.flatnonzero(starts_here), np.flatnonzero(ends_here) + 1
        yield Words(
            row, folded[raw] if fold else raw, bounds, starts, ends, np.searchsorted(starts, bounds)
        )
        row = last

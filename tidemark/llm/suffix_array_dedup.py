"""Suffix-array dedup: sparse suffix arrays at content-selected positions.

Only suffixes that start at minimiser anchors are kept (:mod:`tidemark.llm.repeats`); those that
share an anchor meet in one task. There they are sorted by the words to the right of the anchor,
and, backwards, by the words to its left; neighbours in either order are compared for their
longest common prefix. A match is extended to both sides from its anchor: two windows that
start o words before it are equal exactly if no neighbour between them differs within o words
to the left or within the rest to the right. So every window of ``length`` words that also
occurs earlier is found, and passages of that length or more lose their later copies.

Windows of 50 words are the default; defined cases are those of :mod:`tidemark.llm.repeats`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import repeats

LENGTH = 50
GRAM = 16


def _sorted_prefixes(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): rows sorted within groups, and each one's common prefix with the one
    before it; -1 across groups."""
    order = np.lexsort((*rows.T[::-1], group))
    common = np.full(len(order), -1)
    if rows.shape[1]:
        same = rows[order[1:]] == rows[order[:-1]]
        common[1:] = np.where(same.all(axis=1), rows.shape[1], (~same).argmax(axis=1))
    else:
        common[1:] = 0
    common[1:][group[order[1:]] != group[order[:-1]]] = -1
    return order, common


def _classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """Number of the class of rows with the same first ``depth`` words."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < depth)
    return out


def compare(part: pa.RecordBatch, length: int, gram: int) -> np.ndarray:
    """Masks of the windows that an earlier passage of the same anchor has."""
    group = part.column("anchor").to_numpy()
    shape = part.column("shape").to_numpy()
    windows, anchor = shape >> 8, shape & 255
    numbers: dict[bytes, int] = {}
    width = length - gram + 1
    n = len(group)
    right = np.full((n, length), -1, np.int32)
    left = np.full((n, width - 1), -1, np.int32)
    for i, text in enumerate(part.column("words").to_pylist()):
        ids = [numbers.setdefault(w, len(numbers)) for w in text.split(b" ")]
        a = int(anchor[i])
        right[i, : len(ids) - a] = ids[a:]
        left[i, :a] = ids[:a][::-1]
    to_right, to_left = _sorted_prefixes(group, right), _sorted_prefixes(group, left)
    masks = np.zeros(n, np.int64)
    for back in range(width):
        has = np.flatnonzero((back <= anchor) & (anchor - back < windows))
        if len(has) < 2:
            continue
        key = _classes(*to_right, length - back)[has] * (n + 1) + _classes(*to_left, back)[has]
        first = np.unique(key, return_index=True)[1]  # rows come in order of occurrence
        late = np.delete(has, first)
        masks[late] |= np.int64(1) << (anchor[late] - back).astype(np.int64)
    return masks


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, **options) -> DataFrame:
    """docs with ``text`` cut down to the kept words, n_words and n_removed."""
    return repeats.strip(docs, length, gram, compare, **options)


def report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, **options) -> DataFrame:
    return repeats.digest(deduplicate(docs.select("doc_id", "text"), length, gram, **options))

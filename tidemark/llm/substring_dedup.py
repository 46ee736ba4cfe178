"""Substring dedup by suffix automata: documents stream past reference shards.

The corpus is its own reference, so it cannot be broadcast: its automata grow with it. It is
split into shards by content (:mod:`tidemark.llm.repeats`): a shard holds the passages around
one anchor, and every passage that could match it is dealt to the same task. There a suffix
automaton takes the passages in order of first occurrence. Each passage is read through the
automaton of the earlier ones, which gives its matching statistics (the longest match that ends
at each word); a window that ends where they reach ``length`` repeats, and so maximal spans
above the threshold go. Then the passage joins the automaton, if it brought a new window.

A reference that is small by itself, such as a list of boilerplate texts, is broadcast by
:func:`remove_reference`, in shards of bounded size whose automata the workers keep.

Windows of 20 words are the default; defined cases are those of :mod:`tidemark.llm.repeats`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.llm import words as W
from tidemark.llm.work import aside, ddl, map_arrow

LENGTH = 20
GRAM = 6
#: Words of a broadcast reference shard, and of all shards of one broadcast reference.
SHARD_WORDS = 200_000
REFERENCE_WORDS = 2_000_000


class SuffixAutomaton:
    """All subsequences of consecutive words of the passages added so far."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, follow: dict[bytes, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The copy of q that stands for its matches up to one word longer than p's."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: Iterable[bytes]) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:  # known from an earlier passage
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = new

    def statistics(self, words: Iterable[bytes]) -> Iterator[int]:
        """For each word, the length of the longest known match that ends there."""
        state, length = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            follow = self.next[state].get(word)
            if follow is None:
                yield 0
                continue
            state, length = follow, length + 1
            yield length


def compare(part: pa.RecordBatch, length: int, gram: int) -> np.ndarray:
    """Masks of the windows that an earlier passage of the same anchor has."""
    anchors = part.column("anchor").to_numpy()
    texts = part.column("words").to_pylist()
    windows = part.column("shape").to_numpy() >> 8
    masks = np.zeros(len(texts), np.int64)
    automaton = None
    for i, text in enumerate(texts):
        words = text.split(b" ")
        if i == 0 or anchors[i] != anchors[i - 1]:
            automaton = SuffixAutomaton()
            automaton.add(words)
            continue
        mask = 0
        for k, reach in enumerate(automaton.statistics(words), 1 - length):
            if reach >= length:
                mask |= 1 << k
        masks[i] = mask
        if mask != (1 << int(windows[i])) - 1:
            automaton.add(words)
    return masks


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, **options) -> DataFrame:
    """docs with ``text`` cut down to the kept words, n_words and n_removed."""
    return repeats.strip(docs, length, gram, compare, **options)


def report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, **options) -> DataFrame:
    return repeats.digest(deduplicate(docs.select("doc_id", "text"), length, gram, **options))


@aside
def remove_reference(docs: DataFrame, reference: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs without the spans of ``length`` words or more that occur in a reference (text) of at
    most REFERENCE_WORDS words; a larger one raises, and belongs into ``docs`` of deduplicate."""
    size = F.size(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"))
    total = reference.agg(F.sum(size)).first()[0] or 0
    if total > REFERENCE_WORDS:
        raise ValueError(f"{total} words are too many to broadcast")
    shards: list[list[list[bytes]]] = [[]]
    for row in reference.select("text").where("text is not null").collect():
        words = row.text.encode().split()
        if sum(map(len, shards[-1])) + len(words) > SHARD_WORDS and shards[-1]:
            shards.append([])
        shards[-1].append(words)
    shared = docs.sparkSession.sparkContext.broadcast(shards)
    names = docs.columns
    built: dict[int, list[SuffixAutomaton]] = {}

    def automata() -> list[SuffixAutomaton]:
        if 0 not in built:
            built[0] = []
            for passages in shared.value:
                built[0].append(SuffixAutomaton())
                for words in passages:
                    built[0][-1].add(words)
        return built[0]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        offsets, data = W.text_bytes(batch.column("text"))
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            words = data[a:b].tobytes().split()
            gone = np.zeros(len(words), bool)
            for automaton in automata():
                for k, reach in enumerate(automaton.statistics(words)):
                    if reach >= length:
                        gone[k + 1 - reach : k + 1] = True
            texts.append(b" ".join(w for w, g in zip(words, gone, strict=True) if not g))
        fresh = {"text": pa.array(texts, pa.binary()).cast(pa.string())}
        return pa.RecordBatch.from_arrays(
            [fresh.get(c, batch.column(c)) for c in names], names
        )

    return map_arrow(docs, work, ddl(docs))

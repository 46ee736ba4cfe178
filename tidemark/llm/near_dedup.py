"""Near-duplicates by a chosen-path set similarity join, checked on full sets.

A document is the set of its word shingles; equal sets are one vertex from the start. In each
of ``trees`` independent trees a document follows a path: at every step it branches by the
shingle of its set that is smallest under the step's hash function (a minwise token), so two
documents of similarity J stay together with probability J a step. A node that is small enough
is compared exhaustively; a larger one branches again, and what is still large at the last
step is dealt into blocks that are compared two by two, so nothing is left out. Comparisons in
a node use a one-permutation sketch: the smallest shingle of each of 512 hash ranges, in one
byte. Pairs that it puts at the threshold, less 4.7 standard deviations, or above are checked
on the full sets of both texts. The sketch of a short text holds nearly all of its set, so its
deviation, that of a sample without replacement, is small.

A pair at the threshold is missed by 16 trees with probability 2.3e-10, 1.8e-6 or 1.6e-4 where
nodes are small after one, two or three steps, and its sketch falls short of the margin with probability below 1e-5.

Links need not be listed for components: of a node's candidate pairs the first round checks a
spanning forest only, most similar pairs first. A second round checks every candidate pair
whose ends are still in different components. So a group of thousands of near copies costs a
link a document, not all pairs, and no candidate goes unchecked. Documents carry the list of
their nodes, and a pair that meets in several counts in the first of them only. Nodes are
bounded; candidates, links and components are tables throughout.

Defined cases: documents without words have the empty set and link with nothing; so do those
with a null id; rows with equal ids are one vertex (linked if any of their texts is); a text of
fewer words than a shingle is one shingle; other columns do not matter.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.work import (
    aside,
    connected,
    cut,
    drop,
    map_arrow,
    map_batches,
    told_apart,
    whole_groups,
    without,
)

SHINGLE = 5
#: Similarity of linked documents as a fraction of whole numbers.
LINKED = (75, 100)
TREES = 16
STEPS = 3
NODE_ROWS = 512
SKETCH_BITS = 9
SKETCH = 1 << SKETCH_BITS
#: Standard deviations by which a candidate's estimate may fall short of the threshold.
MARGIN = 4.7
PAIRS_AT_ONCE = 50_000
#: Pairs whose sketches lie side by side in memory.
SKETCHES_AT_ONCE = 8_000

_random = np.random.Generator(np.random.PCG64(7))
_XOR = _random.integers(0, 2**64 - 1, 1024, dtype=np.uint64)
_ODD = _random.integers(0, 2**63 - 1, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for run in W.split(texts, "space", fold=True):
        h, n = run.hashes(), np.diff(run.offsets)
        starts = np.arange(len(h))
        room = run.room()
        first = np.repeat(run.offsets[:-1], n) == starts
        starts = starts[(room >= size) | first]
        hashes = W.range_hashes(h, starts, starts + np.minimum(size, room[starts]))
        bounds = np.searchsorted(starts, run.offsets)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(hashes[a:b])


def signatures(docs: DataFrame, size: int = SHINGLE, trees: int = TREES) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, sketch, path): the set's size, fingerprint and sketch, and
    for each tree the nodes of its path."""
    if trees * STEPS > len(_XOR):
        raise ValueError("too many trees")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(shingle_sets(batch.column("text"), size))
        n = np.array([len(s) for s in sets])
        full = np.flatnonzero(n)
        low = np.zeros((len(full), trees * STEPS), np.uint64)
        sketches = np.zeros((len(sets), SKETCH), np.uint8)
        fingerprint = np.zeros((2, len(sets)), np.uint64)
        begin = 0
        while begin < len(full):  # a few hundred documents at a time stay in the cache
            end = begin + max(1, int(np.searchsorted(np.cumsum(n[full[begin:]]), 200_000)))
            values = np.concatenate([sets[i] for i in full[begin:end]])
            ends = np.cumsum(n[full[begin:end]])
            first = ends - n[full[begin:end]]
            for k in range(trees * STEPS):
                low[begin:end, k] = np.minimum.reduceat((values ^ _XOR[k]) * _ODD[k], first)
            mixed = W.mix(values)
            fingerprint[0, full[begin:end]] = np.add.reduceat(values, first)
            fingerprint[1, full[begin:end]] = np.add.reduceat(mixed, first)
            # sets are sorted, so the first of a hash range is its smallest
            place = np.repeat(full[begin:end], n[full[begin:end]]) * SKETCH + (
                values >> W.U64(64 - SKETCH_BITS)
            ).astype(np.int64)
            least = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            sketches.ravel()[place[least]] = mixed[least] % W.U64(255) + W.U64(1)
            begin = end
        path = np.zeros((len(full), trees, STEPS), np.uint64)
        for t in range(trees):
            node = np.full(len(full), t + 1, np.uint64)
            for s in range(STEPS):
                node = path[:, t, s] = W.mix(W.mix(node) ^ W.mix(low[:, t * STEPS + s]))
        paths = np.zeros((len(sets), trees * STEPS), np.uint64)
        paths[full] = path.reshape(len(full), trees * STEPS)
        sketch = [x.tobytes() for x in sketches]
        steps = np.arange(len(sets) + 1) * trees * STEPS
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()),
                pa.array(fingerprint[0].view(np.int64)), pa.array(fingerprint[1].view(np.int64)),
                pa.array(sketch, pa.binary()),
                pa.ListArray.from_arrays(pa.array(steps, pa.int32()), pa.array(paths.view(np.int64).ravel())),
            ],
            ["doc_id", "n_shingles", "f1", "f2", "sketch", "path"],
        )

    return map_arrow(
        docs.select("doc_id", "text"), work,
        "doc_id long, n_shingles long, f1 long, f2 long, sketch binary, path array<long>",
    )


def nodes(vertices: DataFrame, trees: int = TREES, node_rows: int = NODE_ROWS) -> DataFrame:
    """(node, rid) of all nodes to compare; each has from two to about ``node_rows`` rows."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    rows = vertices.select("rid", "path", tree.alias("t")).select(
        "rid", *(F.element_at("path", F.col("t") * STEPS + s + 1).alias(f"n{s}") for s in range(STEPS))
    )
    leaves = None
    for s in range(STEPS):
        counts = rows.groupBy(f"n{s}").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
        met = cut(rows.join(counts, f"n{s}"), "nodes")
        leaf = met.where(F.col("_rows") <= node_rows).select(F.col(f"n{s}").alias("node"), "rid")
        leaves = leaf if leaves is None else leaves.union(leaf)
        rows = met.where(F.col("_rows") > node_rows)
        large = rows.select(F.col(f"n{s}").alias("node"), "rid", "_rows")
        rows = rows.drop("_rows")
        if large.isEmpty():
            return leaves
    # large at the last step: blocks of half a node, each pair of blocks is a node
    blocks = F.ceil(F.col("_rows") * 2 / F.lit(node_rows)).cast("int")
    own = F.pmod(F.xxhash64("rid"), blocks).cast("int")
    dealt = large.select("node", "rid", own.alias("own"), blocks.alias("blocks")).select(
        "*", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")
    )
    pairs = dealt.select(
        F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "rid"
    )
    return leaves.union(pairs)


@functools.lru_cache(64)  # of small nodes; those of large ones are as large as the pairs
def _small_pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _all_pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _small_pairs(n) if n <= 64 else np.triu_indices(n, 1)


def _forest(a: np.ndarray, b: np.ndarray, same: np.ndarray, n: int) -> list[int]:
    """Indices of the pairs of a spanning forest over rows 0..n-1, most similar pairs first."""
    parent = list(range(n))
    out: list[int] = []
    for i in np.argsort(-same, kind="stable"):
        x, y = int(a[i]), int(b[i])
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[x] = y
            out.append(int(i))
            if len(out) == n - 1:
                break
    return out


def _estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of sketches a[i], b[i], and the ranges it rests on."""
    used = ((a | b) != 0).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    return same / np.maximum(1, used), used


def _least(used: np.ndarray, union: np.ndarray) -> np.ndarray:
    """The estimate from which a pair is a candidate."""
    linked = LINKED[0] / LINKED[1]
    left = np.clip(1 - used / np.maximum(1, union), 0, 1)
    return linked - MARGIN * np.sqrt(linked * (1 - linked) * (left + 0.02) / np.maximum(1, used))


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest number that is in both rows a[i], b[i]; zeros are empty places."""
    shared = ((a[:, :, None] == b[:, None, :]) & (a != 0)[:, :, None]).any(axis=2)
    return np.where(shared, a, np.iinfo(np.int64).max).min(axis=1)


def candidates(rows: DataFrame, forest: bool) -> DataFrame:
    """Distinct pairs (a < b) within nodes whose sketches come near the threshold.

    ``rows``: (node, rid, n_shingles, sketch, nodes, component), ``nodes`` being all nodes of
    the document. With ``forest`` a spanning forest of each node's pairs; without, all pairs of
    different components."""

    def compare(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        node = part.column("node").to_numpy()
        rid = part.column("rid").to_numpy()
        n = part.column("n_shingles").to_numpy()
        component = part.column("component").to_numpy()
        sketch = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
        lists = part.column("nodes")
        bounds = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        many = np.diff(bounds)
        nodes_of = np.zeros((len(node), int(many.max())), np.int64)
        nodes_of[np.repeat(np.arange(len(node)), many), np.arange(bounds[-1]) - np.repeat(bounds[:-1], many)] = (
            lists.flatten().to_numpy()
        )
        at_once = max(1, 4_000_000 // nodes_of.shape[1] ** 2)
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        sizes = np.diff(np.r_[starts, len(node)])
        found: list[np.ndarray] = []

        def flush(group: list[tuple[int, int]]) -> None:
            i = np.concatenate([_all_pairs(m)[0] + s for s, m in group])
            j = np.concatenate([_all_pairs(m)[1] + s for s, m in group])
            near = np.minimum(n[i], n[j]) * LINKED[1] >= np.maximum(n[i], n[j]) * LINKED[0]
            near &= rid[i] != rid[j]
            if not forest:
                near &= component[i] != component[j]
            i, j = i[near], j[near]
            parts = [_estimate(sketch[i[k : k + SKETCHES_AT_ONCE]], sketch[j[k : k + SKETCHES_AT_ONCE]])
                     for k in range(0, max(1, len(i)), SKETCHES_AT_ONCE)]
            same, used = (np.concatenate(x) for x in zip(*parts, strict=True))
            union = (n[i] + n[j]) / (1 + LINKED[0] / LINKED[1])  # of a pair at the threshold
            close = same >= _least(used, union)
            i, j, same = i[close], j[close], same[close]
            first = np.concatenate([
                _first_common(nodes_of[i[k : k + at_once]], nodes_of[j[k : k + at_once]])
                for k in range(0, max(1, len(i)), at_once)
            ])
            here = first == node[i]
            i, j, same = i[here], j[here], same[here]
            if forest and len(i):
                s, m = group[0][0], group[-1][0] + group[-1][1] - group[0][0]
                keep = _forest(i - s, j - s, same, m)
                i, j = i[keep], j[keep]
            found.append(np.stack([np.minimum(rid[i], rid[j]), np.maximum(rid[i], rid[j])]))

        group: list[tuple[int, int]] = []
        pairs = 0
        for s, m in zip(starts.tolist(), sizes.tolist(), strict=True):
            group.append((s, m))
            pairs += m * (m - 1) // 2
            if pairs >= PAIRS_AT_ONCE:
                flush(group)
                group, pairs = [], 0
        if group:
            flush(group)
        a, b = np.concatenate(found, axis=1)
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "node"):
            a, b = compare(part)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    ordered = rows.repartition("node").sortWithinPartitions("node")
    return map_batches(ordered, run, "a long, b long")


def texts_of(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(rid, text) of all documents that are in a pair. Texts are shuffled at every size, so
    that cost grows in step with the input."""
    ends = pairs.select(F.col("a").alias("rid")).union(pairs.select("b")).distinct()
    rows = docs.select(F.col("doc_id").alias("rid"), "text")
    return cut(rows.hint("merge").join(ends, "rid", "left_semi"), "texts")


def check(pairs: DataFrame, texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(a, b, linked) of candidate pairs, by the full sets of their texts."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        linked = []
        left = shingle_sets(batch.column("text_a"), size)
        right = shingle_sets(batch.column("text_b"), size)
        for x, y in zip(left, right, strict=True):
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            union = len(both) - common
            linked.append(union > 0 and LINKED[1] * common >= LINKED[0] * union)
        return pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"]
        )

    joined = (
        pairs.hint("merge").join(texts.select(F.col("rid").alias("a"), F.col("text").alias("text_a")), "a")
        .hint("merge").join(texts.select(F.col("rid").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    return cut(map_arrow(joined, work, "a long, b long, linked boolean"), "checked")


def components(docs: DataFrame, size: int = SHINGLE, trees: int = TREES,
               node_rows: int = NODE_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs."""
    rows = cut(signatures(docs, size, trees), "signatures")
    key = ["f1", "f2", "n_shingles"]
    vertices = cut(
        rows.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(
            F.min("doc_id").alias("rid"), F.first("sketch").alias("sketch"), F.first("path").alias("path")
        ), "vertices",
    )
    narrow = rows.select("doc_id", *key)
    of_doc = narrow.where("doc_id is not null").join(vertices.select(*key, "rid"), key)
    least = of_doc.groupBy("doc_id").agg(F.min("rid").alias("a"), F.max("rid").alias("_top"))
    repeated = of_doc.join(least.where("a < _top"), "doc_id").select("a", F.col("rid").alias("b"))

    leaves = cut(nodes(vertices, trees, node_rows), "leaves")
    nodes_of = leaves.groupBy("rid").agg(F.collect_set("node").alias("nodes"))
    filled = leaves.join(vertices.select("rid", "n_shingles", "sketch").join(nodes_of, "rid"), "rid")
    first = cut(candidates(filled.withColumn("component", F.lit(0).cast("long")), forest=True), "pairs")
    texts = texts_of(first, docs)  # a document of any candidate is in its node's forest
    checked = check(first, texts, size)
    links = checked.where("linked").select("a", "b").union(repeated)
    found = cut(connected(links), "components")
    placed = filled.join(found.withColumnRenamed("node", "rid"), "rid", "left").withColumn(
        "component", F.coalesce("component", "rid")
    )
    second = cut(
        candidates(placed, forest=False).join(checked.select("a", "b"), ["a", "b"], "left_anti"), "pairs"
    )
    if not second.isEmpty():
        again = check(second, texts, size).where("linked")
        if not again.isEmpty():
            found = cut(connected(links.union(again.select("a", "b"))), "components")
    drop(texts)
    drop(leaves)
    of_set = vertices.select(*key, "rid").join(
        found.select(F.col("node").alias("rid"), "component"), "rid", "left"
    ).select(*key, F.coalesce("component", "rid").alias("_component"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return narrow.join(of_set, key, "left").select(
        "doc_id", "n_shingles", own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )


@aside
def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, one of each component: that with the smallest id.

    Where ids repeat or are null, each row is a document of its own and the first one stays."""
    docs, row = told_apart(docs)
    found = components(docs.select(F.col(row).alias("doc_id"), "text"))
    return without(docs, found.where("not kept").select("doc_id"), row)

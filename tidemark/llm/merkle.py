"""Merkle manifest of a dataset: a tree for each language, a tree over their roots, all proofs.

Leaves get their places by a distributed order and are dealt to blocks of ``fanout`` to the power
of k, at most 4096 leaves; a task hashes whole blocks. The block roots then meet by a butterfly
exchange: round by round each block swaps its subtree's root with its partners, the blocks at its
own offset in the other subtrees of an aligned group of ``fanout`` subtrees, and hashes the next
ancestor itself, redundantly with all blocks below it. After the last round every block holds its
upper proof and the root, so there is no pass down the tree. Where a partner's subtree is ragged
and short, its blocks serve several offsets in turn. Each round is written before the next one.
The roots of the languages are the leaves of a second tree of the same kind.

Blocks bound each task, whatever share of the rows a language holds. What a round moves is one
narrow row for each block. The language proofs are broadcast up to ``BROADCAST_GROUPS``
languages (counted first); beyond, they are joined.

Defined cases: nulls in any column hash as ``-``; rows with equal ids in a language are ordered
by their leaf hashes; null ids come first and are never taken as tampered; repeated rows are
leaves of their own; no documents, no rows; other columns are left out of leaves and result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ordering import ascending, ordered
from tidemark.llm.work import cut, drop, workers_import

FANOUT = 2
BLOCK_LEAVES = 4096
BROADCAST_GROUPS = 10_000
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Sums of other siblings at one level, as text: before and after the own node.
STEP = "struct<before: string, after: string>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else length in bytes and value, so no two rows hash the same input."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(**changed: Column) -> Column:
    return digest(*[field(changed.get(c, F.col(c))) for c in LEAF_COLUMNS])


def tampered_leaf() -> Column:
    """The leaf with one character more counted, where 7 divides the id's CRC."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return F.when(hit, leaf(n_chars=F.col("n_chars") + 1)).otherwise(leaf())


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def local_tree(leaves: list[str], fanout: int, levels: int | None) -> tuple[str, list[list[str]]]:
    """(root, nodes of every level below it) after ``levels`` levels, or up to a single node."""
    below, nodes = [], leaves
    while len(nodes) > 1 if levels is None else len(below) < levels:
        below.append(nodes)
        nodes = [_sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], below


def path_of(below: list[list[str]], at: int, fanout: int) -> list[tuple[str, str]]:
    """(siblings before, siblings after) of node ``at`` and its ancestors, level by level."""
    steps = []
    for nodes in below:
        first = at - at % fanout
        steps.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + fanout])))
        at //= fanout
    return steps


def fold(node: str, steps: list[tuple[str, str]]) -> str:
    for before, after in steps:
        node = _sha(before + node + after)
    return node


def block_shape(fanout: int) -> tuple[int, int]:
    """(levels, leaves) of a block."""
    levels = 1
    while fanout ** (levels + 1) <= BLOCK_LEAVES:
        levels += 1
    return levels, fanout**levels


def _sorted_block(table: pa.Table) -> tuple[list[str], int | None]:
    """Leaves of one block in order, and the number of blocks of its tree."""
    table = table.sort_by("place")
    return table["leaf"].to_pylist(), table["blocks"][0].as_py()


def block_roots(leaves: DataFrame, fanout: int) -> DataFrame:
    """(tree, block, blocks, node): the subtree root of every block of ``leaves``
    (tree, place, block, blocks, leaf)."""
    levels, _ = block_shape(fanout)

    def work(table: pa.Table) -> pa.Table:
        nodes, blocks = _sorted_block(table)
        root, _ = local_tree(nodes, fanout, levels if blocks > 1 else None)
        return table.select(["tree", "block", "blocks"]).slice(0, 1).append_column(
            "node", pa.array([root], pa.string())
        )

    workers_import(leaves.sparkSession)
    return leaves.select("tree", "block", "place", "blocks", "leaf").groupBy("tree", "block").applyInArrow(
        work, "tree long, block long, blocks long, node string"
    )


def butterfly(roots: DataFrame, fanout: int) -> DataFrame:
    """(tree, block, node, path): the root of each tree and the upper proof of each block."""
    now = cut(roots.withColumn("path", F.array().cast(f"array<{STEP}>")), "blocks")
    rounds = 0
    most = now.agg(F.max("blocks")).first()[0] or 1
    while fanout**rounds < most:
        span = fanout**rounds  # blocks below a node of this round
        own = F.floor(F.col("block") / span).cast("long")
        first = (own - own % fanout).alias("first")
        subtrees = F.ceil(F.col("blocks") / span).cast("long")
        active = now.where(F.col("blocks") > span).select(
            "*", own.alias("own"), first, F.least(own - own % fanout + fanout, subtrees).alias("end")
        )
        partners = active.select(
            "tree", "block", "blocks", "own",
            F.explode(F.sequence("first", F.col("end") - 1)).alias("other"),
        ).where("other <> own")
        size = F.least(F.lit(span), F.col("blocks") - F.col("other") * span)
        asks = partners.select(
            "tree", "block", "own", "other",
            (F.col("other") * span + F.col("block") % span % size).alias("from"),
        )
        offers = now.select("tree", F.col("block").alias("from"), F.col("node").alias("theirs"))
        heard = asks.join(offers, ["tree", "from"]).groupBy("tree", "block").agg(
            F.sort_array(F.collect_list(F.struct("other", "theirs"))).alias("got"),
            F.first("own").alias("mine"),
        )  # at most fanout - 1 rows a block

        def text(keep) -> Column:
            return F.array_join(F.transform(F.filter("got", keep), lambda g: g["theirs"]), "")

        side = heard.select(
            "tree", "block",
            F.struct(
                text(lambda g: g["other"] < F.col("mine")).alias("before"),
                text(lambda g: g["other"] > F.col("mine")).alias("after"),
            ).alias("step"),
        )
        alone = F.struct(F.lit("").alias("before"), F.lit("").alias("after"))
        joined = now.join(side, ["tree", "block"], "left").withColumn(
            "step", F.when(F.col("blocks") > span, F.coalesce("step", alone))
        )
        climbed = digest(F.col("step.before"), F.col("node"), F.col("step.after"))
        after = cut(
            joined.select(
                "tree", "block", "blocks",
                F.when(F.col("step").isNull(), F.col("node")).otherwise(climbed).alias("node"),
                F.when(F.col("step").isNull(), F.col("path"))
                .otherwise(F.concat("path", F.array("step"))).alias("path"),
            ), "blocks",
        )
        drop(now)
        now, rounds = after, rounds + 1
    return now.drop("blocks")


def _blocked(placed: DataFrame, fanout: int) -> DataFrame:
    """Leaves with their block and the number of blocks of their tree."""
    _, size = block_shape(fanout)
    return placed.withColumns(
        {
            "block": F.floor(F.col("place") / size).cast("long"),
            "blocks": F.ceil(F.col("tree_leaves") / size).cast("long"),
        }
    )


def _with_upper(upper: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """Block paths continued by the path of their tree's root in the tree over the groups."""
    side = F.broadcast(groups) if n_groups <= BROADCAST_GROUPS else groups
    return upper.join(side, "tree").select(
        "tree", "block", F.col("node").alias("subroot"), "root",
        F.concat("path", "group_path").alias("path"),
    )


def _proved(leaves: DataFrame, upper: DataFrame, fanout: int, ids: str) -> DataFrame:
    """Every leaf with the roots above it, its proof's hash and the root folded from ``other``."""
    levels, _ = block_shape(fanout)

    def work(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        nodes, blocks = rows["leaf"].to_pylist(), rows["blocks"][0].as_py()
        _, below = local_tree(nodes, fanout, levels if blocks > 1 else None)
        high = [(s["before"], s["after"]) for s in above["path"][0].as_py()]
        high_text = "".join(a + b for a, b in high)
        proofs, folded = [], []
        for at, other in enumerate(rows["other"].to_pylist()):
            low = path_of(below, at, fanout)
            proofs.append(_sha("".join(a + b for a, b in low) + high_text))
            folded.append(fold(fold(other, low), high))
        n = rows.num_rows
        columns = [
            rows["doc_id"], rows["leaf"], pa.array([above["subroot"][0].as_py()] * n, pa.string()),
            pa.array([above["root"][0].as_py()] * n, pa.string()),
            pa.array(proofs, pa.string()), pa.array(folded, pa.string()),
        ]
        return pa.table(columns, names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    workers_import(leaves.sparkSession)
    given = leaves.select("tree", "block", "place", "blocks", "doc_id", "leaf", "other")
    return given.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block")).applyInArrow(
        work,
        f"doc_id {ids}, leaf string, subroot string, root string, proof_sha256 string, folded_root string",
    )


def manifest(docs: DataFrame, fanout: int = FANOUT, other: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``other`` is the leaf that is checked against the manifest (the document's own by default).
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    own = leaf()
    narrow = docs.select("lang", "doc_id", own.alias("leaf"), (own if other is None else other).alias("other"))
    in_order = ordered(narrow, ["lang"], [ascending("doc_id"), ascending("leaf"), ascending("other")])
    sizes = cut(in_order.parts.groupBy("lang").agg(F.max("_group_rows").alias("tree_leaves")), "trees")
    trees = cut(
        ordered(sizes, [], [ascending("lang")]).placed()
        .select("lang", "tree_leaves", F.col("_place").alias("tree")), "trees",
    )
    n_trees = trees.count()
    side = trees.withColumnRenamed("lang", "tree_lang")
    parts = in_order.parts.join(side, in_order.parts["lang"].eqNullSafe(side["tree_lang"])).drop("tree_lang")
    leaves = cut(
        _blocked(
            in_order.placed(cut(parts, "parts")).select(
                "tree", "tree_leaves", F.col("_place").alias("place"), "doc_id", "leaf", "other"
            ), fanout,
        ).drop("tree_leaves"), "leaves",
    )
    upper = butterfly(block_roots(leaves, fanout), fanout)
    # the roots of the trees, in order of their languages, are the leaves of the last tree
    subroots = cut(upper.where("block = 0").select(F.col("tree").alias("place"), F.col("node").alias("leaf")), "subroots")
    top = _blocked(
        subroots.withColumns({"tree": F.lit(0).cast("long"), "tree_leaves": F.lit(n_trees).cast("long")}), fanout
    )
    groups = cut(_paths(top, butterfly(block_roots(top, fanout), fanout), fanout), "groups")
    above = cut(_with_upper(upper, groups, n_trees), "upper")
    ids = docs.select("doc_id").schema[0].dataType.simpleString()
    return _proved(leaves, above, fanout, ids).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


def _paths(leaves: DataFrame, upper: DataFrame, fanout: int) -> DataFrame:
    """(tree, root, group_path) for each leaf of the tree over the groups, by its place."""
    levels, _ = block_shape(fanout)

    def work(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        blocks = rows["blocks"][0].as_py()
        root, below = local_tree(rows["leaf"].to_pylist(), fanout, levels if blocks > 1 else None)
        high = [(s["before"], s["after"]) for s in above["path"][0].as_py()]
        paths = [
            [{"before": a, "after": b} for a, b in path_of(below, at, fanout) + high]
            for at in range(rows.num_rows)
        ]
        steps = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        roots = pa.array([above["node"][0].as_py()] * rows.num_rows, pa.string())
        return pa.table([rows["place"], roots, pa.array(paths, steps)], names=["tree", "root", "group_path"])

    workers_import(leaves.sparkSession)
    given = leaves.select("tree", "block", "place", "blocks", "leaf")
    return given.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block")).applyInArrow(
        work, f"tree long, root string, group_path array<{STEP}>"
    )


def verify(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """:func:`manifest` checked against copies of which some count a character too many."""
    return manifest(docs, fanout, tampered_leaf())

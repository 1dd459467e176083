"""Dataset manifest: a Merkle tree over rows, one subtree per language, with a version per tampered row.

Trees are cut into aligned blocks of ``arity ** height`` nodes. A block's tree is persistent: a version copies the ancestors
of its leaf and shares every other node. What a block comes to is one node of the next stage, whose blocks are built alike,
until a tree has one node left; a version goes on above its block along the siblings that these stages hand down.
"""

from __future__ import annotations

from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.llm.shared import checkpointed, running_total

#: What a leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "tree STRING, place LONG, digest STRING"
PATHS = "tree STRING, place LONG, siblings ARRAY<STRING>, lefts ARRAY<INT>, subroot STRING, root STRING"


def digest_of(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(values[name]) for name in FIELDS]).cast("binary"), 256)


# --- one block ----------------------------------------------------------------------------------------


class Node(NamedTuple):
    digest: str
    children: tuple[Node, ...] = ()


def block_levels(digests: list[str], first: bool, arity: int, height: int) -> list[list[Node]]:
    """The nodes of an aligned block, its leaves first and its root last.

    Blocks have ``height`` levels above the leaves, even where a level has one node; only a first block that is not full,
    which is the whole tree, ends as soon as one node remains.
    """
    whole = first and len(digests) < arity**height
    levels = [[Node(d) for d in digests]]
    while len(levels[-1]) > 1 or not whole and len(levels) <= height:
        below = levels[-1]
        runs = [tuple(below[k : k + arity]) for k in range(0, len(below), arity)]
        levels.append([Node(digest_of(*[n.digest for n in run]), run) for run in runs])
    return levels


def copied_path(root: Node, place: int, height: int, arity: int, digest: str) -> list[Node]:
    """A version with another leaf at ``place``: the new leaf and its copied ancestors, the version's root last.

    All nodes beside the path are the old version's own.
    """
    if height == 0:
        return [Node(digest)]
    which = place // arity ** (height - 1)
    path = copied_path(root.children[which], place % arity ** (height - 1), height - 1, arity, digest)
    children = (*root.children[:which], path[-1], *root.children[which + 1 :])
    return [*path, Node(digest_of(*[n.digest for n in children]), children)]


def proof(levels: list[list[Node]], place: int, arity: int) -> tuple[list[str], list[int]]:
    """Per level the digests beside the node in its run, in one text, and how many of them are on its left."""
    siblings, lefts = [], []
    for level in levels[:-1]:
        left = place % arity
        run = level[place - left : place - left + arity]
        siblings.append("".join(n.digest for k, n in enumerate(run) if k != left))
        lefts.append(left)
        place //= arity
    return siblings, lefts


def folded(digest: str, siblings: list[str], lefts: list[int]) -> list[str]:
    """Digests from a node up to the root, given what stands beside them."""
    out = []
    for beside, left in zip(siblings, lefts, strict=True):
        digest = digest_of(beside[: 64 * left], digest, beside[64 * left :])
        out.append(digest)
    return out


# --- all blocks ---------------------------------------------------------------------------------------


def _ordered(nodes: pa.Table) -> pa.Table:
    return nodes.sort_by("place")


def _block_root(key: tuple, nodes: pa.Table, arity: int, height: int) -> pa.Table:
    block = key[1].as_py()
    digests = _ordered(nodes)["digest"].to_pylist()
    root = block_levels(digests, block == 0, arity, height)[-1][0]
    return pa.table({"tree": pa.array([key[0].as_py()], pa.string()), "place": pa.array([block], pa.int64()), "digest": [root.digest]})


def _handed_down(key: tuple, nodes: pa.Table, above: pa.Table, arity: int, height: int) -> pa.Table:
    """For every node of a block its way to the root: within the block, then the block's own."""
    nodes, over = _ordered(nodes), above.to_pylist()[0]
    levels = block_levels(nodes["digest"].to_pylist(), key[1].as_py() == 0, arity, height)
    ways = [proof(levels, k, arity) for k in range(nodes.num_rows)]
    same = {name: pa.array([over[name]] * nodes.num_rows, pa.string()) for name in ("subroot", "root")}
    siblings = pa.array([s + over["siblings"] for s, _ in ways], pa.list_(pa.string()))
    return pa.table({"tree": nodes["tree"], "place": nodes["place"], "siblings": siblings, "lefts": pa.array([b + over["lefts"] for _, b in ways], pa.list_(pa.int32())), **same})


def _answered(key: tuple, leaves: pa.Table, above: pa.Table, arity: int, height: int) -> pa.Table:
    """For every leaf of a block its proof, and the way of its version: copied in the block, continued above it."""
    leaves, over = _ordered(leaves), above.to_pylist()[0]
    digests = leaves["digest"].to_pylist()
    levels = block_levels(digests, key[1].as_py() == 0, arity, height)
    root, own_height = levels[-1][0], len(levels) - 1
    out: dict[str, list] = {"siblings": [], "copied": [], "folded_root": []}
    for k, (digest, other) in enumerate(zip(digests, leaves["tampered"].to_pylist(), strict=True)):
        inside, lefts = proof(levels, k, arity)
        if other is None:
            path = [digest, *folded(digest, inside, lefts)]
        else:
            path = [n.digest for n in copied_path(root, k, own_height, arity, other)]
        path += folded(path[-1], over["siblings"], over["lefts"])
        out["siblings"].append(inside + over["siblings"])
        out["copied"].append(None if other is None else path)
        out["folded_root"].append(path[-1])
    texts = pa.list_(pa.string())
    same = {name: pa.array([over[name]] * len(digests), pa.string()) for name in ("subroot", "root")}
    return pa.table({
        "doc_id": leaves["doc_id"], "lang": leaves["lang"], "place": leaves["place"], "leaf": leaves["digest"], **same,
        "siblings": pa.array(out["siblings"], texts), "copied": pa.array(out["copied"], texts), "folded_root": pa.array(out["folded_root"], pa.string()),
    })


def _blocked(nodes: DataFrame, size: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / size).cast("long"))


def stages(nodes: DataFrame, arity: int, height: int) -> list[DataFrame]:
    """``nodes`` (tree, place, digest), the roots of their blocks, the roots of those' blocks, up to one node per tree."""
    found = [nodes]
    while True:
        up = _blocked(found[-1].select("tree", "place", "digest"), arity**height).groupBy("tree", "block")
        found.append(checkpointed(up.applyInArrow(lambda key, nodes: _block_root(key, nodes, arity, height), NODES)))
        if found[-1].filter("place > 0").isEmpty():
            return found


def _joined(nodes: DataFrame, above: DataFrame, answer, schema: str, arity: int, height: int) -> DataFrame:
    """Each block of ``nodes`` with the one row of ``above`` that is the block's own node."""
    left = _blocked(nodes, arity**height).groupBy("tree", "block")
    right = above.withColumnRenamed("place", "block").groupBy("tree", "block")
    return left.cogroup(right).applyInArrow(lambda key, nodes, over: answer(key, nodes, over, arity, height), schema)


def ways(levels: list[DataFrame], tops: DataFrame, arity: int, height: int) -> DataFrame:
    """The ways to the root of the nodes of ``levels[0]``, given those of the last level."""
    for nodes in reversed(levels[:-1]):
        tops = checkpointed(_joined(nodes, tops, _handed_down, PATHS, arity, height))
    return tops


def manifest(docs: DataFrame, tampered: Column | None = None, change: dict[str, Column] | None = None, arity: int = 2, height: int = 10) -> DataFrame:
    """Every row of ``docs`` as a leaf, with its proof and, where ``tampered`` holds, the version its ``change`` makes.

    Columns: doc_id, lang, place (in the language's tree), leaf, subroot, root, siblings (per level, the digests beside the
    node in its run, left to right), copied (digests of the version's own nodes, from the new leaf to its root; null where
    nothing is tampered with), folded_root (that of the version, or of the untampered leaf with its siblings).

    A leaf is the digest of ``FIELDS``; per language (null is one) leaves ascend by doc_id, nulls first, rows of equal doc_id
    by digest, so that rows that repeat have places of their own. ``arity`` consecutive nodes become one while more than one
    remains, and the languages' roots, ordered by name, null first, become the root in the same way. ``change`` maps names
    of ``FIELDS`` to their new values; a null condition is false. Other columns are not read. An empty table gives no rows.

    Text is read once and never moved. A task holds a block of ``arity ** height`` nodes, however many rows a language has.
    """
    values = {name: F.col(name) for name in FIELDS}
    rows = docs.select(
        "doc_id", "lang", leaf_digest(values).alias("digest"),
        (F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf_digest(values | (change or {})))).alias("tampered"),
        # Sorts like the language by bytes, with null first.
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
    )
    leaves = checkpointed(running_total(checkpointed(rows), ["tree"], ["doc_id", "digest"], F.lit(1), "place"))
    trees = stages(leaves, arity, height)

    subroots = checkpointed(running_total(trees[-1].select(F.col("tree").alias("of"), "digest"), [], ["of"], F.lit(1), "place"))
    upper = stages(subroots.select(F.lit("").alias("tree"), "place", "digest"), arity, height)
    nothing = [F.array().cast(kind).alias(name) for name, kind in (("siblings", "array<string>"), ("lefts", "array<int>"))]
    top = upper[-1].select("tree", "place", *nothing, F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    over = ways(upper, top, arity, height).drop("tree", "subroot").join(subroots, "place")
    over = over.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("place"), "siblings", "lefts", F.col("digest").alias("subroot"), "root")

    over = ways(trees[1:], checkpointed(over), arity, height)
    kinds = {f.name: f.dataType.simpleString() for f in docs.select("doc_id", "lang").schema}
    schema = (
        f"doc_id {kinds['doc_id']}, lang {kinds['lang']}, place LONG, leaf STRING, subroot STRING, root STRING, "
        "siblings ARRAY<STRING>, copied ARRAY<STRING>, folded_root STRING"
    )
    return _joined(leaves, over, _answered, schema, arity, height)

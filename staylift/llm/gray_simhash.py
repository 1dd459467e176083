"""SimHash near duplicates through a hierarchical index over fingerprints in Gray order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.llm.shared import checkpointed, other_columns, running_total
from staylift.operators.membership import bloom

SEED = 42


def shingle_hashes(text: str | None, length: int) -> np.ndarray:
    """XXH64 of every ``length``-word shingle, repeats included; of the whole sequence if shorter; none without words."""
    words = (text or "").encode().lower().split()  # bytes: lower-cases A-Z alone and parts at the six spaces alone
    if len(words) <= length:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    joined, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    firsts, lasts = (ends - sizes)[: 1 - length or None].tolist(), ends[length - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(firsts, lasts, strict=True)), np.uint64, len(firsts))


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half of the hashes; the result as a signed long."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, text_hash (tells apart texts of one doc_id), fp of every document."""

    def marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(text.as_py(), length)) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_hash"], pa.array(found, pa.int64())], ["doc_id", "text_hash", "fp"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(marked, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash LONG, fp LONG")


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in the Gray sequence, as a signed long that sorts like the unsigned rank."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


# --- inside one pair of leaves ------------------------------------------------------------------------

FANOUT = 8
FRONTIER = 1 << 12


def _tree(fps: np.ndarray, height: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of (pattern, mask of the bits all members share), from the fingerprints up, ``height`` levels above them."""
    ands, ors = fps, fps
    levels = [(fps, np.full(len(fps), ~np.uint64(0)))]
    for _ in range(height):
        starts = np.arange(0, len(ands), FANOUT)
        ands, ors = np.bitwise_and.reduceat(ands, starts), np.bitwise_or.reduceat(ors, starts)
        levels.append((ands, ~(ands ^ ors)))
    return levels


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) with at most ``radius`` differing bits, in batches; for ``same`` arrays only i < j.

    Two trees over fingerprints in Gray order go down together. A pair of nodes adds the differences on the bits that
    both nodes have factored out and that no pair above them has counted; over ``radius``, the two groups are dropped
    whole.
    """
    height, most = 0, max(len(a), len(b))
    while most > 1:
        height, most = height + 1, -(-most // FANOUT)
    left, right = _tree(a, height), _tree(b, height)
    zero = np.zeros(1, np.int64)
    pending = [(height, zero, zero, np.zeros(1, np.uint8), np.zeros(1, np.uint64))]
    step = np.arange(FANOUT)
    while pending:
        level, i, j, apart, counted = pending.pop()
        if len(i) > FRONTIER:
            pending += [(level, i[k : k + FRONTIER], j[k : k + FRONTIER], apart[k : k + FRONTIER], counted[k : k + FRONTIER]) for k in range(0, len(i), FRONTIER)]
            continue
        (pa_, ma), (pb, mb) = left[level], right[level]
        shared = ma[i] & mb[j]
        apart = apart + np.bitwise_count((pa_[i] ^ pb[j]) & shared & ~counted)
        keep = apart <= radius
        if same:
            keep &= i < j if level == 0 else i <= j
        i, j, apart, counted = i[keep], j[keep], apart[keep], shared[keep]
        if level == 0:
            if len(i):
                yield i, j
            continue
        if not len(i):
            continue
        below_a, below_b = len(left[level - 1][0]), len(right[level - 1][0])
        ci = np.repeat(i * FANOUT, FANOUT * FANOUT) + np.tile(np.repeat(step, FANOUT), len(i))
        cj = np.repeat(j * FANOUT, FANOUT * FANOUT) + np.tile(step, FANOUT * len(j))
        real = (ci < below_a) & (cj < below_b)
        if same:
            real &= ci <= cj
        from_pair = np.repeat(np.arange(len(i)), FANOUT * FANOUT)[real]
        pending.append((level - 1, ci[real], cj[real], apart[from_pair], counted[from_pair]))


def _joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the classes of each i and j; labels point at the smallest place of a class."""
    while True:
        x, y = labels[i], labels[j]
        apart = x != y
        if not apart.any():
            return
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def _leaf_links(batches: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """For each pair of leaves a forest of links: every linked fingerprint with the first one of its class."""
    for batch in batches:
        for row in range(batch.num_rows):
            same = batch["a"][row].as_py() == batch["b"][row].as_py()
            a = batch["fps_a"][row].values.to_numpy().view(np.uint64)
            b = a if same else batch["fps_b"][row].values.to_numpy().view(np.uint64)
            whole = a if same else np.concatenate([a, b])
            labels = np.arange(len(whole))
            for i, j in close_pairs(a, b, radius, same):
                _joined(labels, i, j if same else j + len(a))
            linked = np.flatnonzero(labels != np.arange(len(whole)))
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whole[linked].view(np.int64)), pa.array(whole[labels[linked]].view(np.int64))], ["u", "v"]
                )


# --- the index over all fingerprints ------------------------------------------------------------------


def _surviving(nodes: DataFrame, height: int, fanout: int, radius: int) -> DataFrame:
    """Pairs of leaves (a <= b) whose shared bits differ in at most ``radius`` places, found from the root down."""
    levels = [nodes]
    for _ in range(height):
        up = levels[-1].groupBy(F.floor(F.col("node") / fanout).cast("long").alias("node"))
        levels.append(checkpointed(up.agg(F.bit_and("ands").alias("ands"), F.bit_or("ors").alias("ors"))))
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        child = level.select("node", "ands", F.bitwise_not(F.col("ands").bitwiseXOR(F.col("ors"))).alias("mask"))
        parent = F.floor(F.col("node") / fanout).cast("long")
        left = child.select(parent.alias("a"), F.col("node").alias("ca"), F.col("ands").alias("pa"), F.col("mask").alias("ma"))
        right = child.select(parent.alias("b"), F.col("node").alias("cb"), F.col("ands").alias("pb"), F.col("mask").alias("mb"))
        apart = F.bit_count(F.col("pa").bitwiseXOR(F.col("pb")).bitwiseAND(F.col("ma")).bitwiseAND(F.col("mb")))
        down = pairs.join(left, "a").join(right, "b").filter((F.col("ca") <= F.col("cb")) & (apart <= radius))
        pairs = checkpointed(down.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    return pairs


def linked(fps: DataFrame, radius: int, leaf: int = 4096, fanout: int = 8) -> DataFrame:
    """Links (u, v) between distinct fingerprints that connect all within ``radius`` bits, without listing all pairs.

    Fingerprints are numbered in Gray order and cut into leaves of ``leaf``; upper nodes keep the bits their members
    share. Node pairs are compared from the root down as equi-joins on the parent, then each surviving pair of leaves is
    searched in one task of bounded memory (two leaves).
    """
    numbered = running_total(fps.select("fp", gray_rank(F.col("fp")).alias("rank")), [], ["rank"], F.lit(1), "place")
    numbered = numbered.withColumn("node", F.floor(F.col("place") / leaf).cast("long"))
    leaves = checkpointed(
        numbered.groupBy("node").agg(
            F.bit_and("fp").alias("ands"), F.bit_or("fp").alias("ors"), F.sort_array(F.collect_list(F.struct("place", "fp"))).alias("sorted")
        ).select("node", "ands", "ors", F.col("sorted.fp").alias("fps"))
    )
    count, height = leaves.count(), 0
    while count > 1:
        count, height = -(-count // fanout), height + 1
    pairs = _surviving(leaves.select("node", "ands", "ors"), height, fanout, radius)
    sides = pairs.join(leaves.select(F.col("node").alias("a"), F.col("fps").alias("fps_a")), "a")
    sides = sides.join(leaves.select(F.col("node").alias("b"), F.col("fps").alias("fps_b")), "b")
    return sides.repartition("a", "b").mapInArrow(lambda batches: _leaf_links(batches, radius), "u LONG, v LONG")


def components(links: DataFrame) -> DataFrame:
    """node, root for every linked node but the roots; the root is the smallest node of the component.

    Alternating large and small stars: each round hooks neighbours to the smallest one in sight, as aggregations (which
    combine map-side, so that the centre of a large star is no hot task) and equi-joins, until nothing changes.
    """
    edges = checkpointed(links.filter("u != v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = checkpointed(small.unionByName(low.select("u", F.col("low").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_copies(docs: DataFrame, length: int, radius: int) -> DataFrame:
    """Every document with its near-duplicate component: doc_id, text_hash, fp, component_id, first.

    A document's words are lower-cased (A-Z); fingerprints link at ``radius`` or fewer differing bits, and components
    are what is reachable over links. component_id is the smallest doc_id of the component (null if all are null).
    ``first`` marks the component's one document to keep: the smallest (doc_id, text_hash), null doc_ids last; rows that
    repeat both share the mark. Documents without words have fingerprint zero and link like any other. Columns besides
    doc_id and text are not read. An empty table gives no rows.
    """
    marked = checkpointed(fingerprints(docs.select("doc_id", "text"), length))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    fps = checkpointed(marked.groupBy("fp").agg(F.min(order).alias("lead")))
    roots = components(linked(fps, radius))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "lead", F.coalesce("root", "fp").alias("root"))
    leads = rooted.groupBy("root").agg(F.min("lead").alias("lead"))
    classes = rooted.drop("lead").join(leads, "root").select("fp", "lead")
    first = F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("text_hash") == F.col("lead.text_hash"))
    return marked.join(classes, "fp").select("doc_id", "text_hash", "fp", F.col("lead.doc_id").alias("component_id"), first.alias("first"))


def drop_near_copies(docs: DataFrame, length: int, radius: int) -> DataFrame:
    """One document of each component, with all columns of ``docs`` whatever their names; see ``near_copies``.

    Of rows that repeat doc_id and text the one whose other columns, as JSON, come last stays. Only rows that may go, told by
    a filter of their doc_ids and texts, are shuffled; the others go straight through.
    """
    marks = near_copies(docs, length, radius).groupBy("doc_id", "text_hash").agg(F.max("first").alias("first"), F.count("*").alias("n"))
    marks = checkpointed(marks.withColumn("key", F.xxhash64("doc_id", "text_hash")))
    likely = bloom(marks.filter("NOT first OR n > 1"), "key")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct("*").alias("whole")).withColumn("key", F.xxhash64("doc_id", "text_hash"))
    clear = rows.filter(~likely.may_hold(F.col("key"))).select("whole.*")
    first = marks.filter("first").filter(likely.may_hold(F.col("key"))).select("key", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    some = rows.filter(likely.may_hold(F.col("key"))).alias("r")
    same = (F.col("r.key") == F.col("f.key")) & F.col("r.doc_id").eqNullSafe(F.col("f.id")) & (F.col("r.text_hash") == F.col("f.hash"))
    led = some.join(first.alias("f"), same, "left_semi")
    once = led.groupBy("key", "doc_id", "text_hash").agg(F.max_by("whole", other_columns(docs, "whole")).alias("whole"))
    return clear.unionByName(once.select("whole.*"))

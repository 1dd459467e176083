"""Embedding near duplicates: products of int8 tiles with rigorous error bounds, exact where these leave a pair open.

Vectors are laid out by their nearest pivot and cut into tiles; tiles form a tree of balls (centre, largest angle). Pairs of
nodes go down from the root: pairs too far apart are dropped whole, pairs so close that all their vectors link are counted
whole, and only pairs of tiles in between are multiplied.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylift.llm.gray_simhash import components
from staylift.llm.shared import checkpointed, running_total
from staylift.llm.vectors import finite_rows

#: Rows of a tile that are multiplied at once.
STRIP = 512
#: Pivots of each of the most frequent vector lengths; other lengths are laid out without. They only guide the layout.
PIVOTS, PIVOTED_LENGTHS = 64, 16
#: Places of one vector length, and pairs of tiles a task is given.
PLACES, PAIRS_PER_TASK = 1 << 40, 4
#: Angles are trusted to this much, cosines to the other.
ANGLE_SLACK, COSINE_SLACK = 1e-6, 1e-9
#: Products of so many int8 components are whole numbers that a 32-bit float holds.
EXACT_DIMS = (1 << 24) // 127**2


# --- one pair of tiles --------------------------------------------------------------------------------


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, so that no square overflows or vanishes; cosines are the same."""
    top = np.abs(x).max(axis=1, initial=0)
    return np.ldexp(x, -np.frexp(top)[1][:, None])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


class Quantised(NamedTuple):
    """Unit vectors as ``step`` times whole numbers of -127 to 127 (kept as floats, to multiply fast), off by at most ``error``."""

    values: np.ndarray
    step: np.ndarray
    error: np.ndarray

    @staticmethod
    def of(unit: np.ndarray) -> Quantised:
        step = np.abs(unit).max(axis=1) / 127
        whole = np.rint(unit / step[:, None])
        off = unit - whole * step[:, None]
        return Quantised(whole.astype(np.float32), step, np.sqrt(np.einsum("ij,ij->i", off, off)) + COSINE_SLACK)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of whole-number vectors."""
    if a.shape[1] <= EXACT_DIMS:
        return a @ b.T
    parts = range(0, a.shape[1], EXACT_DIMS)
    return sum((a[:, k : k + EXACT_DIMS] @ b[:, k : k + EXACT_DIMS].T).astype(float) for k in parts)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of the rows of x with those of y, in double precision."""
    dot = partial(np.einsum, "ij,ij->i")
    return dot(x, y) / (np.sqrt(dot(x, x)) * np.sqrt(dot(y, y)))


def close_pairs(x: np.ndarray, y: np.ndarray, threshold: float, tally: dict[str, int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of x and y whose cosine is at least ``threshold``, in batches.

    With errors e and f, the cosine is within e + f + e * f of the quantised product. Pairs that cannot reach the
    threshold are dropped, those that cannot miss it are links, and the others are computed in full precision.
    """
    x, y = scaled(x), scaled(y)
    a, b = Quantised.of(units(x)), Quantised.of(units(y))
    worst, widest = b.error.max(), b.step.max()
    for at in range(0, len(x), STRIP):
        rows = slice(at, at + STRIP)
        near = products(a.values[rows], b.values)
        # What no pair of the row can be below, whatever the column's step and error.
        least = threshold - (a.error[rows] + worst + a.error[rows] * worst)
        least = np.where(least > 0, np.floor(least / (a.step[rows] * widest)) - 1, -np.inf).astype(near.dtype)
        flat = np.flatnonzero(near >= least[:, None])
        for k in range(0, len(flat), 1 << 16):
            i, j = np.divmod(flat[k : k + (1 << 16)], len(y))
            about = near[i, j] * (a.step[i + at] * b.step[j])
            i = i + at
            bound = a.error[i] + b.error[j] + a.error[i] * b.error[j]
            linked = about - bound >= threshold
            open_ = np.flatnonzero(~linked & (about + bound >= threshold))
            for m in range(0, len(open_), 1 << 14):
                some = open_[m : m + (1 << 14)]
                linked[some] = cosines(x[i[some]], y[j[some]]) >= threshold
            if tally is not None:
                tally["recomputed"] = tally.get("recomputed", 0) + len(open_)
            if linked.any():
                yield i[linked], j[linked]


def _merged(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the classes of each i and j; a label is the smallest place of its class."""
    while True:
        low, high = np.minimum(labels[i], labels[j]), np.maximum(labels[i], labels[j])
        apart = low != high
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(labels, high[apart], low[apart])
        while not np.array_equal(up := labels[labels], labels):
            labels[:] = up


def _vectors(cell: pa.Scalar, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(cell.as_py(), kind).reshape(-1, dim).astype(float)


def _tile_links(batches: Iterable[pa.RecordBatch], threshold: float, kind: str, tile: int) -> Iterator[pa.RecordBatch]:
    """Per pair of tiles, for each vector with links: the weight linked to it, and the first vector of its class.

    A tile meets itself with every vector's own weight, which the caller takes off again.
    """
    for batch in batches:
        for row in range(batch.num_rows):
            dim, a, b = (batch[name][row].as_py() for name in ("dim", "a", "b"))
            x = _vectors(batch["vs_a"][row], dim, kind)
            y = x if a == b else _vectors(batch["vs_b"][row], dim, kind)
            wx, wy = (np.frombuffer(batch[name][row].as_py(), "<i8") for name in ("weights_a", "weights_b"))
            shift = 0 if a == b else len(x)
            sums, labels = np.zeros(shift + len(y), np.int64), np.arange(shift + len(y))
            for i, j in close_pairs(x, y, threshold):
                np.add.at(sums, i, wy[j])
                if shift:
                    np.add.at(sums, j + shift, wx[i])
                _merged(labels, i, j + shift)
            uid = np.arange(len(y)) + dim * PLACES + b * tile
            uid = np.concatenate([np.arange(len(x)) + dim * PLACES + a * tile, uid]) if shift else uid
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(uid[some]), pa.array(sums[some]), pa.array(uid[labels[some]])], ["uid", "n", "to"])


# --- layout -------------------------------------------------------------------------------------------


def _packed(batches: Iterable[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes; null where a vector can link with nothing."""
    for batch in batches:
        column = batch["embedding"]
        out: list[bytes | None] = [None] * batch.num_rows
        lengths = pc.fill_null(pc.list_value_length(column), 0)
        for length in pc.unique(lengths).to_pylist():
            if length:
                places, x = finite_rows(column, length)
                for place, v in zip(places.tolist(), x, strict=True):
                    if v.any():
                        out[place] = v.astype(kind).tobytes()
        yield pa.RecordBatch.from_arrays([batch["vec_id"], lengths.cast(pa.int32()), pa.array(out, pa.binary())], ["vec_id", "dim", "v"])


def _pivots(distinct: DataFrame, kind: str) -> dict[int, np.ndarray]:
    """Unit vectors of smallest hash per length: at most PIVOTS for each of PIVOTED_LENGTHS lengths."""
    lengths = distinct.groupBy("dim").count().orderBy(F.col("count").desc(), "dim").limit(PIVOTED_LENGTHS)
    dims = [r.dim for r in lengths.collect()]
    turn = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("v"), "v"))
    drawn = distinct.filter(F.col("dim").isin(dims)).select("dim", "v", turn.alias("turn")).filter(F.col("turn") <= PIVOTS).collect()
    found = {d: units(np.stack([np.frombuffer(r.v, kind).astype(float) for r in drawn if r.dim == d])) for d in dims}
    return {d: x[_tour(x)] for d, x in found.items()}


def _tour(x: np.ndarray) -> list[int]:
    """Unit vectors in such an order that each is followed by the nearest one left, so that neighbours share nodes."""
    near, order, left = x @ x.T, [0], list(range(1, len(x)))
    while left:
        order.append(max(left, key=lambda k: near[order[-1], k]))
        left.remove(order[-1])
    return order


def _laid_out(batches: Iterable[pa.RecordBatch], pivots: dict[int, np.ndarray], kind: str) -> Iterator[pa.RecordBatch]:
    """Add the nearest pivot and the cosine with it."""
    for batch in batches:
        dims = batch["dim"].to_numpy()
        cell, cosine = np.zeros(len(dims), np.int32), np.zeros(len(dims))
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            if dim in pivots:
                x = np.frombuffer(b"".join(batch["v"].take(pa.array(rows)).to_pylist()), kind).reshape(-1, dim).astype(float)
                near = units(x) @ pivots[dim].T
                cell[rows], cosine[rows] = near.argmax(axis=1), near.max(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(cosine)], [*batch.schema.names, "cell", "cosine"])


def _ball(x: np.ndarray, weights: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, float]:
    """A centre of unit vectors, and the largest angle from it to any of them plus their own reach."""
    centre = (x * weights[:, None]).sum(axis=0)
    size = np.linalg.norm(centre)
    centre = x[0] if size < 1e-6 * weights.sum() else centre / size
    return centre, float((np.arccos(np.clip(x @ centre, -1, 1)) + reach).max() + ANGLE_SLACK)


def _tile(key: tuple, rows: pa.Table, kind: str) -> pa.Table:
    rows = rows.sort_by("place")
    dim, node = (k.as_py() for k in key)
    whole, weights = b"".join(rows["v"].to_pylist()), rows["n"].to_numpy()
    unit = units(np.frombuffer(whole, kind).reshape(-1, dim).astype(float))
    centre, radius = _ball(unit, np.ones(len(unit)), np.zeros(len(unit)))
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "node": [node], "size": [len(unit)], "weight": [int(weights.sum())],
        "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "radius": [radius], "vs": pa.array([whole], pa.binary()),
        "weights": pa.array([weights.astype("<i8").tobytes()], pa.binary()),
    })


BALL = "dim INT, node LONG, size LONG, weight LONG, centre ARRAY<DOUBLE>, radius DOUBLE"


def _parent(key: tuple, children: pa.Table) -> pa.Table:
    dim, node = (k.as_py() for k in key)
    size = children["size"].to_numpy()
    centre, radius = _ball(np.array(children["centre"].to_pylist()), size.astype(float), children["radius"].to_numpy())
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "node": [node], "size": [int(size.sum())], "weight": [pc.sum(children["weight"]).as_py()],
        "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "radius": [min(radius, 2 * math.pi)],
    })


def _up(node: Column, fanout: int) -> Column:
    return F.floor(node / fanout).cast("long")


def _descended(balls: DataFrame, height: int, fanout: int, threshold: float) -> tuple[DataFrame, list[tuple[int, DataFrame]]]:
    """Pairs of tiles (dim, a, b; a <= b) to be multiplied, and per level the pairs of nodes all of whose vectors link."""
    levels = [balls]
    for _ in range(height):
        levels.append(checkpointed(levels[-1].withColumn("up", _up(F.col("node"), fanout)).groupBy("dim", "up").applyInArrow(_parent, BALL)))
    pairs = levels[-1].select("dim", F.col("node").alias("a"), F.col("node").alias("b"))
    whole: list[tuple[int, DataFrame]] = []
    limit = math.acos(threshold)
    for level in reversed(range(height)):
        child = levels[level].select("dim", "node", "centre", "radius", "weight", _up(F.col("node"), fanout).alias("up"))
        left = child.select("dim", F.col("up").alias("a"), F.col("node").alias("ca"), F.col("centre").alias("pa"), F.col("radius").alias("ra"), F.col("weight").alias("wa"))
        right = child.select("dim", F.col("up").alias("b"), F.col("node").alias("cb"), F.col("centre").alias("pb"), F.col("radius").alias("rb"), F.col("weight").alias("wb"))
        dot = F.aggregate(F.zip_with("pa", "pb", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
        angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
        met = pairs.join(left, ["dim", "a"]).join(right, ["dim", "b"]).filter("ca <= cb")
        met = met.select("dim", F.col("ca").alias("a"), F.col("cb").alias("b"), "wa", "wb", angle.alias("angle"), (F.col("ra") + F.col("rb")).alias("reach"))
        met = checkpointed(met.filter(F.col("angle") - F.col("reach") <= limit + ANGLE_SLACK).withColumn("whole", F.col("angle") + F.col("reach") <= limit - ANGLE_SLACK))
        whole.append((level, met.filter("whole").select("dim", "a", "b", "wa", "wb")))
        pairs = met.filter("NOT whole").select("dim", "a", "b")
    return pairs, whole


def _uid(node: Column, tile: int) -> Column:
    """The first vector of a tile."""
    return F.col("dim").cast("long") * PLACES + node * tile


def _counted_whole(balls: DataFrame, whole: list[tuple[int, DataFrame]], tile: int, fanout: int) -> DataFrame:
    """What pairs of nodes that link whole add, as rows like those of multiplied tiles: uid, n, to.

    A node of such a pair is one class: its first vector stands for it, the first of a tile for the tile.
    """
    tiles, found = balls.select("dim", "node", "size"), None
    for level, pairs in whole:
        sides = pairs.select("dim", F.col("a").alias("up"), F.col("wb").alias("n"))
        sides = sides.unionByName(pairs.filter("a != b").select("dim", F.col("b").alias("up"), F.col("wa").alias("n")))
        own = sides.groupBy("dim", "up").agg(F.sum("n").alias("n"))
        under = tiles.withColumn("up", _up(F.col("node"), fanout**level)).join(own, ["dim", "up"])
        first = F.col("up") * fanout**level
        member = under.select("dim", "node", "n", first.alias("lead"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1)).alias("k"))
        rows = member.select((_uid(F.col("node"), tile) + F.col("k")).alias("uid"), "n", _uid(F.when(F.col("k") > 0, F.col("node")).otherwise(F.col("lead")), tile).alias("to"))
        links = pairs.filter("a != b").select(_uid(F.col("b") * fanout**level, tile).alias("uid"), F.lit(0).cast("long").alias("n"), _uid(F.col("a") * fanout**level, tile).alias("to"))
        rows = rows.unionByName(links)
        found = rows if found is None else found.unionByName(rows)
    return found


def linked(vectors: DataFrame, threshold: float = 0.95, tile: int = 4096, fanout: int = 8) -> DataFrame:
    """Every row of ``vectors`` (vec_id, embedding) with its links: vec_id, n_links, component_id, kept.

    Two vectors link when they have equally many components and their cosine, in double precision, is at least
    ``threshold`` (above 0). A vector that is null, empty or zero, or holds a null, an infinity or no number, links with
    nothing. n_links counts other rows, rows that repeat included; component_id is the smallest vec_id reachable, itself
    included; null ids are larger than any, and null where all are. ``kept`` marks rows whose vec_id is component_id.
    Other columns are not read. An empty table gives no rows.

    Equal vectors are counted once with a weight, so that a vector that a third of all rows have is one. A task multiplies
    pairs of tiles of ``tile`` vectors and gives at most a row per vector of a pair, never the links. Where nothing can be told
    from the balls, as for vectors that lie evenly all around, all pairs of tiles are multiplied.
    """
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    given = vectors.select("vec_id", F.col("embedding") if kind == "<f4" else F.col("embedding").cast("array<double>"))
    id_type = given.schema["vec_id"].dataType.simpleString()
    rows = checkpointed(given.mapInArrow(partial(_packed, kind=kind), f"vec_id {id_type}, dim INT, v BINARY"))
    distinct = checkpointed(rows.filter("v IS NOT NULL").groupBy("dim", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("least_id")))
    placing = partial(_laid_out, pivots=_pivots(distinct, kind), kind=kind)
    placed = checkpointed(distinct.mapInArrow(placing, f"dim INT, v BINARY, n LONG, least_id {id_type}, cell INT, cosine DOUBLE"))
    numbered = running_total(placed, ["dim"], ["cell", F.col("cosine").desc(), "v"], F.lit(1), "place")
    numbered = checkpointed(numbered.select("dim", "v", "n", "least_id", "place", F.floor(F.col("place") / tile).cast("long").alias("node")))

    tiles = checkpointed(numbered.groupBy("dim", "node").applyInArrow(lambda key, rows: _tile(key, rows, kind), BALL + ", vs BINARY, weights BINARY"))
    balls = tiles.drop("vs", "weights")
    count, height = balls.agg(F.coalesce(F.max("node") + 1, F.lit(0))).first()[0], 0
    while count > 1:
        count, height = -(-count // fanout), height + 1
    pairs, whole = _descended(balls, height, fanout, threshold)
    parts = max(vectors.sparkSession.sparkContext.defaultParallelism, -(-pairs.count() // PAIRS_PER_TASK))
    sides = pairs
    for side in ("a", "b"):
        sides = sides.join(tiles.select("dim", F.col("node").alias(side), F.col("vs").alias(f"vs_{side}"), F.col("weights").alias(f"weights_{side}")), ["dim", side])
    multiplied = sides.repartition(parts, "dim", "a", "b").mapInArrow(partial(_tile_links, threshold=threshold, kind=kind, tile=tile), "uid LONG, n LONG, to LONG")
    if whole:
        multiplied = multiplied.unionByName(_counted_whole(balls, whole, tile, fanout))
    found = checkpointed(multiplied)

    totals = found.groupBy("uid").agg(F.sum("n").alias("total"))
    roots = components(found.select(F.col("uid").alias("u"), F.col("to").alias("v")))
    each = numbered.select("dim", "v", "least_id", (F.col("dim").cast("long") * PLACES + F.col("place")).alias("uid")).join(totals, "uid")
    each = checkpointed(each.join(roots, each["uid"] == roots["node"], "left").select("dim", "v", "least_id", "total", F.coalesce("root", "uid").alias("root")))
    least = each.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = each.join(least, "root").select("dim", "v", "total", "component_id")
    told = rows.join(classes, ["dim", "v"], "left")
    component = F.when(F.col("total").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return told.select(
        "vec_id", F.coalesce(F.col("total") - 1, F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )

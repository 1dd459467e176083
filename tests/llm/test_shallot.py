from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylift.llm import shallot
from staylift.llm.queries import op13_shallot

COLUMNS = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def plain(rows, k, rounds, scale=256, seed=2):
    """Lloyd's rounds with whole distances to all centroids; rows are (vec_id, vector)."""
    x = np.array([[int(np.floor(scale * float(np.float32(c)))) for c in v] for _, v in rows], np.int64)
    drawn = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, sha256(f"{seed}:{rows[i][0]}".encode()).hexdigest(), x[i].astype("<i4").tobytes()))
    centroids = x[drawn[:k]]

    def assigned():
        d = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        nearest, _ = assigned()
        centroids = np.array([[int(s) // int((nearest == j).sum()) for s in x[nearest == j].sum(axis=0)] if (nearest == j).any() else c for j, c in enumerate(centroids)])
    nearest, distance = assigned()
    told = [sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return sorted(((r[0], int(j), int(d), int(distance[nearest == j].sum()), int(distance.sum()), told[j]) for r, j, d in zip(rows, nearest, distance)), key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in rows], COLUMNS)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def clouds(seed, n, dims, spread, centres=7):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return [(i * 3, middle[rng.integers(centres)] + spread * rng.normal(size=dims)) for i in range(n)]


@pytest.mark.parametrize(("n", "dims", "spread", "k", "rounds"), [(300, 4, 0.3, 12, 5), (200, 3, 0.001, 20, 4), (150, 64, 0.5, 40, 5), (30, 2, 1.0, 40, 3), (40, 5, 0.2, 1, 2), (60, 2, 0.2, 2, 0)])
def test_clusters_equal_plain_rounds(spark, n, dims, spread, k, rounds):
    rows = clouds(n, n, dims, spread)
    made = shallot.clustered(table(spark, rows).repartition(3), k, rounds, dims)
    assert found(made) == plain(rows, k, rounds)


def test_ties_repeats_and_null_ids(spark):
    # Whole-number grids make equal distances; every vector is there twice, once without an id.
    rows = [(i, (i % 5 / 256, i // 5 % 5 / 256)) for i in range(75)] + [(None, (i % 5 / 256, 1 / 256)) for i in range(9)]
    made = shallot.clustered(table(spark, rows), 9, 4, 2)
    assert found(made) == plain(rows, 9, 4)


def test_which_vectors_count(spark):
    rows = [
        (1, [0.5, float("nan")]), (2, [float("inf"), 1.0]), (3, [1.0, None]), (4, None), (5, [1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (8, [-0.001, 0.0]), (9, [0.0, -0.0]),
    ]
    docs = spark.createDataFrame([(i, v, 0) for i, v in rows], COLUMNS).withColumn("x", F.lit(1)).withColumn("cluster", F.lit(1))
    assert found(shallot.clustered(docs, 40, 2, 2)) == plain([(8, [-0.001, 0.0]), (9, [0.0, -0.0])], 40, 2)
    assert found(shallot.clustered(docs.limit(0), 40, 2, 2)) == []
    assert shallot.clustered(docs.filter("vec_id < 8"), 40, 2, 2).count() == 0
    with pytest.raises(Exception, match="beyond"):
        shallot.clustered(spark.createDataFrame([(1, [1e30, 0.0], 0)], COLUMNS), 2, 1, 2).count()


def test_bounds_spare_searches_and_hold():
    rng = np.random.default_rng(3)
    x = np.floor(256 * (rng.normal(size=(20, 8))[rng.integers(20, size=3000)] * 4 + 0.1 * rng.normal(size=(3000, 8)))).astype(np.int64)
    centroids = shallot.Centroids.of(x[:25].copy())
    state = shallot.searched(x, np.zeros(3000, np.int64), np.ones(3000, np.int64), centroids)
    seen = []
    real = shallot.searched
    for _ in range(4):
        nearest = state.nearest
        moved = np.array([x[nearest == j].sum(axis=0) // max(1, (nearest == j).sum()) if (nearest == j).any() else c for j, c in enumerate(centroids.points)])
        before, centroids = centroids, shallot.Centroids.of(moved)
        shallot.searched = lambda rows, *rest: seen.append(len(rows)) or real(rows, *rest)
        try:
            state = shallot.reassigned(x, state, centroids, centroids.moved_from(before))
        finally:
            shallot.searched = real
        d = ((x[:, None] - centroids.points[None]) ** 2).sum(axis=2)
        assert (state.nearest == d.argmin(axis=1)).all()
        own = np.sqrt(d[np.arange(3000), state.nearest])
        d[np.arange(3000), state.nearest] = np.iinfo(np.int64).max
        assert (state.upper >= own).all() and (state.lower <= np.sqrt(d.min(axis=1))).all()
    assert sum(seen) < 4 * 3000 / 2


def test_the_query_equals_plain_rounds(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert found(op13_shallot(spark, sf)) == plain(rows, 40, 5)

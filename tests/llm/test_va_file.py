import hashlib
import math
import random

import numpy as np
import pytest

from lakelayer.llm.va_file import Grid, approximation_file, by_cells, cluster_vectors, fit_centroids, nearest

SCHEMA = "vec_id long, embedding array<float>"


def kept(rows):
    return [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]


def brute(rows):
    vectors = kept(rows)
    if not vectors:
        return []
    seeds = sorted(vectors, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(),
                                           np.array(r[1], "<i4").tobytes()))
    x = np.array([v for _, v in vectors])
    c = np.array([v for _, v in seeds[:8]])
    for _ in range(10):
        own = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        c = np.array([x[own == j].sum(0) // (own == j).sum() if (own == j).any() else c[j] for j in range(len(c))])
    d = ((x[:, None] - c) ** 2).sum(2)
    own, least = d.argmin(1), d.min(1)
    return sorted(((i, int(o), int(m), int(least[own == o].sum()), int(least.sum()),
                    hashlib.sha256(",".join(map(str, c[o])).encode()).hexdigest())
                   for (i, _), o, m in zip(vectors, own, least)), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def vectors(seed, n, spread=0.3):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [m + rng.gauss(0, spread) for m in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("seed, spread", [(1, 0.05), (2, 0.6)])
def test_matches_brute_force(spark, seed, spread):
    rows = vectors(seed, 400, spread)
    assert got(cluster_vectors(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_rows_that_are_not_kept_ties_and_repeats(spark):
    rows = vectors(3, 60)
    zero = [0.0] * 64
    rows += [(100, None), (101, []), (102, [0.1] * 63), (103, [0.1] * 65), (104, [None] + [0.1] * 63), (105, [math.nan] * 64),
             (106, [math.inf] + [0.0] * 63), (None, zero), (107, zero), (107, zero), (108, [-0.0001] * 64), rows[5], rows[5],
             (109, [100.0] + [0.0] * 63)]
    df = spark.createDataFrame([(i, v, 1, b"x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, whole binary")
    assert got(cluster_vectors(df)) == brute(rows)


def test_few_and_no_vectors(spark):
    few = vectors(4, 3)
    assert got(cluster_vectors(spark.createDataFrame(few, SCHEMA))) == brute(few)
    same = [(i, [0.5] * 64) for i in range(12)]  # all centroids equal: the smallest number takes all
    assert got(cluster_vectors(spark.createDataFrame(same, SCHEMA))) == brute(same)
    for rows in ([], [(1, None)]):
        out = cluster_vectors(spark.createDataFrame(rows, SCHEMA))
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert out.collect() == []


def test_too_large_components_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e9] * 64)], SCHEMA)
    with pytest.raises(Exception, match="too large for exact distances"):
        cluster_vectors(df)


def test_intervals_hold_the_distances():
    rng = np.random.default_rng(6)
    x = rng.integers(-700, 700, (300, 64))
    c = x[:8]
    grid = Grid(x.min(0), np.maximum(1, -(-(x.max(0) - x.min(0) + 1) // 256)))
    least, most = grid.tables(c)
    place = grid.cells(x).astype(int) + np.arange(64) * 256
    true = ((x[:, None] - c) ** 2).sum(2)
    for k in range(8):
        assert (least[k].take(place).sum(1) <= true[:, k]).all() and (true[:, k] <= most[k].take(place).sum(1)).all()
    told = by_cells(grid.cells(x).astype(np.int64), grid, c)
    assert (told >= 0).any() and (told[told >= 0] == nearest(x, c)[told >= 0]).all()


def test_later_rounds_unpack_few_vectors_of_clear_clusters(spark):
    file, grid = approximation_file(spark.createDataFrame(vectors(7, 500, 0.02), SCHEMA))
    _, fetched = fit_centroids(file, grid)
    assert fetched[0] == 500 and fetched[-1] < 250

"""Centroid clustering over a vector-approximation file.

Every vector is kept twice in one table: as ``BITS``-bit cells, one for each
component, and whole. For a set of centroids, lookup tables hold the least and
the greatest squared distance from each cell to each centroid's component; their
sums bound a vector's distance to each centroid. Where one interval lies below
all others the nearest centroid is known from the cells alone; only the other
vectors are unpacked and measured.

Centroids move by exact integer sums. The first round sums all vectors; each
later one unpacks, beside the undecided, only those that change cluster, and
adds and subtracts them. A task hands on one row for each cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import stage

# Which vectors are kept, and how many centroids and rounds there are.
WIDTH = 64
SCALE = 1024.0
CLUSTERS = 8
ROUNDS = 10
SEED_TEXT = "3:"

BITS = 8
LIMIT = 1 << 27  # components from here on: a squared distance may pass 64 bits


@dataclass(frozen=True)
class Grid:
    """Equal cells of whole numbers in each dimension, from the least value of all vectors."""

    low: np.ndarray
    step: np.ndarray

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        return ((vectors - self.low) // self.step).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared distance: [centroid, dimension * cells + cell]."""
        first = self.low[:, None] + self.step[:, None] * np.arange(1 << BITS)
        last = first + self.step[:, None] - 1
        to_first, to_last = first - centroids[:, :, None], last - centroids[:, :, None]
        least = np.maximum(np.maximum(to_first, -to_last), 0) ** 2
        most = np.maximum(np.abs(to_first), np.abs(to_last)) ** 2
        return least.reshape(len(centroids), -1), most.reshape(len(centroids), -1)


def unpacked(column: pa.Array, kind: str) -> np.ndarray:
    """A column of fixed-size binary values as a matrix of numbers, one row each."""
    if not len(column):
        return np.zeros((0, WIDTH), np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, WIDTH).astype(np.int64)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept vectors as little-endian 32-bit whole numbers."""
    for batch in batches:
        batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column("embedding")), WIDTH), False))
        ids = batch.column("vec_id")
        values = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)  # null is NaN
        finite = np.isfinite(values).all(axis=1)
        numbers = np.floor(SCALE * values[finite])
        if (np.abs(numbers) >= LIMIT).any():
            raise ValueError(f"a component of {LIMIT / SCALE:.0f} or more is too large for exact distances in 64 bits")
        whole = numbers.astype("<i4")
        yield pa.RecordBatch.from_arrays(
            [ids.filter(pa.array(finite)), pa.array([row.tobytes() for row in whole], pa.binary())], ["vec_id", "whole"])


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least, most = np.full(WIDTH, LIMIT), np.full(WIDTH, -LIMIT)
    for batch in batches:
        vectors = unpacked(batch.column("whole"), "<i4")
        if len(vectors):
            least, most = np.minimum(least, vectors.min(axis=0)), np.maximum(most, vectors.max(axis=0))
    yield pa.RecordBatch.from_pydict({"dim": pa.array(range(WIDTH), pa.int32()),
                                      "least": pa.array(least, pa.int64()), "most": pa.array(most, pa.int64())})


def fit_grid(vectors: DataFrame) -> Grid:
    """The grid over the least and greatest component of all vectors in each dimension."""
    found = vectors.mapInArrow(_ranges, "dim int, least long, most long")
    rows = found.groupBy("dim").agg(F.min("least").alias("least"), F.max("most").alias("most")).orderBy("dim").collect()
    low, high = (np.array([r[c] for r in rows], np.int64) for c in ("least", "most"))
    return Grid(low, np.maximum(1, -(-(high - low + 1) // (1 << BITS))))


def _with_cells(batches: Iterator[pa.RecordBatch], grid: Grid) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = grid.cells(unpacked(batch.column("whole"), "<i4"))
        yield batch.append_column("cells", pa.array([row.tobytes() for row in cells], pa.binary()))


def by_cells(cells: np.ndarray, grid: Grid, centroids: np.ndarray) -> np.ndarray:
    """Each vector's nearest centroid as far as its cells tell; -1 where intervals overlap."""
    least, most = grid.tables(centroids)
    place = cells + np.arange(WIDTH) * (1 << BITS)
    low = np.stack([table.take(place).sum(axis=1) for table in least], axis=1)
    high = np.stack([table.take(place).sum(axis=1) for table in most], axis=1)
    possible = low <= high.min(axis=1, keepdims=True)
    return np.where(possible.sum(axis=1) == 1, possible.argmax(axis=1), -1)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exactly nearest centroid; ties go to the smaller number."""
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1).argmin(axis=1)


def _moves(batches: Iterator[pa.RecordBatch], grid: Grid, before: np.ndarray | None,
           now: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each cluster: how its count and component sums change from ``before`` to ``now``.

    ``fetched`` (on cluster 0): how many vectors were unpacked.
    """
    count = np.zeros(len(now), np.int64)
    sums = np.zeros((len(now), WIDTH), np.int64)
    fetched = 0
    for batch in batches:
        cells = unpacked(batch.column("cells"), "u1")
        new = by_cells(cells, grid, now)
        old = new if before is None else by_cells(cells, grid, before)
        wanted = np.flatnonzero((new < 0) | (old < 0) | (old != new) | (before is None))
        vectors = unpacked(batch.column("whole").take(pa.array(wanted)), "<i4")
        fetched += len(wanted)
        for centroids, side, sign in ((now, new, 1), (before, old, -1)):
            if centroids is not None:
                own = side[wanted]
                own[own < 0] = nearest(vectors[own < 0], centroids)
                for c in range(len(now)):
                    count[c] += sign * np.count_nonzero(own == c)
                    sums[c] += sign * vectors[own == c].sum(axis=0)
    yield pa.RecordBatch.from_pydict({
        "cluster": pa.array(range(len(now)), pa.int32()), "n": pa.array(count, pa.int64()),
        "sums": pa.array(sums.tolist(), pa.list_(pa.int64())),
        "fetched": pa.array([fetched] + [0] * (len(now) - 1), pa.int64())})


def moved_sums(file: DataFrame, grid: Grid, before: np.ndarray | None,
               now: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Changes of counts and sums of every cluster over the whole file, and the vectors unpacked for them."""
    rows = file.mapInArrow(lambda b: _moves(b, grid, before, now), "cluster int, n long, sums array<long>, fetched long")
    total = rows.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.sum("fetched").alias("fetched"),
        F.array(*[F.sum(F.col("sums")[d]) for d in range(WIDTH)]).alias("sums")).collect()  # a row a cluster
    count, sums = np.zeros(len(now), np.int64), np.zeros((len(now), WIDTH), np.int64)
    for r in total:
        count[r["cluster"]], sums[r["cluster"]] = r["n"], r["sums"]
    return count, sums, sum(r["fetched"] for r in total)


def _assigned(batches: Iterator[pa.RecordBatch], grid: Grid, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cluster = by_cells(unpacked(batch.column("cells"), "u1"), grid, centroids)
        vectors = unpacked(batch.column("whole"), "<i4")  # all: every distance is asked for
        cluster[cluster < 0] = nearest(vectors[cluster < 0], centroids)
        distance = ((vectors - centroids[cluster]) ** 2).sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
            ["vec_id", "cluster", "distance"])


def approximation_file(vectors: DataFrame) -> tuple[DataFrame, Grid]:
    """The table (vec_id, whole, cells) of ``vectors`` (vec_id, embedding), and its grid.

    Kept are vectors of exactly ``WIDTH`` components, none null, NaN or
    infinite. A component too large for exact 64-bit distances is an error.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = stage(rows.mapInArrow(_whole, "vec_id long, whole binary"), "va-vectors")
    grid = fit_grid(whole)
    return stage(whole.mapInArrow(lambda b: _with_cells(b, grid), "vec_id long, whole binary, cells binary"), "va-file"), grid


def first_centroids(file: DataFrame) -> np.ndarray:
    """The vectors of least sha256 of their id's text; a bounded top-k."""
    digest = F.sha2(F.concat(F.lit(SEED_TEXT), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = file.select(digest.alias("digest"), "whole").orderBy("digest", "whole").limit(CLUSTERS).collect()
    return np.array([np.frombuffer(r["whole"], "<i4") for r in rows], np.int64).reshape(-1, WIDTH)


def fit_centroids(file: DataFrame, grid: Grid, rounds: int = ROUNDS) -> tuple[np.ndarray, list[int]]:
    """Centroids after ``rounds`` rounds, and how many vectors each round unpacked.

    Rounds that could change nothing any more are not run.
    """
    now = first_centroids(file)
    before, fetched = None, []
    count, sums = np.zeros(len(now), np.int64), np.zeros((len(now), WIDTH), np.int64)
    for _ in range(rounds if len(now) else 0):
        more, moved, n = moved_sums(file, grid, before, now)
        count, sums = count + more, sums + moved
        fetched.append(n)
        after = np.where(count[:, None] > 0, sums // np.maximum(count, 1)[:, None], now)
        if np.array_equal(after, now):
            break
        before, now = now, after
    return now, fetched


def cluster_vectors(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Rows that are not kept (see ``approximation_file``) have no result; repeated
    rows are vectors of their own. Fewer than ``CLUSTERS`` vectors give as many
    centroids; none give an empty table. A null id hashes as an empty text.
    Columns other than vec_id and embedding are not read.
    """
    file, grid = approximation_file(vectors)
    centroids, _ = fit_centroids(file, grid, rounds)
    placed = stage(file.mapInArrow(lambda b: _assigned(b, grid, centroids), "vec_id long, cluster int, distance long"),
                   "va-clusters") if len(centroids) else file.select(
        "vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    inertia = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids] or [""]
    own = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(max(1, len(centroids)))])
    return placed.select(
        "vec_id", "cluster", "distance", own[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.array(*map(F.lit, digests))[F.col("cluster")].alias("centroid_sha256"))

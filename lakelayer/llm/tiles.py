"""Pairs of rows that meet in a list, compared in dense blocks of bounded size.

A list longer than a tile is cut into tiles, and each pair of its tiles is a
group of its own, so no task holds more than two tiles of one list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 512  # rows of a list in a tile
PAIRS = 400_000  # compared at once


def tiled(rows: DataFrame, keys: list[str], member: str, tile: int = TILE) -> DataFrame:
    """``rows`` with ``low``, ``high`` (a pair of tiles of the row's list) and ``own`` (the row's tile).

    A list is the rows that agree in ``keys``. A list of k tiles repeats its rows k times.
    """
    long = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_")).where(F.col("rows_") > tile)
    cut = rows.join(long, keys, "left").withColumn("tiles_", F.coalesce(F.ceil(F.col("rows_") / tile), F.lit(1)).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.hash(member), F.col("tiles_")))
    cut = cut.withColumn("other_", F.explode(F.sequence(F.lit(0), F.col("tiles_") - 1)))
    return cut.withColumn("low", F.least("own", "other_")).withColumn("high", F.greatest("own", "other_")).drop(
        "rows_", "tiles_", "other_")


def by_tile(rows: DataFrame, keys: list[str], member: str) -> DataFrame:
    """The rows of each pair of tiles side by side, as ``pairs_in_lists`` reads them."""
    return rows.repartition(*keys, "low", "high").sortWithinPartitions(*keys, "low", "high", member)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches cut at group ends: a table of whole groups, and where each begins (with the end of the last)."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        if rows.num_rows:
            starts = _starts(rows, keys)
            if len(starts) > 1:
                yield rows.slice(0, starts[-1]), starts
            held = rows.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def _starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    fresh = np.ones(rows.num_rows, dtype=bool)
    columns = [rows.column(k).to_numpy() for k in (*keys, "low", "high")]
    fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(fresh)


def pairs_in_groups(starts: np.ndarray, tile_of: np.ndarray, within: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (left, right) of the pairs of every group, at most ``PAIRS`` or one row's pairs at a time.

    In a pair of different tiles (``within`` is false) only rows of different tiles meet.
    """
    sizes = np.diff(starts)
    for m in np.unique(sizes[sizes > 1]).tolist():
        begins = starts[:-1][sizes == m]
        i, j = np.triu_indices(m, 1)
        at_once = max(1, PAIRS // len(i))
        for at in range(0, len(begins), at_once):
            begin = begins[at:at + at_once, None]
            for part in range(0, len(i), PAIRS):
                left = (begin + i[part:part + PAIRS]).ravel()
                right = (begin + j[part:part + PAIRS]).ravel()
                meets = within[left] | (tile_of[left] != tile_of[right])
                yield left[meets], right[meets]


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n rows the least row that it reaches over the pairs (left, right)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[left], root[right])
        after = root.copy()
        np.minimum.at(after, root[left], least)
        np.minimum.at(after, root[right], least)
        while not np.array_equal(after, hop := after[after]):
            after = hop
        if np.array_equal(after, root):
            return root
        root = after

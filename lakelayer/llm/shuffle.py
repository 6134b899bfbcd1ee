"""Uniform shuffle of a table into shards of exact sizes.

The table is seen as blocks (a hash of the row). For each block, how many of
its rows go to each shard is drawn from the multivariate hypergeometric law
given the block counts and the exact shard sizes (Sanders, 1998). Each block is
then put in random order and cut by its row of that matrix, rows are exchanged,
and each shard is put in random order again. Every permutation of the table is
equally likely, and every shard's size is exact.

The law is ``rows``: shard sizes differ by at most one. Only the matrix passes
the driver: one row per block, and the number of blocks is bounded.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import spare_name, stage

BLOCK_ROWS = 20_000
MOST_BLOCKS = 16_384


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good items among ``draws`` without replacement, for populations of any size."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    # Inverse of the distribution function over +-40 deviations around the mode,
    # weights by the ratio of neighbouring probabilities.
    total = good + bad
    mode = (draws + 1) * (good + 1) // (total + 2)
    share = good / total
    spread = int(40 * np.sqrt(max(1.0, draws * share * (1 - share)))) + 2
    first, last = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    weights = np.concatenate(([0.0], np.cumsum(steps)))
    weights = np.cumsum(np.exp(weights - weights.max()))
    return first + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(rng: np.random.Generator, counts: list[int], sizes: list[int]) -> list[list[int]]:
    """Rows: blocks with the given counts; columns: shards with the given sizes; sums are exact."""
    left = list(sizes)
    matrix = []
    for count in counts:
        row, room = [], count
        rest = sum(left)
        for j, size in enumerate(left):
            rest -= size
            n = hypergeometric(rng, size, rest, room)
            row.append(n)
            room -= n
        left = [a - b for a, b in zip(left, row)]
        matrix.append(row)
    return matrix


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def random_key(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *(F.col(c) for c in columns))


def shuffle_into_shards(rows: DataFrame, shards: int, key: list[str], seed: int = 7,
                        block_rows: int = BLOCK_ROWS, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """Add ``shard`` (0 to shards-1) and ``slot`` (gapless from 0) to ``rows``.

    ``key`` names the columns that order rows with equal random numbers; rows
    equal in all of them are interchangeable. Nulls are values like any other.
    An empty table gives an empty result. Columns of ``rows`` named ``shard`` or
    ``slot`` are replaced (``key`` must not name them); all others stay as they
    are. The rows are written once, then read for the counts and again for the
    exchange.
    """
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot")
    random, block, edges, nth, place, part, ahead, count = (
        spare_name(rows, n) for n in ("random", "block", "edges", "nth", "place", "part", "ahead", "count"))
    held = stage(rows.withColumn(random, random_key(seed, *key)), "shuffle-rows")
    total = held.count()
    blocks = max(1, min(most_blocks, total // block_rows))
    dealt = held.withColumn(block, F.pmod(random, F.lit(blocks)))
    counts = {r[0]: r[1] for r in dealt.groupBy(block).agg(F.count(F.lit(1))).collect()}
    own = sorted(counts)
    matrix = communication_matrix(np.random.default_rng(seed), [counts[b] for b in own], shard_sizes(total, shards))
    table = spark.createDataFrame([(b, np.cumsum(row).tolist()) for b, row in zip(own, matrix)],
                                  f"`{block}` long, `{edges}` array<long>")

    # First permutation: random order inside each block; its matrix row cuts it into shards.
    first = Window.partitionBy(block).orderBy(random_key(seed + 1, *key), *key)
    sent = (
        dealt.withColumn(nth, F.row_number().over(first))
        .join(F.broadcast(table), block)  # at most most_blocks rows of ``shards`` numbers
        .withColumn("shard", F.size(F.filter(edges, lambda e: e < F.col(nth))).cast("int"))
        .drop(edges, nth)
    )
    # Second permutation: random order inside each shard, by ranges of the random number.
    sent = stage(sent.withColumn(place, random_key(seed + 2, *key)).withColumn(
        part, F.pmod(F.shiftrightunsigned(place, 20), F.lit(blocks))), "shuffle-sent")
    parts = sent.groupBy("shard", part).agg(F.count(F.lit(1)).alias(count))
    before = F.sum(count).over(Window.partitionBy("shard").orderBy(part)) - F.col(count)
    parts = parts.withColumn(ahead, before).drop(count)
    second = Window.partitionBy("shard", part).orderBy(place, *key)
    return (
        sent.withColumn(nth, F.row_number().over(second))
        .join(parts, ["shard", part])
        .withColumn("slot", F.col(ahead) + F.col(nth) - 1)
        .drop(random, block, place, part, nth, ahead)
    )

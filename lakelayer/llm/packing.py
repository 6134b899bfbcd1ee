"""Pack token ids into fixed windows: histogram packing by non-negative least squares.

Documents are cut at multiples of the window, so only the last piece of each is
shorter. Piece lengths are rounded up to a few hundred classes. Every way to
fill a window with at most three classes is a column; non-negative least
squares gives how often to use each so that the columns add up to the
histogram of classes (Krell et al., 2021). Repeats are rounded down, and what
is left over is packed greedily, longest first, with any number of pieces.

All of this works on the histogram, whose size depends on the window alone.
Pieces then look up their place by their rank within their class; ranks come
from counts per (class, block), so no task holds a class.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import handed_back
from lakelayer.llm.tokens import worker_encoder
from lakelayer.session import work_dir

WINDOW = 2048
CLASSES = 256
DEPTH = 3
END_ID = 1
BLOCK_ROWS = 10_000


def fillings(classes: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All multisets of at most ``depth`` class lengths that sum to ``classes``, largest first."""
    found = []

    def grow(chosen: tuple[int, ...], left: int) -> None:
        if left == 0:
            found.append(chosen)
        elif len(chosen) < depth:
            highest = min(left, chosen[-1] if chosen else classes)
            lowest = -(-left // (depth - len(chosen)))
            for size in range(highest, lowest - 1, -1):
                grow((*chosen, size), left - size)

    grow((), classes)
    return found


def solve_nnls(columns: np.ndarray, target: np.ndarray, rounds: int = 600, tolerance: float = 1e-5) -> np.ndarray:
    """x >= 0 that minimises |columns @ x - target| (Lawson and Hanson's active sets, normal equations).

    Ends when no column can gain more than ``tolerance`` of the first gain.
    """
    scale = max(float(target.max(initial=0)), 1.0)
    goal = target / scale
    x = np.zeros(columns.shape[1])
    used: list[int] = []
    small = None
    for _ in range(rounds):
        gain = columns.T @ (goal - columns[:, used] @ x[used])
        gain[used] = -np.inf
        best = int(np.argmax(gain))
        small = gain[best] * tolerance if small is None else small
        if gain[best] <= small:
            break
        used.append(best)
        while used:
            own = columns[:, used]
            gram = own.T @ own + 1e-9 * np.eye(len(used))
            tried = np.linalg.solve(gram, own.T @ goal)
            held = x[used]
            low = tried <= 0
            if not low.any():
                x[used] = tried
                break
            step = np.min(held[low] / (held[low] - tried[low] + 1e-300))
            moved = np.maximum(held + step * (tried - held), 0)
            moved[low & (moved <= 1e-12)] = 0
            if moved[low].all():
                moved[np.flatnonzero(low)[np.argmin(moved[low])]] = 0
            x[used] = moved
            used = [u for u, m, down in zip(used, moved, low) if m > 0 or not down]
    return x * scale


def plan_packing(histogram: dict[int, int], classes: int = CLASSES, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(class lengths of a window, repeats), using up the histogram exactly."""
    left = np.zeros(classes + 1, dtype=np.int64)
    for size, count in histogram.items():
        left[size] = count
    ways = fillings(classes, depth)
    columns = np.zeros((classes + 1, len(ways)))
    for j, way in enumerate(ways):
        for size in way:
            columns[size, j] += 1
    repeats = np.floor(solve_nnls(columns, left.astype(float)) + 1e-6).astype(np.int64)

    plan = []

    def use(way: tuple[int, ...], most: int | None = None) -> None:
        sizes, times = np.unique(way, return_counts=True)
        n = int(min((left[sizes] // times).min(), left.sum() if most is None else most))
        if n > 0:
            left[sizes] -= n * times
            plan.append((tuple(way), n))

    for j in np.argsort(-repeats, kind="stable"):
        if repeats[j] <= 0:
            break
        use(ways[j], int(repeats[j]))
    while left.any():
        way, room, free = [], classes, left.copy()
        while room > 0 and (fits := np.flatnonzero(free[:room + 1])).size:
            size = int(fits[-1])
            take = int(min(free[size], room // size))
            way += [size] * take
            free[size] -= take
            room -= take * size
        use(tuple(way))
    return plan


def _tokenize(batches: Iterator[pa.RecordBatch], path: str, window: int) -> Iterator[pa.RecordBatch]:
    encoder = worker_encoder(path, keeps_space=False)
    end = np.array([END_ID], dtype="<u4").tobytes()
    step = 4 * window
    for batch in batches:
        keys, starts, totals, pieces, held = [], [], [], [], 0
        for key, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
            ids += end
            for at in range(0, len(ids), step):
                keys.append(key)
                starts.append(at // 4)
                totals.append(len(ids) // 4)
                pieces.append(ids[at:at + step])
            held += len(ids)
            if held > 8_000_000:
                yield _pieces(keys, starts, totals, pieces)
                keys, starts, totals, pieces, held = [], [], [], [], 0
        if keys:
            yield _pieces(keys, starts, totals, pieces)


def _pieces(keys: list, starts: list[int], totals: list[int], pieces: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(keys, pa.int64()), "start": pa.array(starts, pa.int64()),
        "length": pa.array([len(p) // 4 for p in pieces], pa.int64()),
        "doc_tokens": pa.array(totals, pa.int64()), "ids": pa.array(pieces, pa.binary())})


def cut_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of at most ``window`` ids, written once: doc_id, start, length, doc_tokens, ids, ids_crc32.

    ``ids`` are little-endian unsigned 32-bit. Every document ends with id 1;
    a null or empty text is that id alone. Null doc_id is allowed.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, start long, length long, doc_tokens long, ids binary"
    cut = rows.mapInArrow(lambda batches: handed_back(_tokenize(batches, tokenizer_path, window)), schema)
    folder = work_dir(docs.sparkSession, "pieces")
    cut.withColumn("ids_crc32", F.crc32("ids")).write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def place_pieces(pieces: DataFrame, window: int = WINDOW, classes: int = CLASSES, depth: int = DEPTH,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (a stored table with doc_id, start, length, ids_crc32).

    Within a sequence offsets are gapless from 0. Repeated rows are packed as
    often as they occur. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    unit = -(-window // classes)
    rows = pieces.count()
    blocks = max(1, rows // block_rows)
    sized = pieces.withColumn("class", F.ceil(F.col("length") / unit).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(blocks)))
    counts = sized.groupBy("class", "block").agg(F.count(F.lit(1)).alias("n"))
    # At most ``classes`` rows reach the driver.
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    plan = plan_packing(histogram, classes, depth)

    firsts = [0, *accumulate(n for _, n in plan)]
    spans: dict[int, list[tuple[int, int, int]]] = {}
    taken = dict.fromkeys(histogram, 0)
    for (way, n), first in zip(plan, firsts):
        for slot, size in enumerate(way):
            spans.setdefault(size, []).append((taken[size], first, slot))
            taken[size] += n
    table = spark.createDataFrame(
        [(size, [s[0] for s in own], [s[1] for s in own], [s[2] for s in own]) for size, own in spans.items()],
        "class int, rank_from array<long>, first_sequence array<long>, slots array<int>")

    by_block = Window.partitionBy("class").orderBy("block")
    ahead = counts.withColumn("ahead", F.sum("n").over(by_block) - F.col("n")).drop("n")
    own = Window.partitionBy("class", "block").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        sized.withColumn("nth", F.row_number().over(own))
        .join(ahead, ["class", "block"])
        .withColumn("rank", F.col("ahead") + F.col("nth") - 1)
    )
    # One row per class: at most ``classes`` rows, each with the spans of a plan of bounded size.
    at = F.expr("size(filter(rank_from, s -> s <= rank)) - 1")
    placed = ranked.join(F.broadcast(table), "class").withColumn("at", at).select(
        *pieces.columns,
        F.expr("first_sequence[at] + rank - rank_from[at]").alias("sequence_id"),
        F.expr("slots[at]").alias("slot"))
    inside = Window.partitionBy("sequence_id").orderBy("slot")
    return placed.withColumn("offset", F.sum("length").over(inside) - F.col("length")).drop("slot")


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """Tokenize, cut and place ``docs`` (doc_id, text): one row per piece, ids included."""
    return place_pieces(cut_pieces(docs, tokenizer_path, window), window)


def sequences(placed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The packed windows: sequence_id, ids (padded to ``window``), used. At most ``window`` pieces meet in a row."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids", "length")))
    used = placed.groupBy("sequence_id").agg(own.alias("own"), F.sum("length").alias("used"))
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    joined = F.aggregate("own", F.lit(b""), lambda done, piece: F.concat(done, piece["ids"]))
    return used.select(
        "sequence_id",
        F.concat(joined, F.unhex(F.repeat(F.hex(pad), F.lit(window) - F.col("used").cast("int")))).alias("ids"),
        "used")

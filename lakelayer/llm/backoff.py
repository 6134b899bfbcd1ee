"""Stupid-backoff language-model scores, with count tables over the whole corpus.

The score of a word after its history is the relative frequency of the longest
n-gram seen elsewhere in the corpus, times 0.4 for each word of history given
up (Brants et al., 2007). A document's own n-grams are taken out of the counts
it is scored with, so no document vouches for itself.

Relationally: every task cuts the documents it reads into compressed blocks of
bounded size, which are stored once, bucketed by their number, and never move.
Each block lists its distinct n-grams (64-bit hashes) with their counts, cut by hash
into shards. A shard adds up the lists of all blocks (the count table of its
hashes) and answers every list with the counts in the other blocks, mostly none;
a block then looks up its n-grams among them and sums per document. A list holds
an n-gram once per block, so a very frequent one is a row per block. Lists travel
sorted, as differences, numbers by their bytes of equal weight.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from lakelayer.llm.words import runs, word_hashes
from lakelayer.session import work_dir
from lakelayer.sources.buckets import bucketed

ORDER = 3
BACKOFF = 0.4
BLOCK_BYTES = 6_000_000
SHARD_BYTES = 8_000_000


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending distinct uint64 as differences of the fewest whole bytes that hold the largest."""
    if not len(values):
        return b""
    steps = np.diff(values)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    low = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    # The highest byte is small for most steps, so it is worth a Huffman code; the others are even.
    coder = zlib.compressobj(1, zlib.DEFLATED, -15, 9, zlib.Z_HUFFMAN_ONLY)
    high = coder.compress(low[:, -1].tobytes()) + coder.flush()
    return bytes([width]) + int(values[0]).to_bytes(8, "little") + len(steps).to_bytes(8, "little") + low[:, :-1].tobytes() + high


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.uint64)
    width, first, n = data[0], int.from_bytes(data[1:9], "little"), int.from_bytes(data[9:17], "little")
    even = 17 + n * (width - 1)
    wide = np.zeros((n + 1, 8), dtype=np.uint8)
    wide[1:, :width - 1] = np.frombuffer(data, np.uint8, n * (width - 1), 17).reshape(n, width - 1)
    wide[1:, width - 1] = np.frombuffer(zlib.decompress(data[even:], -15), np.uint8)
    steps = wide.view("<u8").ravel()
    steps[0] = first
    return np.cumsum(steps, dtype=np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    """Small numbers: all lowest bytes, then all second ones, as many as the largest needs, compressed."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + zlib.compress(planes.T.tobytes(), 6)


def unpack_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    wide = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    wide[:, :data[0]] = planes.T
    return wide.view("<u8").ravel()


def block_grams(texts: pa.Array, order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(words per text, n-gram hashes by n, text number of each n-gram by n); no n-gram spans texts."""
    words, offsets = word_hashes(texts)
    counts = np.diff(offsets)
    owner = np.repeat(np.arange(len(counts)), counts)
    grams, owners = [], []
    for n in range(1, order + 1):
        own = runs(words, n)
        inside = owner[:len(own)] == owner[len(owner) - len(own):]
        grams.append(own[inside])
        owners.append(owner[:len(own)][inside])
    return counts, grams, owners


def _packed(rows: list[pa.RecordBatch]) -> bytes:
    """Batches of (doc_id, text) as one compressed stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(pa.Table.from_batches(rows).combine_chunks())
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the documents of a task, of ``block_bytes`` of text or one document; numbered by task, then in order."""
    number = TaskContext.get().partitionId() << 32

    def packed(rows):
        return pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "data": pa.array([_packed(rows)], pa.binary())})

    rows, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        begin = 0
        for i, length in enumerate(lengths.tolist()):
            if size and size + length > block_bytes:
                if i > begin:
                    rows.append(batch.slice(begin, i - begin))
                yield packed(rows)
                number, rows, size, begin = number + 1, [], 0, i
            size += length
        rows.append(batch.slice(begin))
    if sum(map(len, rows)):
        yield packed(rows)


def _lists(batches: Iterator[pa.RecordBatch], order: int, shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
            yield from _listed(block, _unpacked(data.as_buffer()), order, shards).to_batches()


def _listed(block: int, table: pa.Table, order: int, shards: int) -> pa.Table:
    _, grams, _ = block_grams(table.column("text"), order)
    # Shard s holds the hashes from s * 2**64 / shards on.
    edges = np.array([(s << 64) // shards for s in range(1, shards)], dtype=np.uint64)
    out: dict[str, list] = {"block": [], "n": [], "shard": [], "hashes": [], "counts": []}
    for n, own in enumerate(grams, 1):
        distinct, counts = np.unique(own, return_counts=True)
        cuts = [0, *np.searchsorted(distinct, edges).tolist(), len(distinct)]
        for shard, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                for name, value in (("block", block), ("n", n), ("shard", shard), ("hashes", pack_sorted(distinct[a:b])),
                                    ("counts", pack_counts(counts[a:b] - 1))):
                    out[name].append(value)
    return pa.table(out, schema=pa.schema([("block", pa.int64()), ("n", pa.int32()), ("shard", pa.int32()),
                                           ("hashes", pa.binary()), ("counts", pa.binary())]))


def _totals(table: pa.Table) -> pa.Table:
    """Counts of one shard over all other blocks, for every entry of every list."""
    lists = [unpack_sorted(x) for x in table.column("hashes").to_pylist()]
    counts = np.concatenate([unpack_counts(x) for x in table.column("counts").to_pylist()]) + np.uint64(1)
    distinct, at = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.uint64)[at] - counts
    cuts = np.cumsum([0, *map(len, lists)])
    packed = [pack_counts(total[a:b]) for a, b in zip(cuts, cuts[1:])]
    return table.select(["block", "n", "shard"]).append_column("totals", pa.array(packed, pa.binary()))


def _scores(docs: pa.Table, replies: pa.Table, order: int, corpus: int, backoff: float) -> pa.Table:
    sizes, grams, owners = block_grams(docs.column("text"), order)
    rows = replies.to_pylist()
    elsewhere = []
    for n, (own, owner) in enumerate(zip(grams, owners), 1):
        parts = sorted((r["shard"], r["totals"]) for r in rows if r["n"] == n)
        others = np.concatenate([np.zeros(0), *(unpack_counts(p).astype(np.float64) for _, p in parts)])
        distinct, at, here_in_block = np.unique(own, return_inverse=True, return_counts=True)
        totals = others + here_in_block
        _, same, here = np.unique(owner * max(1, len(distinct)) + at, return_inverse=True, return_counts=True)
        elsewhere.append(totals[at] - here[same])
    # Scores from the shortest n-gram up; where a longer one is seen elsewhere, it replaces them.
    rest = np.maximum(corpus - sizes, 1).astype(np.float64)
    seen = elsewhere[0] > 0 if order else None
    score = np.where(seen, elsewhere[0], 0.5) / rest[owners[0]]
    level = np.where(seen, 1, 0)
    at_word = np.arange(len(owners[0]))
    starts = np.cumsum(sizes) - sizes
    place = at_word - starts[owners[0]]
    for n in range(2, order + 1):
        ends = at_word[place >= n - 1]  # words with n - 1 words before them, in order
        shorter = elsewhere[n - 2]
        # History: the (n-1)-gram that ends one word before.
        begins = at_word - starts[owners[0]]
        first = np.flatnonzero(_starts_run(begins, sizes, owners[0], n - 1))
        lookup = np.full(len(at_word), -1)
        lookup[first] = np.arange(len(first))
        history = shorter[lookup[ends - (n - 1)]]
        score[ends] *= backoff
        found = elsewhere[n - 1] > 0
        score[ends[found]] = elsewhere[n - 1][found] / history[found]
        level[ends[found]] = n
    # Words with a short history were given up nothing they had; every other level is one factor.
    log = np.bincount(owners[0], weights=np.log(score), minlength=len(sizes))
    unseen = np.bincount(owners[0], weights=level == 0, minlength=len(sizes)).astype(np.int64)
    full = np.bincount(owners[0], weights=level == order, minlength=len(sizes)).astype(np.int64)
    return pa.table({
        "doc_id": docs.column("doc_id"), "n_words": pa.array(sizes, pa.int64()),
        "n_full": pa.array(full, pa.int64()), "n_unseen": pa.array(unseen, pa.int64()),
        "log_score": pa.array(log, pa.float64()),
        "mean_log_score": pa.array(log / np.maximum(sizes, 1), pa.float64(), mask=sizes == 0)})


def _starts_run(place: np.ndarray, sizes: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """Whether a run of ``length`` words of the same text starts at each word."""
    return place + length <= sizes[owner]


def score_documents(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF,
                    block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_full, n_unseen, log_score, mean_log_score.

    log_score: sum over the words of the natural log of their score, given the
    n-gram counts of all other rows. n_full: words scored by a full n-gram;
    n_unseen: words that occur in no other row (they count as half an
    occurrence). Null and empty texts have no words, log_score 0 and a null
    mean. Repeated rows vouch for each other. An empty table gives an empty
    result. Memory of a task: one block, or one shard.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + size // shard_bytes
    stored = bucketed(docs.sparkSession, f"{work_dir(docs.sparkSession, 'lm-blocks')}/blocks",
                      StructType([StructField("block", LongType()), StructField("data", BinaryType())]), ["block"])
    stored.write(rows.mapInArrow(lambda b: _blocks(b, block_bytes), "block long, data binary"), spread=0)
    blocks = stored.read(docs.sparkSession)

    schema = "block long, n int, shard int, hashes binary, counts binary"
    lists = blocks.mapInArrow(lambda b: _lists(b, order, shards), schema)
    replies = lists.groupBy("n", "shard").applyInArrow(_totals, "block long, n int, shard int, totals binary")
    words = F.size(F.filter(F.split("text", "[ \t\n\r\x0b\x0c]+"), lambda w: w != ""))
    corpus = int(rows.where("text is not null").agg(F.sum(words.cast("long"))).first()[0] or 0)

    schema = ("doc_id long, n_words long, n_full long, n_unseen long, log_score double, mean_log_score double")
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        lambda d, r: _scores(_unpacked(d.column("data")[0].as_buffer()), r, order, corpus, backoff), schema)

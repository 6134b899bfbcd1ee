"""Token ids of a corpus as wavelet matrices, one compressed file entry per shard.

A wavelet matrix (Claude, Navarro and Ordonez, 2015) keeps a sequence of ids
as bit-planes, from the highest bit down. After each plane the sequence is
stably parted, zeros before ones; rank and select on the planes then give any
token, the count of an id in a range, and the places where it occurs, without
unpacking the sequence.

Entry format (little-endian): magic ``WMX1``; planes, documents and tokens as
uint32, uint32 and uint64; document ids (int64; a null id is the least int64)
and lengths (int64); zeros per plane (uint64); then each plane's bits, most
significant first, padded to whole 64-byte blocks. Counts per block are
rebuilt on opening. Entries are rows of a zstd-compressed Parquet table, so
Spark's committer makes writing safe against lost tasks and executors.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import totals_before
from lakelayer.llm.tokens import worker_encoder
from lakelayer.session import work_dir

MAGIC = b"WMX1"
NULL_ID = -(1 << 63)
BLOCK = 64  # bytes of a plane between two counts
SHARD_TOKENS = 1 << 20
END_ID = 0


class WaveletMatrix:
    """Rank/select structure over ids in [0, 2**levels)."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self.levels = len(planes)
        self.counts = [_block_counts(p) for p in planes]

    @classmethod
    def build(cls, ids: np.ndarray, levels: int | None = None) -> WaveletMatrix:
        top = int(ids.max()) if len(ids) else 0
        levels = max(1, levels or top.bit_length())
        now = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, zeros = [], []
        for level in range(levels):
            bit = (now & now.dtype.type(1 << (levels - 1 - level))) != 0
            low = now.take(np.flatnonzero(~bit))
            packed = np.packbits(bit)
            planes.append(np.pad(packed, (0, -len(packed) % BLOCK)))
            zeros.append(len(low))
            now = np.concatenate((low, now.take(np.flatnonzero(bit))))
        return cls(len(ids), planes, zeros)

    def _rank1(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of the plane before each position."""
        plane, at = self.planes[level], np.asarray(at, dtype=np.int64)
        block, rest = np.divmod(at, BLOCK * 8)
        inside = np.zeros(len(at), dtype=np.int64)
        part = np.flatnonzero(rest)
        if len(part):
            rows = plane.reshape(-1, BLOCK)[block[part]]
            bits = np.cumsum(np.unpackbits(rows, axis=1), axis=1, dtype=np.int64)
            inside[part] = bits[np.arange(len(part)), rest[part] - 1]
        return self.counts[level][block] + inside

    def _bits(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1

    def access(self, at) -> np.ndarray:
        """The ids at the given positions."""
        at = np.atleast_1d(np.asarray(at, dtype=np.int64))
        found = np.zeros(len(at), dtype=np.int64)
        for level in range(self.levels):
            bit, ones = self._bits(level, at), self._rank1(level, at)
            found = found << 1 | bit
            at = np.where(bit, self.zeros[level] + ones, at - ones)
        return found

    def _range(self, symbol: int, start: int, stop: int) -> tuple[int, int]:
        for level in range(self.levels):
            ones = self._rank1(level, np.array([start, stop]))
            if symbol >> (self.levels - 1 - level) & 1:
                start, stop = (int(self.zeros[level] + x) for x in ones)
            else:
                start, stop = int(start - ones[0]), int(stop - ones[1])
        return start, stop

    def count(self, symbol: int, start: int = 0, stop: int | None = None) -> int:
        """How often ``symbol`` occurs in [start, stop)."""
        if symbol < 0 or symbol >> self.levels:
            return 0
        stop = self.n if stop is None else min(stop, self.n)
        first, last = self._range(symbol, min(start, stop), stop)
        return last - first

    def occurrences(self, symbol: int) -> np.ndarray:
        """All positions of ``symbol``, ascending: select, walked up from the last plane."""
        if symbol < 0 or symbol >> self.levels:
            return np.zeros(0, dtype=np.int64)
        at = np.arange(*self._range(symbol, 0, self.n), dtype=np.int64)
        for level in range(self.levels - 1, -1, -1):
            one = bool(symbol >> (self.levels - 1 - level) & 1)
            at = self._select(level, at - self.zeros[level] if one else at, one)
        return at

    def _select(self, level: int, nth: np.ndarray, one: bool) -> np.ndarray:
        """Positions of the nth (from 0) ones or zeros of a plane."""
        per = BLOCK * 8
        starts = self.counts[level]
        if not one:
            starts = np.arange(len(starts), dtype=np.int64) * per - starts
        block = np.searchsorted(starts, nth, side="right") - 1
        found = np.zeros(len(nth), dtype=np.int64)
        for b in np.unique(block):
            mine = block == b
            bits = np.unpackbits(self.planes[level][b * BLOCK:(b + 1) * BLOCK])
            places = np.flatnonzero(bits if one else bits == 0)
            found[mine] = b * per + places[nth[mine] - starts[b]]
        return found

    def ids(self) -> np.ndarray:
        """The whole sequence, by undoing the partings from the last plane up."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        now = np.zeros(self.n, dtype=kind)
        for level in range(self.levels - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n).view(bool)
            up = np.empty_like(now)
            zeros = self.zeros[level]
            up[np.flatnonzero(~bit)] = now[:zeros]
            up[np.flatnonzero(bit)] = now[zeros:] | kind(1 << (self.levels - 1 - level))
            now = up
        return now


def _block_counts(plane: np.ndarray) -> np.ndarray:
    ones = np.bitwise_count(plane.view(np.uint64)).astype(np.int64)
    per = ones.reshape(-1, BLOCK // 8).sum(axis=1)
    return np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(per)))


def write_entry(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    matrix = WaveletMatrix.build(ids)
    head = MAGIC + struct.pack("<IIQ", matrix.levels, len(doc_ids), matrix.n)
    keys = np.array([NULL_ID if d is None else d for d in doc_ids], dtype="<i8")
    parts = [head, keys.tobytes(), np.array(lengths, dtype="<i8").tobytes(),
             np.array(matrix.zeros, dtype="<u8").tobytes(), *(p.tobytes() for p in matrix.planes)]
    return b"".join(parts)


def read_entry(entry: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """(document ids, lengths, matrix) of one entry."""
    if entry[:4] != MAGIC:
        raise ValueError("not a wavelet matrix entry")
    levels, docs, n = struct.unpack_from("<IIQ", entry, 4)
    at = 20
    keys = np.frombuffer(entry, "<i8", docs, at)
    lengths = np.frombuffer(entry, "<i8", docs, at + 8 * docs)
    at += 16 * docs
    zeros = np.frombuffer(entry, "<u8", levels, at).astype(np.int64).tolist()
    at += 8 * levels
    width = -(-((n + 7) // 8) // BLOCK) * BLOCK
    planes = [np.frombuffer(entry, np.uint8, width, at + i * width) for i in range(levels)]
    return [None if k == NULL_ID else int(k) for k in keys], lengths, WaveletMatrix(n, planes, zeros)


def _encode_partition(batches: Iterator[pa.RecordBatch], path: str, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    encoder = worker_encoder(path, keeps_space=True)
    block = TaskContext.get().partitionId()
    end = np.array([END_ID], dtype="<u4").tobytes()
    keys, lengths, parts, held, entries = [], [], [], 0, 0

    def entry():
        ids = np.frombuffer(b"".join(parts), dtype="<u4")
        return pa.RecordBatch.from_pydict({
            "block": pa.array([block], pa.int32()), "entry": pa.array([entries], pa.int32()),
            "n_docs": pa.array([len(keys)], pa.int64()), "n_tokens": pa.array([held], pa.int64()),
            "matrix": pa.array([write_entry(keys, lengths, ids)], pa.binary())})

    for batch in batches:
        for key, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
            tokens = len(ids) // 4 + 1
            if keys and held + tokens > shard_tokens:
                yield entry()
                keys, lengths, parts, held, entries = [], [], [], 0, entries + 1
            keys.append(key)
            lengths.append(tokens)
            parts += (ids, end)
            held += tokens
    if keys:
        yield entry()


def write_token_shards(docs: DataFrame, tokenizer_path: str, folder: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` (doc_id long, text string) into wavelet matrix entries under ``folder``.

    Documents are dealt by ranges of doc_id (equal ids by a hash of the text,
    so no id is a bottleneck) and sorted within; entries hold up to
    ``shard_tokens`` tokens, or one longer document. A task holds one entry.
    Null text counts as empty: the end id alone. A null id comes first. Rows
    with equal id and text stay separate rows, in order of text.
    """
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = dealt.withColumn("tie", F.xxhash64("text"))
    dealt = dealt.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    schema = "block int, entry int, n_docs long, n_tokens long, matrix binary"
    entries = dealt.select("doc_id", "text").mapInArrow(
        lambda batches: _encode_partition(batches, tokenizer_path, shard_tokens), schema)
    entries.write.option("compression", "zstd").parquet(folder)


def _decode_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, number, entry in zip(*(batch.column(c).to_pylist() for c in ("block", "entry", "matrix"))):
            keys, lengths, matrix = read_entry(entry)
            ids = matrix.ids().astype("<u4")
            stops = np.cumsum(lengths)
            starts = stops - lengths
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
            n = len(keys)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block] * n, pa.int32()), "entry": pa.array([number] * n, pa.int32()),
                "row": pa.array(range(n), pa.int64()),
                "doc_id": pa.array(keys, pa.int64()), "n_tokens": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64())})


def read_documents(entries: DataFrame) -> DataFrame:
    """One row per document, from the entries alone: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, over all entries.
    """
    schema = "block int, entry int, row long, doc_id long, n_tokens long, ids_crc32 long"
    found = entries.select("block", "entry", "matrix").mapInArrow(_decode_partition, schema)
    sizes = entries.select("block", "entry", "n_tokens")
    ahead = totals_before(sizes, "block", "entry", "n_tokens", "ahead").select("block", "entry", "ahead")
    inside = Window.partitionBy("block", "entry").orderBy("row")
    return found.join(ahead, ["block", "entry"]).select(
        "doc_id",
        (F.col("ahead") + F.sum("n_tokens").over(inside) - F.col("n_tokens")).alias("start"),
        "n_tokens", "ids_crc32")


def occurrences(entries: DataFrame, symbol: int) -> DataFrame:
    """Every place of one id: block, entry, position in the entry. Planes only are read."""
    def find(batches):
        for batch in batches:
            for block, number, entry in zip(*(batch.column(c).to_pylist() for c in ("block", "entry", "matrix"))):
                at = read_entry(entry)[2].occurrences(symbol)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block] * len(at), pa.int32()),
                    "entry": pa.array([number] * len(at), pa.int32()), "position": pa.array(at, pa.int64())})

    return entries.select("block", "entry", "matrix").mapInArrow(find, "block int, entry int, position long")


def token_shards(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write ``docs`` as token shards in a fresh shared folder and read every document back."""
    spark = docs.sparkSession
    folder = work_dir(spark, "token-shards")
    write_token_shards(docs, tokenizer_path, folder)
    return read_documents(spark.read.parquet(folder))

"""Near copies by SimHash: a byte-position inverted index with count filtering.

A fingerprint is 64 bits, read as eight bytes. Fingerprints that differ in at
most three bits differ in at most three bytes, so at least ``LEAST_SHARED`` of
the eight positional bytes agree. Pairs that meet in the index get a tally of
the positional bytes they share; those that reach the guaranteed minimum are
verified on their bits.

One position alone lists 1/256 of all fingerprints, and pairs would grow with
the square of the corpus. Of five shared positions three lie in one half of the
fingerprint, so the lists are kept by three positions of a half (eight lists a
fingerprint). A list longer than ``LONG`` is kept by five positions instead:
two of the five other positions are shared as well. No pair is lost in either.
Lists are compared tile by tile, and a tile gives the least edges that connect
what it links, not all its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import smallest_reachable, stage
from lakelayer.llm.tiles import by_tile, local_roots, pairs_in_groups, tiled, whole_groups

MOST_BITS = 3
LEAST_SHARED = 8 - MOST_BITS
WORDS = 3
SEED = 42
LONG = 2048
PIECE_BYTES = 1 << 20
BLANK = re.compile(rb"[\x20\x09-\x0d]")

# Three positions of one half, and those with two more positions each.
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
FIVES = [[tuple(sorted(t + two)) for two in combinations(sorted(set(range(8)) - set(t)), 2)] for t in TRIPLES]


def mask(positions: tuple[int, ...]) -> int:
    """The bytes at these positions, as a signed 64-bit mask."""
    return int(np.uint64(sum(0xFF << (8 * p) for p in positions)).astype(np.int64))


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` cut at white space, each piece of ``PIECE_BYTES`` or up to the next white space after that."""
    at = 0
    while at < len(data):
        cut = BLANK.search(data, at + PIECE_BYTES)
        stop = cut.start() if cut else len(data)
        yield data[at:stop]
        at = stop


def shingle_hashes(text: str) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, repeats included; fewer words are one shingle, none give nothing."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words: list[bytes] = []
    total = 0
    for piece in _pieces(text.encode().lower()):  # bytes.lower changes A-Z alone
        words = words[1 - WORDS:] + piece.split()
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
        hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
        total += len(hashes)
        yield hashes
    if not total and words:
        yield np.array([digest(b" ".join(words), SEED)], np.uint64)


def fingerprint(text: str) -> int:
    """Bit by bit what more than half of the shingles' hashes have, as a signed number; 0 without words."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text):
        for part in np.split(hashes, range(1 << 16, len(hashes), 1 << 16)):
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            total += len(part)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(text.as_py() or "") for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "print"])


def index(prints: DataFrame, long: int = LONG) -> DataFrame:
    """Inverted lists of distinct fingerprints: positions, bytes, print.

    ``positions`` numbers the triples, then for each triple its sets of five.
    """
    triples = F.array(*[F.lit(mask(t)) for t in TRIPLES])
    short = prints.select("print", F.posexplode(triples).alias("positions", "mask"))
    short = short.select("positions", F.col("print").bitwiseAND(F.col("mask")).alias("bytes"), "print")
    full = short.groupBy("positions", "bytes").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long)
    kept = short.join(full, ["positions", "bytes"], "left")
    fives = F.array(*[F.array(*[F.lit(mask(f)) for f in own]) for own in FIVES])
    narrow = kept.where("n is not null").select("print", "positions", F.posexplode(fives[F.col("positions")]).alias("two", "mask"))
    narrow = narrow.select((F.col("positions") * len(FIVES[0]) + F.col("two") + len(TRIPLES)).alias("positions"),
                           F.col("print").bitwiseAND(F.col("mask")).alias("bytes"), "print")
    return kept.where("n is null").select("positions", "bytes", "print").union(narrow)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) that connect what a pair of tiles links."""
    for rows, starts in whole_groups(batches, ["positions", "bytes"]):
        prints = rows.column("print").to_numpy()
        places = prints.astype("<i8").view(np.uint8).reshape(-1, 8)
        own, low, high = (rows.column(c).to_numpy() for c in ("own", "low", "high"))
        for left, right in pairs_in_groups(starts, own, low == high):
            tally = np.count_nonzero(places[left] == places[right], axis=1)
            enough = tally >= LEAST_SHARED
            left, right = left[enough], right[enough]
            close = np.bitwise_count((prints[left] ^ prints[right]).view(np.uint64)) <= MOST_BITS
            left, right = left[close], right[close]
            if len(left):
                used, place = np.unique(np.concatenate((left, right)), return_inverse=True)
                root = local_roots(len(used), place[:len(left)], place[len(left):])
                moved = root != np.arange(len(used))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints[used[moved]]), pa.array(prints[used[root[moved]]])], ["a", "b"])


def links(prints: DataFrame, long: int = LONG) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, enough to connect all that link."""
    keys = ["positions", "bytes"]
    lists = by_tile(tiled(index(prints, long), keys, "print"), keys, "print")
    return lists.mapInArrow(_linked, "a long, b long")


def fingerprint_groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links, the row's own
    included; documents of equal fingerprints reach each other. Null and empty
    texts, and texts of white space, have fingerprint zero and link like any
    other. Null ids count only where nothing else is reachable. Repeated rows
    stay repeated. Other columns are not read. Texts are read whole, long ones
    piece by piece.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stage(rows.mapInArrow(_fingerprints, "doc_id long, print long"), "simhash-prints")
    classes = stage(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-classes")
    groups = smallest_reachable(stage(links(classes.select("print")), "simhash-links"), "simhash-components")
    classes = classes.join(groups.withColumnRenamed("node", "print"), "print", "left")
    classes = classes.withColumn("root", F.coalesce("root", "print"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "root").select("print", "component_id")
    return rows.join(classes, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")

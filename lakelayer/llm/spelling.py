"""Spelling variants: words one edit apart, by dense prefix-suffix tiling.

Two words differ by one inserted, deleted or replaced code point exactly if
their common prefix and common suffix together reach the longer word's length
less one. Words are rows of padded code-point matrices (all letters lie below
U+0100, so a code point is one byte); blocks of rows are compared pair by pair,
prefixes on the words and suffixes on the reversed words.

Only blocks that can hold such a pair are compared. The edit's place in the
longer word lies in one of ``PARTS`` equal stretches; before and after the
stretch both words are equal. Each word is therefore listed once for each
stretch and for each length the longer word may have (its own or one more),
under what stands before and after the stretch. A pair counts in the stretch
that holds the end of its common prefix, so it counts once. Lists longer than
a tile are compared as pairs of tiles.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import stage
from lakelayer.llm.tiles import by_tile, pairs_in_groups, tiled, whole_groups

# What a run is, and which runs lose a code point.
LETTERS = re.compile(rb"[a-z\xc0-\xff]+")
SLIP_EVERY = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3

PARTS = 4  # at most LEAST_LENGTH, so that no stretch is empty
WORDS_HELD = 300_000  # distinct words a task counts before it hands them on
PIECE_BYTES = 1 << 20
CELLS = 8_000_000  # code points of a matrix
LISTS = ["list", "span", "part"]


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """``data`` cut at blanks, each piece of ``size`` bytes or up to the next blank after that."""
    at = 0
    while at < len(data):
        stop = data.find(b" ", at + size)
        stop = len(data) if stop < 0 else stop
        yield data[at:stop]
        at = stop


def text_words(doc_id: str, text: str) -> Iterator[tuple[bytes, int]]:
    """(word in Latin-1, its count) of one text, runs with a slip already shortened."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    runs: Counter[bytes] = Counter()
    # Characters past U+00FF become question marks; bytes.lower changes A-Z alone.
    for piece in pieces(text.encode("latin-1", "replace").lower()):
        runs.update(LETTERS.findall(piece))
    for run, times in runs.items():
        if len(run) >= LEAST_LENGTH:
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
            if h % SLIP_EVERY == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= LEAST_LENGTH:
                yield run, times


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def counts() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("id"), batch.column("text")):
            for word, times in text_words(doc_id.as_py(), text.as_py() or ""):
                held[word] += times
            if len(held) > WORDS_HELD:
                yield counts()
                held.clear()
    yield counts()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that stand at least ``LEAST_COUNT`` times in all texts together."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counts = rows.mapInArrow(_counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def listed(words: DataFrame) -> DataFrame:
    """Every word under each list that may hold a word one edit away: list, span, part, word, n.

    ``span`` is the length of the longer word, ``part`` the stretch that holds the edit.
    """
    rows = words.withColumn("span", F.explode(F.array(F.length("word"), F.length("word") + 1)))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    begin = F.floor(F.col("span") * F.col("part") / PARTS).cast("int")
    end = F.floor(F.col("span") * (F.col("part") + 1) / PARTS).cast("int")
    before = F.substring("word", F.lit(1), begin)
    after = F.right("word", F.col("span") - end)
    return rows.withColumn("list", F.xxhash64("span", "part", before, after)).select(*LISTS, "word", "n")


def padded(words: list[bytes]) -> np.ndarray:
    """The words' code points, one row each, padded with zeros."""
    width = max(map(len, words))
    return np.array(words, dtype=f"S{width}").view(np.uint8).reshape(len(words), width)


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading code points the rows of two matrices share; the whole width where they are equal."""
    other = a != b
    return np.where(other.any(axis=1), other.argmax(axis=1), a.shape[1])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs one edit apart, both ways round: word, near, near_n."""
    for rows, starts in whole_groups(batches, LISTS):
        words = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
        length = np.fromiter(map(len, words), np.int64, len(words))
        span, part = (rows.column(c).to_numpy().astype(np.int64) for c in ("span", "part"))
        own, low, high = (rows.column(c).to_numpy() for c in ("own", "low", "high"))
        for left, right in pairs_in_groups(starts, own, low == high):
            useful = np.maximum(length[left], length[right]) == span[left]
            left, right = left[useful], right[useful]
            by = np.argsort(span[left], kind="stable")  # so that a block is as wide as its words
            left, right = left[by], right[by]
            at = 0
            while at < len(left):
                most = max(1, int(CELLS // span[left[min(len(left), at + CELLS // 64) - 1]]))
                a, b = left[at:at + most], right[at:at + most]
                at += len(a)
                near = single_edits(words, length, a, b, span, part)
                if near.any():
                    a, b = a[near], b[near]
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("word").take(np.concatenate((a, b))).combine_chunks(),
                         rows.column("word").take(np.concatenate((b, a))).combine_chunks(),
                         rows.column("n").take(np.concatenate((b, a))).combine_chunks()], ["word", "near", "near_n"])


def single_edits(words: list[bytes], length: np.ndarray, a: np.ndarray, b: np.ndarray,
                 span: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Which pairs (a, b) of rows are one edit apart, and have it in their list's stretch."""
    used, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    own = [words[i] for i in used.tolist()]
    left, right = place[:len(a)], place[len(a):]
    forward, backward = padded(own), padded([w[::-1] for w in own])
    shorter = np.minimum(length[a], length[b])
    prefix = np.minimum(common_prefix(forward[left], forward[right]), shorter)
    suffix = np.minimum(common_prefix(backward[left], backward[right]), shorter)
    begin, end = span[a] * part[a] // PARTS, span[a] * (part[a] + 1) // PARTS
    return (prefix + suffix >= span[a] - 1) & (a != b) & (begin <= prefix) & (prefix < end)


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, and ``best``: its near word of largest n, ties by code points, with n."""
    lists = by_tile(tiled(listed(words), LISTS, "word"), LISTS, "word")
    pairs = lists.mapInArrow(_compared, "word string, near string, near_n long")
    return pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for ``links`` (word, root): links followed to their ends, in doubling steps.

    A link leads to a word that is at least twice as frequent, so there are no
    rings, and few steps.
    """
    now = stage(links, "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("ahead"))
        moved = stage(now.join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "spelling-roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def group_variants(docs: DataFrame) -> DataFrame:
    """Words of ``docs`` (doc_id, text) with their variants: word, form, root, n, n_near, form_n.

    A word's form is its near word of largest n (ties: smallest in code-point
    order) if that n is at least twice the word's own, else null; its root is
    the last form that forms lead to, or the word itself. Null and empty texts
    have no words; a null doc_id counts as an empty one in the slip's hash.
    Repeated rows count as often as they stand. Other columns are not read.
    Texts are read whole, long ones piece by piece.
    """
    words = stage(word_counts(docs), "spelling-words")
    best = F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best"))
    found = words.join(near_words(words), "word", "left").withColumn("best", best)
    found = stage(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("form"),
        (-F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(found.where("form is not null").select("word", F.col("form").alias("root")))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

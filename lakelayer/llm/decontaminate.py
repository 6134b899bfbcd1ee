"""Benchmark decontamination with a broadcast hash set of normalised test n-grams.

All in DataFrame functions. Texts are lower-cased (A-Z only) and cut into
words. Every run of ``span`` consecutive words of a benchmark item is a window
(an item of fewer words is one window). The hashes of all windows are a small
table; documents stream their own window hashes past it. A hit on a hash is
verified word by word before it counts. Documents of which hit words are a large
share are dropped, or the words hit are removed.

Hashes of a document's windows are built by doubling: runs of 2, 4 and 8 words
come from two shorter runs each, so a window costs four hash steps, not 13.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import spare_name, stage

SPAN = 13
# Characters that part words: ASCII other than 0-9 and a-z, after lower-casing.
PARTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A word in a text that is not lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MOST_BROADCAST = 4_000_000  # windows; at 8 bytes of hash a broadcast stays under 100 MB


def normal(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """Words of a text; no element for null or empty text."""
    return F.array_remove(F.split(normal(text), PARTS), "")


def with_run_hashes(df: DataFrame, hashes: str, lengths: list[int]) -> DataFrame:
    """Add ``run<n>`` for every n of ``lengths``: hashes of all runs of n neighbours in array ``hashes``.

    Built from the runs of powers of two, one column each, so that every array
    is computed once. A run's hash depends on its elements alone, so equal runs
    have equal hashes anywhere. Fewer than n elements give an empty array.
    """
    def joined(left: str, right: str, skip: int) -> Column:
        # Each run of the left column with the run that starts ``skip`` elements later.
        count = F.greatest(F.size(right) - skip, F.lit(0))
        return F.zip_with(F.slice(left, 1, count), F.slice(right, skip + 1, count), lambda a, b: F.xxhash64(a, b))

    columns = list(df.columns)
    built = {1: hashes}
    size = 1
    while size * 2 <= max(lengths):
        name = f"power{size * 2}"
        df = df.withColumn(name, joined(built[size], built[size], size))
        built[size * 2], size = name, size * 2
    for n in lengths:
        parts = [p for p in sorted(built, reverse=True) if n & p]
        own, have = built[parts[0]], parts[0]
        for part in parts[1:]:
            name = f"run{n}" if have + part == n else f"run{n}_{have + part}"
            df = df.withColumn(name, joined(own, built[part], have))
            own, have = name, have + part
        if len(parts) == 1:
            df = df.withColumn(f"run{n}", F.col(own))
    return df.select(*columns, *(f"run{n}" for n in lengths))


def item_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per distinct window: hash, length, words, items (ids as strings, sorted)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("length", F.least(F.lit(span), F.size("words")))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    each = items.select("item", "length", "words", F.explode(starts).alias("at"))
    each = each.select("item", "length", F.slice("words", F.col("at"), F.col("length")).alias("words"))
    return each.groupBy("length", "words").agg(F.collect_set("item").alias("items"))


def with_hash(windows: DataFrame, lengths: list[int]) -> DataFrame:
    hashed = with_run_hashes(windows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))), "hashes", lengths)
    own = F.coalesce(*(F.when(F.col("length") == n, F.get(f"run{n}", F.lit(0))) for n in lengths))
    return hashed.withColumn("hash", own).select(*windows.columns, "hash")


def scan(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, key (a hash of both), n_words, n_hit, items, covered (word intervals hit), contaminated.

    ``n_hit``: words inside any occurrence of a window; ``items``: ids of the
    items with occurring windows, sorted as strings; ``contaminated``: at least
    one word hit and n_hit a twentieth of the words or more. Null and empty
    texts have no words. Repeated rows get a row each. An empty benchmark
    leaves every document clean. The window table is broadcast only if it has
    at most ``most_broadcast`` windows; beyond, Spark shuffles by hash.
    """
    windows = stage(item_windows(benchmark, span), "windows")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # at most ``span`` numbers
    small = windows.count() <= most_broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    if not lengths:
        return rows.select("doc_id", "key", F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
                           F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"),
                           F.array().cast("array<struct<start:int,stop:int>>").alias("covered"),
                           F.lit(False).alias("contaminated"))
    windows = with_hash(windows, lengths)

    hashed = rows.select("key", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
    hashed = with_run_hashes(hashed, "hashes", lengths)
    # The outer form keeps Spark from filtering on the arrays' sizes below the columns that
    # build them, which would spell out every column in terms of the text again.
    by_length = [hashed.select("key", F.lit(n).alias("length"), F.posexplode_outer(f"run{n}").alias("at", "hash")) for n in lengths]
    runs = reduce(DataFrame.union, by_length)
    keys = windows.select("length", "hash").distinct()
    met = runs.join(F.broadcast(keys) if small else keys, ["length", "hash"])
    # Equal rows give equal hits; a key's hits are at most its text's windows.
    hits = met.distinct().join(windows, ["length", "hash"]).groupBy("key").agg(
        F.collect_list(F.struct("at", "length", "words", "items")).alias("hits"))

    found = rows.join(hits, "key", "left").withColumn("all_words", words_of(F.col("text")))
    # Verify: the document's own words at the place of a hit are the window's words.
    true_hits = F.filter("hits", lambda h: F.slice("all_words", h["at"] + 1, h["length"]) == h["words"])
    found = found.withColumn("true_hits", F.when(F.col("hits").isNotNull(), true_hits))
    spans = F.array_sort(F.transform("true_hits", lambda h: F.struct(
        h["at"].alias("start"), (h["at"] + h["length"]).cast("int").alias("stop"))))
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def grow(done: Column, own: Column) -> Column:
        last = F.element_at(done, -1)
        merged = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["stop"], own["stop"]).alias("stop"))))
        return F.when((F.size(done) > 0) & (own["start"] <= F.get(done, F.size(done) - 1)["stop"]), merged).otherwise(
            F.concat(done, F.array(own)))

    found = found.withColumn("covered", F.when(F.size("true_hits") > 0, F.aggregate(spans, empty, grow)).otherwise(empty))
    hit = F.aggregate("covered", F.lit(0).cast("long"), lambda n, c: n + (c["stop"] - c["start"]))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("true_hits", lambda h: h["items"]))))
    found = found.select(
        "doc_id", "key", F.size("all_words").cast("long").alias("n_words"), hit.alias("n_hit"),
        F.coalesce(items, F.array().cast("array<string>")).alias("items"), "covered")
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns unchanged."""
    key = spare_name(docs, "key")
    dirty = scan(docs.select("doc_id", "text"), benchmark, span).where("contaminated").select(F.col("key").alias(key))
    rows = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), "text"))
    return rows.join(dirty.distinct(), key, "left_anti").drop(key)


def without_spans(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` without the words hit by a benchmark window; all other columns unchanged.

    Each run of hit words goes with what stands before its words, back to the
    word before the run; the rest of the text stays as it is. Null texts and
    texts without hits stay. Equal rows get equal texts.
    """
    key, covered = spare_name(docs, "key"), spare_name(docs, "covered")
    hit = scan(docs.select("doc_id", "text"), benchmark, span).where(F.size("covered") > 0)
    hit = hit.groupBy(F.col("key").alias(key)).agg(F.first("covered").alias(covered))
    rows = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), "text")).join(hit, key, "left")
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    gaps = F.split("text", WORD, -1)
    # Every word with what stands before it; the runs between hit runs are kept.
    units = F.zip_with(F.slice(gaps, 1, F.size(words)), words, lambda gap, word: F.concat(gap, word))
    starts = F.concat(F.array(F.lit(0)), F.transform(covered, lambda c: c["stop"]))
    stops = F.concat(F.transform(covered, lambda c: c["start"]), F.array(F.size(words)))
    kept = F.zip_with(starts, stops, lambda a, b: F.array_join(F.slice(units, a + 1, b - a), ""))
    text = F.concat(F.array_join(kept, ""), F.element_at(gaps, -1))
    return rows.withColumn("text", F.when(F.col(covered).isNull(), F.col("text")).otherwise(text)).select(*docs.columns)

"""n-gram Jaccard self-join by a size-aware heavy-light join; connected groups of near copies.

A document's set is its distinct word shingles (64-bit hashes). Two sets link
when den * |a & b| >= num * |a | b|, that is when they share at least
``needed(|a|, |b|)`` elements (Deng, Tao and Li, 2018, for the split):

* Light sets, up to a boundary size, enumerate all subsets of exactly the needed
  size, for every partner size. Sets that meet in a subset link by
  construction, so a bucket gives a star, not all pairs.
* Heavy sets are scanned in inverted lists. Only the first elements of a set in
  a global order, rare ones first, go into lists: a pair that links must meet
  there at least ``MEET`` times. The order comes from a sample; it changes the
  cost, never the result. Pairs that meet are tested on all list entries of both
  sets, and those that may still link exactly, on whole sets.

The boundary has the least estimated cost, from set sizes in the sample.

Equal sets are one class from the start, so a group of copies costs one set. A
list longer than ``SHORT`` is not paired up: all its members are tested
against the list's most central member, and only members that this leaves in
different components are paired, exactly. Groups of near copies therefore cost
their size, not its square, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import handed_back, smallest_reachable, spare_name, stage
from lakelayer.llm.words import mix, runs, slices, word_hashes

MEET = 2
SHORT = 32
SAMPLE_ROWS = 20_000  # at least; else a sixteenth of the rows
SAMPLE_SHARE = 16
MOST_FREQUENT = 200_000
LONG_COUNT = 8  # in the sample: lists of such elements are taken for long from the start
LARGEST_LIGHT = 40
SLICE_BYTES = 4_000_000  # of text that a task holds as words


def needed(a: int, b: int, num: int, den: int) -> int:
    """Least intersection of linked sets of sizes a and b."""
    return -(-num * (a + b) // (num + den))


def partner_sizes(n: int, num: int, den: int) -> range:
    return range(-(-num * n // den), den * n // num + 1)


def subsets_of(n: int, num: int, den: int, largest: int) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, subset size) that a light set of size n enumerates."""
    out = []
    for m in partner_sizes(n, num, den):
        low, high = min(m, n), max(m, n)
        size = needed(low, high, num, den)
        # Sets of one size that need all elements are equal, hence one class.
        if 0 < m and high <= largest and size <= low and not (low == high == size):
            out.append((low, high, size))
    return out


def boundary(sizes: dict[int, int], num: int, den: int, scan_cost: float = 3.0) -> int:
    """Largest size of a light set, by least cost of subsets plus list entries over the sampled sizes."""
    least = next(n for n in range(1, 10 * den) if -(-num * n // den) >= MEET)

    def cost(x: int) -> float:
        light = sum(c * comb(n, s) for n, c in sizes.items() if n <= x for _, _, s in subsets_of(n, num, den, x))
        heavy = sum(c * (n - -(-num * n // den) + MEET) for n, c in sizes.items() if n >= -(-num * (x + 1) // den))
        return light + scan_cost * heavy

    return min(range(least, LARGEST_LIGHT + 1), key=cost)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Each text's set, ascending; fewer than ``words`` words are one shingle, no words an empty set."""
    for part in slices(texts, SLICE_BYTES):
        hashes, offsets = word_hashes(part)
        for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
            own = hashes[a:b]
            yield np.unique(runs(own, min(words, len(own)))) if len(own) else own


def _sampled(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Per batch: distinct shingles with counts (kind 0), set sizes with counts (kind 1)."""
    for batch in batches:
        for part in slices(batch.column("text"), SLICE_BYTES):
            sets = list(shingle_sets(part, words))
            sizes = np.array(list(map(len, sets)), dtype=np.int64)
            for kind, values in ((0, np.concatenate(sets).view(np.int64)), (1, sizes)):
                value, count = np.unique(values, return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "kind": pa.array(np.full(len(value), kind), pa.int32()),
                    "value": pa.array(value, pa.int64()), "n": pa.array(count, pa.int64())})


def sample_order(rows: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
    """(frequent shingles ascending, their counts, set sizes) of a bounded share of the rows."""
    total = max(1, rows.count())
    share = max(SAMPLE_ROWS, total // SAMPLE_SHARE)
    limit = min(2**63 - 1, 2**64 * share // total - 2**63)
    picked = rows.where(F.xxhash64("key") <= F.lit(limit)).select("text")
    counts = picked.mapInArrow(lambda b: handed_back(_sampled(b, words)), "kind int, value long, n long")
    counts = stage(counts.groupBy("kind", "value").agg(F.sum("n").alias("n")), "jaccard-sample")
    top = counts.where("kind = 0 and n >= 3").orderBy(F.desc("n"), "value").limit(MOST_FREQUENT).toArrow()
    value = top.column("value").to_numpy().view(np.uint64)
    by = np.argsort(value)
    # Sizes beyond the lightest matter in sum only, and few are small: a bounded collection.
    small = counts.where(f"kind = 1 and value > 0 and value <= {4 * LARGEST_LIGHT}").collect()
    return value[by], top.column("n").to_numpy()[by], {r["value"]: r["n"] for r in small}


def _described(batches: Iterator[pa.RecordBatch], words: int, num: int, den: int, light: int,
               frequent: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per document its class, set size, and, once per class and task, its list entries and subset keys."""
    seen: set[int] = set()
    least_heavy = -(-num * (light + 1) // den)
    for batch in batches:
        out: dict[str, list] = {"cls": [], "n": [], "entries": [], "long_from": [], "subsets": [], "sides": []}
        for own in shingle_sets(batch.column("text"), words):
            n = len(own)
            cls = class_of(own)
            entries, long_from, subsets, sides = None, None, None, None
            if n and cls not in seen:
                if len(seen) < 1_000_000:
                    seen.add(cls)
                if n >= least_heavy:
                    entries, long_from = list_entries(own, n - -(-num * n // den) + MEET, frequent, counts)
                if n <= light:
                    subsets, sides = subset_keys(own, num, den, light)
            for name, value in zip(out, (cls if n else None, n, entries, long_from, subsets, sides)):
                out[name].append(value)
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        arrays = [pa.array(v, k) for v, k in zip(out.values(), kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *arrays], ["doc_id", "key", *out])


def class_of(own: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def list_entries(own: np.ndarray, length: int, frequent: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The first ``length`` elements, rare before frequent, and where those with long lists begin."""
    count = np.zeros(len(own), dtype=np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        known = frequent[at] == own
        count[known] = counts[at[known]]
    first = np.argsort(count, kind="stable")[:length]
    return own[first].view(np.int64), int(np.searchsorted(count[first], LONG_COUNT))


def subset_keys(own: np.ndarray, num: int, den: int, light: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all subsets of the needed sizes, with the side (0 smaller set, 1 larger) the set takes in each."""
    keys, sides = [], []
    for low, high, size in subsets_of(len(own), num, den, light):
        chosen = np.array(list(combinations(own.tolist(), size)), dtype=np.uint64)
        key = np.full(len(chosen), low * 1000 + high, dtype=np.uint64)
        for column in chosen.T:
            key = mix(key, column)
        for side in {0, 1} if low == high else {int(len(own) == high)}:
            keys.append(key.view(np.int64))
            sides.append(np.full(len(key), side, dtype=np.int32))
    return (np.concatenate(keys), np.concatenate(sides)) if keys else (None, None)


def _scan_lists(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Lists in order of (element, class): short ones give their pairs, long ones their rows.

    Holds one batch and at most SHORT rows of an unfinished list.
    """
    names = ["element", "cls", "n", "at"]
    held = [np.zeros(0, dtype=np.int64)] * 4
    long_element = None
    for batch in _with_last(batches):
        rows = held if batch is None else [
            np.concatenate((h, batch.column(c).to_numpy().astype(np.int64))) for h, c in zip(held, names)]
        element, cls, n, at = rows
        if not len(element):
            continue
        fresh = np.concatenate(([True], (element[1:] != element[:-1]) | (cls[1:] != cls[:-1])))
        element, cls, n, at = (x[fresh] for x in (element, cls, n, at))
        starts = np.flatnonzero(np.concatenate(([True], element[1:] != element[:-1])))
        ends = np.append(starts[1:], len(element))
        is_long = (ends - starts > SHORT) | (element[starts] == long_element if long_element is not None else False)
        last = 0
        if batch is not None:  # the last list may go on
            last = 1
            if is_long[-1]:
                long_element, last = int(element[-1]), 0
        done = slice(0, len(starts) - last)
        out_long = np.concatenate([np.arange(a, b) for a, b in zip(starts[done][is_long[done]], ends[done][is_long[done]])] or
                                  [np.zeros(0, np.int64)])
        left, right = [], []
        sizes = (ends - starts)[done]
        for m in np.unique(sizes[~is_long[done]]).tolist():
            if m > 1:
                begin = starts[done][~is_long[done] & (sizes == m)]
                i, j = np.triu_indices(m, 1)
                left.append((begin[:, None] + i).ravel())
                right.append((begin[:, None] + j).ravel())
        a = np.concatenate(left) if left else np.zeros(0, np.int64)
        b = np.concatenate(right) if right else np.zeros(0, np.int64)
        fits = (den * np.minimum(n[a], n[b]) >= num * np.maximum(n[a], n[b])) & (cls[a] != cls[b])
        a, b = a[fits], b[fits]
        zeros = np.zeros(len(out_long), np.int64)
        yield pa.RecordBatch.from_pydict({
            "element": pa.array(np.concatenate((np.zeros(len(a), np.int64), element[out_long])), pa.int64()),
            "a": pa.array(np.concatenate((cls[a], cls[out_long])), pa.int64()),
            "b": pa.array(np.concatenate((cls[b], zeros)), pa.int64()),
            "na": pa.array(np.concatenate((n[a], n[out_long])), pa.int64()),
            "nb": pa.array(np.concatenate((n[b], zeros)), pa.int64()),
            "ta": pa.array(np.concatenate((at[a], at[out_long])), pa.int64()),
            "tb": pa.array(np.concatenate((at[b], zeros)), pa.int64()),
            "long": pa.array(np.arange(len(a) + len(out_long)) >= len(a))})
        keep = slice(starts[-1], None) if last else slice(0, 0)
        held = [element[keep], cls[keep], n[keep], at[keep]]


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _verified(batches: Iterator[pa.RecordBatch], words: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        sets = zip(shingle_sets(batch.column("text_a"), words), shingle_sets(batch.column("text_b"), words))
        for a, b in sets:
            both = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(den * both >= num * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(linked, pa.bool_()))


def may_link(na: str, nb: str, ta: str, tb: str, num: int, den: int) -> Column:
    """Whether sets of these sizes can link if their first common elements stand at ta and tb.

    What stands before the first common element is in one set only, so the
    sets share at most na - ta, and at most nb - tb. A row that fails is not
    its pair's first meeting, or the pair does not link.
    """
    least = F.expr(f"({num} * ({na} + {nb}) + {num + den - 1}) div {num + den}")
    return ((den * F.least(na, nb) >= num * F.greatest(na, nb))
            & (F.col(na) - F.col(ta) >= least) & (F.col(nb) - F.col(tb) >= least))


def link_groups(docs: DataFrame, words: int = 3, num: int = 9, den: int = 10) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, key, n_shingles, component_id.

    component_id: the smallest doc_id reachable over links, the row's own
    included. Null and empty texts have no shingles, link with nothing and keep
    their own id. Null ids count only where nothing else is reachable. Repeated
    rows are one class. ``key`` is a hash of id and text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    frequent, counts, sizes = sample_order(rows, words)
    light = boundary(sizes, num, den)

    schema = ("doc_id long, key long, cls long, n long, entries array<long>, long_from int, "
              "subsets array<long>, sides array<int>")
    described = stage(rows.mapInArrow(
        lambda b: handed_back(_described(b, words, num, den, light, frequent, counts)), schema), "jaccard-sets")

    # Light sets: members of a subset's bucket link to the least member of the other side.
    light_rows = described.where("subsets is not null").select(
        "cls", F.explode(F.arrays_zip("subsets", "sides")).alias("s")).select("cls", F.col("s.subsets").alias("subset"), "s.sides")
    least = light_rows.groupBy("subset").agg(
        F.min(F.when(F.col("sides") == 0, F.col("cls"))).alias("low"),
        F.min(F.when(F.col("sides") == 1, F.col("cls"))).alias("high")).where("low is not null and high is not null")
    other = F.when(F.col("sides") == 0, F.col("high")).otherwise(F.col("low"))
    light_edges = light_rows.join(least, "subset").select(F.col("cls").alias("a"), other.alias("b")).where("a <> b")

    # Heavy sets: inverted lists of rare elements are scanned in order of (element, class).
    entries = described.where("entries is not null").select(
        "cls", "n", "long_from", F.posexplode("entries").alias("at", "element"))
    listed = entries.where(F.col("at") < F.col("long_from")).select("element", "cls", "n", "at")
    listed = listed.repartition("element").sortWithinPartitions("element", "cls")
    met = stage(listed.mapInArrow(lambda b: handed_back(_scan_lists(b, num, den)),
                                  "element long, a long, b long, na long, nb long, ta long, tb long, long boolean"), "jaccard-lists")
    pairs = met.where("not long").groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("times"), F.min("ta").alias("ta"), F.min("tb").alias("tb"),
        F.first("na").alias("na"), F.first("nb").alias("nb"))
    pairs = pairs.where(may_link("na", "nb", "ta", "tb", num, den)).select("a", "b", "times")

    long_rows = met.where("long").select("element", F.col("a").alias("cls"), F.col("na").alias("n"), F.col("ta").alias("at")).union(
        entries.where(F.col("at") >= F.col("long_from")).select("element", "cls", "n", F.col("at").cast("long")))
    long_rows = stage(long_rows.distinct(), "jaccard-long")
    # A pair that meets in short lists only meets MEET times there. One that meets in long lists
    # too may first meet in a short one; both its sets then have rows in long lists.
    in_long = long_rows.select("cls").distinct()
    few = pairs.where(F.col("times") < MEET).join(in_long.withColumnRenamed("cls", "a"), "a", "left_semi").join(
        in_long.withColumnRenamed("cls", "b"), "b", "left_semi")
    pairs = pairs.where(F.col("times") >= MEET).select("a", "b").union(few.select("a", "b"))

    centre = long_rows.groupBy("element").agg(F.min(F.struct("at", "cls", "n")).alias("p"), F.count(F.lit(1)).alias("m"))
    centre = centre.where("m > 1").select("element", F.col("p.cls").alias("b"), F.col("p.n").alias("nb"), F.col("p.at").alias("tb"))
    tried = long_rows.withColumnsRenamed({"cls": "a", "n": "na", "at": "ta"}).join(centre, "element")
    tried = tried.where((F.col("a") != F.col("b")) & may_link("na", "nb", "ta", "tb", num, den))
    first = pairs.union(tried.select(F.least("a", "b"), F.greatest("a", "b"))).distinct()
    first = stage(first, "jaccard-pairs")

    edges = stage(light_edges.union(_linked(first, rows, described, words, num, den)), "jaccard-links")
    groups = smallest_reachable(edges)

    # Members of long lists that are still in different components are paired in full.
    own = long_rows.join(groups.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    own = stage(own, "jaccard-open")
    split = own.groupBy("element").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("element")
    open_rows = own.join(split, "element")
    a = open_rows.select("element", *(F.col(c).alias(f"{c}_a") for c in ("cls", "n", "at", "root")))
    b = open_rows.select("element", *(F.col(c).alias(f"{c}_b") for c in ("cls", "n", "at", "root")))
    rest = a.join(b, "element").where(
        (F.col("cls_a") < F.col("cls_b")) & (F.col("root_a") != F.col("root_b"))
        & may_link("n_a", "n_b", "at_a", "at_b", num, den))
    rest = rest.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    more = stage(_linked(stage(rest, "jaccard-rest"), rows, described, words, num, den), "jaccard-more")
    if more.count():
        groups = smallest_reachable(edges.union(more))

    found = described.select("doc_id", "key", "n", "cls").join(groups.withColumnRenamed("node", "cls"), "cls", "left")
    found = found.withColumn("root", F.coalesce("root", "cls"))
    smallest = found.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return found.join(smallest, "root", "left").select(
        "doc_id", "key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def _members(pairs: DataFrame) -> DataFrame:
    """The classes of pairs (a, b), each once."""
    return pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()


def _both(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """``pairs`` with the columns of ``table`` (one row for each cls) of either side, marked _a and _b."""
    for side in "ab":
        names = {c: side if c == "cls" else f"{c}_{side}" for c in table.columns}
        pairs = pairs.join(table.withColumnsRenamed(names), side)
    return pairs


def _likely(pairs: DataFrame, described: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that can link by the list entries of both sets.

    Entries are the first elements of a set in one order. What two sets share
    up to the end of the list that ends first is in both lists; beyond it they
    share no more than that set has left. A set of n has ceil(num * n / den) -
    MEET elements outside its list, so the lists must share the needed
    elements less the larger of these two numbers.
    """
    lists = described.where("entries is not null").join(_members(pairs), "cls", "left_semi")
    lists = stage(lists.groupBy("cls").agg(F.first("n").alias("n"), F.first("entries").alias("entries")), "jaccard-entries")
    least = F.expr(f"({num} * (n_a + n_b) + {num + den - 1}) div {num + den}")
    outside = F.expr(f"greatest(({num} * greatest(n_a, n_b) + {den - 1}) div {den} - {MEET}, 0)")
    return _both(pairs, lists).where(F.size(F.array_intersect("entries_a", "entries_b")) >= least - outside).select("a", "b")


def _linked(pairs: DataFrame, rows: DataFrame, described: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of heavy classes whose whole sets link; only likely pairs move their texts."""
    likely = stage(_likely(pairs, described, num, den), "jaccard-likely")
    holders = described.join(_members(likely), "cls", "left_semi").groupBy("cls").agg(F.min("key").alias("key"))
    texts = rows.select("key", "text").join(holders, "key").dropDuplicates(["cls"]).select("cls", "text")
    both = _both(likely, stage(texts, "jaccard-texts")).select("a", "b", "text_a", "text_b")
    return both.mapInArrow(lambda batches: handed_back(_verified(batches, words, num, den)), "a long, b long")


def one_per_group(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their group, all columns unchanged.

    Rows without shingles all stay. Of rows equal in id and text one stays.
    """
    key = spare_name(docs, "key")
    groups = link_groups(docs.select("doc_id", "text"), words, num, den)
    kept = groups.where("n_shingles = 0 or doc_id <=> component_id").groupBy("key").agg(F.max("n_shingles").alias("n"))
    kept = kept.select(F.col("key").alias(key), F.lit(True).alias(spare_name(docs, "kept")))
    rows = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), "text"))
    return rows.join(kept.select(key), key, "left_semi").dropDuplicates([key]).drop(key)

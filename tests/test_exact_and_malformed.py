"""Exact sums, mergeable distinct counts, and captured malformed lines."""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from lakelayer.functions.exprs import REASON_COL, exact_money_sum, money_partials, money_total
from lakelayer.operators.distinct import dense_ids, distinct_bitmaps, merge_bitmaps, merged_counts
from lakelayer.plans.medallion import LayerPaths, run_bronze, run_silver
from lakelayer.schemas import CORRUPT_RECORD, METADATA_COLUMNS, TRANSACTIONS
from lakelayer.session import work_dir
from lakelayer.sources.csv import read_typed_csv, write_lines
from lakelayer.sources.tables import read_table


def sums(df):
    direct = df.groupBy("g").agg(exact_money_sum("v").alias("s"))
    parts = df.groupBy("g", "h").agg(*money_partials("v", "p"))
    return [{r.g: r.s for r in x.collect()} for x in (direct, parts.groupBy("g").agg(money_total("p").alias("s")))]


def test_sums_do_not_depend_on_partitioning(spark):
    rng = random.Random(11)
    large = [rng.choice((-1, 1)) * rng.randrange(1, 9) * 10.0 ** rng.randrange(16, 23) for _ in range(400)]
    small = [rng.randrange(-10**6, 10**6) / 100 for _ in range(400)]
    rows = [("mixed", i % 7, v) for i, v in enumerate(large + small)]
    rows += [("cancel", i % 5, v) for i, v in enumerate([v for x in large for v in (x, -x)] + [5.25, 0.01])]
    rows += [("small", i % 3, v) for i, v in enumerate(small)] + [("nulls", 0, None), ("nulls", 1, None), ("some", 0, None), ("some", 1, 2.5)]
    want = {"mixed": float(sum(map(int, large))) + float(sum(Fraction(round(v * 100), 100) for v in small)),
            "cancel": 5.26, "small": float(sum(Fraction(round(v * 100), 100) for v in small)), "nulls": None, "some": 2.5}
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "g string, h int, v double").repartition(1 + 3 * seed)
        for found in sums(df):
            assert found == want


def test_sums_of_what_is_not_finite(spark):
    inf, nan = math.inf, math.nan
    rows = [("nan", 0, nan), ("nan", 1, 1.0), ("inf", 0, inf), ("inf", 1, 2e18), ("-inf", 0, -inf), ("-inf", 0, 3.0),
            ("both", 0, inf), ("both", 1, -inf), ("huge", 0, 1e300), ("huge", 1, 1.0), ("huge", 2, 1e17)]
    df = spark.createDataFrame(rows, "g string, h int, v double")
    for found in sums(df):
        assert math.isnan(found["nan"]) and math.isnan(found["both"])
        assert (found["inf"], found["-inf"], found["huge"]) == (inf, -inf, 1e300)


def test_bitmap_counts_merge(spark):
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(3000)}", rng.randrange(9), rng.choice("abc")) for _ in range(9000)]
    rows += [("hot", d, "a") for d in range(9)] * 50 + [(None, 3, "z"), (None, 4, "z"), ("nullday", None, "b")]
    df = spark.createDataFrame(rows, "k string, day int, s string")
    ids = dense_ids(df, "k", "day", split=4)
    numbers = sorted(r._id for r in ids.collect())
    assert numbers == list(range(len({k for k, _, _ in rows if k is not None})))
    stored = distinct_bitmaps(df.join(ids, "k", "left"), ["day", "s"])

    def want(*cols):
        at = {"day": 1, "s": 2}
        out = {}
        for r in rows:
            out.setdefault(tuple(r[at[c]] for c in cols), set()).update([r[0]] if r[0] is not None else [])
        return {g: len(ks) for g, ks in out.items()}

    for cols in (["day", "s"], ["s"], ["day"], []):
        got = {tuple(r[c] for c in cols): r.distinct_keys for r in merged_counts(stored, cols).collect()}
        assert got == want(*cols)
    by_store = merge_bitmaps(stored, ["s"])  # coarser bitmaps can be stored and merged again
    assert merged_counts(by_store, []).first()[0] == len(numbers)
    assert merged_counts(distinct_bitmaps(df.limit(0).withColumn("_id", F.lit(1).cast("long")), ["s"]), []).first()[0] == 0


def test_bitmaps_span_buckets(spark):
    df = spark.range(100_000).selectExpr("concat('k', id) AS k", "cast(id % 3 AS int) AS day")
    stored = distinct_bitmaps(df.join(dense_ids(df, "k", "day"), "k"), ["day"])
    assert stored.count() < 10  # ids follow the day, so a day's bitmaps are few
    assert merged_counts(stored, []).first()[0] == 100_000


LINES = [
    "T1,2026-01-01 10:00:00,S1,P1,2,10.0,card",
    "T2,2026-01-01 10:00:00,S1,P1,2,10.0",
    "T3,2026-01-01 10:00:00,S1,P1,2,10.0,card,extra,more",
    "T4,soon,S1,P1,2,10.0,card",
    'T5,2026-01-01 10:00:00,"S, 5",P1,2,10.0,"say x"',
    "T6,2026-01-01 10:00:00,,P1,x,10.0,card",
    "T7",
    "T8,2026-01-01 10:00:00,  S8  ,P1,2,10.0,",
]


def test_malformed_lines_are_captured_and_quarantined(spark):
    paths = LayerPaths(work_dir(spark, "malformed"))
    path = f"{paths.raw}/transactions.csv"
    lines = spark.createDataFrame([(x,) for x in LINES], "line string").repartition(3)
    write_lines(lines, ",".join(TRANSACTIONS.fieldNames()), path)
    rows = read_typed_csv(spark, path, TRANSACTIONS, capture_malformed=True).cache()
    kept = {r.transaction_id: r[CORRUPT_RECORD] for r in rows.collect()}
    rows.unpersist()
    assert kept == {f"T{i + 1}": x if i in (1, 2, 3, 6) else None for i, x in enumerate(LINES)}
    assert read_typed_csv(spark, path, TRANSACTIONS).columns == TRANSACTIONS.fieldNames()
    five = read_typed_csv(spark, path, TRANSACTIONS).where("transaction_id in ('T5', 'T8')").orderBy("transaction_id").collect()
    assert [(r.store_id, r.payment_type) for r in five] == [("S, 5", "say x"), ("  S8  ", None)]

    run_bronze(spark, paths, tables=("transactions",), capture_malformed=True)
    report = run_silver(spark, paths, reference_tables=(), quarantine_malformed=True)
    bad = read_table(spark, f"{paths.quarantine}/transactions")
    assert {r.transaction_id: (r[REASON_COL], r[CORRUPT_RECORD]) for r in bad.collect()} == {
        "T2": ("malformed_record", LINES[1]), "T3": ("malformed_record", LINES[2]),
        "T4": ("null_required_field,malformed_record", LINES[3]),
        "T6": ("null_required_field,non_numeric_value", None), "T7": ("null_required_field,malformed_record", LINES[6])}
    silver = read_table(spark, f"{paths.silver}/transactions")
    assert silver.columns == [*TRANSACTIONS.fieldNames(), *METADATA_COLUMNS] and report.silver_rows["transactions"] == 3
    # Bronze that has no captured lines: nothing is set aside for them.
    plain = LayerPaths(work_dir(spark, "plain"))
    write_lines(lines, ",".join(TRANSACTIONS.fieldNames()), f"{plain.raw}/transactions.csv")
    run_bronze(spark, plain, tables=("transactions",))
    assert run_silver(spark, plain, reference_tables=(), quarantine_malformed=True).silver_rows["transactions"] == 5

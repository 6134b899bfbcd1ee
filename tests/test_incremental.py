"""Layers kept batch by batch, the pruned merge, and bucketed tables."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakelayer.functions.exprs import REASON_COL
from lakelayer.operators.merge import DuplicateSourceKeys, merge_upsert
from lakelayer.operators.quality import QualityRules, QuarantineRateExceeded, TRANSACTION_RULES
from lakelayer.plans.incremental import (
    BatchOutOfOrder,
    apply_batch,
    checked_path,
    key_index,
    quarantined_transactions,
    refresh_gold,
    silver_transactions,
)
from lakelayer.plans.medallion import LayerPaths, land_raw_extract, run_bronze, run_gold, run_references, run_silver
from lakelayer.plans.partitioned_merge import home_partitions, in_partitions, merge_partitions, month_of
from lakelayer.schemas import METADATA_COLUMNS, SOURCE_SCHEMAS
from lakelayer.session import work_dir
from lakelayer.sources.buckets import bucketed
from lakelayer.sources.csv import write_csv
from lakelayer.sources.partitions import drop_partitions, overwrite_partitions, partition_folder
from lakelayer.sources.tables import overwrite_table, read_table

RULES = QualityRules(TRANSACTION_RULES.not_null_columns, TRANSACTION_RULES.numeric_columns, ("transaction_id",), 100.0)


def tx(i, day, store="S1", product="P1", quantity="2", price="10.5"):
    return (i, None if day is None else dt.datetime(2026, 1, day, 9), store, product, quantity, price, "card")


BATCHES = {
    "001": [tx("A", 1), tx("B", 1, product="P2"), tx("C", 2), tx("D", 3, quantity="x"), tx("E", 3, "S2"), tx("F", 4), tx("F", 4),
            tx(None, 2), tx("G", None), tx("H", 5, product="P9")],
    "002": [tx("C", 6), tx("D", 6), tx("I", 6, store=" "), tx(None, 7), tx("J", 3, price="0.01"), tx("G", 6), tx("K", 7, "S2", "P2")],
    "003": [tx("C", 6), tx("F", 8), tx("A", 8), tx("L", 8), tx("L", 9, price="")],
}
REFERENCES = {
    "products": [("P1", "one", "C1", "U1", 1.0), ("P2", "two", "C2", "U1", 2.0), ("P9", "nine", None, "U1", 2.0)],
    "categories": [("C1", "cat one", "D1"), ("C2", "cat two", "D1")],
    "stores": [("S1", "store one", "R1"), ("S2", "store two", "R2")],
    "regions": [("R1", "north"), ("R2", "south")],
    "departments": [("D1", "dep")], "suppliers": [("U1", "sup", "x")],
    "supply_chain": [("H1", dt.date(2026, 1, 1), "P1", "U1", 5)],
}


def frame(spark, table, rows):
    return spark.createDataFrame(rows, SOURCE_SCHEMAS[table].simpleString()[7:-1].replace(":", " "))


def lake(spark, label):
    paths = LayerPaths(work_dir(spark, label))
    land_raw_extract({t: frame(spark, t, rows) for t, rows in REFERENCES.items()}, paths.raw)
    run_bronze(spark, paths, tables=tuple(REFERENCES))
    run_references(spark, paths)
    return paths


def land(spark, paths, batch, rows):
    path = f"{paths.raw}/{batch}/transactions.csv"
    write_csv(frame(spark, "transactions", rows).coalesce(1), path)
    return path


def apply(spark, paths, batch, rows=None, **kw):
    return apply_batch(spark, paths, batch, land(spark, paths, batch, rows or BATCHES[batch]), RULES, **kw)


def bag(df, *leave):
    return Counter(map(str, df.drop(*leave).collect()))


def summary(spark, paths):
    return bag(read_table(spark, f"{paths.gold}/gold_daily_merchandising_summary"), "_period")


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def files(path):
    path = local(path)
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def poison(folder):
    """A file that no reader can open: reading this partition fails."""
    folder = local(folder)
    assert os.path.isdir(folder), folder
    with open(f"{folder}/part-poison.parquet", "wb") as f:
        f.write(b"not parquet")


@pytest.fixture(scope="module")
def whole(spark):
    """One run over all batches."""
    out = {}
    for n in (1, 2, 3):
        paths = lake(spark, "whole")
        land_raw_extract({"transactions": frame(spark, "transactions", sum(list(BATCHES.values())[:n], []))}, paths.raw)
        run_bronze(spark, paths, tables=("transactions",))
        run_silver(spark, paths, RULES, reference_tables=())
        run_gold(spark, paths)
        out[n] = (bag(read_table(spark, f"{paths.silver}/transactions"), *METADATA_COLUMNS),
                  bag(read_table(spark, f"{paths.quarantine}/transactions"), *METADATA_COLUMNS), summary(spark, paths))
    return out


def tables(spark, paths):
    return (bag(silver_transactions(spark, paths), *METADATA_COLUMNS),
            bag(quarantined_transactions(spark, paths), *METADATA_COLUMNS), summary(spark, paths))


def test_batches_equal_one_run_and_read_only_what_changes(spark, whole):
    paths = lake(spark, "batches")
    first = apply(spark, paths, "001")
    assert tables(spark, paths) == whole[1]
    assert first.total_rows == 10 and first.retagged == 0 and first.by_reason["duplicate_key"] == 2
    assert first.periods == ["2026-01-01", "2026-01-02", "2026-01-03", "2026-01-05"]

    store, gold = checked_path(paths), paths.gold
    # Batch 2 may read neither the first batch nor days that it does not touch.
    poison(f"{paths.bronze}/transactions/_batch=001")
    poison(partition_folder(store, {"_dq_outcome": "clean", "_period": "2026-01-05", "_batch": "001"}))
    kept = {p: files(partition_folder(f"{gold}/{t}", {"_period": p})) for p in ("2026-01-01", "2026-01-05")
            for t in ("fact_sales", "gold_daily_merchandising_summary")}
    second = apply(spark, paths, "002")
    # Earlier copies: C (clean), D and G (quarantined, one without a day), and the null id.
    assert second.retagged == 4
    assert second.periods == ["2026-01-02", "2026-01-03", "2026-01-07"]
    assert all(files(partition_folder(f"{gold}/{t}", {"_period": p})) == kept[p] for p in kept
               for t in ("gold_daily_merchandising_summary",))
    os.remove(local(partition_folder(store, {"_dq_outcome": "clean", "_period": "2026-01-05", "_batch": "001"})) + "/part-poison.parquet")
    assert tables(spark, paths) == whole[2]
    # 2 January lost its only sale: its folders are gone.
    for t in ("fact_sales", "gold_daily_merchandising_summary"):
        assert not os.path.exists(local(partition_folder(f"{gold}/{t}", {"_period": "2026-01-02"})))

    third = apply(spark, paths, "003")
    assert third.retagged == 1  # A; copies of C and F were duplicates before
    assert tables(spark, paths) == whole[3]
    assert apply_batch(spark, paths, "003", None, RULES).total_rows == 5  # the last batch again
    assert tables(spark, paths) == whole[3]
    with pytest.raises(BatchOutOfOrder):
        apply_batch(spark, paths, "002", None, RULES)


def test_a_run_that_died_is_repaired_by_repeating_it(spark, whole):
    import shutil

    paths = lake(spark, "died")
    apply(spark, paths, "001")
    emptied = local(partition_folder(checked_path(paths), {"_dq_outcome": "clean", "_period": "2026-01-02", "_batch": "001"}))
    saved = local(work_dir(spark, "saved"))
    shutil.copytree(emptied, saved)
    apply(spark, paths, "002")
    assert not os.path.exists(emptied)
    shutil.copytree(saved, emptied)  # as if the run had ended before the folder was dropped
    apply_batch(spark, paths, "002", None, RULES)
    assert tables(spark, paths) == whole[2]
    assert not os.path.exists(emptied)


def test_months_and_empty_batches(spark, whole):
    paths = lake(spark, "months")
    assert apply(spark, paths, "000", [tx("Z", None)], grain="month").periods == []
    for batch in BATCHES:
        report = apply(spark, paths, batch, grain="month")
    assert report.periods == ["2026-01"]
    got = tables(spark, paths)
    assert got[0] == whole[3][0] and got[2] == whole[3][2]
    write_csv(frame(spark, "transactions", []), f"{paths.raw}/004/transactions.csv")
    empty = apply_batch(spark, paths, "004", f"{paths.raw}/004/transactions.csv", RULES, grain="month")
    assert (empty.total_rows, empty.quarantine_pct, empty.status, empty.periods) == (0, 0.0, "OK", [])


def test_a_corrected_dimension_touches_the_days_of_its_sales(spark):
    paths = lake(spark, "renamed")
    apply(spark, paths, "001")
    before = files(f"{paths.gold}/gold_daily_merchandising_summary")
    assert refresh_gold(spark, paths, []) == []
    fixed = [("P1", "one", "C1", "U1", 1.0), ("P2", "two", "C1", "U1", 2.0), ("P9", "nine", None, "U1", 2.0)]
    overwrite_table(frame(spark, "products", fixed), f"{paths.silver}/products")
    assert refresh_gold(spark, paths, []) == ["2026-01-01"]  # the only sale of P2
    after = files(f"{paths.gold}/gold_daily_merchandising_summary")
    assert {f for f in before if "2026-01-01" not in f} == {f for f in after if "2026-01-01" not in f}
    day = read_table(spark, f"{paths.gold}/gold_daily_merchandising_summary").where("_period = '2026-01-01'")
    assert [r.category_name for r in day.collect()] == ["cat one"]
    assert refresh_gold(spark, paths, []) == []


def test_alert_is_raised_after_the_batch_is_stored(spark):
    paths = lake(spark, "alert")
    strict = QualityRules(RULES.not_null_columns, RULES.numeric_columns, RULES.unique_columns, 5.0)
    path = land(spark, paths, "001", BATCHES["001"])
    with pytest.raises(QuarantineRateExceeded):
        apply_batch(spark, paths, "001", path, strict, fail_on_alert=True)
    assert quarantined_transactions(spark, paths).where(F.col(REASON_COL).isNotNull()).count() == 5
    with pytest.raises(ValueError, match="unique"):
        apply_batch(spark, paths, "002", path, QualityRules(unique_columns=("store_id",)))


def test_the_index_is_met_without_an_exchange_of_it(spark):
    from lakelayer.plans.incremental import batch_rows, meet_index, tag_batch

    paths = lake(spark, "index")
    apply(spark, paths, "001", gold=False)
    land(spark, paths, "002", BATCHES["002"])
    apply(spark, paths, "002", gold=False)
    found = key_index(spark, paths).read(spark)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = meet_index(tag_batch(batch_rows(spark, paths, "002"), RULES, "day"), found, "002")
        plan = met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    scan = [line for line in plan.splitlines() if "Bucketed: true" in line]
    assert scan and plan[:plan.index(scan[0])].rsplit("Join", 1)[1].count("Exchange") == 1  # the batch's own keys


# --- merge ------------------------------------------------------------------------

MERGE_SCHEMA = "id string, day date, a int, b string"


def day(m, d):
    return dt.date(2026, m, d)


def stored(spark, rows):
    path = f"{work_dir(spark, 'merge')}/t"
    target = spark.createDataFrame(rows, MERGE_SCHEMA)
    overwrite_partitions(target.withColumn("_month", month_of("day")), path, ["_month"])
    return target, path


def test_merge_rewrites_only_the_partitions_it_meets(spark):
    rows = [("1", day(1, 5), 1, "x"), ("2", day(2, 5), 2, "x"), ("3", day(3, 5), 3, "x"), ("4", day(3, 6), 4, "x"), ("5", day(4, 1), 5, "x"),
            ("6", None, 6, "x"), (None, day(1, 9), 7, "x")]
    target, path = stored(spark, rows)
    # "3" comes with another day: it is updated where it stands. "7" is new in May, "6" stands in the null partition.
    staging = spark.createDataFrame([("3", day(9, 9), 30, "y"), ("7", day(5, 1), 70, "y"), ("6", day(2, 1), 60, "y")], MERGE_SCHEMA)
    staged = staging.withColumn("_month", month_of("day"))
    kept = files(path)
    report = merge_partitions(spark, path, staging, ["id"], ["a"], "_month", month_of("day"))
    assert report.partitions == ["2026-02", "2026-03", "2026-05", "2026-09", None] and report.staged == 3
    want = bag(merge_upsert(target, staging, ["id"], ["a"]))
    assert bag(read_table(spark, path), "_month") == want
    for month in ("2026-01", "2026-04"):
        folder = local(partition_folder(path, {"_month": month}))
        assert files(folder) == {f: t for f, t in kept.items() if f.startswith(folder + "/")} != {}
    merge_partitions(spark, path, staging, ["id"], ["a"], "_month", month_of("day"))
    assert bag(read_table(spark, path), "_month") == want
    parts = home_partitions(read_table(spark, path), staged, ["id"], "_month")
    plan = read_table(spark, path).where(in_partitions("_month", parts))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(_month" in plan


def test_merge_edge_cases(spark):
    target, path = stored(spark, [("1", day(1, 5), 1, "x")])
    before = files(path)
    empty = spark.createDataFrame([], MERGE_SCHEMA)
    assert merge_partitions(spark, path, empty, ["id"], ["a"], "_month", month_of("day")).partitions == []
    twice = spark.createDataFrame([("1", day(1, 5), 2, "y"), ("1", day(1, 5), 3, "y")], MERGE_SCHEMA)
    with pytest.raises(DuplicateSourceKeys):
        merge_partitions(spark, path, twice, ["id"], ["a"], "_month", month_of("day"))
    assert files(path) == before
    some = spark.createDataFrame([("9", day(1, 7), 9)], "id string, day date, a int")
    merge_partitions(spark, path, some, ["id"], ["a"], "_month", month_of("day"), ["id", "day", "a"])
    assert bag(read_table(spark, path), "_month") == bag(target.unionByName(
        spark.createDataFrame([("9", day(1, 7), 9, None)], MERGE_SCHEMA)))


def test_partition_folders(spark):
    path = work_dir(spark, "folders")
    none = spark.createDataFrame([("a", 1)], "k string, n int")
    joined = none.join(none.limit(0).withColumnRenamed("n", "m"), "k")
    assert overwrite_partitions(joined, f"{path}-none", ["k"]) == 0
    values = ["a b", "x/y", "p=q", "100%", None, "2026-01-01", "ü:1"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k string, n int")
    assert overwrite_partitions(df, path, ["k"]) == len(values)
    assert drop_partitions(spark, path, [{"k": "a b"}, {"k": None}, {"k": "nowhere"}, {"k": "2026-01-01"}]) == 3
    assert {r.k for r in spark.read.schema("n int, k string").parquet(path).collect()} == {"x/y", "p=q", "100%", "ü:1"}


# --- bucketed tables ----------------------------------------------------------------

@pytest.mark.parametrize("spread", [1, 3])
def test_bucketed_tables_join_without_an_exchange(spark, spread):
    base = work_dir(spark, "buckets")
    left = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) AS k", "id AS v")
    right = spark.range(60).selectExpr("concat('k', id) AS k", "id AS w")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = (bucketed(spark, f"{base}/{n}", df.schema, ["k"]) for n, df in (("a", left), ("b", right)))
        a.write(left, spread=spread)
        b.write(right, spread=spread)
        joined = a.read(spark).join(b.read(spark), "k", "full_outer")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert bag(joined) == bag(left.join(right, "k", "full_outer"))
        b.write(right.limit(0), mode="overwrite")
        b.write(right.where("w < 5"))
        b.write(right.where("w >= 5"))
        spark.sql(f"DROP TABLE {b.name}")  # a session that does not know it yet
        again = bucketed(spark, f"{base}/b", right.schema, ["k"])
        assert again == b and bag(again.read(spark)) == bag(right)
        assert bag(a.read(spark).join(again.read(spark), "k")) == bag(left.join(right, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    with pytest.raises(ValueError, match="buckets"):
        bucketed(spark, f"{base}/b", right.schema, ["k"], 5)

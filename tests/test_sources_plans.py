"""Sources, sinks, the layer plans, and the registered queries against SQL."""

import os

import pytest
from pyspark.sql import functions as F

from lakelayer.schemas import TRANSACTIONS
from lakelayer.session import work_dir
from lakelayer.sources.csv import read_typed_csv, stamp_ingest, write_csv


def _write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_permissive_rules(spark):
    base = work_dir(spark, "csvtest").replace("file:", "")
    path = f"{base}/t.csv"
    _write_text(path, "\n".join([
        "transaction_id,transaction_ts,store_id,product_id,quantity,unit_price,payment_type",
        "T1,2026-06-01 10:00:00,S1,P1,2,10.0,card",
        "T2,not-a-time,S1,P1,2,10.0,card",
        "T3,2026-06-01T10:00:00,S1,P1",
        "T4,2026-06-01 10:00:00,S1,P1,2,10.0,card,EXTRA",
        'T5,2026-06-01 10:00:00,"",P1,,10.0,card',
    ]) + "\n")
    rows = {r.transaction_id: r for r in read_typed_csv(spark, path, TRANSACTIONS).collect()}
    assert rows["T2"].transaction_ts is None and rows["T2"].store_id == "S1"
    assert rows["T3"].transaction_ts is not None and rows["T3"].quantity is None
    assert rows["T4"].payment_type == "card"
    assert rows["T5"].store_id is None and rows["T5"].quantity is None


def test_stamp_from_file_metadata(spark):
    base = work_dir(spark, "stamp").replace("file:", "")
    _write_text(f"{base}/a.csv", "transaction_id\nT1\n")
    df = stamp_ingest(spark.read.option("header", True).schema("transaction_id string").csv(f"{base}/a.csv"))
    r = df.collect()[0]
    assert r._source_file == "a.csv" and r._ingested_at is not None


def test_write_csv_keeps_spaces(spark):
    path = f"{work_dir(spark, 'spaces')}/x.csv"
    write_csv(spark.createDataFrame([("  ", "a")], "s string, t string"), path)
    assert spark.read.option("header", True).schema("s string, t string").csv(path).collect()[0].s == "  "


def test_layer_run_end_to_end(spark, sf_small):
    from lakelayer.plans.medallion import LayerPaths, WarehouseViolations, land_raw_extract, publish_warehouse, run_layers
    from lakelayer.sources import driver
    from lakelayer.sources.tables import read_table

    paths = LayerPaths(work_dir(spark, "layers"))
    land_raw_extract(driver.retail_sources(spark, sf_small), paths.raw)
    report = run_layers(spark, paths)
    assert report.silver.total_rows == driver.transactions(spark, sf_small).count()
    assert report.silver.silver_rows["transactions"] == 3307
    assert report.silver.status == "ALERT"
    quarantine = read_table(spark, f"{paths.quarantine}/transactions")
    assert quarantine.count() == report.silver.quarantined_rows
    assert report.gold["fact_sales"] == 3307
    wh = publish_warehouse(spark, paths.gold, paths.warehouse)
    assert wh.rows["fact_sales"] == 3307
    # Second load merges the same staging into the loaded fact: nothing changes.
    prev = read_table(spark, f"{paths.warehouse}/fact_sales")
    again = publish_warehouse(spark, paths.gold, f"{paths.warehouse}-2", previous_fact=prev)
    assert again.rows["fact_sales"] == 3307
    fresh = read_table(spark, f"{paths.warehouse}-2/fact_sales")
    assert fresh.exceptAll(prev).count() == 0 and prev.exceptAll(fresh).count() == 0
    rows = read_table(spark, f"{paths.gold}/dim_category_parquet").collect()
    long = spark.createDataFrame(rows).withColumn("category_id", F.concat("category_id", F.lit("-far-too-long")))
    long.write.mode("overwrite").parquet(f"{paths.gold}/dim_category_parquet")
    assert publish_warehouse(spark, paths.gold, f"{paths.warehouse}-4", on_violation="reject").rows["dim_category"] == 0
    with pytest.raises(WarehouseViolations):
        publish_warehouse(spark, paths.gold, f"{paths.warehouse}-3", on_violation="fail")
    # Rerunning bronze appends the same files again: every id becomes a duplicate.


def test_streaming_ingest_is_idempotent(spark, sf_small):
    from lakelayer.sources import driver
    from lakelayer.sources.tables import read_table
    from lakelayer.streaming.ingest import ingest_incrementally

    base = work_dir(spark, "stream")
    write_csv(driver.transactions(spark, sf_small), f"{base}/landing/b=1", files=2)
    first = ingest_incrementally(spark, f"{base}/landing/*/*.csv", TRANSACTIONS, f"{base}/bronze", f"{base}/cp")
    second = ingest_incrementally(spark, f"{base}/landing/*/*.csv", TRANSACTIONS, f"{base}/bronze", f"{base}/cp")
    assert first == read_table(spark, f"{base}/bronze").count()
    assert second == 0


FAST_QUERIES = [
    "tag_null", "tag_numeric", "tag_duplicate", "tag_duplicate_window", "dq_quarantine", "dq_clean",
    "dq_metrics", "quarantine_by_reason", "quarantine_by_reason_legacy", "cast_transactions",
    "conform_reference", "fact_sales", "supply_chain_summary", "snowflake_enrich", "daily_summary",
    "daily_summary_distinct", "dim_product", "dim_category", "dim_department", "dim_store", "dim_region",
    "dim_supplier", "warehouse_conform", "warehouse_violations", "merge_upsert", "merge_idempotent", "revenue_total", "dim_counts",
    "region_category_top8", "supplier_top5", "csv_typed_scan", "bronze_stamp", "append_evolve",
    "parquet_export",
]


@pytest.fixture(scope="module")
def duck(sf_small):
    from tools.compare import duck as make

    return make(sf_small)


@pytest.mark.parametrize("name", FAST_QUERIES)
def test_query_matches_sql(spark, duck, sf_small, name):
    import __spark_entry__ as entry
    from tools.compare import compare

    r = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], sf_small)
    assert r["ok"], r["note"]


def test_every_query_has_an_oracle():
    import __spark_entry__ as entry

    from lakelayer.plans.catalog import QUERIES

    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date_key", "region_name", "category_name", "total_revenue", "total_units",
                          "transaction_count"]


def test_reingest_scope_all_empties_silver_and_batch_scope_does_not(spark, sf_small):
    from lakelayer.plans.medallion import LayerPaths, land_raw_extract, run_bronze, run_silver
    from lakelayer.sources import driver

    paths = LayerPaths(work_dir(spark, "reingest"))
    land_raw_extract(driver.retail_sources(spark, sf_small), paths.raw)
    run_bronze(spark, paths)
    run_bronze(spark, paths)  # the same files again
    assert run_silver(spark, paths).silver_rows["transactions"] == 0
    batch = run_silver(spark, paths, dedupe_scope="batch")
    assert batch.silver_rows["transactions"] == 3307


def test_upsert_table_twice_equals_once(spark):
    from lakelayer.plans.medallion import upsert_table
    from lakelayer.sources.tables import read_table

    base = work_dir(spark, "upsert")
    first = spark.createDataFrame([("1", 1), ("2", 2)], "id string, v int")
    updates = spark.createDataFrame([("2", 20), ("3", 30)], "id string, v int")
    upsert_table(spark, first, None, f"{base}/v1", ["id"])
    upsert_table(spark, updates, f"{base}/v1", f"{base}/v2", ["id"])
    upsert_table(spark, updates, f"{base}/v2", f"{base}/v3", ["id"])
    v2 = sorted(tuple(r) for r in read_table(spark, f"{base}/v2").collect())
    v3 = sorted(tuple(r) for r in read_table(spark, f"{base}/v3").collect())
    assert v2 == v3 == [("1", 1), ("2", 20), ("3", 30)]


def test_placement_lays_out_files(spark):
    from lakelayer.operators.placement import WAREHOUSE_PLACEMENT, place_for_write

    df = spark.range(0, 4000, 1, 8).selectExpr("cast(id % 7 as string) as product_id", "id")
    base = work_dir(spark, "placement")
    for name, placement in {"hash": ("hash", "product_id"), "even": ("round_robin",), "same": ("replicate",)}.items():
        place_for_write(df, placement).write.parquet(f"{base}/{name}")
    files = {n: spark.read.parquet(f"{base}/{n}").select("product_id", F.input_file_name()).distinct().groupBy(
        "product_id").count().agg(F.max("count")).first()[0] for n in ("hash", "same")}
    assert files == {"hash": 1, "same": 8}  # a product's rows share a file, or lie as they came
    assert spark.read.parquet(f"{base}/even").exceptAll(df).count() == 0
    assert {p[0] for p in WAREHOUSE_PLACEMENT.values()} == {"hash", "round_robin", "replicate"}
    with pytest.raises(ValueError):
        place_for_write(df, ("elsewhere",))


def test_streaming_count_is_whole_beyond_the_progress_ring(spark):
    from lakelayer.streaming.ingest import ingest_incrementally

    base = work_dir(spark, "ring").replace("file:", "")
    for i in range(6):
        _write_text(f"{base}/in/{i}.csv", "transaction_id,transaction_ts,store_id,product_id,quantity,unit_price,payment_type\n"
                    + "t,2026-06-01 10:00:00,s,p,1,2,c\n" * (i + 1))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        args = (spark, f"{base}/in/*.csv", TRANSACTIONS, f"{base}/bronze", f"{base}/checkpoint")
        assert ingest_incrementally(*args, max_files_per_trigger=1) == 21
        assert ingest_incrementally(*args, max_files_per_trigger=1) == 0
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_enforce_header_rejects_swapped_columns(spark):
    base = work_dir(spark, "hdr").replace("file:", "")
    path = f"{base}/t.csv"
    _write_text(path, "transaction_ts,transaction_id,store_id,product_id,quantity,unit_price,payment_type\n"
                      "2026-06-01 10:00:00,T1,S1,P1,2,10.0,card\n")
    # Default: binds by position, silently (the timestamp text lands in transaction_id).
    assert read_typed_csv(spark, path, TRANSACTIONS).collect()[0].transaction_id == "2026-06-01 10:00:00"
    with pytest.raises(Exception):
        read_typed_csv(spark, path, TRANSACTIONS, enforce_header=True).collect()


def _plan(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_partitioned_fact_prunes_dates_and_export_matches(spark, sf_small):
    from lakelayer.plans import catalog
    from lakelayer.sources.tables import publish, read_table

    gold = work_dir(spark, "pub")
    rows = publish(spark, catalog._fact(spark, sf_small), gold, "fact_sales", partition_col="date_key")
    table = read_table(spark, f"{gold}/fact_sales")
    assert rows == table.count() == read_table(spark, f"{gold}/fact_sales_parquet").count()
    one_year = table.where((F.col("date_key") >= "1996-01-01") & (F.col("date_key") < "1997-01-01"))
    plan = _plan(one_year)
    assert "PartitionFilters: [isnotnull(date_key" in plan and "1996-01-01" in plan
    assert one_year.count() < rows


def test_silver_reads_only_its_outcome_partition(spark, sf_small):
    from lakelayer.plans.medallion import OUTCOME_COL
    from lakelayer.sources.tables import overwrite_table, read_table

    base = work_dir(spark, "outcome")
    df = spark.createDataFrame([(1, "clean"), (2, "quarantined")], f"id int, {OUTCOME_COL} string")
    overwrite_table(df, base, partition_by=[OUTCOME_COL])
    clean = read_table(spark, base).where(F.col(OUTCOME_COL) == "clean")
    assert "PartitionFilters: [isnotnull(_dq_outcome" in _plan(clean)
    assert [r.id for r in clean.collect()] == [1]


LAZY_QUERIES = ["tag_null", "tag_numeric", "tag_duplicate", "dq_quarantine", "cast_transactions",
                "conform_reference", "fact_sales", "supply_chain_summary", "snowflake_enrich", "daily_summary",
                "warehouse_conform", "warehouse_violations", "merge_upsert", "revenue_total", "dim_counts",
                "region_category_top8", "supplier_top5"]


@pytest.mark.parametrize("name", LAZY_QUERIES)
def test_no_python_in_plans(spark, sf_small, name):
    import __spark_entry__ as entry

    plan = _plan(entry.queries()[name](spark, sf_small))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert marker not in plan


def test_silver_fails_the_run_on_alert_when_asked(spark, sf_small):
    from lakelayer.operators.quality import QuarantineRateExceeded
    from lakelayer.plans.medallion import LayerPaths, land_raw_extract, run_bronze, run_silver
    from lakelayer.sources import driver

    paths = LayerPaths(work_dir(spark, "alert"))
    land_raw_extract({"transactions": driver.transactions(spark, sf_small)}, paths.raw)
    run_bronze(spark, paths, tables=("transactions",))
    report = run_silver(spark, paths, reference_tables=())  # default: warn only
    assert report.status == "ALERT" and report.quarantine_pct > 5.0
    with pytest.raises(QuarantineRateExceeded):
        run_silver(spark, paths, reference_tables=(), fail_on_alert=True)
    from lakelayer.sources.tables import read_table

    stored = read_table(spark, f"{paths.quarantine}/transactions")
    assert stored.count() == report.quarantined_rows and "_dq_failure_reason" in stored.columns

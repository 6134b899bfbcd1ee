"""Registered queries: one per operator of the build plan, over the driver tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame``. Queries that exercise a
sink write to a fresh folder under the session's checkpoint folder and return
what they read back. ``lakelayer.plans.oracle.ORACLE_SQL`` holds the SQL
statement of each query.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.functions.exprs import REASON_COL
from lakelayer.operators.conform import (
    clean_and_cast_transactions,
    conform_reference_table,
    conform_reference_tables,
    conform_to_schema,
)
from lakelayer.operators.distinct import dense_ids, distinct_bitmaps, merged_counts
from lakelayer.operators.marts import (
    build_daily_summary,
    build_dimensions,
    build_fact_sales,
    build_supply_chain_summary,
    enrich_sales,
)
from lakelayer.operators.merge import merge_fact_sales
from lakelayer.operators.placement import WAREHOUSE_PLACEMENT, place_for_write
from lakelayer.operators.quality import (
    TRANSACTION_RULES,
    QuarantineRateExceeded,
    quarantine_by_reason,
    run_quality_gate,
    tag_duplicate_check,
    tag_null_check,
    tag_numeric_check,
)
from lakelayer.operators.report import (
    dimension_counts,
    gate_report,
    revenue_total,
    revenue_total_text,
    sold_against_received,
    top_region_categories_from_fact,
    top_supply_pairs,
)
from lakelayer.plans.incremental import apply_batch, quarantined_transactions, silver_transactions
from lakelayer.plans.medallion import (
    DEFAULT_REFERENCE_ORDER,
    LayerPaths,
    land_raw_extract,
    publish_warehouse,
    run_bronze,
    run_layers,
    run_references,
    run_silver,
    upsert_table,
)
from lakelayer.plans.partitioned_merge import merge_partitions, month_of
from lakelayer.schemas import (
    CORRUPT_RECORD,
    FACT_SALES_COLUMNS,
    FACT_SALES_MERGE_UPDATES,
    INGESTED_AT,
    METADATA_COLUMNS,
    TRANSACTIONS,
    WAREHOUSE,
)
from lakelayer.session import work_dir
from lakelayer.sources import driver
from lakelayer.sources.buckets import bucketed
from lakelayer.sources.csv import read_typed_csv, stamp_ingest, write_csv, write_lines
from lakelayer.sources.partitions import overwrite_partitions, table_exists
from lakelayer.sources.tables import append_table, export_parquet, materialize, publish, read_table
from lakelayer.streaming.ingest import ingest_incrementally

Query = Callable[[SparkSession, str], DataFrame]

# The merge scenario (warehouse holds facts before the target
# cutoff; the next extract starts at the staging start and carries corrections).
MERGE_TARGET_BEFORE = "1999-01-01"
MERGE_STAGING_FROM = "1998-01-01"
CANCELLED_PRIORITY = "5-LOW"
UNPRICED_PRIORITY = "4-NOT SPECIFIED"
# Bronze schema-evolution scenario (second batch adds ``channel``).
EVOLVE_SPLIT = "1998-01-01"
EXPRESS_PRIORITIES = ("1-URGENT", "2-HIGH")


# --- shared lazy building blocks ---------------------------------------------

def _raw_tx(spark, d):
    return driver.transactions(spark, d)


def _gate(spark, d, **kw):
    return run_quality_gate(_raw_tx(spark, d), TRANSACTION_RULES, **kw)


def _silver_tx(spark, d, dedupe=False):
    # The gate quarantines every repeated id, so the dedupe is a no-op here.
    return clean_and_cast_transactions(_gate(spark, d).clean, dedupe=dedupe)


def _fact(spark, d):
    return build_fact_sales(_silver_tx(spark, d))


def _silver_reference(spark, d):
    src = {name: build(spark, d) for name, build in driver.BUILDERS.items() if name != "transactions"}
    return conform_reference_tables(src, order_by=DEFAULT_REFERENCE_ORDER)


def _silver_ship(spark, d):
    return conform_reference_table(driver.supply_chain(spark, d), "shipment_id",
                                   DEFAULT_REFERENCE_ORDER["supply_chain"])


def _merge_inputs(spark, d):
    fact = _fact(spark, d)
    target = fact.where(F.col("date_key") < F.lit(MERGE_TARGET_BEFORE).cast("date"))
    pt = F.col("payment_type")
    staging = fact.where(F.col("date_key") >= F.lit(MERGE_STAGING_FROM).cast("date")).select(
        "transaction_id", "transaction_ts", "date_key", "store_id", "product_id",
        F.when(pt == CANCELLED_PRIORITY, F.lit(0)).otherwise(F.col("quantity")).alias("quantity"),
        F.when(pt == UNPRICED_PRIORITY, F.lit(None).cast("double")).otherwise(F.col("unit_price"))
        .alias("unit_price"),
        F.when(pt == CANCELLED_PRIORITY, F.lit(0.0)).when(pt == UNPRICED_PRIORITY, F.lit(None).cast("double"))
        .otherwise(F.col("revenue")).alias("revenue"),
        "payment_type",
    )
    return target, staging


# --- sources and sinks --------------------------------------------------------

def csv_typed_scan(spark, d):
    """Raw transactions landed as header CSV, read back with the declared schema."""
    path = f"{work_dir(spark, 'csv')}/transactions.csv"
    write_csv(_raw_tx(spark, d), path)
    return read_typed_csv(spark, path, TRANSACTIONS)


def csv_malformed(spark, d):
    """Lines with a field too few, one too many, or a broken time, through bronze and the gate; as quarantined."""
    paths = LayerPaths(work_dir(spark, "malformed"))
    number = F.substring("product_id", 2, 12).cast("long")
    time = F.when(number % 43 == 0, F.lit("soon")).otherwise(F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss"))
    fields = [time if c == "transaction_ts" else F.coalesce(c, F.lit("")) for c in TRANSACTIONS.fieldNames()]
    line = (F.when(number % 37 == 0, F.concat_ws(",", *fields[:-1]))
            .when(number % 41 == 0, F.concat_ws(",", *fields, F.lit("surplus"))).otherwise(F.concat_ws(",", *fields)))
    header = ",".join(TRANSACTIONS.fieldNames())
    write_lines(_raw_tx(spark, d).select(line.alias("line")), header, f"{paths.raw}/transactions.csv")
    run_bronze(spark, paths, tables=("transactions",), capture_malformed=True)
    run_silver(spark, paths, reference_tables=(), quarantine_malformed=True)
    stored = read_table(spark, f"{paths.quarantine}/transactions").where(F.col(CORRUPT_RECORD).isNotNull())
    return stored.select("transaction_id", F.col(CORRUPT_RECORD).alias("line"), REASON_COL)


def bronze_stamp(spark, d):
    """The typed scan with ingest metadata (the time itself is run-dependent)."""
    path = f"{work_dir(spark, 'stamp')}/transactions.csv"
    write_csv(_raw_tx(spark, d), path)
    stamped = stamp_ingest(read_typed_csv(spark, path, TRANSACTIONS), "transactions.csv")
    return stamped.withColumn("ingest_time_set", F.col(INGESTED_AT).isNotNull()).drop(INGESTED_AT)


def append_evolve(spark, d):
    """S3: two appends, the second adding a column; read back with merged schema."""
    path = f"{work_dir(spark, 'append')}/transactions"
    raw = _raw_tx(spark, d)
    day = F.to_date("transaction_ts")
    split = F.lit(EVOLVE_SPLIT).cast("date")
    append_table(raw.where(day < split), path)
    channel = F.when(F.col("payment_type").isin(*EXPRESS_PRIORITIES), F.lit("express")).otherwise(F.lit("standard"))
    append_table(raw.where(day >= split).withColumn("channel", channel), path)
    return read_table(spark, path, merge_schema=True)


def bronze_incremental(spark, d):
    """Streaming ingest: two landings, three runs; every file lands exactly once."""
    base = work_dir(spark, "stream")
    raw = _raw_tx(spark, d)
    day = F.to_date("transaction_ts")
    split = F.lit(EVOLVE_SPLIT).cast("date")
    landing, bronze, checkpoint = f"{base}/landing", f"{base}/bronze", f"{base}/_checkpoint"
    write_csv(raw.where(day < split), f"{landing}/batch=1")
    ingest_incrementally(spark, f"{landing}/*/*.csv", TRANSACTIONS, bronze, checkpoint)
    write_csv(raw.where(day >= split), f"{landing}/batch=2")
    ingest_incrementally(spark, f"{landing}/*/*.csv", TRANSACTIONS, bronze, checkpoint)
    ingest_incrementally(spark, f"{landing}/*/*.csv", TRANSACTIONS, bronze, checkpoint)  # nothing new
    return read_table(spark, bronze).select(*TRANSACTIONS.fieldNames())


def partitioned_write(spark, d):
    """fact_sales written Hive-partitioned by date_key, read back."""
    gold = work_dir(spark, "gold")
    publish(spark, _fact(spark, d), gold, "fact_sales", partition_col="date_key")
    return read_table(spark, f"{gold}/fact_sales").select(*FACT_SALES_COLUMNS)


def parquet_export(spark, d):
    """fact_sales exported to a fixed number of Parquet files, read back."""
    path = f"{work_dir(spark, 'export')}/fact_sales_parquet"
    export_parquet(_fact(spark, d), path, files=4)
    return read_table(spark, path)


# --- quality gate ---------------------------------------------------------------

def tag_null(spark, d):
    return tag_null_check(_raw_tx(spark, d), TRANSACTION_RULES.not_null_columns)


def tag_numeric(spark, d):
    return tag_numeric_check(_raw_tx(spark, d), TRANSACTION_RULES.numeric_columns)


def tag_duplicate(spark, d):
    return tag_duplicate_check(_raw_tx(spark, d), TRANSACTION_RULES.unique_columns)


def tag_duplicate_window(spark, d):
    return tag_duplicate_check(_raw_tx(spark, d), TRANSACTION_RULES.unique_columns, method="window")


def dq_quarantine(spark, d):
    return _gate(spark, d).quarantined


def dq_clean(spark, d):
    return _gate(spark, d).clean


def dq_metrics(spark, d):
    return _gate(spark, d).metrics


def quarantine_reasons(spark, d):
    return quarantine_by_reason(_gate(spark, d).quarantined)


def quarantine_reasons_legacy(spark, d):
    return quarantine_by_reason(_gate(spark, d, legacy_prefix=True).quarantined)


# --- silver -------------------------------------------------------------------

def cast_transactions(spark, d):
    return _silver_tx(spark, d, dedupe=True)


def conform_reference(spark, d):
    return _silver_ship(spark, d)


# --- gold ---------------------------------------------------------------------

def fact_sales(spark, d):
    return _fact(spark, d)


def supply_chain_summary(spark, d):
    return build_supply_chain_summary(_silver_ship(spark, d))


def _dims(spark, d):
    ref = _silver_reference(spark, d)
    return ref["products"], ref["categories"], ref["stores"], ref["regions"]


def snowflake_enrich(spark, d):
    return enrich_sales(_fact(spark, d), *_dims(spark, d))


def daily_summary(spark, d):
    return build_daily_summary(_fact(spark, d), *_dims(spark, d))


def daily_summary_distinct(spark, d):
    return build_daily_summary(_fact(spark, d), *_dims(spark, d), ids_unique=False)


def _sales_bitmaps(spark, d):
    """Raw lines' transaction ids as stored bitmaps per day and store; ids repeat across both."""
    raw = _raw_tx(spark, d).withColumn("date_key", F.to_date("transaction_ts"))
    rows = raw.select("transaction_id", "date_key", "store_id", F.substring("product_id", 2, 12).cast("long").alias("n"))
    # The same id again on a later day and in another store, so that counts do not simply add up.
    later = rows.where("n % 5 = 0").select(
        "transaction_id", F.date_add("date_key", 40).alias("date_key"), F.lit("S0").alias("store_id"), "n")
    rows, _ = materialize(rows.unionByName(later), "bitmap-rows")
    ids = dense_ids(rows, "transaction_id", "date_key")
    stored, _ = materialize(distinct_bitmaps(rows.join(ids, "transaction_id", "left"), ["date_key", "store_id"]), "bitmaps")
    return stored


def distinct_rollup(spark, d):
    """Distinct transactions per month and store, from the stored bitmaps of days and stores alone."""
    stored = _sales_bitmaps(spark, d).withColumn("month", F.date_format("date_key", "yyyy-MM"))
    return merged_counts(stored, ["month", "store_id"], "transaction_count")


def _dimension(name):
    def query(spark, d):
        return build_dimensions(_silver_reference(spark, d))[name]
    query.__name__ = name
    return query


# --- warehouse ----------------------------------------------------------------

def warehouse_conform(spark, d):
    return conform_to_schema(_fact(spark, d), WAREHOUSE["fact_sales"]).rows


def warehouse_violations(spark, d):
    """P6 report: a fact built from raw rows (no gate), conformed to the warehouse
    fact table; every row that breaks a NOT NULL column or a cast, with reasons."""
    ungated = clean_and_cast_transactions(_raw_tx(spark, d), dedupe=False)
    return conform_to_schema(build_fact_sales(ungated), WAREHOUSE["fact_sales"]).violations


def merge_upsert(spark, d):
    target, staging = _merge_inputs(spark, d)
    return merge_fact_sales(target, staging)


def merge_idempotent(spark, d):
    """M2: the same updates applied twice to a stored table, each time from and to disk."""
    target, staging = _merge_inputs(spark, d)
    base = work_dir(spark, "upsert")
    upsert_table(spark, target, None, f"{base}/v1", ["transaction_id"])
    export_parquet(staging, f"{base}/staging")
    for old, new in (("v1", "v2"), ("v2", "v3")):
        upsert_table(spark, read_table(spark, f"{base}/staging"), f"{base}/{old}", f"{base}/{new}",
                     ["transaction_id"], list(FACT_SALES_MERGE_UPDATES))
    return read_table(spark, f"{base}/v3")


def warehouse_fact_merged(spark, d):
    """C15's merge: a warehouse fact stored by month; staging, conformed to its types, replaces the months it meets."""
    target, staging = _merge_inputs(spark, d)
    path = f"{work_dir(spark, 'fact-merge')}/fact_sales"
    stored = conform_to_schema(target, WAREHOUSE["fact_sales"]).rows
    overwrite_partitions(stored.withColumn("_month", month_of("date_key")), path, ["_month"])
    merge_partitions(spark, path, conform_to_schema(staging, WAREHOUSE["fact_sales"]).rows, ["transaction_id"],
                     FACT_SALES_MERGE_UPDATES, "_month", month_of("date_key"), FACT_SALES_COLUMNS)
    return read_table(spark, path).drop("_month")


def _warehouse_table(name):
    """One of the other eight warehouse tables, conformed to its declaration, as stored."""
    def query(spark, d):
        ref = _silver_reference(spark, d)
        if name == "fact_supply_chain_summary":
            gold = build_supply_chain_summary(ref["supply_chain"])
        elif name == "gold_daily_merchandising_summary":
            gold = build_daily_summary(_fact(spark, d), *_dims(spark, d), sort=False)
        else:
            gold = build_dimensions(ref)[name]
        path = f"{work_dir(spark, 'warehouse-table')}/{name}"
        export_parquet(place_for_write(conform_to_schema(gold, WAREHOUSE[name]).rows, WAREHOUSE_PLACEMENT[name]), path)
        return read_table(spark, path)
    query.__name__ = f"warehouse_{name}"
    return query


def warehouse_too_long(spark, d):
    """Rows whose text is longer than declared; planted where the category's name has an even length."""
    categories = _silver_reference(spark, d)["categories"]
    long = F.when(F.length("category_name") % 2 == 0, F.concat("category_id", F.lit("-far-too-long")))
    return conform_to_schema(categories.withColumn("category_id", F.coalesce(long, F.col("category_id"))),
                             WAREHOUSE["dim_category"]).violations


def warehouse_load(spark, d):
    """Gold written and exported, then every warehouse table reloaded; rows per table."""
    base = work_dir(spark, "warehouse")
    gold, warehouse = f"{base}/gold", f"{base}/warehouse"
    ref = _silver_reference(spark, d)
    fact = _fact(spark, d)
    publish(spark, fact, gold, "fact_sales", partition_col="date_key")
    for dim, df in build_dimensions(ref).items():
        publish(spark, df, gold, dim)
    publish(spark, build_supply_chain_summary(ref["supply_chain"]), gold, "fact_supply_chain_summary")
    gold_fact = read_table(spark, f"{gold}/fact_sales_parquet")
    # The dimensions as published, so that they are not derived from the line items again.
    dims = [read_table(spark, f"{gold}/{dim}_parquet") for dim in ("dim_product", "dim_category", "dim_store", "dim_region")]
    publish(spark, build_daily_summary(gold_fact, *dims, sort=False), gold, "gold_daily_merchandising_summary")
    publish_warehouse(spark, gold, warehouse)
    parts = [read_table(spark, f"{warehouse}/{t}").agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in WAREHOUSE]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- run report -----------------------------------------------------------------

def revenue_total_q(spark, d):
    return revenue_total(_fact(spark, d))


def revenue_total_text_q(spark, d):
    """A9 with its text."""
    return revenue_total_text(_fact(spark, d))


def revenue_edge_prices(spark, d):
    """C10 where prices pass the gate but not decimal(18,2): planted by product number, per day, region, category."""
    number = F.substring("product_id", 2, 12).cast("long")
    price = (F.when(number % 107 == 0, F.lit("1e300")).when(number % 109 == 0, F.lit("NaN"))
             .when(number % 113 == 0, F.lit("Infinity")).otherwise(F.col("unit_price")))
    gate = run_quality_gate(_raw_tx(spark, d).withColumn("unit_price", price), TRANSACTION_RULES)
    fact = build_fact_sales(clean_and_cast_transactions(gate.clean, dedupe=False))
    return build_daily_summary(fact, *_dims(spark, d), sort=False)


def revenue_huge_prices(spark, d):
    """C10 where prices are far beyond money but finite: large amounts of both signs, planted by product number."""
    number = F.substring("product_id", 2, 12).cast("long")
    price = (F.when(number % 7 == 0, F.lit("7e17")).when(number % 11 == 0, F.lit("-7e17"))
             .when(number % 13 == 0, F.lit("3e19")).otherwise(F.col("unit_price")))
    gate = run_quality_gate(_raw_tx(spark, d).withColumn("unit_price", price), TRANSACTION_RULES)
    fact = build_fact_sales(clean_and_cast_transactions(gate.clean, dedupe=False))
    return build_daily_summary(fact, *_dims(spark, d), sort=False)


def source_counts(spark, d):
    """Rows of each raw source."""
    parts = [build(spark, d).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("source"), "row_count")
             for name, build in driver.BUILDERS.items()]
    return reduce(DataFrame.unionByName, parts)


def quarantine_listing(spark, d):
    """C14: what the run report prints of every quarantined row."""
    return _gate(spark, d).quarantined.select("transaction_id", "store_id", "quantity", "unit_price", REASON_COL)


def gate_report_q(spark, d):
    """C14: gate metrics with the percentage as text."""
    return gate_report(_gate(spark, d).metrics)


def supply_pairs_null_ids(spark, d):
    """Non-null shipment ids per product and supplier, over raw shipments where every seventh lost its id."""
    number = F.substring("product_id", 2, 12).cast("long")
    raw = driver.supply_chain(spark, d)
    return top_supply_pairs(raw.withColumn("shipment_id", F.when(number % 7 != 0, F.col("shipment_id"))), k=50)


def dim_counts(spark, d):
    return dimension_counts(build_dimensions(_silver_reference(spark, d)))


def region_category_top8(spark, d):
    return top_region_categories_from_fact(_fact(spark, d), *_dims(spark, d), k=8)


def supplier_top5(spark, d):
    return top_supply_pairs(_silver_ship(spark, d), k=5)


# --- whole run ------------------------------------------------------------------

def reingest_batch_scope(spark, d):
    """Bronze ingested twice from the same files; silver with batch-scoped dedupe
    equals a single ingest (the all-of-bronze scope would quarantine every row)."""
    paths = LayerPaths(work_dir(spark, "reingest"))
    land_raw_extract({"transactions": _raw_tx(spark, d)}, paths.raw)
    for _ in range(2):
        run_bronze(spark, paths, tables=("transactions",))
    run_silver(spark, paths, dedupe_scope="batch", reference_tables=())
    return read_table(spark, f"{paths.silver}/transactions").drop(*METADATA_COLUMNS)


def quarantine_table(spark, d):
    """The quarantine table as a layer run wrote it, though the run ended in an alert."""
    paths = LayerPaths(work_dir(spark, "quarantine"))
    land_raw_extract({"transactions": _raw_tx(spark, d)}, paths.raw)
    run_bronze(spark, paths, tables=("transactions",))
    try:
        run_silver(spark, paths, reference_tables=(), fail_on_alert=True)
        alert = False
    except QuarantineRateExceeded:
        alert = True
    stored = read_table(spark, f"{paths.quarantine}/transactions").withColumn("alert_raised", F.lit(alert))
    return stored.withColumn("ingest_time_set", F.col(INGESTED_AT).isNotNull()).drop(INGESTED_AT)


def reingest_reference_latest(spark, d):
    """C7 after a second ingest that corrects every shipment: earlier dates, other quantities. The newest ingest wins."""
    paths = LayerPaths(work_dir(spark, "reference"))
    ship = driver.supply_chain(spark, d)
    land_raw_extract({"transactions": _raw_tx(spark, d), "supply_chain": ship}, paths.raw)
    run_bronze(spark, paths, tables=("transactions", "supply_chain"))
    fixed = ship.withColumn("ship_date", F.date_sub("ship_date", 30)).withColumn(
        "quantity_received", F.col("quantity_received") + 1)
    land_raw_extract({"supply_chain": fixed}, paths.raw)
    run_bronze(spark, paths, tables=("supply_chain",))
    run_silver(spark, paths, reference_tables=("supply_chain",))
    return read_table(spark, f"{paths.silver}/supply_chain").drop(*METADATA_COLUMNS)


def _two_batches(spark, d, gold=True):
    """Raw transactions in two landings, applied one after the other.

    The first holds all days before the split, and half of the later ones by
    product number; the second the other half, with ids that came before.
    """
    paths = LayerPaths(work_dir(spark, "batches"))
    sources = driver.retail_sources(spark, d)
    raw = sources.pop("transactions")
    if gold:
        needed = ("products", "categories", "stores", "regions")
        land_raw_extract({name: sources[name] for name in needed}, paths.raw)
        run_bronze(spark, paths, tables=needed)
        run_references(spark, paths, reference_tables=needed)
    number = F.substring("product_id", 2, 12).cast("long")
    late = (F.to_date("transaction_ts") >= F.lit(EVOLVE_SPLIT).cast("date")) & (number % 2 == 1)
    landing = F.when(late, F.lit("002")).otherwise(F.lit("001")).alias("landing")
    write_csv(raw.where(late.isNotNull()).select("*", landing), f"{paths.raw}/transactions.csv", compression="gzip", partition_by=["landing"])
    for batch in ("001", "002"):
        landed = f"{paths.raw}/transactions.csv/landing={batch}"
        if not table_exists(spark, landed):  # no row falls into it
            write_csv(raw.limit(0), landed)
        apply_batch(spark, paths, batch, landed, gold=gold, grain="month")
    return paths


def silver_incremental(spark, d):
    """C13 batch by batch: silver after two batches that share ids."""
    return silver_transactions(spark, _two_batches(spark, d, gold=False)).drop(*METADATA_COLUMNS)


def quarantine_incremental(spark, d):
    """S9 batch by batch: quarantine after two batches; earlier copies of an id that came again are in it."""
    return quarantined_transactions(spark, _two_batches(spark, d, gold=False)).drop(*METADATA_COLUMNS)


def gold_incremental(spark, d):
    """C10 batch by batch: the daily summary after two batches, only touched months recomputed."""
    paths = _two_batches(spark, d)
    summary = read_table(spark, f"{paths.gold}/gold_daily_merchandising_summary")
    return summary.select("date_key", "region_name", "category_name", "total_revenue", "total_units", "transaction_count")


def bucketed_sales_supply(spark, d):
    """The fact and the supply summary bucketed by product, joined and added up without an exchange of either."""
    base = work_dir(spark, "bucketed")
    stored = {}
    for name, df in (("fact_sales", _fact(spark, d)),
                     ("fact_supply_chain_summary", build_supply_chain_summary(_silver_ship(spark, d)))):
        rows = conform_to_schema(df, WAREHOUSE[name]).rows
        table = bucketed(spark, f"{base}/{name}", rows.schema, WAREHOUSE_PLACEMENT[name][1:])
        table.write(rows)
        stored[name] = table.read(spark)
    return sold_against_received(stored["fact_sales"], stored["fact_supply_chain_summary"])


def medallion_end_to_end(spark, d):
    """Land CSV extracts, run bronze -> silver -> gold, return the daily summary as written."""
    paths = LayerPaths(work_dir(spark, "layers"))
    land_raw_extract(driver.retail_sources(spark, d), paths.raw)
    run_layers(spark, paths)
    return read_table(spark, f"{paths.gold}/gold_daily_merchandising_summary")


QUERIES: dict[str, Query] = {
    "csv_typed_scan": csv_typed_scan,
    "csv_malformed": csv_malformed,
    "bronze_stamp": bronze_stamp,
    "append_evolve": append_evolve,
    "bronze_incremental": bronze_incremental,
    "partitioned_write": partitioned_write,
    "parquet_export": parquet_export,
    "tag_null": tag_null,
    "tag_numeric": tag_numeric,
    "tag_duplicate": tag_duplicate,
    "tag_duplicate_window": tag_duplicate_window,
    "dq_quarantine": dq_quarantine,
    "dq_clean": dq_clean,
    "dq_metrics": dq_metrics,
    "quarantine_by_reason": quarantine_reasons,
    "quarantine_by_reason_legacy": quarantine_reasons_legacy,
    "cast_transactions": cast_transactions,
    "conform_reference": conform_reference,
    "fact_sales": fact_sales,
    "supply_chain_summary": supply_chain_summary,
    "snowflake_enrich": snowflake_enrich,
    "daily_summary": daily_summary,
    "daily_summary_distinct": daily_summary_distinct,
    "distinct_rollup": distinct_rollup,
    **{name: _dimension(name) for name in
       ("dim_product", "dim_category", "dim_department", "dim_store", "dim_region", "dim_supplier")},
    "warehouse_conform": warehouse_conform,
    "warehouse_violations": warehouse_violations,
    "merge_upsert": merge_upsert,
    "merge_idempotent": merge_idempotent,
    "warehouse_load": warehouse_load,
    "revenue_total": revenue_total_q,
    "dim_counts": dim_counts,
    "region_category_top8": region_category_top8,
    "supplier_top5": supplier_top5,
    "medallion_end_to_end": medallion_end_to_end,
    "warehouse_fact_merged": warehouse_fact_merged,
    **{f"warehouse_{name}": _warehouse_table(name) for name in WAREHOUSE if name != "fact_sales"},
    "warehouse_too_long": warehouse_too_long,
    "revenue_total_text": revenue_total_text_q,
    "revenue_edge_prices": revenue_edge_prices,
    "revenue_huge_prices": revenue_huge_prices,
    "source_counts": source_counts,
    "quarantine_listing": quarantine_listing,
    "gate_report": gate_report_q,
    "supply_pairs_null_ids": supply_pairs_null_ids,
    "quarantine_table": quarantine_table,
    "reingest_reference_latest": reingest_reference_latest,
    "reingest_batch_scope": reingest_batch_scope,
    "silver_incremental": silver_incremental,
    "quarantine_incremental": quarantine_incremental,
    "gold_incremental": gold_incremental,
    "bucketed_sales_supply": bucketed_sales_supply,
}

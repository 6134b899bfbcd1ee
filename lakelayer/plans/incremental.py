"""Silver and gold kept up to date batch by batch, without rereading what came before.

A batch is one landing of raw transactions, under an id that sorts after all
earlier ones. ``apply_batch`` reads the batch, an index of the transaction ids
seen so far, and the partitions that must change; nothing else.

* Bronze: ``bronze/transactions/_batch=<id>``.
* Index: ``state/transaction_keys``, one row per id and batch, bucketed by id. The
  batch's ids meet it without an exchange of the index.
* Silver and quarantine are the two outcomes of one table,
  ``checked/transactions``, partitioned by (outcome, period, batch): a single write
  gives both. Typed columns stand beside the raw ones; ``silver_transactions`` and
  ``quarantined_transactions`` select theirs.
* An id that comes again makes its earlier copy a duplicate too. The index says
  in which (period, batch) that copy stands; those partitions alone are rewritten.
* Gold: the fact and the daily summary are partitioned by period; the periods that
  the batch touched are recomputed and replaced. A corrected product, category,
  store or region touches the periods of its sales.

A period is a day, or a month where a day has too few rows for files of its own
(``LayerPaths`` of one lake are always used with the same ``grain``).

The result equals one run over all batches (``run_silver`` with
``dedupe_scope="all"``, and ``run_gold``). Applying the last batch again changes
nothing, so a run that died is repaired by repeating it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from lakelayer.functions.exprs import (
    DUPLICATE_KEY,
    QUARANTINE_REASONS,
    REASON_COL,
    append_reason,
    to_double,
    to_int_truncating,
)
from lakelayer.operators.marts import build_daily_summary, build_fact_sales, product_categories, store_regions
from lakelayer.operators.quality import (
    TRANSACTION_RULES,
    QualityRules,
    enforce_threshold,
    tag_null_check,
    tag_numeric_check,
)
from lakelayer.plans.medallion import OUTCOME_COL, LayerPaths, log, read_layer
from lakelayer.plans.partitioned_merge import in_partitions
from lakelayer.schemas import INGESTED_AT, METADATA_COLUMNS, SOURCE_FILE, TRANSACTIONS
from lakelayer.sources.buckets import BucketedTable, bucketed
from lakelayer.sources.csv import read_typed_csv, stamp_ingest
from lakelayer.sources.partitions import drop_partitions, overwrite_partitions, table_exists
from lakelayer.sources.tables import append_table, materialize, overwrite_table, read_table

BATCH = "_batch"
PERIOD = "_period"
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}
KEY = "_key"
CLEAN, BAD = "clean", "quarantined"
TYPED = {"quantity": "_quantity", "unit_price": "_unit_price"}
STORE_PARTITIONS = [OUTCOME_COL, PERIOD, BATCH]
RAW = TRANSACTIONS.fieldNames()

# Declared, so that a batch id such as "007" stays text and an emptied table can still be read.
STORE_SCHEMA = StructType([
    *TRANSACTIONS.fields, StructField(INGESTED_AT, TimestampType()), StructField(SOURCE_FILE, StringType()),
    StructField(TYPED["quantity"], IntegerType()), StructField(TYPED["unit_price"], DoubleType()),
    StructField(REASON_COL, StringType()), StructField(KEY, StringType()),
    StructField(OUTCOME_COL, StringType()), StructField(PERIOD, StringType()), StructField(BATCH, StringType())])
FACT_SCHEMA = StructType([
    StructField("transaction_id", StringType()), StructField("transaction_ts", TimestampType()),
    StructField("date_key", DateType()), StructField("store_id", StringType()), StructField("product_id", StringType()),
    StructField("quantity", IntegerType()), StructField("unit_price", DoubleType()),
    StructField("revenue", DoubleType()), StructField("payment_type", StringType()), StructField(PERIOD, StringType())])
INDEX_SCHEMA = StructType([StructField(KEY, StringType()), StructField("copies", LongType()),
                           StructField(PERIOD, StringType()), StructField(BATCH, StringType())])
GOLD_REFERENCES = ("products", "categories", "stores", "regions")


class BatchOutOfOrder(ValueError):
    """A batch id that does not sort after every applied batch, and is not the last one."""


@dataclass
class BatchReport:
    batch: str
    total_rows: int
    quarantined_rows: int
    quarantine_pct: float
    status: str
    by_reason: dict[str, int]              # rows of this batch that each check failed
    retagged: int                          # earlier rows that this batch made duplicates
    periods: list[str] = field(default_factory=list)   # of gold, recomputed


def checked_path(paths: LayerPaths) -> str:
    return f"{paths.checked}/transactions"


def checked_transactions(spark: SparkSession, paths: LayerPaths) -> DataFrame:
    """Both outcomes of all batches, with their partition columns."""
    return spark.read.schema(STORE_SCHEMA).parquet(checked_path(paths))


def gold_fact(spark: SparkSession, paths: LayerPaths) -> DataFrame:
    return spark.read.schema(FACT_SCHEMA).parquet(f"{paths.gold}/fact_sales")


def key_index(spark: SparkSession, paths: LayerPaths, buckets: int | None = None) -> BucketedTable:
    """The stored index of transaction ids; the number of buckets is fixed by its first use."""
    return bucketed(spark, f"{paths.root.rstrip('/')}/state/transaction_keys", INDEX_SCHEMA, [KEY], buckets)


def id_key(column: str = "transaction_id") -> Column:
    """The id as a key that is never null: null ids are one key, as in the duplicate check."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


# --- bronze ---------------------------------------------------------------------

def land_batch(spark: SparkSession, paths: LayerPaths, batch: str, raw_path: str,
               source_file: str | None = "transactions.csv") -> int:
    """Read one batch's raw CSV and write it as its own bronze partition (again, if it is there)."""
    rows = stamp_ingest(read_typed_csv(spark, raw_path, TRANSACTIONS), source_file)
    return overwrite_table(rows, f"{paths.bronze}/transactions/{BATCH}={batch}")


def batch_rows(spark: SparkSession, paths: LayerPaths, batch: str) -> DataFrame:
    declared = StructType([*TRANSACTIONS.fields, StructField(INGESTED_AT, TimestampType()),
                           StructField(SOURCE_FILE, StringType())])
    return spark.read.schema(declared).parquet(f"{paths.bronze}/transactions/{BATCH}={batch}")


# --- silver ---------------------------------------------------------------------

def period_of(day: Column, grain: str) -> Column:
    return F.date_format(day, GRAINS[grain])


def tag_batch(rows: DataFrame, rules: QualityRules, grain: str) -> DataFrame:
    """The checks that need no other row, with the row's key, period and typed measures."""
    tagged = rows.withColumn(REASON_COL, F.lit(None).cast("string"))
    tagged = tag_null_check(tagged, rules.not_null_columns)
    tagged = tag_numeric_check(tagged, rules.numeric_columns, integer_columns=rules.integer_columns,
                               money_columns=rules.money_columns)
    return tagged.withColumns({KEY: id_key(), PERIOD: period_of(F.to_date("transaction_ts"), grain),
                               TYPED["quantity"]: to_int_truncating("quantity"),
                               TYPED["unit_price"]: to_double("unit_price")})


def meet_index(tagged: DataFrame, index: DataFrame, batch: str) -> DataFrame:
    """One row per id of the batch: copies in it, its period, copies before it, and where a lone earlier copy stands."""
    own = tagged.groupBy(KEY).agg(F.count(F.lit(1)).alias("copies"), F.max(PERIOD).alias(PERIOD))
    # A batch that was applied twice is in the index once or twice, with equal rows.
    before = index.where(F.col(BATCH) < batch).groupBy(KEY, BATCH).agg(F.max("copies").alias("n"), F.max(PERIOD).alias("d"))
    before = before.groupBy(KEY).agg(F.sum("n").alias("earlier"), F.max("d").alias("home_period"), F.max(BATCH).alias("home_batch"))
    return own.join(before, KEY, "left").withColumn("earlier", F.coalesce("earlier", F.lit(0)))


def outcome() -> Column:
    return F.when(F.col(REASON_COL).isNull(), F.lit(CLEAN)).otherwise(F.lit(BAD))


def _moved(rows: DataFrame) -> DataFrame:
    """What of tagged rows travels to their partitions; ``_stored`` derives the rest there."""
    return rows.withColumn(OUTCOME_COL, outcome()).select(*RAW, *METADATA_COLUMNS, REASON_COL, *STORE_PARTITIONS)


def _stored(rows: DataFrame) -> DataFrame:
    return rows.withColumns({KEY: id_key(), TYPED["quantity"]: to_int_truncating("quantity"),
                             TYPED["unit_price"]: to_double("unit_price")}).select(
        *RAW, *METADATA_COLUMNS, *TYPED.values(), REASON_COL, KEY, *STORE_PARTITIONS)


def held_at(spark: SparkSession, paths: LayerPaths, homes: list[tuple]) -> DataFrame:
    """The stored partitions of ``homes`` (period, batch), of both outcomes."""
    periods, batches = {p for p, _ in homes}, {b for _, b in homes}
    held = checked_transactions(spark, paths).where(in_partitions(PERIOD, sorted(periods, key=str)) & F.col(BATCH).isin(sorted(batches)))
    # At most periods times batches; without the hint all rows would pass a shuffle to meet them.
    known = F.broadcast(spark.createDataFrame(homes, "h_period string, h_batch string"))
    return held.join(known, F.col(PERIOD).eqNullSafe(F.col("h_period")) & (F.col(BATCH) == F.col("h_batch")), "left_semi")


def retag_earlier(spark: SparkSession, paths: LayerPaths, repeats: DataFrame, homes: list[tuple]) -> DataFrame:
    """The stored partitions of ``homes``, with the ids of ``repeats`` (key, home_period, home_batch) as duplicates.

    An id of ``repeats`` stands in one row. If a run died between writing and
    clearing that row's partitions it stands in both outcomes; the tagged one is
    kept. Rows that are duplicates already meet the ids by their keys alone.
    """
    held = held_at(spark, paths, homes).select(*RAW, *METADATA_COLUMNS, REASON_COL, *STORE_PARTITIONS)
    tagged = F.coalesce(F.col(REASON_COL).contains(DUPLICATE_KEY), F.lit(False))
    settled = held.where(tagged)
    ids = repeats.select(F.col(KEY).alias("r_key"), F.lit(True).alias("again"))
    stale = settled.select(id_key().alias("s_key")).join(ids, F.col("s_key") == F.col("r_key"), "left_semi").distinct()
    ids = ids.join(stale, F.col("r_key") == F.col("s_key"), "left")
    hit = held.where(~tagged).join(ids, id_key() == F.col("r_key"), "left").where("s_key is null")
    hit = hit.withColumn(REASON_COL, append_reason(F.col(REASON_COL), F.coalesce("again", F.lit(False)), DUPLICATE_KEY))
    return _moved(hit).unionByName(_moved(settled))


def apply_silver(spark: SparkSession, paths: LayerPaths, batch: str, rules: QualityRules = TRANSACTION_RULES,
                 grain: str = "day", buckets: int | None = None) -> BatchReport:
    """Gate one batch against all earlier ones and store it; earlier copies of its ids become duplicates."""
    if tuple(rules.unique_columns) != ("transaction_id",):
        raise ValueError("the index is kept by transaction_id, so the rules must be unique on it")
    store, index = checked_path(paths), key_index(spark, paths, buckets)
    landed = batch_rows(spark, paths, batch)
    if landed.isEmpty():
        pct, status = enforce_threshold(0, 0, rules.max_quarantine_pct, False, log)
        return BatchReport(batch, 0, 0, pct, status, dict.fromkeys(QUARANTINE_REASONS, 0), 0)
    tagged = tag_batch(landed, rules, grain)
    met, _ = materialize(meet_index(tagged, index.read(spark), batch), "batch-keys")

    repeated = met.where("copies > 1 or earlier > 0").select(F.col(KEY).alias("r_key"), F.lit(True).alias("again"))
    # The rows meet the repeated keys as they landed; what follows from them is derived after the exchange.
    rows = tag_batch(landed.join(repeated, id_key() == F.col("r_key"), "left"), rules, grain).withColumn(BATCH, F.lit(batch))
    rows = rows.withColumn(REASON_COL, append_reason(F.col(REASON_COL), F.coalesce("again", F.lit(False)), DUPLICATE_KEY))
    found = Observation()
    overwrite_partitions(
        _moved(rows), store, STORE_PARTITIONS, [OUTCOME_COL, PERIOD],
        lambda moved: _stored(moved).observe(found, F.count(F.lit(1)).alias("total"), F.count(REASON_COL).alias("bad"),
                                             *[F.count_if(F.col(REASON_COL).contains(tag)).alias(tag) for tag in QUARANTINE_REASONS]))
    counts = found.get

    lone = met.where("earlier = 1").select(KEY, "home_period", "home_batch")
    homes = [tuple(r) for r in lone.select("home_period", "home_batch").distinct().collect()]  # at most periods times batches
    if homes:
        overwrite_partitions(retag_earlier(spark, paths, lone, homes), store, STORE_PARTITIONS, [OUTCOME_COL, PERIOD], _stored)
        # A clean partition that lost its last row was not overwritten: its rows are ids of ``lone`` still.
        kept = held_at(spark, paths, homes).where(F.col(OUTCOME_COL) == CLEAN).select(KEY, PERIOD, BATCH)
        emptied = kept.join(lone.select(F.col(KEY).alias("r_key")), F.col(KEY) == F.col("r_key"), "left_semi")
        emptied = emptied.select(PERIOD, BATCH).distinct().collect()
        drop_partitions(spark, store, [{OUTCOME_COL: CLEAN, PERIOD: r[PERIOD], BATCH: r[BATCH]} for r in emptied])

    if index.read(spark).where(F.col(BATCH) == batch).isEmpty():
        index.write(met.select(KEY, "copies", PERIOD, F.lit(batch).alias(BATCH)))
    total, bad = int(counts.get("total", 0)), int(counts.get("bad", 0))
    pct, status = enforce_threshold(total, bad, rules.max_quarantine_pct, False, log)
    own = checked_transactions(spark, paths).where((F.col(BATCH) == batch) & (F.col(OUTCOME_COL) == CLEAN))
    periods = {period for period, _ in homes} | {r[0] for r in own.select(PERIOD).distinct().collect()}
    return BatchReport(batch, total, bad, pct, status, {tag: int(counts.get(tag, 0)) for tag in QUARANTINE_REASONS},
                       lone.count(), sorted(p for p in periods if p is not None))


def silver_transactions(spark: SparkSession, paths: LayerPaths, periods: Iterable[str] | None = None) -> DataFrame:
    """Clean transactions with typed measures, of all periods or some (their partitions only)."""
    rows = checked_transactions(spark, paths).where(F.col(OUTCOME_COL) == CLEAN)
    if periods is not None:
        rows = rows.where(F.col(PERIOD).isin(list(periods)))
    return rows.select(*[F.col(TYPED.get(c, c)).alias(c) for c in RAW], *METADATA_COLUMNS)


def quarantined_transactions(spark: SparkSession, paths: LayerPaths) -> DataFrame:
    """Quarantined rows as they came, with their reasons."""
    rows = checked_transactions(spark, paths).where(F.col(OUTCOME_COL) == BAD)
    return rows.select(*RAW, *METADATA_COLUMNS, REASON_COL)


# --- gold -----------------------------------------------------------------------

def renamed_periods(spark: SparkSession, paths: LayerPaths, lookups: dict[str, DataFrame]) -> set[str]:
    """Periods with sales of products or stores whose category or region name is not the one stored last time."""
    periods: set[str] = set()
    for key, now in lookups.items():
        stored = f"{paths.gold}/_lookups/{key}"
        if not (table_exists(spark, stored) and table_exists(spark, f"{paths.gold}/fact_sales")):
            continue
        name = [c for c in now.columns if c != key][0]
        was = read_table(spark, stored).select(F.col(key).alias("was_key"), F.col(name).alias("was"))
        both = now.join(was, F.col(key) == F.col("was_key"), "full_outer")
        changed = both.where(~F.col(name).eqNullSafe(F.col("was"))).select(F.coalesce(key, "was_key").alias(key))
        changed, n = materialize(changed, f"changed-{key}")
        if n:
            sold = gold_fact(spark, paths).select(key, PERIOD).join(changed, key, "left_semi")
            periods |= {r[0] for r in sold.select(PERIOD).distinct().collect()}
    return periods


def refresh_gold(spark: SparkSession, paths: LayerPaths, periods: Iterable[str], grain: str = "day") -> list[str]:
    """Recompute the fact and the daily summary of ``periods``, and of those that a changed dimension touches.

    Needs the reference tables in silver. Returns the periods that were
    replaced. A period without sales any more loses its partitions.
    """
    silver = read_layer(spark, paths.silver, GOLD_REFERENCES)
    lookups = {
        "product_id": product_categories(silver["products"], silver["categories"]).select("product_id", "category_name"),
        "store_id": store_regions(silver["stores"], silver["regions"]).select("store_id", "region_name")}
    lookups = {key: materialize(df, f"lookup-{key}")[0] for key, df in lookups.items()}
    own = sorted(set(periods))
    touched = sorted({*own, *renamed_periods(spark, paths, lookups)})
    period = period_of(F.col("date_key"), grain)
    if own:
        clean = checked_transactions(spark, paths).where((F.col(OUTCOME_COL) == CLEAN) & F.col(PERIOD).isin(own))
        sold = silver_transactions(spark, paths, own).drop(*METADATA_COLUMNS)
        _replace_periods(spark, sold.withColumn(PERIOD, period_of(F.to_date("transaction_ts"), grain)), f"{paths.gold}/fact_sales", own,
                         clean, lambda rows: build_fact_sales(rows).withColumn(PERIOD, period))
    if touched:
        fact = gold_fact(spark, paths).where(F.col(PERIOD).isin(touched))
        summary = build_daily_summary(fact, silver["products"], silver["categories"], silver["stores"],
                                      silver["regions"], sort=False)
        _replace_periods(spark, summary.withColumn(PERIOD, period),
                         f"{paths.gold}/gold_daily_merchandising_summary", touched, fact)
    for key, df in lookups.items():  # last: a run that dies before finds the same changes again
        overwrite_table(df, f"{paths.gold}/_lookups/{key}")
    return touched


def _replace_periods(spark: SparkSession, rows: DataFrame, path: str, periods: list[str], source: DataFrame, finish=None) -> None:
    """Replace ``periods`` of the table at ``path``; the periods that ``source`` has rows for are those of ``rows``."""
    left = {r[0] for r in source.select(PERIOD).distinct().collect()}
    if left:
        overwrite_partitions(rows, path, [PERIOD], finish=finish)
    drop_partitions(spark, path, [{PERIOD: p} for p in periods if p not in left])


# --- a whole batch ----------------------------------------------------------------

def apply_batch(spark: SparkSession, paths: LayerPaths, batch: str, raw_path: str | None = None,
                rules: QualityRules = TRANSACTION_RULES, gold: bool = True, fail_on_alert: bool = False,
                grain: str = "day", buckets: int | None = None) -> BatchReport:
    """Land (from ``raw_path``, unless it is landed), gate and publish one batch.

    ``batch`` must sort after every batch applied before, or be the last one
    again with the same rows. ``fail_on_alert`` raises after the batch is
    stored, as ``run_silver`` does.
    """
    state = f"{paths.root.rstrip('/')}/state/batches"
    last = read_table(spark, state).agg(F.max("batch")).first()[0] if table_exists(spark, state) else None
    if last is not None and batch < last:
        raise BatchOutOfOrder(f"batch {batch!r} comes after {last!r} was applied")
    if raw_path is not None:
        land_batch(spark, paths, batch, raw_path)
    report = apply_silver(spark, paths, batch, rules, grain, buckets)
    if gold:
        report.periods = refresh_gold(spark, paths, report.periods, grain)
    append_table(spark.createDataFrame([(batch, report.total_rows, report.quarantined_rows, report.retagged)],
                                       "batch string, total_rows long, quarantined_rows long, retagged long"), state)
    enforce_threshold(report.total_rows, report.quarantined_rows, rules.max_quarantine_pct, fail_on_alert)
    return report

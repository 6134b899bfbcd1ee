"""Layer plans: raw CSV -> bronze -> silver (+ quarantine) -> gold -> warehouse.

Each stage reads the tables the previous stage wrote (on shared storage) and
runs only after it succeeded, so a lost executor costs at most a stage retry
and the tables themselves cut lineage between stages.

Silver evaluates the quality gate once: the tagged rows are written a single
time, partitioned by outcome (``clean`` / ``quarantined``), while an
``Observation`` counts total and bad rows during that write. Silver and
quarantine then read their own partition folder (partition pruning), instead
of re-running the gate for every count and write.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, replace
from typing import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from lakelayer.functions.exprs import REASON_COL
from lakelayer.operators.conform import (
    clean_and_cast_transactions,
    conform_reference_table,
    conform_to_schema,
    latest_per_key,
)
from lakelayer.operators.marts import (
    build_daily_summary,
    build_dimensions,
    build_fact_sales,
    build_supply_chain_summary,
)
from lakelayer.operators.merge import merge_fact_sales, merge_upsert
from lakelayer.operators.placement import WAREHOUSE_PLACEMENT, place_for_write
from lakelayer.operators.quality import (
    TRANSACTION_RULES,
    QualityRules,
    enforce_threshold,
    tag_malformed_check,
    tag_quality,
)
from lakelayer.schemas import CORRUPT_RECORD, INGESTED_AT, REFERENCE_KEYS, SOURCE_FILE, SOURCE_SCHEMAS, SOURCES, WAREHOUSE
from lakelayer.sources.csv import ingest_sources, write_csv
from lakelayer.sources.tables import overwrite_table, publish, read_table

log = logging.getLogger("lakelayer")

OUTCOME_COL = "_dq_outcome"

# Deterministic "latest wins" order for reference tables with repeated keys. The newest
# ingest comes first, where the table is stamped; then the business date.
DEFAULT_REFERENCE_ORDER: dict[str, tuple[str, ...]] = {
    table: (INGESTED_AT, "ship_date") if table == "supply_chain" else (INGESTED_AT,) for table in REFERENCE_KEYS
}


@dataclass(frozen=True)
class LayerPaths:
    """Table folders of one lake; ``bronze_dir`` reads bronze from elsewhere."""

    root: str
    bronze_dir: str | None = None

    def _p(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}"

    @property
    def raw(self) -> str:
        return self._p("raw")

    @property
    def bronze(self) -> str:
        return self.bronze_dir or self._p("bronze")

    @property
    def checked(self) -> str:
        return self._p("checked")

    @property
    def silver(self) -> str:
        return self._p("silver")

    @property
    def quarantine(self) -> str:
        return self._p("quarantine")

    @property
    def gold(self) -> str:
        return self._p("gold")

    @property
    def warehouse(self) -> str:
        return self._p("warehouse")


def land_raw_extract(sources: Mapping[str, DataFrame], raw_dir: str, files: int | None = None) -> None:
    """Write each retail source as header CSV, gzipped, under ``raw/<name>.csv`` (the landing zone)."""
    for filename, _schema, table, _key in SOURCES:
        if table in sources:
            write_csv(sources[table], f"{raw_dir.rstrip('/')}/{filename}", files, compression="gzip")


def run_bronze(spark: SparkSession, paths: LayerPaths, tables=None, capture_malformed: bool = False) -> dict[str, int]:
    """Typed scan + stamp + append for every raw source (or only ``tables``).

    ``capture_malformed`` keeps the line of every record that does not fit its
    schema, for ``run_silver`` to quarantine.
    """
    sources = [s for s in SOURCES if tables is None or s[2] in tables]
    return ingest_sources(spark, paths.raw, paths.bronze, sources, capture_malformed)


@dataclass
class SilverReport:
    total_rows: int
    quarantined_rows: int
    quarantine_pct: float
    status: str
    silver_rows: dict[str, int] = field(default_factory=dict)


def _bronze_table(spark: SparkSession, paths: LayerPaths, table: str, malformed: bool = False) -> DataFrame:
    """A bronze table under its declared columns and the ingest stamps: no footer is read to find them.

    With ``malformed`` also the captured lines; files written without them give null.
    """
    lines = [StructField(CORRUPT_RECORD, StringType())] if malformed else []
    declared = StructType([*SOURCE_SCHEMAS[table].fields, *lines, StructField(INGESTED_AT, TimestampType()),
                           StructField(SOURCE_FILE, StringType())])
    return spark.read.schema(declared).parquet(f"{paths.bronze}/{table}")


def run_silver(spark: SparkSession, paths: LayerPaths, rules: QualityRules = TRANSACTION_RULES,
               legacy_prefix: bool = False, reference_order: Mapping[str, tuple[str, ...]] | None = None,
               fail_on_alert: bool = False, dedupe_scope: str = "all",
               reference_tables=None, quarantine_malformed: bool = False) -> SilverReport:
    """Gate transactions once, write silver + quarantine, conform reference tables.

    ``dedupe_scope="all"`` checks duplicates over all of bronze (the original
    behaviour: ingesting the same file twice quarantines every one of its
    rows). ``"batch"`` checks duplicates within each ingest batch (rows that
    share ``_ingested_at``) and keeps, per id, the row of the latest batch.
    ``quarantine_malformed`` sets aside records whose line bronze captured, with
    the line in ``_corrupt_record``.
    """
    bronze_tx = _bronze_table(spark, paths, "transactions", quarantine_malformed)
    if dedupe_scope not in ("all", "batch"):
        raise ValueError(f"unknown dedupe_scope {dedupe_scope!r}")
    gate_rules = rules
    if dedupe_scope == "batch" and rules.unique_columns:
        gate_rules = replace(rules, unique_columns=tuple(rules.unique_columns) + (INGESTED_AT,))
    tagged = tag_quality(bronze_tx, gate_rules, REASON_COL, legacy_prefix)
    if quarantine_malformed:
        tagged = tag_malformed_check(tagged, legacy_prefix=legacy_prefix)
    obs = Observation()
    outcome = F.when(F.col(REASON_COL).isNull(), F.lit("clean")).otherwise(F.lit("quarantined"))
    checked = tagged.withColumn(OUTCOME_COL, outcome).observe(
        obs, F.count(F.lit(1)).alias("total"), F.count(REASON_COL).alias("bad"))
    overwrite_table(checked, f"{paths.checked}/transactions", partition_by=[OUTCOME_COL])
    total, bad = int(obs.get.get("total", 0)), int(obs.get.get("bad", 0))
    written = read_table(spark, f"{paths.checked}/transactions")
    clean = written.where(F.col(OUTCOME_COL) == "clean").drop(OUTCOME_COL, REASON_COL, CORRUPT_RECORD)
    quarantined = written.where(F.col(OUTCOME_COL) == "quarantined").drop(OUTCOME_COL)
    overwrite_table(quarantined, f"{paths.quarantine}/transactions")
    # The gate quarantined every repeated transaction id, so dedupe is a no-op
    # unless the rules checked a different key or only within batches.
    if dedupe_scope == "batch":
        silver_tx = latest_per_key(clean_and_cast_transactions(clean, dedupe=False), ["transaction_id"],
                                   [INGESTED_AT])
    else:
        dedupe = tuple(rules.unique_columns) != ("transaction_id",)
        silver_tx = clean_and_cast_transactions(clean, dedupe=dedupe)
    counts = {"transactions": overwrite_table(silver_tx, f"{paths.silver}/transactions")}
    # Both tables are stored before an alert can end the run, so the bad rows can be read.
    pct, status = enforce_threshold(total, bad, rules.max_quarantine_pct, fail_on_alert, log)

    counts |= run_references(spark, paths, reference_order, reference_tables)
    return SilverReport(total, bad, pct, status, counts)


def run_references(spark: SparkSession, paths: LayerPaths, reference_order: Mapping[str, tuple[str, ...]] | None = None,
                   reference_tables=None) -> dict[str, int]:
    """The reference tables of silver (or only ``reference_tables``), conformed from bronze; rows of each."""
    order = dict(DEFAULT_REFERENCE_ORDER if reference_order is None else reference_order)
    counts = {}
    for table, key in REFERENCE_KEYS.items():
        if reference_tables is not None and table not in reference_tables:
            continue
        bronze = _bronze_table(spark, paths, table)
        counts[table] = overwrite_table(conform_reference_table(bronze, key, order.get(table)),
                                        f"{paths.silver}/{table}")
    return counts


def read_layer(spark: SparkSession, layer_dir: str, tables) -> dict[str, DataFrame]:
    return {t: read_table(spark, f"{layer_dir.rstrip('/')}/{t}") for t in tables}


def run_gold(spark: SparkSession, paths: LayerPaths, export_files: int | None = None) -> dict[str, int]:
    """Fact, dimensions and summaries from silver; each published with its Parquet export."""
    silver = read_layer(spark, paths.silver, ["transactions", *REFERENCE_KEYS])
    fact = build_fact_sales(silver["transactions"])
    counts = {"fact_sales": publish(spark, fact, paths.gold, "fact_sales", partition_col="date_key",
                                    export_files=export_files)}
    for dim, df in build_dimensions(silver).items():
        counts[dim] = publish(spark, df, paths.gold, dim, export_files=export_files)
    counts["fact_supply_chain_summary"] = publish(
        spark, build_supply_chain_summary(silver["supply_chain"]), paths.gold,
        "fact_supply_chain_summary", export_files=export_files)
    # The summary reads the fact as written (its flat export needs no partition discovery).
    gold_fact = read_table(spark, f"{paths.gold}/fact_sales_parquet")
    daily = build_daily_summary(gold_fact, silver["products"], silver["categories"], silver["stores"],
                                silver["regions"], sort=False)
    counts["gold_daily_merchandising_summary"] = publish(
        spark, daily, paths.gold, "gold_daily_merchandising_summary", export_files=export_files)
    return counts


@dataclass
class WarehouseReport:
    rows: dict[str, int]
    violations: dict[str, int]


class WarehouseViolations(RuntimeError):
    """Raised by ``publish_warehouse(on_violation="fail")`` when a row breaks its table's declaration."""


def publish_warehouse(spark: SparkSession, gold_dir: str, warehouse_dir: str,
                      previous_fact: DataFrame | None = None, on_violation: str = "report") -> WarehouseReport:
    """Reload every warehouse table from the gold Parquet exports; upsert the fact.

    Each table is conformed to its declared types (P6); rows that break a NOT
    NULL column, a cast or a text length are written to ``_violations/<table>``
    and counted. ``on_violation``: ``"report"`` loads them all the same,
    ``"reject"`` leaves them out, ``"fail"`` raises before that table is loaded.
    ``fact_sales`` is merged into ``previous_fact`` (the warehouse's current
    fact table) when given, else loaded whole.
    """
    if on_violation not in ("report", "reject", "fail"):
        raise ValueError(f"unknown on_violation {on_violation!r}")
    gold_dir, warehouse_dir = gold_dir.rstrip("/"), warehouse_dir.rstrip("/")
    rows, violations = {}, {}
    for table, schema in WAREHOUSE.items():
        staged = read_table(spark, f"{gold_dir}/{table}_parquet")
        conformed = conform_to_schema(staged, schema, on_violation="report" if on_violation == "fail" else on_violation)
        violations[table] = overwrite_table(conformed.violations, f"{warehouse_dir}/_violations/{table}")
        if violations[table] and on_violation == "fail":
            raise WarehouseViolations(f"{violations[table]} rows of {table}: see {warehouse_dir}/_violations/{table}")
        out = conformed.rows
        if table == "fact_sales" and previous_fact is not None:
            out = merge_fact_sales(previous_fact, out)
        rows[table] = overwrite_table(place_for_write(out, WAREHOUSE_PLACEMENT[table]), f"{warehouse_dir}/{table}")
    return WarehouseReport(rows, violations)


def upsert_table(spark: SparkSession, updates: DataFrame, current_path: str | None, new_path: str,
                 keys: list[str], update_columns: list[str] | None = None) -> int:
    """M2: merge ``updates`` into the table at ``current_path``, writing ``new_path``.

    A Parquet folder cannot be rewritten while it is read, so the merged
    table goes to a new folder and the caller switches readers to it.
    ``current_path=None`` (first load) writes ``updates`` as they are.
    ``update_columns`` defaults to every non-key column. Re-applying the same
    updates to the result gives the same table.
    """
    if current_path is None:
        return overwrite_table(updates, new_path)
    current = read_table(spark, current_path)
    update_columns = update_columns or [c for c in current.columns if c not in keys]
    return overwrite_table(merge_upsert(current, updates.select(*current.columns), keys, update_columns),
                           new_path)


@dataclass
class RunReport:
    bronze: dict[str, int]
    silver: SilverReport
    gold: dict[str, int]


def run_layers(spark: SparkSession, paths: LayerPaths, rules: QualityRules = TRANSACTION_RULES,
               fail_on_alert: bool = False, export_files: int | None = None) -> RunReport:
    """Bronze, then silver, then gold; each only after the previous one succeeded."""
    bronze = run_bronze(spark, paths)
    silver = run_silver(spark, paths, rules, fail_on_alert=fail_on_alert)
    gold = run_gold(spark, paths, export_files=export_files)
    return RunReport(bronze, silver, gold)

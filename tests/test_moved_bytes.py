"""What the layer plans write and move: gzipped landings, zstd layer tables, no table kept only to be counted."""

import os

from lakelayer.plans import catalog, incremental
from lakelayer.plans.incremental import apply_batch
from lakelayer.plans.medallion import run_bronze
from lakelayer.sources import tables

from test_incremental import BATCHES, RULES, checked_path, lake, land, local


def names(path):
    return [f for _, _, found in os.walk(local(path)) for f in found if not f.startswith(("_", "."))]


def test_landings_and_layer_tables_are_compressed(spark):
    paths = lake(spark, "bytes")
    assert all(n.endswith(".csv.gz") for n in names(paths.raw)) and names(paths.raw)
    apply_batch(spark, paths, "001", land(spark, paths, "001", BATCHES["001"]), RULES)
    for folder in (f"{paths.bronze}/products", f"{paths.silver}/products", checked_path(paths), f"{paths.gold}/fact_sales"):
        assert names(folder) and all(n.endswith(".zstd.parquet") for n in names(folder))
    run_bronze(spark, paths, tables=("products",))
    assert spark.read.parquet(f"{paths.bronze}/products").count() == 6


def test_a_batch_stores_no_rows_only_to_count_them(spark, monkeypatch):
    labels, own = [], incremental.materialize
    monkeypatch.setattr(incremental, "materialize", lambda df, label: labels.append(label) or own(df, label))
    paths = lake(spark, "counted")
    for batch in ("001", "002"):
        apply_batch(spark, paths, batch, land(spark, paths, batch, BATCHES[batch]), RULES)
    assert labels.count("batch-keys") == 2 and not {"retagged", "gold-periods"} & set(labels)


def test_the_load_sums_up_days_from_the_published_dimensions(spark, sf_small, monkeypatch):
    read, own = [], catalog.build_daily_summary

    def seen(fact, *dims, **kw):
        read.extend(f for d in dims for f in d.inputFiles())
        assert kw["sort"] is False
        return own(fact, *dims, **kw)

    monkeypatch.setattr(catalog, "build_daily_summary", seen)
    rows = {r.table_name: r.row_count for r in catalog.warehouse_load(spark, sf_small).collect()}
    assert read and all("_parquet/" in f for f in read) and rows["dim_region"] == 5


def test_a_fixed_number_of_files_is_merged_from_a_stored_table(spark, monkeypatch):
    labels, own = [], tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df, label: labels.append(label) or own(df, label))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = f"{local(catalog.work_dir(spark, 'files'))}/t"
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        assert tables.export_parquet(spark.range(50_000).repartition(9), path, files=4) == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert labels == ["export"] and len(names(path)) == 4 and spark.read.parquet(path).distinct().count() == 50_000

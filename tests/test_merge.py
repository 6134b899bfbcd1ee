"""Merge-upsert semantics and properties."""

import pytest

from lakelayer.operators.merge import DuplicateSourceKeys, merge_upsert

SCHEMA = "id string, a int, b string, c double"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: (t[0] is None, t[0] or "", str(t)))


def test_update_insert_keep(spark):
    target = spark.createDataFrame([("1", 1, "x", 1.0), ("2", 2, "y", 2.0), (None, 9, "n", 9.0)], SCHEMA)
    source = spark.createDataFrame([("2", 20, "Y", None), ("3", 30, "z", 3.0), (None, 8, "m", 8.0)], SCHEMA)
    out = merge_upsert(target, source, ["id"], ["a", "c"])
    assert _rows(out) == [("1", 1, "x", 1.0), ("2", 20, "y", None), ("3", 30, "z", 3.0),
                          (None, 8, "m", 8.0), (None, 9, "n", 9.0)]


def test_insert_column_subset(spark):
    target = spark.createDataFrame([("1", 1, "x", 1.0)], SCHEMA)
    source = spark.createDataFrame([("3", 30, "z", 3.0)], SCHEMA)
    out = merge_upsert(target, source, ["id"], ["a"], insert_columns=["id", "a"])
    assert _rows(out) == [("1", 1, "x", 1.0), ("3", 30, None, None)]


def test_twice_equals_once(spark):
    target = spark.createDataFrame([("1", 1, "x", 1.0), ("2", 2, "y", 2.0)], SCHEMA)
    source = spark.createDataFrame([("2", 20, "Y", None), ("3", 30, "z", 3.0)], SCHEMA)
    once = merge_upsert(target, source, ["id"], ["a", "b", "c"])
    twice = merge_upsert(once, source, ["id"], ["a", "b", "c"])
    assert _rows(once) == _rows(twice)


def test_repeated_source_key_fails(spark):
    target = spark.createDataFrame([("1", 1, "x", 1.0)], SCHEMA)
    source = spark.createDataFrame([("2", 1, "a", 1.0), ("2", 2, "b", 2.0)], SCHEMA)
    with pytest.raises(DuplicateSourceKeys):
        merge_upsert(target, source, ["id"], ["a"])


def test_many_null_target_keys_survive(spark):
    from pyspark.sql import functions as F

    target = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").cast("int").alias("a"), F.lit("t").alias("b"), F.lit(0.0).alias("c"))
    source = spark.createDataFrame([("1", 100, "s", 1.0)], SCHEMA)
    out = merge_upsert(target, source, ["id"], ["a"])
    assert out.count() == 2000
    assert out.where("id = '1'").collect()[0].a == 100
    assert out.where("id is null").count() == 1000


def test_repeated_target_key_is_updated_everywhere(spark):
    target = spark.createDataFrame([("1", 1, "x", 1.0), ("1", 2, "y", 2.0), ("2", 3, "z", 3.0)], SCHEMA)
    source = spark.createDataFrame([("1", 10, "s", 0.0)], SCHEMA)
    out = merge_upsert(target, source, ["id"], ["a"])
    assert _rows(out) == [("1", 10, "x", 1.0), ("1", 10, "y", 2.0), ("2", 3, "z", 3.0)]


def test_target_types_stay_and_values_must_fit(spark):
    target = spark.createDataFrame([("1", 1, "x", 1.0)], SCHEMA)
    wide = spark.createDataFrame([("1", 7, "w", 2.0)], "id string, a bigint, b string, c double")
    out = merge_upsert(target, wide, ["id"], ["a", "c"])
    assert out.schema["a"].dataType == target.schema["a"].dataType and _rows(out) == [("1", 7, "x", 2.0)]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        merge_upsert(target, wide.selectExpr("id", "9999999999 AS a", "b", "c"), ["id"], ["a"]).collect()


def test_each_side_is_read_and_shuffled_once(spark):
    from lakelayer.session import work_dir

    base = work_dir(spark, "merge-plan")
    spark.createDataFrame([("1", 1, "x", 1.0)], SCHEMA).write.parquet(f"{base}/t")
    spark.createDataFrame([("2", 1, "x", 1.0)], SCHEMA).write.parquet(f"{base}/s")
    out = merge_upsert(spark.read.parquet(f"{base}/t"), spark.read.parquet(f"{base}/s"), ["id"], ["a"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("FullOuter") == 1

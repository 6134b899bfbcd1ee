"""Partitioned Parquet tables that are changed one partition at a time.

``overwrite_partitions`` replaces the partitions that its rows fall in and
leaves every other folder as it is. A partition that has lost its last row gets
no rows, so nothing overwrites it; ``drop_partitions`` takes it away.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakelayer.sources.tables import LAYER_COMPRESSION

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def overwrite_partitions(df: DataFrame, path: str, by: list[str], files_by: list[str] | None = None,
                         finish: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Replace the partitions of ``path`` that ``df`` has rows for; returns the rows written.

    Rows are rebalanced on the partition columns (or ``files_by``), so that AQE
    sizes the files and splits a hot partition over several tasks. ``df`` may
    read other or the same partitions of ``path``: Spark moves the new files in
    when all of them are written. ``finish`` adds columns that follow from the
    others after the rebalance, so that they do not travel.
    """
    obs = Observation()
    # Counted last: below the rebalance, an empty input is planned away, count and all.
    rows = df.hint("rebalance", *(files_by or by))
    rows = (finish(rows) if finish else rows).observe(obs, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", LAYER_COMPRESSION).partitionBy(
        *by).parquet(path)
    return int(obs.get.get("rows", 0))


def partition_folder(path: str, values: Mapping[str, object]) -> str:
    """The folder of one partition, as Spark names it."""
    parts = [f"{name}={NULL_PARTITION if v is None else quote(str(v), safe=' -_.,@()')}" for name, v in values.items()]
    return "/".join([path.rstrip("/"), *parts])


def drop_partitions(spark: SparkSession, path: str, partitions: Iterable[Mapping[str, object]]) -> int:
    """Delete whole partitions of ``path``; those that are not there are passed over."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    for values in partitions:
        folder = jvm.org.apache.hadoop.fs.Path(partition_folder(path, values))
        dropped += bool(folder.getFileSystem(conf).delete(folder, True))
    return dropped


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether something has been written at ``path``."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder))

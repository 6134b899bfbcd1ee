"""Layer tables on shared storage: read, append, overwrite, partitioned write, export.

Tables are Parquet folders (Delta when the ``delta`` package is installed and
``fmt="delta"`` is asked for). Row counts are gathered with ``Observation``
during the write, so reporting a count never re-runs the plan.

A Parquet folder cannot be overwritten while it is also being read; a plan
that rewrites a table from itself (the merge) writes a new folder and reads
from it afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


LAYER_COMPRESSION = "zstd"  # of tables that only Spark reads; exports keep the session's codec, which other loaders know


def _fmt_ok(fmt: str) -> str:
    if fmt == "delta":
        try:
            import delta  # noqa: F401
        except ImportError as exc:  # pragma: no cover - depends on the image
            raise RuntimeError("fmt='delta' needs the delta-spark package") from exc
    return fmt


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Read a layer table; ``merge_schema`` unions the schemas of appended files."""
    reader = spark.read.format(_fmt_ok(fmt))
    if merge_schema and fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def _write_counted(df: DataFrame, path: str, mode: str, fmt: str,
                   partition_by: list[str] | None = None, compression: str | None = LAYER_COMPRESSION) -> int:
    obs = Observation()
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(_fmt_ok(fmt)).mode(mode)
    if fmt == "delta":
        writer = writer.option("mergeSchema" if mode == "append" else "overwriteSchema", "true")
    elif compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get.get("rows", 0))


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """S3: append rows; new columns are allowed (read back with ``merge_schema``)."""
    return _write_counted(df, path, "append", fmt)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: list[str] | None = None) -> int:
    """Full refresh (truncate and reload), optionally Hive-partitioned."""
    return _write_counted(df, path, "overwrite", fmt, partition_by)


def export_parquet(df: DataFrame, path: str, files: int | None = None) -> int:
    """Plain Parquet copy for outside loaders.

    ``files=None`` keeps the input partitioning (one file per task). A fixed
    ``files`` repartitions (a shuffle) rather than ``coalesce``, which would
    pull the whole upstream stage into that many tasks; ``files=1`` is only
    sensible for small tables. The rows are stored first: a table that many
    tasks read is then merged into ``files`` by reading its columns, a third of
    what a shuffle of whole rows brings to each task.
    """
    out = df
    if files:
        out, _ = materialize(df, "export")
        out = out.coalesce(files) if out.rdd.getNumPartitions() >= 2 * files else out.repartition(files)
    return _write_counted(out, path, "overwrite", "parquet", compression=None)


def publish(spark: SparkSession, df: DataFrame, gold_dir: str, table: str,
            partition_col: str | None = None, export_files: int | None = None,
            fmt: str = "parquet") -> int:
    """Write a gold table and its flat Parquet export; return the row count.

    ``df`` is computed once, into the flat export (which also yields the row
    count). The layer table, Hive-partitioned when ``partition_col`` is set,
    is then written from that export: reading a flat folder needs no partition
    discovery, and the partitioned write goes through a ``rebalance`` on the
    partition column, so AQE sizes the output files and splits a hot
    partition value over several tasks.
    """
    base = gold_dir.rstrip("/")
    export_path = f"{base}/{table}_parquet"
    rows = export_parquet(df, export_path, export_files)
    flat = read_table(spark, export_path).select(*df.columns)
    if partition_col:
        flat = flat.hint("rebalance", partition_col)
    overwrite_table(flat, f"{base}/{table}", fmt, [partition_col] if partition_col else None)
    return rows


def materialize(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` once to a fresh folder under the shared checkpoint folder;
    return it read back, with its row count (observed during the write).

    Cuts lineage like ``checkpoint()`` but stores Parquet, and yields the size
    needed for a broadcast decision without a second job.
    """
    from lakelayer.session import work_dir

    spark = df.sparkSession
    path = work_dir(spark, label)
    rows = _write_counted(df, path, "overwrite", "parquet")
    return read_table(spark, path), rows

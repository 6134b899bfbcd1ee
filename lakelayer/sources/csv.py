"""Typed CSV sources and ingest stamping (the raw -> bronze edge).

S1 ``read_typed_csv``: header row, declared schema, no inference, PERMISSIVE
mode (a malformed field becomes null, short records are null-filled, extra
fields are dropped), empty and quoted-empty fields become null. With
``capture_malformed`` the whole line of such a record is kept beside its fields,
so the gate can set it aside (``tag_malformed_check``) and it can be repaired.
S2 ``stamp_ingest``: ``_ingested_at`` and ``_source_file``.
S4 ``ingest_sources``: the registry loop over every raw file.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakelayer.schemas import CORRUPT_RECORD, INGESTED_AT, SOURCE_FILE, SOURCES


def read_typed_csv(spark: SparkSession, path: str, schema: StructType,
                   enforce_header: bool = False, capture_malformed: bool = False) -> DataFrame:
    """Read header CSV with a declared schema.

    Columns bind by position, as in any schema'd CSV read. ``enforce_header``
    makes a header that does not name the schema's columns fail the read.
    ``capture_malformed`` adds ``_corrupt_record``: the line as it came where it
    has too few or too many fields or a field that is not of its type, else null.
    """
    if capture_malformed:
        schema = StructType([*schema.fields, StructField(CORRUPT_RECORD, StringType())])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").schema(schema)
    if capture_malformed:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    if enforce_header:
        reader = reader.option("enforceSchema", False)
    return reader.csv(path)


def stamp_ingest(df: DataFrame, source_file: str | None = None) -> DataFrame:
    """Add the ingest time and the source file name.

    ``source_file=None`` takes each row's real file name from the scan's
    ``_metadata`` column (useful when a folder of many files is read).
    """
    name = F.lit(source_file) if source_file is not None else F.col("_metadata.file_name")
    return df.withColumn(INGESTED_AT, F.current_timestamp()).withColumn(SOURCE_FILE, name)


def write_csv(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite",
              compression: str | None = None, partition_by: list[str] | None = None) -> None:
    """Write header CSV keeping leading/trailing spaces (the writer trims them by default).

    A gzip file is read by one task, so files should be of a task's size.
    """
    out = df.repartition(files) if files else df
    writer = (
        out.write.mode(mode).option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_lines(lines: DataFrame, header: str, path: str) -> None:
    """Write ready-made CSV lines (one text column) as they are, each file under ``header``."""
    name = lines.columns[0]
    # A CSV writer without quotes and escapes puts each line down unchanged; \x01 stands in no line.
    (
        lines.select(F.col(name).alias(header)).write.mode("overwrite").option("header", True)
        .option("sep", "\x01").option("quote", "").option("escapeQuotes", False)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def ingest_source(spark: SparkSession, raw_dir: str, filename: str, schema: StructType,
                  table: str, bronze_dir: str, capture_malformed: bool = False) -> int:
    """S1 + S2 + S3: scan one raw file, stamp it, append it to its bronze table."""
    from lakelayer.sources.tables import append_table

    rows = read_typed_csv(spark, f"{raw_dir.rstrip('/')}/{filename}", schema, capture_malformed=capture_malformed)
    df = stamp_ingest(rows, filename)
    return append_table(df, f"{bronze_dir.rstrip('/')}/{table}")


def ingest_sources(spark: SparkSession, raw_dir: str, bronze_dir: str,
                   sources: Iterable[tuple] = SOURCES, capture_malformed: bool = False) -> dict[str, int]:
    """Ingest every registered source; returns appended rows per table."""
    return {table: ingest_source(spark, raw_dir, filename, schema, table, bronze_dir, capture_malformed)
            for filename, schema, table, _key in sources}

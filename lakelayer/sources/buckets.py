"""Bucketed Parquet tables: rows laid out by a hash of their key, known to the catalog.

A join or an aggregate on the key reads such a table without an exchange. The
table lives at a path of its own; a session whose catalog does not know it yet
declares it there again, so the layout outlives the session.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakelayer.sources.partitions import table_exists
from lakelayer.sources.tables import overwrite_table, read_table


def default_buckets(spark: SparkSession) -> int:
    """As many as shuffle partitions: with fewer, Spark would shuffle both sides of a join to gain tasks."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@dataclass(frozen=True)
class BucketedTable:
    """A bucketed table at ``path``; ``schema`` names its columns, ``keys`` those it is bucketed by."""

    path: str
    schema: StructType
    keys: tuple[str, ...]
    buckets: int

    @property
    def name(self) -> str:
        told = f"{self.path}|{self.keys}|{self.buckets}"
        return f"lakelayer_{hashlib.sha256(told.encode()).hexdigest()[:16]}"

    def declare(self, spark: SparkSession) -> None:
        if spark.catalog.tableExists(self.name):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        path = self.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def read(self, spark: SparkSession) -> DataFrame:
        self.declare(spark)
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name)

    def write(self, df: DataFrame, mode: str = "append", spread: int = 1) -> None:
        """Append rows, or replace the table (``mode="overwrite"``).

        Each bucket is written by ``spread`` tasks, dealt by a hash of the whole
        row, so that a key with a third of all rows does not land in one task.
        One file a bucket (``spread=1``) keeps the table sorted for merge joins.
        ``spread=0`` writes rows where they are, without an exchange: a file for
        each task and bucket, for few large rows.
        """
        spark = df.sparkSession
        self.declare(spark)
        rows = df.select(*self.schema.fieldNames())
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets))  # how Spark deals rows to buckets
        if spread == 1:
            rows = rows.repartition(self.buckets, *self.keys)
        elif spread > 1:
            salt = F.pmod(F.xxhash64(*rows.columns), F.lit(spread))
            rows = rows.repartition(self.buckets * spread, bucket, salt)
        rows.write.insertInto(self.name, overwrite=mode == "overwrite")


def bucketed(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str],
             buckets: int | None = None) -> BucketedTable:
    """The bucketed table at ``path``: with the buckets it was made with, else ``buckets`` or as many as shuffle partitions.

    The number is stored beside the table, since files dealt to another number
    of buckets cannot be read as these.
    """
    layout = f"{path.rstrip('/')}.layout"
    if table_exists(spark, layout):
        found = read_table(spark, layout).first()[0]
        if buckets not in (None, found):
            raise ValueError(f"{path} has {found} buckets, not {buckets}")
        return BucketedTable(path, schema, tuple(keys), found)
    buckets = buckets or default_buckets(spark)
    overwrite_table(spark.createDataFrame([(buckets,)], "buckets int"), layout)
    return BucketedTable(path, schema, tuple(keys), buckets)

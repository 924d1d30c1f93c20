"""Table scans.

Every scan names the columns it needs, so the parquet ``ReadSchema`` is pruned at the
source even before Catalyst's own column pruning, and filters written on top of the
scan are pushed into the parquet reader. Tasks are bounded by the size of the tables that
are read (``bounded_tasks``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from paidpath.operators.sizing import bounded_tasks

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    df = bounded_tasks(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))
    return df.select(*columns) if columns else df


class Catalog:
    """A callable handle on one data directory: ``t("orders", [cols])``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, columns)


class TableCatalog:
    """Reads tables registered in the session catalog (``spark.table``), optionally
    qualified by a database / schema. Same call shape as :class:`Catalog`, so every
    binding and model runs unchanged over metastore tables or views."""

    def __init__(self, spark: SparkSession, database: str | None = None, names: dict | None = None):
        self.spark = spark
        self.database = database
        self.names = names or {}        # role table -> physical table name, when they differ
        self.sf_dir = None

    def __call__(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        physical = self.names.get(name, name)
        full = f"{self.database}.{physical}" if self.database else physical
        df = bounded_tasks(self.spark.table(full))
        return df.select(*columns) if columns else df

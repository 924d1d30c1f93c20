"""Sinks: full refresh (W36) and month-partitioned incremental refresh.

Tables are written under the cluster's shared checkpoint folder (``spark.checkpoint.dir``)
or an explicit shared path, never under a machine-local temporary folder; a written table
also cuts lineage for later stages.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paidpath.functions.calendar import add_months_py, lit_date, month_start
from paidpath.session import ensure_checkpoint_dir
from paidpath.sources.versions import MonthTable


CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A fresh table location under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def _folder(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def drop_months(spark: SparkSession, path: str, month_col: str, which: Callable[[dt.date], bool]) -> None:
    """Delete the month partitions of ``path`` that ``which`` selects (none if there is no
    table yet). Only folder names are read: as many as the calendar has months."""
    fs, hpath = _folder(spark, path)
    if not fs.exists(hpath):
        return
    for status in fs.listStatus(hpath):
        column, _, value = status.getPath().getName().partition("=")
        if column == month_col and value != "__HIVE_DEFAULT_PARTITION__" and which(dt.date.fromisoformat(value)):
            fs.delete(status.getPath(), True)


def full_refresh(df: DataFrame, path: str | None = None, partition_by: list[str] | None = None,
                 table: str | None = None) -> DataFrame:
    """Replace the whole table (TRUNCATE + INSERT) and return it read back. Writes a
    parquet location, or a catalog table when ``table`` is given."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table is not None:
        w.saveAsTable(table)
        return df.sparkSession.table(table)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def bucketed_table(df: DataFrame, name: str, key: str = "member_id", buckets: int | None = None) -> DataFrame:
    """``df`` as a table whose files are dealt by ``key`` into ``buckets`` (as many as shuffle
    partitions, if not given) and sorted by it. Joins, aggregates and windows on the key, over
    tables of equal buckets, then need no exchange: each task reads one bucket of every table.
    Meant for tables with few rows a key (member-months, attributes); a bucket is not split,
    so a log in which one key holds a third of all rows should be joined by key and time.
    The files lie in the shared folder, the name is unique in the session's catalog.

    Spark deals joins on the key *and* other columns by all of them unless
    ``requireAllClusterKeysForCoPartition`` is off; it is switched off here, if the session
    does not say otherwise."""
    spark = df.sparkSession
    if CO_PARTITION not in spark.conf.getAll:
        spark.conf.set(CO_PARTITION, "false")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"bucketed_{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", scratch_table_path(spark, name)).saveAsTable(table))
    return spark.table(table)


def refresh_recent_months(build: Callable[[bool], DataFrame], path: str, as_of: dt.date,
                          month_col: str, lookback_months: int = 2) -> DataFrame:
    """Recompute only months >= (month of ``as_of``) - ``lookback_months``.

    ``build(incremental)`` returns the model; with ``incremental=True`` it may read only
    the recent events. The first run (no table yet) is a full build. Later runs write the
    months of that span as a new version of the table (:class:`MonthTable`), so a month that
    has no rows any more goes too, a month-aligned model gives the same table as a full
    refresh, and a reader never sees a month missing, nor does a failed run change the table."""
    table = MonthTable(SparkSession.getActiveSession(), path, month_col)
    if not table.version():
        table.replace(build(False))
        return table.read()
    cutoff = add_months_py(month_start(as_of), -lookback_months)
    table.replace(build(True).filter(F.col(month_col) >= lit_date(cutoff)), lambda month: month is not None and month >= cutoff)
    return table.read()

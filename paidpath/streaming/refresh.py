"""Streaming form of the incremental monthly refresh.

The models run in batch; the only time-incremental rule in them is "recompute the current
month and the two before it" (late events up to two months old are absorbed). As a
Structured Streaming job this is a ``foreachBatch`` sink: each micro-batch of new events
names the months it touches (a small distinct set), and those months are recomputed from
the full event table and replaced, so a month left without rows goes too. Into a ``MonthTable``
they go as one new version: no reader misses a month. Into a plain folder they are written with
dynamic partition overwrite after their partitions are deleted, and a reader in between misses
them. State lives in the output table and the stream checkpoint, so a lost executor or a
restarted driver replays the micro-batch idempotently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paidpath.sources.sinks import drop_months
from paidpath.sources.versions import MonthTable


def month_refresher(rebuild_months: Callable[[DataFrame], DataFrame], path: str | MonthTable, month_col: str,
                    ts_col: str = "timestamp"):
    """foreachBatch handler: recompute the months present in the micro-batch."""

    def handle(batch: DataFrame, epoch_id: int) -> None:
        months = batch.select(F.trunc(ts_col, "month").alias(month_col)).distinct()
        out = rebuild_months(months)
        touched = {r[0] for r in months.collect()}  # as many as the calendar has months
        if isinstance(path, MonthTable):
            path.replace(out, touched.__contains__)
            return
        drop_months(batch.sparkSession, path, month_col, touched.__contains__)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month_col).parquet(path)

    return handle


def start_monthly_refresh(spark: SparkSession, source_dir: str, schema, rebuild_months, path: str | MonthTable,
                          checkpoint: str, month_col: str = "month_of_activity", ts_col: str = "timestamp",
                          prepare: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True):
    """Start a stream over parquet files of events feeding :func:`month_refresher`."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    if prepare is not None:
        stream = prepare(stream)
    w = stream.writeStream.foreachBatch(month_refresher(rebuild_months, path, month_col, ts_col)).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()

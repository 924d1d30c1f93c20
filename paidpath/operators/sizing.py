"""Size-checked broadcast, and tasks of bounded size.

A mapping or dimension table is broadcast only when Catalyst's size statistics are small:
``sizeInBytes`` of the optimized plan is the file size for a table scan and exact for an
in-memory literal, and (without cost-based estimates) never shrinks through filters,
projections or aggregates. Files are compressed, so a decoded table may be several times
larger; the limit is set low enough that ten times as much still fits a task. Beyond it the
DataFrame is returned unchanged, and the join is planned by measured size as usual: a
sort-merge join, or AQE's runtime broadcast when the shuffle output turns out small. No job
is run.

Shuffled rows are compressed, and a task that sorts and aggregates them holds thirty times
their bytes. Spark's own goal of 64 MB a task is 2 GB of memory then, so ``bounded_tasks``
lowers it; and as partitions are only ever put together, their number follows the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BYTES = 8 * 1024 * 1024
TASK_BYTES = 16 * 1024 * 1024  # of shuffled data, compressed, that a task reads
PARTITION_BYTES = 8 * 1024 * 1024  # of a stored table for each shuffle partition, before small ones are put together
TASK_KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARTITIONS_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_bounded(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def bounded_tasks(table: DataFrame) -> DataFrame:
    """``table``, a stored one, after the session's tasks are bounded for shuffles of its size: a
    smaller goal for what a task reads, unless the session has one of its own, and as many
    partitions as the table has PARTITION_BYTES, if that is more than there are. Changes how
    rows are dealt to tasks, never which."""
    conf = table.sparkSession.conf
    if TASK_KEY not in conf.getAll:
        conf.set(TASK_KEY, TASK_BYTES)
    wanted = -(-estimated_bytes(table) // PARTITION_BYTES)
    if wanted > int(conf.get(PARTITIONS_KEY, None) or conf.get("spark.sql.shuffle.partitions")):
        conf.set(PARTITIONS_KEY, wanted)
    return table

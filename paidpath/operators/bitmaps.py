"""Exact distinct counts that merge: members as bits of bitmaps.

A count of distinct members cannot be added up over days, a bitmap of them can. Members get
consecutive numbers from a dictionary that only grows. A state holds, per group and bucket of
32,768 numbers, a bitmap of 4 KB; states of days, files or segments merge by ``bitmap_or_agg``,
and the count is the sum of the buckets' bits. Building and merging are hash aggregates with a
partial step, so a hot group sends a bitmap per task and bucket.

Meant for groups that are few beside the members (days, labels, segments). Where groups are
small, as organizations, a plain distinct count moves less.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paidpath.session import materialize

NUMBER, BUCKET, BITMAP = "member_number", "_bits", "members"


def number_members(members: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """``key, member_number``: the dictionary ``known`` (as returned here) with every other
    non-null ``key`` of ``members`` appended, numbered from 1 without gaps.

    New keys are dealt by range and numbered inside their partition; a partition's first
    number comes from the partitions' sizes, a table of a row per partition. No task holds
    all keys."""
    new = members.select(key).where(F.col(key).isNotNull()).distinct()
    if known is not None:
        new = new.join(known.select(key), key, "left_anti")
    dealt = materialize(new.repartitionByRange(F.col(key)).withColumn("_part", F.spark_partition_id()), "dictionary")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("_part"), F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                                                     F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    last = F.lit(0) if known is None else F.coalesce(known.select(F.max(NUMBER)).scalar(), F.lit(0))
    out = dealt.withColumn("_inside", inside).join(before, "_part").select(key, (last + F.col("_before") + F.col("_inside")).cast("long").alias(NUMBER))
    return out if known is None else known.select(key, NUMBER).unionByName(out)


def member_states(rows: DataFrame, keys: Sequence[str], number: str = NUMBER) -> DataFrame:
    """``keys, _bits, members``: the distinct numbers of every group as bitmaps."""
    return (rows.where(F.col(number).isNotNull()).groupBy(*keys, F.call_function("bitmap_bucket_number", F.col(number)).alias(BUCKET))
            .agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col(number))).alias(BITMAP)))


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The states of coarser groups, or of several parts of the rows."""
    return states.groupBy(*keys, BUCKET).agg(F.call_function("bitmap_or_agg", F.col(BITMAP)).alias(BITMAP))


def member_counts(states: DataFrame, keys: Sequence[str], out: str = "members") -> DataFrame:
    """Distinct members per ``keys`` (some or all of the states' keys)."""
    n = F.call_function("bitmap_count", F.col(BITMAP))
    return merge_states(states, keys).groupBy(*keys).agg(F.sum(n).alias(out))


def trailing_states(states: DataFrame, day: str, keys: Sequence[str], days: int) -> DataFrame:
    """States of trailing windows: a day's row holds the members of that day and of the
    ``days`` - 1 before it. A day's bitmap goes to each window that holds it. Windows end on
    every day from the first state to ``days`` - 1 after the last."""
    ahead = F.explode(F.sequence(F.col(day), F.date_add(day, days - 1)))
    others = [c for c in states.columns if c != day]
    return merge_states(states.select(ahead.alias(day), *others), [day, *keys])

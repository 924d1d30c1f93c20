"""Days as bits: a member's active days in 64-bit masks, one for each 64 days.

A mask is an associative aggregate (``bit_or``), so it is combined before any shuffle and can
be kept and merged. Days inside a window are counted by masking and ``bit_count``: no join
or window row stands for a single day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64
CHUNK = "_chunk"


def _chunk(day: Column) -> Column:
    return F.floor(F.unix_date(day) / F.lit(BITS)).cast("int")


def _bit(day: Column) -> Column:
    return F.pmod(F.unix_date(day), F.lit(BITS))


def day_masks(activity: DataFrame, keys: list[str], day: str = "day", out: str = "mask") -> DataFrame:
    """``keys, _chunk, mask``: bit d of a chunk's mask is set if ``day`` d of it occurs."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col(day)))
    return (activity.where(F.col(day).isNotNull()).groupBy(*keys, _chunk(F.col(day)).alias(CHUNK))
            .agg(F.bit_or(bit).alias(out)))


def span_mask(first: Column, last: Column) -> Column:
    """The bits ``first`` to ``last`` (0 to 63) set."""
    ones = F.lit(-1).cast("long")
    return (F.call_function("shiftleft", ones, first)
            .bitwiseAND(F.call_function("shiftrightunsigned", ones, F.lit(BITS - 1) - last)))


def window_masks(windows: DataFrame, keys: list[str], first: str = "first", last: str = "last", out: str = "window") -> DataFrame:
    """``keys, _chunk, window``: the days that any of a key's windows covers, as masks. A
    window without a day (``last`` before ``first``) and one with a null end cover none."""
    w = windows.where(F.col(first) <= F.col(last))
    w = w.withColumn(CHUNK, F.explode(F.sequence(_chunk(F.col(first)), _chunk(F.col(last)))))
    begins = F.when(F.col(CHUNK) == _chunk(F.col(first)), _bit(F.col(first))).otherwise(0)
    ends = F.when(F.col(CHUNK) == _chunk(F.col(last)), _bit(F.col(last))).otherwise(BITS - 1)
    return w.groupBy(*keys, CHUNK).agg(F.bit_or(span_mask(begins, ends)).alias(out))


def days_in_windows(windows: DataFrame, activity: DataFrame, key: str, out: str) -> DataFrame:
    """Per key of ``windows`` (key, first, last), the distinct ``day`` of ``activity`` (key,
    day) inside at least one of its windows; 0 if there is none. A null key has no activity."""
    have = window_masks(windows, [key]).join(day_masks(activity, [key]), [key, CHUNK])
    n = have.groupBy(key).agg(F.sum(F.bit_count(F.col("window").bitwiseAND(F.col("mask")))).alias(out))
    return (windows.select(key).distinct().join(n, key, "left")
            .select(key, F.coalesce(F.col(out), F.lit(0)).cast("long").alias(out)))

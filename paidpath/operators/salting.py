"""Joining every row with its group's aggregate when one group may hold a third of all rows.

An equi-join on the group sends a hot group to one task, and AQE cannot split it where the
other side is the group's own aggregate. Here the aggregate counts its rows, so the hot
groups are measured, not guessed: a group is hot if it holds more rows than an average
partition. That can be true of as many groups as there are partitions at most, so the list
of hot groups is bounded and broadcast. Rows of a hot group are dealt to as many salts as
average partitions it fills, and its aggregate is repeated for each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS, SALT, SALTS = "_rows", "_salt", "_salts"


def hot_groups(groups: DataFrame, keys: Sequence[str], rows: str = ROWS) -> DataFrame:
    """``keys, _salts``: the groups with more than an average partition's rows, and how many
    such partitions they fill. At most ``spark.sql.shuffle.partitions`` rows."""
    partitions = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = groups.select(F.sum(rows)).scalar()
    share = F.col(rows) * partitions
    return groups.where(share > total).select(*keys, F.ceil(share / total).cast("int").alias(SALTS))


def join_aggregate(df: DataFrame, groups: DataFrame, keys: Sequence[str], rows: str = ROWS) -> DataFrame:
    """``df`` left-joined with ``groups`` (one row per ``keys``, with its number of ``rows``,
    which is dropped). Null keys match nothing, as in SQL. ``df`` must not have the names of
    this module's columns."""
    keys = list(keys)
    hot = F.broadcast(hot_groups(groups, keys, rows))
    place = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.col(SALTS)).cast("int")
    dealt = df.join(hot, keys, "left").withColumn(SALT, F.coalesce(place, F.lit(0))).drop(SALTS)
    repeated = (groups.drop(rows).join(hot, keys, "left")
                .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1))).drop(SALTS))
    return dealt.join(repeated, [*keys, SALT], "left").drop(SALT)

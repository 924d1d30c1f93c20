"""Spines and grids: period spine (W06), member-month shell (W07), densify onto a shell
(W08), entity x category grid (W09).

Design note (scale): a spine is generated *per row* with ``explode(sequence(...))`` so it
is produced in the tasks that already hold the entity rows. There is no theta join
(``month >= first_month``), which Spark can only plan as a nested-loop join, and no cross
join between entities and a calendar.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidpath.functions.calendar import last_complete_month_start, lit_date


def month_sequence(start: Column, stop: Column) -> Column:
    """Months from ``start`` to ``stop`` inclusive; empty when start > stop."""
    return F.when(start <= stop, F.sequence(start, stop, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>"))


def day_sequence(start: Column, stop: Column) -> Column:
    return F.when(start <= stop, F.sequence(start, stop, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>"))


def period_spine(anchor: DataFrame, start_col: str, as_of: dt.date, name: str = "month",
                 shell_start: dt.date | None = None) -> DataFrame:
    """One row per month from the earliest ``start_col`` (not before ``shell_start``)
    to the last complete month before ``as_of``."""
    first = anchor.agg(F.min(F.trunc(start_col, "month")).alias("_s"))
    start = F.col("_s") if shell_start is None else F.greatest(F.col("_s"), lit_date(shell_start))
    return first.select(F.explode(month_sequence(start, last_complete_month_start(as_of))).alias(name))


def member_month_shell(first_months: DataFrame, member: str, first_col: str, as_of: dt.date,
                       shell_start: dt.date | None = None, name: str = "mrr_month") -> DataFrame:
    """Every member x every month from the member's first month (and not before
    ``shell_start``) to the last complete month before ``as_of``."""
    start = F.trunc(first_col, "month")
    if shell_start is not None:
        start = F.greatest(start, lit_date(shell_start))
    return first_months.select(member, F.explode(month_sequence(start, last_complete_month_start(as_of))).alias(name))


def densify(fact: DataFrame, shell: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every shell row with the fact's values, null where the fact has no row.
    Keys compare with plain equality, so a null key never matches (as in SQL)."""
    s, f = shell.alias("_shell"), fact.alias("_fact")
    cond = [F.col(f"_shell.{k}") == F.col(f"_fact.{k}") for k in keys]
    return s.join(f, cond, "left").select(
        *[F.col(f"_shell.{k}") for k in keys],
        *[F.col(f"_shell.{c}") for c in shell.columns if c not in keys],
        *[F.col(f"_fact.{c}") for c in fact.columns if c not in keys])


def cross_categories(entities: DataFrame, categories: Sequence[str] | Column, overall: str | None = None,
                     name: str = "activity_category") -> DataFrame:
    """Entity x category grid plus an optional "overall" category.

    The grid is an ``explode`` of an array of labels on each entity row (no join, no shuffle
    of entities). ``categories``: the labels, or an array column such as ``label_set``."""
    if isinstance(categories, Column):
        arr = categories
    else:
        arr = F.array(*[F.lit(c) for c in dict.fromkeys(categories)]).cast("array<string>")
    if overall is not None:
        arr = F.array_union(arr, F.array(F.lit(overall)))
    return entities.select(F.explode(arr).alias(name), *entities.columns)


def label_set(df: DataFrame, col: str) -> Column:
    """The distinct labels of a mapping table as one array: a scalar subquery that Spark
    evaluates when the query runs. Nulls are no labels."""
    return df.agg(F.array_sort(F.collect_set(col)).alias("labels")).scalar()

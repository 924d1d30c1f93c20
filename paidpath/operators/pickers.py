"""Row pickers: latest row per key (W01), top payment per month (W02), one-to-one links
(W03), last value in a period (W04).

Design note (scale): "one row per key, highest in this order" is written as an
*aggregate* of ``max(struct(order..., payload...))`` rather than ``row_number()`` over a
window. The aggregate gets a map-side partial aggregation, so each input partition is
reduced to one row per key before the shuffle. A key holding a third of all rows then
costs one row per map task in the shuffle instead of a third of the table sorted in a
single window task. (With string fields in the struct Spark plans the partial step as a
sort-based aggregate, which spills instead of failing; the shuffle still carries one row
per key per map task.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidpath.operators.salting import ROWS, join_aggregate


def top_per_group(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                  payload: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the largest ``order_desc`` tuple.

    Ties on the whole order tuple are broken by the payload columns (largest wins), so
    the result never depends on input order. Nulls in an order column rank lowest, as in
    ``ORDER BY ... DESC NULLS LAST``.
    """
    payload = [c for c in (payload if payload is not None else df.columns)
               if c not in keys and c not in order_desc]
    fields = list(order_desc) + list(payload)
    best = F.max(F.struct(*[F.col(c) for c in fields])).alias("_best")
    agg = df.groupBy(*keys).agg(best)
    return agg.select(*keys, *[F.col("_best")[c].alias(c) for c in fields])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """Keep the row with the highest ``order_desc`` per key; every other column is a
    tie-breaker, so duplicate (key, version) pairs resolve the same way on every run."""
    others = [c for c in df.columns if c not in keys and c not in order_desc]
    out = top_per_group(df, keys, list(order_desc) + others, [])
    return out.select(*df.columns)


def top_payment_per_month(payments: DataFrame, member: str = "member_id", date: str = "payment_date",
                          amount: str = "amount_in_usd",
                          tie_breakers: Sequence[str] = ("plan_name", "billing_interval")) -> DataFrame:
    """One payment per member-month: largest amount, then latest date, then the
    tie-breaker columns (descending). Adds ``month``."""
    p = payments.withColumn("month", F.trunc(date, "month"))
    payload = [c for c in p.columns if c not in (member, "month", amount, date, *tie_breakers)]
    return top_per_group(p, [member, "month"], [amount, date, *tie_breakers], payload)


def one_to_one_links(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(left, right) pairs where the left id links to exactly one right id and the
    right id to exactly one left id. Null ids are not links."""
    e = edges.select(left, right).filter(F.col(left).isNotNull() & F.col(right).isNotNull())
    lone_left = e.groupBy(left).agg(F.count_distinct(right).alias("_n")).filter("_n = 1").select(left)
    lone_right = (e.groupBy(right).agg(F.count_distinct(left).alias("_n"), F.max(left).alias(left))
                   .filter("_n = 1").select(right, left))
    return lone_right.join(lone_left, left, "inner").select(right, left)


def single_valued(edges: DataFrame, key: str, value: str) -> DataFrame:
    """W03 (agreement form): keys whose non-null ``value`` is the same in every row/source;
    returns (key, value)."""
    return (edges.groupBy(key).agg(F.count_distinct(value).alias("_n"), F.max(value).alias(value))
                 .filter("_n = 1").select(key, value))


def last_in_period(df: DataFrame, value: str, partition: Sequence[str], order: Sequence[str],
                   ignore_nulls: bool = False, out: str | None = None) -> DataFrame:
    """Attach to every row the last ``value`` of its partition in ``order`` (optionally
    the last non-null one).

    Computed as a ``max_by`` aggregate joined back on the partition keys instead of an
    unbounded window: the aggregate is partially combined map-side, and counts its rows, so
    that the rows of a hot partition key are dealt to several tasks (operators/salting.py).
    """
    out = out or value
    ord_col = F.struct(*[F.col(c) for c in order])
    if ignore_nulls:
        ord_col = F.when(F.col(value).isNotNull(), ord_col)
    last = df.groupBy(*partition).agg(F.max_by(F.col(value), ord_col).alias(out), F.count("*").alias(ROWS))
    base = df.drop(out) if out in df.columns else df
    return join_aggregate(base, last, partition)

"""Money operators: first refund (W30), proportional allocation.

Allocation uses exact cent arithmetic: ``round(amount * weight / total, 2)`` is computed
as one integer division of cents with a single half-up rounding, so the result does not
depend on an engine's decimal-division scale rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cents(amount) -> Column:
    return (_c(amount) * 100).cast("bigint")


def half_up_div(n: Column, d: Column) -> Column:
    """Integer ``n / d`` rounded half away from zero, for ``d > 0``."""
    wide = "decimal(38,0)"
    q = F.call_function("div", (F.abs(n.cast(wide)) * 2 + d).cast(wide), (d * 2).cast(wide))
    return F.when(n >= 0, q).otherwise(-q)


def allocate(amount, weight, total) -> Column:
    """``round(amount * weight / total, 2)`` in exact cents; 0.00 when total is not > 0."""
    n = cents(amount).cast("decimal(19,0)") * _c(weight).cast("bigint").cast("decimal(18,0)")
    d = _c(total).cast("bigint")
    q = half_up_div(n, d)
    return F.when(d > 0, (q.cast("decimal(20,0)") / F.lit(100)).cast(MONEY)).otherwise(F.lit(0).cast(MONEY))


def allocate_proportionally(df: DataFrame, amount: str, weights: Sequence[str], total: str | None = None,
                            prefix: str = "", suffix: str = "_share") -> DataFrame:
    """Split ``amount`` across weight columns; shares are 0.00 when the weight total
    is 0. ``total`` defaults to the sum of ``weights`` (the source passes a different list
    for the total than for the shares, T12)."""
    tot = _c(total) if total else sum((F.col(w) for w in weights[1:]), F.col(weights[0]))
    return df.select("*", *[allocate(amount, w, tot).alias(f"{prefix}{w}{suffix}") for w in weights])


def first_refund(payments: DataFrame, base: DataFrame, key: str, start: str, first_payment: str,
                 days: int = 59, excluded_plan_pattern: str = "%Prorated%") -> DataFrame:
    """Earliest negative, non-prorated payment between the trial start day and the
    first payment day + ``days``."""
    day = F.to_date("payment_date")
    rng = base.select(F.struct(F.min(F.to_date(start)).alias("lo"),
                               F.max(F.date_add(F.to_date(first_payment), days)).alias("hi")).alias("r")).scalar()
    # refunds only; and only inside the anchors' overall range (runtime scalar subquery)
    p = payments.filter((F.col("amount_in_usd") < 0) & ~F.col("plan_name").like(excluded_plan_pattern) &
                        (day >= rng["lo"]) & (day <= rng["hi"]))
    j = p.join(base.select(key, start, first_payment), key)
    j = j.filter(day.between(F.to_date(start), F.date_add(F.to_date(first_payment), days)))
    return j.groupBy(key).agg(F.min("payment_date").alias("payment_date"))

"""Rolling paid base (M08): paying customers in the trailing calendar month, per day and
segment.

Plan shape: payments are reduced to one row per member-day-plan (partial aggregation),
then to one row per member-month (``top_per_group``, again partially aggregated), joined
to customer segments on ``member_id`` and counted per day and segment. Only that small daily
table is shuffled on the seven segment keys, for the running sum of what enters and leaves
the window (W20 in closed form: no day shell, no frames). The mapping tables (plans, service numbers) are
bounded literals, broadcast behind a size bound.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidpath.functions.calendar import lit_date
from paidpath.operators.pickers import top_per_group
from paidpath.operators.rolling import calendar_trailing_sum
from paidpath.operators.spines import day_sequence
from paidpath.operators.sizing import broadcast_if_bounded

SEGMENTS = ["market", "plan", "billing_interval", "trial_type", "trial_length", "acquisition_source",
            "signup_source"]


def paying_days(payments: DataFrame, plans: DataFrame, service_numbers: DataFrame, as_of: dt.date) -> DataFrame:
    """Member-day-plan totals of MRR payments, kept when both totals are positive."""
    pm = (plans.filter(F.col("include_in_mrr") == F.lit(True))
               .select("associated_plan", "plan_name", "billing_interval").distinct())
    p = payments.select("member_id", "payment_date", "amount", "amount_in_usd", "associated_plan", "service_no")
    day = F.to_date("payment_date")
    j = (p.filter(day <= lit_date(as_of))
          .join(broadcast_if_bounded(pm), "associated_plan")
          .join(broadcast_if_bounded(service_numbers), "service_no")
          .filter(F.col("exclude_from_mrr") == F.lit(False)))
    return (j.groupBy("member_id", day.alias("payment_date"), "plan_name", "billing_interval")
             .agg(F.sum("amount").alias("amount"), F.sum("amount_in_usd").alias("amount_in_usd"))
             .filter((F.col("amount") > 0) & (F.col("amount_in_usd") > 0)))


def top_paying_day_per_month(days: DataFrame) -> DataFrame:
    """W02 on paying days: each member-month keeps its largest payment (then latest day,
    then plan and interval, descending). Returns (date, member_id, plan_name,
    billing_interval, amount_in_usd)."""
    d = days.withColumn("month", F.trunc("payment_date", "month"))
    top = top_per_group(d, ["member_id", "month"], ["amount_in_usd", "payment_date", "plan_name", "billing_interval"], [])
    return top.select(F.col("payment_date").alias("date"), "member_id", "plan_name", "billing_interval",
                      "amount_in_usd")


def daily_paying(top: DataFrame, customers: DataFrame) -> DataFrame:
    seg = top.join(customers.select("member_id", "market", "trial_type", "trial_length", "acquisition_source",
                                    "signup_source"), "member_id")
    return (seg.groupBy("date", "market", F.col("plan_name").alias("plan"), "billing_interval", "trial_type",
                        "trial_length", "acquisition_source", "signup_source")
               .agg(F.count_distinct("member_id").alias("num_paying_daily")))


def segment_day_shell(daily: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per segment and day, from the segment's first paying day to ``as_of``.

    Generated per segment row with ``explode(sequence)``: no calendar cross join."""
    first = daily.groupBy(*SEGMENTS).agg(F.min("date").alias("_first"))
    return first.select(F.explode(day_sequence(F.col("_first"), lit_date(as_of))).alias("date"), *SEGMENTS)


def rolling_paid_base(payments: DataFrame, plans: DataFrame, service_numbers: DataFrame,
                      customers: DataFrame, as_of: dt.date, shell: DataFrame | None = None) -> DataFrame:
    """Per day and segment, paying customers in the trailing calendar month.

    Rows are the days on which the window holds a payer, up to ``as_of``. With a ``shell`` (one
    row per segment and day) they are those of its days, and payers of other days do not count."""
    daily = daily_paying(top_paying_day_per_month(paying_days(payments, plans, service_numbers, as_of)), customers)
    by = ["date", *SEGMENTS]
    if shell is not None:
        shell = shell.select(*by).distinct()
        daily = daily.join(shell, by, "left_semi")
    rolled = calendar_trailing_sum(daily, "num_paying_daily", SEGMENTS, "date", lit_date(as_of), out="num_paying")
    if shell is not None:
        rolled = rolled.join(shell, by, "left_semi")
    return rolled.select("date", *SEGMENTS, F.col("num_paying").cast("bigint").alias("num_paying"))

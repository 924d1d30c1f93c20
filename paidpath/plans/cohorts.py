"""Weekly activity-risk cohorts (M01) and the models the catalogue describes without SQL
(M11-M15: daily and monthly active paying customers, paid base seats, monthly cohorts,
year-later retention).

Every window here is partitioned by member and ordered by period, so a partition holds
one row per paid week or month of one member: bounded by the calendar, not by data size.
M11-M15 follow the catalogue text; rules the text does not fix are ours and are named in
each docstring.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidpath.functions.calendar import current_month_start, last_complete_week_start
from paidpath.functions.rules import activity_risk
from paidpath.operators.pickers import top_per_group
from paidpath.operators.rolling import previous_values, rolling_active_count
from paidpath.session import materialize

MONEY = "decimal(18,2)"
SEGMENT_COLUMNS = ["plan", "billing_interval", "market", "country", "trial_type", "trial_length",
                   "acquisition_source", "signup_source", "is_tier_1_icp_member", "icp_tiers"]
RETENTION_COLUMNS = ["is_customer_retained", "is_customer_retained_and_active", "net_arr_retained",
                     "gross_arr_retained"]
M01_OUTPUT = ["member_id", "date", "icp_tiers", "plan", "billing_interval", "market", "country", "trial_type",
              "acquisition_source", "signup_source", *RETENTION_COLUMNS, "is_active", "activity_retention_cohort"]


def weekly_paying_members(daily_paying: DataFrame) -> DataFrame:
    """W01 per member-week: the latest paid day of the week (ties: plan, interval desc)."""
    d = daily_paying.withColumn("week", F.date_trunc("week", "date").cast("date"))
    top = top_per_group(d, ["member_id", "week"], ["date", "plan", "billing_interval"],
                        [c for c in SEGMENT_COLUMNS if c not in ("plan", "billing_interval")])
    return (top.withColumn("date", F.col("week")).drop("week")
               .withColumn("month", F.trunc("date", "month")))


def monthly_rolling_activity(weekly: DataFrame, monthly_active: DataFrame) -> DataFrame:
    """W18 on paid months: active months among the last 12 and last 2 paid months. A month
    counts as active when the member has an activity row at all (T22)."""
    months = weekly.select("member_id", "month").distinct()
    act = monthly_active.select("member_id", F.col("month_of_activity").alias("month"),
                                F.lit(1).alias("_present")).distinct()
    m = months.join(act, ["member_id", "month"], "left").withColumn(
        "is_active_ind_m", F.when(F.col("_present").isNotNull(), 1).otherwise(0))
    m = rolling_active_count(m, "is_active_ind_m", ["member_id"], ["month"], 12, "twelve_month_rolling_active_count")
    m = rolling_active_count(m, "is_active_ind_m", ["member_id"], ["month"], 2, "two_month_rolling_active_count")
    return m.drop("_present")


def weekly_activity_cohorts(daily_paying: DataFrame, weekly_active: DataFrame, monthly_active: DataFrame,
                            customers: DataFrame, customer_retention: DataFrame, revenue_retention: DataFrame,
                            as_of: dt.date) -> DataFrame:
    """Member x paid week with segments, retention columns, activity and risk label."""
    weekly = materialize(weekly_paying_members(daily_paying), "weekly_paying")   # read by both rollings
    monthly = monthly_rolling_activity(weekly, monthly_active)
    wa = weekly_active.select("member_id", F.col("week_of_activity").alias("date"), F.lit(1).alias("_w")).distinct()
    w = (weekly.join(wa, ["member_id", "date"], "left")
               .withColumn("is_active_ind", F.when(F.col("_w").isNotNull(), 1).otherwise(0)))
    w = rolling_active_count(w, "is_active_ind", ["member_id"], ["date"], 3, "three_week_rolling_active_count")
    w = previous_values(w, ["is_active_ind"], ["member_id"], ["date"], prefix="previous_week_")
    w = w.filter(F.col("date") <= last_complete_week_start(as_of))
    icp = customers.select("member_id", F.col("icp_tiers").alias("_icp"))
    cr = customer_retention.select("member_id", F.col("date").alias("month"), "is_customer_retained",
                                   "is_customer_retained_and_active")
    rr = revenue_retention.select("member_id", F.col("date").alias("month"), "net_arr_retained", "gross_arr_retained")
    if customer_retention is revenue_retention:      # one table feeds both: join it once
        cr = customer_retention.select("member_id", F.col("date").alias("month"), *RETENTION_COLUMNS)
        rr = None
    j = (w.join(monthly.select("member_id", "month", "twelve_month_rolling_active_count",
                               "two_month_rolling_active_count"), ["member_id", "month"], "left")
          .join(icp, "member_id", "left")
          .join(cr, ["member_id", "month"], "left"))
    if rr is not None:
        j = j.join(rr, ["member_id", "month"], "left")
    label = activity_risk("is_active_ind", "previous_week_is_active_ind", "three_week_rolling_active_count",
                          "two_month_rolling_active_count", "twelve_month_rolling_active_count")
    return j.select("member_id", "date", F.col("_icp").alias("icp_tiers"), "plan", "billing_interval", "market",
                    "country", "trial_type", "acquisition_source", "signup_source", *RETENTION_COLUMNS,
                    F.col("is_active_ind").alias("is_active"), label.alias("activity_retention_cohort"))


# ---- M15 ---------------------------------------------------------------------------------

def year_later_retention(paid_months: DataFrame, monthly_active: DataFrame, as_of: dt.date) -> DataFrame:
    """For each paid member-month whose month a calendar year later is complete:
    still paying then (0/1), paying and active then (0/1), and ARR retained.

    Our reading of the catalogue: both net and gross ARR retained are
    ``least(arr a year later, arr now)`` (the catalogue gives them the same definition,
    "excludes expansion, includes contraction"); 0 when not retained.

    Plan: no self-join. Each paid month is emitted as itself and re-dated a year earlier,
    activity months are re-dated a year earlier, and one aggregate by (member, month)
    lines them up (one shuffle, partial aggregation map-side)."""
    arr = (F.col("mrr") * 12).cast("decimal(38,2)")
    no_arr, no_flag = F.lit(None).cast("decimal(38,2)"), F.lit(None).cast("boolean")
    copies = F.array(  # the month itself, and the same payment seen from a year earlier
        F.struct(F.col("date").alias("date"), arr.alias("_arr"), no_arr.alias("_arr_later"),
                 F.lit(True).alias("_now"), no_flag.alias("_kept")),
        F.struct(F.add_months("date", -12).alias("date"), no_arr.alias("_arr"), arr.alias("_arr_later"),
                 no_flag.alias("_now"), F.lit(True).alias("_kept")))
    paid = (paid_months.select("member_id", F.explode(copies).alias("_c"))
                       .select("member_id", "_c.*", no_flag.alias("_act_later")))
    act = monthly_active.select("member_id", F.add_months("month_of_activity", -12).alias("date"),
                                no_arr.alias("_arr"), no_arr.alias("_arr_later"), no_flag.alias("_now"),
                                no_flag.alias("_kept"), F.lit(True).alias("_act_later"))
    rows = paid.unionByName(act).filter(F.add_months("date", 12) < current_month_start(as_of))
    j = (rows.groupBy("member_id", "date")
             .agg(F.max("_arr").alias("_arr"), F.max("_arr_later").alias("_arr_later"), F.max("_now").alias("_now"),
                  F.max("_kept").alias("_kept"), F.max("_act_later").alias("_act_later"))
             .filter(F.col("_now")))
    kept = F.col("_kept").isNotNull()
    retained = F.when(kept, F.least("_arr", "_arr_later")).otherwise(F.lit(0)).cast(MONEY)
    return j.select("member_id", "date",
                    F.when(kept, 1).otherwise(0).alias("is_customer_retained"),
                    F.when(kept & F.col("_act_later").isNotNull(), 1).otherwise(0).alias("is_customer_retained_and_active"),
                    retained.alias("net_arr_retained"), retained.alias("gross_arr_retained"))


# ---- M11, M12 ------------------------------------------------------------------------------

def daily_active_paying_customers(daily_paying: DataFrame, daily_activity: DataFrame,
                                  retention: DataFrame) -> DataFrame:
    """Member x paid day with segments, the month's retention columns and ``is_active``
    = at least one meaningful action that day (1/0)."""
    act = daily_activity.select("member_id", F.col("activity_date").alias("date"), F.lit(1).alias("_a")).distinct()
    r = retention.select("member_id", F.col("date").alias("month"), *RETENTION_COLUMNS)
    d = daily_paying.withColumn("month", F.trunc("date", "month"))
    j = d.join(act, ["member_id", "date"], "left").join(r, ["member_id", "month"], "left")
    return j.select("member_id", "date", "icp_tiers", "plan", "billing_interval", "market", "country", "trial_type",
                    "acquisition_source", "signup_source", *RETENTION_COLUMNS,
                    F.when(F.col("_a").isNotNull(), 1).otherwise(0).alias("is_active"))


def monthly_active_paying_customers(paid_months: DataFrame, customers: DataFrame, monthly_active: DataFrame,
                                    retention: DataFrame) -> DataFrame:
    """Member x paid month with segments, retention columns and ``is_active`` (1/0)."""
    act = monthly_active.select("member_id", F.col("month_of_activity").alias("date"), F.lit(1).alias("_a")).distinct()
    c = customers.select("member_id", "icp_tiers", "market", "country", "trial_type", "acquisition_source",
                         "signup_source")
    j = (paid_months.select("member_id", "date", "plan", "billing_interval")
         .join(c, "member_id", "left").join(act, ["member_id", "date"], "left")
         .join(retention, ["member_id", "date"], "left"))
    return j.select("member_id", "date", "icp_tiers", "plan", "billing_interval", "market", "country", "trial_type",
                    "acquisition_source", "signup_source", *RETENTION_COLUMNS,
                    F.when(F.col("_a").isNotNull(), 1).otherwise(0).alias("is_active"))


# ---- M13 ---------------------------------------------------------------------------------

def paid_base_seats(paid_months: DataFrame, memberships: DataFrame, organizations: DataFrame,
                    monthly_active: DataFrame, customers: DataFrame) -> DataFrame:
    """Paying members and the non-paying members seated in organizations they pay for,
    per month. Our reading: a seat is a member seen in an organization that month whose
    payer paid that month; ``activity_level`` is 'active' with an activity row that month,
    else 'zombie'; plan, interval and currency are the payer's."""
    pay = paid_months.select(F.col("member_id").alias("paying_member_id"), "date", "plan", "billing_interval",
                             "currency")
    payers = pay.select(F.col("paying_member_id").alias("member_id"), "paying_member_id", "date", "plan",
                        "billing_interval", "currency", F.lit("paying").alias("member_type"))
    org = organizations.select("organization_id", F.col("payment_member_id").alias("paying_member_id"))
    seats = (memberships.select("organization_id", "member_id", F.col("month").alias("date"))
             .join(org, "organization_id").drop("organization_id")
             .filter(F.col("member_id") != F.col("paying_member_id"))
             .join(pay, ["paying_member_id", "date"])
             .select("member_id", "paying_member_id", "date", "plan", "billing_interval", "currency",
                     F.lit("non_paying").alias("member_type")))
    rows = payers.unionByName(seats).distinct()
    act = monthly_active.select("member_id", F.col("month_of_activity").alias("date"), F.lit(1).alias("_a")).distinct()
    c = customers.select("member_id", "market", "country", "trial_type", "trial_length", "acquisition_source",
                         "signup_source", "icp_tiers", F.col("is_tier_1_icp_member").alias("is_tier_1_icp"))
    j = rows.join(act, ["member_id", "date"], "left").join(c, "member_id", "left")
    return j.select("date", "member_id", "paying_member_id", "member_type", "plan", "billing_interval", "currency",
                    "market", "country", "trial_type", "trial_length", "acquisition_source", "signup_source",
                    F.when(F.col("_a").isNotNull(), "active").otherwise("zombie").alias("activity_level"),
                    "icp_tiers", "is_tier_1_icp")


# ---- M14 ---------------------------------------------------------------------------------

def cohorts_monthly(paid_months: DataFrame, customers: DataFrame, monthly_active: DataFrame) -> DataFrame:
    """Cohort month x month x plan, interval, prime segment, activity and signup kind:
    age in months, customers, MRR, ARR and the cohort's initial size.

    Our reading: a member's cohort is its first paid month; ``initial_cohort_size`` is the
    number of members in the cohort month (all segments together), repeated on every row of
    the cohort."""
    first = paid_months.groupBy("member_id").agg(F.min("date").alias("cohort_month"))
    act = monthly_active.select("member_id", F.col("month_of_activity").alias("date"), F.lit(True).alias("_a")).distinct()
    c = customers.select("member_id", F.col("icp_tiers").alias("prime_segments"), "trial_or_buynow_signup")
    j = (paid_months.select("member_id", "date", "plan", "billing_interval", "mrr")
         .join(first, "member_id").join(act, ["member_id", "date"], "left").join(c, "member_id", "left")
         .withColumn("active", F.col("_a").isNotNull()))
    sizes = first.groupBy("cohort_month").agg(F.count("*").alias("initial_cohort_size"))
    g = (j.groupBy("cohort_month", "date", "plan", "billing_interval", "prime_segments", "active",
                   "trial_or_buynow_signup")
          .agg(F.count_distinct("member_id").alias("count_customers"), F.sum("mrr").alias("mrr")))
    return (g.join(sizes, "cohort_month")
             .select("cohort_month", "date",
                     F.months_between("date", "cohort_month").cast("int").alias("cohort_age"),
                     "plan", "billing_interval", "prime_segments", "active", "trial_or_buynow_signup",
                     F.col("count_customers").cast("bigint").alias("count_customers"),
                     F.col("mrr").cast(MONEY).alias("mrr"), (F.col("mrr") * 12).cast(MONEY).alias("arr"),
                     F.col("initial_cohort_size").cast("bigint").alias("initial_cohort_size")))


__all__ = ["weekly_activity_cohorts", "year_later_retention", "daily_active_paying_customers",
           "monthly_active_paying_customers", "paid_base_seats", "cohorts_monthly"]

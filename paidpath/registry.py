"""Registered queries: at least one per operator (W..) and model (M..) of the survey, each bound
to the shared test tables. Every callable takes ``(spark, sf_dir)`` and returns a DataFrame
over the whole tables. Most are lazy; those that write an intermediate table (M01-M04, M06,
M07, M11, M12, w36, w37) run jobs when they are called."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paidpath.sources import bindings as B
from paidpath.sources.tables import Catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---- revenue waterfall --------------------------------------------------------------------

def _months(t: Catalog) -> DataFrame:
    """Orders by member and month, aggregated once for the paid base and the MRR."""
    from paidpath.session import materialize
    return materialize(B.member_months(t), "member_months")


def _member_waterfall(t: Catalog) -> DataFrame:
    from paidpath.plans.waterfall import member_waterfall
    cust, months = B.customers(t), _months(t)
    return member_waterfall(B.paid_base_by_member(t, months), B.mrr_by_member(t, months), B.shipment_activity(t), cust,
                            B.activated_members(t), cust, cust, as_of=B.AS_OF_ORDERS,
                            shell_start=B.ORDERS_SHELL_START, signup_cutoff=B.ORDERS_SIGNUP_CUTOFF,
                            own_domain=B.OWN_EMAIL_DOMAIN)


@query("m05_member_waterfall")
def m05(spark, sf_dir):
    return _member_waterfall(Catalog(spark, sf_dir))


@query("m05_member_waterfall_by_plan")
def m05_by_plan(spark, sf_dir):
    """M05 where members pay for several plans in a month (payments dated by quarter)."""
    from paidpath.plans.waterfall import member_waterfall
    t = Catalog(spark, sf_dir)
    cust = B.customers(t)
    return member_waterfall(B.paid_base_by_plan(t), B.mrr_by_member(t), B.shipment_activity(t), cust, B.activated_members(t), cust, cust,
                            as_of=B.AS_OF_ORDERS, shell_start=B.ORDERS_SHELL_START, signup_cutoff=B.ORDERS_SIGNUP_CUTOFF,
                            own_domain=B.OWN_EMAIL_DOMAIN)


def bucketed_waterfall(t: Catalog) -> DataFrame:
    """M05 over tables that are stored by member: no row is exchanged after they are written."""
    from paidpath.plans.waterfall import member_waterfall
    from paidpath.sources.sinks import bucketed_table
    months = bucketed_table(B.member_months(t).select("member_id", "date", "top", "total"), "member_months")
    cust = bucketed_table(B.customers(t), "customers")
    return member_waterfall(B.paid_base_by_member(t, months), B.mrr_by_member(t, months), bucketed_table(B.shipment_activity(t), "activity"),
                            cust, bucketed_table(B.activated_members(t), "activated"), cust, cust, as_of=B.AS_OF_ORDERS,
                            shell_start=B.ORDERS_SHELL_START, signup_cutoff=B.ORDERS_SIGNUP_CUTOFF, own_domain=B.OWN_EMAIL_DOMAIN)


@query("m05_member_waterfall_bucketed")
def m05_bucketed(spark, sf_dir):
    return bucketed_waterfall(Catalog(spark, sf_dir))


@query("m04_revenue_waterfall")
def m04(spark, sf_dir):
    from paidpath.plans.waterfall import revenue_waterfall
    return revenue_waterfall(_member_waterfall(Catalog(spark, sf_dir)), B.AS_OF_ORDERS)


@query("w22_classify_mrr_change")
def w22(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.plans.waterfall import member_monthly_mrr, mrr_movements
    t = Catalog(spark, sf_dir)
    cust, months = B.customers(t), _months(t)
    mm = member_monthly_mrr(B.paid_base_by_member(t, months), B.mrr_by_member(t, months), B.shipment_activity(t), cust,
                            B.activated_members(t))
    mv = mrr_movements(mm, B.AS_OF_ORDERS, B.ORDERS_SHELL_START, B.ORDERS_SIGNUP_CUTOFF)
    return mv.select("member_id", "mrr_month", "change", "moved.mrr", "moved.mrr_change")


@query("w33_opening_balance")
def w33(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.functions.calendar import current_month_start
    from paidpath.operators.rolling import opening_balance
    from paidpath.plans.waterfall import DIMENSIONS, MONEY, waterfall_summary
    s = waterfall_summary(_member_waterfall(Catalog(spark, sf_dir)))
    ending = (s.filter(F.col("change") != "churn").groupBy("month", *DIMENSIONS)
               .agg(F.sum("arr").alias("arr"), F.sum("_n").alias("count_customers")))
    start = opening_balance(ending, "month", current_month_start(B.AS_OF_ORDERS), 1, "metrics", "1_Starting")
    return start.select("month", "metrics", *DIMENSIONS, F.col("arr").cast(MONEY).alias("arr"),
                        F.col("count_customers").cast("bigint").alias("count_customers"))


# ---- rolling paid base ------------------------------------------------------------------

def _paying_days(t: Catalog):
    from paidpath.plans.paid_base import paying_days
    return paying_days(B.invoice_payments(t), B.plans(t.spark), B.service_numbers(t.spark), B.AS_OF_ORDERS)


@query("w02_top_payment_per_month")
def w02(spark, sf_dir):
    from paidpath.plans.paid_base import top_paying_day_per_month
    return top_paying_day_per_month(_paying_days(Catalog(spark, sf_dir)))


@query("w08_densify")
def w08(spark, sf_dir):
    from paidpath.plans.paid_base import SEGMENTS, daily_paying, segment_day_shell, top_paying_day_per_month
    from paidpath.operators.spines import densify
    t = Catalog(spark, sf_dir)
    daily = daily_paying(top_paying_day_per_month(_paying_days(t)), B.customers(t))
    return densify(daily, segment_day_shell(daily, B.AS_OF_ORDERS), ["date", *SEGMENTS])


@query("m08_rolling_paid_base")
def m08(spark, sf_dir):
    from paidpath.plans.paid_base import rolling_paid_base
    t = Catalog(spark, sf_dir)
    return rolling_paid_base(B.invoice_payments(t), B.plans(spark), B.service_numbers(spark), B.customers(t),
                             B.AS_OF_ORDERS)


@query("m08_rolling_paid_base_on_shell")
def m08_on_shell(spark, sf_dir):
    """M08 over a given shell: the segments of current customers, from 1998 on."""
    import datetime as dt
    from pyspark.sql import functions as F
    from paidpath.functions.calendar import lit_date
    from paidpath.operators.spines import day_sequence
    from paidpath.plans.paid_base import SEGMENTS, daily_paying, rolling_paid_base, top_paying_day_per_month
    t = Catalog(spark, sf_dir)
    daily = daily_paying(top_paying_day_per_month(_paying_days(t)), B.customers(t))
    current = daily.filter(F.col("date") >= lit_date(dt.date(1998, 1, 1))).select(*SEGMENTS).distinct()
    shell = current.select(F.explode(day_sequence(lit_date(dt.date(1998, 1, 1)), lit_date(B.AS_OF_ORDERS))).alias("date"), *SEGMENTS)
    return rolling_paid_base(B.invoice_payments(t), B.plans(spark), B.service_numbers(spark), B.customers(t), B.AS_OF_ORDERS, shell)


@query("w20_calendar_trailing_sum")
def w20_trailing(spark, sf_dir):
    """W20 over a sparse table: orders per customer and "last month"."""
    from pyspark.sql import functions as F
    from paidpath.functions.calendar import lit_date
    from paidpath.operators.rolling import calendar_trailing_sum
    o = Catalog(spark, sf_dir)("orders", ["o_custkey", "o_orderdate"])
    daily = o.groupBy(F.col("o_custkey").alias("member_id"), F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("orders"))
    return calendar_trailing_sum(daily, "orders", ["member_id"], "date", lit_date(B.AS_OF_ORDERS), out="orders_last_month")


@query("w20_calendar_rolling_sum")
def w20(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.functions.calendar import lit_date
    from paidpath.operators.rolling import calendar_rolling_sum
    from paidpath.operators.spines import day_sequence, densify
    t = Catalog(spark, sf_dir)
    o = t("orders", ["o_orderpriority", "o_orderdate"])
    daily = o.groupBy(F.col("o_orderpriority").alias("plan"), F.to_date("o_orderdate").alias("date")).agg(
        F.count("*").alias("orders"))
    first = daily.groupBy("plan").agg(F.min("date").alias("_f"))
    shell = first.select("plan", F.explode(day_sequence(F.col("_f"), lit_date(B.AS_OF_ORDERS))).alias("date"))
    dense = densify(daily, shell, ["plan", "date"])
    out = calendar_rolling_sum(dense, "orders", ["plan"], "date", out="orders_last_month")
    return out.select("date", "plan", "orders", F.col("orders_last_month").cast("bigint").alias("orders_last_month"))


# ---- small revenue-side operators ---------------------------------------------------------

@query("w01_latest_per_key")
def w01(spark, sf_dir):
    from paidpath.operators.pickers import latest_per_key
    li = Catalog(spark, sf_dir)("lineitem")
    return latest_per_key(li, ["l_orderkey"], ["l_linenumber"])


@query("w06_period_spine")
def w06(spark, sf_dir):
    from paidpath.operators.spines import period_spine
    o = Catalog(spark, sf_dir)("orders", ["o_orderdate"])
    return period_spine(o, "o_orderdate", B.AS_OF_ORDERS, name="month")


@query("w07_member_month_shell")
def w07(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.operators.spines import member_month_shell
    o = Catalog(spark, sf_dir)("orders", ["o_custkey", "o_orderdate"])
    first = o.groupBy(F.col("o_custkey").alias("member_id")).agg(F.min("o_orderdate").alias("first_order"))
    return member_month_shell(first, "member_id", "first_order", B.AS_OF_ORDERS, name="mrr_month")


@query("w19_previous_values")
def w19(spark, sf_dir):
    from paidpath.operators.rolling import previous_values
    pb = B.paid_base_by_member(Catalog(spark, sf_dir))
    return previous_values(pb, ["plan", "billing_interval"], ["member_id"], ["date"])


@query("w31_monthly_revenue")
def w31(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.operators.rolling import monthly_revenue
    p = B.invoice_payments(Catalog(spark, sf_dir)).withColumn("refunded", F.col("amount") < 0)
    out = monthly_revenue(p, "member_id", "payment_date", "amount", out="revenue", exclude="refunded")
    return out.select("member_id", "date_month", F.col("revenue").cast("decimal(18,2)").alias("revenue"))


# ---- monthly activity ---------------------------------------------------------------------

def _monthly_active(t: Catalog, incremental: bool = False):
    from paidpath.plans.activity import monthly_active_customers
    return monthly_active_customers(B.product_events(t), B.meaningful_activity(t.spark), B.customers(t),
                                    B.organizations(t), as_of=B.AS_OF_EVENTS, incremental=incremental)


@query("m07_monthly_active_customers")
def m07(spark, sf_dir):
    return _monthly_active(Catalog(spark, sf_dir))


@query("m07_monthly_active_incremental")
def m07_incremental(spark, sf_dir):
    """M07 in two runs over stored state: everything before May, then the months from May on."""
    import datetime as dt
    from paidpath.plans.activity import refresh_monthly_active
    from paidpath.sources.sinks import scratch_table_path
    from paidpath.sources.versions import MonthTable
    t = Catalog(spark, sf_dir)
    state = MonthTable(spark, scratch_table_path(spark, "event_summary"), "month_of_activity")
    table = MonthTable(spark, scratch_table_path(spark, "monthly_active"), "month_of_activity")
    args = (B.long_product_events(t), B.meaningful_activity(spark), B.customers(t), B.organizations(t))
    refresh_monthly_active(state, table, *args, as_of=dt.date(2024, 5, 1))
    return refresh_monthly_active(state, table, *args, as_of=dt.date(2024, 7, 1))


@query("m07_users_from_daily_states")
def m07_daily_states(spark, sf_dir):
    """Distinct active users per month, and per trailing 28 days at each month's last day, from
    stored daily bitmaps: the events are read once, for the daily states."""
    from pyspark.sql import functions as F
    from paidpath.operators.bitmaps import NUMBER, member_counts, member_states, number_members, trailing_states
    from paidpath.plans.activity import active_events, label_column
    from paidpath.session import materialize
    t = Catalog(spark, sf_dir)
    ev = active_events(B.long_product_events(t), B.meaningful_activity(spark)).select(
        "member_id", F.to_date("timestamp").alias("day"), F.explode(label_column("activity_category")).alias("label"))
    numbers = materialize(number_members(B.product_events(t), "actor_id"), "member_numbers")
    days = materialize(member_states(ev.join(numbers.withColumnRenamed("actor_id", "member_id"), "member_id"), ["day", "label"], NUMBER), "daily_states")
    month = F.trunc("day", "month").alias("month")
    by_month = member_counts(days.select(month, "label", "_bits", "members"), ["month", "label"], "users")
    ends = trailing_states(days, "day", ["label"], 28).where(F.col("day") == F.last_day("day"))
    by_28 = member_counts(ends, ["day", "label"], "users_28d")
    return (by_month.join(by_28.withColumn("month", F.trunc("day", "month")).drop("day"), ["month", "label"], "left")
            .select("month", "label", "users", F.coalesce("users_28d", F.lit(0)).alias("users_28d")))


@query("w04_last_in_period")
def w04(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.operators.pickers import last_in_period
    e = B.product_events(Catalog(spark, sf_dir)).select(
        "event_id", F.col("actor_id").alias("member_id"), F.trunc("timestamp", "month").alias("month_of_activity"),
        "timestamp", "organization_id")
    keys, order = ["member_id", "month_of_activity"], ["timestamp", "organization_id"]
    x = last_in_period(e, "organization_id", keys, order, ignore_nulls=False, out="last_org")
    x = last_in_period(x, "organization_id", keys, order, ignore_nulls=True, out="last_org_non_null")
    return x.select("event_id", "member_id", "month_of_activity", "last_org", "last_org_non_null")


@query("w12_threshold_flags")
def w12(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.functions.rules import threshold_flags
    e = Catalog(spark, sf_dir)("events", ["user_id", "event_type"])
    c = e.groupBy(F.col("user_id").alias("member_id")).agg(
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.count_if(F.col("event_type") == "view").alias("views"))
    return c.select("member_id", *threshold_flags({
        "any_purchase": ("purchases", ">", 0), "purchases_2": ("purchases", ">=", 2),
        "purchases_3": ("purchases", ">=", 3), "views_5": ("views", ">=", 5),
        "views_20": ("views", ">=", 20), "purchase_flag": ("purchases", ">=", 1, True)}))


@query("w17_allow_listed_events")
def w17(spark, sf_dir):
    from paidpath.operators.events import allow_listed_events
    t = Catalog(spark, sf_dir)
    ev = B.product_events(t).select("event_id", "actor_id", "event", "timestamp")
    return allow_listed_events(ev, B.discovery_events(spark), "event", how="inner")


@query("w17_allow_listed_semi")
def w17_semi(spark, sf_dir):
    """W17 as a filter: events whose name is in the discovery list, without its columns."""
    from paidpath.operators.events import allow_listed_events
    t = Catalog(spark, sf_dir)
    ev = B.product_events(t).select("event_id", "actor_id", "event", "timestamp")
    return allow_listed_events(ev, B.discovery_events(spark), "event", how="semi")


@query("w34_surrogate_key")
def w34(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.functions.rules import surrogate_key
    e = B.product_events(Catalog(spark, sf_dir)).select(
        F.col("actor_id").alias("member_id"), "organization_id",
        F.trunc("timestamp", "month").alias("month_of_activity")).distinct()
    return e.withColumn("primary_key", surrogate_key("member_id", "organization_id", "month_of_activity"))


@query("w36_full_refresh")
def w36(spark, sf_dir):
    from paidpath.sources.sinks import full_refresh, scratch_table_path
    return full_refresh(_monthly_active(Catalog(spark, sf_dir)), scratch_table_path(spark, "monthly_active"))


@query("w37_refresh_recent_months")
def w37(spark, sf_dir):
    import datetime as dt
    from pyspark.sql import functions as F
    from paidpath.operators.rolling import monthly_revenue
    from paidpath.sources.sinks import refresh_recent_months, scratch_table_path
    t = Catalog(spark, sf_dir)

    def build_as_of(as_of):
        def build(incremental):
            p = B.invoice_payments(t).filter(F.col("payment_date") <= F.lit(as_of))
            if incremental:
                p = p.filter(F.col("payment_date") >= F.lit(dt.date(as_of.year, as_of.month, 1)) - F.expr("interval 2 months"))
            r = monthly_revenue(p, "member_id", "payment_date", "amount", out="revenue")
            return r.withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))
        return build

    path = scratch_table_path(spark, "monthly_revenue")
    refresh_recent_months(build_as_of(dt.date(2001, 7, 1)), path, dt.date(2001, 7, 1), "date_month")
    out = refresh_recent_months(build_as_of(B.AS_OF_ORDERS), path, B.AS_OF_ORDERS, "date_month")
    return out.select("member_id", "date_month", "revenue")


# ---- organization profiles, attribution, subscriptions ------------------------------------

@query("m02_org_profiles")
def m02(spark, sf_dir):
    from paidpath.plans.org_profiles import org_profiles
    t = Catalog(spark, sf_dir)
    return org_profiles(B.crm_accounts(t), B.crm_organizations(t), B.industry_map(spark), B.size_map(spark))


@query("w03_one_to_one_links")
def w03(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.operators.pickers import one_to_one_links
    acc = B.crm_accounts(Catalog(spark, sf_dir)).select(
        F.col("id").alias("account_id"), F.col("organisation_id__c").alias("organization_id"))
    return one_to_one_links(acc, "account_id", "organization_id")


@query("w24_tier_from_label")
def w24(spark, sf_dir):
    from paidpath.functions.rules import tier_from_label
    acc = B.crm_accounts(Catalog(spark, sf_dir))
    return acc.select("icp_tier__c", tier_from_label("icp_tier__c").alias("icp_tiers")).distinct()


@query("m09_arr_attribution")
def m09(spark, sf_dir):
    from paidpath.plans.attribution import arr_attribution
    t = Catalog(spark, sf_dir)
    return arr_attribution(B.monthly_usage(t), B.enterprise_arr(t), B.member_revenue(t))


@query("w32_allocate_proportionally")
def w32(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.operators.revenue import allocate_proportionally
    t = Catalog(spark, sf_dir)
    e = t("events", ["user_id", "ts", "event_type"])
    kinds = ["signup", "purchase", "view", "click", "error"]
    days = e.groupBy(F.col("user_id").alias("member_id")).agg(
        *[F.count_distinct(F.when(F.col("event_type") == k, F.to_date("ts"))).alias(k) for k in kinds])
    c = t("customer", ["c_custkey", "c_acctbal"]).select(
        F.col("c_custkey").alias("member_id"), F.col("c_acctbal").cast("decimal(18,2)").alias("amount"))
    return allocate_proportionally(days.join(c, "member_id"), "amount", kinds).select(
        "member_id", "amount", *[f"{k}_share" for k in kinds])


@query("m10_current_subscriptions")
def m10(spark, sf_dir):
    from paidpath.plans.subscriptions import current_subscriptions
    t = Catalog(spark, sf_dir)
    return current_subscriptions(B.invoice_items(t), B.ecomm_customers(t))


@query("w35_select_except")
def w35(spark, sf_dir):
    from paidpath.operators.shape import select_except
    c = B.ecomm_customers(Catalog(spark, sf_dir))
    return select_except(c, ["first_payment_date", "trial_start_date", "trial_end_date", "last_touch_signup_date",
                             "day_diff_first_payment_exp_conversion_date", "non_profit_effective_date"],
                         last=["signup_date"])


# ---- activation -----------------------------------------------------------------------------

@query("m03_activation_funnel")
def m03(spark, sf_dir):
    from paidpath.plans.activation import activation_funnel
    t = Catalog(spark, sf_dir)
    return activation_funnel(B.ecomm_customers(t), B.buy_now_events(t), B.product_events(t), B.discovery_events(spark),
                             B.meaningful_activity(spark), B.authentication_events(t), B.trial_to_paying(t))


@query("w09_cross_categories")
def w09(spark, sf_dir):
    from paidpath.plans.activation import OVERALL, activation_customers
    from paidpath.operators.spines import cross_categories
    t = Catalog(spark, sf_dir)
    cust = activation_customers(B.ecomm_customers(t), B.buy_now_events(t)).select("member_id")
    return cross_categories(cust, ["analytics", "composer", "inbox", "planner"], OVERALL)


def _signup_anchors(t: Catalog):
    return B.first_signups(t)


@query("w05_first_event_after")
def w05(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.operators.events import first_event_after
    t = Catalog(spark, sf_dir)
    ev = B.product_events(t).filter(F.col("event") == "purchase").select("actor_id", "timestamp")
    return first_event_after(_signup_anchors(t), ev, "member_id", "signup_ts", 29, out="first_purchase",
                             event_key="actor_id")


@query("w10_events_in_window")
def w10(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.operators.events import events_in_window
    t = Catalog(spark, sf_dir)
    ev = B.product_events(t).select("event_id", "actor_id", "event", "timestamp")
    j = events_in_window(_signup_anchors(t), ev, "member_id", "signup_ts", 0, 3, closed="left",
                         event_key="actor_id")
    return j.select(F.col("_b.member_id").alias("member_id"), "_e.event_id", "_e.event", "_e.timestamp")


@query("w16_breadth_in_window")
def w16(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.functions.rules import social_network_family
    from paidpath.operators.events import breadth_in_window, events_in_window
    t = Catalog(spark, sf_dir)
    ev = B.product_events(t).select("actor_id", "timestamp", "social_network_type")
    j = events_in_window(_signup_anchors(t), ev, "member_id", "signup_ts", 0, 72, unit="hour",
                         event_key="actor_id")
    return breadth_in_window(j, [F.col("_b.member_id").alias("member_id")],
                             social_network_family(F.col("_e.social_network_type")), "families")


@query("w25_normalise_category")
def w25(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.functions.rules import social_network_family
    e = B.product_events(Catalog(spark, sf_dir))
    return e.select("social_network_type", social_network_family("social_network_type").alias("family")).distinct()


# ---- experiments ----------------------------------------------------------------------------

def _facts(t: Catalog):
    from paidpath.session import materialize
    users = materialize(B.user_facts(t), "user_facts")  # one pass over the events for all six
    return {f"{k}_{'paid' if p else 'free'}": B.onboarding_facts(users, k, p)
            for k in ("setup", "habit", "aha") for p in (True, False)}


@query("m06_experiment_monitoring")
def m06(spark, sf_dir):
    from paidpath.plans.experiments import experiment_monitoring
    t = Catalog(spark, sf_dir)
    return experiment_monitoring(
        B.experiment_cohorts(t), B.experiment_event_log(t), B.ecomm_customers(t), B.free_to_trial(t), B.members(t),
        B.products(spark), B.social_networks(t), B.trial_to_paying(t), _facts(t), B.event_payments(t),
        B.first_payments(t, B.event_payments(t)), B.engagement_days(t), B.MEANINGFUL_NAMES, B.AS_OF_EVENTS, min_cohort=B.BUSY_DAY)


@query("w23_experiment_audience")
def w23(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.functions.payload import payload
    from paidpath.functions.rules import experiment_audience
    t = Catalog(spark, sf_dir)
    a = B.experiment_cohorts(t).select(F.lit("cohort").alias("source"), "experiment")
    ev = B.experiment_event_log(t).filter(F.col("event") == "experiment_started")
    b = payload(ev, "data", {"experiment": "$.additional_data.id"}).select(F.lit("event").alias("source"), "experiment")
    x = a.unionByName(b).distinct()
    return x.withColumn("experiment_audience", F.when(F.col("source") == "cohort", experiment_audience("experiment", "cohort"))
                        .otherwise(experiment_audience("experiment", "event")))


@query("w29_experiment_window")
def w29(spark, sf_dir):
    from paidpath.plans.experiments import experiment_window, exposures, first_exposures
    t = Catalog(spark, sf_dir)
    expo = exposures(B.experiment_cohorts(t), B.experiment_event_log(t))
    return experiment_window(first_exposures(expo, B.ecomm_customers(t), B.free_to_trial(t)))


@query("w26_week_bucket")
def w26(spark, sf_dir):
    from paidpath.functions.rules import week_bucket
    s = B.first_signups(Catalog(spark, sf_dir))
    return s.withColumn("experiment_week", week_bucket("signup_ts", B.AS_OF_EVENTS))


@query("w28_tri_state")
def w28(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.functions.rules import tri_state
    t = Catalog(spark, sf_dir)
    tp = B.trial_to_paying(t).select("member_id", "converted", F.lit(True).alias("_tp"))
    j = B.customers(t).select("member_id").join(tp, "member_id", "left")
    return j.select("member_id", tri_state(F.col("_tp").isNotNull(), F.col("converted") == 1).alias("converted"))


def _anchored_pairs(t: Catalog, hours: int):
    from pyspark.sql import functions as F
    from paidpath.operators.events import events_in_window
    ev = B.experiment_event_log(t).select("actor_id", "event", "timestamp", "social_network_id")
    j = events_in_window(B.first_signups(t), ev, "member_id", "signup_ts", 0, hours, unit="hour",
                         event_key="actor_id")
    return j.select(F.col("_b.member_id").alias("member_id"), "_b.signup_ts", "_e.event", "_e.timestamp",
                    "_e.social_network_id")


@query("w11_conditional_counts")
def w11(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.operators.events import conditional_counts
    from paidpath.plans.experiments import ANALYTICS_EVENTS, COMPOSER_EVENTS, PLANNER_EVENTS, PUBLISHER_EVENT
    p = _anchored_pairs(Catalog(spark, sf_dir), 119)
    e = F.col("event")
    return conditional_counts(p, ["member_id"], {
        "publisher": e == PUBLISHER_EVENT, "composer": e.isin(*COMPOSER_EVENTS),
        "planner": e.isin(*PLANNER_EVENTS), "analytics": e.isin(*ANALYTICS_EVENTS)})


@query("w13_distinct_before_marker")
def w13(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.operators.events import distinct_before_marker
    from paidpath.plans.experiments import ADD_NETWORK_PREFIX, DASHBOARD_EVENT, STEAL_SUFFIX
    p = _anchored_pairs(Catalog(spark, sf_dir), 29 * 24)
    markers = p.filter(F.col("event") == DASHBOARD_EVENT).groupBy("member_id").agg(F.min("timestamp").alias("marker"))
    adds = p.filter(F.col("event").startswith(ADD_NETWORK_PREFIX) | F.col("event").endswith(STEAL_SUFFIX))
    return distinct_before_marker(adds, markers, "member_id", "timestamp", "marker", "social_network_id",
                                  "networks_added")


@query("w14_day_bucket_retention")
def w14(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.operators.events import day_bucket_counts
    p = _anchored_pairs(Catalog(spark, sf_dir), 119 * 24)
    p = p.filter(F.col("event").isin(*B.MEANINGFUL_NAMES))
    return day_bucket_counts(p, ["member_id"], "signup_ts", "timestamp",
                             {"w1": (0, 6), "w2": (7, 13), "w3": (14, 20), "m1": (30, 59), "m2": (60, 89), "m3": (90, 119)})


@query("w15_active_days_in_window")
def w15(spark, sf_dir):
    from paidpath.operators.events import active_days_in_window
    t = Catalog(spark, sf_dir)
    base = B.first_signups(t).withColumnRenamed("signup_ts", "anchor")
    from pyspark.sql import functions as F
    base = base.withColumn("anchor", F.date_trunc("day", "anchor"))
    return active_days_in_window(base, B.engagement_days(t), "member_id", "anchor", 29, "activity_date_utc")


@query("w30_first_refund")
def w30(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.operators.revenue import first_refund
    t = Catalog(spark, sf_dir)
    p = B.invoice_payments(t)
    base = p.groupBy("member_id").agg(F.min("payment_date").alias("trial_start_date")).join(
        B.first_payments(t), "member_id", "left")
    return first_refund(p, base, "member_id", "trial_start_date", "first_overall_payment")


# ---- cohorts and catalogue models -------------------------------------------------------------

def _shipment_days(t: Catalog):
    """The shuffle of line items with orders, done once where weeks and months need it too."""
    from paidpath.session import materialize
    return materialize(B.shipment_days(t), "shipment_days")


def _retention(t: Catalog, written: bool = True, days=None):
    """M15's output. Other models read it as an upstream table, so it is written once
    (as a pipeline would persist it) instead of being re-derived inside each consumer."""
    from paidpath.plans.cohorts import year_later_retention
    from paidpath.session import materialize
    r = year_later_retention(B.paid_months(t), B.shipment_activity(t, days), B.AS_OF_ORDERS)
    return materialize(r, "year_later_retention") if written else r


@query("m15_year_later_retention")
def m15(spark, sf_dir):
    return _retention(Catalog(spark, sf_dir), written=False)


@query("m01_weekly_activity_cohorts")
def m01(spark, sf_dir):
    from paidpath.plans.cohorts import weekly_activity_cohorts
    t = Catalog(spark, sf_dir)
    days = _shipment_days(t)
    r = _retention(t, days=days)
    return weekly_activity_cohorts(B.daily_paying_customers(t), B.shipment_weeks(t, days), B.shipment_activity(t, days),
                                   B.customers(t), r, r, B.AS_OF_ORDERS)


@query("m11_daily_active_paying_customers")
def m11(spark, sf_dir):
    from paidpath.plans.cohorts import daily_active_paying_customers
    t = Catalog(spark, sf_dir)
    days = _shipment_days(t)
    return daily_active_paying_customers(B.daily_paying_customers(t), days, _retention(t, days=days))


@query("m12_monthly_active_paying_customers")
def m12(spark, sf_dir):
    from paidpath.plans.cohorts import monthly_active_paying_customers
    t = Catalog(spark, sf_dir)
    days = _shipment_days(t)
    return monthly_active_paying_customers(B.paid_months(t), B.customers(t), B.shipment_activity(t, days),
                                           _retention(t, days=days))


@query("m13_paid_base_seats")
def m13(spark, sf_dir):
    from paidpath.plans.cohorts import paid_base_seats
    t = Catalog(spark, sf_dir)
    return paid_base_seats(B.event_paid_months(t), B.org_memberships(t), B.organizations(t),
                           B.event_monthly_activity(t), B.customers(t))


@query("m14_cohorts_monthly")
def m14(spark, sf_dir):
    from paidpath.plans.cohorts import cohorts_monthly
    t = Catalog(spark, sf_dir)
    return cohorts_monthly(B.paid_months(t), B.ecomm_customers(t), B.shipment_activity(t))


@query("w18_rolling_active_count")
def w18(spark, sf_dir):
    from paidpath.plans.cohorts import monthly_rolling_activity, weekly_paying_members
    t = Catalog(spark, sf_dir)
    return monthly_rolling_activity(weekly_paying_members(B.daily_paying_customers(t)), B.shipment_activity(t))


@query("w21_activity_risk")
def w21(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.functions.rules import activity_risk
    from paidpath.operators.rolling import previous_values, rolling_active_count
    e = Catalog(spark, sf_dir)("events", ["user_id", "ts", "event_type"])
    wk = e.groupBy(F.col("user_id").alias("member_id"), F.date_trunc("week", "ts").cast("date").alias("week")).agg(
        F.when(F.count_if(F.col("event_type") == "purchase") > 0, 1).otherwise(0).alias("active"))
    wk = rolling_active_count(wk, "active", ["member_id"], ["week"], 3, "w3")
    wk = rolling_active_count(wk, "active", ["member_id"], ["week"], 8, "m2")
    wk = rolling_active_count(wk, "active", ["member_id"], ["week"], 52, "m12")
    wk = previous_values(wk, ["active"], ["member_id"], ["week"], prefix="prev_")
    return wk.select("member_id", "week", "active",
                     activity_risk("active", "prev_active", "w3", "m2", "m12").alias("activity_retention_cohort"))


@query("w38_as_of_bounds")
def w38(spark, sf_dir):
    from pyspark.sql import functions as F
    from paidpath.functions.calendar import last_complete_month_start, last_complete_week_start
    e = Catalog(spark, sf_dir)("events", ["ts"])
    wk = e.select(F.date_trunc("week", "ts").cast("date").alias("period")).filter(
        F.col("period") <= last_complete_week_start(B.AS_OF_EVENTS))
    mo = e.select(F.trunc("ts", "month").alias("period")).filter(
        F.col("period") <= last_complete_month_start(B.AS_OF_EVENTS))
    return (wk.groupBy("period").agg(F.count("*").alias("events")).withColumn("grain", F.lit("week"))
              .unionByName(mo.groupBy("period").agg(F.count("*").alias("events")).withColumn("grain", F.lit("month"))))


@query("w27_email_domain")
def w27(spark, sf_dir):
    from paidpath.functions.rules import email_domain
    c = B.customers(Catalog(spark, sf_dir))
    return c.select("member_id", "email", email_domain("email", B.OWN_EMAIL_DOMAIN).alias("email_domain"))

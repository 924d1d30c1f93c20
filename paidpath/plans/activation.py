"""Activation funnel by product (M03): member x product category with setup, discovery,
activation and conversion flags.

Event windows are equi joins on (member, category) with the time range as a residual, so
each customer row meets only its own events; the category grid is an ``explode`` of a
label array that Spark reads from the mapping (no cross join, nothing collected).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidpath.functions.rules import fold_inbox, fold_inbox_like, social_network_family, threshold_flag
from paidpath.operators.events import allow_listed_events, events_in_window, shift
from paidpath.operators.shape import select_except
from paidpath.operators.spines import cross_categories, label_set
from paidpath.session import materialize

OVERALL = "any_product"
DROPPED_CUSTOMER_COLUMNS = ["first_payment_date", "trial_start_date", "trial_end_date", "last_touch_signup_date",
                            "day_diff_first_payment_exp_conversion_date", "non_profit_effective_date"]
EVENTS_SINCE = dt.date(2018, 1, 1)


def activation_customers(customers: DataFrame, buy_now: DataFrame) -> DataFrame:
    """Customers signed up since 2018 with the adjusted signup time (first buy-now event for
    buy-now signups)."""
    c = select_except(customers, DROPPED_CUSTOMER_COLUMNS).filter(F.year("signup_date") >= 2018)
    bn = (buy_now.filter(F.col("is_buy_now") == F.lit(True)).groupBy("member_id")
                 .agg(F.min("timestamp").alias("buynow_signup_date")))
    j = c.alias("_c").join(bn.alias("_n"), (F.col("_c.member_id") == F.col("_n.member_id")) &
                           (F.col("_c.trial_or_buynow_signup") == "buynow"), "left")
    return j.select("_c.*", F.coalesce(F.col("_n.buynow_signup_date"), F.col("_c.signup_date"))
                    .alias("adjusted_signup_date"))


def activation_funnel(customers: DataFrame, buy_now: DataFrame, events: DataFrame, discovery: DataFrame,
                      meaningful: DataFrame, auth: DataFrame, conversions: DataFrame,
                      setup_hours: int = 1, discovery_days: int = 3, activation_days: int = 7,
                      min_networks: int = 3, min_categories: int = 2) -> DataFrame:
    """M03. Activation follows the SQL (7 days, 2+ categories), not the catalogue text
    (T4); discovery keeps raw categories while the grid folds inbox, so inbox discovery
    never matches (T21)."""
    # one row per customer, read by the grid, the setup window and the final joins: write once
    cust = materialize(activation_customers(customers, buy_now), "activation_customers")
    ev = events.filter(F.col("timestamp") >= F.lit(EVENTS_SINCE))
    labels = label_set(meaningful.select(fold_inbox("activity_category").alias("c")), "c")
    grid = cross_categories(cust, labels, OVERALL)
    base = grid.select("member_id", "activity_category", "adjusted_signup_date")

    a = (auth.filter((F.col("authentication_result") == "success") &
                     (F.col("authentication_type") == "authentication"))
             .withColumn("family", social_network_family("social_network_type")))
    setup = (events_in_window(cust.select("member_id", "adjusted_signup_date"), a, "member_id",
                              "adjusted_signup_date", 0, setup_hours, unit="hour")
             .groupBy(F.col("_b.member_id").alias("member_id"))
             .agg(threshold_flag(F.count_distinct("_e.family"), ">=", min_networks, as_int=True).alias("is_setup")))

    # one pass over the events for both windows: a name may be a discovery (raw category), a
    # meaningful event (folded category) or both
    kinds = (discovery.select("event", "activity_category", F.lit("discovery").alias("kind"))
             .unionByName(meaningful.select("event", fold_inbox_like("activity_category").alias("activity_category"), F.lit("meaningful").alias("kind"))))
    seen = allow_listed_events(ev.select("actor_id", "event", "timestamp"), kinds.distinct(), "event")
    j = events_in_window(base, seen, ["member_id", "activity_category"], "adjusted_signup_date", 0, max(discovery_days, activation_days),
                         event_key=["actor_id", "activity_category"])

    def within(kind: str, days: int):
        inside = F.col("_e.timestamp") <= shift(F.col("_b.adjusted_signup_date"), days, "day")
        return threshold_flag(F.count_if((F.col("_e.kind") == kind) & inside), ">=", 1, as_int=True)

    done = (j.groupBy(F.col("_b.member_id").alias("member_id"), F.col("_b.activity_category").alias("activity_category"))
             .agg(within("discovery", discovery_days).alias("is_discovery"), within("meaningful", activation_days).alias("is_activated"))
             .filter(F.col("activity_category") != OVERALL))
    overall = done.groupBy("member_id").agg(*[threshold_flag(F.sum(c), ">=", min_categories, as_int=True).alias(c)
                                              for c in ("is_discovery", "is_activated")])
    done = done.unionByName(overall.withColumn("activity_category", F.lit(OVERALL)))
    conv = conversions.select("member_id", "is_converted")
    j = (grid.join(setup, "member_id", "left")
             .join(done, ["member_id", "activity_category"], "left")
             .join(conv, "member_id", "left"))
    s, d, ac = F.col("is_setup") == 1, F.col("is_discovery") == 1, F.col("is_activated") == 1
    cv = F.col("is_converted") == F.lit(True)

    def flag(cond):
        return F.when(cond, 1).otherwise(0)

    return j.select(*grid.columns,
                    flag(s).alias("is_setup"), flag(d).alias("is_discovery"), flag(ac).alias("is_activated"),
                    flag(cv).alias("is_converted"), flag(s & cv).alias("is_setup_and_converted"),
                    flag(d & cv).alias("is_discovery_and_converted"), flag(ac & cv).alias("is_activated_and_converted"),
                    flag(s & d).alias("is_discovery_funnel"), flag(s & d & ac).alias("is_activated_funnel"),
                    flag(s & d & cv).alias("is_discovery_funnel_and_converted"),
                    flag(s & d & ac & cv).alias("is_activated_funnel_and_converted"))

"""Experiment monitoring (M06): distinct members per combination of 58 read-out
dimensions.

Plan shape: the conversion anchors (member, created day) are joined to the event log
**once**, on the member and a bucket of days with the widest window (0-119 days) as a residual,
instead of the source's eight separate joins. Events come as a time, a network and a bit for
each class they belong to. The pairs are reduced where they are made to a mergeable funnel
state (operators/funnel.py), which is written; every windowed measure (d0, d5, d28 actions,
29-day first events, breadth, networks before the marker, month-1..3 retention) comes from it.
Mapping tables are broadcast behind a size bound; every fact table joins on ``member_id``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidpath.functions.calendar import lit_date
from paidpath.functions.payload import payload
from paidpath.functions.rules import experiment_audience, tri_state, week_bucket
from paidpath.operators.events import active_days_in_window, events_in_window, shift
from paidpath.operators.funnel import distinct_before, distinct_of, event_classes, funnel_state, has_class, merge_states
from paidpath.operators.revenue import first_refund
from paidpath.session import materialize
from paidpath.operators.sizing import broadcast_if_bounded

# Event lists and names the read-out is defined on.
EXPOSURE_EVENT = "experiment_started"
EXPOSURES_SINCE = dt.date(2021, 1, 1)
MEMBERS_SINCE = dt.date(2019, 1, 1)
WEB = "web"
LANGUAGES = ("en", "es", "fr", "de")
MIN_COHORT = 30
FINISH_STEP_2_EVENTS = ("finish_connecting_sn", "user_clicks_continue_button",
                        "account_setup_user_click_skip_button", "user_clicks_add_more_later")
DASHBOARD_EVENT = "web.dashboard.load"
INSTAGRAM_ATTEMPT_EVENTS = ("instagram_steal_start", "instagram_add_start", "instagrambusiness_add_start",
                            "instagrambusiness_steal_start", "instagram_reauth_start",
                            "instagrambusiness_reauth_start", "user_clicks_add_sn_button_instagram")
PLANNER_EVENTS = ("content_planner_opened", "dashboard_planner_clicked")
ANALYTICS_EVENTS = ("analytics_app_loaded", "dashboard_new_analytics_clicked")
STREAMS_EVENTS = ("dashboard_streams_clicked",)
PUBLISHER_EVENT = "dashboard_publisher_clicked"
POST_CTA_EVENTS = ("new_post_clicked", "compose_new_message_from_source_page")
COMPOSER_EVENTS = ("compose_new_message_from_source_page", "compose_new_message", "open_new_compose_from_template",
                   "new_post_clicked", "new_pin_clicked", "new_story_clicked", "stream_user_clicked_schedule_cta",
                   "user_clicks_new_post", "open_new_compose", "compose_new_message_for_network",
                   "open_new_compose_instagramstory", "open_new_compose_pinterest", "open_legacy_compose")
TEAM_MEMBER_EVENT = "add_team_member"
ENGAGEMENT_EXCLUDED_EVENTS = ("drop_stream", "add_stream", "message_send_failed")
ADD_NETWORK_PREFIX = "add_social_network_"
ADD_NETWORK_STEM = "add_social_network"
DROP_NETWORK_STEM = "drop_social_network"
STEAL_SUFFIX = "_steal_success"
EXCLUDED_EXPERIMENT, EXCLUDED_SINCE = "GRW_SS_OB_2_2", dt.date(2022, 4, 23)
# The 28-day filter list leaves out the publisher and composer events, so those two
# counts are always 0 (T14); kept as in the source.
D28_CLASSES = ("team", "planner", "analytics", "streams")
RETENTION_DAYS = {"m1": (30, 59), "m2": (60, 89), "m3": (90, 119)}

DIMENSIONS = [
    "experiment", "variant", "acquisition_source", "market", "created_date", "have_sn", "converted", "regularity",
    "finished_trial", "finished_step2", "d0_entered_dashboard", "step2_sns_added", "experiment_week",
    "count_sp_engaged", "trial_plan", "trial_length", "language", "m1_retained", "m2_retained", "m3_retained",
    "habit_moment", "d28_5_msgs_published", "d28_20_scrolls", "d28_5_edits", "d28_5_published_20_scrolled",
    "d28_5_published_5_edited", "refunded", "aha_moment", "d5_published", "d5_scrolled", "d5_edited_planner",
    "d5_published_and_scrolled", "d5_published_and_edited", "d5_navigated_publisher", "d5_clicked_post_ctas_planner",
    "d5_opened_composer", "d5_navigated_planner", "d5_navigated_analytics", "d5_navigated_streams",
    "d28_navigated_publisher", "d28_navigated_planner", "d28_opened_composer", "d28_navigated_analytics",
    "d28_navigated_streams", "d28_added_team_member", "h24_attempted_add_instagram", "setup_moment",
    "h24_added_1_profile", "h24_added_2_profiles", "h24_added_3_profiles", "h24_added_facebook_page",
    "h24_added_igb_direct_publish", "h24_added_any_instagram", "h24_added_twitter", "h24_opened_composer",
    "h24_navigated_planner", "h24_navigated_analytics", "h24_navigated_streams",
]


def _true(c: Column) -> Column:
    return F.when(c, True).otherwise(False)


def exposures(cohort_table: DataFrame, event_log: DataFrame) -> DataFrame:
    """Experiment exposures from the cohort table and the event stream (distinct union);
    each source has its own prefix list (T20)."""
    a = cohort_table.select("member_id", "experiment", "variant", F.col("date").cast("date").alias("date"),
                            experiment_audience("experiment", "cohort").alias("experiment_audience"))
    ev = event_log.filter((F.col("event") == EXPOSURE_EVENT) & (F.col("timestamp") >= lit_date(EXPOSURES_SINCE)))
    b = payload(ev, "data", {"experiment": "$.additional_data.id", "variant": "$.additional_data.variation"})
    b = b.select(F.col("actor_id").alias("member_id"), "experiment", "variant", F.to_date("timestamp").alias("date"),
                 experiment_audience("experiment", "event").alias("experiment_audience"))
    return a.unionByName(b).distinct()


def first_exposures(expo: DataFrame, customers: DataFrame, free_to_trial: DataFrame) -> DataFrame:
    """Each web-signup member's first exposure date per experiment."""
    c = customers.select("member_id", F.col("signup_source").alias("_c_src"))
    f = free_to_trial.select("member_id", F.col("signup_source").alias("_f_src"))
    j = expo.join(c, "member_id", "left").join(f, "member_id", "left")
    j = j.filter(((F.col("_c_src") == WEB) | (F.col("_f_src") == WEB)) & (F.col("date") >= lit_date(MEMBERS_SINCE)))
    return j.groupBy("member_id", "experiment").agg(F.min("date").alias("date"))


def experiment_window(members: DataFrame, min_cohort: int = MIN_COHORT) -> DataFrame:
    """start = earliest first exposure; end = last day on which at least ``min_cohort``
    members had their first exposure; experiments without such a day are dropped. Two
    small aggregates joined, instead of joining every member row to every day row."""
    per_day = members.groupBy("experiment", "date").agg(F.count_distinct("member_id").alias("n"))
    end = per_day.filter(F.col("n") >= min_cohort).groupBy("experiment").agg(F.max("date").alias("end_date"))
    start = members.groupBy("experiment").agg(F.min("date").alias("start_date"))
    return start.join(end, "experiment")


def cohorts(expo: DataFrame, experiments: DataFrame, customers: DataFrame, members: DataFrame,
            products: DataFrame, free_to_trial: DataFrame) -> DataFrame:
    lang = F.when(F.col("language").isin(*LANGUAGES), F.col("language")).otherwise("other")
    me = members.select("member_id", "market", "language")
    e = experiments
    paid = (expo.filter(F.col("experiment_audience") == "paid").join(e, "experiment")
                .join(customers.select("member_id", "acquisition_source", "trial_plan", "trial_length", "trial_type",
                                       "trial_start_date", "trial_end_date"), "member_id", "left")
                .join(me, "member_id", "left")
                .join(broadcast_if_bounded(products), F.col("legacy_plan_code") == F.col("trial_plan")))
    start_day = F.date_trunc("day", "trial_start_date")
    paid = paid.filter(
        start_day.between(F.col("start_date"), F.col("end_date")) & (F.col("include_in_ecomm") == "TRUE") &
        (F.col("is_paid") == "TRUE") & (F.col("trial_type") == "immediate") &
        ((F.col("trial_length") == "30_days") |
         ((F.col("trial_length") == "other") &
          (F.datediff(F.to_date("trial_end_date"), F.to_date("trial_start_date")) == 14))))
    paid = paid.select(
        "member_id", "experiment", "experiment_audience", "variant", "acquisition_source", "market", "start_date",
        "end_date", "trial_plan",
        F.when(F.col("trial_length").isin("30_days"), "30_days").otherwise("14_days").alias("trial_length"),
        lang.alias("language"), start_day.alias("trial_start_date"),
        F.date_trunc("day", "trial_end_date").alias("trial_end_date"))
    f = free_to_trial.select("member_id", "acquisition_source", "signup_source", "free_signup_date")
    free = (expo.filter(F.col("experiment_audience") == "free").join(e, "experiment")
                .join(f, "member_id", "left").join(me, "member_id", "left")
                .filter((F.col("signup_source") == WEB) &
                        F.date_trunc("day", "free_signup_date").between(F.col("start_date"), F.col("end_date"))))
    free = free.select(
        "member_id", "experiment", "experiment_audience", "variant", "acquisition_source", "market", "start_date",
        "end_date", F.lit("free").alias("trial_plan"), F.lit("0_days").alias("trial_length"), lang.alias("language"),
        F.col("free_signup_date").alias("trial_start_date"),
        F.col("end_date").cast("timestamp_ntz").alias("trial_end_date"))
    return paid.distinct().unionByName(free.distinct())


def _facts(df: DataFrame, prefix: str) -> DataFrame:
    return df.select("member_id", *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != "member_id"])


def conversions(coh: DataFrame, networks: DataFrame, trial_to_paying: DataFrame, members: DataFrame,
                facts: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    """Per cohort row: anchors, conversion tri-state, week bucket and onboarding flags."""
    paid = F.col("experiment_audience") == "paid"
    free = F.col("experiment_audience") == "free"
    sn = networks.select(F.col("owner_member_id").alias("member_id")).distinct().withColumn("_sn", F.lit(True))
    tp = trial_to_paying.select("member_id", F.col("converted").alias("_conv"), F.lit(True).alias("_tp"))
    m = members.select("member_id", "experiment", F.col("date").alias("_m_date"))
    j = (coh.join(sn, "member_id", "left").join(tp, "member_id", "left").join(m, ["member_id", "experiment"], "left"))
    for prefix, name in [("s_", "setup_paid"), ("sf_", "setup_free"), ("h_", "habit_paid"), ("hf_", "habit_free"),
                         ("a_", "aha_paid"), ("af_", "aha_free")]:
        j = j.join(_facts(facts[name], prefix), "member_id", "left")

    def either(col: str, op: str, value) -> Column:
        cmp = {">=": lambda c: c >= value, ">": lambda c: c > value}[op]
        p, fr = col.split("|")
        return _true(cmp(F.col(p)) | (free & cmp(F.col(fr))))

    def by_audience(p: str, fr: str) -> Column:
        return F.when(paid, F.coalesce(F.col(p), F.lit(False))).otherwise(F.coalesce(F.col(fr), F.lit(False)))

    out = j.select(
        "member_id", "experiment", "experiment_audience", "variant", "acquisition_source", "market",
        F.when(paid, F.col("trial_start_date")).alias("trial_start_date"),
        F.when(paid, F.col("trial_end_date")).alias("trial_end_date"),
        F.date_trunc("day", F.coalesce(F.col("trial_start_date"), F.col("_m_date").cast("timestamp_ntz")))
         .alias("created_date_c"),
        _true(F.col("_sn").isNotNull()).alias("have_sn"),
        tri_state(F.col("_tp").isNotNull(), F.col("_conv") == 1).alias("converted"),
        week_bucket("trial_start_date", as_of).alias("experiment_week"),
        "trial_plan", "trial_length", "language",
        by_audience("s_setup_moment", "sf_setup_moment").alias("setup_moment"),
        either("s_count_social_profiles_added_24h|sf_count_social_profiles_added_24h", ">=", 1).alias("h24_added_1_profile"),
        either("s_count_social_profiles_added_24h|sf_count_social_profiles_added_24h", ">=", 2).alias("h24_added_2_profiles"),
        either("s_count_social_profiles_added_24h|sf_count_social_profiles_added_24h", ">=", 3).alias("h24_added_3_profiles"),
        either("s_count_facebook_pages_added_24h|sf_count_facebook_pages_added_24h", ">", 0).alias("h24_added_facebook_page"),
        either("s_count_igb_direct_publish_added_24h|sf_count_igb_direct_publish_added_24h", ">", 0)
        .alias("h24_added_igb_direct_publish"),
        either("s_count_any_instagram_added_24h|sf_count_any_instagram_added_24h", ">", 0).alias("h24_added_any_instagram"),
        either("s_count_twitter_added_24h|sf_count_twitter_added_24h", ">", 0).alias("h24_added_twitter"),
        by_audience("s_opened_composer_24h", "sf_opened_composer_24h").alias("h24_opened_composer"),
        by_audience("h_habit_moment", "hf_habit_moment").alias("habit_moment"),
        either("h_count_messages_published_28d|hf_count_messages_published_28d", ">=", 5).alias("d28_5_msgs_published"),
        either("h_count_streams_scrolls_28d|hf_count_streams_scrolls_28d", ">=", 20).alias("d28_20_scrolls"),
        either("h_count_edits_planner_28d|hf_count_edits_planner_28d", ">=", 5).alias("d28_5_edits"),
        by_audience("a_aha_moment", "af_aha_moment").alias("aha_moment"),
        either("a_count_messages_published_5d|af_count_messages_published_5d", ">", 0).alias("d5_published"),
        either("a_count_streams_scrolls_5d|af_count_streams_scrolls_5d", ">", 0).alias("d5_scrolled"),
        either("a_count_edits_planner_5d|af_count_edits_planner_5d", ">", 0).alias("d5_edited_planner"),
    )
    out = out.withColumns({
        "d28_5_published_20_scrolled": _true(F.col("d28_5_msgs_published") & F.col("d28_20_scrolls")),
        "d28_5_published_5_edited": _true(F.col("d28_5_msgs_published") & F.col("d28_5_edits")),
        "d5_published_and_scrolled": _true(F.col("d5_published") & F.col("d5_scrolled")),
        "d5_published_and_edited": _true(F.col("d5_published") & F.col("d5_edited_planner"))})
    return out.distinct()


def read_out_classes(meaningful_events, any_product: Column, paid_product: Column) -> dict[str, Column]:
    """``any_product`` / ``paid_product``: whether the event's product counts for retention."""
    e = F.col("event")
    steal = e.endswith(STEAL_SUFFIX)
    # only call-to-action events look into their payload
    page = F.when(e.isin(*POST_CTA_EVENTS), F.get_json_object("data", "$.additional_data.sourcePage"))
    meaningful = e.isin(*meaningful_events)
    return {
        "finish": e.isin(*FINISH_STEP_2_EVENTS), "dashboard": e == DASHBOARD_EVENT,
        "instagram": e.isin(*INSTAGRAM_ATTEMPT_EVENTS), "planner": e.isin(*PLANNER_EVENTS),
        "analytics": e.isin(*ANALYTICS_EVENTS), "streams": e.isin(*STREAMS_EVENTS), "publisher": e == PUBLISHER_EVENT,
        "planner_post": page == "planner", "composer": e.isin(*COMPOSER_EVENTS), "team": e == TEAM_MEMBER_EVENT,
        "added": e.startswith(ADD_NETWORK_PREFIX) | steal,
        "engaged": ~(e.isin(*ENGAGEMENT_EXCLUDED_EVENTS) | steal | e.startswith(ADD_NETWORK_STEM) | e.startswith(DROP_NETWORK_STEM)),
        "kept": meaningful & any_product, "kept_paid": meaningful & paid_product,
    }


def retention_products(products: DataFrame) -> DataFrame:
    """Product codes with what their rows allow: whether any row counts (and one that is paid
    for), for events whose plan is known (``listed``) and for those whose plan is not."""
    listed = (F.col("include_in_ecomm") == "TRUE") | (F.col("include_in_enterprise") == "TRUE")
    paid = F.col("is_paid") == "True"

    def holds(c: Column) -> Column:
        return F.coalesce(F.bool_or(c), F.lit(False))

    return products.groupBy(F.col("billing_product_code").alias("member_effective_product_code")).agg(
        holds(listed).alias("_listed"), holds(listed & paid).alias("_listed_paid"), holds(paid).alias("_paid"))


def experiment_funnel(conv: DataFrame, event_log: DataFrame, products: DataFrame, meaningful_events) -> DataFrame:
    """The funnel state of every (member, created day, network): one anchor x event join, dealt
    by member and week, reduced where the pairs are made. Experiments that share a member and
    a day share their pairs. An event comes as its time, network and classes."""
    anchors = conv.select("member_id", "created_date_c").distinct()
    ev = event_log.join(broadcast_if_bounded(retention_products(products)), "member_effective_product_code", "left")
    no_plan = F.col("member_max_plan").isNull()
    classes = read_out_classes(
        meaningful_events, F.coalesce(F.col("_listed") | (no_plan & F.col("_listed").isNotNull()), F.lit(False)),
        F.coalesce(F.col("_listed_paid") | (no_plan & F.col("_paid")), F.lit(False)))
    ev = ev.select("actor_id", "timestamp", "social_network_id", event_classes(classes)).where("classes <> 0")
    pairs = events_in_window(anchors, ev, "member_id", "created_date_c", 0, 119, event_key="actor_id", days=7)
    pairs = pairs.select("_b.member_id", "_b.created_date_c", "_e.timestamp", "_e.social_network_id", "_e.classes")

    def of(*names: str) -> Column:
        return has_class(classes, *names)

    ts, cr = F.col("timestamp"), F.col("created_date_c")
    in29, d0 = ts <= shift(cr, 29, "day"), ts < shift(cr, 1, "day")
    d5, d28 = ts <= shift(cr, 119, "hour"), ts <= shift(cr, 27, "day")
    day = F.datediff(F.to_date(ts), F.to_date(cr))
    later = ts >= shift(cr, 30, "day")
    pairs = pairs.where(in29 | of("kept"))  # past day 29 only retention is read
    counts = {"engaged": in29 & of("engaged"), "kept": later & of("kept")}
    counts |= {f"d0_{c}": d0 & of(c) for c in ("instagram", "planner", "analytics", "streams")}
    counts |= {f"d5_{c}": d5 & of(c) for c in ("publisher", "planner_post", "composer", "planner", "analytics", "streams")}
    # the 28-day filter list leaves out the publisher and composer events
    counts |= {f"d28_{c}": d28 & of(c) & F.lit(c in D28_CLASSES) for c in ("team", "publisher", "composer", "planner", "analytics", "streams")}
    for m, (lo, hi) in RETENTION_DAYS.items():
        counts |= {f"{m}_free": later & day.between(lo, hi) & of("kept"), f"{m}_paid": later & day.between(lo, hi) & of("kept_paid")}
    return funnel_state(pairs, ["member_id", "created_date_c", "social_network_id"], "timestamp",
                        {"finish": in29 & of("finish"), "dashboard": in29 & of("dashboard"), "added": in29 & of("added")}, counts)


def event_measures(conv: DataFrame, event_log: DataFrame, products: DataFrame, meaningful_events):
    """All windowed event measures, from the written funnel state."""
    state = materialize(experiment_funnel(conv, event_log, products, meaningful_events), "experiment_funnel")
    by_anchor = merge_states(state, ["member_id", "created_date_c"])
    finish = by_anchor.where("first_finish IS NOT NULL").select("member_id", "created_date_c", F.col("first_finish").alias("finish_ts"))
    dashboard = by_anchor.where("first_dashboard IS NOT NULL").select("member_id", "created_date_c", F.col("first_dashboard").alias("dashboard_ts"))

    names = {f"h24_{o}": f"d0_{c}" for o, c in (("attempted_add_instagram", "instagram"), ("navigated_planner", "planner"),
                                               ("navigated_analytics", "analytics"), ("navigated_streams", "streams"))}
    names |= {f"d5_{o}": f"d5_{c}" for o, c in (("navigated_publisher", "publisher"), ("clicked_post_ctas_planner", "planner_post"),
                                                ("opened_composer", "composer"), ("navigated_planner", "planner"),
                                                ("navigated_analytics", "analytics"), ("navigated_streams", "streams"))}
    names |= {f"d28_{o}": f"d28_{c}" for o, c in (("added_team_member", "team"), ("navigated_publisher", "publisher"),
                                                  ("opened_composer", "composer"), ("navigated_planner", "planner"),
                                                  ("navigated_analytics", "analytics"), ("navigated_streams", "streams"))}
    flags = state.groupBy("member_id").agg(*[(F.sum(f"n_{c}") > 0).alias(o) for o, c in names.items()])
    per_member = flags.join(distinct_of(state, ["member_id"], "social_network_id", {"count_sp_engaged": "engaged"}), "member_id")
    # Networks added before the member's (latest) first dashboard visit, all when none
    marker = dashboard.groupBy("member_id").agg(F.max("dashboard_ts").alias("marker"))
    step2 = distinct_before(state, "member_id", "social_network_id", "added", marker, "marker", "step2_sns_added", unit="second")

    # Month 1-3 retention by whole days since the anchor, different rules per audience
    anchors = conv.select("member_id", "experiment", "experiment_audience", "created_date_c").distinct()
    ret = anchors.join(by_anchor.where("n_kept > 0"), ["member_id", "created_date_c"])
    paid = F.col("experiment_audience") == "paid"
    free = F.col("experiment_audience") == "free"
    ret = ret.groupBy("member_id", "experiment", "experiment_audience").agg(*[
        F.bool_or((paid & (F.col(f"n_{m}_paid") > 0)) | (free & (F.col(f"n_{m}_free") > 0))).alias(f"{m}_retained") for m in RETENTION_DAYS])
    return finish, dashboard, per_member, step2, ret.drop("experiment_audience")


def experiment_monitoring(cohort_table: DataFrame, event_log: DataFrame, customers: DataFrame,
                          free_to_trial: DataFrame, members: DataFrame, products: DataFrame,
                          networks: DataFrame, trial_to_paying: DataFrame, facts: dict[str, DataFrame],
                          payments: DataFrame, first_payments: DataFrame, engagement_days: DataFrame,
                          meaningful_events, as_of: dt.date, min_cohort: int = MIN_COHORT) -> DataFrame:
    """Distinct members per combination of the 58 read-out dimensions."""
    # read by the first-exposure aggregate and both cohort branches, each pushing its own
    # filter below the distinct (so no exchange reuse): write it once
    expo = materialize(exposures(cohort_table, event_log), "exposures")
    firsts = first_exposures(expo, customers, free_to_trial)
    exps = experiment_window(firsts, min_cohort)
    coh = cohorts(expo, exps, customers, members, products, free_to_trial)
    conv = materialize(conversions(coh, networks, trial_to_paying, firsts, facts, as_of), "conversions")
    finish, dashboard, per_member, step2, ret = event_measures(conv, event_log, products, meaningful_events)
    activity = active_days_in_window(conv.select("member_id", "created_date_c"), engagement_days, "member_id",
                                     "created_date_c", 29, "activity_date_utc", out="regularity")
    base = (conv.filter(F.col("experiment_audience") == "paid")
                .select("member_id", "trial_start_date")
                .join(first_payments, "member_id", "left"))
    refunds = first_refund(payments, base, "member_id", "trial_start_date", "first_overall_payment")
    s = (conv.join(activity, "member_id", "left")
             .join(finish.select("member_id", F.lit(True).alias("_fin")), "member_id", "left")
             .join(dashboard.select("member_id", F.col("created_date_c").alias("_ed_created"), "dashboard_ts"),
                   "member_id", "left")
             .join(step2, "member_id", "left")
             .join(per_member, "member_id", "left")
             .join(ret, ["member_id", "experiment"], "left")
             .join(refunds.select("member_id", F.lit(True).alias("_ref")), "member_id", "left"))
    created = F.col("created_date_c")
    s = s.withColumn("exclude_ind", _true((F.col("experiment") == EXCLUDED_EXPERIMENT) &
                                          (created >= lit_date(EXCLUDED_SINCE))))
    s = s.filter(F.col("exclude_ind") == F.lit(False))
    end = F.col("trial_end_date")
    coalesce_false = ["m1_retained", "m2_retained", "m3_retained", "h24_navigated_planner", "h24_navigated_analytics",
                      "h24_navigated_streams", "d5_navigated_publisher", "d5_clicked_post_ctas_planner",
                      "d5_opened_composer", "d5_navigated_planner", "d5_navigated_analytics", "d5_navigated_streams",
                      "d28_navigated_publisher", "d28_navigated_planner", "d28_opened_composer",
                      "d28_navigated_analytics", "d28_navigated_streams", "d28_added_team_member",
                      "h24_attempted_add_instagram"]
    exprs = {
        "created_date": created,
        "regularity": F.coalesce(F.col("regularity"), F.lit(0)).cast("bigint"),
        "finished_trial": (F.when((F.datediff(lit_date(as_of), F.to_date(end)) > 0) & end.isNotNull(), F.lit(True))
                            .when(end.isNull(), F.lit(None).cast("boolean")).otherwise(F.lit(False))),
        "finished_step2": _true(F.col("_fin").isNotNull()),
        "d0_entered_dashboard": _true(F.col("_ed_created").isNotNull() &
                                      (F.to_date("_ed_created") == F.to_date("dashboard_ts"))),
        "step2_sns_added": F.coalesce(F.col("step2_sns_added"), F.lit(0)).cast("bigint"),
        "count_sp_engaged": F.coalesce(F.col("count_sp_engaged"), F.lit(0)).cast("bigint"),
        "refunded": _true(F.col("_ref").isNotNull()),
    }
    for c in coalesce_false:
        exprs[c] = F.coalesce(F.col(c), F.lit(False))
    dims = [exprs.get(d, F.col(d)).alias(d) for d in DIMENSIONS]
    return (s.select("member_id", *dims).groupBy(*DIMENSIONS)
             .agg(F.count_distinct("member_id").alias("count_members")))

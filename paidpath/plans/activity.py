"""Monthly active customers (M07): org-month and member-month activity roll-up.

Plan shape, built for a hot member or org holding a third of all events:

1. Events are filtered (allow-list join on a size-checked broadcast mapping, year and product-code
   predicates pushed to the scan) and reduced in one pass (map-side partial aggregation)
   to one row per member x month x category x day x network, written once. The events
   table is scanned exactly once.
2. The organization and payer rules ("last organization of the member-month", "last
   organization of the payer-month", "last payer of the org-month") are ``max_by``
   aggregates over member-month summaries, joined back on equi keys. No window has to
   hold a hot member's events in one task.
3. Each member-category-day row is exploded to at most three labels (all, its category,
   any_inbox) and aggregated once with two distinct counts, then pivoted to columns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidpath.functions.calendar import lit_date
from paidpath.functions.rules import surrogate_key
from paidpath.functions.calendar import add_months_py, month_start
from paidpath.session import materialize
from paidpath.operators.sizing import broadcast_if_bounded
from paidpath.sources.versions import MonthTable

# Measure suffixes in output order, and the categories each one counts.
LABELS = ["all", "composer", "planner", "analytics", "amplify", "any_inbox", "inbox_1", "inbox_2", "streams"]
INBOX = ("inbox_1", "inbox_2")
EMPLOYEE_CODE = "EMPLOYEE"
SUMMARY_EVENT_PATTERN = "%_messages_summary"   # network type is dropped for these events
EVENTS_SINCE = dt.date(2018, 1, 1)


def join_null_safe(a: DataFrame, b: DataFrame, keys, how: str) -> DataFrame:
    """Equi-join where null keys match (member-level rows have a null organization)."""
    b2 = b.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return a.join(b2, cond, how).drop(*[f"_r_{k}" for k in keys])


def _suffix(label):
    return "" if label == "all" else f"_{label}"


def output_columns():
    cols = ["primary_key", "member_id", "organization_id", "month_of_activity"]
    cols += [f"is_active{_suffix(lab)}" for lab in LABELS]
    cols += ["count_active_events"] + [f"count_{lab}_events" for lab in LABELS[1:]]
    cols += ["count_active_users"] + [f"count_active_{lab}_users" for lab in LABELS[1:]]
    cols += [f"days_active{_suffix(lab)}" for lab in LABELS]
    return cols + ["count_social_networks_used", "count_products"]


def label_column(category: str) -> Column:
    """The labels that an event of a category counts under, at most three."""
    cat = F.col(category)
    return F.array_compact(F.array(F.lit("all"), cat, F.when(cat.isin(*INBOX), F.lit("any_inbox"))))


def active_events(events: DataFrame, meaningful: DataFrame, as_of: dt.date | None = None,
                  lookback_months: int | None = None) -> DataFrame:
    """Allow-listed active events since 2018 (optionally only the recomputed months)."""
    m = meaningful.filter(F.col("is_active_event") == F.lit(True)).select("event", "activity_category")
    e = events.filter((F.col("timestamp") >= lit_date(EVENTS_SINCE)) &
                      (F.col("member_effective_product_code") != EMPLOYEE_CODE))
    if lookback_months is not None:
        cutoff = add_months_py(month_start(as_of), -lookback_months)
        e = e.filter(F.col("timestamp") >= lit_date(cutoff))
    e = e.join(broadcast_if_bounded(m), "event")
    return e.select(
        "activity_category", F.col("actor_id").alias("member_id"),
        F.trunc("timestamp", "month").alias("month_of_activity"), "timestamp",
        F.when(~F.col("event").ilike(SUMMARY_EVENT_PATTERN), F.col("social_network_type")).alias("social_network_type"),
        "organization_id")


def event_summary(ev: DataFrame) -> DataFrame:
    """One pass over the events: distinct events (category, member, month, timestamp,
    network) reduced to one row per member x month x category x day x network with the
    event count, the latest timestamp and the organization of the latest event.

    Both steps are hash aggregates with map-side partial aggregation; the result is far
    smaller than the event table and is the only input of every later step."""
    by_ts = (ev.groupBy("member_id", "month_of_activity", "activity_category", F.to_date("timestamp").alias("day"),
                        "social_network_type", "timestamp")
               .agg(F.max("organization_id").alias("organization_id")))
    return (by_ts.groupBy("member_id", "month_of_activity", "activity_category", "day", "social_network_type")
                 .agg(F.count("*").alias("n"), F.max("timestamp").alias("last_ts"),
                      F.max_by("organization_id", "timestamp").alias("last_org")))


def resolve_groups(summary: DataFrame, organizations: DataFrame, customers: DataFrame) -> DataFrame:
    """Per member-month: the (organization_id, member_id) group its events count under.

    last organization of the member-month (nulls kept), then the payer's last organization
    of the month, then the organization's last payer of the month; ties on the timestamp
    go to the larger id. All three are ``max_by`` aggregates over member-month rows."""
    mm = summary.groupBy("member_id", "month_of_activity").agg(
        F.max_by("last_org", F.struct("last_ts", "last_org")).alias("org"),
        F.max("last_ts").alias("last_ts"))
    o = organizations.select(F.col("organization_id").alias("org"), "payment_member_id")
    c1 = customers.select(F.col("member_id").alias("payment_member_id"), F.col("member_id").alias("_c1"))
    c2 = customers.select("member_id", F.col("member_id").alias("_c2"))
    mm = (mm.join(o, "org", "left").join(c1, "payment_member_id", "left").join(c2, "member_id", "left")
            .select("member_id", "month_of_activity", "org", "last_ts",
                    F.coalesce("_c1", "_c2").alias("payer"),
                    F.coalesce("_c1", "_c2", "member_id").alias("payer_key")))
    mm = materialize(mm, "member_months")      # read by both rule aggregates and the joins back
    key = ["payer_key", "month_of_activity"]
    org2 = (mm.filter(F.col("org").isNotNull()).groupBy(*key)
              .agg(F.max_by("org", F.struct("last_ts", "org")).alias("org2")))
    mm = mm.join(org2, key, "left")
    key = ["org2", "month_of_activity"]
    payer2 = (mm.filter(F.col("org2").isNotNull() & F.col("payer").isNotNull()).groupBy(*key)
                .agg(F.max_by("payer", F.struct("last_ts", "payer")).alias("payer2")))
    mm = mm.join(payer2, key, "left")
    has_org = F.col("org2").isNotNull()
    return mm.select("member_id", "month_of_activity",
                     F.col("org2").alias("g_org"),
                     F.when(has_org, F.col("payer2")).otherwise(F.col("member_id")).alias("g_member"))


def monthly_active_customers(events: DataFrame, meaningful: DataFrame, customers: DataFrame,
                             organizations: DataFrame, as_of: dt.date | None = None,
                             incremental: bool = False, lookback_months: int = 2) -> DataFrame:
    """Org-month and member-month activity with 9 flags, 9 event counts, 9 user
    counts, 9 day counts, networks and products, keyed by a surrogate key."""
    ev = active_events(events, meaningful, as_of, lookback_months if incremental else None)
    summary = materialize(event_summary(ev), "event_summary")
    return activity_roll_up(summary, customers, organizations)


def refresh_monthly_active(state: MonthTable, table: MonthTable, events: DataFrame, meaningful: DataFrame, customers: DataFrame,
                           organizations: DataFrame, as_of: dt.date, lookback_months: int = 2) -> DataFrame:
    """M07, incrementally, over stored state. ``state`` keeps ``event_summary`` by month. The
    months from ``lookback_months`` before the run date on are read from the events and
    replace their states; a state of an older month is kept as it is, and its events are not
    read. The model's rows of the same months come from the stored states and replace theirs
    in ``table``. Each is swapped as one version, the state first, so a run that fails in
    between is repaired by the next. The first run reads everything."""
    def recent(month) -> bool:
        return cutoff is None or (month is not None and month >= cutoff)

    cutoff = add_months_py(month_start(as_of), -lookback_months) if state.version() else None
    events = events.filter(F.col("timestamp") < lit_date(as_of))
    state.replace(event_summary(active_events(events, meaningful, as_of, lookback_months if cutoff else None)), recent)
    if not table.version():
        cutoff = None
    table.replace(activity_roll_up(state.read(since=cutoff), customers, organizations), recent)
    return table.read()


def activity_roll_up(summary: DataFrame, customers: DataFrame, organizations: DataFrame) -> DataFrame:
    """M07's rows of the months of an event summary; months do not depend on each other."""
    groups = materialize(resolve_groups(summary, organizations, customers), "activity_groups")
    g = ["g_org", "g_member", "month_of_activity"]
    x = summary.join(groups, ["member_id", "month_of_activity"])
    per_day = x.groupBy(*g, "member_id", "activity_category", "day").agg(F.sum("n").alias("n"))
    per_label = (per_day.withColumn("label", F.explode(label_column("activity_category")))
                 .groupBy(*g, "label")
                 .agg(F.sum("n").alias("events"), F.count_distinct("day").alias("days"),
                      F.count_distinct("member_id").alias("users")))
    wide = per_label.groupBy(*g).pivot("label", LABELS).agg(
        F.first("events").alias("e"), F.first("days").alias("d"), F.first("users").alias("u"))
    breadth = x.groupBy(*g).agg(F.count_distinct("activity_category").alias("count_products"),
                                F.count_distinct("social_network_type").alias("count_social_networks_used"))
    out = join_null_safe(wide, breadth, g, "inner")

    def z(c):
        return F.coalesce(F.col(c), F.lit(0)).cast("bigint")

    sel = [F.col("g_member").alias("member_id"), F.col("g_org").alias("organization_id"), "month_of_activity"]
    sel += [(z(f"{lab}_e") > 0).alias(f"is_active{_suffix(lab)}") for lab in LABELS]
    sel += [z("all_e").alias("count_active_events")] + [z(f"{lab}_e").alias(f"count_{lab}_events") for lab in LABELS[1:]]
    sel += [z("all_u").alias("count_active_users")] + [z(f"{lab}_u").alias(f"count_active_{lab}_users")
                                                        for lab in LABELS[1:]]
    sel += [z(f"{lab}_d").alias(f"days_active{_suffix(lab)}") for lab in LABELS]
    sel += [z("count_social_networks_used").alias("count_social_networks_used"),
            z("count_products").alias("count_products")]
    res = out.select(*sel)
    res = res.withColumn("primary_key", surrogate_key("member_id", "organization_id", "month_of_activity"))
    return res.select(*output_columns())

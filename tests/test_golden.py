"""Hand-made inputs with at least one row per rule branch (FIXTURES.md, golden cases)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

D = dt.date
T = dt.datetime


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---- W22: MRR movements ---------------------------------------------------------------------

def test_w22_movement_branches(spark):
    from paidpath.plans.waterfall import mrr_movements
    schema = ("member_id long, payment_month date, plan string, billing_interval string, is_active boolean, "
              "is_tier_1_icp_member boolean, is_activated boolean, mrr decimal(18,2)")
    data = [
        # member 0: first month, same, higher same plan, higher other plan, lower, gap, return
        (0, D(2020, 1, 1), "a", "m", True, False, True, Decimal("10")),
        (0, D(2020, 2, 1), "a", "m", True, False, True, Decimal("10")),
        (0, D(2020, 3, 1), "a", "m", False, False, True, Decimal("15")),
        (0, D(2020, 4, 1), "b", "m", True, False, True, Decimal("20")),
        (0, D(2020, 5, 1), "b", "m", True, False, True, Decimal("12")),
        (0, D(2020, 7, 1), "b", "m", True, False, True, Decimal("12")),
        # member 1: MRR 0 month (no movement) and a negative month
        (1, D(2020, 1, 1), "a", "m", True, True, False, Decimal("5")),
        (1, D(2020, 2, 1), "a", "m", True, True, False, Decimal("0")),
        (1, D(2020, 3, 1), "a", "m", True, True, False, Decimal("-3")),
        (1, D(2020, 4, 1), "a", "m", True, True, False, Decimal("4")),
    ]
    mm = spark.createDataFrame(data, schema)
    out = mrr_movements(mm, D(2020, 8, 15), None, D(2018, 1, 1))
    got = {(r.member_id, r.mrr_month): (r.change, r.moved.mrr, r.moved.mrr_change) for r in out.collect()}
    assert got[(0, D(2020, 1, 1))] == ("net_new", Decimal("10"), Decimal("10"))     # member id 0 counts (T1)
    assert got[(0, D(2020, 2, 1))] == ("previous_month", Decimal("10"), Decimal("0"))
    assert got[(0, D(2020, 3, 1))] == ("price_increase", Decimal("15"), Decimal("5"))
    assert got[(0, D(2020, 4, 1))] == ("expansion", Decimal("20"), Decimal("5"))
    assert got[(0, D(2020, 5, 1))] == ("contraction", Decimal("12"), Decimal("-8"))
    assert got[(0, D(2020, 6, 1))] == ("churn", Decimal("-12"), Decimal("-12"))
    assert got[(0, D(2020, 7, 1))] == ("win_back", Decimal("12"), Decimal("12"))
    assert got[(1, D(2020, 2, 1))][0] is None                                      # MRR 0: dropped (T25)
    assert got[(1, D(2020, 3, 1))][0] == "contraction"                             # negative month
    assert got[(1, D(2020, 4, 1))][0] == "expansion"                               # last month <= 0
    churn = out.filter((F.col("member_id") == 0) & (F.col("mrr_month") == D(2020, 6, 1))).first()
    assert churn.moved.plan == "b" and churn.moved.is_active is True                          # carried from last month
    first = out.filter((F.col("member_id") == 0) & (F.col("mrr_month") == D(2020, 1, 1))).first()
    assert first.after_2018_signup is True
    assert out.filter((F.col("member_id") == 0) & (F.col("mrr_month") == D(2020, 2, 1))).first().after_2018_signup is False


# ---- W21: risk labels ---------------------------------------------------------------------------

def test_w21_risk_branches(spark):
    from paidpath.functions.rules import activity_risk
    cases = [  # active, prev, 3w, 2m, 12m -> label
        (1, 1, 3, 2, 5, "1_super_healthy"), (1, None, 1, 1, 1, "3_low_risk"), (1, 1, 2, 2, 2, "2_healthy"),
        (1, 0, 1, 1, 1, "4_medium_risk"), (0, None, 0, 0, 0, "4_medium_risk"), (0, 0, 0, 0, 0, "7_dormant_12m"),
        (0, 0, 0, 0, 3, "6_dormant_2m"), (0, 0, 0, 1, 3, "5_high_risk"), (0, 1, 2, 2, 3, "3_low_risk"),
        (0, 1, 1, 1, 3, "4_medium_risk")]
    df = spark.createDataFrame([c[:5] for c in cases], "a int, p int, w3 int, m2 int, m12 int")
    got = [r[0] for r in df.select(activity_risk("a", "p", "w3", "m2", "m12")).collect()]
    assert got == [c[5] for c in cases]


# ---- W20: calendar frames ----------------------------------------------------------------------

def _closed_window(d):
    import calendar
    feb = calendar.monthrange(d.year, 2)[1]
    if d.month == 3 and feb == 28 and 28 <= d.day <= 30:
        return D(d.year, 2, 28), D(d.year, 3, 27)
    if d.month == 3 and feb == 29 and 29 <= d.day <= 30:
        return D(d.year, 2, 29), D(d.year, 3, 28)
    if d.day == calendar.monthrange(d.year, d.month)[1]:
        return d.replace(day=1), d
    y, m = (d.year, d.month - 1) if d.month > 1 else (d.year - 1, 12)
    prev = D(y, m, min(d.day, calendar.monthrange(y, m)[1]))
    return prev + dt.timedelta(days=1), d


def test_w20_calendar_frames_match_closed_form(spark):
    from paidpath.operators.rolling import calendar_rolling_sum
    start, end = D(2022, 11, 1), D(2024, 12, 31)
    days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    df = spark.createDataFrame([("s", d, i) for i, d in enumerate(days)], "seg string, date date, v long")
    out = {r.date: r.rolling for r in calendar_rolling_sum(df, "v", ["seg"], "date").collect()}
    index = {d: i for i, d in enumerate(days)}
    for d in days[62:]:          # skip the shell's first two months (shorter frames by design)
        lo, hi = _closed_window(d)
        assert out[d] == sum(range(index[lo], index[hi] + 1)), d
    for d in [D(2023, 2, 28), D(2024, 2, 29), D(2023, 3, 1), D(2024, 3, 1), D(2023, 4, 30), D(2023, 5, 31)]:
        assert d in out


# ---- W02: top payment ties ---------------------------------------------------------------------

def test_w02_ties(spark):
    from paidpath.plans.paid_base import top_paying_day_per_month
    schema = "member_id long, payment_date date, plan_name string, billing_interval string, amount decimal(18,2), amount_in_usd decimal(18,2)"
    data = [(1, D(2020, 1, 3), "x", "m", Decimal(5), Decimal(5)), (1, D(2020, 1, 9), "x", "m", Decimal(5), Decimal(5)),
            (2, D(2020, 1, 9), "a", "m", Decimal(7), Decimal(7)), (2, D(2020, 1, 9), "b", "m", Decimal(7), Decimal(7))]
    out = top_paying_day_per_month(spark.createDataFrame(data, schema))
    assert rows(out, "member_id", "date", "plan_name") == [(1, D(2020, 1, 9), "x"), (2, D(2020, 1, 9), "b")]


# ---- W03: one-to-one links ---------------------------------------------------------------------

def test_w03_link_shapes(spark):
    from paidpath.operators.pickers import one_to_one_links
    data = [("a1", 1), ("a2", 2), ("a2", 3), ("a3", 4), ("a4", 4), ("a5", 5), ("a5", 6), ("a6", 5), ("a6", 6),
            ("a7", None), ("a8", 8), ("a8", 8)]
    e = spark.createDataFrame(data, "acc string, org long")
    assert rows(one_to_one_links(e, "acc", "org"), "org", "acc") == [(1, "a1"), (8, "a8")]
    swapped = one_to_one_links(e, "org", "acc")
    assert rows(swapped, "org", "acc") == [(1, "a1"), (8, "a8")]          # symmetric


# ---- W04: last value ---------------------------------------------------------------------------

def test_w04_last_value_nulls_and_ties(spark):
    from paidpath.operators.pickers import last_in_period
    data = [(1, T(2024, 1, 1), 10), (1, T(2024, 1, 2), None), (2, T(2024, 1, 1), 3), (2, T(2024, 1, 1), 4)]
    df = spark.createDataFrame(data, "m long, ts timestamp, org long")
    keep = last_in_period(df, "org", ["m"], ["ts", "org"], out="last")
    skip = last_in_period(df, "org", ["m"], ["ts", "org"], ignore_nulls=True, out="last_nn")
    assert set(rows(keep, "m", "last")) == {(1, None), (2, 4)}
    assert set(rows(skip, "m", "last_nn")) == {(1, 10), (2, 4)}


# ---- W10: window bounds ----------------------------------------------------------------------

def test_w10_bounds(spark):
    from paidpath.operators.events import events_in_window
    a = T(2024, 1, 1)
    base = spark.createDataFrame([(1, a)], "member_id long, anchor timestamp_ntz")
    evs = [a, a + dt.timedelta(days=1), a + dt.timedelta(days=1, microseconds=1), a - dt.timedelta(microseconds=1)]
    ev = spark.createDataFrame([(1, t) for t in evs], "actor_id long, timestamp timestamp_ntz")
    closed = events_in_window(base, ev, "member_id", "anchor", 0, 1, event_key="actor_id")
    opened = events_in_window(base, ev, "member_id", "anchor", 0, 1, closed="left", event_key="actor_id")
    assert sorted(r.timestamp for r in closed.select("_e.timestamp").collect()) == [a, a + dt.timedelta(days=1)]
    assert [r.timestamp for r in opened.select("_e.timestamp").collect()] == [a]
    none = events_in_window(base, ev.limit(0), "member_id", "anchor", 0, 1, how="left", event_key="actor_id")
    assert none.count() == 1


# ---- W14: day buckets ---------------------------------------------------------------------------

def test_w14_day_buckets(spark):
    from paidpath.operators.events import day_bucket_counts
    a = T(2024, 1, 1, 0, 0)
    offsets = [29, 30, 59, 60, 89, 90, 119]
    data = [(1, a, a + dt.timedelta(days=d, hours=h)) for d in offsets for h in (0, 13)]
    df = spark.createDataFrame(data, "member_id long, anchor timestamp_ntz, ts timestamp_ntz")
    r = day_bucket_counts(df, ["member_id"], "anchor", "ts", {"m1": (30, 59), "m2": (60, 89), "m3": (90, 119)}).first()
    assert (r.m1, r.m2, r.m3) == (4, 4, 4)


# ---- W16 / W25: names ---------------------------------------------------------------------------

def test_w25_family_names(spark):
    from paidpath.functions.rules import fold_inbox, fold_inbox_like, social_network_family
    df = spark.createDataFrame([("FaceBook_Instagram",), ("INSTAGRAM_business",), ("OwnApp_x",), ("Twitter",), (None,)],
                               "n string")
    got = [r[0] for r in df.select(social_network_family("n")).collect()]
    assert got == ["facebook", "instagram", None, "twitter", None]
    c = spark.createDataFrame([("inbox_1",), ("inbox_2",), ("planner",), ("my_inbox",)], "c string")
    assert [r[0] for r in c.select(fold_inbox("c")).collect()] == ["inbox", "inbox", "planner", "my_inbox"]
    assert [r[0] for r in c.select(fold_inbox_like("c")).collect()] == ["inbox", "inbox", "planner", "inbox"]


# ---- W29: experiment window ------------------------------------------------------------------

def test_w29_threshold(spark):
    from paidpath.plans.experiments import experiment_window
    data = [(i, "E1", D(2024, 1, 1)) for i in range(29)]                      # 29 first exposures: not enough
    data += [(100 + i, "E1", D(2024, 1, 2)) for i in range(30)]               # 30: qualifies
    data += [(200 + i, "E2", D(2024, 1, 1)) for i in range(10)]               # never reaches 30
    members = spark.createDataFrame(data, "member_id long, experiment string, date date")
    got = rows(experiment_window(members), "experiment", "start_date", "end_date")
    assert got == [("E1", D(2024, 1, 1), D(2024, 1, 2))]


def test_w29_repeat_exposures_do_not_count(spark):
    from paidpath.plans.experiments import exposures, experiment_window, first_exposures
    cohort = spark.createDataFrame(
        [(i, "EX_A", "v0", D(2024, 1, 1)) for i in range(30)] + [(i, "EX_A", "v0", D(2024, 1, 5)) for i in range(30)],
        "member_id long, experiment string, variant string, date date")
    log = spark.createDataFrame([], "actor_id long, event string, timestamp timestamp_ntz, data string")
    cust = spark.createDataFrame([(i, "web") for i in range(30)], "member_id long, signup_source string")
    ftt = spark.createDataFrame([], "member_id long, signup_source string")
    win = experiment_window(first_exposures(exposures(cohort, log), cust, ftt))
    assert rows(win, "experiment", "end_date") == [("EX_A", D(2024, 1, 1))]


# ---- W32: allocation ----------------------------------------------------------------------------

def test_w32_allocation_edges(spark):
    from paidpath.operators.revenue import allocate
    df = spark.createDataFrame([(Decimal("100.00"), 1, 3), (Decimal("0.03"), 1, 6), (Decimal("-0.03"), 1, 6),
                                (Decimal("50.00"), 2, 0), (Decimal("50.00"), None, 4)],
                               "amount decimal(18,2), w int, total int")
    got = [r[0] for r in df.select(allocate("amount", "w", "total")).collect()]
    assert got == [Decimal("33.33"), Decimal("0.01"), Decimal("-0.01"), Decimal("0.00"), None]


# ---- W34 / T11 ---------------------------------------------------------------------------------

def test_w34_surrogate_key_and_summary_pattern(spark):
    from paidpath.functions.rules import surrogate_key
    df = spark.createDataFrame([(1, None, D(2024, 1, 1))], "a long, b long, c date")
    import hashlib
    want = hashlib.md5(b"1-_null_-2024-01-01").hexdigest()
    assert df.select(surrogate_key("a", "b", "c")).first()[0] == want
    pat = spark.createDataFrame([("messages_summary",), ("x_messages_summary",), ("xmessages1summary",)], "e string")
    assert [r[0] for r in pat.select(F.col("e").ilike("%_messages_summary")).collect()] == [False, True, True]


# ---- M10 ---------------------------------------------------------------------------------------

def test_m10_versions_and_nulls(spark):
    from paidpath.plans.subscriptions import CUSTOMER_COLUMNS, current_subscriptions
    items = spark.createDataFrame(
        [(1, "c1", 1, D(2020, 1, 31), None, "z"), (1, "c1", 2, D(2020, 2, 29), D(2020, 2, 10), "z"),
         (2, "c2", 1, D(2020, 3, 31), None, "z")],
        "member_id long, original_rate_plan_charge_id string, version int, service_end_date date, "
        "subscription_cancel_date date, billing_system string")
    cols = ", ".join(f"{c} string" for c in CUSTOMER_COLUMNS)
    cust = spark.createDataFrame([(1, D(2020, 1, 1)) + ("x",) * len(CUSTOMER_COLUMNS),
                                  (2, None) + ("y",) * len(CUSTOMER_COLUMNS)],
                                 f"member_id long, non_profit_effective_date date, {cols}")
    out = current_subscriptions(items, cust)
    got = rows(out, "original_rate_plan_charge_id", "version", "next_renewal_date", "is_non_profit")
    assert got == [("c1", 2, D(2020, 2, 11), True), ("c2", 1, D(2020, 4, 1), False)]
    assert out.columns[-1] == "billing_system"


# ---- M07: payer with two orgs, null product code, summary events ------------------------------

def test_m07_payer_orgs_and_traps(spark):
    from paidpath.plans.activity import monthly_active_customers
    ev_schema = ("actor_id long, event string, timestamp timestamp_ntz, organization_id long, "
                 "social_network_type string, member_effective_product_code string")
    events = spark.createDataFrame([
        (1, "compose", T(2024, 1, 3, 10), 10, "facebook", "PRO"),
        (2, "compose", T(2024, 1, 5, 10), 20, "twitter", "PRO"),
        (2, "plan", T(2024, 1, 5, 11), 20, "linkedin", None),               # null code: dropped (T10)
        (2, "x_messages_summary", T(2024, 1, 6, 9), 20, "instagram", "PRO"),  # network dropped (T11)
        (3, "messages_summary", T(2024, 1, 7, 9), None, "instagram", "PRO"),  # no char before: kept
        (3, "compose", T(2024, 1, 7, 9), None, "instagram", "EMPLOYEE"),      # employee: dropped
    ], ev_schema)
    meaningful = spark.createDataFrame(
        [("compose", "composer", True), ("plan", "planner", True), ("x_messages_summary", "inbox_1", True),
         ("messages_summary", "inbox_2", True)], "event string, activity_category string, is_active_event boolean")
    customers = spark.createDataFrame([(1,), (2,), (3,)], "member_id long")
    orgs = spark.createDataFrame([(10, 1), (20, 1)], "organization_id long, payment_member_id long")
    out = {(r.organization_id, r.member_id): r for r in
           monthly_active_customers(events, meaningful, customers, orgs).collect()}
    assert set(out) == {(20, 1), (None, 3)}
    org = out[(20, 1)]                              # both members paid by member 1, last org 20
    assert org.count_active_users == 2 and org.count_active_events == 3
    assert org.count_planner_events == 0            # the null-code event is gone
    assert org.count_any_inbox_events == 1 and org.is_active_inbox_1
    assert org.count_social_networks_used == 2      # facebook, twitter; instagram masked
    assert org.count_products == 2 and org.days_active == 3
    solo = out[(None, 3)]
    assert solo.count_active_events == 1 and solo.count_social_networks_used == 1 and solo.is_active_inbox_2


# ---- M06 / W28: unknown conversion stays null -------------------------------------------------------

def test_w28_unknown_is_null(spark):
    from paidpath.functions.rules import tri_state
    df = spark.createDataFrame([(True, 1), (True, 0), (False, None)], "present boolean, converted int")
    got = [r[0] for r in df.select(tri_state(F.col("present"), F.col("converted") == 1)).collect()]
    assert got == [True, False, None]


# ---- M09: segments, zero totals, different product lists (T12) -------------------------------

def test_m09_allocation_branches(spark):
    from paidpath.plans.attribution import PRODUCTS, arr_attribution
    cols = ", ".join(f"{p}_days int" for p in PRODUCTS)
    def usage(org, member, seg, **days):
        return (org, member, D(2024, 1, 1), seg, *[days.get(p, 0) for p in PRODUCTS])
    u = spark.createDataFrame([
        usage(1, 10, "enterprise", composer=2),                 # org 1: 2 + (6 planner + 2 helpdesk) = 10 days
        usage(1, 11, "enterprise", planner=6, helpdesk=2),
        usage(2, 20, "enterprise"),                             # org total 0 -> 0.00
        usage(None, 30, None, inbox=3),                         # null segment -> enterprise branch, no org
        usage(3, 40, "smb", analytics=1, streams=3),            # self-serve: own MRR x 12
    ], f"organization_id long, member_id long, date_month date, segments string, {cols}")
    ent = spark.createDataFrame([(1, D(2024, 1, 5), Decimal("60.00")), (1, D(2024, 1, 20), Decimal("40.00")),
                                 (2, D(2024, 1, 2), Decimal("50.00"))], "organization_id long, date date, arr decimal(18,2)")
    rev = spark.createDataFrame([(40, D(2024, 1, 3), Decimal("10.00"), False), (40, D(2024, 1, 9), Decimal("5.00"), None)],
                                "member_id long, payment_month date, mrr decimal(18,2), refunded_for_first_payment boolean")
    out = {r.member_id: r for r in arr_attribution(u, ent, rev).collect()}
    assert out[10].arr_attribution == Decimal("20.00") and out[10].composer_arr_attribution == Decimal("20.00")
    # member total leaves helpdesk out (6 days) while the org total counts it
    assert out[11].arr_attribution == Decimal("60.00")
    assert out[11].planner_arr_attribution == Decimal("60.00") and out[11].helpdesk_arr_attribution == Decimal("20.00")
    assert out[20].arr_attribution == Decimal("0.00")
    assert out[30].arr_attribution == Decimal("0.00")                                   # no org: no total
    assert out[40].arr_attribution == Decimal("120.00")                                 # null refund flag dropped
    assert out[40].analytics_arr_attribution == Decimal("30.00") and out[40].streams_arr_attribution == Decimal("90.00")


# ---- M02: duplicate account rows, tiers, unresolved orgs --------------------------------------

def test_m02_profiles(spark):
    from paidpath.plans.org_profiles import org_profiles
    acc = spark.createDataFrame([
        ("A1", 100, "Tier 2", "F", "small", "CA"), ("A1", 100, None, "F", None, None),     # duplicate rows: max
        ("A2", 200, "x", "O", "large", "US"), ("A2", 201, "x", "O", "large", "US"),     # two orgs: unresolved
        ("A3", None, "tier 3 and 1", "P", "medium", "FR"),                               # no primary org
    ], "id string, organisation_id__c long, icp_tier__c string, industry string, no_of_employees__c string, "
       "billingcountry string")
    orgs = spark.createDataFrame([(300, "A3"), (400, "A1"), (400, "A9")], "organization_id__c long, account__c string")
    ind = spark.createDataFrame([("F", "Finance"), ("P", "Public")], "legacy_sf_industry string, current_sf_industry string")
    size = spark.createDataFrame([("small", "1-50"), ("medium", "51-1000")], "legacy_sf_emps string, current_sf_emps string")
    rows = sorted(tuple(r) for r in org_profiles(acc, orgs, ind, size).collect())
    assert rows == [
        ("100", "A1", "CA", "Finance", "1-50", "tier_2"),  # given twice, one row
        ("200", None, None, None, None, "unknown"), ("201", None, None, None, None, "unknown"),
        ("300", "A3", "FR", "Public", "51-1000", "tier_1"), ("400", None, None, None, None, "unknown")]


# ---- M06: month 1-3 retention (W14), product rules, closed day-119 bound (T15, T18) ---------

def test_m06_retention_buckets(spark):
    from paidpath.plans.experiments import event_measures
    c = T(2024, 1, 1)
    conv = spark.createDataFrame([(1, "EX_A", "paid", c), (2, "EX_A", "free", c), (3, "EX_A", "paid", c),
                                  (4, "EX_A", "paid", c)],
                                 "member_id long, experiment string, experiment_audience string, created_date_c timestamp_ntz")
    day = dt.timedelta(days=1)
    ev = spark.createDataFrame([
        (1, "m", c + 45 * day, "P1", "pro"),                       # paid, is_paid 'True': month 1
        (2, "m", c + 95 * day, None, None),                        # null code: no product row (T18)
        (2, "m", c + 65 * day, "P2", "pro"),                       # free: any product, month 2
        (3, "m", c + 70 * day, "P2", "pro"),                       # paid but is_paid 'FALSE': not counted
        (3, "other", c + 100 * day, "P1", "pro"),                  # not a meaningful event
        (4, "m", c + 119 * day, "P1", "pro"),                      # exactly day 119 00:00: inside (T15)
        (4, "m", c + 119 * day + dt.timedelta(seconds=1), "P3", "pro"),  # one second later: outside
    ], "actor_id long, event string, timestamp timestamp_ntz, member_effective_product_code string, "
       "member_max_plan string")
    ev = ev.withColumn("social_network_id", F.lit(None).cast("long")).withColumn("data", F.lit("{}"))
    products = spark.createDataFrame(
        [("L1", "P1", "TRUE", "FALSE", "True"), ("L2", "P2", "FALSE", "TRUE", "FALSE"),
         ("L3", "P3", "TRUE", "FALSE", "True")],
        "legacy_plan_code string, billing_product_code string, include_in_ecomm string, include_in_enterprise string, "
        "is_paid string")
    *_, ret = event_measures(conv, ev, products, ["m"])
    got = {r.member_id: (r.m1_retained, r.m2_retained, r.m3_retained) for r in ret.collect()}
    assert got[1] == (True, False, False)
    assert got[2] == (False, True, False)
    assert got.get(3, (False, False, False)) == (False, False, False)
    assert got[4] == (False, False, True)


# ---- W08 / T26: null segment keys never match; W33: no opening row in the open month -------

def test_w08_null_segment_never_matches(spark):
    from paidpath.operators.spines import densify
    shell = spark.createDataFrame([(D(2024, 1, 1), "EU"), (D(2024, 1, 1), None), (D(2024, 1, 2), "EU")],
                                  "date date, market string")
    fact = spark.createDataFrame([(D(2024, 1, 1), "EU", 3), (D(2024, 1, 1), None, 5)],
                                 "date date, market string, n long")
    got = sorted(densify(fact, shell, ["date", "market"]).collect(), key=lambda r: (r.date, r.market or ""))
    assert [(r.date, r.market, r.n) for r in got] == [
        (D(2024, 1, 1), None, None), (D(2024, 1, 1), "EU", 3), (D(2024, 1, 2), "EU", None)]


def test_w33_opening_balance_skips_open_month(spark):
    from paidpath.functions.calendar import current_month_start
    from paidpath.operators.rolling import opening_balance
    ending = spark.createDataFrame([(D(2024, 5, 1), 10), (D(2024, 6, 1), 12)], "month date, arr long")
    out = opening_balance(ending, "month", current_month_start(D(2024, 7, 15)), 1, "metrics", "1_Starting")
    assert rows(out, "month", "arr", "metrics") == [(D(2024, 6, 1), 10, "1_Starting")]

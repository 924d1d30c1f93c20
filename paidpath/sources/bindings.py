"""Role tables derived from the shared test tables.

The models read a SaaS warehouse (payments, plans, events, CRM accounts ...). The test
tables are a TPC-H-like star schema plus an event log, so every role the models need is
*derived* here from those tables with Spark expressions. Each role grows with the data it
is derived from; none is a fixed literal except the small mapping tables, whose size is
bounded by construction (in-memory VALUES relations with exact sizes); dimension tables
read from storage are broadcast only behind a size bound (``broadcast_if_bounded``).

The same derivations exist as SQL in :mod:`paidpath.oracle` so DuckDB can check results.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paidpath.sources.tables import Catalog
from paidpath.operators.sizing import broadcast_if_bounded

# Run dates. Orders run 1995-01-01 .. 2001-08-01, events 2024-01-01 .. 2024-01-30.
AS_OF_ORDERS = dt.date(2001, 8, 1)
AS_OF_EVENTS = dt.date(2024, 2, 1)
# Earliest month of the waterfall shell for the orders binding (the model's default is 2010-08).
ORDERS_SHELL_START = dt.date(1994, 1, 1)
# "signed up after" cut-off for the orders binding (the model's default is 2018-01-01).
ORDERS_SIGNUP_CUTOFF = dt.date(1998, 1, 1)
# Members whose first exposure makes a day busy, in the experiment read-out of this binding (the
# model's default, 30, leaves one day of one experiment).
BUSY_DAY = 5
# Company e-mail domain dropped by the e-mail domain rule in this binding.
OWN_EMAIL_DOMAIN = "building.com"

# ---- fixed values of the binding (mapping tables; bounded, broadcast) ----------------
# associated_plan, plan_name, billing_interval, include_in_mrr
PLAN_ROWS = [
    ("1-URGENT", "Enterprise", "annual", True),
    ("2-HIGH", "Business", "annual", True),
    ("3-MEDIUM", "Team", "monthly", True),
    ("4-NOT SPECIFIED", "Professional", "monthly", True),
    ("5-LOW", "Free", "monthly", False),
]
# service_no, exclude_from_mrr
SERVICE_ROWS = [("F", False), ("O", False), ("P", True)]
# event, activity_category, is_active_event
MEANINGFUL_ROWS = [
    ("view", "composer", True),
    ("click", "planner", True),
    ("purchase", "analytics", True),
    ("signup", "inbox_1", True),
    ("error", "inbox_2", True),
]
# event, activity_category (discovery events keep raw categories)
DISCOVERY_ROWS = [
    ("view", "composer"),
    ("click", "planner"),
    ("purchase", "analytics"),
    ("error", "inbox_1"),
]
# legacy_plan_code, billing_product_code, include_in_ecomm, include_in_enterprise, is_paid
PRODUCT_ROWS = [
    ("BUILDING", "PRO_PLAN", "TRUE", "FALSE", "TRUE"),
    ("AUTOMOBILE", "TEAM_PLAN", "TRUE", "FALSE", "True"),
    ("MACHINERY", "BUSINESS_PLAN", "TRUE", "TRUE", "True"),
    ("FURNITURE", "ENTERPRISE_PLAN", "FALSE", "TRUE", "TRUE"),
    ("HOUSEHOLD", "FREE_PLAN", "TRUE", "FALSE", "FALSE"),
]
# legacy_sf_industry, current_sf_industry
INDUSTRY_ROWS = [("F", "Finance"), ("O", "Operations"), ("P", "Public Sector")]
# legacy_sf_emps, current_sf_emps
SIZE_ROWS = [("small", "1-50"), ("medium", "51-1000"), ("large", "1000+")]


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    return "'" + str(v).replace("'", "''") + "'"


def _literal(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A mapping table from the fixed values above, as an in-memory VALUES relation (exact
    size statistics). Bounded by construction, so it carries a broadcast hint."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    names = ", ".join(n for n, _ in fields)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS v({names})")
    return F.broadcast(df.select(*[F.col(n).cast(t).alias(n) for n, t in fields]))


def plans(spark):
    return _literal(spark, PLAN_ROWS,
                    "associated_plan string, plan_name string, billing_interval string, include_in_mrr boolean")


def service_numbers(spark):
    return _literal(spark, SERVICE_ROWS, "service_no string, exclude_from_mrr boolean")


def meaningful_activity(spark):
    return _literal(spark, MEANINGFUL_ROWS, "event string, activity_category string, is_active_event boolean")


def discovery_events(spark):
    return _literal(spark, DISCOVERY_ROWS, "event string, activity_category string")


def products(spark):
    return _literal(spark, PRODUCT_ROWS, "legacy_plan_code string, billing_product_code string, "
                    "include_in_ecomm string, include_in_enterprise string, is_paid string")


def industry_map(spark):
    return _literal(spark, INDUSTRY_ROWS, "legacy_sf_industry string, current_sf_industry string")


def size_map(spark):
    return _literal(spark, SIZE_ROWS, "legacy_sf_emps string, current_sf_emps string")


def money(c) -> Column:
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


# ---- revenue side (orders) ------------------------------------------------------------

def invoice_payments(t: Catalog) -> DataFrame:
    o = t("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                     "o_orderpriority"])
    # Settled orders of the free plan are refunds: negative amounts.
    refund = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F")
    amount = F.when(refund, -money("o_totalprice")).otherwise(money("o_totalprice"))
    return o.select(
        F.col("o_custkey").alias("member_id"),
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderdate").alias("payment_date"),
        amount.alias("amount"),
        amount.alias("amount_in_usd"),
        F.col("o_orderpriority").alias("associated_plan"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("Prorated "), F.col("o_orderpriority")))
         .otherwise(F.col("o_orderpriority")).alias("plan_name"),
        F.col("o_orderstatus").alias("service_no"),
    )


def _customer_geo(t: Catalog) -> DataFrame:
    c = t("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = broadcast_if_bounded(t("nation", ["n_nationkey", "n_name", "n_regionkey"]))
    r = broadcast_if_bounded(t("region", ["r_regionkey", "r_name"]))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
             .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))


def customers(t: Catalog) -> DataFrame:
    """Customer attributes (segments) keyed by member_id."""
    g = _customer_geo(t)
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    return g.select(
        F.col("c_custkey").alias("member_id"),
        F.col("r_name").alias("market"),
        F.col("n_name").alias("country"),
        F.when(F.col("n_regionkey") == 0, "en").when(F.col("n_regionkey") == 1, "es")
         .when(F.col("n_regionkey") == 2, "fr").when(F.col("n_regionkey") == 3, "de")
         .otherwise("pt").alias("language"),
        F.when(seg == "BUILDING", "Tier 1").when(seg == "AUTOMOBILE", "Tier 2 Prime")
         .when(seg == "MACHINERY", "tier3").when(seg == "FURNITURE", "T4").alias("icp_tiers"),
        (seg == "BUILDING").alias("is_tier_1_icp_member"),
        F.when(bal >= 0, "web").otherwise("mobile_web").alias("signup_source"),
        F.when(bal >= 5000, "pua").otherwise("organic").alias("acquisition_source"),
        seg.alias("trial_plan"),
        F.when(seg.isin("BUILDING", "MACHINERY", "AUTOMOBILE"), "immediate").otherwise("upgrade").alias("trial_type"),
        F.when(bal < 2000, "other").otherwise("30_days").alias("trial_length"),
        F.lower(F.concat(F.regexp_replace("c_name", "#", "."), F.lit("@"), seg, F.lit(".com"))).alias("email"),
        F.when(seg == "HOUSEHOLD", "personal").otherwise("business").alias("email_type"),
        F.when(bal < 0, None).when(bal < 5000, "small").when(bal < 8000, "medium").otherwise("large").alias("no_of_employees"),
        F.when(bal >= 8000, "10M+").otherwise("<10M").alias("company_revenue"),
        seg.alias("industry"),
    )


def first_signups(t: Catalog) -> DataFrame:
    """First ``signup`` event per user (partial aggregation before the shuffle)."""
    e = t("events", ["user_id", "ts", "event_type"]).filter(F.col("event_type") == "signup")
    return e.groupBy(F.col("user_id").alias("member_id")).agg(F.min("ts").alias("signup_ts"))


def ecomm_customers(t: Catalog) -> DataFrame:
    """Customers with trial dates, anchored on the first signup event."""
    c = customers(t)
    s = first_signups(t)
    x = c.join(s, "member_id", "left")
    days = F.when(F.col("trial_length") == "30_days", 30).otherwise(14)
    return x.select(
        "member_id",
        F.col("signup_ts").alias("signup_date"),
        F.when(F.col("acquisition_source") == "pua", "buynow").otherwise("trial").alias("trial_or_buynow_signup"),
        "icp_tiers", "market", "country", "language", "signup_source", "acquisition_source", "trial_plan",
        F.lit("monthly").alias("trial_billing_interval"),
        "trial_length", "trial_type", "email_type",
        F.when(F.col("industry") == "HOUSEHOLD", F.lit(dt.date(1997, 1, 1))).cast("date").alias("non_profit_effective_date"),
        F.col("signup_ts").cast("date").alias("first_payment_date"),
        F.col("signup_ts").alias("trial_start_date"),
        F.timestamp_add("DAY", days, F.col("signup_ts")).alias("trial_end_date"),
        F.col("signup_ts").cast("date").alias("last_touch_signup_date"),
        F.lit(0).alias("day_diff_first_payment_exp_conversion_date"),
    )


def member_months(t: Catalog) -> DataFrame:
    """Orders in one aggregate by member and month: the month's largest order (``top``) and
    the total that its MRR is banded from."""
    o = t("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    paid = money("o_totalprice")
    refund = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F")
    return o.groupBy(F.col("o_custkey").alias("member_id"), F.trunc("o_orderdate", "month").alias("date")).agg(
        F.max(F.struct(paid.alias("amount"), "o_orderdate", "o_orderkey", F.col("o_orderpriority").alias("plan"),
                       F.col("o_orderstatus").alias("billing_interval"))).alias("top"),
        F.sum(F.when(refund, -paid).otherwise(paid)).alias("total"))


def _banded(total) -> Column:
    return (F.floor(F.col(total) / 100000) * 100).cast("decimal(18,2)").alias("mrr")


def mrr_by_member(t: Catalog, months: DataFrame | None = None) -> DataFrame:
    """Banded monthly revenue per member-month: floor(sum / 100000) * 100. ``months``:
    member_months, where a query has them already."""
    if months is None:
        months = invoice_payments(t).groupBy("member_id", F.trunc("payment_date", "month").alias("date")).agg(F.sum("amount").alias("total"))
    return months.select("member_id", "date", _banded("total"))


def paid_base_by_member(t: Catalog, months: DataFrame | None = None) -> DataFrame:
    """One row per member-month: plan and interval of the month's largest order."""
    return (member_months(t) if months is None else months).select("member_id", "date", "top.plan", "top.billing_interval")


def paid_base_by_plan(t: Catalog) -> DataFrame:
    """Every plan and interval that a member paid for in a month: several rows a member-month."""
    o = t("orders", ["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    return o.select(F.col("o_custkey").alias("member_id"), F.trunc("o_orderdate", "quarter").alias("date"),
                    F.col("o_orderpriority").alias("plan"), F.col("o_orderstatus").alias("billing_interval")).distinct()


def shipment_activity(t: Catalog, days: DataFrame | None = None) -> DataFrame:
    """Member-months with a shipped line item: the activity feed of the orders binding.
    ``days``: shipment_days, where a query has them already."""
    if days is None:
        li = t("lineitem", ["l_orderkey", "l_shipdate"])
        o = t("orders", ["o_orderkey", "o_custkey"])
        days = li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("o_custkey").alias("member_id"), F.to_date("l_shipdate").alias("activity_date"))
    return (days.select("member_id", F.trunc("activity_date", "month").alias("month_of_activity"))
                .distinct()
                .withColumn("is_active", F.lit(True)))


def member_tiers(t: Catalog) -> DataFrame:
    return customers(t).select("member_id", "is_tier_1_icp_member", "country", "industry",
                               "no_of_employees", "company_revenue")


def member_emails(t: Catalog) -> DataFrame:
    return customers(t).select("member_id", "email", "email_type")


def members(t: Catalog) -> DataFrame:
    return customers(t).select("member_id", "market", "language")


def activated_members(t: Catalog) -> DataFrame:
    e = t("events", ["user_id", "event_type"])
    return e.groupBy(F.col("user_id").alias("member_id")).agg(
        F.when(F.count_if(F.col("event_type") == "purchase") > 0, 1).otherwise(0).alias("activated"))


# ---- event side -----------------------------------------------------------------------

def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def product_events(t: Catalog) -> DataFrame:
    """The product event log with the attributes the models read."""
    e = t("events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    k, v = _k(), F.col("value")
    return e.select(
        "event_id",
        F.col("user_id").alias("actor_id"),
        F.col("event_type").alias("event"),
        F.col("ts").alias("timestamp"),
        F.when(k >= 40, F.lit(1000) + F.floor(F.col("user_id") / 10)).cast("bigint").alias("organization_id"),
        F.when(k < 20, "facebook_page").when(k < 40, "Instagram_Business").when(k < 55, "linkedin_company")
         .when(k < 70, "twitter").when(k < 80, "OwnApp_internal").alias("social_network_type"),
        (F.col("user_id") * 100 + F.floor(k / 10)).cast("bigint").alias("social_network_id"),
        F.when(v < 5, "EMPLOYEE").when(v > 300, None).when(v < 150, "PRO_PLAN").otherwise("TEAM_PLAN")
         .alias("member_effective_product_code"),
        F.when(v > 300, None).otherwise("pro").alias("member_max_plan"),
        F.col("props").alias("data"),
    )


def long_product_events(t: Catalog) -> DataFrame:
    """The product event log dealt to six months: event ``i`` moves by ``i mod 6`` times 30 days."""
    e = product_events(t)
    later = ((F.col("event_id") % 6) * 30).cast("int")
    return e.withColumn("timestamp", F.col("timestamp") + F.make_interval(days=later))


def organizations(t: Catalog) -> DataFrame:
    """Organization -> paying member: the lowest member id seen in the organization."""
    e = product_events(t).filter(F.col("organization_id").isNotNull())
    return e.groupBy("organization_id").agg(F.min("actor_id").alias("payment_member_id"))


# ---- CRM side (accounts <-> organizations) ------------------------------------------------

def crm_accounts(t: Catalog) -> DataFrame:
    """Account rows (one per order): an urgent order names the account's primary org."""
    o = t("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    g = _customer_geo(t).select("c_custkey", "n_name")
    j = o.join(g, o.o_custkey == g.c_custkey, "left")
    pr, price = F.col("o_orderpriority"), F.col("o_totalprice")
    return j.select(
        F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("id"),
        F.when(pr == "1-URGENT", F.col("o_orderkey")).alias("organisation_id__c"),
        F.when(pr == "1-URGENT", "Tier 1").when(pr == "2-HIGH", "Tier 2 Prime").when(pr == "3-MEDIUM", "tier3")
         .when(pr == "4-NOT SPECIFIED", "T4 x").alias("icp_tier__c"),
        F.col("o_orderstatus").alias("industry"),
        F.when(price < 100000, "small").when(price < 250000, "medium").otherwise("large").alias("no_of_employees__c"),
        F.col("n_name").alias("billingcountry"),
    )


def crm_organizations(t: Catalog) -> DataFrame:
    """Organization -> account links: each order's customer account, plus the supplier
    account of every returned line (which makes some organizations many-account)."""
    o = t("orders", ["o_orderkey", "o_custkey"]).select(
        F.col("o_orderkey").alias("organization_id__c"),
        F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("account__c"))
    li = (t("lineitem", ["l_orderkey", "l_suppkey", "l_returnflag"]).filter(F.col("l_returnflag") == "R")
          .select(F.col("l_orderkey").alias("organization_id__c"),
                  F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("account__c")))
    return o.unionByName(li)


# ---- usage and revenue for ARR attribution ------------------------------------------------

USAGE_PRODUCTS = ["amplify", "analytics", "apps", "assignments", "authentication", "composer", "inbox", "planner",
                  "streams", "social_ads", "content", "helpdesk"]

def monthly_usage(t: Catalog) -> DataFrame:
    """Active days per product per (organization, member, month): an event is use of the
    product that ``k mod 12`` of its props numbers."""
    e = product_events(t).select(
        "organization_id", F.col("actor_id").alias("member_id"),
        F.trunc("timestamp", "month").alias("date_month"), F.to_date("timestamp").alias("day"),
        (F.get_json_object("data", "$.k").cast("int") % 12).alias("_product"))
    g = e.groupBy("organization_id", "member_id", "date_month", "_product").agg(F.count_distinct("day").alias("_days"))
    g = g.groupBy("organization_id", "member_id", "date_month").agg(
        *[F.coalesce(F.max(F.when(F.col("_product") == i, F.col("_days"))), F.lit(0)).cast("int").alias(f"{p}_days")
          for i, p in enumerate(USAGE_PRODUCTS)])
    seg = F.when(F.col("organization_id") >= 1010, "enterprise").when(F.col("organization_id").isNotNull(), "smb")
    return g.select("organization_id", "member_id", "date_month", seg.alias("segments"), *[f"{p}_days" for p in USAGE_PRODUCTS])


def enterprise_arr(t: Catalog) -> DataFrame:
    """Org ARR rows from purchase events (several rows per org and month, as in the source)."""
    e = product_events(t).filter((F.col("event") == "purchase") & F.col("organization_id").isNotNull())
    k = F.get_json_object("data", "$.k").cast("int")
    return e.select("organization_id", F.to_date("timestamp").alias("date"),
                    (k * 12).cast("decimal(18,2)").alias("arr"))


def member_revenue(t: Catalog) -> DataFrame:
    """Member MRR rows from purchase events; refunded first payments flagged (null unknown)."""
    e = t("events", ["user_id", "ts", "event_type", "value"]).filter(F.col("event_type") == "purchase")
    v = F.col("value")
    return e.select(F.col("user_id").alias("member_id"), F.to_date("ts").alias("payment_month"),
                    money("value").alias("mrr"),
                    F.when(v < 10, True).when(v > 300, None).otherwise(False).alias("refunded_for_first_payment"))


# ---- subscriptions -----------------------------------------------------------------------

def invoice_items(t: Catalog) -> DataFrame:
    """Versioned charges: an order's lines are versions of one charge."""
    li = t("lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
                        "l_shipdate"])
    o = t("orders", ["o_orderkey", "o_custkey"])
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    ship = F.to_date("l_shipdate")
    return j.select(
        F.col("o_custkey").alias("member_id"),
        F.concat(F.lit("C"), F.col("l_orderkey").cast("string")).alias("original_rate_plan_charge_id"),
        F.col("l_linenumber").alias("version"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        ship.alias("service_end_date"),
        F.when(F.col("l_returnflag") == "R", F.date_sub(ship, 10)).alias("subscription_cancel_date"),
        F.col("l_linestatus").alias("billing_system"),
    )


# ---- activation inputs ------------------------------------------------------------------

def buy_now_events(t: Catalog) -> DataFrame:
    e = t("events", ["user_id", "ts", "event_type", "value"]).filter(F.col("event_type") == "purchase")
    return e.select(F.col("user_id").alias("member_id"), F.col("ts").alias("timestamp"),
                    (F.col("value") > 100).alias("is_buy_now"))


def authentication_events(t: Catalog) -> DataFrame:
    """Authentications: every second event is moved to within some hours of its member's first
    signup, as new members connect their networks, so that the setup window has data."""
    e = product_events(t).join(first_signups(t).withColumnRenamed("member_id", "actor_id"), "actor_id", "left")
    minutes = F.make_interval(mins=(F.col("event_id") % 400).cast("int"))
    moved = F.when((F.col("event_id") % 2 == 0) & F.col("signup_ts").isNotNull(), F.col("signup_ts") + minutes)
    return e.select(F.col("actor_id").alias("member_id"), F.coalesce(moved, F.col("timestamp")).alias("timestamp"), "social_network_type",
                    F.when(F.col("event") != "error", "success").otherwise("failure").alias("authentication_result"),
                    F.when(F.col("event").isin("signup", "click", "view"), "authentication").otherwise("reauth")
                     .alias("authentication_type"))


def trial_to_paying(t: Catalog) -> DataFrame:
    """Conversion per member with a purchase: converted when any purchase is above 200."""
    e = t("events", ["user_id", "event_type", "value"]).filter(F.col("event_type") == "purchase")
    return e.groupBy(F.col("user_id").alias("member_id")).agg(
        F.max(F.col("value") > 200).alias("is_converted"),
        F.max(F.when(F.col("value") > 200, 1).otherwise(0)).alias("converted"))


# ---- experiment inputs --------------------------------------------------------------------
# Fixed values of the binding: a detailed product-event vocabulary. Each generic event
# type maps to ten names, picked by ``k mod 10`` of the event's props.
EVENT_NAME_VOCABULARY = {
    "signup": ["experiment_started", "finish_connecting_sn", "user_clicks_continue_button",
               "account_setup_user_click_skip_button", "user_clicks_add_more_later", "add_social_network_twitter",
               "add_social_network_facebook", "instagram_add_start", "instagrambusiness_add_start",
               "facebook_steal_success"],
    "view": ["web.dashboard.load", "content_planner_opened", "analytics_app_loaded", "open_new_compose",
             "compose_new_message_from_source_page", "new_post_clicked", "open_legacy_compose", "new_pin_clicked",
             "stream_user_clicked_schedule_cta", "user_clicks_new_post"],
    "click": ["dashboard_planner_clicked", "dashboard_new_analytics_clicked", "dashboard_streams_clicked",
              "dashboard_publisher_clicked", "user_clicks_add_sn_button_instagram", "instagram_reauth_start",
              "add_team_member", "compose_new_message", "new_story_clicked", "open_new_compose_pinterest"],
    "purchase": ["message_published", "add_team_member", "open_new_compose_from_template",
                 "compose_new_message_for_network", "open_new_compose_instagramstory", "instagram_steal_start",
                 "instagrambusiness_steal_start", "instagrambusiness_reauth_start", "web.dashboard.load",
                 "content_planner_opened"],
    "error": ["message_send_failed", "drop_stream", "add_stream", "drop_social_network_x", "twitter_steal_success",
              "web.dashboard.load", "dashboard_streams_clicked", "analytics_app_loaded", "dashboard_planner_clicked",
              "new_post_clicked"],
}
# Experiment names exposed through the cohort table and through the event stream,
# picked by ``(k div 10) mod 6``.
COHORT_EXPERIMENTS = ["EX_HOME", "GRW_SS_ONB", "GRW_FREE_TRIAL", "GRW_SS_ACT_1", "sitewide_banner", "ca_pricing"]
STREAM_EXPERIMENTS = ["ex_home", "ACT_SETUP", "ENG_FEED", "grw_ss_act_1", "PNC_CHECKOUT", "other_test"]
# Detailed events that count as meaningful activity.
MEANINGFUL_NAMES = ["message_published", "web.dashboard.load", "content_planner_opened", "analytics_app_loaded",
                    "open_new_compose", "dashboard_streams_clicked"]


def _pick(names: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), idx + 1)


def experiment_event_log(t: Catalog) -> DataFrame:
    """Product events with detailed names and a JSON payload (experiment id, variation,
    source page)."""
    e = product_events(t)
    k = F.get_json_object("data", "$.k").cast("int")
    name = F.lit(None).cast("string")
    for et, names in EVENT_NAME_VOCABULARY.items():
        name = F.when(F.col("event") == et, _pick(names, F.pmod(k, F.lit(10)))).otherwise(name)
    exp_idx = F.pmod(F.floor(k / 10), F.lit(6)).cast("int")
    payload = F.to_json(F.struct(F.struct(
        _pick(STREAM_EXPERIMENTS, exp_idx).alias("id"),
        F.concat(F.lit("v"), F.pmod(k, F.lit(2)).cast("string")).alias("variation"),
        F.when(k < 50, "planner").otherwise("dashboard").alias("sourcePage")).alias("additional_data")))
    # a third of the events is dealt to four months, so that month-1..3 retention has data
    i = F.col("event_id")
    later = F.when(i % 3 == 0, F.expr("(event_id div 3) % 4") * 30).otherwise(0).cast("int")
    return e.select("event_id", "actor_id", name.alias("event"),
                    (F.col("timestamp") + F.make_interval(days=later)).alias("timestamp"), "social_network_id",
                    "member_effective_product_code", "member_max_plan", payload.alias("data"),
                    F.col("event").alias("event_type"), k.alias("k"))


def experiment_cohorts(t: Catalog) -> DataFrame:
    """Cohort-table exposures: every view and click event exposes its member."""
    e = t("events", ["user_id", "ts", "event_type", "props"]).filter(F.col("event_type").isin("view", "click"))
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(F.col("user_id").alias("member_id"),
                    _pick(COHORT_EXPERIMENTS, F.pmod(F.floor(k / 10), F.lit(6)).cast("int")).alias("experiment"),
                    F.concat(F.lit("v"), F.pmod(k, F.lit(2)).cast("string")).alias("variant"),
                    F.to_date("ts").alias("date"))


def free_to_trial(t: Catalog) -> DataFrame:
    c = customers(t).filter(F.col("trial_type") == "upgrade")
    s = first_signups(t)
    return c.join(s, "member_id").select("member_id", "signup_source", "acquisition_source",
                                         F.col("signup_ts").alias("free_signup_date"))


def social_networks(t: Catalog) -> DataFrame:
    """Networks and their owners; every fourth member owns none."""
    e = product_events(t).filter(F.col("social_network_type").isNotNull() & (F.col("actor_id") % 4 != 3))
    return e.select(F.col("actor_id").alias("owner_member_id"), "social_network_id").distinct()


def event_payments(t: Catalog) -> DataFrame:
    """Payments in the event log's time: purchases, every fifth a refund, every fourth prorated."""
    e = t("events", ["event_id", "user_id", "ts", "event_type", "value"]).filter(F.col("event_type") == "purchase")
    amount = F.when(F.col("event_id") % 5 == 0, -F.col("value")).otherwise(F.col("value"))
    return e.select(F.col("user_id").alias("member_id"), F.col("event_id").alias("payment_id"), F.to_date("ts").alias("payment_date"),
                    money(amount).alias("amount_in_usd"),
                    F.when(F.col("event_id") % 4 == 0, "Prorated pro").otherwise("pro").alias("plan_name"))


def first_payments(t: Catalog, payments: DataFrame | None = None) -> DataFrame:
    p = (invoice_payments(t) if payments is None else payments).filter(F.col("amount_in_usd") > 0)
    return p.groupBy("member_id").agg(F.min("payment_date").alias("first_overall_payment"))


def engagement_days(t: Catalog) -> DataFrame:
    e = experiment_event_log(t).filter(F.col("event").isin(*MEANINGFUL_NAMES))
    return e.select(F.col("actor_id").alias("member_id"), F.to_date("timestamp").alias("activity_date_utc")).distinct()


def user_facts(t: Catalog) -> DataFrame:
    """Counts of events by kind and of networks per member."""
    e = product_events(t)
    c = lambda cond: F.count_if(cond)
    return e.groupBy(F.col("actor_id").alias("member_id")).agg(
        c(F.col("event") == "purchase").alias("n_purchase"), c(F.col("event") == "view").alias("n_view"),
        c(F.col("event") == "click").alias("n_click"), c(F.col("event") == "error").alias("n_error"),
        c(F.col("event") == "signup").alias("n_signup"),
        F.count_distinct("social_network_type").alias("n_networks"),
        c(F.col("social_network_type") == "facebook_page").alias("n_facebook"),
        c(F.col("social_network_type") == "Instagram_Business").alias("n_instagram"),
        c(F.col("social_network_type") == "twitter").alias("n_twitter"))


def onboarding_facts(users: DataFrame, kind: str, paid: bool) -> DataFrame:
    """Setup / habit / aha fact tables from ``user_facts``; 'paid' tables hold members with an
    odd number of purchases, 'free' tables the others. Remainders of counts, so that the
    thresholds cut at every data size."""
    def left(c: str, n: int) -> Column:
        return (F.col(c) % n).cast("int")

    f = users.filter(F.col("n_purchase") % 2 == (1 if paid else 0))
    if kind == "setup":
        return f.select("member_id", (left("n_click", 3) == 0).alias("setup_moment"),
                        (left("n_view", 2) == 0).alias("opened_composer_24h"),
                        left("n_view", 5).alias("count_social_profiles_added_24h"),
                        left("n_facebook", 2).alias("count_facebook_pages_added_24h"),
                        (left("n_instagram", 3) - 1).alias("count_igb_direct_publish_added_24h"),
                        left("n_instagram", 3).alias("count_any_instagram_added_24h"),
                        left("n_twitter", 2).alias("count_twitter_added_24h"))
    if kind == "habit":
        return f.select("member_id", (left("n_view", 3) == 0).alias("habit_moment"),
                        left("n_view", 10).alias("count_messages_published_28d"),
                        (F.col("n_click") * 3).cast("int").alias("count_streams_scrolls_28d"),
                        left("n_error", 10).alias("count_edits_planner_28d"))
    return f.select("member_id", (left("n_signup", 2) == 0).alias("aha_moment"),
                    left("n_signup", 2).alias("count_messages_published_5d"),
                    left("n_click", 3).alias("count_streams_scrolls_5d"),
                    left("n_error", 2).alias("count_edits_planner_5d"))


# ---- paying members over time (orders) ------------------------------------------------------

def daily_paying_customers(t: Catalog) -> DataFrame:
    """Member x paid day with plan, interval and customer segments."""
    o = t("orders", ["o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"]).select(
        F.col("o_custkey").alias("member_id"), F.to_date("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("plan"), F.col("o_orderstatus").alias("billing_interval")).distinct()
    c = customers(t).select("member_id", "market", "country", "trial_type", "trial_length", "acquisition_source",
                            "signup_source", "is_tier_1_icp_member", "icp_tiers")
    return o.join(c, "member_id")


def paid_months(t: Catalog) -> DataFrame:
    """Member x paid month with plan, interval, MRR and billing currency."""
    cur = customers(t).select("member_id", F.when(F.col("market") == "EUROPE", "EUR").otherwise("USD").alias("currency"))
    months = member_months(t).select("member_id", "date", "top.plan", "top.billing_interval", _banded("total"))
    return months.join(cur, "member_id", "left")


def shipment_days(t: Catalog) -> DataFrame:
    li = t("lineitem", ["l_orderkey", "l_shipdate"])
    o = t("orders", ["o_orderkey", "o_custkey"])
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select(F.col("o_custkey").alias("member_id"), F.to_date("l_shipdate").alias("activity_date")).distinct())


def shipment_weeks(t: Catalog, days: DataFrame | None = None) -> DataFrame:
    return ((shipment_days(t) if days is None else days).select("member_id", F.date_trunc("week", "activity_date").cast("date")
                                    .alias("week_of_activity")).distinct()
            .withColumn("is_active", F.lit(True)))


# ---- seats (events) ---------------------------------------------------------------------------

def event_paid_months(t: Catalog) -> DataFrame:
    """Members paying in a month: purchase events; plan = highest product code seen."""
    e = product_events(t).filter(F.col("event") == "purchase")
    g = e.groupBy(F.col("actor_id").alias("member_id"), F.trunc("timestamp", "month").alias("date")).agg(
        F.max("member_effective_product_code").alias("plan"))
    return g.select("member_id", "date", "plan", F.lit("monthly").alias("billing_interval"),
                    F.lit("USD").alias("currency"))


def org_memberships(t: Catalog) -> DataFrame:
    e = product_events(t).filter(F.col("organization_id").isNotNull())
    return e.select("organization_id", F.col("actor_id").alias("member_id"),
                    F.trunc("timestamp", "month").alias("month")).distinct()


def event_monthly_activity(t: Catalog) -> DataFrame:
    e = product_events(t).filter(F.col("event").isin("view", "click"))
    return e.select(F.col("actor_id").alias("member_id"),
                    F.trunc("timestamp", "month").alias("month_of_activity")).distinct()

"""ARR attribution by member and product.

Org frequencies and both revenue inputs are aggregated *before* the joins (map-side
partial aggregation), so each usage row meets at most one row per (org, month) and one
per (member, month). All money is split in exact cents (see ``allocate``).
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidpath.operators.revenue import MONEY, allocate
from paidpath.operators.rolling import monthly_revenue

# The twelve portfolios; the member total leaves out the last one.
PRODUCTS = ["amplify", "analytics", "apps", "assignments", "authentication", "composer", "inbox", "planner",
            "streams", "social_ads", "content", "helpdesk"]
MEMBER_TOTAL_PRODUCTS = PRODUCTS[:-1]
OUTPUT_ORDER = ["amplify", "analytics", "apps", "assignments", "authentication", "composer", "inbox", "planner",
                "streams", "content", "social_ads", "helpdesk"]


def _days_sum(cols):
    return reduce(add, [F.col(f"{p}_days") for p in cols])


def arr_attribution(monthly_usage: DataFrame, enterprise_arr: DataFrame, member_revenue: DataFrame) -> DataFrame:
    """Month x member x org: ARR attributed to the member and to each product.

    Non-enterprise rows take the member's own MRR x 12; enterprise rows take the org's
    ARR x (member days / org days). Product shares split the member's ARR by product days
    (0.00 when the member has no days)."""
    org_freq = monthly_usage.groupBy("organization_id", "date_month").agg(
        F.sum(_days_sum(PRODUCTS)).alias("total_org_frequency"))
    ent = monthly_revenue(enterprise_arr, "organization_id", "date", "arr", out="arr")
    ss = monthly_revenue(member_revenue, "member_id", "payment_month", "mrr", out="mrr",
                         exclude="refunded_for_first_payment")
    m = (monthly_usage.join(ent, ["organization_id", "date_month"], "left")
                      .join(ss, ["member_id", "date_month"], "left")
                      .join(org_freq, ["organization_id", "date_month"], "left")
                      .withColumn("total_portfolio_frequency", _days_sum(MEMBER_TOTAL_PRODUCTS)))
    attr = (F.when(F.col("segments") != "enterprise", (F.col("mrr") * 12).cast(MONEY))
             .when(F.col("total_org_frequency") > 0,
                   allocate("arr", "total_portfolio_frequency", "total_org_frequency"))
             .otherwise(F.lit(0).cast(MONEY)))
    m = m.withColumn("arr_attribution", attr)
    shares = [allocate("arr_attribution", f"{p}_days", "total_portfolio_frequency").alias(f"{p}_arr_attribution")
              for p in OUTPUT_ORDER]
    return m.select("date_month", "member_id", "organization_id", "arr_attribution", *shares).distinct()


__all__ = ["arr_attribution", "PRODUCTS", "MEMBER_TOTAL_PRODUCTS", "OUTPUT_ORDER"]

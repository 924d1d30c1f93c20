"""Current subscriptions (M10): latest version of each charge with renewal date,
non-profit flag and customer attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidpath.operators.pickers import latest_per_key
from paidpath.operators.shape import select_except

CUSTOMER_COLUMNS = ["icp_tiers", "market", "country", "language", "signup_source", "acquisition_source",
                    "trial_or_buynow_signup", "trial_plan", "trial_billing_interval", "trial_length", "trial_type",
                    "email_type"]


def current_subscriptions(invoice_items: DataFrame, customers: DataFrame, charge: str = "original_rate_plan_charge_id",
                          version: str = "version") -> DataFrame:
    """M10. The latest version is picked *before* the customer join (customers are one row
    per member, so the result is the same and the join moves less data). Ties on the
    version are broken by every other column (W01). ``least`` skips a null cancel date
    (T8)."""
    latest = latest_per_key(invoice_items, [charge], [version])
    c = customers.select("member_id", "non_profit_effective_date", *CUSTOMER_COLUMNS)
    j = latest.join(c, "member_id", "left")
    items = select_except(latest, ["billing_system"])
    return j.select(
        *items.columns,
        F.date_add(F.least("service_end_date", "subscription_cancel_date"), 1).alias("next_renewal_date"),
        F.when(F.col("service_end_date") >= F.col("non_profit_effective_date").cast("date"), True)
         .otherwise(False).alias("is_non_profit"),
        *CUSTOMER_COLUMNS, "billing_system")

"""Sources: the same bindings and models over session-catalog tables (spark.table)."""

import os

from datasets import SMALL


def test_models_run_over_catalog_tables(spark):
    from paidpath.plans.waterfall import member_waterfall, revenue_waterfall
    from paidpath.registry import QUERIES
    from paidpath.sources import bindings as B
    from paidpath.sources.tables import TABLES, TableCatalog
    for name in TABLES:
        spark.read.parquet(os.path.join(SMALL, f"{name}.parquet")).createOrReplaceTempView(f"src_{name}")
    t = TableCatalog(spark, names={n: f"src_{n}" for n in TABLES})
    cust = B.customers(t)
    wm = member_waterfall(B.paid_base_by_member(t), B.mrr_by_member(t), B.shipment_activity(t), cust,
                          B.activated_members(t), cust, cust, as_of=B.AS_OF_ORDERS,
                          shell_start=B.ORDERS_SHELL_START, signup_cutoff=B.ORDERS_SIGNUP_CUTOFF,
                          own_domain=B.OWN_EMAIL_DOMAIN)
    via_tables = revenue_waterfall(wm, B.AS_OF_ORDERS)
    via_files = QUERIES["m04_revenue_waterfall"](spark, SMALL)
    cols = sorted(via_files.columns)
    assert via_tables.count() == via_files.count() > 0
    assert via_tables.select(cols).exceptAll(via_files.select(cols)).count() == 0

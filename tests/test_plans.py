"""Plan checks: no nested-loop or cartesian joins anywhere, one Window
for the nine W20 frames, pruned scans with pushed filters."""

import pytest

from datasets import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def queries():
    import __spark_entry__ as E
    return E.queries()


def test_no_nested_loop_or_cartesian_join(spark, queries):
    for name, fn in queries.items():
        plan = _plan(fn(spark, SMALL))
        assert "NestedLoopJoin" not in plan, name
        assert "CartesianProduct" not in plan, name


def test_nine_frames_share_one_window(spark, queries):
    plan = _plan(queries["w20_calendar_rolling_sum"](spark, SMALL))
    assert plan.count("Window [") + plan.count("Window(") <= 1 or plan.count(" Window ") <= 1
    df = queries["m08_rolling_paid_base"](spark, SMALL)
    text = df._jdf.queryExecution().sparkPlan().toString()
    windows = [ln for ln in text.splitlines() if ln.strip().lstrip("+- :").startswith("Window ")]
    assert len(windows) == 1, windows


def test_scans_are_pruned_and_filters_pushed(spark, queries):
    from paidpath.plans.activity import active_events, event_summary
    from paidpath.sources import bindings as B
    from paidpath.sources.tables import Catalog
    t = Catalog(spark, SMALL)
    summary = event_summary(active_events(B.product_events(t), B.meaningful_activity(spark)))
    plan = _plan(summary)
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert len(scans) == 1                                     # the event table is read once
    s = scans[0]
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in s, s
    assert s.split("ReadSchema: struct<")[1].count(":") < 6, s    # not all six columns
    m08 = _plan(queries["m08_rolling_paid_base"](spark, SMALL))
    orders = [ln for ln in m08.splitlines() if "FileScan parquet" in ln and "orders.parquet" in ln]
    assert orders and all("o_orderkey" not in ln.split("ReadSchema")[1] for ln in orders)


def test_waterfall_window_is_not_reshuffled(spark, queries):
    """The member-month window and the 20-key aggregate share the member partitioning."""
    text = queries["m05_member_waterfall"](spark, SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoopJoin" not in text


def _expand_widths(plan: str) -> list[int]:
    """Number of projections of every Expand node: ``Expand [[p1], [p2], ...], [output]``."""
    widths = []
    for ln in plan.splitlines():
        i = ln.find("Expand [")
        if i < 0:
            continue
        depth, n = 0, 0
        for ch in ln[i + len("Expand "):]:
            if ch == "[":
                depth += 1
                if depth == 2:
                    n += 1
            elif ch == "]":
                depth -= 1
                if depth == 0:
                    break
        widths.append(n)
    return widths


def test_monthly_activity_expand_is_narrow(spark, queries):
    """M07's distinct counts expand each (pre-aggregated) row at most three ways."""
    plan = queries["m07_monthly_active_customers"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    widths = _expand_widths(plan)
    assert widths and max(widths) <= 3, widths


def test_top_row_pickers_aggregate_before_the_shuffle(spark, queries):
    """W01/W02/W04 reduce each map partition to one row per key (partial aggregate below the
    Exchange), so a hot key never lands whole in one task."""
    for name, fn in [("w01_latest_per_key", "partial_max"), ("w02_top_payment_per_month", "partial_max"),
                     ("w04_last_in_period", "partial_max_by")]:
        plan = queries[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert fn in plan, name
        assert "Window" not in plan, name


def test_broadcast_only_behind_a_size_bound(spark):
    from paidpath.operators.sizing import broadcast_if_bounded, estimated_bytes
    from paidpath.sources import bindings as B
    from paidpath.sources.tables import Catalog
    t = Catalog(spark, SMALL)
    plans = B.plans(spark)
    assert estimated_bytes(plans) < 10_000                          # exact size of the literal
    orders = t("orders", ["o_orderkey", "o_orderpriority"])
    lines = t("lineitem", ["l_orderkey"])
    assert broadcast_if_bounded(lines, max_bytes=1024) is lines      # over the bound: no hint
    hinted = orders.join(broadcast_if_bounded(plans), orders.o_orderpriority == plans.associated_plan)
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()


def test_bucketed_members_are_not_exchanged(spark):
    """Over tables stored by member, the waterfall's joins, window and aggregate move no row."""
    import re

    from paidpath.registry import bucketed_waterfall
    from paidpath.sources.tables import Catalog
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(bucketed_waterfall(Catalog(spark, SMALL)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert not re.findall("Exchange hashpartitioning[^\\n]*", plan), plan

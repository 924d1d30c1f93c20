"""Stored states: months replaced as a version, M07 over stored months, distinct bitmaps,
running sums in place of frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paidpath.operators import bitmaps
from paidpath.operators.rolling import calendar_rolling_sum, calendar_trailing_sum
from paidpath.operators.spines import day_sequence, densify
from paidpath.sources.sinks import scratch_table_path
from paidpath.sources.versions import MonthTable

D = dt.date
ROWS = "member_id long, month date, v long"


def _all(df):
    return sorted(map(tuple, df.select("member_id", "month", "v").collect()), key=repr)


def test_a_version_is_replaced_whole(spark):
    table = MonthTable(spark, scratch_table_path(spark, "versions"), "month")
    assert table.version() == 0 and table.months() == {}
    with pytest.raises(FileNotFoundError):
        table.read()
    old = spark.createDataFrame([(1, D(2024, 1, 1), 1), (2, D(2024, 2, 1), 2), (3, D(2024, 3, 1), 3), (4, None, 4)], ROWS)
    assert table.replace(old) == 1
    before = table.read()
    recent = lambda m: m is not None and m >= D(2024, 2, 1)
    # February gets other rows, March none
    assert table.replace(spark.createDataFrame([(9, D(2024, 2, 1), 9)], ROWS), recent) == 2
    assert _all(table.read()) == [(1, D(2024, 1, 1), 1), (4, None, 4), (9, D(2024, 2, 1), 9)]
    assert _all(before) == _all(old) == _all(table.read(1))  # a reader of the old version still sees all of it
    assert _all(table.read(since=D(2024, 2, 1))) == [(9, D(2024, 2, 1), 9)]
    assert table.months(1)[D(2024, 1, 1)] == table.months(2)[D(2024, 1, 1)]  # January was not written again
    with pytest.raises(ValueError):
        table.replace(old, recent)
    # a write that fails leaves the table as it was
    bad = old.where("month >= DATE'2024-02-01'").withColumn("v", F.raise_error(F.lit("stop")).cast("long"))
    with pytest.raises(Exception, match="stop"):
        table.replace(bad, recent)
    assert table.version() == 2 and len(_all(table.read())) == 3
    with pytest.raises(RuntimeError):
        table._commit(2, {})
    table.replace(spark.createDataFrame([], ROWS), lambda m: True)
    assert table.version() == 3 and table.read().count() == 0 and table.read().columns == ["member_id", "month", "v"]
    table.vacuum(keep=1)
    assert table._names(f"{table.path}/data") == [] and table.version() == 3


def test_monthly_active_reads_only_the_months_it_replaces(spark):
    from paidpath.plans.activity import monthly_active_customers, refresh_monthly_active
    meaningful = spark.createDataFrame([("view", "composer", True), ("click", "planner", True)], "event string, activity_category string, is_active_event boolean")
    schema = ("event_id long, actor_id long, event string, timestamp timestamp_ntz, organization_id long, social_network_type string, "
              "member_effective_product_code string")
    at = dt.datetime
    first = [(1, 1, "view", at(2024, 1, 5), 10, "twitter", "PRO"), (2, 2, "click", at(2024, 2, 5), None, None, "PRO"), (3, 2, "view", at(2024, 4, 6), 10, "x", "PRO")]
    later = [(4, 3, "view", at(2024, 5, 7), None, "x", "PRO"), (5, 1, "view", at(2024, 4, 8), 10, "x", "PRO")]
    late = [(6, 1, "view", at(2024, 1, 9), 10, "x", "PRO")]  # of a month that is no longer recomputed
    customers = spark.createDataFrame([(1,), (2,), (3,)], "member_id long")
    orgs = spark.createDataFrame([(10, 2)], "organization_id long, payment_member_id long")
    state, table = (MonthTable(spark, scratch_table_path(spark, n), "month_of_activity") for n in ("s", "t"))
    run = lambda rows, day: refresh_monthly_active(state, table, spark.createDataFrame(rows, schema), meaningful, customers, orgs, day)
    rows = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)
    full = lambda rows_: rows(monthly_active_customers(spark.createDataFrame(rows_, schema), meaningful, customers, orgs))
    assert rows(run(first, D(2024, 5, 1))) == full(first)
    was = state.months()
    assert rows(run(first + later + late, D(2024, 6, 1))) == full(first + later)
    now = state.months()
    assert now[D(2024, 1, 1)] == was[D(2024, 1, 1)] and now[D(2024, 4, 1)] != was[D(2024, 4, 1)] and D(2024, 5, 1) in now


def test_distinct_bitmaps_merge_and_numbers_stay(spark):
    rows = spark.createDataFrame([(f"m{(i * i) % 97}" if i % 11 else None, D(2024, 1, 1) + dt.timedelta(days=i % 40), "ab"[i % 2]) for i in range(3000)],
                                 "member string, day date, label string")
    numbers = bitmaps.number_members(rows.where(F.col("day") < D(2024, 1, 20)), "member").cache()
    again = bitmaps.number_members(rows, "member", numbers)
    known, grown = ({r["member"]: r["member_number"] for r in d.collect()} for d in (numbers, again))
    assert sorted(grown.values()) == list(range(1, len(grown) + 1)) and all(grown[m] == n for m, n in known.items())
    # numbers over several bitmaps, whichever members they belong to
    wide = again.withColumn("member_number", F.col("member_number") * 40_000)
    for dictionary in (again, wide):
        states = bitmaps.member_states(rows.join(dictionary, "member"), ["day", "label"])
        months = bitmaps.member_counts(states.withColumn("month", F.trunc("day", "month")), ["month", "label"])
        want = rows.groupBy(F.trunc("day", "month").alias("month"), "label").agg(F.count_distinct("member").alias("members"))
        assert sorted(map(tuple, months.collect())) == sorted(map(tuple, want.collect()))
        assert sorted(map(tuple, bitmaps.member_counts(states, []).collect())) == [(rows.agg(F.count_distinct("member")).first()[0],)]
    trailing = {r["day"]: r["members"] for r in bitmaps.member_counts(bitmaps.trailing_states(states, "day", [], 7), ["day"]).collect()}
    local = [(r["member"], r["day"]) for r in rows.collect() if r["member"]]
    for end, n in trailing.items():
        assert n == len({m for m, d in local if end - dt.timedelta(days=6) <= d <= end})
    assert len(trailing) == 46


def test_running_sums_equal_the_frames_over_ten_years(spark):
    first, last = D(2019, 1, 1), D(2028, 12, 31)  # two Februaries of 29 days
    days = [first + dt.timedelta(days=k) for k in range((last - first).days + 1)]
    fact = spark.createDataFrame([(key, d, (k * 7919) % 13 - 3) for key, step in ((1, 1), (2, 17), (3, 83)) for k, d in enumerate(days) if k % step == 0 and k % 5],
                                 "key long, date date, n long")
    shell = fact.groupBy("key").agg(F.min("date").alias("f")).select(F.explode(day_sequence(F.col("f"), F.lit(last))).alias("date"), "key")
    framed = calendar_rolling_sum(densify(fact, shell, ["key", "date"]), "n", ["key"], "date", out="s").where("s IS NOT NULL").select("date", "key", "s")
    nothing = spark.createDataFrame([(None, first, 5), (1, first, None)], "key long, date date, n long")
    summed = calendar_trailing_sum(fact.union(nothing), "n", ["key"], "date", F.lit(last), out="s")
    assert summed.count() == framed.count() > len(days)
    assert summed.exceptAll(framed).count() == 0
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("running") < 9 and "Join" not in plan

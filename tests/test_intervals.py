"""Bucketed interval joins, day masks and funnel states against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from paidpath.operators import events as E
from paidpath.operators.daymasks import day_masks, days_in_windows
from paidpath.operators.funnel import distinct_before, distinct_of, event_classes, funnel_state, has_class, merge_states

T0 = dt.datetime(2023, 12, 30)
ANCHORS = "member_id long, anchor timestamp_ntz"
EVENTS = "actor_id long, event string, timestamp timestamp_ntz, network long"


def _rows(seed=4, n=400):
    rng = random.Random(seed)
    at = lambda days: T0 + dt.timedelta(seconds=rng.randrange(days * 86400))
    anchors = [(rng.choice([1, 2, 3, 4, None]), at(20)) for _ in range(12)] + [(1, None), (9, T0)]
    anchors.append(anchors[0])
    events = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice("abc"), at(60), rng.choice([7, 8, 9, None])) for _ in range(n)]
    member, start = next(a for a in anchors if a[0] and a[1])
    events += [(member, "a", start, 7), (member, "a", start + dt.timedelta(days=5), 8), (member, "b", start + dt.timedelta(days=5, microseconds=1), 9)]
    return anchors, events


def _pairs(anchors, events, lower, upper, closed=True):
    out = []
    for m, a in anchors:
        for e in events:
            if m is not None and a is not None and e[0] == m:
                lo, hi = a + lower, a + upper
                if lo <= e[2] and (e[2] <= hi if closed else e[2] < hi):
                    out.append((m, a, *e[1:]))
    return out


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_bucketed_window_equals_the_plain_one(spark):
    anchors, events = _rows()
    base, ev = spark.createDataFrame(anchors, ANCHORS), spark.createDataFrame(events, EVENTS)
    for days in (None, 1, 2, 50):
        for closed in ("both", "left"):
            j = E.events_in_window(base, ev, "member_id", "anchor", -1, 5, closed=closed, event_key="actor_id", days=days)
            got = j.select("_b.member_id", "_b.anchor", "_e.event", "_e.timestamp", "_e.network").collect()
            assert _sorted(got) == _sorted(_pairs(anchors, events, dt.timedelta(days=-1), dt.timedelta(days=5), closed == "both"))
    j = E.events_in_window(base, ev, "member_id", "anchor", 0, 30, unit="hour", how="left", event_key="actor_id", days=1)
    want = _pairs(anchors, events, dt.timedelta(0), dt.timedelta(hours=30))
    met = {(m, a) for m, a, *_ in want}
    want += [(*a, None, None, None) for a in anchors if a not in met]
    assert _sorted(j.select("_b.member_id", "_b.anchor", "_e.event", "_e.timestamp", "_e.network").collect()) == _sorted(want)


def test_first_event_with_and_without_a_bound(spark):
    anchors, events = _rows(5)
    base, ev = spark.createDataFrame(anchors, ANCHORS), spark.createDataFrame(events, EVENTS)
    for days in (None, 4):
        got = E.first_event_after(base, ev, "member_id", "anchor", days, event_key="actor_id").collect()
        first = {}
        for m, a, _, ts, _ in _pairs(anchors, events, dt.timedelta(0), dt.timedelta(days=days or 9999)):
            first[m, a] = min(first.get((m, a), ts), ts)
        assert _sorted(got) == _sorted((*k, v) for k, v in first.items())


def test_active_days_are_counted_as_bits(spark):
    rng = random.Random(2)
    day = lambda k: dt.date(1969, 11, 20) + dt.timedelta(days=k)
    active = [(rng.choice([1, 2, None]), day(rng.randrange(300))) for _ in range(500)] + [(1, None)]
    windows = [(rng.choice([1, 2]), day(k), day(k + rng.randrange(-2, 140))) for k in rng.sample(range(200), 9)] + [(3, day(0), day(9)), (None, day(0), day(9)), (2, None, day(3))]
    w = spark.createDataFrame(windows, "member_id long, first date, last date")
    a = spark.createDataFrame(active, "member_id long, day date")
    want = {m: 0 for m, *_ in windows}
    for m in want:
        want[m] = len({d for n, d in active if n is not None and n == m and d and any(x == m and f and f <= d <= l for x, f, l in windows)})
    assert {r[0]: r[1] for r in days_in_windows(w, a, "member_id", "n").collect()} == want
    masks = day_masks(a, ["member_id"])
    assert masks.count() <= 3 * (300 // 64 + 2)  # a row per 64 days, not per day
    assert sum(bin(r["mask"] & (2**64 - 1)).count("1") for r in masks.collect()) == len({x for x in active if x[1]})


def test_funnel_states_merge(spark):
    anchors, events = _rows(6)
    classes = {"a": F.col("event") == "a", "bc": F.col("event").isin("b", "c"), "never": F.lit(None).cast("boolean")}
    base = spark.createDataFrame([a for a in set(anchors) if a[0] and a[1]], ANCHORS)
    ev = spark.createDataFrame(events, EVENTS).select("actor_id", "timestamp", "network", event_classes(classes))
    pairs = E.events_in_window(base, ev, "member_id", "anchor", 0, 9, event_key="actor_id").select(
        "_b.member_id", "_b.anchor", "_e.timestamp", "_e.network", "_e.classes")
    keys, in4 = ["member_id", "anchor", "network"], F.col("timestamp") <= F.col("anchor") + F.make_interval(days=F.lit(4))
    args = ("timestamp", {"a": has_class(classes, "a")}, {"bc4": in4 & has_class(classes, "bc"), "any": has_class(classes, "a", "bc"), "never": has_class(classes, "never")})
    whole = funnel_state(pairs, keys, *args)
    # states of two halves of the pairs merge into the state of all
    half = F.dayofmonth("timestamp") % 2 == 0
    parts = funnel_state(pairs.where(half), keys, *args).unionByName(funnel_state(pairs.where(~half), keys, *args))
    assert _sorted(merge_states(parts, keys).select(whole.columns).collect()) == _sorted(whole.collect())
    py = _pairs({a for a in anchors if a[0] and a[1]}, events, dt.timedelta(0), dt.timedelta(days=9))
    got = {r["member_id"]: r for r in merge_states(whole, ["member_id"]).collect()}
    for m, r in got.items():
        own = [p for p in py if p[0] == m]
        assert r["first_a"] == min((p[3] for p in own if p[2] == "a"), default=None)
        assert (r["n_any"], r["n_never"]) == (len(own), 0)
        assert r["n_bc4"] == sum(p[2] in "bc" and p[3] <= p[1] + dt.timedelta(days=4) for p in own)
    got = {r[0]: r[1] for r in distinct_of(whole, ["member_id"], "network", {"n": "bc4"}).collect()}
    assert got == {m: len({p[4] for p in py if p[0] == m and p[4] and p[2] in "bc" and p[3] <= p[1] + dt.timedelta(days=4)}) for m in got} and got
    marker = spark.createDataFrame([(1, T0 + dt.timedelta(days=9))], "member_id long, at timestamp_ntz")
    got = {r[0]: r[1] for r in distinct_before(whole, "member_id", "network", "a", marker, "at", "n").collect()}
    before = lambda m: {p[4] for p in py if p[0] == m and p[2] == "a" and (m != 1 or p[3] < T0 + dt.timedelta(days=9))}
    assert got == {m: len(before(m) - {None}) for m in {p[0] for p in py} if before(m)}


def test_distinct_before_marker_keeps_keys_without_a_value(spark):
    t = lambda h: T0 + dt.timedelta(hours=h)
    pairs = spark.createDataFrame([(1, t(1), 5), (1, t(3), 6), (1, t(9), 5), (2, t(4), None), (3, t(9), 8), (4, t(1), 5), (4, t(2), 6)],
                                  "k long, ts timestamp_ntz, v long")
    markers = spark.createDataFrame([(1, t(3)), (3, t(9))], "k long, at timestamp_ntz")
    assert sorted(map(tuple, E.distinct_before_marker(pairs, markers, "k", "ts", "at", "v", "n").collect())) == [(1, 1), (2, 0), (4, 2)]

"""Event-window operators: allow-lists (W17), events in a window around an anchor (W10),
first event after an anchor (W05), conditional counts (W11), distinct values before a
marker (W13), day-bucket retention (W14), active days in a window (W15), breadth in a
window (W16).

Design note (scale): a window join is an equi-join on the member *and* a bucket of days.
Each anchor becomes one row for every bucket its window touches (at most ``SPREAD`` + 1), an
event lies in one bucket, and the exact time range is a residual predicate. A member with a
third of all events is therefore dealt out by time, to as many partitions as the log has
buckets, instead of meeting its anchors in one task. Whatever follows is an aggregate whose
partial step runs where the pairs are made, so a row per task and group is shuffled, not a
row per pair. AQE can still split a bucket that is hot itself: no operator above reuses the
join's partitioning. Events are filtered by the allow-list (a mapping broadcast behind a size
bound) before the join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidpath.operators.daymasks import days_in_windows
from paidpath.operators.sizing import broadcast_if_bounded

SPREAD = 8  # buckets that a window is cut into
BUCKET = "_bucket"

def allow_listed_events(events: DataFrame, mapping: DataFrame, key: str = "event", how: str = "inner",
                        mapping_key: str | None = None) -> DataFrame:
    """Keep events whose ``key`` is in a (bounded, broadcast) mapping. ``inner`` adds
    the mapping's columns; ``semi`` only filters."""
    mk = mapping_key or key
    m = mapping if mk == key else mapping.withColumnRenamed(mk, key)
    if how == "semi":
        return events.join(broadcast_if_bounded(m.select(key).distinct()), key, "left_semi")
    return events.join(broadcast_if_bounded(m), key, "inner")


def shift(ts: Column | str, amount: int, unit: str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    if unit == "day":
        return c + F.make_interval(days=F.lit(amount))
    if unit == "hour":
        return c + F.make_interval(hours=F.lit(amount))
    raise ValueError(unit)


def window_condition(ts: Column, anchor: Column, lower: int, upper: int, unit: str = "day",
                     closed: str = "both") -> Column:
    """``anchor + lower <= ts <= anchor + upper``; ``closed='left'`` makes the upper bound open."""
    lo = ts >= shift(anchor, lower, unit)
    hi = ts <= shift(anchor, upper, unit) if closed == "both" else ts < shift(anchor, upper, unit)
    return lo & hi


def _keys(key, event_key):
    keys = [key] if isinstance(key, str) else list(key)
    ekeys = keys if event_key is None else ([event_key] if isinstance(event_key, str) else list(event_key))
    return keys, ekeys


def bound_to_anchor_range(events: DataFrame, base: DataFrame, anchor: str, lower: int, upper: int,
                          unit: str = "day", ts: str = "timestamp") -> DataFrame:
    """Keep only events inside [min(anchor) + lower, max(anchor) + upper].

    The two bounds come from one scalar subquery over the (small) anchor side, evaluated at
    run time, so events outside every window are dropped right after the scan and never
    reach the shuffle. On a multi-year event log and a few months of anchors this removes
    most of the join input. No rows leave the driver."""
    rng = base.select(F.struct(F.min(anchor).alias("lo"), F.max(anchor).alias("hi")).alias("r")).scalar()
    return events.filter((F.col(ts) >= shift(rng["lo"], lower, unit)) & (F.col(ts) <= shift(rng["hi"], upper, unit)))


def time_bucket(ts: Column, days: int) -> Column:
    """Number of the bucket of ``days`` days that a time lies in. Days, not seconds: whole
    dates keep their order in every session time zone."""
    return F.floor(F.unix_date(F.to_date(ts)) / F.lit(days)).cast("int")


def bucket_days(lower: int, upper: int, unit: str = "day") -> int:
    """Days of a bucket, so that a window touches ``SPREAD`` + 1 buckets at most."""
    return max(1, -(-(upper - lower) // (SPREAD * (24 if unit == "hour" else 1))))


def window_buckets(anchor: Column, lower: int, upper: int, unit: str, days: int) -> Column:
    """The buckets that an anchor's window touches; null for a null anchor."""
    return F.sequence(time_bucket(shift(anchor, lower, unit), days), time_bucket(shift(anchor, upper, unit), days))


def events_in_window(base: DataFrame, events: DataFrame, key, anchor: str, lower: int, upper: int,
                     unit: str = "day", closed: str = "both", how: str = "inner", ts: str = "timestamp",
                     event_key=None, prune: bool = True, days: int | None = None) -> DataFrame:
    """Pair each base row with the same member's events in [anchor+lower, anchor+upper]
    (upper open when ``closed='left'``), as columns of ``_b`` and ``_e``. ``key``/``event_key``
    may name several equi keys (member and category). With ``prune`` the events are first
    bounded to the anchors' overall time range (before the shuffle). ``days``: length of a
    bucket. Null keys and anchors have no events.

    ``how='left'`` keeps base rows without events. Which rows these are is found first, by the
    distinct anchors of the pairs; they go through the join once, in no bucket, while a row
    with events loses the buckets in which it has none."""
    keys, ekeys = _keys(key, event_key)
    if prune:
        events = bound_to_anchor_range(events, base, anchor, lower, upper, unit, ts)
    days = days or bucket_days(lower, upper, unit)
    e = events.withColumn(BUCKET, time_bucket(F.col(ts), days)).alias("_e")
    cond = window_condition(F.col(f"_e.{ts}"), F.col(f"_b.{anchor}"), lower, upper, unit, closed)
    cond = (F.col(f"_b.{BUCKET}") == F.col(f"_e.{BUCKET}")) & cond
    for k, ek in zip(keys, ekeys):
        cond = (F.col(f"_b.{k}") == F.col(f"_e.{ek}")) & cond
    buckets = window_buckets(F.col(anchor), lower, upper, unit, days)
    if how == "inner":
        return base.withColumn(BUCKET, F.explode(buckets)).alias("_b").join(e, cond, "inner")
    if how != "left":
        raise ValueError(how)
    by = list(dict.fromkeys([*keys, anchor]))
    b = base.select(*by).distinct().withColumn(BUCKET, F.explode(buckets)).alias("_b")
    met = b.join(e, cond, "inner").select(*[F.col(f"_b.{c}").alias(c) for c in by]).distinct()
    b = base.join(met.withColumn("_met", F.lit(True)), by, "left").select(*[base[c] for c in base.columns], "_met")
    none = F.array(F.lit(None).cast("int"))
    b = b.withColumn(BUCKET, F.explode(F.when(F.col("_met"), buckets).otherwise(none))).alias("_b")
    j = b.join(e, cond, "left")
    return j.where(F.col("_b._met").isNull() | F.col(f"_e.{BUCKET}").isNotNull())


def first_event_after(base: DataFrame, events: DataFrame, key: str, anchor: str, days: int | None,
                      out: str = "first_ts", ts: str = "timestamp", event_key: str | None = None) -> DataFrame:
    """Earliest event per base row within ``days`` of the anchor (any time after the
    anchor when ``days`` is None). Base rows without such an event are dropped.

    Without an upper bound, the events of the anchor's own day are joined by member and day,
    and of all later days only each day's first event, found before the shuffle, so a member
    brings a row per day at most."""
    ek = event_key or key
    if days is not None:
        j = events_in_window(base, events, key, anchor, 0, days, ts=ts, event_key=event_key)
        return j.groupBy(F.col(f"_b.{key}").alias(key), F.col(f"_b.{anchor}").alias(anchor)).agg(
            F.min(F.col(f"_e.{ts}")).alias(out))
    day = "_day"
    b = base.select(key, anchor).distinct().withColumn(day, F.to_date(anchor)).alias("_b")
    e = events.select(F.col(ek).alias(key), F.col(ts).alias(out)).withColumn(day, F.to_date(out))
    same = F.col(f"_b.{key}") == F.col(f"_e.{key}")
    now = b.join(e.alias("_e"), same & (F.col(f"_b.{day}") == F.col(f"_e.{day}")) & (F.col(f"_e.{out}") >= F.col(f"_b.{anchor}")))
    first = e.groupBy(key, day).agg(F.min(out).alias(out)).alias("_e")
    later = b.join(first, same & (F.col(f"_e.{day}") > F.col(f"_b.{day}")))
    found = [j.select(f"_b.{key}", f"_b.{anchor}", f"_e.{out}") for j in (now, later)]
    return found[0].unionByName(found[1]).groupBy(key, anchor).agg(F.min(out).alias(out))


def conditional_counts(df: DataFrame, keys: Sequence[str], counts: Mapping[str, Column]) -> DataFrame:
    """Many named counts in one pass (``SUM(CASE WHEN p THEN 1 ELSE 0 END)``)."""
    return df.groupBy(*keys).agg(*[F.sum(F.when(p, 1).otherwise(0)).alias(n) for n, p in counts.items()])


def distinct_before_marker(pairs: DataFrame, markers: DataFrame, key: str, ts: str, marker_ts: str,
                           value: str, out: str) -> DataFrame:
    """Per key, distinct ``value`` seen strictly before the key's marker time; all of
    them when the key has no marker. A value was seen before the marker if its first time was,
    so the pairs are reduced to a first time per key and value before they meet the markers."""
    first = pairs.groupBy(key, value).agg(F.min(ts).alias(ts))
    j = first.join(markers.select(key, marker_ts), key, "left")
    keep = (F.col(marker_ts).isNull()) | (F.col(ts) < F.col(marker_ts))
    return j.filter(keep).groupBy(key).agg(F.count(value).alias(out))


def day_bucket_counts(pairs: DataFrame, keys: Sequence[str], anchor: str, ts: str,
                      buckets: Mapping[str, tuple[int, int]], condition: Column | None = None) -> DataFrame:
    """Events per day bucket after the anchor (whole days between the two dates)."""
    d = F.datediff(F.to_date(ts), F.to_date(anchor))
    cond = condition if condition is not None else F.lit(True)
    return conditional_counts(pairs, keys, {n: cond & d.between(lo, hi) for n, (lo, hi) in buckets.items()})


def active_days_in_window(base: DataFrame, activity: DataFrame, key: str, anchor: str, days: int,
                          day_col: str, out: str = "days_active") -> DataFrame:
    """Distinct active days in [anchor, anchor + days] of a member's anchors; 0 when
    there are none. Days are bits (operators/daymasks.py), so a member brings a row per 64 days
    to the join, not one per active day. The activity table is first bounded to the anchors'
    overall range (runtime scalar subquery)."""
    rng = base.select(F.struct(F.min(anchor).alias("lo"), F.max(anchor).alias("hi")).alias("r")).scalar()
    activity = activity.filter((F.col(day_col) >= F.to_date(rng["lo"])) &
                               (F.col(day_col) <= F.date_add(F.to_date(rng["hi"]), days)))
    at = F.to_date(anchor)
    windows = base.select(key, F.when(F.col(anchor) > at, F.date_add(at, 1)).otherwise(at).alias("first"),
                          F.date_add(at, days).alias("last"))
    return days_in_windows(windows, activity.select(key, F.col(day_col).alias("day")), key, out)


def breadth_in_window(pairs: DataFrame, keys: Sequence[str], value: Column, out: str) -> DataFrame:
    """Distinct values (profiles, networks, families) used per key."""
    return pairs.groupBy(*keys).agg(F.count_distinct(value).alias(out))

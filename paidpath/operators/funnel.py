"""Mergeable funnel state: what windowed measures need to know about a member's events.

One pass over anchor x event pairs gives an associative state per group: the first time each
marked class of events was seen (W05) and how many events of each class fell into their windows
(W11, W14). With the distinct value as one of the group's keys, distinct counts (W16) and
distinct values before a marker (W13) are counts of state rows, so every measure of a funnel
comes from the state and the pairs are read once.

States of parts of the pairs (time buckets, days, files) merge by ``merge_states`` into the
state of all of them: minima of firsts, sums of counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_classes(classes: Mapping[str, Column], out: str = "classes") -> Column:
    """The classes an event belongs to, as bits of one integer: all that a pair has to carry
    of the event's name and payload."""
    if len(classes) > 63:
        raise ValueError("at most 63 classes")
    bits = F.lit(0).cast("long")
    for k, cond in enumerate(classes.values()):
        bits = bits.bitwiseOR(F.when(cond, F.lit(1 << k)).otherwise(0).cast("long"))
    return bits.alias(out)


def has_class(classes: Mapping[str, Column] | Sequence[str], *names: str, col: str = "classes") -> Column:
    """Whether an event belongs to one of the named classes."""
    order = list(classes)
    return F.col(col).bitwiseAND(F.lit(sum(1 << order.index(n) for n in names))) != 0


def funnel_state(pairs: DataFrame, keys: Sequence[str], ts: str, firsts: Mapping[str, Column], counts: Mapping[str, Column]) -> DataFrame:
    """``keys`` (one may be the distinct value) with ``first_<name>`` and ``n_<name>``."""
    return pairs.groupBy(*keys).agg(
        *[F.min(F.when(c, F.col(ts))).alias(f"first_{n}") for n, c in firsts.items()],
        *[F.count_if(c).alias(f"n_{n}") for n, c in counts.items()])


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The states of coarser groups (fewer keys), or of several parts of the pairs."""
    firsts = [c for c in states.columns if c.startswith("first_")]
    counts = [c for c in states.columns if c.startswith("n_")]
    return states.groupBy(*keys).agg(*[F.min(c).alias(c) for c in firsts], *[F.sum(c).alias(c) for c in counts])


def distinct_of(states: DataFrame, keys: Sequence[str], value: str, counts: Mapping[str, str]) -> DataFrame:
    """Per ``keys``, how many distinct non-null ``value`` have ``n_<name>`` above 0, as the
    columns that ``counts`` names: out -> name."""
    per_value = merge_states(states, [*keys, value])
    return per_value.groupBy(*keys).agg(*[F.count_if((F.col(f"n_{n}") > 0) & F.col(value).isNotNull()).alias(out) for out, n in counts.items()])


def distinct_before(states: DataFrame, key: str, value: str, first: str, marker: DataFrame, marker_ts: str, out: str, unit: str | None = None) -> DataFrame:
    """Per ``key``, distinct ``value`` whose ``first_<first>`` lies before the key's marker
    (all with such a time if there is none); ``unit`` truncates both times. Keys without a
    value in the state have no row."""
    cut = (lambda c: F.date_trunc(unit, c)) if unit else F.col
    per_value = states.groupBy(key, value).agg(F.min(f"first_{first}").alias("_first")).where("_first IS NOT NULL")
    j = per_value.join(marker.select(key, marker_ts), key, "left")
    before = F.col(marker_ts).isNull() | (cut("_first") < cut(marker_ts))
    return j.where(before).groupBy(key).agg(F.count(value).alias(out))

"""Column-level rules: flags (W12), risk labels (W21), MRR movement (W22), experiment
audience (W23), tier labels (W24), category folding (W25), week buckets (W26), e-mail
domain (W27), tri-state booleans (W28), surrogate keys (W34).

All are pure ``Column`` expressions: they compile into the surrounding whole-stage
codegen span and never leave the JVM.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from paidpath.functions.calendar import lit_date


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- W12 ---------------------------------------------------------------------------------

_OPS = {
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "=": lambda a, b: a == b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
}


def threshold_flag(count, op: str = ">", value=0, as_int: bool = False) -> Column:
    """``CASE WHEN count <op> value THEN TRUE ELSE FALSE``: a null count gives FALSE."""
    cond = _OPS[op](_c(count), F.lit(value))
    return F.when(cond, F.lit(1 if as_int else True)).otherwise(F.lit(0 if as_int else False))


def threshold_flags(spec: Mapping[str, tuple]) -> list[Column]:
    """Many flags at once: ``{name: (count, op, value[, as_int])}``."""
    return [threshold_flag(*args).alias(name) for name, args in spec.items()]


# ---- W21 ---------------------------------------------------------------------------------

def activity_risk(active, previous, three_week, two_month, twelve_month) -> Column:
    """Seven risk labels from weekly activity (first matching rule wins)."""
    a, p, w3, m2, m12 = map(_c, (active, previous, three_week, two_month, twelve_month))
    return (F.when(w3 == 3, "1_super_healthy")
             .when((a == 1) & p.isNull(), "3_low_risk")
             .when((a == 1) & (w3 >= 2), "2_healthy")
             .when((a == 1) & (w3 <= 1), "4_medium_risk")
             .when((a == 0) & p.isNull(), "4_medium_risk")
             .when((a == 0) & (w3 == 0) & (m12 == 0), "7_dormant_12m")
             .when((a == 0) & (w3 == 0) & (m2 == 0), "6_dormant_2m")
             .when((a == 0) & (w3 == 0), "5_high_risk")
             .when((a == 0) & (w3 >= 2), "3_low_risk")
             .when((a == 0) & (w3 == 1), "4_medium_risk"))


# ---- W22 ---------------------------------------------------------------------------------

MOVEMENTS_KEEP_THIS = ("net_new", "price_increase", "expansion", "win_back", "contraction")


def mrr_movement(this_mrr, last_mrr, is_first_month, has_row, plan, last_plan,
                 interval, last_interval) -> Column:
    """Movement label of a member-month (first matching rule wins; null = no movement)."""
    t, l = _c(this_mrr), _c(last_mrr)
    same_plan = (_c(plan) == _c(last_plan)) & (_c(interval) == _c(last_interval))
    return (F.when(_c(is_first_month), "net_new")
             .when((l > 0) & (t > l) & same_plan, "price_increase")
             .when((l > 0) & (t > l), "expansion")
             .when(l.isNull() & (t > 0), "win_back")
             .when((t != 0) & (l != 0) & (l > t), "contraction")
             .when(~_c(has_row) & (l > 0), "churn")
             .when(t < 0, "contraction")
             .when((t != 0) & (t == l), "previous_month")
             .when(t != 0, "expansion"))


def movement_mrr(change, this_mrr, last_mrr) -> Column:
    ch, t, l = _c(change), _c(this_mrr), _c(last_mrr)
    return (F.when(ch.isin(*MOVEMENTS_KEEP_THIS), t)
             .when(ch == "previous_month", l)
             .when(ch == "churn", -l))


def movement_mrr_change(change, this_mrr, last_mrr) -> Column:
    ch, t, l = _c(change), _c(this_mrr), _c(last_mrr)
    return (F.when(ch.isin("net_new", "win_back"), t)
             .when(ch.isin("expansion", "contraction", "price_increase", "previous_month"), t - l)
             .when(ch == "churn", -l))


# ---- W23 ---------------------------------------------------------------------------------
# Experiment-name prefixes that the read-outs must classify identically.
# Cohort-table experiments (compared in upper case unless noted):
COHORT_FREE_EXACT = "GRW_SS_ACT_1"
COHORT_PAID_PREFIXES = ("EX_", "GRW_SS", "CA_", "HP_", "PL_", "sitewide_", "DE_", "PM_", "PNC_")
# Event-stream experiments add two more paid prefixes:
EVENT_PAID_PREFIXES = ("EX_", "GRW_SS", "CA_", "HP_", "PL_", "sitewide_", "DE_", "ACT_", "ENG_", "PM_", "PNC_")
FREE_PREFIX = "GRW_FREE"
LOWER_CASE_PREFIXES = ("sitewide_",)   # compared against lower(name); all others against upper(name)


def _prefix_match(name: Column, prefixes: Sequence[str]) -> Column:
    conds = [(F.lower(name) if p in LOWER_CASE_PREFIXES else F.upper(name)).startswith(p) for p in prefixes]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def experiment_audience(name, source: str = "cohort") -> Column:
    """'paid' / 'free' / null by experiment-name prefix; ``source`` picks the list."""
    n = _c(name)
    if source == "cohort":
        exact, prefixes = n == COHORT_FREE_EXACT, COHORT_PAID_PREFIXES
    else:
        exact, prefixes = F.upper(n) == COHORT_FREE_EXACT, EVENT_PAID_PREFIXES
    return (F.when(exact, "free")
             .when(_prefix_match(n, prefixes), "paid")
             .when(F.upper(n).startswith(FREE_PREFIX), "free"))


# ---- W24 ---------------------------------------------------------------------------------

def tier_from_label(label) -> Column:
    """First of 1..4 contained in the label -> 'tier_n'; otherwise 'unknown'."""
    lab = _c(label)
    out = F.when(lab.like("%1%"), "tier_1")
    for n in (2, 3, 4):
        out = out.when(lab.like(f"%{n}%"), f"tier_{n}")
    return out.otherwise("unknown")


# ---- W25 ---------------------------------------------------------------------------------

def fold_inbox(category) -> Column:
    c = _c(category)
    return F.when(c.isin("inbox_1", "inbox_2"), "inbox").otherwise(c)


def fold_inbox_like(category) -> Column:
    c = _c(category)
    return F.when(c.ilike("%inbox%"), "inbox").otherwise(c)


# Network families folded together.
NETWORK_FAMILIES = ("facebook", "instagram", "linkedin")


def social_network_family(name, own_app: str = "ownapp") -> Column:
    """The family of a network's name; null for the product's ``own_app``."""
    n = F.lower(_c(name))
    out = None
    for fam in NETWORK_FAMILIES:
        cond = n.ilike(f"%{fam}%")
        out = F.when(cond, fam) if out is None else out.when(cond, fam)
    return out.when(n.ilike(f"%{own_app}%"), F.lit(None).cast("string")).otherwise(n)


# ---- W26 ---------------------------------------------------------------------------------

def week_bucket(start, as_of: dt.date) -> Column:
    """Week 1..4 by whole days elapsed (0-6, 7-13, 14-20, 21-27); else 'Week 5+'."""
    d = F.datediff(lit_date(as_of), F.to_date(_c(start)))
    out = F.when(d.between(0, 6), "Week 1")
    for i, lo in enumerate((7, 14, 21), start=2):
        out = out.when(d.between(lo, lo + 6), f"Week {i}")
    return out.otherwise("Week 5+")


# ---- W27 ---------------------------------------------------------------------------------

def email_domain(email, own_domain: str) -> Column:
    d = F.lower(F.split_part(_c(email), F.lit("@"), F.lit(2)))
    return F.when(d == own_domain, F.lit(None).cast("string")).otherwise(d)


# ---- W28 ---------------------------------------------------------------------------------

def tri_state(present, condition) -> Column:
    """TRUE when the condition holds, NULL when the fact is unknown, else FALSE."""
    return (F.when(_c(condition), F.lit(True))
             .when(~_c(present), F.lit(None).cast("boolean"))
             .otherwise(F.lit(False)))


# ---- W34 ---------------------------------------------------------------------------------
# Our key contract: md5 over the text form of each value, joined with '-', with this
# sentinel standing for null.
NULL_SENTINEL = "_null_"


def surrogate_key(*cols) -> Column:
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_SENTINEL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))

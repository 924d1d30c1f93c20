"""Row-ordered windows and period roll-ups: rolling active count (W18), previous values
(W19), calendar-aware rolling sum (W20), monthly revenue (W31), opening balance (W33).

Windows here are partitioned by an entity (member) or a segment; each partition holds one
row per period of that entity (months, weeks or days), so its size is bounded by the
length of the calendar, not by the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paidpath.functions.calendar import ROLLING_FRAMES, calendar_frame_index, windows_holding


def rolling_active_count(df: DataFrame, flag: str, key: Sequence[str], order: Sequence[str],
                         n: int, out: str) -> DataFrame:
    """Sum of ``flag`` over the current row and the ``n - 1`` rows before it (rows,
    not calendar time: gaps shorten the span, T5). Other columns break ties, as in W19."""
    ties = [c for c in df.columns if c not in {*key, *order}]
    w = Window.partitionBy(*key).orderBy(*order, *ties).rowsBetween(-(n - 1), 0)
    return df.withColumn(out, F.sum(flag).over(w))


def previous_values(df: DataFrame, cols: Sequence[str], key: Sequence[str], order: Sequence[str],
                    prefix: str = "last_", offset: int = 1) -> DataFrame:
    """Previous-row value of several columns (one window spec, one sort). All other
    columns break ties of ``order`` (T9), so the answer does not depend on task order; they
    must be of types that Spark can sort."""
    w = Window.partitionBy(*key).orderBy(*order, *[c for c in df.columns if c not in {*key, *order}])
    return df.withColumns({f"{prefix}{c}": F.lag(c, offset).over(w) for c in cols})


def calendar_rolling_sum(df: DataFrame, value: str, keys: Sequence[str], date: str,
                         out: str = "rolling") -> DataFrame:
    """W20: "last month" rolling sum whose length follows the calendar.

    Nine row frames over one partition/order (one Window operator, one sort); the rule
    index picks the frame for each day. Frames count rows, so the input must hold exactly
    one row per key and day (see ``densify``)."""
    w = Window.partitionBy(*keys).orderBy(date)
    sums = [F.sum(value).over(w.rowsBetween(-p, -f)) for p, f in ROLLING_FRAMES]
    idx = calendar_frame_index(F.col(date))
    pick = F.when(idx == 0, sums[0])
    for i in range(1, len(sums)):
        pick = pick.when(idx == i, sums[i])
    return df.withColumn(out, pick)


def calendar_trailing_sum(fact: DataFrame, value: str, keys: Sequence[str], date: str, until: Column,
                          out: str = "rolling") -> DataFrame:
    """W20 over a sparse fact table, by prefix sums: ``date, keys, out`` for every day up to
    ``until`` whose "last month" window holds a row with a value.

    A row enters the windows of one stretch of days: it adds its value on the first and takes
    it away after the last. The running sum of these changes is the rolling sum, constant from
    one change to the next, and only stretches inside which some row counts become days. There
    is no shell of all days, and the window sorts two rows per fact row. Rows with a null key
    are left out, as a shell would never match them."""
    f = fact.where(F.col(value).isNotNull())
    for k in keys:
        f = f.where(F.col(k).isNotNull())
    first, last = windows_holding(F.col(date))
    points = F.explode(F.array(F.struct(first.alias("at"), F.col(value).alias("change"), F.lit(1).alias("held")),
                               F.struct(F.date_add(last, 1).alias("at"), (-F.col(value)).alias("change"), F.lit(-1).alias("held"))))
    points = f.select(*keys, points.alias("_p")).groupBy(*keys, F.col("_p.at").alias("_at")).agg(
        F.sum("_p.change").alias("_change"), F.sum("_p.held").alias("_held"))
    w = Window.partitionBy(*keys).orderBy("_at")
    steps = points.select(*keys, "_at", F.sum("_change").over(w).alias(out), F.sum("_held").over(w).alias("_n"), F.lead("_at").over(w).alias("_next"))
    days = F.sequence(F.col("_at"), F.least(F.date_sub("_next", 1), until))
    return (steps.where((F.col("_n") > 0) & (F.col("_at") <= until))
            .select(F.explode(days).alias(date), *keys, out))


def monthly_revenue(df: DataFrame, key: str, date: str, amount: str, out: str = "revenue",
                    exclude: str | None = None, month: str = "date_month") -> DataFrame:
    """Revenue per key-month, summing duplicate rows of a key; ``exclude`` names a
    boolean column whose TRUE or NULL rows are dropped (``IS FALSE`` semantics)."""
    if exclude is not None:
        df = df.filter(F.col(exclude) == F.lit(False))
    return df.groupBy(key, F.trunc(date, "month").alias(month)).agg(F.sum(amount).alias(out))


def opening_balance(ending: DataFrame, month: str, as_of_month_start, months: int = 1,
                    label_col: str | None = None, label: str | None = None) -> DataFrame:
    """Closing rows re-dated ``months`` later as opening rows, dropping any that
    would land in the still-open period (on or after ``as_of_month_start``)."""
    out = ending.withColumn(month, F.add_months(month, months))
    if label_col:
        out = out.withColumn(label_col, F.lit(label))
    return out.filter(F.col(month) < as_of_month_start)

"""Calendar helpers: run-date bounds (W38) and the calendar-aware month frame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_date(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d)).cast("date")


def month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)


def add_months_py(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.month - 1 + n, 12)
    return dt.date(d.year + y, m + 1, 1)


def last_complete_month_start(as_of: dt.date) -> Column:
    """W38, monthly models: the first day of the last complete month before ``as_of``."""
    return lit_date(add_months_py(month_start(as_of), -1))


def current_month_start(as_of: dt.date) -> Column:
    return lit_date(month_start(as_of))


def week_start(d: dt.date) -> dt.date:
    return d - dt.timedelta(days=d.weekday())


def last_complete_week_start(as_of: dt.date) -> Column:
    """W38, weekly models: the Monday of the last complete week before ``as_of``."""
    return lit_date(week_start(as_of) - dt.timedelta(days=7))


# ---- W20: calendar-aware "last month" frame -------------------------------------------
# Nine row frames (preceding, following-offset) used by the rolling paid base; all share
# one partition and order, so Catalyst evaluates them in a single Window operator.
ROLLING_FRAMES = [(30, 0), (29, 0), (27, 0), (28, 0), (28, 1), (29, 2), (29, 1), (30, 3), (30, 2)]


def calendar_frame_index(date: Column) -> Column:
    """Index into ROLLING_FRAMES for a day (first matching rule wins).

    Rules, with last = last_day(date), m = month(date), d = day(date), feb = days in the
    previous month when m = 3:
      0: m in (1, 8); or not last day and m in (2,4,6,9,11); or last day and m in (3,5,7,10,12)
      1: not last day and m in (5,7,10,12); or last day and m in (4,6,9,11)
      2: (m = 3, feb = 28, d < 28) or (last day and day(last) = 28)
      3: (m = 3, feb = 29, d < 29) or (last day and day(last) = 29)
      4: m = 3, feb = 28, d = 28      5: m = 3, feb = 28, d = 29
      6: m = 3, feb = 29, d = 29      7: m = 3, feb = 28, d = 30
      8: m = 3, feb = 29, d = 30
    """
    m, d = F.month(date), F.dayofmonth(date)
    is_last = date == F.last_day(date)
    feb = F.dayofmonth(F.last_day(F.add_months(date, -1)))
    return (F.when(m.isin(1, 8) | (~is_last & m.isin(2, 4, 6, 9, 11)) | (is_last & m.isin(3, 5, 7, 10, 12)), 0)
             .when((~is_last & m.isin(5, 7, 10, 12)) | (is_last & m.isin(4, 6, 9, 11)), 1)
             .when(((m == 3) & (feb == 28) & (d < 28)) | (is_last & (F.dayofmonth(F.last_day(date)) == 28)), 2)
             .when(((m == 3) & (feb == 29) & (d < 29)) | (is_last & (F.dayofmonth(F.last_day(date)) == 29)), 3)
             .when((m == 3) & (feb == 28) & (d == 28), 4)
             .when((m == 3) & (feb == 28) & (d == 29), 5)
             .when((m == 3) & (feb == 29) & (d == 29), 6)
             .when((m == 3) & (feb == 28) & (d == 30), 7)
             .when((m == 3) & (feb == 29) & (d == 30), 8))


# ---- W20 in closed form ------------------------------------------------------------------

def frozen_day(date: Column) -> Column:
    """The days whose window stands still: March 28-30 after a 28-day February, March 29-30
    after one of 29 days."""
    feb = F.dayofmonth(F.last_day(F.add_months(date, -1)))
    return (F.month(date) == 3) & F.dayofmonth(date).between(feb, 30)


def last_month_start(date: Column) -> Column:
    """First day of a day's "last month" window: the month itself on its last day, otherwise the
    day after the same day a month before. A frozen day has the window of March's last day
    before it, which begins on February's last. Never falls as the date rises."""
    return (F.when(date == F.last_day(date), F.trunc(date, "month"))
            .when(frozen_day(date), F.last_day(F.add_months(date, -1)))
            .otherwise(F.date_add(F.add_months(date, -1), 1)))


def windows_holding(date: Column) -> tuple[Column, Column]:
    """First and last day whose "last month" window holds ``date``. Window bounds never fall,
    so every day between the two holds it as well."""
    first = F.when(frozen_day(date), F.last_day(date)).otherwise(date)
    after = F.filter(F.sequence(date, F.date_add(date, 33)), lambda d: last_month_start(d) <= date)
    return first, F.array_max(after)

"""A refresh leaves no month that the model no longer yields."""

import datetime as dt

from pyspark.sql import functions as F

from paidpath.sources.sinks import refresh_recent_months, scratch_table_path


def test_months_without_rows_go(spark):
    D = dt.date

    def table(*rows):
        return spark.createDataFrame(rows, "member_id long, date_month date, revenue long")

    old = table((1, D(2001, 4, 1), 4), (1, D(2001, 5, 1), 5), (1, D(2001, 6, 1), 6), (1, D(2001, 7, 1), 7))
    new = table((1, D(2001, 4, 1), 4), (2, D(2001, 6, 1), 60))
    path = scratch_table_path(spark, "stale")
    refresh_recent_months(lambda recent: old, path, D(2001, 7, 1), "date_month")
    out = refresh_recent_months(lambda recent: new, path, D(2001, 7, 15), "date_month")
    assert sorted(map(tuple, out.select("member_id", "date_month", "revenue").collect())) == [
        (1, D(2001, 4, 1), 4), (2, D(2001, 6, 1), 60)]
    # nothing left in the span: the older months stay
    out = refresh_recent_months(lambda recent: old.where(F.lit(False)), path, D(2001, 7, 15), "date_month")
    assert [r["date_month"] for r in out.collect()] == [D(2001, 4, 1)]

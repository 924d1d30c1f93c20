"""Column shaping: star-except and move-to-end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def select_except(df: DataFrame, dropped: Sequence[str], last: Sequence[str] = ()) -> DataFrame:
    """Every column but ``dropped``, with ``last`` moved to the end (in that order)."""
    keep = [c for c in df.columns if c not in dropped and c not in last]
    return df.select(*keep, *last)

"""JSON payloads: parsed once a row to a variant, from which paths are read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARSED = "_payload"


def payload(df: DataFrame, col: str, paths: Mapping[str, str]) -> DataFrame:
    """``df`` with a string column for every path of the JSON text ``col``; null where the
    text is no JSON or has no such path. The text is parsed once, whatever the number of
    paths: the parsed value is a column of its own, which Catalyst does not copy into each."""
    parsed = df.withColumn(PARSED, F.try_parse_json(F.col(col)))
    return parsed.withColumns({out: F.try_variant_get(F.col(PARSED), path, "string") for out, path in paths.items()}).drop(PARSED)

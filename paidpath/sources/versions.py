"""Tables of months that are replaced as a whole version.

A version is a small manifest that names, for every month, the folder that holds its rows.
Replacing some months writes new folders and then one new manifest, which a rename makes
visible. The other months keep their folders. A reader takes the newest manifest and sees
either all of a version or none of it; no month is ever missing in between, and a writer that
fails before the rename leaves the table as it was. Old folders go with ``vacuum``.

The manifest has an entry per month, so the driver handles as many as the calendar has.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER = "_month_folder"


class MonthTable:
    def __init__(self, spark: SparkSession, path: str, month_col: str):
        self.spark, self.path, self.month_col = spark, path.rstrip("/"), month_col

    # ---- files -------------------------------------------------------------------------------

    def _hadoop(self, path: str):
        hpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hpath

    def _names(self, path: str) -> list[str]:
        fs, hpath = self._hadoop(path)
        return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []

    def _manifest(self, version: int) -> dict:
        return json.loads("\n".join(r[0] for r in self.spark.read.text(self._manifest_path(version)).collect()))

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifests/{version:012d}.json"

    # ---- reading -----------------------------------------------------------------------------

    def version(self) -> int:
        """The newest version; 0 if nothing was ever written."""
        return max((int(n[:-5]) for n in self._names(f"{self.path}/manifests") if n.endswith(".json") and not n.startswith("_")), default=0)

    def months(self, version: int | None = None) -> dict[dt.date | None, str]:
        version = version or self.version()
        if not version:
            return {}
        return {dt.date.fromisoformat(m) if m else None: f for m, f in self._manifest(version)["months"].items()}

    def read(self, version: int | None = None, since: dt.date | None = None) -> DataFrame:
        """The rows of a version, the newest if none is named; with ``since``, only of months
        from then on, so no other month's files are opened."""
        version = version or self.version()
        if not version:
            raise FileNotFoundError(f"no version in {self.path}")
        schema = T.StructType.fromJson(self._manifest(version)["schema"])
        folders = [f"{self.path}/{f}" for m, f in self.months(version).items() if since is None or (m is not None and m >= since)]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    # ---- writing -----------------------------------------------------------------------------

    def replace(self, df: DataFrame, which: Callable[[dt.date | None], bool] = lambda month: True) -> int:
        """A new version in which the months that ``which`` selects hold the rows of ``df`` (a
        month without rows goes), and all others what they held. Returns its number. Rows of
        ``df`` in other months are an error. Of two writers at once, one raises."""
        before, version = self.months(), self.version()
        folder = f"data/{version + 1:012d}-{uuid.uuid4().hex[:12]}"
        df.withColumn(FOLDER, F.coalesce(F.col(self.month_col).cast("string"), F.lit("none"))).write.partitionBy(FOLDER).parquet(f"{self.path}/{folder}")
        written = {}
        for name in self._names(f"{self.path}/{folder}"):
            if name.startswith(FOLDER):
                value = name.partition("=")[2]
                written[None if value == "none" else dt.date.fromisoformat(value)] = f"{folder}/{name}"
        astray = [m for m in written if not which(m)]
        if astray:
            raise ValueError(f"rows of months that are not replaced: {astray}")
        months = {m: f for m, f in before.items() if not which(m)} | written
        self._commit(version + 1, {"schema": df.schema.jsonValue(), "months": {m.isoformat() if m else "": f for m, f in months.items()}})
        return version + 1

    def _commit(self, version: int, manifest: dict) -> None:
        fs, target = self._hadoop(self._manifest_path(version))
        _, draft = self._hadoop(f"{self.path}/manifests/_{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise RuntimeError(f"version {version} of {self.path} was written by someone else")

    def vacuum(self, keep: int = 2) -> None:
        """Deletes what none of the newest ``keep`` versions names."""
        newest = self.version()
        kept = range(max(1, newest - keep + 1), newest + 1)
        named = {f.split("/")[1] for v in kept for f in self.months(v).values()}
        for name in self._names(f"{self.path}/data"):
            if name not in named and int(name[:12]) <= newest:
                fs, folder = self._hadoop(f"{self.path}/data/{name}")
                fs.delete(folder, True)
        for name in self._names(f"{self.path}/manifests"):
            if name.endswith(".json") and not name.startswith("_") and int(name[:-5]) not in kept:
                fs, old = self._hadoop(f"{self.path}/manifests/{name}")
                fs.delete(old, False)

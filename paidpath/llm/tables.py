"""Reading inputs and writing intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import ctypes
import math
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paidpath.session import ensure_checkpoint_dir

BATCH_BYTES = 4 << 20  # of a record batch that Spark hands to Python


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession) -> None:
    """Bounds a record batch to BATCH_BYTES, unless the session has a bound of its own. Spark holds every
    batch of a task in memory outside the heap, and the Python worker holds it again; the
    bound is no part of any result."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, BATCH_BYTES)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function of record batches, after whose task the Python worker gives freed
    memory back to the system. Workers are used again by later stages, and what the allocators
    keep of one stage's models and buffers would stand beside the next stage's."""
    @wraps(run)
    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim:
                trim(0)

    return tidy


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut, and read
    again by whichever executor needs it."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    bounded_batches(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_of_id(col: str = "doc_id") -> Column:
    """crc32 of an id's decimal text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


class BitFilter:
    """A bitmap of fixed size over hashed keys: says "surely absent" or "maybe there".

    Built by Spark's bitmap aggregates, so the driver receives at most ``bits / 8`` bytes
    whatever the number of keys. Only saves work: an exact join follows wherever it is used."""

    def __init__(self, keys: DataFrame, column: str, bits: int = 1 << 25, hashed: bool = False):
        self.bits, self.hashed = bits, hashed
        rows = (keys.select((self.slot(column) + 1).alias("s"))
                .groupBy(F.expr("bitmap_bucket_number(s)").alias("b"))
                .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(s))").alias("m")).collect())
        self.map = np.zeros(max(1, bits // 32768) * 4096, np.uint8)
        for r in rows:
            self.map[(r["b"] - 1) * 4096:r["b"] * 4096] = np.frombuffer(bytes(r["m"]), np.uint8)

    def slot(self, column: str) -> Column:
        """A key's place in the map, which Spark computes and ``has`` takes. Keys that are
        hashes themselves (``hashed``) are used as they are."""
        if self.hashed:
            return F.col(column).bitwiseAND(self.bits - 1)
        return F.pmod(F.xxhash64(F.col(column)), F.lit(self.bits))

    def has(self, slots: np.ndarray) -> np.ndarray:
        return (self.map[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 > 0

    def has_hash(self, keys: np.ndarray) -> np.ndarray:
        """``has`` for keys that are hashes, as unsigned integers."""
        return self.has((keys & np.uint64(self.bits - 1)).astype(np.int64))


def partitions_for(rows: int, each: int) -> int:
    return max(1, math.ceil(rows / each))

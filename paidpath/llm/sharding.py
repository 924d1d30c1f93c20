"""Uniform shuffle into shards of exact sizes (operator 10).

A uniform shuffle of all rows sends a random number of each partition's rows to each shard:
the counts follow a multivariate hypergeometric law under fixed row and column sums. So

1. count the rows of each input partition;
2. draw that communication matrix, partition by partition, from what the shards still lack;
3. in each partition, permute: the matrix row says how often each shard number occurs;
4. exchange the rows;
5. permute again within each shard. A shard may be larger than any task, so its rows get
   64-bit random keys and go to buckets of key ranges; a row's slot is the number of rows in
   the buckets before it plus its rank by key in its own.

Shard sizes are exact: row counts differ by one at most. Steps 3 and 5 draw from the seed and
the partition's number, so a task that runs again repeats its draws.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paidpath.llm.tables import partitions_for

BUCKET_ROWS = 4096


def communication_matrix(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Rows: partitions with ``counts`` rows; columns: shards, whose sums differ by one at most."""
    total = int(counts.sum())
    left = np.full(shards, total // shards, np.int64)
    left[: total % shards] += 1
    rng = np.random.default_rng([seed, shards])
    out = np.zeros((len(counts), shards), np.int64)
    for p, n in enumerate(counts):
        # the rows yet to be placed are an urn with `left` places of each shard's colour
        rest = int(n)
        pool = int(left.sum())
        for s in range(shards):
            pool -= int(left[s])
            out[p, s] = _draw(rng, int(left[s]), pool, rest)
            rest -= out[p, s]
        left -= out[p]
    return out


URN = 10**9  # the generator's limit for one urn


def _draw(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` balls drawn without replacement are among the ``good``.

    Larger urns than the generator takes are halved. Think of all balls with independent
    uniform marks, of which the n smallest are drawn: the middle good ball's mark follows a
    beta law, and the bad balls below it a binomial one. Either all balls up to that mark are
    drawn, and the rest come from above it, or all drawn ones lie below it. A step leaves
    about half of the urn, so a draw takes as many steps as the urn has doublings."""
    taken = 0
    while n and good and good + bad >= URN:
        if good < bad:  # halve the larger part
            return taken + n - _draw(rng, bad, good, n)
        middle = (good + 1) // 2
        below = int(rng.binomial(bad, rng.beta(middle, good - middle + 1))) if bad else 0
        if middle + below <= n:
            taken, n = taken + middle, n - middle - below
            good, bad = good - middle, bad - below
        else:
            good, bad = middle - 1, below
    if not n or not good:
        return taken
    return taken + int(rng.hypergeometric(good, bad, n))


def partition_draws(row: np.ndarray, partition: int, buckets: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The local permutation of one partition: each row's shard, and its random key."""
    rng = np.random.default_rng([seed, 1, partition])
    return rng.permutation(np.repeat(np.arange(len(row), dtype=np.int32), row)), rng.integers(0, 2**62, int(row.sum()))


def _bucket(shard: np.ndarray, key: np.ndarray, buckets: int) -> np.ndarray:
    return shard.astype(np.int64) * buckets + np.minimum((key.astype(np.float64) * (buckets / 2**62)).astype(np.int64), buckets - 1)


def shuffled(docs: DataFrame, shards: int = 16, seed: int = 20240229) -> DataFrame:
    """``docs`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    ``docs`` must give the same rows in the same partitions whenever it is read, as a table
    scan does; a row count that changed meanwhile raises. Every row counts on its own: nulls,
    empty texts and repeated rows are dealt out like any other. An empty table gives none.
    Columns of ``docs`` named shard or slot are replaced."""
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    names = docs.columns
    docs = docs.toDF(*[f"c{k}" for k in range(len(names))])  # no name clashes
    found = docs.groupBy(F.spark_partition_id().alias("p")).count().collect()
    counts = np.zeros(max((r["p"] for r in found), default=-1) + 1, np.int64)
    for r in found:
        counts[r["p"]] = r["count"]
    matrix = communication_matrix(counts, shards, seed)
    buckets = partitions_for(int(counts.sum()), shards * BUCKET_ROWS)
    told = spark.sparkContext.broadcast(matrix)
    columns = docs.columns

    def deal(batches):
        p, at = TaskContext.get().partitionId(), 0
        row = told.value[p] if p < len(told.value) else np.zeros(shards, np.int64)
        shard, key = partition_draws(row, p, buckets, seed)
        bucket = _bucket(shard, key, buckets)
        for batch in batches:
            to = at + batch.num_rows
            if to > len(shard):
                break
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard[at:to]), pa.array(bucket[at:to]), pa.array(key[at:to])],
                                             names=[*columns, "shard", "_bucket", "_key"])
            at = to
        if at != len(shard):
            raise RuntimeError(f"partition {p} changed since its rows were counted")

    def count(batches):
        for batch in batches:
            for p in batch.column("id").to_pylist():
                total = np.bincount(_bucket(*partition_draws(told.value[p], p, buckets, seed), buckets), minlength=0)
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["_bucket", "n"])

    extra = [T.StructField("shard", T.IntegerType()), T.StructField("_bucket", T.LongType()), T.StructField("_key", T.LongType())]
    rows = docs.mapInArrow(deal, T.StructType([*docs.schema.fields, *extra]))
    sizes = (spark.range(len(counts)).mapInArrow(count, "_bucket long, n long").groupBy("_bucket").agg(F.sum("n").alias("n")))
    before = Window.partitionBy(F.floor(F.col("_bucket") / buckets)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key"))
    return (rows.join(offsets, "_bucket").withColumn("slot", (F.col("_before") + rank - 1).cast("long"))
            .select(*columns, "shard", "slot").toDF(*names, "shard", "slot"))

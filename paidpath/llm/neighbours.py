"""Approximate nearest neighbours (operator 4) over balanced posting lists.

* Centroids come from a bounded sample, by splitting it again and again until no cluster
  holds more than its share, so lists are about equally long.
* A vector goes to its nearest centroid's list. A boundary vector, which other centroids are
  almost as near to, is replicated to their lists too, unless a chosen centroid is nearer to
  the other centroid than the vector is.
* Centroids are searched by best-first search in a neighbour graph that every task holds.
* A query reads the lists whose centroids are at most a ratio farther than its nearest.
* The vectors of those lists are compared with the query by exact cosine. A list too long
  for one task, such as one with many copies of a vector, is compared in blocks.

The sample only shapes the lists: every vector is in at least one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidpath.llm.tables import written

LIST_ROWS = 512  # vectors of a list, on average
MOST_LISTS = 4096  # bounds the index that is broadcast
SAMPLE = 20_000  # vectors that the centroids are fitted to
DEGREE, LONG_LINKS = 16, 4  # links of a centroid: nearest ones, and random ones
BEAM = 64
NEAR, REPLICAS = 1.10, 4  # distance ratio and number of lists of a vector
RATIO = 1.30  # distance ratio of a query's lists
BLOCK = 2048  # vectors or queries that one comparison takes


def split_centroids(x: np.ndarray, share: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Unit centroids of clusters of at most ``share`` rows (copies of one vector excepted)."""
    mean = x.mean(0)
    mean = mean / n if (n := np.linalg.norm(mean)) > 1e-12 else x[0]
    if len(x) <= share:
        return [mean]
    k = min(8, -(-len(x) // share))
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(10):
        group = (x @ centres.T).argmax(1)
        for i in range(k):
            own = x[group == i]
            total = own.sum(0) if len(own) else x[rng.integers(len(x))]
            centres[i] = total / n if (n := np.linalg.norm(total)) > 1e-12 else x[0]
    group = (x @ centres.T).argmax(1)
    if np.bincount(group).max() == len(x):
        if (x == x[0]).all():
            return [mean]
        group = np.argsort(np.argsort(x @ (x[rng.integers(len(x))] - mean), kind="stable"), kind="stable") * k // len(x)
    return [c for i in range(k) if (group == i).any() for c in split_centroids(x[group == i], share, rng)]


class CentroidGraph:
    """Centroids with links to near and to some random others."""

    def __init__(self, centroids: np.ndarray, seed: int = 7):
        self.centroids = centroids.astype(np.float32)
        n, rng = len(centroids), np.random.default_rng(seed)
        near = min(DEGREE, n - 1)
        links = []
        for i in range(0, n, 512):
            dots = self.centroids[i:i + 512] @ self.centroids.T
            dots[np.arange(len(dots)), np.arange(i, i + len(dots))] = -np.inf
            links.append(np.argpartition(-dots, near - 1, 1)[:, :near] if near else np.zeros((len(dots), 0), np.int64))
        ring = (np.arange(n)[:, None] + 1) % n  # so that every centroid can be reached
        self.links = np.concatenate([np.concatenate(links), rng.integers(0, n, (n, LONG_LINKS)), ring], 1).astype(np.int32)
        self.entries = np.unique(rng.integers(0, n, 8))

    def search(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """For each unit vector the ``beam`` nearest centroids found (fewer: -1) and their
        distances, nearest first: all rows expand their best open centroid in step."""
        n, rows = len(self.centroids), np.arange(len(x))
        beam = min(beam, n)
        ids = np.full((len(x), beam), -1)
        dots = np.full((len(x), beam), -np.inf, np.float32)
        done = np.zeros((len(x), beam), bool)
        seen = np.zeros((len(x), n), bool)

        def offer(who: np.ndarray, found: np.ndarray) -> None:
            fresh = ~seen[who[:, None], found]
            # a centroid linked twice counts once
            order = np.argsort(found, 1, kind="stable")
            sorted_ = np.take_along_axis(found, order, 1)
            twice = np.zeros_like(fresh)
            np.put_along_axis(twice, order[:, 1:], sorted_[:, 1:] == sorted_[:, :-1], 1)
            fresh &= ~twice
            value = np.where(fresh, np.einsum("ij,ikj->ik", x[who], self.centroids[found]), -np.inf)
            seen[who[:, None], found] = True
            every = np.concatenate([dots[who], value], 1)
            top = np.argsort(-every, 1, kind="stable")[:, :beam]
            dots[who] = np.take_along_axis(every, top, 1)
            ids[who] = np.where(np.isinf(dots[who]), -1, np.take_along_axis(np.concatenate([ids[who], found], 1), top, 1))
            done[who] = np.take_along_axis(np.concatenate([done[who], np.zeros(found.shape, bool)], 1), top, 1)

        offer(rows, np.tile(self.entries, (len(x), 1)))
        live = rows
        while len(live):
            best = np.where(done[live] | (ids[live] < 0), -np.inf, dots[live]).argmax(1)
            open_ = ~done[live, best] & (ids[live, best] >= 0)
            live, best = live[open_], best[open_]
            if not len(live):
                break
            done[live, best] = True
            offer(live, self.links[ids[live, best]])
        return ids, np.sqrt(np.maximum(0, 2 - 2 * dots.astype(float)))

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every vector's lists."""
        ids, far = self.search(x, 16)
        chosen = [np.zeros(len(x), bool) for _ in range(ids.shape[1])]
        count = np.zeros(len(x), np.int64)
        for j in range(ids.shape[1]):
            good = (ids[:, j] >= 0) & (far[:, j] <= NEAR * far[:, 0] + 1e-9) & (count < REPLICAS)
            for i in range(j):
                near = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", self.centroids[ids[:, i]], self.centroids[ids[:, j]])))
                good &= ~(chosen[i] & (near < far[:, j]))
            chosen[j] = good if j else np.ones(len(x), bool)
            count += chosen[j]
        return (np.concatenate([np.flatnonzero(c) for c in chosen]),
                np.concatenate([ids[c, j] for j, c in enumerate(chosen)]))


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("v", lambda e: e != 0))
    return rows


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), d)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors give equal values wherever they are compared."""
    q, x = q / np.abs(q).max(1, keepdims=True), x / np.abs(x).max(1, keepdims=True)
    dot = lambda a, b: np.einsum("ij,ij->i", a, b)
    return dot(q, x) / (np.sqrt(dot(q, q)) * np.sqrt(dot(x, x)))


def best_in_block(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, vector, cosine) of each query's ``k`` best vec_ids in a block, each with its
    best row, ties to smaller ids."""
    out: list[tuple[np.ndarray, ...]] = []
    order = np.argsort(x_ids, kind="stable")
    x_ids, x = x_ids[order], x[order]
    heads = np.flatnonzero(np.concatenate([[True], x_ids[1:] != x_ids[:-1]]))
    unit_q, unit_x = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (q / np.abs(q).max(1, keepdims=True), x / np.abs(x).max(1, keepdims=True)))
    for i in range(0, len(q), 64):
        rough = unit_q[i:i + 64] @ unit_x.T
        rough[q_ids[i:i + 64, None] == x_ids[None, :]] = -np.inf
        each = np.maximum.reduceat(rough, heads, axis=1) if len(heads) < len(x_ids) else rough
        least = np.partition(each, -k, 1)[:, -k] if len(heads) > k else np.full(len(rough), -2.0)
        a, b = np.nonzero(rough >= np.maximum(least, -2.0)[:, None] - 1e-9)
        exact = cosines(q[i + a], x[b])
        order = np.lexsort((x_ids[b], -exact, a))
        a, b, exact = a[order], b[order], exact[order]
        once = np.sort(np.unique(a * len(x_ids) + np.searchsorted(x_ids, x_ids[b]), return_index=True)[1])
        a, b, exact = a[once], b[once], exact[once]
        first = np.searchsorted(a, a)
        top = np.arange(len(a)) - first < k
        out.append((q_ids[i + a[top]], x_ids[b[top]], exact[top]))
    return tuple(np.concatenate(z) for z in zip(*out, strict=True))


def nearest(vectors: DataFrame, is_query: Column | None = None, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            ratio: float = RATIO) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` nearest of all other rows
    by cosine, nearest first, ties to the smaller vec_id; all of them if there are fewer.

    ``is_query``: a condition on vec_id (default: divisible by 50). Vectors that are null,
    empty, all zero or hold a null or non-finite component take no part, nor do rows without
    vec_id or with another length than most rows have (of equals the longer). Rows that
    repeat a vec_id count once, with their best score; a query's own id is never its
    neighbour. An empty table gives an empty result."""
    spark = vectors.sparkSession
    is_query = F.col("vec_id") % 50 == 0 if is_query is None else is_query
    schema = "query_id long, rank int, vec_id long, score double"
    rows = _usable(vectors, id_col, vec_col)
    sizes = sorted((r["count"], r["d"]) for r in rows.groupBy(F.size("v").alias("d")).count().collect())
    if not sizes:
        return spark.createDataFrame([], schema)
    d = sizes[-1][1]
    rows = written(rows.where(F.size("v") == d).distinct(), "vectors")
    n = rows.count()
    some = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(min(1.0, SAMPLE / n) * (1 << 20))).select("v").toArrow().column("v")
    sample = _unit(_matrix(some.combine_chunks(), d)) if len(some) else _unit(_matrix(rows.select("v").limit(1).toArrow().column("v").combine_chunks(), d))
    lists = min(MOST_LISTS, max(1, n // LIST_ROWS))
    graph = CentroidGraph(np.array(split_centroids(sample, max(1, len(sample) // lists), np.random.default_rng(11))))
    told = spark.sparkContext.broadcast(graph)

    def post(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                row, to = told.value.lists(_unit(_matrix(part.column("v"), d)))
                part = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int64)), part.column("vec_id"), part.column("v")], names=["list", "vec_id", "v"])

    postings = written(rows.mapInArrow(post, "list long, vec_id long, v array<double>"), "postings")
    held = np.zeros(len(graph.centroids), np.int64)
    # every vec_id counts in one of its lists, however many rows and lists it has
    for r in postings.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count().collect():
        held[r["list"]] = r["count"]
    lengths = spark.sparkContext.broadcast(held)
    enough = REPLICAS * (k + 1)

    def probe(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                ids, far = told.value.search(_unit(_matrix(part.column("v"), d)))
                before = np.cumsum(np.where(ids >= 0, lengths.value[ids], 0), 1) - np.where(ids >= 0, lengths.value[ids], 0)
                row, at = np.nonzero((ids >= 0) & ((far <= ratio * far[:, :1] + 1e-9) | (before < enough)))
                part = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(ids[row, at].astype(np.int64)), part.column("vec_id"), part.column("v")], names=["list", "vec_id", "v"])

    probes = written(rows.where(is_query).dropDuplicates(["vec_id"]).mapInArrow(probe, "list long, vec_id long, v array<double>"), "probes")
    asked = probes.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("nq"))
    blocks = (postings.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("nb")).join(asked, "list"))
    salt = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.col(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = probes.join(blocks, "list").withColumn("q", salt("nq")).withColumn("b", upto("nb")).select("list", "b", "q", "vec_id", "v")
    right = postings.join(blocks, "list").withColumn("b", salt("nb")).withColumn("q", upto("nq")).select("list", "b", "q", "vec_id", "v")

    def compare(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if queries.num_rows and candidates.num_rows:
            one = lambda t: (t.column("vec_id").to_numpy(), _matrix(t.column("v").combine_chunks(), d))
            out = best_in_block(*one(queries), *one(candidates), k)
        return pa.table({"query_id": out[0], "vec_id": out[1], "score": out[2]})

    key = ("list", "b", "q")
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(compare, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

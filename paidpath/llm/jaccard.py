"""N-gram Jaccard join (operator 5): a size-aware heavy-light join.

A document's set holds the distinct ``n``-word shingles of its whole text. Two documents link
when 100 * |A and B| >= percent * |A or B|. Of a set of size s, a partner holds at least
need(s) = ceil(percent * s / 100) shingles, so all but s - need(s) of them.

* All sets are put in one order of shingles. Any order gives the same links; the one used
  sends shingles that are frequent in a sample of the documents to the end, so that widely
  shared passages rarely produce candidates.
* Small sets: the first two shingles that a pair has in common lie among the first
  s - need(s) + 2 of both. Every 2-subset of those is enumerated as one key.
* Large sets: the first common shingle lies among the first s - need(s) + 1. Inverted lists
  of those are scanned. Small sets close enough in size to a large one are listed too.
* The boundary between small and large is the size with the least estimated cost, from the
  sample's size histogram and its list lengths.
* Candidates of a list are not expanded into all pairs. Two rounds compare members with one
  centre each; links found there merge components. Only lists that hold more than one
  component afterwards are looked into.
* Of long ones, members go whose shingles are too seldom shared: an overlap has no shingle
  that stands in one set only. The others are compared with the centre that shares most of
  its own, next to which the members of a family of near copies stand.
* What is still open is compared pair by pair in short lists, in blocks in long ones. Before
  the sets of a pair are sent, it must pass an upper bound on its overlap from counts of
  shingles by cell. Where most pairs of two blocks pass it, the blocks' sets meet, and the
  overlaps are products of 0/1 matrices.
* Equal sets are one class from the start, and copies are never paired.

The order, boundary, bitmap and cells only change the work, never the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paidpath.llm.components import components
from paidpath.llm.tables import BitFilter, frugal, written
from paidpath.llm.words import SPACED, U, list_array, mix, run_hashes, span_hashes, spans, text_chunks

ORDER_BITS = 1 << 23  # slots of the bitmap of frequent shingles: 1 MB
SAMPLE_ONE_IN = 16  # of the documents, for the order and the boundary
FREQUENT = 4  # documents of the sample
KEYS_A_TASK = 100  # pairs of one centre that one task compares
LONG_LIST = 48  # members in more than one component
BLOCK = 256  # members of a long list that a task compares with as many
WHOLE_SET, PART = 256, 4  # shingles of a set that are all counted; of larger sets, one in PART at least
PAIRS_A_MEMBER = 4  # of two such blocks that may link; with more, their sets meet


def shingle_sets(data: np.ndarray, docs: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    starts, ends, first = spans(data, docs, SPACED)
    words = span_hashes(data, starts, ends)
    out = []
    for i in range(len(docs) - 1):
        own = words[first[i]:first[i + 1]]
        out.append(np.unique(run_hashes(own, min(n, len(own)) if len(own) else n)))
    return out


def class_key(s: np.ndarray) -> int:
    """A 64-bit name of a whole set."""
    with np.errstate(over="ignore"):
        total = mix(np.array([np.sum(mix(s ^ U(0x5851F42D4C957F2D)), dtype=np.uint64) + U(len(s))], np.uint64))
    return int(total.view(np.int64)[0])


def missing(size: np.ndarray | int, percent: int):
    """How many shingles of a set of this size a partner may lack."""
    return size - (percent * size + 99) // 100


def cells_of(s: np.ndarray) -> bytes:
    """Counts of shingles by hash cell, capped at 255 (a capped cell bounds nothing)."""
    n = 1 << max(3, min(12, int(len(s)).bit_length() - 2))
    return np.minimum(np.bincount((s >> U(52)).astype(np.int64) >> (12 - (n.bit_length() - 1)), minlength=n), 255).astype(np.uint8).tobytes()


def may_link(x: bytes, y: bytes, nx: int, ny: int, percent: int) -> bool:
    """False only if the counts by cell prove that the overlap is too small."""
    a, b = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    if (a == 255).any() or (b == 255).any():
        return True
    if len(a) < len(b):
        a, b = b, a
    most = int(np.minimum(a.reshape(len(b), -1).sum(1), b).sum())
    return (100 + percent) * most >= percent * (nx + ny)


def prefix_keys(s: np.ndarray, frequent: np.ndarray, percent: int, boundary: int) -> np.ndarray:
    """The keys under which a set looks for partners."""
    size = len(s)
    if size < 2:  # a single shingle has no partner but its equals
        return np.zeros(0, np.uint64)
    late = (frequent[(s & U(ORDER_BITS - 1)).astype(np.int64) >> 3] >> (s & U(7)).astype(np.uint8)) & 1
    ordered = s[np.lexsort((s, late))]
    spare, keys = missing(size, percent), []
    if size <= boundary:
        head = ordered[:spare + 2]
        i, j = np.triu_indices(len(head), 1)
        low, high = np.minimum(head[i], head[j]), np.maximum(head[i], head[j])
        keys.append(mix(low * U(3) + mix(high) + U(2)))
    if 100 * size > percent * boundary:  # may link with a set above the boundary, or is one
        keys.append(mix(ordered[:spare + 1] + U(1)))
    return np.concatenate(keys)


def _sample(docs: DataFrame, n: int) -> tuple[np.ndarray, dict[int, int], float]:
    """The bitmap of frequent shingles, the sizes' histogram and the mean chance partners
    of a shingle, from one document in SAMPLE_ONE_IN."""
    def explode(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(0)):
                sets = shingle_sets(data, offsets, n)
                sizes = np.array([len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([
                    list_array(pa.array(np.concatenate(sets).view(np.int64)), np.concatenate([[0], np.cumsum(sizes)])),
                    pa.array(sizes, pa.int32())], names=["s", "size"])

    some = (docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_ONE_IN)) == 0).select("text")
            .mapInArrow(frugal(explode), "s array<long>, size int"))
    some = written(some, "sampled")
    # one pass for the bitmap of frequent shingles and, in the row without a bucket, the sums of rare ones
    often = F.col("count") >= FREQUENT
    counts = (some.select(F.explode("s").alias("s")).groupBy("s").count()
              .select(F.when(often, F.col("s").bitwiseAND(ORDER_BITS - 1) + 1).alias("s"), F.when(~often, F.col("count")).alias("c")))
    rows = (counts.groupBy(F.expr("bitmap_bucket_number(s)").alias("b"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(s))").alias("m"), F.sum(F.col("c") * F.col("c")).alias("q"), F.sum("c").alias("c")).collect())
    frequent, rare = np.zeros(ORDER_BITS // 8, np.uint8), {"q": 0, "c": 0}
    for r in rows:
        if r["b"] is None:
            rare = r
        else:
            frequent[(r["b"] - 1) * 4096:r["b"] * 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    # sizes by powers of two, so that at most 64 rows come back
    sizes = {1 << int(r["p"]): r["count"] for r in some.where("size > 1").groupBy(F.floor(F.log2("size")).alias("p")).count().collect()}
    partners = max(0.0, (rare["q"] or 0) / max(1, rare["c"] or 0) - 1) * SAMPLE_ONE_IN
    return frequent, sizes, partners


def boundary_by_cost(sizes: dict[int, int], partners: float, percent: int) -> int:
    """The largest size that counts as small: a 2-subset costs a key, a list entry costs a
    key and the expected chance partners that share it. Of equal costs the smaller size."""
    def cost(boundary: int) -> float:
        total = 0.0
        for size, count in sizes.items():
            size = size * 3 // 2
            spare = missing(size, percent)
            if size <= boundary:
                total += count * (spare + 2) * (spare + 1) / 2
            if 100 * size > percent * boundary:
                total += count * (spare + 1) * (1 + partners)
        return total
    return min([0, *(1 << p for p in range(2, 12))], key=lambda x: (cost(x), x))


def _described(docs: DataFrame, n: int, percent: int, frequent, boundary: int) -> DataFrame:
    """A row for each document: size, class, keys and cell counts of its set."""
    def describe(batches):
        bitmap = frequent.value
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column("text")):
                sets = shingle_sets(data, offsets, n)
                keys = [prefix_keys(s, bitmap, percent, boundary) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_key(s) if len(s) else None for s in sets], pa.int64()),
                    list_array(pa.array(np.concatenate(keys).view(np.int64)), np.concatenate([[0], np.cumsum([len(k) for k in keys])])),
                    pa.array([cells_of(s) for s in sets], pa.binary())], names=["doc_id", "size", "cls", "keys", "cells"])

    return docs.select("doc_id", "text").mapInArrow(
        frugal(describe), "doc_id long, size long, cls long, keys array<long>, cells binary")


def _first_documents(described: DataFrame) -> BitFilter:
    """The documents that stand for their classes, so that copies do not repeat their keys."""
    return BitFilter(described.where("size > 1 AND doc_id IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("doc_id")), "doc_id")


def _keys(described: DataFrame, firsts: BitFilter, shared: BitFilter | None = None) -> DataFrame:
    """The keys of each class, from one document of each as far as a bitmap tells: all, or
    ``key, cls, size`` of those that more than one document may have."""
    spark = described.sparkSession
    told, among = spark.sparkContext.broadcast(firsts), shared and spark.sparkContext.broadcast(shared)

    def keep(batches):
        for batch in batches:
            batch = batch.filter(pa.array(told.value.has(np.asarray(batch.column("slot")))))
            keys = batch.column("keys")
            if among is None:
                yield pa.RecordBatch.from_arrays([keys.flatten()], names=["key"])
                continue
            lengths = np.asarray(keys.value_lengths())
            every = keys.flatten()
            good = among.value.has_hash(np.asarray(every).view(np.uint64))
            owner = pa.array(np.repeat(np.arange(len(lengths)), lengths)[good])
            yield pa.RecordBatch.from_arrays([every.filter(pa.array(good)), batch.column("cls").take(owner),
                                              batch.column("size").take(owner)], names=["key", "cls", "size"])

    rows = described.where("size > 1 AND doc_id IS NOT NULL").withColumn("slot", firsts.slot("doc_id"))
    if shared is None:
        return rows.select("keys", "slot").mapInArrow(frugal(keep), "key long")
    return rows.select("cls", "size", "keys", "slot").mapInArrow(frugal(keep), "key long, cls long, size long")


def _of_classes(docs: DataFrame, some: BitFilter, n: int, rows, kind: str) -> DataFrame:
    """``rows`` of the lists of sets of the documents in ``some``. Texts are not shuffled: a
    bitmap of the documents goes to where the texts are."""
    told = docs.sparkSession.sparkContext.broadcast(some)

    def whole(batches):
        for batch in batches:
            batch = batch.filter(pa.array(told.value.has(np.asarray(batch.column("slot")))))
            for _, _, data, offsets in text_chunks(batch.column("text")):
                yield rows(shingle_sets(data, offsets, n))

    return (docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("text", some.slot("doc_id").alias("slot"))
            .mapInArrow(frugal(whole), kind))


def _sets_of(docs: DataFrame, holders: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """``cls, shingles`` of ``classes``, from one document of each."""
    def whole(sets):
        return pa.RecordBatch.from_arrays([pa.array([class_key(s) for s in sets], pa.int64()),
                                           pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "shingles"])

    some = BitFilter(holders.join(classes, "cls", "left_semi"), "doc_id")
    return written(_of_classes(docs, some, n, whole, "cls long, shingles binary"), "sets")


def looked_at(s: np.ndarray, size: int) -> np.ndarray:
    """Which shingles are counted of a set of this size: all of a small one, a quarter at
    least of a large one, of the same part of the hashes. A larger set counts no others."""
    return s >> U(56) < U(max(256 // PART, min(256, 256 * WHOLE_SET // max(1, size))))


def _shared_shingles(docs: DataFrame, holders: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """``cls, shared``: of each of ``classes``, at least as many shingles as it has in common
    with all the others together that are close enough in size. No overlap with one of them
    is larger. Documents given again count as others, which only raises the number."""
    some = BitFilter(holders.join(classes, "cls", "left_semi"), "doc_id")
    least = U((1 << 40) - 1)  # of a hash; alike ones only raise the number

    def each(sets):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([s[looked_at(s, len(s))] for s in sets]) & least).cast(pa.int64())], names=["s"])

    often = _of_classes(docs, some, n, each, "s long").groupBy("s").count().where("count > 1")
    among = docs.sparkSession.sparkContext.broadcast(BitFilter(often, "s", hashed=True))

    def count(sets):
        # only shingles that the largest partner would count too
        lone = [int((~among.value.has_hash(s[looked_at(s, 100 * len(s) // percent)])).sum()) for s in sets]
        return pa.RecordBatch.from_arrays([pa.array([class_key(s) for s in sets], pa.int64()),
                                           pa.array([len(s) - x for s, x in zip(sets, lone, strict=True)], pa.int64())], names=["cls", "shared"])

    return written(_of_classes(docs, some, n, count, "cls long, shared long").groupBy("cls").agg(F.max("shared").alias("shared")), "shared")


def _with_partners(members: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Those ``members`` (key, cls, size, comp) of lists that may link with a member of their
    list, with ``own``, the share of their shingles that no other class has. An overlap t of
    sets of x and y shingles links them if (100 + percent) * t >= percent * (x + y), so
    a set has partners only up to a size."""
    sizes = members.groupBy("key").agg(F.collect_set("size").alias("sizes"))
    fits = "x -> %d * (size + x) <= %d * shared AND 100 * x >= %d * size" % (percent, 100 + percent, percent)
    return (members.join(shared, "cls", "left").withColumn("shared", F.coalesce("shared", "size")).join(sizes, "key")
            .where(F.expr(f"exists(sizes, {fits})")).select("key", "cls", "size", "comp", (1 - F.col("shared") / F.col("size")).alias("own")))


def _stars(ranked: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of members (key, cls, size, comp, rank) with the first by ``rank`` of one of their lists."""
    centres = ranked.groupBy("key").agg(F.min(F.struct("rank", "cls", "comp", "size")).alias("m")).select("key", "m.rank", *(
        F.col(f"m.{x}").alias(y) for x, y in (("cls", "c"), ("comp", "c_comp"), ("size", "c_size"))))
    return (ranked.drop("rank").join(centres, "key")
            .where("comp <> c_comp AND 100 * least(size, c_size) >= %d * greatest(size, c_size)" % percent)
            .groupBy(F.col("cls").alias("b")).agg(F.min(F.struct("rank", "c")).alias("m")).select(F.col("m.c").alias("a"), "b"))


def _verified(docs: DataFrame, holders: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """Those pairs ``a, b`` (classes) whose sets really link. Pairs are bounded by their
    cells first; only classes of pairs that pass have their sets built. A centre ``a`` with
    many partners is compared by many tasks."""
    a, b = (holders.select(F.col("cls").alias(x), F.col("size").alias("n" + x), F.col("cells").alias("c" + x)) for x in "ab")

    def bounded(batches):
        for batch in batches:
            x = batch.to_pydict()
            good = [may_link(*v, percent) for v in zip(x["ca"], x["cb"], x["na"], x["nb"], strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    likely = written(pairs.join(a, "a").join(b, "b").where("100 * least(na, nb) >= %d * greatest(na, nb)" % percent)
                     .select("a", "b", "na", "nb", "ca", "cb").mapInArrow(frugal(bounded), "a long, b long"), "likely")
    sets = _sets_of(docs, holders, likely.select(F.col("a").alias("cls")).union(likely.select("b")).distinct(), n)
    salts = likely.groupBy("a").agg(F.ceil(F.count("*") / KEYS_A_TASK).cast("long").alias("salts"))
    salted = F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt")
    members = (likely.join(salts, "a").select("a", "b", salted)
               .join(sets.select(F.col("cls").alias("b"), "shingles"), "b").select("a", "salt", "b", "shingles"))
    centres = (salts.select(F.col("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
               .join(sets.select(F.col("cls").alias("a"), "shingles"), "a")
               .select("a", "salt", F.lit(None).cast("long").alias("b"), "shingles"))

    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of at most KEYS_A_TASK or so members; the centre is the row without b
        centre, rest = None, []
        for batch in batches:
            for b, s in zip(batch.column("b").to_pylist(), batch.column("shingles"), strict=True):
                own = np.frombuffer(s.as_buffer(), np.uint64)
                if b is None:
                    centre = own
                else:
                    rest.append((b, own))
        good = []
        for b, own in rest:
            both = len(np.intersect1d(centre, own, assume_unique=True))
            if 100 * both >= percent * (len(centre) + len(own) - both):
                good.append(b)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()] * len(good), pa.int64()), pa.array(good, pa.int64())], names=["a", "b"])

    return members.union(centres).groupBy("a", "salt").applyInArrow(compare, "a long, b long")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections, by products of 0/1 matrices of bounded width."""
    every, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    wide = np.bincount(at, minlength=len(every)) > 1  # a shingle of one set adds to no overlap
    column = np.cumsum(wide) - 1
    row, column = row[wide[at]], column[at[wide[at]]]
    out = np.diag([float(len(s)) for s in sets]).astype(np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [lo, lo + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        out += part @ part.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what a symmetric matrix of links connects: one fewer than members."""
    left, out = np.ones(len(linked), bool), []
    for start in range(len(linked)):
        if not left[start]:
            continue
        left[start], todo = False, [start]
        while todo:
            u = todo.pop()
            near = np.flatnonzero(linked[u] & left)
            left[near] = False
            out += [(u, int(v)) for v in near]
            todo += near.tolist()
    return out


def likely_pairs(cells: list[bytes], size: np.ndarray, apart: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """``may_link`` for all pairs of some sets at once: the two members of each pair that may
    link, of the pairs that the symmetric matrix ``apart`` admits."""
    lengths = np.array([len(c) for c in cells])
    found = [np.zeros((2, 0), np.int64)]
    for few in np.unique(lengths):
        low = np.flatnonzero(lengths == few)
        x = np.frombuffer(b"".join(cells[u] for u in low), np.uint8).reshape(len(low), few).astype(np.int32)
        for many in np.unique(lengths[lengths >= few]):
            high = np.flatnonzero(lengths == many)
            near = apart[np.ix_(low, high)] & (100 * np.minimum(size[low][:, None], size[high]) >= percent * np.maximum(size[low][:, None], size[high]))
            if few == many:
                near &= low[:, None] < high
            if not near.any():
                continue
            y = np.frombuffer(b"".join(cells[v] for v in high), np.uint8).reshape(len(high), many)
            capped = (y == 255).any(1)
            y = y.reshape(len(high), few, -1).sum(2, dtype=np.int32)
            for r in np.flatnonzero(near.any(1)):
                to = np.flatnonzero(near[r])
                most = np.minimum(x[r], y[to]).sum(1, dtype=np.int64)
                good = high[to[((100 + percent) * most >= percent * (size[low[r]] + size[high[to]])) | capped[to] | (x[r] == 255).any()]]
                found.append(np.stack([np.full(len(good), low[r]), good]))
    u, v = np.concatenate(found, axis=1)
    return u, v


def _long_lists(docs: DataFrame, holders: DataFrame, members: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of the long lists ``members`` (key, cls, comp, size, n: the list's length): pairs
    ``a, b`` that have yet to be compared, and links.

    Members that share too few of their shingles go, and the others are compared with the one
    that shares most. Only lists that are still open then are dealt in blocks.

    Blocks of a list meet two by two, each pair of blocks in a task, with the counts by cell
    only, which are far smaller than the sets. Members of a list's largest component have
    blocks of their own, if they fill one; those meet the others' blocks, never each other. Pairs of different components that pass their
    bound are few as a rule. Where two blocks have more than PAIRS_A_MEMBER of them a member,
    the sets themselves meet, each once, and a spanning forest of the links comes back
    instead of pairs."""
    if not members.limit(1).count():
        return (members.select(F.col("cls").alias("a"), F.col("comp").alias("b")),) * 2
    shared = _shared_shingles(docs, holders, members.select("cls").distinct(), n, percent)
    likely = written(_with_partners(members, shared, percent), "partners")
    stars = written(_verified(docs, holders, _stars(likely.withColumnRenamed("own", "rank"), percent), n, percent), "links")
    members = _still_open(likely, [stars, members.select(F.col("cls").alias("a"), F.col("comp").alias("b")).distinct()])
    largest = members.groupBy("key", "comp").agg(F.count("*").alias("alike")).groupBy("key").agg(F.max(F.struct("alike", "comp")).alias("m"))
    largest = largest.select("key", F.when(F.col("m.alike") >= BLOCK, F.col("m.alike")).otherwise(0).alias("alike"), F.col("m.comp").alias("most"))
    alike = (F.col("alike") > 0) & (F.col("comp") == F.col("most"))
    blocks, more = F.ceil((F.col("n") - F.col("alike")) / BLOCK).cast("long"), F.ceil(F.col("alike") / BLOCK).cast("long")
    own = (members.join(largest, "key").select("key", "cls", "comp", blocks.alias("blocks"), more.alias("more"), alike.alias("alike"))
           .withColumn("x", F.when(F.col("alike"), F.col("blocks") + F.pmod(F.xxhash64("cls"), "more")).otherwise(F.pmod(F.xxhash64("cls"), "blocks")))
           .withColumn("meets", F.when(F.col("alike"), F.col("blocks")).otherwise(F.col("blocks") + F.col("more"))))
    met = own.select("key", "cls", "comp", "x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("meets") - 1)).alias("y"))
    met = met.select("key", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "cls", "comp", "x")

    def bound(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        cls, comp, side, size = (np.asarray(rows.column(c).combine_chunks()) for c in ("cls", "comp", "x", "size"))
        apart = comp[:, None] != comp
        if key[1].as_py() != key[2].as_py():  # pairs within a block have a task of their own
            apart &= side[:, None] != side
        u, v = likely_pairs(rows.column("cells").to_pylist(), size, apart, percent)
        a, b = np.minimum(cls[u], cls[v]), np.maximum(cls[u], cls[v])
        dense = len(a) > PAIRS_A_MEMBER * len(cls)
        a, b = (pa.nulls(1, pa.int64()),) * 2 if dense else (pa.array(a), pa.array(b))
        yield pa.RecordBatch.from_arrays([pa.array([k.as_py()] * len(a), pa.int64()) for k in key] + [a, b], names=["key", "i", "j", "a", "b"])

    bounded = written(met.join(holders.select("cls", "size", "cells"), "cls").groupBy("key", "i", "j")
                      .applyInArrow(bound, "key long, i long, j long, a long, b long"), "bounded")
    dense = met.join(bounded.where("a IS NULL").select("key", "i", "j"), ["key", "i", "j"]).select("key", "i", "j", "cls")
    sets = _sets_of(docs, holders, dense.select("cls").distinct(), n)

    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for batch in batches:
            for c, s in zip(batch.column("cls").to_pylist(), batch.column("shingles"), strict=True):
                found[c] = np.frombuffer(s.as_buffer(), np.uint64)
        names, own = list(found), list(found.values())
        both, size = overlaps(own), np.array([len(s) for s in own], float)
        links = forest(100 * both >= percent * (size[:, None] + size[None, :] - both))
        yield pa.RecordBatch.from_arrays([pa.array([names[u] for u, _ in links], pa.int64()), pa.array([names[v] for _, v in links], pa.int64())], names=["a", "b"])

    links = dense.join(sets, "cls").select("key", "i", "j", "cls", "shingles").groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")
    return bounded.where("a IS NOT NULL").select("a", "b"), links.union(stars)


def jaccard_classes(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
                    star_rounds: int = 2) -> DataFrame:
    """``doc_id, n_shingles, cls, component`` for every row of ``docs``.

    ``cls`` names the row's set (null for the empty set); ``component`` is the smallest class
    key linked with it, directly or not. Rows are documents: repeated rows and equal texts
    share a class. A set that only rows without doc_id have links with nothing else. Null and empty texts, and texts without a word, have the empty set, size
    0 and no class. An empty table gives an empty result. Other columns are not read."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    frequent, sizes, partners = _sample(docs, n)
    boundary = boundary_by_cost(sizes, partners, percent)
    described = written(_described(docs, n, percent, spark.sparkContext.broadcast(frequent), boundary), "described")

    firsts = _first_documents(described)
    repeated = _keys(described, firsts).groupBy("key").count().where("count > 1")
    kept = _keys(described, firsts, BitFilter(repeated, "key", hashed=True))
    lists = kept.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo < hi").select("key")
    members = written(kept.join(lists, "key").distinct(), "members")

    holders = written(described.where("cls IS NOT NULL AND doc_id IS NOT NULL").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("cells").alias("cells"))
        .join(members.select("cls").distinct(), "cls", "left_semi"), "holders")
    verify = lambda pairs: _verified(docs, holders, pairs, n, percent)

    def starred(lists: DataFrame, rank) -> DataFrame:
        """Links of members with the first by ``rank`` of one of their lists."""
        centres = lists.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), "cls", "comp", "size")).alias("m")).select(
            "key", F.col("m.rank").alias("rank"), F.col("m.cls").alias("c"), F.col("m.comp").alias("c_comp"), F.col("m.size").alias("c_size"))
        pairs = (lists.join(centres, "key")
                 .where("comp <> c_comp AND 100 * least(size, c_size) >= %d * greatest(size, c_size)" % percent)
                 .groupBy(F.col("cls").alias("b")).agg(F.min(F.struct("rank", "c")).alias("m")).select(F.col("m.c").alias("a"), "b"))
        return written(verify(pairs), "links")

    links, lists = [], members.select("key", "cls", "size", F.col("cls").alias("comp"), F.lit(LONG_LIST + 1).alias("n"))
    for turn in range(star_rounds):
        rank = F.xxhash64(F.col("comp") + F.lit(turn)) if turn else F.col("cls")
        links.append(written(verify(_stars(lists.withColumn("rank", rank), percent)), "links"))
        lists = _still_open(lists, links)
    x, y = (lists.where(f"n <= {LONG_LIST}").select("key", "cls", "size", "comp").toDF("key", z, f"n{z}", f"c{z}") for z in "ab")
    rest = (x.join(y, "key").where("a < b AND ca <> cb AND 100 * least(na, nb) >= %d * greatest(na, nb)" % percent)
            .select("a", "b"))
    more, within = _long_lists(docs, holders, lists.where(f"n > {LONG_LIST}"), n, percent)
    links.append(written(verify(rest.union(more).distinct()), "links"))
    links.append(written(within, "links"))
    comp = components(reduce(DataFrame.union, links))
    return (described.select("doc_id", "size", "cls").join(comp.withColumnRenamed("node", "cls"), "cls", "left")
            .select("doc_id", F.col("size").alias("n_shingles"), "cls", F.coalesce("component", "cls").alias("component")))


def _still_open(members: DataFrame, links: list[DataFrame]) -> DataFrame:
    """Members (key, cls, size) of lists that still hold more than one component, with their
    component ``comp`` and ``n``, the list's length."""
    comp = components(reduce(DataFrame.union, links)).select(F.col("node").alias("cls"), "component")
    now = members.select("key", "cls", "size").join(comp, "cls", "left").select("key", "cls", "size", F.coalesce("component", "cls").alias("comp"))
    mixed = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("key", "n")
    return written(now.join(mixed, "key").select("key", "cls", "size", "comp", "n"), "open")


def jaccard_components(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id, n_copies`` per row of ``docs``:
    component_id and class_id are the smallest doc_id of the linked documents and of the
    equal sets. A row without a set is alone; where no doc_id is known they are null."""
    rows = written(jaccard_classes(docs, n, percent), "classes")
    classes = rows.where("cls IS NOT NULL").groupBy("cls", "component").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("n_copies"))
    firsts = classes.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = classes.join(firsts, "component").select("cls", "class_id", "component_id", "n_copies")
    return rows.join(named, "cls", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (doc_id, text, others) with one row of each group of linked documents: that
    with the smallest doc_id. Rows are told apart by doc_id and set, so a doc_id that stands
    for different texts loses only those that are copies. Rows with the same doc_id and set
    are one document given again. Rows without a word or without doc_id stay. Texts of rows
    that surely stay are not shuffled. All columns are kept as they are."""
    names = docs.columns
    docs = docs.toDF(*[c if c in ("doc_id", "text") else f"c{k}" for k, c in enumerate(names)])  # no name clashes
    columns, kinds = docs.columns, docs.schema
    rows = written(jaccard_classes(docs, n, percent).where("doc_id IS NOT NULL AND cls IS NOT NULL")
                   .groupBy("doc_id", "cls", "component").agg(F.count("*").alias("times")), "near-copies")
    first = rows.groupBy("component").agg(F.min(F.struct("doc_id", "cls")).alias("first"))
    extra = written(rows.join(first, "component").select("doc_id", "cls", "times", (F.struct("doc_id", "cls") == F.col("first")).alias("kept"))
                    .where("NOT kept OR times > 1"), "extra")
    extra = extra.withColumnRenamed("doc_id", "id")
    some = BitFilter(extra, "id")
    told = docs.sparkSession.sparkContext.broadcast(some)

    def near(batches):
        for batch in batches:
            batch = batch.filter(pa.array(told.value.has(np.asarray(batch.column("slot")))))
            for i, j, data, offsets in text_chunks(batch.column("text")):
                sets = shingle_sets(data, offsets, n)
                keys = pa.array([class_key(s) if len(s) else None for s in sets], pa.int64())
                yield batch.select([*columns, "id"]).slice(i, j - i).append_column("cls", keys)

    def far(batches):
        for batch in batches:
            yield batch.filter(pa.array(~told.value.has(np.asarray(batch.column("slot"))))).select(columns)

    known = docs.where("doc_id IS NOT NULL").withColumn("id", F.col("doc_id").cast("long")).withColumn("slot", some.slot("id"))
    told_apart = known.mapInArrow(frugal(near), T.StructType([*kinds.fields, T.StructField("id", T.LongType()), T.StructField("cls", T.LongType())]))
    marked = told_apart.join(extra, ["id", "cls"], "left")
    stay = marked.where("kept IS NULL").select(columns)
    again = marked.where("kept").dropDuplicates(["id", "cls"]).select(columns)
    out = known.mapInArrow(frugal(far), kinds).unionByName(stay).unionByName(again).unionByName(docs.where("doc_id IS NULL"))
    return out.toDF(*names)

"""Ranked lexical search (operator 13): impact vectors in buckets of equal length.

Documents and items are vectors over terms. A document's coordinate is the impact of a term,
an integer computed from the term's weight, its occurrences and the document's length; an
item's is how often it holds the term. A score is their product, and every item wants the
documents of the ``k`` greatest.

* Only terms of items matter, so a document's vector holds those alone. One pass over the
  texts finds them; document frequencies and lengths are counted over all documents.
* Vectors are ordered by length (Euclidean norm) into buckets, by a range partitioning whose
  second key spreads equal vectors. The written buckets are searched in waves, the longest
  vectors first; a wave begins with the k-th best score of every item from the waves before.
* By Cauchy-Schwarz, a score is at most the product of the two norms. Buckets in which that
  is below every item's k-th best are not read, and neither is any after them; an item skips
  a part of a bucket by the same rule.
* Inside, coordinate bounds filter: the greatest impact of a term in the part bounds what the
  term can add. Terms whose bounds sum to less than the k-th best cannot make a document
  eligible alone, so only the other terms' lists are walked. What a walked document may still
  get is bounded by those sums and by the norms of what is left.
* Survivors are scored again over all their coordinates, in 64-bit integers.

Bounds are doubles with a margin, so they never lose a document; equal scores are kept. A
task holds one part of a bucket and ``k`` documents an item. Items are taken in blocks of
bounded size, each block with a pass of its own.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paidpath.llm.tables import bounded_batches, written
from paidpath.llm.words import ALNUM, list_array, ragged, span_hashes, spans, text_chunks

BEST = 20
BLOCK_BYTES = 8 << 20  # of items' texts that are searched together
WAVE = 8  # a wave holds this many times the buckets of the one before
MARGIN = 1 + 1e-9  # of bounds computed in doubles
SCALE, RISE, FLAT, SLOPE = 1_000_000_000, 1000, 12, 25  # impact = weight * (SCALE tf div (RISE tf + FLAT m))


class Items:
    """A block of items as sparse vectors over their common vocabulary."""

    def __init__(self, texts: list[str]):
        raw = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts, ends, first = spans(data, offsets, ALNUM)
        self.vocabulary, term = np.unique(span_hashes(data, starts, ends), return_inverse=True)
        own = np.repeat(np.arange(len(texts)), np.diff(first))
        both, times = np.unique(own * max(1, len(self.vocabulary)) + term, return_counts=True)
        owner = both // max(1, len(self.vocabulary))
        self.terms, self.times = both % max(1, len(self.vocabulary)), times.astype(np.int64)
        self.at = np.searchsorted(owner, np.arange(len(texts) + 1))

    def vectors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: number of its words; and where in the following its terms begin (one
        more at the end), the items' terms that it holds, and how often."""
        starts, ends, first = spans(data, offsets, ALNUM)
        hashes, size = span_hashes(data, starts, ends), len(self.vocabulary)
        term = np.minimum(np.searchsorted(self.vocabulary, hashes), size - 1)
        known = self.vocabulary[term] == hashes
        own = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        both, times = np.unique(own[known] * size + term[known], return_counts=True)
        return np.diff(first), np.searchsorted(both // size, np.arange(len(offsets))), both % size, times


class Weights:
    """A term's weight from its document frequency, and impacts."""

    def __init__(self, frequency: np.ndarray, documents: int, words: int):
        self.documents, self.words = documents, words
        self.weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * frequency + 1))).astype(np.int64)

    def impacts(self, n: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """``n``: words of the document of each coordinate."""
        m = 100 - SLOPE + (SLOPE * n * self.documents) // self.words
        return self.weights[terms] * ((SCALE * times) // (RISE * times + FLAT * m))


class Search:
    """One task's search: the ``k`` best documents so far of every item."""

    def __init__(self, items: Items, weights: Weights, bars: np.ndarray, k: int):
        self.items, self.weights, self.k = items, weights, k
        self.bars = bars.copy()  # scores below these are not among an item's k best
        self.norms = np.array([np.sqrt((items.times[a:b].astype(float) ** 2).sum()) for a, b in zip(items.at[:-1], items.at[1:], strict=True)])
        none = np.zeros(0, np.int64)
        self.best = [(none, none.astype(bool), none)] * len(bars)  # score, whether the id is null, id
        self.query = np.zeros(len(items.vocabulary), np.int64)

    def part(self, ids: np.ndarray, nulls: np.ndarray, norms: np.ndarray, lengths: np.ndarray, at: np.ndarray, terms: np.ndarray, times: np.ndarray) -> None:
        """Searches one part of a bucket: documents' ids, norms and numbers of words, and
        where each one's vector begins in ``terms`` and ``times`` (one more at the end)."""
        size = np.diff(at)
        doc = np.repeat(np.arange(len(norms)), size)
        impacts = self.weights.impacts(np.repeat(lengths, size), terms, times)
        by_term = np.argsort(terms, kind="stable")
        doc_of, impact_of = doc[by_term], impacts[by_term]
        lists = np.searchsorted(terms[by_term], np.arange(len(self.query) + 1))
        held = np.flatnonzero(np.diff(lists))
        peaks = np.zeros(len(self.query))
        if len(held):
            peaks[held] = np.maximum.reduceat(impact_of, lists[held])
        longest = norms.max(initial=0.0)
        for q in np.flatnonzero((self.norms > 0) & (self.norms * longest * MARGIN >= self.bars)):
            a, b = self.items.at[q], self.items.at[q + 1]
            own, times_ = self.items.terms[a:b], self.items.times[a:b]
            found = self._survivors(own, times_.astype(float), peaks, lists, doc_of, impact_of, norms, self.bars[q])
            if not len(found):
                continue
            self.query[own] = times_
            cells = ragged(at[found], size[found])
            exact = np.add.reduceat(self.query[terms[cells]] * impacts[cells], np.cumsum(size[found]) - size[found])
            self.query[own] = 0
            some = exact >= max(1, self.bars[q])
            self._keep(q, exact[some], nulls[found[some]], ids[found[some]])

    def _survivors(self, own, times, peaks, lists, doc_of, impact_of, norms, bar) -> np.ndarray:
        """The documents of a part that may reach ``bar``."""
        most = times * peaks[own]
        rank = np.argsort(most, kind="stable")
        rank = rank[most[rank] > 0]
        total = np.cumsum(most[rank])
        if not len(rank) or total[-1] * MARGIN < bar:
            return np.zeros(0, np.int64)
        light = int(np.searchsorted(total * MARGIN, bar, "left"))  # terms that cannot reach the bar without others
        walked = rank[light:]
        begin, n = lists[own[walked]], lists[own[walked] + 1] - lists[own[walked]]
        cells = ragged(begin, n)
        partial = np.bincount(doc_of[cells], weights=impact_of[cells] * np.repeat(times[walked], n), minlength=len(norms))
        rest = np.sqrt((times[rank[:light]] ** 2).sum()) * norms
        if light:
            rest = np.minimum(rest, total[light - 1])
        return np.flatnonzero((partial > 0) & ((partial + rest) * MARGIN >= bar))

    def _keep(self, q: int, *more: np.ndarray) -> None:
        scores, nulls, ids = (np.concatenate([a, b]) for a, b in zip(self.best[q], more, strict=True))
        first = np.lexsort((ids, nulls, -scores))[:self.k]
        self.best[q] = (scores[first], nulls[first], ids[first])
        if len(first) == self.k:
            self.bars[q] = max(self.bars[q], scores[first[-1]])


VECTORS = "doc_id long, n long, terms array<int>, times array<int>"


def _vectors(docs: DataFrame, items: Items) -> DataFrame:
    """Documents with at least one word, as vectors over the items' terms."""
    told = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column("text")):
                n, at, terms, times = told.value.vectors(data, offsets)
                lists = [list_array(pa.array(x, pa.int32()), at) for x in (terms, times)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(n), *lists],
                                                 names=["doc_id", "n", "terms", "times"]).filter(pa.array(n > 0))

    return docs.mapInArrow(run, VECTORS)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each document, where its vector begins, terms and times."""
    size = np.asarray(batch.column("terms").value_lengths()).astype(np.int64)
    flat = [np.asarray(batch.column(c).flatten()).astype(np.int64) for c in ("terms", "times")]
    return np.asarray(batch.column("n")), np.concatenate([[0], np.cumsum(size)]), *flat


def _ordered(vectors: DataFrame, weights: Weights) -> DataFrame:
    """The vectors by falling norm, in buckets: ``bucket`` 0 has the longest."""
    told = vectors.sparkSession.sparkContext.broadcast(weights)

    def measured(batches):
        for batch in batches:
            if batch.num_rows:
                n, at, terms, times = _flat(batch)
                impacts = told.value.impacts(np.repeat(n, np.diff(at)), terms, times).astype(float)
                yield batch.append_column("norm", pa.array(np.sqrt(np.add.reduceat(impacts ** 2, at[:-1]))))

    rows = vectors.where("size(terms) > 0").mapInArrow(measured, VECTORS + ", norm double").where("norm > 0")
    return (rows.repartitionByRange(F.desc("norm"), F.xxhash64("doc_id", "n"))
            .sortWithinPartitions(F.desc("norm")).withColumn("bucket", F.spark_partition_id()))


def _searched(buckets: DataFrame, items: Items, weights: Weights, bars: np.ndarray, k: int) -> DataFrame:
    """The ``k`` best documents of every item in each task's share of ``buckets``."""
    told = buckets.sparkSession.sparkContext.broadcast((items, weights, bars))

    def run(batches):
        search = Search(*told.value, k)
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("doc_id")
                search.part(np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(batch.column("norm")), *_flat(batch))
        held = [(q, *own) for q, own in enumerate(search.best) if len(own[0])]
        for i in range(0, len(held), 1000):
            part = held[i:i + 1000]
            scores, nulls, ids = (np.concatenate([h[c] for h in part]) for c in (1, 2, 3))
            number = np.repeat([h[0] for h in part], [len(h[1]) for h in part])
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(scores), pa.array(ids, mask=nulls)], names=["q", "score", "doc_id"])

    return buckets.mapInArrow(run, "q int, score long, doc_id long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of every item: highest score, then smallest doc_id, null ids last."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.select("q", "score", "doc_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(docs: DataFrame, rows: list, k: int) -> DataFrame | None:
    """The ranking of one block of items (id, text)."""
    spark, items = docs.sparkSession, Items([r["text"] for r in rows])
    if not len(items.vocabulary):
        return None
    vectors = written(_vectors(docs, items), "vectors")
    total = vectors.agg(F.count("*").alias("documents"), F.sum("n").alias("words")).first()
    if not total["documents"]:
        return None
    frequency = np.zeros(len(items.vocabulary), np.int64)
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        frequency[r["term"]] = r["count"]
    weights = Weights(frequency, total["documents"], total["words"])
    buckets = written(_ordered(vectors, weights), "buckets")
    longest = {r["bucket"]: r["norm"] for r in buckets.groupBy("bucket").agg(F.max("norm").alias("norm")).collect()}
    norms, bars, best = Search(items, weights, np.zeros(len(rows), np.int64), k).norms, np.zeros(len(rows), np.int64), None
    order, wave, i = sorted(longest), 1, 0
    while i < len(order):
        eligible = [b for b in order[i:i + wave] if (norms * longest[b] * MARGIN >= np.maximum(bars, 1)).any()]
        if not eligible:
            break  # and no later bucket is longer
        found = _searched(buckets.where(F.col("bucket").between(eligible[0], eligible[-1])), items, weights, bars, k)
        best = written(_best(found if best is None else best.select(found.columns).union(found), k), "best")
        for r in best.where(F.col("rank") == k).select("q", "score").toLocalIterator():
            bars[r["q"]] = r["score"]
        i, wave = i + wave, wave * WAVE
    if best is None:
        return None
    names = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(rows)], T.StructType([T.StructField("q", T.IntegerType()), T.StructField("item_id", T.LongType())]))
    return best.join(names, "q").select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents of every item
    with a score above 0 (all, if fewer); equal scores by ascending doc_id.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns take no part. Every row
    of ``docs`` is a document: repeated rows rank one after the other, and a null doc_id comes
    last among equal scores. A null text, and one without a word, is no document. Repeated
    rows of ``items`` count once; rows with one item_id and different texts are ranked each,
    and so is a null item_id. Items without a known word have no rows. Very long texts are
    taken whole. Without documents or items there is no result."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    results = []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        results.append(_block(docs, rows, k) if rows else None)
    results = [r for r in results if r is not None]
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, results)

"""Repeated passages by sparse suffix arrays (operator 7).

A passage repeats when the same ``length`` words (case and punctuation included, runs of
white space alike) stand at two places: in two documents, or twice in one. Rows with one
doc_id are one document given more than once.

1. Suffixes are retained only at content-selected positions: of every ``span`` consecutive
   positions, the one whose four-word run has the smallest hash (the leftmost of equals).
   Both copies of a passage select the same positions, whatever surrounds them.
2. Suffixes are sorted and compared by their first length - span + 1 words, which a repeat
   guarantees. A suffix without an equal neighbour is done with.
3. Left: each position p stands for the windows of ``length`` words that selected it, which
   start at a .. b with p - span < a <= b <= p. The outermost two are compared first. If
   the places of a suffix have no others than these two, all between is covered alike. If
   not, the windows between are compared as well, which extends the match to the left and
   right word by word.

So the results are exactly the union of all windows that occur twice, and the union of all
that occur at an earlier place. Groups of equal
suffixes are never expanded into pairs: each window is compared with its group's first
place, by sums that are combined before the shuffle. Bitmaps of fixed size only spare work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paidpath.llm.tables import BitFilter, frugal, written
from paidpath.llm.words import SPACED, list_array, long_run_hashes, ragged, run_hashes, span_hashes, spans, text_chunks

RUN = 4  # words of the run that selects a position


class Windows:
    """The windows and selected positions of a chunk of texts, by word number."""

    def __init__(self, data: np.ndarray, docs: np.ndarray, length: int, span: int):
        starts, ends, self.first = spans(data, docs, SPACED)
        words = span_hashes(data, starts, ends, lower=False)
        self.size = np.diff(self.first)
        self.hashes = long_run_hashes(words, length)
        doc = np.repeat(np.arange(len(self.size)), self.size)
        s = np.flatnonzero(np.arange(len(words)) + length <= self.first[1:][doc]) if len(words) else np.zeros(0, np.int64)
        if len(s):
            picks = np.lib.stride_tricks.sliding_window_view(run_hashes(words, RUN), span)[: s[-1] + 1].argmin(1)
            at = s + picks[s]
            turn = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            self.a, self.b = s[turn], s[np.concatenate([turn[1:], [len(s)]]) - 1]
            self.suffix = long_run_hashes(words, length - span + 1)[at[turn]]
        else:
            self.a = self.b = s
            self.suffix = np.zeros(0, np.uint64)
        self.doc = doc[self.a] if len(s) else s  # of each selected position
        self.count = np.bincount(self.doc, minlength=len(self.size))


def _places(ids: pa.Array, w: Windows, s: np.ndarray, picked: np.ndarray) -> pa.RecordBatch:
    """A row for each document and different window, of those that start at the words ``s``
    of a chunk and selected ``picked``; a text that repeats itself has them in one row."""
    order = np.lexsort((s, w.hashes[s], w.doc[picked]))
    s, doc = s[order], w.doc[picked][order]
    h = w.hashes[s]
    head = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])) if len(s) else s
    return pa.RecordBatch.from_arrays(
        [pa.array(h[head].view(np.int64)), ids.take(pa.array(doc[head])),
         list_array(pa.array((s - w.first[doc]).astype(np.int32)), np.append(head, len(s))),
         pa.array(w.suffix[picked[order][head]].view(np.int64))], names=["h", "doc_id", "s", "key"])


def _groups(places: DataFrame) -> DataFrame:
    """``h``, its first place, and whether there is any other."""
    at = F.struct("doc_id", F.col("s")[0].alias("s"))
    return (places.groupBy("h").agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.max(F.size("s")).alias("own"))
            .select("h", F.col("lo.doc_id").alias("first_doc"), F.col("lo.s").alias("first_s"), F.expr("lo < hi OR own > 1").alias("again")))


def _kind(df: DataFrame) -> str:
    """The type of documents' names: a number, or what orders as one."""
    return df.schema["doc_id"].dataType.simpleString()


def _judged(places: DataFrame) -> DataFrame:
    """The places whose window occurs elsewhere too, with the first place's document and
    whether this place is a later one. The groups are written first, so that the join has two
    plain shuffles, of which Spark splits large parts; windows that surely stand alone are
    not shuffled."""
    groups = written(_groups(places).where("again").drop("again"), "groups")
    some = BitFilter(groups, "h", hashed=True)
    told = places.sparkSession.sparkContext.broadcast(some)

    def maybe(batches):
        for batch in batches:
            yield batch.filter(pa.array(told.value.has_hash(np.asarray(batch.column("h")).view(np.uint64))))

    rows = places.select("h", "doc_id", "s").mapInArrow(frugal(maybe), f"h long, doc_id {_kind(places)}, s array<int>")
    return rows.join(groups, "h").select("doc_id", F.explode("s").alias("s"), "first_doc", "first_s").select(
        "doc_id", "s", "first_doc", F.expr("doc_id <> first_doc OR s <> first_s").alias("later"))


def repeated_windows(docs: DataFrame, length: int = 50, span: int = 26) -> DataFrame:
    """``doc_id, s, first_doc, later``: windows that repeat, by their first word's number,
    enough of them to cover every word of every repeated window. ``doc_id`` may be of any type
    that Spark can order; equal ones name one document."""
    if not RUN <= span or span + RUN - 1 > length:
        raise ValueError("span must leave room for the run within the length")
    spark = docs.sparkSession

    def suffixes(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column("text")):
                w = Windows(data, offsets, length, span)
                yield pa.RecordBatch.from_arrays([
                    list_array(pa.array(w.suffix.view(np.int64)), np.concatenate([[0], np.cumsum(w.count)])),
                    batch.column("doc_id").slice(i, j - i)], names=["keys", "doc_id"])

    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    keys = docs.mapInArrow(frugal(suffixes), f"keys array<long>, doc_id {_kind(docs)}").select(F.explode("keys").alias("key"))
    shared = BitFilter(keys.groupBy("key").count().where("count > 1"), "key", hashed=True)

    def windows_of(told, inner: bool):
        def emit(batches):
            for batch in batches:
                for i, j, data, offsets in text_chunks(batch.column("text")):
                    w = Windows(data, offsets, length, span)
                    good = np.flatnonzero(told.value.has_hash(w.suffix))
                    if inner:
                        n = np.maximum(0, w.b - w.a - 1)[good]
                        s, picked = ragged(w.a[good] + 1, n), np.repeat(good, n)
                    else:
                        two = good[w.a[good] < w.b[good]]
                        s, picked = np.concatenate([w.a[good], w.b[two]]), np.concatenate([good, two])
                    yield _places(batch.column("doc_id").slice(i, j - i), w, s, picked)
        return docs.mapInArrow(frugal(emit), f"h long, doc_id {_kind(docs)}, s array<int>, key long")

    outer = written(windows_of(spark.sparkContext.broadcast(shared), inner=False), "edges")
    # suffixes with more than two different outer windows: all their places are looked into, as
    # an equal of an inner window may stand between two that have no equal, or other first
    # places. With two at most, the places that have both are alike in all between, and what
    # is between repeats, or repeats an earlier place, only where the outer windows cover it
    several = outer.groupBy("key", "h").agg(F.lit(1)).groupBy("key").count().where("count > 2").select("key")
    odd = BitFilter(several, "key", hashed=True)
    middle = written(windows_of(spark.sparkContext.broadcast(odd), inner=True).drop("key"), "inner")
    # an inner window's equal may be an outer one elsewhere: all places are judged together
    return _judged(outer.drop("key").union(middle))


def repeated_spans(docs: DataFrame, length: int = 50, span: int = 26, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document with a repeated passage: ``doc_id``, ``spans`` and ``later``
    (arrays of start, end in words: all that repeats, and what repeats an earlier place, by
    doc_id and position), ``n_repeated``, ``n_later`` (words) and ``first_doc_ids`` (documents
    with the first places, itself included if it has one).

    Documents without one are not listed, nor are null ids, null or empty texts and texts of
    fewer than ``length`` words. Rows with one doc_id count once. Other columns are not read."""
    return _spans(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), length, span)


def _spans(docs: DataFrame, length: int, span: int) -> DataFrame:
    """``repeated_spans`` of documents with names of any type."""
    rows = repeated_windows(docs, length, span).groupBy("doc_id").agg(
        F.array_sort(F.collect_set(F.col("s") * 2 + F.col("later").cast("int"))).alias("w"),  # one number is a third of a struct
        F.array_sort(F.collect_set("first_doc")).alias("first_doc_ids"))

    def merge(starts: np.ndarray) -> list[dict]:
        cut = np.flatnonzero(np.concatenate([[True], starts[1:] > starts[:-1] + length])) if len(starts) else starts
        ends = starts[np.concatenate([cut[1:], [len(starts)]]) - 1] + length if len(starts) else starts
        return [{"start": int(a), "end": int(b)} for a, b in zip(starts[cut], ends, strict=True)]

    def join(batches):
        for batch in batches:
            every, later = [], []
            for w in batch.column("w"):
                coded = np.asarray(w.values)
                every.append(merge(coded >> 1))
                later.append(merge((coded >> 1)[coded & 1 > 0]))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            total = lambda x: pa.array([sum(v["end"] - v["start"] for v in y) for y in x], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(every, kind), pa.array(later, kind), total(every),
                                              total(later), batch.column("first_doc_ids")],
                                             names=["doc_id", "spans", "later", "n_repeated", "n_later", "first_doc_ids"])

    kind = "array<struct<start:int,end:int>>"
    return rows.mapInArrow(frugal(join), f"doc_id {_kind(docs)}, spans {kind}, later {kind}, n_repeated long, n_later long, first_doc_ids array<{_kind(docs)}>")


def cut_words(text: str, cuts: list[tuple[int, int]], admitted: np.ndarray = SPACED) -> str:
    """``text`` without the words of ``cuts`` (sorted spans of word numbers) and the
    separators after them."""
    data = np.frombuffer(text.encode(), np.uint8)
    starts, _, _ = spans(data, np.array([0, len(data)]), admitted)
    edge = np.concatenate([starts, [len(data)]])
    keep, at = [], 0
    for a, b in cuts:
        keep.append(data[at:edge[a]].tobytes())
        at = edge[b]
    return b"".join([*keep, data[at:].tobytes()]).decode()


def without_spans(docs: DataFrame, cuts: DataFrame, place: Column, admitted: np.ndarray = SPACED) -> DataFrame:
    """``docs`` (text and others) without the word spans of ``cuts`` (doc_id, cuts), which
    names documents by ``place``, a column over ``docs``; n_chars, if there is one, follows the
    text. Documents with nothing left are left out. Texts of documents that surely have no
    cut are not shuffled. All other columns are kept as they are."""
    names = docs.columns
    renamed = ["text" if c == "text" else f"c{k}" for k, c in enumerate(names)]  # no name clashes
    docs = docs.select("*", place).toDF(*renamed, "place")
    columns, schema, kinds = renamed, T.StructType(docs.schema.fields[:-1]), docs.schema
    some = BitFilter(cuts, "doc_id")
    told = docs.sparkSession.sparkContext.broadcast(some)

    def split(want):
        def pick(batches):
            for batch in batches:
                hit = told.value.has(np.asarray(batch.column("slot")))
                yield batch.filter(pa.array(hit == want)).select([*columns, "place"] if want else columns)
        return pick

    def cut(batches):
        for batch in batches:
            texts = [t if c is None or t is None else cut_words(t, [(x["start"], x["end"]) for x in c], admitted)
                     for t, c in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist(), strict=True)]
            kept = [c is None or t is None or bool(t.strip()) for t, c in zip(texts, batch.column("cuts").to_pylist(), strict=True)]
            out = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, batch.schema.field("text").type))
            yield out.select(columns).filter(pa.array(kept, pa.bool_()))

    slotted = docs.withColumn("slot", some.slot("place"))
    # written, so that no task needs two Python workers at once
    near = written(slotted.mapInArrow(frugal(split(True)), kinds), "near")
    told_cuts = near.join(cuts.select(F.col("doc_id").alias("place"), "cuts"), "place", "left").select(*columns, "cuts")
    changed = told_cuts.mapInArrow(frugal(cut), schema)
    if "n_chars" in names:
        n = renamed[names.index("n_chars")]
        changed = changed.withColumn(n, F.when(F.col("text").isNull(), F.col(n)).otherwise(F.length("text")).cast(schema[n].dataType))
    return slotted.mapInArrow(frugal(split(False)), schema).unionByName(changed.select(columns)).toDF(*names)


def without_repeats(docs: DataFrame, length: int = 50, span: int = 26) -> DataFrame:
    """``docs`` with every repeated passage left at its first place only (by doc_id, then
    position). Documents of which nothing is left go; the others keep all columns. Rows are
    told apart by doc_id and text: a doc_id that stands for different texts names several
    documents, and rows with both alike are one document given again. Null ids and texts stay."""
    place = F.when(F.col("doc_id").isNotNull() & F.col("text").isNotNull(), F.struct(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("text")))
    cuts = _spans(docs.select(place.alias("doc_id"), "text"), length, span).where("n_later > 0").select("doc_id", F.col("later").alias("cuts"))
    return without_spans(docs, written(cuts, "cuts"), place)

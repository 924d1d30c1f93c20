"""Benchmark decontamination (operator 9): documents streamed through a suffix automaton.

Words are maximal runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z. A window
is ``length`` consecutive words of a benchmark item; an item of fewer words, but not none, is
one window. A document word inside any occurrence of a window is hit.

The items' words, numbered by a shared vocabulary, build one generalised suffix automaton: a
state is a set of word runs that end at the same places of the items. Reading a document's
words moves from state to state and always knows the longest run that ends here and occurs
in some item. Wherever that run is at least a window long, the window's words are hit and
the state, or one on its suffix links, names the items.

Most words need no automaton: only runs of at least the shortest window, all of whose
neighbouring pairs occur in items, are streamed, and those runs are found with numpy.

Items are read in blocks of ``block_words`` words, each with an automaton of bounded size
that is broadcast; documents pass the blocks one after the other without any shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paidpath.llm.passages import cut_words
from paidpath.llm.tables import frugal
from paidpath.llm.words import ALNUM, span_hashes, spans, text_chunks

BLOCK_WORDS = 200_000


class Automaton:
    """Generalised suffix automaton of items (lists of word numbers), with the windows."""

    def __init__(self, items: list[tuple[int | None, list[int]]], length: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        # windows by the state that holds them: window size and items
        self.out: list[dict[int, set] | None] = [None] * len(self.size)
        for item, words in items:
            need, at, n = min(length, len(words)), 0, 0
            for i, w in enumerate(words):
                at, n = self.next[at][w], n + 1
                while self.size[self.link[at]] >= need:
                    at = self.link[at]
                n = min(n, self.size[at])
                if i + 1 >= need:
                    if self.out[at] is None:
                        self.out[at] = {}
                    self.out[at].setdefault(need, set()).add(item)
        # nearest state on the suffix links that holds a window
        self.up = [-1] * len(self.size)
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            link = self.link[s]
            self.up[s] = link if self.out[link] else self.up[link]

    def _new(self, size: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.size.append(size)
        return len(self.size) - 1

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.size[q] == self.size[last] + 1 else self._split(last, w, q)
        new, p = self._new(self.size[last] + 1), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: int, q: int) -> int:
        """State ``q`` also ends longer runs than ``p`` + w: those up to it get a state."""
        copy = self._new(self.size[p] + 1)
        self.next[copy], self.link[copy] = dict(self.next[q]), self.link[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def stream(self, words: Iterable[int]) -> Iterator[tuple[int, int, set]]:
        """(position of the last word, window size, items) for every window that occurs."""
        at = n = 0
        for i, w in enumerate(words):
            while at and w not in self.next[at]:
                at = self.link[at]
                n = self.size[at]
            if w in self.next[at]:
                at, n = self.next[at][w], n + 1
            for s in self._holders(at):
                for need, items in self.out[s].items():
                    if need <= n:
                        yield i, need, items

    def _holders(self, at: int) -> Iterator[int]:
        s = at if self.out[at] else self.up[at]
        while s > 0:
            yield s
            s = self.up[s]


class Block:
    """One block of items: vocabulary, pairs of neighbours and automaton."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], length: int):
        self.vocabulary = np.unique(np.concatenate([w for _, w in items]))
        numbered = [(i, np.searchsorted(self.vocabulary, w)) for i, w in items]
        self.pairs = np.unique(np.concatenate([w[:-1] * len(self.vocabulary) + w[1:] for _, w in numbered]))
        self.shortest = min(min(length, len(w)) for _, w in items)
        self.automaton = Automaton([(i, w.tolist()) for i, w in numbered], length)

    def runs(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """(first word's place, word numbers) of the stretches that may hold a window;
        ``first``: the texts' first words, over which no stretch runs."""
        size = len(self.vocabulary)
        at = np.searchsorted(self.vocabulary, words)
        known = self.vocabulary[np.minimum(at, size - 1)] == words
        joined = known[:-1] & known[1:]
        cut = first[(first > 0) & (first < len(words))]
        joined[cut - 1] = False
        both = np.flatnonzero(joined)
        if len(self.pairs):
            key = at[both] * size + at[both + 1]
            joined[both] = self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key
        else:
            joined[both] = False
        begin = np.flatnonzero(known & ~np.concatenate([[False], joined]))
        end = np.flatnonzero(known & ~np.concatenate([joined, [False]])) + 1
        for a, b in zip(begin, end, strict=True):
            if b - a >= self.shortest:
                yield int(a), at[a:b].tolist()


def _blocks(items: DataFrame, length: int, block_words: int) -> Iterator[Block]:
    """The items in blocks; one block at a time is on the driver."""
    held, total = [], 0
    rows = items.select(F.col("item_id").cast("long"), F.col("text")).where("text IS NOT NULL").distinct()
    for row in rows.toLocalIterator():
        data = np.frombuffer(row["text"].encode(), np.uint8)
        starts, ends, _ = spans(data, np.array([0, len(data)]), ALNUM)
        if not len(starts):
            continue
        if held and total + len(starts) > block_words:
            yield Block(held, length)
            held, total = [], 0
        held.append((row["item_id"], span_hashes(data, starts, ends)))
        total += len(starts)
    if held:
        yield Block(held, length)


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def matched(docs: DataFrame, items: DataFrame, length: int = 10, text_col: str = "text", block_words: int = BLOCK_WORDS,
            then: Callable[[Iterator], Iterator] | None = None, then_schema: T.StructType | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (sorted spans of word numbers: start, end) and
    ``hit_items`` (ids of the items with occurring windows, each once).

    A null or empty text has no words. Items without words take no part; items with a null
    id are searched for but not named; rows with one item_id count as one item. Without
    items nothing is hit. Columns of ``docs`` with the new names are replaced. ``then``, a
    function of batches with the result ``then_schema``, is applied in the last pass, by the
    same Python worker."""
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in ("n_words", "hits", "hit_items")]
    rows = docs.select(*columns, F.lit(0).cast("long").alias("n_words"),
                       F.expr("CAST(array() AS array<struct<start:int,end:int>>)").alias("hits"),
                       F.expr("CAST(array() AS array<bigint>)").alias("hit_items"))

    def through(told):
        def stream(batches):
            for batch in batches:
                block = told.value if told else None
                counts, hits = np.zeros(batch.num_rows, np.int64), batch.column("hits").to_pylist()
                named = [set(x) for x in batch.column("hit_items").to_pylist()]
                for i, _, data, offsets in text_chunks(batch.column(text_col)):
                    starts, ends, first = spans(data, offsets, ALNUM)
                    counts[i:i + len(first) - 1] = np.diff(first)
                    if not block or not len(starts):
                        continue
                    found: dict[int, list] = {}
                    for a, words in block.runs(span_hashes(data, starts, ends), first):
                        doc = int(np.searchsorted(first, a, "right")) - 1
                        for last, need, ids in block.automaton.stream(words):
                            end = a + last + 1 - int(first[doc])
                            found.setdefault(doc, []).append((end - need, end))
                            named[i + doc] |= ids
                    for doc, own in found.items():
                        own += [(h["start"], h["end"]) for h in hits[i + doc]]
                        hits[i + doc] = [{"start": a, "end": b} for a, b in _merged(own)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in columns] + [pa.array(counts), pa.array(hits, pa.list_(SPAN)),
                                                          pa.array([sorted(x - {None}) for x in named], pa.list_(pa.int64()))],
                    names=[*columns, "n_words", "hits", "hit_items"])
        return stream

    def last(told):
        return through(told) if then is None else lambda batches: then(through(told)(batches))

    schema, told = rows.schema, None
    for block in _blocks(items, length, block_words):
        if told:
            rows = rows.mapInArrow(frugal(through(told)), schema)
        told = spark.sparkContext.broadcast(block)
    return rows.mapInArrow(frugal(last(told)), schema if then is None else then_schema)


def digest(ids: list[int]) -> str:
    """SHA-256 (hex) of ids sorted as strings and joined by commas."""
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row."""
    found = matched(docs.select("doc_id", "text"), items, length, block_words=block_words)
    return found.select(
        "doc_id", "n_words",
        F.aggregate("hits", F.lit(0).cast("long"), lambda t, h: t + (h["end"] - h["start"])).alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("hit_items", lambda i: i.cast("string"))), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, items: DataFrame, length: int = 10, coverage: float = 0.5) -> DataFrame:
    """``docs`` (doc_id, text, others) without the words that are hit, with the separators
    after them; documents of whose words more than ``coverage`` are hit go, and so do those
    with nothing left. Documents without a hit keep their row as it is. n_chars follows."""
    names = docs.columns
    docs = docs.toDF(*["text" if c == "text" else f"c{k}" for k, c in enumerate(names)])  # no name clashes
    columns, schema = docs.columns, docs.schema
    hits = T.StructField("hits", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))

    def cut(batches):
        for batch in batches:
            texts, keep = batch.column("text").to_pylist(), []
            for k, (hits, n) in enumerate(zip(batch.column("hits").to_pylist(), batch.column("n_words").to_pylist(), strict=True)):
                spans_ = [(h["start"], h["end"]) for h in hits]
                keep.append(sum(b - a for a, b in spans_) <= coverage * n)
                if spans_ and keep[-1]:
                    texts[k] = cut_words(texts[k], spans_, ALNUM)
                    keep[-1] = bool(texts[k].strip())
            out = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, batch.schema.field("text").type))
            yield out.select([*columns, "hits"]).filter(pa.array(keep, pa.bool_()))

    out = matched(docs, items, length, then=cut, then_schema=T.StructType([*schema.fields, hits]))
    if "n_chars" in names:
        n = columns[names.index("n_chars")]
        out = out.withColumn(n, F.when(F.size("hits") == 0, F.col(n)).otherwise(F.length("text")).cast(schema[n].dataType))
    return out.select(columns).toDF(*names)

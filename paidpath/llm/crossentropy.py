"""Language model scoring (operator 3): cross-entropy difference of matched bigram models.

A target model learns from the target documents, a background model from all documents.
Both share one vocabulary and everything but their counts: background counts are scaled to
the target's total, and both are smoothed alike, bigrams towards unigrams and those towards
the uniform law. A document's score is the mean over its tokens of the background loss less
the target loss, in bits: higher means closer to the target.

The vocabulary holds every word of the corpus and the edge of a document; every bigram keeps
its own count in both models. No model is collected or broadcast:

1. Documents are dealt into blocks of about BLOCK_BYTES by a hash. A block sends each of its
   different words and bigrams once, with its counts, to the range of hashes that they lie in.
2. A range, of which there are as many as the corpus needs, adds up the blocks' counts and
   returns the totals to each block, in the order in which the block sent its keys.
3. A block weighs its documents with the totals of its own words and bigrams.

So a word or bigram, however common, has at most one entry a block, and what a task holds is
bounded by a block or a range at any corpus size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidpath.llm.tables import partitions_for, written
from paidpath.llm.words import BASE, SPACED, U, mix, span_hashes, spans, text_chunks

STRENGTH = 32.0  # counts that the smoothing law weighs as
BLOCK_BYTES = 2 << 20  # of texts that are counted and weighed together
RANGE_BYTES = 6 << 20  # of texts whose keys a range adds up, about a key for six bytes
EDGE = U(0)


class Block:
    """Words and bigrams of a table of documents: the different ones in the order of their
    hashes, and for each occurrence which one it is. A document's bigrams begin with the edge
    before its first word and end with the one after its last."""

    def __init__(self, texts: pa.ChunkedArray):
        flows, sizes = [np.zeros(1, np.uint64)], []
        for _, _, data, docs in text_chunks(texts):
            starts, ends, first = spans(data, docs, SPACED)
            flow = np.full(len(starts) + len(first) - 1, EDGE)
            inner = np.ones(len(flow), bool)
            inner[first[1:] + np.arange(len(first) - 1)] = False
            flow[inner] = span_hashes(data, starts, ends)
            flows.append(flow)
            sizes.append(np.diff(first) + 1)
        flow = np.concatenate(flows)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.sizes)])
        self.words, word = np.unique(flow, return_inverse=True)
        self.next = word[1:]
        self.pairs, one, self.pair = np.unique(mix(flow[:-1] * U(BASE) + flow[1:]), return_index=True, return_inverse=True)
        self.pair_words = word[one], word[one + 1]

    def counts(self, which: np.ndarray, n: int, wanted: np.ndarray) -> np.ndarray:
        """How often each of ``n`` occurs in all documents, then how often in those wanted."""
        return np.concatenate([np.bincount(which, minlength=n), np.bincount(which[np.repeat(wanted, self.sizes)], minlength=n)])


def packed(counts: np.ndarray) -> bytes:
    """Counts in the narrowest type that holds them all."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    """Two rows of ``n`` counts."""
    return np.frombuffer(raw, f"u{len(raw) // (2 * n)}").astype(np.int64).reshape(2, n) if n else np.zeros((2, 0), np.int64)


def gaps(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences, byte by byte: the high bytes are mostly 0, which a
    shuffle's compression takes out."""
    return np.diff(keys, prepend=U(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def from_gaps(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def log_law(pair: np.ndarray, before: np.ndarray, after: np.ndarray, total: float, size: int, strength: float = STRENGTH) -> np.ndarray:
    """log2 p(next | previous): bigram counts smoothed by unigrams, those by the uniform law.
    ``before`` and ``after``: counts of the previous and the next word."""
    unigram = (after + strength / size) / (total + strength)
    return np.log2((pair + strength * unigram) / (before + strength))


def log_model(counts: np.ndarray, strength: float = STRENGTH) -> np.ndarray:
    """log_law of a whole table of bigram counts."""
    return log_law(counts, counts.sum(1, keepdims=True), counts.sum(0), counts.sum(), len(counts), strength)


def _sent(blocks: DataFrame, labels: DataFrame, ranges: int) -> DataFrame:
    """``part, block`` and the block's keys and counts in that range of hashes."""
    edges = np.array([i * 2**64 // ranges for i in range(1, ranges)], np.uint64)

    def send(key: tuple[pa.Scalar, ...], docs: pa.Table, wanted: pa.Table) -> pa.Table:
        rows: dict[str, list] = {c: [] for c in ("part", "block", "words", "n_words", "pairs", "n_pairs")}
        if docs.num_rows:
            b = Block(docs.column("text"))
            good = np.asarray(pc.is_in(docs.column("doc_id"), value_set=wanted.column("wanted_id").combine_chunks()), bool)
            for name, keys, which in (("words", b.words, b.next), ("pairs", b.pairs, b.pair)):
                both = b.counts(which, len(keys), good).reshape(2, -1)
                cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
                for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                    rows[name].append(gaps(keys[i:j]))
                    rows[f"n_{name}"].append(packed(both[:, i:j].ravel()))
            rows["part"], rows["block"] = list(range(ranges)), [key[0].as_py()] * ranges
        return pa.table(rows, schema=pa.schema([("part", pa.int64()), ("block", pa.int64()), ("words", pa.binary()),
                                                ("n_words", pa.binary()), ("pairs", pa.binary()), ("n_pairs", pa.binary())]))

    return blocks.groupBy("block").cogroup(labels.groupBy("of_block")).applyInArrow(
        send, "part long, block long, words binary, n_words binary, pairs binary, n_pairs binary")


def _totals(sent: DataFrame) -> DataFrame:
    """``part, block, n_words, n_pairs``: both models' counts of the keys that a block sent.
    The row without block holds the range's different words and their occurrences instead."""
    def add(rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {"part": rows.column("part").to_pylist(), "block": rows.column("block").to_pylist()}
        told = np.zeros(3)
        for name in ("words", "pairs"):
            raw = rows.column(name).to_pylist()
            own = [unpacked(n, len(k) // 8) for k, n in zip(raw, rows.column(f"n_{name}").to_pylist(), strict=True)]
            keys, which = np.unique(np.concatenate([from_gaps(k) for k in raw]), return_inverse=True)
            both = np.stack([np.bincount(which, n, len(keys)) for n in np.concatenate(own, 1)]).astype(np.int64)
            at = np.concatenate([[0], np.cumsum([n.shape[1] for n in own])])
            out[f"n_{name}"] = [packed(both[:, which[i:j]].ravel()) for i, j in zip(at[:-1], at[1:], strict=True)]
            if name == "words":
                told = np.array([len(keys), *both.sum(1)], np.int64)
        out["part"].append(out["part"][0])
        out["block"].append(None)
        out["n_words"].append(told.tobytes())
        out["n_pairs"].append(b"")
        return pa.table(out, schema=pa.schema([("part", pa.int64()), ("block", pa.int64()), ("n_words", pa.binary()), ("n_pairs", pa.binary())]))

    return sent.groupBy("part").applyInArrow(add, "part long, block long, n_words binary, n_pairs binary")


def cross_entropy_difference(docs: DataFrame, target: DataFrame, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``doc_id, n_tokens, target_bits, background_bits, score`` for every row of ``docs``
    (doc_id, text); ``target``: doc_ids of the target documents.

    Bits are means over the words and the end of the document. A null or empty text has only
    its end. Repeated rows count as often as given. Target ids without a document and null
    ids add nothing; without target documents both models are the same and all scores 0.
    ``block_bytes`` and ``range_bytes`` only share out the work."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(partitions_for(volume, block_bytes)).cast("long")))
    wanted = target.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    # the labels may outgrow any broadcast, so they are joined with the ids alone, and sent to the blocks
    labels = blocks.select("doc_id", "block").hint("merge").join(wanted.hint("merge"), "doc_id", "left_semi").distinct().toDF("wanted_id", "of_block")
    totals = written(_totals(_sent(blocks, labels, partitions_for(volume, range_bytes))), "counts")
    told = [np.frombuffer(r["n_words"], np.int64) for r in totals.where("block IS NULL").select("n_words").collect()]
    size, every, some = (int(x) for x in np.sum(told, 0)) if told else (0, 0, 0)

    def weigh(key: tuple[pa.Scalar, ...], docs: pa.Table, counts: pa.Table) -> pa.Table:
        doc_ids, n, bits = [], np.zeros(0, np.int64), [np.zeros(0), np.zeros(0)]
        if docs.num_rows:
            b, counts = Block(docs.column("text")), counts.sort_by("part")
            (words, good_words), (pairs, good_pairs) = (
                _joined(counts.column(f"n_{name}").to_pylist(), keys, counts.num_rows) for name, keys in (("words", b.words), ("pairs", b.pairs)))
            if not some:
                good_words, good_pairs = words, pairs
            scale = (some or every) / every
            before, after = b.pair_words
            logs = (log_law(good_pairs, good_words[before], good_words[after], some or every, size),
                    log_law(pairs * scale, words[before] * scale, words[after] * scale, every * scale, size))
            n, bits = b.sizes, [-np.add.reduceat(x[b.pair], b.at[:-1]) / b.sizes for x in logs]
            doc_ids = docs.column("doc_id")
        return pa.table({"doc_id": pa.chunked_array([doc_ids], pa.int64()) if not docs.num_rows else doc_ids, "n_tokens": pa.array(n - 1, pa.int64()),
                         "target_bits": bits[0], "background_bits": bits[1], "score": bits[1] - bits[0]})

    return blocks.groupBy("block").cogroup(totals.where("block IS NOT NULL").groupBy("block")).applyInArrow(
        weigh, "doc_id long, n_tokens long, target_bits double, background_bits double, score double")


def _joined(raw: list[bytes], keys: np.ndarray, ranges: int) -> np.ndarray:
    """Both models' counts of a block's keys, from the ranges' answers in their order."""
    edges = np.array([i * 2**64 // ranges for i in range(1, ranges)], np.uint64)
    cuts = np.diff(np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]))
    return np.concatenate([unpacked(r, n) for r, n in zip(raw, cuts, strict=True)], 1)

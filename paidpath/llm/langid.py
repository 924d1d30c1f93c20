"""Language identification (operator 2): interpolated Kneser-Ney character language models.

A text's words are maximal runs of letters, lower-cased; each is read as its characters
between two spaces, so a word's log probability under a language does not depend on its
neighbours, and every distinct word of a batch is scored once.

One model has all languages: for each order a sorted array of n-gram hashes, with a row of
log probabilities (one for each language, already interpolated down to the uniform law) and
a row of back-off weights. A text goes to the language with the least cross-entropy per
character. A text is rejected if that cross-entropy lies above what held-back training
documents of the language show, widened for short texts. A language of few documents learns
from all of them, and is calibrated by leaving out one after the other.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidpath.llm.tables import frugal, written
from paidpath.llm.words import BASE, U, mix, text_chunks

ORDER = 5
DOCS_A_LANGUAGE = 400  # bound of the training sample, by hash of doc_id
FEW = 25  # documents of a language in the sample, below which none is held back
SPACE = 32
CHUNK = 1 << 20
BLOCK_WORDS = 1 << 12  # distinct words whose n-grams are in memory at once


@lru_cache(maxsize=1)
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and letterhood of the code points below 65536."""
    lower, letter = np.arange(65536, dtype=np.uint32), np.zeros(65536, bool)
    for c in range(65536):
        x = chr(c)
        letter[c] = x.isalpha()
        if len(y := x.lower()) == 1 and ord(y) < 65536:
            lower[c] = ord(y)
    return lower, letter


def text_words(data: np.ndarray, docs: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of a chunk (UTF-32 bytes), each word's number among them, and for
    each text the place of its first word (one more at the end)."""
    lower, letter = _alphabet()
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=at[1:])
    docs = at[docs]
    del at
    small = np.minimum(codes, 65535)
    inside = letter[small]
    codes = lower[small]
    if (small == 65535).any():
        full = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        rare = np.flatnonzero(full >= 65535)
        values, back = np.unique(full[rare], return_inverse=True)
        inside[rare] = np.array([chr(c).isalpha() for c in values])[back]
        codes[rare] = values[back]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = docs[(docs > 0) & (docs < len(codes))]
    first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    kept = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(inside, out=kept[1:])
    letters = np.ascontiguousarray(codes[inside])
    offsets = np.append(kept[starts], len(letters)) * 4
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices), np.searchsorted(starts, docs)


class Grams:
    """The padded words of a list, and for each order the n-gram ending at each character."""

    def __init__(self, words: pa.Array):
        ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1] // 4
        letters = np.frombuffer(words.buffers()[2], np.uint32)[ends[0]:ends[-1]] if len(words) and ends[-1] > ends[0] else np.zeros(0, np.uint32)
        size = np.diff(ends)
        self.first = np.concatenate([[0], np.cumsum(size + 2)])  # of each padded word
        self.codes = np.full(self.first[-1], SPACE, np.uint64)
        inner = np.ones(len(self.codes), bool)
        inner[self.first[:-1]] = inner[self.first[1:] - 1] = False
        self.codes[inner] = letters
        self.place = np.arange(len(self.codes)) - np.repeat(self.first[:-1], size + 2)
        self.chars = size + 1  # predicted: all but the first space

    def hashes(self, order: int) -> np.ndarray:
        """At each character, the hash of the ``order`` characters up to it (meaningful
        where place >= order - 1)."""
        coded, out = mix(self.codes + U(977)), np.zeros(len(self.codes), np.uint64)
        for k in range(order):
            out[k:] += coded[:len(coded) - k] * U(pow(BASE, k, 2**64))
        return mix(out + U(order))


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in a sorted array, or -1."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


class KneserNey:
    """Interpolated Kneser-Ney models of several languages over joint n-gram tables."""

    def __init__(self, words: dict[str, tuple[pa.Array, np.ndarray]], order: int = ORDER):
        """``words``: for each language its distinct words and their counts."""
        self.languages, self.order = sorted(words), order
        grams = {lang: Grams(words[lang][0]) for lang in self.languages}
        types = {lang: self._types(grams[lang], words[lang][1], order) for lang in self.languages}
        self.keys = [np.unique(np.concatenate([types[lang][k]["key"] for lang in self.languages])) for k in range(order)]
        n = len(self.languages)
        self.unseen = np.zeros(n)
        self.log_p = [np.zeros((len(keys), n)) for keys in self.keys]
        self.log_back = [np.zeros((len(keys), n)) for keys in self.keys]
        uniform = 1 / (len(self.keys[0]) + 1)
        # of each joint n-gram, the n-grams without its first and last character
        suffix, context = [None] * order, [None] * order
        for k in range(1, order):
            suffix[k], context[k] = (np.zeros(len(self.keys[k]), np.int64) for _ in range(2))
            for lang in self.languages:
                t = types[lang][k]
                at = np.searchsorted(self.keys[k], t["key"])
                suffix[k][at] = np.searchsorted(self.keys[k - 1], t["suffix"])
                context[k][at] = np.searchsorted(self.keys[k - 1], t["context"])
        for i, lang in enumerate(self.languages):
            lower = None
            for k in range(order):
                t, size = types[lang][k], len(self.keys[k])
                at = np.searchsorted(self.keys[k], t["key"])
                count = np.zeros(size)
                count[at] = t["count"]
                n1, n2 = (count == 1).sum(), (count == 2).sum()
                discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
                if k == 0:
                    total, kinds = count.sum(), (count > 0).sum()
                    rest = discount * kinds / total if total else 1.0
                    p = np.maximum(count - discount, 0) / max(total, 1) + rest * uniform
                    self.unseen[i] = math.log2(rest * uniform)
                else:
                    total = np.bincount(context[k], count, len(self.keys[k - 1]))
                    kinds = np.bincount(context[k], count > 0, len(self.keys[k - 1]))
                    back = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
                    self.log_back[k - 1][:, i] = np.log2(back)
                    p = np.maximum(count - discount, 0) / np.maximum(total, 1)[context[k]] + back[context[k]] * lower[suffix[k]]
                self.log_p[k][:, i] = np.log2(p)
                lower = p

    @staticmethod
    def _types(g: Grams, weight: np.ndarray, order: int) -> list[dict]:
        """For each order the n-grams with their Kneser-Ney counts: how often they occur for
        the highest order and at a word's start, else how many characters precede them."""
        weights = np.repeat(weight.astype(float), np.diff(g.first))
        hashes = [g.hashes(k + 1) for k in range(order)]
        out: list[dict] = []
        for k in range(order):
            at = np.flatnonzero(g.place >= max(k, 1))
            key, one, back = np.unique(hashes[k][at], return_index=True, return_inverse=True)
            seen = at[one]
            out.append({"key": key, "count": np.bincount(back, weights[at], len(key)), "starts": g.place[seen] == k,
                        "suffix": hashes[k - 1][seen] if k else None, "context": hashes[k - 1][seen - 1] if k else None})
        # an end and a start of a word are one character, so a start has its row
        for k in range(order - 1):
            near = np.searchsorted(out[k]["key"], out[k + 1]["suffix"])
            before = np.bincount(near, minlength=len(out[k]["key"])).astype(float)
            out[k]["count"] = np.where(out[k]["starts"] & (k > 0), out[k]["count"], before)
        return out

    def word_bits(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each word its log2 probability by language, and its number of characters."""
        g = Grams(words)
        total = np.zeros((len(words), len(self.languages)))
        if not len(words):
            return total, g.chars
        log_p = np.tile(self.unseen, (len(g.codes), 1))
        found = _find(self.keys[0], g.hashes(1))
        log_p[found >= 0] = self.log_p[0][found[found >= 0]]
        for k in range(1, self.order):
            at = np.flatnonzero(g.place >= k)
            before = found[at - 1]
            now = np.full(len(g.codes), -1)
            # an n-gram is only known if the n-gram without its first character is
            maybe = at[found[at] >= 0]
            now[maybe] = _find(self.keys[k], g.hashes(k + 1)[maybe])
            lost = at[(now[at] < 0) & (before >= 0)]
            log_p[lost] += self.log_back[k - 1][found[lost - 1]]
            kept = maybe[now[maybe] >= 0]
            log_p[kept] = self.log_p[k][now[kept]]
            found = now
        log_p[g.first[:-1]] = 0
        return np.add.reduceat(log_p, g.first[:-1], axis=0), g.chars

    def entropy(self, data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text by language, and its number of characters."""
        words, number, first = text_words(data, docs)
        parts = [self.word_bits(words.slice(i, BLOCK_WORDS)) for i in range(0, max(1, len(words)), BLOCK_WORDS)]
        bits, chars = (np.concatenate(x) for x in zip(*parts, strict=True))
        sums = np.zeros((len(number) + 1, len(self.languages)))
        np.cumsum(bits[number], axis=0, out=sums[1:])
        n = np.zeros(len(number) + 1, np.int64)
        np.cumsum(chars[number], out=n[1:])
        n = np.diff(n[first])
        return -np.diff(sums[first], axis=0) / np.maximum(n, 1)[:, None], n


class Identifier:
    """Models with the cross-entropies at which a text is rejected."""

    SHARE, WIDER, SIGMAS = 0.999, 1.0, 6.0

    def __init__(self, model: KneserNey, bits: np.ndarray, chars: np.ndarray, best: np.ndarray):
        """``bits``, ``chars``, ``best``: least cross-entropy, length and language of
        held-back documents. A language's bound lies WIDER bits above the SHARE quantile of
        its excess over what SIGMAS deviations of its length allow.

        With fewer than five such documents, a language has at least the widest spread and
        excess of the others, and without any the highest mean too. If no language has
        documents to spare, a text must be likelier than under equally likely characters."""
        self.model = model
        n = len(model.languages)
        self.mean, self.spread, self.over = np.full(n, math.log2(len(model.keys[0]) + 1)), np.zeros(n), np.zeros(n)
        size = np.array([((best == i) & (chars > 0)).sum() for i in range(n)], dtype=int)
        for i in np.flatnonzero(size):
            own = (best == i) & (chars > 0)
            self.mean[i] = np.average(bits[own], weights=chars[own])
            self.spread[i] = np.sqrt(np.median((bits[own] - self.mean[i]) ** 2 * chars[own]) / 0.455)
            excess = bits[own] - self.mean[i] - self.SIGMAS * self.spread[i] / np.sqrt(chars[own])
            self.over[i] = max(0.0, float(np.quantile(excess, self.SHARE))) + self.WIDER
        for wide in (self.spread, self.over):
            wide[size < 5] = np.maximum(wide[size < 5], wide[size >= 5].max(initial=0.0))
        if size.any():
            self.mean[size == 0] = self.mean[size > 0].max()

    def judge(self, data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Language number (-1: no letter), score, bits per character and acceptance."""
        bits, n = self.model.entropy(data, docs)
        best = bits.argmin(1)  # of equals the first in alphabetical order
        least = bits[np.arange(len(n)), best]
        odds = np.exp2(-np.minimum((bits - least[:, None]) * np.minimum(n, 64)[:, None], 60)).sum(1)
        bound = self.mean[best] + self.over[best] + self.SIGMAS * self.spread[best] / np.sqrt(np.maximum(n, 1))
        return np.where(n > 0, best, -1), np.where(n > 0, 1 / odds, 0.0), least, (n > 0) & (least <= bound)


def fit(docs: DataFrame, order: int = ORDER, docs_a_language: int = DOCS_A_LANGUAGE) -> Identifier | None:
    """Learns from ``docs`` (doc_id, text, lang): about ``docs_a_language`` whole documents
    of each language, those with the smallest hashes of doc_id; a fifth of them calibrates. A
    language with fewer than ``FEW`` in the sample learns from all, so every language with a
    word is learned.
    Null texts and languages teach nothing. None if there is no language."""
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    bound = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, docs_a_language / n))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    some = written(known.where(draw < bound[F.col("lang")]).where("text IS NOT NULL").select(
        "lang", "text", "doc_id", F.xxhash64("doc_id", "text").alias("doc"),
        (F.pmod(F.xxhash64(F.lit("held back"), F.col("doc_id")), F.lit(5)) == 0).alias("held_back")), "language-sample")
    few = written(some.groupBy("lang").count().select("lang", (F.col("count") < FEW).alias("few")), "languages")
    some = some.join(few, "lang").withColumn("held_back", F.expr("held_back AND NOT few"))

    def count(batches):
        for batch in batches:
            for i, _, data, offsets in text_chunks(batch.column("text"), CHUNK):
                words, number, first = text_words(data, offsets)
                lang = batch.column("lang").slice(i, len(first) - 1).dictionary_encode()
                owner = np.repeat(np.asarray(lang.indices), np.diff(first)).astype(np.int64)
                key, n = np.unique(owner * max(1, len(words)) + number, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(key // max(1, len(words)))), words.take(pa.array(key % max(1, len(words)))).cast(pa.binary()), pa.array(n)],
                    names=["lang", "word", "n"])

    counted = some.where("NOT held_back").mapInArrow(frugal(count), "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    words = {}
    for lang in sorted(pc.unique(counted.column("lang")).to_pylist()):
        own = counted.filter(pc.equal(counted.column("lang"), lang))
        words[lang] = (pa.concat_arrays(own.column("word").cast(pa.large_binary()).chunks), own.column("n").to_numpy().astype(float))
    if not words:
        return None
    model = KneserNey(words, order)
    told = docs.sparkSession.sparkContext.broadcast(model)

    def weigh(batches):
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column("text"), CHUNK):
                bits, n = told.value.entropy(data, offsets)
                yield pa.RecordBatch.from_arrays([pa.array(bits.min(1)), pa.array(n), pa.array(bits.argmin(1))], names=["bits", "chars", "best"])

    held = some.where("held_back").mapInArrow(frugal(weigh), "bits double, chars long, best long").toArrow()
    out = _left_out(some.where("few").select("lang", "doc", "text"), order).toArrow()
    best = np.searchsorted(model.languages, np.array(out.column("lang").to_pylist(), dtype=str)) if out.num_rows else np.zeros(0, np.int64)
    return Identifier(model, *(np.concatenate([held.column(c).to_numpy(), out.column(c).to_numpy()]) for c in ("bits", "chars")),
                      np.concatenate([held.column("best").to_numpy(), best]))


def _left_out(few: DataFrame, order: int) -> DataFrame:
    """``lang, bits, chars``: each document's cross-entropy under its language's other
    documents, for languages of fewer than ``FEW`` documents, each in a task. Equal texts of
    one doc_id are one document; a language of one document has none to spare."""
    def weigh(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        texts = dict(zip(rows.column("doc").to_pylist(), rows.column("text").to_pylist(), strict=True))
        words, out = [], []
        for text in texts.values():
            data = np.frombuffer(text.encode(), np.uint8)
            own, number, _ = text_words(data, np.array([0, len(data)]))
            words.append((own, np.bincount(number, minlength=len(own)).astype(float)))
        for i, (own, times) in enumerate(words):
            others = [w for k, w in enumerate(words) if k != i and len(w[0])]
            if others and len(own):
                every = pa.concat_arrays([w for w, _ in others]).dictionary_encode()
                total = np.bincount(np.asarray(every.indices), np.concatenate([n for _, n in others]), len(every.dictionary))
                bits, chars = KneserNey({"": (every.dictionary, total)}, order).word_bits(own)
                n = float((times * chars).sum())
                out.append((-float((times * bits[:, 0]).sum()) / n, int(n)))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(out), pa.string()), "bits": pa.array([b for b, _ in out], pa.float64()),
                         "chars": pa.array([n for _, n in out], pa.int64())})

    return few.groupBy("lang").applyInArrow(weigh, "lang string, bits double, chars long")


def identified(docs: DataFrame, identifier: Identifier | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` (0 to 1), ``lang_bits`` (per character)
    and ``lang_accepted``. A null text or one without a letter is ``und`` with score 0 and
    not accepted; so is everything if no language was learned. Of equally likely languages
    the alphabetically first wins. Columns of ``docs`` with these names are replaced."""
    docs = docs.drop("lang_pred", "lang_score", "lang_bits", "lang_accepted")
    columns, told = docs.columns, docs.sparkSession.sparkContext.broadcast(identifier)

    def judge(batches):
        for batch in batches:
            parts = []
            for _, _, data, offsets in text_chunks(batch.column("text"), CHUNK):
                n = len(offsets) - 1
                parts.append(told.value.judge(data, offsets) if told.value else (np.full(n, -1), np.zeros(n), np.zeros(n), np.zeros(n, bool)))
            best, score, bits, fine = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0, bool))
            names = [*(told.value.model.languages if told.value else ()), "und"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([names[int(b)] for b in best], pa.string()), pa.array(score, pa.float64()),
                                              pa.array(bits, pa.float64()), pa.array(fine, pa.bool_())],
                                             names=[*columns, "lang_pred", "lang_score", "lang_bits", "lang_accepted"])

    fields = docs.withColumns({"lang_pred": F.lit(""), "lang_score": F.lit(0.0), "lang_bits": F.lit(0.0), "lang_accepted": F.lit(True)}).schema
    return docs.mapInArrow(frugal(judge), fields)

"""Token counts (operator 12): a map-side two-tier lookup of pre-token lengths.

A byte-level BPE splits a text into pre-tokens and encodes each on its own, so a text's count
is the sum of its pre-tokens' lengths in tokens. Texts are split in place: the rule

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

only looks at the classes of neighbouring code points, so the starts of all pre-tokens of
many texts are found at once with numpy. Classes come from the tokenizer itself: a code point
not seen before is classified by what its pre-tokenizer does with it.

Tier one is a broadcast hash table of the lengths of frequent pre-tokens, of fixed size: 64-bit
hashes in open addressing, and a byte of length each. It is filled from a sample of about
``SAMPLE`` documents. What it holds changes the work, never a count.

Tier two encodes what the table misses with the tokenizers library, once for each worker:
lengths are kept in a cache of bounded size in the Python worker.

No pre-token of the corpus is shuffled; a text does not come back from Python either. The
only shuffle is that of the sample's summaries.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidpath.llm.tables import bounded_batches
from paidpath.llm.words import U, span_hashes, text_chunks

SAMPLE = 16_384  # documents that tier one is filled from
FREQUENT = 1 << 16  # pre-tokens in tier one
SUMMARY = 8_192  # pre-tokens that a task of the sample names
SHORT = 64  # bytes; longer pre-tokens are kept in neither tier
CACHED = 1 << 18  # pre-tokens in a worker's cache
SPACE, LETTER, NUMBER, OTHER, EDGE = 1, 2, 3, 4, 5  # classes; 0: not seen yet
# Byte-level models name a byte by the character of its own number if that is visible in
# Latin-1, and the others by the characters from 256 on, in order.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARACTERS = np.arange(256, dtype="<u4")
BYTE_CHARACTERS[[b for b in range(256) if b not in _VISIBLE]] = 256 + np.arange(256 - len(_VISIBLE))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class PreTokens:
    """Where the pre-tokens of many texts lie. Made from the JSON of a tokenizer file."""

    def __init__(self, definition: str):
        self.definition = definition
        told = json.loads(definition)
        split = told.get("pre_tokenizer") or {}
        if (told["model"]["type"], split.get("type"), split.get("use_regex", True), split.get("add_prefix_space")) != ("BPE", "ByteLevel", True, False):
            raise ValueError("token counts need a byte-level BPE that splits by its regular expression, without a space in front")
        if told.get("normalizer") or any(t[k] for t in told["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("token counts need a tokenizer without normaliser, whose added tokens stand for their text alone")
        self.added = sorted((t["content"].encode() for t in told["added_tokens"]), key=len, reverse=True)
        self._start()

    def _start(self) -> None:
        self.classes = np.zeros(0x110000, np.uint8)
        self._tokenizer = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("classes", "_tokenizer")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a worker one core
            from tokenizers import Tokenizer
            self._tokenizer = Tokenizer.from_str(self.definition)
        return self._tokenizer

    def lengths(self, tokens: list[bytes]) -> list[int]:
        """Lengths of pre-tokens by the library's model, which knows a byte as a character."""
        tokenize = self.tokenizer.model.tokenize
        ends = np.cumsum([len(t) for t in tokens]).tolist()
        characters = BYTE_CHARACTERS[np.frombuffer(b"".join(tokens), np.uint8)].tobytes().decode("utf-32-le")
        return [len(tokenize(characters[a:b])) for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def classify(self, points: np.ndarray) -> np.ndarray:
        """The class of each code point."""
        found = self.classes[points]
        if not found.all():
            whole = self.tokenizer.pre_tokenizer.pre_tokenize_str
            for p in np.unique(points[found == 0]).tolist():
                self.classes[p] = next((kind for kind, first in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(whole(first + chr(p))) == 1), SPACE)
            found = self.classes[points]
        return found

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte offsets at which the pre-tokens of all texts start (one more at the end),
        which of them are added tokens, and each text's first pre-token (one more)."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
        n = len(points)
        if not n:
            return np.zeros(1, np.int64), np.zeros(0, bool), np.zeros(len(offsets), np.int64)
        at_byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        edges = [np.searchsorted(at_byte, offsets)]
        added = self._added(raw, offsets)
        added = [np.searchsorted(at_byte, a) for a in added]
        edge = np.zeros(n + 3, bool)
        for places in (*edges, *added):
            edge[places] = True
        kind = np.full(n + 2, EDGE, np.uint8)
        kind[1:-1] = self.classify(points)
        before, own, after = kind[:-2].copy(), kind[1:-1], kind[2:].copy()
        before[edge[:n]] = EDGE
        after[edge[1:n + 1]] = EDGE
        tail = (own == SPACE) & (after != SPACE) & (after != EDGE)  # the last space before something
        starts = np.zeros(n + 4, bool)
        starts[:n] = (own != before) | tail
        starts[1:n + 1][tail & (points == 0x20)] = False  # belongs to what follows
        quotes = np.flatnonzero(starts[:n] & (points == ord("'")))
        if len(quotes):
            padded = np.concatenate([points, np.zeros(3, points.dtype)])
            one, two = padded[quotes + 1], padded[quotes + 2]
            alone, same = ~edge[quotes + 1], ~edge[quotes + 1] & ~edge[quotes + 2]
            short = alone & np.isin(one, [ord(c) for c in "stmd"])
            long = same & np.isin(one << 8 | two, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")]) & (two < 256)
            starts[quotes[short | long] + 1] = False
            starts[quotes[short] + 2] = True
            starts[quotes[long] + 3] = True
        for a, b in zip(*added, strict=True):
            starts[a + 1:b] = False
        first = np.flatnonzero(starts[:n])
        return np.append(at_byte[first], len(data)), np.isin(first, added[0]), np.searchsorted(first, edges[0])

    def _added(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends, in bytes, of the added tokens in the texts."""
        found = []
        if any(t in raw for t in self.added):
            pattern = re.compile(b"|".join(map(re.escape, self.added)))
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                found += [m.span() for m in pattern.finditer(raw, a, b)]
        both = np.array(found, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


class LengthTable:
    """Tier one: 64-bit hashes of pre-tokens in open addressing, each with a length below 256.
    Its size is fixed by the number of entries; 0 marks a free place."""

    def __init__(self, keys: np.ndarray, lengths: np.ndarray):
        keys, first = np.unique(keys, return_index=True)
        lengths = lengths[first]
        fit = (keys != 0) & (lengths < 256)
        keys, lengths = keys[fit], lengths[fit]
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.mask, self.keys, self.lengths = U(size - 1), np.zeros(size, np.uint64), np.zeros(size, np.uint8)
        at = keys & self.mask
        while len(keys):
            put = self.keys[at] == 0
            put[put] = np.isin(np.flatnonzero(put), np.flatnonzero(put)[np.unique(at[put], return_index=True)[1]])
            self.keys[at[put]], self.lengths[at[put]] = keys[put], lengths[put]
            keys, lengths, at = keys[~put], lengths[~put], (at[~put] + U(1)) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The length of each key, 0 for those the table has not."""
        out, at = np.zeros(len(keys), np.int64), keys & self.mask
        left = np.arange(len(keys))
        while len(left):
            held = self.keys[at[left]]
            hit = held == keys[left]
            out[left[hit]] = self.lengths[at[left[hit]]]
            left = left[~hit & (held != 0)]
            at[left] = (at[left] + U(1)) & self.mask
        return out


class TokenCounter:
    """Counts the tokens of texts by the two tiers."""

    def __init__(self, split: PreTokens, table: LengthTable):
        self.split, self.table, self.cache = split, table, {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def encoded(self, tokens: list[bytes]) -> list[int]:
        """Lengths of distinct pre-tokens by the library, through the worker's cache."""
        new = [t for t in tokens if t not in self.cache]
        own = dict(zip(new, self.split.lengths(new), strict=True)) if new else {}
        out = [own[t] if t in own else self.cache[t] for t in tokens]
        if len(self.cache) + len(own) > CACHED:
            self.cache.clear()
        self.cache |= {t: n for t, n in list(own.items())[:CACHED] if len(t) <= SHORT}
        return out

    def count(self, text: pa.Array) -> pa.Array:
        """Tokens of each text; a null text has none."""
        out = [np.zeros(0, np.int64)]
        for _, _, data, offsets in text_chunks(text):
            at, added, first = self.split.spans(data, offsets)
            keys = span_hashes(data, at[:-1], at[1:], lower=False)
            lengths = self.table.find(keys)
            lengths[added] = 1
            missed = np.flatnonzero(lengths == 0)
            if len(missed):
                _, one, which = np.unique(keys[missed], return_index=True, return_inverse=True)
                raw, one = data.tobytes(), missed[one]
                lengths[missed] = np.array(self.encoded([raw[a:b] for a, b in zip(at[one].tolist(), at[one + 1].tolist(), strict=True)]))[which]
            out.append(np.diff(np.concatenate([[0], np.cumsum(lengths)])[first]))
        return pa.array(np.concatenate(out))


def frequent(docs: DataFrame, split: PreTokens, text_col: str = "text", sample: int = SAMPLE, entries: int = FREQUENT) -> list[bytes]:
    """The pre-tokens that are most frequent in about ``sample`` rows of ``docs``. A task
    names ``SUMMARY`` of its own at most, and the driver gets ``entries``."""
    rows = docs.count()
    if not rows:
        return []
    told = docs.sparkSession.sparkContext.broadcast(split)

    def summaries(batches):
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                at, _, _ = told.value.spans(data, offsets)
                raw = data.tobytes()
                seen.update(raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True) if b - a <= SHORT)
            if len(seen) > 8 * SUMMARY:
                seen = Counter(dict(seen.most_common(SUMMARY)))
        most = seen.most_common(SUMMARY)
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in most], pa.binary()), pa.array([n for _, n in most], pa.int64())], names=["token", "n"])

    named = docs.select(text_col).sample(min(1.0, sample / rows), seed=1).mapInArrow(summaries, "token binary, n long")
    top = named.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(entries)
    return [bytes(r["token"]) for r in top.collect()]


def token_counter(docs: DataFrame, tokenizer: str | None = None, text_col: str = "text", sample: int = SAMPLE, entries: int = FREQUENT) -> TokenCounter:
    """A counter for the tokenizer of a JSON file, which the driver reads, with the frequent
    pre-tokens of ``docs`` in its table."""
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        split = PreTokens(f.read())
    bounded_batches(docs.sparkSession)
    counter = TokenCounter(split, LengthTable(np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    tokens = [t for t in frequent(docs, split, text_col, sample, entries) if t not in split.added]
    if tokens:
        ends = np.cumsum([len(t) for t in tokens])
        keys = span_hashes(np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], ends[:-1]]), ends, lower=False)
        counter.table = LengthTable(keys, np.array(counter.encoded(tokens)))
    return counter


def token_count(counter: TokenCounter, docs: DataFrame) -> Column:
    """A column function: the tokens of a text."""
    told = docs.sparkSession.sparkContext.broadcast(counter)
    return F.arrow_udf(lambda text: told.value.count(text), "long")


def counted(docs: DataFrame, tokenizer: str | None = None, text_col: str = "text", into: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each text, as the tokenizers library counts them:
    without special tokens around the text; strings of added tokens inside it count as these.

    A null or empty text has 0 tokens. Every row counts on its own, repeated ones too; other
    columns are left alone, one named ``into`` is replaced. Without rows there is no result."""
    return docs.withColumn(into, token_count(token_counter(docs, tokenizer, text_col), docs)(F.col(text_col)))

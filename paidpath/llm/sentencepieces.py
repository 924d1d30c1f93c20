"""SentencePiece encoding and decoding (operator 1): Unigram Viterbi over a double-array trie.

Pieces and their log scores come from a SentencePiece model file, whose path is a parameter;
nothing is trained. As in SentencePiece, a space in front of a non-empty text (if the model
asks for one) and every space stand as the marker U+2581, the segmentation has the greatest
sum of scores, a character that is no piece costs the least score less 10, and becomes its
bytes' pieces. Of equal sums, the last piece is the longest, as SentencePiece has it.

The trie over the pieces' bytes is a double array: from state s, byte b leads to
t = base[s] + b if check[t] = s. All positions of a batch walk it in step with numpy.

No piece holds a marker after another character, or a line break, so the best segmentation
of a text is that of its words, one after the other: every distinct word of a batch (its
leading markers included) is segmented once. A model for which this does not hold has its
texts segmented whole.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paidpath.llm.tables import frugal
from paidpath.llm.words import ragged, text_chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁".encode()
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces in the file format
CHUNK = 1 << 19
LONG_WORD = 96  # bytes; longer words are segmented one by one
BLOCK = 1 << 15  # bytes of distinct words that are segmented in step
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol buffer message."""
    def number(i: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            b = data[i]
            out |= (b & 127) << shift
            i, shift = i + 1, shift + 7
            if b < 128:
                return out, i

    i = 0
    while i < len(data):
        tag, i = number(i)
        kind = tag & 7
        if kind == 0:
            value, i = number(i)
        elif kind == 2:
            n, i = number(i)
            value, i = data[i:i + n], i + n
        else:
            n = 4 if kind == 5 else 8
            value, i = struct.unpack("<f" if n == 4 else "<d", data[i:i + n])[0], i + n
        yield tag >> 3, value


class Vocabulary:
    """Pieces of a model file with their trie."""

    def __init__(self, pieces: list[tuple[bytes, float, int]], dummy_prefix: bool = True):
        """``pieces``: text in UTF-8, log score and kind, by id."""
        self.dummy_prefix = dummy_prefix
        self.texts = [t.replace(MARKER, b" ") for t, _, _ in pieces]
        self.scores = np.array([s for _, s, _ in pieces])
        self.byte_ids = np.full(256, -1, np.int32)
        for i, (t, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.texts[i] = bytes([int(t[3:5], 16)])
                self.byte_ids[self.texts[i][0]] = i
            elif kind in (CONTROL, UNKNOWN):
                self.texts[i] = b""
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        self.byte_fallback = bool((self.byte_ids >= 0).all())
        usable = {self.texts[i]: i for i, p in reversed(list(enumerate(pieces))) if p[2] in (NORMAL, USER_DEFINED) and p[0]}
        used = [self.scores[i] for i in usable.values()]
        self.unknown_score = (min(used) if used else 0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, usable), default=1)
        self.by_word = not any(b" " in t.lstrip(b" ") or b"\n" in t for t in usable)
        self._double_array(usable)

    def _double_array(self, pieces: dict[bytes, int]) -> None:
        trie: list[dict[int, int]] = [{}]
        ends = {}
        for text, i in pieces.items():
            at = 0
            for b in text:
                if b not in trie[at]:
                    trie[at][b] = len(trie)
                    trie.append({})
                at = trie[at][b]
            ends[at] = i
        # nodes with many children open new ground; the others fill the gaps left behind
        wide = sum(len(c) > 6 for c in trie)
        size = 2 * len(trie) + 256 * (wide + 4)
        used = bytearray(size)
        used[0] = 1
        base, check = [0] * size, [-1] * size
        place, front, gap = [0] * len(trie), 1, 1
        for node, children in enumerate(trie):  # parents come before their children
            if not children:
                continue
            keys = sorted(children)
            low, start = keys[0], 0
            if len(keys) <= 6:
                while used[gap]:
                    gap += 1
                at = max(gap, low + 1)
                for f in range(at, min(at + 40, size - 256)):
                    if not any(used[f - low + k] for k in keys):
                        start = f - low
                        break
            if not start:
                start = max(1, front - low)
                while any(used[start + k] for k in keys):
                    start += 1
            s = place[node]
            base[s] = start
            for b in keys:
                used[start + b], check[start + b] = 1, s
                place[children[b]] = start + b
            front = max(front, start + keys[-1] + 1)
        piece = np.full(size, -1, np.int32)
        for node, i in ends.items():
            piece[place[node]] = i
        last = front + 256
        self.base, self.check, self.piece = np.array(base[:last], np.int32), np.array(check[:last], np.int32), piece[:last]

    def matches(self, data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, starts, ids) of the pieces at all places of ``data``; ``ends``: where
        the word of each place ends."""
        at, state = np.arange(len(data)), np.zeros(len(data), np.int64)
        for n in range(1, self.longest + 1):
            to = self.base[state] + data[at + n - 1].astype(np.int64)
            good = self.check[to] == state
            at, state = at[good], to[good]
            hit = self.piece[state] >= 0
            if hit.any():
                yield n, at[hit], self.piece[state[hit]]
            more = (at + n < ends[at]) & (self.base[state] > 0)
            at, state = at[more], state[more]
            if not len(at):
                return

    def segment(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (bytes between ``offsets``, none of them empty), and how many
        each has. Words are taken in step, place by place."""
        n = len(data)
        size = np.diff(offsets)
        ends = np.repeat(offsets[1:], size)
        word = np.repeat(np.arange(len(size)), size)
        place = np.arange(n) - offsets[:-1][word]
        kind = data[:]
        chars = np.where(kind < 0x80, 1, np.where(kind < 0xE0, 2, np.where(kind < 0xF0, 3, 4)))
        begins = (kind & 0xC0) != 0x80
        lengths, starts, ids = [], [], []
        single = np.zeros(n, bool)
        for k, at, piece in self.matches(data, ends):
            fits = begins[at]
            lengths.append(np.full(fits.sum(), k))
            starts.append(at[fits])
            ids.append(piece[fits])
            single[at[fits & (chars[at] == k)]] = True
        lone = np.flatnonzero(begins & ~single)
        lengths.append(chars[lone])
        starts.append(lone)
        ids.append(np.full(len(lone), -1))
        length, start, piece = np.concatenate(lengths), np.concatenate(starts), np.concatenate(ids).astype(np.int64)
        score = np.where(piece >= 0, self.scores[piece], self.unknown_score)
        # by the place of the end in its word, longer pieces first: of equals the first stays
        step = place[start] + length
        order = np.argsort(step * (self.longest + 5) - length, kind="stable")
        length, start, piece, score, step = (x[order] for x in (length, start, piece, score, step))
        # slots between the bytes, so a word of n bytes has n + 1; total: the best sum there
        here = start + word[start]
        there = here + length
        total, back = np.full(n + len(size), -np.inf), np.full(n + len(size), -1)
        total[offsets[:-1] + np.arange(len(size))] = 0.0
        cuts = np.flatnonzero(np.concatenate([[True], (step[1:] != step[:-1]) | (length[1:] != length[:-1]), [True]]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            value, end = total[here[a:b]] + score[a:b], there[a:b]
            better = np.flatnonzero(value > total[end])
            end = end[better]
            total[end] = value[better]
            back[end] = better + a
        # back from all ends in step
        at, w = back[offsets[1:] + np.arange(len(size))], np.arange(len(size))
        kept_w, kept_at = [], []
        while len(at):
            kept_w.append(w)
            kept_at.append(at)
            more = place[start[at]] > 0
            at, w = back[here[at][more]], w[more]
        kept_w, kept_at = np.concatenate(kept_w), np.concatenate(kept_at)
        order = np.lexsort((start[kept_at], kept_w))
        kept_w, kept_at = kept_w[order], kept_at[order]
        return self._with_bytes(data, kept_w, start[kept_at], length[kept_at], piece[kept_at], len(size))

    def _with_bytes(self, data, word, start, length, piece, words) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters as their bytes' pieces (or as the unknown piece)."""
        lone = piece < 0
        if not self.byte_fallback:
            return np.where(lone, self.unknown, piece).astype(np.int32), np.bincount(word, minlength=words)
        n = np.where(lone, length, 1)
        out = np.repeat(piece, n)
        out[np.repeat(lone, n)] = self.byte_ids[data[ragged(start[lone], length[lone])]]
        return out.astype(np.int32), np.bincount(word, n, minlength=words).astype(np.int64)

    def segment_one(self, word: bytes) -> np.ndarray:
        """The same for one word of any length, place by place."""
        n, base, check, piece = len(word), self.base, self.check, self.piece
        total, back = [0.0] + [-np.inf] * n, [(0, -1)] * (n + 1)
        at = 0
        while at < n:
            b = word[at]
            chars = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            state, single = 0, False
            for k in range(at, n):
                to = int(base[state]) + word[k]
                if check[to] != state:
                    break
                state = to
                if (i := int(piece[state])) >= 0:
                    single |= k + 1 - at == chars
                    if (v := total[at] + float(self.scores[i])) > total[k + 1]:
                        total[k + 1], back[k + 1] = v, (at, i)
                if not base[state]:
                    break
            if not single and (v := total[at] + self.unknown_score) > total[at + chars]:
                total[at + chars], back[at + chars] = v, (at, -1)
            at += chars
        out, end = [], n
        while end:
            at, i = back[end]
            if i >= 0:
                out.append(i)
            elif self.byte_fallback:
                out.extend(int(self.byte_ids[b]) for b in reversed(word[at:end]))
            else:
                out.append(self.unknown)
            end = at
        return np.array(out[::-1], np.int32)

    def encode(self, data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, one after the other, and the texts' offsets in them."""
        data, docs = self._marked(data, docs)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(docs), np.int64)
        space = data == 32
        first = np.zeros(len(data), bool)
        first[docs[:-1][np.diff(docs) > 0]] = True
        if self.by_word:
            first |= space & ~np.concatenate([[False], space[:-1]])
            line = data == 10
            first |= line
            first[1:] |= line[:-1]
        starts = np.flatnonzero(first)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        ids, counts = self._distinct(coded.dictionary)
        number = np.asarray(coded.indices)
        begin = np.concatenate([[0], np.cumsum(counts)])
        each = counts[number]
        out = ids[ragged(begin[number], each)]
        total = np.concatenate([[0], np.cumsum(each)])
        return out, total[np.searchsorted(starts, docs)]

    def _marked(self, data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Markers in the text are spaces already; each non-empty text gets one in front."""
        raw = data.tobytes()
        if MARKER in raw:
            texts = [raw[a:b].replace(MARKER, b" ") for a, b in zip(docs[:-1], docs[1:], strict=True)]
            data = np.frombuffer(b"".join(texts), np.uint8)
            docs = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        if not self.dummy_prefix:
            return data, docs
        full = np.diff(docs) > 0
        return np.insert(data, docs[:-1][full], 32), docs + np.concatenate([[0], np.cumsum(full)])

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)
        size = np.diff(offsets)
        counts = np.zeros(len(words), np.int64)
        # blocks of words of like size: few steps each, and only a block's matches are in memory
        short = np.flatnonzero(size <= LONG_WORD)
        short = short[np.argsort(size[short].astype(np.uint8), kind="stable")]
        ends = np.cumsum(size[short])
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        i = 0
        while i < len(short):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + BLOCK, "right")))
            some = short[i:j]
            own = data[ragged(offsets[:-1][some], size[some])]
            ids, counts[some] = self.segment(own, np.concatenate([[0], np.cumsum(size[some])]))
            parts.append((some, ids))
            i = j
        for w in np.flatnonzero(size > LONG_WORD):
            ids = self.segment_one(data[offsets[w]:offsets[w + 1]].tobytes())
            counts[w] = len(ids)
            parts.append((np.array([w]), ids))
        out, at = np.zeros(counts.sum(), np.int32), np.cumsum(counts) - counts
        for some, ids in parts:
            out[ragged(at[some], counts[some])] = ids
        return out, counts

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of runs of ids: pieces and bytes joined, markers as spaces, without the
        space in front. Bytes that are no UTF-8 become U+FFFD."""
        if not hasattr(self, "_joined"):
            self._joined = np.frombuffer(b"".join(self.texts), np.uint8)
            self._at = np.concatenate([[0], np.cumsum([len(t) for t in self.texts])])
        size = np.diff(self._at)[ids]
        data = self._joined[ragged(self._at[ids], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[offsets]
        begins, stops = ends[:-1].copy(), ends[1:]
        if self.dummy_prefix and len(data):
            full = np.flatnonzero(stops > begins)
            begins[full[data[begins[full]] == 32]] += 1
        kept = data[ragged(begins, stops - begins)]
        out = np.concatenate([[0], np.cumsum(stops - begins)])
        try:
            kept.tobytes().decode()
        except UnicodeDecodeError:
            raw = kept.tobytes()
            return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(out[:-1], out[1:], strict=True)], pa.large_string())
        return pa.LargeStringArray.from_buffers(len(out) - 1, pa.py_buffer(out.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(kept)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_joined", "_at")}


@lru_cache(maxsize=2)
def load(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a SentencePiece model file, which the driver reads."""
    pieces, prefix = [], True
    with open(path, "rb") as f:
        model = f.read()
    for number, value in _fields(model):
        if number == 1:  # a piece: text, score, kind
            own = dict(_fields(value))
            pieces.append((own.get(1, b""), float(own.get(2, 0.0)), own.get(3, NORMAL)))
        elif number == 3:  # the normaliser
            prefix = bool(dict(_fields(value)).get(3, 1))
    return Vocabulary(pieces, prefix)


def encoded(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``n_tokens``. A null text has null ids and 0
    tokens, an empty one no ids. U+2581 in a text counts as a space, as in SentencePiece.
    Every row counts on its own. Columns with the new names are replaced."""
    docs = docs.drop("ids", "n_tokens")
    columns, told = docs.columns, docs.sparkSession.sparkContext.broadcast(load(model))

    def run(batches):
        for batch in batches:
            texts = batch.column(text_col)
            for i, j, data, offsets in text_chunks(texts, CHUNK):
                ids, at = told.value.encode(data, offsets)
                none = texts.slice(i, j - i).is_null()
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids), mask=none if pc.any(none).as_py() else None)
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), lists, pa.array(np.diff(at))], names=[*columns, "ids", "n_tokens"])

    return docs.mapInArrow(frugal(run), T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]))


def decoded(rows: DataFrame, model: str = MODEL, into: str = "decoded") -> DataFrame:
    """``rows`` (with ``ids``) with the text of the ids; null ids give a null text, ids
    outside the vocabulary none."""
    rows = rows.drop(into)
    columns, told = rows.columns, rows.sparkSession.sparkContext.broadcast(load(model))

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = part.column("ids")
                n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = np.asarray(pc.fill_null(lists.flatten(), -1)).astype(np.int64)
                ids = np.where((ids >= 0) & (ids < len(told.value.texts)), ids, told.value.unknown)
                texts = told.value.decode(ids, np.concatenate([[0], np.cumsum(n)])).cast(pa.string())
                texts = pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), texts)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*columns, into])

    return rows.mapInArrow(frugal(run), T.StructType([*rows.schema.fields, T.StructField(into, T.StringType())]))


def tokenised(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, n_tokens, ids, n_byte_tokens, text_restored`` for every row: the ids, how
    many stand for single bytes, and whether decoding them gives the text back (with U+2581
    as a space; null for a null text). Encodes and decodes in one pass over the texts."""
    told = docs.sparkSession.sparkContext.broadcast(load(model))

    def run(batches):
        v = told.value
        single = np.zeros(len(v.texts), np.int64)
        single[v.byte_ids[v.byte_ids >= 0]] = 1
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column("text"), CHUNK):
                ids, at = v.encode(data, offsets)
                restored = pc.equal(v.decode(ids, at), pc.replace_substring(
                    batch.column("text").slice(i, j - i).cast(pa.large_string()), "▁", " "))
                total = np.concatenate([[0], np.cumsum(single[ids])])
                none = batch.column("text").slice(i, j - i).is_null()
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids), mask=none if pc.any(none).as_py() else None)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(np.diff(at)), lists, pa.array(np.diff(total[at])), restored],
                                                 names=["doc_id", "n_tokens", "ids", "n_byte_tokens", "text_restored"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        frugal(run), "doc_id long, n_tokens long, ids array<int>, n_byte_tokens long, text_restored boolean")

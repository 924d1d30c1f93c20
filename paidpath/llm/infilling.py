"""Fill-in-the-middle transformation (operator 11): texts cut between units and rearranged.

A unit is a run of A-Z and a-z, or one other code point. A text is cut after two units into
prefix, middle and suffix, which are written in one of three forms: ``plain`` (the text),
``psm`` (prefix, suffix, middle) and ``spm`` (suffix, prefix, middle), each part behind its
mark. Where and how is decided by a hash of the document's id alone, so a run repeats.

Units are never made into strings. The UTF-8 bytes of many texts are viewed as 64-bit words,
and all eight bytes of a word are classified at once by arithmetic inside the word (SWAR):
the high bit of each byte of a mask says whether a unit ends there. Bits are counted per
word and added up; the word that holds the k-th end is found by binary search, and the byte
in it by comparing the word's running counts with k, again all eight at once.

The cuts are byte offsets, so a text never comes back from Python: Spark cuts and joins the
bytes itself, and restores a text from its output and form with built-in functions alone.
Rows are transformed where they are; nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidpath.llm.tables import bounded_batches
from paidpath.llm.words import text_chunks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"  # of the decisions
SHARE, SUFFIX_FIRST = 90, 20  # of 100: rearranged texts, and of these the suffix-first ones

U = np.uint64
ONES, HIGH = U(0x0101010101010101), U(0x8080808080808080)


def _each(byte: int) -> np.uint64:
    """A word of eight equal bytes."""
    return U(byte) * ONES


def letters(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is one of A-Z and a-z."""
    low = (words & _each(0x7F)) | _each(0x20)  # lower case; at most 0x7F, so no sum below carries over
    from_a, past_z = low + _each(0x80 - ord("a")), low + _each(0x7F - ord("z"))
    return from_a & ~past_z & ~words & HIGH


def continuations(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that continues a code point (10xxxxxx)."""
    return words & ~(words << U(1)) & HIGH


def _following(marks: np.ndarray) -> np.ndarray:
    """Each byte's mark moved to the byte before it, across words."""
    out = marks >> U(8)
    out[:-1] |= marks[1:] << U(56)
    return out


class Marks:
    """Marked bytes: how many lie before a place, and where the k-th is."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Marked bytes before each place."""
        word, shift = places >> 3, (U(8) * (places & 7).astype(np.uint64))
        return self.before[word] + np.bitwise_count(self.words[word] & ((U(1) << shift) - U(1)))

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th marked byte, counted from 1."""
        word = np.searchsorted(self.before, k) - 1
        rest = (k - self.before[word]).astype(np.uint64)
        running = (self.words[word] >> U(7)) * ONES  # byte j: marks in bytes 0 to j
        reached = ((running | HIGH) - rest * ONES) & HIGH
        return 8 * word + 8 - np.bitwise_count(reached)


def unit_marks(data: np.ndarray, offsets: np.ndarray) -> tuple[Marks, Marks]:
    """The unit-ending bytes and the first bytes of code points of the texts of ``data``
    that begin at ``offsets`` (one more at the end)."""
    size = int(offsets[-1])
    padded = np.zeros((size // 8 + 2) * 8, np.uint8)
    padded[:size] = data[:size]
    words = padded.view("<u8")
    letter, inner = letters(words), continuations(words)
    ends = HIGH & ~_following(inner) & ~(letter & _following(letter))
    leads = HIGH & ~inner
    for marks in (ends, leads):  # nothing is marked behind the texts
        marks[size >> 3] &= (U(1) << U(8 * (size & 7))) - U(1)
        marks[(size >> 3) + 1:] = 0
    last = offsets[1:][np.diff(offsets) > 0] - 1
    np.bitwise_or.at(ends, last >> 3, U(0x80) << (U(8) * (last & 7).astype(np.uint64)))
    return Marks(ends), Marks(leads)


CUTS = "n long, prefix_bytes int, middle_bytes int, prefix_chars long, middle_chars long"


def cuts(text: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    """For each text its units, and the bytes and code points of the prefix (the smaller of
    ``first`` and ``second`` modulo units + 1) and of the middle (up to the larger)."""
    h, out = np.stack([np.asarray(first), np.asarray(second)]).astype(np.int64), [[] for _ in range(5)]
    for i, j, data, offsets in text_chunks(text):
        ends, leads = unit_marks(data, offsets)
        begun = ends.rank(offsets)
        n = np.diff(begun)
        unit = np.sort(h[:, i:j] % (n + 1), axis=0)
        at = np.where(unit > 0, ends.select(np.maximum(begun[:-1] + unit, 1)) + 1, offsets[:-1]) if begun[-1] else offsets[:-1] + 0 * unit
        chars = leads.rank(at)
        for into, values in zip(out, (n, at[0] - offsets[:-1], at[1] - at[0], chars[0] - leads.rank(offsets[:-1]), chars[1] - chars[0]), strict=True):
            into.append(values)
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    arrays = [pa.array(np.concatenate(x) if x else np.zeros(0), kind) for x, kind in zip(out, kinds, strict=True)]
    return pa.StructArray.from_arrays(arrays, names=[c.split()[0] for c in CUTS.split(", ")])


def decisions(ids: Column, seed: str = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed``, a colon and the id; a null
    id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ids.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def infilled(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", seed: str = SEED, share: int = SHARE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``docs`` with ``n`` (units), ``form`` (plain, psm, spm), ``prefix_chars`` and
    ``middle_chars`` (code points; null if plain) and ``output`` (the transformed text).

    Of 100 texts about ``share`` are rearranged, and of 100 of these about ``suffix_first``
    into spm. A null or empty text, and one that holds a mark, stays plain (null: empty
    output, 0 units). Rows with equal ids are decided alike, each on its own text; a null id
    counts as an empty one. Very long texts are cut whole. Columns with the new names are
    replaced; without rows there is no result."""
    bounded_batches(docs.sparkSession)
    kept = docs.drop("n", "form", "prefix_chars", "middle_chars", "output")
    names = kept.columns
    rows = kept.toDF(*[f"c{k}" for k in range(len(names))])  # no name clashes
    text = F.coalesce(F.col(f"c{names.index(text_col)}"), F.lit(""))
    h = decisions(F.col(f"c{names.index(id_col)}"), seed)
    found = F.arrow_udf(cuts, CUTS)
    rows = rows.withColumns({"text": text, "h1": h[0], "h2": h[1]}).withColumn("cut", found("text", "h1", "h2"))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains("text", F.lit(mark))
    form = (F.when((F.col("text") == "") | marked | (h[2] % 100 >= share), "plain")
            .when(h[3] % 100 < suffix_first, "spm").otherwise("psm"))
    raw, a, b = F.col("text").cast("binary"), F.col("cut.prefix_bytes"), F.col("cut.middle_bytes")
    prefix, middle, suffix = (F.substring(raw, at, size).cast("string") for at, size in (
        (F.lit(1), a), (a + 1, b), (a + b + 1, F.octet_length("text"))))
    output = (F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
              .otherwise(F.col("text")))
    chars = [F.when(F.col("form") != "plain", F.col(f"cut.{c}")) for c in ("prefix_chars", "middle_chars")]
    return (rows.withColumn("form", form)
            .select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(names)), F.col("cut.n").alias("n"), "form",
                    chars[0].alias("prefix_chars"), chars[1].alias("middle_chars"), output.alias("output")))


def restored(output: Column, form: Column) -> Column:
    """The exact text of an output and its form. No part holds a mark, so the first mark of
    a kind is the one that was written."""
    def between(mark: str, then: str) -> Column:
        return F.split_part(F.split_part(output, F.lit(mark), F.lit(2)), F.lit(then), F.lit(1))

    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
            .otherwise(output))

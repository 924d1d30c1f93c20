"""Fill-in-the-middle against a reading of the rule by regular expression."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paidpath.llm import infilling, registry

SMALL = "/root/testdata/sf0.001"
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def by_rule(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


LETTERS = st.text(st.sampled_from("azAZ@[`{ß 0\n\x00\x7f\x80é漢😀<PSM>"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(LETTERS, st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1)), max_size=8))
@example([("", 0, 0), ("a" * 64, 1, 0), ("é" * 33, 7, 20)])
def test_cuts(rows):
    texts, first, second = ([r[k] for r in rows] for k in range(3))
    got = infilling.cuts(pa.array(texts, pa.string()), pa.array(first, pa.int64()), pa.array(second, pa.int64())).to_pylist()
    for (text, x, y), row in zip(rows, got, strict=True):
        units = UNIT.findall(text)
        a, b = sorted((x % (len(units) + 1), y % (len(units) + 1)))
        p, m = "".join(units[:a]), "".join(units[a:b])
        assert tuple(row.values()) == (len(units), len(p.encode()), len(m.encode()), len(p), len(m))


def test_every_byte_class():
    words = np.arange(256, dtype=np.uint8).view("<u8")
    set_ = lambda marks: set(np.flatnonzero(marks.view(np.uint8) == 0x80).tolist())
    assert set_(infilling.letters(words)) == {*range(65, 91), *range(97, 123)}
    assert set_(infilling.continuations(words)) == set(range(0x80, 0xC0))


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = registry.QUERIES["op11_fill_in_middle"](spark, SMALL).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert len(rows) == len(texts)
    for r in rows:
        *shape, output = by_rule(r["doc_id"], texts[r["doc_id"]])
        assert tuple(r)[1:] == (*shape, sha(output), sha(texts[r["doc_id"]] or ""))


def test_odd_rows(spark, odd, none):
    more = odd.withColumn("n", F.lit("own")).withColumn("cut", F.lit(1)).withColumn("h1", F.lit(2)).withColumn("c0", F.lit(3))
    marks = spark.createDataFrame([(20 + k, f"some text {mark} more", *[None] * 3, 1, 1, 1, "own", 1, 2, 3)
                                   for k, mark in enumerate(("<P>", "<S>", "<M>", "<p>", "<<S", "P>"))], more.schema)
    docs = more.union(marks)
    out = infilling.infilled(docs)
    assert out.columns == [c for c in docs.columns if c != "n"] + ["n", "form", "prefix_chars", "middle_chars", "output"]
    rows = out.withColumn("again", infilling.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == docs.count() and all((r["cut"], r["h1"], r["c0"]) == (1, 2, 3) for r in rows)
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == by_rule(r["doc_id"], r["text"])
        assert r["again"] == (r["text"] or "")
    assert infilling.infilled(none).count() == 0

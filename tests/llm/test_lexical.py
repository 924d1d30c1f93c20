"""Ranked search against scores computed one by one."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paidpath.llm import lexical

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_hand(docs, items, k=20):
    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    big_n, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            n = sum(c.values())
            m = 100 - 25 + (25 * n * big_n) // words
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda x: x[:3])
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(scored[:k])]
    return sorted(out, key=str)


def found(rows):
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.fixture(scope="module")
def tables(spark):
    return [[tuple(r) for r in spark.read.parquet(f"{SMALL}/{t}.parquet").select(i, "text").collect()] for t, i in (("documents", "doc_id"), ("benchmark", "item_id"))]


def test_against_scores_one_by_one(spark, tables, monkeypatch):
    docs, items = (spark.createDataFrame(t, f"{i} long, text string") for t, i in zip(tables, ("doc_id", "item_id"), strict=True))
    assert found(lexical.ranked(docs, items)) == by_hand(*tables)
    # as many buckets as may be, small waves, parts of a few rows, several blocks of items
    monkeypatch.setattr(lexical, "WAVE", 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(lexical.ranked(docs.repartition(3), items, k=3, block_bytes=3000)) == by_hand(*tables, 3)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(spark, odd, none):
    asked = [(1, "ONE three"), (1, "ONE three"), (1, "word"), (None, "text without"), (2, None), (3, "!!"), (4, "absent"), (5, "xyz " + "x" * 50_000)]
    items = spark.createDataFrame([(*r, "own") for r in asked], "item_id long, text string, doc_id string")
    want = by_hand([(r["doc_id"], r["text"]) for r in odd.collect()], [r for r in dict.fromkeys(asked) if r[1]])
    assert found(lexical.ranked(odd, items)) == want and sum(w[:3] in ((1, 1, 4), (1, 2, 4)) for w in want) == 2
    assert lexical.ranked(none, items).count() == 0 and lexical.ranked(odd, none.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
    assert lexical.ranked(odd, items.where("item_id = 3")).count() == 0
    assert lexical.ranked(odd, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_a_third_of_all_rows_are_copies(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(60)]
    docs = [(i, "w1 w2 w3 the") if i % 3 == 0 else (i, " ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(600)]
    items = [(1, "w1 w2 w3"), (2, "the"), (3, "w5 w5 w7 the"), (4, "W59 w58")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found(lexical.ranked(rows, spark.createDataFrame(items, "item_id long, text string"))) == by_hand(docs, items)


def test_bounds_skip_parts_and_documents():
    items = lexical.Items(["rare common", "common"])
    rare, common = (items.terms[0], items.terms[1]) if items.times[0] else (1, 0)
    weights = lexical.Weights(np.array([5, 5]), 1000, 100_000)
    weights.weights = np.array([9000, 9000])
    weights.weights[common] = 10
    search = lexical.Search(items, weights, np.zeros(2, np.int64), 2)
    seen = []
    keep = search._survivors
    search._survivors = lambda *a: seen.append(keep(*a)) or seen[-1]
    n = 50
    holders = np.zeros(n, bool)
    holders[[3, 30]] = True
    size = np.where(holders, 2, 1)
    terms_ = np.concatenate([[rare, common] if h else [common] for h in holders])
    at = np.concatenate([[0], np.cumsum(size)])
    times = np.ones(len(terms_), np.int64)
    lengths = np.full(n, 100)
    impacts = weights.impacts(np.repeat(lengths, size), terms_, times)
    norms = np.sqrt(np.add.reduceat(impacts.astype(float) ** 2, at[:-1]))
    part = (np.arange(n), np.zeros(n, bool), norms, lengths, at, terms_, times)
    search.part(*part)
    assert sorted(search.best[0][2].tolist()) == [3, 30] and sorted(search.best[1][2].tolist()) == [0, 1]
    seen.clear()
    search.part(*part)  # bars are known: only documents with the rare term are walked
    assert sorted(seen[0].tolist()) == [3, 30]
    seen.clear()
    low = ~holders
    search.bars[:] = 10 ** 12
    search.part(np.arange(48), np.zeros(48, bool), norms[low], lengths[low], np.arange(49), np.full(48, common), np.ones(48, np.int64))
    assert not seen  # Cauchy-Schwarz skips the part for both items

"""Rules that must hold at every size: languages of few documents, urns beyond the generator's
limit, and the Kneser-Ney law against a plain reading of it."""

import math
import time
from collections import Counter, defaultdict
from math import comb

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paidpath.llm import langid, sharding

SMALL = "/root/testdata/sf0.001"


class Plain:
    """Interpolated Kneser-Ney over the characters of words between two spaces."""

    def __init__(self, words: dict[str, float], order: int, alphabet: set[str]):
        self.order, self.alphabet = order, alphabet
        raw = [Counter() for _ in range(order + 2)]
        for word, times in words.items():
            w = f" {word} "
            for end in range(2, len(w) + 1):
                for n in range(1, order + 1):
                    if end - n >= 0:
                        raw[n][w[end - n:end]] += times
        self.count = [None] * (order + 1)
        for n in range(1, order + 1):
            before = Counter(g[1:] for g in raw[n + 1])
            self.count[n] = {g: c if n == order or (n > 1 and g[0] == " ") else before[g] for g, c in raw[n].items()}
        self.after = [defaultdict(dict) for _ in range(order + 1)]
        self.discount = [0.0] * (order + 1)
        for n in range(1, order + 1):
            for g, c in self.count[n].items():
                self.after[n][g[:-1]][g[-1]] = c
            n1, n2 = (sum(c == k for c in self.count[n].values()) for k in (1, 2))
            self.discount[n] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    def p(self, context: str, c: str) -> float:
        n = len(context) + 1
        lower = self.p(context[1:], c) if n > 1 else 1 / (len(self.alphabet) + 1)
        own = self.after[n].get(context, {})
        total = sum(own.values())
        if not total:
            return lower
        d = self.discount[n]
        return max(own.get(c, 0) - d, 0) / total + d * sum(v > 0 for v in own.values()) / total * lower

    def bits(self, word: str) -> float:
        w = f" {word} "
        return sum(math.log2(self.p(w[max(0, i - self.order + 1):i], w[i])) for i in range(1, len(w)))


def coded(words):
    return pa.array([np.array([ord(c) for c in w], np.uint32).tobytes() for w in words], pa.large_binary())


@pytest.mark.parametrize("order", [2, 3, 5])
def test_kneser_ney_against_a_plain_reading(order):
    rng = np.random.default_rng(order)
    some = lambda letters, n: {"".join(rng.choice(list(letters), rng.integers(1, 7))): float(rng.integers(1, 5)) for _ in range(n)}
    words = {"x": some("abcd", 60), "y": some("cdef", 40)}
    model = langid.KneserNey({k: (coded(w), np.array(list(w.values()))) for k, w in words.items()}, order)
    alphabet = {c for w in words.values() for x in w for c in f"{x} "}
    asked = [*list(words["x"])[:20], *some("abcdefz", 60), "a", "zzz", "é"]
    got, chars = model.word_bits(coded(asked))
    for i, k in enumerate(model.languages):
        plain = Plain(words[k], order, alphabet)
        assert np.allclose(got[:, i], [plain.bits(w) for w in asked], rtol=0, atol=1e-9)
        assert chars.tolist() == [len(w) + 1 for w in asked]


def test_every_language_is_learned_and_bounded(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("lang IS NOT NULL AND length(text) > 200")
    named = docs.groupBy("lang").count().orderBy(F.desc("count")).collect()
    many, other = named[0]["lang"], named[1]["lang"]
    base = docs.where(F.col("lang") == many).select("doc_id", "text", "lang")
    rare = [r["text"] for r in docs.where(F.col("lang") == other).orderBy("doc_id").limit(4).collect()]
    for first in (5000, 5007, 5014):  # whatever their hash, none of three documents is held back
        three = spark.createDataFrame([(first + k, t, other) for k, t in enumerate(rare[:3])], "doc_id long, text string, lang string")
        found = langid.fit(base.union(three))
        i = found.model.languages.index(other)
        assert np.isfinite(found.mean).all() and found.over[i] > 0
    one = langid.fit(base.union(spark.createDataFrame([(5007, rare[0], other)], "doc_id long, text string, lang string")))
    assert other in one.model.languages and np.isfinite(one.mean).all()
    alone = langid.fit(spark.createDataFrame([(1, rare[0], other), (2, None, "xx")], "doc_id long, text string, lang string"))
    assert alone.model.languages == [other] and np.isfinite(alone.mean).all()
    # noise is rejected whichever language it is nearest to, and the languages' own texts are not
    rng = np.random.default_rng(8)
    letters = list("qxzwvkjypbgfmcdhlu")
    noise = [" ".join("".join(rng.choice(letters, rng.integers(4, 12))) for _ in range(60)) for _ in range(20)]
    own = [r["text"] for r in base.orderBy("doc_id").limit(20).collect()]
    texts = spark.createDataFrame([(k, t) for k, t in enumerate(noise + own + [rare[3]])], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in langid.identified(texts, found).collect()}
    assert not any(rows[k]["lang_accepted"] for k in range(20))
    assert all(rows[k]["lang_accepted"] and rows[k]["lang_pred"] == many for k in range(20, 40))
    assert rows[40]["lang_accepted"] and rows[40]["lang_pred"] == other


def test_halved_urns_follow_the_hypergeometric_law(monkeypatch):
    monkeypatch.setattr(sharding, "URN", 4)
    rng = np.random.default_rng(2)
    for good, bad, n in ((9, 13, 8), (2, 30, 17), (25, 1, 6), (7, 7, 14), (6, 0, 4), (0, 9, 3)):
        draws = 20_000
        seen = Counter(sharding._draw(rng, good, bad, n) for _ in range(draws))
        law = {k: comb(good, k) * comb(bad, n - k) / comb(good + bad, n) for k in range(max(0, n - bad), min(good, n) + 1)}
        assert seen.keys() <= law.keys()
        chi = sum((seen[k] - draws * p) ** 2 / (draws * p) for k, p in law.items() if draws * p >= 5)
        cells = sum(draws * p >= 5 for p in law.values())
        assert chi <= cells + 5 * math.sqrt(2 * cells)


def test_ten_billion_rows_are_drawn_in_seconds():
    began = time.perf_counter()
    counts = np.array([4_000_000_000, 1, 0, 6_000_000_000, 2_500_000_007])
    m = sharding.communication_matrix(counts, 16, 3)
    assert m.sum(1).tolist() == counts.tolist() and m.sum(0).max() - m.sum(0).min() <= 1 and (m >= 0).all()
    assert time.perf_counter() - began < 5
    # counts stay within some deviations of their means
    mean = counts[:, None] * m.sum(0)[None, :] / counts.sum()
    assert (np.abs(m - mean) <= 6 * np.sqrt(mean) + 1).all()


def test_shuffle_keeps_columns_of_any_name(spark):
    docs = spark.range(50).selectExpr("id AS doc_id", "777 AS _key", "'b' AS _bucket", "1.5D AS _before", "'mine' AS shard", "id AS c0")
    out = sharding.shuffled(docs, 4)
    assert out.columns == ["doc_id", "_key", "_bucket", "_before", "c0", "shard", "slot"]
    rows = out.collect()
    assert len(rows) == 50 and all((r["_key"], r["_bucket"], r["_before"], r["c0"]) == (777, "b", 1.5, r["doc_id"]) for r in rows)
    assert sorted((r["shard"], r["slot"]) for r in rows) == sorted((k % 4, k // 4) for k in range(50))

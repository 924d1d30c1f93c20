"""Token counts against the tokenizers library on whole texts."""

import json

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paidpath.llm import registry, tokencounts
from paidpath.llm.words import span_hashes

SMALL = "/root/testdata/sf0.001"
FILE = tokencounts.default_tokenizer()
LIBRARY = Tokenizer.from_file(FILE)
NO_TABLE = tokencounts.LengthTable(np.zeros(0, np.uint64), np.zeros(0, np.int64))
COUNTER = tokencounts.TokenCounter(tokencounts.PreTokens(open(FILE, encoding="utf-8").read()), NO_TABLE)
PARTS = ["'", "s", "t", "re", "ve", "m", "ll", "d", "S", " ", "  ", "\n", "\t", "\x00", "\x1c", "\x85", " ", "　", "a", "é", "ß", "漢", "́", "1", "٣", "²", "Ⅷ",
         "!", "-", "😀", "​", "<|endoftext|>", "<|endof", "text|>", "<|"]


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), st.text(max_size=20)), max_size=6))
@example(["<|endof", "text|>", "'", "s", " ", "'re", "x'll'd  ", "  \n x", ""])
def test_counts_of_any_texts(texts):
    assert COUNTER.count(pa.array(texts, pa.string())).to_pylist() == [library(t) for t in texts]


def test_table_holds_what_it_is_given():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(1, 2**63, 5000, dtype=np.uint64) << np.uint64(7))  # all in few first places
    lengths = rng.integers(1, 400, len(keys))
    table = tokencounts.LengthTable(keys, lengths)
    assert (table.find(keys) == np.where(lengths < 256, lengths, 0)).all()
    assert not table.find(rng.integers(1, 2**63, 5000, dtype=np.uint64) << np.uint64(7) | np.uint64(1)).any()
    assert not NO_TABLE.find(keys).any()


def test_query_for_any_table_and_cache(spark, monkeypatch):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in registry.QUERIES["op12_token_counts"](spark, SMALL).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        n = library(text)
        assert tuple(rows[i])[1:] == (len((text or "").encode()), n, n > 1024)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for entries in (0, 3, 500):
        counter = tokencounts.token_counter(docs, entries=entries)
        assert np.count_nonzero(counter.table.keys) == entries
        monkeypatch.setattr(tokencounts, "CACHED", 50)
        assert counter.count(pa.array(list(texts.values()))).to_pylist() == [rows[i]["n_tokens"] for i in texts]
        assert len(counter.cache) <= 50


def test_frequent_pre_tokens(spark):
    docs = spark.createDataFrame([(" of the", ), ("of the of", ), (None,), ("the the 'tis",)], "text string")
    assert tokencounts.frequent(docs, COUNTER.split, entries=2) == [b" the", b" of"]
    key = span_hashes(np.frombuffer(b" the", np.uint8), np.array([0]), np.array([4]), lower=False)
    assert tokencounts.token_counter(docs).table.find(key).tolist() == [1]


def test_odd_rows(spark, odd, none):
    docs = odd.withColumn("n_tokens", F.lit("own")).union(
        spark.createDataFrame([(30, "<|endoftext|> and <|endoftext|><|endoftext|>", *[None] * 3, 1, 1, 1, "own")], odd.withColumn("n_tokens", F.lit("own")).schema))
    out = tokencounts.counted(docs)
    assert sorted(out.columns) == sorted(docs.columns)
    rows = out.collect()
    assert len(rows) == docs.count() and all(r["n_tokens"] == library(r["text"]) for r in rows)
    assert tokencounts.counted(none).count() == 0


def test_other_kinds_of_tokenizers_are_refused(tmp_path):
    told = json.loads(COUNTER.split.definition)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"added_tokens": [told["added_tokens"][0] | {"lstrip": True}]}):
        with pytest.raises(ValueError):
            tokencounts.PreTokens(json.dumps(told | change))

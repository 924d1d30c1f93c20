"""The corpus pipeline: documents with a known language, one of each group of near copies,
without repeated passages and benchmark items, as SentencePiece ids.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its
result is written and read again as the next one's docs. All but the last return the columns
of documents, with n_chars following the text. Nulls: a null text has no language and goes
in the first stage; null ids keep their row in every stage. No stage drops other rows than
those its function names."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from paidpath.llm import decontaminate, jaccard, langid, passages, sentencepieces
from paidpath.llm.tables import read, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models accept: no null text, none without a letter and
    none that is improbable under every language. Learns from the documents' own lang."""
    rows = langid.identified(docs, langid.fit(docs.select("doc_id", "text", "lang")))
    return rows.where("lang_accepted").select(docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, a similarity of 0.8 or more): the
    one with the smallest doc_id. Documents without a word, and rows without doc_id, stay; a
    doc_id that stands for different texts loses only those that are copies."""
    return jaccard.one_of_each(docs, n=5, percent=80)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every passage of 50 words or more left at its first place only."""
    return passages.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark windows; those that are mostly such words go."""
    return decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document: doc_id, n_tokens, ids, n_byte_tokens, text_restored."""
    return sentencepieces.tokenised(docs)


STAGES = [("language ID", language_id), ("n-gram Jaccard join", jaccard_join), ("suffix-array dedup", suffix_array_dedup),
          ("benchmark decontamination", decontamination), ("SentencePiece encoding and decoding", sentencepiece)]
ORACLE_SQL = None  # SQL can express neither the language models nor the Viterbi segmentation


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

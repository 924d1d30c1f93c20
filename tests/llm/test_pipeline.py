"""The pipeline against its stages' own rules, and without rows."""

import re

import corpus_pipeline
from paidpath.llm import decontaminate, jaccard, passages

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, seen[-1], SMALL), name.replace(" ", "-"))
        assert out.columns == docs.columns
        seen.append(out)
    _, languages, single, unrepeated, clean = seen
    assert languages.count() >= 0.98 * docs.count()
    kept = {r["doc_id"] for r in single.collect()}
    assert kept == {r["component_id"] for r in jaccard.jaccard_components(languages, 5, 80).collect()}
    assert not passages.repeated_spans(unrepeated).where("n_later > 0").count()
    assert not decontaminate.contamination(clean, bench).where("contaminated").count()
    assert not clean.where("n_chars <> length(text)").count()
    rows = corpus_pipeline.STAGES[-1][1](spark, clean, SMALL).collect()
    assert len(rows) == clean.count() and all(r["text_restored"] for r in rows)


def test_stages_of_odd_and_of_no_rows(spark, odd, none):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SMALL).count() <= 10
        assert stage(spark, none, SMALL).count() == 0
    assert re.fullmatch(r"(\w| |-)+", corpus_pipeline.STAGES[0][0])


OWN = "slot long, cuts string, cls string, id int, kept int, place string, c0 int, first string, _key int, _bucket int, n_words int, hits string"


def test_columns_of_any_name_come_through(spark):
    """Every stage but the last returns all columns as they were, whatever their names."""
    long = " ".join(f"the word{k} of and" for k in range(30))
    rows = [(1, "the first text is of the best " + long, 1), (2, "the first text is of the best " + long, 2), (3, "and here is another one " + long, 3),
            (4, "this one is of nothing but itself and the rest", 4), (None, "this is a text without an id of its own", 5)]
    own = (777, "x", "y", 5, 6, "z", 7, "w", 8, 9, 10, "v")
    schema = "doc_id long, text string, mark int, lang string, source string, n_chars long, " + OWN
    docs = spark.createDataFrame([(i, t, m, "en", None, len(t), *own) for i, t, m in rows], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        got = out.collect()
        assert got and all(tuple(r)[6:] == own for r in got), name
        assert len({r["mark"] for r in got}) == len(got), name


def test_texts_that_share_an_id_are_told_apart(spark):
    words = lambda a, n: " ".join(f"{a}{k}" for k in range(n))
    base, passage = words("a", 40), words("p", 60)
    rows = [(1, base), (1, words("b", 40)), (1, words("b", 40)), (2, base + " more"), (2, words("c", 40)), (3, words("c", 40)), (4, ""), (4, ""),
            (None, base), (5, words("d", 9) + " " + passage), (6, words("e", 9) + " " + passage), (6, words("f", 30)), (6, passage + " " + words("g", 9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    single = sorted(map(tuple, corpus_pipeline.jaccard_join(spark, docs, SMALL).collect()), key=repr)
    assert single == sorted([(1, base), (1, words("b", 40)), (2, words("c", 40)), (4, ""), (4, ""), (None, base), *rows[9:]], key=repr)
    left = sorted(map(tuple, corpus_pipeline.suffix_array_dedup(spark, docs.where("doc_id >= 5"), SMALL).collect()), key=repr)
    assert left == sorted([(5, rows[9][1]), (6, words("e", 9) + " "), (6, words("f", 30)), (6, words("g", 9))], key=repr)


def test_near_copies_are_pairs_of_five_words_and_four_fifths(spark):
    """A pair with a similarity of 0.815 of five-word shingles, which four words and 85 % miss."""
    a = [f"w{k}" for k in range(200)]
    b = [f"x{k}" if k in (30, 80, 120, 170) else w for k, w in enumerate(a)]
    c = [f"y{k}" if k % 20 == 3 else w for k, w in enumerate(a)]  # ten changes: no copy
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate((a, b, c))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.jaccard_join(spark, docs, SMALL).collect()) == [0, 2]

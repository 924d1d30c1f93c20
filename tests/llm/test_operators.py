"""The training-data operators against brute force, exact round trips and odd inputs."""

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from paidpath.llm import (crossentropy, decontaminate, jaccard, langid, neighbours, passages, quality, registry,
                          sentencepieces, sharding, warc)

SMALL = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def chunk(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)


# 1
def best_score(v, text):
    """The greatest sum of scores, by trying every piece at every place."""
    raw = (" " + text.replace("▁", " ")).encode()
    pieces = {t: s for t, s in zip(v.texts, v.scores, strict=True) if t}
    best = [0.0] + [-np.inf] * len(raw)
    for i in range(len(raw)):
        if best[i] == -np.inf:
            continue
        for n in range(1, min(v.longest, len(raw) - i) + 1):
            if (s := pieces.get(raw[i:i + n])) is not None and v.piece_ids.get(raw[i:i + n]):
                best[i + n] = max(best[i + n], best[i] + s)
        if raw[i] & 0xC0 != 0x80:
            n = len(raw[i:].decode()[0].encode())
            best[i + n] = max(best[i + n], best[i] + v.unknown_score)
    return best[-1]


def test_pieces_have_the_best_score_and_round_trip(docs):
    v = sentencepieces.load()
    byte = set(v.byte_ids.tolist())
    v.piece_ids = {t: True for i, t in enumerate(v.texts) if t and i not in byte}
    texts = [t[:400] for t in [r["text"] for r in docs.select("text").limit(25).collect()]]
    texts += ["", " ", "  two  spaces ", "日本語 🎉", "a▁b", "é" * 150, "tab\tline\r\nend\n", "\x00\x01"]
    data, at = chunk(texts)
    ids, ends = v.encode(data, at)
    assert v.decode(ids.astype(np.int64), ends).to_pylist() == [t.replace("▁", " ") for t in texts]
    for text, a, b in zip(texts, ends[:-1], ends[1:], strict=True):
        if not text:
            assert a == b
            continue
        # an unknown character is paid once, whatever its bytes
        own, total, i = ids[a:b].tolist(), 0.0, 0
        while i < len(own):
            if own[i] in byte:
                first = v.texts[own[i]][0]
                n = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                total, i = total + v.unknown_score, i + n
            else:
                total, i = total + v.scores[own[i]], i + 1
        assert total == pytest.approx(best_score(v, text))


def test_long_words_take_the_same_path(docs):
    v = sentencepieces.load()
    text = "".join(words(docs.first()["text"]))[:900]
    one = v.segment_one(b" " + text.encode())
    raw = (" " + text).encode()
    ids, _ = v.segment(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert ids.tolist() == one.tolist()


def test_pieces_of_odd_rows(odd, none):
    rows = sentencepieces.tokenised(odd).collect()
    assert len(rows) == 10 and all(r["text_restored"] for r in rows if r["ids"] is not None)
    assert [(r["n_tokens"], r["text_restored"]) for r in rows if r["ids"] is None] == [(0, None)]
    assert sentencepieces.tokenised(none).count() == 0


# 2
def test_language_held_out_accuracy(spark):
    rows = registry.op2_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows) and np.mean([r["accepted"] for r in rows]) > 0.98


def test_kneser_ney_sums_to_one():
    import pyarrow as pa
    coded = lambda w: np.array([ord(c) for c in w], np.uint32).tobytes()
    some = ["ab", "abc", "bca", "cab", "aab"]
    model = langid.KneserNey({"x": (pa.array([coded(w) for w in some], pa.large_binary()), np.array([3.0, 1, 2, 1, 1]))}, 3)
    # all words of up to two letters over the alphabet and one unseen letter, against the mass of longer ones
    letters = ["a", "b", "c", "?"]
    p = lambda w: 2 ** model.word_bits(pa.array([coded(w)], pa.large_binary()))[0][0, 0]
    g = langid.Grams(pa.array([coded("ab")], pa.large_binary()))
    assert g.codes.tolist() == [32, 97, 98, 32] and p("ab") > p("ba") > p("??")
    total = p("") + sum(p(a) for a in letters) + sum(p(a + b) for a in letters for b in letters) + sum(
        p(a + b + c) for a in letters for b in letters for c in letters)
    assert 0.5 < total <= 1 + 1e-9


def test_language_of_odd_rows(odd, none):
    rows = langid.identified(odd, langid.fit(odd)).collect()
    assert len(rows) == 10
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in rows)
    assert langid.fit(none) is None and langid.identified(none, None).count() == 0
    assert {r["lang_pred"] for r in langid.identified(odd, None).collect()} == {"und"}


# 3
def test_cross_entropy_difference(spark, docs, odd, none):
    target = docs.where("lang = 'de'")
    rows = {r["doc_id"]: r for r in crossentropy.cross_entropy_difference(docs, target).collect()}
    mean = lambda lang: np.mean([rows[r["doc_id"]]["score"] for r in docs.where(F.col("lang") == lang).collect()])
    assert mean("de") > 0.3 and mean("en") < -0.3
    model = 2.0 ** crossentropy.log_model(np.random.default_rng(1).integers(0, 9, (20, 20)).astype(float))
    assert model.sum(1) == pytest.approx(np.ones(20), abs=1e-4)
    got = crossentropy.cross_entropy_difference(odd, none).collect()
    assert len(got) == 10 and all(r["score"] == 0 for r in got)
    assert crossentropy.cross_entropy_difference(none, none).count() == 0


def test_cross_entropy_of_rare_words_against_a_dense_model(spark):
    # more words than the former cap of 1,535 and its 512 classes could tell apart, each in two documents
    rng = np.random.default_rng(4)
    rare = rng.permutation(np.repeat([f"w{i}" for i in range(3000)], 2))
    rows = [(i, " ".join(["The", *rare[i * 60:i * 60 + 60], "the"])) for i in range(100)]
    rows += [(7, rows[7][1]), (7, "w1 w1 w2"), (None, "w1 w2"), (200, None), (201, "")]
    wanted = [0, 7, 50, 201, 999]
    flow = [["", *words((t or "").translate(LOWER)), ""] for _, t in rows]
    number = {w: k for k, w in enumerate(sorted({w for f in flow for w in f}))}
    counts = np.zeros((2, len(number), len(number)))
    for (i, _), f in zip(rows, flow, strict=True):
        for a, b in zip(f, f[1:], strict=False):
            counts[:, number[a], number[b]] += [i in wanted, 1]
    logs = [crossentropy.log_model(counts[0]), crossentropy.log_model(counts[1] * counts[0].sum() / counts[1].sum())]
    want = []
    for (i, _), f in zip(rows, flow, strict=True):
        bits = [-np.mean([m[number[a], number[b]] for a, b in zip(f, f[1:], strict=False)]) for m in logs]
        want.append((-1 if i is None else i, len(f) - 2, *bits, bits[1] - bits[0]))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(i,) for i in [*wanted, 7, None]], "doc_id long")
    for sizes in ((2_000, 3_000), (1 << 20, 1 << 20)):
        got = [(-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, crossentropy.cross_entropy_difference(table, target, *sizes).collect())]
        for x, y in zip(sorted(got), sorted(want), strict=True):
            assert x == pytest.approx(y, abs=1e-9)


# 4
def test_neighbours_recall_and_ties(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    copies = rows.where("vec_id = 50").select((F.col("vec_id") + 1_000_000).alias("vec_id"), "embedding", "label")
    bad = spark.createDataFrame([(9_000_050, None, 1), (9_000_100, [0.0] * 64, 1), (9_000_150, [float("nan")] * 64, 1),
                                 (9_000_200, [None] * 64, 1), (9_000_250, [1.0], 1)], rows.schema)
    table = rows.unionByName(copies).unionByName(bad).unionByName(rows.limit(5))
    found = neighbours.nearest(table).collect()
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in rows.unionByName(copies).collect()}
    ids = np.array(sorted(x))
    unit = np.stack([x[i] / np.linalg.norm(x[i]) for i in ids])
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append(r["vec_id"])
    hits = total = 0
    for q in [i for i in ids if i % 50 == 0]:
        s = np.round(unit @ unit[np.searchsorted(ids, q)], 13)
        s[ids == q] = -9
        hits += len(set(ids[np.lexsort((ids, -s))[:5]]) & set(got[q]))
        total += 5
    assert hits / total >= 0.95 and got[50][0] == 1_000_050 and set(got) == {i for i in ids if i % 50 == 0}
    few = neighbours.nearest(rows.limit(3), is_query=F.col("vec_id") >= 0)
    assert few.count() == 6
    assert neighbours.nearest(rows.limit(0)).count() == 0


def test_neighbours_of_rows_given_several_times(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding")
    one = sorted(map(tuple, neighbours.nearest(rows).collect()))
    many = rows.crossJoin(spark.range(6).select(F.lit(1)).toDF("x")).drop("x")
    assert sorted(map(tuple, neighbours.nearest(many).collect())) == one
    few = neighbours.nearest(rows.limit(3).crossJoin(spark.range(10)).drop("id"), is_query=F.col("vec_id") >= 0)
    assert few.count() == 6
    # one vec_id with many different rows hides no other
    rng = np.random.default_rng(8)
    table = [(0, [1.0, 0.0, 0.0])] + [(1, [1.0, float(e), 0.0]) for e in rng.uniform(0, 0.01, 200)] + [(i, [1.0, 0.0, i / 10]) for i in range(2, 9)]
    got = neighbours.nearest(spark.createDataFrame(table, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 3, 4, 5]


# 5
def brute_components(rows, n=4, percent=85):
    sets = {}
    for i, text in rows:
        w = words((text or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("long_list", [2, 48])
def test_jaccard_against_brute_force(spark, monkeypatch, long_list):
    monkeypatch.setattr(jaccard, "LONG_LIST", long_list)
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(60)]
    rows = [(0, " ".join(base)), (1, " ".join(base).upper())]
    for i in range(2, 60):  # near copies of several distances, also tiny texts
        w = base[: int(rng.integers(1, 60))] if i % 3 else list(base)
        for _ in range(int(rng.integers(0, 4))):
            w[int(rng.integers(len(w)))] = f"x{rng.integers(5)}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize(("block", "pairs"), [(4, 0), (4, 1), (256, 0), (4, 1000)])
def test_jaccard_long_lists_against_brute_force(spark, monkeypatch, block, pairs):
    """Blocks whose sets meet, and blocks of which only pairs that may link are compared."""
    for name, value in (("LONG_LIST", 2), ("BLOCK", block), ("PAIRS_A_MEMBER", pairs)):
        monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(6)
    rows = []
    for i in range(60):
        w = [f"w{k}" for k in range(80 + 40 * (i % 2))]
        for _ in range(int(rng.integers(0, 5))):
            w[int(rng.integers(len(w)))] = f"x{rng.integers(9)}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_classes(
        spark.createDataFrame(rows, "doc_id long, text string"), star_rounds=1).groupBy("component").agg(
        F.min("doc_id").alias("component_id"), F.collect_list(F.struct("doc_id", "n_shingles")).alias("r")).selectExpr(
        "component_id", "inline(r)").collect()}
    assert got == brute_components(rows)


def test_jaccard_likely_pairs_are_those_that_may_link():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, n, replace=False), rng.integers(0, 2**63, n // 10 + 1).astype(np.uint64)]))
            for n in [9, 30, 31, 33, 60, 64, 70, 900, 1000, 1100, 2500, 2600, 2999, 3000]]
    sets += [np.unique(s[1:]) for s in sets] + [np.arange(300, dtype=np.uint64)]  # the last has a capped cell
    sets += [np.unique(np.concatenate([sets[-1], base[:8]]))]
    size, comp = np.array([len(s) for s in sets]), np.arange(len(sets)) // 2
    cells = [jaccard.cells_of(s) for s in sets]
    u, v = jaccard.likely_pairs(cells, size, comp[:, None] != comp, 85)
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if comp[a] != comp[b]
            and 100 * min(size[a], size[b]) >= 85 * max(size[a], size[b]) and jaccard.may_link(cells[a], cells[b], len(sets[a]), len(sets[b]), 85)}
    assert len(want) > 14 and sorted(zip(np.minimum(u, v).tolist(), np.maximum(u, v).tolist(), strict=True)) == sorted(want)


def test_jaccard_long_lists_send_no_sets_that_cannot_link(spark, monkeypatch):
    """Documents that share a passage, and so their keys, but are too different to link."""
    seen, lists = [], []
    sets_of, long_lists = jaccard._sets_of, jaccard._long_lists

    def counted(docs, holders, classes, n):
        seen.append(classes.count())
        return sets_of(docs, holders, classes, n)

    def listed(docs, holders, members, n, percent):
        lists.append(members.count())
        return long_lists(docs, holders, members, n, percent)

    for name, value in (("LONG_LIST", 2), ("_sets_of", counted), ("_long_lists", listed)):
        monkeypatch.setattr(jaccard, name, value)
    rows = [(i, " ".join([f"c{k}" for k in range(40)] + [f"u{i}x{k}" for k in range(30)])) for i in range(30)]
    assert len({r["component_id"] for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}) == 30
    assert lists[0] > 100 and sum(seen) == 0


def _family(n, seed=8):
    """Near copies of one text with up to thirty own words each; some link with no other."""
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        w = [f"w{k}" for k in range(150)]
        for k in rng.choice(150, int(rng.integers(0, 30)), replace=False):
            w[k] = f"x{i}y{k}"
        rows.append((i, " ".join(w)))
    return rows


def test_jaccard_long_lists_of_near_copies_are_not_dealt_in_squares(spark, monkeypatch):
    """A family of near copies: what is left for blocks is far less than all by all."""
    sent, written = [], jaccard.written

    def counted(df, name):
        out = written(df, name)
        if name == "open":
            sent.append(out.groupBy("key").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * F.ceil(F.col("n") / jaccard.BLOCK))).first()[0] or 0)
        return out

    for name, value in (("LONG_LIST", 8), ("BLOCK", 4), ("written", counted)):
        monkeypatch.setattr(jaccard, name, value)
    rows = _family(160)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)
    assert sent[-1] < sent[1] / 4, sent  # what was left after the two rounds of centres met block by block


def test_jaccard_shared_shingles_bound_every_overlap(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "WHOLE_SET", 40)
    rows = [*_family(30), *((100 + i, t + " " + " ".join(f"z{k}" for k in range(40))) for i, t in _family(20, 9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    data = [np.frombuffer(t.encode(), np.uint8) for _, t in rows]
    sets = [jaccard.shingle_sets(d, np.array([0, len(d)]), 4)[0] for d in data]
    keys = [jaccard.class_key(s) for s in sets]
    holders = spark.createDataFrame([(k, i) for k, (i, _) in zip(keys, rows, strict=True)], "cls long, doc_id long")
    shared = {r["cls"]: r["shared"] for r in jaccard._shared_shingles(docs, holders, holders.select("cls"), 4, 85).collect()}
    near = lambda a, b: 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b))
    most = {k: max(len(np.intersect1d(a, b)) for b, other in zip(sets, keys, strict=True) if other != k and near(a, b)) for k, a in zip(keys, sets, strict=True)}
    assert shared.keys() == most.keys() and all(shared[k] >= most[k] for k in most)
    assert sum(shared[k] < len(s) for k, s in zip(keys, sets, strict=True)) > 20


def test_jaccard_of_odd_rows(odd, none):
    rows = jaccard.jaccard_components(odd).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert len(rows) == 10 and got[1] == (0, 1) and got[2] == (0, 2) and got[4] == (1, 4) and got[5] == (1, 5)
    assert got[None] == got[6] == (1, 6)  # equal to document 6
    assert jaccard.jaccard_components(none).count() == 0


# 6
def test_warc_round_trip_over_small_ranges(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    more = spark.createDataFrame([(10_001, None, None), (10_002, "http://a b\nc", ""), (None, "x", "q"), (10_003, "z", "q")], pages.schema)
    pages = pages.unionByName(more).unionByName(pages.limit(9).withColumn("page_id", F.col("page_id") + 50_000))
    rows = pages.collect()
    last = {}
    for r in rows:
        last[r["html"] or ""] = max(last.get(r["html"] or "", -1), -1 if r["page_id"] is None else r["page_id"])
    want = sorted(repr((r["page_id"], len((r["html"] or "").encode()), base64.b32encode(hashlib.sha1((r["html"] or "").encode()).digest()).decode(),
                        "response" if last[r["html"] or ""] == r["page_id"] else "revisit",
                        None if last[r["html"] or ""] == r["page_id"] else last[r["html"] or ""])) for r in rows)
    got = warc.archived_pages(pages, archive_bytes=30_000, range_bytes=7_000)
    assert sorted(repr(tuple(r)) for r in got.collect()) == want
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_ranges_own_the_records_that_start_inside(tmp_path):
    import gzip
    import io
    members = [warc.record(i, None, bytes([i % 251]) * (i * 997 % 5000) + warc.MAGIC * 20) for i in range(40)]
    whole = b"".join(members) + b"\0"
    assert gzip.decompress(whole).count(b"WARC/1.1\r\n") == 40

    class File(io.BytesIO):
        def size(self):
            return len(whole)

        def read_at(self, n, at):
            self.seek(at)
            return self.read(n)
    starts = np.concatenate([[0], np.cumsum([len(m) for m in members])[:-1]]).tolist()
    for step in (100, 1013, 10**6):
        assert [p for a in range(0, len(whole), step) for p, _, _ in warc.records_in(File(whole), a, a + step)] == starts


# 7
def brute_repeats(rows, length):
    at, size = defaultdict(set), {}
    for i, text in rows:
        w = words(text)
        size[i] = len(w)
        for k in range(len(w) - length + 1):
            at[tuple(w[k:k + length])].add((i, k))
    every, later = ({i: set() for i in size} for _ in range(2))
    for places in at.values():
        if len(places) > 1:
            for i, k in places:
                every[i] |= set(range(k, k + length))
                if (i, k) != min(places):
                    later[i] |= set(range(k, k + length))
    return {i: v for i, v in every.items() if v}, later


def test_repeated_passages_against_brute_force(spark, docs):
    rng = np.random.default_rng(3)
    parts = [[f"p{i}_{k}" for k in range(70)] for i in range(3)]
    rows = [(i, " ".join(sum(([f"u{i}_{j}_{k}" for k in range(int(rng.integers(0, 30)))] + parts[int(rng.integers(3))][int(rng.integers(0, 15)):int(rng.integers(45, 71))]
                              for j in range(3)), []))) for i in range(25)]
    rows += [(100, "same " * 200), (101, "same " * 120 + "end"), (102, " ".join(f"q{k}" for k in range(80)))]
    rows += [(102, rows[-1][1])]  # one document given twice repeats nothing
    rows += [(r["doc_id"] + 1000, r["text"]) for r in docs.select("doc_id", "text").limit(60).collect()]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    every, later = brute_repeats(rows, 50)
    covered = lambda spans: {k for x in spans for k in range(x["start"], x["end"])}
    found = {r["doc_id"]: r for r in passages.repeated_spans(table).collect()}
    assert {i: covered(r["spans"]) for i, r in found.items()} == every
    assert all(covered(r["later"]) <= later[i] for i, r in found.items())
    kept = {r["doc_id"]: r["text"] for r in passages.without_repeats(table.dropDuplicates(["doc_id"])).collect()}
    assert kept[102] == dict(rows)[102] and all(i in kept for i in dict(rows) if i not in every)


def test_later_places_against_brute_force(spark):
    # a passage in A and B, each of which shares its surroundings with another document
    def four(i, n):
        word = lambda name, size: [f"{name}{i}_{k}" for k in range(size)]
        a, b, p = word("a", 80), word("b", 80), word("p", n)
        left, right = a[:40] + p + a[40:], b[:40] + p + b[40:]
        return [word("u", 9) + left, left + word("v", 9), word("x", 9) + right, right + word("y", 9)]
    texts = [t for i in range(48) for t in four(i, (50, 51, 55, 60, 65, 75)[i % 6])]
    rng = np.random.default_rng(6)
    rows = [(int(i), " ".join(t)) for i, t in zip(rng.permutation(len(texts)), texts, strict=True)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    every, later = brute_repeats(rows, 50)
    covered = lambda spans: {k for x in spans for k in range(x["start"], x["end"])}
    found = {r["doc_id"]: r for r in passages.repeated_spans(table).collect()}
    assert {i: covered(r["spans"]) for i, r in found.items()} == every
    assert {i: covered(r["later"]) for i, r in found.items()} == {i: later[i] for i in every}


def test_repeated_passages_of_odd_rows(odd, none):
    rows = passages.repeated_spans(odd).collect()
    assert [r["doc_id"] for r in rows] == [5] and rows[0]["n_repeated"] == 30_000
    assert passages.repeated_spans(none).count() == 0 and passages.without_repeats(none).count() == 0
    assert passages.without_repeats(odd).columns == odd.columns


# 8
def test_quality_held_out(spark):
    rows = registry.op8_quality(spark, "/root/testdata/sf0.1").collect()
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(r["score"], r["predicted"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    good, bad = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert np.mean([[g > b for g in good] for b in bad]) > 0.97 and np.mean([p == y for _, p, y in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (3, 1), (4, 1), (5, 0), (6, 1), (7, None), (8, 0)], "doc_id long, quality int")
    assert len(quality.quality_scores(odd, labels).where("score BETWEEN 0 AND 1").collect()) == 10
    assert {r["score"] for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(none, labels).count() == 0


# 9
def test_decontamination_against_brute_force(spark, docs):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    bench = bench.unionByName(spark.createDataFrame([(900, "the"), (901, "of THE and"), (902, ""), (903, "!!"), (904, None), (901, "of the and")], bench.schema))
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for r in bench.collect():
        w = split(r["text"])
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k:k + n])].add(r["item_id"])
    sizes = {len(k) for k in windows}
    for block_words in (700, 200_000):
        got = {r["doc_id"]: tuple(r)[1:] for r in decontaminate.contamination(docs, bench, block_words=block_words).collect()}
        for r in docs.collect():
            w, hit, items = split(r["text"]), set(), set()
            for n in sizes:
                for k in range(len(w) - n + 1):
                    if own := windows.get(tuple(w[k:k + n])):
                        items |= own
                        hit |= set(range(k, k + n))
            assert got[r["doc_id"]] == (len(w), len(hit), len(items), decontaminate.digest(list(items)), bool(hit))


def test_decontamination_of_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "one two three"), (None, "the text")], "item_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_hit"], r["n_items"]) for r in decontaminate.contamination(odd, bench).collect())
    assert got == [(0, 2, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 3, 1), (4, 3, 1), (5, 0, 0), (6, 2, 0), (7, 0, 0), (8, 0, 0)]
    assert decontaminate.contamination(none, bench).count() == 0
    assert not decontaminate.contamination(odd, bench.limit(0)).where("contaminated").count()
    kept = decontaminate.decontaminated(odd, bench)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 5, 6, 7, 8]


# 10
def test_sharding_is_exact_and_repeatable(spark, docs, odd, none):
    table = docs.select("doc_id", "text")
    a, b = (sorted((r["shard"], r["slot"], r["doc_id"]) for r in sharding.shuffled(table, 16).collect()) for _ in range(2))
    assert a == b and [x[:2] for x in a] == sorted((k % 16, k // 16) for k in range(200))
    m = sharding.communication_matrix(np.array([5, 0, 70, 13]), 7, 1)
    assert m.sum(1).tolist() == [5, 0, 70, 13] and set(m.sum(0)) == {12, 13} and (m >= 0).all()
    first = [sharding.communication_matrix(np.array([10, 10]), 2, s)[0, 0] for s in range(3000)]
    assert np.mean(first) == pytest.approx(5, abs=0.1) and np.var(first) == pytest.approx(10 * 10 * 10 * 10 / (400 * 19), rel=0.12)
    rows = sharding.shuffled(odd, 4).collect()
    assert len(rows) == 10 and sorted(r["slot"] for r in rows) == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]
    assert sharding.shuffled(none).count() == 0


# SQL
@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, name):
    from tools.oracle_check import compare
    assert compare(spark, SMALL, [name], verbose=False)[name][0] == "ok"
    assert duckdb.__version__

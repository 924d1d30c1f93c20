"""What a chunk of texts may take of a Python worker's memory, and that its blocks change no result."""

import tracemalloc

import numpy as np
import pyarrow as pa

from paidpath.llm import langid, sentencepieces


def different_words(n, seed=3):
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzäß"))
    return ["".join(rng.choice(letters, size)) for size in rng.integers(1, 14, n)]


def chunk(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_encoding_a_chunk_of_different_words_is_bounded():
    v = sentencepieces.load()
    words = different_words(60_000)
    data, docs = chunk([" ".join(words[i:i + 300]) for i in range(0, len(words), 300)])
    assert len(data) > 400_000
    assert peak_mb(lambda: v.encode(data, docs)) < 60


def test_blocks_of_words_change_no_ids(monkeypatch):
    v = sentencepieces.load()
    words = [*different_words(3000), "x" * 97, "y" * 96, "ü" * 60, "日本語", "\U0001f600", "", "z" * 500, "a"]
    texts = [" ".join(words[i:i + 7]) for i in range(0, len(words), 7)] + ["", " ", "  two  spaces\nlines\n\n"]
    data, docs = chunk(texts)
    told = []
    for block in (1, 100, 1 << 15, 1 << 30):
        monkeypatch.setattr(sentencepieces, "BLOCK", block)
        ids, at = v.encode(data, docs)
        told.append((ids.tolist(), at.tolist()))
        assert ids.dtype == np.int32
    assert all(x == told[0] for x in told)
    one = [v.segment_one((" " + w).encode()).tolist() for w in texts[0].split(" ")]
    assert told[0][0][:told[0][1][1]] == sum(one, [])


def test_blocks_of_words_change_no_language(monkeypatch):
    words = {lang: list(dict.fromkeys(different_words(400, seed))) for seed, lang in enumerate(("de", "en"))}
    model = langid.KneserNey({lang: (pa.array([w.encode("utf-32-le") for w in own], pa.large_binary()), np.ones(len(own))) for lang, own in words.items()})
    unseen = different_words(30_000, 7)
    data, docs = chunk([" ".join(unseen[i:i + 100]) for i in range(0, len(unseen), 100)] + ["", "12 !!", "ab"])
    bits, n = model.entropy(data, docs)
    blocked = peak_mb(lambda: model.entropy(data, docs))
    monkeypatch.setattr(langid, "BLOCK_WORDS", 1 << 30)
    whole_bits, whole_n = model.entropy(data, docs)
    assert np.array_equal(bits, whole_bits) and np.array_equal(n, whole_n)
    assert blocked < 0.7 * peak_mb(lambda: model.entropy(data, docs))
    assert [len(x) for x in model.entropy(*chunk([""]))] == [1, 1]

import itertools
from collections import Counter

import numpy as np
import pytest

from tesserae.llm import pieces


@pytest.fixture(scope="module")
def sampler():
    return pieces.Sampler(pieces.Vocabulary.load(pieces.MODEL))


ODD = ["Hello world, this is a test.", "  two  spaces ", "é▁x\n\ttab 日本語 🎉", "", " ", "a" * 3000 + " b", "x", "日本語" * 300, "\x00\x7f ÿ", "word " * 5000]


def test_lossless(sampler):
    got = sampler.encode(ODD, np.arange(len(ODD), dtype=np.uint64))
    assert [sampler.decode(p) for p in got] == ODD


def test_independent_of_batches(sampler):
    seeds = np.arange(len(ODD), dtype=np.uint64)
    together = sampler.encode(ODD, seeds)
    for i, t in enumerate(ODD):
        assert (sampler.encode([t], seeds[i : i + 1])[0] == together[i]).all()
    assert any((sampler.encode([ODD[0]], np.array([s], dtype=np.uint64))[0].tolist() != together[0].tolist()) for s in range(100, 120))


def test_library_decodes_the_pieces(sampler):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for t in ("Hello world, this is a test.", "naïve façade 日本"):
        assert model.decode(sampler.encode([t], np.array([5], dtype=np.uint64))[0].tolist()) == t


@pytest.mark.parametrize("word", ["their", "thorion", "été"])
def test_distribution(sampler, word):
    v = sampler.v
    raw = b"\xff" + word.encode()
    weight = {v.spelling[i]: v.weight[s] for s, i in enumerate(v.id.tolist()) if i >= 0}
    ways = {}
    for cuts in itertools.product([0, 1], repeat=len(raw) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(raw)]
        parts = [raw[a:b] for a, b in itertools.pairwise(at)]
        if all(p in weight for p in parts):
            ways[tuple(parts)] = float(np.prod([weight[p] for p in parts]))
    total, n = sum(ways.values()), 20_000
    seen = Counter(tuple(v.spelling[i] for i in p) for p in sampler.encode([word] * n, np.arange(n, dtype=np.uint64) * np.uint64(2654435761)))
    assert set(seen) <= set(ways)
    for way, w in ways.items():
        assert abs(seen[way] / n - w / total) < 0.02


def test_long_words_follow_the_same_distribution(sampler, monkeypatch):
    n = 4000
    seeds = np.arange(n, dtype=np.uint64)
    short = Counter(tuple(p.tolist()) for p in sampler.encode(["their"] * n, seeds))
    monkeypatch.setattr(pieces, "SHORT", 2)
    long = Counter(tuple(p.tolist()) for p in sampler.encode(["their"] * n, seeds))
    for way, count in short.items():
        assert abs(count - long[way]) < 0.05 * n


def test_rows(odd_docs, no_docs):
    encoded = pieces.encode(odd_docs)
    assert encoded.columns == [*(c for c in odd_docs.columns if c != "pieces"), "pieces", "lossless"]
    rows = pieces.decode(encoded).collect()
    assert len(rows) == odd_docs.count() and all(r["lossless"] and r["decoded"] == (r["text"] or "") for r in rows)
    again = {str(r["doc_id"]) + str(r["text"]): r["pieces"] for r in pieces.encode(odd_docs.repartition(1)).collect()}
    assert all(again[str(r["doc_id"]) + str(r["text"])] == r["pieces"] for r in rows)
    assert pieces.encode(no_docs).count() == 0


def test_words_of_one_hash(sampler):
    """A Thue-Morse word and its complement have one polynomial hash modulo 2**64, whatever its odd base."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    data = np.frombuffer(f"\xff{a}\xff{b}".encode("latin-1"), dtype=np.uint8)
    start, end = np.array([0, len(a) + 1]), np.array([len(a) + 1, len(data)])
    hashes = pieces._ROLL.slices(pieces._ROLL.prefix(data), start, end)
    assert hashes[0] == hashes[1]
    one, word = pieces._different(data, start, end)
    assert len(one) == 2 and word[0] != word[1]
    text = f"{a} {b} {a} short {b}"
    got = sampler.encode(["x", text], np.arange(2, dtype=np.uint64))
    assert sampler.decode(got[1]) == text


def test_alone_as_in_a_large_batch(sampler):
    rows = [" ".join(f"w{(i * 7919 + j * 104729) % 5003}" for j in range(100)) for i in range(1000)]
    seeds = np.arange(len(rows), dtype=np.uint64)
    together = sampler.encode(rows, seeds)
    for i in range(0, len(rows), 97):
        assert (sampler.encode([rows[i]], seeds[i : i + 1])[0] == together[i]).all()


def test_parts_change_nothing(sampler, monkeypatch):
    texts = [*ODD, "  " * 50 + "some words  here " * 40, "\u65e5" * 200 + " tail " * 30, " " * 300]
    seeds = np.arange(len(texts), dtype=np.uint64)
    want = sampler.encode(texts, seeds)
    monkeypatch.setattr(pieces, "CHUNK", 97)
    monkeypatch.setattr(pieces, "LONG_BLOCK", 33)
    got = sampler.encode(texts, seeds)
    assert all((a == b).all() for a, b in zip(got, want, strict=True))


def test_a_column_named_like_the_seed(spark):
    docs = spark.createDataFrame([(1, "some text", 5)], "doc_id long, text string, _row_seed int")
    row = pieces.encode(docs).first()
    assert row["_row_seed"] == 5 and row["lossless"]

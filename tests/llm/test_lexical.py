import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tesserae.llm import lexical as x


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    words = [(i, split(t)) for i, t in docs]
    n, total = sum(1 for _, w in words if w), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in set(items):
        scores = []
        for i, w in words:
            tf = Counter(w)
            m = 25 + (75 * len(w) * n) // total if w else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in split(text) if tf[t])
            if s > 0:
                scores.append((-s, i is not None, i or 0))
        out += [(item, r, i if there else None, -s) for r, (s, there, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def texts(seed, count, longest=40, words=60):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["", "X", "Über-"]) + f"w{min(int(rng.expovariate(0.08)), words)}" for _ in range(rng.randint(0, longest))) for _ in range(count)]


@pytest.fixture(scope="module")
def case(spark):
    docs = list(enumerate(texts(1, 300)))
    docs += [(1000 + i, docs[5][1]) for i in range(25)] + [(7, docs[7][1]), (7, docs[8][1]), (None, docs[9][1]), (None, None), (2000, None), (2001, ""), (2002, " ,. \n"), (2003, "w1 " * 200_000 + "w2"), (2004, "a" * 600_000 + " w3"), (2**60 + 1, "w4 W5 w6\x00w7")]
    items = list(enumerate(texts(2, 12, 25))) + [(100, "w1 w1 w1 w2"), (101, None), (102, ""), (103, "unknown"), (104, docs[5][1]), (104, docs[5][1]), (104, "w9"), (None, "w3 w4")]
    frames = spark.createDataFrame([(*d, 1, 0.5) for d in docs], "doc_id long, text string, n int, score double"), spark.createDataFrame([(*i, "t") for i in items], "item_id long, text string, doc_id string")
    return brute(docs, items), *frames


@pytest.mark.parametrize("options", [{}, {"shard": 200}, {"round_bytes": 300}])
def test_against_brute_force(case, options):
    """Copies, repeated rows, nulls, very long texts and words; in small shards, and in several rounds."""
    want, docs, items = case
    got = x.rank(docs.repartition(3), items, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_empty_tables(case):
    _, docs, items = case
    none = docs.where("false")
    assert x.rank(none, items).isEmpty() and x.rank(docs, items.where("false")).isEmpty() and x.rank(docs.where("text is null"), items).isEmpty()


@pytest.mark.parametrize("leaf", [1, 8, 256])
@pytest.mark.parametrize("shard", [50, 1 << 19])
def test_intervals_miss_nothing(monkeypatch, leaf, shard):
    monkeypatch.setattr(x, "LEAF", leaf)
    rng = np.random.default_rng(leaf + shard)
    mine = x.Items(texts(3, 9, 15))
    v = len(mine.vocabulary)
    weights = rng.integers(0, 50, v)
    search, want = x.Search(mine, weights, 4), {}
    for first in range(0, 800, shard):
        ids = np.sort(rng.integers(0, 500, min(shard, 400)))
        m = rng.integers(25, 30, len(ids))
        pairs = np.unique(rng.integers(0, len(ids) * v, 6 * len(ids)))
        tf = rng.integers(1, 3, len(pairs))
        shard_ = x.Shard(ids, m, pairs // v, pairs % v, tf)
        search.over(shard_)
        held = {(int(p // v), int(p % v)): int(t) for p, t in zip(pairs, tf, strict=True)}
        for i in range(mine.n):
            for d in range(len(ids)):
                s = sum(int(r * weights[t]) * ((10**9 * held[d, t]) // (1000 * held[d, t] + 8 * int(m[d]))) for j, t, r in zip(mine.item.tolist(), mine.term.tolist(), mine.repeats.tolist(), strict=True) if j == i and (d, t) in held)
                if s:
                    want.setdefault(i, []).append((-s, int(ids[d])))
        if first + shard >= 800 or shard > 800:
            break
    got = {}
    for i, s, d in zip(*(g.tolist() for g in search.got), strict=True):
        got.setdefault(i, []).append((-s, d))
    assert got == {i: sorted(s)[:4] for i, s in want.items()}


def test_range_maxima():
    rng = np.random.default_rng(4)
    n = 200
    shard = x.Shard(np.arange(n), np.full(n, 100), np.arange(n), np.zeros(n, np.int64), rng.integers(1, 40, n))
    low = rng.integers(0, n - 1, 500)
    high = low + 1 + rng.integers(0, n - low)
    high = np.minimum(high, n)
    best = shard.greatest(low, high)
    assert all(a <= p < b and shard.impact[p] == shard.impact[a:b].max() for a, b, p in zip(low, high, best, strict=True))


def test_few_documents_are_scored():
    """One document that holds a whole item, and many that hold a word of it."""
    mine = x.Items(["a b c d e f g h"])
    n = 20_000
    doc = np.concatenate((np.arange(n), np.full(8, 777)))
    term = np.concatenate((np.arange(n) % 8, np.arange(8)))
    key = np.unique(doc * 8 + term)
    search = x.Search(mine, np.full(8, 1000), 1)
    search.over(x.Shard(np.arange(n), np.full(n, 100), key // 8, key % 8, np.ones(len(key), np.int64)))
    assert search.got[2].tolist() == [777] and search.scored < n / 10


def test_words_are_those_of_the_pattern():
    text = "Ab,c  1É_x\x7f日本 -"
    assert [w.decode() for w in x.words_of(text)] == split(text)

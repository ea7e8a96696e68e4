import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from tesserae.llm import suffix


def brute(rows, length):
    """rows of (doc_id, text) in order; (doc_id, n_bytes, n_removed, n_spans, digest) of each."""
    seen, out = set(), []
    for i, text in rows:
        raw = (text or "").encode()
        cover = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in seen:
                cover[s : s + length] = b"\1" * length
            seen.add(raw[s : s + length])
        kept = bytes(b for b, c in zip(raw, cover) if not c)
        out.append((i, len(raw), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest()))
    return out


def found(df, length, **options):
    return sorted((tuple(r)[:5] for r in suffix.cut(df, length, **options).collect()), key=str)


def passages(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.randint(20, 200))) for _ in range(4)]
    texts = []
    for _ in range(n):
        t = "".join(rng.choice(base)[rng.randint(0, 20) :] for _ in range(rng.randint(0, 5)))
        t += "z" * rng.choice([0, 0, 0, 150]) + ("\0" * 60 + "ab\0") * rng.choice([0, 0, 1])
        texts.append(t)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"hot": 1}), (3, {"array_bytes": 500}), (4, {"hot": 3, "array_bytes": 1}), (5, {"most": 0}), (6, {"most": 0, "hot": 2})])
def test_against_brute_force(spark, seed, options):
    rows = passages(seed, 40)
    df = spark.createDataFrame([(*r, 1, "h") for r in rows], "doc_id long, text string, n_bytes int, h string").repartition(4)
    assert found(df, 40, **options) == sorted(brute(rows, 40), key=str)


def test_a_gram_around_which_everything_differs(spark):
    """A common passage shorter than a window in many surroundings, some of which repeat."""
    rng = random.Random(11)
    common = "all rights reserved to the holders"
    left, right = (["".join(rng.choice("abcdef ") for _ in range(60)) for _ in range(25)] for _ in range(2))
    rows = [(i, rng.choice(left)[rng.randint(0, 40) :] + common + rng.choice(right)[: rng.randint(5, 60)]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted(brute(rows, 60), key=str)
    assert sum(r[2] for r in want) > 1000
    assert found(df, 60, hot=20) == want and found(df, 60, hot=1) == want


def test_no_name_stays_hot(spark, monkeypatch):
    """Every group that reaches an array has `hot` strings at most."""
    sizes = []
    real = suffix._split

    def watched(strings, hot, length):
        ready, spans = real(strings, hot, length)
        sizes.append(ready.groupBy("g").count().agg({"count": "max"}).first()[0])
        return ready, spans

    monkeypatch.setattr(suffix, "_split", watched)
    rng = random.Random(3)
    common = "all rights reserved to the holders"
    rows = [(i, "".join(rng.choice("abcdef ") for _ in range(60)) + common + "".join(rng.choice("ab") for _ in range(60))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df, 60, hot=15) == sorted(brute(rows, 60), key=str)
    assert sizes and all(n is None or n <= 15 for n in sizes)


def test_hashes_that_collide_are_told_apart(spark):
    """Thue-Morse words and their complements have one polynomial hash, but not one MD5."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    rows = [(0, a), (1, b), (2, "x" + a + "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 100) == sorted(brute(rows, 100), key=str)


def test_blocks_of_long_texts(spark, monkeypatch):
    rows = passages(9, 30)
    monkeypatch.setattr(suffix, "BLOCK", 64)
    raw = [(t or "").encode() for _, t in rows]
    parts = suffix.Stretches(raw, 40)
    monkeypatch.undo()
    whole = suffix.Stretches(raw, 40)

    def windows(s):
        return {(t, a + i, g) for t, a, n, g in zip(s.text.tolist(), s.start.tolist(), s.windows.tolist(), s.gram.tolist()) for i in range(n)}

    assert windows(parts) == windows(whole)
    assert len(windows(whole)) == sum(max(0, len(r) - 39) for r in raw)


def test_odd_rows(odd_docs, no_docs):
    """Null ids come first, and different texts with one id in order of their hash; equal rows are one document."""
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]

    def order(row):
        h = 42 if row[1] is None else xxhash.xxh64_intdigest(row[1].encode(), seed=42)
        return -(2**63) if row[0] is None else row[0], h - 2**64 if h >> 63 else h

    each = sorted(set(rows), key=order)
    result = dict(zip(each, brute(each, 100), strict=True))
    assert found(odd_docs, 100) == sorted((result[r] for r in rows), key=str)
    assert found(no_docs, 100) == []


class Full:
    """A bit map with all bits set."""

    def __init__(self, hashes, n):
        pass

    def has(self, hashes):
        return np.ones(len(hashes), dtype=bool)


def test_one_string_a_class_reaches_a_gram(spark, monkeypatch):
    """Also when the bit map lets everything through, and of repeated rows."""
    def arrays(length, array_bytes):
        def run(batches):
            for b in batches:
                yield pd.DataFrame({"doc_id": b["doc_id"], "h": b["h"], "start": b["start"], "end": b["g"]})

        return run

    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = [(i, base) for i in range(30)] + [(0, base)] * 5 + [(30 + i, base[i : 300 + i]) for i in range(6)]
    df = spark.createDataFrame([(i, 0, t) for i, t in rows], "doc_id long, h long, text string").repartition(4)
    monkeypatch.setattr(suffix, "Filter", Full)
    monkeypatch.setattr(suffix, "_arrays", arrays)
    got = [(r["end"], r["doc_id"], r["start"]) for r in suffix.repeats(df, 40).collect() if abs(r["end"]) > 10**6]

    first = {}
    for i, t in rows:
        s = suffix.Stretches([t.encode()], 40)
        for g, n, start in zip(s.gram.tolist(), s.windows.tolist(), s.start.tolist()):
            d = t[start : start + n + 39]
            first[g, d] = min(first.get((g, d), (i, start)), (i, start))
    grams = [g for g, _ in first]
    want = [(g, *at) for (g, _), at in first.items() if grams.count(g) > 1]
    assert want and sorted(got) == sorted(want)


def test_maximal_repeats():
    strings = [b"xxabcdefghyy", b"zzabcdefghww", b"abcdefghyy"]
    got = {(n, tuple(sorted((strings[s][o : o + n], s) for s, o in zip(a.tolist(), b.tolist())))) for n, a, b in suffix.maximal_repeats(strings, 4)}
    assert (8, tuple((b"abcdefgh", s) for s in range(3))) in got
    assert (10, ((b"abcdefghyy", 0), (b"abcdefghyy", 2))) in got
    assert not any(n < 8 and len(m) == 3 for n, m in got if m[0][0] in b"bcdefgh" and len(m) == 3)


def test_intervals_are_those_of_the_tree():
    import numpy as np

    lcp = np.array([0, 5, 7, 7, 5, 2, 6])
    assert sorted(suffix.intervals(lcp, 5)) == [(0, 4, 5), (1, 3, 7), (5, 6, 6)]


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert found(docs, 100) == sorted(brute(rows, 100), key=str)

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tesserae.llm import simhash
from tesserae.operators.graph import components

from .conftest import words


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
                parent[root(a)] = root(b)
    low = {}
    for a, (i, _) in enumerate(prints):
        if i is not None:
            low[root(a)] = min(i, low.get(root(a), i))
    return sorted(((i, f"{f:016x}", low.get(root(a))) for a, (i, f) in enumerate(prints)), key=str)


def found(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)


def test_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(odd_docs) == brute_components(rows)


def test_empty(no_docs):
    assert found(no_docs) == [] and simhash.keep_one(no_docs).count() == 0


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found(docs) == brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_spark_hash_is_the_same(spark):
    text = "one two three"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == xxhash.xxh64_intdigest(text.encode(), seed=42)


def brute_roots(prints):
    parent = {f: f for f in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and ((a ^ b) % 2**64).bit_count() <= 2:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {f: root(f) for f in prints}


def signed(f):
    return f - (1 << 64) if f >> 63 else f


@pytest.mark.parametrize("small", [1, 4, 32])
def test_links_keep_components(spark, small):
    """Fingerprints given outright: a chain two bits apart, copies around a hub in one and two segments, and random ones."""
    rng = random.Random(small)
    prints = {signed((1 << (2 * k)) - 1) for k in range(20)}
    hub = 0xFFFF << 48
    prints |= {signed(hub ^ 1 << b) for b in range(40)} | {signed(hub ^ 1 << a ^ 1 << b) for a in range(16) for b in range(a)}
    far = rng.getrandbits(64)
    prints |= {signed(far ^ 1 << a ^ 1 << b ^ 1 << c) for a, b, c in (rng.sample(range(64), 3) for _ in range(150))}
    prints |= {signed(rng.getrandbits(64)) for _ in range(50)}
    frame = spark.createDataFrame([(f,) for f in sorted(prints)], "fp long")
    got = {r["node"]: r["component"] for r in components(simhash.links(frame, small)).collect()}
    want = brute_roots(sorted(prints))
    assert {f: got.get(f, f) for f in prints} == want
    assert all(((r["src"] ^ r["dst"]) % 2**64).bit_count() <= 2 for r in simhash.links(frame, small).collect())


def test_six_keys_a_fingerprint(spark):
    assert spark.createDataFrame([(5,)], "fp long").select(F.size(simhash._keys())).first()[0] == 6


def brute_kept(rows):
    """Rows that stay: (id, text) of each component's first."""
    named = brute_components(rows)
    prints = [brute_fingerprint(t) for _, t in rows]
    groups = {}
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    for (i, t), r in zip(rows, root, strict=True):
        groups.setdefault(r, []).append((i is None, i or 0, i))
    assert len(named) == len(rows)
    return sorted(min(g)[2] if min(g)[2] is not None else -1 for g in groups.values())


def test_keep_one(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == brute_kept(rows)


def test_texts_that_share_an_id(spark):
    """Different texts under one doc_id are different nodes: one near to another row, one far from all."""
    near = words(400, 31)
    close = near + " end"
    far = words(400, 77)
    rows = [(3, near), (9, close), (9, far), (9, far), (12, None), (12, ""), (12, words(300, 5))]
    assert 0 < (brute_fingerprint(near) ^ brute_fingerprint(close)).bit_count() <= 2
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")
    assert found(docs) == brute_components(rows)
    kept = sorted((r["doc_id"], r["text"] or "") for r in simhash.keep_one(docs).collect())
    assert kept == sorted([(3, near), (9, far), (12, ""), (12, words(300, 5))])

import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tesserae.llm import mixing as x

from .conftest import words


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def targets(sizes, weights=(1, 2, 3), most=3):
    """By name, sharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = Fraction(sum(sizes.values())), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        base = sum(weight[s] for s in names if s not in full)
        out = {s: Fraction(most * sizes[s]) if s in full else (left * weight[s] / base if base else Fraction(0)) for s in names}
        more = {s for s in names if out[s] > most * sizes[s]}
        if not more:
            return out
        full |= more


@pytest.fixture(scope="module")
def docs():
    """A source with a third of all rows, a tiny one, one of empty texts, one without a name, copies and a very long text."""
    rows = [(i, words(20 + i * 7 % 90, i), "big") for i in range(120)]
    rows += [(200 + i, words(30 + i, i), f"s{i % 5}") for i in range(100)]
    rows += [(400, words(20_000, 9), "long"), (401, "tiny", "é-tiny"), (402, "two words", "\U0001f389"), (403, "", "none"), (404, None, "none"), (405, " \n\t", "none")]
    rows += [(500, words(64, 3), None), (500, words(64, 3), None), (501, None, None), (502, words(10, 4), ""), (None, words(40, 6), "s1"), (None, words(40, 7), "s1"), (200, words(33, 8), "s0"), (2**60 + 1, "a\x0bb\x1cc d\x0ce", "s2")]
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 7, "t") for r in rows], "doc_id long, text string, source string, size int, target string").repartition(parts)


def checked(mixture, docs):
    """Sources' and documents' rows, and the words taken of each."""
    sources = {r["number"]: r for r in mixture.sources.collect()}
    spans = mixture.spans.collect()
    taken, by_doc = Counter(), Counter()
    for s in spans:
        taken[s["number"]] += s["words"]
        by_doc[s["number"], s["start"]] += s["words"]
    for d in mixture.documents.collect():
        if d["size"]:
            assert by_doc[d["number"], d["start"]] <= 3 * d["size"]
    return sources, spans, taken


def test_targets_hold(spark, docs):
    mixture = x.blend(frame(spark, docs), block=8, shard=50)
    sources, spans, taken = checked(mixture, docs)
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(tokens(t))
    want = targets(sizes)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    assert [sources[i]["source"] for i in range(len(sources))] == names
    for i, s in enumerate(names):
        r = sources[i]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], rel_tol=1e-12, abs_tol=1e-12)
        assert taken[i] == math.floor(want[s])
    assert math.isclose(sum(r["target"] for r in sources.values()), sum(sizes.values()))
    assert sorted((d["doc_id"] or -1, d["size"]) for d in mixture.documents.collect()) == sorted((i or -1, len(tokens(t))) for i, t, _ in docs)
    # Rounds: a source's blocks all come once before any comes again.
    by_turn = {}
    for s in spans:
        assert by_turn.setdefault((s["number"], s["turn"]), s["block"]) == s["block"]
    for i, r in sources.items():
        turns = [by_turn[i, k] for k in range(r["slots"])]
        n = -(-r["source_size"] // 8)
        for at in range(0, len(turns), max(n, 1)):
            part = turns[at : at + n]
            assert len(set(part)) == len(part) and (len(part) < n or set(part) == set(range(n)))
    # Slots fill the shards.
    per_shard = Counter(shard for shard, _ in {(s["shard"], s["slot"]) for s in spans})
    total = sum(r["slots"] for r in sources.values())
    assert [per_shard[k] for k in range(total // 50)] == [50] * (total // 50) and sum(per_shard.values()) == total


def test_draws_are_multinomial(spark):
    """The counts of shards scatter as draws do, about the targets' shares."""
    rows = [(i, "w " * 50, f"s{i % 3}") for i in range(600)]
    mixture = x.blend(frame(spark, rows), block=2, shard=100)
    sources = {r["number"]: r["slots"] for r in mixture.sources.collect()}
    total = sum(sources.values())
    counts = Counter((s["shard"], s["number"]) for s in mixture.spans.select("shard", "number", "slot").distinct().collect())
    shards = total // 100
    for i, n in sources.items():
        p = n / total
        drawn = np.array([counts[k, i] for k in range(shards)])
        assert 0.6 < drawn.var() / (100 * p * (1 - p)) < 1.5


def test_reruns_agree(spark, docs):
    columns = ["shard", "slot", "part", "number", "block", "first", "words", "start"]
    got = [sorted(map(tuple, x.blend(frame(spark, docs, n), block=16, shard=40).spans.select(*columns).collect())) for n in (1, 5)]
    assert got[0] == got[1] and got[0]


def test_texts_are_the_spans_words(spark, docs):
    df = frame(spark, docs)
    mixture = x.blend(df, block=16, shard=40)
    got = x.texts(df, mixture).collect()
    sources = {r["number"]: r for r in mixture.sources.collect()}
    taken = Counter()
    for r in got:
        taken[r["number"]] += len(tokens(r["text"]))
    assert taken == Counter({i: r["words"] for i, r in sources.items() if r["words"]})
    known = {s["source"]: Counter() for s in sources.values()}
    for _, t, s in docs:
        known[s].update(tokens(t))
    for i, r in sources.items():
        mine = Counter(w for g in got if g["number"] == i for w in tokens(g["text"]))
        assert all(n <= 3 * known[r["source"]][w] for w, n in mine.items())


@pytest.mark.parametrize("block", [1, 5, 64])
def test_slots_needed(block):
    rng = np.random.default_rng(block)
    for number in range(40):
        size = int(rng.integers(1, 300))
        want = int(rng.integers(0, 3 * size + 1))
        slots, cut = x.needed(number, size, want, block, 13)
        blocks = -(-size // block)
        given = 0
        for turn in range(slots):
            b = int(x.permuted(np.array([turn % blocks]), np.array([blocks]), x._round_key(13, [number], [turn // blocks]))[0])
            n = min(block, size - b * block)
            given += min(n, cut) if turn == slots - 1 else n
        assert given == want


def test_permutations():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        at = x.permuted(np.arange(n), np.full(n, n), np.full(n, 99, dtype=np.uint64))
        assert sorted(at.tolist()) == list(range(n))
        assert x.permuted(at, np.full(n, n), np.full(n, 99, dtype=np.uint64), back=True).tolist() == list(range(n))
    big = np.full(50, 2**50 + 3)
    assert (x.permuted(np.arange(50), big, np.arange(50)) < big).all()


def test_empty_tables(spark, docs):
    df = frame(spark, docs)
    for none in (df.where("false"), df.where("text is null")):
        mixture = x.blend(none)
        assert mixture.spans.isEmpty() and mixture.documents.count() == none.count()
        assert x.texts(none, mixture).isEmpty()


def test_query(spark, sf_dir):
    got = x.op13_mixing(spark, sf_dir).collect()
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    sizes, by_source, target = Counter(), Counter(), {}
    for r in rows:
        sizes[r["source"]] += len(tokens(r["text"]))
    want, source = targets(sizes), {r["doc_id"]: r["source"] for r in rows}
    assert len(got) == len(rows) and {r["doc_id"]: r["size"] for r in got} == {r["doc_id"]: len(tokens(r["text"])) for r in rows}
    for r in got:
        by_source[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[source[r["doc_id"]]]
    assert all(math.isclose(target[s], want[s]) and by_source[s] == math.floor(want[s]) for s in sizes)

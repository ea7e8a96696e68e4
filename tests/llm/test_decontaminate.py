import re

import numpy as np
import pytest

from tesserae.llm import decontaminate as d


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    windows = [(i, w[s : s + min(10, len(w))]) for i, t in items for w in [split(t)] for s in range(max(1, len(w) - 9)) if w]
    for doc, text in docs:
        w = split(text)
        hit, found = set(), set()
        for i, win in windows:
            for s in range(len(w) - len(win) + 1):
                if w[s : s + len(win)] == win:
                    hit |= set(range(s, s + len(win)))
                    found.add(str(i))
        out.append((doc, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=str)


def found(docs, items, **options):
    rows = d.find_shared(docs, items, **options).collect()
    return sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), ",".join(r["items"])) for r in rows), key=str)


@pytest.fixture(scope="module")
def case(spark):
    from .conftest import words

    item = words(25, 9)
    items = [(1, item), (2, words(12, 10)), (3, "tiny Thing"), (4, "one two three four five six seven"), (10, item), (5, None), (6, ""), (7, "é"), (8, "a b a b a b a b a b a b")]
    docs = [
        (1, words(80, 20) + " " + item + " " + words(60, 21)), (2, item.upper().replace(" ", "-\n")), (3, " ".join(item.split()[3:13])), (4, " ".join(item.split()[3:12])),
        (5, "a tiny, thing. TINY thing"), (6, "x one two three four five six seven"), (7, None), (8, ""), (9, words(5000, 22) + " " + item), (9, words(5000, 22) + " " + item),
        (None, item), (11, "a b " * 30), (12, "é"), (13, words(9, 9)), (2**60 + 1, "tiny\x00thing"),
    ]
    frames = spark.createDataFrame([(*r, "s", 1) for r in docs], "doc_id long, text string, spans string, items int"), spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, words int")
    return docs, items, *frames


def test_against_brute_force(case):
    docs, items, df, bench = case
    assert found(df.repartition(3), bench) == brute(docs, items)


@pytest.mark.parametrize("few", [0, 1, 8])
def test_the_shuffle_gives_the_same(case, few):
    """Of no length, of those with one window, or of those with up to eight, are the hashes broadcast."""
    docs, items, df, bench = case
    assert found(df, bench, few=few) == brute(docs, items)


def test_documents_are_scanned_once(case, monkeypatch):
    """However large the benchmark is."""
    _, _, df, bench = case
    for few, scans in ((0, 1), (1000, 1)):
        seen = []
        monkeypatch.setattr(d, "_search", lambda columns, marks: iter(()))
        monkeypatch.setattr(d, "map_lists", lambda frame, work, schema, real=d.map_lists: seen.append("text" in frame.columns and "h" in frame.columns and "runs" not in frame.columns) or real(frame, work, schema))
        d.find_shared(df, bench, few=few)
        assert sum(seen) == scans
        monkeypatch.undo()


@pytest.mark.parametrize("block", [1, 40, 333, 1 << 19])
def test_long_texts_in_pieces(monkeypatch, block):
    from .conftest import words

    texts = [words(500, 3), None, "", "x" * 700 + " " + words(30, 4), words(9, 5), " ,; " * 300]
    whole = d.Block([(t or "").encode() for t in texts])
    want = [set() for _ in texts]
    for s in whole.prints(10)[0].tolist():
        t = int(whole.text[s])
        want[t].add((s - int(whole.first[t]), whole.digest(s, 10)))
    monkeypatch.setattr(d, "BLOCK", block)
    got, n_words = [set() for _ in texts], [0] * len(texts)
    for own, before, b in d._blocks(texts):
        for t, i in enumerate(own.tolist()):
            n_words[i] = max(n_words[i], int(before[t] + b.first[t + 1] - b.first[t]))
        for s in b.prints(10)[0].tolist():
            t = int(b.text[s])
            got[own[t]].add((s - int(b.first[t]) + int(before[t]), b.digest(s, 10)))
    assert got == want and n_words == np.diff(whole.first).tolist()


def test_dropping(case):
    docs, items, df, bench = case
    clean = sorted(str(x[0]) for x in brute(docs, items) if not x[2])
    for n in (0, 8, 1000):
        assert sorted(str(r["doc_id"]) for r in d.drop_hit(df, bench, few=n).collect()) == clean


def test_empty(case, no_docs):
    docs, _, df, bench = case
    assert found(df, bench.where("false")) == brute(docs, [])
    assert found(no_docs, bench) == []


def test_every_long_shared_span_shares_a_fingerprint():
    from .conftest import words

    text = words(400, 30)
    a = d.Block([text.encode()])
    at, low = a.winnow()
    for s in range(0, 300, 7):
        b = d.Block([(words(5, s) + " " + " ".join(text.split()[s : s + 10]) + " " + words(5, s + 1)).encode()])
        assert low[s] in b.winnow()[1]


@pytest.mark.parametrize("few", [0, 1, d.FEW])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts_of_few_words(spark, few, seed):
    """Equal fingerprints meet at the ends of texts that share a block; items have one to twelve words."""
    rng = np.random.default_rng(seed)

    def text(n):
        return " ".join(f"w{i}" for i in rng.integers(0, 12, n))

    items = [(i, text(1 + i % 12)) for i in range(31)]
    docs = [(i, text(int(rng.integers(0, 30)))) for i in range(80)] + [(100, "w1"), (101, "w1 w2"), (102, "w2 w3")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string").repartition(3, "doc_id"), spark.createDataFrame(items, "item_id long, text string")
    assert found(df, bench, few=few) == brute(docs, items)


@pytest.mark.parametrize("few", [0, d.FEW])
def test_one_word_items_stay_within_their_texts(spark, few):
    docs = spark.createDataFrame([(1, "w1"), (2, "w1 w2"), (3, "w2 w3")], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, "w1"), (2, "w2")], "item_id long, text string")
    assert found(docs, bench, few=few) == [(1, 1, 1, "1"), (2, 2, 2, "1,2"), (3, 2, 1, "2")]
    assert d.drop_hit(docs, bench, few=few).count() == 0

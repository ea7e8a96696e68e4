import math

import pytest

from tesserae.llm import topk


def brute(rows, k=5):
    def whole(e):
        return [math.floor(256 * float(x)) for x in e]

    ok = [(i, whole(e)) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, e in {(i, tuple(e)) for i, e in ok if i % 50 == 0}:
        best = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(e, f)))), i) for i, f in ok if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, query_id int").repartition(3)
    got = topk.search(df.where("vec_id % 50 = 0"), df, **options)
    return sorted(tuple(r) for r in got.collect())


def vectors(n, width=16):
    x, out = 3, []
    for i in range(n):
        e = []
        for _ in range(width):
            x = (x * 1103515245 + 12345) % 2**31
            e.append((x >> 8) % 64 / 64 - 0.5)
        out.append((i, e, 0))
    return out


def test_against_brute_force(spark):
    rows = vectors(600)
    assert run(spark, rows) == brute([r[:2] for r in rows])


def test_ties_copies_and_rounds(spark):
    rows = [(i, [0.25, -0.5], 1) for i in range(120)] + [(200, [1.0, 1.0], 1), (200, [1.0, 1.0], 1)]
    got = run(spark, rows, round_size=1)
    assert got == brute([r[:2] for r in rows])
    assert [r[2] for r in got if r[0] == 0] == [1, 2, 3, 4, 5]


def test_rounds_are_bounded_with_equal_vectors(spark, monkeypatch):
    sizes = []
    send = spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: sizes.append(len(value[0].ids)) or send(value))
    df = spark.createDataFrame([(i, [0.25, -0.5]) for i in range(1000)], "vec_id long, embedding array<float>")
    topk.search(df, df, round_size=250)
    assert sum(sizes) == 1000 and len(sizes) == 4 and max(sizes) < 400


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0], 0), (50, None, 0), (100, [1.0, None], 0), (150, [float("nan"), 1.0], 0), (200, [], 0), (None, [1.0, 1.0], 0),
        (1, [float("inf"), 1.0], 0), (2, [3.0, -1.0], 0), (3, [1.0], 0), (4, [1.0, 1.0, 9.0], 0), (5, [3e38, -3e38], 0), (250, [3e38, 1.0], 0),
    ]
    rows = [(i, None if e is None else [None if x is None else x for x in e], q) for i, e, q in rows]
    import struct

    exact = [(i, None if e is None else [None if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in e]) for i, e, _ in rows]
    assert run(spark, rows) == brute(exact)


@pytest.mark.parametrize("n", [0, 1])
def test_few_rows(spark, n):
    assert run(spark, vectors(n)) == []


def test_bounds_hold():
    import numpy as np

    rows = vectors(80)
    v = topk.Vectors(np.arange(80), [r[1] for r in rows])
    exact = v.x @ v.x.T
    for f, a in v.levels:
        assert (f @ f.T + a[:, None] + a >= exact - 1e-6).all()


def test_survivors(spark):
    """Clustered vectors in two tasks: bounds drop more at each level, and the few pairs left give the exact result."""
    import numpy as np

    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 48)) @ np.diag(np.linspace(1, 0.05, 48))
    rows = [(i, (centres[i % 40] + 0.1 * rng.normal(size=48)).astype(np.float32).tolist(), 0) for i in range(6000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, query_id int").repartition(2)
    counts = topk.counters(spark)
    got = sorted(tuple(r) for r in topk.search(df.where("vec_id % 50 = 0"), df, survivors=counts).collect())
    x = np.floor(256 * np.array([r[1] for r in rows], dtype=np.float64)).astype(np.int64)
    want = []
    for q in range(0, 6000, 50):
        score = x @ x[q]
        best = sorted((-s, i) for i, s in enumerate(score.tolist()) if i != q)[:5]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)
    pairs, *left = (c.value for c in counts)
    assert pairs == 120 * (6000 - 2 * topk.SEED) and left == sorted(left, reverse=True) and left[0] < pairs and left[-1] < pairs / 20


def test_survivors_of_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").coalesce(1)
    counts = topk.counters(spark)
    assert topk.search(df.where("vec_id % 50 = 0"), df, survivors=counts).count() == 200
    pairs, *left = (c.value for c in counts)
    print("survivors", [n / pairs for n in left])
    assert left[-1] < pairs / 2

import math
import random

import pytest

from tesserae.llm import negatives as n

SCHEMA = "vec_id long, embedding array<double>, label int, score string, key binary, anchor int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", b"k", 1) for r in rows], SCHEMA)


def brute(rows, anchors, positives=5, per_positive=3):
    def whole(v):
        return [math.floor(256 * x) for x in v]

    def usable(r):
        return r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])

    out = []
    for a in {(r[0], tuple(r[1]), r[2]) for r in anchors if usable(r)}:
        found = [(sum(p * q for p, q in zip(whole(a[1]), whole(r[1]), strict=False)), r[0], r[2]) for r in rows if usable(r) and r[0] != a[0]]
        found.sort(key=lambda s: (-s[0], s[1]))
        for score, positive, _ in [s for s in found if s[2] == a[2]][:positives]:
            fit = [s for s in found if s[2] != a[2] and 50 * score <= 100 * s[0] <= 95 * score]
            out += [(a[0], positive, k, s[1], score, s[0]) for k, s in enumerate(fit[:per_positive], 1)]
    return sorted(out)


def rows_of(seed, count, odd=True):
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-1, 3) / 8 for _ in range(4)], rng.randint(0, 2)) for i in range(count)]
    if odd:
        rows += [rows[3], rows[3], rows[10], (5, [0.5, 0.5, 0.5, 0.5], 1), (200, None, 1), (201, [0.1, None, 0.2, 0.3], 1), (202, [0.1, math.nan, 0.2, 0.3], 1), (203, [math.inf, 0.0, 0.0, 0.0], 0), (204, [0.5] * 4, None)]
        rows += [(205, [0.5, 0.5], 0), (206, [0.5] * 6, 1), (207, [], 2), (208, [0.0] * 4, 0), (2**60 + 1, [0.25] * 4, 2), (None, [0.5] * 4, 1)]
    return rows


@pytest.mark.parametrize("parts", [1, 4])
@pytest.mark.parametrize("round_size", [3, 20_000])
def test_against_brute_force(spark, parts, round_size):
    """Ties, repeated rows, two vectors under one id, nulls, and vectors of other lengths, in one round or several."""
    rows = rows_of(7, 90)
    anchors = [r for r in rows if r[0] is None or r[0] % 5 == 0 or r[0] > 200]
    got = n.mine(frame(spark, rows).repartition(parts), frame(spark, anchors), round_size=round_size)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, anchors)


def test_a_hot_vector(spark):
    """A third of all rows are one vector."""
    rows = rows_of(3, 60, odd=False) + [(1000 + i, [0.25, 0.25, 0.125, 0.25], i % 2) for i in range(40)]
    anchors = [r for r in rows if r[0] % 10 == 0]
    got = n.mine(frame(spark, rows).repartition(3), frame(spark, anchors))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, anchors)


def test_empty_tables(spark):
    rows, none = frame(spark, rows_of(1, 20)), frame(spark, rows_of(1, 20)).where("false")
    assert n.mine(none, rows).isEmpty() and n.mine(rows, none).isEmpty() and n.mine(none, none).isEmpty()
    assert n.mine(rows, rows.where("vec_id = 0")).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_scores_beyond_a_long(spark):
    rows = [(0, [1e15, 0.0], 0), (1, [1e15, 1.0], 0), (2, [6e14, 0.0], 1), (3, [-1e15, 0.0], 1), (4, [9e-1, 0.0], 1)]
    got = sorted(tuple(r) for r in n.mine(frame(spark, rows), frame(spark, rows[:1])).collect())
    assert got == []  # both are a long's end, and so the negative is beyond 95 hundredths


def test_keys_sort_as_ranks():
    rng = random.Random(5)
    rows = [(rng.randrange(3), rng.choice([-(2**63), -5, 0, 7, 2**63 - 1]), rng.randrange(2), rng.choice([-(2**63), -1, 0, 1, 2**63 - 1])) for _ in range(300)]
    keys = sorted(n.packed(*r) for r in rows)
    assert [n.unpacked(k) for k in keys] == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))


def test_the_stream_holds_open_windows_only():
    keys = [n.packed(1, 100, n.POSITIVE, 1), n.packed(1, 90, n.POSITIVE, 2), n.packed(1, 90, n.NEGATIVE, 3), n.packed(1, 60, n.NEGATIVE, 4), n.packed(1, 48, n.NEGATIVE, 5), n.packed(2, 90, n.NEGATIVE, 6)]
    assert list(n.stream(iter(keys), 5, 1, 50, 95)) == [(1, 1, 1, 3, 100, 90), (1, 2, 1, 4, 90, 60)]

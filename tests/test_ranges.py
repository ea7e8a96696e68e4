"""As-of joins and running sums over ranges of the order."""

import random

import pytest

from tesserae.operators import joins, ordered


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_start(spark, seed):
    """Irregular starts, ties, null keys and places, and a third of all points at one place."""
    r = random.Random(seed)
    points = [(r.choice([1, 2, None]), r.choice([None] + [float(r.randint(0, 50))] * 9), i) for i in range(400)] + [(1, 7.0, 1000 + i) for i in range(200)]
    starts = [(r.choice([1, 2, None]), float(r.randint(5, 45)), r.randint(0, 5), i) for i in range(30)] + [(1, None, 3, 3)]
    got = joins.latest(spark.createDataFrame(points, "k int, at double, id int"), spark.createDataFrame(starts, "k int, at double, v int, w int"), ["k"], "at", ["v", "w"])
    want = []
    for k, a, i in points:
        before = [(b, v, w) for q, b, v, w in starts if q == k and b is not None and a is not None and b <= a]
        want.append((k, a, i, *(max(before)[1:] if before else (None, None))))
    assert sorted(str(tuple(x)) for x in got.collect()) == sorted(map(str, want))


def test_latest_without_starts_or_points(spark):
    points, starts = spark.createDataFrame([(1, 2.0)], "id int, at double"), spark.createDataFrame([(1.0, 3)], "at double, v int")
    assert [tuple(r) for r in joins.latest(points, starts, [], "at", ["v"]).collect()] == [(2.0, 1, 3)]
    assert [tuple(r) for r in joins.latest(points, starts.where("false"), [], "at", ["v"]).collect()] == [(2.0, 1, None)]
    assert joins.latest(points.where("false"), starts, [], "at", ["v"]).isEmpty()


def test_running_sums_of_a_large_group(spark):
    r = random.Random(3)
    rows = [(r.choice([1, 1, 1, 1, 2, None]), i, r.randint(0, 9)) for i in range(500)]
    got = ordered.running(spark.createDataFrame(rows, "k int, i int, v long"), ["k"], "i", "v")
    want = []
    for k, i, v in rows:
        upto, total = sum(x for q, j, x in rows if q == k and j <= i), sum(x for q, _, x in rows if q == k)
        want.append((k, i, upto, upto - v, total - upto + v))
    assert sorted(str(tuple(x)) for x in got.collect()) == sorted(map(str, want))

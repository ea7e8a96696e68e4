"""Matchings and nearest neighbours against brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import graph, joins
from tesserae.plans import quality
from tesserae.sources import records


@pytest.mark.parametrize("shape", [(1, 1), (3, 3), (3, 5), (5, 6)])
def test_cheapest_against_all_permutations(shape):
    rng = np.random.default_rng(sum(shape))
    for _ in range(30):
        cost = rng.integers(-9, 9, size=shape).astype(float)
        found = graph.cheapest(cost)
        assert len(set(found.tolist())) == shape[0]
        best = min(sum(cost[i, p] for i, p in enumerate(order)) for order in itertools.permutations(range(shape[1]), shape[0]))
        assert sum(cost[i, p] for i, p in enumerate(found)) == best


def brute_matching(pairs, most_pairs):
    """(number of pairs if it counts, total) of the best matching, by trying every subset in turn."""
    def best(i, used_a, used_b):
        if i == len(pairs):
            return (0, 0.0)
        a, b, s = pairs[i]
        out = best(i + 1, used_a, used_b)
        if a not in used_a and b not in used_b:
            n, total = best(i + 1, used_a | {a}, used_b | {b})
            out = max(out, (n + 1 if most_pairs else 0, total + s))
        return out

    return best(0, frozenset(), frozenset())


@pytest.mark.parametrize("most_pairs", [True, False])
def test_assignment(spark, most_pairs):
    rng = random.Random(8)
    rows = {(g, rng.randint(0, 5), rng.randint(0, 4)): rng.randint(1, 64) / 64 for g in range(12) for _ in range(11)}
    df = spark.createDataFrame([(*k, v) for k, v in rows.items()] + [(0, 99, 99, 0.0)], "g long, a long, b long, iou double").repartition(3)
    got = graph.assignment(df, ["g"], "iou", most_pairs).collect()
    for g in range(12):
        own = [r for r in got if r["g"] == g]
        assert len({r["a"] for r in own}) == len({r["b"] for r in own}) == len(own)
        assert all(rows[g, r["a"], r["b"]] == r["score"] for r in own)
        want = brute_matching([(a, b, s) for (h, a, b), s in rows.items() if h == g], most_pairs)
        assert (len(own) if most_pairs else 0, sum(r["score"] for r in own)) == want
    assert graph.assignment(df.where("false"), ["g"], "iou").count() == 0


def test_given_instances_are_matched_as_over_one_half(spark, sf_dir):
    """Pairs over one half are in every best matching of regions that don't overlap among themselves."""
    from tesserae.plans import spatial

    sure = {tuple(r)[:3] for r in spatial.best_matching(spark, sf_dir).collect()}
    got = {tuple(r)[:3] for r in quality.assigned_segments(spark, sf_dir).collect()}
    assert sure and sure <= got
    assert quality.assigned_instances(spark, sf_dir).count() >= len(got)


@pytest.mark.parametrize("tile", [4.0, 1e6])
def test_nearest_with_outliers_and_ties(spark, tile):
    rng = random.Random(4)
    rows = [(s, 100 * s + i, rng.randint(0, 20) / 2.0, rng.randint(0, 20) / 2.0, "xy"[i % 2]) for s in range(3) for i in range(40)]
    rows += [(0, 900, 300.0, -3.0, "x"), (7, 901, 0.0, 0.0, "x"), (8, 902, 1.0, 1.0, "x"), (8, 903, 1.0, 1.0, "y")]
    df = spark.createDataFrame(rows, "s long, id long, x double, y double, source string")

    def brute(k, differ):
        out = set()
        for s, i, x, y, source in rows:
            near = sorted((math.hypot(x - u, y - v), j) for t, j, u, v, other in rows if t == s and j != i and not (differ and other == source))
            out |= {(s, i, j, round(d, 9), r) for r, (d, j) in enumerate(near[:k], 1)}
        return out

    for k, differ in ((3, None), (1, "source"), (50, None)):
        got = {(r["s"], r["a"], r["b"], round(r["d"], 9), r["rank"]) for r in joins.nearest(df, df, ["s"], k, tile, differ).collect()}
        assert got == brute(k, differ)


def test_nearest_values(spark):
    rng = random.Random(6)
    rows = [(s, 100 * s + i, rng.choice([1, 2, 5, 9, 9, 30])) for s in range(3) for i in range(25)] + [(5, 600, 1)]
    df = spark.createDataFrame(rows, "s long, id long, v long")
    for k in (1, 4):
        want = set()
        for s, i, v in rows:
            near = sorted((abs(v - w), j) for t, j, w in rows if t == s and j != i)
            want |= {(s, i, j, d, r) for r, (d, j) in enumerate(near[:k], 1)}
        assert {tuple(r) for r in joins.nearest_values(df, ["s"], "v", k).collect()} == want


def test_landmarks_beyond_a_broadcast(spark, monkeypatch):
    rng = random.Random(2)
    points = spark.createDataFrame([(i, rng.uniform(0, 50), rng.uniform(0, 50)) for i in range(60)], "id long, x double, y double")
    landmarks = spark.createDataFrame([(i, rng.uniform(0, 50), rng.uniform(0, 50)) for i in range(30)], "landmark long, x double, y double")
    few = {(r["id"], r["landmark"], r["rank"]) for r in joins.nearest_landmarks(points, landmarks, 4).collect()}
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 5)
    assert {(r["id"], r["landmark"], r["rank"]) for r in joins.nearest_landmarks(points, landmarks, 4).collect()} == few


def test_strict_json(spark):
    texts = ['{"a": 1}', '{"a": 1, "a": 1}', '[1,]', "[NaN]", None, "", '[{"b": {"c": 1, "c": 2}}]', '{"a": {"a": 1}}']
    got = [r["fault"] for r in records.strict_json(spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1), "t").collect()]
    assert got == [None, "repeated key: a", "malformed", "not a number", "no text", "malformed", "repeated key: c", None]


def test_csv_that_breaks_its_schema(spark, tmp_path):
    records.write_csv(spark.createDataFrame([("x",)], "n string"), f"file://{tmp_path}/t")
    with pytest.raises(Exception, match="(?i)malformed|failfast|parse"):
        records.read_csv(spark, f"file://{tmp_path}/t", spark.createDataFrame([], "n long").schema).collect()


def test_listing(spark, sf_dir):
    rows = quality.table_files(spark, sf_dir).collect()
    assert [r["suffix"] for r in rows] == ["parquet"] and rows[0]["files"] >= 14 and rows[0]["bytes"] > 0


def test_overlapping_cores_look_past_the_last(spark):
    from tesserae.operators import constraints

    grid = spark.createDataFrame([(0, 0, 0, 100, "a"), (0, 0, 10, 20, "b"), (0, 0, 30, 40, "c"), (0, 0, 100, 120, "d")], "s int, y0 int, x0 int, x1 int, label string")
    assert sorted(r["key"] for r in constraints.overlapping_cores(grid, ["s"]).collect()) == ["b", "c"]


def test_unset_checkpoint_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        graph.shared_folder(Session())


def test_bundles_that_were_changed(spark, tmp_path):
    records.pack(spark.createDataFrame([(i, f"v{i}") for i in range(20)], "id long, v string"), "id", f"file://{tmp_path}/b", 3)
    rows = spark.read.parquet(f"file://{tmp_path}/b").withColumn("v", F.when(F.col("id") == 7, "other").otherwise(F.col("v")))
    rows.write.parquet(f"file://{tmp_path}/c")
    assert [r["id"] for r in records.restored(spark, f"file://{tmp_path}/c").where("not intact").collect()] == [7]
    assert records.restored(spark, f"file://{tmp_path}/b").where("intact").count() == 20

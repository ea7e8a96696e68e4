"""Steps that grow with their input, and ties that large tables bring."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest

from tesserae.operators import aggregates, evidence, graph, joins, models, overlay, raster
from tesserae.plans import catalog


def test_hotspots_interpolate_from_the_lower_value(spark):
    v = 0.5006686726847208
    means = [0.1, 0.2, v, math.nextafter(v, 2)]
    points = spark.createDataFrame([(0, 10.0 * i, 0.0, m, 0.0) for i, m in enumerate(means)], "s int, x double, y double, a double, b double")
    # The cut lies four tenths from v to the next double, which is v: both are hot in a, all four in b.
    assert aggregates.hotspots(points, ["s"], 10.0, "a", "b", 0.8).first()["jaccard"] == 0.5
    assert aggregates.percentiles(points, ["s"], "a", {"q": 0.8}).first()["q"] == v


def test_percentiles_round_as_their_sql_does(spark):
    # Cuts between values that are a few last bits apart; the first group is one of 64 means that lost a hot bin.
    draw = np.random.default_rng(3)
    groups = [[i / 100 for i in range(50)] + [0.5379999999999999, 0.538] + [0.6 + i / 100 for i in range(12)]]
    for _ in range(300):
        values = sorted(draw.random(int(draw.integers(3, 65))).tolist())
        at = int((len(values) - 1) * 0.8)
        values[at + 1] = math.nextafter(values[at], 2)
        groups.append(values)
    rows = pd.DataFrame([(g, v) for g, values in enumerate(groups) for v in values], columns=["g", "v"])
    want = dict(duckdb.sql("SELECT g, quantile_cont(v, 0.8) FROM rows GROUP BY g").fetchall())
    found = aggregates.percentiles(spark.createDataFrame(rows), ["g"], "v", {"q": 0.8})
    assert {r["g"]: r["q"] for r in found.collect()} == want and want[0] == 0.538


def test_near_points_are_not_broadcast(spark):
    # Files of points are small, so their sizes let a driver hold far more than it can.
    points = spark.range(400).selectExpr("0 AS s", "id", "CAST(id % 3 AS STRING) AS source", "CAST(id * 7 % 40 AS DOUBLE) AS x", "CAST(id * 11 % 40 AS DOUBLE) AS y")
    near = joins.nearest_of_sources(points, ["s"], 3.0, 4)
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    fused = graph.greedy_union(near.select("s", "a", "b", "d", "source_a", "source_b"), points, ["s"])
    assert "Broadcast" not in fused._jdf.queryExecution().executedPlan().toString()
    looked_up = graph.greedy_union(near.select("s", "a", "b", "d"), points, ["s"])
    assert set(fused.collect()) == set(looked_up.collect())


def test_fused_instances_use_all_pairs_of_a_crowd(spark, tmp_path):
    # The four cells of O nearest to any of the six of F go to four of them; the other two are left with those further off.
    rows, places = [], {}
    for key in range(1000):
        kind, low = ("F", 500) if len(rows) < 6 else ("O", 500) if len(rows) < 10 else ("O", 514)
        for customer in range(8192):
            x, y = (key * 7919 + customer * 31) % 8192 / 8, (key * 104729 + customer * 17) % 8192 / 8
            if len(rows) < 12 and low <= x < low + 6 and 500 <= y < 506:
                rows.append((key, customer, kind, "1-URGENT"))
                places[key] = (x, y)
                break
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    source = {r[0]: r[2] for r in rows}
    edges = sorted((math.dist(places[a], places[b]), a, b) for a in source for b in source if source[a] < source[b])
    group = {k: {k} for k in source}
    for d, a, b in edges:
        together = group[a] | group[b]
        if d < 24 and len({source[k] for k in together}) == len(together):
            group |= dict.fromkeys(together, together)
    found = catalog.queries()["fused_instances"](spark, str(tmp_path))
    assert len(group) == 12 and all(len(g) == 2 for g in group.values())
    assert {r["id"]: r["fused"] for r in found.collect()} == {k: min(g) for k, g in group.items()}


def brute_landmarks(points, landmarks, k):
    out = set()
    for i, x, y in points:
        near = sorted(((x - u) ** 2 + (y - v) ** 2, j) for j, u, v in landmarks)[:k]
        out |= {(i, j, n + 1) for n, (_, j) in enumerate(near)}
    return out


@pytest.mark.parametrize("most", [20_000, 5])
def test_landmarks_that_crowd_or_tie(spark, monkeypatch, most):
    # Ties of 65: (1, 8) and (4, 7) are equally far, though their rounded hypotenuses may differ; a crowd shares a place.
    landmarks = [(9, 1.0, 8.0), (8, 4.0, 7.0), (7, -8.0, 1.0), (6, 7.0, -4.0)] + [(100 + i, 50.0 + i % 2 / 8, 50.0) for i in range(300)] + [(1000 + i, float(i * 13 % 97), float(i * 29 % 97)) for i in range(300)]
    points = [(i, float(i % 10) * 9, float(i // 10) * 9) for i in range(100)] + [(200, 50.0, 50.0), (201, -1e6, 4e5)]
    monkeypatch.setattr(joins, "BROADCAST_ROWS", most)
    p = spark.createDataFrame(points, "id long, x double, y double")
    found = joins.nearest_landmarks(p, spark.createDataFrame(landmarks, "landmark long, x double, y double"), 7)
    assert {(r["id"], r["landmark"], r["rank"]) for r in found.collect()} == brute_landmarks(points, landmarks, 7)


def test_a_point_meets_few_landmarks():
    # What a look-up compares grows with the points, not with points times landmarks.
    rng = np.random.default_rng(1)
    met = []
    for n in (2_000, 16_000):
        near = joins._Near(rng.random(n), rng.random(n), np.arange(n), None, 5)
        order, cells, width, height = near._grid(near._first_size())
        met.append(np.bincount(cells).max())
        rows, found, d2, rank = near.find(rng.random(500), rng.random(500), np.full(500, -1), None)
        assert len(rows) == 2_500
    assert max(met) < 40


def test_nearest_carries_columns_and_splits_crowds(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 2), int(i), float(x), float(y), "xyz"[i % 3]) for i, (x, y) in enumerate(np.round(rng.random((300, 2)) * 64) / 8)]
    rows += [(0, 1000 + i, 3.0, 3.0, "x") for i in range(40)] + [(1, 2000, None, 1.0, "x"), (1, 2001, 500.0, 500.0, "y")]
    df = spark.createDataFrame(rows, "s int, id long, x double, y double, kind string")
    kind = {r[1]: r[4] for r in rows}
    for differ in (None, "kind"):
        want = set()
        for s, i, x, y, own in rows:
            if x is not None:
                near = sorted(((x - u) ** 2 + (y - v) ** 2, j) for t, j, u, v, other in rows if u is not None and t == s and j != i and not (differ and other == own))[:5]
                want |= {(s, i, j, n + 1, own, kind[j]) for n, (_, j) in enumerate(near)}
        got = joins.nearest(df, df, ["s"], 5, 1.0, differ, ["kind"]).select("s", "a", "b", "rank", "kind_a", "kind_b").collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_a_tile_floods_again_from_what_changed_around_it():
    # A row of five free pixels between two fixed ones: the left one is a neighbour's that has changed, the right one was spread before.
    low = [[float("-inf"), 0.0, 1.0], [float("-inf"), 0.0, 2.0]]
    part = pd.DataFrame({"y": 0, "x": range(7), "g": 1.0, "own": [False] + [True] * 6, "fixed": [True] + [False] * 5 + [True], "own_label": 9, "cost": [low[0], None, None, None, None, None, low[1]], "changed": False, "_ty": 0, "_tx": 0})
    none = raster._flooded(part.assign(fresh=False))
    assert not none["changed"].any()
    got = raster._flooded(part.assign(fresh=[True] + [False] * 6))
    assert got["x"].tolist() == [1, 2, 3, 4, 5, 6] and got["changed"].tolist() == [True] * 5 + [False]
    assert [c[-1] for c in got["cost"]] == [1.0] * 5 + [2.0]


def test_rounds_of_snapped_hold_tiles(spark, monkeypatch):
    # 40 x 40 pixels, whose costs go from tile to tile for several rounds, in rows of whole tiles of 8 x 8.
    kept, written = raster.stored, []

    def counted(df, instead_of=None):
        out = kept(df, instead_of)
        written.append(out.count())
        return out

    monkeypatch.setattr(raster, "stored", counted)
    pixels = spark.range(1600).selectExpr("0 AS k", "id div 40 AS y", "id % 40 AS x", "CAST(id * 7919 % 13 AS DOUBLE) AS g", "IF(id % 40 < 20, 1, 2) AS label")
    found = raster.snapped(pixels, pixels, ["k"], 12, 8)
    assert found.count() == 1600 and found.select("y", "x").distinct().count() == 1600
    assert len(written) > 4 and max(written) <= 25


def test_short_cycles_leave_early(spark, monkeypatch):
    rng = np.random.default_rng(2)
    lengths = [*range(1, 20), *[4] * 300, 33, 200]
    ids = rng.permutation(2 * sum(lengths))[: sum(lengths)].tolist()
    links, want, at = [], set(), 0
    for n in lengths:
        own = ids[at : at + n]
        at += n
        first = own.index(min(own))
        links += [(0, own[i], own[(i + 1) % n]) for i in range(n)]
        want |= {(0, own[i], own[first], (first - i) % n or n) for i in range(n)}
    kept, written = graph.stored, []

    def counted(df, instead_of=None):
        out = kept(df, instead_of)
        written.append(out.count())
        return out

    monkeypatch.setattr(graph, "stored", counted)
    got = graph.cycles(spark.createDataFrame(links, "k int, id long, next long"), ["k"]).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert sum(written) < 7 * len(links)  # nine rounds


def test_lone_pairs_are_matched_without_components(spark, monkeypatch):
    rows = [(1, i, i, 0.5) for i in range(50)] + [(1, 60, 60, 0.9), (1, 60, 61, 0.8), (1, 62, 60, 0.8), (2, 60, 61, 0.1), (2, None, 9, 0.5)]
    linked, plain = [], graph.components
    monkeypatch.setattr(graph, "components", lambda edges, keys=(): linked.append(edges.count()) or plain(edges, keys))
    got = {tuple(r)[:3] for r in graph.assignment(spark.createDataFrame(rows, "s int, a int, b int, iou double"), ["s"], "iou").collect()}
    assert got == {(1, i, i) for i in range(50)} | {(1, 60, 61), (1, 62, 60), (2, 60, 61)}
    assert linked == [3]


def test_density_clusters_find_their_pairs_once(spark):
    # Near pairs are the dear part, and were found again for every step that reads them.
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    pairs = [(i, j) for i in range(20) for j in (i - 1, i + 1) if 0 <= j < 20]
    near = spark.createDataFrame(pairs, "a long, b long").mapInPandas(count, "a long, b long")
    got = {r["id"]: r["cluster"] for r in models.density_clusters(spark.range(21), near, 3).collect()}
    assert got == {**dict.fromkeys(range(20), 1), 20: None}
    assert made.value == len(pairs)


def test_seeds_are_made_once(spark):
    # Rounds of nearest() made the raster that seeds come from anew each time.
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    kind = "s int, y int, x int, label int"
    seeds = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 40, 6)], kind).mapInPandas(count, kind)
    within = spark.createDataFrame([(1, 0, x) for x in range(64)], "s int, y int, x int")
    got = {r["x"]: r["label"] for r in raster.grown(seeds, within, ["s"], 64).collect()}
    assert got == {x: 5 if x <= 20 else 6 for x in range(64)}
    assert made.value == 2


def stars(spark, n):
    """Members of components: three sources' outlines with bays, some of them apart, without area or alone."""
    rng, rows = np.random.default_rng(21), []
    for i in range(n):
        x, y = rng.uniform(0, 900, 2)
        for j, source in enumerate("ABC"[: 1 + i % 3]):
            u, v = x + rng.normal(0, 3), y + rng.normal(0, 3)
            ring = [(u + r * math.cos(t), v + r * math.sin(t)) for t, r in zip(np.linspace(0, 2 * math.pi, 9)[:-1], rng.uniform(1, 5, 8))]
            ring = ring[: 2 if i % 10 == 4 and j else 8][:: 1 if rng.random() < 0.5 else -1]
            rows.append((i % 2, i, 10 * i + j, source, float(u), float(v), [{"x": float(p), "y": float(q)} for p, q in ring]))
    return spark.createDataFrame(rows, "s int, component int, id int, source string, x double, y double, ring array<struct<x:double,y:double>>")


def test_small_contours_are_compared_in_their_row(spark, monkeypatch):
    members = stars(spark, 60)
    counts = members.groupBy("source").agg({"*": "count"}).toDF("source", "n")
    columns = sorted(evidence.pair_agreement(members, counts, ["s"]).columns)

    def agreement():
        return sorted(map(tuple, evidence.pair_agreement(members, counts, ["s"]).select(*columns).orderBy("source_a", "source_b").collect()), key=str)

    with monkeypatch.context() as m:
        m.setattr(evidence, "ROW_SIDES", 0)
        as_rows = agreement()
    for name in ("arranged", "hausdorff"):
        monkeypatch.setattr(overlay, name, lambda *_: pytest.fail("small contours were dealt out as rows"))
    in_a_row = agreement()
    assert len(in_a_row) == 3
    for one, two in zip(as_rows, in_a_row, strict=True):
        assert all(p == q or math.isclose(p, q, abs_tol=1e-9) for p, q in zip(one, two, strict=True))


def test_members_are_named_without_broadcasts_and_alone_only_if_asked(spark):
    points = spark.createDataFrame([(0, i, "AB"[i % 2], float(i)) for i in range(6)], "s int, id long, source string, x double")
    named = spark.createDataFrame([(0, 1, 1), (0, 2, 1), (0, 3, 1)], "s int, node long, component long")
    for alone, want in ((True, {(0, "A", 0), (1, "A", 2), (1, "B", 1), (4, "A", 4), (5, "B", 5)}), (False, {(1, "A", 2), (1, "B", 1)})):
        found = evidence.first_members(points, named, ["s"], ["x"], alone)
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert {(r["component"], r["source"], r["id"]) for r in found.collect()} == want

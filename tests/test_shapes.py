"""Contours against walks along pixels, overlays against clipping and pixels, simplification against loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import constraints, contours, evidence, geometry, graph, joins, overlay
from tesserae.plans import catalog

RING = "array<struct<x:double,y:double>>"


def twice(p):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1], strict=True))


def from_least(points):
    k = min(range(len(points)), key=lambda i: points[i])
    return tuple(points[k:] + points[:k])


def walked(px, eight):
    """(label, area, sides, corners) of all rings of {(y, x): label}, by walking along their sides."""
    steps, out = [(0, 1), (1, 0), (0, -1), (-1, 0)], []
    for label in set(px.values()):
        own = {p for p, v in px.items() if v == label}
        edges = set()
        for y, x in own:
            for d, (ny, nx, sy, sx) in enumerate([(y - 1, x, y, x), (y, x + 1, y, x + 1), (y + 1, x, y + 1, x + 1), (y, x - 1, y + 1, x)]):
                if (ny, nx) not in own:
                    edges.add((sy, sx, d))
        left = set(edges)
        while left:
            e = start = min(left)
            ring = []
            while True:
                left.discard(e)
                y, x, d = e
                ring.append(e)
                e = next((y + steps[d][0], x + steps[d][1], (d + t) % 4) for t in ((3, 0, 1) if eight else (1, 0, 3)) if (y + steps[d][0], x + steps[d][1], (d + t) % 4) in edges)
                if e == start:
                    break
            points = [(float(x), float(y)) for (y, x, d), before in zip(ring, [ring[-1], *ring[:-1]], strict=True) if d != before[2]]
            out.append((label, twice(points) / 2, len(ring), from_least(points)))
    return sorted(out)


def mask(seed, h=25, w=30, labels=(0, 0, 1, 1, 1, 1, 2)):
    r = random.Random(seed)
    px = {(y, x): r.choice(labels) for y in range(h) for x in range(w)}
    return {p: v for p, v in px.items() if v}


def frame(spark, px, k=7):
    return spark.createDataFrame([(k, y, x, v) for (y, x), v in px.items()], "k int, y int, x int, label int")


@pytest.mark.parametrize("eight", [True, False])
def test_contours(spark, eight):
    px = mask(3)
    df = frame(spark, px)
    df = df.unionByName(df.limit(5)).unionByName(spark.createDataFrame([(7, 2, 2, 0), (7, 2, 3, None)], df.schema))  # repeats, background
    got = []
    for g in contours.contours(df, ["k"], eight).collect():
        assert g["hole"] == (g["area"] < 0)
        got.append((g["label"], g["area"], g["sides"], from_least([(p["x"], p["y"]) for p in g["points"]])))
    assert sorted(got) == walked(px, eight)


@pytest.mark.parametrize("eight", [True, False])
def test_polygons_rasterise_back(spark, eight):
    """Pixels whose centres lie in a polygon's ring but in none of its holes are the region's; holes lie in their own region."""
    px = mask(4, 20, 20)
    # A frame around a frame: holes next to holes, and regions within holes.
    for i in range(20):
        for p in ((0, i), (19, i), (i, 0), (i, 19)):
            px[p] = 1
    found = contours.polygons(frame(spark, px), ["k"], eight)
    rings = found.select("k", "label", "polygon", F.explode(F.concat(F.array("ring"), "holes")).alias("ring"))
    rows = geometry.rasterised(rings.select("k", F.struct("label", "polygon").alias("polygon"), "ring"), ["k"])
    inside = {}
    for r in rows.collect():
        key = r["polygon"]["label"], r["polygon"]["polygon"], r["y"], r["x"]
        inside[key] = inside.get(key, 0) + 1
    assert sorted((y, x, label) for (label, _, y, x), n in inside.items() if n % 2) == sorted((y, x, v) for (y, x), v in px.items())
    sizes = {}
    for (label, polygon, _, _), n in inside.items():
        sizes[label, polygon] = sizes.get((label, polygon), 0) + n % 2
    assert {(r["label"], r["polygon"]): r["area"] for r in found.collect()} == sizes


def patches(seed, h, w, size):
    """A mask of two labels in patches of a size, sprinkled with pixels of either and of none."""
    r = random.Random(seed)
    coarse = {(y, x): r.choice((1, 1, 2, 0)) for y in range(h // size + 1) for x in range(w // size + 1)}
    px = {(y, x): coarse[y // size, x // size] if r.random() < 0.97 else r.choice((0, 1, 2)) for y in range(h) for x in range(w)}
    return {p: v for p, v in px.items() if v}


@pytest.mark.parametrize("eight", [True, False])
@pytest.mark.parametrize("size", [5, 90])
def test_contours_and_polygons_across_tiles(spark, eight, size):
    """Rings, holes and runs of pixels that leave their tiles, a frame around all, and a frame in it whose holes lie far from its side."""
    px = patches(size, 200, 140, size)
    for i in range(260):
        for d in (0, 1, 2):
            px |= {(d, i): 1, (259 - d, i): 1, (i, d): 1, (i, 259 - d): 1}
    px |= {(y, x): 2 for y in range(205, 250) for x in range(70, 250) if not (y in (210, 220) and x % 61 == 5 or y == 230 and x > 75 and x < 240)}
    df = frame(spark, px)
    got = contours.contours(df, ["k"], eight).collect()
    assert all(g["hole"] == (g["area"] < 0) and g["hole"] == (g["ring"] % 4 == 1) for g in got)
    assert sorted((g["label"], g["area"], g["sides"], from_least([(p["x"], p["y"]) for p in g["points"]])) for g in got) == walked(px, eight)
    # Regions by their pixels, the first in scan order of each being where its outer ring's smallest side starts.
    steps = [(0, 1), (1, 0), (0, -1), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if eight else [])
    sizes, seen = {}, set()
    for p in sorted(px):
        if p not in seen:
            todo, n = [p], 0
            seen.add(p)
            while todo:
                y, x = todo.pop()
                n += 1
                near = [(y + dy, x + dx) for dy, dx in steps if px.get((y + dy, x + dx)) == px[p] and (y + dy, x + dx) not in seen]
                seen.update(near)
                todo += near
            sizes[px[p], (p[0] * contours.FAR + p[1]) * 4] = n
    found = contours.polygons(df, ["k"], eight).collect()
    assert {(r["label"], r["polygon"]): r["area"] for r in found} == sizes
    assert sum(1 + len(r["holes"]) for r in found) == len(got)


def test_sides_within_a_tile_are_not_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(contours, "cycles", lambda *_: pytest.fail("rings of one tile were ranked as rows"))
    px = mask(5)
    assert len(contours.contours(frame(spark, px), ["k"]).collect()) == len(walked(px, True))
    assert contours.polygons(frame(spark, px), ["k"]).agg(F.sum("area")).first()[0] == len(px)


def test_polygon_overlaps_deal_out_no_sides(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(graph, "cycles", lambda *_: pytest.fail("sides were ranked as rows"))
    monkeypatch.setattr(contours, "cycles", graph.cycles)
    monkeypatch.setattr(overlay, "arranged", lambda *_: pytest.fail("small polygons were dealt out as rows"))
    assert catalog.queries()["polygon_overlaps"](spark, sf_dir).agg(F.sum("both")).first()[0] > 0


def test_one_long_ring(spark):
    """A comb, whose ring is far longer than it is wide, and an empty mask."""
    px = {(y, x): 1 for x in range(60) for y in range(40) if y == 0 or x % 2 == 0}
    (r,) = contours.contours(frame(spark, px), ["k"]).collect()
    assert [(r["label"], r["area"], r["sides"], from_least([(p["x"], p["y"]) for p in r["points"]]))] == walked(px, True) and r["sides"] > 2000
    assert contours.polygons(frame(spark, {(0, 0): 1}).where("false"), ["k"]).isEmpty()


def test_dissolved(spark):
    px = mask(6, labels=(0, 1, 2, 3, 4))
    values = spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "label int, value int")
    named = {p: {1: 10, 2: 10, 3: 20}[v] for p, v in px.items() if v != 4}
    got = contours.dissolved(frame(spark, px), ["k"], values).collect()
    rings = sorted((r["value"], from_least([(p["x"], p["y"]) for p in ring])) for r in got for ring in [r["ring"], *r["holes"]])
    assert rings == sorted((v, points) for v, _, _, points in walked(named, True))


def clipped(p, q):
    """The common part of two convex rings that run to the left."""
    for a, b in zip(q, q[1:] + q[:1], strict=True):
        out = []
        for u, v in zip(p, p[1:] + p[:1], strict=True):
            su, sv = ((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]) for c in (u, v))
            if su >= 0:
                out.append(u)
            if su * sv < 0:
                t = su / (su - sv)
                out.append((u[0] + t * (v[0] - u[0]), u[1] + t * (v[1] - u[1])))
        p = out
        if not p:
            return []
    return p


@pytest.fixture(scope="module")
def convex(spark):
    """Pairs of convex rings, either way round: anyhow, equal, side by side, at a corner, within one another, and sharing sides."""
    r, pairs = random.Random(5), []
    for _ in range(25):
        rings = []
        for _ in range(2):
            n, cx, cy, size = r.randint(3, 9), r.uniform(40, 80), r.uniform(-30, 10), r.uniform(5, 40)
            rings.append([(cx + size * math.cos(t), cy + size * math.sin(t)) for t in sorted(r.uniform(0, 2 * math.pi) for _ in range(n))])
        pairs.append(rings)
    square = [(0.0, 0.0), (20.0, 0.0), (20.0, 20.0), (0.0, 20.0)]
    for move in (lambda x, y: (x + 20, y), lambda x, y: (x + 20, y + 20), lambda x, y: (x / 4 + 5, y / 4 + 5), lambda x, y: (x / 2, y / 2), lambda x, y: (x + 10, y), lambda x, y: (x + 10, y + 5)):
        pairs.append([square, [move(*p) for p in square]])
    pairs.append([square, square[2:] + square[:2]])
    want, rows = {}, []
    for i, (p, q) in enumerate(pairs):
        common = clipped(p, q)
        want[i] = (twice(common) / 2 if common else 0.0, twice(p) / 2, twice(q) / 2)
        rows += [(1, 2 * i + j, [{"x": x, "y": y} for x, y in (ring if r.random() < 0.5 else ring[::-1])], None if j else []) for j, ring in enumerate((p, q))]
    frame_ = spark.createDataFrame(rows, f"k int, polygon int, ring {RING}, holes array<{RING}>")
    pieces = overlay.arranged(spark.createDataFrame([(1, 2 * i, 2 * i + 1) for i in want], "k int, a int, b int"), frame_, ["k"], 16.0).cache()
    return want, pairs, frame_, pieces


def test_overlay_areas(convex):
    want, _, _, pieces = convex
    got = {r["a"] // 2: r for r in overlay.overlay_areas(pieces, ["k"]).collect()}
    assert set(got) == set(want)
    for i, (both, a, b) in want.items():
        assert np.allclose([got[i][c] for c in ("both", "either", "only_a", "only_b", "iou")], [both, a + b - both, a - both, b - both, both / (a + b - both)], atol=1e-6), i


@pytest.mark.parametrize("kind", ["both", "either", "only_a"])
def test_overlay_rings(convex, kind):
    want, _, _, pieces = convex
    sums = {}
    for r in overlay.overlay_rings(pieces, ["k"], kind).collect():
        points = [(p["x"], p["y"]) for p in r["points"]]
        assert math.isclose(twice(points) / 2, r["area"], abs_tol=1e-9) and r["hole"] == (r["area"] < 0)
        sums[r["a"] // 2] = sums.get(r["a"] // 2, 0) + r["area"]
    for i, (both, a, b) in want.items():
        assert math.isclose(sums.get(i, 0), {"both": both, "either": a + b - both, "only_a": a - both}[kind], abs_tol=1e-6)


def test_hausdorff(convex, spark):
    want, pairs, frame_, _ = convex

    def away(p, ring):
        out = []
        for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
            dx, dy = b[0] - a[0], b[1] - a[1]
            t = max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
            out.append(math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy))
        return min(out)

    got = {r["a"] // 2: r["distance"] for r in overlay.hausdorff(spark.createDataFrame([(1, 2 * i, 2 * i + 1) for i in want], "k int, a int, b int"), frame_, ["k"]).collect()}
    for i, (p, q) in enumerate(pairs):
        assert math.isclose(got[i], max(max(away(u, q) for u in p), max(away(u, p) for u in q)), abs_tol=1e-9)


def test_common_areas_and_hausdorff_in_a_row(convex, spark):
    want, pairs, frame_, _ = convex
    by = lambda name: frame_.select(F.expr("polygon div 2").alias("i"), F.col("ring").alias(name)).where(f"polygon % 2 = {'ab'.index(name)}")
    both = by("a").join(by("b"), "i")
    got = {r["i"]: r for r in both.select("i", overlay.common_area(F.col("a"), F.col("b")).alias("both"), overlay.ring_hausdorff(F.col("a"), F.col("b")).alias("h")).collect()}
    far = {r["a"] // 2: r["distance"] for r in overlay.hausdorff(spark.createDataFrame([(1, 2 * i, 2 * i + 1) for i in want], "k int, a int, b int"), frame_, ["k"]).collect()}
    assert set(got) == set(want)
    for i, (shared, _, _) in want.items():
        assert math.isclose(got[i]["both"], shared, abs_tol=1e-9) and got[i]["h"] == far[i], i


def test_overlays_of_outlines_are_pixels(spark):
    """Polygons with holes, sharing sides, corners and more."""
    a, b = mask(8, 14, 14, (0, 1, 1)), mask(9, 14, 14, (0, 1, 1))
    pa, pb = contours.polygons(frame(spark, a), ["k"]), contours.polygons(frame(spark, b), ["k"])
    pb = pb.withColumn("polygon", -1 - F.col("polygon"))
    pairs = pa.select("k", F.col("polygon").alias("a")).join(pb.select("k", F.col("polygon").alias("b")), "k")
    got = overlay.overlay_areas(overlay.arranged(pairs, pa.unionByName(pb), ["k"], 4.0), ["k"])
    assert got.agg(F.sum("both")).first()[0] == len(set(a) & set(b))
    assert overlay.arranged(pairs.where("false"), pa.unionByName(pb), ["k"]).isEmpty()


@pytest.mark.parametrize("most", [1_000_000, 60, 0])
def test_common_areas_of_outlines_are_pixels(spark, monkeypatch, most):
    a, b = mask(8, 14, 14, (0, 1, 1)), mask(9, 14, 14, (0, 1, 1))
    pa, pb = contours.polygons(frame(spark, a), ["k"]), contours.polygons(frame(spark, b), ["k"])
    pb = pb.withColumn("polygon", -1 - F.col("polygon"))
    pairs = pa.select("k", F.col("polygon").alias("a")).join(pb.select("k", F.col("polygon").alias("b")), "k")
    monkeypatch.setattr(overlay, "ROW_SIDES", most)
    if most > 60:  # no pair has as many
        monkeypatch.setattr(overlay, "arranged", lambda *_: pytest.fail("small polygons were dealt out as rows"))
    assert overlay.common_areas(pairs, pa.unionByName(pb), ["k"], 4.0).agg(F.sum("both")).first()[0] == len(set(a) & set(b))


def test_pair_agreement_of_odd_contours(spark):
    shapes = [(1, 1, "A", [(0, 0), (4, 0), (4, 4), (0, 4)]), (1, 2, "B", [(2, 0), (6, 0), (2, 4)]), (2, 3, "A", [(0, 0), (1, 1)]), (2, 4, "B", [(0, 0), (2, 0), (0, 2)])]
    members = spark.createDataFrame([(1, c, i, s, 0.0, float(i), [{"x": float(x), "y": float(y)} for x, y in p]) for c, i, s, p in shapes], f"s int, component int, id int, source string, x double, y double, ring {RING}")
    (r,) = evidence.pair_agreement(members, spark.createDataFrame([("A", 2), ("B", 4)], "source string, n long"), ["s"]).collect()
    assert (r["matched"], r["median_d"], r["fraction_b"]) == (2, 1.0, 0.5)
    assert math.isclose(r["iou_median"], 6 / (16 + 8 - 6)) and math.isclose(r["hausdorff_p95"], 2.0)


def thinned_loop(points, least):
    """The smallest effective area goes, over and over."""
    points, floor = list(enumerate(points)), 0.0
    areas = {}
    while len(points) > 3:
        values = []
        for j, (i, p) in enumerate(points):
            a, b = points[j - 1][1], points[(j + 1) % len(points)][1]
            values.append((max(areas.get(i, 0.0), abs((p[0] - a[0]) * (b[1] - a[1]) - (b[0] - a[0]) * (p[1] - a[1])) / 2), i, j))
        v, _, j = min(values)
        if v >= least:
            break
        floor = max(floor, v)
        areas[points[j - 1][0]] = areas[points[(j + 1) % len(points)][0]] = floor
        del points[j]
    return [i for i, _ in points]


def test_thinned_rings():
    r = random.Random(2)
    for _ in range(40):
        n = r.randint(3, 30)
        points = [(r.randint(0, 12), r.randint(0, 12)) for _ in range(n)]
        x, y = np.array(points, float).T
        assert contours.thinned_ring(x, y, 9.0).tolist() == thinned_loop(points, 9.0)


def test_near_rings():
    r = np.random.default_rng(3)
    for _ in range(30):
        t = np.sort(r.uniform(0, 6.28, r.integers(4, 60)))
        x, y = 20 * np.cos(t) + r.normal(0, 1, len(t)), 20 * np.sin(t) + r.normal(0, 1, len(t))
        at = contours.near_ring(x, y, 2.0)
        assert len(at) >= 3 and 0 in at
        ends = [*at.tolist(), len(t)]
        x2, y2 = np.append(x, x[0]), np.append(y, y[0])
        for a, b in zip(ends, ends[1:], strict=False):
            d = np.array([x2[b] - x2[a], y2[b] - y2[a]])
            for i in range(a + 1, b):
                p = np.array([x2[i] - x2[a], y2[i] - y2[a]])
                assert np.hypot(*(p - np.clip(p @ d / (d @ d), 0, 1) * d)) <= 2.0 + 1e-9


def test_simplified_and_cleaned(spark):
    rows = [(1, [{"x": float(x), "y": float(y)} for x, y in [(0, 0), (5, 0.1), (10, 0), (10, 10), (0, 10)]]), (2, None), (3, []), (4, [{"x": 1.0, "y": 2.0}])]
    got = {r["i"]: r["ring"] for r in contours.simplified(spark.createDataFrame(rows, f"i int, ring {RING}"), "ring", area=1.0).collect()}
    assert [(p["x"], p["y"]) for p in got[1]] == [(0, 0), (10, 0), (10, 10), (0, 10)] and got[2] is None and got[3] == [] and len(got[4]) == 1
    px = {(y, x): 1 for y in range(5) for x in range(5) if (y, x) != (2, 2)} | {(9, 9): 1}
    found = contours.polygons(frame(spark, px), ["k"])
    assert [(r["area"], len(r["holes"])) for r in contours.cleaned(found, 2.0).collect()] == [(24.0, 1)]
    assert [(r["area"], len(r["holes"])) for r in contours.cleaned(found, 2.0, fill=True).collect()] == [(25.0, 0)]


def test_rings_that_touch_themselves(spark):
    rings = {"bow": [(0, 0), (2, 2), (2, 0), (0, 2)], "spike": [(0, 0), (4, 0), (2, 0), (0, 4)], "touch": [(0, 0), (4, 2), (0, 4), (2, 1)], "corner": [(0, 0), (4, 0), (2, 2), (4, 4), (0, 4), (2, 2)], "square": [(0, 0), (2, 0), (2, 2), (0, 2)], "triangle": [(0, 0), (2, 0), (0, 2)], "straight": [(0, 0), (1, 0), (2, 0), (2, 2), (0, 2)]}
    df = spark.createDataFrame([(k, [{"x": float(x), "y": float(y)} for x, y in p]) for k, p in rings.items()], f"k string, ring {RING}")
    got = {r["k"]: r["c"] for r in df.select("k", geometry.crosses_itself(F.col("ring")).alias("c")).collect()}
    assert got == {"bow": True, "spike": True, "touch": True, "corner": True, "square": False, "triangle": False, "straight": False}


def test_overlapping_boxes(spark):
    r = random.Random(7)
    boxes = [(r.randint(1, 2), i, x := r.uniform(-20, 60), y := r.uniform(-20, 60), x + r.choice([0, 3, 30]), y + r.choice([2, 15])) for i in range(80)]
    got = constraints.overlapping_boxes(spark.createDataFrame(boxes, "s int, label int, x0 double, y0 double, x1 double, y1 double"), ["s"], 8)
    want = [(a[0], a[1], b[1]) for a in boxes for b in boxes if a[0] == b[0] and a[1] < b[1] and a[2] < b[4] and b[2] < a[4] and a[3] < b[5] and b[3] < a[5]]
    assert sorted(tuple(x) for x in got.collect()) == sorted(want)


def test_overlaps_are_settled_or_errors(spark):
    def square(i, h):
        return (1, i, [{"x": x * h, "y": y * h} for x, y in ((-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0))])

    shapes = spark.createDataFrame([square(1, 9.0), square(2, 4.0), square(3, 4.0)], f"s int, polygon int, ring {RING}")
    points = spark.createDataFrame([(1, 10, 0.5, 0.5), (1, 11, 6.0, 0.0), (1, 12, 50.0, 0.0)], "s int, id int, x double, y double")
    met = geometry.points_in_polygons(points, shapes, ["s"], 8)
    assert sorted((r["id"], r["polygon"]) for r in geometry.one_polygon(met, ["s", "id"]).collect()) == [(10, 2), (11, 1)]
    assert [(r["id"], r["polygon"]) for r in geometry.one_polygon(met.where("id = 11"), ["s", "id"], "error").collect()] == [(11, 1)]
    with pytest.raises(Exception, match="overlap at a point"):
        geometry.one_polygon(met, ["s", "id"], "error").collect()
    with pytest.raises(ValueError):
        geometry.one_polygon(met, ["s", "id"], "largest")


def test_look_ups_that_may_not_miss(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    names = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "d")], "k int, name string")
    assert sorted((r["k"] or 0, r["name"]) for r in joins.look_up_known(df, names, "k", "name").collect()) == [(0, None), (1, "a"), (2, "b")]
    with pytest.raises(Exception, match="no name for the k 9"):
        joins.look_up_known(df.unionByName(spark.createDataFrame([(9,)], "k int")), names, "k", "name").collect()
    with pytest.raises(Exception, match="k repeats: 3"):
        joins.look_up_known(df.unionByName(spark.createDataFrame([(3,)], "k int")), names, "k", "name").collect()

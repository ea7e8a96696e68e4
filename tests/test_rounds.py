"""Work in rounds over pixels and boxes against plain loops."""

import math
import random

import numpy as np
import pytest

from tesserae.operators import evidence, raster


def spiral(cx, cy, width, height):
    """Pixels around a centre, ring by ring."""
    for r in range(2 * max(width, height)):
        ring = [(cx, cy)] if r == 0 else [(cx + d, y) for d in range(-r, r + 1) for y in (cy - r, cy + r)] + [(x, cy + d) for d in range(-r + 1, r) for x in (cx - r, cx + r)]
        for x, y in ring:
            if 0 <= x < width and 0 <= y < height:
                yield x, y


def one_by_one(rows, width, height):
    taken, out = {}, {}
    for k, i, _, x, y in sorted(rows, key=lambda r: r[2]):
        cx, cy = min(width - 1, max(0, round(x))), min(height - 1, max(0, round(y)))
        out[k, i] = next(p for p in spiral(cx, cy, width, height) if (k, *p) not in taken)
        taken[(k, *out[k, i])] = i
    return out


def test_seed_pixels(spark):
    """A crowd on one pixel, centres beyond the edges, halves, and a full image."""
    r = random.Random(1)
    rows = [(1, i, 1000 - i, 5.5, 4.5) for i in range(60)] + [(1, 100 + i, i, r.uniform(-3, 25), r.uniform(-3, 19)) for i in range(120)]
    rows += [(2, i, i, r.uniform(0, 5), r.uniform(0, 4)) for i in range(30)]
    df = spark.createDataFrame(rows, "k int, id int, order int, x double, y double")
    got = {(r.k, r.id): (r.x, r.y) for r in raster.seed_pixels(df.where("k = 1"), ["k"], 22, 16).collect()}
    assert got == one_by_one([r for r in rows if r[0] == 1], 22, 16)
    got = {(r.k, r.id): (r.x, r.y) for r in raster.seed_pixels(df.where("k = 2"), ["k"], 6, 5).collect()}
    assert got == one_by_one([r for r in rows if r[0] == 2], 6, 5) and len(set(got.values())) == 30
    with pytest.raises(ValueError, match="more centres"):
        raster.seed_pixels(df.where("k = 2"), ["k"], 5, 5)


def flooded(labels, slopes, radius):
    """The whole image at once."""
    edge = {p for p, v in labels.items() for d in ((0, 1), (0, -1), (1, 0), (-1, 0)) if labels.get((p[0] + d[0], p[1] + d[1]), v) != v}
    free = {p for p in labels if any(math.hypot(p[0] - e[0], p[1] - e[1]) <= radius for e in edge)}
    cost = {p: (-math.inf, 0, v) for p, v in labels.items() if p not in free}
    changed = True
    while changed:  # every pixel from every neighbour, until nothing changes
        changed = False
        for p in sorted(free):
            for d in ((0, 1), (0, -1), (1, 0), (-1, 0)):
                c, g = cost.get((p[0] + d[0], p[1] + d[1])), slopes.get(p, 0.0)
                new = c and ((g, 1, *c) if g > c[0] else (c[0], c[1] + 1, *c[2:]))
                if new and (p not in cost or new < cost[p]):
                    cost[p], changed = new, True
    return {p: cost[p][-1] if p in cost else v for p, v in labels.items()}


@pytest.mark.parametrize("tile", [5, 64])
def test_snapped(spark, tile):
    """Boundaries move to ridges, whatever the tiles; holes in the mask, and a part without any label left."""
    r = random.Random(2)
    labels = {(y, x): 1 + (y > 11) + 2 * (x > 13) for y in range(24) for x in range(28) if r.random() > 0.04}
    labels |= {(40, 1): 1, (40, 2): 2}
    slopes = {p: float(r.randint(0, 6)) for p in labels if r.random() > 0.1}
    df = spark.createDataFrame([(1, y, x, v) for (y, x), v in labels.items()] + [(1, 60, 60, 0)], "k int, y int, x int, label int")
    g = spark.createDataFrame([(1, y, x, v) for (y, x), v in slopes.items()], "k int, y int, x int, g double")
    got = {(r.y, r.x): r.label for r in raster.snapped(df, g, ["k"], 2, tile).collect()}
    assert got == flooded(labels, slopes, 2) and got != labels


def test_even_samples(spark):
    r = random.Random(4)
    rows = [(1, i, r.gauss(0, 3), r.gauss(0, 3)) for i in range(300)] + [(2, i, float(i), 0.0) for i in range(7)]
    df = spark.createDataFrame(rows, "k int, id int, x double, y double")
    for most in (5, 90, 1000):
        got = evidence.even_sample(df, ["k"], "id", 1.0, most).collect()
        boxes = {}
        for row in got:
            _, _, x, y = next(q for q in rows if q[0] == row.k and q[1] == row.id)
            boxes.setdefault((row.k, math.floor(x), math.floor(y)), []).append(row)
        for k in (1, 2):
            n = {b: sum((q[0], math.floor(q[2]), math.floor(q[3])) == b for q in rows) for b in {(q[0], math.floor(q[2]), math.floor(q[3])) for q in rows if q[0] == k}}
            assert sum(len(v) for b, v in boxes.items() if b[0] == k) == min(most, sum(n.values()))
            given = {b: len(boxes.get(b, [])) for b in n}
            level = max(given.values())
            assert all(g in (level, level - 1) or g == n[b] for b, g in given.items())
    size = evidence.box_size(df.where("k = 1"), 60)
    occupied = {(math.floor(q[2] / size), math.floor(q[3] / size)) for q in rows if q[0] == 1}
    wider = {(math.floor(q[2] / (1.3 * size)), math.floor(q[3] / (1.3 * size))) for q in rows if q[0] == 1}
    assert 60 <= len(occupied) < 90 and len(wider) < len(occupied)


def test_inverse_distances(spark):
    rows = [(1, i, float(x), 0.0) for i, x in enumerate([0, 0, 1, 3, 10, 100])] + [(2, 9, 0.0, 0.0)]
    got = {(r.k, r.id): r.weight for r in evidence.inverse_distance_weights(spark.createDataFrame(rows, "k int, id int, x double, y double"), ["k"], 1, 2.0, 4.0).collect()}
    low = 1.0 + 0.001 * 0  # of the distances above zero: 1, 2, 7 and 90
    assert got[1, 5] == pytest.approx(90.0**-2) and got[1, 3] == pytest.approx(2.0**-2) and got[2, 9] == 0.0
    assert got[1, 0] == got[1, 1] == pytest.approx((low + 0.003) ** -2)


def test_centred_axes():
    for length in range(1, 60):
        for stride in range(1, 25):
            try:
                first, n = raster.centred_axis(length, stride)
            except ValueError:
                continue
            centres = [first + i * stride for i in range(n)]
            assert 0 <= centres[0] and (centres[-1] < length or n * stride > length + stride) and centres[0] - stride // 2 <= 0 and centres[-1] - stride // 2 + stride >= length
    assert raster.centred_axis(1000, 192) == (20, 6) and raster.centred_axis(5, 10) == (3, 1)
    with pytest.raises(ValueError, match="above zero"):
        raster.centred_axis(0, 3)


@pytest.mark.parametrize(
    "why, cells",
    [
        ("outside its window", [(1, 1, 40.0, 5.0)]),
        ("outside its core", [(1, 1, 30.0, 5.0)]),
        ("an id repeats", [(1, 1, 3.0, 5.0), (2, 1, 12.0, 5.0)]),
        ("unknown shard", [(9, 1, 3.0, 5.0)]),
        ("outside its window", [(1, 1, None, 5.0)]),
        ("outside the image", [(2, 1, 34.0, 5.0)]),
    ],
)
def test_core_cells(spark, why, cells):
    shards = spark.createDataFrame([(1, 0, 0, 32, 32, 0, 0, 24, 32), (2, 16, 0, 64, 32, 24, 0, 64, 32)], "shard int, hx0 int, hy0 int, hx1 int, hy1 int, x0 int, y0 int, x1 int, y1 int")
    kind = "shard int, id int, x double, y double"
    good = raster.core_cells(spark.createDataFrame([(1, 1, 3.0, 5.0), (2, 2, 12.0, 5.0)], kind), shards, [], 48, 32).collect()
    assert sorted(map(tuple, good)) == [(1, 1, 3.0, 5.0), (2, 2, 28.0, 5.0)]
    with pytest.raises(Exception, match=why):
        raster.core_cells(spark.createDataFrame(cells, kind), shards, [], 48, 32).collect()


def test_procrustes(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(0, 3, (60, 2))
    planes = {1: x @ np.array([[0.6, 0.8], [-0.8, 0.6]]) * 4 + 7, 2: x @ np.array([[0.6, 0.8], [0.8, -0.6]]), 3: x + rng.normal(0, 2, x.shape), 4: np.stack((x[:, 0], np.full(60, 5.0)), axis=1)}
    rows = [(k, *map(float, (*p, *q))) for k, u in planes.items() for p, q in zip(x, u, strict=True)] + [(5, 1.0, 1.0, 1.0, 1.0)]
    got = {r.k: r for r in evidence.procrustes(spark.createDataFrame(rows, "k int, x double, y double, u double, v double"), ["k"]).collect()}

    def standard(m):
        sd = m.std(0, ddof=1)
        return np.divide(m - m.mean(0), sd, out=np.zeros_like(m), where=sd > 0)

    for k, u in planes.items():
        a, b = standard(x), standard(u)
        left, _, right = np.linalg.svd(b.T @ a)
        turned = b @ left @ right
        assert got[k].rmse == pytest.approx(np.sqrt(((a - turned) ** 2).mean()), abs=1e-7)
        assert got[k].correlation == pytest.approx(np.corrcoef(a.ravel(), turned.ravel())[0, 1], abs=1e-7)
    assert got[5].correlation is None and got[5].rmse is None

"""Masks as words of 64 pixels, against plain sets."""

import functools
import random

import pytest

from tesserae.operators import raster
from tesserae.plans import quality, spatial

MASK = "s int, y int, x int"


def frame(spark, masks):
    # Every other pixel comes twice: a mask is a set.
    return spark.createDataFrame([(s, y, x) for s, m in masks.items() for y, x in sorted(m) for _ in range(1 + (y + x) % 2)], MASK)


def drawn(seed, height, width, holes):
    draw = random.Random(seed)
    every = [(y, x) for y in range(height) for x in range(width)]
    return set(every) - set(draw.sample(every, holes))


@functools.cache
def disc(radius):
    return [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if dy * dy + dx * dx <= radius * radius]


def grow(mask, radius, height=10**6, width=10**6, least=0):
    return {(y + dy, x + dx) for y, x in mask for dy, dx in disc(radius) if least <= y + dy < height and least <= x + dx < width}


def shrink(mask, radius):
    return {(y, x) for y, x in mask if all((y + dy, x + dx) in mask for dy, dx in disc(radius))}


def got(df):
    rows = [tuple(r) for r in df.select("s", "y", "x").collect()]
    assert len(rows) == len(set(rows))
    return {s: {(y, x) for t, y, x in rows if t == s} for s in {r[0] for r in rows}}


@pytest.mark.parametrize("radius", [0, 1, 3, 65])
def test_masks_grow_and_shrink(spark, radius):
    masks = {1: drawn(1, 20, 150, 40), 2: drawn(2, 150, 140, 1), 3: {(0, 63), (0, 64)}}
    df = frame(spark, masks).persist()

    def want(f):
        return {s: m for s, m in ((s, f(m)) for s, m in masks.items()) if m}

    assert got(raster.dilated(df, ["s"], radius, 150, 145)) == want(lambda m: grow(m, radius, 150, 145) if radius < 9 else grow(shell(m), radius, 150, 145) | grow(m, 0, 150, 145))
    assert got(raster.eroded(df, ["s"], radius)) == want(lambda m: shrink(m, radius))
    if radius < 9:
        assert got(raster.opened(df, ["s"], radius, 150, 145)) == want(lambda m: grow(shrink(m, radius), radius, 150, 145))
        assert got(raster.closed(df, ["s"], radius, 150, 145)) == want(lambda m: shrink(grow(m, radius, 150, 145), radius))
        assert got(raster.boundary(df, ["s"])) == want(lambda m: m - shrink(m, 1))


def shell(mask):
    return mask - shrink(mask, 1)


def test_places_below_zero_are_pixels_too(spark):
    mask = {(y, x) for y in range(-3, 4) for x in range(-70, 5)}
    assert got(raster.eroded(frame(spark, {1: mask}), ["s"], 2)) == {1: shrink(mask, 2)}


def test_masks_meet_as_words(spark, sf_dir):
    # What a task holds while it sums up is a word for each row of a sample, not thirteen rows a pixel.
    full = spark.range(64 * 64).selectExpr("1 AS s", "id div 64 AS y", "id % 64 AS x")
    assert raster._words(full, ["s"]).count() == 64
    for query in (spatial.eroded_mask, quality.closed_mask):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert plan.rindex("bit_or(") > plan.rindex("Exchange")  # the plan's lowest exchange is of words


def flooded(cells):
    """{pixel: the first pixel of its part}, and parts by their first pixel."""
    left, parts = set(cells), {}
    for first in sorted(cells):
        if first in left:
            left.discard(first)
            todo, part = [first], set()
            while todo:
                y, x = todo.pop()
                part.add((y, x))
                near = {(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)} & left
                left -= near
                todo += near
            parts[first] = part
    return parts


def canvas(mask):
    ys, xs = [y for y, _ in mask], [x for _, x in mask]
    box = {(y, x) for y in range(min(ys), max(ys) + 1) for x in range(min(xs), max(xs) + 1)}
    rim = {(y, x) for y, x in box if y in (min(ys), max(ys)) or x in (min(xs), max(xs))}
    return box - set(mask), rim


WIDTH = 200
SNAKE = {(y, x) for y in range(140) for x in range(199) if y % 2 == 0 or x == (198 if y % 4 == 1 else 0)}
SHAPES = {1: drawn(5, 150, WIDTH, 11_000), 2: SNAKE, 3: {(5, 63)}, 4: {(5, 63), (5, 64), (63, 7), (64, 7), (64, 8)}, 5: drawn(6, 64, 64, 1_500)}


@pytest.mark.parametrize("batch", [10_000, 7])
def test_parts_and_holes_of_masks_over_tiles(spark, batch):
    shapes = SHAPES if batch > 7 else {s: SHAPES[s] for s in (3, 4, 5)}
    df = frame(spark, shapes).persist()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = {(r.s, r.y, r.x): (r.component, r.n, r.largest) for r in raster.sized_components(df, ["s"], WIDTH).collect()}
        sizes = {tuple(r) for r in raster.component_sizes(df, ["s"], WIDTH).collect()} if batch == 7 else None
        found = got(raster.holes(df, ["s"], WIDTH))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, want_sizes, want_holes = {}, set(), {}
    for s, mask in shapes.items():
        parts = flooded(mask)
        best = min(parts, key=lambda f: (-len(parts[f]), f))
        for first, part in parts.items():
            told = (first[0] * WIDTH + first[1], len(part), first == best)
            want_sizes.add((s, *told))
            want |= {(s, y, x): told for y, x in part}
        outside, rim = canvas(mask)
        shut = set().union(*(p for p in flooded(outside).values() if not p & rim))
        if shut:
            want_holes[s] = shut
    assert rows == want and sizes in (None, want_sizes) and found == want_holes


def test_parts_within_a_tile_need_no_rounds(spark, monkeypatch):
    linked, plain = [], raster.components
    monkeypatch.setattr(raster, "components", lambda edges, keys=(): linked.append(edges.count()) or plain(edges, keys))
    raster.sized_components(frame(spark, {5: SHAPES[5]}), ["s"], 64).count()
    assert linked == [0]

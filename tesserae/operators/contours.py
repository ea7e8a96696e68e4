"""Contours of masks: pixel sides to rings, holes to their polygons, and polygons dissolved by value.

A pixel at (y, x) is the square from corner (x, y) to (x + 1, y + 1). Its sides run around it with the
pixel on the right (y grows downwards), numbered 0 east, 1 south, 2 west, 3 north. Sides between two
pixels of one label cancel; the others are linked at their corners within tiles of 64 x 64 pixels, which
stream through the tasks. A ring that lies in one tile is done there; of others, a tile keeps pieces that
are ranked along their rings by pointer doubling, so that a ring of any length spreads over all tasks
until it becomes a value.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .geometry import area as area_of
from .graph import cycles, followed, stored
from .joins import latest

#: Corners have coordinates from 0 to this, exclusive.
FAR = 1 << 30


#: A tile's pixels with those around it, and so many tiles at a time.
WIDE, TILES = 66, 64
#: What lies across a pixel's side and what ahead of it, and the corner a side starts from; the next direction's is where it ends.
ACROSS, AHEAD = np.array([-WIDE, 1, WIDE, -1]), np.array([1, WIDE, -1, -WIDE])
START_Y, START_X = np.array([0, 0, 1, 1]), np.array([0, 1, 1, 0])


def _tiled(raster: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, label, _ty, _tx, _row, _side, _w, _first): pixels of a label as words of 64 bits, by the tile of 64 x 64 that they lie in.

    A tile also has the rows above and below it, -1 and 64, and the words left and right, _side -1 and 1, that
    touch it. Label 0 and null are background; repeated pixels count once.
    """
    held = raster.where("label <> 0").dropna(subset=[*keys, "y", "x"]).withColumns({"_y": F.col("y").cast("long"), "_x": F.col("x").cast("long")})
    bit = F.expr("shiftleft(1L, CAST(_x & 63 AS INT))")
    words = held.groupBy(*keys, "label", "_y", F.shiftright("_x", 6).alias("_wx")).agg(F.bit_or(bit).alias("_w"))
    touched = {(0, 0): "true", (-1, 0): "_y & 63 = 0 AND _y > 0", (1, 0): "_y & 63 = 63", (0, -1): "_w & 1 = 1 AND _wx > 0", (0, 1): "_w < 0"}
    touched |= {(v, h): f"{touched[v, 0]} AND {touched[0, h]}" for v in (-1, 1) for h in (-1, 1)}
    tiles = F.array_compact(F.array(*(F.when(F.expr(test), F.struct(F.lit(v).alias("v"), F.lit(h).alias("h"))) for (v, h), test in touched.items())))
    ty = F.shiftright("_y", 6) + F.col("_s.v")
    rows = words.withColumn("_s", F.explode(tiles)).select(*keys, "label", ty.alias("_ty"), (F.col("_wx") + F.col("_s.h")).alias("_tx"), (F.col("_y") - ty * 64).alias("_row"), (-F.col("_s.h")).alias("_side"), "_w")
    tile = Window.partitionBy(*keys, "label", "_ty", "_tx").orderBy("_row", "_side")
    return rows.withColumn("_first", F.row_number().over(tile) == 1)


def _chained(after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, off, open) of links to the next, -1 where there is none: the first of each path, or the smallest of each cycle, how many steps lead from it, and whether it has none before it.

    Pointers back are doubled; what has been around its cycle, or meets one that has, leaves.
    """
    n = len(after)
    every = np.arange(n)
    linked = after >= 0
    jump, head = every.copy(), np.ones(n, bool)
    jump[after[linked]], head[after[linked]] = every[linked], False
    low, off, done = np.where(head, every, every + n), np.zeros(n, np.int64), np.zeros(n, bool)
    left, step = every, 1
    while len(left):
        there, own = jump[left], low[left]
        far = low[there]
        around = (far == own) | done[there]
        new = np.where(far < own, far, own), np.where(far < own, off[there] + step, off[left]), jump[there]
        low[left], off[left], jump[left] = new
        done[left[around]] = True
        left, step = left[~around], step * 2
    return low % n if n else low, off, head


def _traced(tile: np.ndarray, row: np.ndarray, side: np.ndarray, words: np.ndarray, ty: np.ndarray, tx: np.ndarray, eight: bool) -> dict:
    """Columns, a value for each ring of these tiles and each piece of a ring that leaves its tile: what _pieces() returns, `tile` and the numbers of points and gates."""
    held = np.zeros((len(ty), WIDE, WIDE), np.uint8)
    bits = np.unpackbits(words.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    for s, to, of in ((0, slice(1, WIDE - 1), slice(0, 64)), (-1, slice(0, 1), slice(63, 64)), (1, slice(WIDE - 1, WIDE), slice(0, 1))):
        at = side == s
        held[tile[at], row[at] + 1, to] = bits[at, of]
    inner = np.zeros_like(held)
    inner[:, 1:-1, 1:-1] = held[:, 1:-1, 1:-1]
    flat, inside = held.ravel(), inner.ravel()

    # Sides, and the side after each: of the pixel ahead to the left, of the one ahead, or of the same.
    p = np.flatnonzero(inside)
    at, d = np.nonzero(flat[p[:, None] + ACROSS] == 0)
    p = p[at]
    ahead, corner = flat[p + AHEAD[d]] > 0, flat[p + AHEAD[d] + ACROSS[d]] > 0
    if not eight:
        corner &= ahead
    turn = np.where(corner, 3, np.where(ahead, 0, 1))
    owner, way = p + np.where(turn == 1, 0, AHEAD[d] + np.where(turn == 3, ACROSS[d], 0)), (d + turn) % 4
    n = len(p)
    number = np.full(4 * len(flat), -1, np.int64)
    number[4 * p + d] = np.arange(n)
    after = np.where(inside[owner] > 0, number[4 * owner + way], -1)

    def ids(p: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t, place = np.divmod(p, WIDE * WIDE)
        y, x = ty[t] * 64 + place // WIDE - 1 + START_Y[d], tx[t] * 64 + place % WIDE - 1 + START_X[d]
        return (y * FAR + x) * 4 + d, y, x

    first, off, head = _chained(after)
    counts = np.bincount(first, minlength=n)
    tops = np.flatnonzero(counts)
    chain, length = (np.cumsum(counts > 0) - 1)[first], counts[tops]
    starts = np.cumsum(length) - length
    open_ = head[tops]
    id_, y, x = ids(p, d)
    order = np.empty(n, np.int64)
    order[starts[chain] + off] = np.arange(n)
    least = np.minimum.reduceat(id_[order], starts) if n else id_
    least_at = np.flatnonzero(id_ == least[chain])
    least_at = least_at[np.argsort(chain[least_at])]
    lead = off[least_at]
    off = np.where(open_[chain], off, (off - lead[chain]) % length[chain])  # a ring begins with its smallest side
    order[starts[chain] + off] = np.arange(n)
    _, end_y, end_x = ids(p, (d + 1) % 4)
    turns = (turn != 0)[order]
    passed = np.concatenate(([0], np.cumsum(turns)))
    last = order[starts + length - 1]
    twice = np.add.reduceat((x * end_y - end_x * y)[order], starts) if n else y

    # West of a hole's first corner lies its region; the first pixel of that run has a side north, of the region's outer ring or another hole.
    gap = np.maximum.accumulate(np.where(held == 0, np.arange(WIDE), -1), axis=2).ravel()
    hole = least % 4 == 1
    west = p[least_at]
    run = west - west % WIDE + gap[west] + 1
    parent = np.where(hole & (gap[west] >= 0), chain[number[np.where(hole & (gap[west] >= 0), 4 * run + 3, 4 * p[tops] + d[tops])]] if n else 0, -1)
    top = np.arange(len(tops))
    while True:
        up = np.where(hole[top] & ~open_[top] & (parent[top] >= 0), parent[top], top)
        if (up == top).all():
            break
        top = up
    top = np.where(open_ & (parent >= 0), top[parent], top)
    found = ~hole[top] & ~open_[top] & ((top != np.arange(len(tops))) | ~open_)
    via = open_[top] & (top != np.arange(len(tops)))
    asks = ~found & ~via & hole
    asked_row, asked_at = y[least_at[top]], tx[p[least_at[top]] // (WIDE * WIDE)] * 64 - 1

    # Runs that leave the tile on its right tell those there whose they are.
    edge = np.flatnonzero((held[:, 1:-1, -2] > 0) & (held[:, 1:-1, -1] > 0))
    edge = edge // 64 * WIDE * WIDE + (edge % 64 + 1) * WIDE + WIDE - 2
    edge = edge[gap[edge] >= 0]
    begin = edge - edge % WIDE + gap[edge] + 1
    gate = number[4 * begin + 3]
    gate = gate[np.argsort(chain[gate], kind="stable")]
    name = np.where(open_, id_[tops], least)
    return {
        "tile": p[tops] // (WIDE * WIDE),
        "ring": least,
        "open": open_,
        "first": name,
        "next": ids(owner[last], way[last])[0],
        "sides": length,
        "twice": twice,
        "before": np.where(open_, passed[starts + lead] - passed[starts], 0),
        "inside": np.bincount(top[found & hole & ~open_], minlength=len(tops)),
        "polygon": (least[top], found),
        "via": (name[top], via),
        "row": (asked_row, asks),
        "at": (asked_at, asks),
        "points": passed[starts + length] - passed[starts],
        "x": end_x[order][turns].astype(np.float64),
        "y": end_y[order][turns].astype(np.float64),
        "gates": np.bincount(chain[gate], minlength=len(tops)),
        "gate_row": y[gate] - 1,
        "gate_at": x[gate],
    }


def _pieces(raster: DataFrame, keys: Sequence[str], eight: bool) -> DataFrame:
    """(keys, label, ring, open, first, next, sides, twice, before, inside, polygon, via, row, at, points, gates): rings that lie in one tile, and pieces of others.

    ring is the smallest side's number, y * FAR + x of the corner it starts from, times 4, and its direction; points are the corners
    where a ring turns, from that side on. An open piece begins with side `first`, goes on in `next`, and turns `before` times
    before its smallest side. twice is twice the area, below zero for holes, and inside the number of a polygon's holes. A hole lies in the polygon of outer ring `polygon`, or in that of
    the piece `via`, or in that of the last gate up to `at` in a row: gates are where runs of pixels begin that leave the tile on its right.
    """
    rows = _tiled(raster, keys)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    longs = ("ring", "first", "next", "sides", "twice", "before", "inside")
    maybe = ("polygon", "via", "row", "at")

    def found(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, side, words, ty, tx, new = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_row", "_side", "_w", "_ty", "_tx", "_first"))
        begins = np.append(np.flatnonzero(new), len(new))
        for lo in range(0, len(begins) - 1, TILES):
            some = begins[lo : lo + TILES + 1]
            a, b = some[0], some[-1]
            tile = np.cumsum(new[a:b]) - 1
            got = _traced(tile, row[a:b], side[a:b], words[a:b], ty[some[:-1]], tx[some[:-1]], eight)

            def listed(count: str, **columns: str) -> pa.Array:
                ends = np.concatenate(([0], np.cumsum(got[count]))).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(got[c]) for c in columns.values()], names=list(columns)))

            own = batch.select([*keys, "label"]).take(pa.array(some[:-1][got["tile"]]))
            columns = [*own.columns, *(pa.array(got[c].astype(np.int64)) for c in longs), pa.array(got["open"])]
            columns += [pa.array(got[c][0].astype(np.int64), mask=~got[c][1]) for c in maybe]
            columns += [listed("points", x="x", y="y"), listed("gates", row="gate_row", at="gate_at")]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "label", *longs, "open", *maybe, "points", "gates"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in (b.slice(lo, 1 << 12) for b in batches for lo in range(0, b.num_rows, 1 << 12)):
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            cut = int(np.flatnonzero(batch.column("_first").to_numpy(zero_copy_only=False))[-1])  # the last tile may go on in the next batch
            if cut:
                yield from found(batch.slice(0, cut))
            held = batch.slice(cut)
        if held is not None and held.num_rows:
            yield from found(held)

    schema = "".join(f"`{k}` {kinds[k]}, " for k in [*keys, "label"]) + ", ".join(f"`{c}` long" for c in longs) + ", open boolean, " + ", ".join(f"`{c}` long" for c in maybe)
    schema += ", points array<struct<x: double, y: double>>, gates array<struct<row: long, at: long>>"
    return rows.mapInArrow(run, schema)


def _joined(open_: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rings of open pieces, as _pieces() has rings, with `pieces`, the first sides of their pieces."""
    found = cycles(open_.select(*on, F.col("first").alias("id"), "next"), on).withColumnsRenamed({"id": "first", "ring": "_cycle"})
    met = open_.join(found.hint("merge"), [*on, "first"])
    each = F.array_sort(F.collect_list(F.struct((-F.col("off")).alias("place"), "ring", "before", "points")))
    lies = F.struct("polygon", "via", "row", "at")
    rings = met.groupBy(*on, "_cycle").agg(F.min("ring").alias("ring"), F.sum("sides").alias("sides"), F.sum("twice").alias("twice"), F.min_by(lies, "ring").alias("_lies"), F.collect_list("first").alias("pieces"), each.alias("_each"))
    # Corners begin at the smallest side, wherever the pieces begin.
    at = F.array_position(F.transform("_each", lambda e: e["ring"]), F.col("ring")).cast("int")
    skipped = F.aggregate(F.slice("_each", F.lit(1), at - 1), F.lit(0), lambda n, e: n + F.size(e["points"])) + F.get("_each", at - 1)["before"].cast("int")
    rings = rings.withColumn("_all", F.flatten(F.transform("_each", lambda e: e["points"]))).withColumn("_skip", skipped)
    points = F.concat(F.slice("_all", F.col("_skip") + 1, F.size("_all")), F.slice("_all", F.lit(1), F.col("_skip")))
    return rings.select(*on, "ring", "sides", "twice", "_lies.*", "pieces", points.alias("points"))


def contours(raster: DataFrame, keys: Sequence[str], eight: bool = True) -> DataFrame:
    """(keys, label, ring, hole, area, sides, points): the rings around all regions of a raster and around their holes.

    points: the corners (structs of x and y) at which the ring turns. Outer rings have areas above zero,
    holes below. An empty raster has none. Where two pixels of a label touch at a corner only, `eight` joins
    them into one ring; otherwise each keeps to its own.
    """
    on = [*keys, "label"]
    columns = [*on, "ring", "sides", "twice", "points"]
    found = stored(_pieces(raster, keys, eight).select(*columns, "open", "first", "next", "before", "polygon", "via", "row", "at"))
    rings, open_ = found.where("NOT open").select(*columns), found.where("open")
    if not open_.isEmpty():
        rings = rings.unionByName(_joined(open_, on).select(*columns))
    return rings.select(*on, "ring", (F.col("twice") < 0).alias("hole"), (F.col("twice") / 2).alias("area"), "sides", "points")


def polygons(raster: DataFrame, keys: Sequence[str], eight: bool = True) -> DataFrame:
    """(keys, label, polygon, ring, holes, area): the regions of a raster, each with the holes in it; polygon is its outer ring's number.

    West of a hole's first corner, in scan order, lies its own region, and the last upright side before
    it is of the region's outer ring or of another of its holes. Mostly it lies in the same tile; for other holes one
    as-of join finds the tile where the region's run of pixels begins, and chains of holes are followed to their ends.
    """
    on = [*keys, "label"]
    found = stored(_pieces(raster, keys, eight))
    columns = [*on, "ring", "twice", "points", "polygon", "via", "row", "at"]
    # What a ring of one tile holds lies in that tile, so those without holes are done.
    whole = "NOT open AND ring = polygon AND inside = 0"
    rings, open_ = found.where("NOT open").where(f"NOT ({whole}) OR polygon IS NULL").select(*columns), found.where("open")
    if not (open_.isEmpty() and found.where("polygon IS NULL").isEmpty()):
        joined = stored(_joined(open_, on))
        rings = stored(rings.unionByName(joined.select(*columns)))
        ring_of = stored(joined.select(*on, F.explode("pieces").alias("first"), "ring"))
        gates = found.select(*on, "open", F.col("first").alias("near"), F.explode("gates").alias("g")).select(*on, F.col("g.row").alias("row"), F.col("g.at").alias("at"), "near")
        asked = latest(rings.where("twice < 0 AND at IS NOT NULL").select(*on, "row", "at", "ring"), gates, [*on, "row"], "at", ["near"]).select(*on, "ring", F.col("near").alias("up"))
        told = rings.where("twice < 0 AND at IS NULL").select(*on, "ring", F.coalesce("polygon", "via").alias("up"))
        # Pieces go by their first sides, rings by their smallest.
        up = told.unionByName(asked).join(ring_of.withColumnsRenamed({"first": "up", "ring": "_of"}).hint("merge"), [*on, "up"], "left")
        parent = followed(up.select(*on, F.col("ring").alias("id"), F.coalesce("_of", "up").alias("parent")), on)
        rings = rings.drop("polygon").join(parent.select(*on, F.col("id").alias("ring"), F.col("top").alias("polygon")).hint("merge"), [*on, "ring"], "left")
        rings = rings.withColumn("polygon", F.coalesce("polygon", "ring"))
    shape = F.struct((F.col("twice") < 0).alias("hole"), "ring", "points")
    none = F.array().cast("array<" + found.schema["points"].dataType.simpleString() + ">")
    alone = found.where(whole).select(*on, "polygon", F.col("points").alias("ring"), none.alias("holes"), (F.col("twice") / 2).alias("area"))
    met = rings.groupBy(*on, "polygon").agg(F.array_sort(F.collect_list(shape)).alias("_r"), (F.sum("twice") / 2).alias("area"))  # the outer ring comes first
    return alone.unionByName(met.select(*on, "polygon", F.get("_r", F.lit(0))["points"].alias("ring"), F.transform(F.slice("_r", F.lit(2), F.size("_r")), lambda h: h["points"]).alias("holes"), "area"))


def dissolved(raster: DataFrame, keys: Sequence[str], values: DataFrame, eight: bool = True) -> DataFrame:
    """polygons() of a raster whose labels are replaced by their values in (label, value): regions of one value become one.

    Labels without a value are background. Sides that two labels of one value share run opposite ways and cancel.
    """
    named = raster.join(values.select("label", "value"), "label").drop("label").withColumnRenamed("value", "label")
    return polygons(named, keys, eight).withColumnRenamed("label", "value")


def thinned_ring(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """The corners of a ring that are left when those of the smallest effective area, under `least`, go one by one.

    A corner's effective area is that of the triangle with its neighbours of the moment, and no less than
    that of any corner that went before it; a heap yields the smallest, ties to the first corner, and
    entries that have become stale are passed over. Three corners stay.
    """
    n = len(x)
    before, after = np.roll(np.arange(n), 1).tolist(), np.roll(np.arange(n), -1).tolist()
    x, y = x.tolist(), y.tolist()

    def area(i: int) -> float:
        a, b = before[i], after[i]
        return abs((x[i] - x[a]) * (y[b] - y[a]) - (x[b] - x[a]) * (y[i] - y[a])) / 2

    now = [area(i) for i in range(n)]
    heap = [(v, i) for i, v in enumerate(now)]
    heapq.heapify(heap)
    kept, left, floor = [True] * n, n, 0.0
    while left > 3 and heap:
        v, i = heapq.heappop(heap)
        if not kept[i] or v != now[i]:
            continue
        if v >= least:
            break
        kept[i], left, floor = False, left - 1, max(floor, v)
        a, b = before[i], after[i]
        after[a], before[b] = b, a
        for j in (a, b):
            now[j] = max(floor, area(j))
            heapq.heappush(heap, (now[j], j))
    return np.flatnonzero(kept)


def near_ring(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """The corners of a ring that are left when no corner that goes lies over `tolerance` from the line that replaces it.

    The ring is cut at its first corner and the one furthest from it, and each part again at its
    furthest corner, until all lie near enough; a stack holds the parts still open. Three corners stay.
    """
    n = len(x)
    if n <= 3:
        return np.arange(n)
    far = int(np.argmax((x - x[0]) ** 2 + (y - y[0]) ** 2))
    x, y = np.append(x, x[0]), np.append(y, y[0])
    kept = np.zeros(n + 1, bool)
    kept[[0, far, n]] = True
    parts = [(0, far), (far, n)]

    def distances(a: int, b: int) -> np.ndarray:
        dx, dy, px, py = x[b] - x[a], y[b] - y[a], x[a + 1 : b] - x[a], y[a + 1 : b] - y[a]
        length = dx * dx + dy * dy
        t = np.clip((px * dx + py * dy) / length, 0, 1) if length else np.zeros(len(px))
        return np.hypot(px - t * dx, py - t * dy)

    while parts:
        a, b = parts.pop()
        if b - a > 1:
            d = distances(a, b)
            i = int(np.argmax(d))
            if d[i] > tolerance:
                kept[a + 1 + i] = True
                parts += [(a, a + 1 + i), (a + 1 + i, b)]
    kept[n] = False
    if kept.sum() < 3:
        parts = [(a, b) for a, b in ((0, far), (far, n)) if b - a > 1]
        best = max(((float(d.max()), a + 1 + int(np.argmax(d))) for a, b in parts for d in [distances(a, b)]), default=(0.0, 0))
        kept[best[1]] = True
    return np.flatnonzero(kept)


def simplified(df: DataFrame, ring: str, area: float = 0.0, tolerance: float = 0.0) -> DataFrame:
    """`df` with the corners of its rings thinned: those of little effective area go, then those near the lines between the others.

    Work on a ring is a heap's or a stack's, so a row's ring bounds memory. Null and short rings stay as they are.
    """

    @F.pandas_udf("array<int>")
    def kept(xs: pd.Series, ys: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(xs, ys, strict=True):
            at = np.arange(0 if x is None else len(x))
            for chosen, bound in ((thinned_ring, area), (near_ring, tolerance)):
                if bound > 0 and len(at) > 3:
                    at = at[chosen(np.asarray(x, float)[at], np.asarray(y, float)[at], bound)]
            out.append(at.astype(np.int32))
        return pd.Series(out, dtype=object)

    places = kept(F.transform(ring, lambda p: p["x"].cast("double")), F.transform(ring, lambda p: p["y"].cast("double")))
    return df.withColumn("_at", places).withColumn(ring, F.when(F.col(ring).isNotNull(), F.transform("_at", lambda i: F.get(F.col(ring), i)))).drop("_at")


def cleaned(polygons_: DataFrame, least: float = 0.0, fill: bool = False) -> DataFrame:
    """polygons() of `least` area or more; with `fill` without their holes, whose area then counts."""
    if fill:
        none = F.array().cast(polygons_.schema["holes"].dataType)
        polygons_ = polygons_.withColumn("area", F.col("area") + F.aggregate("holes", F.lit(0.0), lambda s, h: s + area_of(h))).withColumn("holes", none)
    return polygons_.where(F.col("area") >= least)

"""Rasters as pixel tables: tiling, remapping, blending, growing and joining."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins
from .graph import components, stored


def lattice(samples: DataFrame, keys: Sequence[str], width: int, height: int, stride: int) -> DataFrame:
    """(keys, label, grid_row, grid_col, x0, y0, x1, y1): cores side by side, the last ones cut at the edge."""
    out = samples.select(*keys).distinct()
    out = out.withColumn("y0", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(height - 1).cast("long"), F.lit(stride).cast("long"))))
    out = out.withColumn("x0", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long"), F.lit(stride).cast("long"))))
    columns = -(-width // stride)
    row, col = F.expr(f"y0 div {stride}"), F.expr(f"x0 div {stride}")
    return out.select(
        *keys, (row * columns + col + 1).alias("label"), row.alias("grid_row"), col.alias("grid_col"), "x0", "y0", F.least(F.col("x0") + stride, F.lit(width)).alias("x1"), F.least(F.col("y0") + stride, F.lit(height)).alias("y1")
    )


def centred_axis(length: int, stride: int) -> tuple[int, int]:
    """(first centre, number) of adjacent cores whose centres lie within an axis and that cover all of it."""
    if length <= 0 or stride <= 0:
        raise ValueError("an axis and its stride are above zero")
    n = max(1, -(-length // stride))
    first = -(-(length - (n - 1) * stride) // 2)
    first -= max(0, first + (n - 1) * stride - (length - 1))
    first = max(0, first)
    if first - stride // 2 > 0 or first + (n - 1) * stride - stride // 2 + stride < length:
        raise ValueError("cores with centres within the axis don't cover it")
    return first, n


def centred_lattice(samples: DataFrame, keys: Sequence[str], width: int, height: int, stride: int) -> DataFrame:
    """(keys, label, grid_row, grid_col, cx, cy, x0, y0, x1, y1): cores of one size with centres in the image; the outer ones reach beyond its edge."""
    (left, columns), (top, rows) = centred_axis(width, stride), centred_axis(height, stride)
    out = samples.select(*keys).distinct()
    out = out.withColumn("grid_row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).withColumn("grid_col", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    cx, cy = F.lit(left) + F.col("grid_col") * stride, F.lit(top) + F.col("grid_row") * stride
    half = stride // 2
    return out.select(
        *keys, (F.col("grid_row") * columns + F.col("grid_col") + 1).alias("label"), "grid_row", "grid_col", cx.alias("cx"), cy.alias("cy"), (cx - half).alias("x0"), (cy - half).alias("y0"), (cx - half + stride).alias("x1"), (cy - half + stride).alias("y1")
    )


def core_cells(cells: DataFrame, shards: DataFrame, keys: Sequence[str], width: float, height: float) -> DataFrame:
    """(keys, shard, id, x, y): cells of shards (keys, shard, id, x, y in the shard's window) moved to their places in the image.

    shards: (keys, shard, hx0, hy0, hx1, hy1, x0, y0, x1, y1), windows and cores. A cell outside its window, in the halo
    around its core, outside the image, or without a known shard is an error, and so is an id that repeats within keys.
    """
    keys = list(keys)
    once = F.count(F.lit(1)).over(Window.partitionBy(*keys, "id"))
    met = cells.select(*keys, "shard", "id", F.col("x").alias("_lx"), F.col("y").alias("_ly"), once.alias("_n")).join(shards, [*keys, "shard"], "left")
    x, y = F.col("hx0") + F.col("_lx"), F.col("hy0") + F.col("_ly")
    window = (F.col("_lx") >= 0) & (F.col("_ly") >= 0) & (F.col("_lx") < F.col("hx1") - F.col("hx0")) & (F.col("_ly") < F.col("hy1") - F.col("hy0"))
    core = (x >= F.col("x0")) & (x < F.col("x1")) & (y >= F.col("y0")) & (y < F.col("y1"))
    rules = [(F.col("hx0").isNotNull(), "an unknown shard"), (F.coalesce(window, F.lit(False)), "a cell outside its window"), (core, "a halo cell outside its core"), ((x >= 0) & (y >= 0) & (x < width) & (y < height), "a cell outside the image"), (F.col("_n") == 1, "an id repeats")]
    why = F.coalesce(*(F.when(~rule, F.lit(text)) for rule, text in rules))
    return met.where(F.when(why.isNull(), True).otherwise(F.raise_error(why).cast("boolean"))).select(*keys, "shard", "id", x.alias("x"), y.alias("y"))


def with_halo(cores: DataFrame, halo: int, width: int, height: int) -> DataFrame:
    """Cores with the window that a halo adds, clipped to the image."""
    return cores.select(
        "*",
        F.greatest(F.col("x0") - halo, F.lit(0)).alias("hx0"),
        F.greatest(F.col("y0") - halo, F.lit(0)).alias("hy0"),
        F.least(F.col("x1") + halo, F.lit(width)).alias("hx1"),
        F.least(F.col("y1") + halo, F.lit(height)).alias("hy1"),
    )


def remapped(raster: DataFrame, table: DataFrame) -> DataFrame:
    """Labels by a look-up table (label, to); labels without an entry become 0."""
    return raster.join(table, "label", "left").withColumn("label", F.coalesce("to", F.lit(0))).drop("to")


def blended(patches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Weighted means of overlapping patches' predictions (y, x, channel, p, w), and each pixel's best channel.

    Ties go to the lowest channel.
    """
    mean = patches.groupBy(*keys, "y", "x", "channel").agg((F.sum(F.col("w") * F.col("p")) / F.sum("w")).alias("p"))
    return mean.groupBy(*keys, "y", "x").agg(F.max("p").alias("p"), F.max_by("channel", F.struct("p", -F.col("channel"))).alias("channel"))


def downsampled_mode(raster: DataFrame, keys: Sequence[str], factor: int) -> DataFrame:
    """The most frequent label of each block, zeros left out; ties to the lowest label."""
    counts = raster.where("label <> 0").groupBy(*keys, F.expr(f"y div {factor}").alias("by"), F.expr(f"x div {factor}").alias("bx"), "label").agg(F.count("*").alias("n"))
    return counts.groupBy(*keys, "by", "bx").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("label"), F.sum("n").alias("n"))


def downsampled_any(raster: DataFrame, keys: Sequence[str], factor: int) -> DataFrame:
    """Blocks with any labelled pixel."""
    return raster.where("label <> 0").select(*keys, F.expr(f"y div {factor}").alias("by"), F.expr(f"x div {factor}").alias("bx")).distinct()


def strided(raster: DataFrame, factor: int) -> DataFrame:
    """Every factor-th pixel of every factor-th row."""
    return raster.where((F.col("y") % factor == 0) & (F.col("x") % factor == 0)).withColumn("y", F.expr(f"y div {factor}")).withColumn("x", F.expr(f"x div {factor}"))


def _offsets(radius: int) -> Column:
    near = [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if dy * dy + dx * dx <= radius * radius]
    return F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(dy * dy + dx * dx).alias("d2")) for dy, dx in near))


def expanded(raster: DataFrame, keys: Sequence[str], radius: int, height: int, width: int) -> DataFrame:
    """Labels grown to all pixels within `radius`: the nearest label, ties to the lowest.

    Each pixel is sent to the disc around it and summed up per target before the shuffle.
    """
    spread = raster.where("label <> 0").select(*keys, "y", "x", "label", F.explode(_offsets(radius)).alias("_o"))
    spread = spread.select(*keys, (F.col("y") + F.col("_o.dy")).alias("y"), (F.col("x") + F.col("_o.dx")).alias("x"), "label", "_o.d2")
    inside = spread.where((F.col("y") >= 0) & (F.col("y") < height) & (F.col("x") >= 0) & (F.col("x") < width))
    return inside.groupBy(*keys, "y", "x").agg(F.min(F.struct("d2", "label")).alias("m")).select(*keys, "y", "x", "m.label", "m.d2")


def _words(mask: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, y, _wx, _w): a mask's pixels as words of 64 bits, bit i of word _wx being pixel 64 * _wx + i of its row."""
    bit = F.expr("shiftleft(1L, CAST(CAST(x AS BIGINT) & 63 AS INT))")
    held = mask.where("y IS NOT NULL AND x IS NOT NULL")
    return held.groupBy(*keys, "y", F.expr("shiftright(CAST(x AS BIGINT), 6)").alias("_wx")).agg(F.bit_or(bit).alias("_w"))


def _pixels(words: DataFrame, keys: Sequence[str], mask: DataFrame) -> DataFrame:
    """(keys, y, x): the pixels of words, with the types of the mask's places."""
    each = words.withColumn("_i", F.explode(F.array(*map(F.lit, range(64))))).where(F.getbit("_w", "_i") == 1)
    return each.select(*keys, *(place.cast(mask.schema[c].dataType).alias(c) for c, place in (("y", F.col("y")), ("x", F.col("_wx") * 64 + F.col("_i")))))


def _swept(words: DataFrame, keys: Sequence[str], radius: int, every: bool) -> DataFrame:
    """Words of the pixels whose disc holds any pixel of the words, or with `every` only such.

    A word meets the words beside it first, and is swept along its row as far as each row of the disc reaches; then rows meet.
    """
    reach = -(-radius // 64)
    steps = range(-reach, reach + 1)
    sent = words.withColumn("_k", F.explode(F.array(*map(F.lit, steps))))
    beside = sent.groupBy(*keys, "y", (F.col("_wx") - F.col("_k")).alias("_wx")).agg(*(F.coalesce(F.bit_or(F.when(F.col("_k") == k, F.col("_w"))), F.lit(0)).alias(f"_w{k + reach}") for k in steps))

    def shifted(d: int) -> Column:
        q, r = divmod(d, 64)
        here = F.col(f"_w{q + reach}")
        return F.shiftrightunsigned(here, r).bitwiseOR(F.shiftleft(F.col(f"_w{q + 1 + reach}"), 64 - r)) if r else here

    both = Column.bitwiseAND if every else Column.bitwiseOR
    moved = beside.select(*keys, "y", "_wx", F.array(shifted(0), *(both(shifted(d), shifted(-d)) for d in range(1, radius + 1))).alias("_s"))
    rows = [F.struct(F.lit(dy).alias("dy"), F.lit(math.isqrt(radius * radius - dy * dy) + 1).alias("n")) for dy in range(-radius, radius + 1)]
    bits = F.aggregate(F.slice("_s", 1, F.col("_o.n")), F.lit(-1 if every else 0).cast("long"), both)
    each = moved.withColumn("_o", F.explode(F.array(*rows))).withColumn("_w", bits).where("_w <> 0")
    met = each.groupBy(*keys, (F.col("y") - F.col("_o.dy")).alias("y"), "_wx").agg((F.bit_and if every else F.bit_or)("_w").alias("_w"), F.count("*").alias("_n"))
    return (met.where((F.col("_n") == len(rows)) & (F.col("_w") != 0)) if every else met).drop("_n")


def _clipped(words: DataFrame, height: int, width: int) -> DataFrame:
    """Words without what lies outside the image."""
    last = (1 << width % 64) - 1
    inside = words.where((F.col("y") >= 0) & (F.col("y") < height) & (F.col("_wx") >= 0) & (F.col("_wx") * 64 < width))
    return inside.withColumn("_w", F.when(F.col("_wx") == width // 64, F.col("_w").bitwiseAND(F.lit(last))).otherwise(F.col("_w")))


def dilated(mask: DataFrame, keys: Sequence[str], radius: int, height: int, width: int) -> DataFrame:
    """Pixels within `radius` of the mask."""
    return _pixels(_clipped(_swept(_words(mask, keys), keys, radius, False), height, width), keys, mask)


def eroded(mask: DataFrame, keys: Sequence[str], radius: int) -> DataFrame:
    """Mask pixels whose whole disc is in the mask; beyond the edge there is none."""
    return _pixels(_swept(_words(mask, keys), keys, radius, True), keys, mask)


def _edges(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Words of the pixels with one of their four neighbours outside."""
    both = words.withColumn("_in", F.lit(0).cast("long")).unionByName(_swept(words, keys, 1, True).select(*keys, "y", "_wx", F.lit(0).cast("long").alias("_w"), F.col("_w").alias("_in")))
    met = both.groupBy(*keys, "y", "_wx").agg(F.bit_or("_w").alias("_w"), F.bit_or("_in").alias("_in"))
    return met.select(*keys, "y", "_wx", F.col("_w").bitwiseAND(F.bitwise_not("_in")).alias("_w")).where("_w <> 0")


def boundary(mask: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mask pixels with one of their four neighbours outside."""
    return _pixels(_edges(_words(mask, keys), keys), keys, mask)


def boundary_f1(a: DataFrame, b: DataFrame, keys: Sequence[str], tolerance: int) -> DataFrame:
    """F1 of two masks' boundaries, a boundary pixel counting if the other boundary is within `tolerance`."""

    def side(own: DataFrame, other: DataFrame, name: str) -> DataFrame:
        near = _swept(other, keys, tolerance, False).withColumnRenamed("_w", "_near")
        met = own.join(near, [*keys, "y", "_wx"], "left")
        hits = F.bit_count(F.col("_w").bitwiseAND(F.coalesce("_near", F.lit(0))))
        return met.groupBy(*keys).agg((F.sum(hits) / F.sum(F.bit_count("_w"))).alias(name))

    ea, eb = (stored(_edges(_words(mask, keys), keys)) for mask in (a, b))
    both = side(ea, eb, "precision").join(side(eb, ea, "recall"), list(keys))
    p, r = F.col("precision"), F.col("recall")
    return both.withColumn("f1", F.when(p + r == 0, F.lit(0.0)).otherwise(F.try_divide(2 * p * r, p + r)))


def neighbour_edges(mask: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """(src, dst): pixels of a mask with their right and lower neighbours in it, as numbers y * width + x within their keys."""
    node = F.col("y").cast("long") * width + F.col("x")
    own = mask.select(*keys, node.alias("src"), "y", "x")
    steps = F.explode(F.array(F.struct(F.lit(0).alias("dy"), F.lit(1).alias("dx")), F.struct(F.lit(1).alias("dy"), F.lit(0).alias("dx"))))
    to = own.select(*keys, "src", "y", "x", steps.alias("_s")).where(F.col("x") + F.col("_s.dx") < width)
    to = to.withColumn("dst", (F.col("y") + F.col("_s.dy")) * width + F.col("x") + F.col("_s.dx"))
    return to.join(own.select(*keys, F.col("src").alias("dst")), [*keys, "dst"]).select(*keys, "src", "dst")


def changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pixels added, removed and relabelled between two rasters."""
    a, b = before.select(*keys, "y", "x", F.col("label").alias("a")), after.select(*keys, "y", "x", F.col("label").alias("b"))
    both = a.join(b, [*keys, "y", "x"], "full").fillna(0, ["a", "b"])
    return both.groupBy(*keys).agg(
        F.count_if(F.expr("a <> 0")).alias("raw"), F.count_if(F.expr("b <> 0")).alias("final"), F.count_if(F.expr("a = 0 AND b <> 0")).alias("added"), F.count_if(F.expr("a <> 0 AND b = 0")).alias("removed"), F.count_if(F.expr("a <> 0 AND b <> 0 AND a <> b")).alias("relabelled")
    )


def overlap(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, a, b, shared, iou, dice) of labels of two rasters that share pixels."""
    sizes_a = a.groupBy(*keys, F.col("label").alias("a")).agg(F.count("*").alias("na"))
    sizes_b = b.groupBy(*keys, F.col("label").alias("b")).agg(F.count("*").alias("nb"))
    met = a.select(*keys, "y", "x", F.col("label").alias("a")).join(b.select(*keys, "y", "x", F.col("label").alias("b")), [*keys, "y", "x"])
    met = met.groupBy(*keys, "a", "b").agg(F.count("*").alias("shared")).join(sizes_a, [*keys, "a"]).join(sizes_b, [*keys, "b"])
    n = F.col("shared")
    return met.select(*keys, "a", "b", "shared", (n / (F.col("na") + F.col("nb") - n)).alias("iou"), (2 * n / (F.col("na") + F.col("nb"))).alias("dice"))


def split_and_merged(pairs: DataFrame, sizes_a: DataFrame, sizes_b: DataFrame, keys: Sequence[str], least: float) -> DataFrame:
    """Labels of either raster that cover several of the other by `least` of the smaller area: (keys, side, label, degree)."""
    good = pairs.join(sizes_a, [*keys, "a"]).join(sizes_b, [*keys, "b"]).where(F.col("shared") >= least * F.least("na", "nb"))
    split = good.groupBy(*keys, F.col("a").alias("label")).agg(F.count("*").alias("degree")).withColumn("side", F.lit("split"))
    merged = good.groupBy(*keys, F.col("b").alias("label")).agg(F.count("*").alias("degree")).withColumn("side", F.lit("merge"))
    return split.unionByName(merged).where("degree > 1")


def ranked_tiles(tiles: DataFrame, keys: Sequence[str], least: float) -> DataFrame:
    """Tiles with enough tissue, numbered in scan order."""
    w = Window.partitionBy(*keys).orderBy("grid_row", "grid_col")
    return tiles.where(F.col("fraction") >= least).withColumn("tile", F.row_number().over(w))


def opened(mask: DataFrame, keys: Sequence[str], radius: int, height: int, width: int) -> DataFrame:
    """The mask eroded and dilated again: parts narrower than the disc go."""
    kept = _swept(_words(mask, keys), keys, radius, True)
    return _pixels(_clipped(_swept(kept, keys, radius, False), height, width), keys, mask)


def closed(mask: DataFrame, keys: Sequence[str], radius: int, height: int, width: int) -> DataFrame:
    """The mask dilated and eroded again: gaps narrower than the disc are filled; beyond the edge there is no mask."""
    wide = _clipped(_swept(_words(mask, keys), keys, radius, False), height, width)
    return _pixels(_swept(wide, keys, radius, True), keys, mask)


def _runs(rows: np.ndarray, marks: np.ndarray, up: np.ndarray) -> tuple:
    """(part, of, places, marked) of rows of 64 pixels, each of which may go on in the one before (up).

    Runs of pixels are joined by the ones they touch in the next row, the later pointing at the earlier, until none moves.
    `places` are the pixels' places, row by row, `part` their parts, numbered by first pixel; `marked` is told for each part.
    """
    bits = [np.unpackbits(w.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool) for w in (rows, marks)]
    held = bits[0]
    start = held.copy()
    start[:, 1:] &= ~held[:, :-1]
    run = np.cumsum(start.ravel()).reshape(held.shape) - 1
    both = held[1:] & held[:-1] & up[1:, None]
    meet = both.copy()
    meet[:, 1:] &= ~both[:, :-1]
    a, b = run[:-1][meet], run[1:][meet]
    parent = np.arange(int(start.sum()))
    while True:
        p, q = parent[a], parent[b]
        if (p == q).all():
            break
        np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
        while (parent[parent] != parent).any():
            parent = parent[parent]
    places = np.flatnonzero(held.ravel())
    tops, part = np.unique(parent[run.ravel()[places]], return_inverse=True)
    return part, len(tops), places, np.bincount(part, weights=bits[1].ravel()[places], minlength=len(tops)) > 0


def parts(words: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """(keys, component, n, marked, pixels): four-connected parts of words (keys, y, _wx, _w), and whether one of their pixels is in _mark.

    A part is named by its first pixel, y * width + x, and has a row for each tile of 64 x 64 pixels that it lies in.
    Tasks stream through tiles and join what meets in one; only parts at a tile's edge go on to rounds of components.
    """
    keys = list(keys)
    tile = Window.partitionBy(*keys, F.expr("shiftright(CAST(y AS BIGINT), 6)"), "_wx").orderBy("y")
    rows = words.where("_w <> 0").select(*keys, F.col("y").cast("long").alias("_y"), "_wx", "_w", "_mark", F.coalesce(F.lag("y").over(tile) == F.col("y") - 1, F.lit(False)).alias("_up"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def found(batch: pa.RecordBatch) -> pa.RecordBatch:
        y, wx, w, mark, up = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_y", "_wx", "_w", "_mark", "_up"))
        part, n, places, marked = _runs(w, mark, up)
        order = np.argsort(part, kind="stable")
        at, x = places[order] // 64, wx[places[order] // 64] * 64 + places[order] % 64
        node, row = y[at] * width + x, y[at] & 63
        ends = np.cumsum(np.bincount(part, minlength=n))
        first = np.concatenate(([0], ends[:-1])).astype(np.int64)
        edge = (row == 0) | (row == 63) | (x & 63 == 0) & (x > 0) | (x & 63 == 63) & (x + 1 < width)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate((first, [len(node)])), pa.int32()), pa.array(node))
        open_ = np.logical_or.reduceat(edge, first) if n else edge
        own = batch.select(keys).take(pa.array(at[first])) if keys else None
        columns = [*(own.columns if keys else []), pa.array(node[first]), pa.array(np.diff(np.concatenate((first, [len(node)])))), pa.array(marked), pa.array(open_), lists]
        return pa.RecordBatch.from_arrays(columns, [*keys, "component", "n", "marked", "_open", "pixels"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in (b.slice(lo, 1 << 14) for b in batches for lo in range(0, b.num_rows, 1 << 14)):
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            cuts = np.flatnonzero(~batch.column("_up").to_numpy(zero_copy_only=False))
            cut = int(cuts[-1])  # the last tile may go on in the next batch
            if cut:
                yield found(batch.slice(0, cut))
            held = batch.slice(cut)
        if held is not None and held.num_rows:
            yield found(held)

    schema = "".join(f"`{k}` {kinds[k]}, " for k in keys) + "component long, n long, marked boolean, _open boolean, pixels array<long>"
    local = stored(rows.mapInArrow(run, schema))
    open_ = local.where("_open").drop("_open")
    at = open_.select(*keys, "component", F.explode("pixels").alias("_p"))
    y, x = F.expr(f"(_p - pmod(_p, {width}L)) div {width}"), F.expr(f"pmod(_p, {width}L)")
    down = at.where(y.bitwiseAND(F.lit(63)) == 63).select(*keys, F.col("component").alias("src"), (F.col("_p") + width).alias("_p"))
    right = at.where((x.bitwiseAND(F.lit(63)) == 63) & (x + 1 < width)).select(*keys, F.col("component").alias("src"), (F.col("_p") + 1).alias("_p"))
    begins = [y.bitwiseAND(F.lit(63)) == 0, x.bitwiseAND(F.lit(63)) == 0]
    edges = [far.join(at.where(begin).withColumnRenamed("component", "dst").hint("merge"), [*keys, "_p"]) for far, begin in zip((down, right), begins, strict=True)]
    linked = components(edges[0].unionByName(edges[1]).select(*keys, "src", "dst"), keys).withColumnRenamed("component", "_to")
    joined = open_.join(linked.withColumnRenamed("node", "component").hint("merge"), [*keys, "component"], "left").withColumn("component", F.coalesce("_to", "component"))
    columns = [*keys, "component", "n", "marked", "pixels"]
    return local.where("NOT _open").select(*columns).unionByName(joined.select(*columns))


def _sizes(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    sizes = found.groupBy(*keys, "component").agg(F.sum("n").alias("n"))
    best = sizes.groupBy(*keys).agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("_best"))
    return sizes.join(best, list(keys)).select(*keys, "component", "n", (F.col("component") == F.col("_best")).alias("largest"))


def component_sizes(mask: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """(keys, component, n, largest): a mask's four-connected parts, as in sized_components()."""
    return _sizes(parts(_words(mask, keys).withColumn("_mark", F.lit(0).cast("long")), keys, width), keys)


def sized_components(mask: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """(keys, y, x, component, n, largest): a mask's pixels with their four-connected part, its size, and whether it is the largest.

    A part is named by its first pixel, y * width + x; of equally large parts the first is the largest.
    """
    found = parts(_words(mask, keys).withColumn("_mark", F.lit(0).cast("long")), keys, width)
    each = found.drop("n").join(_sizes(found, keys), [*keys, "component"]).withColumn("_p", F.explode("pixels"))
    return each.select(*keys, *_place(mask, width), "component", "n", "largest")


def _place(mask: DataFrame, width: int) -> list[Column]:
    """The place of pixel _p, with the types of the mask's places."""
    y, x = F.expr(f"(_p - pmod(_p, {width}L)) div {width}"), F.expr(f"pmod(_p, {width}L)")
    return [y.cast(mask.schema["y"].dataType).alias("y"), x.cast(mask.schema["x"].dataType).alias("x")]


def holes(mask: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """(keys, y, x): pixels outside a mask that no path of four-neighbours outside it leads out of its bounds.

    Only words within the mask's own bounds are looked at, so an empty canvas costs nothing.
    """
    keys = list(keys)
    words = stored(_words(mask, keys))
    low, high = F.expr("_wx * 64 + length(bin(_w)) - length(trim(TRAILING '0' FROM bin(_w)))"), F.expr("_wx * 64 + length(bin(_w)) - 1")
    ends = words.groupBy(*keys).agg(F.min("y").alias("_y0"), F.max("y").alias("_y1"), F.min(low).alias("_x0"), F.max(high).alias("_x1"))
    every = ends.withColumn("y", F.explode(F.sequence("_y0", "_y1"))).withColumn("_wx", F.explode(F.expr("sequence(shiftright(_x0, 6), shiftright(_x1, 6))")))
    from_, to = F.expr("greatest(_x0 - _wx * 64, 0L)"), F.expr("least(_x1 - _wx * 64, 63L)")
    inside = F.expr("shiftleft(-1L, CAST(_from AS INT)) & shiftrightunsigned(-1L, CAST(63 - _to AS INT))")
    sides = F.expr("CASE WHEN y IN (_y0, _y1) THEN -1L ELSE (CASE WHEN _wx = shiftright(_x0, 6) THEN shiftleft(1L, CAST(_from AS INT)) ELSE 0L END) | (CASE WHEN _wx = shiftright(_x1, 6) THEN shiftleft(1L, CAST(_to AS INT)) ELSE 0L END) END")
    box = every.withColumn("_from", from_).withColumn("_to", to).select(*keys, "y", "_wx", inside.alias("_in"), sides.alias("_mark"))
    met = box.join(words.hint("merge"), [*keys, "y", "_wx"], "left")
    outside = met.select(*keys, "y", "_wx", F.col("_in").bitwiseAND(F.bitwise_not(F.coalesce("_w", F.lit(0).cast("long")))).alias("_w"), "_mark")
    found = parts(outside, keys, width)
    leaving = found.where("marked").select(*keys, "component").distinct()
    return found.join(leaving, [*keys, "component"], "left_anti").withColumn("_p", F.explode("pixels")).select(*keys, *_place(mask, width))


def filled(mask: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """The mask with its holes()."""
    return mask.select(*keys, "y", "x").unionByName(holes(mask, keys, width))


def grown(seeds: DataFrame, within: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Labels of `seeds` (y, x, label) grown over all pixels of the mask `within`, however far: each takes its nearest seed pixel's.

    Ties go to the first seed pixel in scan order. Keys without a seed get no label.
    """
    node = F.col("y").cast("long") * width + F.col("x")
    seeds = stored(seeds.select(*keys, "y", "x", "label"))  # both are read in every round of nearest()
    todo = stored(within.join(seeds, [*keys, "y", "x"], "left_anti").select(*keys, node.alias("id"), "y", "x"))
    near = joins.nearest(todo, seeds.select(*keys, node.alias("id"), "y", "x"), keys, 1, 4.0)
    named = near.join(seeds.select(*keys, node.alias("b"), "label"), [*keys, "b"])
    kinds = {f.name: f.dataType for f in seeds.schema}
    place = [F.expr(f"a div {width}").cast(kinds["y"]).alias("y"), F.expr(f"a % {width}").cast(kinds["x"]).alias("x")]
    return seeds.select(*keys, "y", "x", "label").unionByName(named.select(*keys, *place, "label"))


def reassigned(raster: DataFrame, supported: Column, allowed: Column, keys: Sequence[str], width: int) -> DataFrame:
    """Pixels whose label is not `supported` take the nearest supported one's; such a pixel that is not `allowed` to is an error."""
    loose = F.assert_true(supported | allowed, F.lit("an unsupported label away from the edge"))
    checked = raster.withColumn("_ok", supported).where(loose.isNull())
    return grown(checked.where("_ok").select(*keys, "y", "x", "label"), checked.where("NOT _ok").select(*keys, "y", "x"), keys, width)


def scan_ordered(raster: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, label, number): labels numbered from 1 by their first pixel, row by row."""
    first = raster.where("label <> 0").groupBy(*keys, "label").agg(F.min(F.struct("y", "x")).alias("_first"))
    return first.select(*keys, "label", F.row_number().over(Window.partitionBy(*keys).orderBy("_first", "label")).alias("number"))


def _spiral(step: Column, cx: Column, cy: Column) -> tuple[Column, Column]:
    """The pixel (x, y) that a spiral around a centre comes to at a step: rings of squares, upper and lower sides first, in turn."""
    ring = F.ceil((F.sqrt(step.cast("double") + 1) - 1) / 2)
    i = step - (2 * ring - 1) * (2 * ring - 1)
    rows = i < 2 * (2 * ring + 1)
    j = i - 2 * (2 * ring + 1)
    low = F.when(i % 2 == 0, -ring).otherwise(ring)
    dx = F.when(step == 0, 0).when(rows, F.floor(i / 2) - ring).otherwise(low)
    dy = F.when(step == 0, 0).when(rows, low).otherwise(F.floor(j / 2) - ring + 1)
    return cx + dx, cy + dy


def seed_pixels(centres: DataFrame, keys: Sequence[str], width: int, height: int) -> DataFrame:
    """(keys, id, x, y): a pixel of its own for every centre (id, order, x, y), what taking turns in `order` would give.

    A centre takes the first free pixel along a spiral around its own. Here all ask at once: a pixel
    keeps the first in order, and the others go on to the next pixel that none before them holds. What
    is held by one before them stays so, and of several that go on from one pixel the n-th can't get better than
    the n-th place that is left to their first, so each skips as many; so crowds take a few rounds. Centres beyond the image
    count as on its edge; more centres than pixels are an error. `order` must not repeat within keys.
    """
    keys = list(keys)
    near = [F.least(F.lit(n - 1), F.greatest(F.lit(0), F.rint(c))).cast("long") for c, n in (("x", width), ("y", height))]
    rows = centres.select(*keys, "id", F.col("order").cast("long").alias("order"), near[0].alias("cx"), near[1].alias("cy"))
    crowded = rows.groupBy(*keys).count().where(F.col("count") > width * height)
    if not crowded.isEmpty():
        raise ValueError("more centres than pixels")
    last = (2 * max(width, height) + 1) ** 2
    state = rows.withColumn("step", F.lit(0).cast("long")).withColumn("need", F.lit(0).cast("long")).withColumn("first", F.col("order")).withColumn("x", F.col("cx")).withColumn("y", F.col("cy"))
    while True:
        state = stored(state)
        pixel = Window.partitionBy(*keys, "x", "y", "_asks").orderBy("order")
        asked = state.withColumn("_asks", F.col("need") == 0).withColumn("_holds", (F.row_number().over(pixel) == 1) & F.col("_asks"))
        lost = stored(asked.where("NOT _holds"))
        holds = asked.where("_holds").drop("_asks", "_holds")
        if lost.isEmpty():
            return holds.select(*keys, "id", "x", "y")
        # The place among those that go on from one pixel, and what a search has still to skip.
        crowd = Window.partitionBy(*keys, "cx", "cy", "step", "_asks").orderBy("order")
        first = F.when(F.col("_asks"), F.min("order").over(crowd.rowsBetween(Window.unboundedPreceding, 0))).otherwise(F.col("first"))
        lost = lost.withColumn("first", first).withColumn("need", F.when(F.col("_asks"), F.row_number().over(crowd)).otherwise(F.col("need"))).select(*keys, "id", "order", "cx", "cy", "step", "need", "first")
        tries = lost.withColumn("_to", F.explode(F.sequence(F.col("step") + 1, F.least(F.col("step") + 2 * F.col("need") + 24, F.lit(last)))))
        x, y = _spiral(F.col("_to"), F.col("cx"), F.col("cy"))
        tries = tries.withColumn("x", x).withColumn("y", y).where((F.col("x") >= 0) & (F.col("x") < width) & (F.col("y") >= 0) & (F.col("y") < height))
        free = tries.join(holds.select(*keys, "x", "y", F.col("order").alias("_held")), [*keys, "x", "y"], "left").where("_held IS NULL OR _held > first")
        free = free.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys, "id").orderBy("_to")))
        fits = (F.col("_nth") >= F.col("need")) & (F.col("_held").isNull() | (F.col("_held") > F.col("order")))
        got = free.groupBy(*keys, "id").agg(F.count("*").alias("_n"), F.min(F.when(fits, F.struct(F.col("_to"), F.col("x"), F.col("y")))).alias("_at"))
        after = lost.join(got, [*keys, "id"], "left")
        missed = F.col("_at").isNull()
        after = after.select(*keys, "id", "order", "cx", "cy", F.when(missed, F.col("step") + 2 * F.col("need") + 24).otherwise(F.col("_at._to")).alias("step"), F.when(missed, F.greatest(F.lit(1), F.col("need") - F.coalesce("_n", F.lit(0)))).otherwise(F.lit(0)).cast("long").alias("need"), "first", F.coalesce("_at.x", "cx").alias("x"), F.coalesce("_at.y", "cy").alias("y"))
        state = holds.select(*after.columns).unionByName(after)


def boundary_band(labels: DataFrame, keys: Sequence[str], radius: int) -> DataFrame:
    """Pixels within `radius` of one that has a neighbour, of four, with another label."""
    steps = F.explode(F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ((0, 1), (0, -1), (1, 0), (-1, 0)))))
    to = labels.where("label > 0").select(*keys, "y", "x", "label", steps.alias("_s")).select(*keys, F.col("y").alias("_y"), F.col("x").alias("_x"), F.col("label").alias("_l"), (F.col("y") + F.col("_s.dy")).alias("y"), (F.col("x") + F.col("_s.dx")).alias("x"))
    edge = to.join(labels.where("label > 0"), [*keys, "y", "x"]).where("label <> _l").select(*keys, F.col("_y").alias("y"), F.col("_x").alias("x")).distinct()
    spread = edge.select(*keys, "y", "x", F.explode(_offsets(radius)).alias("_o")).select(*keys, (F.col("y") + F.col("_o.dy")).alias("y"), (F.col("x") + F.col("_o.dx")).alias("x")).distinct()
    return labels.where("label > 0").join(spread, [*keys, "y", "x"], "left_semi").select(*keys, "y", "x")


def _spread(heap: list, cost: list, g: list, can: list, width: int) -> None:
    """Costs spread from a heap of (cost, place) to places where `can` holds, beside each other in rows of `width`; `cost` is changed.

    A cost is the way from a label, read backwards: its highest gradient and how many pixels lie at that height,
    then the same of the way before, and at the end the label. So a longer way never costs less, and of two
    ways to a pixel the cheaper stays so beyond it, which makes costs the same in any order of work.
    """
    heapq.heapify(heap)
    while heap:
        c, i = heapq.heappop(heap)
        if c != cost[i]:
            continue
        for j in (i + 1, i - 1, i + width, i - width):
            if can[j]:
                new = (g[j], 1.0, *c) if g[j] > c[0] else (c[0], c[1] + 1, *c[2:])
                if cost[j] is None or new < cost[j]:
                    cost[j] = new
                    heapq.heappush(heap, (new, j))


def _flooded(part: pd.DataFrame) -> pd.DataFrame:
    """A tile's pixels as rows (y, x, g, own, fixed, cost, fresh) after a flood from the fresh ones, over those of its own."""
    y, x = part["y"].to_numpy() - part["y"].min() + 1, part["x"].to_numpy() - part["x"].min() + 1
    width = int(x.max()) + 2
    places = (y * width + x).tolist()
    size = (int(y.max()) + 2) * width
    g, can, cost = [0.0] * size, [False] * size, [None] * size
    for i, h, own, fixed, c in zip(places, part["g"], part["own"], part["fixed"], part["cost"], strict=True):
        g[i], can[i], cost[i] = h, own and not fixed, None if c is None else tuple(c)
    before = [cost[i] for i in places]
    _spread([(c, i) for c, i, fresh in zip(before, places, part["fresh"], strict=True) if fresh], cost, g, can, width)
    after = [cost[i] for i in places]
    out = part.assign(cost=pd.Series([None if c is None else list(c) for c in after], index=part.index, dtype=object), changed=[a != b for a, b in zip(before, after, strict=True)])
    return out[part["own"].to_numpy()].drop(columns=["own", "fresh", "_ty", "_tx"])


class _Tile:
    """The free pixels of a tile, by their places in rows of `tile` + 2, with the costs that have reached them.

    `to` says on which sides, north, south, west and east by bits, a free pixel of another tile lies.
    """

    def __init__(self, tile: int, at: np.ndarray, g: np.ndarray, to: np.ndarray, label: np.ndarray, cost: list):
        self.tile, self.at, self.g, self.to, self.label, self.cost = tile, at, g, to, label, cost

    def flood(self, seeds: list[tuple]) -> list[tuple]:
        """Floods from seeds (cost, place) and returns what the tiles around are to know: (dy, dx, place there, cost)."""
        width = self.tile + 2
        size = width * (width + 1)  # rows below the last are never entered
        heights, can, cost = np.zeros(size), np.zeros(size, bool), [None] * size
        heights[self.at], can[self.at] = self.g, True
        places = self.at.tolist()
        for i, c in zip(places, self.cost, strict=True):
            cost[i] = c
        for c, i in seeds:
            cost[i] = c
        _spread(seeds, cost, heights.tolist(), can.tolist(), width)
        before, self.cost = self.cost, [cost[i] for i in places]
        moved = [k for k, (a, b) in enumerate(zip(before, self.cost, strict=True)) if a is not b]
        if moved:
            self.label[moved] = [int(self.cost[k][-1]) for k in moved]
        to, sent = self.to.tolist(), []
        for k in moved:
            if to[k]:
                i = places[k]
                there = ((-1, 0, i + self.tile * width), (1, 0, i - self.tile * width), (0, -1, i + self.tile), (0, 1, i - self.tile))
                sent += [(*there[b], self.cost[k]) for b in range(4) if to[k] >> b & 1]
        return sent


def _banded(label: np.ndarray, radius: int) -> np.ndarray:
    """Which pixels of a square of labels, 0 for none, lie within `radius` of one that has a neighbour, of four, with another label; the outermost `radius` + 1 are not told."""
    edge = np.zeros(label.shape, bool)
    for one, two in ((np.s_[1:], np.s_[:-1]), (np.s_[:, 1:], np.s_[:, :-1])):
        other = (label[one] != label[two]) & (label[one] > 0) & (label[two] > 0)
        edge[one] |= other
        edge[two] |= other
    band = np.zeros(label.shape, bool)
    if edge.any():
        n = len(label)
        for dy in range(-radius, radius + 1):
            reach = math.isqrt(radius * radius - dy * dy)
            for dx in range(-reach, reach + 1):
                band[max(dy, 0) : n + min(dy, 0), max(dx, 0) : n + min(dx, 0)] |= edge[max(-dy, 0) : n + min(-dy, 0), max(-dx, 0) : n + min(-dx, 0)]
    return band & (label > 0)


def _begun(y: np.ndarray, x: np.ndarray, label: np.ndarray, g: np.ndarray, ty: int, tx: int, radius: int, tile: int) -> tuple[_Tile, np.ndarray, np.ndarray, list[tuple]]:
    """A tile flooded from the fixed pixels in it and beside it, the fixed pixels of its own and their labels, and what the tiles around are to know.

    Its pixels come with those around it, as far as its outermost pixels' neighbours need to know whether they are free.
    """
    halo = radius + 2
    n = tile + 2 * halo
    labels, heights = np.zeros((n, n), np.int64), np.zeros((n, n))
    row, column = y[::-1] - ty * tile + halo, x[::-1] - tx * tile + halo  # of a repeated pixel the first counts
    labels[row, column], heights[row, column] = label[::-1], g[::-1]
    near = np.s_[halo - 1 : 1 - halo, halo - 1 : 1 - halo]
    free, labels, heights = _banded(labels, radius)[near], labels[near], heights[near]
    own = np.zeros(free.shape, bool)
    own[1:-1, 1:-1] = True
    can, fixed = free & own, (labels > 0) & ~free
    beside = np.zeros(free.shape, bool)
    for one, two in ((np.s_[1:], np.s_[:-1]), (np.s_[:, 1:], np.s_[:, :-1])):
        beside[one] |= can[two]
        beside[two] |= can[one]
    at, kept, seeds = (np.flatnonzero(m) for m in (can, fixed & own, fixed & beside))
    out = free & ~own
    to = np.zeros(free.shape, np.int32)
    for bit, (inner, outer) in enumerate(((np.s_[1], np.s_[0]), (np.s_[-2], np.s_[-1]), (np.s_[:, 1], np.s_[:, 0]), (np.s_[:, -2], np.s_[:, -1]))):
        to[inner] |= out[outer].astype(np.int32) << bit
    flat = labels.ravel()
    made = _Tile(tile, at, heights.ravel()[at], to.ravel()[at], flat[at], [None] * len(at))
    sent = made.flood([((-math.inf, 0.0, float(v)), i) for i, v in zip(seeds.tolist(), flat[seeds].tolist(), strict=True)]) if len(at) else []
    return made, kept, flat[kept], sent


#: What a tile is between two rounds of snapped(), and what it hands on.
_TILE = "at array<int>, g array<double>, to array<int>, label array<long>, n array<int>, cost array<double>"
_SENT = "sent array<struct<dy: int, dx: int, at: int, cost: array<double>>>"


def _listed(parts: Sequence[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if len(parts) else np.zeros(0), kind))


def _written(tiles: Sequence[_Tile], sent: Sequence[list[tuple]]) -> list[pa.Array]:
    """The columns of _TILE and _SENT."""
    kinds = (("at", pa.int32()), ("g", pa.float64()), ("to", pa.int32()), ("label", pa.int64()))
    columns = [_listed([getattr(t, c) for t in tiles], kind) for c, kind in kinds]
    columns.append(_listed([np.array([len(c or ()) for c in t.cost], np.int32) for t in tiles], pa.int32()))
    columns.append(_listed([np.array([v for c in t.cost if c for v in c], np.float64) for t in tiles], pa.float64()))
    kind = pa.list_(pa.struct([("dy", pa.int32()), ("dx", pa.int32()), ("at", pa.int32()), ("cost", pa.list_(pa.float64()))]))
    return [*columns, pa.array([[(dy, dx, i, list(c)) for dy, dx, i, c in s] for s in sent], kind)]


def _read(batch: pa.RecordBatch, tile: int) -> Iterator[_Tile]:
    """What _written() wrote."""
    lists = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column(c) for c in ("at", "g", "to", "label", "n", "cost"))]
    for i in range(batch.num_rows):
        at, g, to, label, n, flat = (values[ends[i] : ends[i + 1]] for ends, values in lists)
        flat, ends = flat.tolist(), np.cumsum(n).tolist()
        yield _Tile(tile, at, g, to, label.copy(), [tuple(flat[a:b]) if b > a else None for a, b in zip([0, *ends], ends, strict=False)])


def snapped(labels: DataFrame, gradient: DataFrame, keys: Sequence[str], radius: int, tile: int = 256) -> DataFrame:
    """(keys, y, x, label): labels whose inner boundaries have moved, within `radius`, to the ridges of a gradient (y, x, g).

    Pixels near a boundary are freed and flooded from the labels around: each takes the label from which a
    path within the mask stays lowest, by its highest gradient, then by how much of it lies so high, then by the
    path before that, and last by the smallest label.
    Tiles, a row each, flood by themselves, from the fixed pixels in and beside them, and hand on to the tiles around what has changed
    at their edges; a tile floods again only from what it is handed, until nothing is, so the outcome does
    not depend on `tile`. Pixels without a gradient count as 0; where no label is left to flood from, pixels keep their own.
    """
    keys = list(keys)
    mask = labels.where("label > 0").select(*keys, "y", "x", F.col("label").cast("long").alias("label"))
    slopes = gradient.select(*keys, "y", "x", F.col("g").cast("double").alias("g"))
    rows = mask.join(slopes.hint("merge"), [*keys, "y", "x"], "left")
    rows = rows.select(*keys, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), "label", F.coalesce("g", F.lit(0.0)).alias("g"))
    for c in "yx":
        reach = [F.floor((F.col(c) + d) / tile) for d in (-radius - 2, radius + 2)]
        rows = rows.withColumn(f"_t{c}", F.explode(F.sequence(*reach)))
    place = Window.partitionBy(*keys, "_ty", "_tx").orderBy("y", "x", "label", "g")
    rows = rows.withColumn("_first", F.row_number().over(place) == 1)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    own = [*keys, "_ty", "_tx"]
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in own) + f", {_TILE}, {_SENT}"
    names = [*own, "at", "g", "to", "label", "n", "cost", "sent"]

    def begin(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        y, x, label, g, ty, tx, new = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "x", "label", "g", "_ty", "_tx", "_first"))
        ends = np.append(np.flatnonzero(new), len(new)).tolist()
        inside = (y // tile == ty) & (x // tile == tx)
        for lo in range(0, len(ends) - 1, 64):
            some = [(a, b) for a, b in zip(ends[lo : lo + 64], ends[lo + 1 : lo + 65], strict=False) if inside[a:b].any()]
            made = [_begun(y[a:b], x[a:b], label[a:b], g[a:b], int(ty[a]), int(tx[a]), radius, tile) for a, b in some]
            if made:
                tiles, kept, names_of, sent = zip(*made, strict=True)
                keyed = batch.select(own).take(pa.array([a for a, _ in some])).columns
                yield pa.RecordBatch.from_arrays([*keyed, *_written(tiles, sent), _listed(kept, pa.int32()), _listed(names_of, pa.int64())], [*names, "kept", "kept_label"])

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in (b.slice(lo, 1 << 16) for b in batches for lo in range(0, b.num_rows, 1 << 16)):
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            cut = int(np.flatnonzero(batch.column("_first").to_numpy(zero_copy_only=False))[-1])  # the last tile may go on in the next batch
            if cut:
                yield from begin(batch.slice(0, cut))
            held = batch.slice(cut)
        if held is not None and held.num_rows:
            yield from begin(held)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(lo, 64) for b in batches for lo in range(0, b.num_rows, 64)):
            tiles = list(_read(batch, tile))
            sent = [t.flood([(tuple(m["cost"]), m["at"]) for m in came]) for t, came in zip(tiles, batch.column("came").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.select(own).columns, *_written(tiles, sent)], names)

    begun = stored(rows.mapInArrow(start, f"{schema}, kept array<int>, kept_label array<long>"))
    state, new = begun.select(*names), begun
    first = True
    while True:
        handed = new.select(*own, F.explode("sent").alias("m")).select(*keys, (F.col("_ty") + F.col("m.dy")).alias("_ty"), (F.col("_tx") + F.col("m.dx")).alias("_tx"), F.struct("m.at", "m.cost").alias("m"))
        came = stored(handed.groupBy(*own).agg(F.collect_list("m").alias("came")))  # what lies around a tile, at most
        if came.isEmpty():
            break
        stirred = came.select(*own)
        todo = state.drop("sent").join(stirred, own, "left_semi").join(came.hint("merge"), own)
        still = state.join(stirred, own, "left_anti").withColumn("sent", F.lit(None).cast(state.schema["sent"].dataType))
        state = stored(todo.mapInArrow(again, schema).unionByName(still), instead_of=None if first else state)
        new, first = state, False

    def pixels(df: DataFrame, at: str, label: str) -> DataFrame:
        each = df.select(*own, F.explode(F.arrays_zip(F.col(at).alias("at"), F.col(label).alias("label"))).alias("p"))
        y, x = F.expr(f"_ty * {tile} - 1 + p.at div {tile + 2}"), F.expr(f"_tx * {tile} - 1 + p.at % {tile + 2}")
        return each.select(*keys, y.alias("y"), x.alias("x"), F.col("p.label").alias("label"))

    return pixels(begun, "kept", "kept_label").unionByName(pixels(state, "at", "label"))

"""Joins by key, by place and by nearness.

Joins by place go through buckets: both sides are dealt to square tiles and meet in an equi-join, so
nothing is compared across samples or far apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored
from .ordered import dealt

#: Rows that a broadcast side may have; larger sides go through a shuffle.
BROADCAST_ROWS = 20_000


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join in which a key that repeats on either side is an error when its row is met."""

    def once(df: DataFrame) -> DataFrame:
        n = F.count(F.lit(1)).over(Window.partitionBy(key))
        return df.withColumn("_n", n).where(F.assert_true(F.col("_n") == 1, F.lit(f"{key} repeats")).isNull()).drop("_n")

    return once(left).join(once(right), key)


def look_up(df: DataFrame, mapping: DataFrame, key: str, value: str, default) -> DataFrame:
    """`df` with `value` of its key, or `default` where the mapping has none."""
    return df.join(mapping.select(key, value), key, "left").fillna({value: default})


def look_up_known(df: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """`df` with `value` of its key; a key that the mapping lacks, or has more than once, is an error, a null key gets null."""
    told = mapping.select(key, value, F.count(F.lit(1)).over(Window.partitionBy(key)).alias("_n"))
    met = df.join(told, key, "left")
    why = F.when(F.col(key).isNotNull() & F.col("_n").isNull(), F.concat(F.lit(f"no {value} for the {key} "), F.col(key).cast("string"))).when(F.col("_n") > 1, F.concat(F.lit(f"{key} repeats: "), F.col(key).cast("string")))
    return met.where(F.when(why.isNull(), True).otherwise(F.raise_error(why).cast("boolean"))).drop("_n")


def lattice_join(points: DataFrame, grid: DataFrame, keys: Sequence[str], stride: int) -> DataFrame:
    """Points in the half-open cores of a regular lattice (x0, y0): an equi-join on floor(x / stride) * stride."""
    placed = points.withColumn("x0", (F.floor(F.col("x") / stride) * stride).cast("long")).withColumn("y0", (F.floor(F.col("y") / stride) * stride).cast("long"))
    return placed.join(grid, [*keys, "x0", "y0"])


def box_join(points: DataFrame, boxes: DataFrame, keys: Sequence[str], tile: int) -> DataFrame:
    """Points in half-open boxes (x0, y0, x1, y1) of any shape, by way of the tiles that each box touches."""
    spread = boxes.withColumn("_tx", F.explode(F.expr(f"sequence(floor(x0 / {tile}), floor((x1 - 1e-9) / {tile}))")))
    spread = spread.withColumn("_ty", F.explode(F.expr(f"sequence(floor(y0 / {tile}), floor((y1 - 1e-9) / {tile}))")))
    placed = points.withColumn("_tx", F.floor(F.col("x") / tile)).withColumn("_ty", F.floor(F.col("y") / tile))
    met = placed.join(spread, [*keys, "_tx", "_ty"])
    return met.where("x >= x0 AND x < x1 AND y >= y0 AND y < y1").drop("_tx", "_ty")


def latest(points: DataFrame, starts: DataFrame, keys: Sequence[str], at: str, carried: Sequence[str]) -> DataFrame:
    """`points` with the columns `carried` of the last of `starts` with the same keys whose `at` is not past the point's.

    Both sides are sorted together by ranges, and the last start of each range is carried over to the
    ranges after it, so neither a key nor a value with many points makes a task large. Of starts at one
    place the one with the greatest carried values counts. Points before the first start, or without
    a place, get nulls; starts without a place are ignored. Starts sit close together, far apart or anywhere.
    """
    keys, inner = list(keys), [c for c in points.columns if c not in keys and c != at]
    point = F.struct(F.xxhash64(*points.columns).alias("_h"), F.struct(*inner).alias("_v") if inner else F.lit(0).alias("_v"))
    start = F.struct(*keys, F.struct(*(F.col(c) for c in carried)).alias("_v"))
    kinds = points.select(point.alias("_point")).schema["_point"].dataType, starts.select(start.alias("_start")).schema["_start"].dataType
    left = starts.where(F.col(at).isNotNull()).select(*keys, at, F.lit(0).alias("_kind"), start.alias("_start"), F.lit(None).cast(kinds[0]).alias("_point"))
    right = points.select(*keys, at, F.lit(1).alias("_kind"), F.lit(None).cast(kinds[1]).alias("_start"), point.alias("_point"))
    rows = left.unionByName(right).withColumn("_salt", F.coalesce("_point._h", F.lit(0)))
    order = [*keys, at, "_kind", "_salt"]
    rows = dealt(rows, order)
    ends = rows.where("_kind = 0").groupBy("_p").agg(F.max_by("_start", F.struct(*keys, at, "_start._v")).alias("_last"))
    parts = rows.select("_p").distinct().join(ends, "_p", "left")  # a row for each range
    ends = parts.select("_p", F.last("_last", ignorenulls=True).over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    within = Window.partitionBy("_p").orderBy(*keys, at, "_kind", "_start._v", "_salt").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_own", F.last("_start", ignorenulls=True).over(within)).where("_kind = 1").join(ends, "_p", "left")
    found = found.withColumn("_got", F.coalesce("_own", "_carry"))
    fits = reduce(lambda a, b: a & b, (F.col(f"_got.{k}").eqNullSafe(F.col(k)) for k in keys), F.col(at).isNotNull())
    return found.select(*keys, at, *(F.col(f"_point._v.{c}").alias(c) for c in inner), *(F.when(fits, F.col(f"_got._v.{c}")).alias(c) for c in carried))


def irregular_lattice_join(points: DataFrame, grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Points (x, y) with the core (x0, y0, x1, y1) of an irregular lattice that they lie in, half-open.

    Each axis is an as-of join with the lattice's different starts, and the two starts name the
    core in an equi-join; points in no core are left out.
    """
    keys = list(keys)
    for axis in "xy":
        starts = grid.select(*keys, F.col(f"{axis}0").alias(axis), F.col(f"{axis}0")).distinct()
        points = latest(points, starts, keys, axis, [f"{axis}0"])
    return points.join(grid, [*keys, "x0", "y0"]).where("x < x1 AND y < y1")


def near_pairs(points: DataFrame, keys: Sequence[str], radius: float, carried: Sequence[str] = ()) -> DataFrame:
    """(keys, a, b, d): ordered pairs of different points (id, x, y) less than `radius` apart.

    Columns `carried` come along from both, as `<column>_a` and `<column>_b`. Tiles are two radii wide; one side
    is dealt to its tile, the other to those that its radius reaches, four on average. Neither side is
    broadcast: files hold points so densely that their sizes say little of what a driver would have to hold.
    """
    tile = 2 * float(radius)

    def side(name: str) -> DataFrame:
        return points.select(*keys, F.col("id").alias(name), F.col("x").alias(f"_x{name}"), F.col("y").alias(f"_y{name}"), *(F.col(c).alias(f"{c}_{name}") for c in carried))

    left = side("a").withColumn("_tx", F.floor(F.col("_xa") / tile)).withColumn("_ty", F.floor(F.col("_ya") / tile))
    reach = [F.sequence(F.floor((F.col(c) - radius) / tile), F.floor((F.col(c) + radius) / tile)) for c in ("_xb", "_yb")]
    right = side("b").withColumn("_tx", F.explode(reach[0])).withColumn("_ty", F.explode(reach[1]))
    d = F.hypot(F.col("_xa") - F.col("_xb"), F.col("_ya") - F.col("_yb"))
    names = [f"{c}_{s}" for s in "ab" for c in carried]
    return left.join(right.hint("merge"), [*keys, "_tx", "_ty"]).where("a <> b").withColumn("d", d).where(F.col("d") < radius).select(*keys, "a", "b", "d", *names)


def nearest_of_sources(points: DataFrame, keys: Sequence[str], radius: float, k: int) -> DataFrame:
    """For every point and every other source the `k` nearest points of that source within `radius`.

    Ties go to the smaller id. `points` has id, source, x and y; distances equal to the radius are out.
    """
    pairs = near_pairs(points, keys, radius, ["source"]).where("source_a < source_b")
    order = Window.partitionBy(*keys, "a", "source_b").orderBy("d", "b")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _places(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive runs."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


class _Near:
    """Points (x, y, id, kind) among which a task looks for the nearest: the ids that count at a place, in grids made as needed."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ids: np.ndarray, kind: np.ndarray | None, k: int):
        # Of one place, and kind, only k + 1 ids can be among the k nearest of any point.
        at = np.lexsort((ids, y, x) if kind is None else (ids, kind, y, x))
        runs = _starts(x[at], y[at], *(() if kind is None else (kind[at],))) if len(at) else at
        at = at[_places(np.diff(np.append(runs, len(at)))) <= k]
        at = at[np.argsort(ids[at], kind="stable")]
        self.at, self.x, self.y, self.ids, self.kind, self.k = at, x[at], y[at], ids[at], None if kind is None else kind[at], k
        self.grids: dict = {}
        self.least = None

    def _grid(self, size: float) -> tuple:
        if size not in self.grids:
            gx, gy = (np.floor((c - c.min()) / size).astype(np.int64) for c in (self.x, self.y))
            width, height = int(gx.max()) + 1, int(gy.max()) + 1
            cell = gy * width + gx
            order = np.argsort(cell, kind="stable")
            self.grids[size] = order, cell[order], width, height
        return self.grids[size]

    def _first_size(self) -> float:
        """The width of grid cells of about k points; narrower where many crowd in one."""
        if self.least is None:
            span = [max(float(c.max() - c.min()), 1e-9) for c in (self.x, self.y)]
            self.least = max((span[0] * span[1] * self.k / len(self.x)) ** 0.5, max(span) / 1e6)
            for _ in range(20):
                counts = np.diff(np.append(_starts(self._grid(self.least)[1]), len(self.x)))
                if counts.max() <= 64 * (self.k + 1) or self.least <= max(span) / 1e6:
                    break
                self.least /= 2
        return self.least

    def find(self, x: np.ndarray, y: np.ndarray, ids: np.ndarray, kind: np.ndarray | None) -> tuple:
        """(rows, found, d2, rank): the k nearest that are not a point's own id nor of its kind, by rows of the points, as places in `ids`."""
        if not len(self.x) or not len(x):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0), none.astype(np.int32)
        parts, todo = [], np.arange(len(x))
        size = self._first_size() if len(self.x) > 64 else None
        while len(todo):
            if size is None:  # few: all meet all
                first, last = np.zeros((len(todo), 1), np.int64), np.full((len(todo), 1), len(self.x))
                order, covers = np.arange(len(self.x)), np.ones(len(todo), bool)
            else:
                order, cells, width, height = self._grid(size)
                px, py = (np.floor((a - b.min()) / size) for a, b in ((x[todo], self.x), (y[todo], self.y)))
                covers = (px <= 1) & (px >= width - 2) & (py <= 1) & (py >= height - 2)
                px, py = (np.clip(p, -2, n + 1).astype(np.int64) for p, n in ((px, width), (py, height)))
                rows = py[:, None] + np.arange(-1, 2)
                low, high = np.clip(px - 1, 0, width), np.clip(px + 2, 0, width)
                empty = (rows < 0) | (rows >= height)
                first = np.searchsorted(cells, np.where(empty, 0, rows * width + low[:, None]))
                last = np.where(empty, first, np.searchsorted(cells, np.where(empty, 0, rows * width + high[:, None])))
                last = np.maximum(first, last)
            load = np.cumsum((last - first).sum(1))
            left, lo = [], 0
            while lo < len(todo):
                hi = max(lo + 1, int(np.searchsorted(load, (load[lo - 1] if lo else 0) + 1_000_000, "right")))
                f, n = first[lo:hi].ravel(), (last[lo:hi] - first[lo:hi]).ravel()
                b = order[np.repeat(f, n) + _places(n)]
                r = np.repeat(np.repeat(np.arange(lo, hi), first.shape[1]), n)
                a = todo[r]
                keep = ids[a] != self.ids[b]
                if kind is not None:
                    keep &= kind[a] != self.kind[b]
                r, a, b = r[keep], a[keep], b[keep]
                d2 = (x[a] - self.x[b]) ** 2 + (y[a] - self.y[b]) ** 2
                at = np.lexsort((b, d2, r))  # places in self.ids are in the order of ids
                r, b, d2 = r[at], b[at], d2[at]
                rank = _places(np.bincount(r - lo, minlength=hi - lo)) if len(r) else r
                keep = rank < self.k
                r, b, d2, rank = r[keep], b[keep], d2[keep], rank[keep]
                done = covers[lo:hi].copy()
                if size is not None:
                    done[r[(rank == self.k - 1) & (d2 <= size * size * (1 - 1e-9))] - lo] = True
                keep = done[r - lo]
                parts.append((todo[r[keep]], b[keep], d2[keep], (rank[keep] + 1).astype(np.int32)))
                left.append(todo[lo:hi][~done])
                lo = hi
            todo = np.concatenate(left)
            size = None if size is None else size * 2
        rows, found, d2, rank = (np.concatenate(c) for c in zip(*parts, strict=True))
        return rows, found, d2, rank


def nearest(points: DataFrame, others: DataFrame, keys: Sequence[str], k: int, tile: float, differ: str | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """(keys, a, b, d, rank): for every point (id, x, y) the `k` nearest of `others` with the same keys, however far.

    Points meet the others in tiles four `tile` wide, to which those within `tile` around come along; a task
    streams through tiles, holds one tile's others in grids, and sends on k rows a point. If a point's k
    nearest there lie within `tile`, nothing nearer can lie outside; the points left go on to twice the width,
    until tiles cover everything. Tiles start narrower where any holds over 2**16. A point is not its own neighbour;
    `differ` names a column in which neighbours must differ from the point, and columns `carried` come along
    from both, as `<column>_a` and `<column>_b`. Ties go to the smaller id. Ids are whole numbers; rows without a
    finite place have and are no neighbours. `tile` only bears on the speed.
    """
    keys = list(keys)
    kinds = {c: points.schema[c].dataType.simpleString() for c in keys}
    types = [df.schema["id"].dataType.simpleString() for df in (points, others)]
    held = reduce(lambda a, b: a & b, (F.col(k_).isNotNull() for k_ in keys), (F.abs("x") < float("inf")) & (F.abs("y") < float("inf")))

    def plain(df: DataFrame) -> DataFrame:
        rows = df.where(held & F.col(differ).isNotNull() if differ else held)
        return rows.select(*keys, F.col("id").cast("long").alias("id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), *(F.col(c).alias("_kind") for c in [differ] if c), *(F.col(c).alias(f"{c}_a") for c in carried))

    todo, here = plain(points), plain(others)
    ends = [F.struct(F.min(c).alias("low"), F.max(c).alias("high")) for c in ("x", "y")]
    box = todo.select("x", "y").unionByName(here.select("x", "y")).agg(*(e.alias(c) for e, c in zip(ends, "xy", strict=True))).first()
    span = max((box[c]["high"] or 0) - (box[c]["low"] or 0) for c in "xy")
    size, most = float(tile), None
    while True:
        crowd = here.groupBy(*keys, F.floor(F.col("x") / (4 * size)), F.floor(F.col("y") / (4 * size))).count().agg(F.max("count")).first()[0] or 0
        if crowd <= 1 << 16 or most is not None and crowd > 0.9 * most:
            break
        most, size = crowd, size / 4
    columns = [*keys, "_tx", "_ty"]
    extra = [*(["_kind"] if differ else []), *(f"{c}_a" for c in carried)]
    brought = {f"{c}_b": f"{c}_a" for c in carried}
    fields = "".join(f"`{c}` {kinds[c]}, " for c in keys) + "a long, b long, d double, rank int, x double, y double" + "".join(f", `{c}` {here.schema[c].dataType.simpleString()}" for c in extra)
    fields += "".join(f", `{c}` {here.schema[own_].dataType.simpleString()}" for c, own_ in brought.items())

    def met(margin: float, last: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own, near, waiting = None, None, []
            for batch in batches:
                v = {c: batch[c].to_numpy() for c in batch.columns}
                starts = _starts(*(v[c] for c in columns), v["_side"])
                out = []
                for lo, hi in zip(starts, np.append(starts[1:], len(batch)), strict=True):
                    tile_ = tuple(v[c][lo] for c in columns)
                    if tile_ != own:
                        own, near, waiting = tile_, None, []
                    part = {c: v[c][lo:hi] for c in ("x", "y", "id", *extra)}
                    if v["_side"][lo] == 0:
                        waiting.append(part)
                        continue
                    if near is None:
                        sides = {c: np.concatenate([p[c] for p in waiting]) if waiting else part[c][:0] for c in part}
                        near, waiting = _Near(sides["x"], sides["y"], sides["id"], sides.get("_kind"), k), []
                    rows, found, d2, rank = near.find(part["x"], part["y"], part["id"], part.get("_kind"))
                    d = np.sqrt(d2)
                    n = hi - lo
                    whole = np.zeros(n, bool)
                    whole[rows[(rank == k) & (d <= margin)]] = True
                    keep = whole[rows] | last
                    rows, found, d, rank = rows[keep], found[keep], d[keep], rank[keep]
                    out.append((lo + rows, near.ids[found], d, rank, *(sides[c][near.at[found]] for c in brought.values())))
                    if not last:
                        more = np.flatnonzero(~whole)
                        out.append((lo + more, np.zeros(len(more), np.int64), np.full(len(more), -1.0), np.zeros(len(more), np.int32), *(part[c][more] for c in brought.values())))
                if out:
                    at, found, d, rank, *theirs = (np.concatenate(c) for c in zip(*out, strict=True))
                    yield pd.DataFrame({**{c: v[c][at] for c in keys}, "a": v["id"][at], "b": found, "d": d, "rank": rank, **{c: v[c][at] for c in ["x", "y", *extra]}, **dict(zip(brought, theirs, strict=True))})

        return run

    results = []
    while True:
        wide, last = 4 * size, size >= span
        own = [F.floor(F.col(c) / wide) for c in ("x", "y")]
        reach = [F.sequence(F.floor((F.col(c) - size) / wide), F.floor((F.col(c) + size) / wide)) for c in ("x", "y")]
        placed = todo.withColumn("_tx", own[0]).withColumn("_ty", own[1]).withColumn("_side", F.lit(1))
        sent = here.withColumn("_tx", F.explode(reach[0])).withColumn("_ty", F.explode(reach[1])).withColumn("_side", F.lit(0))
        if results:
            sent = sent.join(placed.select(*columns).distinct(), columns, "left_semi")
        rows = sent.unionByName(placed).repartition(*columns).sortWithinPartitions(*columns, "_side")
        best = stored(rows.mapInPandas(met(size, last), fields))
        results.append(best.where("rank > 0"))
        todo = best.where("rank = 0").select(*keys, F.col("a").alias("id"), "x", "y", *extra)
        if last or todo.isEmpty():
            every = reduce(DataFrame.unionByName, results)
            return every.select(*keys, F.col("a").cast(types[0]).alias("a"), F.col("b").cast(types[1]).alias("b"), "d", "rank", *brought.values(), *brought)
        size *= 2


def nearest_values(df: DataFrame, keys: Sequence[str], value: str, k: int) -> DataFrame:
    """(keys, a, b, d): for every row (id) the `k` rows with the same keys whose values are nearest; ties to the smaller id.

    The k nearest rows have values among the k different ones on either side, and of each value
    only the k + 1 smallest ids can be among them, so a row meets a bounded number of others.
    """
    keys = list(keys)
    first = Window.partitionBy(*keys, value).orderBy("id")
    few = df.select(*keys, "id", value).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    listed = few.groupBy(*keys, value).agg(F.collect_list("id").alias("ids"))
    around = Window.partitionBy(*keys).orderBy(value).rowsBetween(-k, k)
    near = listed.withColumn("_near", F.collect_list(F.struct(F.col(value).alias("v"), "ids")).over(around)).select(*keys, value, "_near")
    met = df.select(*keys, F.col("id").alias("a"), value).join(near, [*keys, value]).withColumn("_c", F.explode("_near")).withColumn("b", F.explode("_c.ids")).where("a <> b")
    met = met.withColumn("d", F.abs(F.col(value) - F.col("_c.v")))
    order = Window.partitionBy(*keys, "a").orderBy("d", "b")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(*keys, "a", "b", "d", "rank")


def nearest_landmarks(points: DataFrame, landmarks: DataFrame, k: int) -> DataFrame:
    """(id, landmark, d, rank): the `k` nearest landmarks (landmark, x, y) for every point.

    Up to BROADCAST_ROWS landmarks are sent to the tasks and looked up in grids of about k to a cell, so a point
    meets few of them; more are dealt to tiles, as in nearest(). Ties go to the smaller landmark.
    """
    few = landmarks.select(F.col("landmark").cast("long"), F.col("x").cast("double"), F.col("y").cast("double")).limit(BROADCAST_ROWS + 1).toPandas()
    if len(few) > BROADCAST_ROWS:
        other = landmarks.select(F.col("landmark").cast("long").alias("id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
        area = other.agg((F.max("x") - F.min("x")) * (F.max("y") - F.min("y")) * k / F.count("*")).first()[0]
        # Landmarks are apart from points, so no id is a point's own: numbers below zero are free for it.
        away = points.select((-1 - F.col("id").cast("long")).alias("id"), "x", "y")
        found = nearest(away, other, [], k, max(1e-9, float(area) ** 0.5))
        return found.select((-1 - F.col("a")).alias("id"), F.col("b").alias("landmark"), "d", "rank")
    sides = [few[c].to_numpy() for c in ("x", "y", "landmark")]

    def run(batches):
        near = _Near(*sides, None, k)
        for b in batches:
            # No landmark is a point's own: ids that none has.
            rows, found, d2, rank = near.find(b["x"].to_numpy(), b["y"].to_numpy(), np.full(len(b), few["landmark"].min() - 1 if len(few) else 0), None)
            yield pd.DataFrame({"id": b["id"].to_numpy()[rows], "landmark": near.ids[found], "d": np.sqrt(d2), "rank": rank})

    finite = (F.abs("x") < float("inf")) & (F.abs("y") < float("inf"))
    return points.where(finite).select(F.col("id").cast("long"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).mapInPandas(run, "id long, landmark long, d double, rank int")


def compare_units(df: DataFrame, unit: Sequence[str], who: str, value: str) -> DataFrame:
    """(unit, who_a, who_b, difference): pairs of `who` measured on the same unit."""
    a = df.select(*unit, F.col(who).alias("who_a"), F.col(value).alias("_a"))
    b = df.select(*unit, F.col(who).alias("who_b"), F.col(value).alias("_b"))
    return a.join(b, list(unit)).where("who_a < who_b").select(*unit, "who_a", "who_b", (F.col("_a") - F.col("_b")).alias("difference"))


def by_either_id(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """(wanted, cell_id): candidates that match exactly one row by its id or its alias; two equi-joins, no OR."""
    hits = wanted.join(known, F.col("wanted") == F.col("cell_id")).select("wanted", "cell_id")
    hits = hits.unionByName(wanted.join(known, F.col("wanted") == F.col("alias")).select("wanted", "cell_id")).distinct()
    return hits.groupBy("wanted").agg(F.count("*").alias("_n"), F.min("cell_id").alias("cell_id")).where("_n = 1").drop("_n")


def matched_outcomes(reference: DataFrame, predicted: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of a full outer join named TP, FN (reference only) or FP (prediction only)."""
    r, p = reference.withColumn("_r", F.lit(1)), predicted.withColumn("_p", F.lit(1))
    outcome = F.when(F.col("_r").isNull(), "FP").when(F.col("_p").isNull(), "FN").otherwise("TP")
    return r.join(p, list(key), "full").withColumn("outcome", outcome).drop("_r", "_p")


def wide(df: DataFrame, key: str, name: str, value: str, names: Sequence[str]) -> DataFrame:
    """One row a key, with a column for each of `names`."""
    return df.groupBy(key).pivot(name, list(names)).agg(F.min(value))

"""Exact overlays of polygons: common parts, unions, differences and Hausdorff distances of pairs.

The sides of a pair's two polygons meet in tiles, and are cut at all points that they have in common; a
crossing point is worked out once, for both. Then every piece lies wholly inside, outside or on the
other polygon. Pieces between two cuts lie alike, so one ray settles each such run. What an overlay
keeps is a choice of pieces: their cross products sum up to areas, and linked at their ends they
are rings. All of it is rows, so polygons may have any number of sides. For pairs of small outlines
that are in one row, common_area() and ring_hausdorff() say the same without a shuffle.

Polygons are (keys, polygon, ring, holes) with points as structs of x and y; rings may run either way
and do not cross themselves. Coordinates are doubles: on a grid of whole numbers (or halves) results
are exact up to crossing points, which are rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .geometry import _edges, bounds
from .graph import cycles, stored

#: Up to so many pairs of sides two polygons are compared in their own row; beyond, as rows.
ROW_SIDES = 16_384
OUTSIDE, INSIDE, SAME, OPPOSITE = range(4)
PIECE = ("side", "part", "nth", "piece")


def _signed(ring: Column) -> Column:
    return F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])


def _turned(ring: Column, sign: int) -> Column:
    """A ring that runs so that its signed area has a sign."""
    return F.when(_signed(ring) * sign < 0, F.reverse(ring)).otherwise(ring)


def _holes(polygons: DataFrame) -> Column:
    """The holes of polygons, none where there is no such column or value."""
    none = F.array().cast(polygons.schema["holes"].dataType if "holes" in polygons.columns else "array<" + polygons.schema["ring"].dataType.simpleString() + ">")
    return F.coalesce("holes", none) if "holes" in polygons.columns else none


def _sides(pairs: DataFrame, polygons: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, a, b, side, part, nth, x1, y1, x2, y2): the sides of every pair's polygons, interior to the left; sides without length are left out."""
    holes = _holes(polygons)
    rings = F.concat(F.array(_turned(F.col("ring"), 1)), F.transform(holes, lambda h: _turned(h, -1)))
    whole = polygons.select(*keys, "polygon", rings.alias("_rings"))
    both = [pairs.select(*keys, "a", "b").distinct().join(whole.withColumnRenamed("polygon", c), [*keys, c]).select(*keys, "a", "b", F.lit(side).alias("side"), "_rings") for side, c in enumerate("ab")]
    each = both[0].unionByName(both[1]).select(*keys, "a", "b", "side", F.posexplode("_rings").alias("part", "_ring")).where(F.size("_ring") >= 3)
    each = each.select(*keys, "a", "b", "side", "part", F.posexplode(_edges(F.col("_ring"))).alias("nth", "e"))
    ends = [F.col(f"e.{p}.{c}").cast("double").alias(f"{c}{n}") for n, p in ((1, "a"), (2, "b")) for c in "xy"]
    return each.select(*keys, "a", "b", "side", "part", "nth", *ends).where("x1 <> x2 OR y1 <> y2")


def _tiled(rows: DataFrame, tile: float) -> DataFrame:
    """`rows` with each tile that a side passes, `_tx` and `_ty`."""
    t = f"CAST({tile!r} AS DOUBLE)"
    spread = rows.withColumn("_tx", F.explode(F.expr(f"sequence(floor(least(x1, x2) / {t}), floor(greatest(x1, x2) / {t}))")))
    at = [F.expr(e) for e in (f"greatest(least(x1, x2), _tx * {t})", f"least(greatest(x1, x2), (_tx + 1) * {t})")]
    ys = [F.when(F.col("x1") == F.col("x2"), F.col(end)).otherwise(F.col("y1") + (x - F.col("x1")) * (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))) for x, end in zip(at, ("y1", "y2"), strict=True)]
    slack = 1e-6 * tile
    low, high = F.floor((F.least(*ys) - slack) / tile), F.floor((F.greatest(*ys) + slack) / tile)
    return spread.withColumn("_ty", F.explode(F.sequence(low, high)))


def _cross(p: str, q: str, r: str) -> Column:
    """Twice the signed area of three points, each named by the end of its columns."""
    return F.expr(f"(x{q} - x{p}) * (y{r} - y{p}) - (y{q} - y{p}) * (x{r} - x{p})")


def _cuts(sides: DataFrame, on: Sequence[str], tile: float) -> DataFrame:
    """(on, side, part, nth, x, y): the points at which a side meets sides of the other polygon, its own ends included."""
    own = _tiled(sides, tile)
    left = own.where("side = 0").drop("side")
    right = own.where("side = 1").select(*on, "_tx", "_ty", F.col("part").alias("_part"), F.col("nth").alias("_nth"), *(F.col(f"{c}{n}").alias(f"{c}{n + 2}") for n in (1, 2) for c in "xy"))
    met = left.join(right, [*on, "_tx", "_ty"])
    met = met.where("least(x1, x2) <= greatest(x3, x4) AND least(x3, x4) <= greatest(x1, x2) AND least(y1, y2) <= greatest(y3, y4) AND least(y3, y4) <= greatest(y1, y2)")
    met = met.drop("_tx", "_ty").distinct().withColumns({"o3": _cross("1", "2", "3"), "o4": _cross("1", "2", "4"), "o1": _cross("3", "4", "1"), "o2": _cross("3", "4", "2")})

    def lies(n: int, a: int, b: int) -> Column:
        return F.expr(f"o{n} = 0 AND x{n} BETWEEN least(x{a}, x{b}) AND greatest(x{a}, x{b}) AND y{n} BETWEEN least(y{a}, y{b}) AND greatest(y{a}, y{b})")

    points = [(lies(1, 3, 4), F.col("x1"), F.col("y1")), (lies(2, 3, 4), F.col("x2"), F.col("y2")), (lies(3, 1, 2), F.col("x3"), F.col("y3")), (lies(4, 1, 2), F.col("x4"), F.col("y4"))]
    t = F.col("o1") / (F.col("o1") - F.col("o2"))
    crossing = (F.signum("o1") * F.signum("o2") < 0) & (F.signum("o3") * F.signum("o4") < 0)
    points.append((crossing, F.col("x1") + t * (F.col("x2") - F.col("x1")), F.col("y1") + t * (F.col("y2") - F.col("y1"))))
    found = F.array_compact(F.array(*(F.when(test, F.struct(x.alias("x"), y.alias("y"))) for test, x, y in points)))
    hits = met.select(*on, "part", "nth", "_part", "_nth", F.explode(found).alias("p"))
    mine = hits.select(*on, F.lit(0).alias("side"), "part", "nth", "p.x", "p.y")
    return mine.unionByName(hits.select(*on, F.lit(1).alias("side"), F.col("_part").alias("part"), F.col("_nth").alias("nth"), "p.x", "p.y")).distinct()


def arranged(pairs: DataFrame, polygons: DataFrame, keys: Sequence[str], tile: float = 64.0) -> DataFrame:
    """(keys, a, b, side, part, nth, piece, x1, y1, x2, y2, place): the pieces of both polygons of every pair (a, b).

    side is 0 for pieces of a and 1 for those of b; place says whether a piece lies OUTSIDE or INSIDE the
    other polygon, or on it, running the SAME or the OPPOSITE way. `tile` only bears on the speed.
    """
    keys = list(keys)
    on = [*keys, "a", "b"]
    sides = stored(_sides(pairs, polygons, keys))
    along = F.expr("least(greatest((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1), 0), (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))")
    cuts = sides.join(_cuts(sides, on, tile), [*on, "side", "part", "nth"]).groupBy(*on, "side", "part", "nth").agg(F.collect_set(F.struct(along.alias("t"), "x", "y")).alias("cuts"))
    cut = sides.join(cuts, [*on, "side", "part", "nth"], "left")
    ends = [F.struct(F.expr(t).cast("double").alias("t"), F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y")) for n, t in ((1, "0"), (2, "(x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)"))]
    marks = F.coalesce("cuts", F.array().cast(cut.schema["cuts"].dataType))
    cut = cut.select(*on, "side", "part", "nth", marks.alias("cuts"), F.array_sort(F.array_distinct(F.concat(marks, F.array(*ends)))).alias("p"))
    each = cut.select(*on, "side", "part", "nth", "cuts", "p", F.explode(F.expr("sequence(0, size(p) - 2)")).alias("piece"))
    start, end = F.get("p", F.col("piece")), F.get("p", F.col("piece") + 1)
    pieces = each.select(*on, "side", "part", "nth", "piece", F.array_contains("cuts", start).alias("cut"), start["x"].alias("x1"), start["y"].alias("y1"), end["x"].alias("x2"), end["y"].alias("y2"))
    pieces = pieces.where("x1 <> x2 OR y1 <> y2")

    # Pieces with the same ends are on both polygons.
    p, q = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    ways = [F.max(F.when(F.col("side") == s, F.col("_way"))).alias(f"_way{s}") for s in (0, 1)]
    grouped = pieces.withColumn("_way", (p < q).cast("int")).groupBy(*on, F.least(p, q).alias("_low"), F.greatest(p, q).alias("_high"))
    named = grouped.agg(*ways, F.collect_list(F.struct(*PIECE, "cut", "x1", "y1", "x2", "y2")).alias("_m"))  # one of either side
    on_both = F.when(F.col("_way0").isNull() | F.col("_way1").isNull(), F.lit(None)).when(F.col("_way0") == F.col("_way1"), SAME).otherwise(OPPOSITE)
    named = named.select(*on, on_both.alias("shared"), F.explode("_m").alias("m")).select(*on, "m.*", "shared")

    line = Window.partitionBy(*on, "side", "part").orderBy("nth", "piece")
    runs = stored(named.withColumn("run", F.sum(F.col("cut").cast("long")).over(line)))
    probes = runs.where("shared IS NULL").groupBy(*on, "side", "part", "run").agg(F.min_by(F.struct(((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y")), F.struct("nth", "piece")).alias("m"))
    probes = probes.select(*on, "side", "part", "run", "m.x", "m.y").withColumn("_band", F.floor(F.col("y") / tile))
    walls = sides.where("y1 <> y2").select(*on, (1 - F.col("side")).alias("side"), "x1", "y1", "x2", "y2", F.explode(F.expr(f"sequence(floor(least(y1, y2) / {tile!r}D), floor(greatest(y1, y2) / {tile!r}D))")).alias("_band"))
    hits = probes.join(walls, [*on, "side", "_band"]).where("(y1 > y) <> (y2 > y) AND (x2 - x1) * (y - y1) / (y2 - y1) + x1 > x")
    inside = hits.groupBy(*on, "side", "part", "run").agg((F.count("*") % 2).cast("int").alias("_in"))
    placed = runs.join(inside, [*on, "side", "part", "run"], "left")
    return placed.select(*on, *PIECE, "x1", "y1", "x2", "y2", F.coalesce("shared", "_in", F.lit(OUTSIDE)).alias("place"))


def overlay_areas(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, a, b, both, either, only_a, only_b, iou): areas of the common part, the union and the differences of arranged() pairs."""
    twice = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")

    def total(test: str, sign: int = 1) -> Column:
        return F.coalesce(F.sum(F.when(F.expr(test), sign * twice)), F.lit(0.0)) / 2

    sums = {f"_{s}{p}": total(f"side = {s} AND place = {p}") for s in (0, 1) for p in range(4)}
    out = pieces.groupBy(*keys, "a", "b").agg(*(v.alias(k) for k, v in sums.items()))
    both = F.col(f"_0{INSIDE}") + F.col(f"_1{INSIDE}") + F.col(f"_0{SAME}")
    either = F.col(f"_0{OUTSIDE}") + F.col(f"_1{OUTSIDE}") + F.col(f"_0{SAME}")
    only = [F.col(f"_{s}{OUTSIDE}") - F.col(f"_{1 - s}{INSIDE}") + F.col(f"_{s}{OPPOSITE}") for s in (0, 1)]
    return out.select(*keys, "a", "b", both.alias("both"), either.alias("either"), only[0].alias("only_a"), only[1].alias("only_b"), F.try_divide(both, either).alias("iou"))


def overlay_rings(pieces: DataFrame, keys: Sequence[str], kind: str) -> DataFrame:
    """(keys, a, b, ring, hole, area, points): the rings of the overlay `both`, `either` or `only_a` of arranged() pairs.

    Where several rings touch at a corner each keeps to its own part. Holes have areas below zero.
    """
    on = [*keys, "a", "b"]
    kept = {"both": f"place = {INSIDE} OR side = 0 AND place = {SAME}", "either": f"place = {OUTSIDE} OR side = 0 AND place = {SAME}", "only_a": f"side = 0 AND place IN ({OUTSIDE}, {OPPOSITE}) OR side = 1 AND place = {INSIDE}"}[kind]
    back = F.col("side") == 1 if kind == "only_a" else F.lit(False)
    turned = [F.when(back, F.col(f"{c}{3 - n}")).otherwise(F.col(f"{c}{n}")).alias(f"{c}{n}") for n in (1, 2) for c in "xy"]
    rows = stored(pieces.where(kept).select(*on, F.struct(*PIECE).alias("id"), *turned))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    end = F.struct("id", dx.alias("dx"), dy.alias("dy"))
    none = F.lit(None).cast(rows.select(end.alias("e")).schema["e"].dataType)
    leaving = rows.select(*on, F.col("x1").alias("x"), F.col("y1").alias("y"), end.alias("out"), none.alias("came"))
    coming = rows.select(*on, F.col("x2").alias("x"), F.col("y2").alias("y"), none.alias("out"), end.alias("came"))
    met = leaving.unionByName(coming).groupBy(*on, "x", "y").agg(F.collect_list("out").alias("outs"), F.collect_list("came").alias("ins"))  # the pieces at a corner
    each = met.select(*on, "outs", F.explode("ins").alias("c"))
    c = F.col("c")
    turn = F.transform("outs", lambda o: F.struct(F.atan2(c["dx"] * o["dy"] - c["dy"] * o["dx"], c["dx"] * o["dx"] + c["dy"] * o["dy"]).alias("turn"), o["id"].alias("id")))
    # Straight back is no turn to the left.
    sharp = F.array_max(F.filter(turn, lambda t: F.abs(t["turn"]) < 3.141592653589793))
    links = each.select(*on, c["id"].alias("id"), F.coalesce(sharp["id"], F.get(turn, F.lit(0))["id"]).alias("next"))
    found = rows.join(cycles(links, on), [*on, "id"])
    points = F.array_sort(F.collect_list(F.struct((-F.col("off")).alias("at"), F.col("x1").alias("x"), F.col("y1").alias("y"))))
    rings = found.groupBy(*on, "ring").agg(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")).alias("twice"), points.alias("p"))
    return rings.select(*on, "ring", (F.col("twice") < 0).alias("hole"), (F.col("twice") / 2).alias("area"), F.transform("p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"))


def hausdorff(pairs: DataFrame, polygons: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, a, b, distance): how far a corner of either polygon lies from the other's sides, at most.

    A corner meets all sides of the other polygon of its pair, so work is the product of their numbers
    of sides: for outlines of cells, not of whole tissues.
    """
    on = [*keys, "a", "b"]
    sides = _sides(pairs, polygons, keys)
    corners = sides.select(*on, (1 - F.col("side")).alias("side"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy) / (dx * dx + dy * dy)))
    ex, ey = F.col("x") - F.col("x1") - t * dx, F.col("y") - F.col("y1") - t * dy
    near = corners.join(sides, [*on, "side"]).groupBy(*on, "side", "x", "y").agg(F.min(ex * ex + ey * ey).alias("d"))
    return near.groupBy(*on).agg(F.sqrt(F.max("d")).alias("distance"))


def _ring_sides(ring: Column, sign: int = 1) -> Column:
    """The sides that _sides() makes of a ring, as structs of x1, y1, x2 and y2."""
    ends = F.transform(_edges(_turned(ring, sign)), lambda e: F.struct(*(e[p][c].cast("double").alias(f"{c}{n}") for n, p in ((1, "a"), (2, "b")) for c in "xy")))
    return F.filter(ends, lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is worked out once, not for each element of the arrays that `then` goes through."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def common_area(a: Column, b: Column, holes_a: Column | None = None, holes_b: Column | None = None) -> Column:
    """The area that two rings of a row, less their holes, have in common; rings may run either way and do not cross themselves.

    On a vertical line, the rings' sides of either sign cancel out, so that minus half the sum of their signed
    distances is the length that both hold; areas are the sums of these over every two sides. Work is the product
    of the numbers of sides.
    """
    p, q = bounds(a), bounds(b)
    apart = (p["x1"] <= q["x0"]) | (q["x1"] <= p["x0"]) | (p["y1"] <= q["y0"]) | (q["y1"] <= p["y0"])

    def lines(ring: Column, holes: Column | None) -> Column:
        sides = _ring_sides(ring)
        if holes is not None:
            sides = F.concat(sides, F.flatten(F.transform(F.filter(holes, lambda h: F.size(h) >= 3), lambda h: _ring_sides(h, -1))))
        leaning = F.filter(sides, lambda e: e["x1"] != e["x2"])
        slope = lambda e: (e["y2"] - e["y1"]) / (e["x2"] - e["x1"])
        return F.transform(leaning, lambda e: F.struct(e["x1"].alias("x"), e["y1"].alias("y"), F.least(e["x1"], e["x2"]).alias("low"), F.greatest(e["x1"], e["x2"]).alias("high"), F.signum(e["x2"] - e["x1"]).alias("way"), slope(e).alias("slope")))

    def between(e: Column, f: Column) -> Column:
        low, high = F.greatest(e["low"], f["low"]), F.least(e["high"], f["high"])
        d, g = ((e["y"] + (x - e["x"]) * e["slope"]) - (f["y"] + (x - f["x"]) * f["slope"]) for x in (low, high))
        met = (d * d + g * g) / (F.abs(d) + F.abs(g))
        return F.when(low < high, e["way"] * f["way"] * (high - low) * F.when(d * g >= 0, F.abs(d + g)).otherwise(met) / 2).otherwise(F.lit(0.0))

    total = _once(lines(b, holes_b), lambda held: F.aggregate(lines(a, holes_a), F.lit(0.0), lambda s, e: F.aggregate(held, s, lambda u, f: u + between(e, f))))
    return F.when(apart, F.lit(0.0)).otherwise(F.greatest(-total / 2, F.lit(0.0)))


def common_areas(pairs: DataFrame, polygons: DataFrame, keys: Sequence[str], tile: float = 64.0) -> DataFrame:
    """(keys, a, b, both): the areas that the polygons of pairs have in common, in a row or, over ROW_SIDES, by arranged()."""
    keys = list(keys)
    whole = polygons.where(F.size("ring") >= 3).select(*keys, "polygon", "ring", _holes(polygons).alias("holes"))
    met = pairs.select(*keys, "a", "b").distinct()
    for c in "ab":
        met = met.join(whole.select(*keys, F.col("polygon").alias(c), F.col("ring").alias(f"_{c}"), F.col("holes").alias(f"_holes_{c}")).hint("merge"), [*keys, c])
    sides = [F.size(f"_{c}") + F.aggregate(f"_holes_{c}", F.lit(0), lambda n, h: n + F.size(h)) for c in "ab"]
    met = met.withColumn("_large", sides[0].cast("long") * sides[1] > ROW_SIDES)
    both = F.when(~F.col("_large"), common_area(F.col("_a"), F.col("_b"), F.col("_holes_a"), F.col("_holes_b")))
    met = stored(met.select(*keys, "a", "b", "_large", both.alias("both")))
    large, small = met.where("_large").select(*keys, "a", "b"), met.where("NOT _large").select(*keys, "a", "b", "both")
    if large.isEmpty():
        return small
    return small.unionByName(overlay_areas(arranged(large, polygons, keys, tile), keys).select(*keys, "a", "b", "both"))


def ring_hausdorff(a: Column, b: Column) -> Column:
    """hausdorff() of two rings of a row. Work is the product of the numbers of sides."""

    def far(corners: Column, sides: Column) -> Column:
        spans = F.transform(sides, lambda s: F.struct(s["x1"].alias("x"), s["y1"].alias("y"), (s["x2"] - s["x1"]).alias("dx"), (s["y2"] - s["y1"]).alias("dy")))

        def nearest(c: Column, held: Column) -> Column:
            at = F.transform(held, lambda s: F.struct(s.alias("s"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((c["x1"] - s["x"]) * s["dx"] + (c["y1"] - s["y"]) * s["dy"]) / (s["dx"] * s["dx"] + s["dy"] * s["dy"]))).alias("t")))
            off = F.transform(at, lambda n: F.struct((c["x1"] - n["s"]["x"] - n["t"] * n["s"]["dx"]).alias("x"), (c["y1"] - n["s"]["y"] - n["t"] * n["s"]["dy"]).alias("y")))
            return F.array_min(F.transform(off, lambda o: o["x"] * o["x"] + o["y"] * o["y"]))

        return _once(spans, lambda held: F.array_max(F.transform(corners, lambda c: nearest(c, held))))

    one, two = _ring_sides(a), _ring_sides(b)
    return F.sqrt(F.greatest(far(one, two), far(two, one)))

"""Polygons as arrays of points (structs of x and y), by higher-order functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _edges(ring: Column) -> Column:
    """(a, b) of every side; the last point is joined to the first."""
    n = F.size(ring)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, (i + 1) % n).alias("b")))


def area(ring: Column) -> Column:
    """Half the absolute sum of cross products; 0 under three points."""
    twice = F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    return F.when(F.size(ring) >= 3, F.abs(twice) / 2.0).otherwise(F.lit(0.0))


def bounds(ring: Column) -> Column:
    """Struct of x0, y0, x1 and y1."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def moved(ring: Column, dx: float = 0.0, dy: float = 0.0, scale: float = 1.0) -> Column:
    return F.transform(ring, lambda p: F.struct((p["x"] * scale + dx).alias("x"), (p["y"] * scale + dy).alias("y")))


def inside(ring: Column, x: Column, y: Column) -> Column:
    """Whether a ray to the right crosses an odd number of sides."""

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        straddles = (a["y"] > y) != (b["y"] > y)
        at = (b["x"] - a["x"]) * (y - a["y"]) / F.when(b["y"] == a["y"], F.lit(1e-12)).otherwise(b["y"] - a["y"]) + a["x"]
        return straddles & (x < at)

    return (F.size(ring) >= 3) & (F.size(F.filter(_edges(ring), crosses)) % 2 == 1)


def on_edge(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point lies on a side."""

    def lies(e: Column) -> Column:
        a, b = e["a"], e["b"]
        cross = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        return (cross == 0) & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    return F.exists(_edges(ring), lies)


def crosses_itself(ring: Column) -> Column:
    """Whether two sides without a common end share a point, or two neighbours run back over each other; sides without length count as points."""
    edges = F.transform(_edges(ring), lambda e, i: F.struct(e["a"].alias("a"), e["b"].alias("b"), i.alias("i")))

    def side(p: Column, q: Column, r: Column) -> Column:
        return F.signum((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))

    def near(e: Column, f: Column, c: str) -> Column:
        return (F.least(e["a"][c], e["b"][c]) <= F.greatest(f["a"][c], f["b"][c])) & (F.least(f["a"][c], f["b"][c]) <= F.greatest(e["a"][c], e["b"][c]))

    def meet(e: Column, f: Column) -> Column:
        apart = (f["i"] > e["i"] + 1) & ~((e["i"] == 0) & (f["i"] == F.size(ring) - 1))
        return apart & near(e, f, "x") & near(e, f, "y") & (side(e["a"], e["b"], f["a"]) * side(e["a"], e["b"], f["b"]) <= 0) & (side(f["a"], f["b"], e["a"]) * side(f["a"], f["b"], e["b"]) <= 0)

    def back(e: Column, f: Column) -> Column:
        follows = (f["i"] == (e["i"] + 1) % F.size(ring)) & (F.size(ring) > 2)
        dot = (e["b"]["x"] - e["a"]["x"]) * (f["b"]["x"] - f["a"]["x"]) + (e["b"]["y"] - e["a"]["y"]) * (f["b"]["y"] - f["a"]["y"])
        return follows & (side(e["a"], e["b"], f["b"]) == 0) & (dot < 0)

    return F.exists(edges, lambda e: F.exists(edges, lambda f: meet(e, f) | back(e, f)))


def points_in_polygons(points: DataFrame, polygons: DataFrame, keys: Sequence[str], tile: int, edge_counts: bool = False) -> DataFrame:
    """Points with every polygon (polygon, ring) that holds them, by way of the tiles of its bounds.

    Points on a side are out, unless `edge_counts`.
    """
    boxed = polygons.withColumn("_b", bounds(F.col("ring")))
    spread = boxed.withColumn("_tx", F.explode(F.expr(f"sequence(floor(_b.x0 / {tile}), floor(_b.x1 / {tile}))")))
    spread = spread.withColumn("_ty", F.explode(F.expr(f"sequence(floor(_b.y0 / {tile}), floor(_b.y1 / {tile}))")))
    placed = points.withColumn("_tx", F.floor(F.col("x") / tile)).withColumn("_ty", F.floor(F.col("y") / tile))
    met = placed.join(spread, [*keys, "_tx", "_ty"]).where("x >= _b.x0 AND x <= _b.x1 AND y >= _b.y0 AND y <= _b.y1")
    x, y, ring = F.col("x"), F.col("y"), F.col("ring")
    test = inside(ring, x, y)
    test = test | on_edge(ring, x, y) if edge_counts else test & ~on_edge(ring, x, y)
    return met.where(test).drop("_tx", "_ty", "_b")


def one_polygon(met: DataFrame, keys: Sequence[str], overlap: str = "smallest") -> DataFrame:
    """(keys, polygon): the polygon of each point of points_in_polygons(), where several hold it: the smallest, or an error.

    overlap: 'smallest' takes the one of least area, ties to the smaller polygon; 'error' raises. keys name a point.
    """
    if overlap not in ("smallest", "error"):
        raise ValueError("overlaps are settled by the smallest or are errors")
    sized = met.select(*keys, "polygon", area(F.col("ring")).alias("_area"))
    best = sized.groupBy(*keys).agg(F.min(F.struct("_area", "polygon")).alias("_m"), F.count("*").alias("_n"))
    if overlap == "error":
        best = best.where(F.assert_true(F.col("_n") == 1, F.lit("polygons overlap at a point")).isNull())
    return best.select(*keys, F.col("_m.polygon").alias("polygon"))


def rasterised(polygons: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, polygon, y, x): pixels whose centres lie in a polygon."""

    def straddles(e: Column) -> Column:
        return (e["a"]["y"] > F.col("y") + 0.5) != (e["b"]["y"] > F.col("y") + 0.5)

    def at(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return (b["x"] - a["x"]) * (F.col("y") + 0.5 - a["y"]) / (b["y"] - a["y"]) + a["x"]

    # A row of pixels is filled between its first and second crossing, third and fourth, and so on.
    boxed = polygons.where(F.size("ring") >= 3).withColumn("_b", bounds(F.col("ring")))
    rows = boxed.withColumn("y", F.explode(F.expr("sequence(CAST(floor(_b.y0) AS INT), CAST(ceil(_b.y1) AS INT))")))
    rows = rows.withColumn("_c", F.array_sort(F.transform(F.filter(_edges(F.col("ring")), straddles), at))).where(F.size("_c") > 0)
    spans = rows.select(*keys, "polygon", "y", "_c", F.explode(F.expr("sequence(1, size(_c) - 1, 2)")).alias("_i"))
    ends = [F.ceil(F.element_at("_c", F.col("_i") + k) - 0.5).cast("int") for k in (0, 1)]
    spans = spans.select(*keys, "polygon", "y", ends[0].alias("_from"), (ends[1] - 1).alias("_to")).where("_from <= _to")
    return spans.select(*keys, "polygon", "y", F.explode(F.sequence("_from", "_to")).alias("x"))


def features(documents: DataFrame, column: str) -> DataFrame:
    """GeoJSON feature collections as polygons: (name, part, ring, area), multi-polygons in parts.

    Only outer rings are kept; parts are numbered by falling area, then by their bounds.
    """
    shape = "struct<type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"
    parsed = documents.select(F.explode(F.from_json(F.get_json_object(column, "$.features"), f"array<{shape}>")).alias("f"))
    deep = F.from_json(F.col("f.geometry.coordinates"), "array<array<array<array<double>>>>")
    flat = F.array(F.from_json(F.col("f.geometry.coordinates"), "array<array<array<double>>>"))
    parts = F.when(F.col("f.geometry.type") == "MultiPolygon", deep).when(F.col("f.geometry.type") == "Polygon", flat)
    named = F.coalesce(F.col("f.properties")["classification"], F.col("f.properties")["name"], F.lit("unnamed"))
    rings = parsed.select(named.alias("name"), F.explode(parts).alias("p")).select("name", F.transform(F.get("p", F.lit(0)), lambda q: F.struct(q[0].alias("x"), q[1].alias("y"))).alias("ring"))
    rings = rings.withColumn("area", area(F.col("ring"))).withColumn("_b", bounds(F.col("ring")))
    order = Window.partitionBy("name").orderBy(F.desc("area"), "_b")
    return rings.withColumn("part", F.row_number().over(order)).select("name", "part", "ring", "area")


def net_area(ring: Column, holes: Column) -> Column:
    """A ring's area less its holes', at least 0; null holes are none."""
    return F.greatest(area(ring) - F.aggregate(F.coalesce(holes, F.array()), F.lit(0.0), lambda s, h: s + area(h)), F.lit(0.0))


def sampled_boundary(polygons: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """(keys, polygon, k, x, y): `n` points at equal steps of length along a ring, from its first corner on.

    A ring without length has no points.
    """
    line = Window.partitionBy(*keys, "polygon")
    sides = polygons.where(F.size("ring") > 0).select(*keys, "polygon", F.posexplode(_edges(F.col("ring"))).alias("i", "e"))
    dx, dy = F.col("e.b.x") - F.col("e.a.x"), F.col("e.b.y") - F.col("e.a.y")
    sides = sides.withColumn("_l", F.sqrt(dx * dx + dy * dy)).withColumn("_end", F.sum("_l").over(line.orderBy("i")))
    sides = sides.withColumn("_start", F.coalesce(F.lag("_end").over(line.orderBy("i")), F.lit(0.0))).withColumn("_all", F.max("_end").over(line))
    first, last = (F.ceil(F.col(c) * n / F.col("_all")) for c in ("_start", "_end"))
    held = sides.where("_l > 0").withColumn("_from", first).withColumn("_to", last - 1).where("_from <= _to")
    placed = held.withColumn("k", F.explode(F.sequence("_from", "_to"))).withColumn("_t", (F.col("k") * F.col("_all") / n - F.col("_start")) / F.col("_l"))
    return placed.select(*keys, "polygon", "k", (F.col("e.a.x") + F.col("_t") * dx).alias("x"), (F.col("e.a.y") + F.col("_t") * dy).alias("y"))


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes (structs of x0, y0, x1 and y1); null if both are empty."""
    shared = F.lit(1.0)
    for low, high in (("x0", "x1"), ("y0", "y1")):
        shared = shared * F.greatest(F.least(a[high], b[high]) - F.greatest(a[low], b[low]), F.lit(0.0))
    sizes = [(c["x1"] - c["x0"]) * (c["y1"] - c["y0"]) for c in (a, b)]
    return F.try_divide(shared, sizes[0] + sizes[1] - shared)


def box_hausdorff(a: Column, b: Column) -> Column:
    """The Hausdorff distance of two boxes: how far a corner of either lies from the other."""

    def out(p: Column, q: Column) -> Column:
        x, y = (F.greatest(q[low] - p[low], p[high] - q[high], F.lit(0.0)) for low, high in (("x0", "x1"), ("y0", "y1")))
        return F.sqrt(x * x + y * y)

    return F.greatest(out(a, b), out(b, a))


def first_bounds(ring: Column, box: Column, x: Column, y: Column) -> Column:
    """The bounds of a contour of three points or more, else of a box, else of a point; bounds the wrong way round are an error."""
    point = F.struct(x.alias("x0"), y.alias("y0"), x.alias("x1"), y.alias("y1"))
    found = F.coalesce(F.when(F.size(ring) >= 3, bounds(ring)), box, point)
    return F.when((found["x0"] > found["x1"]) | (found["y0"] > found["y1"]), F.raise_error(F.lit("reversed bounds"))).otherwise(found)

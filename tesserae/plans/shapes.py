"""Queries over contours of masks, overlays and simplified rings, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import constraints, contours, geometry, joins, overlay, raster
from .frames import CELLS, RASTER, cells, pixels
from .frames import raster as label_raster

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# What patterns of four pixels around a corner say of a mask: its corners, and its parts less its holes.
_PATTERNS = """w AS (SELECT sample_id, label, n = 1 AS one, n = 3 AS three, n = 2 AND far AS across FROM (
  SELECT sample_id, label, y + dy AS vy, x + dx AS vx, count(*) AS n, sum(CASE WHEN dy = dx THEN 1 ELSE -1 END) IN (2, -2) AS far
  FROM r, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(dy, dx) GROUP BY ALL)),
s AS (SELECT sample_id, label, count(*) FILTER (one) AS q1, count(*) FILTER (three) AS q3, count(*) FILTER (across) AS q2 FROM w GROUP BY ALL),
e AS (SELECT sample_id, label, count(*) FILTER (n = 1) AS sides FROM (SELECT sample_id, label, u, y + dy AS y, x + dx AS x, count(*) AS n FROM r, (VALUES (0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 0, 1)) v(u, dy, dx) GROUP BY ALL) GROUP BY ALL),
a AS (SELECT sample_id, label, count(*) AS area FROM r GROUP BY ALL)"""


@query(f"""WITH {RASTER}, r AS (SELECT * FROM raster), {_PATTERNS}
SELECT sample_id, label, CAST(area AS DOUBLE) AS area, sides, q1 + q3 + 2 * q2 AS corners, (q1 - q3 - 2 * q2) // 4 AS parts_less_holes FROM a JOIN s USING (sample_id, label) JOIN e USING (sample_id, label)""")
def mask_contours(spark, sf_dir):
    """Areas, sides, corners and the number of rings around regions less that around holes, of all labels' contours."""
    found = contours.contours(label_raster(spark, sf_dir), ["sample_id"])
    return found.groupBy("sample_id", "label").agg(F.sum("area").alias("area"), F.sum("sides").alias("sides"), F.sum(F.size("points").cast("long")).alias("corners"), F.sum(F.when(F.col("hole"), -1).otherwise(1)).alias("parts_less_holes"))


@query(f"""WITH {RASTER}, r AS (SELECT sample_id, y, x, label % 3 + 1 AS label FROM raster WHERE label < 6), {_PATTERNS}
SELECT sample_id, label AS value, CAST(area AS DOUBLE) AS area, q1 + q3 + 2 * q2 AS corners, (q1 - q3 - 2 * q2) // 4 AS parts_less_holes FROM a JOIN s USING (sample_id, label)""")
def dissolved_values(spark, sf_dir):
    """Regions of labels that share a value as polygons with holes; two labels have no value."""
    values = spark.range(1, 6).select(F.col("id").cast("int").alias("label"), F.expr("CAST(id % 3 + 1 AS INT)").alias("value"))
    found = contours.dissolved(label_raster(spark, sf_dir), ["sample_id"], values)
    corners = F.size("ring") + F.aggregate("holes", F.lit(0), lambda n, h: n + F.size(h))
    return found.groupBy("sample_id", "value").agg(F.sum("area").alias("area"), F.sum(corners.cast("long")).alias("corners"), F.sum((1 - F.size("holes")).cast("long")).alias("parts_less_holes"))


def _nuclei(spark, sf_dir):
    return pixels(spark, sf_dir).where("nucleus > 0").groupBy("sample_id", "y", "x").agg(F.min(F.expr("nucleus % 3 + 1")).alias("label"))


def _overlapping(a, b, keys, tile):
    """Pairs of polygons whose bounds share a tile."""

    def spread(df, name):
        box = df.select(*keys, F.col("polygon").alias(name), geometry.bounds(F.col("ring")).alias("_b"))
        rows = box.withColumn("_tx", F.explode(F.expr(f"sequence(floor(_b.x0 / {tile}), floor(_b.x1 / {tile}))")))
        return rows.withColumn("_ty", F.explode(F.expr(f"sequence(floor(_b.y0 / {tile}), floor(_b.y1 / {tile}))"))).withColumnRenamed("_b", f"_{name}")

    met = spread(a, "a").join(spread(b, "b").hint("merge"), [*keys, "_tx", "_ty"])
    return met.where("_a.x0 < _b.x1 AND _b.x0 < _a.x1 AND _a.y0 < _b.y1 AND _b.y0 < _a.y1").select(*keys, "a", "b").distinct()


@query(f"""WITH {RASTER}, n AS (SELECT sample_id, y, x, min(nucleus % 3 + 1) AS label FROM pixels WHERE nucleus > 0 GROUP BY sample_id, y, x)
SELECT sample_id, raster.label AS label_a, n.label AS label_b, CAST(count(*) AS DOUBLE) AS both FROM raster JOIN n USING (sample_id, y, x) GROUP BY ALL""")
def polygon_overlaps(spark, sf_dir):
    """Exact common areas of two masks' polygons; of pixels' outlines they are the pixels that both have."""
    a = contours.polygons(label_raster(spark, sf_dir), ["sample_id"], eight=False).withColumn("polygon", F.col("polygon") * 16 + F.col("label"))
    b = contours.polygons(_nuclei(spark, sf_dir), ["sample_id"], eight=False).withColumn("polygon", -1 - F.col("polygon") * 16 - F.col("label"))
    pairs = _overlapping(a, b, ["sample_id"], 8)
    found = overlay.common_areas(pairs, a.unionByName(b), ["sample_id"], 8.0)
    labels = found.select("sample_id", (F.col("a") % 16).cast("int").alias("label_a"), ((-1 - F.col("b")) % 16).cast("int").alias("label_b"), "both")
    return labels.where("both > 0").groupBy("sample_id", "label_a", "label_b").agg(F.sum("both").alias("both"))


@query(f"""WITH {RASTER}, r AS (SELECT sample_id, y, x, 1 AS label FROM raster), {_PATTERNS}
SELECT sample_id, CAST(area AS DOUBLE) AS area, q1 + q3 + 2 * q2 AS corners FROM a JOIN s USING (sample_id, label)""")
def thinned_outlines(spark, sf_dir):
    """Outlines of all tissue, thinned by areas that no corner falls short of: nothing changes but in the middle of straight runs."""
    found = contours.contours(label_raster(spark, sf_dir).withColumn("label", F.lit(1)), ["sample_id"])
    found = contours.simplified(found, "points", area=0.25, tolerance=0.25)
    return found.groupBy("sample_id").agg(F.sum(F.when(F.col("hole"), -1).otherwise(1) * geometry.area(F.col("points"))).alias("area"), F.sum(F.size("points").cast("long")).alias("corners"))


@query()
def simplified_tissue(spark, sf_dir):
    """Tissue polygons of eight pixels or more, holes filled, their outlines thinned; tested against loops."""
    found = contours.polygons(label_raster(spark, sf_dir).withColumn("label", F.lit(1)), ["sample_id"])
    found = contours.simplified(contours.cleaned(found, 8.0, fill=True), "ring", area=1.0, tolerance=1.0)
    return found.select("sample_id", "polygon", "area", geometry.area(F.col("ring")).alias("outlined"), F.size("ring").cast("long").alias("corners"))


@query()
def unique_seeds(spark, sf_dir):
    """A pixel of its own for every cell on an image of 128 by 128, in the order of their ids; tested against a loop."""
    c = cells(spark, sf_dir).select("sample_id", F.col("cell_id").alias("id"), F.col("cell_id").alias("order"), (F.col("x") / 8).alias("x"), (F.col("y") / 8).alias("y"))
    return raster.seed_pixels(c, ["sample_id"], 128, 128)


@query()
def snapped_boundaries(spark, sf_dir):
    """Squares of labels whose boundaries move to where the score is highest; tested against a flood of the whole image."""
    p = pixels(spark, sf_dir).groupBy("sample_id", "y", "x").agg(F.max("score").alias("g"))
    labels = p.select("sample_id", "y", "x", F.expr("CAST((y div 16) * 4 + x div 16 + 1 AS INT)").alias("label"))
    return raster.snapped(labels, p, ["sample_id"], 3, 32)


_RINGS = """c(k, i, dx, dy) AS (VALUES (0, 0, 0, 0), (0, 1, 8, 0), (0, 2, 8, 8), (0, 3, 0, 8), (1, 0, 0, 0), (1, 1, 8, 8), (1, 2, 8, 0), (1, 3, 0, 8),
  (2, 0, 0, 0), (2, 1, 8, 0), (2, 2, 4, 0), (2, 3, 0, 8), (3, 0, 0, 0), (3, 1, 8, 0), (3, 2, 4, 4), (3, 3, 0, 8), (4, 0, 0, 0), (4, 1, 8, 4), (4, 2, 0, 8), (4, 3, 4, 2)),
s AS (SELECT sample_id, cell_id, kind, a.i, x + a.dx AS ax, y + a.dy AS ay, x + b.dx AS bx, y + b.dy AS by_ FROM cells, c a JOIN c b ON a.k = b.k AND b.i = (a.i + 1) % 4 WHERE a.k = kind - 1),
t AS (SELECT e.cell_id, e.i AS i, f.i AS j, e.ax AS ax, e.ay AS ay, e.bx AS bx, e.by_ AS by_, f.ax AS cx, f.ay AS cy, f.bx AS dx, f.by_ AS dy FROM s e JOIN s f ON e.cell_id = f.cell_id),
o AS (SELECT *, sign((bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax)) AS o1, sign((bx - ax) * (dy - ay) - (by_ - ay) * (dx - ax)) AS o2, sign((dx - cx) * (ay - cy) - (dy - cy) * (ax - cx)) AS o3, sign((dx - cx) * (by_ - cy) - (dy - cy) * (bx - cx)) AS o4 FROM t),
h AS (SELECT cell_id, bool_or(j > i + 1 AND j - i < 3 AND o1 * o2 <= 0 AND o3 * o4 <= 0 AND least(ax, bx) <= greatest(cx, dx) AND least(cx, dx) <= greatest(ax, bx) AND least(ay, by_) <= greatest(cy, dy) AND least(cy, dy) <= greatest(ay, by_)
  OR j = (i + 1) % 4 AND o2 = 0 AND (bx - ax) * (dx - cx) + (by_ - ay) * (dy - cy) < 0) AS crosses FROM o GROUP BY cell_id)"""


@query(f"WITH {CELLS}, {_RINGS} SELECT sample_id, kind, count(*) AS n, count(*) FILTER (crosses) AS crossing FROM cells JOIN h USING (cell_id) GROUP BY ALL")
def crossing_rings(spark, sf_dir):
    """Rings that are simple, cross themselves, run back over themselves, bend inwards, or touch a side with a corner, by the cell's kind."""
    shapes = {1: [(0, 0), (8, 0), (8, 8), (0, 8)], 2: [(0, 0), (8, 8), (8, 0), (0, 8)], 3: [(0, 0), (8, 0), (4, 0), (0, 8)], 4: [(0, 0), (8, 0), (4, 4), (0, 8)], 5: [(0, 0), (8, 4), (0, 8), (4, 2)]}
    ring = F.lit(None)
    for kind, corners in shapes.items():
        ring = F.when(F.col("kind") == kind, F.array(*(F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y")) for dx, dy in corners))).otherwise(ring)
    found = cells(spark, sf_dir).withColumn("ring", ring).withColumn("crosses", geometry.crosses_itself(F.col("ring")))
    return found.groupBy("sample_id", "kind").agg(F.count("*").alias("n"), F.count_if("crosses").alias("crossing"))


@query(f"""WITH {CELLS}, b AS (SELECT sample_id, cell_id, x AS x0, y AS y0, x + area / 4.0 AS x1, y + kind * 3.0 AS y1 FROM cells)
SELECT a.sample_id, a.cell_id AS a, c.cell_id AS b FROM b a JOIN b c ON a.sample_id = c.sample_id AND a.cell_id < c.cell_id AND a.x0 < c.x1 AND c.x0 < a.x1 AND a.y0 < c.y1 AND c.y0 < a.y1""")
def overlapping_boxes(spark, sf_dir):
    """Boxes that overlap any other, in whatever row or column they start."""
    c = cells(spark, sf_dir)
    boxes = c.select("sample_id", F.col("cell_id").alias("label"), F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + F.col("area") / 4.0).alias("x1"), (F.col("y") + F.col("kind") * 3.0).alias("y1"))
    return constraints.overlapping_boxes(boxes, ["sample_id"], 16)


@query(f"""WITH {CELLS}, t AS (SELECT sample_id, cell_id AS polygon, x, y, 20.0 * (1 + cell_id % 3) AS h FROM cells WHERE cell_id % 40 = 0),
m AS (SELECT c.sample_id, c.cell_id, t.polygon, h FROM cells c JOIN t ON c.sample_id = t.sample_id AND abs(c.x - t.x) + abs(c.y - t.y) < h)
SELECT sample_id, cell_id, arg_min(polygon, (h, polygon)) AS polygon FROM m GROUP BY ALL""")
def smallest_polygons(spark, sf_dir):
    """Cells with the smallest of the diamonds that hold them; diamonds of three sizes stand around every fortieth cell."""
    c = cells(spark, sf_dir)
    half = 20.0 * (1 + F.col("cell_id") % 3)
    ring = F.array(*(F.struct((F.col("x") + dx * half).alias("x"), (F.col("y") + dy * half).alias("y")) for dx, dy in ((1, 0), (0, 1), (-1, 0), (0, -1))))
    diamonds = c.where("cell_id % 40 = 0").select("sample_id", F.col("cell_id").alias("polygon"), ring.alias("ring"))
    met = geometry.points_in_polygons(c.select("sample_id", "cell_id", "x", "y"), diamonds, ["sample_id"], 64)
    return geometry.one_polygon(met, ["sample_id", "cell_id"])


@query(f"""WITH {CELLS} SELECT kind, CASE kind WHEN 1 THEN 'urgent' WHEN 2 THEN 'high' WHEN 3 THEN 'medium' WHEN 4 THEN 'unset' WHEN 5 THEN 'low' END AS name, count(*) AS n FROM cells GROUP BY ALL""")
def known_kinds(spark, sf_dir):
    """Kinds by name, none of which may be missing."""
    names = spark.createDataFrame([(1, "urgent"), (2, "high"), (3, "medium"), (4, "unset"), (5, "low")], "kind int, name string")
    return joins.look_up_known(cells(spark, sf_dir), names, "kind", "name").groupBy("kind", "name").agg(F.count("*").alias("n"))

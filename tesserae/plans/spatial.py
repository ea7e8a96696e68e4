"""Queries over cells and rasters, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import aggregates as agg
from ..operators import constraints, geometry, graph, joins, ordered, raster
from ..operators.graph import stored
from .frames import CELLS, PIXELS, RASTER, SIDE, cells, pixels, table, tissue
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


@query(f"""WITH {PIXELS} SELECT sample_id, label, count(*) AS area, CAST(sum(x) AS BIGINT) AS sum_x, CAST(sum(y) AS BIGINT) AS sum_y, min(x) AS x0, max(x) + 1 AS x1, min(y) AS y0, max(y) + 1 AS y1,
  CAST(sum(score) AS BIGINT) AS score_sum, max(score) AS score_max, CAST(sum(other) AS BIGINT) AS other_sum, max(other) AS other_max FROM pixels WHERE label <> 0 GROUP BY ALL""")
def zonal_stats(spark, sf_dir):
    return agg.zonal(pixels(spark, sf_dir), ["sample_id"], ["score", "other"])


@query(f"""WITH {PIXELS} SELECT sample_id, label, count(*) AS area, CAST(sum(x) AS BIGINT) AS sum_x, CAST(sum(y) AS BIGINT) AS sum_y, min(x) AS x0, max(x) + 1 AS x1, min(y) AS y0, max(y) + 1 AS y1,
  CAST(sum(score) AS BIGINT) AS score_sum, max(score) AS score_max FROM pixels WHERE label <> 0 AND nucleus = 0 GROUP BY ALL""")
def zonal_outside_nucleus(spark, sf_dir):
    return agg.zonal_outside(pixels(spark, sf_dir), ["sample_id"], ["score"])


@query(f"""WITH {PIXELS}, s AS (SELECT sample_id, label, count(*) AS area, sum(score) AS s1, max(score) AS m1, sum(other) AS s2, max(other) AS m2 FROM pixels WHERE label <> 0 GROUP BY ALL)
SELECT sample_id, label, area, 'score' AS marker, CAST(s1 AS BIGINT) AS sum, m1 AS max, s1 / area AS mean FROM s UNION ALL SELECT sample_id, label, area, 'other', CAST(s2 AS BIGINT), m2, s2 / area FROM s""")
def zonal_long(spark, sf_dir):
    return agg.long_to_wide(agg.zonal(pixels(spark, sf_dir), ["sample_id"], ["score", "other"]), ["sample_id"], ["score", "other"])


@query(f"WITH {PIXELS} SELECT sample_id, label, count(*) AS area, avg(x) AS cx, avg(y) AS cy FROM pixels WHERE label <> 0 GROUP BY ALL")
def label_centroids(spark, sf_dir):
    return pixels(spark, sf_dir).where("label <> 0").groupBy("sample_id", "label").agg(F.count("*").alias("area"), F.avg("x").alias("cx"), F.avg("y").alias("cy"))


_GRID = """grid AS (SELECT sample_id, (gy * 16 + gx + 1) AS label, gx * 64 AS x0, gy * 64 AS y0 FROM (SELECT DISTINCT sample_id FROM cells), range(16) a(gx), range(16) b(gy))"""


@query(f"WITH {CELLS}, {_GRID} SELECT c.sample_id, g.label, count(*) AS n, sum(c.area)::BIGINT AS area FROM cells c JOIN grid g ON c.sample_id = g.sample_id AND floor(c.x / 64) * 64 = g.x0 AND floor(c.y / 64) * 64 = g.y0 GROUP BY ALL")
def lattice_counts(spark, sf_dir):
    c = cells(spark, sf_dir)
    grid = raster.lattice(c, ["sample_id"], SIDE, SIDE, 64).select("sample_id", "label", "x0", "y0")
    return joins.lattice_join(c, grid, ["sample_id"], 64).groupBy("sample_id", "label").agg(F.count("*").alias("n"), F.sum("area").alias("area"))


def _boxes(spark, sf_dir):
    return cells(spark, sf_dir).where("kind = 1").select("sample_id", F.col("cell_id").alias("box"), F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + F.col("area") + 0.5).alias("x1"), (F.col("y") + 20).alias("y1"))


_BOXES = "boxes AS (SELECT sample_id, cell_id AS box, x AS x0, y AS y0, x + area + 0.5 AS x1, y + 20 AS y1 FROM cells WHERE kind = 1)"


@query(f"WITH {CELLS}, {_BOXES} SELECT b.sample_id, b.box, count(*) AS n, min(c.cell_id) AS first FROM cells c JOIN boxes b ON c.sample_id = b.sample_id AND c.x >= x0 AND c.x < x1 AND c.y >= y0 AND c.y < y1 GROUP BY ALL")
def box_counts(spark, sf_dir):
    c = cells(spark, sf_dir).select("sample_id", "cell_id", "x", "y")
    return joins.box_join(c, _boxes(spark, sf_dir), ["sample_id"], 64).groupBy("sample_id", "box").agg(F.count("*").alias("n"), F.min("cell_id").alias("first"))


def _points(spark, sf_dir):
    return cells(spark, sf_dir).select("sample_id", F.col("cell_id").alias("id"), "source", "x", "y")


_PAIRS = "pairs AS (SELECT a.sample_id, a.cell_id AS a, b.cell_id AS b, a.source AS sa, b.source AS sb, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM cells a JOIN cells b ON a.sample_id = b.sample_id AND a.cell_id <> b.cell_id WHERE abs(a.x - b.x) < 24 AND abs(a.y - b.y) < 24)"


@query(f"WITH {CELLS}, {_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY sample_id, a, sb ORDER BY round(d, 9), b) AS rank FROM pairs WHERE d < 24 AND sa < sb) SELECT sample_id, a, b, sa AS source_a, sb AS source_b, round(d, 9) AS d, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 4")
def nearest_of_sources(spark, sf_dir):
    found = joins.nearest_of_sources(_points(spark, sf_dir), ["sample_id"], 24.0, 4)
    return found.select("sample_id", "a", "b", "source_a", "source_b", F.round("d", 9).alias("d"), "rank")


@query()
def fused_instances(spark, sf_dir):
    """Greedy unions of all pairs within the radius have no SQL; their rows are tested against a replay."""
    points = _points(spark, sf_dir)
    near = joins.near_pairs(points, ["sample_id"], 24.0, ["source"]).where("source_a < source_b")
    return graph.greedy_union(near, points, ["sample_id"])


@query(f"""WITH RECURSIVE {CELLS}, {_PAIRS}, e AS (SELECT DISTINCT sample_id, a, b FROM pairs WHERE d < 12),
walk AS (SELECT DISTINCT sample_id, a AS node, a AS reach FROM e UNION SELECT walk.sample_id, walk.node, e.b FROM walk JOIN e ON walk.sample_id = e.sample_id AND walk.reach = e.a)
SELECT sample_id, node, min(reach) AS component FROM walk GROUP BY ALL""")
def point_components(spark, sf_dir):
    edges = joins.near_pairs(_points(spark, sf_dir), ["sample_id"], 12.0).where("a < b")
    return graph.components(edges.select("sample_id", F.col("a").alias("src"), F.col("b").alias("dst")), ["sample_id"])


@query(f"WITH {CELLS}, {_PAIRS} SELECT sample_id, count(*) AS n_pairs, round(avg(d), 6) AS mean_d FROM pairs WHERE d < 24 AND a < b GROUP BY ALL")
def pair_distances(spark, sf_dir):
    return joins.near_pairs(_points(spark, sf_dir), ["sample_id"], 24.0).where("a < b").groupBy("sample_id").agg(F.count("*").alias("n_pairs"), F.round(F.avg("d"), 6).alias("mean_d"))


@query(f"""WITH {CELLS}, l AS (SELECT s_suppkey AS landmark, (s_suppkey * 7919 % 8192) / 8.0 AS x, (s_suppkey * 104729 % 8192) / 8.0 AS y, s_suppkey % 6 AS cluster FROM supplier),
n AS (SELECT cell_id AS id, landmark, cluster, row_number() OVER (PARTITION BY cell_id ORDER BY (c.x - l.x) * (c.x - l.x) + (c.y - l.y) * (c.y - l.y), landmark) AS r FROM cells c, l),
v AS (SELECT id, cluster, count(*) AS n FROM n WHERE r <= 15 GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, cluster) AS r, sum(n) OVER (PARTITION BY id) AS k FROM v)
SELECT id, max(cluster) FILTER (r = 1) AS cluster, max(n) FILTER (r = 1) / max(k) AS fraction, (max(n) FILTER (r = 1) - coalesce(max(n) FILTER (r = 2), 0)) / max(k) AS margin FROM o GROUP BY id""")
def landmark_vote(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    landmarks = s.select(F.col("s_suppkey").alias("landmark"), (F.expr("s_suppkey * 7919 % 8192") / 8.0).alias("x"), (F.expr("s_suppkey * 104729 % 8192") / 8.0).alias("y"))
    near = joins.nearest_landmarks(_points(spark, sf_dir), landmarks, 15)
    return agg.vote(near, s.select(F.col("s_suppkey").alias("landmark"), (F.col("s_suppkey") % 6).alias("cluster")))


@query(f"""WITH {CELLS}, l AS (SELECT s_suppkey AS landmark, (s_suppkey * 7919 % 8192) / 8.0 AS x, (s_suppkey * 104729 % 8192) / 8.0 AS y, s_suppkey % 6 AS value FROM supplier),
n AS (SELECT cell_id AS id, value, sqrt((c.x - l.x) * (c.x - l.x) + (c.y - l.y) * (c.y - l.y)) AS d, row_number() OVER (PARTITION BY cell_id ORDER BY (c.x - l.x) * (c.x - l.x) + (c.y - l.y) * (c.y - l.y), landmark) AS r FROM cells c, l)
SELECT id, round(sum(value / greatest(d, 1e-6)) / sum(1 / greatest(d, 1e-6)), 6) AS value FROM n WHERE r <= 5 GROUP BY id""")
def inverse_distance_projection(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    landmarks = s.select(F.col("s_suppkey").alias("landmark"), (F.expr("s_suppkey * 7919 % 8192") / 8.0).alias("x"), (F.expr("s_suppkey * 104729 % 8192") / 8.0).alias("y"))
    near = joins.nearest_landmarks(_points(spark, sf_dir), landmarks, 5).join(s.select(F.col("s_suppkey").alias("landmark"), (F.col("s_suppkey") % 6).alias("value")), "landmark")
    w = 1 / F.greatest(F.col("d"), F.lit(1e-6))
    return near.groupBy("id").agg(F.round(F.sum(F.col("value") * w) / F.sum(w), 6).alias("value"))


def _polygons(spark, sf_dir):
    """Hexagons around every fortieth cell's place, skewed; samples have about 25."""
    c = cells(spark, sf_dir).where("cell_id % 40 = 0")
    corners = [(0, 60), (50, 30), (50, -30), (0, -60), (-50, -30), (-20, 10)]
    ring = F.array(*(F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y")) for dx, dy in corners))
    return c.select("sample_id", F.col("cell_id").alias("polygon"), ring.alias("ring"))


_CORNERS = "corners(i, dx, dy) AS (VALUES (0, 0, 60), (1, 50, 30), (2, 50, -30), (3, 0, -60), (4, -50, -30), (5, -20, 10))"
_SIDES = f"""{_CORNERS}, sides AS (
  SELECT sample_id, cell_id AS polygon, p.x + a.dx AS ax, p.y + a.dy AS ay, p.x + b.dx AS bx, p.y + b.dy AS by_ FROM cells p, corners a JOIN corners b ON b.i = (a.i + 1) % 6 WHERE p.cell_id % 40 = 0)"""
_HITS = """hits AS (
  SELECT c.sample_id, c.cell_id, s.polygon,
    sum(CASE WHEN (ay > c.y) <> (by_ > c.y) AND c.x < (bx - ax) * (c.y - ay) / CASE WHEN by_ = ay THEN 1e-12 ELSE by_ - ay END + ax THEN 1 ELSE 0 END) % 2 = 1 AS inside,
    bool_or((bx - ax) * (c.y - ay) - (by_ - ay) * (c.x - ax) = 0 AND c.x BETWEEN least(ax, bx) AND greatest(ax, bx) AND c.y BETWEEN least(ay, by_) AND greatest(ay, by_)) AS edge
  FROM cells c JOIN sides s ON c.sample_id = s.sample_id GROUP BY ALL)"""


@query(f"WITH {CELLS}, {_SIDES}, {_HITS} SELECT sample_id, cell_id, min(polygon) AS polygon, count(*) AS n FROM hits WHERE inside AND NOT edge GROUP BY ALL")
def points_in_polygons(spark, sf_dir):
    c = cells(spark, sf_dir).select("sample_id", "cell_id", "x", "y")
    met = geometry.points_in_polygons(c, _polygons(spark, sf_dir), ["sample_id"], 128)
    return met.groupBy("sample_id", "cell_id").agg(F.min("polygon").alias("polygon"), F.count("*").alias("n"))


@query(f"""WITH {CELLS}, {_SIDES}, {_HITS}, p AS (SELECT cell_id AS polygon, sample_id FROM cells WHERE cell_id % 40 = 0)
SELECT p.sample_id, p.polygon, count(c.cell_id) AS total, count(*) FILTER (c.kind = 2) AS chosen FROM p LEFT JOIN (SELECT * FROM hits WHERE inside OR edge) h ON p.polygon = h.polygon LEFT JOIN cells c ON h.cell_id = c.cell_id GROUP BY ALL""")
def section_counts(spark, sf_dir):
    c = cells(spark, sf_dir).select("sample_id", "cell_id", "kind", "x", "y")
    polygons = _polygons(spark, sf_dir)
    met = geometry.points_in_polygons(c, polygons, ["sample_id"], 128, edge_counts=True).select("polygon", "cell_id", "kind")
    return polygons.select("sample_id", "polygon").join(met, "polygon", "left").groupBy("sample_id", "polygon").agg(F.count("cell_id").alias("total"), F.count_if(F.col("kind") == 2).alias("chosen"))


@query(f"""WITH {CELLS}, {_SIDES} SELECT sample_id, polygon, abs(sum(ax * by_ - bx * ay)) / 2 AS area, min(ax) AS x0, max(ay) AS y1, false AS crosses FROM sides GROUP BY ALL""")
def polygon_shapes(spark, sf_dir):
    ring = F.col("ring")
    b = geometry.bounds(ring)
    return _polygons(spark, sf_dir).select("sample_id", "polygon", geometry.area(ring).alias("area"), b["x0"].alias("x0"), b["y1"].alias("y1"), geometry.crosses_itself(ring).alias("crosses"))


@query(f"""WITH {CELLS}, {_SIDES}, b AS (SELECT sample_id, polygon, CAST(floor(min(ax)) AS INT) AS x0, CAST(ceil(max(ax)) AS INT) AS x1, CAST(floor(min(ay)) AS INT) AS y0, CAST(ceil(max(ay)) AS INT) AS y1 FROM sides GROUP BY ALL),
p AS (SELECT sample_id, polygon, y, unnest(generate_series(x0, x1)) AS x FROM (SELECT *, unnest(generate_series(y0, y1)) AS y FROM b)),
t AS (SELECT p.sample_id, p.polygon, p.y, p.x, sum(CASE WHEN (ay > p.y + 0.5) <> (by_ > p.y + 0.5) AND p.x + 0.5 < (bx - ax) * (p.y + 0.5 - ay) / CASE WHEN by_ = ay THEN 1e-12 ELSE by_ - ay END + ax THEN 1 ELSE 0 END) % 2 AS odd FROM p JOIN sides s ON p.polygon = s.polygon GROUP BY ALL)
SELECT sample_id, polygon, count(*) AS pixels, CAST(sum(x) AS BIGINT) AS sum_x, CAST(sum(y) AS BIGINT) AS sum_y FROM t WHERE odd = 1 GROUP BY ALL""")
def polygon_pixels(spark, sf_dir):
    found = geometry.rasterised(_polygons(spark, sf_dir), ["sample_id"])
    return found.groupBy("sample_id", "polygon").agg(F.count("*").alias("pixels"), F.sum("x").alias("sum_x"), F.sum("y").alias("sum_y"))


@query(f"WITH {RASTER}, {CELLS} SELECT sample_id, cell_id FROM cells c WHERE EXISTS (SELECT 1 FROM raster r WHERE r.sample_id = c.sample_id AND r.y = floor(c.y / 16) AND r.x = floor(c.x / 16))")
def cells_on_mask(spark, sf_dir):
    mask = label_raster(spark, sf_dir).select("sample_id", F.col("y").alias("my"), F.col("x").alias("mx"))
    return constraints.on_mask(cells(spark, sf_dir), mask, ["sample_id"], 1 / 16).select("sample_id", "cell_id")


@query(f"WITH {RASTER}, t AS (SELECT sample_id, y // 8 AS grid_row, x // 8 AS grid_col, count(*) / 64.0 AS fraction FROM raster GROUP BY ALL) SELECT sample_id, grid_row, grid_col, fraction, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY grid_row, grid_col) AS INTEGER) AS tile FROM t WHERE fraction >= 0.5")
def tissue_tiles(spark, sf_dir):
    r = label_raster(spark, sf_dir)
    tiles = r.groupBy("sample_id", F.expr("y div 8").alias("grid_row"), F.expr("x div 8").alias("grid_col")).agg((F.count("*") / 64.0).alias("fraction"))
    return raster.ranked_tiles(tiles, ["sample_id"], 0.5)


@query(f"WITH {CELLS} SELECT sample_id, count(*) AS n, sum(area)::BIGINT AS area FROM cells WHERE x BETWEEN 100 AND 400 AND y BETWEEN 200 AND 900 AND kind IN (1, 3) AND (probability IS NULL OR probability <= 0.75) GROUP BY ALL")
def viewport_counts(spark, sf_dir):
    return constraints.viewport(cells(spark, sf_dir), 100, 200, 400, 900, [1, 3], 0.75).groupBy("sample_id").agg(F.count("*").alias("n"), F.sum("area").alias("area"))


@query(f"WITH {CELLS} SELECT cell_id, kind, x, y FROM cells WHERE x BETWEEN 100 AND 400 AND y BETWEEN 200 AND 900 AND cell_id > 500 ORDER BY cell_id LIMIT 101")
def viewport_page(spark, sf_dir):
    return ordered.page(constraints.viewport(cells(spark, sf_dir), 100, 200, 400, 900), "cell_id", 500, 100).select("cell_id", "kind", "x", "y")


@query(f"WITH {CELLS} SELECT source, kind, count(*) AS n FROM cells GROUP BY ALL")
def index_summary(spark, sf_dir):
    return cells(spark, sf_dir).groupBy("source", "kind").agg(F.count("*").alias("n"))


@query(f"WITH {CELLS} SELECT cell_id, source, kind, x, y FROM cells WHERE x BETWEEN 10 AND 300 AND y BETWEEN 500 AND 700")
def indexed_viewport(spark, sf_dir):
    import uuid

    from ..sources import records
    from ..streaming.zonal import folder_of

    path = f"{folder_of(spark).rstrip('/')}/index-{uuid.uuid4().hex}"
    records.build_index(cells(spark, sf_dir).select("cell_id", "source", "kind", "x", "y"), path, 128)
    return records.query_index(spark, path, 128, 10, 500, 300, 700)


@query(f"WITH {RASTER}, m(label, t) AS (VALUES (1, 10), (2, 20), (3, 20), (5, 0)) SELECT sample_id, coalesce(t, 0) AS label, count(*) AS n FROM raster LEFT JOIN m ON raster.label = m.label GROUP BY ALL")
def remapped_labels(spark, sf_dir):
    lut = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (5, 0)], "label long, to int")
    return raster.remapped(label_raster(spark, sf_dir), lut).groupBy("sample_id", "label").agg(F.count("*").alias("n"))


@query(f"""WITH {RASTER}, c AS (SELECT sample_id, y // 4 AS "by", x // 4 AS bx, label, count(*) AS n FROM raster GROUP BY ALL) SELECT sample_id, "by", bx, arg_max(label, n * 100 - label) AS label, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ALL """)
def mode_downsample(spark, sf_dir):
    return raster.downsampled_mode(label_raster(spark, sf_dir), ["sample_id"], 4)


@query(f"WITH {RASTER} SELECT DISTINCT sample_id, y // 4 AS by, x // 4 AS bx FROM raster")
def any_downsample(spark, sf_dir):
    return raster.downsampled_any(label_raster(spark, sf_dir), ["sample_id"], 4)


@query(f"WITH {RASTER} SELECT sample_id, y // 2 AS y, x // 2 AS x, label FROM raster WHERE y % 2 = 0 AND x % 2 = 0")
def stride_downsample(spark, sf_dir):
    return raster.strided(label_raster(spark, sf_dir), 2).select("sample_id", "y", "x", "label")


_SPARSE = "sparse AS (SELECT * FROM raster WHERE (y * 7 + x * 3) % 5 = 0)"


def _sparse(spark, sf_dir):
    return label_raster(spark, sf_dir).where("(y * 7 + x * 3) % 5 = 0")


_DISC = "disc AS (SELECT dy, dx, dy * dy + dx * dx AS d2 FROM range(-2, 3) a(dy), range(-2, 3) b(dx) WHERE dy * dy + dx * dx <= 4)"


@query(f"""WITH {RASTER}, {_SPARSE}, {_DISC}, s AS (SELECT sample_id, y + dy AS y, x + dx AS x, label, d2 FROM sparse, disc)
SELECT sample_id, y, x, arg_min(label, d2 * 100 + label) AS label, CAST(min(d2) AS INTEGER) AS d2 FROM s WHERE y BETWEEN 0 AND 63 AND x BETWEEN 0 AND 63 GROUP BY ALL""")
def expanded_labels(spark, sf_dir):
    return raster.expanded(_sparse(spark, sf_dir), ["sample_id"], 2, 64, 64)


@query(f"WITH {RASTER}, {_SPARSE}, {_DISC} SELECT DISTINCT sample_id, y + dy AS y, x + dx AS x FROM sparse, disc WHERE y + dy BETWEEN 0 AND 63 AND x + dx BETWEEN 0 AND 63")
def dilated_mask(spark, sf_dir):
    return raster.dilated(tissue(spark, sf_dir).where("(y * 7 + x * 3) % 5 = 0"), ["sample_id"], 2, 64, 64)


@query(f"WITH {RASTER}, {_DISC}, near AS (SELECT r.sample_id, r.y, r.x, count(n.label) AS n FROM raster r JOIN disc ON true LEFT JOIN raster n ON n.sample_id = r.sample_id AND n.y = r.y + dy AND n.x = r.x + dx GROUP BY ALL) SELECT sample_id, y, x FROM near WHERE n = 13")
def eroded_mask(spark, sf_dir):
    return raster.eroded(tissue(spark, sf_dir), ["sample_id"], 2)


@query(f"""WITH RECURSIVE {RASTER}, m AS (SELECT sample_id, y, x FROM raster WHERE (y * y * 3 + x * x * 5 + x * y) % 5 < 2), n AS (SELECT sample_id, y * 64 + x AS id, y, x FROM m),
e AS (SELECT a.sample_id, a.id AS a, b.id AS b FROM n a JOIN n b ON a.sample_id = b.sample_id AND abs(a.y - b.y) + abs(a.x - b.x) = 1),
walk AS (SELECT DISTINCT sample_id, a AS node, a AS reach FROM e UNION SELECT walk.sample_id, walk.node, e.b FROM walk JOIN e ON walk.sample_id = e.sample_id AND walk.reach = e.a)
SELECT sample_id, node, min(reach) AS component FROM walk GROUP BY ALL""")
def mask_components(spark, sf_dir):
    """Pixels with a neighbour, and the first pixel of their part."""
    found = raster.sized_components(tissue(spark, sf_dir).where("(y * y * 3 + x * x * 5 + x * y) % 5 < 2"), ["sample_id"], 64)
    return found.where("n > 1").select("sample_id", (F.col("y") * 64 + F.col("x")).alias("node"), "component")


_TWO = "a AS (SELECT sample_id, y, x, (label * 100 + (y // 8) * 8 + x // 8) AS label FROM raster WHERE (y + x) % 9 <> 0), b AS (SELECT sample_id, y, x, (label * 100 + (y // 8) * 8 + x // 8) AS label FROM raster WHERE (y * 2 + x) % 7 <> 0)"


def _two(spark, sf_dir):
    r = label_raster(spark, sf_dir).withColumn("l", F.expr("label * 100 + (y div 8) * 8 + x div 8"))
    return tuple(r.where(w).select("sample_id", "y", "x", F.col("l").alias("label")) for w in ("(y + x) % 9 <> 0", "(y * 2 + x) % 7 <> 0"))


@query(f"""WITH {RASTER}, {_TWO}, na AS (SELECT sample_id, label, count(*) AS n FROM a GROUP BY ALL), nb AS (SELECT sample_id, label, count(*) AS n FROM b GROUP BY ALL),
m AS (SELECT a.sample_id, a.label AS a, b.label AS b, count(*) AS shared FROM a JOIN b USING (sample_id, y, x) GROUP BY ALL)
SELECT m.sample_id, a, b, shared, shared / (na.n + nb.n - shared) AS iou, 2 * shared / (na.n + nb.n) AS dice FROM m JOIN na ON m.sample_id = na.sample_id AND a = na.label JOIN nb ON m.sample_id = nb.sample_id AND b = nb.label""")
def mask_overlap(spark, sf_dir):
    return raster.overlap(*_two(spark, sf_dir), ["sample_id"])


@query(f"""WITH {RASTER}, {_TWO}, na AS (SELECT sample_id, label, count(*) AS n FROM a GROUP BY ALL), nb AS (SELECT sample_id, label, count(*) AS n FROM b GROUP BY ALL),
m AS (SELECT a.sample_id, a.label AS a, b.label AS b, count(*) AS shared FROM a JOIN b USING (sample_id, y, x) GROUP BY ALL)
SELECT m.sample_id, a, b, shared / (na.n + nb.n - shared) AS iou FROM m JOIN na ON m.sample_id = na.sample_id AND a = na.label JOIN nb ON m.sample_id = nb.sample_id AND b = nb.label WHERE shared / (na.n + nb.n - shared) > 0.5""")
def best_matching(spark, sf_dir):
    return graph.best_matching(raster.overlap(*_two(spark, sf_dir), ["sample_id"]), ["sample_id"])


@query(f"""WITH {RASTER}, {_TWO}, b2 AS (SELECT sample_id, y, x, label // 100 AS label FROM b), na AS (SELECT sample_id, label, count(*) AS n FROM a GROUP BY ALL), nb AS (SELECT sample_id, label, count(*) AS n FROM b2 GROUP BY ALL),
g AS (SELECT a.sample_id, a.label AS a, b2.label AS b, count(*) AS n FROM a JOIN b2 USING (sample_id, y, x) GROUP BY ALL),
k AS (SELECT g.* FROM g JOIN na ON g.sample_id = na.sample_id AND a = na.label JOIN nb ON g.sample_id = nb.sample_id AND b = nb.label WHERE g.n >= 0.5 * least(na.n, nb.n))
SELECT sample_id, a AS label, count(*) AS degree, 'split' AS side FROM k GROUP BY sample_id, a HAVING count(*) > 1 UNION ALL SELECT sample_id, b, count(*), 'merge' FROM k GROUP BY sample_id, b HAVING count(*) > 1""")
def split_and_merged(spark, sf_dir):
    a, b = _two(spark, sf_dir)
    b = b.withColumn("label", F.expr("label div 100"))
    na = a.groupBy("sample_id", F.col("label").alias("a")).agg(F.count("*").alias("na"))
    nb = b.groupBy("sample_id", F.col("label").alias("b")).agg(F.count("*").alias("nb"))
    return raster.split_and_merged(raster.overlap(a, b, ["sample_id"]), na, nb, ["sample_id"], 0.5)


@query(f"""WITH {RASTER}, a AS (SELECT sample_id, y, x, label FROM raster WHERE (y + x) % 9 <> 0), b AS (SELECT sample_id, y, x, CASE WHEN y % 5 = 0 THEN 9 ELSE label END AS label FROM raster WHERE (y * 2 + x) % 7 <> 0),
f AS (SELECT sample_id, coalesce(a.label, 0) AS la, coalesce(b.label, 0) AS lb FROM a FULL JOIN b USING (sample_id, y, x))
SELECT sample_id, count(*) FILTER (la <> 0) AS raw, count(*) FILTER (lb <> 0) AS final, count(*) FILTER (la = 0 AND lb <> 0) AS added, count(*) FILTER (la <> 0 AND lb = 0) AS removed, count(*) FILTER (la <> 0 AND lb <> 0 AND la <> lb) AS relabelled FROM f GROUP BY ALL""")
def mask_changes(spark, sf_dir):
    r = label_raster(spark, sf_dir)
    after = r.where("(y * 2 + x) % 7 <> 0").withColumn("label", F.expr("CASE WHEN y % 5 = 0 THEN 9 ELSE label END"))
    return raster.changes(r.where("(y + x) % 9 <> 0"), after, ["sample_id"])


@query(f"""WITH {PIXELS}, p AS (SELECT sample_id, y, x, label % 3 AS channel, sum(score * (other + 1)) / sum(other + 1) AS p FROM pixels WHERE label > 0 GROUP BY ALL)
SELECT sample_id, y, x, max(p) AS p, arg_max(channel, (p, -channel)) AS channel FROM p GROUP BY ALL""")
def blended_patches(spark, sf_dir):
    patches = pixels(spark, sf_dir).where("label > 0").select("sample_id", "y", "x", F.expr("label % 3").alias("channel"), F.col("score").alias("p"), (F.col("other") + 1).alias("w"))
    return raster.blended(patches, ["sample_id"])


@query(f"WITH {RASTER} SELECT sample_id, count(*) AS n, min(y * 64 + x) AS first FROM raster WHERE label IN (2, 4) GROUP BY ALL")
def kept_labels(spark, sf_dir):
    kept = spark.createDataFrame([(2,), (4,)], "label long")
    r = label_raster(spark, sf_dir)
    out = constraints.keep_labels(r, r.select("sample_id").distinct().crossJoin(F.broadcast(kept)), ["sample_id"])
    return out.where("label <> 0").groupBy("sample_id").agg(F.count("*").alias("n"), F.min(F.expr("y * 64 + x")).alias("first"))


@query(f"""WITH {CELLS}, s AS (SELECT DISTINCT sample_id FROM cells) SELECT sample_id, (gy * 4 + gx + 1) AS label, greatest(gx * 256 - 96, 0) AS hx0, greatest(gy * 256 - 96, 0) AS hy0, least(gx * 256 + 256 + 96, 1000) AS hx1, least(gy * 256 + 256 + 96, 1000) AS hy1 FROM s, range(4) a(gx), range(4) b(gy)""")
def halo_plan(spark, sf_dir):
    cores = raster.lattice(cells(spark, sf_dir), ["sample_id"], 1000, 1000, 256)
    return raster.with_halo(cores, 96, 1000, 1000).select("sample_id", "label", "hx0", "hy0", F.least("hx1", F.lit(1000)).cast("long").alias("hx1"), F.least("hy1", F.lit(1000)).cast("long").alias("hy1"))


@query(f"""WITH {CELLS}, b AS (SELECT sample_id, source, count(DISTINCT (floor(x / 64), floor(y / 64))) AS bins, count(*) AS n FROM cells GROUP BY ALL)
SELECT sample_id, max(bins) FILTER (source = 'F') AS f, max(bins) FILTER (source = 'O') AS o, max(bins) FILTER (source = 'P') AS p, CASE WHEN min(n) = 0 OR count(*) < 3 THEN 'missing' WHEN max(n) / min(n) > 1.5 THEN 'uneven' ELSE 'even' END AS status FROM b GROUP BY ALL""")
def source_coverage(spark, sf_dir):
    bins = F.struct(F.floor(F.col("x") / 64), F.floor(F.col("y") / 64))
    per = cells(spark, sf_dir).groupBy("sample_id", "source").agg(F.countDistinct(bins).alias("bins"), F.count("*").alias("n"))
    own = {s: F.max(F.when(F.col("source") == s, F.col("bins"))).alias(s.lower()) for s in "FOP"}
    status = F.when((F.min("n") == 0) | (F.count("*") < 3), "missing").when(F.max("n") / F.min("n") > 1.5, "uneven").otherwise("even")
    return per.groupBy("sample_id").agg(*own.values(), status.alias("status"))


@query(f"""WITH {CELLS}, b AS (SELECT sample_id, floor(x / 128) AS bx, floor(y / 128) AS by, avg(probability) AS ma, avg(area) AS mb FROM cells GROUP BY ALL),
c AS (SELECT sample_id, quantile_cont(ma, 0.8) AS ca, quantile_cont(mb, 0.8) AS cb, count(*) AS bins FROM b GROUP BY ALL)
SELECT b.sample_id, bins, round(CASE WHEN bins >= 3 THEN count(*) FILTER (ma >= ca AND mb >= cb) / nullif(count(*) FILTER (ma >= ca OR mb >= cb), 0) END, 9) AS jaccard FROM b JOIN c ON b.sample_id = c.sample_id GROUP BY b.sample_id, bins""")
def hotspot_overlap(spark, sf_dir):
    return agg.hotspots(cells(spark, sf_dir), ["sample_id"], 128.0, "probability", "area", 0.8).withColumn("jaccard", F.round("jaccard", 9))


@query(f"""WITH {RASTER}, s AS (SELECT sample_id, x, abs(label - lag(label) OVER (PARTITION BY sample_id, y ORDER BY x)) AS step FROM raster)
SELECT sample_id, quantile_cont(step, 0.95) FILTER (x % 8 = 0) AS boundary, quantile_cont(step, 0.95) FILTER (x % 8 <> 0) AS baseline, count(*) FILTER (x % 8 = 0) AS n_boundary FROM s WHERE step IS NOT NULL GROUP BY ALL""")
def seam_steps(spark, sf_dir):
    return agg.seams(label_raster(spark, sf_dir), ["sample_id"], "label", 8)


@query(f"""WITH {CELLS}, {_PAIRS}, s AS (SELECT p.sample_id, p.a, a.kind = b.kind AS same FROM pairs p JOIN cells a ON p.a = a.cell_id JOIN cells b ON p.b = b.cell_id WHERE d < 24),
n AS (SELECT sample_id, a, avg(same::INT) AS f FROM s GROUP BY ALL) SELECT c.sample_id, c.kind, count(*) AS n, round(avg(f), 9) AS mean, round(median(f), 9) AS median FROM n JOIN cells c ON n.a = c.cell_id GROUP BY ALL""")
def neighbour_coherence(spark, sf_dir):
    points = cells(spark, sf_dir).select("sample_id", F.col("cell_id").alias("id"), "kind", "x", "y")
    pairs = joins.near_pairs(points, ["sample_id"], 24.0, ["kind"])
    same = stored(pairs.groupBy("sample_id", "a", F.col("kind_a").alias("kind")).agg(F.avg((F.col("kind_a") == F.col("kind_b")).cast("int")).alias("f")).drop("a"))
    found = same.groupBy("sample_id", "kind").agg(F.count("*").alias("n"), F.round(F.avg("f"), 9).alias("mean"))
    return agg.with_percentiles(found, same, ["sample_id", "kind"], {"f": {"median": 0.5}}).withColumn("median", F.round("median", 9))


@query(f"WITH {CELLS}, n AS (SELECT sample_id, kind, count(*) AS n FROM cells GROUP BY ALL) SELECT sample_id, CAST(sum(n * n) / (sum(n) * sum(n)) AS DOUBLE) AS chance, count(*) AS clusters FROM n GROUP BY ALL")
def chance_agreement(spark, sf_dir):
    return agg.chance_agreement(cells(spark, sf_dir), ["sample_id"], "kind")


@query(f"""WITH {CELLS}, t AS (SELECT sample_id, cell_id, (patient * 13 % 40) / 100.0 AS margin, CASE WHEN kind = 5 THEN NULL ELSE (cell_id % 11) / 10.0 END AS stability FROM cells)
SELECT sample_id, CASE WHEN margin IS NULL OR stability IS NULL THEN 'not_assessed' WHEN margin < 0.10 AND stability < 0.67 THEN 'low_margin_and_stability' WHEN margin < 0.10 THEN 'low_margin' WHEN stability < 0.67 THEN 'low_stability' ELSE 'accepted' END AS status, count(*) AS n FROM t GROUP BY ALL""")
def uncertainty_status(spark, sf_dir):
    t = cells(spark, sf_dir).select("sample_id", (F.expr("patient * 13 % 40") / 100.0).alias("margin"), F.when(F.col("kind") != 5, F.col("cell_id") % 11 / 10.0).alias("stability"))
    return t.groupBy("sample_id", scalars.uncertainty(F.col("margin"), F.col("stability")).alias("status")).agg(F.count("*").alias("n"))


_FOUR = "four(dy, dx) AS (VALUES (0, 1), (1, 0), (0, -1), (-1, 0))"
_TEN = "disc AS (SELECT dy, dx FROM range(-2, 3) a(dy), range(-2, 3) b(dx) WHERE dy * dy + dx * dx <= 4)"


@query(f"""WITH {RASTER}, {_FOUR}, {_TEN}, a AS (SELECT sample_id, y, x FROM raster WHERE label <> 1), b AS (SELECT sample_id, y, x FROM raster WHERE label <> 2),
ea AS (SELECT * FROM a p WHERE EXISTS (SELECT 1 FROM four f WHERE (p.sample_id, p.y + dy, p.x + dx) NOT IN (SELECT sample_id, y, x FROM a))), eb AS (SELECT * FROM b p WHERE EXISTS (SELECT 1 FROM four f WHERE (p.sample_id, p.y + dy, p.x + dx) NOT IN (SELECT sample_id, y, x FROM b))),
na AS (SELECT DISTINCT sample_id, y + dy AS y, x + dx AS x FROM ea, disc), nb AS (SELECT DISTINCT sample_id, y + dy AS y, x + dx AS x FROM eb, disc),
p AS (SELECT ea.sample_id, count(nb.y) / count(*) AS precision FROM ea LEFT JOIN nb USING (sample_id, y, x) GROUP BY ALL), r AS (SELECT eb.sample_id, count(na.y) / count(*) AS recall FROM eb LEFT JOIN na USING (sample_id, y, x) GROUP BY ALL)
SELECT sample_id, precision, recall, 2 * precision * recall / (precision + recall) AS f1 FROM p JOIN r USING (sample_id)""")
def boundary_agreement(spark, sf_dir):
    r = label_raster(spark, sf_dir)
    return raster.boundary_f1(r.where("label <> 1"), r.where("label <> 2"), ["sample_id"], 2)


@query(f"WITH {CELLS} SELECT sample_id, cell_id, (rank() OVER (PARTITION BY sample_id ORDER BY area) + (count(*) OVER (PARTITION BY sample_id, area) - 1) / 2) / count(*) OVER (PARTITION BY sample_id) AS share FROM cells")
def area_percentile_ranks(spark, sf_dir):
    n = F.count(F.lit(1)).over(Window.partitionBy("sample_id"))
    return cells(spark, sf_dir).select("sample_id", "cell_id", (agg.average_rank("area", ["sample_id"]) / n).alias("share"))


_LATTICE = """marks AS (SELECT * FROM cells WHERE area >= 60 AND kind = 1),
xs AS (SELECT sample_id, x0, least(lead(x0) OVER (PARTITION BY sample_id ORDER BY x0), x0 + 48) AS x1 FROM (SELECT DISTINCT sample_id, x AS x0 FROM marks)),
ys AS (SELECT sample_id, y0, least(lead(y0) OVER (PARTITION BY sample_id ORDER BY y0), y0 + 96) AS y1 FROM (SELECT DISTINCT sample_id, y AS y0 FROM marks)),
grid AS (SELECT sample_id, x0, y0, coalesce(x1, x0 + 48) AS x1, coalesce(y1, y0 + 96) AS y1 FROM xs JOIN ys USING (sample_id))"""


@query(f"""WITH {CELLS}, {_LATTICE}, a AS (SELECT c.sample_id, c.cell_id, c.x, c.y, c.area, xs.x0 FROM cells c ASOF JOIN xs ON c.sample_id = xs.sample_id AND c.x >= xs.x0),
b AS (SELECT a.*, ys.y0 FROM a ASOF JOIN ys ON a.sample_id = ys.sample_id AND a.y >= ys.y0)
SELECT sample_id, x0, y0, count(*) AS n, CAST(sum(area) AS BIGINT) AS area, min(cell_id) AS first FROM b JOIN grid USING (sample_id, x0, y0) WHERE x < x1 AND y < y1 GROUP BY ALL""")
def irregular_cores(spark, sf_dir):
    """Cells in the cores of a lattice whose starts lie anywhere, with gaps between some cores."""
    c = cells(spark, sf_dir)
    marks = c.where("area >= 60 AND kind = 1")
    axes = []
    for axis, most in (("x", 48), ("y", 96)):
        starts = marks.select("sample_id", F.col(axis).alias(f"{axis}0")).distinct()
        after = F.lead(f"{axis}0").over(Window.partitionBy("sample_id").orderBy(f"{axis}0"))
        axes.append(starts.withColumn(f"{axis}1", F.least(after, F.col(f"{axis}0") + most)))
    met = joins.irregular_lattice_join(c.select("sample_id", "cell_id", "x", "y", "area"), axes[0].join(axes[1], "sample_id"), ["sample_id"])
    return met.groupBy("sample_id", "x0", "y0").agg(F.count("*").alias("n"), F.sum("area").alias("area"), F.min("cell_id").alias("first"))


@query(f"""WITH {CELLS}, s AS (SELECT DISTINCT sample_id FROM cells)
SELECT sample_id, CAST(r * 6 + c + 1 AS INTEGER) AS label, CAST(20 + 192 * c AS INTEGER) AS cx, CAST(62 + 192 * r AS INTEGER) AS cy, CAST(-76 + 192 * c AS INTEGER) AS x0, CAST(-34 + 192 * r AS INTEGER) AS y0, CAST(116 + 192 * c AS INTEGER) AS x1, CAST(158 + 192 * r AS INTEGER) AS y1 FROM s, range(4) a(r), range(6) b(c)""")
def centred_cores(spark, sf_dir):
    """Adjacent cores of 192 by 192 whose centres lie in an image of 1,000 by 700."""
    return raster.centred_lattice(cells(spark, sf_dir), ["sample_id"], 1000, 700, 192).select("sample_id", "label", "cx", "cy", "x0", "y0", "x1", "y1")


@query(f"""WITH {CELLS} SELECT sample_id, CAST(floor(y / 256) * 4 + floor(x / 256) + 1 AS BIGINT) AS shard, count(*) AS n, CAST(sum(x) AS DOUBLE) AS sum_x, CAST(sum(y) AS DOUBLE) AS sum_y FROM cells GROUP BY ALL""")
def shard_cells(spark, sf_dir):
    """Cells of windows with halos, moved back to the image; each must lie in its own core."""
    c = cells(spark, sf_dir)
    shards = raster.with_halo(raster.lattice(c, ["sample_id"], 1024, 1024, 256), 64, 1024, 1024).withColumnRenamed("label", "shard")
    own = c.withColumn("shard", (F.floor(F.col("y") / 256) * 4 + F.floor(F.col("x") / 256) + 1)).join(shards.select("sample_id", "shard", "hx0", "hy0"), ["sample_id", "shard"])
    local = own.select("sample_id", "shard", F.col("cell_id").alias("id"), (F.col("x") - F.col("hx0")).alias("x"), (F.col("y") - F.col("hy0")).alias("y"))
    found = raster.core_cells(local, shards, ["sample_id"], 1024, 1024)
    return found.groupBy("sample_id", "shard").agg(F.count("*").alias("n"), F.sum("x").alias("sum_x"), F.sum("y").alias("sum_y"))

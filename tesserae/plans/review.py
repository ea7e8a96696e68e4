"""Queries over detector roles, holes and growth, review packets and declared values, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import aggregates as agg
from ..operators import constraints, evidence, geometry, graph, joins, ordered, raster
from ..operators.graph import stored
from ..sources import records
from .evidence import _ALL_PAIRS
from .frames import CELLS, OUTCOMES, PIXELS, RASTER, cells, outcomes, pixels, table, tissue
from .frames import raster as label_raster
from .quality import _CROSS
from .spatial import _PAIRS, _SIDES, _points, _polygons, _sparse
from .spatial import _SPARSE as _SPARSE_SQL

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# Components by chains of near cells, and the first cell of each source in every component.
_MEMBERS = f"""{CELLS}, {_PAIRS}, e AS (SELECT DISTINCT sample_id, a, b FROM pairs WHERE d < 12),
walk AS (SELECT DISTINCT sample_id, a AS node, a AS reach FROM e UNION SELECT walk.sample_id, walk.node, e.b FROM walk JOIN e ON walk.sample_id = e.sample_id AND walk.reach = e.a),
c AS (SELECT sample_id, node, min(reach) AS component FROM walk GROUP BY ALL),
f AS (SELECT sample_id, coalesce(component, cell_id) AS component, source, min(cell_id) AS cell_id FROM cells LEFT JOIN (SELECT node, component FROM c) ON node = cell_id GROUP BY ALL),
m AS (SELECT f.*, x, y, sqrt(area) / 2 AS h FROM f JOIN (SELECT cell_id, x, y, area FROM cells) USING (cell_id))"""


def _members(spark, sf_dir, alone=True):
    points = cells(spark, sf_dir).select("sample_id", F.col("cell_id").alias("id"), "source", "x", "y", "area")
    edges = joins.near_pairs(_points(spark, sf_dir), ["sample_id"], 12.0).where("a < b")
    named = graph.components(edges.select("sample_id", F.col("a").alias("src"), F.col("b").alias("dst")), ["sample_id"])
    return evidence.first_members(points, named, ["sample_id"], ["x", "y", "area"], alone)


# The contours' corners, each against the other square's sides: from within to the nearest side, else to the square.
_FAR = """corner_far AS (SELECT k, max(CASE WHEN ex < 0 AND ey < 0 THEN least(-ex, -ey) ELSE sqrt(greatest(ex, 0) * greatest(ex, 0) + greatest(ey, 0) * greatest(ey, 0)) END) AS hd FROM (
  SELECT k, abs(ux - tx + sx * h1) - h2 AS ex, abs(uy - ty + sy * h1) - h2 AS ey FROM (SELECT k, xa AS ux, ya AS uy, xb AS tx, yb AS ty, ha AS h1, hb AS h2 FROM p UNION ALL SELECT k, xb, yb, xa, ya, hb, ha FROM p), s) GROUP BY k)"""


@query(f"""WITH RECURSIVE {_MEMBERS}, s(sx, sy) AS (VALUES (-1, -1), (1, -1), (1, 1), (-1, 1)),
p AS (SELECT row_number() OVER () AS k, a.source AS source_a, b.source AS source_b, a.x AS xa, a.y AS ya, b.x AS xb, b.y AS yb, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d, a.h AS ha, b.h AS hb, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy
  FROM m a JOIN m b ON a.sample_id = b.sample_id AND a.component = b.component AND a.source < b.source),
q AS (SELECT *, greatest(least(2 * ha, 2 * hb, ha + hb - dx), 0) * greatest(least(2 * ha, 2 * hb, ha + hb - dy), 0) AS shared FROM p), {_FAR},
r AS (SELECT *, shared / (4 * ha * ha + 4 * hb * hb - shared) AS iou FROM q JOIN corner_far USING (k)),
n AS (SELECT source, count(*) AS n FROM cells GROUP BY ALL)
SELECT source_a, source_b, count(*) AS matched, any_value(na.n) AS count_a, any_value(nb.n) AS count_b, count(*) / any_value(na.n) AS fraction_a, count(*) / any_value(nb.n) AS fraction_b, round(median(d), 6) AS median_d, round(quantile_cont(d, 0.95), 6) AS p95_d,
  round(quantile_cont(iou, 0.25), 6) AS iou_p25, round(median(iou), 6) AS iou_median, round(quantile_cont(iou, 0.75), 6) AS iou_p75, round(median(hd), 6) AS hausdorff_median, round(quantile_cont(hd, 0.95), 6) AS hausdorff_p95
FROM r JOIN n na ON source_a = na.source JOIN n nb ON source_b = nb.source GROUP BY ALL""")
def detector_pairs(spark, sf_dir):
    """Contours are squares of the cells' areas, so that SQL can say what their overlaps are."""
    counts = cells(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))
    half = F.sqrt("area") / 2
    ring = F.array(*(F.struct((F.col("x") + dx * half).alias("x"), (F.col("y") + dy * half).alias("y")) for dx, dy in ((-1, -1), (1, -1), (1, 1), (-1, 1))))
    members = _members(spark, sf_dir, alone=False).withColumn("ring", ring)
    found = evidence.pair_agreement(members, counts, ["sample_id"])
    return found.select(*(F.round(c, 6).alias(c) if c.endswith(("_d", "median", "p25", "p75", "p95")) else c for c in found.columns))


@query(f"""WITH RECURSIVE {_MEMBERS}, g AS (SELECT sample_id, component, string_agg(source, ';' ORDER BY source) AS sources, count(*) AS n, count(*) FILTER (source IN ('F', 'O')) AS n_broad,
  coalesce(sqrt(pow(max(x) FILTER (source = 'F') - max(x) FILTER (source = 'O'), 2) + pow(max(y) FILTER (source = 'F') - max(y) FILTER (source = 'O'), 2)), 0) AS far FROM m GROUP BY ALL),
s AS (SELECT *, n_broad / 2 * (0.5 + 0.5 * (1 - least(far / 12, 1))) AS score FROM g)
SELECT sample_id, component, sources, CAST(n_broad AS INTEGER) AS n_broad, round(far, 6) AS far, round(score, 6) AS score,
  CASE WHEN n_broad = 2 AND n > 2 THEN 'broad_consensus_with_scoped_support' WHEN n_broad = 2 THEN 'broad_consensus' WHEN n_broad > 0 AND n > n_broad THEN 'single_broad_with_scoped_support' WHEN n_broad > 0 THEN 'single_broad_only' ELSE 'scoped_support_only' END AS tier,
  CASE WHEN n_broad = 2 AND score >= 0.75 THEN 'high' WHEN score >= 0.45 THEN 'moderate' ELSE 'low' END AS agreement,
  CASE WHEN n < 2 THEN 'abstained_insufficient_detector_support' WHEN n_broad < 2 THEN 'abstained_missing_broad_detector_consensus' WHEN far > 12 THEN 'abstained_broad_detector_distance' ELSE 'accepted_instance_fusion' END AS status FROM s""")
def component_roles(spark, sf_dir):
    found = evidence.role_evidence(_members(spark, sf_dir), ["sample_id"], ["F", "O"], 12.0, 2)
    return found.withColumn("far", F.round("far", 6)).withColumn("score", F.round("score", 6))


@query(f"""WITH {CELLS}, {_ALL_PAIRS}, r AS (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY d2, b) AS k FROM pairs),
s AS (SELECT r.a, avg((ca.kind = cb.kind)::INT) AS f FROM r JOIN cells ca ON r.a = ca.cell_id JOIN cells cb ON r.b = cb.cell_id WHERE k <= 6 GROUP BY ALL),
n AS (SELECT sample_id, kind, count(*) AS n FROM cells GROUP BY ALL), h AS (SELECT sample_id, sum(n * n) / (sum(n) * sum(n)) AS chance FROM n GROUP BY ALL)
SELECT sample_id, kind, count(*) AS n, round(avg(f), 9) AS mean, round(median(f), 9) AS median, round(avg(f) - any_value(chance), 9) AS excess FROM s JOIN cells ON a = cell_id JOIN h USING (sample_id) GROUP BY ALL""")
def nearest_coherence(spark, sf_dir):
    """Like cells among the six nearest, against what chance would give."""
    points = cells(spark, sf_dir).select("sample_id", F.col("cell_id").alias("id"), "kind", "x", "y")
    near = joins.nearest(points, points, ["sample_id"], 6, 64.0, carried=["kind"])
    share = stored(near.groupBy("sample_id", "a", F.col("kind_a").alias("kind")).agg(F.avg((F.col("kind_a") == F.col("kind_b")).cast("int")).alias("f")).drop("a"))
    chance = agg.chance_agreement(cells(spark, sf_dir), ["sample_id"], "kind").select("sample_id", "chance")
    found = share.groupBy("sample_id", "kind").agg(F.count("*").alias("n"), F.avg("f").alias("mean")).join(chance, "sample_id")
    found = agg.with_percentiles(found, share, ["sample_id", "kind"], {"f": {"median": 0.5}})
    return found.select("sample_id", "kind", "n", F.round("mean", 9).alias("mean"), F.round("median", 9).alias("median"), F.round(F.col("mean") - F.col("chance"), 9).alias("excess"))


@query(f"""WITH {CELLS}, r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY md5(CAST(cell_id AS VARCHAR)), cell_id) AS nth FROM cells), s AS (SELECT * FROM r WHERE nth <= 60),
p AS (SELECT a.sample_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d1, sqrt((a.x + a.area - b.x - b.area) * (a.x + a.area - b.x - b.area)) AS d2 FROM s a JOIN s b ON a.sample_id = b.sample_id AND a.cell_id < b.cell_id),
k AS (SELECT sample_id, rank() OVER (PARTITION BY sample_id ORDER BY d1) + (count(*) OVER (PARTITION BY sample_id, d1) - 1) / 2 AS ra, rank() OVER (PARTITION BY sample_id ORDER BY d2) + (count(*) OVER (PARTITION BY sample_id, d2) - 1) / 2 AS rb FROM p)
SELECT sample_id, CASE WHEN count(*) >= 3 THEN round(corr(ra, rb), 7) END AS spearman FROM k GROUP BY ALL""")
def sampled_distance_correlation(spark, sf_dir):
    """The sample of 60 a group is the feature; whether distances agree in the plane and along a line."""
    c = cells(spark, sf_dir).select("sample_id", F.col("cell_id").alias("id"), "x", "y", (F.col("x") + F.col("area")).alias("u"))
    drawn = ordered.hashed_sample(c, ["sample_id"], 60, F.struct(F.md5(F.col("id").cast("string")), "id"))
    return evidence.distance_correlation(drawn, ["sample_id"], ["x", "y"], ["u"]).withColumn("spearman", F.round("spearman", 7))


_FOURS = "q(dy, dx) AS (VALUES (0, 1), (0, -1), (1, 0), (-1, 0))"


@query(f"""WITH RECURSIVE {RASTER}, {_CROSS}, {_FOURS}, g AS (SELECT DISTINCT sample_id, y + dy AS y, x + dx AS x FROM raster, d WHERE y + dy BETWEEN 0 AND 63 AND x + dx BETWEEN 0 AND 63 AND (y * 3 + x) % 4 > 0),
b AS (SELECT sample_id, min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1 FROM g GROUP BY ALL), v AS (SELECT b.*, CAST(ty AS BIGINT) AS y, CAST(tx AS BIGINT) AS x FROM b, range(64) s(ty), range(64) t(tx) WHERE ty BETWEEN y0 AND y1 AND tx BETWEEN x0 AND x1),
o AS (SELECT v.* FROM v ANTI JOIN g ON v.sample_id = g.sample_id AND v.y = g.y AND v.x = g.x),
w AS (SELECT sample_id, y, x FROM o WHERE y IN (y0, y1) OR x IN (x0, x1) UNION SELECT o.sample_id, o.y, o.x FROM w, q JOIN o ON true WHERE o.sample_id = w.sample_id AND o.y = w.y + dy AND o.x = w.x + dx)
SELECT sample_id, count(*) AS n, count(*) FILTER (hole) AS holes, sum(y * 64 + x) FILTER (hole) AS places FROM (SELECT sample_id, y, x, false AS hole FROM g UNION ALL SELECT o.sample_id, o.y, o.x, true FROM o ANTI JOIN w ON o.sample_id = w.sample_id AND o.y = w.y AND o.x = w.x) GROUP BY ALL""")
def filled_mask(spark, sf_dir):
    mask = raster.dilated(tissue(spark, sf_dir).where("(y * 3 + x) % 4 > 0"), ["sample_id"], 1, 64, 64)
    whole = mask.withColumn("hole", F.lit(False)).unionByName(raster.holes(mask, ["sample_id"], 64).withColumn("hole", F.lit(True)))
    return whole.groupBy("sample_id").agg(F.count("*").alias("n"), F.count_if("hole").alias("holes"), F.sum(F.when(F.col("hole"), F.col("y") * 64 + F.col("x"))).alias("places"))


@query(f"""WITH RECURSIVE {RASTER}, m AS (SELECT sample_id, y, x FROM raster WHERE (y * y * 3 + x * x * 5 + x * y) % 5 < 2), n AS (SELECT sample_id, y * 64 + x AS id, y, x FROM m),
e AS (SELECT a.sample_id, a.id AS a, b.id AS b FROM n a JOIN n b ON a.sample_id = b.sample_id AND abs(a.y - b.y) + abs(a.x - b.x) = 1),
walk AS (SELECT sample_id, id AS node, id AS reach FROM n UNION SELECT walk.sample_id, walk.node, e.b FROM walk JOIN e ON walk.sample_id = e.sample_id AND walk.reach = e.a),
c AS (SELECT sample_id, node, min(reach) AS component FROM walk GROUP BY ALL), s AS (SELECT sample_id, component, count(*) AS n FROM c GROUP BY ALL)
SELECT sample_id, component, n, row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, component) = 1 AS largest FROM s QUALIFY n >= 3""")
def large_components(spark, sf_dir):
    """Parts of three pixels or more."""
    return raster.component_sizes(tissue(spark, sf_dir).where("(y * y * 3 + x * x * 5 + x * y) % 5 < 2"), ["sample_id"], 64).where("n >= 3")


@query(f"""WITH {RASTER}, {_SPARSE_SQL}, t AS (SELECT r.sample_id, r.y, r.x FROM raster r ANTI JOIN sparse s ON r.sample_id = s.sample_id AND r.y = s.y AND r.x = s.x),
n AS (SELECT t.sample_id, t.y, t.x, arg_min(label, ((t.y - s.y) * (t.y - s.y) + (t.x - s.x) * (t.x - s.x)) * 4096 + s.y * 64 + s.x) AS label FROM t JOIN sparse s ON t.sample_id = s.sample_id GROUP BY ALL)
SELECT sample_id, y, x, label FROM n UNION ALL SELECT sample_id, y, x, label FROM sparse""")
def grown_labels(spark, sf_dir):
    """A few labels grown over every pixel of the tissue."""
    return raster.grown(_sparse(spark, sf_dir), label_raster(spark, sf_dir).select("sample_id", "y", "x"), ["sample_id"], 64)


@query(f"""WITH {RASTER}, r AS (SELECT sample_id, y, x, CASE WHEN x >= 60 AND label % 2 = 1 THEN 9 ELSE label END AS label FROM raster),
n AS (SELECT t.sample_id, t.y, t.x, arg_min(s.label, ((t.y - s.y) * (t.y - s.y) + (t.x - s.x) * (t.x - s.x)) * 4096 + s.y * 64 + s.x) AS label FROM r t JOIN r s ON t.sample_id = s.sample_id AND s.label < 9 WHERE t.label = 9 GROUP BY ALL)
SELECT sample_id, y, x, label FROM n UNION ALL SELECT sample_id, y, x, label FROM r WHERE label < 9""")
def edge_reassigned(spark, sf_dir):
    """Labels without support, all in the last columns, go to the nearest that has some."""
    r = label_raster(spark, sf_dir).withColumn("label", F.expr("CASE WHEN x >= 60 AND label % 2 = 1 THEN 9 ELSE label END"))
    return raster.reassigned(r, F.col("label") < 9, F.col("x") >= 60, ["sample_id"], 64)


@query(f"""WITH {PIXELS}, h AS (SELECT sample_id, least(2, y * 3 // 64) AS ry, least(2, x * 3 // 64) AS rx, score AS bin, count(*) FILTER (nucleus > 0) AS pos, count(*) FILTER (nucleus = 0) AS neg FROM pixels GROUP BY ALL),
w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY sample_id, ry, rx ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM h)
SELECT sample_id, ry, rx, sum(pos * (2 * below + neg)) / nullif(2 * sum(pos) * sum(neg), 0) AS auc FROM w GROUP BY ALL""")
def regional_auc(spark, sf_dir):
    """How well intensity tells nuclei in each of nine regions."""
    p = pixels(spark, sf_dir).select("sample_id", F.expr("least(2, y * 3 div 64)").alias("ry"), F.expr("least(2, x * 3 div 64)").alias("rx"), F.col("score").alias("bin"), "nucleus")
    counts = p.groupBy("sample_id", "ry", "rx", "bin").agg(F.count_if(F.col("nucleus") > 0).alias("pos"), F.count_if(F.col("nucleus") == 0).alias("neg"))
    return agg.histogram_auc(counts, ["sample_id", "ry", "rx"])


@query(f"""WITH {PIXELS}, e AS (SELECT *, y < 8 OR x < 8 OR y >= 56 OR x >= 56 AS edge FROM pixels WHERE nucleus > 0)
SELECT sample_id, count(*) FILTER (edge) AS n_edge, count(*) FILTER (NOT edge) AS n_core, CASE WHEN count(*) FILTER (edge) >= 20 AND count(*) FILTER (NOT edge) >= 50 AND sum(score) FILTER (NOT edge) > 0 THEN avg(score) FILTER (edge) / avg(score) FILTER (NOT edge) END AS ratio FROM e GROUP BY ALL""")
def edge_core_ratio(spark, sf_dir):
    """Nuclear intensity near the image's edge against the rest; null where either has too few pixels."""
    e = pixels(spark, sf_dir).where("nucleus > 0").withColumn("edge", F.expr("y < 8 OR x < 8 OR y >= 56 OR x >= 56"))
    return agg.edge_ratio(e, ["sample_id"], "score", "edge", 20, 50)


@query("""SELECT l_orderkey, l_linenumber, rule FROM lineitem, (VALUES ('returned but open'), ('discount needs a tax'), ('too many at once')) r(rule)
WHERE (rule = 'returned but open' AND l_returnflag = 'R' AND l_linestatus = 'O') OR (rule = 'discount needs a tax' AND l_discount > 0.05 AND l_tax = 0) OR (rule = 'too many at once' AND l_quantity > 45 AND l_linenumber > 4)""")
def broken_rules(spark, sf_dir):
    c = F.col
    rules = {
        "returned but open": (c("l_returnflag") != "R") | (c("l_linestatus") != "O"),
        "discount needs a tax": (c("l_discount") <= 0.05) | (c("l_tax") != 0),
        "too many at once": (c("l_quantity") <= 45) | (c("l_linenumber") <= 4),
    }
    return constraints.violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], rules)


@query(f"WITH {CELLS}, r AS (SELECT sample_id, source, cell_id, row_number() OVER w AS nth, count(*) OVER (PARTITION BY sample_id, source) AS n FROM cells WINDOW w AS (PARTITION BY sample_id, source ORDER BY probability DESC, cell_id)) SELECT sample_id, source, cell_id, CAST(nth AS INTEGER) AS nth, greatest(n - 5, 0) AS omitted FROM r WHERE nth <= 5")
def preview_gallery(spark, sf_dir):
    """The five best of every source: the limit is the feature."""
    return ordered.gallery(cells(spark, sf_dir).select("sample_id", "source", "cell_id", "probability"), ["sample_id", "source"], [F.desc("probability"), "cell_id"], 5).drop("probability")


@query(f"""WITH {CELLS}, r AS (SELECT sample_id, kind, cell_id, row_number() OVER (PARTITION BY sample_id, kind ORDER BY md5(CAST(cell_id AS VARCHAR)), cell_id) AS nth FROM cells)
SELECT sample_id, kind, cell_id, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY md5('item:' || cell_id), cell_id) AS INTEGER) AS item FROM r WHERE nth <= 4""")
def unblinded_review(spark, sf_dir):
    """A shuffled packet joined to its key again."""
    c = cells(spark, sf_dir)
    packet, key = ordered.blinded(c, ["sample_id"], "kind", "cell_id", 4, F.struct(F.md5(F.col("cell_id").cast("string")), "cell_id"))
    return packet.join(key, ["sample_id", "item"])


@query(f"""WITH {CELLS}, t AS (SELECT sample_id, cell_id, x, y, (patient * 13 % 40) / 100.0 AS margin, CASE WHEN kind = 5 THEN NULL ELSE (cell_id % 11) / 10.0 END AS stability FROM cells)
SELECT sample_id, cell_id, '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || x || ',' || y || ']}},"properties":{{"name":"' || cell_id || '"}}}}' AS feature FROM t WHERE margin IS NULL OR stability IS NULL OR margin < 0.10 OR stability < 0.67""")
def abstained_features(spark, sf_dir):
    """Cells whose cluster is not to be interpreted, as GeoJSON."""
    margin, stability = F.expr("patient * 13 % 40") / 100.0, F.when(F.col("kind") != 5, F.col("cell_id") % 11 / 10.0)
    t = cells(spark, sf_dir).where(scalars.uncertainty(margin, stability) != "accepted").withColumn("name", F.col("cell_id").cast("string"))
    return t.select("sample_id", "cell_id", records.feature_collection(t, "name").alias("feature"))


@query(f"""WITH {CELLS}, b AS (SELECT *, count(*) OVER (PARTITION BY sample_id, floor(x / 128), floor(y / 128)) AS n FROM cells),
k AS (SELECT sample_id, cell_id, -ln(greatest(CAST('0x' || substr(md5(CAST(cell_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0, 1e-12)) / n AS key FROM b), r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY key, cell_id) AS nth FROM k) SELECT sample_id, cell_id, CAST(nth AS INTEGER) AS nth FROM r WHERE nth <= 20""")
def dense_landmarks(spark, sf_dir):
    """Landmarks drawn with the square of their bin's density."""
    weighted = evidence.density_weights(cells(spark, sf_dir), ["sample_id"], 128.0, 2.0)
    return evidence.weighted_sample(weighted, ["sample_id"], "cell_id", "weight", 20)


@query(f"""WITH {CELLS}, c AS (SELECT sample_id, cell_id, x - avg(x) OVER s AS u, y - avg(y) OVER s AS v FROM cells WINDOW s AS (PARTITION BY sample_id)),
t AS (SELECT sample_id, sum(u * u) AS uu, sum(u * v) AS uv, sum(v * v) AS vv FROM c GROUP BY ALL),
k AS (SELECT sample_id, cell_id, CASE WHEN uu * vv - uv * uv > 0 THEN (u * u * vv - 2 * u * v * uv + v * v * uu) / (uu * vv - uv * uv) ELSE 0 END AS w FROM c JOIN t USING (sample_id)) SELECT sample_id, cell_id, round(w, 9) AS weight FROM k""")
def plane_leverages(spark, sf_dir):
    return evidence.leverages(cells(spark, sf_dir), ["sample_id"]).select("sample_id", "cell_id", F.round("weight", 9).alias("weight"))


@query(f"""WITH {CELLS}, v AS (SELECT sample_id, r, cell_id, kind, CASE WHEN (cell_id * 7 + r) % 10 < 8 THEN (kind + r) % 5 ELSE (kind + r + 1) % 5 END AS label FROM cells, range(3) t(r)),
n AS (SELECT sample_id, r, label, kind, count(*) AS n FROM v GROUP BY ALL), a AS (SELECT sample_id, r, label, kind AS aligned FROM n QUALIFY row_number() OVER (PARTITION BY sample_id, r, label ORDER BY n DESC, kind) = 1)
SELECT cell_id, avg((kind = aligned)::INT) AS stability FROM v JOIN a USING (sample_id, r, label) GROUP BY cell_id""")
def aligned_stability(spark, sf_dir):
    """Replicates whose labels are permuted, aligned before they are compared."""
    c = cells(spark, sf_dir).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(2))))
    label = F.when((F.col("cell_id") * 7 + F.col("r")) % 10 < 8, (F.col("kind") + F.col("r")) % 5).otherwise((F.col("kind") + F.col("r") + 1) % 5)
    v = c.select("sample_id", "r", "cell_id", F.col("kind").alias("reference"), label.alias("label"))
    named = v.join(evidence.align_labels(v, ["sample_id", "r"]), ["sample_id", "r", "label"])
    return named.groupBy("cell_id").agg(F.avg((F.col("reference") == F.col("aligned")).cast("int")).alias("stability"))


@query(f"""WITH {CELLS}, {_SIDES}, o AS (SELECT s.sample_id, s.polygon, c.i, ax, ay, bx, by_, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) AS l FROM sides s JOIN cells p ON p.cell_id = s.polygon JOIN corners c ON ax = p.x + c.dx AND ay = p.y + c.dy),
e AS (SELECT *, sum(l) OVER (PARTITION BY polygon ORDER BY i) AS done, sum(l) OVER (PARTITION BY polygon) AS total FROM o),
k AS (SELECT e.*, k, k * total / 7 - (done - l) AS t FROM e, range(7) r(k) WHERE k * total / 7 >= done - l - 1e-9 AND k * total / 7 < done - 1e-9)
SELECT sample_id, polygon, k, round(ax + t / l * (bx - ax), 6) AS x, round(ay + t / l * (by_ - ay), 6) AS y FROM k""")
def boundary_points(spark, sf_dir):
    found = geometry.sampled_boundary(_polygons(spark, sf_dir), ["sample_id"], 7)
    return found.withColumn("x", F.round("x", 6)).withColumn("y", F.round("y", 6))


@query(f"""WITH {CELLS}, {_SIDES}, a AS (SELECT sample_id, polygon, abs(sum(ax * by_ - bx * ay)) / 2 AS area FROM sides GROUP BY ALL) SELECT sample_id, polygon, round(CASE WHEN polygon % 3 = 0 THEN area ELSE area * 0.75 END, 6) AS area FROM a""")
def holed_areas(spark, sf_dir):
    """Two in three polygons have a hole of half their size."""
    ring = F.col("ring")
    holes = F.when(F.col("polygon") % 3 != 0, F.array(geometry.moved(ring, scale=0.5)))
    return _polygons(spark, sf_dir).select("sample_id", "polygon", F.round(geometry.net_area(ring, holes), 6).alias("area"))


@query(f"""WITH {CELLS} SELECT cell_id, CASE cell_id % 3 WHEN 0 THEN x - 2 WHEN 1 THEN x - 4 ELSE x END AS x0, CASE cell_id % 3 WHEN 0 THEN y - 2 WHEN 1 THEN y - 4 ELSE y END AS y0,
  CASE cell_id % 3 WHEN 0 THEN x + 2 WHEN 1 THEN x + 4 ELSE x END AS x1, CASE cell_id % 3 WHEN 0 THEN y + 2 WHEN 1 THEN y + 4 ELSE y END AS y1 FROM cells""")
def cell_bounds(spark, sf_dir):
    """A third of the cells have a contour, a third a box, the rest only a place."""
    x, y = F.col("x"), F.col("y")
    ring = F.when(F.col("cell_id") % 3 == 0, F.array(*(F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in ((-2, 0), (0, -2), (2, 0), (0, 2)))))
    box = F.when(F.col("cell_id") % 3 == 1, F.struct((x - 4).alias("x0"), (y - 4).alias("y0"), (x + 4).alias("x1"), (y + 4).alias("y1")))
    return cells(spark, sf_dir).select("cell_id", geometry.first_bounds(ring, box, x, y).alias("b")).select("cell_id", "b.*")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN printf('%d B', p_partkey % 1024) WHEN p_partkey % 4 = 1 THEN printf('%.1f KB', (1024 + p_partkey * 16 % 900000) / 1024.0) ELSE printf('%.1f MB', (1048576 + p_partkey % 1000 * 1024) / 1048576.0) END AS size,
  CASE WHEN p_partkey * 7 >= 3600 THEN printf('%dh %dm %ds', p_partkey * 7 // 3600, p_partkey * 7 % 3600 // 60, p_partkey * 7 % 60) WHEN p_partkey * 7 >= 60 THEN printf('%dm %ds', p_partkey * 7 // 60, p_partkey * 7 % 60) ELSE printf('%ds', p_partkey * 7) END AS took,
  CASE p_partkey % 4 WHEN 0 THEN 'tile,inner_square' WHEN 1 THEN 'nuclei,tile' WHEN 2 THEN 'tile,nuclei,cyto,inner_square' ELSE 'cyto' END AS modes FROM part""")
def readable_values(spark, sf_dir):
    """Parts' keys as bytes, seconds and mode words."""
    p = F.col("p_partkey")
    size = F.when(p % 4 == 0, p % 1024).when(p % 4 == 1, 1024 + p * 16 % 900000).otherwise(1048576 + p % 1000 * 1024)
    words = F.when(p % 4 == 0, F.lit(None)).when(p % 4 == 1, " Nucleus + full_tile,label").when(p % 4 == 2, "ALL4").otherwise("cytoplasm")
    return table(spark, sf_dir, "part").select("p_partkey", scalars.readable_bytes(size).alias("size"), scalars.readable_seconds((p * 7).cast("double")).alias("took"), F.array_join(scalars.modes(words), ",").alias("modes"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey || ';0.5;s' || o_orderkey ELSE '0.5;s' || o_orderkey END AS declared FROM orders")
def declared_values(spark, sf_dir):
    """Values that GeoJSON texts made of orders declare."""
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    top = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit('"mpp": '), c, F.lit(", "))).otherwise(F.lit('"mpp": null, '))
    text = F.concat(F.lit("{"), top, F.lit('"metadata": {"mpp": " 0.5 "}, "features": [{"slide": {"mpp": 9}, "properties": {"mpp": 0.5, "slide": "s'), k, F.lit('"}}, {"properties": null, "mpp": [1]}]}'))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return orders.select("o_orderkey", F.array_join(scalars.declared(F.col("text"), ("mpp", "slide")), ";").alias("declared"))


@query(f"WITH {RASTER}, l AS (SELECT sample_id, label * 100 + y // 8 AS label, min(y * 64 + x) AS f FROM raster GROUP BY ALL) SELECT sample_id, label, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY f) AS INTEGER) AS number FROM l")
def scan_ordered_labels(spark, sf_dir):
    return raster.scan_ordered(label_raster(spark, sf_dir).withColumn("label", F.expr("label * 100 + y div 8")), ["sample_id"])


@query(f"""WITH {OUTCOMES}, r AS (SELECT detector, patient, roi, CASE WHEN sum(fp) = 0 THEN sum(tp) / (sum(tp) + sum(fn)) END AS v, sum(fn) / (sum(tp) + sum(fn)) AS m, sum(tp) + sum(fp) + sum(fn) AS w FROM outcomes GROUP BY ALL)
SELECT detector, patient, count(*) AS regions, round(avg(v), 9) AS mean, round(sum(w * m) / sum(w), 9) AS missing FROM r GROUP BY ALL""")
def patient_missing_shares(spark, sf_dir):
    """Recall by patient over regions without a false alarm, and the share of reference rows missed."""
    tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    r = outcomes(spark, sf_dir).groupBy("detector", "patient", "roi").agg(F.when(fp == 0, tp / (tp + fn)).alias("v"), (fn / (tp + fn)).alias("m"), (tp + fp + fn).alias("w"))
    found = agg.macro_average(r, ["detector", "patient"], "v", "m", "w")
    return found.withColumn("mean", F.round("mean", 9)).withColumn("missing", F.round("missing", 9))


@query(f"""WITH {RASTER}, p AS (SELECT sample_id, y, x, label % 3 AS channel, y // 8 - a AS py, x // 8 - b AS px, (label * 7 + (y // 8 - a) * 3 + x // 8 - b) % 10 AS p FROM raster, range(2) s(a), range(2) t(b) WHERE y // 8 >= a AND x // 8 >= b),
w AS (SELECT *, greatest(0.5 - 0.5 * cos((y - 8 * py) * (2 * pi() / 15)), 0.001) * greatest(0.5 - 0.5 * cos((x - 8 * px) * (2 * pi() / 15)), 0.001) AS w FROM p)
SELECT sample_id, y, x, channel, round(sum(w * p) / sum(w), 7) AS p FROM w GROUP BY ALL""")
def cosine_blended(spark, sf_dir):
    """Patches of 16 pixels at every eighth, weighted towards their middles."""
    both = F.array(F.lit(0), F.lit(1))
    p = label_raster(spark, sf_dir).withColumn("a", F.explode(both)).withColumn("b", F.explode(both))
    p = p.withColumn("py", F.expr("y div 8 - a")).withColumn("px", F.expr("x div 8 - b")).where("py >= 0 AND px >= 0")
    w = scalars.blend_weight(F.col("y") - 8 * F.col("py"), 16) * scalars.blend_weight(F.col("x") - 8 * F.col("px"), 16)
    patches = p.select("sample_id", "y", "x", (F.col("label") % 3).alias("channel"), F.expr("(label * 7 + py * 3 + px) % 10").alias("p"), w.alias("w"))
    return raster.blended(patches, ["sample_id"]).withColumn("p", F.round("p", 7))

"""Queries over agreement, alignment, sampling and review evidence, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import aggregates as agg
from ..operators import evidence, joins, ordered, raster
from ..operators.graph import stored
from .frames import CELLS, OUTCOMES, PIXELS, RASTER, SCORES, cells, outcomes, pixels, scores, table
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


def _points(spark, sf_dir):
    return cells(spark, sf_dir).select("sample_id", F.col("cell_id").alias("id"), "source", "x", "y")


_PAIRS = "pairs AS (SELECT a.sample_id, a.cell_id AS a, b.cell_id AS b, a.source AS sa, b.source AS sb, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM cells a JOIN cells b ON a.sample_id = b.sample_id AND a.cell_id <> b.cell_id WHERE abs(a.x - b.x) < 24 AND abs(a.y - b.y) < 24)"


@query(f"""WITH {CELLS}, {_PAIRS} SELECT sa AS source_a, sb AS source_b, count(*) AS n, round(median(d), 6) AS median_d, round(quantile_cont(d, 0.95), 6) AS p95_d FROM pairs WHERE d < 24 AND sa < sb GROUP BY ALL""")
def source_agreement(spark, sf_dir):
    near = joins.near_pairs(_points(spark, sf_dir), ["sample_id"], 24.0, ["source"])
    both = stored(near.where("source_a < source_b").select("source_a", "source_b", "d"))
    found = agg.with_percentiles(both.groupBy("source_a", "source_b").agg(F.count("*").alias("n")), both, ["source_a", "source_b"], {"d": {"median_d": 0.5, "p95_d": 0.95}})
    return found.withColumns({c: F.round(c, 6) for c in ("median_d", "p95_d")})


@query(f"""WITH {CELLS}, {_PAIRS}, g AS (SELECT sample_id, a, count(DISTINCT sb) AS others, max(d) AS far, string_agg(DISTINCT sb, ';' ORDER BY sb) AS seen FROM pairs WHERE d < 16 AND sa <> sb GROUP BY ALL)
SELECT c.sample_id, c.cell_id, coalesce(others, 0) AS others, CASE WHEN others IS NULL THEN 'single' WHEN others = 1 THEN 'pair' WHEN far > 12 THEN 'loose' ELSE 'full' END AS tier, coalesce(seen, '') AS seen FROM cells c LEFT JOIN g ON c.cell_id = g.a""")
def agreement_tiers(spark, sf_dir):
    return evidence.tiers(_points(spark, sf_dir), joins.near_pairs(_points(spark, sf_dir), ["sample_id"], 16.0), 12.0).withColumnRenamed("id", "cell_id")


_ALL_PAIRS = "pairs AS (SELECT a.sample_id, a.cell_id AS a, b.cell_id AS b, a.source AS sa, b.source AS sb, abs(a.area - b.area) AS v, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM cells a JOIN cells b ON a.sample_id = b.sample_id AND a.cell_id <> b.cell_id)"


@query(f"WITH {CELLS}, {_ALL_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d2, b) AS k FROM pairs) SELECT sample_id, a, b, round(sqrt(d2), 9) AS d, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 4")
def nearest_cells(spark, sf_dir):
    return joins.nearest(_points(spark, sf_dir), _points(spark, sf_dir), ["sample_id"], 4, 64.0).withColumn("d", F.round("d", 9))


@query(f"""WITH {CELLS}, {_ALL_PAIRS}, r AS (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY d2, b) AS k FROM pairs),
p AS (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY v, b) AS k FROM pairs),
u AS (SELECT a, b, max(o) AS one, max(t) AS two FROM (SELECT a, b, 1 AS o, 0 AS t FROM r WHERE k <= 6 UNION ALL SELECT a, b, 0, 1 FROM p WHERE k <= 6) GROUP BY ALL)
SELECT a AS cell_id, CAST(sum(one * two) AS DOUBLE) / count(*) AS jaccard FROM u GROUP BY a""")
def neighbour_set_overlap(spark, sf_dir):
    """The six nearest in place and the six nearest in area, each from the whole sample."""
    near = joins.nearest(_points(spark, sf_dir), _points(spark, sf_dir), ["sample_id"], 6, 64.0)
    alike = joins.nearest_values(cells(spark, sf_dir).select("sample_id", F.col("cell_id").alias("id"), "area"), ["sample_id"], "area", 6)
    return evidence.neighbour_overlap(near.select("a", "b", "d"), alike.select("a", "b", "d"), 6).withColumnRenamed("a", "cell_id")


@query(f"""WITH {CELLS}, {_ALL_PAIRS}, n AS (SELECT sample_id, a, sa, sqrt(min(d2)) AS d FROM pairs WHERE sa <> sb GROUP BY ALL) SELECT sample_id, sa AS source, count(*) AS n, round(avg(d), 6) AS mean_nearest, round(max(d), 6) AS hausdorff FROM n GROUP BY ALL""")
def nearest_boundary(spark, sf_dir):
    points = _points(spark, sf_dir)
    near = joins.nearest(points, points, ["sample_id"], 1, 64.0, differ="source")
    best = near.join(points.select("sample_id", F.col("id").alias("a"), "source"), ["sample_id", "a"])
    return best.groupBy("sample_id", "source").agg(F.count("*").alias("n"), F.round(F.avg("d"), 6).alias("mean_nearest"), F.round(F.max("d"), 6).alias("hausdorff"))


@query(f"""WITH {CELLS}, c AS (SELECT x % 256 AS lx, y % 256 AS ly, floor(x / 256) AS gx, floor(y / 256) AS gy, sample_id, cell_id FROM cells) SELECT sample_id, CAST(gy * 4 + gx + 1 AS BIGINT) AS owner, count(*) AS n, count(*) FILTER (lx < 32 OR ly < 32 OR lx >= 224 OR ly >= 224) AS near_edge FROM c GROUP BY ALL""")
def shard_ownership(spark, sf_dir):
    cores = raster.lattice(cells(spark, sf_dir), ["sample_id"], 1024, 1024, 256)
    owned = joins.box_join(cells(spark, sf_dir).select("sample_id", "cell_id", "x", "y"), cores, ["sample_id"], 256)
    edge = (F.col("x") < F.col("x0") + 32) | (F.col("y") < F.col("y0") + 32) | (F.col("x") >= F.col("x1") - 32) | (F.col("y") >= F.col("y1") - 32)
    return owned.groupBy("sample_id", F.col("label").alias("owner")).agg(F.count("*").alias("n"), F.count_if(edge).alias("near_edge"))


@query(f"""WITH {RASTER}, l AS (SELECT DISTINCT sample_id, label FROM raster WHERE label <> 3 OR sample_id % 2 = 0), m AS (SELECT sample_id, max(label) AS m FROM l GROUP BY ALL), e AS (SELECT sample_id, unnest(generate_series(1, m)) AS label FROM m)
SELECT sample_id, label FROM e WHERE (sample_id, label) NOT IN (SELECT sample_id, label FROM l)""")
def missing_labels(spark, sf_dir):
    return evidence.missing_labels(label_raster(spark, sf_dir).where("label <> 3 OR sample_id % 2 = 0"), ["sample_id"])


@query(f"""WITH {RASTER}, t AS (SELECT sample_id, y // 4 AS ty, x // 4 AS tx, min(label) = max(label) AND count(*) = 16 AS pure, avg(label) AS m FROM raster GROUP BY ALL) SELECT sample_id, count(*) FILTER (pure) AS pure, count(*) AS tokens, round(avg(m), 9) AS mean FROM t GROUP BY ALL""")
def token_purity(spark, sf_dir):
    return evidence.tokens(label_raster(spark, sf_dir), ["sample_id"], 4).groupBy("sample_id").agg(F.count_if("pure").alias("pure"), F.count("*").alias("tokens"), F.round(F.avg("mean"), 9).alias("mean"))


@query(f"""WITH {RASTER}, t AS (SELECT sample_id, y // 8 AS ty, x // 8 AS tx, avg(label) AS v FROM raster GROUP BY ALL), p AS (SELECT sample_id, y, x, (y + 0.5) / 8 - 0.5 AS fy, (x + 0.5) / 8 - 0.5 AS fx FROM raster),
n AS (SELECT p.sample_id, p.y, p.x, t.v, (1 - abs(fy - t.ty)) * (1 - abs(fx - t.tx)) AS w FROM p JOIN t ON p.sample_id = t.sample_id AND abs(fy - t.ty) < 1 AND abs(fx - t.tx) < 1)
SELECT sample_id, y, x, round(sum(w * v) / sum(w) + 1e-9, 6) AS v FROM n GROUP BY ALL""")
def bilinear_projection(spark, sf_dir):
    r = label_raster(spark, sf_dir)
    tokens = evidence.tokens(r, ["sample_id"], 8).select("sample_id", "ty", "tx", F.col("mean").alias("v"))
    return evidence.bilinear(r.select("sample_id", "y", "x"), tokens, ["sample_id"], 8).withColumn("v", F.round(F.col("v") + 1e-9, 6))  # many values are halves of the last digit


@query(f"""WITH {PIXELS}, q AS (SELECT sample_id, quantile_cont(score, 0.02) AS lo, quantile_cont(score, 0.98) AS hi FROM pixels GROUP BY ALL) SELECT p.sample_id, count(*) AS n, round(avg(least(greatest((score - lo) / nullif(hi - lo, 0), 0), 1)), 9) AS mean FROM pixels p JOIN q ON p.sample_id = q.sample_id GROUP BY ALL""")
def scaled_intensity(spark, sf_dir):
    return evidence.percentile_scaled(pixels(spark, sf_dir), ["sample_id"], "score", 0.02, 0.98).groupBy("sample_id").agg(F.count("*").alias("n"), F.round(F.avg("scaled"), 9).alias("mean"))


@query(f"""WITH {PIXELS} SELECT label % 10 AS channel, count(*) AS n, avg((score < 5)::INT) AS near_zero, avg((score >= 50)::INT) AS saturated, round(corr(score, other), 9) AS r, avg(score) FILTER (nucleus > 0) AS inside, avg(score) FILTER (nucleus = 0) AS outside FROM pixels WHERE label > 0 GROUP BY ALL""")
def marker_quality(spark, sf_dir):
    p = pixels(spark, sf_dir).where("label > 0").withColumn("channel", F.col("label") % 10)
    stats = p.groupBy("channel").agg(
        F.count("*").alias("n"), F.avg((F.col("score") < 5).cast("int")).alias("near_zero"), F.avg((F.col("score") >= 50).cast("int")).alias("saturated"), F.avg(F.when(F.col("nucleus") > 0, F.col("score"))).alias("inside"), F.avg(F.when(F.col("nucleus") == 0, F.col("score"))).alias("outside")
    )
    return stats.join(agg.correlation(p, ["channel"], "score", "other", "r").withColumn("r", F.round("r", 9)), "channel")


@query(f"""WITH {SCORES}, h AS (SELECT grp, least(score, 255) AS bin, sum(truth) AS pos, count(*) AS n FROM scores GROUP BY ALL), c AS (SELECT *, sum(n) OVER (PARTITION BY grp ORDER BY bin DESC) AS above, sum(pos) OVER (PARTITION BY grp) AS target, sum(pos) OVER (PARTITION BY grp ORDER BY bin DESC) AS hits FROM h),
t AS (SELECT grp, max(bin) AS cut FROM c WHERE above >= target GROUP BY ALL) SELECT c.grp, cut, CAST(2 * hits AS DOUBLE) / (above + target) AS dice FROM c JOIN t ON c.grp = t.grp AND c.bin = t.cut""")
def prevalence_threshold(spark, sf_dir):
    counts = scores(spark, sf_dir).groupBy("grp", F.least("score", F.lit(255)).alias("bin")).agg(F.sum("truth").alias("pos"), F.count("*").alias("n"))
    return evidence.prevalence_threshold(counts, ["grp"])


@query("""WITH d AS (SELECT s_suppkey % 7 AS device, s_suppkey AS path, s_acctbal AS need, (s_suppkey % 7 + 1) * 30000.0 AS free FROM supplier), g AS (SELECT device, count(*) AS paths, round(sum(need), 2) AS need, max(free) AS free FROM d GROUP BY ALL)
SELECT device, paths, need, free, CASE WHEN need > free THEN 'insufficient' WHEN need > 0.8 * free THEN 'tight' ELSE 'ok' END AS status FROM g""")
def storage_demand(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 7).alias("device"), F.col("s_acctbal").alias("need"), ((F.col("s_suppkey") % 7 + 1) * 30000.0).alias("free"))
    return evidence.storage_status(s).withColumn("need", F.round("need", 2))


@query("""WITH f(stage, factor) AS (VALUES ('AUTOMOBILE', 1.5), ('BUILDING', 2.0), ('MACHINERY', 0.25)), s AS (SELECT c_mktsegment AS stage, CAST(sum(CAST(c_custkey AS BIGINT)) AS DOUBLE) AS bytes FROM customer GROUP BY ALL) SELECT s.stage, CAST(ceil(bytes * coalesce(factor, 1.0) * 1.1) AS BIGINT) AS demand FROM s LEFT JOIN f ON s.stage = f.stage""")
def stage_demand(spark, sf_dir):
    factors = spark.createDataFrame([("AUTOMOBILE", 1.5), ("BUILDING", 2.0), ("MACHINERY", 0.25)], "stage string, factor double")
    bytes_ = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("stage")).agg(F.sum("c_custkey").cast("double").alias("bytes"))
    return bytes_.join(F.broadcast(factors), "stage", "left").select("stage", F.ceil(F.col("bytes") * F.coalesce("factor", F.lit(1.0)) * 1.1).cast("long").alias("demand"))


@query(f"""WITH {OUTCOMES}, s AS (SELECT detector || tissue AS method, min(tp) AS low, round(avg(tp), 9) AS mean, CAST(sum(fp) AS BIGINT) AS cost FROM outcomes GROUP BY ALL) SELECT *, CAST(row_number() OVER (ORDER BY mean DESC, low DESC, cost, method) AS INTEGER) AS rank FROM s""")
def method_ranking(spark, sf_dir):
    s = outcomes(spark, sf_dir).groupBy(F.concat("detector", F.col("tissue").cast("string")).alias("method")).agg(F.min("tp").alias("low"), F.round(F.avg("tp"), 9).alias("mean"), F.sum("fp").alias("cost"))
    return s.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean"), F.desc("low"), "cost", "method")))


@query(f"""WITH {CELLS}, r AS (SELECT cell_id, kind, CASE WHEN (cell_id * 7 + r) % 10 < 8 THEN kind ELSE kind % 5 + 1 END AS again FROM cells, range(4) t(r)) SELECT cell_id, avg((kind = again)::INT) AS stability FROM r GROUP BY cell_id""")
def replicate_stability(spark, sf_dir):
    r = cells(spark, sf_dir).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(3))))
    again = F.when((F.col("cell_id") * 7 + F.col("r")) % 10 < 8, F.col("kind")).otherwise(F.col("kind") % 5 + 1)
    return r.groupBy("cell_id").agg(F.avg((F.col("kind") == again).cast("int")).alias("stability"))


@query()
def aligned_labels(spark, sf_dir):
    """Greedy matching is order-dependent and has no short SQL; tested against a loop."""
    c = cells(spark, sf_dir)
    return evidence.align_labels(c.select("sample_id", F.col("kind").alias("reference"), (F.expr("(kind + sample_id) % 5") * 10).alias("label")), ["sample_id"])


@query(f"""WITH {CELLS}, k AS (SELECT sample_id, cell_id, -ln(greatest(CAST('0x' || substr(md5(CAST(cell_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0, 1e-12)) / area AS key FROM cells), r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY key, cell_id) AS nth FROM k) SELECT sample_id, cell_id, CAST(nth AS INTEGER) AS nth FROM r WHERE nth <= 20""")
def weighted_landmarks(spark, sf_dir):
    return evidence.weighted_sample(cells(spark, sf_dir), ["sample_id"], "cell_id", "area", 20)


@query(f"""WITH {CELLS}, b AS (SELECT sample_id, cell_id, row_number() OVER (PARTITION BY sample_id, floor(x / 256), floor(y / 256) ORDER BY md5(CAST(cell_id AS VARCHAR)), cell_id) AS nth FROM cells) SELECT sample_id, cell_id, CAST(nth AS INTEGER) AS nth FROM b WHERE nth <= 2""")
def balanced_landmarks(spark, sf_dir):
    c = cells(spark, sf_dir).withColumn("bx", F.floor(F.col("x") / 256)).withColumn("by", F.floor(F.col("y") / 256))
    draw = F.struct(F.md5(F.col("cell_id").cast("string")), F.col("cell_id"))
    return ordered.hashed_sample(c, ["sample_id", "bx", "by"], 2, draw).select("sample_id", "cell_id", "nth")


@query(f"""WITH {CELLS}, s AS (SELECT sample_id, cell_id, kind, x, y FROM cells WHERE cell_id % 25 = 0), p AS (SELECT a.sample_id, a.cell_id AS a, a.kind AS ka, b.kind AS kb, avg(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS d, count(*) AS n FROM s a JOIN s b ON a.sample_id = b.sample_id AND a.cell_id <> b.cell_id GROUP BY ALL),
w AS (SELECT sample_id, a, max(d) FILTER (ka = kb) AS own, min(d) FILTER (ka <> kb) AS other FROM p GROUP BY ALL) SELECT sample_id, count(*) AS n, round(avg(CASE WHEN own IS NULL OR other IS NULL THEN 0 ELSE (other - own) / greatest(own, other) END), 9) AS silhouette FROM w GROUP BY sample_id""")
def sampled_silhouette(spark, sf_dir):
    s = cells(spark, sf_dir).where("cell_id % 25 = 0").select("sample_id", F.col("cell_id").alias("id"), F.col("kind").alias("cluster"), "x", "y")
    return evidence.silhouette(s, ["sample_id"]).withColumn("silhouette", F.round("silhouette", 9))


@query(f"""WITH {CELLS}, s AS (SELECT sample_id, avg(x) AS mx, avg(y) AS my, avg(area) AS ma, avg(patient) AS mp FROM cells GROUP BY ALL)
SELECT c.sample_id, round(sqrt(pow(sum((x - mx) * (area - ma)) + sum((y - my) * (patient - mp)), 2) + pow(sum((x - mx) * (patient - mp)) - sum((y - my) * (area - ma)), 2)) / sqrt((sum((x - mx) * (x - mx)) + sum((y - my) * (y - my))) * (sum((area - ma) * (area - ma)) + sum((patient - mp) * (patient - mp)))), 7) AS correlation FROM cells c JOIN s ON c.sample_id = s.sample_id GROUP BY ALL""")
def rotation_fit(spark, sf_dir):
    c = cells(spark, sf_dir).select("sample_id", "x", "y", F.col("area").cast("double").alias("u"), F.col("patient").cast("double").alias("v"))
    return evidence.rotation_fit(c, ["sample_id"]).withColumn("correlation", F.round("correlation", 7))


@query(f"""WITH {CELLS}, s AS (SELECT sample_id, kind AS k, count(*) AS n, round(avg(probability), 9) AS score, CAST(count(*) FILTER (area < 8) AS DOUBLE) / count(*) AS tiny FROM cells GROUP BY ALL), m AS (SELECT *, max(score) OVER (PARTITION BY sample_id) AS best FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY k, tiny, score DESC) AS r FROM m WHERE score >= best - 0.03) SELECT sample_id, k, score FROM r WHERE r = 1""")
def chosen_resolution(spark, sf_dir):
    s = cells(spark, sf_dir).groupBy("sample_id", F.col("kind").alias("k")).agg(F.round(F.avg("probability"), 9).alias("score"), (F.count_if(F.col("area") < 8) / F.count("*")).alias("tiny"))
    return evidence.cascade(s, ["sample_id"], "score", 0.03, ["k", "tiny", F.desc("score")]).select("sample_id", "k", "score")


@query("""WITH w AS (SELECT o_orderkey % 40 AS wanted, o_custkey % 64 AS have FROM orders), r AS (SELECT DISTINCT wanted, have FROM w)
SELECT wanted, CASE WHEN max(have) FILTER (have <= wanted) IS NOT NULL THEN max(have) FILTER (have <= wanted) ELSE min(have) END AS have FROM r GROUP BY wanted""")
def nearest_dimension(spark, sf_dir):
    w = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 40).alias("wanted"), (F.col("o_custkey") % 64).alias("have"))
    return w.groupBy("wanted").agg(F.coalesce(F.max(F.when(F.col("have") <= F.col("wanted"), F.col("have"))), F.min("have")).alias("have"))


@query("""WITH l AS (SELECT p_brand AS path, count(*) FILTER (p_size % 3 > 0) AS filled, bool_and(p_size > 1) AS texty FROM part GROUP BY ALL) SELECT arg_max(path, (filled, texty::INT, path)) AS path, max(filled) AS filled FROM l""")
def chosen_label_path(spark, sf_dir):
    per = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("path")).agg(F.count_if(F.expr("p_size % 3 > 0")).alias("filled"), F.bool_and(F.expr("p_size > 1")).alias("texty"))
    return per.agg(F.max_by("path", F.struct("filled", "texty", "path")).alias("path"), F.max("filled").alias("filled"))


@query("""SELECT p_brand AS stage, string_agg(DISTINCT f, ';' ORDER BY f) AS missing, count(*) AS n FROM (SELECT p_brand, unnest(CASE WHEN p_size % 2 = 0 THEN ['hash', 'version'] WHEN p_size > 40 THEN ['license'] ELSE [] END) AS f FROM part) GROUP BY ALL""")
def inventory_gaps(spark, sf_dir):
    fields = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("hash"), F.lit("version"))).when(F.col("p_size") > 40, F.array(F.lit("license")))
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("stage"), F.explode(fields).alias("f"))
    return rows.groupBy("stage").agg(F.array_join(F.array_sort(F.collect_set("f")), ";").alias("missing"), F.count("*").alias("n"))


@query(f"""WITH {CELLS}, d AS (SELECT kind, count(*) FILTER (source = 'F') AS hits, count(*) AS n FROM cells GROUP BY ALL) SELECT kind, CAST(hits AS DOUBLE) / n AS declared, abs(CAST(hits AS DOUBLE) / n - CAST(hits AS DOUBLE) / (n + kind % 2)) <= 1e-12 * greatest(1, CAST(hits AS DOUBLE) / n) AS agrees FROM d""")
def declared_metrics(spark, sf_dir):
    d = cells(spark, sf_dir).groupBy("kind").agg(F.count_if(F.col("source") == "F").alias("hits"), F.count("*").alias("n"))
    declared, found = F.col("hits") / F.col("n"), F.col("hits") / (F.col("n") + F.col("kind") % 2)
    return d.select("kind", declared.alias("declared"), (F.abs(declared - found) <= 1e-12 * F.greatest(F.lit(1.0), declared)).alias("agrees"))


@query(f"""WITH {CELLS}, b AS (SELECT sample_id, patient % 4 AS route, kind FROM cells), c AS (SELECT route, count(*) AS n, count(*) FILTER (kind > 1) AS accepted FROM b GROUP BY ALL) SELECT route, n, CAST(accepted AS DOUBLE) / n AS coverage, 1 - CAST(accepted AS DOUBLE) / n AS abstained FROM c""")
def route_coverage(spark, sf_dir):
    b = cells(spark, sf_dir).groupBy((F.col("patient") % 4).alias("route")).agg(F.count("*").alias("n"), F.count_if(F.col("kind") > 1).alias("accepted"))
    return b.select("route", "n", (F.col("accepted") / F.col("n")).alias("coverage"), (1 - F.col("accepted") / F.col("n")).alias("abstained"))


@query("""SELECT event_type, count(*) FILTER (date_diff('second', ts, TIMESTAMP '2024-02-01') > 14400) AS stale, count(*) AS n FROM events GROUP BY ALL""")
def stale_receipts(spark, sf_dir):
    age = F.unix_seconds(F.lit("2024-02-01 00:00:00").cast("timestamp")) - F.unix_seconds(F.date_trunc("second", F.col("ts").cast("timestamp")))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(age > 14400).alias("stale"), F.count("*").alias("n"))


@query("""SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL""")
def json_properties(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type", scalars.whole_number(scalars.json_path(F.col("props"), "missing.k", "k")).alias("k")).agg(F.count("*").alias("n"))


@query(f"""WITH {RASTER}, p AS (SELECT sample_id, y, x, label FROM raster), c AS (SELECT sample_id, label, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1, count(*) AS area FROM p WHERE label IN (2, 5) GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY area DESC, label) AS r FROM c)
SELECT sample_id, greatest(x0 - 3, 0) AS x0, greatest(y0 - 3, 0) AS y0, least(x1 + 3, 64) AS x1, least(y1 + 3, 64) AS y1 FROM b WHERE r = 1""")
def crop_bounds(spark, sf_dir):
    r = label_raster(spark, sf_dir).where("label IN (2, 5)")
    boxes = r.groupBy("sample_id", "label").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") + 1).alias("x1"), (F.max("y") + 1).alias("y1"), F.count("*").alias("area"))
    best = ordered.first_of(boxes, ["sample_id"], [F.desc("area"), "label"])
    return evidence.padded(best, 3, 64, 64).select("sample_id", "x0", "y0", "x1", "y1")


@query(f"""WITH RECURSIVE {CELLS}, s AS (SELECT sample_id AS id, 0 AS level, CAST(max(x) * 8 AS BIGINT) AS w, CAST(max(y) * 8 AS BIGINT) AS h FROM cells GROUP BY sample_id UNION ALL SELECT id, level + 1, (w + 1) // 2, (h + 1) // 2 FROM s WHERE greatest(w, h) > 256) SELECT id, level, w, h FROM s""")
def pyramid_levels(spark, sf_dir):
    n = cells(spark, sf_dir).groupBy(F.col("sample_id").alias("id")).agg((F.max("x") * 8).cast("long").alias("w"), (F.max("y") * 8).cast("long").alias("h"))
    return evidence.pyramid(n, "id", 256)


@query(f"""WITH {RASTER}, l AS (SELECT DISTINCT sample_id, label FROM raster), g AS (SELECT sample_id, label, avg(y) AS cy, avg(x) AS cx, count(*) AS n FROM raster GROUP BY ALL), s AS (SELECT * FROM g WHERE n < 400), b AS (SELECT * FROM g WHERE n >= 400),
p AS (SELECT s.sample_id, s.label, b.label AS merged, row_number() OVER (PARTITION BY s.sample_id, s.label ORDER BY round((s.cy - b.cy) * (s.cy - b.cy) + (s.cx - b.cx) * (s.cx - b.cx), 9), b.label) AS r FROM s JOIN b ON s.sample_id = b.sample_id)
SELECT sample_id, label, merged FROM p WHERE r = 1 UNION ALL SELECT sample_id, label, label FROM b""")
def merged_small_clusters(spark, sf_dir):
    return evidence.merge_small(label_raster(spark, sf_dir), ["sample_id"], 400)


@query(f"""WITH {CELLS}, b AS (SELECT sample_id, CAST(floor(x / 64) AS BIGINT) AS bx, CAST(floor(y / 64) AS BIGINT) AS by_, count(*) AS n FROM cells GROUP BY ALL),
l AS (SELECT sample_id, max(lv) AS level FROM (SELECT sample_id, lv, sum(least(n, lv)) AS t FROM b, range(0, 1001) r(lv) GROUP BY ALL) WHERE t <= 300 GROUP BY sample_id),
q AS (SELECT b.*, least(n, level) + CASE WHEN n > level AND row_number() OVER (PARTITION BY b.sample_id, n > level ORDER BY md5(bx || ':' || by_), bx, by_) <= 300 - sum(least(n, level)) OVER (PARTITION BY b.sample_id) THEN 1 ELSE 0 END AS quota FROM b JOIN l ON b.sample_id = l.sample_id),
c AS (SELECT *, row_number() OVER (PARTITION BY sample_id, floor(x / 64), floor(y / 64) ORDER BY md5(CAST(cell_id AS VARCHAR)), cell_id) AS nth FROM cells)
SELECT c.sample_id, cell_id, CAST(quota AS BIGINT) AS quota, CAST(nth AS INTEGER) AS nth FROM c JOIN q ON c.sample_id = q.sample_id AND floor(x / 64) = bx AND floor(y / 64) = by_ WHERE nth <= quota""")
def even_landmarks(spark, sf_dir):
    """Landmarks spread as evenly as may be over occupied boxes."""
    return evidence.even_sample(cells(spark, sf_dir), ["sample_id"], "cell_id", 64.0, 300)


@query(f"""WITH {CELLS}, {_ALL_PAIRS}, r AS (SELECT sample_id, a, sqrt(d2) AS d, row_number() OVER (PARTITION BY a ORDER BY d2, b) AS k FROM pairs),
m AS (SELECT sample_id, a, avg(d) AS d FROM r WHERE k <= 6 GROUP BY ALL), l AS (SELECT sample_id, quantile_cont(d, 0.001) AS low FROM m WHERE d > 0 GROUP BY ALL),
w AS (SELECT m.sample_id, a AS cell_id, -ln(greatest(CAST('0x' || substr(md5(CAST(a AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0, 1e-12)) * greatest(d, coalesce(low, 0)) AS key FROM m LEFT JOIN l ON m.sample_id = l.sample_id)
SELECT sample_id, cell_id, CAST(nth AS INTEGER) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY key, cell_id) AS nth FROM w) WHERE nth <= 50""")
def inverse_distance_landmarks(spark, sf_dir):
    """Landmarks drawn where cells lie close together."""
    points = _points(spark, sf_dir)
    weights = evidence.inverse_distance_weights(points, ["sample_id"], 6, 1.0, 64.0)
    return evidence.weighted_sample(weights.withColumnRenamed("id", "cell_id"), ["sample_id"], "cell_id", "weight", 50)


@query(f"""WITH {CELLS}, r AS (SELECT sample_id, count(*) AS n, corr(x, area) AS xu, corr(x, patient) AS xv, corr(y, area) AS yu, corr(y, patient) AS yv FROM cells GROUP BY ALL),
t AS (SELECT sample_id, n, sqrt(xu * xu + xv * xv + yu * yu + yv * yv + 2 * abs(xu * yv - xv * yu)) AS total FROM r)
SELECT sample_id, n, round(total / 2, 7) AS correlation, round(sqrt((4 - 2 * total) * (n - 1) / (2 * n)), 7) AS rmse FROM t""")
def procrustes_fit(spark, sf_dir):
    """How well one standardised plane falls on another, mirrored or not."""
    c = cells(spark, sf_dir).select("sample_id", "x", "y", F.col("area").cast("double").alias("u"), F.col("patient").cast("double").alias("v"))
    return evidence.procrustes(c, ["sample_id"]).withColumns({n: F.round(n, 7) for n in ("correlation", "rmse")})

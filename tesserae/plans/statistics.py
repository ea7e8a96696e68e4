"""Queries over outcomes, scores and records, each with its SQL."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import aggregates as agg
from ..operators import constraints, geometry, joins, ordered
from ..sources import records
from ..streaming import zonal as streams
from .frames import CELLS, OUTCOMES, PIXELS, SCORES, cells, outcomes, pixels, scores, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _metrics(source: str, keys: str, more: str = "") -> str:
    return f"""SELECT {keys}, tp, fp, fn{more}, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall,
  CASE WHEN tp = 0 AND tp + fp > 0 OR tp = 0 AND tp + fn > 0 THEN 0.0 ELSE 2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / nullif((tp / nullif(tp + fp, 0)) + (tp / nullif(tp + fn, 0)), 0) END AS f1,
  tp / nullif(tp + fp + fn, 0) AS jaccard FROM {source}"""


@query(f"WITH {OUTCOMES}, s AS (SELECT split, detector, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM outcomes GROUP BY ALL) " + _metrics("s", "split, detector"))
def detector_totals(spark, sf_dir):
    return agg.totals(outcomes(spark, sf_dir), ["split", "detector"])


@query(
    f"""WITH {OUTCOMES}, u AS (SELECT detector, 'tissue' AS stratum, CAST(tissue AS VARCHAR) AS value, patient, tp, fp, fn FROM outcomes UNION ALL SELECT detector, 'site', CAST(site AS VARCHAR), patient, tp, fp, fn FROM outcomes),
s AS (SELECT detector, stratum, value, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn, count(DISTINCT patient) AS patients FROM u GROUP BY ALL) """
    + _metrics("s", "detector, stratum, value", ", patients")
)
def stratified_metrics(spark, sf_dir):
    return agg.stratified(outcomes(spark, sf_dir), ["detector"], ["tissue", "site"])


@query(f"WITH {OUTCOMES} SELECT split, detector, tissue, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn, CAST(grouping_id(split, detector, tissue) AS BIGINT) AS level FROM outcomes GROUP BY ROLLUP (split, detector, tissue)")
def rolled_up_outcomes(spark, sf_dir):
    return agg.grouped_sets(outcomes(spark, sf_dir), ["split", "detector", "tissue"])


_CUMULATIVE = itertools.accumulate(math.exp(-1.0) / math.factorial(k) for k in range(6))
_WEIGHT = " + ".join(f"(u >= {t!r})::INT" for t in _CUMULATIVE)


@query(f"""WITH {OUTCOMES}, s AS (SELECT detector, patient, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM outcomes GROUP BY ALL),
d AS (SELECT *, CAST('0x' || substr(md5(patient || ':' || draw), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM s, range(200) r(draw)),
w AS (SELECT *, {_WEIGHT} AS w FROM d), f AS (SELECT detector, draw, CAST(2 * sum(tp * w) AS DOUBLE) / nullif(2 * sum(tp * w) + sum(fp * w) + sum(fn * w), 0) AS f1 FROM w GROUP BY ALL)
SELECT detector, round(quantile_cont(f1, 0.025), 9) AS low, round(quantile_cont(f1, 0.975), 9) AS high, round(avg(f1), 9) AS mean FROM f GROUP BY detector""")
def bootstrap_intervals(spark, sf_dir):
    out = agg.bootstrap(outcomes(spark, sf_dir), ["detector"], "patient", 200)
    return out.select("detector", *(F.round(c, 9).alias(c) for c in ("low", "high", "mean")))


@query(f"""WITH {OUTCOMES}, m AS (SELECT roi, detector, sum(tp)::BIGINT AS v FROM outcomes GROUP BY ALL), p AS (SELECT a.roi, a.detector AS who_a, b.detector AS who_b, a.v - b.v AS difference FROM m a JOIN m b ON a.roi = b.roi WHERE a.detector < b.detector)
SELECT who_a, who_b, count(*) AS n, CAST(sum(difference) AS BIGINT) AS total, median(difference) AS median FROM p GROUP BY ALL""")
def paired_differences(spark, sf_dir):
    m = outcomes(spark, sf_dir).groupBy("roi", "detector").agg(F.sum("tp").alias("v"))
    pairs = joins.compare_units(m, ["roi"], "detector", "v")
    found = pairs.groupBy("who_a", "who_b").agg(F.count("*").alias("n"), F.sum("difference").alias("total"))
    return agg.with_percentiles(found, pairs, ["who_a", "who_b"], {"difference": {"median": 0.5}})


@query(f"""WITH {OUTCOMES}, r AS (SELECT detector, patient, roi, sum(tp) / nullif(sum(tp) + sum(fp), 0) AS v, sum(tp) AS w FROM outcomes GROUP BY ALL), p AS (SELECT detector, patient, avg(v) AS v FROM r GROUP BY ALL)
SELECT detector, count(*) AS patients, round(avg(v), 9) AS macro FROM p GROUP BY detector""")
def patient_macro_average(spark, sf_dir):
    tp, fp = F.sum("tp"), F.sum("fp")
    r = outcomes(spark, sf_dir).groupBy("detector", "patient", "roi").agg(agg.safe_ratio(tp, tp + fp).alias("v"))
    return r.groupBy("detector", "patient").agg(F.avg("v").alias("v")).groupBy("detector").agg(F.count("*").alias("patients"), F.round(F.avg("v"), 9).alias("macro"))


@query(f"""WITH {CELLS}, n AS (SELECT sample_id, source, kind, count(*) AS n FROM cells GROUP BY ALL),
w AS (SELECT *, sum(n) OVER (PARTITION BY sample_id, source) AS na, sum(n) OVER (PARTITION BY sample_id, kind) AS nb, sum(n) OVER (PARTITION BY sample_id) AS nn FROM n),
s AS (SELECT sample_id, CAST(max(nn) AS DOUBLE) AS nn, sum(n * (n - 1) / 2) AS same, sum((na - 1) / 2 * n) AS ra, sum((nb - 1) / 2 * n) AS rb, sum(n / nn * ln(n * nn / (na * nb))) AS mi, sum(-n / nn * ln(na / nn)) AS ha, sum(-n / nn * ln(nb / nn)) AS hb FROM w GROUP BY ALL)
SELECT sample_id, round((same - ra * rb / (nn * (nn - 1) / 2)) / ((ra + rb) / 2 - ra * rb / (nn * (nn - 1) / 2)), 9) AS ari, round(mi, 9) AS mi, round(2 * mi / (ha + hb), 9) AS nmi, round(mi / ha, 9) AS homogeneity, round(mi / hb, 9) AS completeness, round(ha + hb - 2 * mi, 9) AS variation FROM s""")
def partition_agreement(spark, sf_dir):
    out = agg.contingency(cells(spark, sf_dir), ["sample_id"], "source", "kind")
    return out.select("sample_id", *(F.round(c, 9).alias(c) for c in out.columns[1:]))


@query(f"""WITH {SCORES}, s AS (SELECT grp, score, sum(truth) AS pos, sum(1 - truth) AS neg FROM scores GROUP BY ALL),
c AS (SELECT *, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp, coalesce(sum(neg) OVER (PARTITION BY grp ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s WINDOW d AS (PARTITION BY grp ORDER BY score DESC))
SELECT grp, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives, CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / (2 * sum(pos) * sum(neg)) AS auroc, round(sum(pos * tp / (tp + fp)) / sum(pos), 9) AS average_precision FROM c GROUP BY grp""")
def ranking_quality(spark, sf_dir):
    return agg.ranked_curve(scores(spark, sf_dir), ["grp"]).withColumn("average_precision", F.round("average_precision", 9))


@query(f"""WITH {SCORES}, r AS (SELECT grp, rank() OVER (PARTITION BY grp ORDER BY score) + (count(*) OVER (PARTITION BY grp, score) - 1) / 2 AS a, rank() OVER (PARTITION BY grp ORDER BY measured) + (count(*) OVER (PARTITION BY grp, measured) - 1) / 2 AS b FROM scores)
SELECT grp, round(corr(a, b), 9) AS spearman FROM r GROUP BY grp""")
def rank_correlation(spark, sf_dir):
    return agg.spearman(scores(spark, sf_dir), ["grp"], "score", "measured").withColumn("spearman", F.round("spearman", 9))


@query(f"""WITH {SCORES}, c AS (SELECT grp, corr(score, measured) AS ab, corr(score, id) AS ac, corr(measured, id) AS bc FROM scores GROUP BY grp) SELECT grp, round((ab - ac * bc) / sqrt((1 - ac * ac) * (1 - bc * bc)), 7) AS partial FROM c""")
def partial_correlation(spark, sf_dir):
    s = scores(spark, sf_dir).withColumn("id", F.col("id").cast("double"))
    return agg.partial_correlation(s, ["grp"], "score", "measured", "id").withColumn("partial", F.round("partial", 7))


@query()
def partial_correlation_many(spark, sf_dir):
    """Several controls have no short SQL; tested against least squares."""
    s = scores(spark, sf_dir).withColumn("half", F.col("id") % 7)
    return agg.partial_by_many(s, ["grp"], "score", "measured", ["id", "half"])


@query(f"WITH {SCORES} SELECT grp, quantile_cont(score, 0.01) AS q01, quantile_cont(score, 0.5) AS q50, quantile_cont(score, 0.99) AS q99, avg((score = 0)::INT) AS zero_share, avg((score >= 100)::INT) AS top_share FROM scores GROUP BY grp")
def score_distribution(spark, sf_dir):
    return agg.distribution(scores(spark, sf_dir), ["grp"], "score", 100)


@query(f"""WITH {SCORES}, h AS (SELECT grp, least(score, 255) AS bin, sum(truth) AS pos, sum(1 - truth) AS neg FROM scores GROUP BY ALL), c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY grp ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM h)
SELECT grp, CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / (2 * sum(pos) * sum(neg)) AS auc FROM c GROUP BY grp""")
def histogram_auc(spark, sf_dir):
    counts = scores(spark, sf_dir).groupBy("grp", F.least("score", F.lit(255)).alias("bin")).agg(F.sum("truth").alias("pos"), F.sum(1 - F.col("truth")).alias("neg"))
    return agg.histogram_auc(counts, ["grp"])


@query(f"""WITH {SCORES}, h AS (SELECT grp, least(score, 255) AS bin, count(*) AS n FROM scores GROUP BY ALL), c AS (SELECT grp, bin, sum(n) OVER (PARTITION BY grp ORDER BY bin) AS run, sum(n) OVER (PARTITION BY grp) AS total FROM h)
SELECT grp, CAST((min(bin) + 0.5) / 256 AS DOUBLE) AS value FROM c WHERE run >= ceil(0.9 * total) GROUP BY grp""")
def histogram_quantile(spark, sf_dir):
    counts = scores(spark, sf_dir).groupBy("grp", F.least("score", F.lit(255)).alias("bin")).agg(F.count("*").alias("n"))
    return agg.histogram_quantile(counts, ["grp"], 0.9, 256)


@query("""WITH p AS (SELECT unnest(generate_series(0, len(embedding) - 1)) AS feature, floor(unnest(embedding)::DOUBLE * 1024) AS v FROM embeddings), s AS (SELECT feature, count(v) AS n, sum(v) AS s, sum(v * v) AS ss FROM p GROUP BY ALL)
SELECT CAST(feature AS INTEGER) AS feature, round(ss / n - (s / n) * (s / n), 6) AS variance FROM s ORDER BY ss / n - (s / n) * (s / n) DESC, feature LIMIT 10""")
def top_variance_features(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024).cast("double")).alias("e"))
    return agg.top_variance(e, "e", 10).withColumn("variance", F.round("variance", 6))


@query(f"WITH {CELLS}, m AS (SELECT kind, median(area) AS middle FROM cells GROUP BY ALL) SELECT c.kind, max(middle) AS middle, median(abs(area - middle)) AS mad FROM cells c JOIN m ON c.kind = m.kind GROUP BY ALL")
def robust_area_scale(spark, sf_dir):
    return agg.robust_scale(cells(spark, sf_dir), ["kind"], "area")


@query(f"WITH {CELLS}, v AS (SELECT cell_id, CASE WHEN kind = 2 THEN NULL ELSE probability END AS p FROM cells) SELECT cell_id, coalesce(p, (SELECT median(p) FROM v), 0.0) AS p FROM v")
def median_imputed(spark, sf_dir):
    v = cells(spark, sf_dir).select("cell_id", F.when(F.col("kind") != 2, F.col("probability")).alias("p"))
    return agg.impute_median(v, "p")


@query(f"""WITH {CELLS}, u AS (SELECT kind, 'area' AS marker, CAST(area AS DOUBLE) AS value FROM cells UNION ALL SELECT kind, 'patient', patient FROM cells), o AS (SELECT marker, avg(value) AS overall, stddev_samp(value) AS sd FROM u GROUP BY ALL)
SELECT kind, u.marker, count(*) AS n, avg(value) AS mean, median(value) AS median, max(overall) AS overall, round((avg(value) - max(overall)) / nullif(max(sd), 0), 9) AS smd FROM u JOIN o ON u.marker = o.marker GROUP BY ALL""")
def marker_enrichment(spark, sf_dir):
    c = cells(spark, sf_dir).select("kind", F.col("area").cast("double").alias("area"), F.col("patient").cast("double").alias("patient"))
    return agg.enrichment(c, "kind", ["area", "patient"]).withColumn("smd", F.round("smd", 9))


@query(f"""WITH {CELLS}, n AS (SELECT source AS t, CASE kind % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS p, count(*) AS n FROM cells GROUP BY ALL), a AS (SELECT t AS c, sum(n) AS s, sum(n) FILTER (t = p) AS h FROM n GROUP BY ALL), b AS (SELECT p AS c, sum(n) AS m FROM n GROUP BY ALL)
SELECT a.c AS class, CAST(s AS BIGINT) AS support, CAST(m AS BIGINT) AS named, h / m AS precision, h / s AS recall, h / (s + m - h) AS iou FROM a JOIN b ON a.c = b.c""")
def class_confusion(spark, sf_dir):
    c = cells(spark, sf_dir).withColumn("guess", F.expr("CASE kind % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END"))
    return agg.confusion(c, "source", "guess")


@query(f"WITH {CELLS}, n AS (SELECT sample_id, kind, count(*) AS n FROM cells GROUP BY ALL) SELECT sample_id, string_agg(kind || ':' || n, ';' ORDER BY n DESC, kind) AS sizes FROM n GROUP BY ALL")
def cluster_size_strings(spark, sf_dir):
    return agg.size_string(cells(spark, sf_dir), ["sample_id"], "kind")


@query(f"""WITH {CELLS}, c AS (SELECT cell_id % 5 AS fold, CAST(area AS DOUBLE) AS x, CAST(area * 3 + kind AS DOUBLE) AS y FROM cells), o AS (SELECT fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy FROM c GROUP BY ALL),
t AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM o), l AS (SELECT o.*, t.n - o.n AS tn, t.sx - o.sx AS tx, t.sy - o.sy AS ty, t.sxx - o.sxx AS txx, t.sxy - o.sxy AS txy FROM o, t),
b AS (SELECT *, (tn * txy - tx * ty) / (tn * txx - tx * tx) AS b FROM l), a AS (SELECT *, (ty - b * tx) / tn AS a FROM b)
SELECT fold, round(1 - (syy - 2 * a * sy - 2 * b * sxy + a * a * n + 2 * a * b * sx + b * b * sxx) / (syy - sy * sy / n), 9) AS r2 FROM a""")
def cross_validated_r2(spark, sf_dir):
    c = cells(spark, sf_dir).select((F.col("cell_id") % 5).alias("fold"), F.col("area").alias("x"), F.expr("area * 3 + kind").alias("y"))
    return agg.fold_r2(c, "x", "y", "fold").withColumn("r2", F.round("r2", 9))


@query(f"WITH {CELLS}, n AS (SELECT sample_id, kind, count(*) AS n FROM cells GROUP BY ALL) SELECT sample_id, kind, n, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY kind) AS INTEGER) AS dense, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, kind) AS INTEGER) AS by_size FROM n")
def renumbered_labels(spark, sf_dir):
    return ordered.dense_labels(cells(spark, sf_dir), ["sample_id"], "kind")


@query(f"WITH {CELLS} SELECT patient, cell_id, CAST(sum(area) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto, CAST(coalesce(sum(area) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before, CAST(sum(area) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS from_here FROM cells WINDOW w AS (PARTITION BY patient ORDER BY cell_id)")
def running_areas(spark, sf_dir):
    return ordered.running(cells(spark, sf_dir), ["patient"], "cell_id", "area")


@query(f"WITH {CELLS}, r AS (SELECT sample_id, cell_id, row_number() OVER (PARTITION BY sample_id ORDER BY abs(probability - 0.5) DESC, cell_id) AS rank, count(*) OVER (PARTITION BY sample_id) AS n FROM cells) SELECT sample_id, cell_id, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= least(20, greatest(1, ceil(n * 0.01)))")
def discordant_cells(spark, sf_dir):
    return ordered.top_fraction(cells(spark, sf_dir), ["sample_id"], [F.desc(F.abs(F.col("probability") - 0.5)), "cell_id"], 0.01, 20).select("sample_id", "cell_id", "rank")


@query(f"WITH {CELLS}, r AS (SELECT *, row_number() OVER (PARTITION BY patient, kind ORDER BY area DESC, cell_id) AS n FROM cells) SELECT patient, kind, cell_id, area FROM r WHERE n = 1")
def first_of_group(spark, sf_dir):
    return ordered.first_of(cells(spark, sf_dir), ["patient", "kind"], [F.desc("area"), "cell_id"]).select("patient", "kind", "cell_id", "area")


@query(f"WITH {CELLS}, s AS (SELECT sample_id, count(*) AS total, count(*) FILTER (kind = 1) AS hot, CAST(sum(area) AS BIGINT) AS area FROM cells GROUP BY ALL) SELECT * FROM s ORDER BY hot DESC, total DESC, area DESC, sample_id LIMIT 1")
def chosen_section(spark, sf_dir):
    s = cells(spark, sf_dir).groupBy("sample_id").agg(F.count("*").alias("total"), F.count_if(F.col("kind") == 1).alias("hot"), F.sum("area").alias("area"))
    return s.orderBy(F.desc("hot"), F.desc("total"), F.desc("area"), "sample_id").limit(1)


@query()
def gap_clusters(spark, sf_dir):
    """A running mean that moves with its members has no short SQL; tested against a loop."""
    return ordered.gap_clusters(cells(spark, sf_dir).select("patient", "y"), ["patient"], "y", 12.0)


@query("SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0 INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def shared_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k")
    return ordered.in_all([table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), c.where("k % 2 = 0"), c.where("c_acctbal > 0")], "k")


@query("SELECT c_custkey AS id, c_acctbal AS balance, NULL::BIGINT AS size FROM customer UNION ALL SELECT p_partkey, NULL, p_size FROM part")
def stacked_with_missing(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    return ordered.stacked([a, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("long").alias("size"))])


_PATHS = "paths AS (SELECT DISTINCT 'r' || (p_partkey % 9) || CASE WHEN p_size % 3 > 0 THEN '/' || p_brand ELSE '' END || CASE WHEN p_size % 3 > 1 THEN '/' || p_type ELSE '' END AS path FROM part WHERE p_partkey % 9 > 1 OR p_size % 3 > 0)"


@query(f"WITH {_PATHS} SELECT path FROM paths p WHERE NOT EXISTS (SELECT 1 FROM paths q WHERE starts_with(p.path, q.path || '/'))")
def outermost_paths(spark, sf_dir):
    p = table(spark, sf_dir, "part").where("p_partkey % 9 > 1 OR p_size % 3 > 0")
    path = F.expr("'r' || (p_partkey % 9) || CASE WHEN p_size % 3 > 0 THEN '/' || p_brand ELSE '' END || CASE WHEN p_size % 3 > 1 THEN '/' || p_type ELSE '' END")
    return ordered.outermost(p.select(path.alias("path")), "path")


def _draw(c):
    return F.struct(F.md5(c.cast("string")), c)


@query(f"WITH {CELLS}, r AS (SELECT sample_id, kind, cell_id, row_number() OVER (PARTITION BY sample_id, kind ORDER BY md5(CAST(cell_id AS VARCHAR)), cell_id) AS nth FROM cells) SELECT sample_id, kind, cell_id, CAST(nth AS INTEGER) AS nth FROM r WHERE nth <= 3")
def review_sample(spark, sf_dir):
    return ordered.hashed_sample(cells(spark, sf_dir), ["sample_id", "kind"], 3, _draw(F.col("cell_id"))).select("sample_id", "kind", "cell_id", "nth")


@query(f"""WITH {CELLS}, n AS (SELECT kind, count(*) AS n, sum(count(*)) OVER () AS t FROM cells GROUP BY kind), r AS (SELECT kind, cell_id, row_number() OVER (PARTITION BY kind ORDER BY md5(CAST(cell_id AS VARCHAR)), cell_id) AS nth FROM cells)
SELECT r.kind, cell_id, CAST(nth AS INTEGER) AS nth FROM r JOIN n ON r.kind = n.kind WHERE nth <= greatest(1, round_even(100.0 * n / t, 0))""")
def proportional_sample(spark, sf_dir):
    return ordered.proportional_sample(cells(spark, sf_dir), "kind", 100, _draw(F.col("cell_id"))).select("kind", "cell_id", "nth")


@query(f"WITH {CELLS} SELECT 'patient in several values of source' AS rule, CAST(patient AS VARCHAR) AS key FROM cells GROUP BY patient HAVING count(DISTINCT source) > 1")
def split_leakage(spark, sf_dir):
    return constraints.leakage(cells(spark, sf_dir), "patient", "source")


@query(f"""WITH {CELLS}, c AS (SELECT cell_id // 3 AS roi, kind, CASE WHEN area > 60 THEN NULL ELSE 1 END AS tag FROM cells)
SELECT 'kind varies' AS rule, CAST(roi AS VARCHAR) AS key FROM c GROUP BY roi HAVING count(DISTINCT kind) > 1 UNION ALL SELECT 'tag varies', CAST(roi AS VARCHAR) FROM c GROUP BY roi HAVING count(DISTINCT tag) + max((tag IS NULL)::INT) > 1""")
def varying_regions(spark, sf_dir):
    c = cells(spark, sf_dir).select(F.expr("cell_id div 3").alias("roi"), "kind", F.when(F.col("area") <= 60, F.lit(1)).alias("tag"))
    return constraints.varies_within(c, "roi", ["kind", "tag"])


@query(f"WITH {CELLS} SELECT 'probabilities' AS rule, CAST(cell_id AS VARCHAR) AS key FROM cells WHERE abs(probability + (1 - probability) * CASE WHEN kind = 4 THEN 0.5 ELSE 1 END - 1) > 1e-5")
def bad_probabilities(spark, sf_dir):
    p = F.array(F.col("probability"), (1 - F.col("probability")) * F.when(F.col("kind") == 4, 0.5).otherwise(1.0))
    return constraints.not_summing_to_one(cells(spark, sf_dir).withColumn("p", p), "cell_id", "p")


@query("""WITH g AS (SELECT l_orderkey % 5 AS s, l_partkey % 1000 AS label, l_suppkey % 20 AS y0, (l_partkey * 7) % 500 AS x0, (l_partkey * 7) % 500 + l_linenumber AS x1 FROM (SELECT DISTINCT l_orderkey % 5 AS l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem)),
e AS (SELECT label, x0, max(x1) OVER (PARTITION BY s, y0 ORDER BY x0, label, x1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM g) SELECT 'overlap' AS rule, CAST(label AS VARCHAR) AS key, count(*) AS n FROM e WHERE e > x0 GROUP BY ALL""")
def overlapping_cores(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 5).alias("s"), "l_partkey", "l_suppkey", "l_linenumber").distinct()
    g = g.select("s", (F.col("l_partkey") % 1000).alias("part"), (F.col("l_suppkey") % 20).alias("y0"), F.expr("l_partkey * 7 % 500").alias("x0"), F.expr("l_partkey * 7 % 500 + l_linenumber").alias("x1"))
    found = constraints.overlapping_cores(g.withColumn("label", F.struct("part", "x1")), ["s"])
    return found.groupBy("rule", F.regexp_extract("key", r"\{(\d+)", 1).alias("key")).agg(F.count("*").alias("n"))


@query(f"WITH {CELLS}, m AS (SELECT patient, cell_id, area * 1.0 AS v, min(area * 1.0) OVER (PARTITION BY patient) AS low, max(area * 1.0) OVER (PARTITION BY patient) AS high FROM cells) SELECT patient, cell_id, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high FROM m WHERE v - low > 0.9 * v OR high - v > 0.9 * high")
def conflicting_scales(spark, sf_dir):
    m = cells(spark, sf_dir).withColumn("v", F.col("area").cast("double"))
    return constraints.conflicting_values(m, "patient", "cell_id", "v", 0.9)


@query("SELECT 'only left' AS rule, CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_custkey % 5 > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 3 > 0) UNION ALL SELECT DISTINCT 'only right', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_custkey % 3 > 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 > 0)")
def customers_without_orders(spark, sf_dir):
    left = table(spark, sf_dir, "customer").where("c_custkey % 5 > 0").select(F.col("c_custkey").alias("k"))
    return constraints.not_bijective(left, table(spark, sf_dir, "orders").where("o_custkey % 3 > 0").select(F.col("o_custkey").alias("k")), "k")


@query(f"""WITH {CELLS}, c AS (SELECT patient % 10 AS g, cell_id, CASE WHEN kind = 3 AND patient % 10 < 4 THEN NULL ELSE area END AS v FROM cells), s AS (SELECT g, avg((v IS NULL)::INT) AS m FROM c GROUP BY ALL)
SELECT c.g, count(*) AS n, CAST(sum(v) AS BIGINT) AS v FROM c JOIN s ON c.g = s.g WHERE m <= 0.1 AND v IS NOT NULL GROUP BY ALL""")
def complete_cases(spark, sf_dir):
    c = cells(spark, sf_dir).select((F.col("patient") % 10).alias("g"), "cell_id", F.when(~F.expr("kind = 3 AND patient % 10 < 4"), F.col("area")).alias("v"))
    return constraints.complete_cases(c, ["g"], ["v"], 0.1).groupBy("g").agg(F.count("*").alias("n"), F.sum("v").alias("v"))


@query("SELECT c_custkey AS k, c_name, n FROM customer JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def one_to_one(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    return joins.one_to_one(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name"), n, "k")


@query("SELECT s_suppkey AS id, s_nationkey AS k, coalesce(n_name, 'none') AS n_name FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 3 > 0) ON s_nationkey = n_nationkey")
def looked_up(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("k"))
    return joins.look_up(s, table(spark, sf_dir, "nation").where("n_nationkey % 3 > 0").withColumnRenamed("n_nationkey", "k"), "k", "n_name", "none")


@query("""WITH w AS (SELECT CAST(c_custkey AS VARCHAR) AS wanted FROM customer), k AS (SELECT CAST(s_suppkey AS VARCHAR) AS cell_id, CAST(s_suppkey * 2 AS VARCHAR) AS alias FROM supplier), h AS (SELECT DISTINCT wanted, cell_id FROM w JOIN k ON wanted = cell_id OR wanted = alias)
SELECT wanted, min(cell_id) AS cell_id FROM h GROUP BY wanted HAVING count(*) = 1""")
def found_by_alias(spark, sf_dir):
    k = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("cell_id"), (F.col("s_suppkey") * 2).cast("string").alias("alias"))
    return joins.by_either_id(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("wanted")), k)


@query(f"WITH {CELLS}, r AS (SELECT cell_id AS k, patient FROM cells WHERE kind <> 1), p AS (SELECT cell_id AS k, area FROM cells WHERE kind <> 2) SELECT CASE WHEN r.k IS NULL THEN 'FP' WHEN p.k IS NULL THEN 'FN' ELSE 'TP' END AS outcome, count(*) AS n FROM r FULL JOIN p ON r.k = p.k GROUP BY ALL")
def outcome_counts(spark, sf_dir):
    c = cells(spark, sf_dir).withColumnRenamed("cell_id", "k")
    found = joins.matched_outcomes(c.where("kind <> 1").select("k", "patient"), c.where("kind <> 2").select("k", "area"), ["k"])
    return found.groupBy("outcome").agg(F.count("*").alias("n"))


@query(f"WITH {CELLS} SELECT patient, min(area) FILTER (source = 'F') AS F, min(area) FILTER (source = 'O') AS O, min(area) FILTER (source = 'P') AS P FROM cells GROUP BY patient")
def wide_by_source(spark, sf_dir):
    return joins.wide(cells(spark, sf_dir), "patient", "source", "area", ["F", "O", "P"])


_TRACE = """trace AS (SELECT event_id, event_type AS process, CASE event_id % 3 WHEN 0 THEN (event_id % 5) || 'h ' || (event_id % 60) || 'm ' || (event_id % 59) || 's' WHEN 1 THEN (event_id % 900) || 'ms' ELSE (event_id % 4) || ':' || (event_id % 60) || ':07' END AS realtime,
  CASE event_id % 2 WHEN 0 THEN (event_id % 100) || ' MB' ELSE (event_id % 8) || ' GiB' END AS rss FROM events)"""


@query(f"""WITH {_TRACE}, s AS (SELECT process, CASE event_id % 3 WHEN 0 THEN (event_id % 5) * 3600.0 + (event_id % 60) * 60 + event_id % 59 WHEN 1 THEN (event_id % 900) * 0.001 ELSE (event_id % 4) * 3600.0 + (event_id % 60) * 60 + 7 END AS sec,
  CASE event_id % 2 WHEN 0 THEN (event_id % 100) * 1048576.0 ELSE (event_id % 8) * 1073741824.0 END AS mem FROM trace)
SELECT process, count(*) AS tasks, round(sum(sec), 3) AS seconds, CAST(max(mem) AS DOUBLE) AS peak FROM s GROUP BY ALL""")
def trace_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    time = F.expr("CASE event_id % 3 WHEN 0 THEN (event_id % 5) || 'h ' || (event_id % 60) || 'm ' || (event_id % 59) || 's' WHEN 1 THEN (event_id % 900) || 'ms' ELSE (event_id % 4) || ':' || (event_id % 60) || ':07' END")
    rss = F.expr("CASE event_id % 2 WHEN 0 THEN (event_id % 100) || ' MB' ELSE (event_id % 8) || ' GiB' END")
    t = e.select(F.col("event_type").alias("process"), scalars.seconds(time).alias("s"), scalars.memory_bytes(rss).alias("m"))
    return t.groupBy("process").agg(F.count("*").alias("tasks"), F.round(F.sum("s"), 3).alias("seconds"), F.max("m").alias("peak"))


@query(f"""SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS clean, p_partkey AS trailing, regexp_replace(p_brand || '/' || p_type, '[^A-Za-z0-9._-]+', '_', 'g') AS safe, 'stage_' || substr(sha1('ns' || chr(9) || p_name), 1, 16) AS stable, p_size % 2 = 0 AS yes,
  p_size * 1000.0 AS um, CAST(p_size + 0 AS BIGINT) AS whole FROM part""")
def scalar_functions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    return p.select(
        F.col("p_partkey").alias("id"),
        scalars.normal_id(F.concat(F.lit(' "'), key, F.lit('.0" '))).alias("clean"),
        scalars.trailing_number(F.concat(F.lit("cell_"), key)).alias("trailing"),
        scalars.safe_name(F.concat_ws("/", "p_brand", "p_type")).alias("safe"),
        scalars.stable_id("stage_", F.lit("ns"), F.col("p_name")).alias("stable"),
        scalars.truthy(F.when(F.col("p_size") % 2 == 0, " Yes ").otherwise("no")).alias("yes"),
        scalars.micrometres(F.col("p_size").cast("double"), F.lit(" MM ")).alias("um"),
        scalars.whole_number(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".9"))).alias("whole"),
    )


@query(f"""WITH {CELLS}, e AS (SELECT cell_id, [exp((a - greatest(a, b, c)) / 0.5), exp((b - greatest(a, b, c)) / 0.5), exp((c - greatest(a, b, c)) / 0.5)] AS e, CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS best FROM (SELECT cell_id, probability AS a, area / 64 AS b, kind / 5 AS c FROM cells))
SELECT cell_id, best, round(e[1] / list_sum(e), 9) AS p0, round(e[3] / list_sum(e), 9) AS p2 FROM e""")
def softmax_heads(spark, sf_dir):
    logits = F.array(F.col("probability"), F.col("area") / 64, F.col("kind") / 5)
    p = scalars.softmax(logits, 0.5)
    return cells(spark, sf_dir).select("cell_id", scalars.first_argmax(logits).cast("int").alias("best"), F.round(p[0], 9).alias("p0"), F.round(p[2], 9).alias("p2"))


@query(f"WITH {CELLS} SELECT sample_id, CAST(cell_id % 100 AS VARCHAR) AS source_id, x, y, kind, probability FROM cells WHERE kind <> 3")
def json_instances(spark, sf_dir):
    c = cells(spark, sf_dir)
    cell = F.struct(F.when(F.col("kind") != 3, F.array("x", "y")).alias("centroid"), F.col("kind").alias("type"), F.col("probability").alias("type_prob"))
    packed = c.groupBy("sample_id", F.expr("cell_id div 100").alias("block")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct((F.col("cell_id") % 100).cast("string").alias("k"), cell.alias("v"))))).alias("cells"))
    text = packed.select("sample_id", F.to_json(F.struct("cells")).alias("json"))
    return _instances(text)


def _instances(text):
    """`records.instances` keeps only what stands in the JSON, so each sample's id goes along by its cells' ids."""
    renamed = text.select("sample_id", F.from_json(F.get_json_object("json", "$.cells"), f"map<string,{records.CELL}>").alias("m"))
    wrapped = renamed.select(F.to_json(F.struct(F.transform_keys("m", lambda k, v: F.concat(F.col("sample_id").cast("string"), F.lit("/"), k)).alias("cells"))).alias("json"))
    rows = records.instances(wrapped, "json")
    return rows.select(F.split("source_id", "/")[0].cast("long").alias("sample_id"), F.split("source_id", "/")[1].alias("source_id"), "x", "y", "kind", "probability")


@query(f"WITH {CELLS} SELECT 'box' || kind AS name, CAST(row_number() OVER (PARTITION BY kind ORDER BY area DESC, x, y) AS INTEGER) AS part, CAST(area * area AS DOUBLE) AS area FROM (SELECT kind, area, x, y, row_number() OVER (PARTITION BY kind, area ORDER BY cell_id) AS n FROM cells) WHERE n = 1")
def geojson_sections(spark, sf_dir):
    c = ordered.first_of(cells(spark, sf_dir), ["kind", "area"], ["cell_id"])
    x, y, a = F.col("x"), F.col("y"), F.col("area")
    ring = F.array(*(F.array(p, q) for p, q in ((x, y), (x + a, y), (x + a, y + a), (x, y + a), (x, y))))
    feature = F.struct(F.lit("Feature").alias("type"), F.create_map(F.lit("name"), F.concat(F.lit("box"), "kind")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    text = c.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))).alias("json"))
    return geometry.features(text, "json").select("name", "part", "area")


@query("""WITH f AS (SELECT 'in/s' || (p_partkey % 200) || CASE p_size % 4 WHEN 0 THEN '.ome.tiff' WHEN 1 THEN '.tif' WHEN 2 THEN '.png' ELSE '.txt' END AS path FROM part),
r AS (SELECT DISTINCT path, regexp_extract(path, 's[0-9]+') AS sample, CASE WHEN path LIKE '%.ome.tiff' THEN 0 WHEN path LIKE '%.tif' THEN 1 WHEN path LIKE '%.png' THEN 2 END AS k FROM f)
SELECT sample, arg_min(path, k) AS path FROM r WHERE k IS NOT NULL GROUP BY sample""")
def best_files(spark, sf_dir):
    path = F.expr("'in/s' || (p_partkey % 200) || CASE p_size % 4 WHEN 0 THEN '.ome.tiff' WHEN 1 THEN '.tif' WHEN 2 THEN '.png' ELSE '.txt' END")
    return records.best_files(table(spark, sf_dir, "part").select(path.alias("path")).distinct(), [".ome.tiff", ".tif", ".png"])


@query("""SELECT p_partkey AS id, sha256('{"p_partkey":' || p_partkey || ',"p_brand":"' || p_brand || '"}') AS digest FROM part""")
def row_digests(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), records.row_digest(F.col("p_partkey"), F.col("p_brand")).alias("digest"))


@query(f"""WITH {PIXELS} SELECT sample_id, label, count(*) AS area, CAST(sum(x) AS BIGINT) AS sum_x, CAST(sum(y) AS BIGINT) AS sum_y, min(x) AS x0, max(x) + 1 AS x1, min(y) AS y0, max(y) + 1 AS y1,
  CAST(sum(score) AS BIGINT) AS score_sum, max(score) AS score_max FROM pixels WHERE label <> 0 GROUP BY ALL""")
def streamed_zonal_stats(spark, sf_dir):
    stream = streams.stream_of(spark, f"{sf_dir}/lineitem.parquet")

    class Tables:
        """Stands in for the session where the frame is to come from the stream."""

        class read:
            parquet = staticmethod(lambda _: stream)

    return streams.zonal_stream(pixels(Tables, sf_dir), streams.folder_of(spark), ["sample_id"], ["score"])


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, CAST(sum(round(value * 100)) AS BIGINT) AS cents FROM events GROUP BY ALL")
def streamed_event_counts(spark, sf_dir):
    return streams.counted(spark, f"{sf_dir}/events.parquet", "1 hour", "10 minutes", streams.folder_of(spark))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity, CAST(sum(round(l_extendedprice * 100)) AS BIGINT) AS cents FROM lineitem GROUP BY ALL""")
def pricing_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"), F.sum(F.rint(F.col("l_extendedprice") * 100).cast("long")).alias("cents"))


@query(f"""WITH {OUTCOMES}, s AS (SELECT detector, patient, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM outcomes GROUP BY ALL),
d AS (SELECT *, CAST('0x' || substr(md5(patient || ':' || draw), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM s, range(200) r(draw)),
w AS (SELECT *, {_WEIGHT} AS w FROM d), t AS (SELECT detector, draw, CAST(sum(tp * w) AS DOUBLE) AS tp, CAST(sum(fp * w) AS DOUBLE) AS fp, CAST(sum(fn * w) AS DOUBLE) AS fn FROM w GROUP BY ALL),
m AS (SELECT detector, unnest([{{'metric': 'precision', 'value': tp / nullif(tp + fp, 0)}}, {{'metric': 'recall', 'value': tp / nullif(tp + fn, 0)}}, {{'metric': 'f1', 'value': 2 * tp / nullif(2 * tp + fp + fn, 0)}}, {{'metric': 'jaccard', 'value': tp / nullif(tp + fp + fn, 0)}}], recursive := true) FROM t)
SELECT detector, metric, round(quantile_cont(value, 0.025), 9) AS low, round(quantile_cont(value, 0.975), 9) AS high, round(avg(value), 9) AS mean FROM m GROUP BY ALL""")
def bootstrap_metric_intervals(spark, sf_dir):
    """Intervals of precision, recall, F1 and Jaccard index by resampled patients."""
    out = agg.bootstrap_metrics(outcomes(spark, sf_dir), ["detector"], "patient", 200)
    return out.select("detector", "metric", *(F.round(c, 9).alias(c) for c in ("low", "high", "mean")))


@query(f"""WITH {CELLS}, b AS (SELECT sample_id, floor(x / 128) AS bx, floor(y / 128) AS by_, avg(patient) AS ma, avg(area) AS mb FROM cells GROUP BY ALL),
r AS (SELECT *, rank() OVER (PARTITION BY sample_id ORDER BY ma) + (count(*) OVER (PARTITION BY sample_id, ma) - 1) / 2 AS ra, rank() OVER (PARTITION BY sample_id ORDER BY mb) + (count(*) OVER (PARTITION BY sample_id, mb) - 1) / 2 AS rb FROM b)
SELECT sample_id, count(*) AS bins, round(CASE WHEN count(*) >= 3 THEN corr(ma, mb) END, 7) AS pearson, round(CASE WHEN count(*) >= 3 THEN corr(ra, rb) END, 7) AS spearman FROM r GROUP BY sample_id""")
def binned_correlation(spark, sf_dir):
    """How two measures go together over spatial bins."""
    found = agg.binned_agreement(cells(spark, sf_dir), ["sample_id"], 128.0, "patient", "area")
    return found.withColumns({c: F.round(c, 7) for c in ("pearson", "spearman")})

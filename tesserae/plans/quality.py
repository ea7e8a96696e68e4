"""Queries over matchings, resamples, seams and checked sources, each with its SQL where SQL can."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import constraints, geometry, graph, ordered, raster
from ..operators.graph import shared_folder
from ..sources import cell_index, records
from .frames import CELLS, OUTCOMES, RASTER, cells, outcomes, table, tissue
from .frames import raster as label_raster
from .spatial import _SIDES, _TWO, _polygons, _two
from .statistics import _WEIGHT

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


@query()
def assigned_instances(spark, sf_dir):
    """Most pairs, then most IoU; SQL has no optimal matching, so it is tested against all permutations."""
    return graph.assignment(raster.overlap(*_two(spark, sf_dir), ["sample_id"]), ["sample_id"], "iou")


@query()
def assigned_segments(spark, sf_dir):
    """The greatest total Dice; tested against all permutations."""
    return graph.assignment(raster.overlap(*_two(spark, sf_dir), ["sample_id"]), ["sample_id"], "dice", most_pairs=False)


@query(f"""WITH {RASTER}, {_TWO}, na AS (SELECT sample_id, label, count(*) AS n FROM a GROUP BY ALL), nb AS (SELECT sample_id, label, count(*) AS n FROM b GROUP BY ALL),
m AS (SELECT a.sample_id, a.label AS a, b.label AS b, count(*) AS shared FROM a JOIN b USING (sample_id, y, x) GROUP BY ALL),
t AS (SELECT m.sample_id, count(*) AS tp, sum(shared / (na.n + nb.n - shared)) AS iou, sum(shared) AS shared FROM m JOIN na ON m.sample_id = na.sample_id AND a = na.label JOIN nb ON m.sample_id = nb.sample_id AND b = nb.label WHERE shared / (na.n + nb.n - shared) > 0.5 GROUP BY ALL),
sa AS (SELECT sample_id, count(*) AS la, sum(n) AS aa FROM na GROUP BY ALL), sb AS (SELECT sample_id, count(*) AS lb, sum(n) AS ab FROM nb GROUP BY ALL)
SELECT sample_id, coalesce(tp, 0) AS tp, lb - coalesce(tp, 0) AS fp, la - coalesce(tp, 0) AS fn, round(coalesce(iou, 0) / ((la + lb) / 2), 9) AS pq,
  round(coalesce(shared, 0) / (aa + ab - coalesce(shared, 0)), 9) AS aji, round(2 * coalesce(shared, 0) / (aa + ab), 9) AS dice
FROM sa FULL JOIN sb USING (sample_id) LEFT JOIN t USING (sample_id)""")
def panoptic_quality(spark, sf_dir):
    a, b = _two(spark, sf_dir)
    sizes = (x.groupBy("sample_id", "label").agg(F.count("*").alias("n")) for x in (a, b))
    found = agg.panoptic(raster.overlap(a, b, ["sample_id"]).where("iou > 0.5"), *sizes, ["sample_id"])
    return found.select("sample_id", "tp", "fp", "fn", *(F.round(c, 9).alias(c) for c in ("pq", "aji", "dice")))


_RATES = "r AS (SELECT detector, patient, avg(v) AS v FROM (SELECT detector, patient, roi, sum(tp) / nullif(sum(tp) + sum(fp), 0) AS v FROM outcomes GROUP BY ALL) GROUP BY ALL)"
_DRAWN = f"""u AS (SELECT *, CAST('0x' || substr(md5(patient || ':' || draw), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM s, range(200) t(draw)), w AS (SELECT *, {_WEIGHT} AS w FROM u)"""


def _rates(spark, sf_dir):
    tp, fp = F.sum("tp"), F.sum("fp")
    rates = outcomes(spark, sf_dir).groupBy("detector", "patient", "roi").agg(agg.safe_ratio(tp, tp + fp).alias("v"))
    return rates.groupBy("detector", "patient").agg(F.avg("v").alias("v"))


def _rounded(df, *names):
    return df.select(*(F.round(c, 9).alias(c) if c in ("mean", "low", "high") else c for c in (*names, "units", "mean", "low", "high", "decision")))


@query(f"""WITH {OUTCOMES}, {_RATES}, s AS (SELECT detector, patient, v FROM r), {_DRAWN}, d AS (SELECT detector, draw, sum(v * w) / nullif(sum(w), 0) AS m FROM w GROUP BY ALL),
c AS (SELECT detector, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM d WHERE m IS NOT NULL GROUP BY ALL), k AS (SELECT detector, count(v) AS units, avg(v) AS mean FROM s GROUP BY ALL)
SELECT detector, units, round(mean, 9) AS mean, round(low, 9) AS low, round(high, 9) AS high, CASE WHEN low > 0 THEN 'higher' WHEN high < 0 THEN 'lower' ELSE 'undecided' END AS decision FROM k JOIN c USING (detector)""")
def patient_mean_intervals(spark, sf_dir):
    return _rounded(agg.mean_bootstrap(_rates(spark, sf_dir), ["detector"], "patient", "v", 200), "detector")


@query(f"""WITH {OUTCOMES}, {_RATES}, s AS (SELECT a.detector AS who_a, b.detector AS who_b, a.patient, a.v - b.v AS v FROM r a JOIN r b ON a.patient = b.patient AND a.detector < b.detector), {_DRAWN},
d AS (SELECT who_a, who_b, draw, sum(v * w) / nullif(sum(w), 0) AS m FROM w GROUP BY ALL), c AS (SELECT who_a, who_b, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM d WHERE m IS NOT NULL GROUP BY ALL),
k AS (SELECT who_a, who_b, count(v) AS units, avg(v) AS mean FROM s GROUP BY ALL)
SELECT who_a, who_b, units, round(mean, 9) AS mean, round(low, 9) AS low, round(high, 9) AS high, CASE WHEN low > 0 THEN 'higher' WHEN high < 0 THEN 'lower' ELSE 'undecided' END AS decision FROM k JOIN c USING (who_a, who_b)""")
def paired_decisions(spark, sf_dir):
    """Differences of two detectors on the same patients, resampled by patient."""
    r = _rates(spark, sf_dir)
    pairs = r.select("patient", F.col("detector").alias("who_a"), F.col("v").alias("va")).join(r.select("patient", F.col("detector").alias("who_b"), F.col("v").alias("vb")), "patient").where("who_a < who_b")
    return _rounded(agg.mean_bootstrap(pairs.withColumn("v", F.col("va") - F.col("vb")), ["who_a", "who_b"], "patient", "v", 200), "who_a", "who_b")


_STEPS = """st AS (SELECT sample_id, 'x' AS axis, x AS place, abs(label - lag(label) OVER (PARTITION BY sample_id, y ORDER BY x)) AS step FROM raster
  UNION ALL SELECT sample_id, 'y', y, abs(label - lag(label) OVER (PARTITION BY sample_id, x ORDER BY y)) FROM raster),
bs AS (SELECT sample_id, axis, quantile_cont(step, 0.95) AS base FROM st WHERE step IS NOT NULL AND place % 8 <> 0 GROUP BY ALL),
ex AS (SELECT st.sample_id, st.axis, place, count(*) AS n, quantile_cont(step, 0.95) - any_value(base) AS excess FROM st JOIN bs ON st.sample_id = bs.sample_id AND st.axis = bs.axis WHERE step IS NOT NULL AND place % 8 = 0 GROUP BY ALL)"""


@query(f"WITH {RASTER}, {_STEPS}, r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY round(excess, 9) DESC, axis, place) AS k FROM ex) SELECT sample_id, axis, place, n, round(excess, 9) AS excess, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 3")
def worst_seams(spark, sf_dir):
    """The three worst block boundaries of every sample."""
    found = agg.seam_excess(label_raster(spark, sf_dir), ["sample_id"], "label", 8).withColumn("excess", F.round("excess", 9))
    return ordered.top_fraction(found, ["sample_id"], [F.desc("excess"), "axis", "place"], 1.0, 3)


@query(f"WITH {RASTER}, {_STEPS} SELECT sample_id, count(*) AS boundaries, avg((excess > 0.5)::INT) AS affected, max(excess) > 0.5 AND avg((excess > 0.5)::INT) >= 0.1 AS fails FROM ex GROUP BY ALL")
def failing_seams(spark, sf_dir):
    """Samples fail whose affected share of boundaries, those with an excess over one half, is a tenth or more."""
    hit = F.avg((F.col("excess") > 0.5).cast("int"))
    found = agg.seam_excess(label_raster(spark, sf_dir), ["sample_id"], "label", 8)
    return found.groupBy("sample_id").agg(F.count("*").alias("boundaries"), hit.alias("affected"), ((F.max("excess") > 0.5) & (hit >= 0.1)).alias("fails"))


@query(f"WITH {CELLS}, s AS (SELECT sample_id, avg(area) AS m, greatest(stddev_pop(area), 2.220446049250313e-16) AS d FROM cells GROUP BY ALL) SELECT cell_id, round((area - m) / d, 7) AS z FROM cells JOIN s USING (sample_id)")
def standardised_areas(spark, sf_dir):
    return agg.standardised(cells(spark, sf_dir), ["sample_id"], "area").select("cell_id", F.round("z", 7).alias("z"))


@query(f"WITH {CELLS} SELECT source, count(*) FILTER (kind < 4 AND area % 7 <> 0) AS n FROM cells GROUP BY ALL")
def finite_points(spark, sf_dir):
    """Points with a null, infinite or undefined coordinate are left out."""
    x = F.when(F.col("kind") < 4, F.col("x")).when(F.col("kind") == 4, F.lit(float("nan")))
    y = F.when(F.col("area") % 7 == 0, F.lit(float("-inf"))).otherwise(F.col("y"))
    c = constraints.require_columns(cells(spark, sf_dir), ["source", "x", "y"]).withColumn("fx", x).withColumn("fy", y)
    return c.groupBy("source").agg(F.count_if(constraints.is_finite("fx", "fy")).alias("n"))


@query(f"WITH {CELLS}, {_SIDES} SELECT sample_id, polygon, abs(sum((ax * 0.5 + 10) * (by_ * 0.5 - 20) - (bx * 0.5 + 10) * (ay * 0.5 - 20))) / 2 AS area, min(ax * 0.5 + 10) AS x0, max(ay * 0.5 - 20) AS y1 FROM sides GROUP BY ALL")
def moved_polygons(spark, sf_dir):
    """Polygons halved in scale and moved."""
    ring = geometry.moved(F.col("ring"), 10.0, -20.0, 0.5)
    b = geometry.bounds(ring)
    return _polygons(spark, sf_dir).select("sample_id", "polygon", geometry.area(ring).alias("area"), b["x0"].alias("x0"), b["y1"].alias("y1"))


_CROSS = "d(dy, dx) AS (VALUES (0, 0), (0, 1), (0, -1), (1, 0), (-1, 0))"
_MASK = "m AS (SELECT sample_id, y, x FROM raster WHERE (y * 5 + x * 3) % 11 > 1)"


def _mask(spark, sf_dir):
    return tissue(spark, sf_dir).where("(y * 5 + x * 3) % 11 > 1")


@query(f"""WITH {RASTER}, {_CROSS}, {_MASK}, e AS (SELECT m.sample_id, m.y + dy AS y, m.x + dx AS x FROM m, d GROUP BY ALL HAVING count(*) = 5)
SELECT DISTINCT sample_id, y + dy AS y, x + dx AS x FROM e, d WHERE y + dy BETWEEN 0 AND 63 AND x + dx BETWEEN 0 AND 63""")
def opened_mask(spark, sf_dir):
    return raster.opened(_mask(spark, sf_dir), ["sample_id"], 1, 64, 64)


@query(f"""WITH {RASTER}, {_CROSS}, {_MASK}, g AS (SELECT DISTINCT sample_id, y + dy AS y, x + dx AS x FROM m, d WHERE y + dy BETWEEN 0 AND 63 AND x + dx BETWEEN 0 AND 63)
SELECT sample_id, y + dy AS y, x + dx AS x FROM g, d GROUP BY ALL HAVING count(*) = 5""")
def closed_mask(spark, sf_dir):
    return raster.closed(_mask(spark, sf_dir), ["sample_id"], 1, 64, 64)


@query(f"WITH {CELLS}, k AS (SELECT cell_id FROM cells WHERE area > 30 AND cell_id > 100 ORDER BY cell_id LIMIT 51), s AS (SELECT list(cell_id ORDER BY cell_id) AS l FROM k) SELECT array_to_string(l[1:50], ',') AS keys, (SELECT count(*) FROM cells WHERE area > 30) AS total, len(l) > 50 AS truncated, CASE WHEN len(l) > 50 THEN l[50] END AS next_cursor FROM s")
def page_of_large_cells(spark, sf_dir):
    found = ordered.page_envelope(cells(spark, sf_dir).where("area > 30"), "cell_id", 100, 50)
    return found.withColumn("keys", F.array_join(F.col("keys").cast("array<string>"), ","))


@query("SELECT CASE o_orderkey % 4 WHEN 1 THEN 'repeated key: id' WHEN 2 THEN 'malformed' ELSE 'fine' END AS fault, count(*) AS n FROM orders GROUP BY ALL")
def strict_records(spark, sf_dir):
    """JSON texts of orders, of which one in four repeats a key and one ends in a comma."""
    key = F.col("o_orderkey").cast("string")
    good = F.concat(F.lit('{"id": '), key, F.lit(', "of": {"id": 1, "list": [1, 2]}}'))
    bad = F.concat(F.lit('{"id": '), key, F.lit(', "of": {"id": 1, "id": 2}}'))
    text = F.when(F.col("o_orderkey") % 4 == 1, bad).when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit('[{"id": '), key, F.lit("},]"))).otherwise(good)
    found = records.strict_json(table(spark, sf_dir, "orders").select(text.alias("t")), "t")
    return found.groupBy(F.coalesce("fault", F.lit("fine")).alias("fault")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name, c_acctbal, NULL AS remark FROM customer")
def customers_by_csv(spark, sf_dir):
    """Customers written as compressed CSV and read again under their schema, with a column that the files lack."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = f"{graph.shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    records.write_csv(rows, path)
    return records.read_csv(spark, path, rows.schema, ["c_custkey", "c_name", "c_acctbal", "remark"])


@query("SELECT s_nationkey, count(*) AS n, true AS intact FROM supplier GROUP BY ALL")
def restored_bundle(spark, sf_dir):
    """Suppliers packed with digests, read again and verified row by row."""
    path = f"{graph.shared_folder(spark)}/bundle-{uuid.uuid4().hex}"
    records.pack(table(spark, sf_dir, "supplier"), "s_suppkey", path, 4)
    return records.restored(spark, path).groupBy("s_nationkey", "intact").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_size AS size_x, round(p_size * 0.25, 4) AS physical_x, 'p' || p_partkey AS name FROM part")
def image_attributes(spark, sf_dir):
    """Attributes scraped from XML headers made of parts."""
    xml = F.format_string('<OME><Image Name="p%s"><Pixels SizeX="%s" PhysicalSizeX="%s"/></Image></OME>', F.col("p_partkey").cast("string"), F.col("p_size").cast("string"), (F.col("p_size") * 0.25).cast("string"))
    x = table(spark, sf_dir, "part").select("p_partkey", "p_size", xml.alias("xml"))
    return x.select(
        "p_partkey", F.xpath_int("xml", F.lit("/OME/Image/Pixels/@SizeX")).alias("size_x"), F.round(F.xpath_double("xml", F.lit("/OME/Image/Pixels/@PhysicalSizeX")), 4).alias("physical_x"), F.xpath_string("xml", F.lit("/OME/Image/@Name")).alias("name")
    )


@query()
def table_files(spark, sf_dir):
    """The files that a folder of tables holds, by suffix; their number and bytes are not in any table."""
    return records.listing(spark, sf_dir, "*.parquet").groupBy(F.regexp_extract("path", "[^/.]*$", 0).alias("suffix")).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def _published(spark, sf_dir):
    """An index of all cells with two models' predictions and vectors of three values."""
    c = cells(spark, sf_dir)
    one = c.select("cell_id", F.lit("kinds").alias("model"), F.col("kind").alias("class_id"), F.concat(F.lit("kind-"), F.col("kind")).alias("label"), "probability")
    two = c.select("cell_id", F.lit("sizes").alias("model"), (F.col("area") % 3).cast("int").alias("class_id"), F.concat(F.lit("size-"), F.col("area") % 3).alias("label"), (F.col("area") / 64.0).alias("probability"))
    vectors = c.select("cell_id", F.array(F.col("x"), F.col("y"), F.col("area").cast("double")).alias("values"))
    path = f"{shared_folder(spark)}/cells-{uuid.uuid4().hex}"
    cell_index.publish(c.select("cell_id", "sample_id", "source", "x", "y"), one.unionByName(two), vectors, path, 128, ["kinds", "sizes"])
    return cell_index.open_index(spark, path, verify=True)


@query(f"""WITH {CELLS} SELECT cell_id, sample_id, source, x, y, 'sizes' AS model, CAST(area % 3 AS INTEGER) AS class_id, 'size-' || (area % 3) AS label, area / 64.0 AS probability FROM cells
WHERE x BETWEEN 100 AND 420.5 AND y BETWEEN 30 AND 400 AND area % 3 > 0 AND area / 64.0 >= 0.25""")
def indexed_predictions(spark, sf_dir):
    """Cells of a viewport with one model's predictions, of two labels and from a probability on, out of a published index."""
    return _published(spark, sf_dir).viewport(100, 30, 420.5, 400, "sizes", ["size-1", "size-2"], 0.25)


@query(f"WITH {CELLS} SELECT cell_id, x AS first, y AS second, CAST(area AS DOUBLE) AS third FROM cells WHERE kind = 2 AND source = 'F'")
def located_vectors(spark, sf_dir):
    """Vectors of chosen cells, by their locators."""
    wanted = cells(spark, sf_dir).where("kind = 2 AND source = 'F'").select("cell_id")
    found = _published(spark, sf_dir).vectors_of(wanted)
    return found.select("cell_id", *(F.get("values", F.lit(i)).alias(name) for i, name in enumerate(("first", "second", "third"))))

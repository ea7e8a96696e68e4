"""Holes, growth, roles, rules and readable values against brute force and on odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from tesserae.functions import scalars
from tesserae.operators import aggregates, constraints, evidence, geometry, ordered, raster
from tesserae.sources import records

MASK = "s long, y int, x int"


def pixels(df):
    return sorted((r.s, r.y, r.x) for r in df.collect())


def holes(mask):
    """Pixels of the mask's bounds that a flood from beyond them does not reach."""
    ys, xs = [y for y, _ in mask], [x for _, x in mask]
    box = {(y, x) for y in range(min(ys) - 1, max(ys) + 2) for x in range(min(xs) - 1, max(xs) + 2)}
    seen, todo = set(), [(min(ys) - 1, min(xs) - 1)]
    while todo:
        y, x = todo.pop()
        if (y, x) in box and (y, x) not in mask and (y, x) not in seen:
            seen.add((y, x))
            todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
    return box - mask - seen


def test_filled(spark):
    draw = random.Random(4)
    masks = {s: {(draw.randrange(12), draw.randrange(12)) for _ in range(110)} for s in range(4)}
    masks[7] = {(3, 3)}
    rows = [(s, y, x) for s, m in masks.items() for y, x in m]
    want = sorted(rows + [(s, y, x) for s, m in masks.items() for y, x in holes(m)])
    assert len(want) > len(rows)
    assert pixels(raster.filled(spark.createDataFrame(rows, MASK), ["s"], 16)) == want
    assert raster.filled(spark.createDataFrame([], MASK), ["s"], 16).collect() == []


def test_sized_components(spark):
    rows = [(1, 0, 0), (1, 0, 1), (1, 5, 5), (1, 9, 0), (1, 9, 1), (2, 0, 15), (2, 1, 0)]
    got = {(r.s, r.y, r.x): (r.component, r.n, r.largest) for r in raster.sized_components(spark.createDataFrame(rows, MASK), ["s"], 16).collect()}
    assert got[1, 0, 1] == (0, 2, True) and got[1, 9, 0] == (144, 2, False) and got[1, 5, 5] == (85, 1, False)
    assert got[2, 0, 15] == (15, 1, True) and got[2, 1, 0] == (16, 1, False)  # a row's end does not meet the next one's start


def test_grown_and_reassigned(spark):
    seeds = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 10, 6)], MASK + ", label int")
    within = spark.createDataFrame([(1, 0, x) for x in range(16)] + [(2, 0, 0)], MASK)
    got = {(r.s, r.x): r.label for r in raster.grown(seeds, within, ["s"], 16).collect()}
    assert [got[1, x] for x in range(16)] == [5] * 6 + [6] * 10 and (2, 0) not in got
    both = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 3, 9)], MASK + ", label int")
    fixed = raster.reassigned(both, F.col("label") < 9, F.col("x") > 2, ["s"], 16)
    assert sorted((r.x, r.label) for r in fixed.collect()) == [(0, 5), (3, 5)]
    with pytest.raises(Exception, match="away from the edge"):
        raster.reassigned(both, F.col("label") < 9, F.col("x") > 3, ["s"], 16).collect()


def test_boxes_and_bounds(spark):
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    df = spark.createDataFrame([((0.0, 0.0, 2.0, 2.0), (1.0, 1.0, 3.0, 3.0)), ((0.0, 0.0, 1.0, 1.0), (4.0, 5.0, 5.0, 6.0)), ((0.0, 0.0, 4.0, 4.0), (1.0, 1.0, 2.0, 2.0)), ((1.0, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, 1.0))], f"a {box}, b {box}")
    got = df.select(geometry.box_iou(F.col("a"), F.col("b")), geometry.box_hausdorff(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(1 / 7, 2**0.5), (0.0, 41**0.5), (1 / 16, 8**0.5), (None, 0.0)]
    bad = spark.createDataFrame([((3.0, 0.0, 1.0, 1.0),)], f"b {box}").withColumn("ring", F.lit(None).cast("array<struct<x:double,y:double>>"))
    with pytest.raises(Exception, match="reversed bounds"):
        bad.select(geometry.first_bounds(F.col("ring"), F.col("b"), F.lit(0.0), F.lit(0.0))).collect()


def test_sampled_boundary(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    df = spark.createDataFrame([(1, square), (2, [(1.0, 1.0)]), (3, [])], "polygon int, ring array<struct<x:double,y:double>>")
    got = sorted((r.polygon, r.k, r.x, r.y) for r in geometry.sampled_boundary(df, [], 8).collect())
    assert got == [(1, i, *p) for i, p in enumerate([(0, 0), (2, 0), (4, 0), (4, 2), (4, 4), (2, 4), (0, 4), (0, 2)])]


def test_roles(spark):
    rows = [(1, "A", 0.0), (1, "B", 3.0), (1, "C", 0.0), (2, "A", 0.0), (2, "B", 30.0), (3, "C", 0.0), (4, "A", 0.0), (4, "C", 1.0)]
    members = spark.createDataFrame([(c, s, x, 0.0) for c, s, x in rows], "component int, source string, x double, y double")
    got = {r.component: (r.sources, r.n_broad, r.score, r.agreement, r.tier, r.status) for r in evidence.role_evidence(members, [], ["A", "B"], 12.0, 2).collect()}
    assert got[1] == ("A;B;C", 2, 0.875, "high", "broad_consensus_with_scoped_support", "accepted_instance_fusion")
    assert got[2] == ("A;B", 2, 0.5, "moderate", "broad_consensus", "abstained_broad_detector_distance")
    assert got[3] == ("C", 0, 0.0, "low", "scoped_support_only", "abstained_insufficient_detector_support")
    assert got[4] == ("A;C", 1, 0.5, "moderate", "single_broad_with_scoped_support", "abstained_missing_broad_detector_consensus")


def test_rules_and_galleries(spark):
    df = spark.createDataFrame([(1, 5, 2), (2, 1, 2), (3, None, 2)], "id int, a int, b int")
    assert [tuple(r) for r in constraints.violations(df, ["id"], {"order": F.col("a") <= F.col("b"), "never": F.lit(True)}).collect()] == [(1, "order")]
    got = sorted((r.b, r.id, r.nth, r.omitted) for r in ordered.gallery(df, ["b"], ["id"], 2).collect())
    assert got == [(2, 1, 1, 1), (2, 2, 2, 1)]
    packet, key = ordered.blinded(df, ["b"], "a", "id", 1, F.col("id"))
    assert packet.columns == ["b", "item", "id"] and key.columns == ["b", "item", "a"] and packet.count() == 3


def test_edge_ratio(spark):
    df = spark.createDataFrame([(1, 2.0, True), (1, 4.0, False), (2, 2.0, True), (3, 0.0, False), (3, 1.0, True)], "s int, v double, e boolean")
    assert {r.s: r.ratio for r in aggregates.edge_ratio(df, ["s"], "v", "e", 1, 1).collect()} == {1: 0.5, 2: None, 3: None}


def test_readable(spark):
    df = spark.createDataFrame([(0,), (1023,), (1024,), (1280,), (1536,), (5 * 1024**3,), (3 * 1024**5,), (None,)], "n long")
    assert [r[0] for r in df.select(scalars.readable_bytes(F.col("n"))).collect()] == ["0 B", "1023 B", "1.0 KB", "1.2 KB", "1.5 KB", "5.0 GB", "3072.0 TB", None]
    df = spark.createDataFrame([(-3.0,), (0.5,), (59.6,), (3600.0,), (90061.0,)], "n double")
    assert [r[0] for r in df.select(scalars.readable_seconds(F.col("n"))).collect()] == ["0s", "0s", "1m 0s", "1h 0m 0s", "25h 1m 1s"]


def test_modes(spark):
    df = spark.createDataFrame([(None,), (" ALL ",), ("full",), ("full,cyto",), ("label+nuclei, ,square",)], "t string")
    assert [r[0] for r in df.select(scalars.modes(F.col("t"))).collect()] == [["tile", "inner_square"], ["tile", "inner_square"], ["tile", "nuclei", "cyto", "inner_square"], ["tile", "cyto"], ["nuclei", "inner_square"]]
    for text, fault in (("tile,other", "unknown mode: other"), (" , + ", "no mode")):
        with pytest.raises(Exception, match=fault):
            spark.createDataFrame([(text,)], "t string").select(scalars.modes(F.col("t"))).collect()


def test_declared(spark):
    texts = ['{"a": 1, "properties": {"b": "x"}, "metadata": {"a": {"b": 2}}, "features": [{"a": 1, "properties": {"b": " y "}}, {"b": ""}]}', "{}", "not json", None, '{"features": []}']
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(scalars.declared(F.col("t"), ("a", "b"))).collect()]
    assert got == [["1", "x", "y"], [], [], [], []]


def test_index_spreads_a_row_of_tiles(spark, tmp_path):
    """One row of tiles is cut into several files, each with its own range of columns."""
    df = spark.range(40_000).select(F.col("id").alias("cell_id"), (F.col("id") % 5000).cast("double").alias("x"), F.lit(1.0).alias("y"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it would join so small ranges again
    try:
        records.build_index(df, str(tmp_path / "index"), 10)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = records.query_index(spark, str(tmp_path / "index"), 10, 100, 0, 119, 5)
    assert got.count() == 160 and len(list((tmp_path / "index" / "bin_y=0").glob("*.parquet"))) > 1


def test_percentiles_and_spearman(spark):
    draw = random.Random(1)
    rows = [(g, float(draw.randrange(9)), draw.choice([None, *range(5)])) for g in range(3) for _ in range(50)] + [(7, None, 1), (8, 2.0, 2)]
    df = spark.createDataFrame(rows, "g int, a double, b int")
    got = {r.g: (r.p, r.q) for r in aggregates.percentiles(df, ["g"], "a", {"p": 0.33, "q": 1.0}).collect()}
    want = {r.g: (r.p, r.q) for r in df.groupBy("g").agg(F.percentile("a", 0.33).alias("p"), F.percentile("a", 1.0).alias("q")).where("p IS NOT NULL").collect()}
    assert got == {g: pytest.approx(v) for g, v in want.items()}
    assert aggregates.percentiles(df.limit(0), [], "a", {"p": 0.5}).collect()[0].p is None
    assert {r.g: r.mad for r in aggregates.robust_scale(df, ["g"], "a").where("g > 6").collect()} == {7: None, 8: 0.0}
    full = df.where("a IS NOT NULL AND b IS NOT NULL")
    ranked = full.select("g", aggregates.average_rank("a", ["g"]).alias("ra"), aggregates.average_rank("b", ["g"]).alias("rb"))
    want = {r.g: r.r for r in aggregates.correlation(ranked, ["g"], "ra", "rb", "r").collect()}
    got = {r.g: r.spearman for r in aggregates.spearman(df, ["g"], "a", "b").collect()}
    assert got == {g: v if v is None else pytest.approx(v) for g, v in want.items()}

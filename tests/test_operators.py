"""What SQL cannot express, and how operators treat odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.functions import scalars
from tesserae.operators import aggregates, constraints, geometry, graph, joins, ordered, raster
from tesserae.plans import catalog, statistics
from tesserae.plans.frames import cells, scores


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_greedy_union_takes_no_source_twice(spark):
    points = spark.createDataFrame([(0, 1, "one", 10.0, 10.0), (0, 2, "one", 11.0, 10.0), (0, 3, "two", 10.2, 10.0), (0, 4, "three", 10.4, 10.0)], "s int, id long, source string, x double, y double")
    near = joins.nearest_of_sources(points, ["s"], 2.0, 4)
    got = dict(graph.greedy_union(near.select("s", "a", "b", "d"), points, ["s"]).select("id", "fused").collect())
    sizes = sorted(list(got.values()).count(v) for v in set(got.values()))
    assert sizes == [1, 3] and got[1] != got[2]


def test_fused_instances_replay(spark, sf_dir):
    points = cells(spark, sf_dir).select("sample_id", F.col("cell_id").alias("id"), "source", "x", "y")
    rows = {r["id"]: r for r in points.collect()}
    edges = joins.nearest_of_sources(points, ["sample_id"], 24.0, 4).collect()
    parent = {i: i for i in rows}
    held = {i: {r["source"]} for i, r in rows.items()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in sorted(edges, key=lambda e: (e["d"], e["a"], e["b"])):
        p, q = root(e["a"]), root(e["b"])
        if p != q and not held[p] & held[q]:
            low, high = min(p, q), max(p, q)
            parent[high] = low
            held[low] |= held.pop(high)
    got = {r["id"]: r["fused"] for r in catalog.queries()["fused_instances"](spark, sf_dir).collect()}
    assert got == {i: root(i) for i in rows}


def test_radius_is_exclusive(spark):
    points = spark.createDataFrame([(0, 1, 0.0, 0.0), (0, 2, 5.0, 0.0)], "s int, id long, x double, y double")
    assert joins.near_pairs(points, ["s"], 5.0).count() == 0
    assert joins.near_pairs(points, ["s"], 5.01).count() == 2


def test_gap_clusters(spark, sf_dir):
    by = {}
    for r in cells(spark, sf_dir).select("patient", "y").collect():
        by.setdefault(r["patient"], []).append(r["y"])
    want = []
    for p, ys in by.items():
        group, total, n = 1, 0.0, 0
        for y in sorted(ys):
            if n and abs(y - total / n) > 12.0:
                group, total, n = group + 1, 0.0, 0
            total, n = total + y, n + 1
            want.append((p, y, group))
    assert sorted(map(tuple, statistics.gap_clusters(spark, sf_dir).collect())) == sorted(want)


def test_partial_correlation_with_controls(spark, sf_dir):
    got = {r["grp"]: r["partial"] for r in statistics.partial_correlation_many(spark, sf_dir).collect()}
    data = scores(spark, sf_dir).toPandas()
    for grp, g in data.groupby("grp"):
        c = np.stack([np.ones(len(g)), g["id"], g["id"] % 7], 1)
        res = [v - c @ np.linalg.lstsq(c, v, rcond=None)[0] for v in (g["score"].to_numpy(float), g["measured"].to_numpy(float))]
        assert abs(got[grp] - np.corrcoef(*res)[0, 1]) < 1e-6


def test_one_to_one_refuses_repeats(spark):
    a, b = spark.createDataFrame([(1,), (1,)], "k int"), spark.createDataFrame([(1,)], "k int")
    with pytest.raises(Exception, match="repeats"):
        joins.one_to_one(a, b, "k").collect()


def test_nucleus_of_another_label_is_an_error(spark):
    df = spark.createDataFrame([(7, 8, 0, 0, 1)], "label int, nucleus int, y int, x int, v int")
    with pytest.raises(Exception, match="another label"):
        aggregates.zonal_outside(df, [], ["v"]).collect()


def test_scalars(spark):
    assert [one(spark, scalars.seconds(F.lit(t))) for t in ("1h 2m 3s", "12ms", "1:02:03", "x", "1.5s")] == [3723.0, 0.012, 3723.0, None, 1.5]
    assert [one(spark, scalars.memory_bytes(F.lit(t))) for t in ("1.5 GB", "10 MiB", "7", "x")] == [1.5 * 1024**3, 10 * 1024**2, 7.0, None]
    assert [one(spark, scalars.normal_id(F.lit(t))) for t in (' "7.0" ', "cell_1", "7.5")] == ["7", "cell_1", "7.5"]
    assert one(spark, scalars.trailing_number(F.lit("ab12"))) == 12 and one(spark, scalars.trailing_number(F.lit("ab"))) is None
    assert one(spark, scalars.first_argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0)))) == 1
    assert one(spark, scalars.json_path(F.lit('{"a":{"b":"c"}}'), "x.y", "a.b")) == "c"


def test_polygons(spark):
    square = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 4), (0, 4))))
    bow = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 4), (4, 0), (0, 4))))
    assert one(spark, geometry.area(square)) == 16.0
    assert one(spark, geometry.inside(square, F.lit(1.0), F.lit(3.0))) and not one(spark, geometry.inside(square, F.lit(5.0), F.lit(3.0)))
    assert one(spark, geometry.on_edge(square, F.lit(4.0), F.lit(3.0)))
    assert not one(spark, geometry.crosses_itself(square)) and one(spark, geometry.crosses_itself(bow))


def test_constant_columns_have_no_correlation(spark):
    df = spark.createDataFrame([(1, 2, i) for i in range(5)], "g int, a int, b int")
    assert aggregates.correlation(df, ["g"], "a", "b", "r").first()["r"] is None


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "src long, dst long")
    assert {r["component"] for r in graph.components(edges).collect()} == {0}


def test_pages_have_bounds(spark):
    with pytest.raises(ValueError):
        ordered.page(spark.range(1), "id", 0, 2001)


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing columns: b"):
        constraints.require_columns(spark.range(1).toDF("a"), ["a", "b"])


def test_empty_frames(spark, sf_dir):
    none = cells(spark, sf_dir).where("false")
    assert aggregates.chance_agreement(none, ["sample_id"], "kind").count() == 0
    assert raster.lattice(none, ["sample_id"], 10, 10, 3).count() == 0
    assert joins.near_pairs(none.select("sample_id", F.col("cell_id").alias("id"), "x", "y"), ["sample_id"], 5.0).count() == 0


def test_aligned_labels(spark, sf_dir):
    counts = {}
    for r in cells(spark, sf_dir).collect():
        key = (r["sample_id"], (r["kind"] + r["sample_id"]) % 5 * 10, r["kind"])
        counts[key] = counts.get(key, 0) + 1
    got = {(r["sample_id"], r["label"]): r["aligned"] for r in catalog.queries()["aligned_labels"](spark, sf_dir).collect()}
    for s in {k[0] for k in counts}:
        pairs = sorted((-n, lab, ref) for (t, lab, ref), n in counts.items() if t == s)
        named = {}
        for _, lab, ref in pairs:
            if lab not in named and ref not in named.values():
                named[lab] = ref
        assert all(got[s, lab] == ref for lab, ref in named.items())

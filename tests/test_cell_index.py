"""The cell index: what may be published, what an open one finds, and that changes are seen."""

import pytest
from pyspark.sql import functions as F

from tesserae.sources import cell_index


def parts(spark):
    cells = spark.createDataFrame([(i, float(10 * i), float(7 * i % 50), "s") for i in range(20)], "cell_id long, x double, y double, source string")
    told = spark.createDataFrame([(i, m, i % 2, f"l{i % 2}", None if i == 3 else i / 20) for i in range(20) for m in ("a", "b")], "cell_id long, model string, class_id int, label string, probability double")
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "cell_id long, values array<double>")
    return cells, told, vectors


def test_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    cells, told, vectors = parts(spark)
    manifest = cell_index.publish(cells, told, vectors, path, 16, ["a", "b"])
    assert {t: v["rows"] for t, v in manifest["tables"].items()} == {"cells": 20, "predictions": 40, "features": 20, "vectors": 20}
    index = cell_index.open_index(spark, path, verify=True)
    assert sorted(r["cell_id"] for r in index.viewport(20, 0, 90, 30).collect()) == [i for i in range(2, 10) if 7 * i % 50 <= 30]
    assert sorted(r["cell_id"] for r in index.viewport(0, 0, 200, 50, "b", ["l1"], 0.5).collect()) == [3, 11, 13, 15, 17, 19]
    got = index.vectors_of(spark.createDataFrame([(4,), (4,), (17,), (99,)], "cell_id long")).collect()
    assert sorted((r["cell_id"], r["values"]) for r in got) == [(4, [4.0, 1.0]), (17, [17.0, 1.0])]
    with pytest.raises(ValueError, match="no model"):
        index.viewport(0, 0, 1, 1, "c")
    with pytest.raises(FileExistsError):
        cell_index.publish(cells, told, vectors, path, 16, ["a", "b"])


def test_changes_and_unfinished_indexes_are_seen(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    cells, told, vectors = parts(spark)
    cell_index.publish(cells, told, vectors.where("false"), path, 16, ["a", "b"])
    index = cell_index.open_index(spark, path, verify=True)
    index.table("predictions").limit(1).write.mode("append").parquet(f"{path}/predictions")
    with pytest.raises(ValueError, match="predictions has changed"):
        cell_index.open_index(spark, path, verify=True)
    with pytest.raises(ValueError, match="no finished index"):
        cell_index.open_index(spark, f"file://{tmp_path}/other")


@pytest.mark.parametrize(
    "why, change",
    [
        ("id repeats", lambda c, p, v: (c.unionByName(c.limit(1)), p, v)),
        ("one prediction a model", lambda c, p, v: (c, p.where("NOT (cell_id = 5 AND model = 'a')"), v)),
        ("one prediction a model", lambda c, p, v: (c, p.where("cell_id <> 5 OR model <> 'a'").unionByName(p.where("cell_id = 5 AND model = 'b'")), v)),
        ("unknown model", lambda c, p, v: (c, p.withColumn("model", F.when(F.col("cell_id") == 1, "z").otherwise(F.col("model"))), v)),
        ("prediction without a cell", lambda c, p, v: (c.where("cell_id > 0"), p, v)),
        ("not finite", lambda c, p, v: (c, p, v.withColumn("values", F.when(F.col("cell_id") == 2, F.array(F.lit(float("nan")))).otherwise(F.col("values"))))),
        ("vector repeats", lambda c, p, v: (c, p, v.unionByName(v.limit(1)))),
        ("cell without a vector", lambda c, p, v: (c, p, v.where("cell_id <> 7"))),
    ],
)
def test_what_may_not_be_published(spark, tmp_path, why, change):
    with pytest.raises(ValueError, match=why):
        cell_index.publish(*change(*parts(spark)), f"file://{tmp_path}/index", 16, ["a", "b"])
    assert not (tmp_path / "index").exists()

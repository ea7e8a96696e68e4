"""An index of cells in four tables: places, predictions, feature locators and feature vectors.

    cells        cell_id, x, y and what else they have, in folders by tile rows
    predictions  cell_id, model, class_id, label, probability: one row a cell and model
    features     cell_id, part, row: where a cell's vector stands
    vectors      part, row, values: the only copy of the vectors, in folders by part

A manifest with counts and fingerprints of all four is written last, so an index that was cut off
has none and can't be opened; nothing is ever written over. Fingerprints are sums of row hashes and
so do not depend on the order of rows or files.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.ordered import dealt
from .records import build_index

TABLES = ("cells", "predictions", "features", "vectors")
VERSION = 1


def fingerprint(df: DataFrame) -> dict[str, str | int]:
    """The number of rows and the sum of their hashes, over all columns by name."""
    n, total = df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")), F.lit(0))).first()
    return {"rows": n, "hash": str(int(total)), "columns": ",".join(sorted(df.columns))}


def _fail_if(found: DataFrame, why: str) -> None:
    bad = found.limit(1).collect()
    if bad:
        raise ValueError(f"{why}: {bad[0][0]}")


def checked(cells: DataFrame, predictions: DataFrame, vectors: DataFrame, models: Sequence[str]) -> None:
    """Raises ValueError unless ids are unique, every cell has one prediction a model, and one finite vector or none has any."""
    _fail_if(cells.groupBy("cell_id").count().where("count > 1 OR cell_id IS NULL"), "a cell's id repeats or is null")
    named = predictions.where(F.col("model").isin(*models)).groupBy("cell_id").agg(F.count("*").alias("n"), F.countDistinct("model").alias("m"))
    _fail_if(predictions.where(~F.coalesce(F.col("model").isin(*models), F.lit(False))).select("model"), "an unknown model")
    _fail_if(cells.join(named, "cell_id", "left").where((F.coalesce("n", F.lit(0)) != len(models)) | (F.col("m") != len(models))).select("cell_id"), "a cell without one prediction a model")
    _fail_if(predictions.join(cells.select("cell_id"), "cell_id", "left_anti").select("cell_id"), "a prediction without a cell")
    bad = F.col("values").isNull() | F.exists("values", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    _fail_if(vectors.where(bad).select("cell_id"), "a vector that is not finite")
    _fail_if(vectors.groupBy("cell_id").count().where("count > 1"), "a cell's vector repeats")
    _fail_if(vectors.join(cells.select("cell_id"), "cell_id", "left_anti").select("cell_id"), "a vector without a cell")
    if not vectors.isEmpty():
        _fail_if(cells.join(vectors.select("cell_id"), "cell_id", "left_anti").select("cell_id"), "a cell without a vector")


def publish(cells: DataFrame, predictions: DataFrame, vectors: DataFrame, path: str, tile: int, models: Sequence[str]) -> dict:
    """Write an index and return its manifest.

    cells: (cell_id, x, y, …); predictions: (cell_id, model, class_id, label, probability); vectors: (cell_id, values).
    """
    spark = cells.sparkSession
    if _exists(spark, path):
        raise FileExistsError(f"choose a new place for the index: {path}")
    checked(cells, predictions, vectors, models)
    build_index(cells, f"{path}/cells", tile)
    told = predictions.select("cell_id", "model", "class_id", "label", "probability")
    told.repartitionByRange("cell_id").sortWithinPartitions("cell_id", "model").write.parquet(f"{path}/predictions")
    placed = dealt(vectors.select("cell_id", "values"), ["cell_id"]).withColumnRenamed("_p", "part")
    placed = placed.withColumn("row", F.row_number().over(Window.partitionBy("part").orderBy("cell_id")) - 1)
    placed.select("cell_id", "part", "row").repartitionByRange("cell_id").sortWithinPartitions("cell_id").write.parquet(f"{path}/features")
    placed.select("part", "row", "values").repartition("part").sortWithinPartitions("part", "row").write.partitionBy("part").parquet(f"{path}/vectors")
    # Empty tables have no files, and folders no types, so a manifest has the schemas, too.
    schemas = {"cells": StructType([*cells.schema, StructField("bin_x", LongType()), StructField("bin_y", LongType())]), "predictions": told.schema, "features": placed.select("cell_id", "part", "row").schema, "vectors": placed.select("row", "values", "part").schema}
    manifest = {"version": VERSION, "tile": tile, "models": list(models), "schemas": {t: s.json() for t, s in schemas.items()}}
    manifest["tables"] = {t: fingerprint(Index(spark, path, manifest).table(t)) for t in TABLES}
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.text(f"{path}/manifest")
    return manifest


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


@dataclass
class Index:
    """An open index."""

    spark: SparkSession
    path: str
    manifest: dict

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(StructType.fromJson(json.loads(self.manifest["schemas"][name]))).parquet(f"{self.path}/{name}")

    def verify(self) -> Index:
        """Itself, unless a table is no longer what the manifest says."""
        for name, told in self.manifest["tables"].items():
            if fingerprint(self.table(name)) != told:
                raise ValueError(f"the index's table {name} has changed since it was published")
        return self

    def viewport(self, x0: float, y0: float, x1: float, y1: float, model: str | None = None, labels: Sequence[str] = (), least: float = 0.0) -> DataFrame:
        """Cells in a closed box; with a model, its predictions, of some labels only or from a probability on.

        Folders are pruned by tile rows and row groups by columns; predictions are met by id.
        """
        tile = self.manifest["tile"]
        found = self.table("cells").where(F.col("bin_y").between(int(y0 // tile), int(y1 // tile)) & F.col("bin_x").between(int(x0 // tile), int(x1 // tile)))
        found = found.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1)).drop("bin_y", "bin_x")
        if model is None:
            return found
        if model not in self.manifest["models"]:
            raise ValueError(f"the index has no model {model}")
        told = self.table("predictions").where(F.col("model") == model).where(F.col("probability").isNull() | (F.col("probability") >= least))
        told = told.where(F.col("label").isin(*labels)) if labels else told
        return found.join(told, "cell_id")

    def vectors_of(self, ids: DataFrame) -> DataFrame:
        """(cell_id, values) of the cells in `ids`, by way of their locators; only the parts that hold them are read."""
        where = self.table("features").join(ids.select("cell_id").distinct(), "cell_id")
        return where.join(self.table("vectors"), ["part", "row"]).select("cell_id", "values")


def open_index(spark: SparkSession, path: str, verify: bool = False) -> Index:
    """The index at a place; with `verify` its tables are held against the manifest."""
    if not _exists(spark, f"{path}/manifest/_SUCCESS"):
        raise ValueError(f"no finished index at {path}")
    manifest = json.loads(spark.read.text(f"{path}/manifest").first()["value"])
    if manifest.get("version") != VERSION:
        raise ValueError("an index of another version")
    index = Index(spark, path, manifest)
    return index.verify() if verify else index

"""Reading and writing of record files: JSON instances, listings, bundles and the cell index."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CELL = "struct<centroid:array<double>,type:int,type_prob:double>"


def instances(documents: DataFrame, column: str) -> DataFrame:
    """(source_id, x, y, kind, probability) of JSON texts whose `cells` are a list or an object by id.

    Entries without a centroid are left out; entries of a list are named by their place from 0.
    """
    body = F.get_json_object(column, "$.cells")
    listed = F.transform(F.from_json(body, f"array<{CELL}>"), lambda c, i: F.struct(i.cast("string").alias("key"), c.alias("value")))
    keyed = F.transform(F.map_entries(F.from_json(body, f"map<string,{CELL}>")), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    rows = documents.select(F.explode(F.when(F.substring(F.ltrim(body), 1, 1) == "[", listed).otherwise(keyed)).alias("e"))
    named = rows.select(F.col("e.key").alias("source_id"), F.get("e.value.centroid", F.lit(0)).alias("x"), F.get("e.value.centroid", F.lit(1)).alias("y"), F.col("e.value.type").alias("kind"), F.col("e.value.type_prob").alias("probability"))
    return named.where("x is not null and y is not null")


def best_files(files: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    """(sample, path): for each sample the file whose suffix comes first in `suffixes`; ties to the first path."""
    rank = F.lit(None).cast("int")
    stem = F.col("path")
    for i, s in reversed(list(enumerate(suffixes))):
        hit = F.col("path").endswith(s)
        rank = F.when(hit, F.lit(i)).otherwise(rank)
        stem = F.when(hit, F.expr(f"substr(path, 1, length(path) - {len(s)})")).otherwise(stem)
    known = files.select("path", rank.alias("_rank"), F.regexp_extract(stem, "[^/]*$", 0).alias("sample")).where("_rank is not null")
    w = Window.partitionBy("sample").orderBy("_rank", "path")
    return known.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("sample", "path")


def row_digest(*columns: Column) -> Column:
    """SHA-256 of a row's columns as JSON."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def feature_collection(rows: DataFrame, name: str) -> Column:
    """A GeoJSON point of a row (x, y) with its name."""
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates")).alias("geometry"), F.struct(F.col(name).alias("name")).alias("properties")))


def build_index(cells: DataFrame, path: str, tile: int) -> None:
    """Write cells for look-ups by place: one folder a tile row, sorted within, never over an existing index.

    Tasks take ranges of (row, column, cell), so a row of many cells is written by several.
    """
    placed = cells.withColumn("bin_y", F.floor(F.col("y") / tile)).withColumn("bin_x", F.floor(F.col("x") / tile))
    placed.repartitionByRange("bin_y", "bin_x", "cell_id").sortWithinPartitions("bin_y", "bin_x", "cell_id").write.mode("errorifexists").partitionBy("bin_y").parquet(path)


def query_index(spark: SparkSession, path: str, tile: int, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Cells of the index in a closed box: folders are pruned by bin_y, row groups by bin_x."""
    found = spark.read.parquet(path).where(F.col("bin_y").between(int(y0 // tile), int(y1 // tile)) & F.col("bin_x").between(int(x0 // tile), int(x1 // tile)))
    return found.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1)).drop("bin_y", "bin_x")


def _json_fault(text: str | None) -> str | None:
    def once(pairs: list) -> dict:
        out = dict(pairs)
        if len(out) < len(pairs):
            names = [k for k, _ in pairs]
            raise ValueError(f"repeated key: {min(k for k in out if names.count(k) > 1)}")
        return out

    if text is None:
        return "no text"
    try:
        json.loads(text, object_pairs_hook=once, parse_constant=lambda c: (_ for _ in ()).throw(ValueError("not a number")))
    except json.JSONDecodeError:
        return "malformed"
    except (ValueError, RecursionError) as e:
        return str(e)
    return None


def strict_json(df: DataFrame, column: str) -> DataFrame:
    """`df` with `fault`: null for strict JSON, else why not: malformed, repeated key, not a number, no text.

    Spark's own parser takes the last of repeated keys in silence, so texts are read in Arrow batches.
    """

    @F.pandas_udf("string")
    def fault(texts):
        return texts.map(_json_fault)

    return df.withColumn("fault", fault(F.col(column)))


def write_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write a table as CSV files with headers, never over an existing one."""
    df.write.mode("errorifexists").csv(path, header=True, compression=compression, quoteAll=True)


def read_csv(spark: SparkSession, path: str, schema: StructType, wanted: Sequence[str] | None = None) -> DataFrame:
    """CSV files, compressed or not, under a schema; a value that breaks it is an error. Columns `wanted` beyond it are null."""
    rows = spark.read.csv(path, header=True, schema=schema, mode="FAILFAST", enforceSchema=False)
    names = rows.columns if wanted is None else wanted
    return rows.select(*(F.col(n) if n in rows.columns else F.lit(None).cast("string").alias(n) for n in names))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, bytes) of the files under a folder, without reading any."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return found.select("path", F.col("length").alias("bytes"))


def pack(df: DataFrame, key: str, path: str, files: int) -> None:
    """Write a table as a bundle of Parquet files dealt by ranges of `key`, with every row's digest, never over an existing one."""
    digested = df.withColumn("_sha256", row_digest(*(F.col(c) for c in df.columns)))
    digested.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("errorifexists").parquet(path)


def restored(spark: SparkSession, path: str) -> DataFrame:
    """A bundle's rows with `intact`: whether each still has the digest it was packed with."""
    rows = spark.read.parquet(path)
    names = [c for c in rows.columns if c != "_sha256"]
    return rows.withColumn("intact", F.col("_sha256").eqNullSafe(row_digest(*(F.col(c) for c in names)))).drop("_sha256")

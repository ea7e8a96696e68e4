"""Predicates, filters and constraint checks.

Checks return the rows that break a rule as (rule, key), so an empty frame means that all is well.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """`df`, or an error that names the missing columns."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def is_finite(*columns: str) -> Column:
    """Whether all columns hold finite numbers."""
    tests = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c)) < float("inf")) for c in columns]
    return reduce(lambda a, b: a & b, tests)


def complete_cases(df: DataFrame, keys: Sequence[str], needed: Sequence[str], most_missing: float) -> DataFrame:
    """Rows with all `needed` columns, of the groups that miss at most that share of their rows."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needed])
    share = df.groupBy(*keys).agg(F.avg(missing.cast("int")).alias("missing_share"))
    return df.join(share.where(F.col("missing_share") <= most_missing), list(keys)).dropna(subset=list(needed))


def on_mask(points: DataFrame, mask: DataFrame, keys: Sequence[str], scale: float) -> DataFrame:
    """Points whose pixel, floor(coordinate * scale), is in `mask` (keys, my, mx): a left-semi equi-join."""
    placed = points.withColumn("my", F.floor(F.col("y") * scale)).withColumn("mx", F.floor(F.col("x") * scale))
    return placed.join(mask, [*keys, "my", "mx"], "left_semi").drop("my", "mx")


def keep_labels(pixels: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pixels with labels outside `kept` (keys, label) set to 0."""
    known = kept.select(*keys, "label").distinct().withColumn("_kept", F.lit(True))
    return pixels.join(known, [*keys, "label"], "left").withColumn("label", F.when(F.col("_kept"), F.col("label")).otherwise(F.lit(0))).drop("_kept")


def viewport(cells: DataFrame, x0: float, y0: float, x1: float, y1: float, kinds: Sequence[int] | None = None, most_probability: float | None = None) -> DataFrame:
    """Cells in the closed box, of the kinds, and up to a probability; a null probability passes."""
    out = cells.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))
    if kinds is not None:
        out = out.where(F.col("kind").isin(list(kinds)))
    if most_probability is not None:
        out = out.where(F.col("probability").isNull() | (F.col("probability") <= most_probability))
    return out


def _violations(df: DataFrame, rule: str, key: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"))


def leakage(df: DataFrame, unit: str, split: str) -> DataFrame:
    """Units that stand in more than one split."""
    return _violations(df.groupBy(unit).agg(F.countDistinct(split).alias("n")).where("n > 1"), f"{unit} in several values of {split}", F.col(unit))


def varies_within(df: DataFrame, unit: str, columns: Sequence[str]) -> DataFrame:
    """Units within which a column has more than one value, null being one."""
    found = df.groupBy(unit).agg(*(F.size(F.collect_set(F.struct(F.col(c)))).alias(c) for c in columns))
    return reduce(DataFrame.unionByName, [_violations(found.where(F.col(c) > 1), f"{c} varies", F.col(unit)) for c in columns])


def not_summing_to_one(df: DataFrame, key: str, column: str, tolerance: float = 1e-5) -> DataFrame:
    """Rows whose probabilities are negative or do not sum to one."""
    total = F.aggregate(column, F.lit(0.0), lambda a, x: a + x)
    return _violations(df.where(F.exists(column, lambda p: p < 0) | (F.abs(total - 1.0) > tolerance)), "probabilities", F.col(key))


def overlapping_cores(grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grid rows that start where a core before them in their row, not just the last one, has not ended."""
    from pyspark.sql import Window

    before = Window.partitionBy(*keys, "y0").orderBy("x0", "label").rowsBetween(Window.unboundedPreceding, -1)
    return _violations(grid.withColumn("_end", F.max("x1").over(before)).where("_end > x0"), "overlap", F.col("label"))


def overlapping_boxes(boxes: DataFrame, keys: Sequence[str], tile: int) -> DataFrame:
    """(keys, a, b): pairs of boxes (label, x0, y0, x1, y1) with area in common, a before b, wherever they lie.

    Boxes meet in the tiles that both touch; the first such tile reports a pair, so none is told twice.
    """
    keys = list(keys)
    reach = F.expr(f"sequence(floor(x0 / {tile}), greatest(floor(x0 / {tile}), ceil(x1 / {tile}) - 1))"), F.expr(f"sequence(floor(y0 / {tile}), greatest(floor(y0 / {tile}), ceil(y1 / {tile}) - 1))")
    spread = boxes.select(*keys, "label", "x0", "y0", "x1", "y1").withColumn("_tx", F.explode(reach[0])).withColumn("_ty", F.explode(reach[1]))
    other = spread.select(*keys, "_tx", "_ty", F.col("label").alias("b"), *(F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")))
    met = spread.withColumnRenamed("label", "a").join(other, [*keys, "_tx", "_ty"]).where("a < b AND x0 < _x1 AND _x0 < x1 AND y0 < _y1 AND _y0 < y1")
    first = (F.col("_tx") == F.floor(F.greatest("x0", "_x0") / tile)) & (F.col("_ty") == F.floor(F.greatest("y0", "_y0") / tile))
    return met.where(first).select(*keys, "a", "b")


def conflicting_values(df: DataFrame, unit: str, order: str, value: str, tolerance: float) -> DataFrame:
    """Rows whose value differs from their unit's smallest or largest by more than a share of the larger one, with these.

    A row that conflicts with any row of its unit conflicts with one of the two, so no pairs are formed. Values are positive.
    """
    ends = df.groupBy(unit).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    met = df.select(unit, order, value).join(ends, unit)
    apart = (F.col(value) - F.col("low") > tolerance * F.col(value)) | (F.col("high") - F.col(value) > tolerance * F.col("high"))
    return met.where(apart).select(unit, order, "low", "high")


def not_bijective(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return _violations(a.join(b, key, "left_anti"), "only left", F.col(key)).unionByName(_violations(b.join(a, key, "left_anti"), "only right", F.col(key)))


def repeated(df: DataFrame, key: str) -> DataFrame:
    """Keys of more than one row."""
    return _violations(df.groupBy(key).count().where("count > 1"), f"{key} repeats", F.col(key))


def violations(df: DataFrame, keys: Sequence[str], rules: dict[str, Column]) -> DataFrame:
    """(keys, rule): every rule over several fields that a row breaks; a rule that is null holds."""
    broken = F.array(*(F.when(~rule, F.lit(name)) for name, rule in rules.items()))
    return df.select(*keys, F.explode(F.filter(broken, lambda r: r.isNotNull())).alias("rule"))

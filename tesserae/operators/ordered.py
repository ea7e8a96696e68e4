"""Ranking, running sums, top-k, pages and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each group in an order; unlike dropDuplicates, which row it is is defined."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def top_fraction(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], fraction: float, most: int) -> DataFrame:
    """The first min(most, max(1, ceil(n * fraction))) rows of each group."""
    w = Window.partitionBy(*keys)
    n = F.count(F.lit(1)).over(w)
    ranked = df.withColumn("rank", F.row_number().over(w.orderBy(*order))).withColumn("_n", n)
    return ranked.where(F.col("rank") <= F.least(F.lit(most), F.greatest(F.lit(1), F.ceil(F.col("_n") * fraction)))).drop("_n")


def page(df: DataFrame, key: str, cursor: int, limit: int) -> DataFrame:
    """One row more than `limit` after `cursor` in key order; the extra one says that there are more."""
    if not 1 <= limit <= 2000:
        raise ValueError("a page has 1 to 2000 rows")
    return df.where(F.col(key) > cursor).orderBy(key).limit(limit + 1)


def dense_labels(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Labels renumbered from 1 without gaps, and by falling size with ties to the smaller label."""
    sizes = df.groupBy(*keys, label).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    return sizes.select(*keys, label, "n", F.row_number().over(w.orderBy(label)).alias("dense"), F.row_number().over(w.orderBy(F.desc("n"), label)).alias("by_size"))


def dealt(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """`df` dealt out by ranges of `order` and stored, with the number of its range, `_p`.

    What is summed up within ranges and carried over their ends then replaces one long window; rows
    of a large group fall into several ranges.
    """
    return stored(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))


def same(a: DataFrame, b: DataFrame, names: Sequence[str]) -> Column:
    """Whether two frames' columns are the same, nulls included."""
    return reduce(lambda x, y: x & y, (a[n].eqNullSafe(b[n]) for n in names), F.lit(True))


def running(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], value: str, also: Sequence[str] = ()) -> DataFrame:
    """Running sum of a long `value` up to a row, before it, and from it on; with the columns of `also`.

    Sums within ranges of the order, and the sums of the ranges before: a group of any size is
    spread over as many tasks as it needs.
    """
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    columns = list(dict.fromkeys([*keys, *order, value, *also]))
    rows = dealt(df.select(*columns), [*keys, *order])
    parts = Window.partitionBy(*keys).orderBy("_p")
    sums = rows.groupBy(*keys, "_p").agg(F.sum(value).alias("_s"))
    sums = sums.select(*keys, "_p", F.coalesce(F.sum("_s").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_s").over(Window.partitionBy(*keys)).alias("_all"))
    within = Window.partitionBy(*keys, "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_w", F.sum(value).over(within))
    met = summed.join(sums, same(summed, sums, [*keys, "_p"]))
    upto = F.col("_before") + F.col("_w")
    kept = [summed[c] for c in columns if c != value or c in also]
    return met.select(*kept, upto.alias("upto"), (upto - F.col(value)).alias("before"), (F.col("_all") - upto + F.col(value)).alias("from_here"))


def gap_clusters(df: DataFrame, keys: Sequence[str], value: str, gap: float) -> DataFrame:
    """Groups of values along a line: one joins the open group if within `gap` of its running mean.

    The mean moves with each value, so a group's members depend on their order. Rows are streamed
    through the tasks in that order, and only the open group's sum and count are held.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    columns = [*keys, value]

    def run(batches):
        key, group, total, n = None, 0, 0.0, 0
        for b in batches:
            out = []
            for row in b[columns].itertuples(index=False, name=None):
                v = row[-1]
                if row[:-1] != key:
                    key, group, total, n = row[:-1], 1, 0.0, 0
                elif abs(v - total / n) > gap:
                    group, total, n = group + 1, 0.0, 0
                total, n = total + v, n + 1
                out.append(group)
            yield b[columns].assign(cluster=pd.Series(out, index=b.index, dtype="int32"))

    dealt = df.select(*columns).repartition(*keys).sortWithinPartitions(*columns)
    return dealt.mapInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", cluster int")


def in_all(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Keys that every frame has, once each."""
    return reduce(lambda a, b: a.join(b.select(key).distinct(), key, "left_semi"), frames[1:], frames[0].select(key).distinct())


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def outermost(paths: DataFrame, column: str) -> DataFrame:
    """Paths that lie in no other path of the frame: an anti-join on every path's ancestors."""
    each = paths.select(column).distinct()
    parts = F.split(F.col(column), "/")
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    inside = each.withColumn("_up", F.explode(above)).where(F.col("_up") != F.col(column))
    nested = inside.join(each.select(F.col(column).alias("_up")), "_up", "left_semi").select(column).distinct()
    return each.join(nested, column, "left_anti")


def hashed_sample(df: DataFrame, keys: Sequence[str], per_group: int, draw: Column) -> DataFrame:
    """`per_group` rows of each group by a hashed draw; ties cannot reorder it if the draw is of the row's key."""
    w = Window.partitionBy(*keys).orderBy("_draw")
    return df.withColumn("_draw", draw).withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= per_group).drop("_draw")


def proportional_sample(df: DataFrame, stratum: str, most: int, draw: Column) -> DataFrame:
    """About `most` rows, each stratum in proportion and with one row at least."""
    w = Window.partitionBy(stratum)
    sizes = df.groupBy(stratum).agg(F.count("*").alias("_n"))
    total = sizes.agg(F.sum("_n").alias("_all"))
    quota = F.greatest(F.lit(1), F.rint(F.lit(float(most)) * F.col("_n") / F.col("_all")))
    ranked = df.withColumn("_draw", draw).withColumn("nth", F.row_number().over(w.orderBy("_draw")))
    return ranked.join(sizes.crossJoin(total), stratum).where(F.col("nth") <= quota).drop("_draw", "_n", "_all")


def page_envelope(df: DataFrame, key: str, cursor: int, limit: int) -> DataFrame:
    """One row for a page after `cursor`: its keys, how many rows there are in all, whether more follow, and the next cursor."""
    rows = page(df.select(key), key, cursor, limit)
    found = rows.agg(F.array_sort(F.collect_list(key)).alias("_k"))  # one more than `limit` at most
    shown = F.slice("_k", 1, limit)
    more = F.size("_k") > limit
    total = df.agg(F.count("*").alias("total"))
    return found.crossJoin(total).select(shown.alias("keys"), "total", more.alias("truncated"), F.when(more, F.element_at(shown, -1)).alias("next_cursor"))


def gallery(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], most: int) -> DataFrame:
    """The first `most` rows of each group in an order, with `nth` and how many rows the group leaves out."""
    w = Window.partitionBy(*keys)
    first = df.withColumn("nth", F.row_number().over(w.orderBy(*order))).where(F.col("nth") <= most)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return first.join(sizes, list(keys)).withColumn("omitted", F.greatest(F.col("_n") - most, F.lit(0))).drop("_n")


def blinded(df: DataFrame, group: Sequence[str], cluster: str, row: str, per_cluster: int, draw: Column) -> tuple[DataFrame, DataFrame]:
    """A review packet and its key: `per_cluster` drawn rows of every cluster, shuffled within `group` by another draw.

    The packet is (group, item, row) and says nothing of clusters; the key is (group, item, cluster).
    """
    drawn = hashed_sample(df, [*group, cluster], per_cluster, draw).select(*group, cluster, row)
    shuffled = F.struct(F.md5(F.concat_ws(":", F.lit("item"), F.col(row).cast("string"))), F.col(row))
    items = drawn.withColumn("item", F.row_number().over(Window.partitionBy(*group).orderBy(shuffled)))
    return items.select(*group, "item", row), items.select(*group, "item", cluster)

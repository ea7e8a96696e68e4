"""Aggregations over labels, strata, contingencies and scored observations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored
from .ordered import running


def zonal(pixels: DataFrame, keys: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """Area, coordinate sums, bounds (ends exclusive) and each channel's sum and maximum for every label but 0."""
    stats = [F.count("*").alias("area"), F.sum("x").alias("sum_x"), F.sum("y").alias("sum_y")]
    stats += [F.min("x").alias("x0"), (F.max("x") + 1).alias("x1"), F.min("y").alias("y0"), (F.max("y") + 1).alias("y1")]
    for c in channels:
        stats += [F.sum(c).alias(f"{c}_sum"), F.max(c).alias(f"{c}_max")]
    return pixels.where("label <> 0").groupBy(*keys, "label").agg(*stats)


def zonal_outside(pixels: DataFrame, keys: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """`zonal` over pixels of a label outside its nucleus; a pixel with another label's nucleus is an error."""
    same = F.assert_true((F.col("nucleus") == 0) | (F.col("nucleus") == F.col("label")), F.lit("nucleus of another label"))
    return zonal(pixels.where(same.isNull()).where("nucleus = 0"), keys, channels)


def long_to_wide(stats: DataFrame, keys: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """One row for each label and channel, with its mean."""
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("marker"), F.col(f"{c}_sum").alias("sum"), F.col(f"{c}_max").alias("max")) for c in channels)))
    return stats.select(*keys, "label", "area", rows.alias("r")).select(*keys, "label", "area", "r.*", (F.col("r.sum") / F.col("area")).alias("mean"))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def metrics(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and Jaccard of summed tp, fp and fn; F1 is 0 if either ratio is."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    p, r = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn)
    f1 = F.when((p == 0) | (r == 0), F.lit(0.0)).otherwise(safe_ratio(2 * p * r, p + r))
    return df.select("*", p.alias("precision"), r.alias("recall"), f1.alias("f1"), safe_ratio(tp, tp + fp + fn).alias("jaccard"))


def totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Micro-averages: counts are summed before the ratios are taken."""
    return metrics(df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn"))))


def stratified(df: DataFrame, keys: Sequence[str], strata: Sequence[str]) -> DataFrame:
    """`totals` within each value of each stratum; strata are unpivoted, so each row is read once."""
    named = F.explode(F.array(*(F.struct(F.lit(s).alias("stratum"), F.col(s).cast("string").alias("value")) for s in strata)))
    spread = df.select(*keys, "tp", "fp", "fn", "patient", named.alias("s")).select("*", "s.*").drop("s")
    sums = spread.groupBy(*keys, "stratum", "value").agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")), F.countDistinct("patient").alias("patients"))
    return metrics(sums)


def grouped_sets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums over every prefix of `keys`, down to the grand total."""
    return df.rollup(*keys).agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")), F.grouping_id().alias("level"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts joined by colons: the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(p.cast("string") for p in parts))), 1, 8), 16, 10).cast("double") / float(1 << 32)


def poisson_weight(u: Column, most: int = 6) -> Column:
    """A Poisson(1) count from a uniform number."""
    out, total, p = F.lit(0), 0.0, float(np.exp(-1.0))
    for k in range(most):
        total += p
        out = out + (u >= total).cast("int")
        p /= k + 1
    return out


def bootstrap(df: DataFrame, keys: Sequence[str], unit: str, rounds: int, level: float = 0.95) -> DataFrame:
    """Interval of the micro-averaged F1 over Poisson resamples of whole units.

    A resample's weights are hashed from the unit and its number, so the units are summed once and
    no draw depends on partitions.
    """
    sums = df.groupBy(*keys, unit).agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")))
    drawn = sums.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    weight = poisson_weight(uniform(F.col(unit), F.col("draw")))
    drawn = drawn.groupBy(*keys, "draw").agg(*(F.sum(F.col(c) * weight).alias(c) for c in ("tp", "fp", "fn")))
    ends = [(1 - level) / 2, (1 + level) / 2]
    f1 = safe_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return drawn.withColumn("f1", f1).groupBy(*keys).agg(F.percentile("f1", ends[0]).alias("low"), F.percentile("f1", ends[1]).alias("high"), F.avg("f1").alias("mean"))


def bootstrap_metrics(df: DataFrame, keys: Sequence[str], unit: str, rounds: int, level: float = 0.95) -> DataFrame:
    """(keys, metric, low, high, mean): as bootstrap(), for precision, recall, F1 and Jaccard index; resamples that leave one undefined don't count for it."""
    sums = df.groupBy(*keys, unit).agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")))
    drawn = sums.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    weight = poisson_weight(uniform(F.col(unit), F.col("draw")))
    drawn = drawn.groupBy(*keys, "draw").agg(*(F.sum(F.col(c) * weight).alias(c) for c in ("tp", "fp", "fn")))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    found = {"precision": safe_ratio(tp, tp + fp), "recall": safe_ratio(tp, tp + fn), "f1": safe_ratio(2 * tp, 2 * tp + fp + fn), "jaccard": safe_ratio(tp, tp + fp + fn)}
    each = drawn.select(*keys, F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value")) for n, v in found.items()))).alias("m")).select(*keys, "m.metric", "m.value")
    ends = [(1 - level) / 2, (1 + level) / 2]
    return each.groupBy(*keys, "metric").agg(F.percentile("value", ends[0]).alias("low"), F.percentile("value", ends[1]).alias("high"), F.avg("value").alias("mean"))  # `rounds` values a group


def contingency(df: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """Adjusted Rand index, mutual information and its normal form, homogeneity, completeness and variation.

    Both labellings constant: 1 for every ratio; natural logarithms.
    """
    cells = df.groupBy(*keys, a, b).agg(F.count("*").alias("n"))
    rows = Window.partitionBy(*keys, a)
    columns = Window.partitionBy(*keys, b)
    whole = Window.partitionBy(*keys)
    cells = cells.select("*", F.sum("n").over(rows).alias("na"), F.sum("n").over(columns).alias("nb"), F.sum("n").over(whole).alias("nn"))

    def pairs(c: Column) -> Column:
        return c * (c - 1) / 2.0

    p = F.col("n") / F.col("nn")
    sums = cells.groupBy(*keys).agg(
        F.max("nn").alias("nn"),
        F.sum(pairs(F.col("n"))).alias("same"),
        F.sum(pairs(F.col("na")) * F.col("n") / F.col("na")).alias("ra"),
        F.sum(pairs(F.col("nb")) * F.col("n") / F.col("nb")).alias("rb"),
        F.sum(p * F.log(F.col("n") * F.col("nn") / (F.col("na") * F.col("nb")))).alias("mi"),
        F.sum(-p * F.log(F.col("na") / F.col("nn"))).alias("ha"),
        F.sum(-p * F.log(F.col("nb") / F.col("nn"))).alias("hb"),
    )
    expected = F.col("ra") * F.col("rb") / pairs(F.col("nn"))
    top = (F.col("ra") + F.col("rb")) / 2.0

    def ratio(x: Column, y: Column) -> Column:
        return F.when(F.abs(y) < 1e-12, F.lit(1.0)).otherwise(F.try_divide(x, y))

    return sums.select(
        *keys,
        ratio(F.col("same") - expected, top - expected).alias("ari"),
        F.col("mi"),
        ratio(2 * F.col("mi"), F.col("ha") + F.col("hb")).alias("nmi"),
        ratio(F.col("mi"), F.col("ha")).alias("homogeneity"),
        ratio(F.col("mi"), F.col("hb")).alias("completeness"),
        (F.col("ha") + F.col("hb") - 2 * F.col("mi")).alias("variation"),
    )


def ranked_curve(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AUROC by average ranks and average precision by steps of distinct scores, of (truth, score) rows.

    Scores are counted first, so ties and hot scores are summed before the windows.
    """
    steps = df.groupBy(*keys, "score").agg(F.sum("truth").alias("pos"), F.sum(1 - F.col("truth")).alias("neg"))
    down = Window.partitionBy(*keys).orderBy(F.desc("score"))
    below = Window.partitionBy(*keys).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select(
        "*", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"), F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("below")
    )
    sums = steps.groupBy(*keys).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.sum(F.col("pos") * (2 * F.col("below") + F.col("neg"))).alias("wins2"), F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("gain")
    )
    both = 2 * F.col("positives") * F.col("negatives")
    return sums.select(*keys, "positives", "negatives", safe_ratio(F.col("wins2"), both).alias("auroc"), safe_ratio(F.col("gain"), F.col("positives")).alias("average_precision"))


def average_rank(column: str, keys: Sequence[str]) -> Column:
    """Ranks from 1, ties sharing their average."""
    w = Window.partitionBy(*keys).orderBy(column)
    return F.rank().over(w) + (F.count(F.lit(1)).over(Window.partitionBy(*keys, column)) - 1) / 2.0


def correlation(df: DataFrame, keys: Sequence[str], a: str, b: str, name: str, weight: str | None = None) -> DataFrame:
    """Pearson's r from exact sums; null under three rows or with a constant column. A row counts `weight` times."""
    x, y, w = F.col(a), F.col(b), F.lit(1) if weight is None else F.col(weight)
    s = df.groupBy(*keys).agg(F.sum(w).alias("n"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"), F.sum(w * x * x).alias("sxx"), F.sum(w * y * y).alias("syy"), F.sum(w * x * y).alias("sxy"))
    n = F.col("n").cast("double")
    cov = n * F.col("sxy") - F.col("sx") * F.col("sy")
    var = (n * F.col("sxx") - F.col("sx") * F.col("sx")) * (n * F.col("syy") - F.col("sy") * F.col("sy"))
    return s.select(*keys, F.when((F.col("n") >= 3) & (var > 0), cov / F.sqrt(var)).alias(name))


def spearman(df: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """Pearson's r of average ranks; rows that lack either value take no part.

    Equal pairs are counted before the shuffle, and ranks are running sums over different values only.
    """
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*keys, a, b).agg(F.count("*").alias("_w"))
    ranked = pairs
    for c, name in ((a, "_ra"), (b, "_rb")):
        steps = pairs.groupBy(*keys, c).agg(F.sum("_w").alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(c))
        ranked = ranked.join(steps.select(*keys, c, (upto - (F.col("_n") - 1) / 2.0).alias(name)), [*keys, c])
    return correlation(ranked, keys, "_ra", "_rb", "spearman", "_w")


def percentiles(df: DataFrame, keys: Sequence[str], column: str, wanted: dict[str, float]) -> DataFrame:
    """(keys, names): exact percentiles of a column's values that aren't null, interpolated as low * (1 - share) + high * share.

    The first product and the sum are rounded once (a fused step, as in DuckDB), which settles whether a cut between
    two nearly equal values is the lower or the upper one. Equal values are counted before the shuffle, and the different ones get running counts over ranges of
    values, so neither a few groups nor one of any size meet in one task.
    """
    steps = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    steps = running(steps, keys, "_v", "_n").withColumnRenamed("upto", "_upto").withColumn("_all", F.col("before") + F.col("from_here"))
    ends, out = [], []
    for name, q in wanted.items():
        at = (F.col("_all") - 1) * F.lit(q)
        ends += [F.min(F.when(F.col("_upto") > f(at), F.col("_v"))).alias(f"_{name}{i}") for i, f in enumerate((F.floor, F.ceil))]
        low, high = F.col(f"_{name}0"), F.col(f"_{name}1")
        share = at - F.floor(at)
        between = F.java_method(F.lit("java.lang.Math"), F.lit("fma"), low, 1 - share, high * share).cast("double")
        out.append(F.when(low < high, between).otherwise(low).alias(name))
    return steps.groupBy(*keys).agg(F.max("_all").alias("_all"), *ends).select(*keys, *out)


def with_percentiles(found: DataFrame, df: DataFrame, keys: Sequence[str], wanted: dict[str, dict[str, float]]) -> DataFrame:
    """`found`, a row for each of the keys, with percentiles() of several columns of `df`; null where a column has no values."""
    for column, names in wanted.items():
        found = found.join(percentiles(df, keys, column, names), list(keys), "left")
    return found


def partial_correlation(df: DataFrame, keys: Sequence[str], a: str, b: str, control: str) -> DataFrame:
    """Correlation of a and b with one control's linear part taken out."""
    parts = [correlation(df, keys, *pair, name) for pair, name in (((a, b), "ab"), ((a, control), "ac"), ((b, control), "bc"))]
    joined = reduce(lambda p, q: p.join(q, list(keys)), parts)
    ab, ac, bc = F.col("ab"), F.col("ac"), F.col("bc")
    left = (1 - ac * ac) * (1 - bc * bc)
    return joined.select(*keys, F.when(left > 1e-12, (ab - ac * bc) / F.sqrt(left)).alias("partial"))


def hotspots(df: DataFrame, keys: Sequence[str], bin_size: float, a: str, b: str, quantile: float) -> DataFrame:
    """Jaccard index of the spatial bins whose mean reaches the quantile of their sample, for two measures."""
    bins = df.groupBy(*keys, F.floor(F.col("x") / bin_size).alias("bx"), F.floor(F.col("y") / bin_size).alias("by")).agg(F.avg(a).alias("ma"), F.avg(b).alias("mb"))
    bins = stored(bins)
    cut = bins.groupBy(*keys).agg(F.count("*").alias("bins"))
    cut = with_percentiles(cut, bins, keys, {"ma": {"ca": quantile}, "mb": {"cb": quantile}})
    flagged = bins.join(cut, list(keys)).select(*keys, "bins", (F.col("ma") >= F.col("ca")).alias("ha"), (F.col("mb") >= F.col("cb")).alias("hb"))
    sums = flagged.groupBy(*keys).agg(F.max("bins").alias("bins"), F.count_if(F.expr("ha AND hb")).alias("both"), F.count_if(F.expr("ha OR hb")).alias("any"))
    return sums.select(*keys, "bins", F.when(F.col("bins") >= 3, safe_ratio(F.col("both"), F.col("any"))).alias("jaccard"))


def binned_agreement(df: DataFrame, keys: Sequence[str], bin_size: float, a: str, b: str) -> DataFrame:
    """(keys, bins, pearson, spearman) of two measures' means over spatial bins; both null under three bins or without spread."""
    bins = stored(df.groupBy(*keys, F.floor(F.col("x") / bin_size).alias("_bx"), F.floor(F.col("y") / bin_size).alias("_by")).agg(F.avg(a).alias("_ma"), F.avg(b).alias("_mb")))
    out = bins.groupBy(*keys).agg(F.count("*").alias("bins"))
    return out.join(correlation(bins, keys, "_ma", "_mb", "pearson"), list(keys)).join(spearman(bins, keys, "_ma", "_mb"), list(keys))


def distribution(df: DataFrame, keys: Sequence[str], column: str, top: float) -> DataFrame:
    """Quantiles, and the shares of zeros and of values at `top` or more."""
    c = F.col(column)
    shares = df.groupBy(*keys).agg(F.avg((c == 0).cast("int")).alias("zero_share"), F.avg((c >= top).cast("int")).alias("top_share"))
    cuts = percentiles(df, keys, column, {"q01": 0.01, "q50": 0.5, "q99": 0.99})
    both = shares.join(cuts, list(keys), "left") if keys else shares.crossJoin(cuts)  # one row each
    return both.select(*keys, "q01", "q50", "q99", "zero_share", "top_share")


def histogram_auc(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AUC of positive against negative histogram counts (bin, pos, neg)."""
    below = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    rows = counts.withColumn("below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    sums = rows.groupBy(*keys).agg(F.sum(F.col("pos") * (2 * F.col("below") + F.col("neg"))).alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return sums.select(*keys, safe_ratio(F.col("w"), 2 * F.col("p") * F.col("n")).alias("auc"))


def histogram_quantile(counts: DataFrame, keys: Sequence[str], quantile: float, bins: int) -> DataFrame:
    """The mid-point of the first bin at which the running count reaches ceil(quantile * total)."""
    up = Window.partitionBy(*keys).orderBy("bin")
    rows = counts.select(*keys, "bin", F.sum("n").over(up).alias("run"), F.sum("n").over(Window.partitionBy(*keys)).alias("total"))
    return rows.where(F.col("run") >= F.ceil(F.lit(quantile) * F.col("total"))).groupBy(*keys).agg(((F.min("bin") + 0.5) / bins).alias("value"))


def top_variance(df: DataFrame, column: str, n: int) -> DataFrame:
    """(feature, variance): the n array positions with the largest population variance, from sums of squares."""
    parts = df.select(F.posexplode(column).alias("feature", "v")).groupBy("feature").agg(F.count("v").alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("ss"))
    mean = F.col("s") / F.col("n")
    return parts.select("feature", (F.col("ss") / F.col("n") - mean * mean).alias("variance")).orderBy(F.desc("variance"), "feature").limit(n)


def robust_scale(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Median and median absolute deviation; groups without a value have neither."""
    keys = list(keys)
    middle = percentiles(df, keys, column, {"middle": 0.5})
    off = df.join(middle, keys).withColumn("off", F.abs(F.col(column) - F.col("middle")))
    found = middle.join(percentiles(off, keys, "off", {"mad": 0.5}), keys)
    return df.select(*keys).distinct().join(found, keys, "left").select(*keys, "middle", "mad")


def impute_median(df: DataFrame, column: str) -> DataFrame:
    """Nulls replaced by the column's median, or 0 if it has none."""
    middle = percentiles(df, [], column, {"_m": 0.5})  # one row
    return df.crossJoin(F.broadcast(middle)).withColumn(column, F.coalesce(F.col(column), F.col("_m"), F.lit(0.0))).drop("_m")


def seams(df: DataFrame, keys: Sequence[str], column: str, every: int) -> DataFrame:
    """95th percentiles of steps between neighbouring pixels of a row, at block boundaries and elsewhere."""
    line = Window.partitionBy(*keys, "y").orderBy("x")
    step = df.withColumn("step", F.abs(F.col(column) - F.lag(column).over(line))).where("step is not null")
    at = F.col("x") % every == 0
    return step.groupBy(*keys).agg(F.percentile(F.when(at, F.col("step")), 0.95).alias("boundary"), F.percentile(F.when(~at, F.col("step")), 0.95).alias("baseline"), F.count_if(at).alias("n_boundary"))


def enrichment(df: DataFrame, cluster: str, markers: Sequence[str]) -> DataFrame:
    """Mean of each marker by cluster against all, in standard deviations (sample); null if there is none."""
    spread = df.select(cluster, F.explode(F.array(*(F.struct(F.lit(m).alias("marker"), F.col(m).alias("value")) for m in markers))).alias("m")).select(cluster, "m.*")
    every = spread.groupBy("marker").agg(F.avg("value").alias("overall"), F.stddev_samp("value").alias("sd"))
    own = spread.groupBy(cluster, "marker").agg(F.count("value").alias("n"), F.avg("value").alias("mean"))
    own = with_percentiles(own, spread, [cluster, "marker"], {"value": {"median": 0.5}})
    return own.join(every, "marker").select(cluster, "marker", "n", "mean", "median", "overall", F.try_divide(F.col("mean") - F.col("overall"), F.col("sd")).alias("smd"))


def chance_agreement(df: DataFrame, keys: Sequence[str], cluster: str) -> DataFrame:
    """The chance that two random rows share a cluster: the sum of squared shares."""
    n = df.groupBy(*keys, cluster).agg(F.count("*").alias("n"))
    return n.groupBy(*keys).agg((F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("chance"), F.count("*").alias("clusters"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall and intersection over union of every class."""
    cells = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    t = cells.groupBy(F.col("t").alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)).alias("hits"))
    p = cells.groupBy(F.col("p").alias("class")).agg(F.sum("n").alias("named"))
    both = t.join(p, "class", "full").fillna(0, ["support", "hits", "named"])
    return both.select(
        "class", "support", "named", safe_ratio(F.col("hits"), F.col("named")).alias("precision"), safe_ratio(F.col("hits"), F.col("support")).alias("recall"), safe_ratio(F.col("hits"), F.col("support") + F.col("named") - F.col("hits")).alias("iou")
    )


def vote(neighbours: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, cluster, fraction, margin): the most frequent cluster among a point's landmarks; ties to the lowest."""
    counts = neighbours.join(labels, "landmark").groupBy("id", "cluster").agg(F.count("*").alias("n"))
    order = Window.partitionBy("id").orderBy(F.desc("n"), "cluster")
    ranked = counts.select("*", F.row_number().over(order).alias("r"), F.sum("n").over(Window.partitionBy("id")).alias("k"))
    best = ranked.groupBy("id").agg(F.max(F.when(F.col("r") == 1, F.col("cluster"))).alias("cluster"), F.max(F.when(F.col("r") == 1, F.col("n"))).alias("first"), F.coalesce(F.max(F.when(F.col("r") == 2, F.col("n"))), F.lit(0)).alias("second"), F.max("k").alias("k"))
    return best.select("id", "cluster", (F.col("first") / F.col("k")).alias("fraction"), ((F.col("first") - F.col("second")) / F.col("k")).alias("margin"))


def size_string(df: DataFrame, keys: Sequence[str], cluster: str) -> DataFrame:
    """'cluster:n' of every cluster, largest first, joined by semicolons."""
    n = df.groupBy(*keys, cluster).agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(cluster).alias("c"))))
    return n.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["c"].cast("string"), (-s["m"]).cast("string"))), ";").alias("sizes"))


def fold_r2(df: DataFrame, x: str, y: str, fold: str) -> DataFrame:
    """R2 on each fold of a line fitted to the other folds, from sums over the folds."""
    cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
    own = df.groupBy(fold).agg(F.count("*").alias("n"), F.sum(cx).alias("sx"), F.sum(cy).alias("sy"), F.sum(cx * cx).alias("sxx"), F.sum(cx * cy).alias("sxy"), F.sum(cy * cy).alias("syy"))
    names = ("n", "sx", "sy", "sxx", "sxy", "syy")
    every = own.agg(*(F.sum(c).alias(f"all_{c}") for c in names))
    both = own.crossJoin(F.broadcast(every))
    n, sx, sy, sxx, sxy = (F.col(f"all_{c}") - F.col(c) for c in names[:5])
    both = both.withColumn("b", F.try_divide(n * sxy - sx * sy, n * sxx - sx * sx)).withColumn("a", F.try_divide(sy - F.col("b") * sx, n))
    a, b = F.col("a"), F.col("b")
    rest = F.col("syy") - 2 * a * F.col("sy") - 2 * b * F.col("sxy") + a * a * F.col("n") + 2 * a * b * F.col("sx") + b * b * F.col("sxx")
    total = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return both.select(fold, (1 - F.try_divide(rest, total)).alias("r2"))


def partial_by_many(df: DataFrame, keys: Sequence[str], a: str, b: str, controls: Sequence[str]) -> DataFrame:
    """Partial correlation with several controls: each group's cross products are summed by Spark, and solved alone.

    What reaches Python is one small matrix a group, however many rows the group has.
    """
    names = [*controls, a, b]
    full = ["_one", *names]
    rows = df.withColumn("_one", F.lit(1.0))
    products = [F.sum(F.col(p).cast("double") * F.col(q)).alias(f"m{i}_{j}") for i, p in enumerate(full) for j, q in enumerate(full) if j >= i]
    sums = rows.groupBy(*keys).agg(*products)
    k = len(full)

    def solve(batches):
        for g in batches:
            out = []
            for r in g.to_dict("records"):
                m = np.array([[r[f"m{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
                c, v = m[: k - 2, : k - 2], m[: k - 2, k - 2 :]
                rest = m[k - 2 :, k - 2 :] - v.T @ np.linalg.lstsq(c, v, rcond=None)[0]
                ok = rest[0, 0] > 1e-9 and rest[1, 1] > 1e-9
                out.append([*(r[c_] for c_ in keys), rest[0, 1] / np.sqrt(rest[0, 0] * rest[1, 1]) if ok else None])
            yield pd.DataFrame(out, columns=[*keys, "partial"])

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return sums.mapInPandas(solve, ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", partial double")


def panoptic(pairs: DataFrame, sizes_a: DataFrame, sizes_b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Panoptic quality, aggregated Jaccard index and Dice of matched labels, from totals.

    pairs: matched (keys, shared, iou); sizes: (keys, n), a row a label. All are sums, so regions add up.
    """
    keys = list(keys)
    found = pairs.groupBy(*keys).agg(F.count("*").alias("tp"), F.sum("iou").alias("iou"), F.sum("shared").alias("shared"))
    a = sizes_a.groupBy(*keys).agg(F.count("*").alias("labels_a"), F.sum("n").alias("area_a"))
    b = sizes_b.groupBy(*keys).agg(F.count("*").alias("labels_b"), F.sum("n").alias("area_b"))
    all_ = a.join(b, keys, "full").join(found, keys, "left").fillna(0)
    tp, shared, area = F.col("tp"), F.col("shared"), F.col("area_a") + F.col("area_b")
    return all_.select(
        *keys, "tp", (F.col("labels_b") - tp).alias("fp"), (F.col("labels_a") - tp).alias("fn"),
        safe_ratio(F.col("iou"), (F.col("labels_a") + F.col("labels_b")) / 2).alias("pq"), safe_ratio(shared, area - shared).alias("aji"), safe_ratio(2 * shared, area).alias("dice"),
    )


def mean_bootstrap(df: DataFrame, keys: Sequence[str], unit: str, value: str, rounds: int, level: float = 0.95) -> DataFrame:
    """Mean over units of a value, one a unit, and its interval over Poisson resamples of whole units.

    A resample without any unit is left out; the decision says on which side of zero the interval lies.
    """
    drawn = df.select(*keys, unit, value, F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("draw"))
    weight = poisson_weight(uniform(F.col(unit), F.col("draw")))
    drawn = drawn.groupBy(*keys, "draw").agg(safe_ratio(F.sum(F.col(value) * weight), F.sum(weight)).alias("m")).where("m is not null")
    ends = [(1 - level) / 2, (1 + level) / 2]
    out = drawn.groupBy(*keys).agg(F.percentile("m", ends[0]).alias("low"), F.percentile("m", ends[1]).alias("high"))
    means = df.groupBy(*keys).agg(F.count(value).alias("units"), F.avg(value).alias("mean"))
    decision = F.when(F.col("low") > 0, "higher").when(F.col("high") < 0, "lower").otherwise("undecided")
    return means.join(out, list(keys)).withColumn("decision", decision)


def seam_excess(df: DataFrame, keys: Sequence[str], column: str, every: int) -> DataFrame:
    """(keys, axis, place, n, excess): for each block boundary the 95th percentile of its steps over that of all steps elsewhere."""

    def along(axis: str, other: str) -> DataFrame:
        line = Window.partitionBy(*keys, other).orderBy(axis)
        step = df.withColumn("step", F.abs(F.col(column) - F.lag(column).over(line))).where("step is not null")
        at = F.col(axis) % every == 0
        base = step.where(~at).groupBy(*keys).agg(F.percentile("step", 0.95).alias("base"))
        met = step.where(at).groupBy(*keys, F.col(axis).alias("place")).agg(F.count("*").alias("n"), F.percentile("step", 0.95).alias("p95"))
        return met.join(base, list(keys)).select(*keys, F.lit(axis).alias("axis"), "place", "n", (F.col("p95") - F.col("base")).alias("excess"))

    return along("x", "y").unionByName(along("y", "x"))


def standardised(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """`df` with `z`: how many population deviations a value lies from its group's mean; the deviation has a floor."""
    s = df.groupBy(*keys).agg(F.avg(column).alias("_m"), F.greatest(F.stddev_pop(column), F.lit(2.220446049250313e-16)).alias("_s"))
    return df.join(s, list(keys)).withColumn("z", (F.col(column) - F.col("_m")) / F.col("_s")).drop("_m", "_s")


def edge_ratio(df: DataFrame, keys: Sequence[str], value: str, edge: str, least_edge: int, least_core: int) -> DataFrame:
    """Mean of the rows at an edge over the mean of the others; null if either are too few or the others' sum isn't positive."""
    v, e = F.col(value), F.col(edge)
    g = df.groupBy(*keys).agg(F.count_if(e).alias("n_edge"), F.count_if(~e).alias("n_core"), F.sum(F.when(e, v)).alias("_e"), F.sum(F.when(~e, v)).alias("_c"))
    enough = (F.col("n_edge") >= least_edge) & (F.col("n_core") >= least_core) & (F.col("_c") > 0)
    return g.select(*keys, "n_edge", "n_core", F.when(enough, (F.col("_e") / F.col("n_edge")) / (F.col("_c") / F.col("n_core"))).alias("ratio"))


def macro_average(df: DataFrame, keys: Sequence[str], value: str, missing: str, weight: str) -> DataFrame:
    """Mean of a metric over a unit's regions, those without one left out, and the share of rows missing, weighted by the regions' rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("regions"), F.avg(value).alias("mean"), F.try_divide(F.sum(F.col(weight) * F.col(missing)), F.sum(weight)).alias("missing"))

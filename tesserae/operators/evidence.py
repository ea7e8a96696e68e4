"""Agreement, alignment, sampling and review of clusters and detectors."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import geometry, overlay
from .aggregates import percentiles, spearman, uniform, with_percentiles
from .graph import stored
from .joins import nearest
from .ordered import running

# What a component's evidence is called.
TIERS = ("broad_consensus_with_scoped_support", "broad_consensus", "single_broad_with_scoped_support", "single_broad_only", "scoped_support_only")
STATUSES = ("abstained_insufficient_detector_support", "abstained_missing_broad_detector_consensus", "abstained_broad_detector_distance", "accepted_instance_fusion")


def tiers(points: DataFrame, near: DataFrame, tight: float) -> DataFrame:
    """Every point with the other sources near it: how many, which, and how close they all are."""
    a = points.select("sample_id", F.col("id").alias("a"), F.col("source").alias("sa"))
    b = points.select("sample_id", F.col("id").alias("b"), F.col("source").alias("sb"))
    seen = near.join(a, ["sample_id", "a"]).join(b, ["sample_id", "b"]).where("sa <> sb")
    found = seen.groupBy("sample_id", F.col("a").alias("id")).agg(F.countDistinct("sb").alias("others"), F.max("d").alias("far"), F.array_join(F.array_sort(F.collect_set("sb")), ";").alias("seen"))
    tier = F.when(F.col("others").isNull(), "single").when(F.col("others") == 1, "pair").when(F.col("far") > tight, "loose").otherwise("full")
    return points.join(found, ["sample_id", "id"], "left").select("sample_id", "id", F.coalesce("others", F.lit(0)).alias("others"), tier.alias("tier"), F.coalesce("seen", F.lit("")).alias("seen"))


def neighbour_overlap(one: DataFrame, two: DataFrame, k: int) -> DataFrame:
    """(a, jaccard): how far a point's k nearest in two spaces, of pairs (a, b, d), are the same."""
    order = Window.partitionBy("a").orderBy("d", "b")

    def nearest(df: DataFrame) -> DataFrame:
        return df.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).select("a", "b")

    both = nearest(one).withColumn("o", F.lit(1)).withColumn("t", F.lit(0)).unionByName(nearest(two).withColumn("o", F.lit(0)).withColumn("t", F.lit(1)))
    merged = both.groupBy("a", "b").agg(F.max("o").alias("o"), F.max("t").alias("t"))
    return merged.groupBy("a").agg((F.sum(F.col("o") * F.col("t")) / F.count("*")).alias("jaccard"))


def missing_labels(raster: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Numbers from 1 to the largest label that no pixel has."""
    known = raster.where("label > 0").select(*keys, "label").distinct()
    every = known.groupBy(*keys).agg(F.max("label").alias("m")).select(*keys, F.explode(F.sequence(F.lit(1).cast("long"), F.col("m").cast("long"))).alias("label"))
    return every.join(known.withColumn("label", F.col("label").cast("long")), [*keys, "label"], "left_anti")


def tokens(raster: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """(keys, ty, tx, mean, pure): blocks of pixels; pure if full and of one label."""
    one = (F.min("label") == F.max("label")) & (F.count("*") == size * size)
    return raster.groupBy(*keys, F.expr(f"y div {size}").alias("ty"), F.expr(f"x div {size}").alias("tx")).agg(F.avg("label").alias("mean"), one.alias("pure"))


def bilinear(pixels: DataFrame, field: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Values of a token field (ty, tx, v) at pixel centres, from the up to four tokens around each."""
    fy, fx = (F.col("y") + 0.5) / size - 0.5, (F.col("x") + 0.5) / size - 0.5
    placed = pixels.withColumn("fy", fy).withColumn("fx", fx)
    corner = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1))))
    spread = placed.withColumn("c", corner).withColumn("ty", F.floor("fy") + F.col("c.a")).withColumn("tx", F.floor("fx") + F.col("c.b"))
    w = (1 - F.abs(F.col("fy") - F.col("ty"))) * (1 - F.abs(F.col("fx") - F.col("tx")))
    met = spread.withColumn("w", w).where("w > 0").join(field, [*keys, "ty", "tx"])
    return met.groupBy(*keys, "y", "x").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("v"))


def percentile_scaled(df: DataFrame, keys: Sequence[str], column: str, low: float, high: float) -> DataFrame:
    """`df` with `scaled`: the column between two of its percentiles, clipped to 0 and 1."""
    cut = df.groupBy(*keys).agg(F.percentile(column, low).alias("_lo"), F.percentile(column, high).alias("_hi"))
    value = F.try_divide(F.col(column) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return df.join(cut, list(keys)).withColumn("scaled", F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))).drop("_lo", "_hi")


def prevalence_threshold(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bin from which on as many rows are called positive as are, and the Dice overlap it gives."""
    down = Window.partitionBy(*keys).orderBy(F.desc("bin"))
    rows = counts.select(*keys, "bin", F.sum("n").over(down).alias("above"), F.sum("pos").over(down).alias("hits"), F.sum("pos").over(Window.partitionBy(*keys)).alias("target"))
    best = rows.where("above >= target").groupBy(*keys).agg(F.max_by(F.struct("bin", "above", "hits", "target"), "bin").alias("b"))
    return best.select(*keys, F.col("b.bin").alias("cut"), (2 * F.col("b.hits") / (F.col("b.above") + F.col("b.target"))).alias("dice"))


def storage_status(df: DataFrame) -> DataFrame:
    """Demand and room of each device."""
    g = df.groupBy("device").agg(F.count("*").alias("paths"), F.sum("need").alias("need"), F.max("free").alias("free"))
    return g.withColumn("status", F.when(F.col("need") > F.col("free"), "insufficient").when(F.col("need") > 0.8 * F.col("free"), "tight").otherwise("ok"))


def align_labels(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, label, aligned): labels renamed to the reference labels they share most rows with.

    Pairs are taken greedily by falling count, then by label and reference; a label left over takes
    a number beyond the reference's. Only the counts of pairs reach Python, one small group a key.
    """
    counts = df.groupBy(*keys, "label", "reference").agg(F.count("*").alias("n"))
    kinds = {f.name: f.dataType.simpleString() for f in counts.schema}

    def greedy(g: pd.DataFrame) -> pd.DataFrame:
        named: dict = {}
        for r in g.sort_values(["n", "label", "reference"], ascending=[False, True, True]).itertuples(index=False):
            if r.label not in named and r.reference not in named.values():
                named[r.label] = r.reference
        free = int(g["reference"].max()) + 1
        for label in sorted(set(g["label"]) - set(named)):
            named[label], free = free, free + 1
        labels = sorted(named)
        return pd.DataFrame({**{k: g[k].iloc[0] for k in keys}, "label": labels, "aligned": [int(named[x]) for x in labels]})

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", label {kinds['label']}, aligned long"
    return counts.groupBy(*keys).applyInPandas(greedy, schema)


def weighted_sample(df: DataFrame, keys: Sequence[str], row: str, weight: str, n: int) -> DataFrame:
    """(keys, row, nth): n rows of each group drawn without replacement by weight, from hashed exponential keys; rows that weigh nothing never."""
    df = df.where(F.col(weight) > 0)
    key = -F.log(F.greatest(uniform(F.col(row)), F.lit(1e-12))) / F.col(weight)
    order = Window.partitionBy(*keys).orderBy("_key", row)
    return df.select(*keys, row, key.alias("_key")).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n).drop("_key")


def silhouette(sample: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean silhouette of a sample (id, cluster, x, y), by plain distances; a point alone in its cluster counts 0.

    All pairs of a group's sample meet, so samples are to be drawn small.
    """
    a = sample.select(*keys, F.col("id").alias("a"), F.col("cluster").alias("ka"), F.col("x").alias("xa"), F.col("y").alias("ya"))
    b = sample.select(*keys, F.col("id").alias("b"), F.col("cluster").alias("kb"), F.col("x").alias("xb"), F.col("y").alias("yb"))
    d = F.sqrt((F.col("xa") - F.col("xb")) * (F.col("xa") - F.col("xb")) + (F.col("ya") - F.col("yb")) * (F.col("ya") - F.col("yb")))
    mean = a.join(b, list(keys)).where("a <> b").groupBy(*keys, "a", "ka", "kb").agg(F.avg(d).alias("d"))
    per = mean.groupBy(*keys, "a").agg(F.max(F.when(F.col("ka") == F.col("kb"), F.col("d"))).alias("own"), F.min(F.when(F.col("ka") != F.col("kb"), F.col("d"))).alias("other"))
    s = F.when(F.col("own").isNull() | F.col("other").isNull(), F.lit(0.0)).otherwise(F.try_divide(F.col("other") - F.col("own"), F.greatest("own", "other")))
    return per.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(s).alias("silhouette"))


def rotation_fit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Correlation of (x, y) with (u, v) after the best rotation, from centred cross products."""
    c = {n: F.col(n) - F.col(f"_{n}") for n in "xyuv"}
    centred = df.join(df.groupBy(*keys).agg(*(F.avg(n).alias(f"_{n}") for n in "xyuv")), list(keys))
    s = centred.groupBy(*keys).agg(*(F.sum(c[p] * c[q]).alias(p + q) for p, q in ("xu", "yv", "xv", "yu", "xx", "yy", "uu", "vv")))
    top = F.sqrt(F.pow(F.col("xu") + F.col("yv"), 2) + F.pow(F.col("xv") - F.col("yu"), 2))
    return s.select(*keys, F.try_divide(top, F.sqrt((F.col("xx") + F.col("yy")) * (F.col("uu") + F.col("vv")))).alias("correlation"))


def procrustes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n, correlation, rmse) of standardised (x, y) with standardised (u, v) turned, or turned and mirrored, onto them.

    All of it follows from the four correlations between the columns: a two by two table's singular values add up to
    the root of its squares and twice its determinant's size. A constant column stands at zero; one row has neither.
    """
    sums = [F.count("*").alias("n"), *(F.var_samp(c).alias(f"_{c}") for c in "xyuv"), *(F.covar_samp(a, b).alias(f"_{a}{b}") for a in "xy" for b in "uv")]
    s = df.groupBy(*keys).agg(*sums)
    r = {a + b: F.coalesce(F.try_divide(F.col(f"_{a}{b}"), F.sqrt(F.col(f"_{a}") * F.col(f"_{b}"))), F.lit(0.0)) for a in "xy" for b in "uv"}
    total = F.sqrt(r["xu"] * r["xu"] + r["xv"] * r["xv"] + r["yu"] * r["yu"] + r["yv"] * r["yv"] + 2 * F.abs(r["xu"] * r["yv"] - r["xv"] * r["yu"]))
    size = [sum((F.when(F.col(f"_{c}") > 0, F.lit(1.0)).otherwise(F.lit(0.0)) for c in pair), F.lit(0.0)) for pair in ("xy", "uv")]
    n = F.col("n").cast("double")
    off = F.sqrt(F.greatest(F.lit(0.0), (size[0] + size[1] - 2 * total) * (n - 1) / (2 * n)))
    several = F.col("n") > 1
    return s.select(*keys, "n", F.when(several, F.try_divide(total, F.sqrt(size[0] * size[1]))).alias("correlation"), F.when(several, off).alias("rmse"))


def cascade(df: DataFrame, keys: Sequence[str], score: str, margin: float, order: Sequence[Column | str]) -> DataFrame:
    """Of the rows within `margin` of their group's best score, the first in an order."""
    w = Window.partitionBy(*keys)
    near = df.withColumn("_best", F.max(score).over(w)).where(F.col(score) >= F.col("_best") - margin)
    return near.withColumn("_r", F.row_number().over(w.orderBy(*order))).where("_r = 1").drop("_r", "_best")


def padded(boxes: DataFrame, pad: int, width: int, height: int) -> DataFrame:
    """Boxes widened on every side and cut at the image's edge."""
    out = boxes.withColumn("x0", F.greatest(F.col("x0") - pad, F.lit(0))).withColumn("y0", F.greatest(F.col("y0") - pad, F.lit(0)))
    return out.withColumn("x1", F.least(F.col("x1") + pad, F.lit(width))).withColumn("y1", F.least(F.col("y1") + pad, F.lit(height)))


def pyramid(images: DataFrame, key: str, smallest: int) -> DataFrame:
    """(key, level, w, h): sizes halved, rounding up, until both sides are at most `smallest`."""
    halves = F.aggregate(
        F.sequence(F.lit(1), F.lit(40)),
        F.array(F.struct(F.lit(0).alias("level"), F.col("w").cast("long").alias("w"), F.col("h").cast("long").alias("h"))),
        lambda a, i: F.when(
            F.greatest(F.element_at(a, -1)["w"], F.element_at(a, -1)["h"]) > smallest,
            F.concat(a, F.array(F.struct(i.alias("level"), F.floor((F.element_at(a, -1)["w"] + 1) / 2).alias("w"), F.floor((F.element_at(a, -1)["h"] + 1) / 2).alias("h")))),
        ).otherwise(a),
    )
    return images.select(key, F.explode(halves).alias("s")).select(key, "s.level", "s.w", "s.h")


def merge_small(raster: DataFrame, keys: Sequence[str], least: int) -> DataFrame:
    """(keys, label, merged): labels with fewer pixels than `least` go to the nearest centroid of those with more."""
    g = raster.groupBy(*keys, "label").agg(F.avg("y").alias("cy"), F.avg("x").alias("cx"), F.count("*").alias("n"))
    small, big = g.where(F.col("n") < least), g.where(F.col("n") >= least)
    target = big.select(*keys, F.col("label").alias("merged"), F.col("cy").alias("by"), F.col("cx").alias("bx"))
    d = F.round((F.col("cy") - F.col("by")) * (F.col("cy") - F.col("by")) + (F.col("cx") - F.col("bx")) * (F.col("cx") - F.col("bx")), 9)
    best = small.join(target, list(keys)).groupBy(*keys, "label").agg(F.min_by("merged", F.struct(d, "merged")).alias("merged"))
    return best.unionByName(big.select(*keys, "label", F.col("label").alias("merged")))


def first_members(points: DataFrame, named: DataFrame, keys: Sequence[str], columns: Sequence[str], alone: bool = True) -> DataFrame:
    """(keys, component, source, id, columns): each source's first point of every component.

    points: (keys, id, source, columns); named: (keys, node, component). A point in no component is its own, or
    left out if not `alone`. Names are not broadcast: their files say little of what a driver would have to hold.
    """
    placed = points.join(named.withColumnRenamed("node", "id").hint("merge"), [*keys, "id"], "left" if alone else "inner").withColumn("component", F.coalesce("component", "id"))
    return placed.groupBy(*keys, "component", "source").agg(F.min_by(F.struct("id", *columns), "id").alias("m")).select(*keys, "component", "source", "m.*")


#: Up to so many pairs of sides two contours are compared in their own row; beyond, as rows.
ROW_SIDES = overlay.ROW_SIDES


def pair_agreement(members: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How far every two sources agree on the components that both are in: matched shares, distances, overlaps and Hausdorff distances.

    members: (keys, component, source, id, x, y, ring), one row a component and source, so a component's list is as
    short as the sources; counts: (source, n). Members of components with one source only may be missing.
    Overlaps and Hausdorff distances are those of the contours, whatever their shapes; contours under three
    points or without area have neither.
    """
    keys = list(keys)
    size = geometry.area(F.col("ring"))
    drawn = (F.size("ring") >= 3) & (size > 0)
    member = F.struct("source", "id", "x", "y", F.when(drawn, F.col("ring")).alias("ring"), F.when(drawn, size).alias("area"))
    groups = members.groupBy(*keys, "component").agg(F.collect_list(member).alias("_m")).where(F.size("_m") > 1)
    met = groups.select(*keys, "_m", F.explode("_m").alias("_a")).select(*keys, "_a", F.explode(F.filter("_m", lambda m: m["source"] > F.col("_a.source"))).alias("_b"))
    dx, dy = F.col("_a.x") - F.col("_b.x"), F.col("_a.y") - F.col("_b.y")
    work = F.size("_a.ring").cast("long") * F.size("_b.ring")
    met = met.select(*keys, F.col("_a.source").alias("source_a"), F.col("_b.source").alias("source_b"), F.sqrt(dx * dx + dy * dy).alias("d"), "_a", "_b", (work > ROW_SIDES).alias("_large"))
    small = met.withColumn("_small", F.coalesce(~F.col("_large"), F.lit(False)))
    small = small.withColumn("_both", F.when(F.col("_small"), overlay.common_area(F.col("_a.ring"), F.col("_b.ring"))))
    iou = F.try_divide("_both", F.col("_a.area") + F.col("_b.area") - F.col("_both"))
    h = F.when(F.col("_small"), overlay.ring_hausdorff(F.col("_a.ring"), F.col("_b.ring")))
    large = F.when(F.col("_large"), F.struct("_a", "_b"))  # the others leave their contours behind
    met = stored(small.select(*keys, "source_a", "source_b", "d", iou.alias("iou"), h.alias("h"), large.alias("_large")))
    outlines = met.where("_large IS NOT NULL").select(*keys, "source_a", "source_b", "d", F.col("_large._a.id").alias("a"), F.col("_large._b.id").alias("b"), "_large")
    met = met.where("_large IS NULL").select("source_a", "source_b", "d", "iou", "h")
    if not outlines.isEmpty():
        shapes = [outlines.select(*keys, F.col(f"_large.{s}.id").alias("polygon"), F.col(f"_large.{s}.ring").alias("ring")) for s in ("_a", "_b")]
        polygons, outlines = shapes[0].unionByName(shapes[1]).dropDuplicates([*keys, "polygon"]), outlines.drop("_large")
        areas = overlay.overlay_areas(overlay.arranged(outlines, polygons, keys), keys).select(*keys, "a", "b", "iou")
        areas = areas.join(overlay.hausdorff(outlines, polygons, keys), [*keys, "a", "b"])
        met = stored(met.unionByName(outlines.join(areas, [*keys, "a", "b"], "left").select("source_a", "source_b", "d", "iou", F.col("distance").alias("h"))))
    pair = ["source_a", "source_b"]
    found = met.groupBy(*pair).agg(F.count("*").alias("matched"))
    shares = {"d": {"median_d": 0.5, "p95_d": 0.95}, "iou": {"iou_p25": 0.25, "iou_median": 0.5, "iou_p75": 0.75}, "h": {"hausdorff_median": 0.5, "hausdorff_p95": 0.95}}
    found = with_percentiles(found, met, pair, shares)
    for s in "ab":
        found = found.join(counts.select(F.col("source").alias(f"source_{s}"), F.col("n").alias(f"count_{s}")), f"source_{s}")
        found = found.withColumn(f"fraction_{s}", F.col("matched") / F.greatest(f"count_{s}", F.lit(1)))
    return found


def role_evidence(members: DataFrame, keys: Sequence[str], broad: Sequence[str], radius: float, least: int) -> DataFrame:
    """What speaks for every component: its broad and other (scoped) sources, how near the broad ones lie, a score, and whether it is accepted.

    members: (keys, component, source, x, y), one row a component and source, so a component's list is as short as the sources.
    A component of fewer than `least` sources, without all of `broad`, or with two broad points over `radius` apart abstains.
    """
    wanted = F.array(*(F.lit(s) for s in broad))
    g = members.groupBy(*keys, "component").agg(F.array_sort(F.collect_list(F.struct("source", "x", "y"))).alias("_m"))
    g = g.withColumn("_b", F.filter("_m", lambda m: F.array_contains(wanted, m["source"])))
    n_broad, n_all = F.size("_b"), F.size("_m")
    apart = F.transform("_b", lambda p: F.transform("_b", lambda q: F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"]))))
    g = g.withColumn("far", F.coalesce(F.array_max(F.flatten(apart)), F.lit(0.0)))
    full, scoped = n_broad == len(broad), n_all > n_broad
    tier = F.when(full & scoped, TIERS[0]).when(full, TIERS[1]).when((n_broad > 0) & scoped, TIERS[2]).when(n_broad > 0, TIERS[3]).otherwise(TIERS[4])
    score = n_broad / F.lit(max(1, len(broad))) * (0.5 + 0.5 * (1 - F.least(F.col("far") / radius, F.lit(1.0))))
    agreement = F.when(full & (F.col("score") >= 0.75), "high").when(F.col("score") >= 0.45, "moderate").otherwise("low")
    status = F.when(n_all < least, STATUSES[0]).when(~full, STATUSES[1]).when(F.col("far") > radius, STATUSES[2]).otherwise(STATUSES[3])
    sources = F.array_join(F.transform("_m", lambda m: m["source"]), ";")
    return g.withColumn("score", score).select(*keys, "component", sources.alias("sources"), n_broad.alias("n_broad"), tier.alias("tier"), "far", "score", agreement.alias("agreement"), status.alias("status"))


def distance_correlation(sample: DataFrame, keys: Sequence[str], one: Sequence[str], two: Sequence[str]) -> DataFrame:
    """Spearman's correlation of the distances between a sample's rows (id) in two spaces, each given by its columns.

    All pairs of a group's sample meet, so samples are to be drawn small.
    """
    names = [*one, *two]
    a = sample.select(*keys, F.col("id").alias("a"), *(F.col(c).alias(f"{c}_a") for c in names))
    b = sample.select(*keys, F.col("id").alias("b"), *(F.col(c).alias(f"{c}_b") for c in names))
    far = [F.sqrt(sum(((F.col(f"{c}_a") - F.col(f"{c}_b")) * (F.col(f"{c}_a") - F.col(f"{c}_b")) for c in space), F.lit(0.0))) for space in (one, two)]
    pairs = a.join(b, list(keys)).where("a < b").select(*keys, far[0].alias("d1"), far[1].alias("d2"))
    return spearman(pairs, keys, "d1", "d2")


def density_weights(df: DataFrame, keys: Sequence[str], bin_size: float, power: float) -> DataFrame:
    """`df` with `weight`: each row's share of its grid bin's count to the power of `power`."""
    placed = df.withColumn("_bx", F.floor(F.col("x") / bin_size)).withColumn("_by", F.floor(F.col("y") / bin_size))
    counts = placed.groupBy(*keys, "_bx", "_by").agg(F.count("*").alias("_n"))
    return placed.join(counts, [*keys, "_bx", "_by"]).withColumn("weight", F.pow(F.col("_n"), F.lit(power - 1.0))).drop("_bx", "_by", "_n")


def leverages(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` with `weight`: each row's leverage in the centred plane (x, y) of its group; 0 where the group spans no plane."""
    means = df.groupBy(*keys).agg(F.avg("x").alias("_mx"), F.avg("y").alias("_my"))
    u, v = F.col("x") - F.col("_mx"), F.col("y") - F.col("_my")
    near = df.join(means, list(keys))
    sums = near.groupBy(*keys).agg(F.sum(u * u).alias("_uu"), F.sum(u * v).alias("_uv"), F.sum(v * v).alias("_vv"))
    det = F.col("_uu") * F.col("_vv") - F.col("_uv") * F.col("_uv")
    lever = (u * u * F.col("_vv") - 2 * u * v * F.col("_uv") + v * v * F.col("_uu")) / det
    return near.join(sums, list(keys)).withColumn("weight", F.when(det > 0, lever).otherwise(F.lit(0.0))).drop("_mx", "_my", "_uu", "_uv", "_vv")


def box_size(df: DataFrame, target: int, rounds: int = 24) -> float:
    """A side of square boxes of the plane (x, y) of which about `target` hold a row: the largest, by halving, that leaves at least so many.

    Every round counts the occupied boxes of one size. If even the smallest boxes hold too few, it is theirs.
    """
    ends = df.agg(F.max("x") - F.min("x"), F.max("y") - F.min("y")).first()
    high = max([float(e or 0) for e in ends], default=0.0) or 1.0
    low = high / (1 << rounds)

    def occupied(size: float) -> int:
        return df.select(F.floor(F.col("x") / size), F.floor(F.col("y") / size)).distinct().count()

    for _ in range(rounds):
        middle = (low * high) ** 0.5
        if occupied(middle) >= target:
            low = middle
        else:
            high = middle
        if high / low < 1.01:
            break
    return low


def even_sample(df: DataFrame, keys: Sequence[str], id_: str, size: float, most: int) -> DataFrame:
    """(keys, id, quota, nth): `most` rows of each group, spread as evenly over occupied boxes of a side as their rows allow.

    Boxes get the same number, or all they have; what is left goes, one each, to the first boxes in the order
    of a hash of their places, and rows within a box are drawn by a hash of their id.
    """
    keys = list(keys)
    placed = df.select(*keys, id_, F.floor(F.col("x") / size).alias("_bx"), F.floor(F.col("y") / size).alias("_by"))
    boxes = stored(placed.groupBy(*keys, "_bx", "_by").agg(F.count("*").alias("_n")).withColumn("_one", F.lit(1).cast("long")))
    order = ["_n", "_bx", "_by"]
    summed = running(boxes, keys, order, "_n", ["_n"]).select(*keys, *order, F.col("before").alias("_less"))
    summed = summed.join(running(boxes, keys, order, "_one").select(*keys, *order, F.col("from_here").alias("_rest")), [*keys, *order])
    full = F.col("_less") + F.col("_n") * F.col("_rest") > most
    level = F.min(F.when(full, F.struct("_n", "_bx", "_by", F.floor((F.lit(most) - F.col("_less")) / F.col("_rest")).alias("level"))))
    levels = summed.groupBy(*keys).agg(F.coalesce(level["level"], F.max("_n")).alias("_level"))
    told = boxes.join(levels, keys) if keys else boxes.crossJoin(levels)
    given = told.groupBy(*keys).agg((F.lit(most) - F.sum(F.least("_n", "_level"))).alias("_left"))
    told = told.join(given, keys) if keys else told.crossJoin(given)
    open_ = told.where("_n > _level").withColumn("_h", F.md5(F.concat_ws(":", F.col("_bx").cast("string"), F.col("_by").cast("string"))))
    turns = running(open_, keys, ["_h", "_bx", "_by"], "_one", ["_n", "_level", "_left"]).select(*keys, "_bx", "_by", (F.col("upto") <= F.col("_left")).alias("_more"))
    quota = told.join(turns, [*keys, "_bx", "_by"], "left").select(*keys, "_bx", "_by", (F.least("_n", "_level") + F.when(F.col("_more"), 1).otherwise(0)).alias("quota"))
    draw = Window.partitionBy(*keys, "_bx", "_by").orderBy(F.md5(F.col(id_).cast("string")), id_)
    drawn = placed.join(quota, [*keys, "_bx", "_by"]).withColumn("nth", F.row_number().over(draw))
    return drawn.where("nth <= quota").select(*keys, id_, "quota", "nth")


def inverse_distance_weights(points: DataFrame, keys: Sequence[str], k: int, power: float, tile: float) -> DataFrame:
    """(keys, id, weight): each point's mean distance from its `k` nearest others to the power of -`power`.

    Distances of zero, and those under the least thousandth of the others, count as that thousandth. Points
    without neighbours weigh nothing.
    """
    keys = list(keys)
    near = stored(nearest(points, points, keys, k, tile).groupBy(*keys, F.col("a").alias("id")).agg(F.avg("d").alias("_d")))
    low = percentiles(near.where("_d > 0"), keys, "_d", {"_low": 0.001})
    met = near.join(low, keys, "left") if keys else near.crossJoin(low)
    weighed = met.select(*keys, "id", F.pow(F.greatest("_d", F.coalesce("_low", F.lit(2.0**-52))), F.lit(-power)).alias("weight"))
    return points.select(*keys, "id").join(weighed, [*keys, "id"], "left").fillna({"weight": 0.0})

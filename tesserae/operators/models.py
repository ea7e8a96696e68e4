"""Embeddings and clusterings: neighbour graphs, density clusters, merges, trained heads."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import components, stored

#: Rows that meet as many others in a task, and those of them compared at a time.
BLOCK_ROWS = 4096
QUERY_ROWS = 256
#: Pivots, and cells, at most.
MOST_PIVOTS = 2048
#: Clusters that the driver merges by itself.
FEW = 1024


def shared_neighbours(nearest: DataFrame) -> DataFrame:
    """(a, b, shared): pairs of points with a < b that have neighbours in common, of rows (a, b).

    The lists are joined on the neighbour, so a pair costs one row for each neighbour that it shares.
    """
    nearest = stored(nearest.select("a", "b"))  # read twice
    left, right = nearest.select("a", F.col("b").alias("n")), nearest.select(F.col("a").alias("b"), F.col("b").alias("n"))
    return left.join(right, "n").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))


def propagated_labels(edges: DataFrame, rounds: int) -> DataFrame:
    """(node, label): each node takes the heaviest label around it, `rounds` times; ties to the smallest.

    `edges` (a, b, w) has each pair once; labels start as the nodes' own.
    """
    both = stored(edges.select("a", "b", "w").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")))
    labels = both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node"))
    for _ in range(rounds):
        weights = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a", "label").agg(F.sum("w").alias("w"))
        labels = stored(weights.groupBy(F.col("a").alias("node")).agg(F.max_by("label", F.struct("w", -F.col("label"))).alias("label")))
    return labels


def density_clusters(points: DataFrame, near: DataFrame, least: int) -> DataFrame:
    """(id, cluster): density clusters of pairs (a, b) within a radius.

    Points with `least` neighbours or more, themselves counted, are cores; cores that are near each
    other share a cluster, named by its smallest core; other points join their smallest near core's
    cluster; points without one are noise, with a null cluster.
    """
    near = stored(near.select("a", "b"))  # read four times
    cores = near.groupBy("a").agg((F.count("*") + 1).alias("n")).where(F.col("n") >= least).select(F.col("a").alias("core"))
    cores = stored(cores)
    core_pairs = near.where("a < b").join(cores.withColumnRenamed("core", "a").hint("merge"), "a", "left_semi").join(cores.withColumnRenamed("core", "b").hint("merge"), "b", "left_semi")
    found = components(core_pairs.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    named = cores.join(found.withColumnRenamed("node", "core"), "core", "left").select("core", F.coalesce("component", "core").alias("cluster"))
    edge = near.join(named.withColumnRenamed("core", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min_by("cluster", "b").alias("border"))
    own = points.select("id").join(named.withColumnRenamed("core", "id"), "id", "left").join(edge, "id", "left")
    return own.select("id", F.coalesce("cluster", "border").alias("cluster"))


def mlp_head(df: DataFrame, column: str, w1: np.ndarray, b1: np.ndarray, w2: np.ndarray, b2: np.ndarray) -> DataFrame:
    """`df` with `probabilities` and `predicted` of a head of two layers; ties go to the first class.

    The weights go to the tasks once; rows are taken in Arrow batches.
    """
    shared = df.sparkSession.sparkContext.broadcast((w1, b1, w2, b2))

    @F.pandas_udf("array<double>")
    def head(vectors: pd.Series) -> pd.Series:
        a1, c1, a2, c2 = shared.value
        if not len(vectors):
            return pd.Series([], dtype=object)
        x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
        z = np.maximum(x @ a1 + c1, 0) @ a2 + c2
        e = np.exp(z - z.max(1, keepdims=True))
        return pd.Series(list(e / e.sum(1, keepdims=True)))

    out = df.withColumn("probabilities", head(column))
    p = F.col("probabilities")
    return out.withColumn("predicted", (F.array_position(p, F.array_max(p)) - 1).cast("int"))


def shape_filter(shapes: DataFrame, least_area: float, least_circularity: float) -> DataFrame:
    """Shapes (area, perimeter) that are large and round enough: 4 * pi * area / perimeter ** 2."""
    round_ = F.try_divide(4 * F.lit(float(np.pi)) * F.col("area"), F.col("perimeter") * F.col("perimeter"))
    return shapes.withColumn("circularity", round_).where((F.col("area") >= least_area) & (F.col("circularity") >= least_circularity))


def _centres(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """(label, n, v): clusters (label, n, v) put together by (label, to), with their weighted means."""
    at = F.posexplode("v").alias("i", "x")
    sums = rows.join(merged, "label").select("to", "n", at).groupBy("to", "i").agg(F.sum(F.col("n") * F.col("x")).alias("x"))
    sizes = rows.join(merged, "label").groupBy("to").agg(F.sum("n").alias("n"))
    v = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"])  # a row for each dimension
    return sums.groupBy("to").agg(v.alias("v")).join(sizes, "to").select(F.col("to").alias("label"), "n", F.transform("v", lambda x: x / F.col("n")).alias("v"))


def _steps(pairs: list, most: int) -> list[tuple[int, int]]:
    """The first of sorted pairs (a, b, d, bound) that one merge after the other would make, too.

    d is a pair's squared distance; nothing that its merge brings about comes nearer than its bound.
    """
    out, bound = [], float("inf")
    for p in pairs[:most]:
        if out and p["d"] * 1.25 + 1e-9 >= bound:  # two new centres may be nearer by a quarter of a pair's distance
            break
        out.append((p["a"], p["b"]))
        bound = min(bound, p["bound"])
    return out


def _merged_here(x: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """The place of the cluster that each ends in, one merge of the nearest two after another."""
    to, alive = np.arange(len(x)), np.ones(len(x), bool)
    d = ((x[:, None] - x) ** 2).sum(2) if len(x) else np.zeros((0, 0))
    d[np.tril_indices(len(x))] = np.inf
    for _ in range(len(x) - max(1, k)):
        a, b = divmod(int(d.argmin()), len(x))
        x[a], n[a] = (n[a] * x[a] + n[b] * x[b]) / (n[a] + n[b]), n[a] + n[b]
        alive[b], to[to == b] = False, a
        d[b], d[:, b] = np.inf, np.inf
        new = np.where(alive, ((x - x[a]) ** 2).sum(1), np.inf)
        d[a, a + 1 :], d[:a, a] = new[a + 1 :], new[:a]
    return to


def merge_to_k(clusters: DataFrame, k: int, step: int = 1000, few: int = FEW) -> DataFrame:
    """(label, merged): of all clusters the two with the nearest centres are merged, until k are left; the smaller label stays.

    `clusters` (label, n, v) has a row a cluster; a merged centre is the mean weighted by n; ties go to
    the smaller labels. A round finds every centre's two nearest others, and makes as many merges as
    cannot bear on one another, up to `step`: a new centre lies no nearer to others than its
    parts' next neighbours allow. So the outcome is that of merging one pair at a time, for any number of
    clusters. Once no more than `few` are left, which is counted, the driver makes the rest one by one.
    """
    rows = stored(clusters.select(F.col("label").cast("long").alias("label"), F.col("n").cast("double").alias("n"), F.transform("v", lambda x: x.cast("double")).alias("v")))
    names = stored(rows.select("label", F.col("label").alias("merged")))
    left = rows.count()
    while left > max(1, k):
        if left <= few:
            rest = rows.orderBy("label").toPandas()  # `few` rows at most
            to = _merged_here(np.stack(rest["v"].to_list()).astype(np.float64), rest["n"].to_numpy(dtype=np.float64), k)
            ends = rows.sparkSession.createDataFrame(pd.DataFrame({"merged": rest["label"], "_to": rest["label"].to_numpy()[to]}), "merged long, _to long")
            return names.join(ends, "merged").select("label", F.col("_to").alias("merged"))
        near = nearest_in_feature_space(rows.select(F.col("label").alias("id"), "v"), 2, distances=True)
        first = near.where("rank = 1").select("a", "b", "d")
        second = near.where("rank = 2").select(F.col("a").alias("_a"), F.col("d").alias("next"))
        known = stored(first.join(second, first["a"] == second["_a"], "left").select("a", "b", "d", F.coalesce("next", F.lit(float("inf"))).alias("next")).join(rows.select(F.col("label").alias("a"), "n"), "a"))
        back = known.select(F.col("a").alias("b"), F.col("b").alias("_back"), F.col("next").alias("next_b"), F.col("n").alias("n_b"))
        pairs = known.join(back, "b").where("a < b AND _back = a")
        # Whose nearest neighbour a pair takes away has its next one at best.
        hurt = known.select(F.col("a").alias("x"), F.col("b").alias("near"), F.col("next").alias("hurt"))
        ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("near")).join(hurt, "near").where("x <> a AND x <> b").groupBy("a", "b").agg(F.min("hurt").alias("hurt"))
        total = F.col("n") + F.col("n_b")
        own = (F.col("n") * F.col("next") + F.col("n_b") * F.col("next_b")) / total - F.col("n") * F.col("n_b") * F.col("d") / (total * total)
        bound = F.least(own, F.coalesce("hurt", F.lit(float("inf"))))
        found = pairs.join(ends, ["a", "b"], "left").select("a", "b", "d", bound.alias("bound")).orderBy("d", "a", "b").limit(step).collect()
        made = _steps(found, left - max(1, k))
        to = rows.sparkSession.createDataFrame([(b, a) for a, b in made], "label long, _to long")
        merged = rows.select("label").join(to, "label", "left").select("label", F.coalesce("_to", "label").alias("to"))
        names = stored(names.join(merged.toDF("merged", "to"), "merged").select("label", F.col("to").alias("merged")), instead_of=names)
        rows = stored(_centres(rows, merged))
        left -= len(made)
    return names


def merge_small(clusters: DataFrame, least: float) -> DataFrame:
    """(label, merged): clusters smaller than `least` join the nearest of those that are not, round by round.

    `clusters` (label, n, v) has a row a cluster. In a round all small ones join at once, ties to the smaller
    label, and centres are worked out anew; where none is large enough, each joins its nearest other, and what
    hangs together so becomes the cluster of its smallest label. It ends when no small one, or one cluster, is left.
    """
    rows = stored(clusters.select(F.col("label").cast("long").alias("label"), F.col("n").cast("double").alias("n"), F.transform("v", lambda x: x.cast("double")).alias("v")))
    names = stored(rows.select("label", F.col("label").alias("merged")))
    while True:
        small, every = rows.agg(F.count_if(F.col("n") < least), F.count("*")).first()
        if not small or every < 2:
            return names
        if small < every:
            asked = rows.where(F.col("n") < least).select(F.col("label").alias("id"), "v")
            to = nearest_in_feature_space(asked, 1, others=rows.where(F.col("n") >= least).select(F.col("label").alias("id"), "v")).select(F.col("a").alias("label"), F.col("b").alias("_to"))
        else:
            near = nearest_in_feature_space(rows.select(F.col("label").alias("id"), "v"), 1)
            to = components(near.select(F.col("a").alias("src"), F.col("b").alias("dst"))).select(F.col("node").alias("label"), F.col("component").alias("_to"))
        merged = stored(rows.select("label").join(to, "label", "left").select("label", F.coalesce("_to", "label").alias("to")))
        names = stored(names.join(merged.toDF("merged", "to"), "merged").select("label", F.col("to").alias("merged")), instead_of=names)
        rows = stored(_centres(rows, merged))


def _nearest_in_block(k: int):
    """The k nearest of a block to each row that asks, if nearer than what it knows already (`least`, squared)."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "d": []})
        right = right.sort_values("id")
        ids, others = left["id"].to_numpy(), right["id"].to_numpy()
        q, x = np.stack(left["v"].to_list()).astype(np.float64), np.stack(right["v"].to_list()).astype(np.float64)
        known = left["least"].to_numpy(dtype=np.float64)
        square, out = np.einsum("ij,ij->i", x, x), []
        for at in range(0, len(ids), QUERY_ROWS):
            own, v = ids[at : at + QUERY_ROWS], q[at : at + QUERY_ROWS]
            norm = np.einsum("ij,ij->i", v, v)
            about = square - 2 * (v @ x.T)
            about[own[:, None] == others] = np.inf
            least = np.partition(about, k - 1, axis=1)[:, k - 1] if len(others) > k else np.full(len(own), np.inf)
            least = np.minimum(least, known[at : at + QUERY_ROWS] - norm)
            slack = 1e-9 * (norm + square.max())  # products round otherwise than differences
            i, j = np.nonzero(about <= (least + slack)[:, None])
            i, j = i[own[i] != others[j]], j[own[i] != others[j]]
            d = ((v[i] - x[j]) ** 2).sum(1)
            order = np.lexsort((others[j], d, i))
            i, j, d = i[order], j[order], d[order]
            keep = np.arange(len(i)) - np.searchsorted(i, i) < k
            out.append(pd.DataFrame({"a": own[i[keep]], "b": others[j[keep]], "d": d[keep]}))
        return pd.concat(out)

    return run


class Pivots:
    """Places that cells of vectors lie around, each vector in that of its nearest pivot."""

    def __init__(self, places: np.ndarray) -> None:
        self.places = places
        self.apart = np.sqrt(self._squares(places))

    def _squares(self, x: np.ndarray) -> np.ndarray:
        p = self.places
        return np.maximum(np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", p, p) - 2 * (x @ p.T), 0)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's cell and its distance from the pivot."""
        at = self._squares(x).argmin(1)
        return at, np.sqrt(((x - self.places[at]) ** 2).sum(1))

    def bounds(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How near rows of each cell, from `low` to `high` away from its pivot, may lie to each of x, by the triangle and by the cells' borders."""
        square = self._squares(x)
        d = np.sqrt(square)
        own = square.argmin(1)
        mine = square[np.arange(len(x)), own]
        gap = self.apart[own]
        border = np.divide(square - mine[:, None], 2 * gap, out=np.zeros_like(square), where=gap > 0)
        return np.maximum(np.maximum(low - d, d - high), border)


def nearest_in_feature_space(rows: DataFrame, k: int, block_rows: int = BLOCK_ROWS, others: DataFrame | None = None, pivots: int | None = None, distances: bool = False) -> DataFrame:
    """(a, b, rank) and, if asked for, d: the k nearest rows by squared distance of vectors, for each of `rows` (id, v).

    Neighbours are rows of `others`, else of `rows` themselves; no row is its own. Vectors lie in cells
    around pivots, a bounded sample. A row first looks in one block of its own cell, and then meets only
    those cells that may hold something nearer than its k-th so far, by the triangle inequality. Cells are cut
    into blocks of about `block_rows` rows, and so are the rows that meet one, which bounds a task; there are about two
    cells to as many rows. Clustered vectors meet a few cells, vectors without structure meet them all. Ties go to the smaller id; rows
    without a vector take no part.
    """
    spark = rows.sparkSession
    asking = stored(rows.where("v is not null").select("id", "v"))
    held = asking if others is None else stored(others.where("v is not null").select("id", "v"))
    n = held.count()
    m = max(1, min(MOST_PIVOTS, 2 * n // block_rows if pivots is None else pivots))
    drawn = held.orderBy(F.xxhash64("id", F.lit(5)), "id").limit(m).toPandas()
    schema = "a long, b long, d double"
    if not len(drawn):
        empty = spark.createDataFrame([], schema).withColumn("rank", F.lit(1))
        return empty.select("a", "b", "rank", *(["d"] if distances else []))
    shared = spark.sparkContext.broadcast(Pivots(np.unique(np.stack(drawn["v"].to_list()).astype(np.float64), axis=0)))  # MOST_PIVOTS vectors at most

    def place(batches):
        for b in batches:
            at, d = shared.value.cells(np.stack(b["v"].to_list()).astype(np.float64)) if len(b) else (np.zeros(0, int), np.zeros(0))
            yield b.assign(cell=at.astype(np.int32), far=d)

    kinds = {f.name: f.dataType.simpleString() for f in held.schema}
    cells = stored(held.mapInPandas(place, f"id {kinds['id']}, v {kinds['v']}, cell int, far double"))
    sizes = cells.groupBy("cell").agg(F.min("far").alias("low"), F.max("far").alias("high"), F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    told = sizes.toPandas()  # a row for each pivot
    places = len(shared.value.places)
    low, high, parts = np.full(places, np.inf), np.full(places, -np.inf), np.zeros(places, int)
    low[told["cell"]], high[told["cell"]], parts[told["cell"]] = told["low"], told["high"], told["parts"]
    stats = spark.sparkContext.broadcast((low, high, parts))
    part_of = F.pmod(F.xxhash64("id"), F.greatest(F.col("parts"), F.lit(1))).cast("int")
    blocks = stored(cells.join(sizes.select("cell", "parts"), "cell").select("id", "v", "cell", part_of.alias("part")))

    def meet(probes: DataFrame) -> DataFrame:
        """The k nearest of each block to the probes (id, v, least, cell, part) that it meets."""
        counts = stored(probes.groupBy("cell", "part").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("turns")))
        left = probes.join(counts, ["cell", "part"]).withColumn("turn", F.pmod(F.xxhash64("id", F.lit(1)), F.col("turns")).cast("int"))
        right = blocks.join(counts, ["cell", "part"]).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        return left.select("id", "v", "least", "cell", "part", "turn").groupBy("cell", "part", "turn").cogroup(right.select("id", "v", "cell", "part", "turn").groupBy("cell", "part", "turn")).applyInPandas(_nearest_in_block(k), schema)

    order = Window.partitionBy("a").orderBy("d", "b")

    def begin(batches):
        for b in batches:
            at, _ = shared.value.cells(np.stack(b["v"].to_list()).astype(np.float64)) if len(b) else (np.zeros(0, int), None)
            number = stats.value[2][at]
            yield b.assign(cell=at.astype(np.int32), part=(b["id"].to_numpy(dtype=np.int64) % np.maximum(number, 1)).astype(np.int32), least=np.inf)

    probe = f"id {kinds['id']}, v {kinds['v']}, cell int, part int, least double"
    first = stored(meet(asking.mapInPandas(begin, probe)))
    best = first.groupBy("a").agg(F.when(F.count("*") >= k, F.max("d")).alias("least"))
    known = asking.join(best, asking["id"] == best["a"], "left").select("id", "v", F.coalesce("least", F.lit(float("inf"))).alias("least"))

    def further(batches):
        low, high, parts = stats.value
        for b in batches:
            for at in range(0, len(b), QUERY_ROWS):
                part = b.iloc[at : at + QUERY_ROWS]
                x = np.stack(part["v"].to_list()).astype(np.float64)
                bound = shared.value.bounds(x, low, high)
                # Roots and products are rounded.
                slack = 1e-6 * (1 + np.sqrt(np.einsum("ij,ij->i", x, x)))
                i, c = np.nonzero((bound <= np.sqrt(part["least"].to_numpy(dtype=np.float64))[:, None] + slack[:, None]) & (parts > 0))
                own, _ = shared.value.cells(x)
                done = part["id"].to_numpy(dtype=np.int64) % np.maximum(parts[own], 1)
                turns = parts[c]
                i, c = np.repeat(i, turns), np.repeat(c, turns)
                p = np.arange(len(i)) - np.repeat(np.cumsum(turns) - turns, turns)
                keep = (c != own[i]) | (p != done[i])
                i, c, p = i[keep], c[keep], p[keep]
                yield pd.DataFrame({"id": part["id"].to_numpy()[i], "v": part["v"].to_numpy()[i], "cell": c.astype(np.int32), "part": p.astype(np.int32), "least": part["least"].to_numpy()[i]})

    rest = meet(stored(known).mapInPandas(further, probe))
    near = first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return near.select("a", "b", "rank", *(["d"] if distances else []))

"""Components of graphs, and unions under constraints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one in spark.checkpoint.dir.

    Only a local session may leave it unset, and then gets a temporary folder of this machine; on a
    cluster each executor would write to its own disk, so there an unset folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='spark-checkpoint-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
    """`df` written to the shared folder and read again, so that a lost executor costs no more than a reread.

    instead_of: an earlier result of this function that nothing needs from here on; it is deleted.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if instead_of is not None:
        for old in {f.rpartition("/")[0] for f in instead_of.inputFiles()}:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, node, component): the smallest node that each node of (keys, src, dst) reaches.

    Large-star and small-star steps take turns, each a grouped minimum and a join, until the edges
    stop changing; then every node points at its component's smallest. That takes about the square
    of the logarithm of the number of nodes in rounds, whatever the shape, and has no limit. Groups
    are never gathered: a hub's minimum is taken before the shuffle, and its skewed join is left to
    adaptive execution. Null ends and loops are ignored.
    """
    keys = list(keys)
    pairs = edges.select(*keys, F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    pairs = stored(pairs.where("u != v").distinct())
    state = None
    while True:
        both = pairs.unionByName(pairs.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low.hint("merge"), [*keys, "u"]).select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), [*keys, "u"]).select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select(*keys, "u", F.col("m").alias("v"))).where("u != v").distinct()
        pairs = stored(small, instead_of=pairs)
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64(*keys, "u", "v").cast("decimal(38,0)"))).first())
        if now == state or now[0] == 0:
            break
        state = now
    roots = pairs.select(*keys, F.col("v").alias("node")).distinct()
    return pairs.select(*keys, F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(*keys, "node", F.col("node").alias("component"))
    )


def greedy_union(edges: DataFrame, points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, id, fused): points joined along edges (a, b, d) from the shortest on, no source twice in a group.

    Edges may bring the ends' sources along (source_a, source_b); otherwise they are looked up. Joins are never
    broadcast: the sizes of files say little of what a driver would have to hold.

    The outcome hangs on the order, so each plain component's edges are replayed in order of (d, a, b).
    Components spread over all tasks and stream through them; a task holds one component's nodes.
    Points without edges are groups of themselves.
    """
    keys = list(keys)
    component = components(edges.select(*keys, F.col("a").alias("src"), F.col("b").alias("dst")), keys)
    rows = edges.join(component.withColumnRenamed("node", "a").hint("merge"), [*keys, "a"])
    if {"source_a", "source_b"} <= set(edges.columns):
        rows = rows.withColumnsRenamed({"source_a": "sa", "source_b": "sb"})
    else:
        source = points.select(*keys, "id", "source")
        rows = rows.join(source.withColumnRenamed("id", "a").withColumnRenamed("source", "sa").hint("merge"), [*keys, "a"])
        rows = rows.join(source.withColumnRenamed("id", "b").withColumnRenamed("source", "sb").hint("merge"), [*keys, "b"])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    order = [*keys, "component", "d", "a", "b"]
    rows = rows.select(*order, "sa", "sb").repartition(*keys, "component").sortWithinPartitions(*order)
    width = len(keys)

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict = {}
        held: dict = {}
        own = None

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            out: list[tuple] = []
            for r in zip(*(batch[c].tolist() for c in batch.columns), strict=True):
                if r[: width + 1] != own:
                    out += [(*own[:width], i, root(i)) for i in parent] if own else []
                    own, parent, held = r[: width + 1], {}, {}
                _, a, b, sa, sb = r[width + 1 :]
                for node, s in ((a, sa), (b, sb)):
                    if node not in parent:
                        parent[node], held[node] = node, {s}
                p, q = root(a), root(b)
                if p != q and held[p].isdisjoint(held[q]):
                    low, high = (p, q) if p < q else (q, p)
                    parent[high] = low
                    held[low] |= held.pop(high)
            yield pd.DataFrame(out, columns=[*keys, "id", "fused"])
        yield pd.DataFrame([(*own[:width], i, root(i)) for i in parent] if own else [], columns=[*keys, "id", "fused"])

    schema = "".join(f"`{k}` {kinds[k]}, " for k in keys) + "id long, fused long"
    fused = rows.mapInPandas(replay, schema)
    return points.select(*keys, "id").join(fused.hint("merge"), [*keys, "id"], "left").select(*keys, "id", F.coalesce("fused", "id").alias("fused"))


def best_matching(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, a, b, iou): the one-to-one pairs of labels with IoU over one half.

    Labels of one raster do not overlap, so over one half each label has one partner at most, and the
    matching of largest number and overlap is just these pairs.
    """
    return pairs.where("iou > 0.5").select(*keys, "a", "b", "iou")


def cheapest(cost: np.ndarray) -> np.ndarray:
    """The column of each row in the assignment of least total cost, by shortest augmenting paths; rows are no more than columns."""
    n, m = cost.shape
    row_price, column_price = np.zeros(n + 1), np.zeros(m + 1)
    owner, back = np.zeros(m + 1, dtype=np.int64), np.zeros(m + 1, dtype=np.int64)  # place 0 stands for none
    for row in range(1, n + 1):
        owner[0], at = row, 0
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=bool)
        while True:
            used[at] = True
            reduced = np.concatenate(([np.inf], cost[owner[at] - 1] - row_price[owner[at]] - column_price[1:]))
            better = ~used & (reduced < least)
            least[better], back[better] = reduced[better], at
            to = int(np.argmin(np.where(used, np.inf, least)))
            step = least[to]
            row_price[owner[used]] += step
            column_price[used] -= step
            least[~used] -= step
            at = to
            if not owner[at]:
                break
        while at:
            owner[at] = owner[back[at]]
            at = back[at]
    out = np.zeros(n, dtype=np.int64)
    out[owner[1:][owner[1:] > 0] - 1] = np.flatnonzero(owner[1:] > 0)
    return out


def assignment(pairs: DataFrame, keys: Sequence[str], score: str, most_pairs: bool = True) -> DataFrame:
    """(keys, a, b, score): the one-to-one matching of pairs (a, b, score > 0) with the greatest total score.

    With most_pairs the number of pairs comes first, and the total score decides among the largest
    matchings. Pairs whose ends are in no other pair are matched at once. Others that do not touch are matched each by themselves:
    components spread over all tasks and stream through them, and a task holds one component's square of scores.
    """
    keys = list(keys)
    held = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in [*keys, "a", "b"]), F.col(score) > 0)
    pairs = pairs.where(held).select(*keys, F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), F.col(score).cast("double").alias("score"))
    ends = [F.count(F.lit(1)).over(Window.partitionBy(*keys, c)) == 1 for c in "ab"]
    told = stored(pairs.withColumn("_a", ends[0]).withColumn("_b", ends[1]).select("*", (F.col("_a") & F.col("_b")).alias("_lone")))
    lone, pairs = told.where("_lone").select(*keys, "a", "b", "score"), told.where("NOT _lone").select(*keys, "a", "b", "score")
    left, right = F.col("a") * 2, F.col("b") * 2 + 1
    component = components(pairs.select(*keys, left.alias("src"), right.alias("dst")), keys)
    rows = pairs.withColumn("node", left).join(component, [*keys, "node"])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    order = [*keys, "component", "a", "b"]
    rows = rows.select(*order, "score").repartition(*keys, "component").sortWithinPartitions(*order)
    width = len(keys)

    def solve(held: list[tuple]) -> list[tuple]:
        a, b = sorted({r[width + 1] for r in held}), sorted({r[width + 2] for r in held})
        place_a, place_b = {x: i for i, x in enumerate(a)}, {x: i for i, x in enumerate(b)}
        scores = np.zeros((len(a), len(b)))
        for r in held:
            scores[place_a[r[width + 1]], place_b[r[width + 2]]] = r[width + 3]
        weight = np.where(scores > 0, scores + (max(len(a), len(b)) + 1 if most_pairs else 0), 0)
        turned = len(a) > len(b)
        column = cheapest(-(weight.T if turned else weight))
        found = [(int(c), i) if turned else (i, int(c)) for i, c in enumerate(column)]
        return [(*held[0][:width], a[i], b[j], float(scores[i, j])) for i, j in found if scores[i, j] > 0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, held = None, []
        names = [*keys, "a", "b", "score"]
        for batch in batches:
            out: list[tuple] = []
            for r in zip(*(batch[c].tolist() for c in batch.columns), strict=True):
                if r[: width + 1] != own:
                    out += solve(held) if held else []
                    own, held = r[: width + 1], []
                held.append(r)
            yield pd.DataFrame(out, columns=names)
        yield pd.DataFrame(solve(held) if held else [], columns=names)

    schema = "".join(f"`{k}` {kinds[k]}, " for k in keys) + "a long, b long, score double"
    return lone.unionByName(rows.mapInPandas(run, schema))


def cycles(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, id, ring, off) of a permutation (keys, id, next): the smallest id of each cycle, and how many steps lead to it.

    Pointers are doubled: in round k a node knows the smallest of the 2**k nodes after it, and where it
    lies, and a join with the node there doubles that. A node that finds the same smallest in both halves has
    been around and is done; what is around with any node of its cycle is so one round later, so
    nodes that are done are looked up for one more round and then leave. Rounds are the logarithm of the longest
    cycle, and short cycles take part in few of them. The smallest node itself comes with the cycle's length.
    """
    keys = list(keys)
    state = stored(links.select(*keys, "id", F.col("next").alias("jump"), F.col("next").alias("ring"), F.lit(1).cast("long").alias("off"), F.lit(False).alias("_done")))
    step, found = 1, []
    while True:
        there = state.select(*keys, F.col("id").alias("jump"), F.col("jump").alias("_jump"), F.col("ring").alias("_ring"), F.col("off").alias("_off"))
        later = F.col("_ring") < F.col("ring")
        met = state.where("NOT _done").join(there.hint("merge"), [*keys, "jump"])
        new = met.select(*keys, "id", F.col("_jump").alias("jump"), F.least("ring", "_ring").alias("ring"), F.when(later, F.col("_off") + step).otherwise(F.col("off")).alias("off"), (F.col("_ring") == F.col("ring")).alias("_done"))
        state = stored(new, instead_of=state)
        found.append(stored(state.where("_done").select(*keys, "id", "ring", "off")))
        if state.where("NOT _done").isEmpty():
            return reduce(DataFrame.unionByName, found)
        step *= 2


def followed(parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, id, top) of a forest (keys, id, parent): the last of the chain of parents; ids that are no one's child are tops."""
    keys = list(keys)
    state = stored(parents.select(*keys, "id", F.col("parent").alias("top")))
    while True:
        up = state.select(*keys, F.col("id").alias("top"), F.col("top").alias("_top"))
        new = stored(state.join(up, [*keys, "top"], "left").select(*keys, "id", F.coalesce("_top", "top").alias("top"), F.col("_top").isNotNull().alias("_more")), instead_of=state)
        state = new.drop("_more")
        if new.where("_more").isEmpty():
            return state

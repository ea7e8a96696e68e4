"""Communities of weighted graphs by modularity: local moves in coloured rounds, and contraction.

Every round works out, for all nodes at once, what moving to each neighbouring community would gain,
from sums of weights and degrees. Half of the nodes, by a hash that changes with the round, then move
together. Such moves can get in one another's way; if modularity falls the round is taken
back, and only moves that share no community are made, whose gains add up exactly. So modularity
never falls. When no move gains any more, communities become the nodes of a smaller graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components, stored

#: What a move, and what a round must gain at least, as a share of all weight.
LEAST = 1e-9
#: Edges of a graph that the driver finishes by itself.
FEW = 50_000


def _both(edges: DataFrame) -> DataFrame:
    apart = edges.where("a <> b")
    return apart.select("a", "b", "w").unionByName(apart.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))


def _nodes(edges: DataFrame) -> DataFrame:
    """(node, k, loop): degrees, in which a loop counts twice, and loops."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("w").alias("k")), F.struct(F.col("b").alias("node"), F.col("w").alias("k")))).alias("e"), (F.col("a") == F.col("b")).alias("own"))
    return ends.groupBy(F.col("e.node").alias("node")).agg(F.sum("e.k").alias("k"), (F.sum(F.when(F.col("own"), F.col("e.k")).otherwise(F.lit(0))) / 2).alias("loop"))


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> float:
    """Modularity of (node, community) labels of a graph of (a, b, w), each pair once; 0 without weight."""
    own = labels.select("node", "community")
    met = edges.join(own.toDF("a", "ca"), "a").join(own.toDF("b", "cb"), "b")
    inner, total = met.agg(F.sum(F.when(F.col("ca") == F.col("cb"), F.col("w")).otherwise(F.lit(0))), F.sum("w")).first()
    if not total:
        return 0.0
    sizes = _nodes(edges).join(own, "node").groupBy("community").agg(F.sum("k").alias("k")).agg(F.sum(F.col("k") * F.col("k"))).first()[0]
    return float(inner) / float(total) - resolution * float(sizes) / (2.0 * float(total)) ** 2


def _proposals(both: DataFrame, held: DataFrame, total: float, resolution: float, turn: int) -> DataFrame:
    """(a, c, k, loop, inner, t, best, gain, now): for each node of `held` (node, c, k, loop) its best other community."""
    links = both.join(held.select(F.col("node").alias("b"), F.col("c").alias("to")), "b").groupBy("a", "to").agg(F.sum("w").alias("w"))
    sums = held.groupBy("c").agg(F.sum("k").alias("t"), F.count("*").alias("n"))
    met = links.join(held.withColumnRenamed("node", "a"), "a").join(sums, "c").join(sums.toDF("to", "to_t", "to_n"), "to")
    pull = F.lit(resolution) * F.col("k") / F.lit(total)
    score = F.col("w") - pull * F.col("to_t")
    # Two single nodes join at the smaller one's, so that they don't change places.
    open_ = (F.col("to") != F.col("c")) & ((F.col("n") > 1) | (F.col("to_n") > 1) | (F.col("to") < F.col("c")))
    each = met.groupBy("a", "c", "k", "loop", "t").agg(F.sum(F.when(F.col("to") == F.col("c"), F.col("w")).otherwise(F.lit(0))).alias("inner"), F.max(F.when(open_, F.struct(score.alias("score"), (-F.col("to")).alias("to")))).alias("m"))
    stay = F.col("inner") - pull * (F.col("t") - F.col("k"))
    gain = F.coalesce(F.col("m.score") - stay, F.lit(-1.0))
    return each.select("a", "c", "k", "loop", "inner", "t", (-F.col("m.to")).alias("best"), gain.alias("gain"), (F.pmod(F.xxhash64("a", F.lit(turn)), F.lit(2)) == 0).alias("now"))


def _apart(movers: DataFrame) -> DataFrame:
    """Movers (a, c, best, gain) of which no two touch a community; the one with the greatest gain is always among them."""
    rank = F.struct("gain", (-F.col("a")).alias("a"))
    best = movers.select(F.explode(F.array("c", "best")).alias("x"), rank.alias("rank")).groupBy("x").agg(F.max("rank").alias("rank"))
    met = movers.withColumn("rank", rank).join(best.toDF("c", "r1"), "c").join(best.toDF("best", "r2"), "best")
    return met.where("rank = r1 AND rank = r2").select("a", "best")


def _moved(edges: DataFrame, total: float, resolution: float) -> DataFrame:
    """(node, c): nodes after all moves that gain."""
    both = stored(_both(edges))
    nodes = stored(_nodes(edges))
    held = nodes.select("node", F.col("node").alias("c"), "k", "loop")
    before, last, turn = None, None, 0
    while True:
        found = stored(_proposals(both, held, total, resolution, turn))
        gains = F.col("gain") > LEAST * total
        inner, squares, movers, now = found.agg(F.coalesce(F.sum(F.col("inner") + 2 * F.col("loop")), F.lit(0)), F.coalesce(F.sum(F.col("k") * F.col("t")), F.lit(0)), F.count_if(gains), F.count_if(gains & F.col("now"))).first()
        quality = float(inner) / total - resolution * float(squares) / total**2
        if before is not None and quality < before - 1e-12:
            few = _apart(last.where(gains).select("a", "c", "best", "gain")).withColumnRenamed("best", "to")
            held = last.join(few, "a", "left").select(F.col("a").alias("node"), F.coalesce("to", "c").alias("c"), "k", "loop")
        elif not movers:
            alone = nodes.join(found.select(F.col("a").alias("node")), "node", "left_anti").select("node", F.col("node").alias("c"))
            return stored(found.select(F.col("a").alias("node"), "c").unionByName(alone))
        else:
            before, last = quality, found
            move = gains & (F.col("now") if now else F.lit(True))
            held = found.select(F.col("a").alias("node"), F.when(move, F.col("best")).otherwise(F.col("c")).alias("c"), "k", "loop")
        turn += 1


def _here(edges: list[tuple[int, int, float]], resolution: float, connected: bool) -> dict[int, int]:
    """The community of each node of a graph of (a, b, w), one move after another until none gains, level by level."""
    near: dict[int, dict[int, float]] = {}
    for a, b, w in edges:
        for x, y in ((a, b), (b, a)):  # a loop counts twice
            near.setdefault(x, {})
            near[x][y] = near[x].get(y, 0.0) + w
    total = sum(sum(own.values()) for own in near.values())
    labels = {n: n for n in near}
    while True:
        k = {n: sum(own.values()) for n, own in near.items()}
        of, sums, moved = {n: n for n in near}, dict(k), True
        while moved:
            moved = False
            for n in sorted(near):
                weight: dict[int, float] = {of[n]: 0.0}
                for other, w in near[n].items():
                    if other != n:
                        weight[of[other]] = weight.get(of[other], 0.0) + w
                sums[of[n]] -= k[n]
                score = {c: w - resolution * k[n] * sums[c] / total for c, w in weight.items()}
                best = max(score, key=lambda c: (score[c], -c))
                if best != of[n] and score[best] - score[of[n]] > LEAST * total:
                    of[n], moved = best, True
                sums[of[n]] += k[n]
        if connected:
            part: dict[int, int] = {}
            for n in sorted(near):
                todo = [] if n in part else [n]
                part.setdefault(n, n)
                while todo:
                    for other in near[x := todo.pop()]:
                        if other not in part and of[other] == of[x]:
                            part[other] = n
                            todo.append(other)
            of = part
        labels = {n: of[c] for n, c in labels.items()}
        if len(set(of.values())) == len(near):
            return labels
        level: dict[int, dict[int, float]] = {}
        for x, own in near.items():
            for y, w in own.items():
                row = level.setdefault(of[x], {})
                row[of[y]] = row.get(of[y], 0.0) + w
        near = level


def louvain(edges: DataFrame, resolution: float = 1.0, connected: bool = False, few: int = FEW) -> DataFrame:
    """(node, community) of a graph of (a, b, w), each pair once, w > 0: communities of locally greatest modularity.

    connected: communities that fall apart are split into their connected parts before each
    contraction, which modularity can only gain by. A community is named by one of its nodes. Node ids
    are longs; loops are inner weight; an empty graph has no communities. Once contraction has left `few`
    edges or fewer, which are counted, the driver goes on with single moves.
    """
    level = stored(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), F.col("w").cast("double").alias("w")).where("w > 0"))
    weight = level.agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
    labels = stored(_nodes(level).select("node", F.col("node").alias("community")))
    while weight:
        rest = level.limit(few + 1).collect() if few else []  # `few` rows, and one
        if 0 < len(rest) <= few:
            found = _here([tuple(r) for r in rest], resolution, connected)
            ends = edges.sparkSession.createDataFrame(list(found.items()), "community long, c long")
            return labels.join(ends, "community").select("node", F.col("c").alias("community"))
        moved = _moved(level, 2.0 * weight, resolution)
        if connected:
            inner = level.where("a <> b").join(moved.toDF("a", "ca"), "a").join(moved.toDF("b", "cb"), "b").where("ca = cb")
            parts = components(inner.select(F.col("a").alias("src"), F.col("b").alias("dst")))
            moved = stored(moved.join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("c")))
        n, fewer = moved.agg(F.count("*"), F.countDistinct("c")).first()
        if n == fewer:
            break
        labels = stored(labels.join(moved.toDF("community", "c"), "community").select("node", F.col("c").alias("community")), instead_of=labels)
        ends = level.join(moved.toDF("a", "ca"), "a").join(moved.toDF("b", "cb"), "b")
        level = stored(ends.groupBy(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.sum("w").alias("w")))
    return labels

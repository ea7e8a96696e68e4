"""Hard negatives by a secondary sort.

Anchors meet all rows in blocks, and every pair's score is packed into a key of (anchor, descending
score, kind, id), so that the order of bytes is the order of ranks. One shuffle deals the keys out by
anchor and sorts them within partitions; a task then streams over its sorted keys. A positive opens a
window of scores below it, negatives that fall into open windows are emitted, and a window closes
when it is full or scores have sunk below it. What a task holds is one anchor's open windows: no
anchor's candidates are ever gathered.

Before the shuffle each task drops what cannot be emitted. A first pass over the rows keeps the
`positives` best of an anchor's own label in each task, and their union settles the windows; the
second keeps, in each task, the first `per_positive` negatives of each window. Whatever the tasks, the
negatives that the stream would emit are among these.

Anchors go out in rounds of about `ROUND`, which bounds what is broadcast.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table
from .rows import map_frames
from .topk import FAR, SCALE, in_round, taking_part

POSITIVES = 5
PER_POSITIVE = 3
#: A window holds the negatives from LOW to HIGH hundredths of its positive's score, both included.
LOW, HIGH = 50, 95
#: Anchor vectors in one broadcast.
ROUND = 20_000
#: Anchors and rows compared at a time.
ANCHOR_BLOCK = 256
ROWS = 2000

_KEY = struct.Struct(">QQBQ")
_TOP = 1 << 63
POSITIVE, NEGATIVE = 0, 1


def packed(anchor: int, score: int, kind: int, row: int) -> bytes:
    """A key whose bytes sort by anchor, falling score, positives before negatives, and id."""
    return _KEY.pack(anchor, _TOP - 1 - score, kind, row + _TOP)


def unpacked(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, row = _KEY.unpack(key)
    return anchor, _TOP - 1 - score, kind, row - _TOP


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The least and greatest score of a positive's negatives; the first is larger if there is none."""
    return -(-low * score // 100), high * score // 100


def whole(rows: list, width: int) -> np.ndarray:
    """floor(256 * x) of vectors, cut or padded with zeros to `width`."""
    x = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        n = min(len(r), width)
        x[i, :n] = np.clip(np.floor(SCALE * np.asarray(r[:n], dtype=np.float64)), -FAR, FAR)
    return x


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products, whole; beyond a long they are its ends."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a @ x.T).astype(np.int64)
    if most < 2**63:
        return a.astype(np.int64) @ x.astype(np.int64).T
    left, right = ([[int(v) for v in row] for row in m.tolist()] for m in (a, x))
    return np.array([[min(max(sum(p * q for p, q in zip(u, v, strict=True)), -_TOP), _TOP - 1) for v in right] for u in left], dtype=np.int64).reshape(len(a), len(x))


class Anchors:
    """One round's anchors: ids, labels and vectors, and the scores of their positives once known."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: list, numbers: np.ndarray) -> None:
        self.ids, self.labels, self.numbers = ids, labels, numbers
        self.x = whole(vectors, max(map(len, vectors), default=0))
        self.scores: list[list[int]] = [[] for _ in ids]


def _best(group: np.ndarray, score: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group, by falling score and id."""
    order = np.lexsort((row, ~score, group))  # ~score is -score - 1, which has no overflow
    group = group[order]
    return order[np.arange(len(group)) - np.searchsorted(group, group) < k]


def _compared(anchors: Anchors, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first anchor, scores, whether labels are the same, rows' ids) of blocks; an anchor's own rows have neither label."""
    for b in batches:
        for at in range(0, len(b), ROWS):
            part = b.iloc[at : at + ROWS]
            x, ids, labels = whole(list(part["embedding"]), anchors.x.shape[1]), part["vec_id"].to_numpy(), part["label"].to_numpy()
            for first in range(0, len(anchors.ids), ANCHOR_BLOCK):
                block = slice(first, first + ANCHOR_BLOCK)
                same = (anchors.labels[block, None] == labels).astype(np.int8)
                same[anchors.ids[block, None] == ids] = -1
                yield first, products(anchors.x[block], x), same, ids


def _first_pass(anchors: Anchors, k: int):
    """Each task's k best rows of an anchor's label: (anchor, vec_id, score)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [np.zeros(0, np.int64)] * 3
        least = np.full(len(anchors.ids), np.iinfo(np.int64).min)
        for first, scores, same, ids in _compared(anchors, batches):
            i, j = np.nonzero((same == 1) & (scores >= least[first : first + len(scores), None]))
            i, j, s = i + first, ids[j], scores[i, j]
            own = (got[0] >= first) & (got[0] < first + len(scores))
            i, j, s = (np.concatenate((old[own], new)) for old, new in zip(got, (i, j, s), strict=True))
            keep = _best(i, s, j, k)
            i, j, s = i[keep], j[keep], s[keep]
            nth = np.arange(len(i)) - np.searchsorted(i, i)
            least[i[nth == k - 1]] = s[nth == k - 1]
            got = [np.concatenate((old[~own], new)) for old, new in zip(got, (i, j, s), strict=True)]
        yield pd.DataFrame({"anchor": anchors.numbers[got[0]], "vec_id": got[1], "score": got[2]})

    return run


def _second_pass(anchors: Anchors, positives: int, per_positive: int, low: int, high: int):
    """The packed keys of each task's first negatives of every window; one that falls into several windows has one key."""
    n = len(anchors.ids)
    ends = np.array([[window(s[p], low, high) if p < len(s) else (1, 0) for p in range(positives)] for s in anchors.scores], dtype=np.int64).reshape(n, positives, 2)
    none = np.iinfo(np.int64).min

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [np.zeros(0, np.int64)] * 3  # window, vec_id, score
        least = ends[:, :, 0].ravel().copy()
        for first, scores, same, ids in _compared(anchors, batches):
            new = [tuple(got)]
            block = slice(first, first + len(scores))
            far = np.where(same == 0, scores, none)
            for p in range(positives):
                at = np.arange(n)[block] * positives + p
                i, j = np.nonzero((far >= least[at][:, None]) & (far <= ends[block, p, 1][:, None]) & (ends[block, p, 0] <= ends[block, p, 1])[:, None] & (same == 0))
                new.append((at[i], ids[j], scores[i, j]))
            if sum(len(x[0]) for x in new[1:]):
                w, v, s = (np.concatenate(c) for c in zip(*new, strict=True))
                keep = _best(w, s, v, per_positive)
                w, v, s = got = [w[keep], v[keep], s[keep]]
                nth = np.arange(len(w)) - np.searchsorted(w, w)
                least[w[nth == per_positive - 1]] = s[nth == per_positive - 1]
        w, v, s = got
        # Windows of an anchor overlap: a row that stands in several has a key for one of them.
        a = w // positives
        order = np.lexsort((np.arange(len(w)), v, s, a))
        p = w % positives
        copies: dict[tuple[int, int, int, int], int] = {}
        most: dict[tuple[int, int, int], int] = {}
        for i in order.tolist():
            row = (int(a[i]), int(s[i]), int(v[i]))
            n_in = copies[(*row, int(p[i]))] = copies.get((*row, int(p[i])), 0) + 1
            most[row] = max(most.get(row, 0), n_in)
        yield pd.DataFrame({"key": [packed(int(anchors.numbers[x]), y, NEGATIVE, z) for (x, y, z), n_in in most.items() for _ in range(n_in)]})

    return run


def stream(keys: Iterator[bytes], positives: int, per_positive: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, positive score, negative score) of sorted packed keys, as they pass by.

    Held are the open windows of one anchor: `positives` at most.
    """
    own, seen, windows = None, 0, []
    for key in keys:
        anchor, score, kind, row = unpacked(key)
        if anchor != own:
            own, seen, windows = anchor, 0, []
        if kind == POSITIVE:
            if seen < positives:
                seen += 1
                windows.append([*window(score, low, high), row, score, 0])
            continue
        windows = [w for w in windows if w[0] <= score and w[4] < per_positive]
        for w in windows:
            if score <= w[1]:
                w[4] += 1
                yield anchor, w[2], w[4], row, w[3], score


def mine(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, per_positive: int = PER_POSITIVE, low: int = LOW, high: int = HIGH, round_size: int = ROUND
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every row of `anchors`.

    Both have vec_id, embedding and label. An anchor's positives are its `positives` best other rows
    of the same label; each gets the first `per_positive` rows of other labels whose score is
    between `low` and `high` hundredths of its own. Scores are inner products of floor(256 * x);
    ties go to the smaller vec_id. Rows with the anchor's vec_id are its own. Repeated rows are
    candidates each; equal anchor rows are one, and different vectors or labels under one id are
    anchors each. Vectors of different lengths are compared over the shorter one. Rows with a null
    id, label or vector, or a null or non-finite component, take no part; a positive score of zero has
    zero scores for negatives, one below zero has none. Scores beyond a long become its ends. Empty
    tables give an empty result.
    """
    spark = rows.sparkSession

    def labelled(df: DataFrame) -> DataFrame:
        return taking_part(df.select("vec_id", "embedding", F.col("label").cast("long").alias("label")).where("label is not null"), "label")

    every = labelled(rows)
    asked = materialize(labelled(anchors).distinct().withColumn("query_key", F.xxhash64("embedding", "label")))
    rounds = max(1, -(-asked.count() // round_size))

    def one(number: int) -> DataFrame:
        part = in_round(asked, rounds, number).toArrow().sort_by([("vec_id", "ascending"), ("query_key", "ascending")])  # round_size vectors, about
        ids = part["vec_id"].to_numpy()
        mine_ = Anchors(ids, part["label"].to_numpy(), part["embedding"].to_pylist(), np.arange(len(ids)))
        shared = spark.sparkContext.broadcast(mine_)
        few = map_frames(every, lambda batches: _first_pass(shared.value, positives)(batches), "anchor long, vec_id long, score long")
        order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
        best = materialize(few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives).drop("n"))
        for r in best.orderBy("anchor", F.desc("score"), "vec_id").toLocalIterator():  # round_size times `positives` rows at most
            mine_.scores[r["anchor"]].append(r["score"])
        known = spark.sparkContext.broadcast(mine_)
        negatives = map_frames(every, lambda batches: _second_pass(known.value, positives, per_positive, low, high)(batches), "key binary")
        keys = best.rdd.map(lambda r: packed(r["anchor"], r["score"], POSITIVE, r["vec_id"])).union(negatives.rdd.map(lambda r: bytes(r["key"])))
        n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        dealt = keys.map(lambda key: (key, None)).repartitionAndSortWithinPartitions(n, lambda key: int.from_bytes(key[:8], "big"))

        def emit(part_: Iterator[tuple[bytes, None]]) -> Iterator[tuple[int, int, int, int, int, int]]:
            names = known.value.ids
            for r in stream((key for key, _ in part_), positives, per_positive, low, high):
                yield int(names[r[0]]), *r[1:]

        return spark.createDataFrame(dealt.mapPartitions(emit), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

    return reduce(DataFrame.unionByName, map(one, range(rounds)))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector among all; labels of every seventh are moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(rows, rows.where(F.col("vec_id") % 50 == 0))


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT * FROM n WHERE rank <= 3
"""

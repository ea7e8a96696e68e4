"""Exact top-k search with segment statistics in several resolutions.

Vectors are turned by an orthogonal basis that is learnt from a round's queries, which changes no
inner product but gathers what the vectors have in common in the first components. A turned vector is
cut into 1, 4, 16 and 32 segments; each is summed up by its mean and its deviation. For segments of n
components, n * ((mean - mean')**2 + (dev - dev')**2) summed over the segments is never more than the
squared distance, so (|q|**2 + |x|**2 - bound) / 2 is never less than the inner product. Pairs whose
bound stays under the query's k-th best so far are dropped, coarse bounds first, and inner products
are computed for the survivors only, in whole numbers, from the vectors as they were. The first
`SEED` candidates of a task have nothing to be held against and are all computed.

Queries are dealt out in rounds of about `ROUND` vectors, which bounds what is broadcast; each
round reads the candidates once, in blocks, and sends on k rows a query and task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Accumulator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table
from .rows import map_frames

K = 5
SCALE = 256
#: Components beyond are taken as this; their scores are beyond a long anyhow.
FAR = 1e150
SEGMENTS = (1, 4, 16, 32)
#: Query vectors in one broadcast.
ROUND = 20_000
#: Queries and candidates compared at a time.
QUERY_BLOCK = 256
ROWS = 2000
#: Candidates of a task that are computed first, to have k scores to hold the others against.
SEED = 256
#: Up to this share of survivors the next bound is worked out pair by pair, else for the whole block.
SPARSE = 0.1
#: Pairs whose components are gathered at a time.
PAIRS = 1 << 14


def turning(x: np.ndarray) -> np.ndarray:
    """An orthogonal basis of the columns of `x`, what its rows have most in common first."""
    most = np.abs(x).max(initial=0)
    if not most:
        return np.eye(x.shape[1])
    return np.linalg.eigh((x / most).T @ (x / most))[1][:, ::-1]


class Vectors:
    """Integer vectors with their segment statistics under a basis."""

    def __init__(self, ids: np.ndarray, rows: list, basis: np.ndarray | None = None) -> None:
        """Without a basis it is learnt from these vectors."""
        self.ids = ids
        self.width = max([len(r) for r in rows], default=0) if basis is None else len(basis)
        x = np.zeros((len(rows), self.width))
        for i, r in enumerate(rows):
            n = min(len(r), self.width)  # beyond the other side's width all products are 0
            x[i, :n] = np.clip(np.floor(SCALE * np.asarray(r[:n], dtype=np.float64)), -FAR, FAR)
        self.x = x
        self.basis = turning(x) if basis is None else basis
        y = x @ self.basis
        self.levels = []
        square = np.einsum("ij,ij->i", y, y)
        for n in SEGMENTS:
            cuts = np.linspace(0, self.width, min(n, max(1, self.width // 2)) + 1).astype(int)
            sizes = np.maximum(np.diff(cuts), 1)
            if self.width:
                mean = np.add.reduceat(y, cuts[:-1], axis=1) / sizes
                dev = np.sqrt(np.maximum(np.add.reduceat(y * y, cuts[:-1], axis=1) / sizes - mean * mean, 0))
            else:
                mean = dev = np.zeros((len(x), 1))
            f = np.concatenate((mean, dev), axis=1) * np.sqrt(np.concatenate((sizes, sizes)))
            self.levels.append((f, (square - np.einsum("ij,ij->i", f, f)) / 2))
        self.square = square

    def part(self, at: slice) -> Vectors:
        out = object.__new__(Vectors)
        out.ids, out.width, out.x, out.square, out.basis = self.ids[at], self.width, self.x[at], self.square[at], self.basis
        out.levels = [(f[at], a[at]) for f, a in self.levels]
        return out


def _products(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of q[i] and x[j], whole; beyond a long they are its ends."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < 2**53 and len(i) == len(q) * len(x):
        return (q @ x.T)[i, j].astype(np.int64)
    if most < 2**63:
        kind = np.float64 if most < 2**53 else np.int64
        q, x = q.astype(kind), x.astype(kind)
        parts = [np.einsum("ij,ij->i", q[i[n : n + PAIRS]], x[j[n : n + PAIRS]]).astype(np.int64) for n in range(0, len(i), PAIRS)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(q[m].tolist(), x[n].tolist(), strict=True)) for m, n in zip(i.tolist(), j.tolist(), strict=True)]
    return np.array([min(max(v, -(2**63)), 2**63 - 1) for v in whole], dtype=np.int64)


def search_block(q: Vectors, x: Vectors, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(query, candidate, score) of this block's pairs that reach `least`, and the survivors of each level.

    least: each query's k-th best score so far, or -inf.
    """
    total = len(q.ids) * len(x.ids)
    alive = q.ids[:, None] != x.ids
    slack = 1 + 1e-9 * (q.square[:, None] + x.square)
    pairs: tuple[np.ndarray, np.ndarray] | None = None
    left = []
    for (fq, aq), (fx, ax) in zip(q.levels, x.levels, strict=True):
        if pairs is None:
            alive &= fq @ fx.T + aq[:, None] + ax + slack >= least[:, None]
            if alive.sum() <= SPARSE * total:
                pairs = np.nonzero(alive)
            left.append(int(alive.sum()))
        else:
            i, j = pairs
            bound = np.einsum("ij,ij->i", fq[i], fx[j]) + aq[i] + ax[j] + slack[i, j]
            keep = bound >= least[i]
            pairs = i[keep], j[keep]
            left.append(len(pairs[0]))
    i, j = np.nonzero(alive) if pairs is None else pairs
    score = _products(q.x, x.x, i, j)
    keep = score >= least[i]
    return i[keep], j[keep], score[keep], left


def _search(queries: Vectors, keys: np.ndarray, k: int, count: Callable[[int, list[int]], None] | None = None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = len(queries.ids)
        least = np.full(n, -np.inf)
        got = [np.zeros(0, np.int64)] * 3  # query number, vec_id, score
        seeded = False
        for b in batches:
            cuts = [0, *range(ROWS if seeded else SEED, len(b), ROWS), len(b)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if low == high:
                    continue
                rows = b.iloc[low:high]
                x = Vectors(rows["vec_id"].to_numpy(dtype=np.int64), list(rows["embedding"]), queries.basis)
                new = [got]
                for at in range(0, n, QUERY_BLOCK):
                    part = slice(at, min(n, at + QUERY_BLOCK))
                    i, j, score, left = search_block(queries.part(part), x, least[part])
                    new.append([i + at, x.ids[j], score])
                    if count and seeded:
                        count((part.stop - at) * len(x.ids), left)
                seeded = True
                q, v, s = (np.concatenate(c) for c in zip(*new, strict=True))
                order = np.lexsort((v, -s.astype(object) if (s == np.iinfo(np.int64).min).any() else -s, q))
                q, v, s = q[order], v[order], s[order]
                nth = np.arange(len(q)) - np.searchsorted(q, q)
                keep = nth < k
                got = [q[keep], v[keep], s[keep]]
                full = nth == k - 1
                least[q[full]] = s[full]
        q, v, s = got
        yield pd.DataFrame({"query_id": queries.ids[q], "query_key": keys[q], "vec_id": v, "score": s})

    return run


def taking_part(vectors: DataFrame, *more: str) -> DataFrame:
    """(vec_id, embedding, more) of rows with an id and a vector without null or non-finite components."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), *more).where("vec_id is not null and embedding is not null").where(~bad)


def counters(spark: SparkSession) -> list[Accumulator]:
    """Accumulators for search(): of all pairs, and of those that survive each level of segments."""
    return [spark.sparkContext.accumulator(0) for _ in range(1 + len(SEGMENTS))]


def in_round(asked: DataFrame, rounds: int, number: int) -> DataFrame:
    """The queries of one round, dealt by id and vector, so that equal vectors spread over all rounds."""
    return asked.where(F.pmod(F.xxhash64("vec_id", "query_key"), F.lit(rounds)) == number)


def search(queries: DataFrame, vectors: DataFrame, k: int = K, round_size: int = ROUND, survivors: list[Accumulator] | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products of floor(256 * x).

    Rows with the query's vec_id are its own and no candidates; ties go to the smaller vec_id; fewer
    than k candidates are all returned. Vectors of different lengths are compared over the shorter
    one, as if padded with zeros. Repeated candidate rows are candidates each; equal query rows are
    one query, and different vectors under one id are queries each. Scores beyond a long become its
    ends. Null vectors, and those with null or non-finite components, take no part; an empty table
    gives an empty result. survivors: what counters() gave, to count pairs in, those of seeds aside.
    """
    spark = vectors.sparkSession
    rows = taking_part(vectors)
    asked = materialize(taking_part(queries).distinct().withColumn("query_key", F.xxhash64("embedding")))
    rounds = max(1, -(-asked.count() // round_size))

    def one(number: int) -> DataFrame:
        part = in_round(asked, rounds, number).toArrow()
        part = part.sort_by([("vec_id", "ascending"), ("query_key", "ascending")])
        mine = Vectors(part["vec_id"].to_numpy(), part["embedding"].to_pylist())
        shared = spark.sparkContext.broadcast((mine, part["query_key"].to_numpy()))  # round_size vectors, about

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield from _search(*shared.value, k, count)(batches)

        return map_frames(rows, run, "query_id long, query_key long, vec_id long, score long")

    def add(pairs: int, left: list[int]) -> None:
        for total, n in zip(survivors, [pairs, *left], strict=True):
            total.add(n)

    count = add if survivors else None
    found = reduce(DataFrame.unionByName, map(one, range(rounds)))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all vectors for every fiftieth."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors.where(F.col("vec_id") % 50 == 0), vectors)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

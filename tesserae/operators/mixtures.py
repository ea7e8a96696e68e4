"""Components, k-means and Gaussian mixtures from sums: a pass over the rows sends on moments only.

Each task adds up its rows' moments in blocks, Spark sums them up by place, and the driver sees a number
of values that depends on the dimensions and components alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import stored

#: Rows of a block, and of the sample that first centres are drawn from.
BLOCK = 4096
SEEDS = 2048


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def summed(df: DataFrame, column: str, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over blocks of rows of what `work` makes of each (a flat array of one length); null vectors take no part."""

    def run(batches):
        total = None
        for b in batches:
            for at in range(0, len(b), BLOCK):
                part = work(_matrix(b["v"].iloc[at : at + BLOCK]))
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "x": total})

    rows = df.select(F.col(column).alias("v")).where("v is not null").mapInPandas(run, "i long, x double")
    found = rows.groupBy("i").agg(F.sum("x").alias("x")).toPandas().sort_values("i")  # as many rows as `work` has values
    return found["x"].to_numpy()


def added(df: DataFrame, column: str, name: str, kind: str, work: Callable[[np.ndarray], list]) -> DataFrame:
    """`df` with a column that `work` makes of blocks of vectors; null vectors get null."""

    @F.pandas_udf(kind)
    def run(vectors: pd.Series) -> pd.Series:
        has = vectors.notna()
        out = pd.Series([None] * len(vectors), index=vectors.index, dtype=object)
        if has.any():
            out[has] = pd.Series(list(work(_matrix(vectors[has]))), index=vectors.index[has], dtype=object)
        return out

    return df.withColumn(name, run(column))


def principal_components(df: DataFrame, column: str, k: int) -> DataFrame:
    """`df` with `components`: the first k principal components of the centred and scaled vectors.

    They come from the table's cross products. Each points so that its largest loading is above zero.
    Columns that never change are left at zero.
    """

    def moments(x: np.ndarray) -> np.ndarray:
        return np.concatenate(([len(x)], x.sum(0), (x.T @ x).ravel()))

    got = summed(df, column, moments)
    if not len(got):
        return df.withColumn("components", F.lit(None).cast("array<double>"))
    d = int(round((np.sqrt(4 * len(got) - 3) - 1) / 2))
    n, mean = got[0], got[1 : 1 + d] / got[0]
    cov = (got[1 + d :].reshape(d, d) - n * np.outer(mean, mean)) / max(n - 1, 1)
    scale = np.sqrt(np.maximum(np.diag(cov), 0))
    by = np.divide(1.0, scale, out=np.zeros(d), where=scale > 0)
    values, turned = np.linalg.eigh(cov * np.outer(by, by))
    turned = turned[:, np.argsort(-values, kind="stable")[:k]]
    turned = turned * np.where(turned[np.abs(turned).argmax(0), np.arange(turned.shape[1])] < 0, -1, 1)
    return added(df, column, "components", "array<double>", lambda x: list(((x - mean) * by) @ turned))


def _seeds(df: DataFrame, column: str, k: int, seed: int) -> np.ndarray:
    """k first centres: of a bounded sample by hash, one after the other the row that lies furthest from those before it."""
    drawn = df.select(F.col(column).alias("v")).where("v is not null").distinct().orderBy(F.xxhash64(F.lit(seed), "v")).limit(SEEDS).toPandas()
    x = _matrix(drawn["v"]) if len(drawn) else np.zeros((0, 0))
    chosen = [0] if len(x) else []
    far = np.full(len(x), np.inf)
    while chosen and len(chosen) < min(k, len(x)):
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(np.argmax(far)))
    return x[chosen]


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = ((x[:, None, :] - centres) ** 2).sum(2) if len(x) * centres.size < 1 << 24 else np.stack([((x - c) ** 2).sum(1) for c in centres], axis=1)
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at]


def k_means_centres(df: DataFrame, column: str, k: int, seed: int, rounds: int = 100, centres: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """(centres, sum of squared distances) when nothing moves any more, or after `rounds`; a centre without rows stays."""
    centres = _seeds(df, column, k, seed) if centres is None else centres
    squares = 0.0
    for _ in range(rounds if len(centres) else 0):
        now = centres

        def sums(x: np.ndarray, now: np.ndarray = now) -> np.ndarray:
            at, d = _nearest(x, now)
            one = np.eye(len(now))[at]
            return np.concatenate(([d.sum()], one.sum(0), (one.T @ x).ravel()))

        got = summed(df, column, sums)
        squares, n = float(got[0]), got[1 : 1 + len(now)]
        centres = np.where(n[:, None] > 0, got[1 + len(now) :].reshape(now.shape) / np.maximum(n, 1)[:, None], now)
        if np.array_equal(centres, now):
            break
    return centres, squares


def k_means(df: DataFrame, column: str, k: int, seed: int) -> DataFrame:
    """`df` with `cluster` from 0, the nearest of k centres; ties go to the first."""
    rows = stored(df)
    centres, _ = k_means_centres(rows, column, k, seed)
    return added(rows, column, "cluster", "int", lambda x: _nearest(x, centres)[0].tolist())


@dataclass
class Mixture:
    """Weights, means and covariances of Gaussians, with the log-likelihood and Bayesian information criterion (larger is better)."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    likelihood: float = -np.inf
    bic: float = -np.inf
    rounds: int = 0

    def logs(self, x: np.ndarray) -> np.ndarray:
        """Each row's log density times weight, by component."""
        out = np.empty((len(x), len(self.weights)))
        for j, (w, m, c) in enumerate(zip(self.weights, self.means, self.covariances, strict=True)):
            lower = np.linalg.cholesky(c)
            z = np.linalg.solve(lower, (x - m).T)
            out[:, j] = np.log(w) - 0.5 * (z * z).sum(0) - np.log(np.diag(lower)).sum() - 0.5 * len(m) * np.log(2 * np.pi)
        return out

    def shares(self, x: np.ndarray) -> tuple[np.ndarray, float]:
        """Each row's share in the components, and the rows' log-likelihood."""
        logs = self.logs(x)
        top = logs.max(1, keepdims=True)
        total = top + np.log(np.exp(logs - top).sum(1, keepdims=True))
        return np.exp(logs - total), float(total.sum())


def fit_mixture(df: DataFrame, column: str, k: int, seed: int = 7, shape: str = "full", rounds: int = 200, tolerance: float = 1e-6, ridge: float = 1e-6, start: Mixture | None = None) -> Mixture:
    """A mixture of k Gaussians by expectation and maximisation; every round is one pass that sends on moments.

    shape: 'full' covariances, 'diagonal' ones, or 'spherical'. It begins with k-means and ends when the mean
    log-likelihood gains less than `tolerance`, or after `rounds`. `ridge` times the data's own
    variance is added to every variance, so that no component shrinks to a point. Components whose rows
    run out are dropped.
    """
    rows = stored(df.select(F.col(column).alias("v")).where("v is not null"))

    def moments(shares: Callable[[np.ndarray], tuple[np.ndarray, float]]) -> np.ndarray:
        def work(x: np.ndarray) -> np.ndarray:
            r, likelihood = shares(x)
            second = np.einsum("ij,ik,il->jkl", r, x, x, optimize=True)
            return np.concatenate(([len(x), likelihood], r.sum(0), (r.T @ x).ravel(), second.ravel()))

        return summed(rows, "v", work)

    def maximised(got: np.ndarray, n_components: int) -> Mixture:
        n, sums = got[0], got[2 : 2 + n_components]
        d = int(round((np.sqrt(1 + 4 * (len(got) - 2 - n_components) / n_components) - 1) / 2))
        first = got[2 + n_components : 2 + n_components * (1 + d)].reshape(n_components, d)
        second = got[2 + n_components * (1 + d) :].reshape(n_components, d, d)
        own = np.flatnonzero(sums > 1e-9 * n)
        means = first[own] / sums[own, None]
        cov = second[own] / sums[own, None, None] - means[:, :, None] * means[:, None, :]
        if shape == "diagonal":
            cov = cov * np.eye(d)
        elif shape == "spherical":
            cov = np.trace(cov, axis1=1, axis2=2)[:, None, None] / d * np.eye(d)
        centre = first.sum(0) / n
        spread = np.maximum(np.diag(second.sum(0) / n - np.outer(centre, centre)), 1e-12)
        return Mixture(sums[own] / n, means, cov + ridge * np.diag(spread))

    if start is None:
        centres, _ = k_means_centres(rows, "v", k, seed)
        if not len(centres):
            raise ValueError("a mixture needs rows")
        start = maximised(moments(lambda x: (np.eye(len(centres))[_nearest(x, centres)[0]], 0.0)), len(centres))
    mixture, last = start, -np.inf
    for turn in range(1, rounds + 1):
        got = moments(mixture.shares)
        n, d, j = got[0], mixture.means.shape[1], len(mixture.weights)
        free = j - 1 + j * d + j * {"full": d * (d + 1) // 2, "diagonal": d, "spherical": 1}[shape]
        mixture.likelihood, mixture.bic, mixture.rounds = float(got[1]), float(2 * got[1] - free * np.log(n)), turn
        if got[1] - last < tolerance * n or turn == rounds:
            break
        last, mixture = got[1], maximised(got, j)
    return mixture


def mixed(df: DataFrame, column: str, mixture: Mixture) -> DataFrame:
    """`df` with `component` (from 0, the likeliest, ties to the first) and `share`, how sure that is."""
    out = added(df, column, "_shares", "array<double>", lambda x: list(mixture.shares(x)[0]))
    top = F.array_max("_shares")
    return out.withColumn("component", (F.array_position("_shares", top) - 1).cast("int")).withColumn("share", top).drop("_shares")

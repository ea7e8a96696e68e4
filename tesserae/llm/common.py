"""Helpers that the text operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..operators.graph import stored

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Writes a DataFrame to the shared folder and reads it again, which cuts the lineage.
materialize = stored


def splitmix(n: int, seed: int) -> np.ndarray:
    """`n` pseudo-random 64-bit values (SplitMix64)."""
    with np.errstate(over="ignore"):
        x = np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes mod 2**64 of any slices of a byte buffer.

    The base is odd, so it has an inverse and one prefix sum serves every slice.
    """

    BASE = 0x9E3779B97F4A7C15 | 1
    BYTES = splitmix(256, 7)

    def __init__(self) -> None:
        self.power = np.ones(1, dtype=np.uint64)
        self.inverse = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.power):
            n = max(n, 2 * len(self.power))
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 2**64))):
                factors = np.full(n, base, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums, one more than there are bytes."""
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.BYTES[data] * self.power[: len(data)], out=out[1:])
        return out

    def slices(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end]."""
        return mix((prefix[end] - prefix[start]) * self.inverse[start])

    def grams(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Hashes of every k successive bytes."""
        n = len(prefix) - k
        return mix((prefix[k:] - prefix[:n]) * self.inverse[:n]) if n > 0 else np.zeros(0, np.uint64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` successive values."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x

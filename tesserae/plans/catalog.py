"""All queries of the library (without the text subpackage), with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import evidence, modelling, quality, review, shapes, spatial, statistics

FLAGSHIP = spatial.zonal_stats


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return spatial.QUERIES | statistics.QUERIES | evidence.QUERIES | modelling.QUERIES | quality.QUERIES | review.QUERIES | shapes.QUERIES


def oracle_sql() -> dict[str, str]:
    return spatial.SQL | statistics.SQL | evidence.SQL | modelling.SQL | quality.SQL | review.SQL | shapes.SQL

"""Queries over embeddings and clusterings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import communities, joins, mixtures, models
from .frames import CELLS, cells, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _vectors(spark, sf_dir):
    """Embeddings with whole numbers, so that sums are the same in any order."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("v"))


_LANDMARKS = "lm AS (SELECT vec_id AS id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v FROM embeddings)"
_NEAREST = f"""{_LANDMARKS}, nn AS (SELECT a, b FROM (SELECT a.id AS a, b.id AS b, row_number() OVER (PARTITION BY a.id ORDER BY list_inner_product(a.v, a.v) + list_inner_product(b.v, b.v) - 2 * list_inner_product(a.v, b.v), b.id) AS r FROM lm a JOIN lm b ON a.id <> b.id) WHERE r <= 10)"""


@query(f"WITH {_NEAREST} SELECT x.a AS a, y.a AS b, count(*) AS shared FROM nn x JOIN nn y ON x.b = y.b AND x.a < y.a GROUP BY ALL")
def shared_neighbour_graph(spark, sf_dir):
    near = models.nearest_in_feature_space(_vectors(spark, sf_dir), 10)
    return models.shared_neighbours(near.select("a", "b"))


@query()
def propagated_communities(spark, sf_dir):
    """Rounds of label propagation over all vectors; tested against a loop."""
    near = models.nearest_in_feature_space(_vectors(spark, sf_dir), 10)
    edges = models.shared_neighbours(near.select("a", "b")).where("shared >= 2").withColumnRenamed("shared", "w")
    return models.propagated_labels(edges, 4)


@query()
def principal_component_spread(spark, sf_dir):
    """Variance along each component, free of signs; tested against numpy."""
    p = mixtures.principal_components(_vectors(spark, sf_dir), "v", 3)
    return p.select(F.posexplode("components").alias("component", "value")).groupBy("component").agg(F.round(F.var_samp("value"), 6).alias("variance"))


@query()
def embedding_clusters(spark, sf_dir):
    """k-means from sums; tested against numpy."""
    return mixtures.k_means(_vectors(spark, sf_dir), "v", 8, 7).groupBy("cluster", "label").agg(F.count("*").alias("n"))


def _head(width: int):
    """Fixed weights by formula."""
    i, j, c = np.arange(width)[:, None], np.arange(6)[None, :], np.arange(4)[None, :]
    return ((i * 7 + j * 3) % 11 - 5) / 64.0, np.arange(6) / 8.0, ((np.arange(6)[:, None] * 5 + c) % 7 - 3) / 32.0, np.arange(4) / 16.0


@query()
def head_predictions(spark, sf_dir):
    """A head of two layers over all embeddings; tested against numpy."""
    v = _vectors(spark, sf_dir)
    out = models.mlp_head(v, "v", *_head(64))
    return out.select("id", "predicted", F.round(F.array_max("probabilities"), 6).alias("confidence"))


@query()
def density_clusters(spark, sf_dir):
    """Density clusters of cells; tested against a loop."""
    points = cells(spark, sf_dir).select("sample_id", F.col("cell_id").alias("id"), "x", "y")
    near = joins.near_pairs(points, ["sample_id"], 24.0)
    return models.density_clusters(points, near.select("a", "b"), 3)


@query(f"WITH {CELLS}, s AS (SELECT cell_id, CAST(area AS DOUBLE) AS area, 2.0 * (area + kind) AS perimeter FROM cells) SELECT cell_id, area, round(4 * pi() * area / (perimeter * perimeter), 9) AS circularity FROM s WHERE area >= 4 AND 4 * pi() * area / (perimeter * perimeter) >= 0.1")
def round_shapes(spark, sf_dir):
    s = cells(spark, sf_dir).select("cell_id", F.col("area").cast("double").alias("area"), (2.0 * (F.col("area") + F.col("kind"))).alias("perimeter"))
    return models.shape_filter(s, 4.0, 0.1).select("cell_id", "area", F.round("circularity", 9).alias("circularity"))


def _patients(spark, sf_dir):
    c = cells(spark, sf_dir).groupBy(F.col("patient").alias("label")).agg(F.count("*").alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y"))
    return c.select("label", "n", F.array("x", "y").alias("v"))


@query()
def forced_clusters(spark, sf_dir):
    """Clusters merged, nearest centres first, until five are left; tested against a loop."""
    return models.merge_to_k(_patients(spark, sf_dir), 5)


@query()
def regrouped_clusters(spark, sf_dir):
    """Clusters below the mean size merged into the nearest larger ones, round by round; tested against a loop."""
    c = _patients(spark, sf_dir)
    return models.merge_small(c, c.agg(F.avg("n")).first()[0])


@query()
def louvain_communities(spark, sf_dir):
    """Communities of the shared-neighbour graph by modularity, each connected; tested against a loop and for what modularity gains."""
    near = models.nearest_in_feature_space(_vectors(spark, sf_dir), 10)
    edges = models.shared_neighbours(near.select("a", "b")).where("shared >= 3").withColumnRenamed("shared", "w")
    return communities.louvain(edges, connected=True)


@query()
def mixture_components(spark, sf_dir):
    """A mixture of three Gaussians over the cells' places and areas: each component's size, mean and spread; tested against numpy."""
    rows = cells(spark, sf_dir).select("cell_id", F.array("x", "y", F.col("area").cast("double")).alias("v"))
    fitted = mixtures.fit_mixture(rows, "v", 3, shape="full", rounds=25)
    found = mixtures.mixed(rows, "v", fitted)
    return found.groupBy("component").agg(F.count("*").alias("n"), *(F.round(F.avg(F.get("v", F.lit(i))), 3).alias(f"mean_{c}") for i, c in enumerate(("x", "y", "area"))), F.round(F.avg("share"), 4).alias("sure"))

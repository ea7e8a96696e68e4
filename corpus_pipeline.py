"""A corpus pipeline: toxic documents go, near copies go, benchmark passages go, personal data is
masked, and the rest is cut into pieces.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next
one's documents. Columns beyond doc_id and text pass through as they are, whatever their names; empty
tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import decontaminate, pieces, pii, simhash, toxicity
from tesserae.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold of a model learnt from the labels.

    Null, empty and wordless texts score 0 and stay; of rows that repeat, each is judged; without
    labels of both kinds nothing is learnt and every text scores by the toxic share alone.
    """
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest doc_id.

    Null and empty texts are copies of one another; rows without doc_id come last; of rows with one
    doc_id and text one stays, and different texts under one doc_id are judged each by its text.
    """
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark; null and empty texts stay, and so do all beside an empty benchmark."""
    return decontaminate.drop_hit(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data in their texts replaced by its kind; n_chars is counted anew. Null texts stay null."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def cut_into_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's doc_id, its sampled pieces, their number, and whether they decode to its text.

    Null and empty texts have no pieces; repeated rows are cut alike.
    """
    found = pieces.encode(docs.select("doc_id", "text"))
    return found.select("doc_id", "pieces", F.size("pieces").cast("long").alias("n_pieces"), "lossless")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("pieces", cut_into_pieces),
]

#: SQL can express neither the trained model nor the hashes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into four segments of 16 bits. Fingerprints that differ in two bits or fewer
agree in two segments at least, so there is a table for each pair of segments, six keys a
fingerprint, and whoever meets whom in a table is verified by the whole distance.

A bucket of a table holds what agrees in two segments. Among unrelated texts that is next to nothing,
but the near copies of one text may fill a bucket with any number of different fingerprints, and all
pairs of these would be their square. Buckets of more than `SMALL` fingerprints are therefore split:
their members enumerate the Hamming balls of radius 1 within the bucket's two other segments, 33 keys
each, and meet under whole values. Two members at distance 1 meet under either one's own value, and
two at distance 2 under the value that differs from each of them by one bit. Members that meet so are
two bits apart at most, so one link from each to the smallest keeps the components as they are. No
pair is left out, and nothing is capped.

Nodes are the different fingerprints, never the rows or ids, so texts that share an id by mistake
are not taken for one another.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components
from .common import materialize, table
from .rows import map_lists

SHINGLE = 3
SEED = 42
SEGMENTS = 4
SEGMENT_BITS = 64 // SEGMENTS
#: Two segments each; the tables' keys.
TABLES = tuple(combinations(range(SEGMENTS), 2))
#: Bits in which linked fingerprints may differ.
DISTANCE = 2
#: Fingerprints of a bucket that are compared pair by pair; larger buckets are split.
SMALL = 32
#: Buckets with several fingerprints that are broadcast (24 MB); more go through a shuffle.
MET_ROWS = 1_000_000
#: Keys that a task enumerates, about.
PROBES = 2_000_000
#: Hashes whose bits are summed at a time.
BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text as a signed long; a bit is set if it is set in over half the hashes."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), BLOCK):
        ones += np.unpackbits(hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, th, fp) for every row of `docs`; th is a hash of the text, null for a null text."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.withColumn("th", F.when(F.col("text").isNotNull(), F.xxhash64("text")))
    return map_lists(
        rows, lambda c: {"doc_id": c["doc_id"], "th": c["th"], "fp": [fingerprint(t) for t in c["text"]]}, "doc_id long, th long, fp long"
    )


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask)


def _keys() -> Column:
    """The keys (t, s) of the tables: t the table, s its two segments with all other bits cleared."""
    segment = (1 << SEGMENT_BITS) - 1
    masks = [segment << SEGMENT_BITS * i | segment << SEGMENT_BITS * j for i, j in TABLES]
    return F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(_signed(m)).alias("s")) for t, m in enumerate(masks)))


def _ball() -> Column:
    """By table `t`: fp, and fp with one bit changed in a segment that is not in the table's keys."""
    balls = F.lit(None).cast("array<bigint>")
    for t, pair in enumerate(TABLES):
        bits = [b for i in range(SEGMENTS) if i not in pair for b in range(i * SEGMENT_BITS, (i + 1) * SEGMENT_BITS)]
        balls = F.when(F.col("t") == t, F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(_signed(1 << b)) for b in bits))).otherwise(balls)
    return balls


def links(prints: DataFrame, small: int = SMALL) -> DataFrame:
    """(src, dst) between different fingerprints (fp) two bits apart or less, enough of them to keep all components.

    `prints` has no repeats. Of buckets up to `small` all links are given.
    """
    spark = prints.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), prints.count() * len(TABLES) // PROBES + 1)
    keyed = prints.repartition(tasks, "fp").select("fp", F.explode(_keys()).alias("k")).select("fp", "k.t", "k.s")
    met = materialize(keyed.groupBy("t", "s").agg(F.count("*").alias("n")).where("n > 1"))
    few = met.count() <= MET_ROWS
    members = materialize(keyed.join(F.broadcast(met) if few else met, ["t", "s"]))
    cold = members.where(F.col("n") <= small)
    other = cold.select("t", "s", F.col("fp").alias("dst"))
    apart = F.bit_count(F.col("src").bitwiseXOR(F.col("dst")))
    pairs = cold.select("t", "s", F.col("fp").alias("src")).join(other, ["t", "s"]).where("src < dst").where(apart <= DISTANCE)
    hot = members.where(F.col("n") > small).select("fp", F.explode(_ball()).alias("key")).distinct()
    low = hot.groupBy("key").agg(F.min("fp").alias("src"), F.max("fp").alias("top")).where("src != top")
    stars = hot.join(low.select("key", "src"), "key").select("src", F.col("fp").alias("dst")).where("src != dst").where(apart <= DISTANCE)
    return pairs.select("src", "dst").unionByName(stars).distinct()


def _classes(found: DataFrame) -> DataFrame:
    """(fp, n_class, first, component) of the different fingerprints of `found`; first is the row with the smallest doc_id."""
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", F.col("th").isNull().alias("textless"), "th")
    classes = materialize(found.groupBy("fp").agg(F.min(rank).alias("first"), F.count("*").alias("n_class")))
    linked = components(links(classes.select("fp"))).withColumnRenamed("node", "fp")
    return classes.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_class) for every row of `docs`; its other columns are left out.

    component_id is the smallest doc_id reachable over links of two differing bits or fewer.
    n_class: rows with the same fingerprint. Null and empty texts have the fingerprint zero and link
    like any other; repeated rows are kept, and rows of one doc_id with different texts are judged
    each; rows whose doc_id is null get their component's smallest doc_id, or null where no member
    has one. An empty table gives an empty result.
    """
    found = materialize(fingerprints(docs))
    classes = materialize(_classes(found))
    smallest = classes.groupBy("component").agg(F.min("first.doc_id").alias("component_id"))
    named = classes.join(smallest, "component").select("fp", "n_class", "component_id")
    return found.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_class"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all their columns, with one of each component: the one with its smallest doc_id.

    Null and empty texts are one component; rows without doc_id come after all others. Of different
    texts with that doc_id in one component the one with the smallest hash stays, in other
    components they are judged there; of rows with the same doc_id and text one stays. An empty
    table gives an empty result.
    """
    found = materialize(fingerprints(docs))
    first = _classes(found).groupBy("component").agg(F.min("first").alias("first"))
    kept = materialize(first.select(F.col("first.doc_id").alias("_d"), F.col("first.th").alias("_t")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_d"))
    rows = found.join(kept, same & F.col("th").eqNullSafe(F.col("_t")), "left_semi")
    twice = not rows.groupBy("doc_id", "th").count().where("count > 1").isEmpty()
    text = F.col("text").cast("string")
    hash_ = F.when(text.isNotNull(), F.xxhash64(text))
    out = docs.join(kept, same & hash_.eqNullSafe(F.col("_t")), "left_semi")
    return out.dropDuplicates(["doc_id", "text"]) if twice else out


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))

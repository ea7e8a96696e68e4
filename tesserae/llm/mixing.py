"""Mixing sources to target weights, in blocks of a fixed number of tokens.

A source's documents stand in a pseudorandom order, and their tokens (words between white space) are
packed into blocks of `BLOCK`; only its last block may be shorter. Targets come from the weights: no
source goes beyond `most` times its size, and what it leaves is shared anew by the others' weights.

The mix is a row of slots, `SHARD` to an output shard. Every slot of a shard draws its source with
the targets for probabilities, so that a shard's counts are a multinomial draw. A source's slots are
numbered over the shards; those beyond what its target needs, by chance, are handed to the
sources that chance left short, so that totals hold exactly. Slot number i of a source goes through
a pseudorandom permutation of its block numbers, one for each round through the source, and
slots meet blocks in an equi-join by source and block. A source's last slot is cut where
its target is reached.

Nothing long is gathered: orders are cut into ranges with running sums, draws meet the sources'
shares in an as-of join, and a block meets as many slots as it is taken times.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import latest
from ..operators.ordered import running
from .common import materialize, mix, table
from .rows import map_lists, slices

#: Tokens of a block.
BLOCK = 64
#: Slots of an output shard.
SHARD = 4096
#: Times that a source may be taken.
MOST = 3
WEIGHTS = (1, 2, 3)
#: What separates tokens.
WHITE = " \t\n\x0b\x0c\r"
ROUNDS = 4


def _rounds(left: np.ndarray, right: np.ndarray, half: np.ndarray, key: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
    mask = (np.uint64(1) << half) - np.uint64(1)
    with np.errstate(over="ignore"):
        for r in range(ROUNDS)[:: -1 if back else 1]:
            if back:
                left, right = right ^ (mix(left + mix(key + np.uint64(r))) & mask), left
            else:
                left, right = right, left ^ (mix(right + mix(key + np.uint64(r))) & mask)
    return left, right


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """Where pseudorandom permutations of 0 to n - 1 take i, or, with `back`, what they take there.

    A Feistel network over the least even number of bits that holds n; values beyond n go through it again.
    """
    i, n, key = (np.asarray(v).astype(np.uint64) for v in (i, n, key))
    bits = np.frexp(np.maximum(n.astype(np.float64) - 1, 1))[1]
    half = ((bits + 1) // 2).astype(np.uint64)
    out, todo = i.copy(), np.arange(len(i))
    while len(todo):
        h = half[todo]
        left, right = _rounds(out[todo] >> h, out[todo] & ((np.uint64(1) << h) - np.uint64(1)), h, key[todo], back)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _round_key(seed: int, source: np.ndarray, epoch: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.uint64(seed) + mix(np.asarray(source).astype(np.uint64) * np.uint64(1 << 8) + np.asarray(epoch).astype(np.uint64)))


def needed(number: int, size: int, words: int, block: int, seed: int) -> tuple[int, int]:
    """Slots that a source of `size` words needs to give `words`, and how many words of the last are taken."""
    if not words:
        return 0, 0
    blocks, whole, rest = -(-size // block), words // size, words % size
    if not rest:
        return whole * blocks, block
    # The short block's place in the round that is taken in part.
    key = _round_key(seed, [number], [whole])
    short = int(permuted(np.array([blocks - 1]), np.array([blocks]), key, back=True)[0])
    before = min(-(-rest // block), short)
    if before * block >= rest:
        return whole * blocks + before, rest - (before - 1) * block
    left = rest - before * block - (size - (blocks - 1) * block)  # after the short block, which is next
    if left <= 0:
        return whole * blocks + before + 1, rest - before * block
    more = -(-left // block)
    return whole * blocks + before + 1 + more, left - (more - 1) * block


def word_count(text: Column) -> Column:
    """Tokens of a text; null has none."""
    marks = F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x"), WHITE, "")
    return F.length(marks).cast("long")


@dataclass
class Mixture:
    """What mix() returns.

    sources: (number, lost, source, source_size, weight, target, words, slots, cut), from number 0 on;
    documents: (number, doc_id, draw, size, start), with a row for each document and its place in its source's order;
    spans: (shard, slot, part, number, turn, block, doc_id, draw, start, first, words): a run of words of a
    document in a slot, from its word `first` on, `part` words into the slot.
    """

    sources: DataFrame
    documents: DataFrame
    spans: DataFrame


def _targets(sources: DataFrame, most: int) -> DataFrame:
    """`sources` (source_size, weight) with `target`: shares by weight, `most` times the size at most."""
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    share, weights, capped = total, None, F.lit(False)
    while True:
        done, left = sources.where(capped).agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0], sources.where(~capped).agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
        now = total - most * done, left
        if not left or now == (share, weights):
            break
        share, weights = now
        capped = F.col("source_size").cast("double") * most * weights < F.col("weight").cast("double") * share
    level = F.lit(0.0) if not weights else F.col("weight") * F.lit(float(share)) / F.lit(float(weights))
    return sources.withColumn("target", F.least(level, F.col("source_size").cast("double") * most))


def _sources(rows: DataFrame, weights: tuple[int, ...], most: int, block: int, seed: int) -> DataFrame:
    """The sources' table, numbered in order."""
    sizes = rows.groupBy("lost", "name").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    numbered = running(sizes, [], ["lost", "name"], "one", ["source_size"]).select("lost", "name", "source_size", F.col("before").alias("number"))
    by_turn = F.get(F.array(*(F.lit(w).cast("long") for w in weights)), (F.col("number") % len(weights)).cast("int"))
    told = _targets(materialize(numbered.withColumn("weight", by_turn)), most)
    told = told.withColumn("words", F.floor("target"))

    def run(columns: dict[str, list]) -> dict:
        found = [needed(n, s, w, block, seed) for n, s, w in zip(columns["number"], columns["source_size"], columns["words"], strict=True)]
        return columns | {"slots": [f[0] for f in found], "cut": [f[1] for f in found]}

    return materialize(map_lists(told, run, "lost boolean, name string, source_size long, number long, weight long, target double, words long, slots long, cut long"))


def _drawn(spark: SparkSession, sources: DataFrame, shard: int, seed: int) -> DataFrame:
    """(shard, number, turn): the slots of every shard, with each source's numbered over the shards."""
    shares = materialize(running(sources.where("slots > 0"), [], "number", "slots").select("number", F.col("before").alias("at")))
    slots = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    if not slots:
        return spark.createDataFrame([], "shard long, number long, turn long")
    draws = spark.range(slots).select(F.expr(f"id div {shard}").alias("shard"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(slots)).alias("at"))
    counts = materialize(latest(draws, shares, [], "at", ["number"]).groupBy("shard", "number").agg(F.count("*").alias("drawn")))

    # What was drawn too often, picked by a permutation from all of a source's draws, goes to sources drawn too seldom.
    totals = sources.select("number", "slots").join(counts.groupBy("number").agg(F.sum("drawn").alias("all")), "number", "left").fillna(0, ["all"])
    totals = materialize(totals.withColumn("over", F.greatest(F.col("all") - F.col("slots"), F.lit(0))).withColumn("short", F.greatest(F.col("slots") - F.col("all"), F.lit(0))))
    over = running(totals.where("over > 0"), [], "number", "over", ["slots", "all"]).select("number", "slots", "all", F.col("before").alias("base"))
    short = running(totals.where("short > 0"), [], "number", "short").select(F.col("number").alias("to"), F.col("before").alias("at"))
    ranges = running(counts.join(over.select("number"), "number", "left_semi"), ["number"], "shard", "drawn", ["drawn"])
    picks = ranges.select("shard", "number", F.explode(F.sequence("before", F.col("upto") - 1)).alias("draw")).join(over, "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            number, draw, every, keep, base = (b.column(c).to_numpy() for c in ("number", "draw", "all", "slots", "base"))
            at = permuted(draw, every, _round_key(seed, number, np.full(len(number), 255)))
            gone = np.flatnonzero(at >= keep)
            yield pa.RecordBatch.from_arrays([b.column("shard").take(pa.array(gone)), pa.array(number[gone]), pa.array((base + at - keep)[gone])], ["shard", "number", "at"])

    handed = materialize(latest(picks.mapInArrow(run, "shard long, number long, at long"), short, [], "at", ["to"]))
    changes = handed.select("shard", "number", F.lit(-1).cast("long").alias("drawn")).unionByName(handed.select("shard", F.col("to").alias("number"), F.lit(1).cast("long").alias("drawn")))
    held = counts.unionByName(changes).groupBy("shard", "number").agg(F.sum("drawn").alias("drawn")).where("drawn > 0")
    turns = running(held, ["number"], "shard", "drawn")
    return turns.select("shard", "number", F.explode(F.sequence("before", F.col("upto") - 1)).alias("turn"))


def _placed(turns: DataFrame, sources: DataFrame, block: int, seed: int) -> DataFrame:
    """`turns` with the block that each takes, and how many words of it."""
    few = sources.select("number", F.ceil(F.col("source_size") / block).alias("blocks"), "slots", "cut")
    met = turns.join(few, "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            number, turn, blocks = (b.column(c).to_numpy() for c in ("number", "turn", "blocks"))
            at = permuted(turn % blocks, blocks, _round_key(seed, number, turn // blocks))
            most = np.where(turn == b.column("slots").to_numpy() - 1, b.column("cut").to_numpy(), block)
            yield pa.RecordBatch.from_arrays([b.column("shard"), b.column("number"), b.column("turn"), pa.array(at), pa.array(most)], ["shard", "number", "turn", "block", "most"])

    return met.mapInArrow(run, "shard long, number long, turn long, block long, most long")


def blend(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, shard: int = SHARD, seed: int = 13) -> Mixture:
    """A mix of `docs` (doc_id, text, source) whose sources come to their targets.

    Sources take the weights in turn, by code point, null last. Together the targets are all words there
    are; a source's slots give its target, rounded down to whole words, and take no document more
    than `most` times. Null and empty texts have no words, count among their source's documents and
    are never taken; repeated rows are documents each, and which of them is taken more often is not
    told apart. Draws, orders and permutations come from hashes, so reruns agree, whatever the
    partitions. Empty tables and tables without words give empty spans.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), text, "source").alias("draw"))
    rows = materialize(rows.select("doc_id", "size", "draw", F.col("source").isNull().alias("lost"), F.coalesce("source", F.lit("")).alias("name")))
    sources = _sources(rows, weights, most, block, seed)
    numbered = rows.join(sources.select("lost", "name", "number"), ["lost", "name"]).select("number", "doc_id", "draw", "size")
    documents = materialize(running(numbered, ["number"], ["draw", "doc_id", "size"], "size", ["size"]).select("number", "doc_id", "draw", "size", F.col("before").alias("start")))
    span = documents.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    low, high = F.greatest(F.col("start"), F.col("block") * block), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    pieces = span.select("number", "block", "doc_id", "draw", "start", (low - F.col("block") * block).alias("part"), (low - F.col("start")).alias("first"), (high - low).alias("words"))
    turns = _placed(_drawn(spark, sources, shard, seed), sources, block, seed)
    met = turns.join(pieces, ["number", "block"]).withColumn("words", F.least("words", F.col("most") - F.col("part"))).where("words > 0")
    spans = met.select("shard", F.xxhash64(F.lit(seed), "shard", "number", "turn").alias("slot"), "part", "number", "turn", "block", "doc_id", "draw", "start", "first", "words")
    named = sources.withColumn("source", F.when(~F.col("lost"), F.col("name"))).drop("name")
    return Mixture(named, documents, spans)


def texts(docs: DataFrame, mixture: Mixture, seed: int = 13) -> DataFrame:
    """(shard, slot, number, text): the mix written out, a row for each slot; `slot` orders a shard.

    Words are joined by single spaces. `docs`, and a seed other than the usual, are what blend() was given.
    """
    text = F.col("text").cast("string")
    own = docs.select(F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), text, "source").alias("draw"), text.alias("text")).dropDuplicates(["draw"])
    wanted = mixture.spans.select("shard", "slot", "part", "number", "draw", "first", "words")
    cuts = wanted.groupBy("draw").agg(F.collect_set(F.struct("first", "words")).alias("cuts"))  # one document's spans

    def cut(columns: dict[str, list]) -> Iterator[dict]:
        for draw, whole, asked in zip(columns["draw"], columns["text"], columns["cuts"], strict=True):
            words = [w for w in _split(whole) if w]
            yield {"draw": [draw] * len(asked), "first": [c["first"] for c in asked], "words": [c["words"] for c in asked], "piece": [" ".join(words[c["first"] : c["first"] + c["words"]]) for c in asked]}

    pieces = map_lists(own.join(cuts, "draw"), cut, "draw long, first long, words long, piece string")
    met = wanted.join(pieces, ["draw", "first", "words"])
    return met.groupBy("shard", "slot", "number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "piece"))), lambda p: p["piece"]), " ").alias("text"))  # a block of words at most


def _split(text: str) -> list[str]:
    for c in WHITE[1:]:
        text = text.replace(c, " ")
    return text.split(" ")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix of all documents takes of each."""
    mixture = blend(table(spark, sf_dir, "documents"))
    taken = mixture.spans.groupBy("number", "start").agg(F.sum("words").alias("taken"))
    every = mixture.documents.join(mixture.sources.select("number", "source_size", "target"), "number")
    # Documents without words share their start with the next one.
    met = every.withColumn("start", F.when(F.col("size") > 0, F.col("start"))).join(taken, ["number", "start"], "left")
    return met.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

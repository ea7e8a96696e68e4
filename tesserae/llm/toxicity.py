"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of hashed features of
its different words; a document's score is the noisy-or of them, 1 - prod(1 - p). Only documents carry labels:
the likelihood of these is differentiated through the noisy-or, so the sentences that explain a
label are found by training. The same sentence scores then locate the offending sentences.

The model is fitted on a bounded sample of labelled rows (`TRAIN_DOCS` of each class, and of very long
ones sentences of about `TRAIN_CHARS` code points), drawn by hashes; every text is scored whole.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .rows import add_columns, keep_rows, map_lists

#: Rows of each class that the model is fitted on, about.
TRAIN_DOCS = 2500
#: Of longer texts, sentences of about so many code points are fitted on, drawn by a hash of their places.
TRAIN_CHARS = 50_000
#: Hashed features; the model is one float of 4 bytes for each.
FEATURES = 1 << 20
ROUNDS = 100
RATE = 0.5
#: Weights are drawn to zero by this much a step and training document, so that few features carry the score.
SPARSITY = 1.25e-4
#: Features whose words are in fewer training documents than this are left out.
SEEN_IN = 4
#: Weight of the toxic class in fitting.
TOXIC_SHARE = 0.35
#: Logit of a sentence at the start of fitting; low, as a long clean document has many sentences.
BIAS = -9.0
THRESHOLD = 0.7
#: Words whose weights a task remembers at a time.
REMEMBERED = 300_000
#: Lengths of the word beginnings that are features beside the whole word.
PREFIXES = (3, 4, 5, 6)

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")


def word_features(word: str) -> list[int]:
    """Feature numbers of a lower-case word: the word and its beginnings."""
    raw = word.encode("utf-8", "replace")
    return [zlib.crc32(raw, 1) % FEATURES, *(zlib.crc32(raw[:n], 16 + n) % FEATURES for n in PREFIXES if len(raw) >= n)]


@dataclass
class Model:
    """Weights of the features, and the logit of a sentence without any."""

    weights: np.ndarray
    bias: float


class WordWeights(dict):
    """Weights of words, worked out when first asked for."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = float(self.model.weights[word_features(word)].sum())
        return value


def sentences(text: str | None, weights: WordWeights) -> list[tuple[int, int, float]]:
    """(start, end, logit) of every sentence with words; code points."""
    out = []
    low = (text or "").lower()
    for m in _SENTENCE.finditer(low):
        if words := _WORD.findall(m[0]):
            out.append((m.start(), m.end(), weights.model.bias + sum(map(weights.__getitem__, dict.fromkeys(words)))))
    return out


def noisy_or(logits: list[float]) -> float:
    """1 - prod(1 - p) of sentence logits; 0 for none."""
    total = 0.0
    for z in logits:
        total += z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))
    return -math.expm1(-total)


def _bags(columns: dict[str, list]) -> dict[str, list]:
    """The different words of training texts' sentences, one sentence after the other."""
    out: dict[str, list] = {"doc_id": columns["doc_id"], "toxic": columns["toxic"], "sizes": [], "words": []}
    for text in columns["text"]:
        part = TRAIN_CHARS / max(1, len(text or ""))
        found = (m for m in _SENTENCE.finditer((text or "").lower()) if part >= 1 or zlib.crc32(b"%d" % m.start()) < part * 2**32)
        own = [list(dict.fromkeys(_WORD.findall(m[0]))) for m in found]
        out["sizes"].append([len(x) for x in own if x])
        out["words"].append([w for x in own for w in x])
    return out


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = TRAIN_DOCS) -> Model:
    """Fit on labelled rows with crc32(doc_id as text) mod 3 other than 1.

    Of a doc_id labelled more than once, any toxic label counts; null labels are left out. Without
    rows of both classes the model has no features, and a sentence's logit is that of the toxic share.
    """
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    empty = Model(np.zeros(FEATURES, dtype=np.float32), math.log((share + 1e-3) / (1 - share + 1e-3)))
    if len(counts) < 2:
        return empty
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    part = F.when(F.col("toxic") == 1, sample_docs / counts[1]).otherwise(sample_docs / counts[0])
    chosen = F.broadcast(known.where(draw < part))  # about 2 * sample_docs rows of 12 bytes
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    bags = map_lists(texts.join(chosen, "doc_id"), _bags, "doc_id long, toxic int, sizes array<int>, words array<string>").where("size(words) > 0").toArrow()
    bags = bags.combine_chunks().sort_by("doc_id")
    if not bags.num_rows:
        return empty
    sizes = bags["sizes"].combine_chunks()
    words = bags["words"].combine_chunks().flatten().dictionary_encode()
    return fit(bags["toxic"].to_numpy(), np.diff(sizes.offsets.to_numpy()), sizes.flatten().to_numpy(), words.indices.to_numpy(), words.dictionary.to_pylist())


def fit(y: np.ndarray, per_doc: np.ndarray, per_sentence: np.ndarray, word: np.ndarray, vocabulary: list[str]) -> Model:
    """Maximise the bags' likelihood by Adagrad with soft thresholding.

    y: labels; per_doc: sentences of each; per_sentence: words of each; word: their places in the
    vocabulary. A word's weight is the sum of its features', so sums go over words first.
    """
    own = [word_features(w) for w in vocabulary]
    entry_word = np.repeat(np.arange(len(own)), [len(x) for x in own])
    known, feature = np.unique(np.array([f for x in own for f in x]), return_inverse=True)
    del own
    sentence = np.repeat(np.arange(len(per_sentence)), per_sentence)
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    pairs = np.unique(word.astype(np.int64) * len(per_doc) + doc[sentence]) // len(per_doc)
    often = np.bincount(feature, np.bincount(pairs, minlength=len(vocabulary))[entry_word], len(known)) >= SEEN_IN
    used = often[feature]
    feature, entry_word, known = (np.cumsum(often) - 1)[feature[used]], entry_word[used], known[often]
    first = np.concatenate(([0], np.cumsum(per_doc)[:-1]))
    weight = np.where(y == 1, TOXIC_SHARE / max(1, (y == 1).sum()), (1 - TOXIC_SHARE) / max(1, (y == 0).sum())) * len(y)
    theta, bias = np.zeros(len(known)), BIAS
    seen, seen_bias = np.full(len(known), 1e-6), 1e-6
    for _ in range(ROUNDS):
        by_word = np.bincount(entry_word, theta[feature], len(vocabulary))
        z = np.clip(bias + np.bincount(sentence, by_word[word], len(per_sentence)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        none = np.exp(np.add.reduceat(-np.logaddexp(0, z), first))
        slope = (np.where(y == 1, none / np.maximum(1 - none, 1e-9), -1.0) * weight)[doc] * p
        g = np.bincount(feature, np.bincount(word, slope[sentence], len(vocabulary))[entry_word], len(known))
        gb = slope.sum()
        seen += g * g
        seen_bias += gb * gb
        step = RATE / np.sqrt(seen)
        theta += step * g
        theta = np.sign(theta) * np.maximum(np.abs(theta) - step * SPARSITY * len(y), 0)
        bias = min(-1.0, bias + RATE * gb / math.sqrt(seen_bias))
    weights = np.zeros(FEATURES, dtype=np.float32)
    weights[known] = theta
    return Model(weights, float(bias))


SCORED = "score double, worst_start long, worst_end long, worst_score double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of every row of `docs`, after its own columns but for text.

    score: the noisy-or; worst_start, worst_end, worst_score: the sentence most likely to offend, in
    code points, null where there are no words. Null, empty and wordless texts score 0; repeated
    rows are scored each; columns of `docs` with these names give way. Of a text that changes length
    in lower case the positions are of its lower case. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 4 MB, whatever the input
    held: list[WordWeights] = []

    def run(columns: dict[str, list]) -> dict[str, list]:
        if not held:
            held.append(WordWeights(shared.value))
        out: dict[str, list] = {"score": [], "worst_start": [], "worst_end": [], "worst_score": []}
        for text in columns["text"]:
            found = sentences(text, held[0])
            start, end, top = max(found, key=lambda x: x[2], default=(None, None, None))
            out["score"].append(noisy_or([z for *_, z in found]))
            out["worst_start"].append(start)
            out["worst_end"].append(end)
            out["worst_score"].append(None if top is None else 1 / (1 + math.exp(-max(top, -700))))
        return out

    return add_columns(docs, run, SCORED, ["text"], drop=["text"])


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """`docs`, all its columns, without the rows that score `threshold` or more.

    Null, empty and wordless texts stay; repeated rows are judged each; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    held: list[WordWeights] = []

    def test(texts: list) -> list[bool]:
        if not held:
            held.append(WordWeights(shared.value))
        return [noisy_or([z for *_, z in sentences(t, held[0])]) < threshold for t in texts]

    return keep_rows(docs, test)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "worst_start", "worst_end", "worst_score"
    )

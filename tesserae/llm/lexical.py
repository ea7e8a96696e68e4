"""Ranked lexical search by range maxima.

Texts are read once, for each document's length and its occurrences of the items' terms; documents
stay dealt as they are, and their counts give the weights. Each task then takes its documents in
shards, ordered by id. A shard has a posting list for every term (documents and impacts) and a
sparse table of range maxima for every list, so that the greatest impact of a term in any interval
of documents takes two look-ups. An interval's bound is the sum of its terms' greatest impacts, times
their weights. An item begins with the whole shard for its interval. The intervals with the highest
bounds are taken first, each split at the document that the largest summand comes from; that document
is scored, and what lies before and after it become intervals with bounds of their own. An interval
whose bound stays under the item's k-th score so far goes, and one with `LEAF` postings or fewer is
scored whole. Scores carry over to a task's next shards; the best of all tasks are ranked at the end.

Items go out in rounds of about `ROUND_BYTES` of text, which bounds what is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table
from .decontaminate import BLOCK, Block
from .rows import map_lists, slices

K = 10
#: Text of the items of one round.
ROUND_BYTES = 8 << 20
#: Postings of a shard, or those of one document.
SHARD = 1 << 19
#: An interval with so few postings is scored whole.
LEAF = 256
#: Intervals of an item that are split at a time, at most.
WIDTH = 256
#: Pairs of interval and term that are looked up at a time.
PAIRS = 1 << 18
_NONE = -(1 << 63)
_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_SPACES = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def parts(raw: bytes) -> Iterator[bytes]:
    """A text in parts of about BLOCK bytes, cut between words."""
    if len(raw) <= BLOCK:
        yield raw
        return
    spaced, at = raw.translate(_SPACES), 0
    while at < len(raw):
        cut = spaced.find(b" ", at + BLOCK)
        cut = len(raw) if cut < 0 else cut
        yield raw[at:cut]
        at = cut


def blocks(texts: list) -> Iterator[tuple[np.ndarray, Block]]:
    """(text numbers, block) of the parts of texts, in blocks of about BLOCK bytes; null texts have none."""
    own, held, size = [], [], 0
    for i, t in enumerate(texts):
        for raw in parts(t.encode("utf-8", "replace")) if isinstance(t, str) else ():
            if held and size + len(raw) > BLOCK:
                yield np.array(own), Block(held)
                own, held, size = [], [], 0
            own.append(i)
            held.append(raw)
            size += len(raw)
    if held:
        yield np.array(own), Block(held)


def _same(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether `size` bytes of a from `at` on are those of b from `bt` on; both end in eight spare bytes."""
    out = np.ones(len(at), bool)
    x, y = (np.lib.stride_tricks.sliding_window_view(v, 8) for v in (a, b))
    for k in range(0, int(size.max(initial=0)), 8):
        left = np.flatnonzero(out & (size > k))
        bytes_ = np.arange(8) < (size[left] - k)[:, None]
        out[left] = ((x[at[left] + k] == y[bt[left] + k]) | ~bytes_).all(1)
    return out


class Vocabulary:
    """The different words of some texts, by number."""

    def __init__(self, words: set[bytes]) -> None:
        block = Block(sorted(words))
        order = np.argsort(block.hash, kind="stable")
        self.hash, self.start = block.hash[order], block.start[order]
        self.size = block.end[order] - self.start
        self.bytes = np.frombuffer(block.raw + b" " * 8, dtype=np.uint8)
        same = np.flatnonzero(np.concatenate(([True], self.hash[1:] != self.hash[:-1], [True]))) if len(order) else np.zeros(1, int)
        self.alike = int(np.diff(same).max(initial=0))

    def __len__(self) -> int:
        return len(self.hash)

    def find(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Places of the block's words that are of this vocabulary, and their numbers; hashes find them, bytes confirm."""
        if not len(self) or not len(block.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.searchsorted(self.hash, block.hash)
        raw = np.frombuffer(block.raw + b" " * 8, dtype=np.uint8)
        size = block.end - block.start
        places, numbers = [], []
        for step in range(self.alike):
            number = np.minimum(first + step, len(self) - 1)
            at = np.flatnonzero((self.hash[number] == block.hash) & (self.size[number] == size) & (first + step < len(self)))
            number = number[at]
            at_, number_ = (v[_same(raw, block.start[at], self.bytes, self.start[number], size[at])] for v in (at, number))
            places.append(at_)
            numbers.append(number_)
        return np.concatenate(places), np.concatenate(numbers)


def words_of(text: str) -> list[bytes]:
    """A text's words in order."""
    out: list[bytes] = []
    for _, block in blocks([text]):
        out += block.raw.split()
    return out


class Items:
    """One round's items: their terms with repeats, by item."""

    def __init__(self, texts: list) -> None:
        lists = [words_of(t) for t in texts]
        self.vocabulary = Vocabulary({w for ws in lists for w in ws})
        item, term = [], []
        for i, ws in enumerate(lists):
            if ws:
                block = Block([b" ".join(ws)])
                places, numbers = self.vocabulary.find(block)
                item.append(np.full(len(numbers), i))
                term.append(numbers)
        n = max(1, len(self.vocabulary))
        pairs, repeats = np.unique(np.concatenate(item) * n + np.concatenate(term), return_counts=True) if item else (np.zeros(0, np.int64),) * 2
        self.n, self.item, self.term, self.repeats = len(texts), pairs // n, pairs % n, repeats


def _postings(columns: dict[str, list], vocabulary: Vocabulary) -> dict:
    """(doc_id, n, terms, tfs) of the documents with words."""
    texts, v = columns["text"], max(1, len(vocabulary))
    n = np.zeros(len(texts), np.int64)
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for own, block in blocks(texts):
        np.add.at(n, own, np.diff(block.first))
        at, term = vocabulary.find(block)
        key, count = np.unique(own[block.text[at]] * v + term, return_counts=True)
        keys.append(key)
        counts.append(count)
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    tf = np.zeros(len(key), np.int64)
    np.add.at(tf, place, np.concatenate(counts))
    cut = np.searchsorted(key, np.arange(len(texts) + 1) * v)
    term, has = (key % v).astype(np.int32), np.flatnonzero(n).tolist()
    return {"doc_id": [columns["doc_id"][i] for i in has], "n": n[has], "terms": [term[cut[i] : cut[i + 1]] for i in has], "tfs": [tf[cut[i] : cut[i + 1]] for i in has]}


def norms(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents of n terms."""
    if int(n.max(initial=0)) * 75 * documents < 2**63:
        return 25 + (75 * n * documents) // max(1, total)
    return np.array([25 + 75 * int(x) * documents // total for x in n], dtype=np.int64)


class Shard:
    """Posting lists of a shard's documents, each with its sparse table of range maxima; they stand side by side."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """`doc` are places in `ids`, which is sorted."""
        self.ids, self.docs = ids, len(ids)
        self.terms, local = np.unique(term, return_inverse=True)
        key = local * self.docs + doc
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.impact = ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))[order]
        longest = int(np.bincount(local).max(initial=1))
        self.best = np.zeros((longest.bit_length(), len(key)), dtype=np.int32)
        self.best[0] = np.arange(len(key))
        for level in range(1, len(self.best)):
            half, n = 1 << (level - 1), len(key) - (1 << level) + 1
            a, b = self.best[level - 1, :n], self.best[level - 1, half : half + n]
            self.best[level, :n] = np.where(self.impact[b] > self.impact[a], b, a)

    def greatest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Places of the greatest impacts of postings low to high, none of which is empty."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        a, b = self.best[level, low], self.best[level, high - (1 << level.astype(np.int64))]
        return np.where(self.impact[b] > self.impact[a], b, a)


class Search:
    """The best documents of every item so far, over any number of shards."""

    def __init__(self, items: Items, weights: np.ndarray, k: int) -> None:
        """weights: of each term of the vocabulary; terms that weigh nothing add nothing."""
        weight = items.repeats * weights[items.term]
        keep = weight > 0
        self.item, self.term, self.weight, self.k = items.item[keep], items.term[keep], weight[keep], k
        self.got = [np.zeros(0, np.int64)] * 3  # item, score, doc_id
        self.least = np.zeros(items.n, np.int64)
        self.last = np.full(items.n, np.iinfo(np.int64).max)
        self.scored = 0

    def add(self, item: np.ndarray, score: np.ndarray, doc_id: np.ndarray) -> None:
        keep = (score > 0) & (score >= self.least[item])
        item, score, doc_id = (np.concatenate((old, new[keep])) for old, new in zip(self.got, (item, score, doc_id), strict=True))
        order = np.lexsort((doc_id, -score, item))
        item, score, doc_id = item[order], score[order], doc_id[order]
        nth = np.arange(len(item)) - np.searchsorted(item, item)
        full = nth == self.k - 1
        self.least[item[full]], self.last[item[full]] = score[full], doc_id[full]
        self.got = [v[nth < self.k] for v in (item, score, doc_id)]

    def over(self, shard: Shard) -> None:
        """Adds a shard's documents."""
        if not len(shard.key) or not len(self.term):
            return
        local = np.minimum(np.searchsorted(shard.terms, self.term), len(shard.terms) - 1)
        has = shard.terms[local] == self.term
        items, first, sizes = np.unique(self.item[has], return_index=True, return_counts=True)
        one = _OneShard(shard, local[has] * shard.docs, self.weight[has], first, sizes)
        number = np.arange(len(items))
        front = [number, np.zeros(len(items), np.int64), np.full(len(items), shard.docs), *one.bounds(number, np.zeros(len(items), np.int64), np.full(len(items), shard.docs))]
        width = 1
        while len(front[0]):
            item, low, _, bound, _, _ = front
            own = items[item]
            alive = (bound > 0) & ((bound > self.least[own]) | ((bound == self.least[own]) & (shard.ids[low] <= self.last[own])))
            front = [v[alive] for v in front]
            item, bound = front[0], front[3]
            order = np.lexsort((-bound, item))
            nth = np.zeros(len(item), np.int64)
            nth[order] = np.arange(len(item)) - np.searchsorted(item[order], item[order])
            now, width = nth < width, min(WIDTH, 2 * width)
            item, low, high, _, count, split = (v[now] for v in front)
            front = [v[~now] for v in front]
            small = count <= LEAF
            got = [one.leaves(item[small], low[small], high[small])]
            item, low, high, split = (v[~small] for v in (item, low, high, split))
            got.append((item, split, one.scores(item, split)))
            self.scored += sum(len(g[0]) for g in got)
            for i, doc, score in got:
                self.add(items[i], score, shard.ids[doc])
            child = [np.concatenate(v) for v in ((item, item), (low, split + 1), (split, high))]
            child = [v[child[1] < child[2]] for v in child]
            front = [np.concatenate(v) for v in zip(front, [*child, *one.bounds(*child)], strict=True)]


class _OneShard:
    """A shard with the items' terms in it: those of item i are first[i] to first[i] + sizes[i]."""

    def __init__(self, shard: Shard, base: np.ndarray, weight: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> None:
        self.shard, self.base, self.weight, self.first, self.sizes = shard, base, weight, first, sizes

    def _pieces(self, item: np.ndarray) -> Iterator[slice]:
        """Slices of `item` with about PAIRS terms."""
        ends, at = np.cumsum(self.sizes[item]), 0
        while at < len(item):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
            yield slice(at, to)
            at = to

    def _pairs(self, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in `item`, term) of every item's terms, and where each item's begin."""
        sizes = self.sizes[item]
        begin = np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(item)), sizes)
        return of, np.arange(len(of)) - begin[of] + self.first[item][of], begin

    def bounds(self, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bound, postings, document to split at) of intervals."""
        out = [(np.zeros(0, np.int64),) * 3]
        for part in self._pieces(item):
            of, term, begin = self._pairs(item[part])
            a, b = (np.searchsorted(self.shard.key, self.base[term] + v[part][of]) for v in (low, high))
            some = np.flatnonzero(b > a)
            summand, doc = np.zeros(len(of), np.int64), np.full(len(of), -1)
            best = self.shard.greatest(a[some], b[some])
            summand[some] = self.weight[term[some]] * self.shard.impact[best]
            doc[some] = self.shard.key[best] - self.base[term[some]]
            largest = np.maximum.reduceat(summand, begin)
            top = np.flatnonzero(summand == largest[of])
            _, at = np.unique(of[top], return_index=True)
            out.append((np.add.reduceat(summand, begin), np.add.reduceat(b - a, begin), doc[top[at]]))
        return tuple(np.concatenate(v) for v in zip(*out, strict=True))

    def scores(self, item: np.ndarray, doc: np.ndarray) -> np.ndarray:
        out = [np.zeros(0, np.int64)]
        for part in self._pieces(item):
            of, term, begin = self._pairs(item[part])
            key = self.base[term] + doc[part][of]
            at = np.minimum(np.searchsorted(self.shard.key, key), len(self.shard.key) - 1)
            out.append(np.add.reduceat(np.where(self.shard.key[at] == key, self.weight[term] * self.shard.impact[at], 0), begin))
        return np.concatenate(out)

    def leaves(self, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, document, score) of all documents with postings in intervals."""
        out = [(np.zeros(0, np.int64),) * 3]
        for part in self._pieces(item):
            of, term, _ = self._pairs(item[part])
            a, b = (np.searchsorted(self.shard.key, self.base[term] + v[part][of]) for v in (low, high))
            n = b - a
            pair = np.repeat(np.arange(len(of)), n)
            place = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + a[pair]
            key = of[pair] * self.shard.docs + self.shard.key[place] - self.base[term[pair]]
            order = np.argsort(key, kind="stable")
            key, summand = key[order], (self.weight[term[pair]] * self.shard.impact[place])[order]
            if len(key):
                new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                out.append((item[part][key[new] // self.shard.docs], key[new] % self.shard.docs, np.add.reduceat(summand, new)))
        return tuple(np.concatenate(v) for v in zip(*out, strict=True))


def _shards(batches: Iterator[pa.RecordBatch], documents: int, total: int, most: int) -> Iterator[Shard]:
    """Shards of rows (doc_id, n, terms, tfs)."""
    held, size = [], 0

    def shard() -> Shard:
        ids, n, counts, term, tf = (np.concatenate(v) for v in zip(*held, strict=True))
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        return Shard(ids[order], norms(n, documents, total)[order], np.repeat(place, counts), term, tf)

    for b in slices(batches):
        terms, tfs = b.column("terms"), b.column("tfs")
        counts = np.diff(terms.offsets.to_numpy())
        held.append((b.column("doc_id").fill_null(_NONE).to_numpy(zero_copy_only=False), b.column("n").to_numpy(), counts, terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy()))
        size += int(counts.sum())
        if size >= most:
            yield shard()
            held, size = [], 0
    if held:
        yield shard()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def rank(docs: DataFrame, items: DataFrame, k: int = K, round_bytes: int = ROUND_BYTES, shard: int = SHARD) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k highest-scoring documents, ties by ascending doc_id.

    `docs` has doc_id and text, `items` item_id and text. Documents without terms (null, empty, or all
    separators) don't count; items without any have no rows, nor have documents that score 0. Rows that
    repeat a doc_id are documents each; a null doc_id comes first among equals. Equal item rows are one
    item, different texts under one item_id are ranked each. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = materialize(items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").distinct())
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-size // round_bytes))
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")

    def one(number: int) -> DataFrame:
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == number).toArrow()  # round_bytes, about
        own = own.sort_by([("item_id", "ascending"), ("text", "ascending")])
        mine = Items(own["text"].to_pylist())
        words = spark.sparkContext.broadcast(mine.vocabulary)
        found = materialize(map_lists(rows, lambda columns: _postings(columns, words.value), "doc_id long, n long, terms array<int>, tfs array<long>"))
        documents, total = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        counts = found.select(F.explode("terms").alias("term")).groupBy("term").count().toPandas()  # a row for each term of the round
        weights = np.zeros(len(mine.vocabulary), np.int64)
        weights[counts["term"].to_numpy(dtype=np.int64)] = [weight(documents, n) for n in counts["count"].tolist()]
        shared = spark.sparkContext.broadcast((mine, weights))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = Search(*shared.value, k)
            for s in _shards(batches, documents, total, shard):
                search.over(s)
            item, score, doc_id = search.got
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc_id, pa.int64(), mask=doc_id == _NONE), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

        scored = found.mapInArrow(run, "item long, doc_id long, score long")
        top = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        named = spark.createDataFrame(own.select(["item_id"]).append_column("item", pa.array(range(own.num_rows), pa.int64())))
        return top.join(named, "item").select("item_id", "rank", "doc_id", "score")

    return reduce(DataFrame.unionByName, map(one, range(rounds)))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP11_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT count(*) AS N, CAST(sum(len(w)) AS BIGINT) AS L FROM d WHERE len(w) > 0),
q AS (SELECT item_id, t, count(*) AS r FROM (SELECT item_id, unnest({_WORDS}) AS t FROM benchmark) GROUP BY ALL),
tf AS (SELECT doc_id, t, count(*) AS tf, any_value(size) AS size FROM (SELECT doc_id, len(w) AS size, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t),
df AS (SELECT t, CAST(floor(1000 * ln((2 * N + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY t, N),
sc AS (
  SELECT item_id, doc_id, CAST(sum(r * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + CAST((75 * size * N) // L AS BIGINT))))) AS BIGINT) AS score
  FROM q JOIN tf USING (t) JOIN df USING (t), s GROUP BY item_id, doc_id),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM sc WHERE score > 0)
SELECT * FROM k WHERE rank <= 10
"""

"""Benchmark decontamination by winnowing.

Every run of ten item words is a window. A window's fingerprint is the minimum hash of its six
5-word grams, so equal windows have equal fingerprints, and a shared span of ten words or more
always shares one. Documents are winnowed the same way, which leaves a fingerprint for every few
words; these are joined with the benchmark's, and each hit is extended to the whole windows it stands
for, which are joined by their digests of all ten words. Items with fewer than ten words are one
shorter window, with the hash of their first gram (of all their words, below five) for a fingerprint.

Documents are read once, whatever the benchmark's size. Up to `FEW` windows of a length, their
hashes are sent to the tasks, and only hits leave these; beyond, all fingerprints of the documents go
through a shuffle, and the documents with hits are read again for their windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Rolling, materialize, mix, sliding_min, splitmix, table
from .rows import map_lists

WINDOW = 10
GRAM = 5
#: Windows of one length whose hashes are broadcast (16 bytes each, ten lengths at most).
FEW = 500_000
#: Bytes of text handled at a time; a longer text is cut, with nine words in common.
BLOCK = 1 << 19

_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[0x80:] = np.arange(0x80, 0x100)
for _a, _b, _to in ((0x30, 0x39, 0x30), (0x61, 0x7A, 0x61), (0x41, 0x5A, 0x61)):
    _CLASS[_a : _b + 1] = np.arange(_to, _to + _b - _a + 1)
#: Lower-cases A-Z and turns every byte outside words into a space.
_LOWER = bytes(int(x) or 0x20 for x in _CLASS)
_PLACE = splitmix(WINDOW, 11) | np.uint64(1)
_ROLL = Rolling()


class Block:
    """Word boundaries and hashes of several texts in one buffer."""

    def __init__(self, texts: list[bytes]) -> None:
        data = b" ".join([*texts, b""])
        self.raw = data.translate(_LOWER)
        x = np.frombuffer(self.raw, dtype=np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], x != 0x20, [False])).view(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        self.hash = _ROLL.slices(_ROLL.prefix(x), self.start, self.end)
        ends = np.cumsum([len(t) + 1 for t in texts])
        #: Words of text i: first[i] to first[i + 1].
        self.first = np.concatenate(([0], np.searchsorted(self.start, ends)))
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def grams(self, n: int) -> np.ndarray:
        """Hashes of every n successive words."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64)
        total = self.hash[:m] * _PLACE[0]
        for i in range(1, n):
            total = total + self.hash[i : i + m] * _PLACE[i]
        return mix(total)

    def whole(self, n: int) -> np.ndarray:
        """Whether n successive words, from each first one on, are of one text."""
        m = max(0, len(self.hash) - n + 1)
        return self.text[:m] == self.text[n - 1 : n - 1 + m]

    def winnow(self) -> tuple[np.ndarray, np.ndarray]:
        """First words and fingerprints of all windows of ten words."""
        if len(self.hash) < WINDOW:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        low = sliding_min(self.grams(GRAM), WINDOW - GRAM + 1)
        at = np.flatnonzero(self.whole(WINDOW))
        return at, low[at]

    def prints(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and fingerprints, as longs, of all windows of n words, ten or fewer."""
        if n == WINDOW:
            at, low = self.winnow()
            return at, low.view(np.int64)
        at = np.flatnonzero(self.whole(n))
        return at, self.grams(min(n, GRAM))[at].view(np.int64)

    def digest(self, at: int, n: int) -> bytes:
        """A digest of n words from `at` on."""
        return hashlib.md5(b" ".join(self.raw[self.start[at] : self.end[at + n - 1]].split())).digest()


def _windows(columns: dict[str, list]) -> Iterator[dict]:
    """The windows of items: number of words, fingerprint, hash and digest of all words."""
    for item, text in zip(columns["item_id"], columns["text"], strict=True):
        block = Block([text.encode("utf-8", "replace") if isinstance(text, str) else b""])
        n = min(WINDOW, len(block.hash))
        if n:
            at, fp = block.prints(n)
            digests = [block.digest(s, n) for s in at.tolist()]
            yield {"item_id": [item] * len(at), "n": [n] * len(at), "fp": fp, "whole": block.grams(n)[at].view(np.int64), "digest": digests}


def _pieces(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """(words before, bytes) of a text's pieces of about BLOCK bytes; each repeats the last nine words of the one before."""
    if len(raw) <= BLOCK:
        yield 0, raw
        return
    low = raw.translate(_LOWER)
    at = before = 0
    while True:
        cut, starts = at, np.zeros(0, np.int64)
        while cut < len(low) and len(starts) < WINDOW:
            cut = low.find(b" ", cut + BLOCK)
            cut = len(low) if cut < 0 else cut
            x = np.frombuffer(low[at:cut], dtype=np.uint8) != 0x20
            starts = np.flatnonzero(x & ~np.concatenate(([False], x[:-1])))
        yield before, low[at:cut]
        if cut == len(low):
            return
        before += len(starts) - WINDOW + 1
        at += int(starts[len(starts) - WINDOW + 1])


def _blocks(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray, Block]]:
    """(text numbers, words before, block) of the pieces of texts, in blocks of about BLOCK bytes."""
    own, before, held, size = [], [], [], 0
    for i, t in enumerate(texts):
        for words, raw in _pieces(t.encode("utf-8", "replace") if isinstance(t, str) else b""):
            if held and size + len(raw) > BLOCK:
                yield np.array(own), np.array(before), Block(held)
                own, before, held, size = [], [], [], 0
            own.append(i)
            before.append(words)
            held.append(raw)
            size += len(raw)
    if held:
        yield np.array(own), np.array(before), Block(held)


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether values are among `known`, which is sorted."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)


#: A document's row has n_words alone; a window's has s, n and digest; a fingerprint's has s, last, n and fp.
FOUND = "doc_id long, h long, n_words long, n int, s long, last long, fp long, digest binary"


def _found(size: int, **columns) -> dict:
    return {name: columns.get(name, [None] * size) for name in ("doc_id", "h", "n_words", "n", "s", "last", "fp", "digest")}


def _search(columns: dict[str, list], marks: dict[int, tuple[np.ndarray, np.ndarray] | None]) -> Iterator[dict]:
    """Rows of FOUND of the documents in `columns`; marks: the benchmark's fingerprints and windows by length, None for too many."""
    doc_id, h = columns["doc_id"], columns["h"]
    n_words = np.zeros(len(doc_id), np.int64)
    for own, before, block in _blocks(columns["text"]):
        np.maximum.at(n_words, own, before + np.diff(block.first))

        def rows(at: np.ndarray, own=own, before=before, block=block, **more) -> dict:
            t = block.text[at]
            place = at - block.first[t] + before[t]
            return _found(len(at), doc_id=[doc_id[i] for i in own[t]], h=[h[i] for i in own[t]], s=place, **more)

        for n, known in marks.items():
            at, fp = block.prints(n)
            if known:
                at = at[_within(fp, known[0])]
                at = at[_within(block.grams(n)[at].view(np.int64), known[1])] if len(at) else at
                if len(at):
                    yield rows(at, n=[n] * len(at), digest=[block.digest(s, n) for s in at.tolist()])
            elif len(at):
                cut = (fp[1:] != fp[:-1]) | (np.diff(at) != 1) | (block.text[at[1:]] != block.text[at[:-1]])
                new = np.flatnonzero(np.concatenate(([True], cut)))
                run = np.diff(np.concatenate((new, [len(at)])))
                out = rows(at[new], n=[n] * len(new), fp=fp[new])
                yield out | {"last": out["s"] + run - 1}
    yield _found(len(doc_id), doc_id=doc_id, h=h, n_words=n_words)


def _marks(bench: DataFrame, few: int) -> dict[int, tuple[np.ndarray, np.ndarray] | None]:
    sizes = {r["n"]: r["size"] for r in bench.groupBy("n").agg(F.countDistinct("whole").alias("size")).collect()}  # ten rows at most
    out: dict[int, tuple[np.ndarray, np.ndarray] | None] = {}
    for n, size in sorted(sizes.items()):
        out[n] = None
        if size <= few:
            own = bench.where(F.col("n") == n)
            out[n] = tuple(np.sort(own.select(c).distinct().toPandas()[c].to_numpy()) for c in ("fp", "whole"))
    return out


def _refetched(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Windows (doc_id, h, s, n, digest) of the runs in `hits` (doc_id, h, n, s, last), read again from the documents."""
    runs = hits.groupBy("doc_id", "h").agg(F.collect_list(F.struct("n", "s", "last")).alias("runs"))

    def fetch(columns: dict[str, list]) -> Iterator[dict]:
        asked = [{} for _ in columns["runs"]]
        for own, found in zip(asked, columns["runs"], strict=True):
            for r in found:
                own.setdefault(r["n"], []).append((r["s"], r["last"]))
        for own, before, block in _blocks(columns["text"]):
            for t, i in enumerate(own.tolist()):
                words = int(block.first[t + 1] - block.first[t])
                for n, spans in asked[i].items():
                    starts = [s - int(before[t]) for a, b in spans for s in range(a, b + 1) if 0 <= s - before[t] <= words - n]
                    if starts:
                        digests = [block.digest(int(block.first[t]) + s, n) for s in starts]
                        place = [s + int(before[t]) for s in starts]
                        yield _found(len(starts), doc_id=[columns["doc_id"][i]] * len(starts), h=[columns["h"][i]] * len(starts), n=[n] * len(starts), s=place, digest=digests)

    met = rows.join(runs, rows["doc_id"].eqNullSafe(runs["doc_id"]) & (rows["h"] == runs["h"])).select(rows["doc_id"], rows["h"], "text", "runs")
    return map_lists(met, fetch, FOUND)


def _true_windows(docs: DataFrame, benchmark: DataFrame, few: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What _search() found, the documents' windows (doc_id, h, s, n, digest) that are the benchmark's, and its windows."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    bench = materialize(map_lists(items, _windows, "item_id string, n int, fp long, whole long, digest binary").distinct())
    marks = _marks(bench, few)
    shared = spark.sparkContext.broadcast(marks)  # ten lengths of `few` windows at most
    found = materialize(map_lists(rows, lambda columns: _search(columns, shared.value), FOUND))
    windows = found.where("digest is not null")
    if None in marks.values():
        prints = found.where("fp is not null")
        hits = materialize(prints.join(bench.select("n", "fp").distinct(), ["n", "fp"], "left_semi").select("doc_id", "h", "n", "s", "last"))
        windows = windows.unionByName(_refetched(rows, hits))
    windows = windows.select("doc_id", "h", "s", "n", "digest").distinct()
    return found, windows.join(bench.select("digest").distinct(), "digest", "left_semi"), bench


def find_shared(docs: DataFrame, benchmark: DataFrame, few: int = FEW) -> DataFrame:
    """(doc_id, n_words, spans, items) for every row of `docs`; its other columns are left out.

    spans: disjoint ranges of word numbers, end exclusive, that windows of the benchmark cover;
    items: ids, as strings, of the items those windows belong to. Null and empty texts have no
    words; an empty benchmark hits nothing; rows that repeat a doc_id are kept and judged each
    by its text; rows without doc_id are judged like any other. Items whose id is null hit words, but
    are not listed. An empty table gives an empty result.
    """
    found, windows, bench = _true_windows(docs, benchmark, few)
    windows = materialize(windows)
    before = Window.partitionBy("doc_id", "h").orderBy("s", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("s") + F.col("n")
    runs = windows.select("doc_id", "h", "s", "n").distinct().withColumn("far", F.max(end).over(before))
    new = F.when(F.col("far").isNull() | (F.col("s") > F.col("far")), F.col("s"))
    runs = runs.withColumn("start", F.max(new).over(before.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("doc_id", "h", "start").agg(F.max(end).alias("end"))
    spans = runs.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    met = windows.select("doc_id", "h", "digest").distinct().join(bench.where("item_id is not null").select("digest", "item_id"), "digest")
    items = met.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    # Null ids are the smallest long here, so that the joins are by equal keys.
    named = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d")
    hits = spans.select(named, "h", "spans").join(items.select(named, "h", "items"), ["d", "h"], "left")
    every = found.where("n_words is not null").select("doc_id", named, "h", "n_words")
    return every.join(hits, ["d", "h"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def drop_hit(docs: DataFrame, benchmark: DataFrame, few: int = FEW) -> DataFrame:
    """`docs`, all its columns, without the rows that hold any window of the benchmark.

    Null and empty texts stay, as do all rows where the benchmark is empty; rows are judged each by its text.
    """
    _, windows, _ = _true_windows(docs, benchmark, few)
    hit = materialize(windows.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h")).distinct())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_h"))
    return docs.join(hit, same, "left_anti")


def report(found: DataFrame) -> DataFrame:
    """Digest columns of find_shared()'s rows."""
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    return report(find_shared(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


#: The same by plain word windows, for DuckDB.
_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP8_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
n AS (SELECT item_id, least(len(w), 10) AS k, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS g FROM n),
sizes AS (SELECT DISTINCT k FROM win),
p AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS s FROM d),
g AS (SELECT doc_id, s, k, array_to_string(w[s : s + k - 1], ' ') AS g FROM p, sizes WHERE s + k - 1 <= len(w)),
hit AS (SELECT g.doc_id, g.s, g.k, win.item_id FROM g JOIN win ON g.g = win.g AND g.k = win.k),
pos AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + k - 1)) AS at FROM hit),
cnt AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cnt ON d.doc_id = cnt.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""

"""Repeated byte strings by enhanced suffix arrays and their common-prefix interval trees.

Every string of `length` bytes repeats where an equal one starts elsewhere. The work is dealt out so
that equal strings meet:

1. Anchors. A window of `length` bytes is named by the smallest hash of its 24-byte grams, its
   anchor; equal windows have equal anchors at the same place. Successive windows with one anchor
   form a stretch. Anchors whose gram occurs once cannot repeat and are dropped.
2. Equal stretches become one class with its first occurrence, by a grouped minimum that is summed
   before the shuffle. All windows of the others repeat. Classes are named by an MD5 of their bytes.
3. Classes with one gram meet in a task. It sorts the suffixes of `length` bytes or more of their
   stretches into an enhanced suffix array (order and common prefixes of neighbours), walks the
   common prefixes with a stack, which builds the interval tree bottom up, and keeps the intervals
   of `length` or more whose occurrences differ in the byte before them (or begin a stretch): the
   maximal repeats, each with all its occurrences.
4. A gram with more than `HOT` classes is split first, by the bytes around it: of the places that the
   gram may have within a window, one half has more bytes after it in common, the other more before
   it. Each stretch gives each half its windows there, named by these bytes too, and equal ones
   become classes again. Halving goes on until no name has more than `HOT` classes, at the latest
   when a name is a whole window; every name then gets its interval tree as in step 3.

Positions are bytes of UTF-8. Null texts are empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Rolling, materialize, mix, sliding_min, table
from .rows import map_frames

LENGTH = 100
GRAM = 24
#: Classes of one gram that a task takes together.
HOT = 1024
#: Bytes of stretches of which a task builds one suffix array; whole grams only.
ARRAY_BYTES = 1 << 19
#: Bytes of text hashed at a time.
BLOCK = 1 << 19
#: Hashes in a filter at most (64 MB); with more there is none, and joins do its work.
FILTER_KEYS = 1 << 25
SLICE_BITS = 1 << 20

_PLACE = np.uint64((1 << 20) - 1)
_ROLL = Rolling()


def _blocks(texts: list[bytes], length: int) -> Iterator[tuple[list[tuple[int, int]], bytes]]:
    """Buffers with the (text number, offset in it) of their pieces; long texts overlap by length - 1."""
    held: list[tuple[int, int]] = []
    parts: list[bytes] = []
    size = 0
    for i, raw in enumerate(texts):
        if len(raw) < length:
            continue
        for at in range(0, len(raw) - length + 1, BLOCK):
            piece = raw[at : at + BLOCK + length - 1]
            if held and size + len(piece) > BLOCK + length:
                yield held, b"".join(parts)
                held, parts, size = [], [], 0
            held.append((i, at))
            parts.append(piece)
            size += len(piece)
    if held:
        yield held, b"".join(parts)


class Stretches:
    """The stretches of several texts: text number, first window, windows, the anchor's gram hash and place after the first window's start."""

    def __init__(self, texts: list[bytes], length: int) -> None:
        out: list[tuple[np.ndarray, ...]] = []
        for held, data in _blocks(texts, length):
            x = np.frombuffer(data, dtype=np.uint8)
            prefix = _ROLL.prefix(x)
            grams = _ROLL.grams(prefix, GRAM)
            keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
            anchor = (sliding_min(keys, length - GRAM + 1) & _PLACE).astype(np.int64)
            bounds = np.array([min(len(texts[i]) - at, BLOCK + length - 1) for i, at in held])
            first = np.concatenate(([0], np.cumsum(bounds)))
            piece = np.repeat(np.arange(len(held)), bounds)[: len(anchor)]
            at = np.flatnonzero(np.arange(len(anchor)) + length <= first[piece + 1])
            own = anchor[at]
            new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (piece[at[1:]] != piece[at[:-1]]))))
            p = piece[at[new]]
            text, offset = np.array(held, dtype=np.int64).T
            windows = np.diff(np.concatenate((new, [len(at)])))
            out.append((text[p], at[new] - first[p] + offset[p], windows, grams[own[new]].view(np.int64), own[new] - at[new]))
        self.text, self.start, self.windows, self.gram, self.anchor = (np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out, strict=True) if out else [()] * 5))


def _raw(texts: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]


def _merge_overlapping(rows: np.ndarray) -> np.ndarray:
    """Disjoint sorted ranges that cover those of `rows` (start, end)."""
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    end = np.maximum.accumulate(rows[:, 1])
    new = np.flatnonzero(np.concatenate(([True], rows[1:, 0] > end[:-1])))
    return np.stack((rows[new, 0], end[np.concatenate((new[1:] - 1, [len(rows) - 1]))]), axis=1)


def suffix_array(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, size, lcp) of all suffixes of `length` bytes or more, sorted; lcp[i] is shared with i - 1."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    counts = sizes - length + 1
    string = np.repeat(np.arange(len(strings)), counts)
    offset = np.arange(len(string)) - np.repeat(np.cumsum(counts) - counts, counts)
    size = sizes[string] - offset
    width = int(sizes.max())
    data = np.zeros(int(sizes.sum()) + width, dtype=np.uint8)
    data[: -width or None] = np.frombuffer(b"".join(strings), dtype=np.uint8)
    begin = (np.cumsum(sizes) - sizes)[string] + offset
    rows = np.lib.stride_tricks.sliding_window_view(data, width)[begin]
    rows[np.arange(width) >= size[:, None]] = 0
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").ravel(), kind="stable")
    rows, string, offset, size = rows[order], string[order], offset[order], size[order]
    differs = rows[1:] != rows[:-1]
    lcp = np.where(differs.any(1), differs.argmax(1), width)
    lcp = np.concatenate(([0], np.minimum(lcp, np.minimum(size[1:], size[:-1]))))
    return string, offset, size, lcp


def intervals(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, common prefix) of the common-prefix intervals of `least` or more, children before parents.

    A scan with a stack of open intervals; runs below `least` are skipped.
    """
    high = np.flatnonzero(lcp >= least)
    if not len(high):
        return
    cut = np.flatnonzero(np.diff(high) > 1)
    for a, b in zip(high[np.concatenate(([0], cut + 1))], high[np.concatenate((cut, [len(high) - 1]))], strict=True):
        stack: list[tuple[int, int]] = []
        for i, common in enumerate([*lcp[a : b + 1].tolist(), 0], int(a)):
            left = i - 1
            while stack and stack[-1][1] > common:
                left, top = stack.pop()
                yield left, i - 1, top
            if common >= least and (not stack or stack[-1][1] < common):
                stack.append((left, common))


def maximal_repeats(strings: list[bytes], length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(common prefix, strings, offsets) of the maximal repeats of `length` bytes or more in different strings.

    A repeat whose occurrences all have the same byte before them is part of a longer one and left out.
    """
    if not strings:
        return
    string, offset, _, lcp = suffix_array(strings, length)
    before = np.array([strings[s][o - 1] if o else -1 for s, o in zip(string.tolist(), offset.tolist(), strict=True)])
    changes = np.cumsum(np.concatenate(([0], before[1:] != before[:-1])))
    begins = np.cumsum(before < 0)
    for first, last, common in intervals(lcp, length):
        if changes[last] > changes[first] or begins[last] > begins[first] - (before[first] < 0):
            yield common, string[first : last + 1], offset[first : last + 1]


def _repeats_of(rows: list[tuple], length: int) -> Iterator[tuple]:
    """(doc_id, h, start, end) of what repeats in classes (gram, doc_id, h, start, stretch) but for first occurrences."""
    strings = [r[4] for r in rows]
    spans: list[list] = [[] for _ in rows]
    for common, string, offset in maximal_repeats(strings, length):
        at = [(rows[s][1], rows[s][2], rows[s][3] + o) for s, o in zip(string.tolist(), offset.tolist(), strict=True)]
        least = min(at)
        for s, o, key in zip(string.tolist(), offset.tolist(), at, strict=True):
            if key != least:
                spans[s].append((key[2], key[2] + common))
    for r, own in zip(rows, spans, strict=True):
        if own:
            for s, e in _merge_overlapping(np.array(own)).tolist():
                yield r[1], r[2], s, e


SPANS = "doc_id long, h long, start long, end long"


def _arrays(length: int, array_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        gram, group, size = None, 0, 0

        def flush(rows: list[tuple]) -> pd.DataFrame:
            grams = pd.Series([r[0] for r in rows])
            twice = grams.duplicated(keep=False)
            return pd.DataFrame(_repeats_of([r for r, t in zip(rows, twice, strict=True) if t], length), columns=["doc_id", "h", "start", "end"])

        for b in batches:
            for r in zip(*(b[c] for c in ("g", "doc_id", "h", "start", "u")), strict=True):
                if r[0] != gram:
                    if size > array_bytes:
                        yield flush(held)
                        held, size = [], 0
                    gram, group = r[0], len(held)
                held.append(r)
                size += len(r[4])
        if held:
            yield flush(held)

    return run


class Filter:
    """A bit map of hashes: has all that were put in, and one in sixteen of the others."""

    def __init__(self, hashes: DataFrame, n: int) -> None:
        """`hashes` has one column of longs, g, and `n` rows."""
        self.bits = SLICE_BITS
        while self.bits < 16 * n:
            self.bits *= 2

        def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            part, own = None, np.zeros(0, dtype=np.uint8)
            for b in batches:
                for number, rows in b.groupby("part", sort=False):
                    if number != part:
                        if part is not None:
                            yield pd.DataFrame({"part": [part], "bits": [np.packbits(own).tobytes()]})
                        part, own = number, np.zeros(SLICE_BITS, dtype=np.uint8)
                    own[rows["bit"].to_numpy()] = 1
            if part is not None:
                yield pd.DataFrame({"part": [part], "bits": [np.packbits(own).tobytes()]})

        place = F.col("g").bitwiseAND(F.lit(self.bits - 1))
        dealt = hashes.select(F.shiftright(place, 20).alias("part"), place.bitwiseAND(F.lit(SLICE_BITS - 1)).alias("bit")).distinct()
        slices = map_frames(dealt.repartition("part").sortWithinPartitions("part"), fill, "part long, bits binary")
        self.map = np.zeros(self.bits // 8, dtype=np.uint8)
        for r in slices.toLocalIterator():
            self.map[r["part"] * SLICE_BITS // 8 : (r["part"] + 1) * SLICE_BITS // 8] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & (self.bits - 1)
        return (self.map[at >> 3] & (128 >> (at & 7)).astype(np.uint8)) > 0


def _filter(hashes: DataFrame, most: int):
    """A broadcast filter of the column g of `hashes`, or None for more than `most`."""
    n = hashes.count()
    return hashes.sparkSession.sparkContext.broadcast(Filter(hashes, n)) if n <= most else None


def _place_hash(gram: np.ndarray, doc_id: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of a stretch's place."""
    return mix(gram.view(np.uint64) + mix(doc_id.astype(np.int64).view(np.uint64) + mix(start.astype(np.int64).view(np.uint64)))).view(np.int64)


PLACE = ("doc_id", "h", "start")
STRINGS = "g long, doc_id long, h long, start long, a int, u binary"


def _strings(docs: DataFrame, several: DataFrame, length: int, most: int) -> DataFrame:
    """STRINGS of the stretches in `several` (g, doc_id, h, start), each once: a is the gram's place in the bytes u."""

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"g": _place_hash(*(b[c].to_numpy() for c in ("g", "doc_id", "start")))})

    wanted = _filter(map_frames(several.select("g", "doc_id", "start"), places, "g long"), most)
    if not wanted:
        starts = several.groupBy("doc_id", "h").agg(F.collect_set("start").alias("starts"))
        docs = docs.join(starts, ["doc_id", "h"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raw = _raw(b["text"])
            found = Stretches(raw, length)
            doc_id, h = b["doc_id"].to_numpy()[found.text], b["h"].to_numpy()[found.text]
            if wanted:
                keep = np.flatnonzero(wanted.value.has(_place_hash(found.gram, doc_id, found.start)))
            else:
                asked = [set(x.tolist()) for x in b["starts"]]
                keep = np.array([i for i, (t, s) in enumerate(zip(found.text.tolist(), found.start.tolist(), strict=True)) if s in asked[t]], dtype=np.int64)
            text, start = found.text[keep], found.start[keep]
            ends = start + found.windows[keep] + (length - 1)
            strings = [raw[t][s:e] for t, s, e in zip(text.tolist(), start.tolist(), ends.tolist(), strict=True)]
            yield pd.DataFrame({"g": found.gram[keep], "doc_id": doc_id[keep], "h": h[keep], "start": start, "a": found.anchor[keep], "u": strings})

    # A filter lets some other stretches through, and repeated rows have one place: one string a class is left.
    strung = map_frames(docs, cut, STRINGS).dropDuplicates(["g", *PLACE])
    return strung.join(several.select("g", *PLACE), ["g", *PLACE], "left_semi")


def _halved(strings: DataFrame, length: int) -> DataFrame:
    """Each of `strings` (STRINGS, and lo and hi: the gram's least and last place in a window) in two, by the gram's place.

    g becomes a hash of the bytes that all windows of a half with the gram have in common; strings
    that get one by chance stay apart, as lo and hi are part of the name and bytes are compared later.
    """
    windows = F.octet_length("u") - length + 1
    middle = ((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct((middle + 1).alias("lo"), F.col("hi").alias("hi")))
    cut = strings.select("doc_id", "h", "start", "a", "u", windows.alias("n"), F.explode(halves).alias("half")).select("*", "half.lo", "half.hi")
    first, last = F.greatest(F.lit(0), F.col("a") - F.col("hi")), F.least(F.col("n") - 1, F.col("a") - F.col("lo"))
    cut = cut.where("lo <= hi").withColumn("i", first).withColumn("j", last).where("i <= j")
    common = F.substring("u", F.col("a") - F.col("lo") + 1, F.col("lo") + GRAM + (length - GRAM - F.col("hi")))
    return cut.select(
        F.xxhash64(common, "lo", "hi").alias("g"), "doc_id", "h", (F.col("start") + F.col("i")).alias("start"), (F.col("a") - F.col("i")).alias("a"),
        F.substring("u", F.col("i") + 1, F.col("j") - F.col("i") + length).alias("u"), "lo", "hi",
    )


def _split(strings: DataFrame, hot: int, length: int) -> tuple[DataFrame, DataFrame]:
    """(strings to build arrays of, SPANS of whole strings that repeat) in place of `strings`, whose names are all hot."""
    todo = strings.withColumn("lo", F.lit(0)).withColumn("hi", F.lit(length - GRAM))
    ready, spans = [], []
    while True:
        parts = materialize(_halved(todo, length).withColumn("d", F.md5("u")))
        classes = parts.groupBy("g", "d", "lo", "hi").agg(F.min(F.struct(*PLACE, "a", "u")).alias("first"), F.count("*").alias("copies"))
        classes = materialize(classes)
        # Written first, so that the join has an exchange for each side and a hot class can be split.
        firsts = materialize(classes.where("copies > 1").select("g", "d", "lo", "hi", F.struct(*(F.col(f"first.{c}") for c in PLACE)).alias("first")))
        copies = parts.join(firsts, ["g", "d", "lo", "hi"]).where(F.struct(*PLACE) != F.col("first"))
        spans.append(copies.select(*PLACE, (F.col("start") + F.octet_length("u")).alias("end")))
        sizes = materialize(classes.groupBy("g").count().where("count > 1"))
        alone = classes.select("g", *(f"first.{c}" for c in (*PLACE, "a", "u")), "lo", "hi").join(sizes, "g")
        ready.append(alone.where(F.col("count") <= hot))
        todo = alone.where((F.col("count") > hot) & (F.col("lo") < F.col("hi")))
        if sizes.where(F.col("count") > hot).isEmpty():
            break
        if todo.isEmpty():  # whole windows have one class each, but for chance
            ready.append(alone.where(F.col("count") > hot))
            break
    columns = ["g", *PLACE, "u"]
    return reduce(DataFrame.unionByName, (r.select(*columns) for r in ready)), reduce(DataFrame.unionByName, spans)


def repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, array_bytes: int = ARRAY_BYTES, most: int = FILTER_KEYS) -> DataFrame:
    """(doc_id, h, start, end): byte ranges of the documents that repeat earlier ones, unmerged.

    `docs` has doc_id and h (longs, not null) and text. Together the ranges of a document cover just
    the bytes of strings of `length` bytes that also start earlier: in a document with smaller
    (doc_id, h), or further ahead in the same one.
    """

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"g": Stretches(_raw(b["text"]), length).gram})

    repeated = materialize(map_frames(docs.select("text"), grams, "g long").groupBy("g").count().where("count > 1").select("g"))
    shared = _filter(repeated, most)

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raw = _raw(b["text"])
            found = Stretches(raw, length)
            keep = np.flatnonzero(shared.value.has(found.gram)) if shared else np.arange(len(found.gram))
            text, start, n = found.text[keep], found.start[keep], found.windows[keep]
            ends = start + n + (length - 1)
            yield pd.DataFrame(
                {
                    "g": found.gram[keep],
                    "d": [hashlib.md5(raw[t][s:e]).digest() for t, s, e in zip(text.tolist(), start.tolist(), ends.tolist(), strict=True)],
                    "doc_id": b["doc_id"].to_numpy()[text],
                    "h": b["h"].to_numpy()[text],
                    "start": start,
                    "n": n,
                }
            )

    found = map_frames(docs, stretches, "g long, d binary, doc_id long, h long, start long, n int")
    found = materialize(found if shared else found.join(repeated, "g", "left_semi"))
    classes = found.groupBy("g", "d").agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("copies"))
    classes = materialize(classes)
    firsts = classes.where("copies > 1").select("g", "d", "first")
    copies = found.join(firsts, ["g", "d"]).where(F.struct(*PLACE) != F.col("first"))
    out = copies.select(*PLACE, (F.col("start") + F.col("n") + (length - 1)).alias("end"))

    sizes = materialize(classes.groupBy("g").count().where("count > 1"))
    several = materialize(classes.join(sizes, "g", "left_semi").select("g", *(f"first.{c}" for c in PLACE)))
    strung = _strings(docs, several, length, most)
    common = materialize(sizes.where(F.col("count") > hot).select("g"))
    if common.isEmpty():
        cold = strung.select("g", *PLACE, "u")
    else:
        strung = materialize(strung)
        cold = strung.join(common, "g", "left_anti").select("g", *PLACE, "u")
        ready, whole = _split(strung.join(common, "g", "left_semi"), hot, length)
        cold, out = cold.unionByName(ready), out.unionByName(whole)
    dealt = cold.repartition("g").sortWithinPartitions("g")
    return out.unionByName(map_frames(dealt, _arrays(length, array_bytes), SPANS))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id (null as the smallest long), h and text; h is a hash of the text, or 0 if doc_id alone names the rows."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.col("text").cast("string"))
    alone = keyed.groupBy("doc_id").count().where("count > 1").isEmpty()
    return keyed.withColumn("h", F.lit(0).cast("long") if alone else F.xxhash64("text"))


def cut(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for every row of `docs`.

    spans: the maximal removed runs (start, end in bytes). What is left need not be whole UTF-8, so
    it is given by its digest; `kept_bytes` cuts it. Rows with one doc_id and one text are one
    document and get one result each; of different texts with one doc_id the order is by their hash.
    Null doc_ids come first and are null in the result. An empty table gives an empty result.
    """
    keyed = _keyed(docs)
    found = materialize(repeats(keyed, length, **options).groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    hash_ = F.xxhash64("doc_id", "h")
    touched = _filter(found.select(hash_.alias("g")), options.get("most", FILTER_KEYS))

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        return pd.Series(touched.value.has(hashes.to_numpy()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for raw, spans in zip(_raw(b["text"]), b["spans"], strict=True):
                runs = [] if spans is None else _merge_overlapping(np.array([(x["start"], x["end"]) for x in spans])).tolist()
                rows.append((len(raw), sum(e - s for s, e in runs), len(runs), hashlib.sha256(kept_bytes(raw, runs)).hexdigest(), [{"start": s, "end": e} for s, e in runs]))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"], index=b.index)
            out.insert(0, "doc_id", b["doc_id"])
            yield out

    kind = "array<struct<start:bigint,end:bigint>>"
    marked = keyed.withColumn("hit", maybe(hash_) if touched else F.lit(True))
    joined = marked.where("hit").join(found.hint("shuffle_hash"), ["doc_id", "h"], "left").select("doc_id", "text", "spans")
    joined = map_frames(joined, run, f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans {kind}")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rest = marked.where("not hit").select(
        "doc_id", F.octet_length(raw).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(raw, 256).alias("kept_sha256"), F.array().cast(kind).alias("spans")
    )
    out = joined.unionByName(rest)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))


def kept_bytes(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    """`raw` without disjoint sorted ranges."""
    out, done = [], 0
    for s, e in runs:
        out.append(raw[done:s])
        done = e
    return b"".join([*out, raw[done:]])


def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents left when strings of 100 bytes that started earlier are gone."""
    return cut(table(spark, sf_dir, "documents")).drop("spans")


#: The same by all windows of 100 bytes, in hexadecimal, for DuckDB; texts are cut into overlapping parts first, as substr() counts from the start.
OP10_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
b AS (SELECT doc_id, o, n, substr(x, 2 * o + 1, 798) AS part FROM (SELECT doc_id, x, n, unnest(range(0, n - 99, 300)) AS o FROM d WHERE n >= 100)),
w AS (SELECT doc_id, o + s AS s, md5(substr(part, 2 * s + 1, 200)) AS k FROM (SELECT doc_id, o, part, unnest(range(least(300, n - 99 - o))) AS s FROM b)),
f AS (SELECT k, min((doc_id, s)) AS first FROM w GROUP BY k HAVING count(*) > 1),
late AS (SELECT w.doc_id, w.s FROM w JOIN f USING (k) WHERE (w.doc_id, w.s) <> f.first),
m AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS gap FROM late),
i AS (SELECT doc_id, s, sum(CASE WHEN gap <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM m),
r AS (SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM i GROUP BY ALL),
k AS (SELECT doc_id, b AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a, b), n) AS b, b - a AS gone FROM (
  SELECT doc_id, a, b, n FROM r JOIN d USING (doc_id) UNION ALL SELECT doc_id, 0, 0, n FROM d)),
c AS (SELECT doc_id, sum(gone) AS gone, count(*) - 1 AS n_spans, string_agg(substr(x, 2 * k.a + 1, 2 * (k.b - k.a)), '' ORDER BY k.a) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(gone AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256 FROM d JOIN c USING (doc_id)
"""

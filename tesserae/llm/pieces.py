"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text's lattice has an edge for every vocabulary piece that matches at a place, and byte pieces for
characters without one. Forward filtering sums the weights of all ways to each place; backward
sampling draws a way from the end, so whole segmentations come with their exact probability under
the pieces' weights. The random numbers are hashes of the row's key, the word's number and the step:
the same row gives the same segmentation on any partition, batch or executor.

Pieces hold a space only at their beginning, so the lattice falls apart at spaces, and a word's sums
are worked out once for all its occurrences in a part of about a megabyte; words are compared by their bytes. Spaces are the byte 0xFF inside (never part
of UTF-8); a literal U+2581 is spelled in byte pieces. So every text decodes to itself.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Rolling, mix, table
from .rows import add_columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED = 1
#: Of a model with ranks for scores, a piece of rank r has the weight 1 / (r + 1) ** SHARPNESS.
SHARPNESS = 1.0
#: Longer words, in bytes, are taken one by one.
SHORT = 64
#: Weight for a byte piece.
BYTE_WEIGHT = 1e-3
#: Weights are multiplied by this for each byte, to stay in a float's range; it cancels out.
LIFT = 10.0
SPACE = 0xFF
#: Bytes of a longer word whose pieces are held at a time.
LONG_BLOCK = 1 << 16
#: Bytes of text segmented at a time, at words' beginnings; bounds a task's memory.
CHUNK = 1 << 20

_ROLL = Rolling()


class Vocabulary:
    """Pieces as bytes, their weights, and a trie over them as a table of states by byte classes."""

    def __init__(self, pieces: list[tuple[bytes, int, float]], byte_ids: list[int], size: int) -> None:
        """pieces: bytes, id and weight of each ordinary piece; byte_ids: the ids of the 256 byte pieces."""
        self.spelling: list[bytes] = [b""] * size
        for raw, i, _ in pieces:
            self.spelling[i] = raw
        for b, i in enumerate(byte_ids):
            self.spelling[i] = bytes([b])
        self.byte_ids = np.array(byte_ids, dtype=np.int32)
        used = sorted({b for raw, _, _ in pieces for b in raw})
        self.byte_class = np.zeros(256, dtype=np.int64)
        self.byte_class[used] = np.arange(1, len(used) + 1)
        index = {b: c + 1 for c, b in enumerate(used)}
        steps: list[dict[int, int]] = [{}, {}]  # state 0: no way on; 1: the root
        self_id, self_weight = [-1, -1], [0.0, 0.0]
        for raw, i, w in pieces:
            at = 1
            for b in raw:
                to = steps[at].get(index[b])
                if to is None:
                    to = steps[at][index[b]] = len(steps)
                    steps.append({})
                    self_id.append(-1)
                    self_weight.append(0.0)
                at = to
            self_id[at], self_weight[at] = i, w * LIFT ** len(raw)
        inner = [i for i, s in enumerate(steps) if s]
        self.row = np.zeros(len(steps), dtype=np.int64)
        self.row[inner] = np.arange(1, len(inner) + 1)
        self.next = np.zeros((len(inner) + 1, len(used) + 1), dtype=np.int32)
        for i in inner:
            for c, to in steps[i].items():
                self.next[self.row[i], c] = to
        self.longest = max((len(raw) for raw, _, _ in pieces), default=1)
        self.id = np.array(self_id, dtype=np.int32)
        self.weight = np.array(self_weight)

    @staticmethod
    def load(path: str, sharpness: float = SHARPNESS) -> Vocabulary:
        """From a SentencePiece model file with byte fallback."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        ids = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = [model.get_score(i) for i in ids]
        ranks = all(s <= 0 and s == int(s) for s in scores)
        weights = [(1 / (1 - s)) ** sharpness if ranks else math.exp(s * sharpness) for s in scores]
        pieces = [(model.id_to_piece(i).replace("▁", "\udcff").encode("utf-8", "surrogateescape"), i, w) for i, w in zip(ids, weights, strict=True)]
        if any(SPACE in raw.lstrip(bytes([SPACE])) for raw, _, _ in pieces):
            raise ValueError("a piece holds a space after other characters")
        return Vocabulary(pieces, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], size)

    def edges(self, data: np.ndarray, room: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
        """(start, bytes, id, weight) of all pieces at `start` places of `data` of at most `room` bytes."""
        out = []
        at, state, n = start, np.full(len(start), 1), 0
        covered = np.zeros(len(data), dtype=bool)
        lead = (data >= 0xC0).astype(np.int64) + (data >= 0xE0) + (data >= 0xF0) + 1
        lead[data == SPACE] = 1
        while len(at):
            keep = room[at] > n
            at, state = at[keep], state[keep]
            state = self.next[self.row[state], self.byte_class[data[at + n]]]
            keep = state > 0
            at, state = at[keep], state[keep]
            n += 1
            full = self.id[state] >= 0
            out.append((at[full], np.full(full.sum(), n), self.id[state[full]], self.weight[state[full]]))
            covered[at[full][lead[at[full]] == n]] = True
        bare = start[~covered[start]]
        whole = np.minimum(lead[bare], room[bare])
        for n in range(int(whole.max(initial=0))):
            at = bare[whole > n] + n
            out.append((at, np.ones(len(at), np.int64), self.byte_ids[data[at]], np.full(len(at), BYTE_WEIGHT * LIFT)))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _uniform(seeds: np.ndarray, word: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) by row seed, word number and step."""
    x = mix(seeds + word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (mix(x + np.uint64(step)) >> np.uint64(11)) * 2.0**-53


def _starts(data: np.ndarray) -> np.ndarray:
    """Places where a word begins: a space after another character."""
    return np.flatnonzero((data[1:] == SPACE) & (data[:-1] != SPACE)) + 1 if len(data) else np.zeros(0, np.int64)


def _cut(raw: bytes) -> Iterator[bytes]:
    """`raw` in parts of about CHUNK bytes, each from a word's beginning to another's; longer words are not cut."""
    at = 0
    while len(raw) - at > CHUNK:
        to = raw.rfind(b"\xff", at + 1, at + CHUNK)
        while to > at + 1 and raw[to - 1] == SPACE:
            to -= 1
        if to <= at + 1:  # one word, or its spaces, fills the part
            to = at + CHUNK
            while (to := raw.find(b"\xff", to)) > 0 and raw[to - 1] == SPACE:
                to += 1
        if to <= 0:
            break
        yield raw[at:to]
        at = to
    if at < len(raw):
        yield raw[at:]


def _different(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The occurrence that stands for each different word, and each occurrence's word; the words tile `data`.

    Words are found by hashes and compared byte by byte, so that words with one hash are told apart.
    """
    hashes = _ROLL.slices(_ROLL.prefix(data), start, end) ^ (end - start).astype(np.uint64)
    _, one, word = np.unique(hashes, return_index=True, return_inverse=True)
    size = end - start
    like = np.repeat(start[one[word]] - start, size) + np.arange(len(data))
    wrong = (size != size[one[word]]) | np.logical_or.reduceat(data != data[np.minimum(like, len(data) - 1)], start)
    more: dict[bytes, int] = {}
    for o in np.flatnonzero(wrong).tolist():
        raw = data[start[o] : end[o]].tobytes()
        if raw not in more:
            more[raw] = len(one)
            one = np.append(one, o)
        word[o] = more[raw]
    return one, word


class Sampler:
    """Draws segmentations of many texts at once."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary

    def encode(self, texts: list[str], seeds: np.ndarray) -> list[np.ndarray]:
        """Piece ids of every text; seeds: one of 64 bits for each. About CHUNK bytes, or one word, at a time."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, bytes, int]] = []  # text, bytes, words of the text before them
        size = 0

        def flush() -> None:
            raws = [raw for _, raw, _ in held]
            for (i, _, _), ids in zip(held, self._encode(raws, seeds[[i for i, _, _ in held]], [n for *_, n in held]), strict=True):
                found[i].append(ids)
            held.clear()

        for i, t in enumerate(texts):
            words = 0
            parts = list(_cut(b"\xff" + t.encode("utf-8", "replace").replace(b" ", b"\xff") if t else b""))
            for raw in parts:
                if held and size + len(raw) > CHUNK:
                    flush()
                    size = 0
                held.append((i, raw, words))
                size += len(raw)
                if len(parts) > 1:
                    words += 1 + len(_starts(np.frombuffer(raw, dtype=np.uint8)))
        if held:
            flush()
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.int32) for x in found]

    def _encode(self, raw: list[bytes], seeds: np.ndarray, before: list[int]) -> list[np.ndarray]:
        """Piece ids of byte strings that begin with a space; `before`: the number of words that each one's text had before."""
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sizes = np.array([len(r) for r in raw])
        first = np.cumsum(sizes) - sizes
        start = np.union1d(_starts(data), first)
        end = np.concatenate((start[1:], [len(data)]))
        row = np.searchsorted(first, start, side="right") - 1
        nth = np.arange(len(start)) - np.searchsorted(start, first)[row] + np.array(before)[row]
        one, word = _different(data, start, end)
        order = np.argsort(start[one] - end[one], kind="stable")  # long ones first
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        word, one = place[word], one[order]
        occurrence, step, ids = self._draw(data, start[one], end[one], word, seeds[row], nth)
        count = np.bincount(occurrence, minlength=len(start))
        out = np.empty(len(ids), np.int32)
        out[(np.cumsum(count) - count)[occurrence] + count[occurrence] - 1 - step] = ids
        per_row = np.bincount(row, weights=count, minlength=len(raw)).astype(np.int64)
        return np.split(out, np.cumsum(per_row)[:-1])

    def _draw_long(self, data: np.ndarray, seed: np.ndarray, nth: np.ndarray) -> list[np.ndarray]:
        """Piece ids, from the end, of one long word `data` for each seed and word number.

        Sums are kept as logarithms, one a byte; pieces are looked up again on the way back, a block at a time.
        """
        n = len(data)
        total = np.full(n + 1, -math.inf)
        total[0] = 0.0
        for lo in range(0, n, LONG_BLOCK):
            for at, ways in enumerate(self._into(data, lo, min(n, lo + LONG_BLOCK)), lo + 1):
                sums = [total[s] + w for s, _, w in ways]
                top = max(sums, default=-math.inf)
                if top > -math.inf:
                    total[at] = top + math.log(sum(math.exp(x - top) for x in sums))
        place = [n] * len(seed)
        got: list[list[int]] = [[] for _ in place]
        for lo in range((n - 1) // LONG_BLOCK * LONG_BLOCK, -1, -LONG_BLOCK):
            into = self._into(data, lo, min(n, lo + LONG_BLOCK))
            for o in range(len(place)):
                at, own = place[o], got[o]
                while at > lo:
                    u = float(_uniform(seed[o : o + 1], nth[o : o + 1], len(own))[0])
                    pick = None
                    for s, i, w in into[at - lo - 1]:
                        if total[s] > -math.inf:
                            pick = s, i
                            u -= math.exp(total[s] + w - total[at])
                            if u < 0:
                                break
                    at = pick[0]
                    own.append(pick[1])
                place[o] = at
        return [np.array(x, dtype=np.int32) for x in got]

    def _into(self, data: np.ndarray, lo: int, hi: int) -> list[list[tuple[int, int, float]]]:
        """For each place from lo + 1 to hi, the pieces that end there: (start, id, logarithm of the weight)."""
        begin = max(0, lo - self.v.longest - 4)
        stop = min(len(data), hi + self.v.longest + 4)
        own = data[begin:stop]
        room = len(data) - begin - np.arange(len(own))
        # Pieces that reach past the slice end past hi, and are not asked for.
        room = np.minimum(room, len(own) - np.arange(len(own)))
        boundary = np.flatnonzero((own[: hi - begin] & 0xC0) != 0x80)
        at, n, ids, weight = self.v.edges(own, room, boundary)
        into: list[list[tuple[int, int, float]]] = [[] for _ in range(hi - lo)]
        inside = (at + n + begin > lo) & (at + n + begin <= hi)
        for s, e, i, w in zip((at[inside] + begin).tolist(), (at + n)[inside].tolist(), ids[inside].tolist(), np.log(weight[inside]).tolist(), strict=True):
            into[e + begin - lo - 1].append((s, i, w))
        return into

    def _draw(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, word: np.ndarray, seed: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, ...]:
        """(occurrence, step from the end, id) of all pieces drawn; words are given by their places, longest first."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n_long = int(np.searchsorted(start - end, -SHORT, side="left"))
        by_word = np.argsort(word, kind="stable")
        cuts = np.searchsorted(word[by_word], np.arange(n_long + 1))
        for k in range(n_long):
            where = by_word[cuts[k] : cuts[k + 1]]
            for o, got in zip(where.tolist(), self._draw_long(data[start[k] : end[k]], seed[where], nth[where]), strict=True):
                out.append((np.full(len(got), o), np.arange(len(got)), got))

        # All short words together: node (word, place) is base + word + place.
        start, end = start[n_long:], end[n_long:]
        if len(start):
            size = end - start
            base = np.cumsum(size) - size
            owner = np.repeat(np.arange(len(size)), size)
            flat = np.arange(len(owner)) - base[owner] + start[owner]
            own = data[flat]
            room = base[owner] + size[owner] - np.arange(len(owner))
            at, n, ids, weight = self.v.edges(own, room, np.flatnonzero(((own & 0xC0) != 0x80)))
            w = owner[at]
            node = base + np.arange(len(size))
            from_ = at - base[w]
            to = from_ + n
            a, b = node[w] + from_, node[w] + to
            total = np.zeros(int(size.sum()) + len(size))
            total[node] = 1.0
            by_place = np.argsort(to.astype(np.int16), kind="stable")
            bounds = np.searchsorted(to[by_place], np.arange(1, SHORT + 2))
            reach = np.searchsorted(-size, -np.arange(SHORT + 1), side="right")  # words of so many bytes or more
            for t in range(1, SHORT + 1):
                part = by_place[bounds[t - 1] : bounds[t]]
                if len(part):
                    total[node[: reach[t]] + t] = np.bincount(w[part], total[a[part]] * weight[part], reach[t])
            by_node = np.argsort(b, kind="stable")
            a, ids, b = a[by_node], ids[by_node], b[by_node]
            share = total[a] * weight[by_node] / np.maximum(total[b], 1e-300)
            last = np.cumsum(np.bincount(b, minlength=len(total)))
            first = np.concatenate(([0], last[:-1]))
            widest = int((last - first).max())
            # Running sums begin anew at every node, so that no word's draws hang on its neighbours.
            for r in range(1, widest):
                up = first[last - first > r] + r
                share[up] += share[up - 1]
            live = np.flatnonzero(word >= n_long)
            place = node[word[live] - n_long] + size[word[live] - n_long]
            step = 0
            while len(live):
                low, high = first[place], last[place]
                aim = _uniform(seed[live], nth[live], step) * share[high - 1]
                pick, top = low, high - 1
                for _ in range(widest.bit_length()):
                    middle = (pick + top) >> 1
                    right = share[middle] <= aim
                    pick, top = np.where(right, np.minimum(middle + 1, top), pick), np.where(right, top, middle)
                out.append((live, np.full(len(live), step), ids[pick]))
                place = a[pick]
                more = place != node[word[live] - n_long]
                live, place, step = live[more], place[more], step + 1
        return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))

    def spell(self, ids) -> bytes:
        return b"".join(map(self.v.spelling.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))

    def decode(self, ids) -> str:
        """The text of piece ids."""
        return self.spell(ids)[1:].replace(b"\xff", b" ").decode("utf-8", "replace")


def encode(docs: DataFrame, key: str = "doc_id", model: str = MODEL, seed: int = SEED) -> DataFrame:
    """The columns of `docs` with `pieces` (array<int>) and `lossless` beside them.

    The random numbers hang on `key` and `seed` alone: rows with one key and one text are segmented
    alike, alone or among others. Null and empty texts have no pieces; null keys have one seed; columns
    named pieces or lossless give way; an empty table gives an empty result. lossless says whether the pieces decode to the text.
    The model is read on the driver and sent to the tasks (a few MB, whatever the input).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.load(model))
    row_seed = "_row_seed"
    while row_seed in docs.columns:
        row_seed += "_"
    seeded = docs.withColumn(row_seed, F.xxhash64(F.col(key).cast("string"), F.lit(seed)))
    held: list[Sampler] = []

    def run(columns: dict[str, list]) -> dict[str, list]:
        if not held:
            held.append(Sampler(shared.value))
        texts = [t or "" for t in columns["text"]]
        found = held[0].encode(texts, np.array(columns[row_seed], dtype=np.int64).view(np.uint64)) if texts else []
        return {"pieces": found, "lossless": [held[0].decode(p) == t for p, t in zip(found, texts, strict=True)]}

    return add_columns(seeded, run, "pieces array<int>, lossless boolean", ["text", row_seed], drop=[row_seed])


def decode(df: DataFrame, model: str = MODEL) -> DataFrame:
    """`df` with the text of its `pieces` in the column `decoded`; null pieces give null."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    held: list[Sampler] = []

    def run(columns: dict[str, list]) -> dict[str, list]:
        if not held:
            held.append(Sampler(shared.value))
        return {"decoded": [None if p is None else held[0].decode(p) for p in columns["pieces"]]}

    return add_columns(df, run, "decoded string", ["pieces"])


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentations of all documents: their number of pieces, digest, and whether they decode to the text."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return encode(docs).select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"), F.sha2(F.array_join(F.col("pieces").cast("array<string>"), ","), 256).alias("pieces_sha256"), "lossless"
    )


def digest(ids: list[int]) -> str:
    """The digest of op7 for one row."""
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()

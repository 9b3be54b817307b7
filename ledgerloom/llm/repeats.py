"""Substring dedup with prefix-partitioned suffix trees.

A passage repeats if a window of ``WINDOW`` words does, that is, if two suffixes agree in their first ``WINDOW`` words: in
the suffix tree of all texts they hang below an internal node of that depth. The tree is built in parts:

1. Every window goes to one part, named by a prefix: of the ``PREFIX``-word prefixes of the window's own suffixes the one
   of the smallest hash. Equal windows choose alike, and neighbouring windows mostly choose the same place, so a text is
   cut into a few overlapping stretches, each with the windows of one place.
2. Parts with one stretch have no internal node and go. Equal stretches of a part are counted as one, with all their
   windows repeated, so copies never meet in one task.
3. The different stretches of a part of ordinary size are brought together, and their suffix tree is built in memory:
   nodes of depth 1, 2, 4, ... up to the window, by naming pairs of nodes. Deep nodes of several suffixes are repeats.
4. Parts of too many stretches get a longer prefix, the whole window, and split into one part for each value of it.

Windows are compared by 64-bit hashes of words, word by word within a tree, and by 128 bits and their part elsewhere.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, pick, work_table

#: Words of a window and of the prefixes that name parts.
WINDOW, PREFIX = 35, 8
#: Different stretches of a part that are held in memory together.
PART_STRETCHES = 1024
#: Words that are cut into stretches at once, in a longer text with an overlap.
CHUNK_WORDS = 1 << 19
#: Word hashes kept by one worker; beyond, the memo starts anew.
MEMO_WORDS = 200_000

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes split at space and 0x09-0x0D only


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class _Polynomial:
    """Hashes of any stretch of a sequence from running sums."""

    def __init__(self, values: np.ndarray, multiplier: int):
        n = len(values)
        self.inverse = np.ones(n + 1, np.uint64)
        self.inverse[1:] = np.uint64(pow(multiplier, -1, 1 << 64))
        power = np.ones(n + 1, np.uint64)
        power[1:] = np.uint64(multiplier)
        np.multiply.accumulate(self.inverse, out=self.inverse)
        np.multiply.accumulate(power, out=power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over ``width`` values from each place on."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def stretches(hashes: np.ndarray, borders: np.ndarray, window: int = WINDOW, prefix: int = PREFIX) -> tuple[np.ndarray, ...]:
    """(first window, windows, part, stretch hash) of the stretches of a chunk of texts.

    ``borders`` are the places at which texts begin, and the end; no window crosses one.
    """
    none = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int64),) * 2
    n = len(hashes)
    if n < window:
        return none
    polynomial = _Polynomial(hashes, _MULTIPLIERS[0])
    at = np.arange(n - prefix + 1)
    grams = polynomial(at, at + prefix)
    low = np.uint64((1 << 20) - 1)
    least = _sliding_min(grams & ~low | at.astype(np.uint64), window - prefix + 1)  # the leftmost of equal ones
    chosen = (least & low).astype(np.int64)
    inside = np.ones(n + 1, bool)
    for b in borders[1:].tolist():
        inside[max(0, b - window + 1) : b] = False
    valid = np.flatnonzero(inside[: n - window + 1])
    if not len(valid):
        return none
    chosen = chosen[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (np.diff(chosen) != 0) | (np.diff(valid) != 1)
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(valid)))
    first = valid[begin]
    whole = polynomial(first, first + count + window - 1)
    anchor = chosen[begin]
    whole = _mixed(whole + (anchor - first).astype(np.uint64))
    return first, count, grams[anchor].view(np.int64), whole.view(np.int64)


def _chunks(lengths: list[int], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Texts in chunks of (text, first word, end); a long text in several, each window in one of them."""
    chunk, n = [], 0
    for i, length in enumerate(lengths):
        at = 0
        while True:
            end = min(length, at + CHUNK_WORDS)
            chunk.append((i, at, end))
            n += end - at
            if n >= CHUNK_WORDS:
                yield chunk
                chunk, n = [], 0
            if end == length:
                break
            at = end - window + 1
    if chunk:
        yield chunk


def _stretches_of(docs: DataFrame, window: int, prefix: int) -> DataFrame:
    """(id, body, first, windows, part, stretch) of every text; and (id, body, n_words, sha) once per text, first = -1."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t) for t in batch.column("text").to_pylist()]
            sha = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            n = len(words)
            nothing = pa.nulls(n, pa.int64())
            out = [(np.arange(n), np.full(n, -1), np.fromiter(map(len, words), np.int64, n), nothing, nothing, pa.array(sha, pa.string()))]
            for chunk in _chunks([len(w) for w in words], window):
                hashes = np.concatenate([hashes_of(words[i][a:b]) for i, a, b in chunk])
                borders = np.cumsum([0, *(b - a for _, a, b in chunk)])
                first, count, part, stretch = stretches(hashes, borders, window, prefix)
                k = np.searchsorted(borders, first, "right") - 1
                while len(k) and (empty := borders[k + 1] == borders[k]).any():
                    k[empty] += 1
                text, start = (np.array([c[j] for c in chunk], np.int64) for j in (0, 1))
                out.append((text[k], first - borders[k] + start[k], count, pa.array(part), pa.array(stretch), pa.nulls(len(k), pa.string())))
            for text, first, count, part, stretch, sha_ in out:
                if len(text):
                    rows = pa.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(rows), batch.column("body").take(rows), pa.array(first, pa.int32()), pa.array(count, pa.int64()), part, stretch, sha_],
                        ["id", "body", "first", "n", "part", "stretch", "sha"])

    schema = docs.select("id", "body").schema.add("first", "integer").add("n", "long").add("part", "long").add("stretch", "long").add("sha", "string")
    return map_batches(docs, cut, schema)


def repeated_suffixes(texts: list[list[bytes]], window: int = WINDOW) -> list[np.ndarray]:
    """For each text, whether the suffix at each place has its first ``window`` words below a node of several suffixes.

    Nodes of depth 2d are the pairs of nodes of depth d that follow each other, so a few namings build the levels of the
    suffix tree down to the window.
    """
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths) - lengths
    words = hashes_of([w for t in texts for w in t])
    node = np.unique(words, return_inverse=True)[1].astype(np.int64)
    depth = 1
    while depth < window:
        step = min(depth, window - depth)
        pair = node[: len(node) - step] * (int(node.max()) + 1) + node[step:]
        node = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        depth += step
    places = np.concatenate([np.arange(s, s + n - window + 1) for s, n in zip(starts.tolist(), lengths.tolist())])
    deep = node[places]
    repeated = np.bincount(deep, minlength=1)[deep] > 1
    return np.split(repeated, np.cumsum(np.maximum(0, lengths - window + 1))[:-1])


def _tree_batches(window: int):
    """Over rows (part, stretch, words) sorted by part: (part, stretch, flags of the windows as bits)."""

    def build(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        flags = repeated_suffixes([words_of(r[2]) for r in rows], window)
        bits = [int.from_bytes(np.packbits(f, bitorder="little").tobytes(), "little") for f in flags]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)] + [pa.array(bits, pa.int64())], ["part", "stretch", "flags"])

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, str]] = []
        for batch in batches:
            held += zip(*(batch.column(k).to_pylist() for k in range(3)))
            last = held[-1][0]
            end = len(held)
            while end and held[end - 1][0] == last:
                end -= 1
            if end:  # the last part may go on
                yield build(held[:end])
                held = held[end:]
        if held:
            yield build(held)

    return trees


def _fetched(docs: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """The texts of ``places``(id, body, first, n, part, stretch), as (part, stretch, words)."""
    wanted = places.groupBy("id", "body").agg(F.collect_list(F.struct("first", "n", "part", "stretch")).alias("places"))
    both = docs.join(wanted, [docs.id.eqNullSafe(wanted.id), docs.body == wanted.body]).select("text", "places")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p["part"] for p in some], pa.int64()), pa.array([p["stretch"] for p in some], pa.int64()),
                     pa.array([b" ".join(words[p["first"] : p["first"] + p["n"] + window - 1]).decode() for p in some], pa.string())],
                    ["part", "stretch", "words"])

    return map_batches(both, fetch, "part long, stretch long, words string")


def _split_parts(stretches_: DataFrame, window: int) -> DataFrame:
    """Flags of the stretches of very large parts: one part for each whole window."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, stretch, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                hashes = hashes_of(words_of(text))
                at = np.arange(len(hashes) - window + 1)
                a, b = (_Polynomial(hashes, m)(at, at + window).view(np.int64) for m in _MULTIPLIERS)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int64()), pa.array([stretch] * n, pa.int64()), pa.array(at, pa.int32()), pa.array(a), pa.array(b)],
                    ["part", "stretch", "at", "a", "b"])

    windows = work_table(map_batches(stretches_, explode, "part long, stretch long, at int, a long, b long"), "windows")
    many = work_table(windows.groupBy("part", "a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated-windows")
    return windows.join(many, ["part", "a", "b"], "left_semi").groupBy("part", "stretch").agg(
        F.expr("bit_or(shiftleft(1L, at))").alias("flags"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """``key``, n_words, n_removed, kept_sha256 and kept_spans of each row of ``docs``.

    Words are runs of characters other than space and 0x09-0x0D. Every word is removed that lies in a window of
    ``window`` words of its text that also begins anywhere else, in the same text too; windows are judged on the input.
    ``kept_spans`` are (first word, end) of what is left. Null texts have no words; texts shorter than a window lose
    none. Of repeated rows, each is a place of its own, so their windows repeat. An empty table gives no rows.
    """
    if not 0 <= window - prefix < 63:
        raise ValueError("a stretch has window - prefix + 1 windows, at most 63")
    rows = pick(docs, id=F.col(f"`{key}`"), text=F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    rows = rows.withColumn("body", F.xxhash64("text"))  # tells rows of one id apart; equal texts have equal results
    cut = work_table(_stretches_of(rows, window, prefix), "stretches")
    whole = cut.filter("first < 0").select("id", "body", F.col("n").alias("n_words"), "sha")
    cut = cut.filter("first >= 0").drop("sha")
    several = work_table(cut.groupBy("part").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("part"), "parts")
    cut = work_table(cut.join(several, "part"), "shared-stretches")
    # equal stretches as one, at its first place
    distinct = cut.groupBy("part", "stretch").agg(F.count(F.lit(1)).alias("like"), F.min(F.struct("id", "body", "first", "n")).alias("at"))
    distinct = work_table(distinct.select("part", "stretch", "like", "at.*"), "distinct-stretches")
    sizes = work_table(distinct.groupBy("part").agg(F.count(F.lit(1)).alias("size"), F.min("like").alias("least")), "part-sizes")
    # parts with a stretch that occurs once, beside others
    places = distinct.join(sizes.filter("size > 1 and least = 1"), "part")
    texts = work_table(_fetched(rows, places, window), "stretch-texts")
    texts = texts.join(sizes.select("part", (F.col("size") > PART_STRETCHES).alias("large")), "part").select("part", "stretch", "words", "large")
    texts = work_table(texts, "stretch-texts")
    ordinary = texts.filter("not large").drop("large").repartition("part").sortWithinPartitions("part")
    flags = map_batches(ordinary, _tree_batches(window), "part long, stretch long, flags long")
    flags = work_table(flags.unionByName(_split_parts(texts.filter("large").drop("large"), window)), "flags")
    decided = distinct.join(flags, ["part", "stretch"], "left").select(
        "part", "stretch", F.when(F.col("like") > 1, F.lit(-1).cast("long")).otherwise(F.coalesce("flags", F.lit(0).cast("long"))).alias("flags"))
    decided = work_table(decided.filter("flags <> 0"), "decided")
    marks = cut.join(decided, ["part", "stretch"]).groupBy("id", "body").agg(F.collect_set(F.struct("first", "n", "flags")).alias("marks"))
    marks = work_table(marks, "marks")
    untouched = whole.join(marks, [whole.id.eqNullSafe(marks.id), whole.body == marks.body], "left_anti").select(
        F.col("id"), "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"),
        F.when(F.col("n_words") > 0, F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("end")))).otherwise(F.array()).alias("kept_spans"))
    touched = rows.join(marks, [rows.id.eqNullSafe(marks.id), rows.body == marks.body]).select(rows.id, "text", "marks")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [], [], [], []
            for text_, some in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist()):
                words = words_of(text_)
                edges = np.zeros(len(words) + 1, np.int64)
                for m in some:
                    hit = m["first"] + np.flatnonzero([m["flags"] >> j & 1 for j in range(m["n"])])
                    np.add.at(edges, hit, 1)
                    np.add.at(edges, hit + window, -1)
                kept = np.cumsum(edges[:-1]) == 0
                turns = np.flatnonzero(np.diff(np.concatenate([[0], kept.astype(np.int8), [0]])))
                spans = [{"first": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])]
                left = b" ".join(w for s in spans for w in words[s["first"] : s["end"]])
                for o, x in zip(out, (len(words), int((~kept).sum()), hashlib.sha256(left).hexdigest(), spans)):
                    o.append(x)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(o, k) for o, k in zip(out, kinds))], ["id", "n_words", "n_removed", "kept_sha256", "kept_spans"])

    done = map_batches(touched, remove, untouched.schema)
    return untouched.unionByName(done).withColumnRenamed("id", key)

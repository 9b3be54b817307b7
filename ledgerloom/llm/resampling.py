"""Importance resampling towards a target's distribution of hashed n-grams, with texts cut into lines.

Features are runs of one to three words. A line break is no part of a word, so every text is its lines plus the few
features that cross from one line to another:

1. One scan writes a slim row per document: how many words, the digests of its lines with their counts, and the buckets
   of the features that cross lines. Another brings equal lines together and writes each once, with its occurrences.
2. The features of a distinct line are counted once and multiplied by its occurrences; those across lines are added.
   The counts of all buckets, bounded by their number, give each bucket's gain.
3. Each distinct line is weighed once. Documents get the weights of their lines by digest, and their own features'
   gains; scores are sorted over the cluster, and a row's rank is its place in its sorted part plus the parts before.

No text moves but distinct lines, and those are combined in each task first, so a line that a third of all rows share
is a row per task.
"""
from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import map_batches, pick, work_table

#: Words are runs of ASCII letters, digits and all other characters beyond ASCII, in ASCII lower case.
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def lines_of(text: bytes) -> list[list[bytes]]:
    """The words of each line that has any."""
    return [words for line in text.translate(_LOWER).split(b"\n") if (words := _WORDS.findall(line))]


def digest(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


def grams(words: list[bytes]) -> tuple[list[int], list[int], list[int]]:
    """crc32 of the runs of one, two and three words that begin at each word; a run's goes on from the shorter one's."""
    spaced = [b" " + w for w in words]
    one = list(map(zlib.crc32, words))
    two = list(map(zlib.crc32, spaced[1:], one))
    return one, two, list(map(zlib.crc32, spaced[2:], two))


def crossing(lines: list[list[bytes]]) -> list[int]:
    """crc32 of the features that hold words of more than one line."""
    out: list[int] = []
    before: list[bytes] = []  # the last two words so far
    for line in lines:
        near = before + line[:2]
        k = len(before)
        one, two, three = grams(near)
        out += two[k - 1 : k] if k else []
        out += [c for i, c in enumerate(three) if i < k < i + 3]
        before = (before + line[-2:])[-2:]
    return out


def line_features(lines: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the line, bucket) of every feature within each of the lines."""
    cut = [line.split(b" ") for line in lines]
    of = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
    one, two, three = (np.array(x, np.int64) for x in grams([w for c in cut for w in c]))
    in_two, in_three = of[:-1] == of[1:], of[:-2] == of[2:]
    places = np.concatenate([of, of[: len(two)][in_two], of[: len(three)][in_three]])
    return places, np.concatenate([one, two[in_two], three[in_three]]) % buckets


# ---- over documents -------------------------------------------------------------------------------------------------


def _slim(docs: DataFrame, key: str, text: str, buckets: int) -> DataFrame:
    """row, key, n_words, lines (digest, n) and crossing (buckets) of each document."""
    kind = pick(docs, key=F.col(f"`{key}`")).dtypes[0][1]
    line_type = pa.list_(pa.struct([("digest", pa.binary()), ("n", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, lines, across = [], [], []
            for raw in batch.column(1).to_pylist():
                found = lines_of(raw)
                words.append(sum(map(len, found)))
                lines.append([{"digest": d, "n": n} for d, n in Counter(digest(b" ".join(x)) for x in found).items()])
                across.append([c % buckets for c in crossing(found)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(lines, line_type), pa.array(across, pa.list_(pa.int32()))], ["key", "n_words", "lines", "crossing"])

    rows = map_batches(_binary(docs, key, text), cut, f"key {kind}, n_words long, lines array<struct<digest binary, n long>>, crossing array<int>")
    return work_table(rows.withColumn("row", F.monotonically_increasing_id()), "slim")


def _binary(docs: DataFrame, key: str, text: str) -> DataFrame:
    return pick(docs, key=F.col(f"`{key}`"), text=F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary"))


def _distinct_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """line (its words, joined by one space) and how often it occurs in all texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(b" ".join(x) for raw in batch.column(0).to_pylist() for x in lines_of(raw))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["line", "n"])

    rows = map_batches(_binary(docs, key, text).select("text"), cut, "line binary, n long")
    return work_table(rows.groupBy("line").agg(F.sum("n").alias("n")), "lines")


def _bucket_counts(slim: DataFrame, lines: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of all features in each bucket: the lines' own, times their occurrences, and those across lines."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            n = batch.column(1).to_numpy()
            places, found = line_features(batch.column(0).to_pylist(), buckets)
            np.add.at(total, found, n[places])
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met])], ["bucket", "n"])

    within = map_batches(lines.select("line", "n"), counted, "bucket long, n long")
    across = slim.select(F.explode(F.col("crossing").cast("array<bigint>")).alias("bucket"), F.lit(1).cast("long").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in within.unionByName(across).groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """Per bucket, a thousand times the logarithm of how much likelier the target has it, smoothed by one, rounded down."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return [math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist())]


def _line_weights(lines: DataFrame, gain: list[int]) -> DataFrame:
    """digest and weight of each distinct line."""
    of = np.array(gain, np.int64)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            places, found = line_features(texts, len(of))
            total = np.zeros(len(texts), np.int64)
            np.add.at(total, places, of[found])
            yield pa.RecordBatch.from_arrays([pa.array(map(digest, texts), pa.binary()), pa.array(total)], ["digest", "weight"])

    return map_batches(lines.select("line"), weighed, "digest binary, weight long")


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``rank``, the place from 1 on in that order, without a window over all rows."""
    placed = work_table(rows.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "sorted")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # as many rows as the sort had tasks
    parts = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    return placed.join(parts, "part").withColumn("rank", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).drop("part", "place", "before")


def noise(key: Column, seed: int) -> Column:
    """A thousand times a Gumbel variate, rounded down, drawn from the hash of the seed and the key."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, buckets: int = 10_000, seed: int = 42,
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_features, weight, score and rank of every row of ``docs``.

    weight: the gains of all features. score: weight and noise by the key, so that the best scores are a draw without
    replacement. rank: 1, 2, ... for the drawn rows, which are ``percent`` of a hundred of those with at least
    ``least_words`` words (rounded down); ties go to the smaller key, a null one last; rows of one key and text share
    score and stand in any order. Null texts have no words; other columns do not go along. An empty target leaves only
    the source's counts; an empty table gives no rows.
    """
    slim, lines = _slim(docs, key, text, buckets), _distinct_lines(docs, key, text)
    source = _bucket_counts(slim, lines, buckets)
    wanted = _bucket_counts(_slim(target, text, text, buckets), _distinct_lines(target, text, text), buckets)
    gain = gains(source, wanted)
    of_lines = slim.select("row", F.explode("lines").alias("line")).select("row", F.col("line.digest").alias("digest"), F.col("line.n").alias("n"))
    of_lines = of_lines.join(_line_weights(lines, gain), "digest").groupBy("row").agg(F.sum(F.col("n") * F.col("weight")).alias("within"))
    table = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")
    across = F.aggregate("crossing", F.lit(0).cast("bigint"), lambda total, bucket: total + F.get(table, bucket))
    n = F.col("n_words")
    features = n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))
    weighed = slim.join(of_lines, "row", "left").select("key", "n_words", features.cast("long").alias("n_features"), (F.coalesce("within", F.lit(0)) + across).alias("weight"))
    scored = work_table(weighed.select("*", (F.col("weight") + noise(F.col("key"), seed)).alias("score"), (n >= least_words).alias("fit")), "scored")
    drawn = scored.filter("fit").count() * percent // 100
    found = ranked(scored, F.desc("fit"), F.desc("score"), F.asc_nulls_last("key"))
    rank = F.when(F.col("fit") & (F.col("rank") <= drawn), F.col("rank"))
    return found.select(F.col("key").alias(key), "n_features", "weight", "score", rank.alias("rank"))

"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled texts: one on ordinary windows, one on windows that
are typical of toxic texts. A window's distance is how many bytes shorter it gets when the toxic dictionary is at hand
too. The numbers of windows at or above each distance are calibrated to a probability on rows that the dictionaries
have not seen, and 0.5 is the threshold.

Windows are single words in lower case with the space before them, so that a worker can keep the distances of words it
has met. Each is followed by a fixed carrier that both dictionaries hold: zstandard begins no match in the last bytes of
its input and leaves short input as it is, which would hide what a word costs.
"""
from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_batches, pick

#: Labelled rows of each class used, about: all there are, or a share chosen by their ids' hash.
SAMPLE_TOXIC, SAMPLE_ORDINARY = 3_000, 6_000
#: One in so many sampled rows calibrates and is kept from the dictionaries.
CALIBRATION = 3
#: Lengths of word beginnings, with their space, that are compared between the classes.
BEGINNINGS = range(5, 10)
#: A beginning is typical if chance gives its toxic rows with at most this probability, and it is so many times as frequent.
CHANCE, TIMES = 1e-6, 5
#: Most windows of either dictionary, and bytes of the ordinary one.
WINDOWS, ORDINARY_BYTES = 20_000, 112 << 10
#: Distances that are counted, as bytes and as shares of the window, and words kept by one worker; beyond, its memo starts anew.
DISTANCES, SHARES, MEMO_WORDS = range(1, 7), (0.2, 0.3, 0.4, 0.5), 200_000

_WORD = re.compile(r"\w+")
_CARRIER = b" " + bytes(range(1, 32))


def windows(text: str | None) -> set[str]:
    """The distinct windows of a whole text."""
    return {" " + w for w in _WORD.findall((text or "").lower())}


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray  # of the features, the last one alone
    prior: float  # score where no toxic dictionary could be trained

    def distances(self) -> "_Distances":
        return _distances_of(self.toxic, self.ordinary)

    def features(self, text: str | None) -> np.ndarray:
        distance, met = self.distances(), windows(text)
        found = [(d, d / len(w.encode())) for w in met if (d := distance[w]) > 0]
        counts = [sum(d >= k for d, _ in found) for k in DISTANCES] + [sum(s >= k for _, s in found) for k in SHARES]
        most = max(found, default=(0, 0.0))[0], max((s for _, s in found), default=0.0)
        return np.array([*np.log1p(counts), *most, math.log1p(len(met)), 1.0])

    def score(self, text: str | None) -> float:
        if not self.toxic:
            return self.prior
        z = float(self.features(text) @ self.weights)
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


class _Distances(dict):
    """Window -> bytes that the toxic dictionary saves."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard as zstd

        settings = zstd.ZstdCompressionParameters(
            format=zstd.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
            window_log=18, hash_log=16, chain_log=16, search_log=6, min_match=5, strategy=zstd.STRATEGY_LAZY2)

        def coder(content):
            made = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(compression_params=settings)
            return zstd.ZstdCompressor(dict_data=made, compression_params=settings).compress

        # the ordinary part is last in both, so that its matches cost the same
        self.with_toxic, self.without = coder(toxic + ordinary + _CARRIER), coder(ordinary + _CARRIER)

    def __missing__(self, window: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        data = window.encode() + _CARRIER
        value = self[window] = len(self.without(data)) - len(self.with_toxic(data))
        return value


@functools.lru_cache(maxsize=2)
def _distances_of(toxic: bytes, ordinary: bytes) -> _Distances:
    return _Distances(toxic, ordinary)


def trained(samples: list[bytes], size: int) -> bytes:
    """The content zstandard selects from the samples; nothing if it finds them too few."""
    import zstandard as zstd

    try:
        return zstd.train_dictionary(size, samples, level=3).as_bytes()
    except zstd.ZstdError:
        return b""


def by_chance(toxic: int, ordinary: int, share: float) -> float:
    """Probability that at least ``toxic`` of all these rows are toxic if ``share`` of rows are."""
    n, total = toxic + ordinary, 0.0
    for k in range(toxic, n + 1):
        log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share)
        term = math.exp(log)
        total += term
        if k > toxic and term < total * 1e-6:
            break
    return total


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, whole, toxic) for the distinct windows of each text and their beginnings."""
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = windows(text)
            starts = {w[:k] for w in found for k in BEGINNINGS if len(w) >= k}
            grams = [*found, *starts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.string()), pa.array([True] * len(found) + [False] * len(starts), pa.bool_()), pa.array([toxic] * len(grams), pa.int32())], ["gram", "whole", "toxic"])


def train(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model of the labelled rows whose ``key`` fulfils ``learn``; rows without a key, label or text teach nothing."""
    known = pick(labels, key=F.col(f"`{key}`"), toxic=F.col(f"`{label}`").cast("int"), learn=learn).filter("learn and key is not null and toxic in (0, 1)")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / total if total else 0.0
    nothing = Model(b"", b"", np.zeros(0), min(prior, 0.499))
    if len(sizes) < 2:
        return nothing
    place = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit(0)), F.lit(1 << 20))
    share = F.when(F.col("toxic") == 1, SAMPLE_TOXIC / sizes[1]).otherwise(SAMPLE_ORDINARY / sizes[0])
    chosen = known.filter(place < share * (1 << 20)).select("key", "toxic").dropDuplicates(["key"])  # bounded: about the two sample sizes
    rows = pick(docs, key=F.col(f"`{key}`"), text=F.col(f"`{text}`").cast("string")).join(F.broadcast(chosen), "key").filter("text is not null")
    rows = rows.groupBy(F.xxhash64("text").alias("same")).agg(F.min(F.struct("key", "text", "toxic")).alias("row")).select("row.*")  # copies teach once
    part = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit(1)), F.lit(CALIBRATION))
    grams = map_batches(rows.filter(part > 0).select("text", "toxic"), _beginnings, "gram string, whole boolean, toxic int")
    counts = grams.groupBy("gram", "whole").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).cache()
    taught = {r["toxic"]: r["n"] for r in rows.filter(part > 0).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad_rows, good_rows = taught.get(1, 0), taught.get(0, 0)
    if not bad_rows or not good_rows:
        return nothing
    often = (F.col("bad") >= 3) & (F.col("bad") / bad_rows > TIMES * (F.col("good") + 0.5) / good_rows)
    starts = counts.filter(~F.col("whole") & often).orderBy(F.desc("bad"), "gram").limit(WINDOWS).collect()
    typical = {r["gram"] for r in starts if by_chance(r["bad"], r["good"], bad_rows / (bad_rows + good_rows)) < CHANCE}
    typical_list = F.array(*(F.lit(g) for g in sorted(typical))).cast("array<string>")
    beginning = F.arrays_overlap(F.array(*(F.substring("gram", 1, k) for k in BEGINNINGS)), typical_list)
    bad = counts.filter("whole and bad > 0").filter(beginning).orderBy(F.desc("bad"), "gram").limit(WINDOWS).collect()
    good = counts.filter("whole and good > 0").filter(~beginning).orderBy(F.desc("good"), "gram").limit(WINDOWS).collect()
    counts.unpersist()
    if not bad:
        return nothing
    bad_windows = [w for r in bad for w in [r["gram"].encode()] * min(r["bad"], 50)]
    toxic = trained(bad_windows, ORDINARY_BYTES) + b"".join(r["gram"].encode() for r in reversed(bad)) + b" "
    ordinary = trained([w for r in good for w in [r["gram"].encode()] * min(r["good"], 20)], ORDINARY_BYTES)
    model = Model(toxic, ordinary, np.zeros(len(DISTANCES) + len(SHARES) + 4), prior)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.features(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.float64()))], ["toxic", "features"])

    apart = map_batches(rows.filter(part == 0).select("text", "toxic"), measured, "toxic int, features array<double>").collect()
    apart.sort(key=lambda r: (r["toxic"], r["features"]))
    if len({r["toxic"] for r in apart}) < 2:
        return nothing
    model.weights = fit_logistic(np.array([r["features"] for r in apart]), np.array([r["toxic"] for r in apart], float))
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, score (0 to 1) and predicted (1 from 0.5 on) of each row.

    Null and empty texts have no windows and get the score of none. Where nothing could be learnt, every score is the
    share of toxic labels, below 0.5. Repeated rows are scored alike; an empty table gives no rows.
    """
    rows = pick(docs, key=F.col(f"`{key}`"), text=F.col(f"`{text}`").cast("string"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64()), pa.array([int(s >= 0.5) for s in found], pa.int32())], ["key", "score", "predicted"])

    schema = rows.select("key").schema.add("score", "double").add("predicted", "integer")
    return map_batches(rows, scored, schema).withColumnRenamed("key", key)

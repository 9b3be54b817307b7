"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Three passes. Document frequencies are counted over all training texts. The regression is fitted by
follow-the-regularised-leader steps with elastic-net penalties on a bounded sample of training rows, whose n-gram
counts (never more than ``BUCKETS`` a row) meet in one task; a part of the sample stays apart to calibrate the
temperature of the probabilities. Every whole text is then scored where it is; the model is all that is sent.
"""
from __future__ import annotations

import functools
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import map_batches, pick

#: n-grams of these many characters, hashed into so many buckets.
ORDERS, BUCKETS = (1, 2, 3), 1 << 15
#: Rows of each language, about, on which the regression is fitted: all different ones there are, or a share
#: chosen by the hash of id and text, and never more than twice as many.
SAMPLE_ROWS = 1_500
#: One in so many sampled rows calibrates the temperature only.
CALIBRATION = 5
#: Learning rate, its offset, and the penalties of absolute and squared weights.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 0.01, 2
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")


@functools.cache
def _letters() -> np.ndarray:
    """Each code point itself if a letter, else a space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m.group().isalpha() for m in _LETTER.finditer(text))


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, count) of the n-grams of a whole text in lower case; anything but letters counts as a space."""
    letters = _letters()[np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)]
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != 32) | (letters[:-1] != 32)  # runs of spaces count as one
    letters = letters[keep].astype(np.uint64)
    counts = np.zeros(BUCKETS, np.int64)
    value = np.zeros(len(letters), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        m = len(letters) - n + 1
        if m <= 0:
            break
        value = value[:m] * np.uint64(0x100000001B3) + letters[n - 1 :] + np.uint64(n)
        if n in ORDERS:
            mixed = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            counts += np.bincount((mixed >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1), minlength=BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # (labels, BUCKETS), sparse in value
    bias: np.ndarray
    idf: np.ndarray
    temperature: float = 1.0

    def features(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[buckets]
        return x / max(np.sqrt(x @ x), 1e-12)

    def logits(self, buckets: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self.weights[:, buckets] @ x + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.labels or not has_letter(text):
            return UNDETERMINED, 0.0
        buckets, counts = ngrams(text)
        p = _softmax(self.logits(buckets, self.features(buckets, counts)) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray) -> Model:
    """The regression over (label, buckets, counts), in the order given; every ``CALIBRATION``-th row calibrates."""
    labels = sorted({r[0] for r in rows})
    model = Model(labels, np.zeros((len(labels), len(idf))), np.zeros(len(labels)), idf)
    if not labels:
        return model
    z, n = np.zeros((len(labels), len(idf) + 1)), np.zeros((len(labels), len(idf) + 1))
    data = []
    for label, buckets, counts in rows:
        x = model.features(buckets, counts)
        data.append((labels.index(label), np.append(buckets, len(idf)), np.append(x, 1.0)))
    apart = data[::CALIBRATION] if len(data) >= 2 * CALIBRATION else []
    learn = [d for i, d in enumerate(data) if not apart or i % CALIBRATION]

    def weights(zs, ns, l1=L1):
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for y, at, x in learn:
            w = weights(z[:, at], n[:, at])
            p = _softmax(w @ x)
            p[y] -= 1.0
            g = p[:, None] * x
            rate = (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / ALPHA
            z[:, at] += g - rate * w
            n[:, at] += g * g
    w = weights(z, n)
    model.weights, model.bias = w[:, :-1], w[:, -1]
    if apart:
        scores = [(y, model.logits(at[:-1], x[:-1])) for y, at, x in apart]

        sure = (len(scores) + 1) / (len(scores) + 2)  # no finite sample makes certain

        def loss(t):
            total = 0.0
            for y, s in scores:
                p = np.log(np.maximum(_softmax(s / t), 1e-12))
                total -= sure * p[y] + (1 - sure) * (p.sum() - p[y]) / max(1, len(p) - 1)
            return total

        model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    return model


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of the task have each bucket; bucket -1: how many texts there are."""
    found, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            found[ngrams(text)[0]] += 1
            n += 1
    some = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(found[some], n))], ["bucket", "texts"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [ngrams(t) for t in batch.column("text").to_pylist()]
        lists = [pa.array([m[k] for m in made], pa.list_(pa.int32())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("label"), *lists], ["place", "label", "buckets", "counts"])


def train(docs: DataFrame, learn: Column, label: str = "lang", key: str = "doc_id", text: str = "text") -> Model:
    """The model of the rows where ``learn`` holds and ``label`` and ``text`` are not null and the text has letters."""
    rows = pick(docs, text=F.col(f"`{text}`").cast("string"), label=F.col(f"`{label}`").cast("string"),
                place=F.xxhash64(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`").cast("string")), learn=learn)
    rows = rows.filter("learn and label is not null").filter(F.col("text").rlike(r"\p{L}"))
    sums = map_batches(rows.select("text"), _frequencies, "bucket int, texts long").groupBy("bucket").agg(F.sum("texts").alias("texts"))
    texts = np.zeros(BUCKETS + 1, np.int64)  # the last one: all texts
    for r in sums.collect():  # at most a row for each bucket
        texts[r["bucket"]] = r["texts"]
    idf = np.log((1 + texts[-1]) / (1 + texts[:-1])) + 1
    # the share of each language's different rows: a row for each language
    shares = {r["label"]: min(1.0, SAMPLE_ROWS / r["n"]) for r in rows.groupBy("label").agg(F.approx_count_distinct("place").alias("n")).collect()}
    if not shares:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0), idf)
    share = F.create_map(*(F.lit(x) for kv in sorted(shares.items()) for x in kv))[F.col("label")]
    sample = rows.filter(F.pmod("place", F.lit(1 << 20)) < share * (1 << 20))
    sample = sample.groupBy("label", "place").agg(F.min("text").alias("text"))  # a row repeated any number of times teaches once
    nth = F.row_number().over(W.partitionBy("label").orderBy(F.pmod("place", F.lit(1 << 20)), "place"))
    sample = sample.withColumn("nth", nth).filter(F.col("nth") <= 2 * SAMPLE_ROWS).select("place", "label", "text")
    counted = map_batches(sample, _counted, "place long, label string, buckets array<int>, counts array<int>")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            place, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(len(place)):
                held.append((place[i], labels[i], batch.column(2)[i].values.to_numpy().astype(np.int32), batch.column(3)[i].values.to_numpy().astype(np.int32)))
        held.sort(key=lambda r: r[:2])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit([r[1:] for r in held], idf))], pa.binary())], ["model"])

    return pickle.loads(map_batches(counted.repartition(1), fitted, "model binary").first()["model"])


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``key``, lang_pred and score (of the predicted language) of each row, and the columns in ``carry`` as ``input``.

    Texts that are null or have no letter, and all texts if nothing could be learnt, are ``und`` with score 0.
    """
    extra = {"input": F.struct(*(F.col(f"`{c}`") for c in carry))} if carry else {}
    rows = pick(docs, key=F.col(f"`{key}`"), text=F.col(f"`{text}`").cast("string"), **extra)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sent.value.predict(t) for t in batch.column("text").to_pylist()]
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
                [*kept, "lang_pred", "score"])

    schema = rows.drop("text").schema.add("lang_pred", "string").add("score", "double")
    return map_batches(rows, score, schema).withColumnRenamed("key", key)

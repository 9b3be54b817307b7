"""Token counts: Arrow batches of whole texts go in, lengths come out, token ids never leave the worker.

Null texts count as empty. An empty table gives an empty result. Other columns of the input do not go along; repeated
rows are counted each for itself. Texts of any length are split at safe borders, so no text is too long.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import tokens
from .common import map_batches, pick


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row of ``docs``."""
    kind = docs.select(F.col(f"`{key}`").alias("key")).schema["key"].dataType.simpleString()
    schema = f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            n = pa.array(tokens.counts(path, texts.to_pylist()), pa.int64())
            n_bytes = pc.cast(pc.binary_length(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, n, pc.greater(n, limit)], [key, "n_bytes", "n_tokens", "over_limit"])

    return map_batches(pick(docs, key, text=F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))), count, schema)

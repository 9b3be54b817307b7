"""Benchmark decontamination with suffix arrays of the training text.

Each task builds suffix arrays over shards of its documents' words and looks every suffix of every benchmark item up by
binary search. The suffixes that begin with a common window are neighbours in the array, so one search gives all
places of a window. Only suffixes whose first words all occur in the benchmark enter the array: no others can match.

The benchmark is sent to the tasks in blocks of bounded size; a document's hits travel with its row from block to block,
so nothing is shuffled, and a long document, a hot source or a passage in every document is no special case.
"""
from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, pick

#: Words of a window.
WINDOW = 10
#: Most bytes of benchmark text sent to the tasks at once, unless one item alone is longer.
BLOCK_BYTES = 16 << 20
#: Words of one shard, that is of one suffix array, unless one document alone is longer.
SHARD_WORDS = 1 << 18

#: Bytes of words are 0-9, a-z and all from 0x80 on; A-Z count as a-z, anything else parts words.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LETTERS).split()


@dataclass
class Items:
    """A block of benchmark items, ready for searching."""

    ids: list[str | None]
    vocabulary: dict[bytes, int]
    windows: np.ndarray  # word numbers of each distinct window, as keys; 0 past the end of a short one
    widths: np.ndarray  # words of each window
    owners: np.ndarray  # item of each (window, item) pair, in the order of windows
    first_owner: np.ndarray  # where the pairs of each window begin; one more at the end
    origin: np.ndarray  # place in its item of each pair's window


def _keys(words: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort as the rows do."""
    return np.ascontiguousarray(words.astype(">u4")).view(f"S{4 * words.shape[1]}").ravel()


def prepare(items: list[tuple[str | None, str]], width: int = WINDOW) -> Items:
    vocabulary: dict[bytes, int] = {}
    rows: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for i, (_, text) in enumerate(items):
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        for j in range(max(1, len(ids) - width + 1) if ids else 0):
            rows.setdefault(tuple(ids[j : j + width]), []).append((i, j))
    windows = np.zeros((len(rows), width), np.int64)
    for k, row in enumerate(rows):
        windows[k, : len(row)] = row
    pairs = [p for owners in rows.values() for p in owners]
    return Items(
        ids=[i for i, _ in items], vocabulary=vocabulary, windows=windows, widths=np.array([len(r) for r in rows], np.int64),
        owners=np.array([i for i, _ in pairs], np.int64), origin=np.array([j for _, j in pairs], np.int64),
        first_owner=np.cumsum([0, *(len(o) for o in rows.values())]),
    )


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every span, one span after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - before, lengths)


def occurrences(words: np.ndarray, items: Items, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of each occurrence in ``words``: numbers of the vocabulary, 0 for other words.

    A 0 stands between documents, so no window reaches over a border.
    """
    none = np.zeros(0, np.int64)
    if not len(items.widths) or not len(words):
        return none, none
    padded = np.concatenate([words, np.zeros(width, words.dtype)])
    known = np.concatenate([[0], np.cumsum(padded > 0)])
    shortest = int(items.widths.min())
    suffixes = np.flatnonzero(known[shortest : shortest + len(words)] - known[: len(words)] == shortest)
    if not len(suffixes):
        return none, none
    heads = padded[suffixes[:, None] + np.arange(width)]
    ends = np.cumprod(heads > 0, axis=1).astype(heads.dtype)
    keys = _keys(heads * ends)  # nothing counts past the end of a document or an unknown word
    order = np.argsort(keys, kind="stable")
    suffixes, keys = suffixes[order], keys[order]
    upper = items.windows.copy()
    upper[np.arange(width) >= items.widths[:, None]] = 0xFFFFFFFF
    low = np.searchsorted(keys, _keys(items.windows), "left")
    high = np.searchsorted(keys, _keys(upper), "right")
    return np.repeat(np.arange(len(low)), high - low), suffixes[_spans(low, high - low)]


def _shards(texts: list[str | None], vocabulary: dict[bytes, int], size: int = SHARD_WORDS) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """(documents, word numbers, first word of each document and the end) of shards of whole documents."""
    first, parts, starts, n = 0, [], [0], 0
    for i, text in enumerate(texts):
        words = words_of(text)
        parts.append(np.fromiter(map(vocabulary.get, words, itertools.repeat(0)), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))
        n += len(words) + 1
        starts.append(n)
        if n >= size or i == len(texts) - 1:
            yield range(first, i + 1), np.concatenate(parts), np.array(starts)
            first, parts, starts, n = i + 1, [], [0], 0


def _item_blocks(items: DataFrame, item: str, text: str, limit: int) -> Iterator[Items]:
    """The benchmark in blocks of about ``limit`` bytes: their number follows from its size, id and text choose the block."""
    rows = pick(items, id=F.col(f"`{item}`").cast("string"), text=F.col(f"`{text}`").cast("string")).filter("text is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-2 * total // limit) if total > limit else 1)
    for block in range(blocks):
        chosen = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        yield prepare([(r["id"], r["text"]) for r in chosen.collect()])


def _scan_batch(batch: pa.RecordBatch, items: Items) -> pa.RecordBatch:
    """The batch with the hits of one block of items added to its marks."""
    texts, marks, found = (batch.column(c).to_pylist() for c in ("text", "hits", "item_ids"))
    n_words, n_hit = [0] * len(texts), [0] * len(texts)
    for docs, words, starts in _shards(texts, items.vocabulary):
        window, at = occurrences(words, items)
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + items.widths[window], -1)
        hit = np.cumsum(edges[:-1]) > 0
        doc = np.searchsorted(starts, at, "right") - 1
        seen = np.unique(doc * len(items.widths) + window) if len(at) else np.zeros(0, np.int64)
        doc, window = seen // max(1, len(items.widths)), seen % max(1, len(items.widths))
        pairs = items.first_owner[window + 1] - items.first_owner[window]
        owners = items.owners[_spans(items.first_owner[window], pairs)]
        met = np.unique(np.repeat(doc, pairs) * len(items.ids) + owners) if len(owners) else np.zeros(0, np.int64)
        for x in met.tolist():
            i, name = docs[x // len(items.ids)], items.ids[x % len(items.ids)]
            if name is not None:
                found[i] = [*(found[i] or ()), name]
        for k, i in enumerate(docs):
            own = hit[starts[k] : starts[k + 1] - 1]
            if marks[i] is not None:
                own = own | np.unpackbits(np.frombuffer(marks[i], np.uint8), count=len(own)).astype(bool)
            n_words[i], n_hit[i] = len(own), int(own.sum())
            marks[i] = np.packbits(own).tobytes() if n_hit[i] else None
    new = {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()), "hits": pa.array(marks, pa.binary()), "item_ids": pa.array(found, pa.list_(pa.string()))}
    names = batch.schema.names
    return pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in names], names)


def mark(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
         carry: list[str] | None = None, limit: int = BLOCK_BYTES) -> DataFrame:
    """Each row of ``docs`` with ``key``, n_words, n_hit, item_ids (sorted, distinct) and the columns in ``carry`` as ``input``.

    A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but at least one, is one window. A
    word of a document is hit if it lies in an occurrence of a window. Null texts have no words; items without words
    or a text never occur; items without an id hit words but are not in item_ids; items of one id count as one. An empty benchmark hits nothing; an empty table of
    documents gives no rows; repeated rows are judged each for itself.
    """
    extra = {"input": F.struct(*(F.col(f"`{c}`") for c in carry))} if carry else {}
    none = F.lit(0).cast("long")
    rows = pick(docs, key=F.col(f"`{key}`"), text=F.col(f"`{text}`").cast("string"), n_words=none, n_hit=none,
                hits=F.lit(None).cast("binary"), item_ids=F.array().cast("array<string>"), **extra)
    for block in _item_blocks(items, item, item_text, limit):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            return (_scan_batch(batch, sent.value) for batch in batches)

        rows = map_batches(rows, scan, rows.schema)
    return rows.select(F.col("key").alias(key), "n_words", "n_hit", F.array_sort(F.array_distinct("item_ids")).alias("item_ids"), *extra)


def longest_matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                    item_text: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """The verbatim matches of at least a window, each as long as it gets: ``key``, doc_word, item_id, item_word, n_words.

    ``doc_word`` and ``item_word`` are the places, from 0, of the match's first word. Nulls and empty tables as in ``mark``,
    but that items without an id match with a null item_id; equal items count as one.
    """
    kind = docs.select(F.col(f"`{key}`").alias("key")).schema["key"].dataType.simpleString()
    rows, out = pick(docs, key=F.col(f"`{key}`"), text=F.col(f"`{text}`").cast("string")), None
    for block in _item_blocks(items, item, item_text, limit):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for docs_, words, starts in _shards(batch.column(1).to_pylist(), sent.value.vocabulary):
                    yield _runs(batch.column(0), docs_, words, starts, sent.value, key)

        found = map_batches(rows, search, f"`{key}` {kind}, doc_word long, item_id string, item_word long, n_words long")
        out = found if out is None else out.unionByName(found)
    return out


def _runs(keys: pa.Array, docs: range, words: np.ndarray, starts: np.ndarray, items: Items, key: str) -> pa.RecordBatch:
    """Occurrences that follow each other in document and item, joined into one match each."""
    window, at = occurrences(words, items)
    pairs = items.first_owner[window + 1] - items.first_owner[window]
    spans = _spans(items.first_owner[window], pairs)
    owner, origin, at, width = items.owners[spans], items.origin[spans], np.repeat(at, pairs), np.repeat(items.widths[window], pairs)
    order = np.lexsort((at, at - origin, owner))
    owner, origin, at, width = owner[order], origin[order], at[order], width[order]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(owner) != 0) | (np.diff(at - origin) != 0) | (np.diff(at) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    doc = np.searchsorted(starts, at[first], "right") - 1
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(doc + docs.start)), pa.array(at[first] - starts[doc]), pa.array([items.ids[i] for i in owner[first]], pa.string()),
         pa.array(origin[first]), pa.array(at[last] + width[last] - at[first])],
        [key, "doc_word", "item_id", "item_word", "n_words"],
    )

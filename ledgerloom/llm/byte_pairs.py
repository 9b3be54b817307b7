"""Byte-level BPE by higher-order functions: ranked merges folded over distinct words, and decoding.

Encoding is one pass over the documents, without a shuffle:

1. A task cuts its texts by the vocabulary's pattern. A word (a match of the pattern) that it has not met yet goes ahead
   of the documents as an array with a part per byte; documents follow as places in the list of words. Words that are
   tokens themselves are settled there.
2. Spark folds the merges over each array: of all adjacent pairs the one of least rank becomes one token, until no
   pair has a rank. Ranks come from a literal map, kept in buckets so that a look-up meets a pair or two.
3. The task's second worker holds the folded words and puts each document's ids together.

Distinct words of the whole table would have to meet all their occurrences again in a shuffle several times the input,
so words are distinct per task, in a list that starts anew beyond ``LIST_WORDS`` or ``LIST_BYTES``. Words of more than
``FOLD_BYTES`` bytes, whose fold would be quadratic, are merged with a heap instead: same ranks, same ids.

Decoding is all JVM: the binary pieces of a document's ids, concatenated.
"""
from __future__ import annotations

import base64
import functools
import heapq
import json
from collections.abc import Iterator
from itertools import chain, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import tokens
from .common import map_batches, pick

#: Words, and bytes of words, that a task's list holds before it starts anew.
LIST_WORDS, LIST_BYTES = 500_000, 16 << 20
#: Longest word that is folded.
FOLD_BYTES = 256
#: Bytes of text cut at once, words of one row, and buckets of the rank map (a prime).
CUT_BYTES, ROW_WORDS, BUCKETS = 1 << 20, 256, 99_991
#: Ids and ranks are below ``PAIR - 1``, so a pair of ids is one number, as is an id with a place before ``PLACED``.
PAIR, PLACED, NO_RANK = 1 << 20, 1 << 29, 1 << 20
#: The part before a word's first one: its id is no token's, so it has no rank with any other.
EDGE = NO_RANK * PLACED + PAIR - 1


@functools.lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, of a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=4)
def _pattern(pattern: str):
    import regex

    return regex.compile(pattern)


def _is_odd(word: str) -> bool:
    """True if the faster pattern may cut a text with this word in another way than the usual one does."""
    return not (word.isascii() and word.isprintable()) and tokens._odd().search(word) is not None


def words_of(texts: list[str], pattern: str, usual: str, known: dict | set, odd: set[str]) -> tuple[list[list[str]], set[str]]:
    """Matches of ``pattern`` in each text, and those that are not ``known``.

    For the ``usual`` pattern, texts without rare characters take the faster equal one. Its words hold every character, so
    rare ones are looked for in new words only; ``odd`` holds the known words with such characters and gathers the new.
    """
    if pattern != usual:
        cut = [*map(_pattern(pattern).findall, texts)]
        return cut, set().union(*cut).difference(known)
    cut = [*map(tokens._pieces().findall, texts)]
    distinct = set().union(*cut)
    new = distinct.difference(known)
    odd.update(filter(_is_odd, new))
    if not odd.isdisjoint(distinct):
        for i, words in enumerate(cut):
            if not odd.isdisjoint(words):
                cut[i] = _pattern(pattern).findall(texts[i])
        new = set().union(*cut).difference(known)
        odd.update(filter(_is_odd, new))
    return cut, new


def heap_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word of any length: least rank first, leftmost of equals, by a heap over linked parts."""
    ends = list(range(1, len(word) + 1))  # end of the part that starts here; 0 if none does
    before = list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        middle = ends[start]
        if middle < len(word) and (rank := ranks.get(word[start : ends[middle]])) is not None:
            heapq.heappush(heap, (rank, start, ends[middle]))

    for start in range(len(word)):
        offer(start)
    while heap:
        _, start, end = heapq.heappop(heap)
        middle = ends[start]
        if not middle or middle >= end or ends[middle] != end:
            continue  # one of its parts has become part of another
        ends[start], ends[middle] = end, 0
        if end < len(word):
            before[end] = start
            offer(start)
        if before[start] >= 0:
            offer(before[start])
    out, at = [], 0
    while at < len(word):
        out.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return out


# ---- the fold -------------------------------------------------------------------------------------------------------


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The literal map of every pair of tokens that is a token together, in buckets: pair -> rank."""
    buckets: list[dict[int, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            left, right = ranks.get(token[:k]), ranks.get(token[k:])
            if left is not None and right is not None:
                pair = left * PAIR + right
                buckets[pair % BUCKETS][pair] = rank * PLACED
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,bigint>>").cast("array<map<bigint,bigint>>")


def _with(value: Column, zero: Column, use) -> Column:
    """``use(value)``, of the type of ``zero``, with ``value`` worked out once; the result is not copied."""
    return F.aggregate(F.array(value), zero, lambda _, x: use(x))


def start_ranks(ranks: dict[bytes, int]) -> np.ndarray:
    """For each pair of bytes, first * 256 + second, the rank of its token, in a part's place of it."""
    found = [ranks.get(bytes(pair), NO_RANK) for pair in product(range(256), repeat=2)]
    return np.array(found, np.int64) * PLACED


def start_parts(words: list[bytes], pairs: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of parts of each word, and the parts of all words that ``folded`` starts from."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    lasts = np.cumsum(lengths) - 1
    firsts = lasts + 1 - lengths
    ranked = np.full(len(data), NO_RANK * PLACED)
    ranked[:-1] = pairs[data[:-1].astype(np.int64) * 256 + data[1:]]
    ranked[lasts] = NO_RANK * PLACED
    places = np.arange(1, len(data) + 1) - np.repeat(firsts, lengths)
    return lengths + 1, np.insert(ranked + places * PAIR + single[data], firsts, EDGE)


def folded(parts: Column, ranks: Column) -> Column:
    """The parts left of an array of parts, which begins with ``EDGE``, after all merges: their lowest bits are the ids.

    A part is one number: the rank of the pair that begins with it, its place and its id, in this order of weight. The
    least number is then the pair to merge, the leftmost of equals; a merge changes that number and the one before, and
    drops the one after. Lambdas are interpreted, so all else than those two numbers is left to whole-array functions.
    """

    def ranked(pair: Column, rest: Column) -> Column:
        return F.coalesce(ranks[pair % BUCKETS][pair], F.lit(NO_RANK * PLACED)) + rest

    def merge(state: Column, _: Column) -> Column:
        def merged(least: Column) -> Column:
            def at(j: Column) -> Column:  # parts before the least one
                before, token = F.get(state, j - 1), F.shiftright(least, PLACED.bit_length() - 1)
                pairs = F.array(before.bitwiseAND(PAIR - 1) * PAIR + token, token * PAIR + F.get(state, j + 2).bitwiseAND(PAIR - 1))
                rests = F.array(before.bitwiseAND(PLACED - 1), least.bitwiseAND(PLACED - PAIR) + token)
                return F.flatten(F.array(F.slice(state, F.lit(1), j - 1), F.zip_with(pairs, rests, ranked), F.slice(state, j + 3, F.lit(FOLD_BYTES))))

            place = least.bitwiseAND(PLACED - PAIR)
            before = F.size(F.filter(state, lambda part: part.bitwiseAND(PLACED - PAIR) < place))
            return F.when(least >= NO_RANK * PLACED, state).otherwise(_with(before, state, at))

        return _with(F.array_min(state), state, merged)

    return F.aggregate(F.slice(parts, 3, FOLD_BYTES), parts, merge)


# ---- over documents -------------------------------------------------------------------------------------------------


_LISTS = pa.list_(pa.list_(pa.int64()))
_COLUMNS = ["key", "words", "done", "at", "fresh"]


def _lists(ends: np.ndarray, flat: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _of_words(key: pa.DataType, column: str, lengths: list[int], flat: np.ndarray, fresh: bool) -> pa.RecordBatch:
    """One row with a list of words' parts in ``column``."""
    lists = pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), _lists(np.cumsum([0, *lengths]), flat))
    held = {"key": pa.nulls(1, key), "words": pa.nulls(1, _LISTS), "done": pa.nulls(1, _LISTS), "at": pa.nulls(1, pa.binary()), "fresh": pa.array([fresh])}
    return pa.RecordBatch.from_arrays([*(held | {column: lists}).values()], _COLUMNS)


class _Known:
    """The ids of a list of words, side by side."""

    def __init__(self):
        self.new: list[pa.ListArray] = []
        self.flat, self.starts, self.lengths = (np.zeros(0, t) for t in (np.int32, np.int64, np.int64))

    def add(self, words: pa.ListArray) -> None:
        self.new.append(words)

    def ids(self, at: np.ndarray) -> np.ndarray:
        """The ids of the words at these places, one after the other."""
        if self.new:
            lengths = np.concatenate([self.lengths, *(x.value_lengths().to_numpy(zero_copy_only=False) - 1 for x in self.new)]).astype(np.int64)
            parts = (x.flatten().to_numpy() for x in self.new)
            self.flat = np.concatenate([self.flat, *((x[x != EDGE] & PAIR - 1).astype(np.int32) for x in parts)])
            self.lengths, self.starts, self.new = lengths, np.cumsum(lengths) - lengths, []
        n = self.lengths[at]
        before = np.cumsum(n) - n
        return self.flat[np.repeat(self.starts[at] - before, n) + np.arange(int(n.sum()))]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``CUT_BYTES`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CUT_BYTES or i + 1 == len(texts):
            yield start, i + 1
            start, size = i + 1, 0


def encode(docs: DataFrame, path: str, pattern: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ids, an array<int> of the text's tokens by the ranks in ``path``, for each row of ``docs``.

    Every match of ``pattern`` (default: that of the public byte-level vocabularies) is encoded separately; there are no
    special tokens. Null and empty texts have no ids; an empty table gives no rows; repeated rows and keys are encoded
    each for itself; other columns do not go along. Texts and words may have any length.
    """
    from public_tokenizers import PATTERN as usual

    pattern = pattern or usual
    kind = pick(docs, key=F.col(f"`{key}`")).dtypes[0][1]
    ranks = read_ranks(path)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = sent.value
        single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = start_ranks(ranks)
        places: dict[str, int] = {}
        odd: set[str] = set()
        held, fresh = 0, True
        for batch in batches:
            key_type, texts = batch.schema.field(0).type, batch.column(1).to_pylist()
            for start, end in _slices(texts):
                if len(places) > LIST_WORDS or held > LIST_BYTES:
                    places, odd, held, fresh = {}, set(), 0, True
                cut, new = words_of(texts[start:end], pattern, usual, places, odd)
                new = [(w, w.encode()) for w in new]
                held += sum(len(data) for _, data in new)
                fold = [x for x in new if x[1] not in ranks and len(x[1]) <= FOLD_BYTES]
                rest = [x for x in new if x[1] in ranks or len(x[1]) > FOLD_BYTES]
                for some, column in ((fold, "words"), (rest, "done")):
                    for i in range(0, len(some), ROW_WORDS):
                        few = [data for _, data in some[i : i + ROW_WORDS]]
                        if column == "words":
                            lengths, flat = start_parts(few, pairs, single)
                        else:
                            ids = [[ranks[data]] if data in ranks else heap_merges(data, ranks) for data in few]
                            lengths, flat = [len(own) + 1 for own in ids], np.array([x for own in ids for x in (EDGE, *own)], np.int64)
                        yield _of_words(key_type, column, lengths, flat, fresh)
                        fresh = False
                    places.update(zip((w for w, _ in some), range(len(places), len(places) + len(some))))
                at = np.fromiter(map(places.__getitem__, chain.from_iterable(cut)), np.int32, sum(map(len, cut)))
                rows = [x.tobytes() for x in np.split(at, np.cumsum([*map(len, cut)])[:-1])]
                nothing = pa.nulls(end - start, _LISTS)
                yield pa.RecordBatch.from_arrays([batch.column(0)[start:end], nothing, nothing, pa.array(rows, pa.binary()), pa.array([False] * (end - start))], _COLUMNS)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known()
        for batch in batches:
            keys, out = [], []
            new, at, fresh = batch.column("ids"), batch.column("at").to_pylist(), batch.column("fresh").to_pylist()
            for i, words in enumerate(at):
                if fresh[i]:
                    known = _Known()
                if words is None:
                    known.add(new[i].values)
                else:
                    keys.append(i)
                    out.append(known.ids(np.frombuffer(words, np.int32)))
            ids = _lists(np.cumsum([0, *map(len, out)]), np.concatenate([np.zeros(0, np.int32), *out]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int64())), ids], ["key", "ids"])

    rows = pick(docs, key=F.col(f"`{key}`"), text=F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    lists = map_batches(rows, listed, f"key {kind}, words array<array<bigint>>, done array<array<bigint>>, at binary, fresh boolean")
    # bound once, so that the plan holds one copy of the map
    ids = F.coalesce("done", _with(rank_map(ranks), F.col("words"), lambda table: F.transform("words", lambda parts: folded(parts, table))))
    return map_batches(lists.select("key", ids.alias("ids"), "at", "fresh"), joined, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(ids: Column, path: str) -> Column:
    """The bytes of an array of ids: its tokens' binary pieces, concatenated; ids that are no token give nothing."""
    ranks = read_ranks(path)
    pieces = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.hex()
    table = F.split(F.lit(",".join(pieces)), ",")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))

"""Best-fit packing of token sequences by patterns of lengths.

Only lengths decide how documents share sequences, so the work is split in three:

1. Spark tokenises the texts. Each task numbers its pieces within each length and writes them once.
2. The histogram of lengths (at most ``size`` numbers, whatever the input) is fitted on the driver: all patterns of up
   to three lengths that fill a sequence exactly, repeat counts by non-negative least squares, of which the best share
   is rounded down and used; what is left is packed best fit, longest first, on the histogram itself.
3. Each piece finds its place from its number within its length: the places of a length are runs of consecutive numbers.

No document is moved to another one; no group of equal lengths meets in one task.
"""
from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.taskcontext import TaskContext

from . import tokens
from .common import map_batches, pick, work_table

#: Steps of the least-squares fit.
FIT_STEPS = 300
#: Shares of the fitted repeats that are tried.
SHARES = (1.0, 0.9, 0.75, 0.6, 0.5, 0.4, 0.25, 0.1, 0.0)

Pattern = tuple[tuple[int, ...], int]


# ---- fitting the histogram ------------------------------------------------------------------------------------------


def exact_patterns(have: np.ndarray, size: int) -> np.ndarray:
    """All (a, b, c) with a >= b >= c >= 0 and a + b + c = size whose lengths occur in ``have``; 0 is no document."""
    occurs = have > 0
    occurs[0] = True
    out = []
    for a in range((size + 2) // 3, size + 1):
        if not occurs[a]:
            continue
        b = np.arange((size - a + 1) // 2, min(a, size - a) + 1)
        c = size - a - b
        ok = occurs[b] & occurs[c]
        out.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), int)


def fit_repeats(have: np.ndarray, patterns: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Repeats x >= 0 of the patterns that minimise |A x - have|^2, by accelerated projected gradient steps."""
    size = len(have) - 1
    mask = np.ones(size + 1)
    mask[0] = 0.0

    def used(x):  # A x
        return sum(np.bincount(patterns[:, k], x, size + 1) for k in range(3)) * mask

    def back(r):  # A' r
        r = r * mask
        return r[patterns[:, 0]] + r[patterns[:, 1]] + r[patterns[:, 2]]

    v = np.ones(len(patterns))
    for _ in range(20):
        v = back(used(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - back(used(y) - have) / (1.05 * norm))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def best_fit(left: np.ndarray, size: int) -> list[Pattern]:
    """Best fit of a histogram, longest lengths first: equal items go into equal sequences together."""
    by_room: dict[int, list[list]] = defaultdict(list)  # room -> [lengths, repeats]
    rooms: list[int] = []

    def put(lengths, n):
        room = size - sum(lengths)
        if not by_room[room]:
            bisect.insort(rooms, room)
        by_room[room].append([lengths, n])

    for length in range(size, 0, -1):
        n = int(left[length])
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                per = size // length
                if n >= per:
                    put((length,) * per, n // per)
                if n % per:
                    put((length,) * (n % per), 1)
                break
            room = rooms[at]
            lengths, repeats = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            k = min(room // length, n)  # as many as still fit, into each
            whole = min(repeats, n // k)
            if whole < repeats:
                by_room[room].append([lengths, repeats - whole])
                if len(by_room[room]) == 1:
                    bisect.insort(rooms, room)
            put(lengths + (length,) * k, whole)
            n -= whole * k
    return [(tuple(lengths), n) for some in by_room.values() for lengths, n in some]


def sequences(patterns: list[Pattern]) -> int:
    return sum(n for _, n in patterns)


def plan_patterns(histogram: dict[int, int], size: int) -> list[Pattern]:
    """Patterns of lengths and how often each is used; together they hold every item of the histogram once.

    The fit asks for more of some lengths than there are and for less of others, and takes short ones that best fit
    needs to fill up sequences. So a share of the fitted repeats is used, the one of ``SHARES`` that gives the fewest
    sequences; 0 is best fit alone, so no plan is worse than that.
    """
    have = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        have[length] = n
    whole: list[Pattern] = [((size,), int(have[size]))] if have[size] else []
    have[size] = 0
    patterns = exact_patterns(have, size)
    patterns = patterns[patterns[:, 0] < size]
    fitted = fit_repeats(have.astype(float), patterns) if len(patterns) else np.zeros(0)

    def plan(share: float) -> list[Pattern]:
        left, out = have.copy(), []
        repeats = np.floor(fitted * share + 1e-9).astype(np.int64)
        for i in np.argsort(-repeats, kind="stable"):
            if not repeats[i]:
                break
            lengths = tuple(int(x) for x in patterns[i] if x)
            n = min([int(repeats[i]), *(int(left[x]) // lengths.count(x) for x in set(lengths))])
            if n:
                out.append((lengths, n))
                for x in lengths:
                    left[x] -= n
        return out + best_fit(left, size)

    return whole + min(map(plan, SHARES), key=sequences)


def places(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: where runs of numbers begin, the sequence of each run's first number and the offset there."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for lengths, n in patterns:
        offset = 0
        for length in lengths:
            runs[length].append((taken[length], sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in runs.items()}


# ---- over documents -------------------------------------------------------------------------------------------------


def _pieces(docs: DataFrame, path: str, size: int, end_id: int, key: str, text: str) -> DataFrame:
    kind = docs.select(F.col(f"`{key}`").alias("key")).schema["key"].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, bucket int, nth long"
    end = tokens.packed([end_id])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [0] * (size + 1)
        bucket = TaskContext.get().partitionId()
        for batch in batches:
            source, piece, start, length, crc, nth = [], [], [], [], [], []
            for i, ids in enumerate(tokens.packed_ids(path, batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    m = min(size, n) if at else (n - 1) % size + 1
                    source.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(m)
                    crc.append(zlib.crc32(ids[4 * at : 4 * (at + m)]))
                    nth.append(seen[m])
                    seen[m] += 1
                    at += m
                    k += 1
            keys = batch.column(0).take(pa.array(source, pa.int64()))
            long = [pa.array(x, pa.int64()) for x in (start, length, crc)]
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(piece, pa.int32()), *long, pa.array([bucket] * len(source), pa.int32()), pa.array(nth, pa.int64())],
                [key, "piece", "start", "length", "ids_crc32", "bucket", "nth"],
            )

    return map_batches(pick(docs, key, text=F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))), cut, schema)


def pack(docs: DataFrame, path: str, size: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document.

    A document is its token ids and ``end_id``. Only documents of more than ``size`` ids are cut; all pieces but the
    first have ``size`` ids. Null texts count as empty (one piece, the end id alone); an empty table gives no pieces;
    rows with a repeated or null ``key`` are packed each for itself. Sequence numbers start at 0 without gaps.
    """
    pieces = work_table(_pieces(docs, path, size, end_id, key, text), "pieces")
    counts = pieces.groupBy("bucket", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = work_table(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # the runs of all patterns: bounded by the patterns of ``size``, not by the documents
    runs = docs.sparkSession.sparkContext.broadcast(places(plan_patterns(histogram, size)))
    before = F.sum("n").over(W.partitionBy("length").orderBy("bucket")) - F.col("n")
    # sorted, since the counts grow with the tasks: one plan at every size
    numbered = pieces.hint("merge").join(counts.select("bucket", "length", before.alias("base")), ["bucket", "length"])
    numbered = pick(numbered, key, "piece", "start", "length", "ids_crc32", number=F.col("base") + F.col("nth"))
    kind = dict(pieces.dtypes)[key]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = runs.value
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            values, starts = np.unique(length[order], return_index=True)
            for value, rows in zip(values.tolist(), np.split(order, starts[1:])):
                first, first_sequence, first_offset = of[value]
                run = np.searchsorted(first, number[rows], "right") - 1
                sequence[rows] = first_sequence[run] + number[rows] - first[run]
                offset[rows] = first_offset[run]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return map_batches(numbered, place, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

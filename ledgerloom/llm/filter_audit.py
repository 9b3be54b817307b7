"""How filters interact: what each removes, in every order, by sorted posting lists.

1. One scan gives each row a number, its part and which filters it fails; a text met before under a smaller id is found
   by the digest of the whole text, so only slim rows move.
2. Rows are sorted by part and number over the cluster, so a part of any size is spread over as many tasks as it needs.
   Each task cuts its rows into id ranges of one part and keeps, per range, one sorted list of failing ids for each
   filter (and one of good, one of toxic ids).
3. Within a range, the union of any set of lists is a k-way merge, and what a filter removes after a set of others is
   the difference of its list and that union; both gallop over the stretches that the other lists do not touch.
   Sizes of the ranges are summed. Every order is then a path through those sums.

Ranges are bounded by ``RANGE_IDS`` rows, so no list grows with its part. Lost executors repeat their ranges only.
"""
from __future__ import annotations

import heapq
import itertools
import math
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import map_batches, pick, work_table

#: Rows of one id range: its lists are held in memory together.
RANGE_IDS = 1 << 16

SUMS = ("kept", "removed", "redundant", "good_lost", "toxic_lost")


# ---- sorted lists ---------------------------------------------------------------------------------------------------


def skip(ids: list[int], value: int, at: int) -> int:
    """First position from ``at`` on whose id is not below ``value``: doubling steps, then bisection in the last one."""
    step, end = 1, len(ids)
    while at + step < end and ids[at + step] < value:
        at += step
        step *= 2
    return bisect_left(ids, value, at, min(at + step + 1, end))


def union(lists: list[list[int]]) -> list[int]:
    """Ids of any of the sorted lists, once each: the list with the least head gives all it has below the next head."""
    heads = [(ids[0], k, 0) for k, ids in enumerate(lists) if ids]
    heapq.heapify(heads)
    out: list[int] = []
    while heads:
        first, k, at = heads[0]
        ids = lists[k]
        if len(heads) == 1:
            return out + ids[at:]
        bound = min(heads[1:3])[0]
        end = at + 1 if first == bound else skip(ids, bound, at)  # an equal head is left to the other list
        if first < bound:
            out += ids[at:end]
        if end < len(ids):
            heapq.heapreplace(heads, (ids[end], k, end))
        else:
            heapq.heappop(heads)
    return out


def difference(ids: list[int], others: list[int]) -> list[int]:
    """Ids of the first sorted list that the second does not hold, in stretches between the second's ids."""
    out: list[int] = []
    at = there = 0
    while at < len(ids):
        there = skip(others, ids[at], there) if there < len(others) else there
        if there == len(others):
            return out + ids[at:]
        if others[there] == ids[at]:
            at += 1
        else:
            end = skip(ids, others[there], at)
            out += ids[at:end]
            at = end
    return out


def common(ids: list[int], others: list[int]) -> int:
    """How many ids two sorted lists share: the shorter one gallops through the longer one."""
    short, long = sorted((ids, others), key=len)
    n = at = 0
    for x in short:
        at = skip(long, x, at) if at < len(long) else at
        if at == len(long):
            break
        n += long[at] == x
    return n


def range_sizes(failing: list[list[int]], good: list[int], toxic: list[int], rows: int) -> Iterator[tuple[int, ...]]:
    """(filter, earlier filters as bits, *SUMS) of one id range for every filter after every set of the others."""
    sets = range(1 << len(failing))
    unions = [union([ids for k, ids in enumerate(failing) if s >> k & 1]) for s in sets]
    for k, ids in enumerate(failing):
        for s in sets:
            if not s >> k & 1:
                removed = difference(ids, unions[s])
                yield (k, s, rows - len(unions[s | 1 << k]), len(removed), len(ids) - len(removed), common(removed, good), common(removed, toxic))


# ---- over documents -------------------------------------------------------------------------------------------------


def text_failures(text: Column) -> dict[str, Column]:
    """Filters on one text: few words, repeated words, capitals, symbols."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(0))
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)) * F.lit(100).cast("long") < n * F.lit(65).cast("long"),
        "C": capitals * F.lit(100).cast("long") > F.length(text) * F.lit(5).cast("long"),
        "D": F.length(F.translate(text, "#$%&*|", "")) < F.length(text),
    }


def failures(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """row (a number), part, one boolean for each of the filters A to E, good and toxic, for each row of ``docs``.

    E: the text is that of a row with a smaller ``key``; a null key is neither smaller nor larger. Null texts count as
    empty, a null part is the empty one. ``labels`` may lack keys or hold one several times: a row is good (toxic) if
    any label of its key says so.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = pick(docs, key=F.col(f"`{key}`"), part=F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")),
                digest=F.unhex(F.sha2(body, 256)), row=F.monotonically_increasing_id(), **text_failures(body))
    rows = work_table(rows, "failures")
    first = rows.groupBy("digest").agg(F.min("key").alias("least"), F.max("key").alias("most")).filter("least < most").select("digest", "least")
    first = work_table(first, "first-copies")  # a table of its own, so that Spark can split the rows of a text with many copies
    known = pick(labels, key=F.col(f"`{key}`"), good=F.col("quality") == 1, toxic=F.col("toxic") == 1).filter("key is not null")
    known = known.groupBy("key").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    found = rows.join(first, "digest", "left").withColumn("E", F.col("key") > F.col("least")).join(known, "key", "left")
    return found.select("row", "part", *(F.coalesce(c, F.lit(False)).alias(c) for c in "ABCDE"), *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))


def _sizes(failing: DataFrame, letters: str, range_ids: int) -> DataFrame:
    """part, filter, before and ``SUMS`` of each id range."""
    columns = ["part", "row", *letters, "good", "toxic"]
    names = ["part", "filter", "before", *SUMS]

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, lists = None, 0, [[] for _ in columns[2:]]

        def done() -> pa.RecordBatch:
            found = list(range_sizes(lists[:-2], lists[-2], lists[-1], rows))
            return pa.RecordBatch.from_arrays(
                [pa.array([now] * len(found), pa.string()), *(pa.array(x, t) for x, t in zip(zip(*found), [pa.int32()] * 2 + [pa.int64()] * len(SUMS)))], names)

        for batch in batches:
            parts, ids = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            flags = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(2, len(columns))]
            at = 0
            for part, run in itertools.groupby(parts):
                end = at + len(list(run))
                while at < end:
                    if rows and (part != now or rows >= range_ids):
                        yield done()
                        rows, lists = 0, [[] for _ in flags]
                    now, stop = part, min(end, at + range_ids - rows)
                    for ids_of, flag in zip(lists, flags):
                        ids_of += ids[at:stop][flag[at:stop]].tolist()
                    rows, at = rows + stop - at, stop
        if rows:
            yield done()

    ordered = failing.select(*columns).repartitionByRange("part", "row").sortWithinPartitions("part", "row")
    return map_batches(ordered, sizes, "part string, filter int, before int, " + ", ".join(f"{c} long" for c in SUMS))


def audit(failing: DataFrame, letters: str = "ABCDE", range_ids: int = RANGE_IDS) -> DataFrame:
    """part, filter_order, step and the counts of that step, for every part and every order of the filters ``letters``.

    ``failing`` has row (unique), part, one boolean column per letter, good and toxic. kept: rows left after the step;
    removed: by it; redundant: failing its filter but removed earlier; unique_fails: failing its filter only; good_lost
    and toxic_lost: of the removed; shapley: the filter's removed, summed over all orders. Counts are zero where
    nothing falls; a part without failing rows has all its rows too; an empty table gives none.
    """
    count = len(letters)
    sums = _sizes(failing, letters, range_ids).groupBy("part", "filter", "before").agg(*(F.sum(c).alias(c) for c in SUMS))
    of_filter = W.partitionBy("part", "filter")  # one row per set of other filters
    others = (1 << count) - 1 - F.expr("shiftleft(1, filter)")
    orders = F.element_at(F.array(*(F.lit(math.factorial(s) * math.factorial(count - 1 - s)) for s in range(count))), F.bit_count("before") + 1)
    sums = sums.select(
        "*", F.max(F.when(F.col("before") == others, F.col("removed"))).over(of_filter).alias("unique_fails"),
        F.sum(F.col("removed") * orders).over(of_filter).alias("shapley"))
    steps = [("".join(letters[k] for k in order), n + 1, k, sum(1 << x for x in order[:n])) for order in itertools.permutations(range(count)) for n, k in enumerate(order)]
    paths = failing.sparkSession.createDataFrame(steps, "filter_order string, step int, filter int, before int")  # as many as the filters give
    return sums.join(F.broadcast(paths), ["filter", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

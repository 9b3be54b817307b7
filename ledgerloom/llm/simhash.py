"""SimHash near-dedup with Golay-code fuzzy hashing.

The binary Golay code puts every 23-bit word at most 3 bits from exactly one of 4,096 codewords. A word's keys are the
codewords that the word itself and its 23 neighbours decode to: 1 to 6 keys, and two words that differ in at most 2
bits share one. A 64-bit fingerprint has 4 segments of 16 bits. Of up to 4 differing bits, either

* some segment has none: the other 48 bits form two halves of 24, one of which has at most 2. Key: the segment's value
  and a Golay key of the half (one bit of the half is left out, which only lowers its errors); or
* each segment has exactly one: key: a Golay key of each of the first two segments, and the parity of all four, which
  one of the two fingerprints flips.

So fingerprints that must link share a key of 28 bits, and few others do. Rows of keys are range-partitioned by key and
fingerprint and sorted; each is verified against the rows just before it. Keys with more rows than that, or cut by a
partition's border, go on: those whose rows already lie in one component are done, and the rest are joined across
components. No key's rows are gathered, and no pairs within a component are made.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, pick, work_table
from .components import components

#: Words of a shingle, and bits in which linked fingerprints may differ.
SHINGLE, BITS = 4, 4
#: Rows before it that a row of a key is verified against at once.
NEAR_ROWS = 256
#: Rounds, at most, that tie the rows of large keys to one of them before components are compared pair by pair. The
#: rounds end as soon as a row has no more than ``NEAR_ROWS`` others to be compared with on average.
TIES = 3

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit by bit the majority of the shingles' XXH64 values; 0 without words."""
    import xxhash

    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    body, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(body, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1]
    hashes = np.fromiter([digest(body[a:b], 42) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist())], np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
    ones = np.bincount(octets.ravel(), minlength=2048).reshape(8, 256) @ _BIT_OF_BYTE
    return int.from_bytes(np.packbits(2 * ones.ravel() > len(hashes), bitorder="little").tobytes(), "little")


# ---- keys -----------------------------------------------------------------------------------------------------------


@functools.cache
def _decoded() -> np.ndarray:
    """For each 23-bit word the number (0 to 4095) of its nearest codeword."""
    generator = 0b110001110101  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
    remainder = np.zeros(1, np.uint16)
    r = 1
    for _ in range(23):
        remainder = np.concatenate([remainder, remainder ^ np.uint16(r)])
        r <<= 1
        if r >> 11:
            r ^= generator
    error = np.zeros(2048, np.uint32)
    light = [1 << np.arange(23)]
    light.append((light[0][:, None] ^ light[0][None]).ravel())
    light.append((light[1][:, None] ^ light[0][None]).ravel())
    for words in reversed(light):  # lighter ones last, so that they stay
        error[remainder[words]] = words
    error[0] = 0
    codeword, step = np.empty(1 << 23, np.uint16), 1 << 18  # in steps, since every worker builds it beside the others
    for start in range(0, 1 << 23, step):
        word = np.arange(start, start + step, dtype=np.uint32)
        codeword[start : start + step] = (word ^ error[remainder[start : start + step]]) >> 11
    return codeword


def golay_keys(words: np.ndarray, width: int = 23) -> np.ndarray:
    """Codewords of each word and of its neighbours in the lowest ``width`` bits, sorted; repeats are set to -1."""
    flips = np.concatenate([[0], 1 << np.arange(width)])
    keys = np.sort(_decoded()[words[:, None] ^ flips].astype(np.int64), axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return keys


def link_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the fingerprint, key) for unsigned 64-bit ``prints``: linked ones share a key."""
    segment = [((prints >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    rows, out = [], []

    def add(keys, head):
        i, k = np.nonzero(keys >= 0)
        rows.append(i)
        out.append(head[i] | keys[i, k])

    for i in range(4):
        a, b, c = (segment[j] for j in range(4) if j != i)
        rest = a | b << 16 | c << 32
        for half in range(2):
            add(golay_keys(rest >> (24 * half) & 0x7FFFFF), (2 * i + half) << 28 | segment[i] << 12)
    parity = sum((np.bitwise_count(s).astype(np.int64) & 1) << i for i, s in enumerate(segment))
    zero, one = segment[0], segment[1]
    own = (_decoded()[zero].astype(np.int64) << 12 | _decoded()[one])[:, None]
    add(own, 8 << 28 | parity << 24)
    first, second = golay_keys(zero, 16), golay_keys(one, 16)
    pair = np.where((first[:, :, None] >= 0) & (second[:, None, :] >= 0), first[:, :, None] << 12 | second[:, None, :], -1)
    add(pair.reshape(len(prints), -1), 8 << 28 | (parity ^ 15) << 24)
    return np.concatenate(rows), np.concatenate(out)


# ---- over documents -------------------------------------------------------------------------------------------------


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, same: bool = False) -> DataFrame:
    """``key`` as key and print (64 bits as a long) of each row; null texts have no words. With ``same`` also the text's hash."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    extra = {"same": F.xxhash64(whole)} if same else {}
    rows = pick(docs, key=F.col(f"`{key}`"), text=whole, print=F.lit(0).cast("long"), **extra)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            kept = [n for n in batch.schema.names if n not in ("text", "print")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(prints)], [*kept, "print"])

    schema = rows.select("key", *extra, "print").schema
    return map_batches(rows, hashed, schema)


def _keyed(prints: DataFrame) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            at, key = link_keys(values.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(values[at])], ["link", "print"])

    return map_batches(prints, keys, "link long, print long")


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it hangs together with) over links, for the nodes that aren't that one themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = np.split(at, 2)
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    other = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[other], nodes[root[other]]


def _near_links(bits: int, near: int):
    """Over sorted (link, print) rows: verified links (a, b), and rows of keys that need more (link, a, b = null)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail_key = tail = np.zeros(0, np.int64)
        first: np.ndarray | None = None
        for batch in batches:
            key, value = (np.concatenate([t, batch.column(c).to_numpy()]) for t, c in ((tail_key, "link"), (tail, "print")))
            first = key[:1] if first is None or not len(first) else first
            a, b = [], []
            for d in range(1, min(near, len(key) - 1) + 1):
                same = np.flatnonzero(key[d:] == key[:-d])
                if not len(same):
                    break
                close = same[np.bitwise_count((value[same] ^ value[same + d]).view(np.uint64)) <= bits]
                a.append(value[close])
                b.append(value[close + d])
            if a:
                nodes, roots = _roots(np.concatenate(a), np.concatenate(b))
                yield _links(None, nodes, roots)
            # keys longer than the reach, and the first key of the partition, which may have begun in the one before
            values, counts = np.unique(key, return_counts=True)
            chosen = np.isin(key, np.append(values[counts > near], first))
            if chosen.any():
                yield _links(key[chosen], value[chosen], None)
            tail_key, tail = key[-near:], value[-near:]
        if len(tail):  # and its last key
            chosen = tail_key == tail_key[-1]
            yield _links(tail_key[chosen], tail[chosen], None)

    return scan


def _links(key, a, b) -> pa.RecordBatch:
    n = len(a)
    nothing = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays([nothing if key is None else pa.array(key), pa.array(a), nothing if b is None else pa.array(b)], ["link", "a", "b"])


def print_components(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """(node, root) of the distinct fingerprints ``prints``(print) that link to another one."""
    rows = _keyed(prints).repartitionByRange("link", "print").sortWithinPartitions("link", "print")
    found = work_table(map_batches(rows, _near_links(bits, NEAR_ROWS), "link long, a long, b long"), "near-links")
    roots = work_table(components(found.filter("b is not null").select("a", "b")), "roots")
    # rows of long or cut keys: every row of such a key is here, or was verified against all rows of the key before it
    open_rows = found.filter("b is null").select("link", F.col("a").alias("print")).distinct()
    for tie in range(TIES + 1):
        known = open_rows.join(roots, F.col("print") == F.col("node"), "left").select("link", "print", F.coalesce("root", "print").alias("root"))
        mixed = known.groupBy("link").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"),
                                          F.min_by("print", F.xxhash64("print", F.lit(tie))).alias("pivot")).filter("low <> high")
        mixed = work_table(mixed.select("link", "size", "pivot"), "mixed")
        size = mixed.agg(F.sum("size").alias("rows"), F.sum(F.col("size") * F.col("size")).alias("pairs")).first()
        if not size["rows"]:
            break
        known = work_table(known.join(mixed, "link"), "open")
        last = tie == TIES or size["pairs"] <= NEAR_ROWS * size["rows"]
        x = known.select("link", F.col("print").alias("x"), F.col("root").alias("a"))
        if last:
            y = known.select("link", F.col("print").alias("y"), F.col("root").alias("b"))
            pairs = x.join(y, "link").filter("a < b")
        else:
            y = known.filter("print = pivot").select("link", F.col("print").alias("y"), F.col("root").alias("b"))
            pairs = x.join(y, "link").filter("a <> b")
        new = pairs.filter(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= bits).select("a", "b")
        new = work_table(new.distinct(), "new-links")
        if not new.isEmpty():  # components of components
            merged = work_table(components(new), "merged")
            renamed = merged.select(F.col("node").alias("root"), F.col("root").alias("new"))
            roots = roots.join(renamed, "root", "left").select("node", F.coalesce("new", "root").alias("root")).unionByName(merged)
            roots = work_table(roots.distinct(), "roots")
        if last:
            break
        open_rows = known.select("link", "print")
    return roots


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS, carry: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` with ``key``, fingerprint (16 hex digits), component_id and the columns in ``carry`` as ``input``.

    With ``carry`` there is ``kept`` too: one text of each group has it, that of the smallest key (of several texts with
    that key the one of the least hash); rows alike in key and text are decided alike.

    Rows link if their fingerprints differ in at most ``bits`` (up to 4) bits; ``component_id`` is the smallest ``key``
    reachable over links, itself included (null only if all are null). Texts without words, null ones too, have the
    fingerprint zero and link like any other. Repeated rows fall into one group; an empty table gives no rows.
    """
    if bits > BITS:
        raise ValueError(f"the keys find links of up to {BITS} bits")
    rows = work_table(fingerprints(docs, key, text, shingle, bool(carry)), "prints")
    # with carried columns, rows of one key are told apart by their texts
    order = F.struct(F.col("key").isNull().alias("none"), "key", *(["same"] if carry else []))
    least = work_table(rows.groupBy("print").agg(F.min(order).alias("least")), "distinct-prints")
    roots = print_components(least.select("print"), bits)
    rooted = least.join(roots, F.col("print") == F.col("node"), "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("first"))
    decided = rooted.join(groups, "root").select("print", "first")
    found = rows.join(decided, "print").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("first.key").alias("component_id"),
        *(["same", (F.col("key").eqNullSafe(F.col("first.key")) & (F.col("same") == F.col("first.same"))).alias("kept")] if carry else []))
    if not carry:
        return found
    # the texts move once, to what was decided; rows alike in key and text are decided alike
    found = found.distinct()
    rows = pick(docs, mine=F.col(f"`{key}`"), own=F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))),
                input=F.struct(*(F.col(f"`{c}`") for c in carry)))
    return rows.hint("merge").join(found, F.col("mine").eqNullSafe(F.col(key)) & (F.col("own") == F.col("same"))).select(
        key, "fingerprint", "component_id", "kept", "input")

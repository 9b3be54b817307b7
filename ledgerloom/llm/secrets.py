"""Secret scans: fixed patterns, and credential values whose guess cost is high.

The patterns give the base spans. The method adds the values that stand in a credential's place (those of the base
pattern, after words such as ``pwd`` or ``authorization``, in a connection string, in quotes with any characters) and
are hard to guess, so that it also tells real secrets from ``token = example1``: a value's guess cost is that of the
cheapest way to put it together from common words, dates, repeats, keyboard walks, sequences and brute-force stretches, found
by dynamic programming over its characters. Values too costly for someone to have made them up as ordinary text are spans.

Every text is scanned whole where it is; nothing is shuffled, and only values in a credential's place are costed.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, pick

# ---- fixed values ---------------------------------------------------------------------------------------------------

#: Kinds of base spans, in their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

#: Places of credentials beyond the base pattern; group 1 is the value, of any length: it ends at a quote, blank or @. Names may have a prefix
#: (``DB_PWD``, ``dbPwd``); quoted values may hold blanks, and line breaks in keys of PEM form.
CONTEXTS = tuple(
    re.compile(p, re.IGNORECASE | re.ASCII)
    for p in (
        r"""(?:password|passwd|passphrase|pwd|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret|auth[_-]?key)["']?[\x20\t]*(?:[:=]|=>|\bis\b)[\x20\t]*"([^"\n]{6,}|\s*-----BEGIN\x20[^"]+)\"""",
        r"""(?:password|passwd|passphrase|pwd|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret|auth[_-]?key)["']?[\x20\t]*(?:[:=]|=>|\bis\b)[\x20\t]*'([^'\n]{6,}|\s*-----BEGIN\x20[^']+)'""",
        r"""(?:passphrase|pwd|credential|access[_-]?key|private[_-]?key|auth[_-]?key)["']?[\x20\t]*(?:[:=]|=>|\bis\b)[\x20\t]*([^\s"',;]{6,})""",
        r"""(?:password|passwd|secret|token|api[_-]?key)[\x20\t]*[:=][\x20\t]*([^\s"',;]{6,})""",
        r"""authorization["']?[\x20\t]*[:=][\x20\t]*["']?(?:bearer|basic|token)[\x20\t]+([A-Za-z0-9+/_.=~-]{6,})""",
        r"""(?<=[a-z0-9+.-])://[^\s:/@]+:([^\s:/@]{6,})@""",
    )
)

#: One of these stands, in some case, in every text that a pattern above matches; looking for them first is quick.
_NEEDED = ("passw", "passphrase", "pwd", "secret", "token", "credential", "key", "authorization", "://")

#: Words that people build passwords from, most common first.
WORDS = """password pass admin welcome login master secret dragon monkey shadow sunshine princess football baseball letmein
hello freedom whatever trust love money summer winter spring autumn january february march april june july august september
october november december monday friday sunday test user root guest default changeme example sample demo token key server
system computer internet office company project data base service account public private super iloveyou michael charlie
jordan thomas robert daniel george""".split()

#: Rows of a keyboard; walks run along them or down their columns.
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")

#: Letters written for others.
LEET = str.maketrans("4@310$57", "aaeiosst")

# ---- guess cost, as log10 of guesses --------------------------------------------------------------------------------

#: A value is a secret from this cost on.
LEAST_COST = 8.0
#: Characters costed together: longer values are costed in stretches of this many.
STRETCH = 64

_RANK = {w: i + 1 for i, w in enumerate(WORDS)}
_LONGEST_WORD = max(map(len, WORDS))
_PLACE = {c: (x, y) for y, row in enumerate(KEYBOARD) for x, c in enumerate(row)}
_DIGITS = re.compile(r"(?:\d{8}|\d{6}|\d{4}|\d{1,4}[-/._]\d{1,2}[-/._]\d{1,4})")


def _alphabet(text: str) -> int:
    size = 26 * any("a" <= c <= "z" for c in text) + 26 * any("A" <= c <= "Z" for c in text) + 10 * any(c.isdigit() for c in text)
    return max(10, size + (33 if any(not c.isalnum() and c < "\x80" for c in text) else 0) + (100 if any(c >= "\x80" for c in text) else 0))


def _brute(text: str) -> float:
    return len(text) * math.log10(_alphabet(text))


def _word(text: str) -> float | None:
    """Rank of the word, times the ways of its capitals and letters written for others."""
    low = text.lower()
    plain = low.translate(LEET)
    rank = _RANK.get(low) or _RANK.get(plain)
    if not rank:
        return None
    capitals = sum(c.isupper() for c in text)
    ways = 1 if not capitals else 2 if capitals in (1, len(text)) else math.comb(len(text), capitals) * 2
    return math.log10(rank * ways * (2 ** sum(a != b for a, b in zip(low, plain))) + 1)


def _date(text: str) -> float | None:
    """Days of a century in the usual ways to write them, or a year."""
    if not _DIGITS.fullmatch(text):
        return None
    parts = re.split(r"[-/._]", text)
    if len(parts) == 1:
        if len(text) == 4:
            return math.log10(120) if 1920 <= int(text) <= 2040 else None
        cuts = ((4, 6), (2, 4)) if len(text) == 8 else ((2, 4),)
        ways = [(text[:a], text[a:b], text[b:]) for a, b in cuts]
    else:
        ways = [tuple(parts)] if len(parts) == 3 else []
    for a, b, c in ways:
        for y, m, d in ((a, b, c), (c, b, a), (c, a, b)):
            try:
                date(int(y) + (2000 if len(y) <= 2 else 0), int(m), int(d))
            except ValueError:
                continue
            if len(y) in (2, 4):
                return math.log10(365 * 120 * (4 if len(parts) == 3 else 1))
    return None


def _repeat(text: str) -> float | None:
    """A unit of up to a third of the text, again and again."""
    for n in range(1, len(text) // 3 + 1):
        if len(text) % n == 0 and text[:n] * (len(text) // n) == text:
            return _brute(text[:n]) + math.log10(len(text) // n)
    return None


def _walk(text: str) -> float | None:
    """Neighbouring keys, or characters that follow each other."""
    if len(text) < 3:
        return None
    low = text.lower()
    step = ord(low[1]) - ord(low[0])
    if step in (1, -1) and all(ord(b) - ord(a) == step for a, b in zip(low, low[1:])):
        return math.log10(4 * 26 * len(text))
    turns, last = 0, None
    for a, b in zip(low, low[1:]):
        if a not in _PLACE or b not in _PLACE:
            return None
        move = _PLACE[b][0] - _PLACE[a][0], _PLACE[b][1] - _PLACE[a][1]
        if max(map(abs, move)) > 1 or move == (0, 0):
            return None
        turns += move != last
        last = move
    return math.log10(47 * len(text)) + turns * math.log10(4)


def segments(value: str) -> list[tuple[str, str, float]]:
    """The cheapest segmentation of ``value``: (kind, part, log10 of guesses)."""
    if len(value) > STRETCH:
        if (cost := _repeat(value)) is not None and cost < LEAST_COST:
            return [("repeat", value, cost)]
        return [s for i in range(0, len(value), STRETCH) for s in segments(value[i : i + STRETCH])]
    best: list[tuple[float, int, str]] = [(0.0, 0, "")]
    for end in range(1, len(value) + 1):
        options = []
        for start in range(end):
            part = value[start:end]
            costs = [("brute", _brute(part))]
            if 3 <= len(part) <= _LONGEST_WORD:
                costs.append(("word", _word(part)))
            if 4 <= len(part) <= 10:
                costs.append(("date", _date(part)))
            if len(part) >= 3:
                costs += [("repeat", _repeat(part)), ("walk", _walk(part))]
            joint = 0.0 if start == 0 else math.log10(2)  # where one part ends and another begins
            options += [(best[start][0] + joint + c, start, kind) for kind, c in costs if c is not None]
        best.append(min(options))
    out, end = [], len(value)
    while end:
        cost, start, kind = best[end]
        out.append((kind, value[start:end], cost - best[start][0]))
        end = start
    return out[::-1]


def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation needs."""
    return sum(c for _, _, c in segments(value))


def _is_costly(value: str) -> bool:
    """Whether guess_cost reaches LEAST_COST; no stretch costs nothing, so a long value is settled by its first ones."""
    if len(value) <= STRETCH or (_repeat(value) or LEAST_COST) < LEAST_COST:
        return guess_cost(value) >= LEAST_COST
    cost = 0.0
    for i in range(0, len(value), STRETCH):
        cost += guess_cost(value[i : i + STRETCH])
        if cost >= LEAST_COST:
            return True
    return False


# ---- spans ----------------------------------------------------------------------------------------------------------


def _may_hold(text: str) -> bool:
    low = text.lower()
    return any(word in low for word in _NEEDED)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, leftmost and non-overlapping for each kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6] if _may_hold(text) else []
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return out + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def guess_spans(text: str) -> list[tuple[int, int, int]]:
    """Values in a credential's place with a high guess cost; of overlapping ones the one that begins first, then the longest."""
    if not _may_hold(text):
        return []
    found = {m.span(2) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6}
    found |= {m.span(1) for pattern in CONTEXTS for m in pattern.finditer(text)}
    out: list[tuple[int, int, int]] = []
    for a, b in sorted(found, key=lambda s: (s[0], -s[1])):
        if (not out or a >= out[-1][2]) and _is_costly(text[a:b]):
            out.append((a, 3, b))
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, base and spans of each row: arrays of (kind, start, end), by start, then kind; base are spans too.

    Offsets are code points, ends exclusive; a span is a whole match of a base pattern, or the value alone for kind
    ``guess``. Null counts as empty, which has no spans; repeated rows are scanned each for itself.
    """
    span = "array<struct<kind:string,start:long,end:long>>"
    kind = docs.select(F.col(f"`{key}`").alias("key")).schema["key"].dataType.simpleString()
    rows = pick(docs, key=F.col(f"`{key}`"), text=F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = [sorted(base_spans(t)) for t in batch.column(1).to_pylist()]
            every = [sorted(b + guess_spans(t)) for t, b in zip(batch.column(1).to_pylist(), base)]
            both = [pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in row] for row in x], arrow) for x in (base, every)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *both], ["key", "base", "spans"])

    return map_batches(rows, found, f"key {kind}, base {span}, spans {span}").withColumnRenamed("key", key)

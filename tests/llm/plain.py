"""Plain versions of the operators, one row after the other, to compare with."""
from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
BENCH_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def repeats(docs, window=35):
    words = [(d, WORDS.findall((t or "").encode())) for d, t in docs]
    count = Counter(tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def contaminated(docs, items, width=10):
    def words(t):
        return BENCH_WORDS.findall((t or "").encode().translate(LOWER))

    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        if i is not None and w:
            for k in range(max(1, len(w) - width + 1)):
                windows[tuple(w[k : k + width])].add(str(i))
    out = []
    for d, t in docs:
        w = words(t)
        hit, met = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    met |= found
                    hit[k : k + n] = [True] * n
        out.append((d, len(w), sum(hit), len(met), sha(",".join(sorted(met))), any(hit)))
    return out


def pieces(docs, size=1024):
    out = []
    for d, t in docs:
        x, at, k = [*ids(t), 2], 0, 0
        while at < len(x):
            n = size if at else (len(x) - 1) % size + 1
            out.append((d, k, at, n, zlib.crc32(struct.pack(f"<{n}I", *x[at : at + n]))))
            at, k = at + n, k + 1
    return out


def copies(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    out = []
    for body, members in groups.items():
        known = [m for m in members if m is not None]
        keep = min(known) if known else None
        kept = False
        for m in members:
            first = m == keep and not kept
            kept |= first
            out.append((m, keep, len(members), first, sha(body)))
    return out


def fingerprint(text):
    w = WORDS.findall((text or "").encode().translate(LOWER))
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(prints, bits=4):
    """Fingerprint -> number of its component."""
    todo, out, n = sorted(set(prints)), {}, 0
    for x in todo:
        if x in out:
            continue
        out[x], queue, n = n, [x], n + 1
        while queue:
            a = queue.pop()
            for b in todo:
                if b not in out and (a ^ b).bit_count() <= bits:
                    out[b] = out[x]
                    queue.append(b)
    return out


def near(docs):
    prints = [(d, fingerprint(t)) for d, t in docs]
    of = linked([p for _, p in prints])
    least = {}
    for d, p in prints:
        if d is not None:
            least[of[p]] = min(d, least.get(of[p], d))
    return [(d, f"{p:016x}", least.get(of[p])) for d, p in prints]


ASSIGN = re.compile(
    "(" + "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w).replace("_", "_?") for w in
                   ("password", "passwd", "secret", "token", "api_key")) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(spans)


def audit(rows, labels, letters="ABCDE"):
    """Rows are (doc_id, text, source); labels (doc_id, quality, toxic)."""
    import itertools

    good, toxic = ({d for d, *marks in labels if d is not None and marks[k] == 1} for k in (0, 1))
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    parts = defaultdict(list)
    for d, t, s in rows:
        t = t or ""
        w = WORDS.findall(t.encode())
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and d > least[t]}
        parts[s or ""].append(({k for k in letters if fails[k]}, d in good, d in toxic))
    out = []
    for part, members in parts.items():
        shapley, found = Counter(), []
        for order in itertools.permutations(letters):
            for n, f in enumerate(order):
                gone = [m for m in members if f in m[0] and not m[0] & set(order[:n])]
                shapley[f] += len(gone)
                failing = sum(f in m[0] for m in members)
                kept = sum(not m[0] & set(order[: n + 1]) for m in members)
                only = sum(m[0] == {f} for m in members)
                found.append(("".join(order), n + 1, kept, len(gone), failing - len(gone), only, sum(m[1] for m in gone), sum(m[2] for m in gone), f))
        out += [(part, *r[:-1], shapley[r[-1]]) for r in found]
    return out


def resampled(docs, items, percent=5, least=20, buckets=10_000, seed=42):
    import math

    def features(text):
        w = BENCH_WORDS.findall((text or "").encode().translate(LOWER))
        return len(w), [zlib.crc32(b" ".join(w[i : i + k])) % buckets for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    found = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for _, _, x in found for b in x), Counter(b for _, x in items for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for d, n, x in found:
        weight, h = sum(gain[b] for b in x), int(sha(f"{seed}:{'' if d is None else d}")[:8], 16)
        rows.append((d, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least))
    order = sorted((i for i, r in enumerate(rows) if r[4]), key=lambda i: (-rows[i][3], rows[i][0] is None, rows[i][0] or 0))
    rank = {i: n + 1 for n, i in enumerate(order[: len(order) * percent // 100])}
    return [(*r[:4], rank.get(i)) for i, r in enumerate(rows)]

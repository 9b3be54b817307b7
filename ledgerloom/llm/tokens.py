"""Token ids and counts of whole texts with the vocabularies of public tokenizers.

A tokenizer is loaded once per Python worker. For byte-level BPE every piece of the pre-tokenizer's pattern is
encoded by itself, so borders of pieces are safe places to split a text of any length. Each piece is looked up in
a bounded memo of the worker; only pieces that are not in it go through the tokenizer's merges. Texts in which the
memo's pattern could differ from the tokenizer's own go through the tokenizer whole.
"""
from __future__ import annotations

import codecs
import functools
import re
import struct
import unicodedata
from collections.abc import Callable, Iterable

#: New pieces after which a worker's memo forgets those not met since it did so last: it never holds more than twice as
#: many. Longer pieces than this many characters are not kept.
MEMO_PIECES, MEMO_CHARACTERS = 200_000, 64
#: Bytes of text handed to a tokenizer at once.
ENCODE_BYTES = 1 << 20

#: A place where every tokenizer here may be cut: a single space between two ASCII letters.
_SAFE = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")


@functools.cache
def _pieces() -> re.Pattern:
    """The pattern of byte-level BPE in terms of ``re``; its pieces hold every character.

    Letters are word characters that are neither digits nor the underscore, spelt out, since ``re`` finds them in a table
    sooner than it asks for three classes. A character of no other kind is a piece, and odd.
    """
    letters = "".join(c for c in map(chr, range(0x10000)) if c.isalnum() and not c.isdecimal())
    return re.compile(rf" ?[{letters}]+|'(?:[stmd]|re|ve|ll)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+|\w")


@functools.cache
def _odd() -> re.Pattern:
    """Characters whose class differs, or may differ, between ``re`` and the tokenizer's own pattern."""
    numerals = "".join(
        re.escape(c) for c in map(chr, range(0x10000)) if unicodedata.category(c) in ("No", "Nl") and not c.isalpha()
    )
    numerals += "".join(c for c in map(chr, range(0x1F000, 0x20000)) if c.isalnum())
    return re.compile(f"[\x1c-\x1f\x85{numerals}\U00010000-\U0001efff\U00020000-\U0010ffff]")


@functools.cache
def _byte_letters() -> str:
    """The printable letter of each byte in byte-level vocabularies: visible Latin-1 stays, the rest moves up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(hidden)) for b in range(256))


@functools.cache
def _loaded(path: str):
    import tokenizers

    return tokenizers.Tokenizer.from_file(path)


@functools.cache
def _sentencepiece(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _is_byte_level(tokenizer) -> bool:
    """True for plain byte-level BPE: the standard pattern and nothing that looks at a text as a whole."""
    import json

    spec = json.loads(tokenizer.to_str())
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    return (
        pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        and model.get("type") == "BPE" and not model.get("dropout") and not spec.get("normalizer")
        and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )


class _Odd(ValueError):
    """A text that the memo's pattern may cut in another way than the tokenizer does."""


class _Memo(dict):
    """Piece -> ``make(its tokens)``; pieces not met for long go."""

    def __init__(self, tokenizer, make: Callable[[list], object]):
        self.tokenize, self.make, self.letters = tokenizer.model.tokenize, make, _byte_letters()
        self.before: dict = {}

    def __missing__(self, piece: str):
        value = self.before.get(piece)
        if value is None:
            if not (piece.isascii() and piece.isprintable()) and _odd().search(piece):
                raise _Odd(piece)
            value = self.make(self.tokenize(codecs.charmap_decode(piece.encode(), "strict", self.letters)[0]))
        if len(piece) <= MEMO_CHARACTERS:
            if len(self) >= MEMO_PIECES:
                self.before = dict(self)
                self.clear()
            self[piece] = value
        return value


@functools.cache
def _memo(path: str, kind: str) -> _Memo:
    return _Memo(_loaded(path), len if kind == "count" else lambda found: packed([t.id for t in found]))


def packed(ids: Iterable[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    ids = list(ids)
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.cache
def _added(path: str) -> list[str]:
    """Strings that the tokenizer takes out of a text before it is cut into pieces."""
    return [t.content for t in _loaded(path).get_added_tokens_decoder().values()]


def safe_parts(text: str, size: int = ENCODE_BYTES) -> list[str]:
    """``text`` cut before single spaces between ASCII letters into parts of about ``size`` characters.

    A text without such a place stays whole.
    """
    if len(text) <= size:
        return [text]
    parts, start = [], 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if not cut:
            break
        parts.append(text[start : cut.start()])
        start = cut.start()
    return [*parts, text[start:]]


def balanced(texts: list[str], size: int = ENCODE_BYTES) -> list[list[int]]:
    """Positions of ``texts`` in groups of about ``size`` characters each, longest first, so that no group straggles."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    groups, room = [], 0
    for i in order:
        if not groups or room < len(texts[i]):
            groups.append([])
            room = size
        groups[-1].append(i)
        room -= len(texts[i])
    return groups


def _encoded(path: str, texts: list[str], make: Callable[[list[int]], object]) -> list:
    """``make(ids)`` of each text, encoded by the library in groups balanced by size."""
    out: list = [None] * len(texts)
    for group in balanced(texts):
        some = [texts[i] for i in group]
        if path.endswith(".model"):
            ids = _sentencepiece(path).encode(some, num_threads=1)
        else:
            ids = [e.ids for e in _loaded(path).encode_batch_fast(some, add_special_tokens=False)]
        for i, x in zip(group, ids):
            out[i] = make(x)
    return out


def _cut_parts(path: str, text: str) -> list[str]:
    """Parts of a long text that the library may encode one by one."""
    parts = safe_parts(text)
    if path.endswith(".model"):  # the library itself puts the word mark before each part
        return [parts[0], *(p[1:] for p in parts[1:])]
    return parts


def _over_texts(path: str, texts: list[str], kind: str, make, join) -> list:
    out: list = [None] * len(texts)
    rest: list[int] = []
    quick = path.endswith(".json") and _byte_level(path)
    if quick:
        value, cut, added = _memo(path, kind).__getitem__, _pieces().findall, _added(path)
        for i, text in enumerate(texts):
            try:
                if any(a in text for a in added):
                    raise _Odd(text)
                out[i] = join(map(value, cut(text)))
            except _Odd:
                rest.append(i)
    else:
        rest = list(range(len(texts)))
    if rest:
        parts = [_cut_parts(path, texts[i]) for i in rest]
        made = iter(_encoded(path, [p for ps in parts for p in ps], make))
        for i, ps in zip(rest, parts):
            out[i] = join(next(made) for _ in ps)
    return out


@functools.cache
def _byte_level(path: str) -> bool:
    return _is_byte_level(_loaded(path))


def counts(path: str, texts: list[str]) -> list[int]:
    """Number of tokens of each text, without begin, end or added special tokens."""
    return _over_texts(path, texts, "count", len, sum)


def packed_ids(path: str, texts: list[str]) -> list[bytes]:
    """Token ids of each text as packed 32-bit numbers."""
    return _over_texts(path, texts, "ids", packed, b"".join)



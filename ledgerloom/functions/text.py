"""Text expressions: trimming, cleaning, header keys, paths and deterministic ids."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The characters counted as white space when a value is trimmed.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body`` (for use inside array lambdas)."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    """Trim every kind of white space on both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


_SPACE = r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same characters as a pattern class; spelled out, it is much cheaper than a Unicode-aware ``\\s``.
SPACES = f"[{_SPACE}]"
#: Any other character.
FILLED = f"[^{_SPACE}]"
#: Runs of white space, but for a blank before a letter or sign, which is clean already. Nearly all of those lie in the three
#: ranges looked for ahead, which settles most characters with one to three comparisons where the class makes ten.
RUNS = rf"(?! ?[!-~\xa1-\u167f\u3001-\uffff]){SPACES}+"


#: What a clean text never holds; looking for it is cheaper than cleaning a text that is clean.
UNCLEAN = r"[\x09-\x0d\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|^ |  | \z"


def clean(c: Column) -> Column:
    """Collapse runs of white space to one blank and trim; null becomes the empty string."""
    return F.coalesce(F.trim(F.regexp_replace(c, RUNS, " ")), F.lit(""))


def has_text(c: Column) -> Column:
    """Whether ``clean`` leaves anything of it; the first character that is not white space tells."""
    return F.coalesce(c.rlike(FILLED), F.lit(False))


def header_key(c: Column) -> Column:
    """Lower-case and keep only ``a-z0-9``: the key under which headers and contract columns meet."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def local_path(path: Column) -> Column:
    """``file:/x`` and ``file:///x`` as ``/x``; other schemes stay as they are."""
    return F.regexp_replace(path, "^file:/+", "/")


def dirname(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def extension(path: Column) -> Column:
    """Text after the last dot, lower-cased; a name without a dot is its own extension."""
    return F.lower(F.element_at(F.split(path, r"\."), -1))


def normalize_path(path: Column) -> Column:
    """Resolve ``.``, ``..`` and doubled slashes lexically (object stores have no symlinks)."""
    parts = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))
    resolved = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(
            p == "..",
            F.when(F.size(acc) > 0, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc),
        ).otherwise(F.concat(acc, F.array(p))),
    )
    return F.concat(F.lit("/"), F.array_join(resolved, "/"))


def quote_regex(c: Column) -> Column:
    """Quote a data value so that it can stand inside a pattern."""
    return F.regexp_replace(c, r"([\\^$.|?*+()\[\]{}\-])", r"\\$1")


def glob_to_regex(c: Column) -> Column:
    """Shell wildcard (``*``, ``?``, ``[...]``) to an anchored pattern over one path segment."""
    escaped = F.regexp_replace(c, r"([\\^$.|+(){}])", r"\\$1")
    sets = F.regexp_replace(escaped, r"\[!", "[^")
    return F.concat(
        F.lit("^"),
        F.regexp_replace(F.regexp_replace(sets, r"\*", "[^/]*"), r"\?", "[^/]"),
        F.lit("$"),
    )


def generated_id(request: Column) -> Column:
    """``AUTO-`` plus 16 hex digits, derived from the request so that a retry gets the same id."""
    return F.concat(F.lit("AUTO-"), F.substring(F.sha2(request, 256), 1, 16))


def run_id(request: Column, attempt: Column) -> Column:
    """12 hex digits naming one run of one request; the same request and attempt always agree."""
    return F.substring(F.sha2(F.concat_ws("\x1f", request, attempt.cast("string")), 256), 1, 12)

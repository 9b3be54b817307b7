"""Dirty text to numbers, dates, booleans and plain text under an error policy.

Every value stays text, as the record format keeps precision and scale; typed views use ``try_cast``.
The same small steps are offered in two shapes: ``*_text`` builds one Column (usable inside array
lambdas, where each row may follow another contract) and ``with_*`` spreads the steps over projections
that whole-stage codegen fuses.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .dates import date_text
from .text import WHITESPACE, let, strip

# Declared column types, by family.
NUMBER_TYPES = ("numeric", "decimal", "number", "float", "double")
INTEGER_TYPES = ("int", "integer", "bigint")
DATE_TYPES = ("date",)
TIMESTAMP_TYPES = ("timestamp", "datetime", "timestamptz")
BOOLEAN_TYPES = ("bool", "boolean")
TRUE_WORDS = ("1", "true", "y", "yes", "t")
CURRENCY_AND_SEPARATORS = ",$€£¥"
# The date formats tried in order.
DATE_FORMATS = ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d-%b-%Y", "%Y%m%d")


@dataclass(frozen=True)
class CoercionOptions:
    """Switches of the coercion step; the defaults are the documented ones."""

    date_formats: tuple[str, ...] = DATE_FORMATS
    dayfirst: bool = True
    on_error: str = "keep_raw"  # keep_raw | null | fail
    parentheses_negative: bool = True
    trailing_minus: bool = True
    crdr_suffix: bool = True


DEFAULTS = CoercionOptions()


# --- numeric, in steps ------------------------------------------------------------------------------
def _is_blank(s: Column) -> Column:
    return s.isin("", "-", "--")


def _drop_suffix(s: Column, options: CoercionOptions) -> Column:
    if not options.crdr_suffix:
        return s
    # only texts that end in one of the suffix letters pay for the pattern
    return F.when(
        F.upper(F.right(s, F.lit(1))).isin("R", "C", "D"),
        F.regexp_replace(s, r"(?i)\s*(CR|DR|C|D)\s*$", ""),
    ).otherwise(s)


def _open_parentheses(s: Column, options: CoercionOptions) -> Column:
    if not options.parentheses_negative:
        return s
    wrapped = s.startswith("(") & s.endswith(")")
    return F.when(wrapped, F.substring(s, F.lit(2), F.length(s) - 2)).otherwise(s)


def _marked_negative(before: Column, inner: Column, options: CoercionOptions) -> Column:
    marked = F.length(before) != F.length(inner)
    return (marked | inner.endswith("-")) if options.trailing_minus else marked


def _digits(inner: Column, options: CoercionOptions) -> Column:
    body = inner
    if options.trailing_minus:
        body = F.when(inner.endswith("-"), F.substring(inner, F.lit(1), F.length(inner) - 1)).otherwise(inner)
    return F.translate(body, CURRENCY_AND_SEPARATORS + WHITESPACE, "")


def _valid_number(digits: Column) -> Column:
    return digits.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$")


def _plain(digits: Column) -> Column:
    """Unsigned canonical digits: no leading zeros, no bare point, scale untouched."""
    unsigned = F.ltrim(F.translate(digits, "+-", ""), F.lit("0"))
    led = F.when((unsigned == "") | unsigned.startswith("."), F.concat(F.lit("0"), unsigned)).otherwise(unsigned)
    return F.rtrim(led, F.lit("."))


def _signed(digits: Column, plain: Column, marked: Column) -> Column:
    own_minus = digits.startswith("-")
    is_zero = F.translate(plain, "0.", "") == ""
    minus = F.when(marked, ~own_minus & ~is_zero).otherwise(own_minus)
    return F.concat(F.when(minus, "-").otherwise(""), _scientific(plain))


def _scientific(plain: Column) -> Column:
    """Decimals below one millionth print in scientific form (``1E-7``), all others as they are."""
    tail = F.ltrim(F.regexp_replace(plain, r"^0\.", ""), F.lit("0"))
    places = F.length(plain) - 2
    exponent = F.when(tail == "", places).otherwise(places - F.length(tail) + 1)
    mantissa = (
        F.when(tail == "", "0")
        .when(F.length(tail) == 1, tail)
        .otherwise(F.concat(F.substring(tail, 1, 1), F.lit("."), F.substring(tail, F.lit(2), F.length(tail))))
    )
    tiny = plain.startswith("0.000000") & (exponent > 6)
    return F.when(tiny, F.concat(mantissa, F.lit("E-"), exponent.cast("string"))).otherwise(plain)


def numeric_text(c: Column, options: CoercionOptions = DEFAULTS) -> Column:
    """Canonical number text of a dirty number; null when blank or not a number (see :func:`is_blank_number`)."""

    def of_stripped(s):
        def of_suffixless(t):
            def of_inner(inner):
                return let(
                    _digits(inner, options),
                    lambda d: F.when(
                        ~_is_blank(s) & _valid_number(d),
                        _signed(d, _plain(d), _marked_negative(t, inner, options)),
                    ),
                )

            return let(_open_parentheses(t, options), of_inner)

        return let(_drop_suffix(s, options), of_suffixless)

    return let(strip(c), of_stripped)


def is_blank_number(c: Column) -> Column:
    """Texts that mean "no number" rather than a bad one."""
    return c.isNull() | _is_blank(strip(c))


def with_numeric(
    df: DataFrame, source: str, target: str, options: CoercionOptions = DEFAULTS, integer: bool = False
) -> DataFrame:
    """Add ``target`` = coerced ``source`` under the error policy, as fused projections."""
    tmp = [f"__{target}_{i}" for i in range(5)]
    s, t, inner, digits, plain = (F.col(x) for x in tmp)
    out = (
        df.withColumn(tmp[0], strip(F.col(source)))
        .withColumn(tmp[1], _drop_suffix(s, options))
        .withColumn(tmp[2], _open_parentheses(t, options))
        .withColumn(tmp[3], _digits(inner, options))
        .withColumn(tmp[4], _plain(digits))
    )
    good = _signed(digits, plain, _marked_negative(t, inner, options))
    if integer:
        good = integer_text(good)
    value = (
        F.when(F.col(source).isNull() | _is_blank(s), F.lit(None).cast("string"))
        .when(_valid_number(digits), good)
        .otherwise(on_error(F.col(source), "numeric", options))
    )
    return out.withColumn(target, value).drop(*tmp)


def integer_text(number: Column) -> Column:
    """Truncate canonical number text toward zero."""
    whole = F.when(number.contains("E-"), F.lit("0")).otherwise(F.substring_index(number, ".", 1))
    return F.when(whole == "-0", F.lit("0")).otherwise(whole)


# --- the other families -----------------------------------------------------------------------------
def boolean_text(c: Column) -> Column:
    """Listed words are true; any other non-null text is false."""
    return F.when(c.isNotNull(), F.lower(strip(c)).isin(*TRUE_WORDS).cast("string"))


def boolean(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lower(strip(c)).isin(*TRUE_WORDS))


def varchar_text(c: Column, value_type: Column | None = None) -> Column:
    """Trim; a whole number that arrived as a number cell loses its ``.0`` (ids from sheets)."""
    if value_type is None:
        return strip(c)
    whole = (value_type == "number") & c.rlike(r"^-?[0-9]+\.0+$")
    return F.when(whole, F.regexp_replace(c, r"\.0+$", "")).otherwise(strip(c))


def null_nan(c: Column) -> Column:
    """A floating NaN counts as missing."""
    return F.when(~F.isnan(c), c)


def on_error(raw: Column, type_name: str | Column, options: CoercionOptions) -> Column:
    """What a value that cannot be coerced becomes: its untrimmed self, null, or a failed query."""
    if options.on_error == "keep_raw":
        return raw
    if options.on_error == "null":
        return F.lit(None).cast("string")
    kind = F.lit(type_name) if isinstance(type_name, str) else type_name
    return F.raise_error(F.concat(F.lit("cannot coerce '"), raw, F.lit("' to "), kind)).cast("string")


def coerce_text(
    c: Column, type_name: str, options: CoercionOptions = DEFAULTS, custom_format: str | None = None, custom: Column | None = None
) -> Column:
    """Coerce one column of a known type (plan-time dispatch, used for wide records)."""
    kind = (type_name or "varchar").lower()
    if kind in NUMBER_TYPES + INTEGER_TYPES:
        good = numeric_text(c, options)
        good = integer_text(good) if kind in INTEGER_TYPES else good
        blank = is_blank_number(c)
    elif kind in DATE_TYPES + TIMESTAMP_TYPES:
        good = date_text(c, options.date_formats, with_time=kind in TIMESTAMP_TYPES, custom_format=custom_format, custom=custom, dayfirst=options.dayfirst)
        blank = c.isNull() | (strip(c) == "")
    elif kind in BOOLEAN_TYPES:
        return boolean_text(c)
    else:
        return varchar_text(c)
    return F.when(blank, F.lit(None).cast("string")).otherwise(F.coalesce(good, on_error(c, kind, options)))


def coerce_dynamic(
    c: Column, kind: Column, options: CoercionOptions = DEFAULTS, custom: Column | None = None, value_type: Column | None = None
) -> Column:
    """Coerce when the type itself is data (many contracts in one plan).

    ``custom`` is the shape of the table's own date format, ``value_type`` the type of a sheet's cell.
    """
    return (
        F.when(kind.isin(*NUMBER_TYPES), coerce_text(c, "numeric", options))
        .when(kind.isin(*INTEGER_TYPES), coerce_text(c, "bigint", options))
        .when(kind.isin(*DATE_TYPES), coerce_text(c, "date", options, custom=custom))
        .when(kind.isin(*TIMESTAMP_TYPES), coerce_text(c, "timestamp", options, custom=custom))
        .when(kind.isin(*BOOLEAN_TYPES), boolean_text(c))
        .otherwise(varchar_text(c, value_type))
    )

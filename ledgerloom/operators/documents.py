"""Values of a whole document: first match of a pattern, or the text after a keyword."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import clean, quote_regex, strip
from ..session import write_once
from .ordered import OrderedRows, following

# Document fields looked for by default.
KEY_VALUE_PATTERNS = {
    "opening_balance": r"opening\s+balance[:\s]+([\-\d,().]+)",
    "closing_balance": r"closing\s+balance[:\s]+([\-\d,().]+)",
    "statement_date": r"statement\s+date[:\s]+([\w/\-. ]+)",
}


#: Pages after its first one that a match may run into before it is looked at again, and then.
REACH, WIDE = 2, 32


def _own_line(rest: Column) -> Column:
    """What stands before the first line separator other than the line feed, cleaned."""
    return clean(F.regexp_extract(rest, "^[^\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]*", 0))


def keyword_pattern(keyword: Column) -> Column:
    """The rest of the line after a keyword and an optional ``:`` or ``-``; the keyword is data, so it is quoted."""
    bare = F.btrim(strip(keyword), F.lit("'\""))
    return F.concat(quote_regex(bare), F.lit(r"\s*[:\-]?\s*(.+)"))


def keyword_value(text: Column, keyword: Column) -> Column:
    """Rest of the line after a keyword (and an optional ``:`` or ``-``).

    A keyword at the end of a line takes the next non-blank line. ``.`` excludes only the line feed, and other line
    separators end the value.
    """
    pattern = F.concat(F.lit("(?id)"), keyword_pattern(keyword))
    return F.when(F.regexp_like(text, pattern), _own_line(F.call_function("regexp_extract", text, pattern, F.lit(1))))


def _filled(page_text: DataFrame) -> DataFrame:
    """Pages with text; those of white space only hold nothing."""
    return page_text.select("file_id", "page", "text").filter(F.coalesce(strip(F.col("text")), F.lit("")) != "")


def stretches(page_text: DataFrame, reach: int = REACH) -> DataFrame:
    """``file_id, page, stretch, further`` of the pages with text: each with the ``reach`` pages after it.

    One line break stands between pages; ``further`` tells whether a page follows the stretch. No document is gathered:
    its pages are ordered like any other rows, a document of very many pages in blocks.
    """
    rows = OrderedRows.of(_filled(page_text), ["file_id"], ["page"])
    before = "text"
    for k in range(1, reach + 2):
        rows = rows.carry(**{f"__{k}": following(F.col(before))})
        before = f"__{k}"
    return rows.rows().select(
        "file_id", "page", F.concat_ws("\n", "text", *(f"__{k}" for k in range(1, reach + 1))).alias("stretch"),
        F.col(f"__{reach + 1}").isNotNull().alias("further"))


def _match(stretch: Column, further: Column, flags: str, pattern: Column) -> Column:
    """The first match in the stretch: struct of value and whether it may go on, null if there is none.

    A match may go on if pages follow and one touches the end of the stretch.
    """
    own = F.concat(F.lit(flags), pattern)
    ends = F.when(further, F.regexp_like(stretch, F.concat(F.lit(f"{flags}(?:"), pattern, F.lit(")\\z")))).otherwise(False)
    match = F.struct(F.call_function("regexp_extract", stretch, own, F.lit(1)).alias("value"), ends.alias("open"))
    return F.when(F.regexp_like(stretch, own), match)


def _first(flags: str, pattern: Column) -> Column:
    """Aggregate over the ``stretches`` of a document: of the first page whose stretch has a match, its value and whether it may go on."""
    match = _match(F.col("stretch"), F.col("further"), flags, pattern)
    return F.min(F.transform(F.array(match), lambda m: F.when(m.isNotNull(), F.struct(F.col("page"), m["value"].alias("value"), m["open"].alias("open"))))[0])


def _widened(found: DataFrame, page_text: DataFrame, keys: list[str], flags: str, pattern: Column) -> DataFrame:
    """``found`` (keys, page, value, open) with the open matches settled over ``WIDE`` more pages.

    A match is open if it touches the end of its stretch while pages follow: only there it may go on.
    """
    found = write_once(found, "first-matches")
    if found.filter("open").isEmpty():
        return found.select(*keys, "value")
    pages = _filled(page_text).select(F.col("file_id").alias("__file"), F.col("page").alias("__page"), F.col("text").alias("__text"))
    near = found.filter("open").join(pages, (F.col("file_id") == F.col("__file")) & (F.col("__page") >= F.col("page")))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("__page"))
    near = near.withColumn("__n", nth).filter(F.col("__n") <= REACH + 1 + WIDE).groupBy(*keys, "page").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("__n", "__text"))), lambda p: p["__text"]).alias("__texts"))
    wide = near.withColumn("stretch", F.array_join("__texts", "\n"))
    wide = wide.select(*keys, _match(F.col("stretch"), F.lit(False), flags, pattern)["value"].alias("value"))
    return found.filter(~F.col("open")).select(*keys, "value").unionByName(wide)


def key_values(page_text: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """One row per file with one column per field: group 1 of the first match in the text of all its pages, cleaned.

    A match may run over ``REACH`` pages after its first one, and over ``WIDE`` more where it touches the end of those.
    """
    wanted = patterns or KEY_VALUE_PATTERNS
    firsts = stretches(page_text).groupBy("file_id").agg(*(_first("(?i)", F.lit(p)).alias(n) for n, p in wanted.items()))
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("field"), F.col(n).alias("f")) for n in wanted))).alias("x")
    found = firsts.select("file_id", each).select("file_id", "x.field", "x.f.page", "x.f.value", F.coalesce("x.f.open", F.lit(False)).alias("open"))
    pattern = F.element_at(F.create_map(*(F.lit(x) for kv in wanted.items() for x in kv)), F.col("field"))
    found = _widened(found, page_text, ["file_id", "field"], "(?i)", pattern)
    return found.groupBy("file_id").agg(*(F.max(F.when(F.col("field") == n, clean_known(F.col("value")))).alias(n) for n in wanted))


def clean_known(value: Column) -> Column:
    """``clean`` that leaves null as it is."""
    return F.when(value.isNotNull(), clean(value))


def keyword_values(page_text: DataFrame, keywords: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(values per file and field, warnings for keywords that do not occur).

    ``keywords(file_id, field, keyword)`` come with the request of the file.
    """
    keys, pattern = ["file_id", "keyword"], keyword_pattern(F.col("keyword"))
    rows = stretches(page_text).join(keywords.select(*keys).distinct(), "file_id")
    firsts = rows.groupBy(*keys).agg(_first("(?id)", pattern).alias("f"))
    found = firsts.select(*keys, "f.page", "f.value", F.coalesce("f.open", F.lit(False)).alias("open"))
    found = _widened(found, page_text, keys, "(?id)", pattern)
    found = found.select(*keys, F.when(F.col("value").isNotNull(), _own_line(F.col("value"))).alias("value"))
    asked = keywords.join(found, keys, "left")
    bare = F.btrim(strip(F.col("keyword")), F.lit("'\""))
    warnings = asked.filter(F.col("value").isNull()).select(
        "file_id",
        F.lit("missing_keyword").alias("kind"),
        F.concat(F.lit("keyword '"), bare, F.lit("' of field "), F.col("field"), F.lit(" does not occur")).alias("detail"),
    )
    return asked.filter(F.col("value").isNotNull()).select("file_id", "field", "value"), warnings


def document_map(pattern_fields: DataFrame, keyword_fields: DataFrame) -> DataFrame:
    """``doc MAP<STRING,STRING>`` per file; keyword values override pattern values of the same name."""
    names = [c for c in pattern_fields.columns if c != "file_id"]
    entries = F.array(*(F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in names))
    base = pattern_fields.select(
        "file_id", F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("base")
    )
    # fields named by one request: a short list
    extra = keyword_fields.groupBy("file_id").agg(
        F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("extra")
    )
    empty = F.create_map().cast("map<string,string>")
    joined = base.join(extra, "file_id", "full").select(
        "file_id", F.coalesce("base", empty).alias("base"), F.coalesce("extra", empty).alias("extra")
    )
    kept = F.map_filter("base", lambda k, _: ~F.map_contains_key(F.col("extra"), k))
    return joined.select("file_id", F.map_concat(kept, "extra").alias("doc"))

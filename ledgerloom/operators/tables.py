"""Repair of extracted tables: size filter, header detection, stitching over pages, wrapped rows.

Input is ``fragments(file_id, page, table_on_page, strategy_ord, row_no, cells)``: the rows of every table
found on every page. A page is the unit a page extractor holds in memory, so a fragment is bounded; a file
is not, and everything that follows the order of a file goes through :class:`OrderedRows`.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.money import looks_numeric
from ..functions.text import clean
from .ordered import BLOCK_ROWS, OrderedRows, last, previous, running

FRAGMENT = ["file_id", "page", "table_on_page"]


@dataclass(frozen=True)
class TableOptions:
    min_rows: int = 2
    min_cols: int = 2
    stitch_across_pages: bool = True
    drop_repeated_headers: bool = True
    merge_wrapped_rows: bool = True
    key_column_index: int = 0
    # Rows that are page furniture rather than data.
    skip_row_patterns: tuple[str, ...] = (r"^\s*(page \d+|total|sub\s*total|continued)\b",)


DEFAULTS = TableOptions()


def clean_cells(cells: Column) -> Column:
    return F.transform(cells, clean)


def not_blank(cells: Column) -> Column:
    return F.exists(cells, lambda c: c != "")


def is_noise(line: Column, patterns: tuple[str, ...]) -> Column:
    """Any pattern found in the text, ignoring case."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | line.rlike(f"(?i){p}")
    return hit


def is_header(cells: Column) -> Column:
    """Enough filled cells, and less than a fifth of them numeric-looking."""
    filled = F.filter(cells, lambda c: c != "")
    numeric = F.size(F.filter(filled, looks_numeric))
    return (F.size(filled) >= F.greatest(F.lit(2), F.floor(F.size(cells) / 2))) & (
        numeric / F.greatest(F.size(filled), F.lit(1)) < 0.2
    )


def sized_fragments(fragments: DataFrame, options: TableOptions = DEFAULTS) -> DataFrame:
    """Clean cells, drop blank rows and fragments that are too small, keep one strategy per page.

    Of the extraction strategies tried on a page, the first with any table left is kept.
    """
    rows = fragments.withColumn("cells", clean_cells(F.col("cells"))).filter(not_blank(F.col("cells")))
    sizes = (
        rows.groupBy(*FRAGMENT, "strategy_ord")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.size("cells")).alias("width"))
        .filter((F.col("n_rows") >= options.min_rows) & (F.col("width") >= options.min_cols))
    )
    page = Window.partitionBy("file_id", "page")  # slim: one row per table of a page
    chosen = (
        sizes.withColumn("__best", F.min("strategy_ord").over(page))
        .filter(F.col("strategy_ord") == F.col("__best"))
        .drop("__best", "n_rows")
    )
    kept = rows.join(chosen, [*FRAGMENT, "strategy_ord"], "inner")
    padded = F.concat(
        "cells", F.array_repeat(F.lit(""), F.greatest(F.col("width") - F.size("cells"), F.lit(0)))
    )
    return kept.withColumn("cells", padded)


def split_headers(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row per fragment with its ``header``, body rows).

    The header is the first of the first five rows that looks like one; rows above it are dropped. Without
    one the columns are called ``col_1..n`` and every row is kept.
    """
    fragment = Window.partitionBy(*FRAGMENT).orderBy("row_no")
    ranked = rows.withColumn("__rn", F.row_number().over(fragment)).withColumn(
        "__head", (F.col("__rn") <= 5) & is_header(F.col("cells"))
    )
    heads = ranked.groupBy(*FRAGMENT).agg(
        F.first("width").alias("width"),
        F.min(F.when(F.col("__head"), F.col("__rn"))).alias("__at"),
        F.min_by("cells", F.when(F.col("__head"), F.col("__rn"))).alias("__cells"),
    )
    generated = F.transform(
        F.sequence(F.lit(1), F.col("width")), lambda i: F.concat(F.lit("col_"), i.cast("string"))
    )
    heads = heads.withColumn("header", F.coalesce("__cells", generated)).drop("__cells")
    whole = Window.partitionBy(*FRAGMENT)
    body = (
        ranked.withColumn("__at", F.min(F.when(F.col("__head"), F.col("__rn"))).over(whole))
        .filter(F.col("__at").isNull() | (F.col("__rn") > F.col("__at")))
        .drop("__rn", "__head", "__at")
    )
    return heads.drop("__at"), body


def stitch(
    heads: DataFrame,
    options: TableOptions = DEFAULTS,
    block_rows: int = BLOCK_ROWS,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Add ``table_no`` (1-based within the file) and the running ``table_header`` to each fragment.

    A fragment joins the running table when its width agrees and its header either repeats the running
    header or was generated. Inside a run of equal width the running header is the last real header seen,
    or the generated one when there was none.
    """
    if not options.stitch_across_pages:
        return (
            OrderedRows.of(heads, ["file_id"], ["page", "table_on_page"], block_rows, size_of)
            .number("table_no")
            .rows()
            .withColumns({"table_header": F.col("header"), "table_page": F.col("page")})
        )
    no_header = F.array().cast("array<string>")
    seq = OrderedRows.of(heads, ["file_id"], ["page", "table_on_page"], block_rows, size_of).carry(
        __width=previous(F.col("width"))
    )
    seq = seq.with_columns(
        __run=F.col("__width").isNull() | (F.col("__width") != F.col("width")),
        __gen=F.col("header")[0].startswith("col_"),
    )
    seq = seq.carry(
        __real=last(
            F.when(F.col("__run") & F.col("__gen"), no_header).when(
                F.col("__run") | ~F.col("__gen"), F.col("header")
            ),
            inclusive=False,
        )
    )
    seq = seq.with_columns(
        __new=F.col("__run") | (~F.col("__gen") & (F.col("header") != F.coalesce("__real", no_header)))
    )
    seq = seq.carry(
        table_no=running(F.col("__new").cast("bigint")),
        table_header=last(F.when(F.col("__new"), F.col("header"))),
        table_page=last(F.when(F.col("__new"), F.col("page"))),
    )
    return seq.rows().drop("__width", "__run", "__gen", "__real", "__new")


def merge_wrapped(
    body: DataFrame,
    options: TableOptions = DEFAULTS,
    keys: tuple[str, ...] = ("file_id",),
    order: tuple[str, ...] = ("page", "table_on_page", "row_no"),
    block_rows: int = BLOCK_ROWS,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Drop noise rows and repeated headers, then append wrapped rows to the row above.

    ``body`` has ``table_no`` and ``table_header`` besides the order columns. A row with an empty key cell
    and no numeric-looking cell continues the previous kept row of the same table, cell by cell. The result
    has ``src_row``, the 1-based number of the merged row within its table.
    """
    header = F.col("table_header")
    key = F.get("cells", F.least(F.lit(options.key_column_index), F.size(header) - 1))
    kept = body.filter(~is_noise(F.array_join("cells", " "), options.skip_row_patterns))
    if options.drop_repeated_headers:
        kept = kept.filter(F.col("cells") != header)
    loose = (key == "") & ~F.exists("cells", lambda c: (c != "") & looks_numeric(c))
    seq = OrderedRows.of(kept, keys, order, block_rows, size_of).carry(__table=previous(F.col("table_no")))
    first = F.col("__table").isNull() | (F.col("__table") != F.col("table_no"))
    seq = seq.with_columns(
        __first=first, __head=(first | ~loose) if options.merge_wrapped_rows else F.lit(True)
    ).carry(__group=running(F.col("__head").cast("bigint")))
    seq = seq.carry(__base=last(F.when(F.col("__first"), F.col("__group"))))
    parts = F.transform(
        F.sort_array(F.collect_list(F.struct(F.struct(*order).alias("o"), F.col("cells").alias("c")))),
        lambda x: x["c"],
    )
    grouped = seq.rows().groupBy(*keys, "table_no", "__group").agg(
        parts.alias("__parts"),
        F.max(F.size("table_header")).alias("__width"),
        F.max("__base").alias("__base"),
    )
    merged = F.transform(
        F.sequence(F.lit(0), F.col("__width") - 1),
        lambda i: F.array_join(
            F.filter(
                F.transform("__parts", lambda r: F.coalesce(F.get(r, i), F.lit(""))), lambda c: c != ""
            ),
            " ",
        ),
    )
    return grouped.select(
        *keys, "table_no", (F.col("__group") - F.col("__base") + 1).alias("src_row"), merged.alias("cells")
    )


def logical_tables(
    fragments: DataFrame, options: TableOptions = DEFAULTS, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(tables: header, page and number per logical table; cells: repaired rows) of raw fragments."""
    heads, body = split_headers(sized_fragments(fragments, options))
    # a file has no more tables and rows than fragment rows
    placed = stitch(heads, options, block_rows, fragments)
    tables = placed.filter(F.col("page") == F.col("table_page")).groupBy("file_id", "table_no").agg(
        F.min_by("table_header", "table_on_page").alias("headers"), F.min("table_page").alias("page")
    )
    rows = body.join(placed.select(*FRAGMENT, "table_no", "table_header"), FRAGMENT, "inner")
    return tables, merge_wrapped(rows, options, block_rows=block_rows, size_of=fragments)


def select_pages(pages: DataFrame, spec: str, page: str = "page", counts: DataFrame | None = None) -> DataFrame:
    """Pages named by ``all`` or ``1-3,5``: in the order written (``page_ord``), repeats kept.

    Pages a file does not have simply do not join.
    """
    if not spec or spec == "all":
        return pages.withColumn("page_ord", F.col(page).cast("bigint"))
    spark = pages.sparkSession
    ranges = (
        spark.range(1)
        .select(F.posexplode(F.split(F.lit(spec), ",")).alias("i", "part"))
        .select("i", F.split("part", "-").alias("ab"))
        .select("i", F.get("ab", F.lit(0)).cast("int").alias("a"), F.get("ab", F.lit(1)).alias("b"))
        .withColumn("b", F.when(F.coalesce("b", F.lit("")) == "", F.col("a")).otherwise(F.col("b").cast("int")))
        .filter("b >= a")
    )
    # one row per part of the option's text: ranges are not spelled out, however long they are
    ranges = ranges.select("i", "a", "b")
    chosen = pages.join(ranges, F.col(page).between(F.col("a"), F.col("b")))
    return chosen.withColumn("page_ord", F.col("i").cast("bigint") * 1_000_000_000 + F.col(page)).drop("i", "a", "b")


def pages_with_text(files: DataFrame, page_text: DataFrame) -> DataFrame:
    """Warning rows for files without any text layer."""
    some = page_text.filter(F.coalesce(F.trim("text"), F.lit("")) != "").select("file_id").distinct()
    return files.join(some, "file_id", "left_anti").select(
        "file_id", F.lit("no_text_layer").alias("kind"),
        F.lit("no page of the file holds text; it may be a scan").alias("detail"),
    )


def files_without_tables(files: DataFrame, tables: DataFrame) -> DataFrame:
    """Warning rows for files in which no table was found."""
    return files.join(tables.select("file_id").distinct(), "file_id", "left_anti").select(
        "file_id", F.lit("no_tables").alias("kind"),
        F.lit("none of the pages holds a table").alias("detail"),
    )

"""Sheet cells ``(file_id, sheet_idx, sheet, row, col, value, value_type)`` to tables of cells."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import write_once
from .ordered import OrderedRows


def wanted_sheets(sheets: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chosen sheets with ``table_no``, warnings for names that do not exist).

    ``sheets(file_id, sheet_idx, sheet)``; ``requests(file_id, identifiers ARRAY<STRING>)``. No identifier
    means the first sheet, digits are a 0-based index when there are that many sheets, anything else is a name.
    """
    named = sheets.groupBy("file_id").agg(
        # the sheets of one workbook: a short list by nature of the format
        F.transform(F.sort_array(F.collect_list(F.struct("sheet_idx", "sheet"))), lambda s: s["sheet"]).alias("names")
    )
    ids = F.filter(
        F.coalesce("identifiers", F.array().cast("array<string>")), lambda s: F.trim(s) != ""
    )
    asked = named.join(requests, ["file_id"], "left").withColumn("__ids", ids)
    wanted = F.when(F.size("__ids") == 0, F.slice("names", 1, 1)).otherwise(F.col("__ids"))
    one = asked.select("file_id", "names", F.size("__ids").alias("__n"), F.posexplode(wanted).alias("table_no", "id"))
    index = F.when(F.col("id").rlike("^[0-9]+$"), F.col("id").try_cast("int"))
    by_index = F.when((F.col("__n") > 0) & (index < F.size("names")), F.get("names", index))
    by_name = F.when(F.array_contains("names", F.col("id")), F.col("id"))
    picked = one.withColumn("sheet", F.coalesce(by_index, by_name))
    missing = picked.filter(F.col("sheet").isNull()).select(
        "file_id",
        F.lit("missing_sheet").alias("kind"),
        F.concat(F.lit("no sheet '"), F.col("id"), F.lit("'; the workbook has "), F.array_join("names", ", ")).alias("detail"),
    )
    return picked.filter(F.col("sheet").isNotNull()).select("file_id", "table_no", "sheet"), missing


def sheet_grid(cells: DataFrame, chosen: DataFrame, header_row: int | str = 1) -> tuple[DataFrame, DataFrame]:
    """(tables with trimmed headers, data rows) of the chosen sheets.

    The header is row ``header_row`` (1-based, a number or a column of ``chosen``), cut after its last filled cell; data
    rows are cut to that width and rows with only empty cells are dropped. ``src_row`` of a data row is the header's row
    and its place among the kept rows. ``cell_types`` are the cells' own types, if ``value_type`` is there. A row is
    assembled from its own cells, so the shuffle key is the row and no sheet is gathered.
    """
    typed = "value_type" in cells.columns
    chosen = chosen.select("file_id", "table_no", "sheet", (F.lit(header_row) if isinstance(header_row, int) else F.col(header_row)).alias("__head"))
    # one slim row a sheet, written so that its size is known: guessed sizes made Spark broadcast the cells instead
    chosen = write_once(chosen, "chosen")
    mine = cells.join(chosen, ["file_id", "sheet"], "inner").filter(F.col("row") >= F.col("__head"))

    def by_column(name: str) -> Column:
        return F.map_from_entries(F.collect_list(F.struct("col", name)))

    rows = mine.groupBy("file_id", "table_no", "sheet", "__head", "row").agg(
        by_column("value").alias("__m"), *([by_column("value_type").alias("__t")] if typed else []),
        F.max(F.when(F.coalesce("value", F.lit("")) != "", F.col("col"))).alias("__filled"),
    )
    rows = write_once(rows, "sheet-rows")  # read for headers, sizes and data
    width = F.coalesce(F.col("__filled"), F.lit(0))

    def listed(name: str, n: Column) -> Column:
        return F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.element_at(name, i))

    tables = write_once(rows.filter(F.col("row") == F.col("__head")).select(
        "file_id", "table_no", "sheet", width.alias("width"), listed("__m", width).alias("headers")), "sheet-heads")
    data = rows.filter(F.col("row") > F.col("__head")).join(tables.filter("width > 0").select("file_id", "table_no", "width"), ["file_id", "table_no"], "inner")
    data = data.withColumns({"cells": listed("__m", F.col("width")), **({"cell_types": listed("__t", F.col("width"))} if typed else {})})
    kept = data.filter(F.exists("cells", lambda c: F.coalesce(c, F.lit("")) != ""))
    kept = kept.select("file_id", "table_no", "sheet", "row", "__head", "cells", *(["cell_types"] if typed else []))
    numbered = OrderedRows.of(kept, ["file_id", "table_no"], ["row"]).number("__i").rows()
    return tables.drop("width"), numbered.withColumn("src_row", (F.col("__head") + F.col("__i")).cast("bigint")).drop("__head", "__i")

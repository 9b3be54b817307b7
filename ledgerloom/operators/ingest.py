"""The path of a request, for delimited files and workbooks: files, format, scan, header mapping, coercion, enrichment, batches, totals and warnings.

Every step is a DataFrame step over all requests at once; a request that cannot be read is a row of ``rejected`` and
gives nothing else. What a batch stores is the JSON text of its records, in which whole numbers, booleans and the
source row are JSON numbers and booleans; other numbers stay text, which keeps their scale.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.coerce import BOOLEAN_TYPES, INTEGER_TYPES
from ..session import write_once
from ..sources.delimited import delimiter_of, header_row_of, read_delimited
from ..sources.listing import resolve_paths, resolved_format
from .batches import build_batches, job_totals
from .contract import contract_drift, map_headers, type_of, unmapped_headers
from .records import fill_system_columns, records_mixed
from .sheets import sheet_grid, wanted_sheets


@dataclass(frozen=True)
class Ingested:
    """``batches``, ``totals`` per request, ``warnings`` (rows) and ``rejected`` requests with their error."""

    batches: DataFrame
    totals: DataFrame
    warnings: DataFrame
    rejected: DataFrame


def _quoted(text: Column) -> Column:
    """A JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def typed_json(record: Column, types: Column, row: Column) -> Column:
    """A record map as JSON text: integers and booleans bare where their type says so, then ``_row``."""

    def value(e):
        kind = F.coalesce(type_of(types, e["key"]), F.lit("varchar"))
        bare = (kind.isin(*INTEGER_TYPES) & e["value"].rlike(r"^-?(0|[1-9][0-9]*)$")) | (
            kind.isin(*BOOLEAN_TYPES) & e["value"].isin("true", "false"))
        return F.when(e["value"].isNull(), "null").when(bare, e["value"]).otherwise(_quoted(e["value"]))

    fields = F.transform(F.map_entries(record), lambda e: F.concat(_quoted(e["key"]), F.lit(":"), value(e)))
    own = F.array(F.concat(F.lit('"_row":'), row.cast("string")))
    return F.concat(F.lit("{"), F.array_join(F.concat(fields, own), ","), F.lit("}"))


def _asked_files(requests: DataFrame, listing: DataFrame, pick: str, allowed_roots: tuple[str, ...], kind: str, said: str) -> tuple[DataFrame, DataFrame]:
    """(files of the requests with their fields and ``fmt``, rejected requests); all files must be of one ``kind``.

    Both are one slim row per file or request and written once: every step below reads them, and their plan in each of
    those places would outgrow the driver.
    """
    found, refused = resolve_paths(requests.select("file_seq_id", "path", "file_name", "sub_path"), listing, pick, allowed_roots)
    fields = requests.drop("path", "file_name", "sub_path")
    files = write_once(found.join(fields, "file_seq_id").withColumn("fmt", resolved_format(F.col("path"), F.col("format"))), "found-files")
    unread = files.filter(~F.col("fmt").eqNullSafe(F.lit(kind))).select("file_seq_id", F.concat(F.lit(f"{said}: "), F.col("path")).alias("error"))
    rejected = write_once(refused.unionByName(unread).groupBy("file_seq_id").agg(F.min("error").alias("error")), "refused")
    return write_once(files.join(rejected, "file_seq_id", "left_anti"), "asked-files"), rejected


def _without(broken: DataFrame, *frames: DataFrame) -> tuple[DataFrame, ...]:
    return tuple(f.join(broken, "file_seq_id", "left_anti") for f in frames)


def _stored(
    files: DataFrame, tables: DataFrame, cells: DataFrame, contracts: DataFrame, said: DataFrame | None, rejected: DataFrame,
    engine: str, batch_size: int, more_meta: tuple[str, ...] = (),
) -> Ingested:
    """Tables of cells to stored batches: mapping, coercion, enrichment, JSON, meta, totals and warnings (with those ``said``)."""
    mapped = write_once(map_headers(tables, contracts), "mapped")
    drift = contract_drift(contracts.join(files.select("file_seq_id").distinct(), "file_seq_id", "left_semi"))
    warnings = drift.unionByName(unmapped_headers(mapped))
    warnings = warnings if said is None else warnings.unionByName(said)
    known = records_mixed(cells, mapped).join(
        files.select("file_seq_id", "file_ord", "path", "source_name", "run_id", "process_date", "enrich_flow"), ["file_seq_id", "file_ord"])
    # nested expressions over maps are evaluated once each, not once for every mention further on
    known = write_once(known, "coerced")
    plain = F.col("__plain")
    filled = write_once(fill_system_columns(known.withColumn("__plain", F.col("record"))), "filled")
    record = F.when(F.coalesce("enrich_flow", F.lit(False)), F.col("record")).otherwise(plain)
    records = filled.select("file_seq_id", "file_ord", "table_no", "src_row", typed_json(record, F.col("types"), F.col("src_row")).alias("record"))
    meta = F.map_filter(
        F.create_map(F.lit("file"), F.col("path"), F.lit("format"), F.col("fmt"), F.lit("engine"), F.lit(engine),
                     F.lit("reconId"), F.col("recon_id"), F.lit("eventId"), F.col("event_id"), *(x for c in more_meta for x in (F.lit(c), F.col(c)))),
        lambda _, v: v.isNotNull())
    described = tables.select("file_seq_id", "file_ord", "table_no", *more_meta).join(files, ["file_seq_id", "file_ord"]).select(
        "file_seq_id", "file_ord", "table_no", meta.alias("meta"))
    batches = write_once(build_batches(records, batch_size, tables=described), "batches")  # read for the totals, too
    return Ingested(batches, job_totals(batches, warnings), warnings, rejected)


def ingest_delimited(
    spark: SparkSession, requests: DataFrame, contracts: DataFrame, listing: DataFrame, pick: str = "latest",
    allowed_roots: tuple[str, ...] = (), batch_size: int = 1000,
) -> Ingested:
    """Requests for delimited files, from their messages' fields to batches.

    ``requests``: file_seq_id, path, file_name, sub_path, details_delimiter, delimiter, headers_row, format, source_name,
    run_id, process_date, enrich_flow, recon_id, event_id. ``contracts`` as in ``contract``; ``listing`` as in ``listing``.
    """
    files, rejected = _asked_files(requests, listing, pick, allowed_roots, "csv", "no delimited file")
    asked = files.select(
        "file_seq_id", "file_ord", "path", delimiter_of(F.col("details_delimiter"), F.col("delimiter")).alias("delimiter"),
        header_row_of(F.col("headers_row")).alias("headers_row"))
    # the files to open: their names go through the driver in any case, as the scan needs them
    paths = [r["path"] for r in asked.select("path").distinct().collect()]
    read = read_delimited(spark, asked, paths)
    broken = write_once(
        asked.join(read.rejected, "path").groupBy("file_seq_id").agg(F.min(F.concat("path", F.lit(": "), "error")).alias("error")), "broken")
    files, tables, cells = _without(broken, files, read.tables, read.cells)
    files, tables = write_once(files, "files"), write_once(tables, "tables")
    return _stored(files, tables, cells.drop("path"), contracts, None, rejected.unionByName(broken), "spark-delimited", batch_size)


def ingest_sheets(
    requests: DataFrame, contracts: DataFrame, listing: DataFrame, cells: DataFrame, pick: str = "latest",
    allowed_roots: tuple[str, ...] = (), batch_size: int = 1000,
) -> Ingested:
    """Requests for workbooks, from their messages' fields and the workbooks' cells to batches.

    ``requests`` as for delimited files, with ``sheet_identifiers`` (names or 0-based numbers) instead of delimiters;
    ``cells(path, sheet_idx, sheet, row, col, value, value_type)``. Each chosen sheet is a table, in the order asked for,
    and its name is in the batch's meta. A number in a text column loses its ``.0``, dates keep their ISO form. A name
    that no sheet has is a warning; a workbook without cells rejects its request.
    """
    files, rejected = _asked_files(requests, listing, pick, allowed_roots, "excel", "no workbook")
    book = F.struct("file_seq_id", "file_ord").alias("file_id")
    listed = files.select("file_seq_id", "file_ord", "path").join(cells.select("path", "sheet_idx", "sheet").distinct(), "path")
    empty = files.join(listed, ["file_seq_id", "file_ord"], "left_anti").groupBy("file_seq_id").agg(
        F.min(F.concat(F.lit("workbook without cells: "), F.col("path"))).alias("error"))
    files, listed = (write_once(f, n) for f, n in zip(_without(empty, files, listed), ("workbooks", "sheets")))
    asked = files.select(book, header_row_of(F.col("headers_row")).alias("headers_row"), F.col("sheet_identifiers").alias("identifiers"))
    chosen, missing = wanted_sheets(listed.select(book, "sheet_idx", "sheet"), asked.drop("headers_row"))
    chosen = chosen.join(asked.drop("identifiers"), "file_id")
    mine = files.select(book, "path").join(cells, "path").drop("path", "sheet_idx")
    heads, rows = sheet_grid(mine, chosen, "headers_row")
    place = ["file_id.file_seq_id", "file_id.file_ord", "table_no"]
    tables = heads.select(*place, "headers", "sheet")
    # rows are numbered by sheet, a few tasks; the costly work per row is dealt anew over all cores
    body = rows.select(*place, "src_row", "cells", "cell_types").repartition("file_seq_id", "file_ord", "table_no", "src_row")
    said = missing.select("file_id.file_seq_id", "kind", "detail")
    return _stored(files, tables, body, contracts, said, rejected.unionByName(empty), "spark-sheets", batch_size, ("sheet",))

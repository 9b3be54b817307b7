"""Numbered fixed-size batches over all tables and files of a request.

The number of a record is (records in earlier tables of the request) + (its place inside its table). Places are
counted in source order, whatever the source row numbers are; one slim row per table is scanned for the offsets.
Records are written once, since sizes, places and rows all read them, and a hot request spreads over as many
tasks as it has batches.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import write_once
from .ordered import OrderedRows, running

TABLE_KEY = ["file_seq_id", "file_ord", "table_no"]
#: Records, with their texts, that one task numbers at once.
NUMBERED_ROWS = 1 << 18


def number_records(records: DataFrame) -> DataFrame:
    """Add ``n``: 0-based number of the record within its request."""
    records = write_once(records, "records")
    tables = records.groupBy(*TABLE_KEY).agg(F.count(F.lit(1)).alias("__rows"))
    offsets = (
        OrderedRows.of(tables, ["file_seq_id"], ["file_ord", "table_no"])
        .carry(__before=running(F.col("__rows"), inclusive=False))
        .rows()
        .select(*TABLE_KEY, F.coalesce("__before", F.lit(0)).alias("__before"))
    )
    counted = OrderedRows.of(records, TABLE_KEY, ["src_row"], NUMBERED_ROWS).number("__i").rows()
    placed = counted.join(offsets, TABLE_KEY)
    return placed.withColumn("n", F.col("__before") + F.col("__i") - 1).drop("__before", "__i")


def with_batch_no(records: DataFrame, size: int | str = 1000) -> DataFrame:
    """Add ``n`` and the 1-based ``batch_no``; ``size`` is a number or the name of a column."""
    per = F.lit(size) if isinstance(size, int) else F.col(size)
    return number_records(records).withColumn("batch_no", (F.floor(F.col("n") / per) + 1).cast("int"))


def build_batches(
    records: DataFrame, size: int | str = 1000, record: str = "record", tables: DataFrame | None = None
) -> DataFrame:
    """One row per batch: ``file_seq_id, batch_no, record_count, first_row, records, meta``.

    ``records`` is an array of JSON texts in source order (a record map is rendered with its ``_row``).
    ``meta`` is that of the table being read when the batch was flushed: the last record's table for a full
    batch, the last table of the request (even an empty one) for the final partial batch. It is taken from
    ``tables(file_seq_id, file_ord, table_no, meta MAP)`` when given.
    """
    numbered = with_batch_no(records, size)
    kind = dict(numbered.dtypes)[record]
    body = F.col(record)
    if kind.startswith("map"):
        body = F.map_concat(body, F.create_map(F.lit("_row"), F.col("src_row").cast("string")))
    if kind != "string":
        body = F.to_json(body, {"ignoreNullFields": "false"})
    per = F.lit(size) if isinstance(size, int) else F.col(size)
    batches = (
        numbered.withColumn("__size", per.cast("int"))
        .groupBy("file_seq_id", "batch_no")
        .agg(
            F.count(F.lit(1)).cast("int").alias("record_count"),
            F.min_by("src_row", "n").alias("first_row"),
            F.transform(
                F.sort_array(F.collect_list(F.struct("n", body.alias("r")))), lambda x: x["r"]
            ).alias("records"),
            F.max(F.struct("n", "file_ord", "table_no")).alias("__at"),
            F.max("__size").alias("__size"),
        )
    )
    if tables is None:
        return batches.drop("__at", "__size")
    finals = tables.groupBy("file_seq_id").agg(
        F.max(F.struct("file_ord", "table_no")).alias("__final")
    )
    flushed = batches.join(finals, ["file_seq_id"], "left")
    partial = F.col("record_count") < F.col("__size")
    flushed = flushed.withColumns(
        {
            "file_ord": F.when(partial, F.col("__final.file_ord")).otherwise(F.col("__at.file_ord")),
            "table_no": F.when(partial, F.col("__final.table_no")).otherwise(F.col("__at.table_no")),
        }
    )
    meta = flushed.join(tables.select(*TABLE_KEY, "meta"), TABLE_KEY, "left")
    return meta.withColumn(
        "meta",
        F.map_concat(
            F.coalesce("meta", F.create_map().cast("map<string,string>")),
            F.create_map(
                F.lit("batch_no"), F.col("batch_no").cast("string"),
                F.lit("batch_size"), F.col("__size").cast("string"),
            ),
        ),
    ).select("file_seq_id", "batch_no", "record_count", "first_row", "records", "meta")


def job_totals(batches: DataFrame, warnings: DataFrame | None = None) -> DataFrame:
    """Per request: records, batches and how many warnings its rows of the warning table hold.

    The warnings themselves stay rows: one file may have any number of failed checks.
    """
    totals = batches.groupBy("file_seq_id").agg(
        F.sum("record_count").cast("bigint").alias("total_records"),
        F.max("batch_no").alias("total_batches"),
    )
    if warnings is None:
        return totals
    counted = warnings.groupBy("file_seq_id").agg(F.count(F.lit(1)).alias("warning_count"))
    return totals.join(counted, "file_seq_id", "full").select(
        "file_seq_id",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total_records", "total_batches", "warning_count")),
    )


def combine_tables(*tables: DataFrame) -> DataFrame:
    """All tables of a request as one set of records; columns missing on one side read as null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out

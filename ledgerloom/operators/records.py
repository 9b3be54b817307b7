"""Rows of cells to records: one map per row when contracts differ, wide columns for one contract."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.coerce import (
    DATE_TYPES,
    DEFAULTS,
    INTEGER_TYPES,
    NUMBER_TYPES,
    TIMESTAMP_TYPES,
    CoercionOptions,
    coerce_dynamic,
    coerce_text,
    with_numeric,
)
from ..functions.dates import format_shape
from ..functions.text import basename
from .contract import type_of

TABLE_KEY = ["file_seq_id", "file_ord", "table_no"]


def records_mixed(
    cells: DataFrame,
    mapped: DataFrame,
    options: CoercionOptions = DEFAULTS,
) -> DataFrame:
    """``record MAP<STRING,STRING>`` per row; every table follows its own mapping, in one plan.

    Short rows read as null, surplus cells are ignored, and when two source columns end up under one name
    the later cell wins. ``mapped`` may bring a date format of each table in ``custom_format``, which is tried before the
    others: any number of formats make one plan. Cells of sheets may bring their types in ``cell_types``; a NaN there
    counts as missing.
    """
    typed, own_format = "cell_types" in cells.columns, "custom_format" in mapped.columns
    # the winning source column per target: the last one of that name
    winners = F.filter(
        F.filter("mapping", lambda m: m["keep"]),
        lambda m: ~F.exists("mapping", lambda o: (o["target"] == m["target"]) & (o["pos"] > m["pos"])),
    )
    carried = ["types", *([format_shape(F.col("custom_format")).alias("__format")] if own_format else [])]
    side = mapped.select(*TABLE_KEY, *carried, winners.alias("mapping"))
    rows = cells.join(side, TABLE_KEY, "inner")

    def value(m) -> Column:
        cell = F.get("cells", m["pos"])
        own = F.get("cell_types", m["pos"]) if typed else None
        if typed:
            cell = F.when((own != "number") | (F.lower(cell) != "nan"), cell)
        return coerce_dynamic(cell, m["type"], options, F.col("__format") if own_format else None, own)

    entries = F.transform("mapping", lambda m: F.struct(m["target"].alias("key"), value(m).alias("value")))
    return rows.withColumn("record", F.map_from_entries(entries)).drop("mapping", "cells", "cell_types", "__format")


def records_wide(
    cells: DataFrame,
    mapping: list,
    options: CoercionOptions = DEFAULTS,
    custom_format: str | None = None,
    keep_columns: tuple[str, ...] = ("file_seq_id", "file_ord", "table_no", "src_row"),
) -> DataFrame:
    """One column per target for tables that share one contract.

    ``mapping`` is the mapping of one table (as read from :func:`..contract.map_headers`). Numeric columns
    are spread over fused projections, so that the whole select stays in generated code.
    """
    chosen = {}
    for m in mapping:
        if m["keep"]:
            chosen[m["target"]] = m  # later cell wins
    out = cells.select(
        *keep_columns, *(F.get("cells", F.lit(m["pos"])).alias(f"__raw_{t}") for t, m in chosen.items())
    )
    for target, m in chosen.items():
        if m["type"] in NUMBER_TYPES + INTEGER_TYPES:
            out = with_numeric(out, f"__raw_{target}", target, options, integer=m["type"] in INTEGER_TYPES)
        else:
            fmt = custom_format if m["type"] in DATE_TYPES + TIMESTAMP_TYPES else None
            out = out.withColumn(target, coerce_text(F.col(f"__raw_{target}"), m["type"], options, fmt))
    return out.select(*keep_columns, *chosen)


def fill_system_columns(rows: DataFrame, record: str = "record", doc: str | None = None) -> DataFrame:
    """Fill system fields a record lacks: only those its type table names, only where empty.

    Needs columns ``types, file_seq_id, path, source_name, run_id, process_date`` (run id and process date
    are inputs, so a retry gives the same record). Document values ``customN`` go to ``custom_field_N``.
    """
    fills = {
        "file_seq_id": F.col("file_seq_id"),
        "bloc_recon_file_name": basename(F.col("path")),
        "sourcetype": F.col("source_name"),
        "batch_id": F.col("run_id"),
        "process_date": F.col("process_date"),
    }
    candidates = F.array(
        *(F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in fills.items())
    )
    if doc:
        pattern = r"^custom(\d+)$"
        customs = F.transform(
            F.filter(F.map_entries(F.col(doc)), lambda e: e["key"].rlike(pattern)),
            lambda e: F.struct(
                F.regexp_replace(e["key"], pattern, "custom_field_$1").alias("key"), e["value"].alias("value")
            ),
        )
        candidates = F.concat(candidates, F.coalesce(customs, F.array().cast("array<struct<key:string,value:string>>")))
    have = F.col(record)
    wanted = F.filter(
        candidates,
        lambda e: type_of(F.col("types"), e["key"]).isNotNull()
        & (F.coalesce(have[e["key"]], F.lit("")) == "")
        & (F.coalesce(e["value"], F.lit("")) != ""),
    )
    kept = F.map_filter(have, lambda k, _: ~F.exists("__fill", lambda e: e["key"] == k))
    return (
        rows.withColumn("__fill", wanted)
        .withColumn(record, F.map_concat(kept, F.map_from_entries("__fill")))
        .drop("__fill")
    )


def apply_field_map(df: DataFrame, field_map: dict[str, str], include_raw: bool = True) -> DataFrame:
    """Premapped records: target column <- parsed field, then ``record_type`` and the whole record as ``raw``."""
    have = set(df.columns)
    columns = [
        (F.col(source) if source in have else F.lit(None).cast("string")).alias(target)
        for target, source in field_map.items()
    ]
    raw = [F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("_raw")] if include_raw else []
    return df.select(*columns, "record_type", *raw)

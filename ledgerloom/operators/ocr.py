"""OCR block graphs: cell text, table grids with spans, and form key-values.

``ocr_blocks(file_id, block_ord, Id, BlockType, Text, Page, Relationships ARRAY<STRUCT<Type, Ids>>, EntityTypes,
SelectionStatus, RowIndex, ColumnIndex, RowSpan, ColumnSpan)``. Relationships are exploded into an edge table
and resolved by equi-joins on ``(file_id, Id)``, which spread over blocks, not over files.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import clean


def edges(blocks: DataFrame, kind: str) -> DataFrame:
    """``(file_id, parent, child, ord)`` of one relationship type, in the order listed."""
    rels = blocks.select(
        "file_id", F.col("Id").alias("parent"), F.posexplode("Relationships").alias("rel_ord", "rel")
    ).filter(F.col("rel.Type") == kind)
    return rels.select("file_id", "parent", "rel_ord", F.posexplode("rel.Ids").alias("id_ord", "child"))


def block_text(blocks: DataFrame) -> DataFrame:
    """``(file_id, Id, text)``: words and selected boxes (``X``) below a block, in order."""
    leaves = blocks.filter(
        (F.col("BlockType") == "WORD")
        | ((F.col("BlockType") == "SELECTION_ELEMENT") & (F.col("SelectionStatus") == "SELECTED"))
    ).select(
        "file_id",
        F.col("Id").alias("child"),
        F.when(F.col("BlockType") == "WORD", F.col("Text")).otherwise("X").alias("t"),
    )
    return (
        edges(blocks, "CHILD")
        .join(leaves, ["file_id", "child"])
        .groupBy("file_id", F.col("parent").alias("Id"))
        .agg(
            clean(
                F.array_join(
                    F.transform(
                        F.sort_array(F.collect_list(F.struct("rel_ord", "id_ord", "t"))), lambda w: w["t"]
                    ),
                    " ",
                )
            ).alias("text")
        )
    )


def grid_rows(blocks: DataFrame) -> DataFrame:
    """``fragments`` rows of every OCR table: spans replicated, holes empty, a later cell wins an overlap."""
    cells = blocks.filter(F.col("BlockType") == "CELL").select(
        "file_id", F.col("Id").alias("child"), "RowIndex", "ColumnIndex",
        F.coalesce("RowSpan", F.lit(1)).alias("rs"), F.coalesce("ColumnSpan", F.lit(1)).alias("cs"),
    )
    # a table's cells are listed on its own block; blocks of one Id count as one table, in each of their places
    place = F.struct(F.coalesce("Page", F.lit(1)).alias("page"), "block_ord")
    tables = blocks.filter((F.col("BlockType") == "TABLE") & F.col("file_id").isNotNull() & F.col("Id").isNotNull()).groupBy(
        "file_id", F.col("Id").alias("parent")).agg(F.collect_list(place).alias("places"), F.collect_list("Relationships").alias("lists"))
    listed = (
        tables.select("file_id", "parent", F.explode("places").alias("place"), "lists")
        .select("file_id", "parent", "place.*", F.explode("lists").alias("rels"))
        .select("file_id", "parent", "page", "block_ord", F.posexplode("rels").alias("rel_ord", "rel"))
        .filter(F.col("rel.Type") == "CHILD")
        .select("file_id", "parent", "page", "block_ord", "rel_ord", F.posexplode("rel.Ids").alias("id_ord", "child"))
    )
    texts = block_text(blocks.filter(F.col("BlockType").isin("CELL", "WORD", "SELECTION_ELEMENT")))
    placed = (
        listed.join(cells, ["file_id", "child"])
        .join(texts.withColumnRenamed("Id", "child"), ["file_id", "child"], "left")
        .select(
            "file_id", "parent", "page", "block_ord", "rel_ord", "id_ord", "ColumnIndex", "cs",
            F.coalesce("text", F.lit("")).alias("text"),
            F.explode(F.sequence(F.col("RowIndex"), F.col("RowIndex") + F.col("rs") - 1)).alias("row_no"),
        )
        .withColumn("col_no", F.explode(F.sequence(F.col("ColumnIndex"), F.col("ColumnIndex") + F.col("cs") - 1)))
        .repartition("file_id", "parent")  # all steps below are within a table of a page
    )
    unique = placed.groupBy("file_id", "page", "block_ord", "parent", "row_no", "col_no").agg(
        F.max_by("text", F.struct("rel_ord", "id_ord")).alias("text")
    )
    rows = unique.groupBy("file_id", "parent", "row_no").agg(
        F.map_from_entries(F.collect_list(F.struct("col_no", "text"))).alias("m"), F.max("col_no").alias("nc"),
        F.first("page").alias("page"), F.first("block_ord").alias("table_on_page"),
    )
    table = Window.partitionBy("file_id", "parent")
    whole = table.orderBy("row_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns(
        {
            "nc": F.max("nc").over(whole), "page": F.first("page").over(whole), "table_on_page": F.first("table_on_page").over(whole),
            "before": F.coalesce(F.lag("row_no").over(table.orderBy("row_no")), F.lit(0)),
        }
    ).filter("row_no > 0")
    # a row also gives the empty rows between the one before and itself
    every = rows.withColumn("at", F.explode(F.sequence(F.greatest("before", F.lit(0)) + 1, F.col("row_no"))))
    every = every.withColumn("m", F.when(F.col("at") == F.col("row_no"), F.col("m")))
    return every.select(
        "file_id", "page", "table_on_page", F.lit(0).alias("strategy_ord"), F.col("at").alias("row_no"),
        F.transform(
            F.sequence(F.lit(1), F.col("nc")),
            lambda i: F.coalesce(F.element_at("m", i), F.lit("")),
        ).alias("cells"),
    )


def form_key_values(blocks: DataFrame) -> DataFrame:
    """``(file_id, field, value)`` of form fields: ``form:<key without trailing colons>``; the last one wins."""
    texts = block_text(blocks)
    keys = (
        blocks.filter(
            (F.col("BlockType") == "KEY_VALUE_SET") & F.array_contains("EntityTypes", "KEY")
        )
        .select("file_id", "Id", "block_ord")
        .join(texts.withColumnRenamed("text", "key"), ["file_id", "Id"])
        .filter(F.col("key") != "")
    )
    values = (
        edges(blocks, "VALUE")
        .join(texts.withColumnRenamed("Id", "child"), ["file_id", "child"], "left")
        .groupBy("file_id", F.col("parent").alias("Id"), "rel_ord")
        .agg(
            F.array_join(
                F.transform(
                    F.sort_array(F.collect_list(F.struct("id_ord", F.coalesce("text", F.lit("")).alias("t")))),
                    lambda v: v["t"],
                ),
                " ",
            ).alias("value")
        )
    )
    return (
        keys.join(values, ["file_id", "Id"])
        .withColumn("field", F.concat(F.lit("form:"), F.rtrim("key", F.lit(":"))))
        .groupBy("file_id", "field")
        .agg(F.max_by("value", F.struct("block_ord", "rel_ord")).alias("value"))
    )

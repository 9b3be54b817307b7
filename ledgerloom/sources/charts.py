"""Chart payloads to rows, and chart filters as DataFrame filters."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import write_once

PAYLOAD = "struct<result:array<struct<data:array<map<string,string>>,colnames:array<string>,rowcount:bigint>>>"


def chart_tables(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tables, cells) of ``payloads(chart_id, body)``: one table per query result, cells in column order."""
    results = payloads.select(
        "chart_id", F.posexplode(F.from_json("body", PAYLOAD)["result"]).alias("query_index", "r")
    )
    columns = F.when(F.size(F.coalesce("r.colnames", F.array().cast("array<string>"))) > 0, F.col("r.colnames")).otherwise(
        F.coalesce(F.map_keys(F.get("r.data", F.lit(0))), F.array().cast("array<string>"))
    )
    named = results.withColumn("headers", columns)
    tables = named.select(
        "chart_id", "query_index", "headers", F.lit(1).cast("bigint").alias("first_row_no"),
        F.col("r.rowcount").alias("rowcount"),
    )
    cells = named.select(
        "chart_id", "query_index", "headers", F.posexplode("r.data").alias("i", "row")
    ).select(
        "chart_id", "query_index", (F.col("i") + 1).cast("bigint").alias("src_row"),
        F.transform("headers", lambda c: F.col("row")[c]).alias("cells"),
    )
    return tables, cells


def chart_query(table: DataFrame, filters: list[dict], row_limit: int | None = None) -> DataFrame:
    """Apply ``{col, op, val}`` filters (pushed down to the source); ``row_limit`` holds only if a request names one."""
    out = table
    for f in filters:
        c, op, val = F.col(f["col"]), f["op"].upper(), f.get("val")
        tests = {
            "==": lambda: c == val, "!=": lambda: c != val, ">": lambda: c > val, "<": lambda: c < val,
            ">=": lambda: c >= val, "<=": lambda: c <= val, "IN": lambda: c.isin(*val),
            "NOT IN": lambda: ~c.isin(*val), "LIKE": lambda: c.like(val), "ILIKE": lambda: c.ilike(val),
            "IS NULL": c.isNull, "IS NOT NULL": c.isNotNull,
        }
        out = out.filter(tests[op]())
    if row_limit is None or out.count() <= row_limit:
        return out
    return _first_rows(out, row_limit)


def _first_rows(rows: DataFrame, n: int) -> DataFrame:
    """``n`` of the rows, without sending them through one task as ``limit`` does.

    They are written with the number of their task and their place in it; one row per task tells how many its rows
    come after.
    """
    numbered = write_once(rows.withColumn("__id", F.monotonically_increasing_id()), "limited")
    task, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = numbered.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__task", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    kept = numbered.withColumns({"__task": task, "__place": place}).join(F.broadcast(before), "__task")
    return kept.filter(F.col("__before") + F.col("__place") < n).select(*rows.columns)

"""Driver queries: numbering, batches, delimited files and chart payloads."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.coerce import with_numeric
from ..operators.batches import build_batches, job_totals, number_records
from ..operators.ordered import OrderedRows
from ..session import shared_dir, write_once
from ..sources.charts import chart_query, chart_tables
from ..functions.text import local_path
from ..operators.ingest import ingest_delimited as ingest, ingest_sheets as ingest_books
from ..sources.delimited import delimiter_of, header_row_of, scan_delimited as scan
from .coercion import DIRTY_PRICE_SQL, dirty_price
from .common import money2, printed, table, text


def dirty_price_batches(spark, sf_dir):
    """Flagship: line prices as printed text -> numbers -> batches of 250 per supplier file -> totals."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("file_seq_id"), "l_orderkey", "l_linenumber", "l_partkey",
        "l_extendedprice", dirty_price().alias("raw"),
    )
    # a file's rows get their source row number from their order (large files are split, see OrderedRows)
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    rows = OrderedRows.of(lines, ["file_seq_id"], order).number("src_row").rows()
    records = with_numeric(rows, "raw", "amount").select(
        "file_seq_id", "amount", "src_row", ((F.col("src_row") - 1) / 250).cast("bigint").alias("b")
    )
    typed = F.col("amount").try_cast("decimal(18,2)")
    return records.groupBy("file_seq_id", (F.col("b") + 1).alias("batch_no")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("src_row").alias("first_row"),
        F.count(typed).alias("numbers"),
        text(F.sum(typed)).alias("total"),
    )


def _order_records(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.lit("ORDERS").alias("file_seq_id"), (F.col("o_orderkey") % 3).cast("int").alias("file_ord"),
        F.lit(0).alias("table_no"), (F.floor(F.col("o_orderkey") / 3) + 2).alias("src_row"),
        F.create_map(
            F.lit("key"), text(F.col("o_orderkey")), F.lit("total"), text(money2(F.col("o_totalprice")))
        ).alias("record"),
    )


def batch_rows(spark, sf_dir):
    """One request over three files, batches of 1,000 that run on across the files."""
    records = _order_records(spark, sf_dir)
    tables = spark.createDataFrame(
        [("ORDERS", i, 0, {"file": f"f{i}"}) for i in range(4)],
        "file_seq_id string, file_ord int, table_no int, meta map<string,string>",
    )
    batches = build_batches(records, 1000, tables=tables)
    total = F.aggregate(
        F.transform("records", lambda r: F.get_json_object(r, "$.total").cast("decimal(18,2)")),
        F.lit(0).cast("decimal(38,2)"), lambda a, x: (a + x).cast("decimal(38,2)"),
    )
    return batches.select(
        "batch_no", "record_count", "first_row", text(total).alias("total"),
        F.get_json_object(F.get("records", F.lit(0)), "$.key").alias("first_key"),
        F.get_json_object(F.element_at("records", -1), "$.key").alias("last_key"),
        F.col("meta")["file"].alias("meta_file"), F.col("meta")["batch_size"].alias("meta_size"),
    )


def batch_totals(spark, sf_dir):
    """Job totals of one request per customer: records, batches of 5, warnings."""
    o = table(spark, sf_dir, "orders")
    rows = OrderedRows.of(
        o.select(
            F.concat(F.lit("C"), text(F.col("o_custkey"))).alias("file_seq_id"), "o_orderkey",
            text(money2(F.col("o_totalprice"))).alias("record"),
        ),
        ["file_seq_id"], ["o_orderkey"],
    ).number("src_row").rows().withColumns({"file_ord": F.lit(0), "table_no": F.lit(0)})
    warnings = o.filter("o_orderstatus = 'P'").select(
        F.concat(F.lit("C"), text(F.col("o_custkey"))).alias("file_seq_id"), F.lit("pending").alias("detail")
    )
    return job_totals(build_batches(rows, 5), warnings)


def number_gaps(spark, sf_dir):
    """Record numbers when source row numbers have gaps."""
    o = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), F.col("o_orderstatus")).alias("file_seq_id"),
        (F.col("o_custkey") % 2).cast("int").alias("file_ord"), F.lit(0).alias("table_no"),
        (F.col("o_orderkey") * 5).alias("src_row"), "o_orderkey",
    )
    return number_records(o).select("file_seq_id", "o_orderkey", "n")


def _delimited_files(spark, sf_dir):
    """Orders written as one delimited file per priority, header in the first line."""
    o = table(spark, sf_dir, "orders")
    folder = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    lines = o.select(
        F.substring("o_orderpriority", 1, 1).alias("f"), F.col("o_orderkey").alias("o"),
        F.concat_ws(
            ",", text(F.col("o_orderkey")), F.concat(F.lit('"'), printed(F.col("o_totalprice")), F.lit('"')),
            F.date_format("o_orderdate", "dd/MM/yyyy"), F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no"),
            F.when(F.col("o_orderkey") % 7 == 0, F.lit('"two\nlines"')).otherwise("one"), F.lit(""),
        ).alias("value"),
    )
    heads = o.select(F.substring("o_orderpriority", 1, 1).alias("f")).distinct().select(
        "f", F.lit(-1).cast("bigint").alias("o"), F.lit("Order Key,Total Price,Order Date,Is Done,Remark,Source Type").alias("value"))
    all_lines = lines.unionByName(heads).repartition("f").sortWithinPartitions("f", "o")
    all_lines.select("f", "value").write.partitionBy("f").text(folder)
    return folder, write_once(spark.read.text(folder).select(F.col("_metadata.file_path").alias("path"), "f").distinct(), "written")


def ingest_delimited(spark, sf_dir):
    """Requests of several contracts to stored batches: one row per record, with its batch, meta and typed fields."""
    folder, files = _delimited_files(spark, sf_dir)
    files = files.withColumn("f", F.col("f").cast("int"))
    listing = files.select(local_path(F.col("path")).alias("path"), F.lit("2024-01-01").cast("timestamp").alias("modificationTime"), F.lit(1).cast("bigint").alias("length"))
    seq = F.concat(F.lit("R"), text(F.col("f")))
    requests = files.select(
        seq.alias("file_seq_id"), local_path(F.col("path")).alias("path"), F.lit(None).cast("string").alias("file_name"),
        F.lit(None).cast("string").alias("sub_path"), F.lit(None).cast("string").alias("details_delimiter"), F.lit(",").alias("delimiter"),
        F.lit(1).alias("headers_row"), F.lit("csv").alias("format"), F.lit("desk").alias("source_name"), F.lit("run").alias("run_id"),
        F.lit("2024-05-06").alias("process_date"), (F.col("f") % 2 == 0).alias("enrich_flow"), F.lit("rc").alias("recon_id"),
        F.when(F.col("f") < 3, "ev").alias("event_id"),
    )
    details = [("orderkey", "bigint"), ("totalprice", "numeric"), ("orderdate", "date"), ("isdone", "boolean"), ("sourcetype", "varchar"), ("process_date", "varchar")]
    contracts = files.select(
        seq.alias("file_seq_id"),
        F.array(*(F.struct(F.lit(n).alias("columnName"), F.lit(t).alias("columnType")) for n, t in details)).alias("column_details"),
        F.array().cast("array<struct<source_column:string,source_display_column:string,field_type:string>>").alias("positions"),
        F.lit(True).alias("fetch_by_name"), F.lit(False).alias("by_column_number"), F.array().cast("array<string>").alias("include_exclude"), F.lit(False).alias("is_exclude"),
    )
    done = ingest(spark, requests, contracts, listing, pick="all", batch_size=100)
    rows = done.batches.select(
        "file_seq_id", "batch_no", "record_count", "first_row", F.posexplode("records").alias("i", "r"), "meta")
    return rows.join(done.totals, "file_seq_id").select(
        "file_seq_id", "batch_no", "record_count", "first_row", "i", "total_records", "total_batches", "warning_count",
        F.get_json_object("r", "$._row").cast("bigint").alias("src_row"), F.regexp_replace("r", r',"_row":\d+}$', "}").alias("record"),
        F.col("meta")["format"].alias("format"), F.col("meta")["reconId"].alias("recon_id"), F.col("meta")["eventId"].alias("event_id"),
        F.col("meta")["batch_no"].alias("meta_batch_no"),
    )


def _order_books(spark, sf_dir):
    """Cells of one workbook per priority and one sheet per status: a title, a header, a row per order and blank rows between."""
    o = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("/books/b"), F.substring("o_orderpriority", 1, 1), F.lit(".xlsx")).alias("path"), "o_orderstatus", "o_orderkey", "o_totalprice", "o_orderdate", "o_custkey")
    sheet = F.col("o_orderstatus").alias("sheet")
    idx = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("sheet_idx")

    def cell(value, kind):
        return F.struct(value.alias("value"), F.lit(kind).alias("value_type"))

    key = F.col("o_orderkey")
    values = F.array(
        cell(F.concat(text(key), F.lit(".0")), "number"), cell(printed(F.col("o_totalprice")), "number"),
        cell(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), "date"), cell(F.concat(text(F.col("o_custkey")), F.lit(".0")), "number"),
        cell(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), "date"), cell(F.when(key % 5 == 0, "NaN").otherwise(" n "), "number"), cell(F.lit("over"), "string"))
    blank = F.transform(values, lambda c: F.struct(F.lit("").alias("value"), c["value_type"].alias("value_type")))
    data = o.select("path", sheet, idx, (key + 3).cast("int").alias("row"), F.when(key % 11 == 0, blank).otherwise(values).alias("v"))
    names = F.array(*(cell(F.lit(n), "string") for n in ("Order Key", "Total Price", "Order Date", "Customer", "Placed", "Remark", "")))
    books = o.select("path", sheet, idx).distinct()
    heads = books.select("path", "sheet", "sheet_idx", F.lit(2).alias("row"), names.alias("v"))
    titles = books.select("path", "sheet", "sheet_idx", F.lit(1).alias("row"), F.array(cell(F.lit("Orders"), "string")).alias("v"))
    return data.unionByName(heads).unionByName(titles).select("path", "sheet", "sheet_idx", "row", F.posexplode("v").alias("col", "c")).select(
        "path", "sheet", "sheet_idx", "row", (F.col("col") + 1).alias("col"), "c.value", "c.value_type")


def ingest_sheets(spark, sf_dir):
    """Requests for sheets of workbooks to stored batches: one row per record, with its batch, meta, typed fields and warnings."""
    cells = write_once(_order_books(spark, sf_dir), "books")
    paths = cells.select("path").distinct()
    listing = paths.unionByName(spark.sql("select '/books/empty.xlsx' path union all select '/books/b1.csv'")).select(
        "path", F.lit("2024-01-01").cast("timestamp").alias("modificationTime"), F.lit(1).cast("bigint").alias("length"))
    f = F.substring("path", 9, 1).try_cast("int")
    seq = F.regexp_replace("path", "^/books/b?", "B").alias("file_seq_id")
    none = F.lit(None).cast("string")
    wanted = F.when(f % 3 == 1, F.array(F.lit("1"), F.lit("Z9"))).when(f % 3 == 2, F.array(F.lit("P"), F.lit(" "), F.lit("F")))
    requests = listing.select(
        seq, "path", none.alias("file_name"), none.alias("sub_path"), wanted.alias("sheet_identifiers"), F.lit(2).alias("headers_row"), none.alias("format"),
        F.lit("desk").alias("source_name"), F.lit("run").alias("run_id"), F.lit("2024-05-06").alias("process_date"), F.lit(False).alias("enrich_flow"),
        F.lit("rc").alias("recon_id"), none.alias("event_id"))
    details = [("orderkey", "bigint"), ("totalprice", "numeric"), ("orderdate", "date"), ("customer", "varchar"), ("placed", "varchar"), ("remark", "varchar")]
    contracts = listing.select(
        seq, F.array(*(F.struct(F.lit(n).alias("columnName"), F.lit(t).alias("columnType")) for n, t in details)).alias("column_details"),
        F.array().cast("array<struct<source_column:string,source_display_column:string,field_type:string>>").alias("positions"),
        F.lit(True).alias("fetch_by_name"), F.lit(False).alias("by_column_number"), F.array().cast("array<string>").alias("include_exclude"), F.lit(False).alias("is_exclude"))
    done = ingest_books(requests, contracts, listing, cells, pick="all", batch_size=100)
    rows = done.batches.select("file_seq_id", "batch_no", "record_count", F.posexplode("records").alias("i", "r"), "meta")
    rows = rows.join(done.totals, "file_seq_id").select(
        "file_seq_id", "batch_no", "record_count", "i", "total_records", "total_batches", "warning_count",
        F.get_json_object("r", "$._row").cast("bigint").alias("src_row"), F.regexp_replace("r", r',"_row":\d+}$', "}").alias("record"),
        F.col("meta")["sheet"].alias("sheet"), F.col("meta")["engine"].alias("engine"))
    said = done.warnings.select("file_seq_id", F.concat_ws(": ", "kind", "detail").alias("record")).unionByName(
        done.rejected.select("file_seq_id", F.concat(F.lit("rejected: "), "error").alias("record")))
    return rows.unionByName(said, allowMissingColumns=True)


def scan_delimited(spark, sf_dir):
    """Customers written as delimited files with a title line, a header and blank lines, read back."""
    c = table(spark, sf_dir, "customer")
    folder = f"{shared_dir(spark)}/scan-{uuid.uuid4().hex}"
    nation = text(F.col("c_nationkey"))
    sep = F.when(F.col("c_nationkey") % 3 == 0, ";").when(F.col("c_nationkey") % 3 == 1, "\t").otherwise(",")
    body = c.select(
        nation.alias("f"), (F.col("c_custkey") * 2 + 10).alias("o"),
        F.concat(
            text(F.col("c_custkey")), sep, F.col("c_name"), sep,
            F.lit('"'), F.replace("c_mktsegment", F.lit("I"), F.lit('""I,;')), F.lit('"'), sep,
            F.lit('"'), printed(F.col("c_acctbal")), F.lit('"'),
        ).alias("value"),
    )
    blank = c.filter("c_custkey % 10 = 3").select(
        nation.alias("f"), (F.col("c_custkey") * 2 + 11).alias("o"), F.concat(sep, F.lit("  "), sep).alias("value")
    )
    heads = c.select("c_nationkey").distinct().select(
        nation.alias("f"),
        F.explode(
            F.array(
                F.struct(F.lit(1).cast("bigint").alias("o"), F.lit("Customer list").alias("value")),
                F.struct(F.lit(2).cast("bigint").alias("o"), F.lit("").alias("value")),
                F.struct(
                    F.lit(3).cast("bigint").alias("o"),
                    F.concat(F.lit("Cust Key"), sep, F.lit("Name"), sep, F.lit("Segment"), sep, F.lit("Balance")).alias("value"),
                ),
            )
        ).alias("x"),
    ).select("f", "x.o", "x.value")
    lines = body.unionByName(blank).unionByName(heads)
    lines.repartition("f").sortWithinPartitions("f", "o").select("f", "value").write.partitionBy("f").text(folder)
    files = spark.read.text(folder).select(F.col("_metadata.file_path").alias("path"), "f").distinct()
    given = F.when(F.col("f") % 3 == 0, ";").when(F.col("f") % 3 == 1, "tab")
    requests = files.select(
        text(F.col("f")).alias("file_seq_id"), F.lit(0).alias("file_ord"), "path",
        delimiter_of(given, F.lit(None).cast("string")).alias("delimiter"),
        header_row_of(F.lit(3)).alias("headers_row"),
    )
    tables, cells = scan(spark, requests, folder)
    named = cells.join(tables.select("file_seq_id", "headers"), "file_seq_id")
    return named.select(
        "file_seq_id", "src_row", F.array_join("headers", "|").alias("headers"),
        *(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(("key", "name", "segment", "balance"))),
    )


def chart_rows(spark, sf_dir):
    """Orders packed as chart payloads (50 order keys each) with two queries, unpacked again."""
    o = chart_query(
        table(spark, sf_dir, "orders"),
        [{"col": "o_orderstatus", "op": "IN", "val": ["O", "F"]}, {"col": "o_totalprice", "op": ">", "val": 1000}],
        row_limit=2_000_000_000,
    )
    row = F.create_map(
        F.lit("key"), text(F.col("o_orderkey")), F.lit("status"), F.col("o_orderstatus"),
        F.lit("total"), text(money2(F.col("o_totalprice"))),
    )
    chart = F.floor(F.col("o_orderkey") / 50).alias("chart_id")
    packed = (
        o.groupBy(chart)
        .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", F.to_json(row).alias("j")))).alias("rows"))
        .select(
            "chart_id",
            F.concat(
                F.lit('{"result":[{"data":['),
                F.array_join(F.transform("rows", lambda r: r["j"]), ","),
                F.lit('],"colnames":["total","key","absent"],"rowcount":'), text(F.size("rows")),
                F.lit('},{"data":['), F.get("rows", F.lit(0))["j"], F.lit('],"rowcount":1}]}'),
            ).alias("body"),
        )
    )
    tables, cells = chart_tables(packed)
    return cells.join(
        tables.select("chart_id", "query_index", "rowcount", F.array_join("headers", "|").alias("headers")),
        ["chart_id", "query_index"],
    ).select(
        "chart_id", "query_index", "src_row", "rowcount", "headers",
        F.array_join("cells", "|", "~").alias("cells"),
    )


QUERIES = {
    "dirty_price_batches": dirty_price_batches,
    "batch_rows": batch_rows,
    "batch_totals": batch_totals,
    "number_gaps": number_gaps,
    "scan_delimited": scan_delimited,
    "ingest_delimited": ingest_delimited,
    "ingest_sheets": ingest_sheets,
    "chart_rows": chart_rows,
}

ORACLE = {
    "dirty_price_batches": f"""
        SELECT l_suppkey AS file_seq_id, (rn - 1) // 250 + 1 AS batch_no, count(*) AS record_count,
               min(rn) AS first_row, count(amount) AS numbers, CAST(sum(amount) AS VARCHAR) AS total
        FROM (SELECT l_suppkey, TRY_CAST({DIRTY_PRICE_SQL} AS DECIMAL(18, 2)) AS amount,
                     row_number() OVER (PARTITION BY l_suppkey
                         ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS rn
              FROM lineitem)
        GROUP BY 1, 2""",
    "batch_rows": """
        WITH n AS (SELECT *, row_number() OVER (ORDER BY o_orderkey % 3, o_orderkey) - 1 AS n FROM orders)
        SELECT CAST(n // 1000 + 1 AS INTEGER) AS batch_no, CAST(count(*) AS INTEGER) AS record_count,
               arg_min(o_orderkey // 3 + 2, n) AS first_row,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS VARCHAR) AS total,
               CAST(arg_min(o_orderkey, n) AS VARCHAR) AS first_key,
               CAST(arg_max(o_orderkey, n) AS VARCHAR) AS last_key,
               CASE WHEN count(*) = 1000 THEN 'f' || arg_max(o_orderkey % 3, n) ELSE 'f3' END AS meta_file,
               '1000' AS meta_size
        FROM n GROUP BY 1""",
    "batch_totals": """
        SELECT 'C' || o_custkey AS file_seq_id, count(*) AS total_records,
               CAST(ceil(count(*) / 5) AS INTEGER) AS total_batches,
               count(*) FILTER (o_orderstatus = 'P') AS warning_count
        FROM orders GROUP BY o_custkey""",
    "number_gaps": """
        SELECT 'S' || o_orderstatus AS file_seq_id, o_orderkey,
               row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey % 2, o_orderkey) - 1 AS n
        FROM orders""",
    "ingest_delimited": """
        WITH o AS (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS f,
                          row_number() OVER (PARTITION BY substr(o_orderpriority, 1, 1) ORDER BY o_orderkey) AS k,
                          count(*) OVER (PARTITION BY substr(o_orderpriority, 1, 1)) AS n FROM orders)
        SELECT 'R' || f AS file_seq_id, CAST((k - 1) // 100 + 1 AS INTEGER) AS batch_no,
               CAST(least(100, n - (k - 1) // 100 * 100) AS INTEGER) AS record_count, (k - 1) // 100 * 100 + 2 AS first_row,
               CAST((k - 1) % 100 AS INTEGER) AS i, n AS total_records, CAST((n - 1) // 100 + 1 AS INTEGER) AS total_batches,
               CAST(1 AS BIGINT) AS warning_count, k + 1 AS src_row,
               '{"orderkey":' || o_orderkey || ',"totalprice":"' || CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR)
               || '","orderdate":"' || strftime(o_orderdate, '%Y-%m-%d') || '","isdone":' || (o_orderstatus = 'F')
               || ',"remark":"' || CASE WHEN o_orderkey % 7 = 0 THEN 'two\\nlines' ELSE 'one' END || '",'
               || CASE WHEN f % 2 = 0 THEN '"sourcetype":"desk","process_date":"2024-05-06"' ELSE '"sourcetype":""' END || '}' AS record,
               'csv' AS format, 'rc' AS recon_id, CASE WHEN f < 3 THEN 'ev' END AS event_id,
               CAST((k - 1) // 100 + 1 AS VARCHAR) AS meta_batch_no
        FROM o""",
    "ingest_sheets": """
        WITH a AS (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS f FROM orders),
        w AS (SELECT f, o_orderkey, o_totalprice, o_orderdate, o_custkey, o_orderstatus AS sheet,
                     CASE f % 3 WHEN 0 THEN CASE WHEN o_orderstatus = (SELECT min(o_orderstatus) FROM a x WHERE x.f = a.f) THEN 0 END
                                WHEN 1 THEN CASE WHEN o_orderstatus = 'O' THEN 0 END
                                ELSE CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 END END AS t
              FROM a),
        k AS (SELECT *, row_number() OVER (PARTITION BY f, t ORDER BY o_orderkey) AS i, row_number() OVER (PARTITION BY f ORDER BY t, o_orderkey) AS n,
                     count(*) OVER (PARTITION BY f) AS total
              FROM w WHERE t IS NOT NULL AND o_orderkey % 11 > 0),
        m AS (SELECT *, (n - 1) // 100 + 1 AS b, least(100, total - (n - 1) // 100 * 100) AS c FROM k)
        SELECT 'B' || f || '.xlsx' AS file_seq_id, CAST(b AS INTEGER) AS batch_no, CAST(c AS INTEGER) AS record_count, CAST((n - 1) % 100 AS INTEGER) AS i,
               total AS total_records, CAST((total - 1) // 100 + 1 AS INTEGER) AS total_batches, CAST(CASE WHEN f % 3 = 1 THEN 1 ELSE 0 END AS BIGINT) AS warning_count,
               i + 2 AS src_row,
               '{"orderkey":' || o_orderkey || ',"totalprice":"' || CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) || '","orderdate":"' || strftime(o_orderdate, '%Y-%m-%d')
               || '","customer":"' || o_custkey || '","placed":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","remark":'
               || CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE '"n"' END || '}' AS record,
               CASE WHEN c = 100 THEN last(sheet) OVER (PARTITION BY f, b ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
                    ELSE last(sheet) OVER (PARTITION BY f ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS sheet,
               'spark-sheets' AS engine
        FROM m
        UNION ALL
        SELECT DISTINCT 'B' || f || '.xlsx', NULL, NULL, NULL, NULL, NULL, NULL, NULL,
               'missing_sheet: no sheet ''Z9''; the workbook has ' || (SELECT string_agg(DISTINCT o_orderstatus, ', ' ORDER BY o_orderstatus) FROM a x WHERE x.f = a.f), NULL, NULL
        FROM a WHERE f % 3 = 1
        UNION ALL SELECT 'Bempty.xlsx', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'rejected: workbook without cells: /books/empty.xlsx', NULL, NULL
        UNION ALL SELECT 'B1.csv', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'rejected: no workbook: /books/b1.csv', NULL, NULL""",
    "scan_delimited": """
        SELECT CAST(c_nationkey AS VARCHAR) AS file_seq_id,
               3 + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS src_row,
               'Cust Key|Name|Segment|Balance' AS headers, CAST(c_custkey AS VARCHAR) AS key, c_name AS name,
               replace(c_mktsegment, 'I', '"I,;') AS segment, format('{:,.2f}', c_acctbal) AS balance
        FROM customer""",
    "chart_rows": """
        WITH o AS (SELECT o_orderkey // 50 AS chart_id, o_orderkey, o_orderstatus AS s,
                          CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS t
                   FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_totalprice > 1000),
             r AS (SELECT *, row_number() OVER (PARTITION BY chart_id ORDER BY o_orderkey) AS rn,
                          count(*) OVER (PARTITION BY chart_id) AS n FROM o)
        SELECT chart_id, 0 AS query_index, rn AS src_row, n AS rowcount, 'total|key|absent' AS headers,
               t || '|' || o_orderkey || '|~' AS cells FROM r
        UNION ALL
        SELECT chart_id, 1, 1, 1, 'key|status|total', o_orderkey || '|' || s || '|' || t FROM r WHERE rn = 1""",
}

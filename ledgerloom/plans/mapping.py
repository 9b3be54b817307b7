"""Driver queries: contract mapping, projection, enrichment and record rendering."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import generated_id
from ..operators.batches import combine_tables, with_batch_no
from ..operators.contract import (
    DETAILS_TYPE,
    contract_drift as drift_of,
    map_headers as map_headers_of,
    resolve_options as resolve_options_of,
    type_of,
    unmapped_headers as unmapped_of,
    with_lookup,
)
from ..operators.records import apply_field_map as project_fields
from ..operators.records import fill_system_columns, records_mixed
from ..sinks.tables import record_json as render
from ..sources.profiles import TableProfile
from .common import money2, table, text


def _details(*pairs):
    return F.array(
        *(F.struct(F.lit(n).alias("columnName"), F.lit(t).alias("columnType")) for n, t in pairs)
    )


def _position(source, shown, kind):
    return F.struct(
        source.alias("source_column"), shown.alias("source_display_column"), kind.alias("field_type")
    )


def _part_tables(spark, sf_dir):
    """One table per part, one contract per brand."""
    part = table(spark, sf_dir, "part")
    tables = part.select(
        F.col("p_brand").alias("file_seq_id"), F.lit(0).alias("file_ord"), F.col("p_partkey").alias("table_no"),
        F.array(
            F.lit("Sub Account"), F.concat("p_type", F.lit(" Price")), F.col("p_brand"), F.col("p_brand"),
            F.lit(""), F.lit(" P-Name "),
        ).alias("headers"),
    )
    contracts = part.select(F.col("p_brand").alias("file_seq_id")).distinct().select(
        "file_seq_id",
        _details(
            ("subaccount", "varchar"), ("economyprice", "Numeric"), ("large_price", "double"), ("p_name", "VARCHAR")
        ).alias("column_details"),
        F.array(
            _position(F.lit("account"), F.lit("Sub Account"), F.lit("String")),
            _position(F.lit("standard_price"), F.lit("Standard  Price"), F.lit("Numeric")),
            _position(F.lit("brand_col"), F.col("file_seq_id"), F.lit("")),
        ).alias("positions"),
        F.lit(False).alias("by_column_number"),
        F.array(F.lit("col_5")).alias("include_exclude"),
        F.lit(True).alias("is_exclude"),
    )
    return tables, contracts


def _mapping_rows(mapped):
    # the outer form, as for the other Spark infers a filter that maps every header a second time
    return mapped.select("table_no", F.explode_outer("mapping").alias("m")).filter(F.col("m").isNotNull()).select(
        F.col("table_no").alias("p_partkey"), "m.pos", "m.header", "m.target", "m.type", "m.keep", "m.mapped"
    )


def map_headers(spark, sf_dir):
    tables, contracts = _part_tables(spark, sf_dir)
    return _mapping_rows(map_headers_of(tables, contracts.withColumn("fetch_by_name", F.lit(True))))


def map_headers_position(spark, sf_dir):
    tables, contracts = _part_tables(spark, sf_dir)
    return _mapping_rows(map_headers_of(tables, contracts.withColumn("fetch_by_name", F.lit(False))))


def unmapped_headers(spark, sf_dir):
    tables, contracts = _part_tables(spark, sf_dir)
    return unmapped_of(map_headers_of(tables, contracts.withColumn("fetch_by_name", F.lit(True))))


def contract_drift(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    declared = nation.groupBy(F.col("n_regionkey").alias("r")).agg(
        F.collect_list(
            F.struct(F.col("n_name").alias("columnName"), F.lit("varchar").alias("columnType"))
        ).alias("column_details")
    )
    shown = (
        nation.withColumn("r", F.explode(F.array(F.col("n_nationkey") % 5, (F.col("n_nationkey") + 4) % 5)))
        .groupBy("r")
        .agg(F.collect_list(_position(F.col("n_name"), F.col("n_name"), F.lit("String"))).alias("positions"))
    )
    contracts = (
        region.withColumnRenamed("r_regionkey", "r").join(declared, "r").join(shown, "r")
        .withColumn("file_seq_id", F.col("r_name"))
    )
    return drift_of(contracts)


def project_include_exclude(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    group = (F.col("c_nationkey") % 3).cast("int")
    full = F.array(
        text(F.col("c_custkey")), F.col("c_name"), F.col("c_mktsegment"), text(money2(F.col("c_acctbal"))), F.lit("extra")
    )
    cells = c.select(
        F.concat(F.lit("G"), text(group)).alias("file_seq_id"), F.lit(0).alias("file_ord"), F.lit(0).alias("table_no"),
        F.col("c_custkey").alias("src_row"),
        F.when(F.col("c_custkey") % 7 == 0, F.slice(full, 1, 2)).otherwise(full).alias("cells"),
    )
    tables = cells.select("file_seq_id", "file_ord", "table_no").distinct().withColumn(
        "headers", F.array(*(F.lit(h) for h in ("Cust Key", "C_NAME", "c mktsegment", "C-AcctBal")))
    )
    contracts = tables.select("file_seq_id").distinct().select(
        "file_seq_id",
        _details(("custkey", "bigint"), ("c_name", "varchar"), ("c_mktsegment", "varchar"), ("c_acctbal", "numeric")).alias(
            "column_details"
        ),
        F.lit(None).cast(
            "array<struct<source_column:string,source_display_column:string,field_type:string>>"
        ).alias("positions"),
        F.lit(True).alias("fetch_by_name"), F.lit(False).alias("by_column_number"),
        F.when(F.col("file_seq_id") == "G0", F.array(F.lit("c_name"), F.lit("c_acctbal")))
        .when(F.col("file_seq_id") == "G1", F.array(F.lit("c_acctbal"), F.lit("nothing")))
        .alias("include_exclude"),
        (F.col("file_seq_id") == "G1").alias("is_exclude"),
    )
    records = records_mixed(cells, map_headers_of(tables, contracts))
    r = F.col("record")
    return records.select(
        F.col("src_row").alias("c_custkey"), F.size(r).alias("n_fields"), r["custkey"].alias("custkey"),
        r["c_name"].alias("name"), r["c_mktsegment"].alias("segment"), r["c_acctbal"].alias("balance"),
    )


def enrich_system_columns(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    even = F.col("event_id") % 2 == 0
    names = ["file_seq_id", "bloc_recon_file_name", "sourcetype", "batch_id", "process_date", "custom_field_1"]
    rows = e.select(
        "event_id",
        F.concat(F.lit("F"), text(F.col("user_id"))).alias("file_seq_id"),
        F.concat(F.lit("/in/"), F.col("event_type"), F.lit("/u"), text(F.col("user_id")), F.lit(".csv")).alias("path"),
        F.when(F.col("event_type") != "view", F.upper("event_type")).alias("source_name"),
        F.lit("run1").alias("run_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("process_date"),
        F.create_map(
            F.lit("sourcetype"), F.when(even, "").otherwise("own"),
            F.lit("amount"), text(money2(F.col("value"))),
        ).alias("record"),
        # the type table of purchases has no batch id and no custom field
        F.transform(
            F.array(*(F.lit(n) for n in names)),
            lambda n: F.struct(
                F.when((F.col("event_type") == "purchase") & n.isin("batch_id", "custom_field_1"), "other")
                .otherwise(n).alias("name"),
                F.lit("varchar").alias("type"),
            ),
        ).alias("types"),
        F.create_map(F.lit("custom1"), F.get_json_object("props", "$.k"), F.lit("other"), F.lit("x")).alias("doc"),
    )
    r = F.col("record")
    return fill_system_columns(rows, doc="doc").select(
        "event_id", *(r[n].alias(f"r_{n}") for n in names), r["amount"].alias("r_amount"), F.size(r).alias("n_fields")
    )


def record_json(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_custkey") + 2).alias("_row"), "c_name",
        F.lit("hidden").alias("batch_id"),
        F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("segment"),
        text(money2(F.col("c_acctbal"))).alias("balance"),
    )
    return render(c, ["c_custkey"])


def combine(spark, sf_dir):
    def shape(df, ord_, key, name):
        return df.select(
            F.lit("R1").alias("file_seq_id"), F.lit(ord_).alias("file_ord"), F.lit(0).alias("table_no"),
            (F.col(key) + 2).alias("src_row"), F.col(name).alias("name"),
        )

    both = combine_tables(
        shape(table(spark, sf_dir, "supplier"), 0, "s_suppkey", "s_name"),
        shape(table(spark, sf_dir, "customer"), 1, "c_custkey", "c_name").withColumn("only_second", F.lit("y")),
    )
    numbered = with_batch_no(both, 1000)
    return numbered.select(
        "file_ord", "src_row", "name", "only_second", "n", "batch_no", generated_id(F.col("name")).alias("auto_id")
    )


def apply_field_map(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    parsed = o.select(
        "o_orderkey",
        F.concat_ws("-", F.lpad(text(F.col("o_custkey") % 10000), 4, "0"), F.lit("0001")).alias("account_number"),
        F.lit("$").alias("currency"), F.lit("transaction").alias("record_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("posting_date"),
        F.col("o_orderpriority").alias("description"),
        text(money2(F.col("o_totalprice"))).alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "DB").otherwise("CR").alias("dbcr"),
    )
    mapped = project_fields(parsed, TableProfile().field_map)
    raw = F.col("_raw")
    return mapped.select(
        *(c for c in mapped.columns if c != "_raw"),
        F.get_json_object(raw, "$.o_orderkey").cast("bigint").alias("raw_key"),
    )


def resolve_options(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    requests = o.select(
        "o_orderkey", "o_orderpriority",
        F.when(F.col("o_orderkey") % 3 == 0, "textract").alias("engine"),
        F.when(F.col("o_orderkey") % 4 == 0, "table").alias("layout"),
    )
    defaults = o.select("o_orderpriority").distinct().select(
        "o_orderpriority", F.lit("native").alias("engine"),
        F.concat(F.lit("auto"), "o_orderpriority").alias("layout"),
    )
    return resolve_options_of(requests, defaults, ["o_orderpriority"], ["engine", "layout"])


def merge_options(spark, sf_dir):
    """Nested options of requests over those of their priority: objects merge, lists, nulls and other kinds replace."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    asked = (
        F.when(k % 6 == 1, "{}").when(k % 6 == 2, '{"pdf": {"table": {"mode": "text"}}}')
        .when(k % 6 == 3, '{"pdf": {"dpi": null, "extra": {"x": 1}, "table": {"snap": [9]}}}')
        .when(k % 6 == 4, '{"engine": {"name": "e"}, "pdf": "off"}')
        .when(k % 6 == 5, F.concat(F.lit('{"pdf": {"pages": {"from": '), text(k), F.lit("}}}")))
    )
    defaults = o.select("o_orderpriority").distinct().select(
        "o_orderpriority", F.lit("native").alias("engine"),
        F.concat(F.lit('{"engine": "native", "pdf": {"dpi": 150, "pages": null, "table": {"mode": "'), "o_orderpriority", F.lit('", "snap": [1, 2]}}}')).alias("parser"))
    requests = o.select("o_orderkey", "o_orderpriority", F.when(k % 4 == 0, "own").alias("engine"), asked.alias("parser"))
    return resolve_options_of(requests, defaults, ["o_orderpriority"], ["engine"], ("parser",))


def type_lookup(spark, sf_dir):
    """Types of the part contracts: contract entries before position entries."""
    _, contracts = _part_tables(spark, sf_dir)
    looked = with_lookup(contracts)
    names = F.array(*(F.lit(n) for n in ("subaccount", "economyprice", "account", "standard_price", "brand_col")))
    return looked.select("file_seq_id", F.explode(names).alias("name"), "types").select(
        "file_seq_id", "name", type_of(F.col("types"), F.col("name")).alias("type")
    )


QUERIES = {
    "map_headers": map_headers,
    "map_headers_position": map_headers_position,
    "contract_drift": contract_drift,
    "unmapped_headers": unmapped_headers,
    "type_lookup": type_lookup,
    "project_include_exclude": project_include_exclude,
    "enrich_system_columns": enrich_system_columns,
    "record_json": record_json,
    "combine_tables": combine,
    "apply_field_map": apply_field_map,
    "resolve_options": resolve_options,
    "merge_options": merge_options,
}

_HEADERS = """(SELECT p_partkey, p_type, p_brand, i AS pos,
                 CASE i WHEN 0 THEN 'Sub Account' WHEN 1 THEN p_type || ' Price' WHEN 2 THEN p_brand
                        WHEN 3 THEN p_brand WHEN 4 THEN '' ELSE ' P-Name ' END AS header,
                 CASE WHEN i = 4 THEN false WHEN i = 1 THEN p_type IN ('ECONOMY', 'STANDARD', 'LARGE')
                      ELSE true END AS mapped
          FROM part, range(6) AS r(i))"""

ORACLE = {
    "map_headers": f"""
        SELECT p_partkey, CAST(pos AS INTEGER) AS pos, header, mapped, pos <> 4 AS keep,
               CASE pos WHEN 0 THEN 'account' WHEN 2 THEN 'brand_col' WHEN 3 THEN 'brand_col_1' WHEN 4 THEN 'col_5'
                        WHEN 5 THEN 'p_name'
                        ELSE CASE p_type WHEN 'STANDARD' THEN 'standard_price' WHEN 'LARGE' THEN 'large_price'
                             ELSE lower(p_type) || 'price' END END AS target,
               CASE WHEN pos = 0 THEN 'string'
                    WHEN pos = 1 THEN CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'numeric'
                                           WHEN p_type = 'LARGE' THEN 'double' ELSE 'varchar' END
                    ELSE 'varchar' END AS type
        FROM {_HEADERS}""",
    "map_headers_position": f"""
        SELECT p_partkey, CAST(pos AS INTEGER) AS pos, header, mapped, pos <> 4 AS keep,
               CASE pos WHEN 0 THEN 'subaccount' WHEN 1 THEN 'economyprice' WHEN 2 THEN 'large_price'
                        WHEN 3 THEN 'p_name' ELSE 'col_' || (pos + 1) END AS target,
               CASE pos WHEN 1 THEN 'numeric' WHEN 2 THEN 'double' ELSE 'varchar' END AS type
        FROM {_HEADERS}""",
    "unmapped_headers": f"""
        SELECT p_brand AS file_seq_id, 'unmapped_headers' AS kind,
               'no column of the contract for header ''' || header || '''' AS detail
        FROM {_HEADERS} WHERE NOT mapped""",
    "type_lookup": """
        SELECT file_seq_id, t.name, t.type
        FROM (SELECT DISTINCT p_brand AS file_seq_id FROM part),
             (VALUES ('subaccount', 'varchar'), ('economyprice', 'numeric'), ('account', 'string'),
                     ('standard_price', 'numeric'), ('brand_col', NULL)) AS t(name, type)""",
    "contract_drift": """
        SELECT r_name AS file_seq_id, 'contract_drift' AS kind,
               'the contract has a position but no detail for column ''' || n_name || '''' AS detail
        FROM region JOIN nation ON n_nationkey % 5 IN (r_regionkey, (r_regionkey + 1) % 5)
        WHERE n_regionkey <> r_regionkey""",
    "project_include_exclude": """
        SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 4 END AS n_fields,
               CASE WHEN c_nationkey % 3 > 0 THEN CAST(c_custkey AS VARCHAR) END AS custkey,
               c_name AS name,
               CASE WHEN c_nationkey % 3 > 0 AND c_custkey % 7 > 0 THEN c_mktsegment END AS segment,
               CASE WHEN c_nationkey % 3 <> 1 AND c_custkey % 7 > 0
                    THEN CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR) END AS balance
        FROM customer""",
    "enrich_system_columns": """
        SELECT event_id, 'F' || user_id AS r_file_seq_id, 'u' || user_id || '.csv' AS r_bloc_recon_file_name,
               CASE WHEN event_id % 2 = 1 THEN 'own' WHEN event_type = 'view' THEN '' ELSE upper(event_type) END
                   AS r_sourcetype,
               CASE WHEN event_type <> 'purchase' THEN 'run1' END AS r_batch_id,
               strftime(ts, '%Y-%m-%d') AS r_process_date,
               CASE WHEN event_type <> 'purchase' THEN json_extract_string(props, '$.k') END AS r_custom_field_1,
               CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) AS r_amount,
               CASE WHEN event_type = 'purchase' THEN 5 ELSE 7 END AS n_fields
        FROM events""",
    "record_json": """
        SELECT c_custkey, '{"_row":' || (c_custkey + 2) || ',"c_name":"' || c_name || '","segment":'
               || CASE WHEN c_custkey % 3 > 0 THEN '"' || c_mktsegment || '"' ELSE 'null' END
               || ',"balance":"' || CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR) || '"}' AS json
        FROM customer""",
    "combine_tables": """
        SELECT file_ord, src_row, name, only_second, n, CAST(n // 1000 + 1 AS INTEGER) AS batch_no,
               'AUTO-' || left(sha256(name), 16) AS auto_id
        FROM (SELECT *, row_number() OVER (ORDER BY file_ord, src_row) - 1 AS n
              FROM (SELECT 0 AS file_ord, s_suppkey + 2 AS src_row, s_name AS name, NULL AS only_second FROM supplier
                    UNION ALL SELECT 1, c_custkey + 2, c_name, 'y' FROM customer))""",
    "apply_field_map": """
        SELECT lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') || '-0001' AS subaccount, '$' AS currency,
               CAST(NULL AS VARCHAR) AS openingbalance, CAST(NULL AS VARCHAR) AS closingbalance,
               CAST(NULL AS VARCHAR) AS openingbalancedate, CAST(NULL AS VARCHAR) AS closingbalancedate,
               strftime(o_orderdate, '%Y-%m-%d') AS itemdate, o_orderpriority AS description,
               CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS amount,
               CASE WHEN o_orderstatus = 'F' THEN 'DB' ELSE 'CR' END AS dbcr_10,
               'transaction' AS record_type, o_orderkey AS raw_key
        FROM orders""",
    "merge_options": """
        SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 4 = 0 THEN 'own' ELSE 'native' END AS engine,
               CASE o_orderkey % 6
                 WHEN 2 THEN '{"engine":"native","pdf":{"dpi":150,"pages":null,"table":{"mode":"text","snap":[1,2]}}}'
                 WHEN 3 THEN '{"engine":"native","pdf":{"dpi":null,"extra":{"x":1},"pages":null,"table":{"mode":"' || o_orderpriority || '","snap":[9]}}}'
                 WHEN 4 THEN '{"engine":{"name":"e"},"pdf":"off"}'
                 WHEN 5 THEN '{"engine":"native","pdf":{"dpi":150,"pages":{"from":' || o_orderkey || '},"table":{"mode":"' || o_orderpriority || '","snap":[1,2]}}}'
                 ELSE '{"engine":"native","pdf":{"dpi":150,"pages":null,"table":{"mode":"' || o_orderpriority || '","snap":[1,2]}}}' END AS parser
        FROM orders""",
    "resolve_options": """
        SELECT o_orderkey, o_orderpriority,
               CASE WHEN o_orderkey % 3 = 0 THEN 'textract' ELSE 'native' END AS engine,
               CASE WHEN o_orderkey % 4 = 0 THEN 'table' ELSE 'auto' || o_orderpriority END AS layout
        FROM orders""",
}

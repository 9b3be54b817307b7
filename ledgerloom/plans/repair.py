"""Driver queries: table repair, pages, sheets, OCR blocks and word geometry."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean, has_text
from ..operators import geometry, ocr, sheets, tables as T
from ..operators.documents import key_values as values_of, keyword_value, keyword_values as keywords_of
from .common import money2, table, text

NUMERIC_SQL = r"'(?i)^[\s\-+(]*[\d,.\s]+\)?\s*(CR|DR)?-?$'"


def _lines(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def noise_filter(spark, sf_dir):
    lines = _lines(spark, sf_dir).withColumn(
        "line",
        F.when(F.col("line_no") % 5 == 0, F.concat(F.lit("Page 3 "), F.col("line")))
        .when(F.col("line_no") % 7 == 0, F.concat(F.lit("  SUB total: "), F.col("line")))
        .when(F.col("line_no") % 6 == 1, F.concat(F.lit("Totally "), F.col("line")))
        .otherwise(F.col("line")),
    )
    # blank lines go as they are read; cleaned, each filter would clean every line once more
    kept = lines.filter(has_text(F.col("line"))).withColumn("line", clean(F.col("line")))
    return kept.filter(~T.is_noise(F.col("line"), T.DEFAULTS.skip_row_patterns))


def _fragments(spark, sf_dir):
    cells = F.split("line", ", ")
    return _lines(spark, sf_dir).select(
        F.col("doc_id").alias("file_id"), F.lit(1).alias("page"), F.lit(0).alias("table_on_page"),
        F.lit(0).alias("strategy_ord"), F.col("line_no").alias("row_no"),
        F.when(F.col("line_no") % 4 < 2, F.transform(cells, lambda c: text(F.length(c)))).otherwise(cells).alias("cells"),
    )


def detect_header(spark, sf_dir):
    heads, body = T.split_headers(T.sized_fragments(_fragments(spark, sf_dir)))
    n = body.groupBy("file_id").agg(F.count(F.lit(1)).alias("n_body"))
    return heads.join(n, "file_id", "left").select(
        F.col("file_id").alias("doc_id"), "width", F.array_join("header", "|").alias("header"),
        F.coalesce("n_body", F.lit(0)).alias("n_body"),
    )


def table_size(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    n = F.col("p_partkey") % 4
    cells = F.when(n == 0, F.array(F.lit(" "), F.lit("")).cast("array<string>")).when(
        n == 1, F.array(F.col("p_name"))
    ).otherwise(F.array(F.col("p_name"), F.concat(F.lit(" "), F.col("p_type"), F.lit("  x"))))
    fragments = p.select(
        F.col("p_brand").alias("file_id"), F.col("p_size").alias("page"),
        (F.col("p_partkey") % 3).cast("int").alias("table_on_page"),
        (F.floor(F.col("p_partkey") / 3) % 2).cast("int").alias("strategy_ord"), F.col("p_partkey").alias("row_no"),
        cells.alias("cells"),
    )
    return T.sized_fragments(fragments).select(
        "file_id", "page", "table_on_page", "strategy_ord", "row_no", "width", F.array_join("cells", "|").alias("cells")
    )


def stitch_tables(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    n = F.length("text")
    names = F.array(F.concat(F.lit("H"), text(F.floor(n / 10) % 2)), F.lit("b"), F.lit("c"))
    width = (F.lit(2) + F.floor(n / 7) % 2).cast("int")
    heads = c.select(
        (F.col("conv_id") % 50).alias("file_id"), F.col("conv_id").alias("page"), F.col("turn").alias("table_on_page"),
        width.alias("width"),
        F.when(
            n % 3 == 0, F.transform(F.sequence(F.lit(1), width), lambda i: F.concat(F.lit("col_"), text(i)))
        ).otherwise(F.slice(names, F.lit(1), width)).alias("header"),
    )
    out = T.stitch(heads)
    return out.select(
        F.col("page").alias("conv_id"), F.col("table_on_page").alias("turn"), "table_no", "table_page",
        F.array_join("table_header", "|").alias("header"),
    )


def merge_wrapped_rows(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    n = F.length("text")
    key = F.when(n % 11 == 0, "Page 3").when(F.col("role") == "assistant", "").otherwise(F.col("role"))
    value = F.when(n % 5 == 0, "1,250.00 CR").otherwise(clean(F.col("text")))
    cells = F.when(n % 13 == 0, F.array(F.lit("key"), F.lit("v"), F.lit("w"))).otherwise(
        F.array(key, value, F.when(n % 2 == 0, "x").otherwise(""))
    )
    body = c.select(
        (F.col("conv_id") % 50).alias("file_id"), F.col("conv_id").alias("page"), F.lit(0).alias("table_on_page"),
        F.col("turn").alias("row_no"), F.floor(F.col("conv_id") / 200).alias("table_no"),
        F.array(F.lit("key"), F.lit("v"), F.lit("w")).alias("table_header"), cells.alias("cells"),
    )
    merged = T.merge_wrapped(body)
    return merged.select(
        "file_id", "table_no", "src_row", *(F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(3))
    )


_PATTERNS = {
    "after_and": r"and\s+([a-z]+)",
    "number": r"([0-9][0-9,.]*)",
    "in_phrase": r"\sin[:\s]+([a-z ]+)",
}


def key_values(spark, sf_dir):
    pages = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"), F.lit(1).alias("page"), "text"
    )
    return values_of(pages, _PATTERNS).withColumnRenamed("file_id", "doc_id")


def _turn_pages(spark, sf_dir):
    """Conversation turns as the pages of a document; a label, its second half and its value stand on three pages."""
    turn = F.col("turn") % 3
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("file_id"), F.col("turn").alias("page"),
        F.when(turn == 0, F.concat("text", F.lit(" Opening "))).when(turn == 1, " balance: ")
        .otherwise(F.concat(F.lit("("), text(F.length("text")), F.lit(".50) "), F.col("text"))).alias("text"),
    )


def paged_key_values(spark, sf_dir):
    """A match may run over any number of pages."""
    return values_of(_turn_pages(spark, sf_dir)).withColumnRenamed("file_id", "conv_id")


def requested_keywords(spark, sf_dir):
    """Keywords of requests over paged documents: values, and a warning for each that does not occur."""
    pages = _turn_pages(spark, sf_dir)
    keywords = pages.select("file_id").distinct().select(
        "file_id", F.explode(F.array(F.struct(F.lit("opening").alias("field"), F.lit("'balance'").alias("keyword")),
                                     F.struct(F.lit("absent").alias("field"), F.lit("zq§zq").alias("keyword")))).alias("k")
    ).select("file_id", "k.field", "k.keyword")
    values, warnings = keywords_of(pages, keywords)
    return values.withColumns({"kind": F.lit(None).cast("string"), "detail": F.lit(None).cast("string")}).unionByName(
        warnings.withColumns({"field": F.lit(None).cast("string"), "value": F.lit(None).cast("string")})).withColumnRenamed("file_id", "conv_id")


def keyword_values(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    keyword = F.when(F.col("lang") == "en", " 'ing the' ").when(F.col("lang") == "fr", "la").when(
        F.col("lang") == "de", '"und."'
    ).otherwise("que")
    return d.select(
        "doc_id", keyword_value(F.col("text"), keyword).alias("value"),
    ).withColumn("missing", F.col("value").isNull())


def _order_blocks(spark, sf_dir):
    """Twenty orders form one OCR table: key, priority (words, sometimes two columns wide), a check box."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.floor(F.col("o_orderkey") / 20).alias("t"), (F.col("o_orderkey") % 20 + 1).cast("int").alias("r"),
        "o_orderpriority",
    )
    key = F.col("o_orderkey")

    def block(df, **given):
        fields = {
            "file_id": "bigint", "block_ord": "bigint", "Id": "string", "BlockType": "string", "Text": "string",
            "Page": "int", "Relationships": "array<struct<Type:string,Ids:array<string>>>",
            "EntityTypes": "array<string>", "SelectionStatus": "string", "RowIndex": "int", "ColumnIndex": "int",
            "RowSpan": "int", "ColumnSpan": "int",
        }
        return df.select(
            *(given.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields.items())
        )

    def child(ids):
        return F.array(F.struct(F.lit("CHILD").alias("Type"), ids.alias("Ids")))

    def id_(letter):
        return F.concat(F.lit(letter), text(key))

    file_id = F.col("t") % 97
    cell_ids = F.when(key % 3 == 0, F.array(id_("a"), id_("b"), id_("c"))).otherwise(F.array(id_("a"), id_("b")))
    per_table = o.groupBy("t").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", cell_ids.alias("ids")))).alias("x"))
    words = F.split("o_orderpriority", " ")
    word_ids = F.transform(words, lambda w, i: F.concat(F.lit("w"), text(key), F.lit("_"), text(i)))
    cells = [
        block(o, file_id=file_id, block_ord=key, Id=id_("a"), BlockType=F.lit("CELL"), RowIndex=F.col("r"),
              ColumnIndex=F.lit(1), RowSpan=F.when(key % 7 == 0, 2), Relationships=child(F.array(id_("k")))),
        block(o, file_id=file_id, block_ord=key, Id=id_("b"), BlockType=F.lit("CELL"), RowIndex=F.col("r"),
              ColumnIndex=F.lit(2), ColumnSpan=F.when(key % 5 == 0, 2).otherwise(1), Relationships=child(word_ids)),
        block(o.filter("o_orderkey % 3 = 0"), file_id=file_id, block_ord=key, Id=id_("c"), BlockType=F.lit("CELL"),
              RowIndex=F.col("r"), ColumnIndex=F.lit(3), Relationships=child(F.array(id_("s")))),
        block(o.filter("o_orderkey % 3 = 0"), file_id=file_id, block_ord=key, Id=id_("s"),
              BlockType=F.lit("SELECTION_ELEMENT"),
              SelectionStatus=F.when(key % 2 == 0, "SELECTED").otherwise("NOT_SELECTED")),
        block(o, file_id=file_id, block_ord=key, Id=id_("k"), BlockType=F.lit("WORD"), Text=text(key)),
        block(
            o.select("t", "o_orderkey", F.posexplode(words).alias("i", "w")), file_id=file_id, block_ord=key,
            Id=F.concat(F.lit("w"), text(key), F.lit("_"), text(F.col("i"))), BlockType=F.lit("WORD"), Text=F.col("w"),
        ),
        block(
            per_table, file_id=file_id, block_ord=F.col("t"), Id=F.concat(F.lit("t"), text(F.col("t"))),
            BlockType=F.lit("TABLE"),
            Relationships=child(F.flatten(F.transform("x", lambda v: v["ids"]))),
        ),
    ]
    out = cells[0]
    for c in cells[1:]:
        out = out.unionByName(c)
    return out


def grid_from_cells(spark, sf_dir):
    rows = ocr.grid_rows(_order_blocks(spark, sf_dir))
    return rows.select(
        "file_id", "page", F.col("table_on_page").alias("table_no"), "row_no", F.array_join("cells", "|").alias("cells")
    )


def form_key_values(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    nothing = F.lit(None).cast("array<struct<Type:string,Ids:array<string>>>")

    def rel(kind, name):
        return F.struct(F.lit(kind).alias("Type"), F.array(F.concat(F.lit(name), text(key))).alias("Ids"))

    def block(kind, name, relationships=nothing, entity=None, word=None):
        return F.struct(
            F.concat(F.lit(name), text(key)).alias("Id"), F.lit(kind).alias("BlockType"),
            (F.lit(None).cast("string") if word is None else word).alias("Text"), relationships.alias("Relationships"),
            F.array(F.lit(entity)).cast("array<string>").alias("EntityTypes"),
            F.lit(None).cast("string").alias("SelectionStatus"),
        )

    blocks = c.select(
        F.floor(key / 40).alias("file_id"), key.alias("block_ord"),
        F.explode(
            F.array(
                block("KEY_VALUE_SET", "key", F.array(rel("CHILD", "kw"), rel("VALUE", "val")), "KEY"),
                block("WORD", "kw", word=F.concat("c_mktsegment", F.lit("::"))),
                block("KEY_VALUE_SET", "val", F.array(rel("CHILD", "vw")), "VALUE"),
                block("WORD", "vw", word=F.col("c_name")),
            )
        ).alias("b"),
    ).select("file_id", "block_ord", "b.*")
    return ocr.form_key_values(blocks)


def page_select(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).alias("page"), F.length("text").alias("n"))
    chosen = T.select_pages(c, "4-5,1-2,2,90")
    return chosen.groupBy("page_ord", "page").agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n").alias("n_chars"))


def _book(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(
        F.concat(F.lit("wb"), text(F.col("p_size") % 4)).alias("file_id"),
        F.substring_index("p_brand", "#", -1).cast("int").alias("sheet_idx"), F.col("p_brand").alias("sheet"),
        (F.col("p_partkey") + 2).cast("int").alias("row"), "p_partkey", "p_name", "p_retailprice",
    )
    empty = F.col("p_partkey") % 6 == 0
    values = F.array(
        F.when(~empty, F.col("p_name")), F.lit(""), F.when(~empty, text(money2(F.col("p_retailprice")))), F.lit("over")
    )
    data = p.select("file_id", "sheet_idx", "sheet", "row", F.posexplode(values).alias("col", "value"))
    names = F.array(F.lit("Name"), F.lit("Gap"), F.lit("Price"), F.lit(""))
    heads = p.select("file_id", "sheet_idx", "sheet").distinct().select(
        "file_id", "sheet_idx", "sheet", F.lit(1).alias("row"), F.posexplode(names).alias("col", "value")
    )
    return data.unionByName(heads).withColumn("col", F.col("col") + 1)


def sheet_select(spark, sf_dir):
    cells = _book(spark, sf_dir)
    listed = cells.select("file_id", "sheet_idx", "sheet").distinct()
    requests = listed.select("file_id").distinct().withColumn(
        "identifiers",
        F.when(F.col("file_id") == "wb0", F.array(F.lit("")))
        .when(F.col("file_id") == "wb1", F.array(F.lit("2"), F.lit("Brand#3")))
        .when(F.col("file_id") == "wb2", F.array(F.lit("Brand#99"), F.lit("Brand#5"))),
    )
    chosen, missing = sheets.wanted_sheets(listed, requests)
    heads, rows = sheets.sheet_grid(cells, chosen)
    out = rows.join(heads.select("file_id", "table_no", F.array_join("headers", "|").alias("headers")), ["file_id", "table_no"])
    return out.select(
        "file_id", "table_no", "sheet", "row", "headers", F.array_join("cells", "|", "~").alias("cells")
    ).unionByName(missing.select("file_id", F.substring_index("detail", ";", 1).alias("cells")), allowMissingColumns=True)


def _words(spark, sf_dir):
    """Words of a document, eight to a line and fifty lines to a page, with jitter below the tolerance."""
    d = table(spark, sf_dir, "documents")
    w = d.select("doc_id", F.posexplode(F.split("text", r"\s+")).alias("i", "text")).filter("text <> ''")
    line = F.floor(F.col("i") / 8) % 50
    return w.select(
        F.col("doc_id").alias("file_id"), (F.floor(F.col("i") / 400) + 1).cast("int").alias("page"),
        F.col("i").alias("word_ord"), "text",
        (F.col("i") % 8 * 0.1).alias("x0"), (F.col("i") % 8 * 0.1 + 0.09).alias("x1"),
        (line * 0.02 + (F.col("i") * 7) % 5 * 0.0005).alias("top"),
    )


def visual_rows(spark, sf_dir):
    rows = geometry.visual_rows(_words(spark, sf_dir), 0.0035)
    return rows.select(
        F.col("file_id").alias("doc_id"), "page", "row_no", geometry.between(F.col("words"), 0.0).alias("line")
    )


def column_slices(spark, sf_dir):
    rows = geometry.visual_rows(_words(spark, sf_dir), 0.0035)
    cut = geometry.column_slices(rows, {"lft": (0.0, 0.25), "mid": (0.15, 0.45), "rgt": (0.45, 9.0)})
    return cut.select(F.col("file_id").alias("doc_id"), "page", "row_no", "lft", "mid", "rgt")


def ocr_words(spark, sf_dir):
    w = _words(spark, sf_dir)
    blocks = w.select(
        "file_id", F.col("word_ord").alias("block_ord"),
        F.when(F.col("word_ord") % 10 == 9, "LINE").otherwise("WORD").alias("BlockType"), F.col("text").alias("Text"),
        F.when(F.col("page") > 1, F.col("page")).alias("Page"),
        F.struct(
            F.struct(
                (F.col("x0") * 612).alias("Left"), F.lit(55.08).alias("Width"), (F.col("top") * 792).alias("Top"),
                F.lit(7.92).alias("Height"),
            ).alias("BoundingBox")
        ).alias("Geometry"),
    )
    found = geometry.ocr_words(blocks).withColumns({"page_width": F.lit(612.0), "page_height": F.lit(792.0)})
    scaled = geometry.to_fractions(found)

    def micro(c):
        return F.sum(F.round(F.col(c) * 10000).cast("bigint"))

    return scaled.groupBy(F.col("file_id").alias("doc_id"), "page").agg(
        F.count(F.lit(1)).alias("n_words"), F.sum(F.length("text")).alias("n_chars"), micro("x0").alias("x0"),
        micro("x1").alias("x1"), micro("top").alias("top"), F.sum("word_ord").cast("bigint").alias("ords"),
    )


QUERIES = {
    "noise_filter": noise_filter,
    "detect_header": detect_header,
    "table_size": table_size,
    "stitch_tables": stitch_tables,
    "merge_wrapped_rows": merge_wrapped_rows,
    "key_values": key_values,
    "paged_key_values": paged_key_values,
    "requested_keywords": requested_keywords,
    "keyword_values": keyword_values,
    "grid_from_cells": grid_from_cells,
    "form_key_values": form_key_values,
    "page_select": page_select,
    "sheet_select": sheet_select,
    "visual_rows": visual_rows,
    "column_slices": column_slices,
    "ocr_words": ocr_words,
}

_LINES = r"""lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                       generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)"""
_CLEAN = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
_WORDS = r"""w AS (SELECT doc_id, i // 400 + 1 AS page, i, text, i % 8 AS p, i // 8 % 50 AS l
              FROM (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS text,
                           generate_subscripts(string_split_regex(text, '\s+'), 1) - 1 AS i FROM documents)
              WHERE text <> '')"""
_VALUE = r"""trim(regexp_replace(regexp_extract(text, '(?i){0}', 1), '\s+', ' ', 'g'))"""


def _value_sql(name, pattern):
    return f"CASE WHEN regexp_matches(text, '(?i){pattern}') THEN {_VALUE.format(pattern)} END AS {name}"


ORACLE = {
    "noise_filter": rf"""
        WITH {_LINES}
        SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line
        FROM (SELECT doc_id, line_no, {_CLEAN.format('''CASE WHEN line_no % 5 = 0 THEN 'Page 3 ' || line
                  WHEN line_no % 7 = 0 THEN '  SUB total: ' || line
                  WHEN line_no % 6 = 1 THEN 'Totally ' || line ELSE line END''')} AS line FROM lines)
        WHERE line <> '' AND line_no % 5 > 0 AND line_no % 7 > 0
          AND NOT regexp_matches(line, '(?i)^\s*(page \d+|total|sub\s*total|continued)([^a-z0-9_]|$)')""",
    "detect_header": rf"""
        WITH {_LINES},
        c AS (SELECT doc_id, line_no, CASE WHEN line_no % 4 < 2
                  THEN list_transform(string_split(line, ', '), lambda x: CAST(length(x) AS VARCHAR))
                  ELSE list_transform(string_split(line, ', '), lambda x: {_CLEAN.format('x')}) END AS cells FROM lines),
        k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS rn,
                     max(len(cells)) OVER (PARTITION BY doc_id) AS width, count(*) OVER (PARTITION BY doc_id) AS n
              FROM c WHERE len(list_filter(cells, lambda x: x <> '')) > 0),
        h AS (SELECT *, list_filter(cells, lambda x: x <> '') AS filled FROM k WHERE n >= 2 AND width >= 2),
        j AS (SELECT *, rn <= 5 AND len(filled) >= greatest(2, width // 2)
                  AND len(list_filter(filled, lambda x: regexp_matches(x, {NUMERIC_SQL}))) / len(filled) < 0.2 AS head
              FROM h)
        SELECT doc_id, CAST(any_value(width) AS INTEGER) AS width,
               coalesce(arg_min(array_to_string(list_concat(cells, list_transform(range(width - len(cells)), lambda i: '')), '|'), rn)
                            FILTER (head),
                        array_to_string(list_transform(range(1, any_value(width) + 1), lambda i: 'col_' || i), '|')) AS header,
               count(*) - coalesce(min(rn) FILTER (head), 0) AS n_body
        FROM j GROUP BY doc_id""",
    "table_size": """
        WITH f AS (SELECT p_brand AS file_id, p_size AS page, CAST(p_partkey % 3 AS INTEGER) AS table_on_page,
                          CAST(p_partkey // 3 % 2 AS INTEGER) AS strategy_ord, p_partkey AS row_no,
                          CASE WHEN p_partkey % 4 = 1 THEN 1 ELSE 2 END AS w,
                          p_name || CASE WHEN p_partkey % 4 = 1 THEN '|' ELSE '|' || p_type || ' x' END AS cells
                   FROM part WHERE p_partkey % 4 > 0),
             g AS (SELECT *, count(*) OVER t AS n, max(w) OVER t AS width FROM f
                   WINDOW t AS (PARTITION BY file_id, page, table_on_page, strategy_ord)),
             k AS (SELECT *, min(strategy_ord) OVER (PARTITION BY file_id, page) AS best FROM g WHERE n >= 2 AND width >= 2)
        SELECT file_id, page, table_on_page, strategy_ord, row_no, CAST(width AS INTEGER) AS width, cells
        FROM k WHERE strategy_ord = best""",
    "stitch_tables": """
        WITH f AS (SELECT conv_id, turn, conv_id % 50 AS f, 2 + length(text) // 7 % 2 AS width, length(text) % 3 = 0 AS gen,
                          'H' || (length(text) // 10 % 2) AS h FROM conversations),
             g AS (SELECT *, CASE WHEN gen THEN 'col_1|col_2' || CASE WHEN width = 3 THEN '|col_3' ELSE '' END
                              ELSE h || '|b' || CASE WHEN width = 3 THEN '|c' ELSE '' END END AS header,
                          coalesce(lag(width) OVER o <> width, true) AS run FROM f
                   WINDOW o AS (PARTITION BY f ORDER BY conv_id, turn)),
             r AS (SELECT *, last_value(CASE WHEN run AND gen THEN '' WHEN run OR NOT gen THEN header END IGNORE NULLS) OVER
                              (PARTITION BY f ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
                   FROM g),
             n AS (SELECT *, run OR (NOT gen AND header <> coalesce(prev, '')) AS new FROM r)
        SELECT conv_id, turn, CAST(sum(CAST(new AS INTEGER)) OVER o AS BIGINT) AS table_no,
               last_value(CASE WHEN new THEN conv_id END IGNORE NULLS) OVER o AS table_page,
               last_value(CASE WHEN new THEN header END IGNORE NULLS) OVER o AS header
        FROM n WINDOW o AS (PARTITION BY f ORDER BY conv_id, turn)""",
    "merge_wrapped_rows": rf"""
        WITH b AS (SELECT conv_id % 50 AS f, conv_id, turn, conv_id // 200 AS t,
                          CASE WHEN role = 'assistant' THEN '' ELSE role END AS c0,
                          CASE WHEN length(text) % 5 = 0 THEN '1,250.00 CR' ELSE {_CLEAN.format("text")} END AS c1,
                          CASE WHEN length(text) % 2 = 0 THEN 'x' ELSE '' END AS c2
                   FROM conversations WHERE length(text) % 11 > 0 AND length(text) % 13 > 0),
             k AS (SELECT * FROM b WHERE NOT regexp_matches(c0 || ' ' || c1 || ' ' || c2,
                      '(?i)^\s*(page \d+|total|sub\s*total|continued)([^a-z0-9_]|$)')),
             h AS (SELECT *, coalesce(lag(t) OVER o <> t, true)
                             OR NOT (c0 = '' AND NOT regexp_matches(c1, {NUMERIC_SQL})) AS head
                   FROM k WINDOW o AS (PARTITION BY f ORDER BY conv_id, turn)),
             g AS (SELECT *, sum(CAST(head AS INTEGER)) OVER (PARTITION BY f ORDER BY conv_id, turn) AS grp FROM h)
        SELECT f AS file_id, t AS table_no, row_number() OVER (PARTITION BY f, t ORDER BY grp) AS src_row,
               coalesce(string_agg(nullif(c0, ''), ' ' ORDER BY conv_id, turn), '') AS c0,
               coalesce(string_agg(nullif(c1, ''), ' ' ORDER BY conv_id, turn), '') AS c1,
               coalesce(string_agg(nullif(c2, ''), ' ' ORDER BY conv_id, turn), '') AS c2
        FROM g GROUP BY f, t, grp""",
    "key_values": f"""
        SELECT doc_id, {", ".join(_value_sql(n, p) for n, p in _PATTERNS.items())} FROM documents""",
    "paged_key_values": """
        WITH p AS (SELECT conv_id, turn, lead(turn) OVER o AS t2, lead(turn, 2) OVER o AS t3, lead(length(text), 2) OVER o AS n3
                   FROM conversations WINDOW o AS (PARTITION BY conv_id ORDER BY turn))
        SELECT conv_id, arg_min('(' || n3 || '.50)', turn) FILTER (turn % 3 = 0 AND t2 % 3 = 1 AND t3 % 3 = 2) AS opening_balance,
               CAST(NULL AS VARCHAR) AS closing_balance, CAST(NULL AS VARCHAR) AS statement_date
        FROM p GROUP BY conv_id""",
    "requested_keywords": r"""
        WITH d AS (SELECT conv_id, string_agg(CASE turn % 3 WHEN 0 THEN text || ' Opening ' WHEN 1 THEN ' balance: '
                          ELSE '(' || length(text) || '.50) ' || text END, chr(10) ORDER BY turn) AS t FROM conversations GROUP BY 1),
             v AS (SELECT conv_id, CASE WHEN regexp_matches(t, '(?i)balance\s*[:\-]?\s*(.+)')
                          THEN trim(regexp_replace(regexp_extract(t, '(?i)balance\s*[:\-]?\s*(.+)', 1), '\s+', ' ', 'g')) END AS value FROM d)
        SELECT conv_id, 'opening' AS field, value, CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS VARCHAR) AS detail FROM v WHERE value IS NOT NULL
        UNION ALL SELECT conv_id, NULL, NULL, 'missing_keyword', 'keyword ''balance'' of field opening does not occur' FROM v WHERE value IS NULL
        UNION ALL SELECT conv_id, NULL, NULL, 'missing_keyword', 'keyword ''zq§zq'' of field absent does not occur' FROM v""",
    "keyword_values": rf"""
        SELECT doc_id, value, value IS NULL AS missing
        FROM (SELECT doc_id, CASE
                {" ".join(
                    f"WHEN {cond} THEN CASE WHEN regexp_matches(text, '(?i){kw}{rest}') THEN "
                    f"{_VALUE.format(kw + rest)} END"
                    for cond, kw, rest in (
                        ("lang = 'en'", "ing the", r"\s*[:\-]?\s*(.+)"), ("lang = 'fr'", "la", r"\s*[:\-]?\s*(.+)"),
                        ("lang = 'de'", r"und\.", r"\s*[:\-]?\s*(.+)"), ("true", "que", r"\s*[:\-]?\s*(.+)"))
                )} END AS value FROM documents)""",
    "grid_from_cells": """
        WITH o AS (SELECT o_orderkey AS k, o_orderkey // 20 AS t, o_orderkey % 20 + 1 AS r, o_orderpriority AS p FROM orders),
             x AS (SELECT t, max(r) AS m, arg_max(k, r) AS k FROM o GROUP BY t)
        SELECT t % 97 AS file_id, 1 AS page, t AS table_no, CAST(r AS INTEGER) AS row_no,
               k || '|' || p || '|' || CASE WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN 'X' ELSE '' END
                                            WHEN k % 5 = 0 THEN p ELSE '' END AS cells FROM o
        UNION ALL
        SELECT t % 97, 1, t, CAST(m + 1 AS INTEGER), k || '||' FROM x WHERE k % 7 = 0""",
    "form_key_values": """
        SELECT c_custkey // 40 AS file_id, 'form:' || c_mktsegment AS field, arg_max(c_name, c_custkey) AS value
        FROM customer GROUP BY 1, 2""",
    "page_select": """
        SELECT CAST(i * 1000000000 + page AS BIGINT) AS page_ord, page, count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS n_chars
        FROM (SELECT turn + 1 AS page, length(text) AS n FROM conversations)
             JOIN (VALUES (0, 4), (0, 5), (1, 1), (1, 2), (2, 2)) AS s(i, q) ON page = q
        GROUP BY 1, 2""",
    "sheet_select": """
        WITH p AS (SELECT *, 'wb' || (p_size % 4) AS file_id, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS ix FROM part),
             s AS (SELECT DISTINCT file_id, ix, p_brand FROM p),
             n AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY ix) - 1 AS i FROM s),
             c AS (SELECT file_id, 0 AS table_no, p_brand FROM n WHERE file_id IN ('wb0', 'wb3') AND i = 0
                   UNION ALL SELECT file_id, 0, p_brand FROM n WHERE file_id = 'wb1' AND i = 2
                   UNION ALL SELECT file_id, 1, p_brand FROM n WHERE file_id = 'wb1' AND p_brand = 'Brand#3'
                   UNION ALL SELECT file_id, 1, p_brand FROM n WHERE file_id = 'wb2' AND p_brand = 'Brand#5')
        SELECT file_id, table_no, p_brand AS sheet, CAST(p_partkey + 2 AS INTEGER) AS "row", 'Name|Gap|Price' AS headers,
               p_name || '||' || CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS VARCHAR) AS cells
        FROM p JOIN c USING (file_id, p_brand) WHERE p_partkey % 6 > 0
        UNION ALL
        SELECT DISTINCT file_id, NULL, NULL, NULL, NULL, 'no sheet ''Brand#99''' FROM s WHERE file_id = 'wb2'""",
    "visual_rows": f"""
        WITH {_WORDS}
        SELECT doc_id, CAST(page AS INTEGER) AS page,
               CAST(dense_rank() OVER (PARTITION BY doc_id, page ORDER BY l) AS INTEGER) AS row_no,
               string_agg(text, ' ' ORDER BY p) AS line
        FROM w GROUP BY doc_id, page, l""",
    "column_slices": f"""
        WITH {_WORDS}
        SELECT doc_id, CAST(page AS INTEGER) AS page,
               CAST(dense_rank() OVER (PARTITION BY doc_id, page ORDER BY l) AS INTEGER) AS row_no,
               coalesce(string_agg(text, ' ' ORDER BY p) FILTER (p <= 2), '') AS lft,
               coalesce(string_agg(text, ' ' ORDER BY p) FILTER (p BETWEEN 2 AND 4), '') AS mid,
               coalesce(string_agg(text, ' ' ORDER BY p) FILTER (p >= 5), '') AS rgt
        FROM w GROUP BY doc_id, page, l""",
    "ocr_words": f"""
        WITH {_WORDS}
        SELECT doc_id, CAST(page AS INTEGER) AS page, count(*) AS n_words, CAST(sum(length(text)) AS BIGINT) AS n_chars,
               CAST(sum(p * 1000) AS BIGINT) AS x0, CAST(sum(p * 1000 + 900) AS BIGINT) AS x1,
               CAST(sum(l * 200 + i * 7 % 5 * 5) AS BIGINT) AS top, CAST(sum(i) AS BIGINT) AS ords
        FROM w WHERE i % 10 < 9 GROUP BY doc_id, page""",
}

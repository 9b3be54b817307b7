"""Driver queries: coercion of dirty text."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.coerce import DATE_FORMATS, boolean, null_nan, varchar_text, with_numeric
from ..functions.dates import date_text
from ..functions.money import first_money, has_money, sign_label, to_money
from .common import money2, printed, table, text


def dirty_price():
    """A line price in one of six printed forms, with a few blanks and a few bad texts."""
    p = printed(F.col("l_extendedprice"))
    form = F.col("l_linenumber") % 6
    return (
        F.when(F.col("l_partkey") % 97 == 0, "n/a")
        .when(F.col("l_partkey") % 89 == 0, " -- ")
        .when(form == 0, F.concat(F.lit("("), p, F.lit(")")))
        .when(form == 1, F.concat(p, F.lit("-")))
        .when(form == 2, F.concat(p, F.lit(" CR")))
        .when(form == 3, F.concat(F.lit("$ "), p))
        .when(form == 4, F.replace(p, F.lit(","), F.lit("")))
        .otherwise(F.concat(F.lit("  £"), p, F.lit(" Dr ")))
    )


DIRTY_PRICE_SQL = """
    CASE WHEN l_partkey % 97 = 0 THEN 'n/a'
         WHEN l_partkey % 89 = 0 THEN NULL
         WHEN l_linenumber % 6 IN (0, 1) THEN '-' || printf('%.2f', l_extendedprice)
         ELSE printf('%.2f', l_extendedprice) END"""


def coerce_numeric(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dirty_price().alias("raw")
    )
    out = with_numeric(lines, "raw", "amount")
    return out.withColumn(
        "whole", F.col("amount").try_cast("decimal(38,18)").try_cast("bigint")
    ).drop("raw")


def coerce_dates(spark, sf_dir):
    d, form = F.col("o_orderdate"), F.col("o_orderkey") % 6
    raw = (
        F.when(form == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(form == 1, F.date_format(d, "dd/MM/yyyy"))
        .when(form == 2, F.date_format(d, "M/d/yyyy"))
        .when(form == 3, F.upper(F.date_format(d, "d-MMM-yyyy")))
        .when(form == 4, F.date_format(d, "yyyyMMdd"))
        .otherwise("soon")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return orders.select(
        "o_orderkey",
        F.coalesce(date_text(F.col("raw"), DATE_FORMATS), "raw").alias("item_date"),
        F.coalesce(date_text(F.col("raw"), DATE_FORMATS, with_time=True), "raw").alias("item_time"),
    )


def coerce_bool_varchar(spark, sf_dir):
    words = (
        F.when(F.col("event_type") == "signup", " Yes ")
        .when(F.col("event_type") == "click", "TRUE")
        .when(F.col("event_type") == "view", "0")
        .when(F.col("event_type") == "purchase", "t")
        .when(F.col("event_id") % 2 == 0, F.col("event_type"))
    )
    events = table(spark, sf_dir, "events").select(
        "event_id", words.alias("flag"),
        F.concat(F.lit(" "), text(F.col("user_id")), F.lit(".0")).alias("padded"),
        F.concat(text(F.col("user_id")), F.lit(".0")).alias("id"),
        F.when(F.col("event_id") % 2 == 0, "number").otherwise("text").alias("cell"),
    )
    return events.select(
        "event_id", boolean(F.col("flag")).alias("flag"),
        varchar_text(F.col("id"), F.col("cell")).alias("id"),
        varchar_text(F.col("padded")).alias("padded"),
    )


def money_text(spark, sf_dir):
    p = printed(F.abs("s_acctbal"))
    form = F.col("s_suppkey") % 5
    raw = (
        F.when(form == 0, F.concat(F.lit("Balance ("), p, F.lit(") due")))
        .when(form == 1, F.concat(F.lit("-"), p))
        .when(form == 2, F.concat(p, F.lit("- held")))
        .when(form == 3, F.concat(F.lit("USD "), p))
        .otherwise("no amount 12")
    )
    nan = F.when(F.col("s_suppkey") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("s_acctbal"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", raw.alias("raw"), nan.alias("x"))
    amount = to_money(first_money(F.col("raw")))
    return s.select(
        "s_suppkey", has_money(F.col("raw")).alias("has_amount"), text(amount).alias("amount"),
        sign_label(amount).alias("label"), text(money2(null_nan(F.col("x")))).alias("balance"),
    )


QUERIES = {
    "coerce_numeric": coerce_numeric,
    "coerce_dates": coerce_dates,
    "coerce_bool_varchar": coerce_bool_varchar,
    "money_text": money_text,
}

ORACLE = {
    "coerce_numeric": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, amount,
               TRY_CAST(trunc(TRY_CAST(amount AS DECIMAL(38, 2))) AS BIGINT) AS whole
        FROM (SELECT *, {DIRTY_PRICE_SQL} AS amount FROM lineitem)""",
    "coerce_dates": """
        SELECT o_orderkey, coalesce(d, 'soon') AS item_date, coalesce(d || 'T00:00:00', 'soon') AS item_time
        FROM (SELECT o_orderkey, strftime(CASE
                 WHEN o_orderkey % 6 = 5 THEN NULL
                 WHEN o_orderkey % 6 = 2 AND day(o_orderdate) <= 12
                 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
                 ELSE CAST(o_orderdate AS DATE) END, '%Y-%m-%d') AS d FROM orders)""",
    "coerce_bool_varchar": """
        SELECT event_id,
               CASE WHEN event_type IN ('signup', 'click', 'purchase') THEN true
                    WHEN event_type = 'view' OR event_id % 2 = 0 THEN false END AS flag,
               CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE user_id || '.0' END AS id,
               user_id || '.0' AS padded
        FROM events""",
    "money_text": """
        SELECT s_suppkey, s_suppkey % 5 < 4 AS has_amount,
               CAST(amount AS VARCHAR) AS amount,
               CASE WHEN amount < 0 THEN 'DR' WHEN amount IS NOT NULL THEN 'CR' END AS label,
               CASE WHEN s_suppkey % 10 > 0 THEN CAST(CAST(s_acctbal AS DECIMAL(18, 2)) AS VARCHAR) END AS balance
        FROM (SELECT *, CASE WHEN s_suppkey % 5 < 3 THEN -CAST(abs(s_acctbal) AS DECIMAL(18, 2))
                             WHEN s_suppkey % 5 = 3 THEN CAST(abs(s_acctbal) AS DECIMAL(18, 2)) END AS amount
              FROM supplier)""",
}

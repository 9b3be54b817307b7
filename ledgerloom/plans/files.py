"""Driver queries: listings, wildcards, allowed roots and formats."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import basename, extension
from ..sources.listing import resolve_paths, resolved_format
from .common import table, text


def _listing(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    folder = F.concat(F.lit("/landing/u"), text(F.col("user_id")))
    return e, e.select(
        F.concat(folder, F.lit("/"), F.col("event_type"), F.lit("_"), text(F.col("event_id")), F.lit(".csv")).alias("path"),
        F.col("ts").alias("modificationTime"), F.lit(1).cast("bigint").alias("length"),
    )


def _wildcards(events):
    u = F.col("user_id")
    folder = F.concat(F.lit("/landing/u"), text(u))
    return events.select("user_id").distinct().select(
        text(u).alias("file_seq_id"),
        F.when(u % 3 == 0, F.concat(folder, F.lit("/click_*.csv")))
        .when(u % 3 == 1, F.concat(folder, F.lit("/old.csv?")))
        .alias("path"),
        F.when(u % 6 == 2, F.lit("p[a-u]*.c?v")).alias("file_name"),
        F.when(u % 3 == 2, F.concat(folder, F.lit("/"))).alias("sub_path"),
    )


def _resolve(spark, sf_dir, pick):
    events, listing = _listing(spark, sf_dir)
    good, bad = resolve_paths(_wildcards(events), listing, pick, ("/landing",))
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


def latest_file(spark, sf_dir):
    return _resolve(spark, sf_dir, "latest")


def all_files(spark, sf_dir):
    return _resolve(spark, sf_dir, "all")


def allowed_roots(spark, sf_dir):
    """Page addresses as explicit paths, some of which climb out of the root and some of which do not exist."""
    p = table(spark, sf_dir, "pages")
    rest = F.concat(F.regexp_replace(F.regexp_replace("url", "^https?://", ""), r"[?#].*", ""), F.lit("/p"), text(F.col("page_id")))
    path = (
        F.when(F.col("page_id") % 5 == 1, F.concat(F.lit("/data/../private/"), rest))
        .when(F.col("page_id") % 5 == 2, F.concat(F.lit("/data/./x/..//"), rest))
        .otherwise(F.concat(F.lit("/data/"), rest))
    )
    asked = p.select(
        text(F.col("page_id")).alias("file_seq_id"), path.alias("path"), F.lit(None).cast("string").alias("file_name"),
        F.lit(None).cast("string").alias("sub_path"), "page_id",
    )
    listing = asked.filter("page_id % 7 > 0").select(
        "path", F.lit("2024-01-01").cast("timestamp").alias("modificationTime"), F.lit(1).cast("bigint").alias("length")
    )
    good, bad = resolve_paths(asked.drop("page_id"), listing, "all", ("/data",))
    return good.drop("file_ord").withColumn("error", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


def resolve_format(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    ends = F.get(
        F.array(*(F.lit(x) for x in (".xlsx", ".XLS", ".csv", ".txt", ".tsv", ".pdf", ".html", ""))),
        (F.col("page_id") % 8).cast("int"),
    )
    declared = F.when(F.col("page_id") % 3 == 0, "Excel").when(F.col("page_id") % 3 == 1, "Delimited")
    path = F.concat(F.lit("/data/page"), text(F.col("page_id")), ends)
    return p.select(
        "page_id", basename(path).alias("name"), extension(path).alias("ext"),
        resolved_format(path, declared, F.col("page_id") % 11 == 0).alias("format"),
    )


QUERIES = {
    "latest_file": latest_file,
    "all_files": all_files,
    "allowed_roots": allowed_roots,
    "resolve_format": resolve_format,
}

_MATCHES = """
    WITH f AS (SELECT user_id, ts, '/landing/u' || user_id || '/' || event_type || '_' || event_id || '.csv' AS path
               FROM events
               WHERE (user_id % 3 = 0 AND event_type = 'click') OR (user_id % 6 = 2 AND event_type = 'purchase')
                  OR user_id % 6 = 5),
         u AS (SELECT DISTINCT user_id FROM events)"""
_NO_MATCH = """
    SELECT CAST(u.user_id AS VARCHAR) AS file_seq_id, CAST(NULL AS INTEGER) AS file_ord, CAST(NULL AS VARCHAR) AS path,
           'no file matches /landing/u' || u.user_id || '/'
               || CASE u.user_id % 3 WHEN 0 THEN 'click_*.csv' WHEN 1 THEN 'old.csv?' ELSE 'p[a-u]*.c?v' END AS error
    FROM u WHERE u.user_id NOT IN (SELECT user_id FROM f)"""

ORACLE = {
    "latest_file": f"""
        {_MATCHES}
        SELECT CAST(user_id AS VARCHAR) AS file_seq_id, 0 AS file_ord, arg_max(path, (ts, path)) AS path,
               CAST(NULL AS VARCHAR) AS error FROM f GROUP BY user_id
        UNION ALL {_NO_MATCH}""",
    "all_files": f"""
        {_MATCHES}
        SELECT CAST(user_id AS VARCHAR) AS file_seq_id,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, path) - 1 AS INTEGER) AS file_ord,
               path, CAST(NULL AS VARCHAR) AS error FROM f
        UNION ALL {_NO_MATCH}""",
    "allowed_roots": """
        WITH p AS (SELECT page_id,
                          regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*', '') || '/p' || page_id AS rest
                   FROM pages),
             q AS (SELECT *, CASE page_id % 5 WHEN 1 THEN '/data/../private/' || rest
                                              WHEN 2 THEN '/data/./x/..//' || rest ELSE '/data/' || rest END AS path
                   FROM p)
        SELECT CAST(page_id AS VARCHAR) AS file_seq_id,
               CASE WHEN page_id % 5 <> 1 AND page_id % 7 > 0
                    THEN '/data/' || regexp_replace(rest, '/+', '/', 'g') END AS path,
               CASE WHEN page_id % 5 = 1 THEN 'path ' || path || ' outside allowed roots'
                    WHEN page_id % 7 = 0 THEN 'file not found: ' || path END AS error
        FROM q""",
    "resolve_format": """
        WITH p AS (SELECT page_id, page_id % 8 AS k, 'page' || page_id
                       || ['.xlsx', '.XLS', '.csv', '.txt', '.tsv', '.pdf', '.html', ''][page_id % 8 + 1] AS name
                   FROM pages)
        SELECT page_id, name, CASE WHEN k = 7 THEN '/data/' || name ELSE lower(split_part(name, '.', -1)) END AS ext,
               CASE WHEN page_id % 11 = 0 THEN 'superset' WHEN k < 2 THEN 'excel' WHEN k < 5 THEN 'csv'
                    WHEN k = 5 THEN 'pdf' WHEN page_id % 3 = 0 THEN 'excel' WHEN page_id % 3 = 1 THEN 'csv' END AS format
        FROM p""",
}

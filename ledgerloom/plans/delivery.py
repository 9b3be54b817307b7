"""Driver queries: request messages, routing, ledger, batches and the request stream."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import shared_dir
from ..sinks import tables as store
from ..streaming import requests as R
from .common import money2, table, text


def _messages(spark, sf_dir):
    """One message per event: objects, arrays, other types, broken JSON, replays of a key."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    kind = F.col("event_id") % 10

    def obj(*pairs):
        return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))

    def string(key, value):
        return F.concat(F.lit(f'"{key}":"'), value, F.lit('"'))

    ending = F.when(F.col("event_type") == "click", ".PDF").when(F.col("event_type") == "view", ".xlsx").otherwise(".csv")
    path = F.concat(F.lit("/inbox/u"), text(F.col("user_id")), ending)
    template = F.when(F.col("event_id") % 4 == 0, " schwab ").when(F.col("event_id") % 4 == 1, "").when(
        F.col("event_id") % 4 == 2, "NT"
    ).otherwise("HSBC")
    whole = obj(
        string("fileSeqId", F.concat(F.lit("J"), text(F.col("user_id")))), string("path", path),
        string("pdfTemplate", template), F.concat(F.lit('"eventSeqId":'), text(F.col("event_id"))),
        F.when(F.col("user_id") % 9 == 0, '"isSourceReprocess":true'),
    )
    by_name = obj(F.lit('"fileSeqId":null'), F.lit('"fileImportDetails":{"fileName":"a.pdf"}'), F.lit('"path":""'))
    other = obj(F.lit('"hello":"world"'), F.lit('"path":""'), F.lit('"superset":{}'))
    value = (
        F.when(kind == 1, F.concat(F.lit("["), whole, F.lit(", "), other, F.lit("]")))
        .when(kind == 2, F.concat(F.lit("["), whole, F.lit(", 5]")))
        .when(kind == 3, '{"a":')
        .when(kind == 4, "42")
        .when(kind == 5, by_name)
        .when(kind == 6, "[]")
        .otherwise(whole)
    )
    return e.select(F.col("event_id").alias("offset"), value.alias("value"))


def split_messages(spark, sf_dir):
    items, dead = R.split_messages(_messages(spark, sf_dir))
    return items.select(
        "offset", "item_no", R.text_field(F.col("item"), "fileSeqId").alias("file_seq_id"),
        F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("original"),
    ).unionByName(dead.select("offset", "error", "original"), allowMissingColumns=True)


def route_requests(spark, sf_dir):
    items, _ = R.split_messages(_messages(spark, sf_dir))
    routed = R.route(items)
    return routed.select(
        "offset", "item_no", "route", "is_pdf", "profile", "is_reprocess",
        "error", R.is_retryable(F.col("error")).alias("retryable"),
        F.substring("file_seq_id", 1, 5).alias("key_start"), F.length("file_seq_id").alias("key_length"),
    )


def result_messages(spark, sf_dir):
    items, _ = R.split_messages(_messages(spark, sf_dir))
    routed = R.route(items).filter("route = 'process' and path is not null and path <> ''")
    message = R.result_message(F.col("item"), F.col("is_pdf"), F.col("path"), R.output_path_of(F.col("path")))
    return routed.select("offset", "item_no", message.alias("m")).select(
        "offset", "item_no",
        *(F.get_json_object("m", f"$.{n}").alias(n) for n in ("path", "pdfFilePath", "isPdfProcessorMessage", "fileSeqId", "eventSeqId")),
    )


def _ledger(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "purchase", "COMPLETED").when(F.col("event_type") == "error", "FAILED").otherwise(
        "PROCESSING"
    )
    return e.select(
        text(F.col("user_id")).alias("file_seq_id"), F.concat(F.lit("run"), text(F.col("event_id") % 3)).alias("run_id"),
        status.alias("status"), F.col("ts").alias("event_ts"), F.lit(1).alias("step"),
        F.col("event_id").alias("total_records"),
    )


def job_state(spark, sf_dir):
    jobs = store.latest_jobs(_ledger(spark, sf_dir))
    return jobs.select(
        "file_seq_id", "status", "run_id", "total_records",
        *(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("created_at", "started_at")),
    )


def claim_jobs(spark, sf_dir):
    requests = table(spark, sf_dir, "events").select(
        text(F.col("user_id") + F.col("event_id") % 2 * 5).alias("file_seq_id"), F.col("event_id").alias("msg_ord"),
        (F.col("event_id") % 50 == 0).alias("is_reprocess"),
    )
    return store.claim(requests, store.latest_jobs(_ledger(spark, sf_dir)))


def get_batch(spark, sf_dir):
    """Batches of the run each job currently points to; a replaced run's batches are not seen."""
    e = table(spark, sf_dir, "events")
    batches = e.select(
        text(F.col("user_id")).alias("file_seq_id"), F.concat(F.lit("run"), text(F.col("event_id") % 3)).alias("run_id"),
        (F.col("event_id") % 7 + 1).cast("int").alias("batch_no"), "event_id",
    )
    jobs = store.latest_jobs(_ledger(spark, sf_dir))
    current = store.current_batches(batches, jobs)
    return current.groupBy("file_seq_id", "run_id", "batch_no").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event")
    )


def stream_requests(spark, sf_dir):
    """The messages through a file stream in several micro-batches; the result is the state of the jobs.

    The file of a request holds the purchases of its user, ten to a batch.
    """
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    R.enqueue(_messages(spark, sf_dir).repartitionByRange(4, "offset"), f"{base}/in")
    bought = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(
        F.concat(F.lit("J"), text(F.col("user_id"))).alias("file_seq_id"), F.lit(0).alias("file_ord"),
        F.lit(0).alias("table_no"), F.col("event_id").alias("src_row"),
        F.create_map(F.lit("value"), text(money2(F.col("value")))).alias("record"),
    )

    def records_of(claimed):
        rows = claimed.select("file_seq_id").join(bought, "file_seq_id", "left")
        locked = F.col("file_seq_id").endswith("3")  # these files cannot be read
        return rows.filter(F.col("src_row").isNotNull() | locked).withColumn(
            "error", F.when(locked, "RuntimeError: file is locked")
        )

    query = R.run_stream(R.read_folder(spark, f"{base}/in", max_files=2), f"{base}/out", records_of, batch_size=10)
    query.awaitTermination()
    jobs = store.latest_jobs(store.read_table(spark, f"{base}/out", "ledger", store.LEDGER_SCHEMA))
    batches = store.current_batches(store.read_table(spark, f"{base}/out", "batches", store.BATCH_SCHEMA), jobs)
    stored = batches.groupBy("file_seq_id").agg(
        F.count(F.lit(1)).alias("stored_batches"), F.sum("record_count").alias("stored_records")
    )
    return (
        jobs.filter("file_seq_id like 'J%'")
        .join(stored, "file_seq_id", "left")
        .select(
            "file_seq_id", "status", "stored_batches", "stored_records",
            F.nullif("total_records", F.lit(0)).alias("total_records"),
        )
    )


QUERIES = {
    "split_messages": split_messages,
    "route_requests": route_requests,
    "result_messages": result_messages,
    "job_state": job_state,
    "claim_jobs": claim_jobs,
    "get_batch": get_batch,
    "stream_requests": stream_requests,
}

_KEY = "'J' || user_id"
_PATH = """'/inbox/u' || user_id || CASE event_type WHEN 'click' THEN '.PDF' WHEN 'view' THEN '.xlsx' ELSE '.csv' END"""
_ITEMS = f"""
    i AS (SELECT event_id AS "offset", 0 AS item_no, event_id % 10 AS kind, *, event_type = 'click' OR event_id % 10 = 5 AS pdf,
                 {_PATH} AS path FROM events WHERE event_id % 10 NOT IN (2, 3, 4, 6))"""
_JOBS = """
    led AS (SELECT CAST(user_id AS VARCHAR) AS file_seq_id, 'run' || (event_id % 3) AS run_id, ts, event_id,
                   CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED' ELSE 'PROCESSING' END AS status
            FROM events),
    jobs AS (SELECT file_seq_id, arg_max(status, ts) AS status, arg_max(run_id, ts) AS run_id, arg_max(event_id, ts) AS total_records,
                    min(ts) AS created_at, max(ts) FILTER (status = 'PROCESSING') AS started_at FROM led GROUP BY 1)"""
_MESSAGE = f"""
    '{{"fileSeqId":"J' || user_id || '","path":"' || {_PATH} || '","pdfTemplate":"'
    || CASE event_id % 4 WHEN 0 THEN ' schwab ' WHEN 1 THEN '' WHEN 2 THEN 'NT' ELSE 'HSBC' END
    || '","eventSeqId":' || event_id || CASE WHEN user_id % 9 = 0 THEN ',"isSourceReprocess":true' ELSE '' END || '}}'"""

ORACLE = {
    "split_messages": f"""
        WITH {_ITEMS}
        SELECT "offset", CAST(item_no AS INTEGER) AS item_no, CASE WHEN kind <> 5 THEN {_KEY} END AS file_seq_id,
               CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS original FROM i
        UNION ALL SELECT "offset", 1, NULL, NULL, NULL FROM i WHERE kind = 1
        UNION ALL SELECT event_id, NULL, NULL, CASE WHEN event_id % 10 = 3 THEN 'message is not valid JSON'
                                                   ELSE 'neither an object nor a list of objects' END,
               CASE event_id % 10 WHEN 2 THEN '[' || {_MESSAGE} || ', 5]' WHEN 3 THEN '{{"a":' ELSE '42' END
        FROM events WHERE event_id % 10 IN (2, 3, 4)""",
    "route_requests": f"""
        WITH {_ITEMS}, j AS (SELECT *, pdf AND kind <> 5 AND event_id % 4 = 3 AS bad FROM i)
        SELECT "offset", CAST(item_no AS INTEGER) AS item_no, CASE WHEN bad THEN 'dead' ELSE 'process' END AS route,
               pdf AS is_pdf, CASE WHEN pdf AND NOT bad THEN CASE WHEN kind <> 5 AND event_id % 4 = 0 THEN 'charles_schwab'
                                                                  ELSE 'northern_trust_daily' END END AS profile,
               kind <> 5 AND user_id % 9 = 0 AS is_reprocess,
               CASE WHEN bad THEN 'ValueError: no profile for template ''HSBC''; there are [''CHARLES_SCHWAB'', ''NORTHERN_TRUST'', ''NT'', ''SCHWAB'']' END AS error,
               CASE WHEN bad THEN false END AS retryable,
               CASE WHEN kind = 5 THEN 'AUTO-' ELSE left({_KEY}, 5) END AS key_start,
               CAST(CASE WHEN kind = 5 THEN 21 ELSE length({_KEY}) END AS INTEGER) AS key_length FROM j
        UNION ALL SELECT "offset", 1, 'skip', false, NULL, false, NULL, NULL, 'AUTO-', 21 FROM i WHERE kind = 1""",
    "result_messages": f"""
        WITH {_ITEMS}
        SELECT "offset", CAST(item_no AS INTEGER) AS item_no, regexp_replace(path, '\\.[a-zA-Z]+$', '.json') AS path,
               CASE WHEN pdf THEN i.path END AS "pdfFilePath", CASE WHEN pdf THEN 'true' END AS "isPdfProcessorMessage",
               {_KEY} AS "fileSeqId", CAST(event_id AS VARCHAR) AS "eventSeqId"
        FROM i WHERE kind <> 5 AND NOT (pdf AND event_id % 4 = 3)""",
    "job_state": f"""
        WITH {_JOBS}
        SELECT file_seq_id, status, run_id, total_records, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
               strftime(started_at, '%Y-%m-%d %H:%M:%S.%f') AS started_at FROM jobs""",
    "claim_jobs": f"""
        WITH {_JOBS},
        r AS (SELECT CAST(user_id + event_id % 2 * 5 AS VARCHAR) AS file_seq_id, event_id AS msg_ord, event_id % 50 = 0 AS again
              FROM events),
        one AS (SELECT file_seq_id, coalesce(max(msg_ord) FILTER (again), min(msg_ord)) AS msg_ord, bool_or(again) AS is_reprocess
                FROM r GROUP BY 1)
        SELECT one.file_seq_id, msg_ord, is_reprocess FROM one LEFT JOIN jobs USING (file_seq_id)
        WHERE is_reprocess OR coalesce(status, '') <> 'COMPLETED'""",
    "get_batch": f"""
        WITH {_JOBS}
        SELECT led.file_seq_id, run_id, CAST(event_id % 7 + 1 AS INTEGER) AS batch_no, count(*) AS n, max(event_id) AS last_event
        FROM led JOIN jobs USING (file_seq_id, run_id) GROUP BY ALL""",
    "stream_requests": """
        WITH m AS (SELECT user_id, bool_or(event_type <> 'click' OR event_id % 4 <> 3) AS good FROM events
                   WHERE event_id % 10 IN (0, 1, 7, 8, 9) GROUP BY 1),
             p AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1),
             j AS (SELECT m.user_id, good AND m.user_id % 10 <> 3 AS done, CASE WHEN good AND m.user_id % 10 <> 3 THEN n END AS n
                   FROM m LEFT JOIN p USING (user_id))
        SELECT 'J' || user_id AS file_seq_id, CASE WHEN done THEN 'COMPLETED' ELSE 'FAILED' END AS status,
               CAST(ceil(n / 10) AS BIGINT) AS stored_batches, n AS stored_records, n AS total_records
        FROM j""",
}

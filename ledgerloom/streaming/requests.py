"""Request messages: split, filter, route, process once, publish results and dead letters.

All message logic is stateless column work; the only state is the ledger. A micro-batch first writes the jobs it has
claimed as PROCESSING, then its batches, results and dead letters, and last all its ledger events, each to a folder
of the epoch, so re-delivery and repeated epochs change nothing.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import generated_id, run_id
from ..operators.batches import build_batches
from ..session import cut
from ..sinks import tables as store
from ..sources.listing import resolved_format
from ..sources.profiles import PROFILE_BY_TEMPLATE, profile_of_template

# Keys that make a message a parse request, and JSON texts that count as empty.
REQUEST_KEYS = ("path", "fileName", "superset", "fileImportDetails")
EMPTY_JSON = ("null", '""', "false", "[]", "{}")
NOT_RETRYABLE = ("FileResolutionError", "ValueError")


def field(item: Column, name: str) -> Column:
    """JSON text of a field (quotes kept), null when missing."""
    return F.to_json(F.try_variant_get(item, f"$.{name}", "variant"))


def text_field(item: Column, name: str) -> Column:
    """A string field (null when missing or null)."""
    return F.try_variant_get(item, f"$.{name}", "string")


def truthy(json_text: Column) -> Column:
    return F.coalesce(
        ~json_text.isin(*EMPTY_JSON) & ~json_text.rlike(r"^-?0+(\.0*)?([eE].*)?$"), F.lit(False)
    )


def split_messages(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(items with ``item_no`` and ``item VARIANT``, dead letters of invalid messages).

    A message holds one JSON object or an array of them; anything else, and an array with any other element,
    rejects the whole message.
    """
    judged = judge_messages(messages, value)
    split = judged.filter(F.col("__good") & F.col("item").isNotNull()).select(*messages.columns, "item_no", "item")
    return split, invalid_messages(judged, messages, value)


def judge_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Items of good messages and a row for every other, parsed once: ``item_no, item``, ``__good``, ``__json``."""
    parsed = messages.withColumn("__v", F.try_parse_json(value))
    shape = F.schema_of_variant("__v")
    items = F.when(shape.startswith("ARRAY"), F.try_variant_get("__v", "$", "array<variant>")).when(
        F.col("__v").isNotNull(), F.array("__v")
    )
    listed = parsed.withColumn("__items", items)
    good = F.col("__items").isNotNull() & F.forall(
        "__items", lambda i: F.coalesce(F.schema_of_variant(i).startswith("OBJECT"), F.lit(False))
    )
    judged = listed.withColumn("__good", F.coalesce(good, F.lit(False)))
    return judged.select(
        *messages.columns, "__good", F.col("__v").isNotNull().alias("__json"),
        F.posexplode_outer(F.when(F.col("__good"), F.col("__items"))).alias("item_no", "item"),
    )


def invalid_messages(judged: DataFrame, messages: DataFrame, value: str = "value") -> DataFrame:
    """Dead letters of the messages that were not good."""
    return judged.filter(~F.col("__good")).select(
        *(c for c in messages.columns if c != value),
        F.when(~F.col("__json"), "message is not valid JSON").otherwise("neither an object nor a list of objects").alias("error"),
        F.lit(False).alias("retryable"),
        F.col(value).alias("original"),
    )


def is_parse_request(item: Column) -> Column:
    hit = F.lit(False)
    for key in REQUEST_KEYS:
        hit = hit | truthy(field(item, key))
    return hit


def is_pdf_request(item: Column) -> Column:
    """Any of the three file names is a string ending in ``.pdf``."""
    hit = F.lit(False)
    for name in ("path", "fileName", "fileImportDetails.fileName"):
        hit = hit | F.coalesce(field(item, name).rlike(r'(?i)^"(?s:.*)\.pdf"$'), F.lit(False))
    return hit


def route(items: DataFrame) -> DataFrame:
    """Add ``route`` (``process``, ``skip`` or ``dead``), ``is_pdf``, ``profile``, ``error`` and the request fields."""
    item = F.col("item")
    template = F.when(truthy(field(item, "pdfTemplate")), text_field(item, "pdfTemplate"))
    out = items.withColumns(
        {
            "is_request": is_parse_request(item),
            "is_pdf": is_pdf_request(item),
            "template": F.upper(F.trim(F.coalesce(template, F.lit("")))),
            "path": text_field(item, "path"),
            "file_seq_id": F.coalesce(
                F.nullif(text_field(item, "fileSeqId"), F.lit("")), generated_id(F.to_json(item))
            ),
            "is_reprocess": truthy(field(item, "isSourceReprocess")),
            "recon_id": text_field(item, "reconId"),
            "event_id": text_field(item, "eventId"),
            "source_name": F.coalesce(text_field(item, "sourceName"), text_field(item, "source")),
        }
    )
    profile = F.when(F.col("is_pdf"), profile_of_template(F.col("template")))
    known = ", ".join(f"'{t}'" for t in sorted(PROFILE_BY_TEMPLATE))
    return out.withColumn("profile", profile).withColumns(
        {
            "route": F.when(~F.col("is_request"), "skip")
            .when(F.col("is_pdf") & F.col("profile").isNull(), "dead")
            .otherwise("process"),
            "error": F.when(
                F.col("is_request") & F.col("is_pdf") & F.col("profile").isNull(),
                F.concat(
                    F.lit("ValueError: no profile for template '"), F.col("template"),
                    F.lit(f"'; there are [{known}]"),
                ),
            ),
        }
    )


def is_retryable(error: Column) -> Column:
    """Errors of file resolution and of values would fail again; anything else may be retried."""
    kind = F.regexp_extract(error, r"^(\w+)", 1)
    return ~kind.isin(*NOT_RETRYABLE)


def dead_letters(routed: DataFrame, dead_letter_skipped: bool = False) -> DataFrame:
    """Dead letters of items that failed, and of skipped ones when asked for."""
    failed = F.col("error").isNotNull()
    skip = (F.col("route") == "skip") if dead_letter_skipped else F.lit(False)
    message = F.coalesce(
        "error", F.lit("names nothing to parse")
    )
    return routed.filter(failed | skip).select(
        "file_seq_id",
        message.alias("error"),
        (failed & F.coalesce(is_retryable(F.col("error")), F.lit(False))).alias("retryable"),
        F.to_json("item").alias("original"),
    )


def result_message(item: Column, is_pdf: Column, source_path: Column, output_path: Column) -> Column:
    """The original request with the new path; a PDF request also says where its source was."""
    fields = F.variant_get(item, "$", "map<string,variant>")

    def js(c):
        return F.parse_json(F.coalesce(F.to_json(F.struct(c.alias("v"))), F.lit("{}")))

    def value(c):
        return F.variant_get(js(c), "$.v", "variant")

    moved = F.create_map(F.lit("path"), value(output_path))
    as_pdf = F.map_concat(
        moved,
        F.create_map(
            F.lit("isPdfProcessorMessage"), F.parse_json(F.lit("true")),
            F.lit("pdfFilePath"), F.coalesce(value(source_path), F.parse_json(F.lit("null"))),
        ),
    )
    none = F.create_map().cast("map<string,variant>")
    changes = F.when(is_pdf, as_pdf).when(output_path.isNotNull(), moved).otherwise(none)
    kept = F.map_filter(fields, lambda k, _: ~F.map_contains_key(changes, k))
    return F.to_json(F.map_concat(kept, changes))


def output_path_of(path: Column) -> Column:
    """Where the record file of a source goes: the same name with ``.json``."""
    return F.concat(F.regexp_replace(path, r"\.[^./]+$", ""), F.lit(".json"))


def _parsed(claimed: DataFrame, records_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The records of all claimed requests; if that fails, request by request, so that one cannot fail the others."""
    try:
        return cut(records_of(claimed))
    except Exception:  # noqa: BLE001  whatever a parser raises becomes the error of its request
        spark = claimed.sparkSession
        out = spark.createDataFrame([], "file_seq_id string, file_ord int, table_no int, src_row bigint, error string")
        for row in claimed.select("file_seq_id").collect():  # the requests of one micro-batch
            try:
                part = cut(records_of(claimed.filter(F.col("file_seq_id") == row["file_seq_id"])))
            except Exception as e:  # noqa: BLE001
                said = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else 'no reason given'}"
                part = spark.createDataFrame([(row["file_seq_id"], said)], "file_seq_id string, error string")
            out = out.unionByName(part, allowMissingColumns=True)
        return out if "record" in out.columns else out.withColumn("record", F.lit(None).cast("string"))


def _event(spark: SparkSession, batch_size: int) -> dict[str, Column]:
    """What every ledger event of a step says; the time is taken once per step."""
    now = F.lit(spark.sql("select current_timestamp() t").first()["t"])
    declared = F.get_json_object("request", "$.fileImportDetails.format")
    return {
        "event_ts": now, "rule_id": F.get_json_object("request", "$.ruleId"), "engine": F.lit("spark"),
        "source_type": F.coalesce(resolved_format(F.col("path"), declared), F.when(F.col("is_pdf"), "pdf")), "file_path": F.col("path"),
        "batch_size": F.lit(batch_size), "warning_count": F.lit(0).cast("bigint"),
    }


def process_epoch(
    messages: DataFrame,
    epoch: int,
    base: str,
    records_of: Callable[[DataFrame], DataFrame],
    batch_size: int = 1000,
    dead_letter_skipped: bool = False,
) -> None:
    """Process one micro-batch of ``messages(value, offset)``, with ``partition`` where the topic has several.

    ``records_of(requests)`` parses the claimed requests: records ``(file_seq_id, file_ord, table_no, src_row,
    record, error)``, where a row with an ``error`` fails its own request and no other.
    """
    spark = messages.sparkSession
    # parsed and written once, with the messages that hold no items
    judged = judge_messages(messages)
    place = F.struct(*(F.col(c) for c in ("partition", "offset") if c in messages.columns)).alias("message")
    judged = cut(route(judged).withColumn("msg_ord", F.struct(place, "item_no")))
    routed = judged.filter(F.col("__good") & F.col("item").isNotNull())
    invalid = invalid_messages(judged, messages)
    jobs = store.latest_jobs(store.read_table(spark, base, "ledger", store.LEDGER_SCHEMA, before_epoch=epoch))
    asked = routed.filter(F.col("route") == "process")
    # claimed once: the ledger must not be read again after this epoch has written to it
    claimed = cut(
        store.claim(
            asked.select(
                "file_seq_id", "msg_ord", "is_reprocess", "path", "is_pdf", "profile", "recon_id", "event_id",
                "source_name", F.to_json("item").alias("request"),
            ),
            jobs,
        ).withColumn("run_id", run_id(F.col("request"), F.lit(epoch)))
    )
    names = [f.name for f in store.read_table(spark, base, "none", store.LEDGER_SCHEMA).schema if f.name != "epoch"]
    nothing = {
        "total_records": F.lit(0).cast("bigint"), "total_batches": F.lit(0),
    }
    started = cut(claimed.withColumns(
        {**_event(spark, batch_size), **nothing, "step": F.lit(1), "status": F.lit("PROCESSING"), "error": F.lit(None).cast("string")}
    ).select(*names))
    store.write_epoch(started, base, "ledger", epoch)  # seen while the work goes on; replaced below
    records = _parsed(claimed, records_of)
    failed = records.filter(F.col("error").isNotNull()).groupBy("file_seq_id").agg(F.min("error").alias("error"))
    good = records.join(failed, "file_seq_id", "left_anti").drop("error")
    batches = (
        build_batches(good, batch_size)
        .join(claimed.select("file_seq_id", "run_id"), "file_seq_id")
        .select("file_seq_id", "run_id", "batch_no", "record_count", "first_row", "records")
    )
    store.write_epoch(batches, base, "batches", epoch)
    written = spark.read.parquet(f"{base}/batches/epoch={epoch}")
    totals = written.groupBy("file_seq_id").agg(
        F.sum("record_count").alias("total_records"), F.max("batch_no").alias("total_batches")
    )
    outcome = (
        claimed.join(failed, "file_seq_id", "left")
        .join(totals, "file_seq_id", "left")
        .withColumn("status", F.when(F.col("error").isNull(), "COMPLETED").otherwise("FAILED"))
    )
    outcome = cut(outcome)
    # items answered now: claimed ones that completed, and re-deliveries of jobs completed before
    done = outcome.filter("status = 'COMPLETED'").select("file_seq_id").union(
        jobs.filter("status = 'COMPLETED'").select("file_seq_id")
    ).distinct()
    answered = asked.join(done, "file_seq_id", "left_semi")
    store.write_epoch(
        answered.select(
            "file_seq_id",
            result_message(
                F.col("item"), F.col("is_pdf"), F.col("path"),
                F.when(F.col("path").isNotNull(), output_path_of(F.col("path"))),
            ).alias("value"),
        ),
        base, "results", epoch,
    )
    broken = asked.join(failed, "file_seq_id").drop(asked["error"])
    letters = (
        dead_letters(routed, dead_letter_skipped)
        .unionByName(dead_letters(broken))
        .unionByName(invalid.withColumn("file_seq_id", F.lit(None).cast("string")).select(
            "file_seq_id", "error", "retryable", "original"))
    )
    store.write_epoch(letters, base, "dead_letters", epoch)
    event = _event(spark, batch_size)
    finished = outcome.withColumns({**event, "step": F.lit(2)})
    # a rejected request makes a FAILED job only for a key that has no job; it never hides an earlier result
    known_keys = jobs.select("file_seq_id").union(claimed.select("file_seq_id")).distinct()
    refused = routed.filter(F.col("route") == "dead").join(known_keys, "file_seq_id", "left_anti")
    rejected = refused.dropDuplicates(["file_seq_id"]).withColumn("request", F.to_json("item")).withColumns(
        {
            **event, **nothing, "step": F.lit(2), "status": F.lit("FAILED"),
            "run_id": run_id(F.to_json("item"), F.lit(epoch)),
        }
    )
    ledger = started.unionByName(finished.select(*names)).unionByName(rejected.select(*names))
    store.write_epoch(ledger, base, "ledger", epoch)


def read_kafka(spark: SparkSession, servers: str, topic: str, max_offsets: int = 100_000) -> DataFrame:
    """Request stream from a topic (needs the Kafka connector on the class path)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select(F.col("value").cast("string").alias("value"), F.col("partition"), F.col("offset"))
    )


def read_folder(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Request stream from JSON-lines files ``{"offset": n, "value": "<message>"}``."""
    return (
        spark.readStream.schema("offset bigint, value string").option("maxFilesPerTrigger", max_files).json(path)
    )


def enqueue(requests: DataFrame, path: str) -> None:
    """Append requests ``(offset, value)`` to the request folder."""
    requests.select("offset", "value").write.mode("append").json(path)


def run_stream(
    stream: DataFrame, base: str, records_of: Callable[[DataFrame], DataFrame], batch_size: int = 1000,
    dead_letter_skipped: bool = False, available_now: bool = True,
):
    """Start the request stream; outputs of an epoch are complete before its offsets are committed."""
    writer = stream.writeStream.foreachBatch(
        lambda df, epoch: process_epoch(df, epoch, base, records_of, batch_size, dead_letter_skipped)
    ).option("checkpointLocation", f"{base}/_offsets")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")).start()

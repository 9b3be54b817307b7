"""Batch table, job ledger, record files and messages on plain files: append-only, safe to repeat.

Every write of one micro-batch goes to its own ``epoch=<n>`` folder in overwrite mode, so a repeated epoch
replaces itself. Batches carry the ``run_id`` of the run that wrote them; the ledger, written last, names the
current run, and readers join the two. A re-run that yields fewer (or no) batches thus hides the old ones.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

LEDGER_SCHEMA = """file_seq_id string, run_id string, status string, event_ts timestamp, step int,
    event_id string, recon_id string, rule_id string, source_name string, source_type string, file_path string,
    engine string, batch_size int, total_records bigint, total_batches int, warning_count bigint,
    error string, request string"""
BATCH_SCHEMA = """file_seq_id string, run_id string, batch_no int, record_count int, first_row bigint,
    records array<string>"""
# Fields that the record file leaves out.
NOT_IN_RECORD_FILE = ("_raw", "batch_id", "sourcetype", "bloc_recon_file_name", "functionofmessage")


def write_epoch(df: DataFrame, base: str, table: str, epoch: int) -> None:
    df.write.mode("overwrite").parquet(f"{base}/{table}/epoch={epoch}")


def read_table(spark: SparkSession, base: str, table: str, schema: str, before_epoch: int | None = None) -> DataFrame:
    """All epochs of a table (those before ``before_epoch``), empty when nothing was written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{table}")
    exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    if not exists:
        return spark.createDataFrame([], schema + ", epoch int")
    out = spark.read.schema(schema + ", epoch int").parquet(f"{base}/{table}")
    return out if before_epoch is None else out.filter(F.col("epoch") < before_epoch)


def latest_jobs(ledger: DataFrame) -> DataFrame:
    """Current state per job: the latest event. Aggregated map-side, so a hot job costs nothing extra."""
    rest = [c for c in ledger.columns if c not in ("file_seq_id",)]
    return (
        ledger.groupBy("file_seq_id")
        .agg(
            F.max_by(F.struct(*rest), F.struct("event_ts", "step")).alias("j"),
            F.min("event_ts").alias("created_at"),
            F.max(F.when(F.col("status") == "PROCESSING", F.col("event_ts"))).alias("started_at"),
        )
        .select("file_seq_id", "j.*", "created_at", "started_at")
    )


def claim(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """Requests to be processed: one per key, none whose job is COMPLETED unless it asks for a re-run.

    ``requests(file_seq_id, msg_ord, is_reprocess, ...)``: among several requests of one key the last re-run
    wins, else the first.
    """
    rest = [c for c in requests.columns if c != "file_seq_id"]
    again = F.coalesce("is_reprocess", F.lit(False))
    row = F.struct(*rest)
    last_again = F.max_by(row, F.when(again, F.col("msg_ord")))
    one = requests.groupBy("file_seq_id").agg(F.coalesce(last_again, F.min_by(row, "msg_ord")).alias("r")).select("file_seq_id", "r.*")
    done = jobs.filter(F.col("status") == "COMPLETED").select("file_seq_id", F.lit(True).alias("__done"))
    return (
        one.join(done, "file_seq_id", "left")
        .filter(F.col("__done").isNull() | F.coalesce("is_reprocess", F.lit(False)))
        .drop("__done")
    )


def skipped(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """Requests whose job is already COMPLETED."""
    done = jobs.filter(F.col("status") == "COMPLETED").select("file_seq_id")
    return requests.filter(~F.coalesce("is_reprocess", F.lit(False))).join(done, "file_seq_id", "left_semi")


def current_batches(batches: DataFrame, jobs: DataFrame) -> DataFrame:
    """Batches of the run each job currently points to."""
    return batches.join(jobs.select("file_seq_id", "run_id"), ["file_seq_id", "run_id"], "left_semi")


def get_job(jobs: DataFrame, file_seq_id: str) -> DataFrame:
    return jobs.filter(F.col("file_seq_id") == file_seq_id)


def get_batch(batches: DataFrame, jobs: DataFrame, file_seq_id: str, batch_no: int) -> DataFrame:
    wanted = batches.filter((F.col("file_seq_id") == file_seq_id) & (F.col("batch_no") == batch_no))
    return current_batches(wanted, get_job(jobs, file_seq_id))


def record_columns(columns: list[str]) -> list[str]:
    """Column order of the record file: ``_row`` first, internal fields left out."""
    return [c for c in columns if c == "_row"] + [
        c for c in columns if c != "_row" and c not in NOT_IN_RECORD_FILE
    ]


def record_json(records: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` plus ``json``: one JSON text per record, nulls kept."""
    names = record_columns([c for c in records.columns if c not in keys])
    return records.select(*keys, F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("json"))


def write_record_files(records: DataFrame, keys: list[str], path: str) -> None:
    """JSON lines per request, published by the committer only when the whole job succeeds."""
    lines = record_json(records, keys).withColumnRenamed("json", "value")
    lines.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).text(path)


def write_batch_files(batches: DataFrame, jobs: DataFrame, path: str) -> None:
    """Batches as JSON under ``batches/`` and job rows under ``jobs/``; the folder is replaced as a whole."""
    batches.write.mode("overwrite").partitionBy("file_seq_id").json(f"{path}/batches")
    jobs.write.mode("overwrite").json(f"{path}/jobs")

"""Session helpers: checkpoint location, lineage cuts and work tables."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and work tables.

    A cluster names it in ``spark.checkpoint.dir``. A scratch folder is made only where that is unset and the
    session is a local one, as in tests; on a cluster an unset folder is an error, since a folder of one machine
    is of no use to the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that later passes do not recompute earlier ones."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a work table in the shared folder and read it back.

    For a frame with many readers: each then scans only the columns it needs, and lost executors re-read
    files instead of repeating the work. Work tables stay until the shared folder is cleaned.
    """
    path = f"{shared_dir(df.sparkSession)}/work/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def folding(spark: SparkSession) -> Iterator[None]:
    """In here, Spark folds groups in one pass over rows that are sorted by their keys in their partitions already.

    Without that it groups such rows twice, in hash maps that it gives up after a few groups, before and after an exchange
    that is not there.
    """
    name = "spark.sql.execution.replaceHashWithSortAgg"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df: DataFrame) -> DataFrame:
    """Spread an input of few scan partitions over all cores before row-wise work.

    A large input has at least as many scan partitions as cores and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the queries are written for.

    Generated methods above 8,000 bytes are never compiled by the JVM; with this limit Spark splits such
    projections into small functions instead. Expressions here are wide but cheap, so it matters.
    Shuffle files go when their execution is done, as work tables take its result.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark

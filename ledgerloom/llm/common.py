"""Shared parts of the text operators: Arrow batches, work tables and input columns."""
from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_dir

#: The folder that holds this package. Python workers look there too; on a cluster the package is installed or sent along.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows and bytes of one Arrow batch handed to a Python worker: a worker holds a few of them, whatever the texts' sizes.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a frame with several readers, or whose rows must stay as they are: lost executors re-read the files.
    """
    path = f"{shared_dir(df.sparkSession)}/work/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded in rows and bytes."""
    conf = df.sparkSession.conf
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(function, schema)


def pick(df: DataFrame, *names: str, **renamed: Column) -> DataFrame:
    """Only the named columns and expressions: further columns of the input, whatever their names, do not go along."""
    return df.select(*(F.col(f"`{n}`").alias(n) for n in names), *(c.alias(n) for n, c in renamed.items()))


def crc_part(ids: Column, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit(""))) % parts

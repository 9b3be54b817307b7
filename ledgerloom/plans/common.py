"""Shared parts of the driver queries."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def money2(c: Column) -> Column:
    """A DOUBLE of the test tables as DECIMAL(18,2)."""
    return F.round(c, 2).cast("decimal(18,2)")


def printed(c: Column) -> Column:
    """``1,234.50``: the way a statement prints an amount."""
    return F.format_number(money2(c), 2)


def text(c: Column) -> Column:
    return c.cast("string")

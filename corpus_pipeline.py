"""The corpus pipeline: language, exact copies, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of ``documents``; the last one
returns the places of every piece. Between stages the rows are written to the shared folder and read again, so each
stage starts from files, and lost executors repeat no earlier stage.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import block_names, decontaminate, language, packing, simhash
from ledgerloom.llm.common import crc_part, table, work_table

#: Texts whose language is less sure than this are rejected, as are those without a letter.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised; the model learns from the labelled rows of its own input.

    Null and empty texts and those without letters go; repeated rows go or stay together; without labels no row stays.
    """
    model = language.train(docs, crc_part(F.col("doc_id"), 3) != 1)
    found = language.predict(docs, model, carry=docs.columns)
    return found.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select("input.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the one with the smallest doc_id."""
    return block_names.exact_groups(docs, carry=docs.columns).filter("kept").select("input.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near copies: that of the smallest doc_id, whatever other rows share this id.

    Rows alike in id and text, which the stage before leaves only one of, are kept or dropped together. Null and empty
    texts are a group of their own; an empty table gives no rows.
    """
    return simhash.near_groups(docs, carry=docs.columns).filter("kept").select("input.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a word in an occurrence of a benchmark window.

    Null and empty texts have no words and stay; repeated rows go or stay together; an empty benchmark removes nothing.
    """
    found = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"), carry=docs.columns)
    return found.filter("n_hit = 0").select("input.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of all rows in sequences of 1024 tokens; null and empty texts are one piece, the end id."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the fitted language model nor the packing; tests compare stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}

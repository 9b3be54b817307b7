"""Exact dedup by deterministic block naming.

Every text becomes one integer without any hash, by the naming of blocks and of pairs of names:

1. Texts are normalised and cut into blocks of a fixed number of characters. A text whose (length, first block) occurs
   once is like no other text, so that pair is its identity; it takes no further part.
2. The distinct blocks of the others are sorted and numbered: equal blocks get equal names, different ones different.
3. Adjacent names of a text form pairs; the distinct pairs are sorted and numbered in turn, which halves the names of
   each text, until one is left. Texts are equal exactly if their lengths and last names are.

All of it is DataFrame work. Numbers of a sorted table are fixed by writing it once. A block, a pair or an identity that
a large part of all rows share is first reduced in each task; rows get its name by a join whose large keys Spark splits.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import pick, work_table

#: Characters of a block.
BLOCK = 1024


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _named(rows: DataFrame, by: list[str], label: str) -> DataFrame:
    """``rows`` with ``by`` replaced by ``name``: the place of its value among the sorted distinct values."""
    names = rows.select(*by).distinct().orderBy(*by).withColumn("name", F.monotonically_increasing_id())
    names = work_table(names, label)
    on = [rows[c].eqNullSafe(names[c]) for c in by]
    return rows.join(names, on).drop(*by)


def identities(texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """``texts``(row, n, body) as (row, n, name): rows have equal (n, name) exactly if their bodies are equal.

    ``n`` is the body's number of characters. Ends after log2(longest / block) rounds; a round keeps only the texts
    that have more than one name left.
    """
    parts = F.greatest(F.ceil(F.col("n") / block).cast("int"), F.lit(1))
    blocks = F.regexp_extract_all("body", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))  # one pass, however long the text
    rows = texts.select("row", "n", parts.alias("parts"), F.posexplode_outer(blocks).alias("at", "block"))
    rows = rows.withColumn("at", F.coalesce("at", F.lit(0))).withColumn("block", F.coalesce("block", F.lit("")))
    rows = work_table(_named(work_table(rows, "blocks"), ["block"], "block-names"), "named")
    done = None
    while True:
        whole = rows.filter("parts = 1").select("row", "n", "name")
        done = whole if done is None else done.unionByName(whole)
        rows = rows.filter("parts > 1")
        if rows.isEmpty():
            return done
        pairs = rows.groupBy("row", "n", "parts", F.floor(F.col("at") / 2).cast("int").alias("at")).agg(
            F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left"),
            F.max(F.when(F.col("at") % 2 == 1, F.col("name"))).alias("right"),
        ).withColumn("parts", F.ceil(F.col("parts") / 2).cast("int"))
        rows = work_table(_named(work_table(pairs, "pairs"), ["left", "right"], "pair-names"), "named")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``key``, keep_id, group_size, kept, text_sha256, and the columns named in ``carry``.

    Texts are equal when they are after ``normalised``; null counts as empty. ``keep_id`` is the smallest ``key`` of
    the equal texts (null only if all are null) and exactly one row of each group is kept: one with that key. Of
    several rows with one text and one key, one is kept. An empty table gives no rows. ``carry`` are input columns that
    the result shall have too, as struct ``input``, so that no name can clash.
    """
    held = {"input": F.struct(*(F.col(f"`{c}`") for c in carry))} if carry else {}
    extra = list(held)
    if not carry or text not in carry:
        held["source"] = F.col(f"`{text}`").cast("string")
    source = F.col("source") if "source" in held else F.col("input")[text]  # a text moves once, whoever asks for it
    body = normalised(source).alias("body")
    rows = pick(docs, key=F.col(f"`{key}`"), **held)
    rows = rows.select("*", F.length(body).alias("n"), F.substring(body, 1, 64).alias("head"))
    heads = rows.groupBy("n", "head").agg(F.count(F.lit(1)).alias("like")).filter("like > 1").drop("like")
    heads = work_table(heads, "shared-heads")
    digest = F.sha2(body, 256).alias("text_sha256")
    out = [F.col("key").alias(key), "keep_id", "group_size", "kept", "text_sha256", *extra]
    single = rows.select("n", "head", "key", digest, *extra).hint("merge").join(heads, ["n", "head"], "left_anti").select(
        "*", F.col("key").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    # rows get numbers where they are written, so that the numbers stay
    shared = rows.hint("merge").join(heads, ["n", "head"], "left_semi").withColumn("row", F.monotonically_increasing_id())
    shared = work_table(shared.select("row", "n", "key", *held), "shared")
    named = work_table(identities(shared.select("row", "n", body), block).join(shared.select("row", "key"), "row"), "identities")
    order = F.struct(F.col("key").isNull(), F.col("key"), F.col("row"))
    groups = named.groupBy("n", "name").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
    groups = work_table(groups.select("n", "name", "group_size", F.col("first.key").alias("keep_id"), F.col("first.row").alias("keep_row")), "groups")
    decided = named.join(groups, ["n", "name"]).select("row", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"))
    many = shared.join(decided, "row").select("key", "keep_id", "group_size", "kept", digest, *extra)
    return single.select(*out).unionByName(many.select(*out))

"""The registered queries of this subpackage: thin calls of its operators over whole tables."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import block_names, byte_pairs, decontaminate, filter_audit, html_text, language, packing, repeats, resampling, secrets, simhash, token_counts, toxicity
from .common import crc_part, table


def op1_text_tag_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op2_suffix_tree_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_spans")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_part(F.col("doc_id"), 3) == 1
    model = language.train(docs, ~held_out)
    return language.predict(docs, model).withColumn("held_out", held_out)


def op4_digest(marked: DataFrame) -> DataFrame:
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_digest(decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_digest(found: DataFrame) -> DataFrame:
    def text(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def op7_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_digest(secrets.scan(table(spark, sf_dir, "documents")))


def op8_block_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_names.exact_groups(table(spark, sf_dir, "documents"))


def op9_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op10_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_part(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).withColumn("held_out", held_out)


def op11_posting_list_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op12_digest(encoded: DataFrame, path: str) -> DataFrame:
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2(byte_pairs.decode(F.col("ids"), path), 256).alias("decoded_sha256"))


def op12_byte_pair_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return op12_digest(byte_pairs.encode(table(spark, sf_dir, "documents"), path), path)


def op13_line_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_text_tag_ratio, op2_suffix_tree_repeats, op3_language_id, op4_suffix_decontamination, op5_best_fit_packing, op6_token_counts, op7_guess_cost_secrets, op8_block_names, op9_golay_simhash, op10_compression_toxicity,
                                  op11_posting_list_audit, op12_byte_pair_fold, op13_line_resampling)}

#: Texts are equal when they are after replacing each run of white space by one space.
_OP8_SQL = """
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), g AS (
  SELECT doc_id, sha256(body) AS text_sha256, min(doc_id) OVER (PARTITION BY body) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

#: Rows counted by which filters they fail; each order is then a path through those counts.
_OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), f AS (
  SELECT part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
         100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) AS c,
         regexp_matches(body, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS e,
         coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
  FROM d LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)
), p AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS fails, count(*) AS n,
         count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM f GROUP BY ALL
), k AS (SELECT unnest([0, 1, 2, 3, 4]) AS k
), o AS (
  SELECT [k1.k, k2.k, k3.k, k4.k, k5.k] AS ks FROM k k1, k k2, k k3, k k4, k k5
  WHERE len(list_distinct([k1.k, k2.k, k3.k, k4.k, k5.k])) = 5
), s AS (
  SELECT list_aggregate(list_transform(ks, lambda x: substr('ABCDE', x + 1, 1)), 'string_agg', '') AS filter_order, step,
         (1 << ks[step]) AS own, coalesce(list_sum(list_transform(ks[1:step - 1], lambda x: 1 << x)), 0)::INT AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE fails & (before | own) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE fails & own > 0 AND fails & before = 0), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE fails & own > 0 AND fails & before > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = own), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE fails & own > 0 AND fails & before = 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE fails & own > 0 AND fails & before = 0), 0) AS toxic_lost
  FROM p, s GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""

ORACLE: dict[str, str] = {"op8_block_names": _OP8_SQL, "op11_posting_list_audit": _OP11_SQL}

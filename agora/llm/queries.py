"""Registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.llm import (
    filter_audit,
    fm_index,
    grammar_tokens,
    language,
    lsh_forest,
    mixing,
    mtree,
    multi_index,
    piece_spans,
    quality,
    secret_tags,
    separator_scan,
    toxicity,
)
from agora.llm.common import id_bucket, table
from agora.sources.staging import scratch_root

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


def _folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/agora-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def op1_quality_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    bucket = id_bucket(F.col("doc_id"), 5)
    model = quality.train(docs.where(bucket != 0), labels.where(bucket != 0))
    return quality.score(docs, model).select(
        "doc_id",
        F.coalesce(bucket == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "text_score",
        "meta_score",
    )


def op2_grammar_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "grammar-tokens")
    grammar_tokens.write_shards(table(spark, sf_dir, "documents"), tokenizer_path(), folder)
    return grammar_tokens.read_documents(spark, folder)


def op3_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op4_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        "contaminated",
    )


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Trained on the labelled documents that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.train(docs, labels.where(id_bucket(F.col("doc_id"), 5) != 0))


def op5_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir), locate=True)
    return scored.select(
        "doc_id",
        F.coalesce(id_bucket(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))


def op7_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_tags.find_secrets(docs, secret_tags.train(docs))
    text = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"] != "crf")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def op8_mtree_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return mtree.top_k(rows, rows.where(F.col("vec_id") % 50 == 0), 5)


def op9_language_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bucket = id_bucket(F.col("doc_id"), 4)
    model = language.train(docs.where(bucket != 2))
    return language.predict(docs, model).select(
        "doc_id",
        F.coalesce(bucket == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "entropy",
        "rejected",
    )


def op10_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "token-files")
    separator_scan.write_files(table(spark, sf_dir, "documents"), tokenizer_path(), folder)
    return separator_scan.count_tokens(spark, folder).select("doc_id", "n_tokens", "open")


def op11_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = piece_spans.encode_spans(table(spark, sf_dir, "documents"), pieces_path())
    covered = F.try_element_at("ends", F.lit(-1)) - F.try_element_at("starts", F.lit(1))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("covered_bytes"),
    )


def op12_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return multi_index.hard_negatives(rows, rows.where(F.col("vec_id") % 100 == 0))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP8_SQL = """
with usable as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select q.vec_id as query_id, r.vec_id,
    cast(list_sum(list_transform(range(1, len(r.v) + 1), lambda i: q.v[i] * r.v[i])) as bigint) as score
  from usable q join usable r on q.vec_id % 50 = 0 and r.vec_id <> q.vec_id
),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as n from scored
)
select query_id, cast(n as integer) as "rank", vec_id, score from ranked where n <= 5
"""

QUERIES = {
    "op1_quality_co_training": op1_quality_co_training,
    "op2_grammar_tokens": op2_grammar_tokens,
    "op3_lsh_forest": op3_lsh_forest,
    "op4_fm_index": op4_fm_index,
    "op5_toxicity_mil": op5_toxicity_mil,
    "op6_source_mix": op6_source_mix,
    "op7_secret_crf": op7_secret_crf,
    "op8_mtree_top5": op8_mtree_top5,
    "op9_language_kneser_ney": op9_language_kneser_ney,
    "op10_separator_scan": op10_separator_scan,
    "op11_piece_spans": op11_piece_spans,
    "op12_multi_index": op12_multi_index,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES = {
    "op3_lsh_forest": lsh_forest.SQL,
    "op4_fm_index": fm_index.SQL,
    "op8_mtree_top5": OP8_SQL,
    "op12_multi_index": multi_index.SQL,
    "op13_filter_audit": filter_audit.SQL,
}

"""From raw documents to token files: five stages, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  ``run`` chains them over the table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.llm import fm_index, grammar_tokens, lsh_forest, mixing, toxicity
from agora.llm.common import table
from agora.llm.queries import tokenizer_path, toxicity_model
from agora.sources.staging import scratch_root, stage

#: No stage but the filters has an SQL form; each is tested against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not call toxic.

    The model is trained on the labelled documents of the table, not on ``docs``.
    """
    # under other names, none of the table's columns is taken for one of the score's
    kept = {f"c{i}": name for i, name in enumerate(docs.columns)}
    plain = docs.select(*[F.col(name).alias(c) for c, name in kept.items()], "text")
    scored = toxicity.score(plain, toxicity_model(spark, sf_dir), keep=tuple(kept))
    return scored.where(F.col("score") < 0.5).select(*[F.col(c).alias(name) for c, name in kept.items()])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    A ``doc_id`` stays if one of its rows does; rows equal in id and text stay once.
    Rows without id stay.
    """
    judged = lsh_forest.near_duplicates(docs).where("kept and doc_id is not null")
    ids = stage(judged.select("doc_id").distinct(), "kept-ids")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct(*docs.columns).alias("row"))
    once = rows.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return once.select("row.*").unionByName(docs.where(F.col("doc_id").isNull()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold too much of the benchmark."""
    columns = tuple(docs.columns)
    found = fm_index.find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=columns)
    return found.where(~F.col("contaminated")).select(*[F.col(f"kept_{c}").alias(c) for c in columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' words as the mix takes them, repeats as documents of their own."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents; the result has one row per document, read back from them."""
    folder = f"{scratch_root(spark)}/agora-{spark.sparkContext.applicationId}/corpus-{uuid.uuid4().hex}"
    grammar_tokens.write_shards(docs, tokenizer_path(), folder)
    return grammar_tokens.read_documents(spark, folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result staged for the next one."""
    docs = table(spark, sf_dir, "documents")
    for position, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = stage(docs, f"corpus-{name}")
    return docs

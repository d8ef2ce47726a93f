"""Training rows with the ids of a real vocabulary, against the library itself."""

import hashlib

import pytest
from pyspark.sql import functions as F

from agora.catalog import QUERIES
from agora.functions.prompts import render_chat
from agora.operators import training

SF_DIR = "/root/testdata/sf0.001"
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def vocabulary():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def ids(vocabulary, text):
    return vocabulary.encode(text, add_special_tokens=False).ids


def test_ids_of_odd_texts(spark, vocabulary):
    texts = ["", None, "a  b\n", "ñandú 日本 😀", "word " * 5000, "a  b\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = df.select("id", training.vocabulary_tokenizer(public.path("byte_bpe_50k.json"))(F.col("t")).alias("x")).collect()
    assert {r["id"]: r["x"] for r in found} == {i: None if t is None else ids(vocabulary, t) for i, t in enumerate(texts)}


def test_pairs_are_cut_padded_and_masked(spark, vocabulary):
    rows = [(1, 2, "a b c d e f", "x"), (1, 3, "", None)]
    pairs = spark.createDataFrame(rows, "chosen long, rejected long, chosen_prompt string, rejected_prompt string")
    tokens = training.vocabulary_tokenizer(public.path("byte_bpe_50k.json"))
    found = {r["rejected"]: r for r in training.pair_rows(pairs, tokens, max_len=4, pad=F.lit(0).cast("bigint")).collect()}
    long, short = ids(vocabulary, "a b c d e f"), ids(vocabulary, "x")
    assert found[2]["input_ids_chosen"] == long[:4] and found[2]["attention_mask_chosen"] == [1] * 4
    assert found[2]["input_ids_rejected"] == [*short, 0, 0, 0] and found[2]["attention_mask_rejected"] == [1, 0, 0, 0]
    assert found[3]["input_ids_chosen"] == [0] * 4


def test_queries_show_the_ids_of_the_library(spark, vocabulary):
    from agora.catalog.views import items, table
    from agora.plans.story_datasets import build_story_dataset

    stories = {r["id"]: r["serialized"] for r in build_story_dataset(items(spark, SF_DIR)).select("id", "serialized").collect()}
    found = QUERIES["training_token_ids"](spark, SF_DIR).collect()
    assert found
    for row in found:
        own = ids(vocabulary, stories[row["id"]])
        assert (row["tokens"], row["md5"]) == (len(own), hashlib.md5(",".join(map(str, own)).encode()).hexdigest())

    turns = table(spark, SF_DIR, "conversations").where("conv_id is not null and turn is not null").collect()
    fits = 0
    said = {}
    for row in sorted(turns, key=lambda r: (r["conv_id"], r["turn"], r["role"], r["text"])):
        said.setdefault(row["conv_id"], []).append(row)
    chats = []
    for own in said.values():
        for row in own:
            before = [(m["role"], m["text"]) for m in own if m["turn"] < row["turn"]]
            chats.append((len(chats), before))
    frame = spark.createDataFrame(chats, "k int, m array<struct<role:string,content:string>>")
    fits = sum(len(ids(vocabulary, r["chat"])) <= 400 for r in frame.select(render_chat(F.col("m")).alias("chat")).collect())
    report = QUERIES["chat_token_report"](spark, SF_DIR).first()
    assert (report["samples_before"], report["samples_after"]) == (len(chats), fits) and 0 < fits < len(chats)


def test_pair_ids_have_a_row_for_every_pair(spark):
    found = QUERIES["pair_token_ids"](spark, SF_DIR)
    pairs = QUERIES["pair_rows"](spark, SF_DIR)
    assert found.count() == pairs.count() > 0
    assert found.where("attention_mask_chosen is null or input_ids_rejected is null").count() == 0

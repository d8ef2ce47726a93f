"""Stages of the pipeline on odd tables: nulls, empty and long texts, repeated rows, clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"
#: Names that the stages' own results use.
CLASHES = ("score", "offending", "print", "node", "kept", "component_id", "contaminated", "kept_text", "key", "row",
           "_text", "_key", "text_hash", "runs", "got", "size", "id", "taken", "c1", "start", "rank", "_k0")
LONG = " ".join(f"word{i}" for i in range(30_000))
ROWS = [
    (1, "a plain text about gardens and rain in the early spring", "en", "x", 5),
    (2, None, "en", "x", None),
    (3, "", None, None, 0),
    (4, " \n\t ", "en", "y", 4),
    (5, LONG, "en", "x", len(LONG)),
    (5, LONG, "en", "x", len(LONG)),
    (6, LONG + " tail", "en", None, 1),
    (7, "short", None, "y", 5),
    (None, "a row that has no id at all but some words in it", "en", "z", 3),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_of_any_name_pass_through(spark, odd, name):
    found = dict(corpus_pipeline.STAGES)[name](spark, odd, SF_DIR)
    assert found.columns == odd.columns
    rows = found.collect()
    assert rows and all(r[c] == f"own {c}" for r in rows for c in CLASHES)
    known = {(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()}
    if name == "source_mix":
        assert {r["doc_id"] for r in rows} <= {1, 5, 6, 7, None}
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
    else:
        assert {(r["doc_id"], r["text"]) for r in rows} <= known
    if name == "near_duplicates":
        # 5 and its repeated row stay once, 6 is nearly the same; rows without id stay
        assert sorted(r["doc_id"] or 0 for r in rows) == [0, 0, 1, 2, 3, 4, 5, 7]
    if name == "decontamination":
        assert len(rows) == len(ROWS)


def test_token_files_of_odd_rows(spark, odd):
    rows = dict(corpus_pipeline.STAGES)["token_files"](spark, odd, SF_DIR).collect()
    assert len(rows) == len(ROWS)
    assert {r["doc_id"] for r in rows if r["n_tokens"] == 1} == {2, 3, None}


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_empty_tables_stay_empty(spark, odd, name):
    found = dict(corpus_pipeline.STAGES)[name](spark, odd.limit(0), SF_DIR)
    assert found.count() == 0
    if name != "token_files":
        assert found.columns == odd.columns


def test_no_stage_sees_what_its_predecessor_dropped(spark, odd):
    """The stages in a row leave no document that a filter turned away on its own."""
    stages = dict(corpus_pipeline.STAGES)
    calm = stages["toxicity"](spark, odd, SF_DIR)
    once = stages["near_duplicates"](spark, calm, SF_DIR)
    assert once.join(calm, ["doc_id"], "left_anti").where("doc_id is not null").count() == 0

"""Items are stored beside their texts: same rows, without a copy of the text for each event."""

import os
import random
from datetime import datetime, timedelta

import pytest

from agora.catalog import views
from agora.catalog.compare import _rows
from agora.operators import forest, scoring, training
from agora.operators.scoring import length_scorer
from agora.session import configure
from agora.sources.result_store import ResultStore, key_rows, lookup_results, score_incremental
from pyspark.sql import functions as F

#: The fifth document has no text, number 3 is there twice, one has no number.
IDS = [0, 1, 2, 3, 3, 4, 5, None]
EVENTS = 1500


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(5)
    docs = [(i, None if i == 4 else f"{i} " + "".join(rng.choices("abcdefgh &<>", k=20_000))) for i in IDS]
    docs[4] = (3, "another three")
    start = datetime(2024, 1, 1)
    rows = [
        (i, i % 50, "error" if i % 3 else "view", start + timedelta(hours=i), float(i % 97)) for i in range(EVENTS)
    ]
    rows += [(64, 7, None, None, None), (None, 7, "view", start, 1.0)]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(
        rows, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double"
    ).write.parquet(f"{folder}/events.parquet")
    return folder


def _duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "events"):
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet/*.parquet'")
    return con


def test_items_are_those_of_the_sql(spark, sf_dir):
    wanted = ["id", "type", "by", "time", "text", "title", "score", "parent", "top_level_parent", "kids"]
    found = views.items(spark, sf_dir).select(*wanted)
    # DuckDB's concat passes over a null text; in Spark the whole is null
    clause = views.oracle("items").replace("else concat(d.text,", "when d.text is null then null else concat(d.text,")
    cursor = _duck(sf_dir).execute(clause + "select " + ", ".join(f'"{c}"' for c in wanted) + " from items")
    theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    assert _rows(found.columns, found.collect()) == theirs
    # six of eight numbers have a document; events of the one that is there twice are there twice
    assert EVENTS * 6 / 8 < len(theirs) < EVENTS


def _bytes(df):
    return sum(os.path.getsize(name.removeprefix("file:")) for name in df.inputFiles())


def test_no_text_is_stored_per_event(spark, sf_dir):
    texts = views.items(spark, sf_dir).agg(F.sum(F.length("text"))).first()[0]
    assert _bytes(views.item_rows(spark, sf_dir)) + _bytes(views._texts(spark, sf_dir)) < texts / 20


def test_texts_stay_in_the_given_table(spark, sf_dir):
    assert all(name.startswith(f"file://{sf_dir}/documents.parquet/") for name in views._texts(spark, sf_dir).inputFiles())
    keys = [r["text_key"] for r in views._texts(spark, sf_dir).collect()]
    assert keys.count(None) == 1 and len(set(keys)) == len(keys) == len(IDS) - 1


def test_texts_are_shuffled_once(spark, sf_dir):
    whole = views.text_reader(spark, sf_dir)(views.item_rows(spark, sf_dir).select("id", "text_key"))
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2


def test_few_texts_are_those_of_all(spark, sf_dir):
    few = views.item_rows(spark, sf_dir).where("id < 20").select("id", "text_key")
    wanted = sorted(map(str, views.text_reader(spark, sf_dir)(few).collect()))
    read = views.text_reader(spark, sf_dir, few)(few)
    assert sorted(map(str, read.collect())) == wanted
    assert "LeftSemi" in read._jdf.queryExecution().optimizedPlan().toString()


def test_shuffle_files_go_with_their_job(spark):
    configure(spark)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().groupBy("count").count()
    assert sorted(counted.collect()) == sorted(counted.collect()) == [(142, 1), (143, 6)]


@pytest.mark.parametrize("narrow", [
    lambda x: x.select("id", "time"),
    lambda x: x.where("type = 'story' and score > 3").select("id", "title"),
    lambda x: x.groupBy("type").count(),
    lambda x: x.join(x.where("score > 3").select(F.col("id").alias("top_level_parent")), "top_level_parent", "left_semi").select("id"),
])
def test_texts_are_not_read_where_none_is_wanted(spark, sf_dir, narrow):
    plan = narrow(views.items(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert "_body" not in plan and "text_key" not in plan.split("Relation")[0]


def test_texts_come_last(spark, sf_dir):
    rows, read = views.item_rows(spark, sf_dir), views.text_reader(spark, sf_dir)
    unique = rows.dropDuplicates(["id"])
    stored = spark.createDataFrame(read(unique).drop("text_key").collect(), read(unique).drop("text_key").schema)
    apart = forest.augment_comments(spark.createDataFrame(unique.collect(), unique.schema), read)
    assert apart.columns == forest.augment_comments(stored).columns
    order = lambda df: sorted(map(str, df.collect()))
    assert order(apart) == order(forest.augment_comments(stored))
    asked = stored.where("type = 'comment'").select("id")
    digests = forest.ancestor_chain(asked, stored, F.md5("text"))
    later = forest.ancestor_chain(asked, stored).withColumn(
        "chain", F.transform("chain", lambda a: F.struct(a["author"].alias("author"), F.md5(a["text"]).alias("text")))
    )
    assert order(digests) == order(later)


def test_results_by_texts_that_lie_apart(spark, sf_dir, fresh_path):
    rows, read = views.item_rows(spark, sf_dir).select("id", "text_key"), views.text_reader(spark, sf_dir)
    store = ResultStore(spark, fresh_path())
    score_incremental(rows.where("id < 300"), "f", ["text"], length_scorer, store, "text", read=read)
    hits = lookup_results(rows, "f", ["text"], store, read).select("id", "hit").collect()
    known = {r["id"] for r in read(rows).where("id < 300 and text is not null").collect()}
    assert {r["id"] for r in hits if r["hit"]} == known and len(hits) == rows.count()
    found = score_incremental(rows, "f", ["text"], length_scorer, store, "text", read=read)
    assert "text" not in found.columns
    got = sorted((r["id"], round(r["score"] or -1, 6)) for r in found.collect())
    exact = read(rows).select("id", F.round(F.log1p(F.length("text")), 6).alias("s")).collect()
    assert got == sorted((r["id"], -1 if r["s"] is None else r["s"]) for r in exact)


def test_rows_are_keyed_once_and_not_moved_to_few_values(spark, sf_dir, fresh_path):
    read = views.text_reader(spark, sf_dir)
    rows = key_rows(views.item_rows(spark, sf_dir).select("id", "text_key"), ["text"], read)
    store = ResultStore(spark, fresh_path())
    score_incremental(rows.where("id < 300"), "f", ["text"], length_scorer, store, "text", read=read)
    found = lookup_results(rows, "f", ["text"], store, read)
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.inputFiles() and set(rows.inputFiles()) <= set(found.inputFiles())
    assert found.where("id < 300 and text_key is not null").count() == found.where("hit").count() > 0


def test_hashes_wanted_twice_are_found_once(spark, fresh_path):
    store = ResultStore(spark, fresh_path())
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "text string, id int")
    for _ in range(2):
        keyed = score_incremental(rows, "f", ["text"], length_scorer, store, "text", refresh=True)
    wanted = keyed.where("id = 1").select("arg_hash")
    assert store.live("f", wanted.unionByName(wanted)).count() == 1


def test_rows_are_not_sorted_by_their_texts(spark):
    texts = spark.range(50).select("id", F.repeat(F.lit("x"), F.col("id").cast("int")).alias("text"))
    scored = scoring.batch_score(texts, "id", "text")
    assert "Sort" not in scored._jdf.queryExecution().executedPlan().toString()
    assert scored.where("error is not null or score is null").count() == 0


def test_stretches_go_longest_first(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(scoring, "_SORTED", 30)
    frames = [pd.DataFrame({"t": ["x" * n if n is not None else None for n in part]}) for part in ([1, 20], [None, 9], [3], [5])]
    found = [f["t"].str.len().fillna(0).astype(int).tolist() for f in scoring._longest_first(iter(frames), ["t"])]
    assert found == [[20, 9, 1, 0], [5, 3]]
    assert list(scoring._longest_first(iter([]), ["t"])) == []


def test_encoding_goes_in_pieces():
    texts = ["a" * n for n in (4, 4, 3, 20, 0, 10, 1)]
    found = list(training._pieces(texts, 10))
    assert sum(found, []) == texts
    assert [[len(t) for t in piece] for piece in found] == [[4, 4], [3], [20], [0, 10], [1]]
    assert list(training._pieces([])) == []

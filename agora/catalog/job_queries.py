"""Queries over scoring, stored results, files and fitted models."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora import fixed_values as fixed
from agora.catalog.item_queries import (
    CHAINS, CLEAN, COMMENTS, PAIRS, PROMPT_FROM, PROMPT_V1, RANKS, TEXT_STORY, UP, pairing_ctes,
    split_sql, text_posts, unit_sql,
)
from agora.catalog.registry import query
from agora.catalog.views import (
    comments, item_marks, item_rows, items, oracle, read_marked, table, text_reader, view,
)
from agora.operators import forest, metrics, models, training
from agora.operators.benchmark import nest_results
from agora.operators.distributions import histogram_by
from agora.operators.filters import filter_min_score, filter_type
from agora.operators.ranking import top_n
from agora.operators.sampling import split_rows
from agora.operators.scoring import batch_score, length_scorer, score_pairs
from agora.operators.trends import mean_by_group
from agora.plans import evaluations
from agora.plans.pair_dataset import each_with_prompts, pair_candidates, split_pairs, with_prompts
from agora.plans.story_datasets import build_story_dataset
from agora.session import configure
from agora.sources import tables
from agora.sources.memo import materialize, resume_predictions
from agora.sources.result_store import (
    ResultStore, arg_hash, evict_results, key_rows, lookup_results, score_incremental,
)
from agora.sources.staging import scratch_root, stage


def _fresh_path(spark, label: str) -> str:
    return f"{scratch_root(spark)}/agora-{label}-{uuid.uuid4().hex}"


def _rounded(df, *columns: str):
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- scoring -----------------------------------------------------------------------------


@query("batch_score", oracle("items") + """
select id, case when text is not null then round(ln(1 + length(text)), 6) end as score,
       cast(null as varchar) as error from items""")
def scored_items(spark, sf_dir):
    return _rounded(batch_score(items(spark, sf_dir), "id", "text"), "score")


@query("incremental_scoring", oracle("items") + """
select id, case when text is not null then round(ln(1 + length(text)), 6) end as score
from items""")
def incremental_scoring(spark, sf_dir):
    rows, read = item_rows(spark, sf_dir).select("id", "type", "text_key"), text_reader(spark, sf_dir)
    store = ResultStore(spark, _fresh_path(spark, "results"))
    stories = rows.where(F.col("type") == "story")
    score_incremental(stories, "length", ["text"], length_scorer, store, "text", read=read)
    found = score_incremental(rows, "length", ["text"], length_scorer, store, "text", read=read)
    return _rounded(found.select("id", "score"), "score")


@query("looked_up_results", oracle("items", stories="""
select text from items where type = 'story' and text is not null""") + """
select id, text is not null and text in (select text from stories) as hit,
       case when text is not null and text in (select text from stories)
            then round(ln(1 + length(text)), 6) end as score
from items""")
def looked_up_results(spark, sf_dir):
    rows, read = item_rows(spark, sf_dir).select("id", "type", "text_key"), text_reader(spark, sf_dir)
    store = ResultStore(spark, _fresh_path(spark, "results"))
    stories = rows.where(F.col("type") == "story")
    score_incremental(stories, "length", ["text"], length_scorer, store, "text", read=read)
    found = lookup_results(rows, "length", ["text"], store, read)
    return _rounded(found.select("id", "hit", "score"), "score")


@query("evicted_results", oracle("items", stories="""
select text from items where type = 'story' and text is not null and score < 100""") + """
select id, text is not null and text in (select text from stories) as hit from items""")
def evicted_results(spark, sf_dir):
    """Score all stories, then forget those with a high score."""
    rows, read = item_rows(spark, sf_dir).select("id", "type", "text_key", "score"), text_reader(spark, sf_dir)
    store = ResultStore(spark, _fresh_path(spark, "results"))
    stories = rows.where((F.col("type") == "story") & F.col("text_key").isNotNull())
    score_incremental(stories.drop("score"), "length", ["text"], length_scorer, store, "text", read=read)
    high = read(filter_min_score(stories, 100))
    evict_results(store, "length", high.select(arg_hash(high, ["text"]).alias("arg_hash")))
    return lookup_results(rows, "length", ["text"], store, read).select("id", "hit")


_ALL_LENGTHS = oracle("items") + """
select id, case when text is not null then round(ln(1 + length(text)), 6) end as score from items"""


@query("cache_only_scoring", _ALL_LENGTHS)
def cache_only_scoring(spark, sf_dir):
    """A second run that may not score anything any more."""
    everything, read = item_rows(spark, sf_dir).select("id", "text_key"), text_reader(spark, sf_dir)
    rows = everything.where(F.col("text_key").isNotNull())
    store = ResultStore(spark, _fresh_path(spark, "results"))
    score_incremental(rows, "length", ["text"], length_scorer, store, "text", read=read)
    found = score_incremental(rows, "length", ["text"], length_scorer, store, "text", cache_only=True, read=read)
    others = everything.where(F.col("text_key").isNull())
    found = found.select("id", "score").unionByName(others.select("id", F.lit(None).cast("double").alias("score")))
    return _rounded(found, "score")


def _first_scorer():
    return lambda texts: [1.0 for _ in texts]


@query("refreshed_scoring", _ALL_LENGTHS)
def refreshed_scoring(spark, sf_dir):
    """Values of another scorer are replaced by a run that recomputes everything."""
    rows, read = item_rows(spark, sf_dir).select("id", "text_key"), text_reader(spark, sf_dir)
    store = ResultStore(spark, _fresh_path(spark, "results"))
    score_incremental(rows, "length", ["text"], _first_scorer, store, "text", read=read)
    score_incremental(rows, "length", ["text"], length_scorer, store, "text", refresh=True, read=read)
    return _rounded(lookup_results(rows, "length", ["text"], store, read).select("id", "score"), "score")


def _two_functions(spark, sf_dir):
    """Stories scored under two functions; all rows, with their hashes."""
    rows, read = item_rows(spark, sf_dir).select("id", "type", "text_key"), text_reader(spark, sf_dir)
    store = ResultStore(spark, _fresh_path(spark, "results"))
    rows = key_rows(rows, ["text"], read)
    stories = rows.where((F.col("type") == "story") & F.col("text_key").isNotNull())
    for name in ("length", "other"):
        score_incremental(stories, name, ["text"], length_scorer, store, "text", read=read)
    return rows, store, read


def _hits(rows, store, read):
    return reduce(DataFrame.unionByName, [
        lookup_results(rows, name, ["text"], store, read).select("id", F.lit(name).alias("fn"), "hit")
        for name in ("length", "other")
    ])


@query("evicted_function", oracle("items", stories="""
select text from items where type = 'story' and text is not null""") + """
select id, fn, fn = 'other' and text is not null and text in (select text from stories) as hit
from items, (select unnest(['length', 'other']) as fn)""")
def evicted_function(spark, sf_dir):
    """One of two functions is forgotten; the log is compacted before it is read."""
    rows, store, read = _two_functions(spark, sf_dir)
    evict_results(store, "length")
    return _hits(rows, store.compacted(_fresh_path(spark, "compacted")), read)


@query("evicted_all", oracle("items") + """
select id, fn, false as hit from items, (select unnest(['length', 'other']) as fn)""")
def evicted_all(spark, sf_dir):
    rows, store, read = _two_functions(spark, sf_dir)
    evict_results(store)
    return _hits(rows, store, read)


def _ranked_scores(spark, sf_dir):
    """Comment scores with the comment's rank among its siblings."""
    scored = batch_score(comments(spark, sf_dir), "id", "text")
    return forest.sibling_rank(scored, items(spark, sf_dir))


_RANKED_SCORES = oracle("items", comments=COMMENTS, ranks=RANKS, scored="""
select cast(coalesce(r.rk, -1) as integer) as sibling_rank, ln(1 + length(c.text)) as score
from comments c left join ranks r on r.id = c.id""")


@query("mean_score_by_rank", _RANKED_SCORES + """
select sibling_rank, round(avg(score), 6) as avg_reward from scored group by sibling_rank""")
def mean_score_by_rank(spark, sf_dir):
    means = mean_by_group(_ranked_scores(spark, sf_dir), "sibling_rank", "score", "avg_reward")
    return _rounded(means, "avg_reward")


@query("histogram_by_rank", _RANKED_SCORES + """
select sibling_rank, cast(least(floor((score - lo) / (hi - lo) * 20) + 1, 20) as integer) as bin,
       count(*) as count
from scored join (select sibling_rank, min(score) as lo, max(score) as hi
                  from scored group by sibling_rank) using (sibling_rank)
group by 1, 2""")
def histogram_by_rank(spark, sf_dir):
    return histogram_by(_ranked_scores(spark, sf_dir), "sibling_rank", "score")


_PROMPTED = oracle(
    "items", recursive=True, **pairing_ctes(), pairs=PAIRS, up=UP, chains=CHAINS,
    prompts=f"select c.id, length({PROMPT_V1}) as n {PROMPT_FROM}",
    judged="""
select p.chosen, p.rejected, round(ln(1 + a.n), 6) as chosen_reward,
       round(ln(1 + b.n), 6) as rejected_reward, a.n > b.n as correct
from pairs p join prompts a on a.id = p.chosen join prompts b on b.id = p.rejected""",
)


_PROMPT_NAMES = {"chosen_prompt_v1": "chosen_prompt", "rejected_prompt_v1": "rejected_prompt"}


def prompted_pairs(spark, sf_dir):
    """Every pair with the first prompt version of both sides, all at once."""
    everything = items(spark, sf_dir)
    found = stage(split_pairs(pair_candidates(everything)), "pairs")
    return with_prompts(found, everything, ("v1",)).withColumnsRenamed(_PROMPT_NAMES)


def each_prompted_pair(spark, sf_dir, make, label):
    """``make`` of all pairs with the first prompt version of both sides, staged; they come in steps.

    Only what is made of the prompts is kept, never the prompts of more than one step.
    """
    rows, reader = item_rows(spark, sf_dir), text_reader(spark, sf_dir)
    found = stage(split_pairs(pair_candidates(rows, reader)), "pairs")
    return each_with_prompts(
        found, rows, lambda pairs: make(pairs.withColumnsRenamed(_PROMPT_NAMES)), label, ("v1",), reader
    )


@query("score_pairs", _PROMPTED + "select * from judged")
def scored_pairs(spark, sf_dir):
    def judged(pairs):
        found = metrics.with_correct(score_pairs(pairs))
        return found.select("chosen", "rejected", "chosen_reward", "rejected_reward", "correct")

    return _rounded(each_prompted_pair(spark, sf_dir, judged, "judged"), "chosen_reward", "rejected_reward")


@query("pair_accuracy", _PROMPTED + """
select correct, count(*) as count,
       (select round(avg(case when correct then 1 else 0 end) * 100, 6) from judged) as accuracy
from judged group by correct""")
def pair_accuracy(spark, sf_dir):
    judged = each_prompted_pair(
        spark, sf_dir, lambda pairs: metrics.with_correct(score_pairs(pairs)).select("correct"), "judged"
    )
    share = F.round(metrics.pair_accuracy(judged).scalar(), 6)
    return metrics.correct_counts(judged).withColumn("accuracy", share)


_CUT = "least(len(w), 4096)"


@query("pair_rows",
       oracle("items", recursive=True, **pairing_ctes(), pairs=PAIRS, up=UP, chains=CHAINS, cut=f"""
select id, md5(array_to_string(w[1:4096], ' ') || repeat(' ', 4096 - {_CUT})) as ids,
       md5(repeat('1', {_CUT}) || repeat('0', 4096 - {_CUT})) as mask
from (select c.id, regexp_extract_all({PROMPT_V1}, '\\S+') as w {PROMPT_FROM})""") + """
select chosen, rejected, a.ids as chosen_ids, a.mask as chosen_mask, b.ids as rejected_ids,
       b.mask as rejected_mask
from pairs p join cut a on a.id = p.chosen join cut b on b.id = p.rejected""")
def pair_rows(spark, sf_dir):
    """Tokens and masks of both sides, each as the md5 of all its entries."""
    digests = [
        F.md5(F.array_join(column, between)).alias(f"{side}_{name}")
        for side in ("chosen", "rejected")
        for name, column, between in (
            ("ids", f"input_ids_{side}", " "), ("mask", F.col(f"attention_mask_{side}").cast("array<string>"), "")
        )
    ]
    return each_prompted_pair(
        spark, sf_dir, lambda pairs: training.pair_rows(pairs).select("chosen", "rejected", *digests), "pair-rows"
    )


def _vocabulary():
    """A public byte-level vocabulary; without its package the queries of token ids cannot run."""
    import public_tokenizers

    return training.vocabulary_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def _ids_md5(column: str):
    return F.md5(F.array_join(F.col(column).cast("array<string>"), ","))


@query("training_token_ids")
def training_token_ids(spark, sf_dir):
    """Training rows of the stories with a model's token ids, those of at most 2,000 tokens."""
    stories = build_story_dataset(text_posts(spark, sf_dir))
    rows = stage(training.training_rows(stories, "train", 200, _vocabulary(), max_len=2000), "token-ids")
    return rows.select("id", F.round("label", 6).alias("label"), F.size("tokens").alias("tokens"), _ids_md5("tokens").alias("md5"))


@query("pair_token_ids")
def pair_token_ids(spark, sf_dir):
    """Token ids and masks of both prompts of a pair, cut and padded to 4,096."""
    columns = [f"{kind}_{side}" for side in ("chosen", "rejected") for kind in ("input_ids", "attention_mask")]
    vocabulary = _vocabulary()

    def digests(pairs):
        rows = training.pair_rows(pairs, vocabulary, pad=F.lit(0).cast("bigint"))
        return rows.select("chosen", "rejected", *[_ids_md5(c).alias(c) for c in columns])

    return each_prompted_pair(spark, sf_dir, digests, "pair-token-ids")


@query("chat_token_report")
def chat_token_report(spark, sf_dir):
    """Chats before and after a limit of 400 of a model's tokens."""
    return training.turn_length_report(table(configure(spark), sf_dir, "conversations"), 400, _vocabulary())


_RATED = f"""
select c.id, strftime(c.time, '%B %d, %Y') as date, c."by", '{fixed.LINK_PREFIX}' || c.id as link,
       t.title as story_title, md5({CLEAN.format("c.text")}) as text_md5,
       round(ln(1 + length({PROMPT_V1})), 6) as reward
{PROMPT_FROM} left join items t on t.id = c.top_level_parent and t.type = 'story'"""
_RATED_COLUMNS = ("id", "date", "by", "link", "story_title", "text_md5", "reward")


def _rated(rows):
    """Rated comments with their text as its md5."""
    return _rounded(rows.withColumn("text_md5", F.md5("text")), "reward").select(*_RATED_COLUMNS)


@query("rated_sample",
       oracle("items", recursive=True, comments=COMMENTS, up=UP, chains=CHAINS, rated=_RATED) + f"""
select * from rated order by {unit_sql("id")}, id limit 300""")
def rated_sample(spark, sf_dir):
    """A sample of the comments, rated."""
    asked = comments(spark, sf_dir).select("id", "by", "time", "text", "top_level_parent")
    return _rated(evaluations.rate_comments(asked, items(spark, sf_dir), sample_size=300))


@query("rated_comments",
       oracle("items", recursive=True, comments=COMMENTS, up=UP, chains=CHAINS, rated=_RATED) + """
select *
from ((select 'top' as list, * from rated order by reward desc, id limit 100)
      union all (select 'bottom', * from rated order by reward, id limit 100)) r""")
def rated_comments(spark, sf_dir):
    rows = item_rows(spark, sf_dir)
    asked = filter_type(rows, "comment").select("id", "by", "time", "text_key", "top_level_parent")
    rated = evaluations.rate_comments(asked, rows, sample_size=None, reader=text_reader(spark, sf_dir))
    reports = evaluations.rating_reports(stage(_rated(rated), "rated"))
    return tables_tagged(reports).select("list", *_RATED_COLUMNS)


def tables_tagged(reports):
    parts = [df.withColumn("list", F.lit(name)) for name, df in reports.items()]
    return parts[0].unionByName(parts[1])


# --- files -------------------------------------------------------------------------------


@query("split_table", oracle("items") + f"""
select id, title, case {split_sql("id")} when 'val' then 'validation' else {split_sql("id")} end as split
from items where type = 'story'""")
def split_table(spark, sf_dir):
    """Write all splits as one table and read each of them back."""
    stories = split_rows(items(spark, sf_dir).where(F.col("type") == "story").select("id", "title"))
    path = _fresh_path(spark, "splits")
    tables.write_splits(stories, path, {"val": "validation"})
    parts = [
        tables.scan_split(spark, path, name).select("id", "title", F.lit(name).alias("split"))
        for name in ("train", "test", "validation")
    ]
    return reduce(DataFrame.unionByName, parts)


@query("scanned_items", oracle("items") + """
select id, type, "by", time, title, score, parent, len(kids) as kids, md5(text) as md5 from items""")
def scanned_items(spark, sf_dir):
    """The item table written, and read back through the scan that checks its schema."""
    path = _fresh_path(spark, "items")
    tables.write_table(items(spark, sf_dir), path)
    return tables.scan_items(spark, path).select(
        "id", "type", "by", "time", "title", "score", "parent",
        F.when(F.col("kids").isNotNull(), F.size("kids")).cast("bigint").alias("kids"),
        F.md5("text").alias("md5"),
    )


@query("scanned_table", "select doc_id, md5(text) as md5, lang from documents")
def scanned_table(spark, sf_dir):
    """Any table written and read back with a schema of its own."""
    rows = table(configure(spark), sf_dir, "documents")
    path = _fresh_path(spark, "documents")
    tables.write_table(rows.select("doc_id", F.md5("text").alias("md5"), "lang"), path)
    schema = T.StructType.fromDDL("doc_id long, md5 string, lang string")
    return tables.scan_table(spark, path, schema)


@query("csv_report", oracle("items") + """
select id, text, score from items where type = 'story' order by score desc nulls first, id limit 50""")
def csv_report(spark, sf_dir):
    """A ranked report written as CSV and read back."""
    stories = item_rows(spark, sf_dir).where(F.col("type") == "story").select("id", "text_key", "score")
    path = _fresh_path(spark, "report")
    first = stage(top_n(stories, "score", 50), "report")
    report = top_n(text_reader(spark, sf_dir, first)(first).select("id", "text", "score"), "score", 50)
    tables.write_csv_report(report, path)
    return tables.scan_csv_report(spark, path, report.schema)


@query("results_json", oracle("title_results") + """
select item_id, model, original_title, original_score, rm_score_original, md5(scraped_body) as md5,
       generated_title, score, api_time, total_time, full_response, error from title_results""")
def results_json(spark, sf_dir):
    """Nested results written as JSON and read back."""
    path = _fresh_path(spark, "results")
    tables.write_results_json(nest_results(view(spark, sf_dir, "title_results")), path)
    return tables.scan_results_json(spark, path).select(
        "item_id", "original_title", "original_score", "rm_score_original",
        F.md5("scraped_body").alias("md5"), F.explode("model_results").alias("model", "r"),
    ).select(
        "item_id", "model", "original_title", "original_score", "rm_score_original", "md5", "r.*"
    )


@query("materialized_stories", oracle("items") + """
select id, title, score from items where type = 'story' and time is not null and text is not null
  and url is null and deleted is null and dead is null and time >= timestamp '2016-01-01'""")
def materialized_stories(spark, sf_dir):
    """Built on the first call, read on the second."""
    path = _fresh_path(spark, "stories")
    for _ in range(2):
        stories = materialize(spark, path, lambda: build_story_dataset(text_posts(spark, sf_dir)))
    return stories.select("id", "title", "score")


@query("resumed_predictions", oracle("items") + f"""
select id, round(ln(1 + length(text)), 6) as predictions, {split_sql("id")} as split
from items where type = 'story' and text is not null""")
def resumed_predictions(spark, sf_dir):
    """Score once, then join the saved predictions."""
    marks = item_marks(spark, sf_dir).where((F.col("type") == "story") & F.col("text").isNotNull())
    stories = split_rows(read_marked(spark, sf_dir, marks))

    def score(df):
        return batch_score(df, "id", "text").withColumnRenamed("score", "predictions")

    path = _fresh_path(spark, "predictions")
    resume_predictions(stories, path, score, ("id", "split"))
    return _rounded(resume_predictions(stories, path, score, ("id", "split")), "predictions")


# --- fitted models -----------------------------------------------------------------------


def _judged_fit(found):
    """What of a fit does not depend on the optimiser: on its training rows it beats the mean."""
    learned = (F.col("split") != "train") | (F.col("model_rmse") < F.col("baseline_rmse"))
    return _rounded(found.withColumn("learned", learned), "baseline_rmse").select(
        "split", "num_rows", "baseline_rmse", "learned"
    )


_FIT = """
select split, count(*) as num_rows,
       round(sqrt(var_pop(label) * count(label) / count(*)), 6) as baseline_rmse, true as learned
from labelled group by split"""


@query("score_regressor", oracle("items", labelled=f"""
select {split_sql("id")} as split, ln(score) as label from items
where {TEXT_STORY} and time >= timestamp '2016-01-01' and score > 0""") + _FIT)
def score_regressor(spark, sf_dir):
    """Fit on the training split of the stories with points, report errors on every split."""
    stories = stage(
        build_story_dataset(filter_min_score(text_posts(spark, sf_dir), 1)).select(
            "id", "split", "log_score", "serialized"
        ),
        "stories",
    )
    model = models.fit_score_regressor(stories.where(F.col("split") == "train"))
    return _judged_fit(metrics.metrics_by_split(models.predict_scores(model, stories)))


def _path_figures(path, rows, text, label):
    """Errors and correlations of the picked ridge on every split, from predictions row by row."""
    found = metrics.metrics_by_split(path.predict(rows, text), label)
    return _rounded(found, "baseline_rmse", "model_rmse", "model_correlation").withColumn("ridge", F.lit(path.ridge))


@query("score_ridge_path")
def score_ridge_path(spark, sf_dir):
    """Ridge path on the stories with points; the validation split picks, all splits are judged."""
    stories = stage(
        build_story_dataset(filter_min_score(text_posts(spark, sf_dir), 1)).select("split", "log_score", "serialized"), "stories"
    )
    return _path_figures(models.fit_ridge_path(stories), stories, "serialized", "log_score")


@query("quality_ridge_path")
def quality_ridge_path(spark, sf_dir):
    """The same with document texts and their quality labels."""
    rows = _labelled_documents(spark, sf_dir)
    return _path_figures(models.fit_ridge_path(rows, "text", "label"), rows, "text", "label")


def _labelled_documents(spark, sf_dir):
    spark = configure(spark)
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("label")
    )
    return stage(split_rows(documents.join(labels, "id")), "labelled")


@query("quality_regressor", oracle(labelled=f"""
select {split_sql("doc_id")} as split, cast(quality as double) as label
from documents join labels using (doc_id)""") + _FIT)
def quality_regressor(spark, sf_dir):
    """The same fit with document texts and their quality labels."""
    rows = _labelled_documents(spark, sf_dir)
    model = models.fit_score_regressor(rows.where(F.col("split") == "train"), "text", "label")
    return _judged_fit(metrics.metrics_by_split(models.predict_scores(model, rows), "label"))


@query("preference_model", oracle("items", recursive=True, **pairing_ctes(), pairs=PAIRS) + f"""
select {split_sql("top_level_parent")} as split, count(*) as pairs, true as learned
from pairs group by 1""")
def preference_model(spark, sf_dir):
    """Fit on training pairs; they are mostly in the right order afterwards."""
    judged = _judged_pairs(spark, sf_dir)
    return judged.groupBy("split").agg(
        F.count(F.lit(1)).alias("pairs"),
        ((F.col("split") != "train") | (F.avg(F.col("correct").cast("int")) > 0.5)).alias("learned"),
    )


@query("preference_accuracy")
def preference_accuracy(spark, sf_dir):
    """Share of pairs in the right order, in percent, and the mean margin on every split."""
    return _judged_pairs(spark, sf_dir).groupBy("split").agg(
        F.count(F.lit(1)).alias("pairs"),
        (F.avg(F.col("correct").cast("int")) * 100).alias("accuracy"),
        F.round(F.avg(F.col("chosen_reward") - F.col("rejected_reward")), 6).alias("mean_margin"),
    )


def _judged_pairs(spark, sf_dir):
    rows = stage(
        prompted_pairs(spark, sf_dir).select(
            "chosen", "rejected", "split", "chosen_prompt", "rejected_prompt"
        ),
        "prompted",
    )
    model = models.fit_preference_model(rows.where(F.col("split") == "train"))
    return metrics.with_correct(model.score_pairs(rows))

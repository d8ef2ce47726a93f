"""Queries over predictions, title results and completions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from agora import fixed_values as fixed
from agora.catalog.item_queries import split_sql, unit_sql
from agora.catalog.registry import query
from agora.catalog.views import items, oracle, table, view
from agora.functions import prompts, rewards, text
from agora.functions.stories import (
    parse_iso_time, request_problem, score_request, serialize_story, with_link,
)
from agora.operators import (
    benchmark, distributions, filters, generations, joins, metrics, ranking, training, trends,
)
from agora.operators.sampling import split_rows
from agora.operators.scoring import score_titles
from agora.plans import evaluations, story_datasets
from agora.plans.story_datasets import build_scraped_dataset, build_title_rows
from agora.session import configure
from agora.sources.staging import scratch_root

# --- metrics over scored rows --------------------------------------------------------


def scored(spark, sf_dir):
    return view(spark, sf_dir, "scored_rows")


def _rounded(df, *columns: str):
    return df.withColumns({c: F.round(c, 6) for c in columns})


_METRICS = """
round(sqrt(var_pop(log_score) * count(log_score) / count(*)), 6) as baseline_rmse,
round(sqrt(sum(pow(log_score - predictions, 2)) / count(*)), 6) as model_rmse,
round(corr(log_score, predictions), 6) as model_correlation, count(*) as num_rows"""


@query("metrics_by_split", oracle("scored_rows") + f"""
select split, {_METRICS}
from (select *, {split_sql("id")} as split from scored_rows) group by split""")
def metrics_by_split(spark, sf_dir):
    found = metrics.metrics_by_split(split_rows(scored(spark, sf_dir)))
    return _rounded(found, "baseline_rmse", "model_rmse", "model_correlation")


@query("compare_models", oracle("scored_rows") + f"""
select model, split, {_METRICS} from (
  select 'first' as model, {split_sql("id")} as split, log_score, predictions from scored_rows
  union all
  select 'shifted', {split_sql("id")}, log_score, predictions * 0.5 + 1 from scored_rows)
group by model, split""")
def compare_models(spark, sf_dir):
    rows = split_rows(scored(spark, sf_dir))
    shifted = rows.withColumn("predictions", F.col("predictions") * 0.5 + 1)
    found = evaluations.compare_models({"first": rows, "shifted": shifted})
    return _rounded(found, "baseline_rmse", "model_rmse", "model_correlation")


@query("eval_metrics", oracle("scored_rows") + """
select round(sqrt(avg(pow(log_score - predictions, 2))), 6) as rmse,
       round(corr(log_score, predictions), 6) as correlation from scored_rows""")
def eval_metrics(spark, sf_dir):
    return _rounded(
        metrics.eval_metrics(scored(spark, sf_dir), "log_score", "predictions"),
        "rmse", "correlation",
    )


@query("linear_fit", oracle("scored_rows") + """
select round(regr_slope(predictions, log_score), 6) as slope,
       round(regr_intercept(predictions, log_score), 6) as intercept,
       round(corr(log_score, predictions), 6) as r_value from scored_rows""")
def linear_fit(spark, sf_dir):
    found = metrics.linear_fit(scored(spark, sf_dir), "log_score", "predictions")
    return _rounded(found, "slope", "intercept", "r_value")


@query("joint_range", oracle("scored_rows") + """
select round(least(min(log_score), min(predictions)), 6) as low,
       round(greatest(max(log_score), max(predictions)), 6) as high from scored_rows""")
def joint_range(spark, sf_dir):
    return _rounded(metrics.joint_range(scored(spark, sf_dir), "log_score", "predictions"), "low", "high")


@query("log_histogram", oracle("scored_rows") + """
select cast(least(floor((log_score - lo) / (hi - lo) * 20) + 1, 20) as integer) as bin,
       count(*) as count
from scored_rows, (select min(log_score) as lo, max(log_score) as hi from scored_rows)
group by 1""")
def log_histogram(spark, sf_dir):
    return distributions.histogram(scored(spark, sf_dir), "log_score")


@query("histogram_by_group", oracle("scored_rows") + """
select grp, cast(least(floor((log_score - lo) / (hi - lo) * 20) + 1, 20) as integer) as bin,
       count(*) as count
from scored_rows join (select grp, min(log_score) as lo, max(log_score) as hi
                       from scored_rows group by grp) using (grp)
group by 1, 2""")
def histogram_by_group(spark, sf_dir):
    return distributions.histogram_by(scored(spark, sf_dir), "grp", "log_score")


@query("density_grid", oracle("scored_rows") + """
select cast(least(floor(log_score / 6 * 30) + 1, 30) as integer) as x_bin,
       cast(least(floor(predictions / 6 * 30) + 1, 30) as integer) as y_bin, count(*) as count
from scored_rows
where log_score between 0 and 6 and predictions between 0 and 6 group by 1, 2""")
def density_grid(spark, sf_dir):
    return distributions.density_grid(
        scored(spark, sf_dir), "log_score", "predictions", 0, 6, 30
    )


_KERNEL = """
, pairs as (select log_score as x, predictions as y from scored_rows),
shape as (
  select n, xx * s as xx, xy * s as xy, yy * s as yy
  from (select count(*) as n, var_samp(x) as xx, covar_samp(x, y) as xy, var_samp(y) as yy,
               pow(count(*), -1.0 / 3) as s from pairs) one
),
kernel as (
  select *, xx * yy - xy * xy as det, cast(ceil(5 * sqrt(xx) / 0.2) as bigint) as rx,
    cast(ceil(5 * sqrt(yy) / 0.2) as bigint) as ry from shape
),
placed as (
  select cast(floor(x / 0.2) as bigint) as i, cast(floor(y / 0.2) as bigint) as j,
    x / 0.2 - floor(x / 0.2) as a, y / 0.2 - floor(y / 0.2) as b from pairs
),
corners as (
  select i, j, (1 - a) * (1 - b) as w from placed union all select i + 1, j, a * (1 - b) from placed
  union all select i, j + 1, (1 - a) * b from placed union all select i + 1, j + 1, a * b from placed
),
cells as (select i, j, sum(w) as w from corners group by i, j having sum(w) > 0),
grid as (select unnest(range(0, 31)) as g)
select cast(p.g as integer) as x_point, cast(q.g as integer) as y_point, round(
    sum(w * exp(-(yy * pow((p.g - i) * 0.2, 2) - 2 * xy * (p.g - i) * (q.g - j) * 0.04
                  + xx * pow((q.g - j) * 0.2, 2)) / (2 * det)))
    / any_value(n * 2 * pi() * sqrt(det)), 6) as density
from cells, kernel, grid p, grid q
where abs(p.g - i) <= rx and abs(q.g - j) <= ry group by p.g, q.g"""


@query("density_kernel", oracle("scored_rows") + _KERNEL)
def density_kernel(spark, sf_dir):
    found = distributions.density_kernel(scored(spark, sf_dir), "log_score", "predictions", 0, 6, 30)
    return found.withColumn("density", F.round("density", 6))


_PREDICTED = """
select *, cast(trunc(exp(predictions)) as bigint) as predicted_score,
       score - cast(trunc(exp(predictions)) as bigint) as score_diff from scored_rows"""


@query("predicted_score", oracle("scored_rows", predicted=_PREDICTED) + """
select id, predicted_score, score_diff, round(exp(predictions), 4) as reward from predicted""")
def predicted_score(spark, sf_dir):
    found = evaluations.with_predicted_score(scored(spark, sf_dir))
    return found.select(
        "id", "predicted_score", "score_diff", F.round(F.exp("predictions"), 4).alias("reward")
    )


def _board_sql(name: str) -> str:
    column, desc, only = ranking.LEADERBOARDS[name]
    where = "" if only is None else f"where score = {only}"
    order = "desc nulls first" if desc else "asc nulls first"
    return (
        f"(select '{name}' as list, * from predicted {where}"
        f" order by {column} {order}, id limit 100)"
    )


@query("leaderboards",
       oracle("scored_rows", predicted=_PREDICTED)
       + "select list, id, title, predicted_score, score, score_diff, "
       + f"'{fixed.LINK_PREFIX}' || id as link from (\n"
       + "\nunion all ".join(_board_sql(name) for name in ranking.LEADERBOARDS) + ")")
def leaderboards(spark, sf_dir):
    found = ranking.score_leaderboards(evaluations.with_predicted_score(scored(spark, sf_dir)))
    return found.select(
        "list", "id", "title", "predicted_score", "score", "score_diff",
        with_link(F.col("id")).alias("link"),
    )


@query("top_report", oracle("scored_rows", predicted=_PREDICTED) + f"""
select '<a href="{fixed.LINK_PREFIX}' || id || '">' || title || '</a>' as "Story",
       predicted_score as "Predicted Score", score as "Actual Score"
from predicted where not contains(title, 'Who is hiring')
order by predicted_score desc nulls first, id limit 10""")
def top_report(spark, sf_dir):
    kept = filters.exclude_title_containing(evaluations.with_predicted_score(scored(spark, sf_dir)))
    top = ranking.top_n(kept, "predicted_score", 10)
    return ranking.report_rows(top.withColumn("link", with_link(F.col("id"))))


@query("distribution_summary", oracle("scored_rows") + """
select round(avg(predictions), 6) as mean, round(quantile_cont(predictions, 0.05), 6) as p5,
       round(quantile_cont(predictions, 0.5), 6) as median,
       round(quantile_cont(predictions, 0.95), 6) as p95,
       round(stddev_pop(predictions), 6) as std_dev from scored_rows""")
def distribution_summary(spark, sf_dir):
    found = distributions.distribution_summary(scored(spark, sf_dir), "predictions")
    return _rounded(found, "mean", "p5", "median", "p95", "std_dev")


_PLACES = ", ".join(
    f"""max(case when i = floor({p} * (n - 1)) then x end) as low{k},
    max(case when i = ceil({p} * (n - 1)) then x end) as high{k}, max({p} * (n - 1)) as at{k}"""
    for k, p in enumerate(distributions.SUMMARY_PROBS)
)
_BETWEEN = ", ".join(
    f"""case when low{k} = high{k} or low{k} = '-infinity'::double then low{k}
    else round(low{k} + (high{k} - low{k}) * (at{k} - floor(at{k})), 6) end as {name}"""
    for k, name in enumerate(("p5", "median", "p95"))
)


@query("log_score_summary", oracle("items") + f"""
, ranked as (
  select x, row_number() over (order by x) - 1 as i, count(*) over () as n
  from (select case when score > 30 then ln(score - 30) else '-infinity'::double end as x
        from items where score >= 0)
), places as (select {_PLACES} from ranked)
select {_BETWEEN} from places""")
def log_score_summary(spark, sf_dir):
    """Percentiles of the logarithm of points beyond 30; none at all counts as -inf."""
    beyond = F.greatest(F.col("score") - 30, F.lit(0)).alias("score")
    rows = items(spark, sf_dir).where(F.col("score") >= 0).select(beyond)
    found = distributions.distribution_summary(metrics.with_log_score(rows), "log_score")
    return _rounded(found, "p5", "median", "p95").select("p5", "median", "p95")


@query("mean_by_group", oracle("scored_rows") + """
select grp, round(avg(predictions), 6) as avg_reward from scored_rows group by grp""")
def mean_by_group(spark, sf_dir):
    return _rounded(trends.mean_by_group(scored(spark, sf_dir), "grp", "predictions", "avg_reward"), "avg_reward")


# --- title results ---------------------------------------------------------------------


def results(spark, sf_dir):
    return view(spark, sf_dir, "title_results")


@query("benchmark_summary", oracle("title_results") + """
select model, round(avg(score), 6) as avg_score, round(median(score), 6) as median_score,
       round(avg(total_time) filter (where score is not null), 6) as avg_total_time,
       round(avg(api_time) filter (where score is not null), 6) as avg_api_time,
       round(avg(rm_score_original), 6) as avg_rm_original_score,
       count(*) as sample_count, count(score) as valid_sample_count
from title_results group by model""")
def benchmark_summary(spark, sf_dir):
    return _rounded(
        benchmark.benchmark_summary(results(spark, sf_dir)),
        "avg_score", "median_score", "avg_total_time", "avg_api_time", "avg_rm_original_score",
    )


@query("nested_results", oracle("title_results") + """
select item_id, model, original_title, original_score, rm_score_original, md5(scraped_body) as md5,
       generated_title, score, api_time, total_time, full_response, error from title_results""")
def nested_results(spark, sf_dir):
    nested = benchmark.nest_results(results(spark, sf_dir), ["a", "b", "c"])
    return nested.select(
        "item_id", "original_title", "original_score", "rm_score_original",
        F.md5("scraped_body").alias("md5"), F.explode("model_results").alias("model", "r"),
    ).select("item_id", "model", "original_title", "original_score", "rm_score_original", "md5", "r.*")


@query("mean_score_by_model", oracle("title_results") + """
select 'Original' as model, round(avg(rm_score_original), 6) as average_score
from (select distinct item_id, rm_score_original from title_results)
union all select model, round(avg(score), 6) from title_results group by model""")
def mean_score_by_model(spark, sf_dir):
    nested = benchmark.nest_results(results(spark, sf_dir))
    return _rounded(benchmark.mean_score_by_model(nested), "average_score")


@query("rank_titles", oracle("title_results") + """
select item_id, cast(row_number() over (partition by item_id
                     order by score desc nulls last, model) as integer) as place,
       model, score, title
from (select item_id, model, score, generated_title as title from title_results
      union all
      select distinct item_id, 'Original', rm_score_original, original_title from title_results)""")
def rank_titles(spark, sf_dir):
    return benchmark.rank_titles(benchmark.nest_results(results(spark, sf_dir)))


def scraped(spark, sf_dir):
    return view(spark, sf_dir, "scraped_stories")


@query("cross_models", oracle("scraped_stories") + """
select s.id, m.model from scraped_stories s, (select unnest(['a', 'b', 'c']) as model) m""")
def cross_models(spark, sf_dir):
    return joins.cross_models(scraped(spark, sf_dir).select("id"), ["a", "b", "c"])


def _tagged_sql(title: str, t: str = "") -> str:
    return (
        f"'<submitter>' || coalesce({t}\"by\", 'None') || '</submitter>' || chr(10) || '<url>'"
        f" || coalesce({t}url, 'None') || '</url>' || chr(10) || '<date>'"
        f" || strftime({t}time, '%Y-%m-%d') || '</date>' || chr(10) || chr(10) || '<body>'"
        f" || coalesce({t}scraped_body, 'None') || '</body>' || chr(10) || '<title>'"
        f" || coalesce({title}, 'None') || '</title>'"
    )


_GENERATED = """
select id as item_id, m.model,
       case when mod(id + m.k, 9) = 0 then null
            else '  "' || coalesce(title, 'none') || ' by ' || m.model || '" ' end as content,
       case when mod(id + m.k, 10) = 7 then 'timeout' end as error,
       cast(mod(id * m.k, 9) as double) as api_time, cast(mod(id, 5) as double) as total_time
from scraped_stories, (select 'a' as model, 1 as k union all select 'b', 2) m"""


@query("score_titles", oracle("scraped_stories", generated=_GENERATED, cleaned="""
select g.* exclude (error), s.title as original_title, s.score as original_score, s."by", s.url,
       s.time, s.scraped_body, case when g.error is null
         then coalesce(substr(trim(g.content), 2, length(trim(g.content)) - 2), '') end as made,
       coalesce(g.error, case when s."by" is null then 'by is missing' end) as error
from generated g join scraped_stories s on s.id = g.item_id""") + f"""
select item_id, model, made as generated_title, content as full_response, original_title,
       original_score, error, total_time,
       case when made is not null then api_time end as api_time,
       case when error is null then round(ln(1 + length({_tagged_sql("made")})), 6) end as score,
       case when coalesce(original_title, '') <> '' and "by" is not null
            then round(ln(1 + length({_tagged_sql("original_title")})), 6) end as rm_score_original
from cleaned""")
def titles_scored(spark, sf_dir):
    stories = scraped(spark, sf_dir)
    asked = joins.cross_models(stories.select("id", "title"), ["a", "b"])
    k = F.when(F.col("model") == "a", 1).otherwise(2)
    generated = asked.select(
        F.col("id").alias("item_id"),
        "model",
        F.when((F.col("id") + k) % 9 != 0, F.concat(
            F.lit('  "'), F.coalesce("title", F.lit("none")), F.lit(" by "), F.col("model"), F.lit('" ')
        )).alias("content"),
        F.when((F.col("id") + k) % 10 == 7, "timeout").alias("error"),
        ((F.col("id") * k) % 9).cast("double").alias("api_time"),
        (F.col("id") % 5).cast("double").alias("total_time"),
    )
    found = score_titles(stories, generated).drop("scraped_body")
    return _rounded(found, "score", "rm_score_original")


@query("title_requests", oracle("scraped_stories") + f"""
select s.id as item_id, m.model, s.title as original_title, s.score as original_score,
       md5('{fixed.TITLE_SYSTEM}' || '|' || '{fixed.TITLE_REQUEST}'
           || substr(coalesce(s.scraped_body, ''), 1, {fixed.MAX_BODY_CHARS})) as asked
from (select * from scraped_stories where split = 'val' and score >= 20
      order by {unit_sql("id")}, id limit 50) s, (select unnest(['a', 'b', 'c']) as model) m""")
def title_requests(spark, sf_dir):
    """What the title benchmark sends out: a chat per chosen story and model."""
    asked = story_datasets.build_title_requests(scraped(spark, sf_dir), ["a", "b", "c"], max_items=50)
    return asked.select(
        "item_id", "model", "original_title", "original_score",
        F.md5(F.array_join(F.transform("prompt", lambda m: m["content"]), "|")).alias("asked"),
    )


_PROPOSED = """
select id, 'new ' || id as title, case mod(id, 4) when 0 then 'False' when 1 then 'tea' else 'True' end as verdict,
       s."by", s.url, s.time, s.scraped_body from scraped_stories s"""


@query("title_rewards", oracle("scraped_stories", proposed=_PROPOSED, judged=f"""
select id, case when verdict = 'False' then 0 else 1 end as matches,
       case when "by" is not null then ln(1 + length({_tagged_sql("title")})) end as rm,
       cast(length(title) as double) as length from proposed""") + """
select id, round(case when matches = 0 then 0.0 else rm end, 6) as reward,
       cast(matches as double) as matches, round(rm, 6) as rm, length from judged""")
def title_rewards(spark, sf_dir):
    """The reward step of title tuning: new titles scored, checked for support and gated."""
    stories = scraped(spark, sf_dir)
    number = F.pmod("id", F.lit(4))
    proposed = stories.select(
        "id",
        F.concat(F.lit("new "), F.col("id").cast("string")).alias("title"),
        F.when(number == 0, "False").when(number == 1, "tea").otherwise("True").alias("verdict"),
    )
    found = evaluations.reward_titles(stories, proposed)
    shown = [F.col("metrics")[name].alias(name) for name in ("matches", "rm", "length")]
    return _rounded(found.select("id", "reward", *shown), "reward", "rm")


@query("score_requests", oracle("scraped_stories") + """
select id, strftime(time, '%Y-%m-%dT%H:%M:%S') as sent, time as received,
       case when title is null then 'title is missing' when "by" is null then 'by is missing' end
         as problem
from scraped_stories""")
def score_requests(spark, sf_dir):
    rows = scraped(spark, sf_dir).withColumn("request", score_request(F.col("title")))
    return rows.select(
        "id",
        F.col("request.time").alias("sent"),
        parse_iso_time(F.col("request.time")).alias("received"),
        request_problem(F.col("request")).alias("problem"),
    )


# --- scraped stories ---------------------------------------------------------------------


@query("scraped_dataset", oracle("scraped_stories") + f"""
select id, split, {unit_sql("id")} as shuffle_key, {_tagged_sql("title")} as serialized
from scraped_stories where scraping_error = 'no_error' and text is null
  and time > timestamp '2016-01-01'""")
def scraped_dataset(spark, sf_dir):
    stories = scraped(spark, sf_dir)
    parts = {name: filters.filter_split(stories, name).drop("split") for name in ("train", "val", "test")}
    return build_scraped_dataset(parts).select("id", "split", "shuffle_key", "serialized")


@query("serialized_url", oracle("scraped_stories") + """
select id, 'URL: ' || coalesce(url, 'None') as serialized from scraped_stories""")
def serialized_url(spark, sf_dir):
    return scraped(spark, sf_dir).select("id", serialize_story("url").alias("serialized"))


@query("reasoning_prompt", oracle("scraped_stories") + f"""
select id, '{fixed.REASONING_REQUEST.replace("'", "''")}' || {_tagged_sql("title")} || chr(10) as prompt
from scraped_stories""")
def reasoning_prompt(spark, sf_dir):
    return scraped(spark, sf_dir).select("id", prompts.reasoning_prompt().alias("prompt"))


@query("title_rows", oracle("scraped_stories") + rf"""
select id, asked, title from (
  select id, title, '{fixed.TITLE_SYSTEM}' || '|' || '{fixed.TITLE_REQUEST}'
           || scraped_body as asked,
         len(regexp_extract_all('<|im_start|>system' || chr(10)
           || '{fixed.TITLE_SYSTEM}' || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10)
           || '{fixed.TITLE_REQUEST}' || scraped_body || '<|im_end|>' || chr(10)
           || '<|im_start|>assistant' || chr(10), '\S+')) as tokens
  from scraped_stories where split = 'train' and score >= 20
  order by {unit_sql("id")}, id limit 100)
where tokens <= 400""")
def title_rows(spark, sf_dir):
    rows = build_title_rows(scraped(spark, sf_dir), "train", max_items=100, max_len=400)
    return rows.select(
        "id",
        F.array_join(F.transform("prompt", lambda m: m["content"]), "|").alias("asked"),
        F.col("row.title").alias("title"),
    )


@query("match_prompt", oracle("scraped_stories") + f"""
select id, '{fixed.MATCH_SYSTEM}' as system,
       '<article>' || scraped_body || '</article>' || chr(10) || '<proposed_title>'
       || coalesce(title, 'None') || '</proposed_title>' as request from scraped_stories""")
def match_prompt(spark, sf_dir):
    chat = prompts.match_prompt(F.col("scraped_body"), F.col("title"))
    return scraped(spark, sf_dir).select(
        "id", chat[0]["content"].alias("system"), chat[1]["content"].alias("request")
    )


@query("truncated_bodies", oracle("scraped_stories") + """
select id, substr(coalesce(scraped_body, ''), 1, 4000) as body from scraped_stories""")
def truncated_bodies(spark, sf_dir):
    return scraped(spark, sf_dir).select(
        "id", text.truncate_text(F.col("scraped_body")).alias("body")
    )


@query("replaced_titles", oracle("scraped_stories") + """
select id, 'new ' || id as title, url, "by" from scraped_stories""")
def replaced_titles(spark, sf_dir):
    row = F.struct("id", "title", "url", "by")
    title = F.concat(F.lit("new "), F.col("id").cast("string"))
    return scraped(spark, sf_dir).select(
        story_datasets.replace_title(row, title).alias("row")
    ).select("row.*")


# --- completions -------------------------------------------------------------------------


def completions(spark, sf_dir):
    return view(spark, sf_dir, "completions")


_ANSWER = "split_part(split_part(completion, '<answer>', -1), '</answer>', 1)"
_STRIP = "trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _count_sql(piece: str) -> str:
    quoted = " || ".join("chr(10)" if p == "\n" else f"'{p}'" for p in piece.replace("\n", "\0\n\0").split("\0") if p)
    return f"((length(completion) - length(replace(completion, {quoted}, ''))) / {len(piece)})"


def _tail_sql(piece: str) -> str:
    quoted = " || ".join("chr(10)" if p == "\n" else f"'{p}'" for p in piece.replace("\n", "\0\n\0").split("\0") if p)
    return f"length(split_part(completion, {quoted}, -1))"


@query("text_rewards", oracle("completions", answered=f"""
select *, {_STRIP.format(_ANSWER)} as given from completions""") + rf"""
select id,
  case when given = answer then 2.0::double else 0.0::double end as correct,
  case when regexp_full_match(given, '\p{{Nd}}+') then 0.5::double else 0.0::double end as integer,
  case when regexp_full_match(completion,
       '<reasoning>\n[^\n]*\n</reasoning>\n<answer>\n[^\n]*\n</answer>\n') then 0.5::double
       else 0.0::double end as strict_format,
  case when regexp_matches(completion, '^<reasoning>[^\n]*</reasoning>\s*<answer>[^\n]*</answer>')
       then 0.5::double else 0.0::double end as soft_format,
  round(case when {_count_sql("<reasoning>" + chr(10))} = 1 then 0.125 else 0.0 end
  + case when {_count_sql(chr(10) + "</reasoning>" + chr(10))} = 1 then 0.125 else 0.0 end
  + case when {_count_sql(chr(10) + "<answer>" + chr(10))} = 1
         then 0.125 - {_tail_sql(chr(10) + "</answer>" + chr(10))} * 0.001 else 0.0 end
  + case when {_count_sql(chr(10) + "</answer>")} = 1
         then 0.125 - ({_tail_sql(chr(10) + "</answer>")} - 1) * 0.001 else 0.0 end, 6)::double
  as tag_count
from answered""")
def text_rewards(spark, sf_dir):
    columns = rewards.text_rewards(F.col("completion"), F.col("answer"))
    columns["tag_count"] = F.round(columns["tag_count"], 6)
    return completions(spark, sf_dir).select("id", *[c.alias(n) for n, c in columns.items()])


@query("tagged_answers", oracle("completions") + f"""
select id, {_STRIP.format(_ANSWER)} as answer,
       case when contains(worked, '####')
            then {_STRIP.format("split_part(worked, '####', 2)")} end as hash_answer
from completions""")
def tagged_answers(spark, sf_dir):
    return completions(spark, sf_dir).select(
        "id",
        text.extract_tagged_answer(F.col("completion")).alias("answer"),
        text.extract_hash_answer(F.col("worked")).alias("hash_answer"),
    )


_PARSED = rf"""
select id, turn, case when regexp_matches(thought, '(?s)<think>(.*?)</think>')
       then {_STRIP.format("regexp_extract(thought, '(?s)<think>(.*?)</think>', 1)")} end as reasoning,
       case when regexp_matches(thought, '(?s)<answer>(.*?)</answer>')
       then {_STRIP.format("regexp_extract(thought, '(?s)<answer>(.*?)</answer>', 1)")} end as said
from completions"""
_NUMBER = r"coalesce(try_cast(said as double), try_cast(regexp_extract(said, '\d+') as double))"


@query("parsed_reasoning", oracle("completions", parsed=_PARSED) + f"""
select id, reasoning, {_NUMBER} as answer, reasoning is not null as has_reasoning,
       {_NUMBER} is not null as has_answer from parsed""")
def parsed_reasoning(spark, sf_dir):
    columns = text.parse_reasoning(F.col("thought"))
    answer = F.nanvl(columns["predictions"], F.lit(None).cast("double"))
    return completions(spark, sf_dir).select(
        "id", columns["reasoning"].alias("reasoning"), answer.alias("answer"),
        columns["has_reasoning"].alias("has_reasoning"), columns["has_answer"].alias("has_answer"),
    )


@query("reasoning_presence", oracle("completions", parsed=_PARSED) + f"""
select {split_sql("id")} as split,
       round(avg(case when reasoning is not null then 1 else 0 end), 6) as reasoning_presence_rate,
       round(avg(case when {_NUMBER} is not null then 1 else 0 end), 6) as answer_presence_rate
from parsed group by 1""")
def reasoning_presence(spark, sf_dir):
    columns = text.parse_reasoning(F.col("thought"))
    flags = completions(spark, sf_dir).select(
        "id", *[columns[c].alias(c) for c in ("has_reasoning", "has_answer")]
    )
    return _rounded(
        metrics.presence_rates(split_rows(flags)),
        "reasoning_presence_rate", "answer_presence_rate",
    )


@query("evaluated_reasoning", oracle("completions", parsed=_PARSED, judged=f"""
select {split_sql("id")} as split, ln(1 + turn) as label, reasoning,
       {_NUMBER} as p from parsed""") + """
select split, round(sqrt(var_pop(label) * count(label) / count(*)), 6) as baseline_rmse,
       case when count(p) = count(*) then round(sqrt(sum(pow(label - p, 2)) / count(*)), 6)
            else 'NaN'::double end as model_rmse, coalesce(round(max(r), 6), 'NaN'::double) as model_correlation,
       count(*) as num_rows,
       round(avg(case when reasoning is not null then 1 else 0 end), 6) as reasoning_presence_rate,
       round(avg(case when p is not null then 1 else 0 end), 6) as answer_presence_rate
from (select *, case when count(p) over (partition by split) = count(*) over (partition by split)
             then corr(label, p) over (partition by split) end as r from judged) group by split""")
def evaluated_reasoning(spark, sf_dir):
    rows = completions(spark, sf_dir)
    stories = split_rows(rows.select("id", F.ln(1 + F.col("turn")).alias("label")))
    found = evaluations.evaluate_reasoning(
        stories, rows.select("id", F.col("thought").alias("completion"))
    )
    return _rounded(
        found, "baseline_rmse", "model_rmse", "model_correlation", "reasoning_presence_rate",
        "answer_presence_rate",
    )


@query("clean_titles", oracle("completions") + f"""
select id, case when (starts_with(t, '"') and ends_with(t, '"')) or (starts_with(t, '''')
       and ends_with(t, '''')) then {_STRIP.format("substr(t, 2, length(t) - 2)")} else t end as title
from (select id, {_STRIP.format("raw_title")} as t from completions)""")
def clean_titles(spark, sf_dir):
    return completions(spark, sf_dir).select(
        "id", text.clean_title(F.col("raw_title")).alias("title")
    )


@query("gated_rewards", oracle("completions") + """
select id, case when lower(substr(verdict, 1, 1)) = 't' then 1 else 0 end as matches,
       verdict in ('True', 'False') as clean_flag,
       case when lower(substr(verdict, 1, 1)) = 't' then cast(turn as double) else 0.0 end as reward,
       cast(length(completion) as double) as title_length,
       case when completion = answer then 1.0::double else 0.0::double end as exact
from completions""")
def gated_rewards(spark, sf_dir):
    flag = text.parse_flag(F.col("verdict"))
    gated = rewards.gated_reward(F.col("completion"), flag, F.col("turn").cast("double"))
    return completions(spark, sf_dir).select(
        "id", flag.alias("matches"), text.is_clean_flag(F.col("verdict")).alias("clean_flag"),
        gated["reward"].alias("reward"), gated["metrics"]["length"].alias("title_length"),
        F.when(F.col("completion") == F.col("answer"), 1.0).otherwise(0.0).alias("exact"),
    )


@query("exact_rewards", oracle("completions") + """
select id, case when verdict = 'True' then 1.0::double else 0.0::double end as reward
from completions""")
def exact_rewards(spark, sf_dir):
    return completions(spark, sf_dir).select(
        "id", rewards.reward_exact(F.col("verdict"), "True").alias("reward")
    )


@query("metric_summaries", oracle("completions", metrics="""
select 'length' as metric, cast(length(completion) as double) as value from completions
union all
select 'matches', case when lower(substr(verdict, 1, 1)) = 't' then 1.0 else 0.0 end from completions
union all select 'rm', cast(turn as double) from completions""") + """
select metric, round(avg(value), 6) as mean, round(quantile_cont(value, 0.05), 6) as p5,
       round(quantile_cont(value, 0.5), 6) as median, round(quantile_cont(value, 0.95), 6) as p95,
       round(stddev_pop(value), 6) as std_dev from metrics group by metric""")
def metric_summaries(spark, sf_dir):
    gated = rewards.gated_reward(
        F.col("completion"), text.parse_flag(F.col("verdict")), F.col("turn").cast("double")
    )
    rows = completions(spark, sf_dir).select(gated["metrics"].alias("metrics"))
    found = distributions.metric_summaries(rows, "metrics")
    return _rounded(found, "mean", "p5", "median", "p95", "std_dev")


_SAMPLES = "select *, row_number() over (partition by turn order by conv_id) as i from completions"


@query("generation_table", oracle("completions", numbered=_SAMPLES) + "select turn as step, " + ", ".join(
    f"max(case when i = {i} then answer end) as input_{i}, "
    f"max(case when i = {i} then completion end) as output_{i}, "
    f"max(case when i = {i} then cast(conv_id as double) end) as score_{i}, "
    f"max(case when i = {i} then 'length=' || cast(length(completion) as double) || chr(10)"
    f" || 'matches=' || case when lower(substr(verdict, 1, 1)) = 't' then '1.0' else '0.0' end"
    f" || chr(10) || 'rm=' || cast(cast(turn as double) as varchar) end) as metrics_{i}"
    for i in (1, 2, 3)) + " from numbered group by turn")
def generation_table(spark, sf_dir):
    gated = rewards.gated_reward(
        F.col("completion"), text.parse_flag(F.col("verdict")), F.col("turn").cast("double")
    )
    rows = completions(spark, sf_dir).select(
        F.col("turn").alias("step"), F.col("conv_id").alias("sample"),
        F.col("answer").alias("input"), F.col("completion").alias("output"),
        F.col("conv_id").cast("double").alias("score"), gated["metrics"].alias("metrics"),
    )
    return generations.generation_table(rows, 3)


@query("step_log", oracle("completions") + """
select cast(mod(turn, 4) as integer) as step, id, length(completion) + mod(turn, 4) as score
from completions where mod(turn, 4) <> 3""")
def step_log(spark, sf_dir):
    """Steps logged one by one, one of them again after a first run that went wrong."""
    path = f"{scratch_root(spark)}/agora-steps-{uuid.uuid4().hex}"
    rows = completions(spark, sf_dir)
    for step in (0, 1, 2, 1):
        wrong = step == 1 and not generations.logged_steps(spark, path).count(1)
        mine = rows.where(F.col("turn") % 4 == (2 if wrong else step))
        generations.log_step(mine.select("id", (F.length("completion") + step).alias("score")), path, step)
    return generations.read_steps(spark, path)


_CHATS = """
select a.conv_id, a.turn,
       coalesce(string_agg('<|im_start|>' || b.role || chr(10) || b.text || '<|im_end|>' || chr(10), ''
                           order by b.turn, b.role, b.text), '')
       || '<|im_start|>assistant' || chr(10) as chat
from (select conv_id, turn, row_number() over () as place from conversations) a
left join conversations b on b.conv_id = a.conv_id and b.turn < a.turn
group by a.conv_id, a.turn, a.place"""
_CHAT_TOKENS = r"len(regexp_extract_all(chat, '\S+'))"


@query("chat_length_filter", oracle(chats=_CHATS) + f"""
select conv_id, turn, md5(chat) as md5 from chats where {_CHAT_TOKENS} <= 300""")
def chat_length_filter(spark, sf_dir):
    kept = training.filter_turns(table(configure(spark), sf_dir, "conversations"), 300)
    return kept.select("conv_id", "turn", F.md5("chat").alias("md5"))


@query("chat_length_report", oracle(chats=_CHATS) + f"""
select count(*) as samples_before, count(case when {_CHAT_TOKENS} <= 300 then 1 end) as samples_after
from chats""")
def chat_length_report(spark, sf_dir):
    return training.turn_length_report(table(configure(spark), sf_dir, "conversations"), 300)

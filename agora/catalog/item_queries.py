"""Queries over the item table: filters, trends, reply forest, pairs, prompts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from agora import fixed_values as fixed

from agora.catalog.registry import query
from agora.catalog.views import comments, item_marks, item_rows, items, oracle, read_marked, text_reader
from agora.functions.numbers import natural_log
from agora.functions.stories import serialize_story, with_link
from agora.functions.text import unescape_html
from agora.operators import filters, forest, joins, sampling, trends
from agora.operators.prompting import prompt_steps
from agora.operators.training import training_rows
from agora.plans.pair_dataset import build_pair_dataset, pair_candidates, split_pairs
from agora.plans.story_datasets import build_story_dataset
from agora.sources.staging import scratch_root

# --- SQL pieces ---------------------------------------------------------------


def unit_sql(key: str, seed: int = fixed.SAMPLE_SEED) -> str:
    return (
        f"(cast('0x' || substr(md5('{seed}:' || cast({key} as varchar)), 1, 8) as bigint)"
        " / 4294967296.0)"
    )


def split_sql(key: str) -> str:
    u = unit_sql(key)
    return f"case when {u} < 0.8 then 'train' when {u} < 0.9 then 'test' else 'val' end"


COMMENTS = "select * from items where type = 'comment'"
RANKS = """
select kid as id, max_by(pos, pid * 100000 + pos) as rk
from (select id as pid, unnest(kids) as kid, generate_subscripts(kids, 1) as pos from items)
group by kid
"""
LEVELS = """
select id, 0 as d from comments where parent = top_level_parent
union all
select c.id, l.d + 1 from comments c join levels l on c.parent = l.id where l.d < 24
"""
RANKED = """
select c.*, coalesce(r.rk, -1) as sibling_rank,
       count(c.id) over (partition by c.parent) as siblings_count
from comments c left join ranks r on r.id = c.id
"""
ROOTED = "select * from ranked where top_level_parent in (select id from items where score >= 100)"
CLOSURE = """
select id, 0 as d from rooted where sibling_rank <= 3 and parent = top_level_parent
union all
select c.id, k.d + 1 from rooted c join closure k on c.parent = k.id
where c.sibling_rank <= 3 and k.d < 6
"""
CLEAN = (
    "regexp_replace(replace(replace(replace({0}, '&#x27;', ''''), '&amp;', '&'), '<p>',"
    " chr(10) || chr(10)), '<a href=\"([^\"]+)\"[^>]*>[^<]+</a>', '\\1', 'g')"
)
USABLE = f"""
select * from rooted where id in (select id from closure)
  and siblings_count >= 5 and siblings_count < 25
  and text is not null and length({CLEAN.format("text")}) > 10 and sibling_rank > 0
"""
PAIRS = """
select b.id as chosen, o.id as rejected, b.sibling_rank as chosen_rank,
       o.sibling_rank as rejected_rank, b.top_level_parent
from (select *, row_number() over (partition by parent order by sibling_rank, id) as rn,
             max(late) over (partition by parent order by sibling_rank, id
                             rows between unbounded preceding and current row) as stopped
      from (select *, case when epoch_us(time) - epoch_us(first_value(time) over
                             (partition by parent order by sibling_rank, id)) > 1800000000
                           then 1 else 0 end as late from usable)) o
join (select *, row_number() over (partition by parent order by sibling_rank, id) as rn
      from usable) b on b.parent = o.parent and b.rn = 1
where o.rn > 1 and o.stopped = 0
"""
UP = """
select id, top_level_parent as root, parent as anc, 0 as depth from comments
where parent <> top_level_parent
union all
select u.id, u.root, i.parent, u.depth + 1 from up u join items i on i.id = u.anc
where i.parent <> u.root
"""


def esc_sql(column: str) -> str:
    out = f"coalesce({column}, '')"
    for char, code in (("&", "&amp;"), ('"', "&quot;"), ("''", "&apos;"), ("<", "&lt;"), (">", "&gt;")):
        out = f"replace({out}, '{char}', '{code}')"
    return out


def leaf_sql(tag: str, column: str) -> str:
    return f"'<{tag}>' || {esc_sql(column)} || '</{tag}>'"


CHAINS = f"""
select u.id, string_agg('<item>' || {leaf_sql('author', 'i."by"')} || {leaf_sql('text', 'i.text')}
                        || '</item>', '' order by u.depth) as chain
from up u join items i on i.id = u.anc group by u.id
"""
_ME = f"{leaf_sql('author', 'c.\"by\"')} || {leaf_sql('text', 'c.text')}"
_CHAIN = "'<parent_chain>' || coalesce(h.chain, '') || '</parent_chain>'"
_STORY = (
    f"'<story>' || {leaf_sql('title', 's.title')}"
    f" || case when s.url is null then '' else {leaf_sql('url', 's.url')} end"
    f" || case when s.text is null then '' else {leaf_sql('text', 's.text')} end || '</story>'"
)
_ASK = f"'<instructions>{fixed.COMMENT_INSTRUCTIONS}</instructions>'"
PROMPT_V1 = f"{_ASK} || '<comment>' || {_ME} || {_CHAIN} || '</comment>' || {_STORY}"
PROMPT_V2 = f"{_STORY} || {_CHAIN} || '<comment>' || {_ME} || '</comment>'"
PROMPT_FROM = """
from comments c join items s on s.id = c.top_level_parent left join chains h on h.id = c.id
"""

_FOREST = dict(comments=COMMENTS, ranks=RANKS, ranked=RANKED, rooted=ROOTED)
_PAIRING = dict(**_FOREST, closure=CLOSURE, usable=USABLE)


def pairing_ctes() -> dict[str, str]:
    return dict(_PAIRING)


TEXT_STORY = """type = 'story' and time is not null and text is not null
  and url is null and deleted is null and dead is null"""


def _digest(df, column: str, key: str = "id"):
    """A text as its md5 and length, which keeps results of whole texts small."""
    return df.select(
        key, F.md5(column).alias("md5"), F.length(column).cast("bigint").alias("chars")
    )


def text_posts(spark, sf_dir):
    """Live text posts with their texts; those of other items are not moved."""
    return read_marked(spark, sf_dir, filters.filter_text_stories(item_marks(spark, sf_dir)))


# --- counts and filters ---------------------------------------------------------


@query("type_counts", oracle("items") + """
select type, count(*) as count, round(count(*) * 100.0 / (select count(*) from items), 2) as percent
from items group by type""")
def type_counts(spark, sf_dir):
    return trends.value_counts(items(spark, sf_dir), "type", pct=True)


@query("row_count", oracle("items") + "select count(*) as rows from items")
def row_count(spark, sf_dir):
    return trends.row_count(items(spark, sf_dir))


@query("distinct_roots", oracle("items") + """
select distinct top_level_parent from items where type = 'comment'""")
def distinct_roots(spark, sf_dir):
    return trends.distinct_values(comments(spark, sf_dir), "top_level_parent")


@query("text_stories", oracle("items") + f"""
select id, title, "by", score, descendants, time from items where {TEXT_STORY}""")
def text_stories(spark, sf_dir):
    kept = filters.filter_text_stories(item_marks(spark, sf_dir))
    return kept.select("id", "title", "by", "score", "descendants", "time")


@query("stories_by_month", oracle("items") + f"""
select strftime(time, '%Y-%m') as month, count(id) as num_stories,
       round(avg(score), 6) as avg_upvotes
from items where {TEXT_STORY} group by 1""")
def stories_by_month(spark, sf_dir):
    kept = filters.filter_text_stories(item_marks(spark, sf_dir))
    found = trends.count_by_period(kept, "month", mean_of="score", mean_alias="avg_upvotes")
    return found.withColumn("avg_upvotes", F.round("avg_upvotes", 6))


@query("stories_by_quarter", oracle("items") + """
select cast(date_trunc('quarter', time) as timestamp) as year_quarter, count(id) as num_stories
from items where type = 'story' and time is not null and text is not null
  and time < timestamp '2024-10-01' and time >= timestamp '2016-01-01' group by 1""")
def stories_by_quarter(spark, sf_dir):
    kept = filters.filter_stories_with_text(item_marks(spark, sf_dir))
    kept = filters.filter_time_range(kept, ge=fixed.REGRESSION_START, lt=fixed.REPORT_END)
    return trends.count_by_period(kept, "quarter")


@query("mean_score_by_quarter", oracle("items") + """
select cast(date_trunc('quarter', time) as timestamp) as year_quarter,
       round(avg(score), 6) as avg_score
from items where type = 'story' and time is not null and text is not null
  and time < timestamp '2024-10-01' group by 1""")
def mean_score_by_quarter(spark, sf_dir):
    kept = filters.filter_stories_with_text(item_marks(spark, sf_dir))
    kept = filters.filter_time_range(kept, lt=fixed.REPORT_END)
    means = trends.mean_by_period(kept, "quarter")
    return means.withColumn("avg_score", F.round("avg_score", 6))


@query("calendar_month", oracle("items") + """
select id, time from items where year(time) = 2020 and month(time) = 12""")
def calendar_month(spark, sf_dir):
    return filters.filter_calendar(items(spark, sf_dir), 2020, 12).select("id", "time")


@query("calendar_years", oracle("items") + """
select id, time from items where year(time) >= 2022""")
def calendar_years(spark, sf_dir):
    return filters.filter_calendar(items(spark, sf_dir), 2022, op=">=").select("id", "time")


@query("stories_not_hiring", oracle("items") + f"""
select id, title, '{fixed.LINK_PREFIX}' || id as link from items
where type = 'story' and not contains(title, 'Who is hiring')""")
def stories_not_hiring(spark, sf_dir):
    kept = filters.exclude_title_containing(filters.filter_type(items(spark, sf_dir), "story"))
    return kept.select("id", "title", with_link(F.col("id")).alias("link"))


@query("log_scores", oracle("items") + """
select id, case when score = 0 then '-Infinity'::double when score < 0 then 'NaN'::double
           else round(ln(score), 6) end as log_score
from items where type = 'story'""")
def log_scores(spark, sf_dir):
    kept = filters.filter_type(items(spark, sf_dir), "story")
    return kept.select("id", F.round(natural_log(F.col("score")), 6).alias("log_score"))


# --- reply forest ---------------------------------------------------------------


@query("sibling_rank", oracle("items", comments=COMMENTS, ranks=RANKS) + """
select c.id, cast(coalesce(r.rk, -1) as integer) as sibling_rank
from comments c left join ranks r on r.id = c.id""")
def sibling_rank(spark, sf_dir):
    ids = comments(spark, sf_dir).select("id")
    return forest.sibling_rank(ids, items(spark, sf_dir))


@query("rank_stats", oracle("items", ranks=RANKS) + """
select cast(max(rk) as integer) as max_rank, count(*) as ranked_ids from ranks""")
def rank_stats(spark, sf_dir):
    return forest.rank_stats(items(spark, sf_dir))


@query("siblings_count", oracle("items", comments=COMMENTS) + """
select id, parent, count(id) over (partition by parent) as siblings_count from comments""")
def siblings_count(spark, sf_dir):
    return forest.siblings_count(comments(spark, sf_dir).select("id", "parent"))


@query("nested_level", oracle("items", recursive=True, comments=COMMENTS, levels=LEVELS) + """
select c.id, cast(coalesce(l.d, -1) as integer) as nested_level
from comments c left join levels l on l.id = c.id""")
def nested_level(spark, sf_dir):
    edges = comments(spark, sf_dir).select("id", "parent", "top_level_parent")
    return forest.nested_level(edges).select("id", "nested_level")


@query("augmented_comments",
       oracle("items", recursive=True, comments=COMMENTS, ranks=RANKS, levels=LEVELS,
              ranked=RANKED) + f"""
select r.id, r.parent, r.siblings_count, cast(r.sibling_rank as integer) as sibling_rank,
       cast(coalesce(l.d, -1) as integer) as nested_level, md5({CLEAN.format("r.text")}) as md5
from ranked r left join levels l on l.id = r.id""")
def augmented_comments(spark, sf_dir):
    rows = item_rows(spark, sf_dir)
    return forest.augment_comments(rows, text_reader(spark, sf_dir)).select(
        "id", "parent", "siblings_count", "sibling_rank", "nested_level",
        F.md5("text").alias("md5"),
    )


@query("comments_of_high_scores", oracle("items", comments=COMMENTS) + """
select id, top_level_parent from comments
where top_level_parent in (select id from items where score >= 100)""")
def comments_of_high_scores(spark, sf_dir):
    roots = filters.filter_min_score(items(spark, sf_dir), fixed.MIN_ROOT_SCORE).select("id")
    kept = joins.keep_in(comments(spark, sf_dir), "top_level_parent", roots)
    return kept.select("id", "top_level_parent")


@query("thread_closure",
       oracle("items", recursive=True, comments=COMMENTS, ranks=RANKS, ranked=RANKED,
              rooted="select * from ranked", closure=CLOSURE) + """
select distinct id from closure""")
def thread_closure(spark, sf_dir):
    edges = comments(spark, sf_dir).select("id", "parent", "top_level_parent")
    ranked = forest.sibling_rank(edges, items(spark, sf_dir))
    return forest.thread_closure(ranked).select("id")


@query("pair_candidates", oracle("items", recursive=True, **_PAIRING) + """
select id, parent, cast(sibling_rank as integer) as sibling_rank, siblings_count from usable""")
def usable_comments(spark, sf_dir):
    return pair_candidates(items(spark, sf_dir)).select(
        "id", "parent", "sibling_rank", "siblings_count"
    )


@query("preference_pairs",
       oracle("items", recursive=True, **_PAIRING, pairs=PAIRS) + f"""
select chosen, rejected, cast(chosen_rank as integer) as chosen_rank,
       cast(rejected_rank as integer) as rejected_rank, top_level_parent,
       {split_sql("top_level_parent")} as split from pairs""")
def pairs(spark, sf_dir):
    return split_pairs(pair_candidates(items(spark, sf_dir)))


@query("pair_splits",
       oracle("items", recursive=True, **_PAIRING, pairs=PAIRS) + f"""
select {split_sql("top_level_parent")} as split, count(*) as count,
       round(count(*) * 100.0 / (select count(*) from pairs), 2) as percent
from pairs group by 1""")
def pair_splits(spark, sf_dir):
    found = split_pairs(pair_candidates(items(spark, sf_dir)))
    return trends.value_counts(found, "split", pct=True)


@query("ancestor_chain", oracle("items", recursive=True, comments=COMMENTS, up=UP) + """
select u.id, cast(u.depth as integer) as depth, i."by" as author, md5(i.text) as md5
from up u join items i on i.id = u.anc""")
def ancestor_chain(spark, sf_dir):
    rows = item_rows(spark, sf_dir)
    asked = filters.filter_type(rows, "comment").select("id", "top_level_parent")
    chains = forest.ancestor_chain(asked, rows, F.md5("text"), text_reader(spark, sf_dir))
    steps = chains.select("id", F.posexplode("chain").alias("depth", "a"))
    return steps.select("id", "depth", "a.author", F.col("a.text").alias("md5"))


def _prompt_query(version: str):
    def run(spark, sf_dir):
        rows = item_rows(spark, sf_dir)
        ids = filters.filter_type(rows, "comment").select("id")
        steps = prompt_steps(ids, rows, (version,), text_reader(spark, sf_dir))
        return steps.each(lambda prompts: _digest(prompts, f"prompt_{version}"), "prompt-digests")

    return run


for _version, _sql in (("v1", PROMPT_V1), ("v2", PROMPT_V2)):
    query(f"comment_prompt_{_version}",
          oracle("items", recursive=True, comments=COMMENTS, up=UP, chains=CHAINS) + f"""
select id, md5(p) as md5, length(p) as chars
from (select c.id, {_sql} as p {PROMPT_FROM})""")(_prompt_query(_version))


@query("comments_with_story", oracle("items", comments=COMMENTS) + """
select c.id, c.top_level_parent, s.title as story_title, s.url as story_url
from comments c left join items s on s.id = c.top_level_parent and s.type = 'story'""")
def comments_with_story(spark, sf_dir):
    asked = comments(spark, sf_dir).select("id", "top_level_parent")
    return joins.with_story_info(asked, items(spark, sf_dir))


_SAMPLES = dict(
    split_pairs=f"select *, {split_sql('top_level_parent')} as split, {unit_sql('rejected')} as u from pairs",
    sampled="select * from split_pairs order by u, rejected limit 100000",
    published="""
select * from (select *, row_number() over (partition by split order by u, rejected) as rn from sampled)
where rn <= case split when 'train' then 30000 when 'val' then 500 else 1000 end""",
)


@query("pair_dataset",
       oracle("items", recursive=True, **_PAIRING, pairs=PAIRS, up=UP, chains=CHAINS,
              prompts=f"select c.id, {PROMPT_V1} as p1, {PROMPT_V2} as p2 {PROMPT_FROM}",
              **_SAMPLES) + """
select p.chosen, p.rejected, case p.split when 'val' then 'validation' else p.split end as split,
       md5(a.p1) as chosen_v1, md5(b.p1) as rejected_v1,
       md5(a.p2) as chosen_v2, md5(b.p2) as rejected_v2
from published p join prompts a on a.id = p.chosen join prompts b on b.id = p.rejected""")
def pair_dataset(spark, sf_dir):
    built = build_pair_dataset(items(spark, sf_dir))
    return built.splits.select(
        "chosen", "rejected", "split",
        *[F.md5(f"{side}_prompt_{v}").alias(f"{side}_{v}")
          for v in ("v1", "v2") for side in ("chosen", "rejected")],
    )


@query("held_out_top_comments",
       oracle("items", recursive=True, **_PAIRING, pairs=PAIRS, up=UP, chains=CHAINS, **_SAMPLES,
              held="""
select * from usable where sibling_rank = 1
  and id not in (select chosen from published where split = 'train')
  and id not in (select rejected from published where split = 'train')""") + f"""
select id, md5(p) as md5, length(p) as chars from (
select c.id, {PROMPT_V1} as p from held c
join items s on s.id = c.top_level_parent left join chains h on h.id = c.id)""")
def held_out_top_comments(spark, sf_dir):
    return _digest(build_pair_dataset(items(spark, sf_dir)).held_out, "prompt")


# --- texts and regression rows ----------------------------------------------------


@query("clean_text", oracle("items") + f"""
select id, md5({CLEAN.format("text")}) as md5, length({CLEAN.format("text")}) as chars from items""")
def clean_text(spark, sf_dir):
    read = items(spark, sf_dir).select("id", unescape_html(F.col("text")).alias("text"))
    return _digest(read, "text")


_BODY = (
    "coalesce(replace(replace(replace(text, '&#x27;', ''''), '&amp;', '&'), '<p>',"
    " chr(10) || chr(10)), 'None')"
)
_PLAIN = f"""chr(10) || coalesce(title, 'None') || chr(10) || coalesce("by", 'None') || ', '
  || strftime(time, '%Y-%m-%d') || chr(10) || chr(10) || {_BODY} || chr(10)"""


@query("serialized_plain", oracle("items") + f"""
select id, {_PLAIN} as serialized from items where {TEXT_STORY}""")
def serialized_plain(spark, sf_dir):
    kept = text_posts(spark, sf_dir)
    return kept.select("id", serialize_story("plain").alias("serialized"))


@query("serialized_by", oracle("items") + f"""
select id, chr(10) || coalesce(title, 'None') || chr(10) || 'by ' || coalesce("by", 'None') || ', '
  || strftime(time, '%B %d, %Y') || chr(10) || chr(10) || {_BODY} || chr(10) as serialized
from items where {TEXT_STORY}""")
def serialized_by(spark, sf_dir):
    kept = text_posts(spark, sf_dir)
    return kept.select("id", serialize_story("by").alias("serialized"))


_STORY_SET = f"""
select id, title, "by", score, descendants, time,
       case when score = 0 then '-Infinity'::double else ln(score) end as log_score,
       {_PLAIN} as serialized, {split_sql("id")} as split, {unit_sql("id")} as u
from items where {TEXT_STORY} and time >= timestamp '2016-01-01'"""


@query("story_dataset", oracle("items", stories=_STORY_SET) + """
select id, title, "by", score, descendants, time, round(log_score, 6) as log_score,
       md5(serialized) as md5, split from stories""")
def story_dataset(spark, sf_dir):
    built = build_story_dataset(text_posts(spark, sf_dir))
    return built.select(
        "id", "title", "by", "score", "descendants", "time",
        F.round("log_score", 6).alias("log_score"), F.md5("serialized").alias("md5"), "split",
    )


@query("training_rows", oracle("items", stories=_STORY_SET) + r"""
select id, label, len(tokens) as tokens, md5(array_to_string(tokens, ' ')) as md5 from (
  select id, round(log_score, 6) as label, regexp_extract_all(serialized, '\S+') as tokens
  from stories where split = 'train' order by u, id limit 200)
where len(tokens) <= 600""")
def story_training_rows(spark, sf_dir):
    rows = training_rows(build_story_dataset(text_posts(spark, sf_dir)), "train", 200, max_len=600)
    return rows.select(
        "id", F.round("label", 6).alias("label"), F.size("tokens").cast("bigint").alias("tokens"),
        F.md5(F.array_join("tokens", " ")).alias("md5"),
    )


# --- sampling -----------------------------------------------------------------------


@query("row_splits", oracle("items") + f"""
select id, {split_sql("id")} as split from items""")
def row_splits(spark, sf_dir):
    return sampling.split_rows(items(spark, sf_dir).select("id"))


@query("shuffled", oracle("items") + f"select id, {unit_sql('id')} as shuffle_key from items")
def shuffled(spark, sf_dir):
    return sampling.with_shuffle_key(items(spark, sf_dir).select("id"))


@query("shuffled_table", oracle("items", ordered=f"""
select id, type, {split_sql("id")} as split, {unit_sql("id")} as shuffle_key from items""") + """
select id, type, split, shuffle_key from (
  select *, row_number() over (partition by split order by shuffle_key, id) as place from ordered)
where place <= case split when 'train' then 800 when 'test' then 50 else 0 end""")
def shuffled_table(spark, sf_dir):
    """All items stored in shuffled order by split; the first rows of two splits read back."""
    path = f"{scratch_root(spark)}/agora-shuffled-{uuid.uuid4().hex}"
    rows = sampling.split_rows(items(spark, sf_dir).select("id", "type"))
    sampling.write_shuffled(rows, path, split="split", parts=16)
    heads = [sampling.head_of_shuffled(spark, path, n, split=name) for name, n in (("train", 800), ("test", 50))]
    return heads[0].unionByName(heads[1]).select("id", "type", "split", "shuffle_key")


@query("sample_n", oracle("items") + f"""
select id, type from items order by {unit_sql('id')}, id limit 1500""")
def sample_n(spark, sf_dir):
    return sampling.sample_n(items(spark, sf_dir).select("id", "type"), 1500)


@query("sample_nullable", oracle("items") + f"""
select key, type from (select case when parent is not null then id end as key, type from items)
where key is not null order by {unit_sql('key')}, key limit 700""")
def sample_nullable(spark, sf_dir):
    """Rows without a key are never sampled."""
    key = F.when(F.col("parent").isNotNull(), F.col("id")).alias("key")
    return sampling.sample_n(items(spark, sf_dir).select(key, "type"), 700, "key")


@query("sample_per_split", oracle("items") + f"""
select id, split from (
  select *, row_number() over (partition by split order by u, id) as rn
  from (select id, {split_sql("top_level_parent")} as split, {unit_sql("id")} as u from items))
where rn <= case split when 'train' then 300 when 'test' then 40 else 25 end""")
def sample_per_split(spark, sf_dir):
    tagged = sampling.split_by_group(
        items(spark, sf_dir).select("id", "top_level_parent"), "top_level_parent"
    )
    sizes = {"train": 300, "test": 40, "val": 25}
    return sampling.sample_per_split(tagged, sizes).select("id", "split")


@query("head_of_split", oracle("items") + f"""
select id from (select id, {split_sql("id")} as split, {unit_sql("id")} as u from items)
where split = 'test' order by u, id limit 100""")
def head_of_split(spark, sf_dir):
    tagged = sampling.split_rows(items(spark, sf_dir).select("id"))
    return sampling.head_of_split(tagged, "test", 100).select("id")


@query("first_stories", oracle("items") + f"""
select id, title, score from items where type = 'story' and score >= 20
order by {unit_sql("id")}, id limit 60""")
def first_stories(spark, sf_dir):
    stories = filters.filter_type(items(spark, sf_dir), "story").select("id", "title", "score")
    return sampling.take_first(filters.filter_min_score(stories, 20), 60)

"""Model x item benchmark results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.operators.quantiles import percentiles_of_staged
from agora.sources.staging import stage

ORIGINAL = "Original"
_ITEM_FIELDS = ("original_title", "original_score", "rm_score_original")
_RESULT_FIELDS = ("generated_title", "score", "api_time", "total_time", "full_response", "error")


def benchmark_summary(results: DataFrame) -> DataFrame:
    """Per model: score, time and original-score figures with sample counts.

    Scores and times are averaged over scored rows only and are 0 for a model
    without any; the original score is averaged wherever present.
    """
    figures = ("model", "score", "total_time", "api_time", "rm_score_original")
    results = stage(results.select(*figures), "figures")
    scored = F.col("score").isNotNull()

    def mean_scored(column: str) -> Column:
        mean = F.avg(F.when(scored, F.col(column).cast("double")))
        return F.coalesce(mean, F.lit(0.0))

    means = results.groupBy("model").agg(
        mean_scored("score").alias("avg_score"),
        mean_scored("total_time").alias("avg_total_time"),
        mean_scored("api_time").alias("avg_api_time"),
        F.avg(F.col("rm_score_original").cast("double")).alias("avg_rm_original_score"),
        F.count(F.lit(1)).alias("sample_count"),
        F.count("score").alias("valid_sample_count"),
    )
    medians = percentiles_of_staged(results, ["model"], "score", [0.5])
    return (
        # One row per model.
        means.join(medians, "model", "left")
        .withColumn("median_score", F.coalesce("p0", F.lit(0.0)))
        .drop("p0")
    )


def nest_results(long: DataFrame, model_order: list[str] | None = None) -> DataFrame:
    """One row per item with a map from model to its result.

    Item fields come from the first model in ``model_order`` (alphabetical
    when not given).  Repeated (item, model) rows are reduced first, so an
    item's map never holds more entries than there are models.  The body is an
    aggregate of its own, which goes away for readers that do not ask for it.
    """
    fields = [c for c in _ITEM_FIELDS if c in long.columns]
    results = [c for c in _RESULT_FIELDS if c in long.columns]
    has_body = "scraped_body" in long.columns
    place = F.col("model")
    if model_order:
        names = F.array(*[F.lit(m) for m in model_order])
        place = F.struct(
            F.when(F.array_contains(names, F.col("model")), F.array_position(names, F.col("model")))
            .otherwise(len(model_order) + 1)
            .alias("at"),
            "model",
        )
    bodies = [F.max("scraped_body").alias("scraped_body")] * has_body
    per_model = long.groupBy("item_id", "model").agg(
        F.max(F.struct(F.struct(*results), F.struct(*fields))).alias("row"), *bodies
    )
    named = F.struct("model", F.col("row.col1").alias("result"))
    first_body = [F.min_by("scraped_body", place).alias("scraped_body")] * has_body
    return (
        per_model.groupBy("item_id")
        .agg(
            F.min_by("row.col2", place).alias("item"),
            *first_body,
            F.map_from_entries(F.array_sort(F.collect_list(named))).alias("model_results"),
        )
        .select("item_id", "item.*", *["scraped_body"] * has_body, "model_results")
    )


def _entries(nested: DataFrame) -> Column:
    """The original and every model result as (model, score, title)."""
    original = F.struct(
        F.lit(ORIGINAL).alias("model"),
        F.col("rm_score_original").cast("double").alias("score"),
        F.col("original_title").alias("title"),
    )
    models = F.transform(
        F.map_entries("model_results"),
        lambda e: F.struct(
            e["key"].alias("model"),
            e["value"]["score"].cast("double").alias("score"),
            e["value"]["generated_title"].alias("title"),
        ),
    )
    return F.concat(F.array(original), models)


def mean_score_by_model(nested: DataFrame) -> DataFrame:
    """Mean score per model and of the originals, best first; unscored ones have no row."""
    return (
        nested.select(F.explode(_entries(nested)).alias("e"))
        .where(F.col("e.score").isNotNull())
        .groupBy(F.col("e.model").alias("model"))
        .agg(F.avg("e.score").alias("average_score"))
        .orderBy(F.desc("average_score"), "model")
    )


def rank_titles(nested: DataFrame) -> DataFrame:
    """Per item, the original and model titles by score, best first, unscored last.

    An item's titles are already together in its row, so they are sorted in
    place as an array and nothing is shuffled.
    """
    keyed = F.transform(
        _entries(nested),
        lambda e: F.struct(
            e["score"].isNull().alias("unscored"),
            (-e["score"]).alias("down"),
            e["model"].alias("model"),
            e["score"].alias("score"),
            e["title"].alias("title"),
        ),
    )
    has_models = F.size("model_results") > 0
    return (
        nested.where(has_models)
        .select("item_id", F.posexplode(F.array_sort(keyed)).alias("at", "e"))
        .select(
            "item_id",
            (F.col("at") + 1).alias("place"),
            F.col("e.model").alias("model"),
            F.col("e.score").alias("score"),
            F.col("e.title").alias("title"),
        )
    )

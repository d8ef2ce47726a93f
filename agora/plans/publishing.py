"""Writing of finished results: datasets as Parquet, reports as CSV, benchmarks as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora import fixed_values as fixed
from agora.functions.stories import with_link
from agora.operators import benchmark, ranking
from agora.plans.evaluations import rating_reports, with_predicted_score
from agora.plans.pair_dataset import PairDataset
from agora.sources.staging import stage
from agora.sources.tables import write_csv_report, write_results_json, write_splits, write_table


def publish_pairs(built: PairDataset, folder: str, versions: tuple[str, ...] = ("v1", "v2")) -> None:
    """One split set per prompt version and the held-out comments."""
    for version in versions:
        prompts = {
            f"{side}_prompt_{version}": f"{side}_prompt" for side in ("chosen", "rejected")
        }
        named = built.splits.withColumnsRenamed(prompts)
        others = [c for c in named.columns if "_prompt_" in c]
        write_splits(named.drop(*others), f"{folder}/sample_pairs_{version}")
    write_table(built.held_out, f"{folder}/top_comments")


def publish_leaderboards(scored: DataFrame, folder: str, n: int = 100) -> None:
    """One CSV per top list of stories with ``predictions``, in rank order."""
    boards = ranking.score_leaderboards(with_predicted_score(scored), n)
    boards = stage(boards.withColumn("link", with_link(F.col("id"))), "boards")
    for name, (column, desc, _) in ranking.LEADERBOARDS.items():
        ranked = ranking.top_n(boards.where(F.col("list") == name), column, n, desc)
        write_csv_report(ranked.select(*fixed.STORY_REPORT), f"{folder}/{name}")


def publish_ratings(rated: DataFrame, folder: str, n: int = 100) -> None:
    """CSVs of the best and the worst rated comments."""
    for name, report in rating_reports(rated, n).items():
        write_csv_report(report.select(*fixed.COMMENT_REPORT), f"{folder}/{name}_comments")


def publish_benchmark(results: DataFrame, folder: str, model_order: list[str] | None = None) -> None:
    """Results by item as JSON and the figures per model."""
    write_results_json(benchmark.nest_results(results, model_order), f"{folder}/by_item")
    write_table(benchmark.benchmark_summary(results), f"{folder}/by_model")

"""Whole runs: a rate-limited replay with scoring, and the fusion study with ablation and attribution."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from brookmill.operators import attribution, models
from brookmill.plans.queries import FEATURE_GROUPS, FUSED, _fused_input
from brookmill.session import materialise, shared_path
from brookmill.sources.tables import EVENTS, load
from brookmill.streaming.replay import replay_records
from brookmill.streaming.scoring import label


def replay_run(
    spark: SparkSession,
    folder: str,
    qps: float = 200,
    max_records: int = 10_000,
    model: PipelineModel | None = None,
) -> DataFrame:
    """Replay stored events at ``qps`` and label each batch; the labels."""
    out = replay_records(
        load(spark, folder, "events"),
        EVENTS,
        ["ts", "event_id"],
        shared_path(spark, "replay"),
        lambda batch: label(batch, model),
        qps,
        max_records,
    )
    return spark.read.schema("event_id BIGINT, prediction INT, batch_id INT").parquet(out)


def fusion_run(spark: SparkSession, folder: str, balanced: bool = False) -> dict[str, DataFrame]:
    """Boosted trees on fused features: scores, ablation over feature groups, Shapley value per group."""
    fused = materialise(_fused_input(spark, folder), "fused")
    groups = {**FEATURE_GROUPS, "text": ("tfidf",)}
    trees = models.boosted_trees("quality")
    labelled = fused.where("quality IS NOT NULL")
    table = models.ablation(labelled, groups, "quality", trees, balanced=balanced)
    return {
        "scores": models.fit_score(fused, [*FUSED, "tfidf"], "quality", trees, balanced=balanced),
        "ablation": table,
        "shapley": attribution.group_shapley(table, sorted(groups)),
    }

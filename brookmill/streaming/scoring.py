"""Labels for records, by one function for batches and streams alike."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 250.0


def label(events: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """``event_id, prediction``: from the model, or from a fixed rule where none is given."""
    if model is not None:
        return model.transform(events).select("event_id", F.col("prediction").cast("int"))
    flagged = (F.col("event_type") == "error") | (F.col("value") > LIMIT)
    return events.select("event_id", flagged.cast("int").alias("prediction"))

"""Exact measures of a ranking by scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmill.operators.skew import running_sums


def rank_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., n_positive, n_negative, auc``: the chance that a row of class 1 scores above one of class 0, ties counting half.

    That is the area under the ROC curve, by ranks that are averaged over ties. Equal scores collapse to counts in the map
    tasks; over the ordered distinct scores, ranges carry the number of negatives below. All sums are whole numbers, so the
    result does not depend on the partitions. Rows whose label is not 0 or 1, or whose score is null, do not count; NaN scores
    above all others. Without rows of both classes the area is null; without any row a group has no row.
    """
    by = list(by)
    one = F.lit(1).alias("_all")
    rows = df.where(F.col(label).isin(0, 1) & F.col(score).isNotNull())
    counts = rows.groupBy(*(by or [one]), F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_positive"), F.count_if(F.col(label) == 0).alias("_negative")
    )
    below = running_sums(counts, by or ["_all"], [F.col("_score")], ["_negative"])
    wide = "decimal(38,0)"
    # Twice the number of pairs that are ordered rightly: each positive beats all negatives below, and ties with its own.
    twice = F.col("_positive").cast("decimal(19,0)") * (2 * F.col("_negative_upto") - F.col("_negative")).cast("decimal(19,0)")
    sums = below.groupBy(*(by or ["_all"])).agg(
        F.sum(twice.cast(wide)).alias("_twice"),
        F.sum("_positive").alias("n_positive"),
        F.sum("_negative").alias("n_negative"),
    )
    pairs = 2.0 * F.col("n_positive").cast("double") * F.col("n_negative").cast("double")
    auc = F.when(pairs > 0, F.col("_twice").cast("double") / pairs)
    return sums.select(*by, "n_positive", "n_negative", auc.alias("auc"))

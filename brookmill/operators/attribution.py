"""How much each feature, or group of features, adds to a result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.functions.numbers import rounded


def cell_ablation(df: DataFrame, groups: Mapping[str, Column], label: str) -> DataFrame:
    """``subset, metric``: accuracy of the majority label per cell, for every subset of groups.

    A model-free ablation: a cell is one combination of the subset's values, and predicts its most frequent
    label. Rows are counted once at the finest cells; the cube runs on those counts.
    """
    names = sorted(groups)
    cells = df.groupBy(*[groups[g].alias(g) for g in names], F.col(label).alias("_label")).agg(
        F.count("*").alias("_n")
    )
    sets = [[g for i, g in enumerate(names) if mask >> i & 1] for mask in range(2 ** len(names))]
    level = F.grouping_id().alias("_gid")
    by_label = cells.groupingSets(
        [[F.col(c) for c in [*s, "_label"]] for s in sets], *names, "_label"
    ).agg(level, F.sum("_n").alias("_n"))
    voted = by_label.groupBy("_gid", *names).agg(
        F.max("_n").alias("_hits"), F.sum("_n").alias("_rows")
    )
    # grouping_id has one bit per grouped column, the first one highest; a set bit means "not in the subset".
    members = F.filter(
        F.array(
            *[
                F.when(F.shiftright("_gid", len(names) - i).bitwiseAND(1) == 0, g)
                for i, g in enumerate(names)
            ]
        ),
        lambda g: g.isNotNull(),
    )
    return (
        voted.groupBy("_gid")
        .agg((F.sum("_hits") / F.sum("_rows")).alias("metric"))
        .select(members.alias("subset"), "metric")
    )


def group_shapley(coalitions: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``grp, phi``: exact Shapley value of each group from the metric of every subset.

    With m groups, a subset of size s adds ``(s-1)! (m-s)! / m!`` of its metric to each member and
    takes ``s! (m-s-1)! / m!`` from each other group, so one pass replaces the join of S with S + g.
    Without any subset, the values are null.
    """
    m = len(groups)
    share = [factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)]
    shares = F.array(*[F.lit(w) for w in share])
    size = F.size("subset")

    def value(group: str) -> Column:
        inside = F.array_contains(F.col("subset"), F.lit(group))
        part = F.when(inside, F.get(shares, size - 1)).otherwise(-F.get(shares, size))
        return F.sum(part * F.col("metric"))

    sums = coalitions.agg(*[value(g).alias(f"_{i}") for i, g in enumerate(groups)])
    rows = [F.struct(F.lit(g).alias("grp"), rounded(F.col(f"_{i}")).alias("phi")) for i, g in enumerate(groups)]
    return sums.select(F.inline(F.array(*rows)))


def linear_shap(df: DataFrame, coef: Mapping[str, float], id: str = "doc_id") -> DataFrame:
    """``id, feature, phi`` with ``phi = w * (x - mean(x))`` for a linear score.

    The means are scalar subqueries over one shared aggregate; rows are expanded where they are.
    """
    means = df.agg(*[F.avg(c).alias(c) for c in coef])
    parts = [
        F.struct(
            F.lit(c).alias("feature"),
            rounded(F.lit(float(w)) * (F.col(c) - means.select(c).scalar())).alias("phi"),
        )
        for c, w in coef.items()
    ]
    return df.select(id, F.explode(F.array(*parts)).alias("p")).select(id, "p.feature", "p.phi")

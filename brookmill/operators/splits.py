"""Exact split search, and decision trees grown by it level by level.

Class counts per value of a feature are one aggregate, which the map tasks combine. Running sums over the ordered
values then give the counts on both sides of every possible split; no sample, no bins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.functions.numbers import rounded
from brookmill.operators.skew import running_sums
from brookmill.session import materialise

MAX_DEPTH = 10


def _gini(n: Column, positive: Column) -> Column:
    """Gini impurity times the number of rows: a whole number over a whole number."""
    return F.try_divide(2 * positive * (n - positive), n)  # no row is impure on an empty side, which is not used


def value_counts(df: DataFrame, features: Sequence[str], label: str, node: str = "node") -> DataFrame:
    """``node, feature, value, n, positive``: rows and rows of class 1 for each value of each feature."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    rows = df.select(node, F.explode(pairs).alias("_pair"), F.col(label).cast("bigint").alias("_class"))
    return rows.groupBy(node, F.col("_pair.feature").alias("feature"), F.col("_pair.value").alias("value")).agg(
        F.count("*").alias("n"), F.sum("_class").alias("positive")
    )


def best_splits(df: DataFrame, features: Sequence[str], label: str, node: str = "node") -> DataFrame:
    """The best split of each node by each feature, and which of them is the node's ``best``.

    ``node, feature, threshold, gain, n, positive, n_left, positive_left, best``. Values up to ``threshold`` go left, all
    others, and null, go right. ``gain`` is the decrease of the Gini impurity, rounded; among equal gains the smaller threshold and
    the first feature in name order win. ``label`` holds 0 and 1 only. A feature with one value has no split.
    """
    counts = value_counts(df, features, label, node)
    order = [F.asc_nulls_last("value")]
    summed = materialise(running_sums(counts, [node, "feature"], order, ["n", "positive"]), "split-counts")
    totals = summed.groupBy(F.col(node).alias("_node"), F.col("feature").alias("_feature")).agg(
        F.max("n_upto").alias("_n"), F.max("positive_upto").alias("_positive")
    )
    same = F.col(node).eqNullSafe(F.col("_node")) & (F.col("feature") == F.col("_feature"))
    both = summed.join(F.broadcast(totals), same).drop("_node", "_feature")  # a row per node and feature: the caller opens few
    sides = both.where("value IS NOT NULL AND NOT isnan(value) AND n_upto < _n")
    left, right = (F.col("n_upto"), F.col("positive_upto")), (F.col("_n") - F.col("n_upto"), F.col("_positive") - F.col("positive_upto"))
    gain = rounded((_gini(F.col("_n"), F.col("_positive")) - _gini(*left) - _gini(*right)) / F.col("_n"), 9)
    scored = sides.withColumn("gain", gain)
    tops = scored.groupBy(F.col(node).alias("_node"), F.col("feature").alias("_feature")).agg(F.max("gain").alias("_gain"))
    highest = scored.join(
        F.broadcast(tops),
        F.col(node).eqNullSafe(F.col("_node")) & (F.col("feature") == F.col("_feature")) & (F.col("gain") == F.col("_gain")),
    )
    counts_there = F.struct("value", "gain", "_n", "_positive", "n_upto", "positive_upto")
    each = highest.groupBy(node, "feature").agg(F.min_by(counts_there, "value").alias("s"))
    first = each.groupBy(F.col(node).alias("_node")).agg(
        F.min_by("feature", F.struct(-F.col("s.gain"), "feature")).alias("_first")
    )
    return each.join(F.broadcast(first), F.col(node).eqNullSafe(F.col("_node"))).select(
        node,
        "feature",
        F.col("s.value").alias("threshold"),
        F.col("s.gain").alias("gain"),
        F.col("s._n").alias("n"),
        F.col("s._positive").alias("positive"),
        F.col("s.n_upto").alias("n_left"),
        F.col("s.positive_upto").alias("positive_left"),
        (F.col("feature") == F.col("_first")).alias("best"),
    )


@dataclass(frozen=True)
class Node:
    """A node of a grown tree; its children are 2 * id (left) and 2 * id + 1. A leaf has no feature."""

    id: int
    n: int
    positive: int
    feature: str | None = None
    threshold: float | None = None
    gain: float | None = None


def place(nodes: Sequence[Node]) -> Column:
    """The leaf that a row falls into, as a column expression over the features."""
    by_id = {node.id: node for node in nodes}

    def below(id: int) -> Column:
        node = by_id[id]
        if node.feature is None:
            return F.lit(id)
        left = F.coalesce(F.col(node.feature) <= F.lit(node.threshold), F.lit(False))
        return F.when(left, below(2 * id)).otherwise(below(2 * id + 1))

    return below(1)


def grow(df: DataFrame, features: Sequence[str], label: str, depth: int) -> list[Node]:
    """A tree of ``depth`` levels of splits; nodes are split while that gains anything.

    One search per level covers all open nodes; the driver gets one row per node and feature. ``df`` is read once per level:
    materialise it first. Rows whose label is not 0 or 1 teach nothing; without any other row the tree is empty.
    """
    if not 0 <= depth <= MAX_DEPTH:
        raise ValueError(f"a depth of 0 to {MAX_DEPTH} levels")
    rows = df.where(F.col(label).isin(0, 1))
    total = rows.agg(F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("positive")).first()
    if not total.n:
        return []
    nodes = {1: Node(1, total.n, total.positive)}
    for level in range(depth):
        inside = place(list(nodes.values()))
        open_ = [i for i, node in nodes.items() if i >= 1 << level and 0 < node.positive < node.n]
        if not open_:
            break
        searched = best_splits(rows.withColumn("node", inside).where(F.col("node").isin(open_)), features, label)
        for s in searched.where("best AND gain > 0").collect():
            nodes[s.node] = Node(s.node, s.n, s.positive, s.feature, s.threshold, s.gain)
            nodes[2 * s.node] = Node(2 * s.node, s.n_left, s.positive_left)
            nodes[2 * s.node + 1] = Node(2 * s.node + 1, s.n - s.n_left, s.positive - s.positive_left)
    return [nodes[i] for i in sorted(nodes)]


TREE = "node INT, feature STRING, threshold DOUBLE, gain DOUBLE, n LONG, positive LONG"


def tree_rows(df: DataFrame, nodes: Sequence[Node]) -> DataFrame:
    """The nodes as a table, for a report."""
    rows = [(x.id, x.feature, x.threshold, x.gain, x.n, x.positive) for x in nodes]
    return df.sparkSession.createDataFrame(rows, TREE)


def tree_nodes(rows: DataFrame) -> list[Node]:
    """The nodes of a stored ``tree_rows``."""
    found = [Node(r.node, r.n, r.positive, r.feature, r.threshold, r.gain) for r in rows.collect()]  # as many as the depth allows
    return sorted(found, key=lambda node: node.id)


def score(nodes: Sequence[Node]) -> Column:
    """The share of class 1 in the leaf that a row falls into, as a column expression over the features; null for no tree."""
    by_id = {node.id: node for node in nodes}

    def below(id: int) -> Column:
        node = by_id[id]
        if node.feature is None:
            return F.lit(node.positive / node.n)
        left = F.coalesce(F.col(node.feature) <= F.lit(node.threshold), F.lit(False))
        return F.when(left, below(2 * id)).otherwise(below(2 * id + 1))

    return below(1) if by_id else F.lit(None).cast("double")

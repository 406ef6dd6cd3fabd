"""Exact Shapley values of tree models, as column expressions.

The game of a document: a set of known features is worth what the tree gives on average if it follows the document at splits on
known features, and at others goes both ways in the proportion of the training rows there. That game is a sum over
leaves. A leaf's share is its value times one factor per feature on its path: does the document meet all its conditions (known), or what
share of the rows does (unknown). The Shapley value of such a product depends only on *which* of the path's features the document
meets; these few cases are worked out once per leaf, and a document's value is one lookup by that pattern.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import factorial, prod

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.functions.numbers import rounded
from brookmill.operators.splits import Node

MAX_PATH = 12
TABLED = 10


@dataclass(frozen=True)
class Step:
    """One split on the way to a leaf: the side taken, and the share of the split's rows on it."""

    feature: str
    threshold: float
    left: bool
    share: float


@dataclass(frozen=True)
class Leaf:
    value: float
    path: tuple[Step, ...]


Tree = Sequence[Leaf]


def grown_leaves(nodes: Sequence[Node]) -> list[Leaf]:
    """The leaves of a tree of ``splits.grow``; a leaf is worth its share of class 1."""
    by_id = {node.id: node for node in nodes}

    def below(id: int, path: tuple[Step, ...]) -> list[Leaf]:
        node = by_id[id]
        if node.feature is None:
            return [Leaf(node.positive / node.n, path)]
        sides = [(2 * id, True), (2 * id + 1, False)]
        return [
            leaf
            for child, left in sides
            for leaf in below(child, (*path, Step(node.feature, node.threshold, left, by_id[child].n / node.n)))
        ]

    return below(1, ()) if by_id else []


def ensemble_trees(model: PipelineModel) -> list[tuple[float, list[Leaf]]]:
    """Weight and leaves of every tree of a fitted pipeline: an assembler of number columns, then boosted trees or a forest.

    Boosted trees explain the margin, ``rawPrediction[1]``; a forest of classification trees the probability of class 1. The shares are
    those of the training rows (by weight) that each node keeps. Splits on categories are refused.
    """
    assembler, ensemble = model.stages
    names = assembler.getInputCols()
    voting = isinstance(ensemble, RandomForestClassificationModel)

    def worth(node) -> float:
        if not voting:
            return node.prediction()
        counts = list(node.impurityStats().stats())
        return counts[1] / sum(counts)

    def below(node, path: tuple[Step, ...]) -> list[Leaf]:
        if node.numDescendants() == 0:
            return [Leaf(worth(node), path)]
        split = node.split()
        if split.getClass().getSimpleName() != "ContinuousSplit":
            raise ValueError("only splits on numbers are supported")
        feature, threshold = names[split.featureIndex()], split.threshold()
        return [
            leaf
            for child, left in ((node.leftChild(), True), (node.rightChild(), False))
            for leaf in below(child, (*path, Step(feature, threshold, left, _weight(child, voting) / _weight(node, voting))))
        ]

    roots = [tree._call_java("rootNode") for tree in ensemble.trees]
    weights = [1 / len(roots)] * len(roots) if voting else ensemble.treeWeights
    return [(weight, below(root, ())) for weight, root in zip(weights, roots)]


def _weight(node, voting: bool) -> float:
    """The training rows of a node, by weight: class counts, or the first of the moments of a regression tree."""
    stats = list(node.impurityStats().stats())
    return sum(stats) if voting else stats[0]


def _conditions(leaf: Leaf) -> dict[str, tuple[list[Step], float]]:
    """Per feature on the path: its steps, and the product of their shares."""
    out: dict[str, tuple[list[Step], float]] = {}
    for step in leaf.path:
        steps, share = out.get(step.feature, ([], 1.0))
        out[step.feature] = [*steps, step], share * step.share
    if len(out) > MAX_PATH:
        raise ValueError(f"a path over {len(out)} features; at most {MAX_PATH} are supported")
    return out


def _met(step: Step, inputs: Mapping[str, Column]) -> Column:
    left = F.coalesce(inputs[step.feature] <= F.lit(float(step.threshold)), F.lit(False))  # null goes right
    return left if step.left else ~left


def pattern_values(shares: Sequence[float], value: float) -> np.ndarray:
    """Shapley values of a leaf by pattern: row ``p``, column ``f`` if just the features of the bits of ``p`` are met."""
    m = len(shares)
    weight = [factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)]
    table = np.zeros((1 << m, m))
    for pattern in range(1 << m):
        for f in range(m):
            by_size = np.array([value])  # coefficient s: sum over the sets of s other features
            for g in range(m):
                if g != f:
                    by_size = np.convolve(by_size, [shares[g], pattern >> g & 1])
            table[pattern, f] = ((pattern >> f & 1) - shares[f]) * sum(w * c for w, c in zip(weight, by_size))
    return table


def _sum(columns: Sequence[Column]) -> Column:
    """A sum as a balanced tree of additions: a long chain would be a deep expression."""
    while len(columns) > 1:
        columns = [columns[i] + columns[i + 1] if i + 1 < len(columns) else columns[i] for i in range(0, len(columns), 2)]
    return columns[0] if columns else F.lit(0.0)


def base_value(trees: Sequence[tuple[float, Tree]]) -> float:
    """What the ensemble gives with nothing known: the mean over the training rows."""
    return sum(weight * leaf.value * prod(s.share for s in leaf.path) for weight, tree in trees for leaf in tree)


def margin(trees: Sequence[tuple[float, Tree]], inputs: Mapping[str, Column]) -> Column:
    """What the ensemble gives for a row."""
    return _sum([F.when(_all([_met(s, inputs) for s in leaf.path]), weight * leaf.value).otherwise(0.0) for weight, tree in trees for leaf in tree])


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _by_leaf(weight: float, leaf: Leaf, inputs: Mapping[str, Column]) -> dict[str, Column]:
    """A leaf's part of each feature's value: one pattern and its lookups."""
    found = _conditions(leaf)
    met = [_all([_met(s, inputs) for s in steps]) for steps, _ in found.values()]
    pattern = _sum([F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(met)])
    table = pattern_values([share for _, share in found.values()], weight * leaf.value)
    return {feature: F.get(F.lit(table[:, i]), pattern) for i, feature in enumerate(found)}


def _by_tree(weight: float, tree: Tree, splits: Sequence[tuple[str, float]], inputs: Mapping[str, Column]) -> dict[str, Column]:
    """A small tree's part of each feature's value: the pattern of all its splits, and one lookup per feature."""
    patterns = np.arange(1 << len(splits))
    tables: dict[str, np.ndarray] = {}
    for leaf in tree:
        found = _conditions(leaf)
        met = np.zeros(len(patterns), int)
        for i, (steps, _) in enumerate(found.values()):
            bits = [(patterns >> splits.index((s.feature, s.threshold)) & 1) == s.left for s in steps]
            met += np.logical_and.reduce(bits).astype(int) << i
        values = pattern_values([share for _, share in found.values()], weight * leaf.value)[met]
        for i, feature in enumerate(found):
            tables[feature] = tables.get(feature, 0) + values[:, i]
    sides = [F.when(_met(Step(f, t, True, 1.0), inputs), F.lit(1 << i)).otherwise(F.lit(0)) for i, (f, t) in enumerate(splits)]
    pattern = _sum(sides)
    return {feature: F.get(F.lit(table), pattern) for feature, table in tables.items()}


def shapley_columns(trees: Sequence[tuple[float, Tree]], inputs: Mapping[str, Column]) -> dict[str, Column]:
    """The Shapley value of every feature that some tree splits on.

    A tree of up to ``TABLED`` different splits is one table over their outcomes. A larger one is a table per leaf; many large trees
    make a long expression, which Spark then compiles in parts outside whole-stage code.
    """
    parts: dict[str, list[Column]] = {}
    for weight, tree in trees:
        splits = sorted({(s.feature, s.threshold) for leaf in tree for s in leaf.path})
        if len(splits) <= TABLED:
            found = [_by_tree(weight, tree, splits, inputs)]
        else:
            found = [_by_leaf(weight, leaf, inputs) for leaf in tree]
        for columns in found:
            for feature, column in columns.items():
                parts.setdefault(feature, []).append(column)
    return {feature: _sum(columns) for feature, columns in sorted(parts.items())}


def tree_shap(
    df: DataFrame, trees: Sequence[tuple[float, Tree]], id: str = "doc_id", inputs: Mapping[str, Column] | None = None
) -> DataFrame:
    """``id, feature, phi`` of every row and every feature that some tree splits on: a projection, no shuffle, no Python.

    The values of a row add up to ``margin - base_value``. ``inputs`` gives the columns of the features where they are not the columns
    of their names. A null value goes right at every split, and so does NaN.
    """
    names = {s.feature for _, tree in trees for leaf in tree for s in leaf.path}
    columns = inputs or {name: F.col(name) for name in names}
    values = shapley_columns(trees, columns)
    pairs = [F.struct(F.lit(f).alias("feature"), c.alias("phi")) for f, c in values.items()]
    if not pairs:
        pairs = [F.struct(F.lit(None).cast("string").alias("feature"), F.lit(0.0).alias("phi"))]
    rows = df.select(id, F.explode(F.array(*pairs)).alias("_pair"))
    # Rounded after the rows are expanded: rounding names its argument several times.
    return rows.select(id, "_pair.feature", rounded(F.col("_pair.phi"), 9).alias("phi")).where("feature IS NOT NULL")

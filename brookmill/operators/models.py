"""Tree models on fused features, and the ablation study over groups of features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.operators.features import class_weights
from brookmill.operators.ranking import rank_auc
from brookmill.operators.skew import lookup
from brookmill.session import materialise

MAX_GROUPS = 5
TASK_BYTES = 64 << 20


def random_forest(label: str, weight: str | None = None) -> RandomForestClassifier:
    forest = RandomForestClassifier(labelCol=label, numTrees=20, maxDepth=5, seed=42)
    return forest.setWeightCol(weight) if weight else forest


def boosted_trees(label: str, weight: str | None = None) -> GBTClassifier:
    """The ensemble that LightGBM grows unless told otherwise: 100 rounds at a rate of 0.1, and up to 32 leaves for its 31."""
    trees = GBTClassifier(labelCol=label, maxIter=100, maxDepth=5, stepSize=0.1, seed=42)
    return trees.setWeightCol(weight) if weight else trees


def fold(id: str) -> Column:
    """``test`` for a fifth of the ids, ``train`` for the rest; the same in every run, and in SQL."""
    digits = F.substring(F.md5(F.col(id).cast("string")), 1, 8)
    return F.when(F.conv(digits, 16, 10).cast("bigint") % 5 == 0, "test").otherwise("train")


def balance(df: DataFrame, label: str, id: str = "doc_id", name: str = "weight") -> DataFrame:
    """Add the class weight of each row, without a shuffle of the rows by their few labels."""
    weights = materialise(class_weights(df, label).withColumnRenamed("w", name), "class-weights")
    return lookup(df, weights, [label], "n", [id])


def dealt_out(train: DataFrame, assembler: VectorAssembler) -> DataFrame:
    """The rows in as many parts as keep each below ``TASK_BYTES`` inside a tree model.

    There, a row takes four bytes for every feature, however sparse its vector; a scan cuts its splits by packed bytes, which tell nothing of that.
    """
    rows = train.count()
    if not rows:
        return train
    width = len(assembler.transform(train).select(assembler.getOutputCol()).first()[0])
    parts = -(-rows * 4 * width // TASK_BYTES)
    return train.repartition(parts) if parts > train.rdd.getNumPartitions() else train


def fit(train: DataFrame, features: Sequence[str], estimator: Estimator) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, estimator.copy()]).fit(dealt_out(train, assembler))


def fit_score(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    estimator: Estimator,
    id: str = "doc_id",
    balanced: bool = False,
) -> DataFrame:
    """Fit on the labelled train rows, score every row: ``id, fold, prediction``.

    Rows without a label are scored too, as fold ``unlabelled``. ``df`` is read several times: materialise it
    first. The fold is worked out on reading, not stored.
    """
    parts = F.when(F.col(label).isNull(), "unlabelled").otherwise(fold(id))
    ready = df.withColumn("fold", parts)
    train = ready.where("fold = 'train'")
    if balanced:
        train = balance(train, label, id)
        estimator = estimator.copy().setWeightCol("weight")
    model = fit(train, features, estimator)
    return model.transform(ready).select(id, "fold", "prediction")


def ablation(
    df: DataFrame,
    groups: Mapping[str, Sequence[str]],
    label: str,
    estimator: Estimator,
    id: str = "doc_id",
    balanced: bool = False,
    parallelism: int = 4,
    max_groups: int = MAX_GROUPS,
) -> DataFrame:
    """``subset, metric``: area under the ROC curve of the test rows for every subset of groups.

    The empty subset has no information: 0.5. The number of fits doubles with each group, so groups are
    limited to ``max_groups``; the fits run side by side and read ``df``, which should be materialised and
    narrow. The metric is exact, by ranks over all distinct scores of all subsets at once. Names of groups hold no ``+``.
    """
    if len(groups) > max_groups:
        raise ValueError(f"{len(groups)} groups need {2 ** len(groups)} fits; merge some")
    ready = df.withColumn("fold", fold(id))
    train, test = ready.where("fold = 'train'"), ready.where("fold = 'test'")
    if balanced:
        train = balance(train, label, id)
        estimator = estimator.copy().setWeightCol("weight")
    subsets = [s for n in range(1, len(groups) + 1) for s in combinations(sorted(groups), n)]

    def scored(subset: tuple[str, ...]) -> DataFrame:
        columns = [column for group in subset for column in groups[group]]
        margin = vector_to_array("rawPrediction")[1].alias("score")
        return fit(train, columns, estimator).transform(test).select(F.lit("+".join(subset)).alias("subset"), margin, label)

    spark = df.sparkSession
    with ThreadPool(parallelism) as pool:
        scores = reduce(DataFrame.unionAll, pool.map(inheritable_thread_target(spark)(scored), subsets))
    measured = rank_auc(scores, "score", label, ["subset"]).select(F.split("subset", r"\+").alias("subset"), F.col("auc").alias("metric"))
    return spark.createDataFrame([([], 0.5)], "subset ARRAY<STRING>, metric DOUBLE").unionAll(measured)

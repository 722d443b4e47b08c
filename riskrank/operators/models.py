"""Classifiers, their scores and a summary of fitted trees.

Training frames are not cached here: each of these learners keeps its own compact form of the
training rows (binned points, stacked blocks) for its iterations, and reads the source only for
that preparation.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.functions.columns import logistic, to_int, vector_element

# The settings of the models.
FOREST_TREES = 66
BOOSTING_ROUNDS = 3
HIDDEN_UNITS = 3
NETWORK_ITERATIONS = 100
BLOCK_SIZE = {"index": 128, "onehot": 200}
SEED = 1234

MODELS = ("forest", "boosted", "network", "tree")

# Tells learners that labels are 0/1, which spares them a pass to find the number of classes.
_BINARY = {"ml_attr": {"name": "label", "type": "nominal", "vals": ["0", "1"]}}


def training_label(label: Column) -> Column:
    """A 0/1 label as the double column ``label`` that learners expect."""
    return label.cast("double").alias("label", metadata=_BINARY)


def classifier(kind: str, *, width: int | None = None, encode: str = "index", seed: int = SEED, **params):
    """An unfitted Spark ML classifier reading ``features`` and ``label``.

    ``width`` is the number of features (the first layer of a network); ``params`` override any
    setting of the underlying estimator.
    """
    columns = {"featuresCol": "features", "labelCol": "label"}
    if kind == "forest":
        return RandomForestClassifier(
            **columns, **{"numTrees": FOREST_TREES, "impurity": "gini", "seed": seed, **params}
        )
    if kind == "boosted":
        return GBTClassifier(**columns, **{"maxIter": BOOSTING_ROUNDS, "seed": seed, **params})
    if kind == "tree":
        return DecisionTreeClassifier(**columns, **{"impurity": "gini", "seed": seed, **params})
    if kind == "network":
        if width is None:
            raise ValueError("a network needs the number of features")
        settings = {
            "layers": [width, HIDDEN_UNITS, 2],
            "blockSize": BLOCK_SIZE[encode],
            "maxIter": NETWORK_ITERATIONS,
            "seed": seed,
        }
        return MultilayerPerceptronClassifier(**columns, **{**settings, **params})
    raise ValueError(f"unknown model {kind!r}, expected one of {MODELS}")


def probability_score(vector: str = "probability") -> Column:
    """Probability of label 1."""
    return vector_element(vector, 1)


def score_label_pair(
    predicted: DataFrame, label: str = "label", *keep: str | Column, score: Column | None = None
) -> DataFrame:
    """``(score, label)``, and what else to keep; the score is the probability of label 1 unless another is given."""
    score = probability_score() if score is None else score
    return predicted.select(*keep, score.alias("score"), to_int(label).alias("label"))


def per_tree_score(model: GBTClassificationModel, df: DataFrame) -> DataFrame:
    """Add the output of every tree of a boosted ensemble as ``tree_0``, ``tree_1``, ..."""
    for i, tree in enumerate(model.trees):
        df = tree.copy().setPredictionCol(f"tree_{i}").transform(df)
    return df


def ensemble_raw(model: GBTClassificationModel) -> Column:
    """Weighted sum of the columns that ``per_tree_score`` adds."""
    return reduce(operator.add, [F.col(f"tree_{i}") * F.lit(w) for i, w in enumerate(model.treeWeights)])


def ensemble_score(model: GBTClassificationModel, df: DataFrame, *, keep_trees: bool = False) -> DataFrame:
    """Add ``raw_score``, the weighted sum of the tree outputs, and ``score``, its logistic.

    Spark's own ``probability`` is the logistic of twice the raw score; it ranks rows alike but has
    other values. The raw score is read from the model's own margin unless ``keep_trees`` asks for
    the column of every tree, which evaluates each tree separately.
    """
    if keep_trees:
        scored = per_tree_score(model, df).withColumn("raw_score", ensemble_raw(model))
    else:
        scored = model.transform(df).withColumn("raw_score", vector_element(model.getRawPredictionCol(), 1))
    return scored.withColumn("score", logistic("raw_score"))


def tree_summary(spark, model) -> DataFrame:
    """One row per fitted tree: tree, weight, depth, num_nodes and its rules as text."""
    trees = getattr(model, "trees", None)
    weights = model.treeWeights if trees is not None else [1.0]
    rows = [
        (i, float(w), t.depth, t.numNodes, t.toDebugString)
        for i, (t, w) in enumerate(zip(trees if trees is not None else [model], weights, strict=True))
    ]
    return spark.createDataFrame(rows, "tree int, weight double, depth int, num_nodes int, rules string")

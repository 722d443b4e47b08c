"""Fit a classifier on a training split, score a held-out split and report its ranking."""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskrank.functions.columns import BAD_WEIGHT, GOOD_WEIGHT, checked_label, label_of, logistic, to_int
from riskrank.operators import features
from riskrank.operators.cleaning import fill_missing
from riskrank.operators.gains import CUTOFFS, gains_table, rank_layout, tdr_at
from riskrank.operators.levels import Levels, fit_levels, index_apply, unseen_to_mode
from riskrank.operators.metrics import auc_roc, error_rate
from riskrank.operators.models import SEED, classifier, ensemble_score, score_label_pair, training_label, tree_summary
from riskrank.operators.trees import Input, compile_trees, node_table, share_of_ones, tree_nodes
from riskrank.sources.roles import Roles
from riskrank.sources.workspace import Workspace

TREE_MODELS = ("forest", "boosted", "tree")
DEFAULT_BINS = 32
# Levels that a category of a tree model may have: each is a bin of its own, for every feature.
MAX_LEVELS = 1_000
# Training rows of a partition, where they are dealt: what a task of a learner holds and reads in each pass.
ROWS_PER_PARTITION = 250_000
# Where blocks are even, the share of all weight that the rows of the one short block may have beyond their own.
EVEN_WITHIN = 1e-6


@dataclass(frozen=True)
class RiskModel:
    """A fitted flow: dictionaries, and a pipeline of encoder, assembler and classifier."""

    kind: str
    roles: Roles
    positive: object
    levels: Levels | None
    inputs: tuple[str, ...]
    pipeline: PipelineModel
    numeric: tuple[str, ...] = ()

    @property
    def classifier(self):
        return self.pipeline.stages[-1]

    def label(self) -> Column:
        return _label(self.roles, self.positive)

    def prepare(self, df: DataFrame) -> DataFrame:
        """Clean rows and add their index and feature vector columns; unseen levels become the mode."""
        cleaned = _clean(df, self.roles)
        if self.roles.categorical:
            cleaned = unseen_to_mode(cleaned, self.levels, self.roles.categorical)
            cleaned = index_apply(cleaned, self.levels, self.roles.categorical, numeric=self.numeric)
        return PipelineModel(self.pipeline.stages[:-1]).transform(cleaned)

    def predict(self, df: DataFrame) -> DataFrame:
        """``prepare`` and append rawPrediction, probability and prediction."""
        return self.classifier.transform(self.prepare(df))

    def score(self, df: DataFrame) -> DataFrame:
        """``(id, score, label, prediction)`` for every row of ``df``."""
        boosted = self.kind == "boosted"
        predicted = ensemble_score(self.classifier, self.prepare(df)) if boosted else self.predict(df)
        pairs = score_label_pair(
            predicted.withColumn("__label", self.label()),
            "__label",
            F.col(self.roles.id).alias("id"),
            to_int("prediction").alias("prediction"),
            score=F.col("score") if boosted else None,
        )
        return pairs.select("id", "score", "label", "prediction")

    def compiled_trees(self, workspace: Workspace) -> list[Column]:
        """The output of every tree as an expression over cleaned raw columns: see ``compiled_score``."""
        if self.kind not in TREE_MODELS or not all(isinstance(s, VectorAssembler) for s in self.pipeline.stages[:-1]):
            raise ValueError("only tree models of plain index features can be compiled")
        inputs = [Input(c) for c in self.inputs]
        for i, name in enumerate(self.inputs):
            category = name.removesuffix(features.INDEX)
            if category in self.roles.categorical and name != category:
                inputs[i] = Input(category, tuple(self.levels.labels[category]))
        leaf = (lambda node: node.prediction) if self.kind == "boosted" else share_of_ones
        return compile_trees(node_table(self.classifier, workspace), inputs, leaf)

    def compiled_score(self, df: DataFrame, workspace: Workspace | None = None, *, keep_trees: bool = False) -> DataFrame:
        """``score`` by the trees as nested conditions: one projection, whatever the number of trees.

        Rows get the same scores up to the rounding of sums, without index columns and vectors. ``keep_trees`` adds
        the output of each tree, ``tree_0`` and so on, and ``raw_score``, their weighted sum.
        """
        trees = self.compiled_trees(workspace or Workspace(df.sparkSession))
        outputs = [t.alias(f"tree_{i}") for i, t in enumerate(trees)]
        cleaned = _clean(df, self.roles).select("*", *outputs)
        weights = self.classifier.treeWeights if self.kind == "boosted" else [1 / len(trees)] * len(trees)
        raw = reduce(operator.add, [F.col(f"tree_{i}") * F.lit(w) for i, w in enumerate(weights)])
        boosted = self.kind == "boosted"
        return cleaned.withColumn("raw_score", raw).select(
            F.col(self.roles.id).alias("id"),
            (logistic("raw_score") if boosted else F.col("raw_score")).alias("score"),
            self.label().alias("label"),
            (F.col("raw_score") > (0.0 if boosted else 0.5)).cast("bigint").alias("prediction"),
            *([f"tree_{i}" for i in range(len(trees))] + ["raw_score"] if keep_trees else []),
        )

    def nodes(self, workspace: Workspace | None = None) -> DataFrame:
        """One row per node of a fitted tree model, with the names of features and of the levels that go left."""
        found = tree_nodes(self.classifier, workspace or Workspace(SparkSession.active()))
        names = F.array(*[F.lit(n.removesuffix(features.INDEX) if n.removesuffix(features.INDEX) in self.roles.categorical else n) for n in self.inputs])
        known = {c: self.levels.labels[c] for c in self.roles.categorical if not self.levels.is_wide(c)} if self.levels else {}
        table = F.create_map(*[v for c, labels in known.items() for v in (F.lit(c), F.array(*[F.lit(x) for x in labels]))]) if known else None
        named = found.withColumn("feature", F.get(names, F.col("feature")))
        if table is None:
            return named.withColumn("levels", F.lit(None).cast("array<string>"))
        labels = F.try_element_at(table, F.col("feature"))
        return named.withColumn("levels", F.transform("categories", lambda i: F.get(labels, i.cast("int"))))

    def summary(self) -> DataFrame:
        """One row per tree of a fitted tree model."""
        return tree_summary(SparkSession.active(), self.classifier)


def _clean(df: DataFrame, roles: Roles) -> DataFrame:
    # The target and the id keep their nulls: a filled label or id would be an invented one.
    return fill_missing(df, exclude=(roles.target, roles.id))


def _label(roles: Roles, positive) -> Column:
    target = F.col(roles.target)
    # A level found by frequency is a string, as all dictionary levels are.
    return label_of(target.cast("string") if roles.positive is None else target, positive)


def even_block(rows: int, at_most: int, within: float = EVEN_WITHIN) -> int:
    """The largest block, up to ``at_most`` rows, that leaves no short last one, or one that lacks no more than ``within`` of all rows."""
    return next(b for b in range(max(1, at_most), 0, -1) if -rows % b <= within * rows)


def _deal_blocks(training: DataFrame, partitions: int, block: int) -> DataFrame:
    """Deal rows by a hash of ``__order`` to ``partitions`` of whole blocks; what is left of each, less than a block, shares one more."""
    slot = F.pmod(F.xxhash64("__order"), F.lit(partitions)).cast("int")
    mates = Window.partitionBy("__slot")
    numbered = training.withColumn("__slot", slot).select(
        "*",
        F.row_number().over(mates.orderBy(*training.columns)).alias("__number"),
        F.count(F.lit(1)).over(mates).alias("__mates"),
    )
    whole = F.col("__number") <= F.col("__mates") - F.col("__mates") % block
    dealt = numbered.repartitionById(partitions + 1, F.when(whole, F.col("__slot")).otherwise(F.lit(partitions)))
    return dealt.sortWithinPartitions("__slot", "__number").drop("__slot", "__number", "__mates")


def fit_risk_model(
    train: DataFrame,
    roles: Roles,
    model: str = "forest",
    *,
    encode: str = "index",
    scale: bool = False,
    seed: int = SEED,
    partitions: int | None = None,
    rows_per_partition: int = ROWS_PER_PARTITION,
    even_blocks: int | None = None,
    numeric: tuple[str, ...] = (),
    max_levels: int = MAX_LEVELS,
    workspace: Workspace | None = None,
    **params,
) -> RiskModel:
    """Fit dictionaries, encoders and a classifier.

    The rows are trained on as they are read, since learners draw their samples by partition. With
    ``partitions`` they are dealt to so many, and to more where these would have over ``rows_per_partition``
    rows each, by a hash of the id and sorted by it, so that the fit follows from the data and the seed alone, on any
    number of cores, and a task reads no more of a larger table.

    A network averages its loss by block, so that the rows of a short last block of a partition weigh more. With
    ``even_blocks``, which needs ``partitions``, blocks have one size, the largest up to so many rows that divides their number,
    or, of over a million rows, leaves a last block that lacks at most a millionth of them: as blocks of one row, rows weigh alike.

    A tree model takes the index of a category as nominal; a category of over ``max_levels`` levels is
    refused, unless ``numeric`` names it: then its index counts as a number.

    ``model`` is forest, boosted, network or tree; ``encode`` is index (category indexes as
    numbers) or onehot. ``scale`` standardises the features, which only a network profits from.
    ``params`` go to the underlying Spark ML classifier.
    """
    if encode not in ("index", "onehot"):
        raise ValueError(f"encode must be index or onehot, got {encode!r}")
    if even_blocks and (model != "network" or not partitions or "blockSize" in params):
        raise ValueError("even_blocks is for a network, with partitions and without blockSize")
    categorical = list(roles.categorical)
    cleaned = _clean(train, roles)
    fitted = categorical + ([roles.target] if roles.positive is None else [])
    levels = fit_levels(cleaned, fitted, workspace=workspace) if fitted else None

    positive = roles.positive
    if positive is None:
        if levels.size(roles.target) != 2:
            raise ValueError(f"{roles.target} has {levels.size(roles.target)} levels, a binary target needs 2")
        positive = levels.labels[roles.target][1]

    stages = []
    if encode == "onehot" and categorical:
        stages.append(features.one_hot_encoder(categorical))
        inputs = features.onehot_feature_columns(cleaned, roles)
        width = sum(levels.size(c) - 1 for c in categorical) + len(inputs) - len(categorical)
    else:
        inputs = features.feature_columns(cleaned, roles)
        width = len(inputs)
    stages.append(features.assembler(inputs, "unscaled" if scale else "features"))
    if scale:
        stages.append(features.scaler("unscaled", "features"))
    if model in TREE_MODELS and encode == "index":
        nominal = {c: levels.size(c) for c in categorical if c not in numeric}
        for c, n in nominal.items():
            if n > max_levels:
                raise ValueError(f"{c} has {n} levels, over max_levels={max_levels}; name it in numeric, or encode it otherwise")
        # Trees treat the index as a category and need one bin per level.
        params.setdefault("maxBins", max(DEFAULT_BINS, *nominal.values()) if nominal else DEFAULT_BINS)
    rows = cleaned.count() if partitions else 0
    if even_blocks:
        params["blockSize"] = even_block(rows, even_blocks)
    stages.append(classifier(model, width=width, encode=encode, seed=seed, **params))

    checked = cleaned.withColumn("label", _label(roles, positive))
    needed = [*categorical, *features.continuous_columns(cleaned, roles)]
    order = [F.col(roles.id).alias("__order")] if partitions else []
    training = checked.select(*order, *needed, training_label(checked_label("label")))
    if categorical:
        training = index_apply(training, levels, categorical, numeric=numeric).drop(*categorical)
    if partitions:
        partitions = max(partitions, math.ceil(rows / rows_per_partition))
        if even_blocks:
            training = _deal_blocks(training, partitions, params["blockSize"])
        else:
            training = training.repartition(partitions, "__order").sortWithinPartitions("__order")
        training = training.drop("__order")
    return RiskModel(model, roles, positive, levels, tuple(inputs), Pipeline(stages=stages).fit(training), tuple(numeric))


@dataclass(frozen=True)
class RankingReport:
    """The scored rows and what their ranking is worth; all members but the model are DataFrames."""

    scored: DataFrame
    gains: DataFrame
    rates: DataFrame
    auc: DataFrame
    error: DataFrame
    model: RiskModel | None = None

    def summary(self) -> DataFrame:
        """The figures of the report as ``(measure, value)`` rows."""
        name = F.format_string("rate at %s", F.col("cutoff").cast("string"))
        rates = self.rates.select(name.alias("measure"), "rate")
        auc = self.auc.select(F.lit("auc").alias("measure"), "auc")
        error = self.error.select(F.lit("error rate").alias("measure"), "error_rate")
        return rates.union(auc).union(error).toDF("measure", "value")


def ranking_report(
    scored: DataFrame,
    *,
    cutoffs=CUTOFFS,
    bad_weight: int = BAD_WEIGHT,
    good_weight: int = GOOD_WEIGHT,
    num_buckets: int | None = None,
    workspace: Workspace | None = None,
    model: RiskModel | None = None,
) -> RankingReport:
    """Gains, detection rates, ROC area and error rate of ``(id, score, label, prediction)`` rows.

    The scored rows are written once to the shared folder, so that the passes of the ranking read
    four narrow columns instead of running the model again, and all of them share one layout.
    """
    workspace = workspace or Workspace(scored.sparkSession)
    kept = workspace.keep(scored, "scored")
    layout = rank_layout(kept, num_buckets=num_buckets, workspace=workspace)
    weights = {"bad_weight": bad_weight, "good_weight": good_weight}
    return RankingReport(
        scored=kept,
        gains=gains_table(kept, layout=layout, **weights),
        rates=tdr_at(kept, cutoffs=cutoffs, layout=layout, **weights),
        auc=auc_roc(kept, workspace=workspace),
        error=error_rate(kept),
        model=model,
    )


def fit_score_rank(
    train: DataFrame,
    holdout: DataFrame,
    roles: Roles,
    model: str = "forest",
    *,
    encode: str = "index",
    scale: bool = False,
    seed: int = SEED,
    num_buckets: int | None = None,
    workspace: Workspace | None = None,
    **params,
) -> RankingReport:
    """Fit on ``train``, score ``holdout``, report the ranking of ``holdout``."""
    workspace = workspace or Workspace(train.sparkSession)
    fitted = fit_risk_model(train, roles, model, encode=encode, scale=scale, seed=seed, workspace=workspace, **params)
    return ranking_report(fitted.score(holdout), num_buckets=num_buckets, workspace=workspace, model=fitted)

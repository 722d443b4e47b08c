"""Exact area under the ROC curve and error rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.functions.columns import checked_label, checked_score
from riskrank.operators.ordering import Key, plan_layout, running_totals
from riskrank.sources.workspace import Workspace


def roc_pairs(per_score: DataFrame, *, num_buckets: int | None = None, workspace: Workspace | None = None) -> DataFrame:
    """Pairs of a positive and a negative, one row ``(pairs, wins)``, from rows ``(score, pos, neg)``, a score each.

    ``wins`` are the pairs whose positive has the higher score, a tie being half of one. Both are exact decimals, doubled
    so as to be whole; null without rows.
    """
    layout = plan_layout(per_score, [Key("score", descending=True)], num_buckets=num_buckets, nullable=False, workspace=workspace)
    totals = running_totals(per_score, layout, {"pos": F.col("pos"), "neg": F.col("neg")})
    # Their number is quadratic in the rows and outgrows bigint, which is wide enough for the counts.
    wide = "decimal(20,0)"
    twice_above = F.col("cum_pos").cast(wide) * 2 - F.col("pos").cast(wide)
    return totals.agg(
        (F.max("total_pos").cast(wide) * F.max("total_neg").cast(wide) * 2).cast("decimal(38,0)").alias("pairs"),
        F.sum((F.col("neg").cast(wide) * twice_above.cast(wide)).cast("decimal(38,0)")).cast("decimal(38,0)").alias("wins"),
    )


def auc_roc(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    *,
    num_buckets: int | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Area under the ROC curve, one row ``(auc)``; ties count half, null unless both classes occur.

    Rows are combined per distinct score, and these are written to the ``workspace`` and ordered by cut points of their own:
    however many rows share a few scores, the rest is divided evenly.
    """
    checked = df.select(checked_score(df, score).alias("score"), checked_label(label).alias("label"))
    per_score = checked.groupBy("score").agg(
        F.sum("label").alias("pos"), (F.count(F.lit(1)) - F.sum("label")).alias("neg")
    )
    workspace = workspace or Workspace(df.sparkSession)
    pairs = roc_pairs(workspace.keep(per_score, "per_score"), num_buckets=num_buckets, workspace=workspace)
    return pairs.select(F.try_divide(F.col("wins").cast("double"), F.col("pairs").cast("double")).alias("auc"))


def label_vs_prediction(df: DataFrame, label: str = "label", prediction: str = "prediction", *keep: str) -> DataFrame:
    """The label beside the prediction, with any further columns to keep."""
    return df.select(*keep, label, prediction)


def error_rate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction differs from the label, one row ``(error_rate)``; null if empty.

    A row whose label is not 0 or 1, or whose prediction is null or NaN, fails the query.
    """
    correct = (checked_score(df, prediction) == checked_label(label).cast("double")).cast("double")
    return df.agg((F.lit(1.0) - F.avg(correct)).alias("error_rate"))

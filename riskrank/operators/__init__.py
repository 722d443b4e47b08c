"""Operators: functions from DataFrames to DataFrames, lazy unless they fit something."""

from riskrank.operators.cleaning import fill_missing, fill_numeric, fill_string
from riskrank.operators.features import (
    assemble,
    columns_by_role,
    continuous_columns,
    feature_columns,
    one_hot,
    onehot_feature_columns,
    unpack,
)
from riskrank.operators.gains import CUTOFFS, gains_table, rank_layout, score_rank, tdr_at
from riskrank.operators.levels import Levels, fit_levels, frequent_levels, index_apply, unseen_to_mode
from riskrank.operators.metrics import auc_roc, error_rate, label_vs_prediction, roc_pairs
from riskrank.operators.models import (
    classifier,
    ensemble_score,
    per_tree_score,
    score_label_pair,
    training_label,
    tree_summary,
)
from riskrank.operators.ordering import Key, Layout, plan_layout, running_totals, sort_by_key

__all__ = [
    "CUTOFFS",
    "Key",
    "Layout",
    "Levels",
    "assemble",
    "auc_roc",
    "classifier",
    "columns_by_role",
    "continuous_columns",
    "ensemble_score",
    "error_rate",
    "feature_columns",
    "fill_missing",
    "fill_numeric",
    "fill_string",
    "fit_levels",
    "frequent_levels",
    "gains_table",
    "index_apply",
    "label_vs_prediction",
    "one_hot",
    "onehot_feature_columns",
    "per_tree_score",
    "plan_layout",
    "rank_layout",
    "roc_pairs",
    "running_totals",
    "score_label_pair",
    "score_rank",
    "sort_by_key",
    "tdr_at",
    "training_label",
    "tree_summary",
    "unpack",
    "unseen_to_mode",
]

"""Column expressions; everything here stays inside the JVM."""

from riskrank.functions.columns import (
    checked_id,
    checked_label,
    checked_score,
    class_weight,
    label_of,
    logistic,
    row_sum,
    to_dense,
    to_int,
    vector_element,
    weighted_row_sum,
)

__all__ = [
    "checked_id",
    "checked_label",
    "checked_score",
    "class_weight",
    "label_of",
    "logistic",
    "row_sum",
    "to_dense",
    "to_int",
    "vector_element",
    "weighted_row_sum",
]

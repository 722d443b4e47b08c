"""Row-wise arithmetic, vector access and input checks as plain Spark columns.

No function here needs a Python worker: each one is a built-in expression, so it stays
visible to the optimizer and inside generated code.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Review cost of one bad row and of one good row.
BAD_WEIGHT = 1
GOOD_WEIGHT = 40

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType)


def _addend(df: DataFrame, name: str) -> Column:
    # A sum of ints is computed as bigint: under ANSI rules an int overflow is an error.
    column = F.col(name)
    return column.cast("bigint") if isinstance(df.schema[name].dataType, _INTEGRAL) else column


def row_sum(df: DataFrame, names: Sequence[str], output: str = "sums") -> DataFrame:
    """Add ``output``, the sum of the named columns of each row; null if any of them is null."""
    if not names:
        raise ValueError("row_sum needs at least one column")
    return df.withColumn(output, reduce(operator.add, [_addend(df, n) for n in names]))


def weighted_row_sum(weights: Mapping[str, float]) -> Column:
    """``sum(column * weight)`` over a row."""
    if not weights:
        raise ValueError("weighted_row_sum needs at least one column")
    return reduce(operator.add, [F.col(n) * F.lit(float(w)) for n, w in weights.items()])


def logistic(x: Column | str) -> Column:
    """``1 / (1 + exp(-x))``."""
    column = F.col(x) if isinstance(x, str) else x
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-column))


def vector_element(vector: Column | str, i: int) -> Column:
    """Element ``i`` of an ML vector, sparse or dense."""
    return vector_to_array(vector)[i]


def to_dense(vector: Column | str) -> Column:
    """The same vector stored densely. Only for display: Spark ML takes sparse vectors as they are."""
    return array_to_vector(vector_to_array(vector))


def to_int(x: Column | str) -> Column:
    """Truncate to a whole number, as bigint so that running totals cannot overflow an int."""
    return (F.col(x) if isinstance(x, str) else x).cast("bigint")


def class_weight(label: Column, bad_weight: int = BAD_WEIGHT, good_weight: int = GOOD_WEIGHT) -> Column:
    """Whole-number weight of a row by its 0/1 label."""
    for w in (bad_weight, good_weight):
        if isinstance(w, bool) or not isinstance(w, int) or w < 1:
            raise ValueError(f"class weights must be whole numbers of at least 1, got {w!r}")
    return F.when(label == 1, F.lit(bad_weight)).otherwise(F.lit(good_weight)).cast("bigint")


def label_of(target: Column | str, positive) -> Column:
    """0/1 label: 1 where ``target`` equals ``positive``; a null target stays null."""
    column = F.col(target) if isinstance(target, str) else target
    return (column == F.lit(positive)).cast("bigint")


def _or_fail(ok: Column, value: Column, message: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.lit(message)))


def checked_label(label: str) -> Column:
    """The label as bigint; any row whose label is not 0 or 1 (null included) fails the query."""
    column = F.col(label)
    return _or_fail(column.isin(0, 1), column.cast("bigint"), f"{label}: labels must be 0 or 1")


def checked_score(df: DataFrame, score: str) -> Column:
    """The score as double; a null or NaN score has no rank and fails the query.

    So does a whole or decimal number that a double cannot hold, as its rank could be wrong. Fractions and ints
    always fit, so they are not compared.
    """
    own, kind = F.col(score), df.schema[score].dataType
    column = own.cast("double")
    ok = column.isNotNull()
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        ok = ok & ~F.isnan(column)
    elif isinstance(kind, T.LongType):
        # The largest bigints become 2^63, which is cast back to the largest one.
        ok = ok & (column < F.lit(float(2**63))) & (column.cast("bigint") == own)
    elif isinstance(kind, T.DecimalType):
        ok = ok & F.coalesce(column.try_cast(kind) == own, F.lit(False))
    elif not isinstance(kind, T.IntegralType):
        ok = ok & ~F.isnan(column)
    return _or_fail(ok, column, f"{score}: scores must not be null or NaN, nor beyond the precision of a double")


def checked_id(name: str) -> Column:
    """The id; a null id cannot settle ties and fails the query."""
    column = F.col(name)
    return _or_fail(column.isNotNull(), column, f"{name}: ids must not be null")

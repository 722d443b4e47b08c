"""Filling missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# What a missing string and a missing number become.
MISSING_TEXT = "missing"
MISSING_NUMBER = -1.0


def fill_string(df: DataFrame, text: str = MISSING_TEXT, exclude: Sequence[str] = ()) -> DataFrame:
    """Replace null in every string column."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]
    return df.na.fill(text, subset=names) if names else df


def fill_numeric(df: DataFrame, number: float = MISSING_NUMBER, exclude: Sequence[str] = ()) -> DataFrame:
    """Replace null, and NaN, in every numeric column; the value is cast to the column's type."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    return df.na.fill(number, subset=names) if names else df


def fill_missing(
    df: DataFrame, text: str = MISSING_TEXT, number: float = MISSING_NUMBER, exclude: Sequence[str] = ()
) -> DataFrame:
    """Both fills; other column types (booleans, dates) stay as they are."""
    return fill_numeric(fill_string(df, text, exclude), number, exclude)

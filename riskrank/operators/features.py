"""From indexed columns to one feature vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.functions.columns import vector_element
from riskrank.sources.roles import Roles

INDEX, ONEHOT = "_index", "_onehot"


def columns_by_role(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those columns of ``df`` that are in ``names``, in table order."""
    wanted = set(names)
    return [c for c in df.columns if c in wanted]


def continuous_columns(df: DataFrame, roles: Roles) -> list[str]:
    """The continuous columns: as listed, or else every column without another role, in table order."""
    if roles.continuous is not None:
        return list(roles.continuous)
    taken = {roles.target, roles.target + INDEX, roles.id, *roles.categorical}
    taken.update(c + suffix for c in roles.categorical for suffix in (INDEX, ONEHOT))
    return [c for c in df.columns if c not in taken]


def feature_columns(df: DataFrame, roles: Roles) -> list[str]:
    """Inputs of an index-encoded model: continuous columns, then category indexes, each in table order."""
    return continuous_columns(df, roles) + [c + INDEX for c in columns_by_role(df, roles.categorical)]


def onehot_feature_columns(df: DataFrame, roles: Roles) -> list[str]:
    """Inputs of a one-hot model: indicator vectors in the order of the role list, then continuous columns."""
    return [c + ONEHOT for c in roles.categorical] + continuous_columns(df, roles)


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    """Indicator vectors ``<column>_onehot`` from ``<column>_index``; the last level is all zeros."""
    return OneHotEncoder(
        inputCols=[c + INDEX for c in columns], outputCols=[c + ONEHOT for c in columns], dropLast=True
    )


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_onehot`` for indexed columns.

    The number of levels comes from the metadata that indexing leaves on the column, so fitting
    reads no rows.
    """
    return one_hot_encoder(columns).fit(df).transform(df)


def assembler(inputs: Sequence[str], output: str = "features") -> VectorAssembler:
    """Numbers and vectors joined into one vector, in the given order; a null fails the query."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid="error")


def assemble(df: DataFrame, inputs: Sequence[str], output: str = "features") -> DataFrame:
    return assembler(inputs, output).transform(df)


def scaler(input: str, output: str) -> StandardScaler:
    """Unit-variance, zero-mean features; an option for models that are sensitive to scale."""
    return StandardScaler(inputCol=input, outputCol=output, withMean=True, withStd=True)


def unpack(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Add one double column per vector element."""
    return df.withColumns({n: vector_element(F.col(vector), i) for i, n in enumerate(names)})

"""Reading delimited tables, name lists and literal rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskrank.sources.roles import Roles

MAX_NAMES = 100_000
_LINE = "__line"
# Types from narrow to wide; two that are in no common row are strings together.
_WIDER = (
    (T.IntegerType, T.LongType, T.DecimalType, T.DoubleType),
    (T.DateType, T.TimestampNTZType, T.TimestampType),
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Read a CSV table whose first line holds the column names.

    Without ``schema`` the types are inferred, which costs one extra pass over the files. Pass the
    schema of the training split when reading a held-out split: it saves that pass and keeps both
    splits on the same types.
    """
    reader = spark.read.options(header=True, **options)
    if schema is None:
        return reader.csv(path, inferSchema=True)
    return reader.schema(schema).csv(path, enforceSchema=False)


@dataclass(frozen=True)
class Checked:
    """The whole lines of a CSV table, and the damaged ones as (file, line, reason): short, long or mistyped."""

    rows: DataFrame
    damaged: DataFrame

    def counts(self) -> DataFrame:
        """Damaged lines by file and reason."""
        return self.damaged.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n"))


def read_checked(spark: SparkSession, path: str, schema: T.StructType | str, *, header: bool = True, sep: str = ",", **options) -> Checked:
    """Read a CSV table of a known schema, and keep what does not fit it apart.

    A line is damaged if it has fewer or more fields than the schema, or a field that is none of its type; it is
    in no part among the rows. Empty fields are nulls, and empty lines are no lines.
    """
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    if _LINE in schema.names:
        raise ValueError(f"rename the column {_LINE}: it holds damaged lines")
    whole = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema]).add(_LINE, "string")
    settings = {"header": header, "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE, "columnPruning": False}
    table = spark.read.options(**settings, **options).schema(whole).csv(path).withColumn("__file", F.input_file_name())
    # A field that is not read is not checked either, so both parts refer to all of them: a hash is never below its least value.
    table = table.where(F.xxhash64(*schema.names) >= F.lit(-(2**63)).cast("bigint"))
    bad = F.col(_LINE).isNotNull()
    outside_quotes = f"{re.escape(sep)}(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)"
    fields = F.size(F.split(_LINE, outside_quotes, -1))
    reason = F.when(fields < len(schema), "short").when(fields > len(schema), "long").otherwise("mistyped")
    damaged = table.where(bad).select(F.col("__file").alias("file"), F.col(_LINE).alias("line"), reason.alias("reason"))
    return Checked(table.where(~bad).select(*schema.names), damaged)


def _widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for chain in _WIDER:
        ranks = [next((i for i, kind in enumerate(chain) if isinstance(t, kind)), None) for t in (a, b)]
        if None not in ranks:
            return (a, b)[ranks[1] > ranks[0]]
    return T.StringType()


def merged_schema(spark: SparkSession, paths: Sequence[str], **options) -> T.StructType:
    """One schema for all splits of a table: each is inferred, and a column has the narrowest type that holds them all.

    Columns are in the order of the first split; those of later ones follow. A column without a value anywhere is a string.
    """
    found: dict[str, T.DataType] = {}
    for path in paths:
        for f in read_csv(spark, path, nullValue="", **options).schema:
            found[f.name] = _widened(found.get(f.name, T.NullType()), f.dataType)
    return T.StructType([T.StructField(n, T.StringType() if isinstance(t, T.NullType) else t) for n, t in found.items()])


def read_splits(spark: SparkSession, paths: Sequence[str], **options) -> list[Checked]:
    """Every split of a table with the same schema; a column that a split lacks is null there."""
    schema = merged_schema(spark, paths, **options)
    out = []
    for path in paths:
        own = spark.read.options(header=True, **options).csv(path).columns
        read = read_checked(spark, path, T.StructType([schema[n] for n in own]), **options)
        rows = read.rows.select(*[F.col(f.name) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        out.append(Checked(rows, read.damaged))
    return out


def read_names(spark: SparkSession, path: str, max_names: int = MAX_NAMES) -> list[str]:
    """Read a small text file with one column name per line; blank lines are skipped, over ``max_names`` are refused."""
    rows = spark.read.text(path).limit(max_names + 1).collect()
    if len(rows) > max_names:
        raise ValueError(f"{path} has over {max_names} lines and is no list of column names")
    return [name for name in (row.value.strip() for row in rows) if name]


def read_roles(
    spark: SparkSession,
    categorical: str,
    *,
    id: str,
    continuous: str | None = None,
    target: str | None = None,
    target_column: str | None = None,
    positive: object = None,
) -> Roles:
    """Build ``Roles`` from name-list files.

    The target comes from a one-line file (``target``) or by name (``target_column``).
    """
    if (target is None) == (target_column is None):
        raise ValueError("give exactly one of target (a file) and target_column (a name)")
    if target is not None:
        names = read_names(spark, target)
        if len(names) != 1:
            raise ValueError(f"{target} must name one column, found {len(names)}")
        target_column = names[0]
    return Roles(
        target=target_column,
        id=id,
        categorical=read_names(spark, categorical),
        continuous=None if continuous is None else read_names(spark, continuous),
        positive=positive,
    )


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str | Sequence[str]) -> DataFrame:
    """Turn literal tuples into a table. For configuration and examples, not for bulk data."""
    return spark.createDataFrame(list(rows), schema)

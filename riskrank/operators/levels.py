"""Category dictionaries: learning the level order and applying it to rows.

Levels are ordered by frequency, most frequent first, ties alphabetically, and compared as
strings. A column of few levels (the number is checked, not assumed) keeps its dictionary on the
driver and has it applied as a literal lookup. The dictionary of a wider column stays a
distributed table: its frequent levels are broadcast, and a Bloom filter of the long tail tells which of the
other rows can have a level there at all. Only those are joined by shuffle.
"""

from __future__ import annotations

import json
import math
import operator
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.operators.ordering import plan_layout, running_totals
from riskrank.sources.workspace import Workspace

MAX_LOCAL_LEVELS = 10_000
BROADCAST_LEVELS = 10_000
# A filter has about so many bits a level, up to a size of one megabyte; beyond it more rows take the join in vain.
BLOOM_BITS_PER_LEVEL = 10
MAX_BLOOM_BITS = 1 << 23
BLOOM_SEEDS = (101, 102, 103)
# Levels that a sketch of heavy hitters holds, for each one that may have the share asked for.
SKETCH_FACTOR = 8
# So that a sketch holds 2^19 levels at most, which Spark allows.
LEAST_SHARE = 1 / (1 << 16)
_INDEX = "__index"


@dataclass(frozen=True)
class Levels:
    """Fitted dictionaries of one or more columns.

    ``frame`` has the columns column, level, n and index (0.0 for the most frequent level).
    ``labels`` maps each narrow column to its levels in index order and ``counts`` to their row
    counts; wide columns appear in ``frame`` only. ``widths`` maps each wide column to its number of levels and
    ``blooms`` to the words of a filter of those that are not broadcast.
    """

    frame: DataFrame
    columns: tuple[str, ...]
    labels: dict[str, list[str]]
    counts: dict[str, list[int]]
    broadcast_levels: int = BROADCAST_LEVELS
    blooms: dict[str, list[int]] = field(default_factory=dict)
    widths: dict[str, int] = field(default_factory=dict)

    def is_wide(self, column: str) -> bool:
        return column not in self.labels

    def size(self, column: str) -> int:
        """Number of levels of a column."""
        return self.widths[column] if self.is_wide(column) else len(self.labels[column])

    def mode(self, column: str) -> str | None:
        """The most frequent level of a column; None if it had no value at all."""
        if not self.is_wide(column):
            return next(iter(self.labels[column]), None)
        return self.frame.where((F.col("column") == column) & (F.col("index") == 0)).head().level


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per level of every column, ``(column, level, n)``, in one pass; nulls are not levels."""
    return _level_pairs(df, columns).groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))


def _level_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row ``(column, level)`` for every value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.column", "p.level").where(F.col("level").isNotNull())


def frequent_levels(df: DataFrame, columns: Sequence[str], share: float) -> DataFrame:
    """The levels that ``share`` of the values of their column have at least: ``(column, level, n)``, exact.

    One pass keeps a mergeable sketch of heavy hitters for each column, of a size that follows from ``share`` alone; its
    error is below the share, so no such level is missing. A second pass counts its levels, and nothing else is shuffled:
    the long tail of a column costs nothing. Nulls are not levels and do not count.
    """
    if not LEAST_SHARE <= share <= 1:
        raise ValueError(f"share must lie between {LEAST_SHARE} and 1, got {share}")
    size = 1 << max(6, math.ceil(math.log2(SKETCH_FACTOR / share)))
    columns = list(columns)
    values = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
    # In two steps, so that no task merges the sketches of all others.
    values = values.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))

    def sketched(name: str, *arguments) -> Column:
        return F.call_function(name, *arguments, F.lit(size))

    names = [f"c{i}" for i in range(len(columns))]
    parts = values.groupBy("part").agg(*[sketched("approx_top_k_accumulate", F.col(c)).alias(c) for c in names])
    merged = parts.agg(*[sketched("approx_top_k_combine", F.col(c)).alias(c) for c in names])
    tops = [F.transform(F.call_function("approx_top_k_estimate", F.col(c), F.lit(size)), lambda x: x["item"]).alias(c) for c in names]
    found = merged.select(*tops)
    candidates = [F.transform(F.col(f"c{i}"), _named(c)) for i, c in enumerate(columns)]
    candidates = found.select(F.explode(F.concat(*candidates)).alias("p")).select("p.column", "p.level")
    pairs = _level_pairs(df, columns)
    counted = pairs.join(F.broadcast(candidates), ["column", "level"], "left_semi").groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    totals = pairs.groupBy("column").agg(F.count(F.lit(1)).alias("total"))
    # One row a fitted column.
    return counted.join(F.broadcast(totals), "column").where(F.col("n") >= F.col("total") * share).select("column", "level", "n")


def _named(column: str):
    return lambda level: F.struct(F.lit(column).alias("column"), level.alias("level"))


def fit_levels(
    df: DataFrame,
    columns: Sequence[str],
    *,
    max_local: int = MAX_LOCAL_LEVELS,
    broadcast_levels: int = BROADCAST_LEVELS,
    min_share: float | None = None,
    workspace: Workspace | None = None,
    num_buckets: int | None = None,
) -> Levels:
    """Learn the dictionaries of ``columns``.

    All levels are counted in one pass over ``df`` and the counts written to the ``workspace`` once; pass one to be able to
    clear it. A column of up to ``max_local`` levels has its dictionary on the driver, whatever the others have.
    With ``min_share`` only levels that have that share of their column's values are learned, from a sketch and
    an exact count of what it holds, so that columns of any number of levels have small dictionaries.
    """
    columns = tuple(columns)
    if not columns:
        raise ValueError("fit_levels needs at least one column")
    spark = df.sparkSession
    workspace = workspace or Workspace(spark)
    counted = level_counts(df, columns) if min_share is None else frequent_levels(df, columns, min_share)
    counts = workspace.keep(counted, "level_counts")
    per_column = {r.column: r["count"] for r in counts.groupBy("column").count().collect()}
    narrow = [c for c in columns if per_column.get(c, 0) <= max_local]
    labels, sizes = _ordered(narrow, counts.where(F.col("column").isin(narrow)).collect())
    if len(narrow) == len(columns):
        rows = [(c, level, n, float(i)) for c in columns for i, (level, n) in enumerate(zip(labels[c], sizes[c]))]
        frame = spark.createDataFrame(rows, "column string, level string, n bigint, index double")
        return Levels(frame, columns, labels, sizes, broadcast_levels)

    layout = plan_layout(counts, ["column", "-n", "level"], num_buckets=num_buckets, nullable=False, workspace=workspace)
    placed = workspace.keep(running_totals(counts, layout), "levels")
    first = placed.groupBy("column").agg(F.min("idx").alias("first"))  # one row per fitted column
    frame = placed.join(F.broadcast(first), "column").select(
        "column", "level", "n", (F.col("idx") - F.col("first")).cast("double").alias("index")
    )
    wide = {c: per_column[c] for c in columns if c not in narrow}
    return Levels(frame, columns, labels, sizes, broadcast_levels, _blooms(frame, wide, broadcast_levels), wide)


def _bloom_bits(levels: int) -> int:
    """A power of two that fits the number of levels."""
    return min(MAX_BLOOM_BITS, 1 << max(6, math.ceil(math.log2(max(1, levels) * BLOOM_BITS_PER_LEVEL))))


def _bloom_places(level: Column, bits: int) -> list[Column]:
    return [F.xxhash64(level, F.lit(seed)).bitwiseAND(F.lit(bits - 1)) for seed in BLOOM_SEEDS]


def _blooms(frame: DataFrame, wide: dict[str, int], broadcast_levels: int) -> dict[str, list[int]]:
    """Words of a Bloom filter for the levels of each wide column that are not broadcast; at most a megabyte each."""
    tail = frame.where(F.col("index") >= broadcast_levels)
    out = {}
    for c, levels in wide.items():
        bits = _bloom_bits(levels - broadcast_levels)
        places = tail.where(F.col("column") == c).select(F.explode(F.array(*_bloom_places(F.col("level"), bits))).alias("p"))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
        words = [0] * (bits // 64)
        for r in places.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect():
            words[r.word] = r.bits
        out[c] = words
    return out


def _may_hold(words: Sequence[int], level: Column) -> Column:
    """Whether a level may be in the filter: never false for one that is."""
    held = F.from_json(F.lit(json.dumps(list(words))), "array<bigint>")
    bits = [
        F.getbit(F.get(held, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
        for p in _bloom_places(level, 64 * len(words))
    ]
    return reduce(operator.and_, bits)


def _ordered(columns: Sequence[str], rows: Sequence) -> tuple[dict[str, list[str]], dict[str, list[int]]]:
    labels, sizes = {c: [] for c in columns}, {c: [] for c in columns}
    for r in sorted(rows, key=lambda r: (-r.n, r.level.encode())):
        labels[r.column].append(r.level)
        sizes[r.column].append(r.n)
    return labels, sizes


def _lookup(df: DataFrame, levels: Levels, outputs: dict[str, str]) -> DataFrame:
    """Add the index of each column (``outputs``: column to new name) from distributed dictionaries; null where unknown.

    Frequent levels are broadcast. Of the other rows, those that a filter says cannot have a level of the tail go by
    unshuffled, however many share an unknown level; the rest is joined with the tails, and skewed parts of
    these joins are split at run time. Both parts read ``df``, so it must be the same each time.
    """
    keyed, names = df, list(df.columns)
    for i, c in enumerate(outputs):
        known = levels.frame.where(F.col("column") == c)
        # Indexes follow frequency, so the first ones are exactly the hot levels.
        frequent = known.where(F.col("index") < levels.broadcast_levels)
        frequent = frequent.select(F.col("level").alias(f"__level_{i}"), F.col("index").alias(f"__frequent_{i}"))
        keyed = keyed.withColumn(f"__level_{i}", F.col(c).cast("string")).join(F.broadcast(frequent), f"__level_{i}", "left")
    open_ = [
        F.when(F.col(f"__frequent_{i}").isNull() & _may_hold(levels.blooms[c], F.col(f"__level_{i}")), F.col(f"__level_{i}"))
        for i, c in enumerate(outputs)
    ]
    some = reduce(operator.or_, [o.isNotNull() for o in open_])
    direct = keyed.where(~some).select(*names, *[F.col(f"__frequent_{i}").alias(o) for i, o in enumerate(outputs.values())])
    cold = keyed.where(some).withColumns({f"__open_{i}": o for i, o in enumerate(open_)})
    for i, c in enumerate(outputs):
        tail = levels.frame.where((F.col("column") == c) & (F.col("index") >= levels.broadcast_levels))
        tail = tail.select(F.col("level").alias(f"__open_{i}"), F.col("index").alias(f"__tail_{i}"))
        cold = cold.join(tail, f"__open_{i}", "left")
    found = [F.coalesce(f"__frequent_{i}", f"__tail_{i}").alias(o) for i, o in enumerate(outputs.values())]
    return direct.unionByName(cold.select(*names, *found))


def indexers(
    levels: Levels, columns: Sequence[str] | None = None, suffix: str = "_index", unknown: str = "error"
) -> list[StringIndexerModel]:
    """The dictionaries of narrow columns as Spark ML stages; unknown levels and nulls fail, or as ``unknown`` says.

    One stage per column: PySpark pads label lists of unequal length to a rectangle when several
    share a stage, which would add levels that do not exist.
    """
    columns = [c for c in (columns or levels.columns) if not levels.is_wide(c)]
    return [
        StringIndexerModel.from_labels(levels.labels[c], inputCol=c, outputCol=c + suffix, handleInvalid=unknown)
        for c in columns
    ]


def index_apply(
    df: DataFrame,
    levels: Levels,
    columns: Sequence[str] | None = None,
    suffix: str = "_index",
    *,
    numeric: Sequence[str] = (),
    unknown: float | None = None,
) -> DataFrame:
    """Add ``<column>_index``, the double index of each level; an unknown level or null fails the query.

    With ``unknown`` these get that index instead, 0.0 being the most frequent level's: a dictionary of frequent
    levels only may hold none at all, and then nothing that a value could be replaced by. Indexes are marked as nominal for learners, but for those of the columns in ``numeric``; those of columns whose
    dictionary is a table carry the number of levels without their names. Values are compared as strings,
    whatever the type of the column.
    """
    columns = list(columns or levels.columns)
    wide = {c: c + suffix for c in columns if levels.is_wide(c)}
    if wide:
        df = _lookup(df, levels, wide)
        checked = {}
        for c, output in wide.items():
            unseen = F.raise_error(F.concat(F.lit(f"{c}: level not seen in training: "), F.col(c).cast("string")))
            index = (
                F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c}: null has no index")))
                .when(F.col(output).isNull(), unseen)
                .otherwise(F.col(output))
            )
            if unknown is not None:
                index = F.coalesce(F.col(output), F.lit(float(unknown)))
            nominal = {} if c in numeric else {"ml_attr": {"type": "nominal", "name": output, "num_vals": levels.size(c)}}
            checked[output] = index.alias(output, metadata=nominal)
        df = df.select(*[checked.get(n, F.col(n)) for n in df.columns])
    stages = indexers(levels, columns, suffix, "error" if unknown is None else "keep")
    text = {s.getInputCol(): F.col(s.getInputCol()).cast("string") for s in stages}
    kept = [F.col(c).alias(f"__own_{c}") for c in text]
    out = PipelineModel(stages).transform(df.select("*", *kept).withColumns(text)) if stages else df
    plain = {c + suffix: F.col(c + suffix).alias(c + suffix, metadata={}) for c in numeric if c in text}
    if unknown is not None:
        # Those that the dictionary lacks have been kept as one more level.
        for c in text:
            names = levels.labels[c]
            index = F.when(F.col(c + suffix) < len(names), F.col(c + suffix)).otherwise(F.lit(float(unknown)))
            nominal = {"ml_attr": {"type": "nominal", "name": c + suffix, "vals": names}} if names and c not in numeric else {}
            plain[c + suffix] = index.alias(c + suffix, metadata=nominal)
    out = out.withColumns({c: F.col(f"__own_{c}") for c in text} | plain).drop(*(f"__own_{c}" for c in text))
    return out


def unseen_to_mode(df: DataFrame, levels: Levels, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace every value that is not a fitted level, null included, by the most frequent level.

    The columns become strings, numeric ones too. Columns not named are untouched, so leave the
    target out unless silently moving unknown targets to the majority class is wanted.
    """
    columns = list(columns or levels.columns)
    wide = {c: f"{_INDEX}_{i}" for i, c in enumerate(filter(levels.is_wide, columns))}
    if wide:
        values = {
            c: F.when(F.col(index).isNotNull(), F.col(c).cast("string")).otherwise(F.lit(levels.mode(c)))
            for c, index in wide.items()
        }
        df = _lookup(df, levels, wide).withColumns(values).drop(*wide.values())
    replaced = {}
    for c in columns:
        if not levels.is_wide(c):
            value = F.col(c).cast("string")
            seen = value.isin(levels.labels[c]) if levels.labels[c] else F.lit(False)
            replaced[c] = F.when(seen, value).otherwise(F.lit(levels.mode(c)).cast("string"))
    return df.withColumns(replaced) if replaced else df

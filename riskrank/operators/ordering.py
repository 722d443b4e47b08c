"""Total orders over distributed rows: positions and running totals without a single-task window.

A ``Layout`` holds fixed cut points of a sort order. The bucket of a row is a deterministic
expression of its sort keys, so separate passes agree on it with nothing materialised in between,
and a lost executor simply recomputes the same buckets. Running totals then take

1. one pass that counts the rows and picks one of each of ``SLOTS`` hash slots for the cut points,
2. one pass that adds up every bucket (map-side combined, one small row per bucket), and
3. one shuffle that sends each bucket to its own task, headed by a row that holds the totals of all
   earlier buckets, where a window adds up locally.

Cut points are tuples of *all* sort keys, the unique last one included, so a score shared by a
third of the rows is divided by id like anything else. Where the cut points fall changes only the
balance of the tasks, never the result. Where one level of cut points would leave buckets too large,
each bucket is divided again by cut points of its own, which are a table and never on the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskrank.sources.workspace import Workspace

# Buckets aim at ROWS_PER_BUCKET rows each, at every size.
MIN_BUCKETS = 4
ROWS_PER_BUCKET = 1_000_000
# Rows that one pass over a table picks for cut points, and how many of them stand for a bucket.
SLOTS = 8192
SAMPLES_PER_BUCKET = 16
# Buckets of one level of cut points, those that each of them is divided into, and tasks of a shuffle.
MAX_COARSE = SLOTS // SAMPLES_PER_BUCKET
MAX_FINE = 4096
MAX_TASKS = 8192
# Buckets smaller than they need to be share tasks, once there are so many.
MANY_TASKS = 64
BUCKET = "__bucket"
SLOT = "__slot"
TASK = "__task"
_VALUE, _INTERVAL, _HOT = "__value", "__interval", "__hot"


@dataclass(frozen=True)
class Key:
    """One sort key. Nulls sort as Spark does by default: first ascending, last descending."""

    name: str
    descending: bool = False

    def ordering(self) -> Column:
        return F.desc(self.name) if self.descending else F.asc(self.name)


def as_key(key: Key | str) -> Key:
    """``"name"`` or ``"-name"`` (descending) as a Key."""
    if isinstance(key, Key):
        return key
    return Key(key[1:], True) if key.startswith("-") else Key(key)


@dataclass(frozen=True)
class Layout:
    """Cut points dividing a sort order into contiguous buckets; no cut points mean one bucket.

    ``fine`` divides the buckets of ``cuts`` further: a table with a row for each of them, bucket, base (its
    first bucket in the finer count) and cuts (an ordered array of structs of the keys); ``total`` finer buckets. ``rows`` is the
    number of rows that the cut points were chosen for.

    A faster search may place a row that is tied with a hot score and next to a cut point on the other side of it, always the
    same one. With ``exact`` it does not, so that a cut point divides the rows alike in all layouts that hold it.
    """

    keys: tuple[Key, ...]
    cuts: tuple[tuple, ...] = ()
    types: tuple[T.DataType, ...] = ()
    nullable: bool = False
    fine: DataFrame | None = None
    total: int = 0
    exact: bool = False
    rows: int = 0

    @property
    def buckets(self) -> int:
        return len(self.cuts) + 1 if self.fine is None else self.total

    @property
    def tasks(self) -> int:
        """Tasks of a shuffle by bucket: each has one bucket, or a run of them."""
        return min(self.buckets, MAX_TASKS, max(MANY_TASKS, choose_buckets(self.rows)))

    def ordering(self) -> list[Column]:
        return [k.ordering() for k in self.keys]

    def place(self, df: DataFrame) -> DataFrame:
        """Add the bucket of each row: the number of cut points at or before it in the order."""
        if self.fine is None:
            return self._place_coarse(df)
        coarse = self._place_coarse(df)
        fine = self.fine.select(F.col("bucket").alias(BUCKET), F.col("base").alias("__base"), F.col("cuts").alias("__cuts"))
        cut = F.col("__cuts")
        inside = self._search(
            F.size(cut), MAX_FINE, lambda i, n: F.get(cut, i).getField(f"k{n}")
        )
        joined = coarse.join(fine, BUCKET, "left")
        return joined.select(*df.columns, (F.coalesce("__base", F.lit(0)) + F.coalesce(inside, F.lit(0))).alias(BUCKET))

    def _place_coarse(self, df: DataFrame) -> DataFrame:
        if not self.cuts:
            return df.withColumn(BUCKET, F.lit(0))
        if self._is_ranking():
            return self._place_by_score(df)
        arrays = [_literal_array([cut[i] for cut in self.cuts], kind) for i, kind in enumerate(self.types)]
        found = self._search(F.lit(len(self.cuts)), len(self.cuts), lambda i, n: F.get(arrays[n], i))
        # Never null; saying so keeps joins from adding a second evaluation as a null filter.
        return df.withColumn(BUCKET, F.coalesce(found, F.lit(0)))

    def _is_ranking(self) -> bool:
        score, *rest = self.keys
        return (
            not self.nullable
            and score.descending
            and isinstance(self.types[0], T.DoubleType)
            and len(rest) <= 1
            and not any(k.descending for k in rest)
            and all(math.isfinite(c[0]) for c in self.cuts)
        )

    def _place_by_score(self, df: DataFrame) -> DataFrame:
        """Buckets of (score descending, id ascending) by compiled searches.

        Only rows tied with a cut point look at the id, and only a score with several cut points,
        a hot one, needs a search among ids.
        """
        # Adding 0.0 turns -0.0 into 0.0, which sort alike but not in a binary search.
        ids_at: dict[float, list] = {}
        for cut in self.cuts:
            ids_at.setdefault(cut[0] + 0.0, []).append(cut[1] if len(cut) > 1 else None)
        scores = sorted(ids_at)
        # Interval 0 lies below all cut scores, interval i from the i-th lowest up to the next one.
        groups = [[], *[ids_at[s] for s in scores]]
        above = [len(self.cuts) - n for n in accumulate(len(g) for g in groups)]

        score = F.col(self.keys[0].name) + F.lit(0.0)
        placed = _count_splits(df, score, scores, _INTERVAL)
        tied = _at(_INTERVAL, [None, *scores], T.DoubleType()) == score
        within = F.lit(1)
        if len(self.keys) == 2:
            id, kind = F.col(self.keys[1].name), self.types[1]
            within = (_at(_INTERVAL, [g[0] if g else None for g in groups], kind) <= id).cast("int")
            if len(ids_at) < len(self.cuts):
                placed, hot = _search_hot_ids(placed, groups, tied, id, kind, self.exact)
                within = F.coalesce(hot, within)
        bucket = _at(_INTERVAL, above, T.IntegerType()) + F.when(tied, within).otherwise(F.lit(0))
        return placed.select(*df.columns, F.coalesce(bucket, F.lit(0)).alias(BUCKET))

    def _search(self, length: Column, at_most: int, cut_key) -> Column:
        """Cut points at or before the row, of ``length``; ``cut_key(i, n)`` is the n-th key of the i-th one."""

        def at_or_before(i: Column) -> Column:
            result = None
            for n in reversed(range(len(self.keys))):
                cut, value = cut_key(i, n), F.col(self.keys[n].name)
                before, same = self._compare(cut, value, self.keys[n].descending)
                result = before | same if result is None else before | (same & result)
            return (i < length) & result

        return _binary_search(F.lit(0), at_most, at_or_before)

    def _compare(self, cut: Column, value: Column, descending: bool) -> tuple[Column, Column]:
        before = cut > value if descending else cut < value
        if not self.nullable:
            return before, cut == value
        null_first = cut.isNotNull() & value.isNull() if descending else cut.isNull() & value.isNotNull()
        return F.coalesce(before, F.lit(False)) | null_first, cut.eqNullSafe(value)


def _binary_search(start: Column, length: int, holds) -> Column:
    """``start`` plus the number of leading positions, out of at most ``length``, where ``holds(i)``."""
    steps = [1 << k for k in reversed(range(length.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        start,
        lambda at, step: F.when(holds(at + step - 1), at + step).otherwise(at),
    )


def _literal_array(values: Sequence, kind: T.DataType) -> Column:
    """A constant array. One JSON literal, where the type allows it, builds far faster than many small ones."""
    if isinstance(kind, (T.IntegralType, T.StringType)) or (
        isinstance(kind, T.DoubleType) and all(v is None or math.isfinite(v) for v in values)
    ):
        return F.from_json(F.lit(json.dumps(list(values))), T.ArrayType(kind))
    return F.array(*[F.lit(v) for v in values]).cast(T.ArrayType(kind))


def _at(position: str, values: Sequence, kind: T.DataType) -> Column:
    """The element of a constant array at the position held by a column."""
    return F.get(_literal_array(values, kind), F.col(position))


def _count_splits(df: DataFrame, value: Column, splits: Sequence[float], output: str) -> DataFrame:
    """Add the number of ascending ``splits`` at or below a double; null for null."""
    search = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol=_VALUE, outputCol=output)
    found = search.transform(df.withColumn(_VALUE, value))
    # The search describes every interval in the column's metadata, which nobody needs.
    return found.select(*df.columns, F.col(output).cast("int").alias(output, metadata={}))


def _search_hot_ids(
    df: DataFrame, groups: Sequence[list], tied: Column, id: Column, kind: T.DataType, exact: bool
) -> tuple[DataFrame, Column]:
    """For rows tied with a hot score: how many of its cut points have an id up to the row's.

    ``groups`` holds the ids of the cut points per interval; hot ones have several. Null elsewhere.
    """
    hot = [g if len(g) > 1 else [] for g in groups]
    slots = [n - 1 if g else None for g, n in zip(hot, accumulate(1 if g else 0 for g in hot))]
    if exact or not isinstance(kind, T.NumericType):
        ends = list(accumulate(len(g) for g in hot))
        ids = _literal_array([v for g in hot for v in g], kind)
        start = _at(_INTERVAL, [e - len(g) for e, g in zip(ends, hot)], T.IntegerType())
        end = _at(_INTERVAL, ends, T.IntegerType())
        found = _binary_search(start, max(map(len, hot)), lambda i: (i < end) & (F.get(ids, i) <= id))
        return df, F.when(tied & _at(_INTERVAL, slots, T.IntegerType()).isNotNull(), found - start)

    # One compiled search serves all hot scores: slot n covers n to n + 1, and an id is placed in
    # its slot by a non-decreasing map. Rounding may merge neighbours but cannot swap them.
    low = float(min(min(g) for g in hot if g))
    spread = float(max(max(g) for g in hot if g)) - low or 1.0
    splits, counts = [], [0]
    for slot, ids in enumerate(g for g in hot if g):
        splits.append(float(slot))
        counts.append(0)
        for n, v in enumerate(ids, start=1):
            key = slot + 0.25 + 0.5 * ((float(v) - low) / spread)
            if key > splits[-1]:
                splits.append(key)
                counts.append(n)
            else:
                counts[-1] = n
    inside = F.lit(0.25) + F.lit(0.5) * ((id.cast("double") - F.lit(low)) / F.lit(spread))
    key = _at(_INTERVAL, slots, T.IntegerType()).cast("double") + F.greatest(F.lit(0.1), F.least(F.lit(0.9), inside))
    placed = _count_splits(df, F.when(tied, key), splits, _HOT)
    return placed, _at(_HOT, counts, T.IntegerType())


def choose_buckets(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(MIN_BUCKETS, math.ceil(rows / rows_per_bucket))


def survey(placed: DataFrame, layout: Layout, measures: Sequence[str] = (), slots: int = SLOTS) -> list:
    """One pass over rows that ``layout`` has placed: for each bucket and slot, rows, sums and a row's keys, in order.

    A slot is a part of the rows by a hash of their keys, and the row with the least hash stands for it, so that
    the keys are a sample of each bucket. All is combined before it is shuffled; some ``slots`` rows reach the driver.
    Columns: the bucket, n, ``sum_<measure>``, ``k<i>`` (a key) and ``nulls`` (of keys).
    """
    names = [k.name for k in layout.keys]
    # Keys that differ in their bits only, as zeros do, need not fall in one slot.
    code = F.xxhash64(*names)
    each = max(1, slots // layout.buckets)
    nulls = sum((F.col(n).isNull().cast("int") for n in names), F.lit(0))
    grouped = placed.withColumn("__code", code).groupBy(BUCKET, F.pmod("__code", F.lit(each)).alias(SLOT))
    summed = grouped.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(m).alias(f"sum_{m}") for m in measures],
        *[F.min_by(k, "__code").alias(f"k{i}") for i, k in enumerate(names)],
        F.sum(nulls).alias("nulls"),
    )
    order = [F.desc(f"k{i}") if k.descending else F.asc(f"k{i}") for i, k in enumerate(layout.keys)]
    return summed.repartition(1).sortWithinPartitions(BUCKET, *order).collect()


def keys_of(row, layout: Layout) -> tuple:
    return tuple(row[f"k{i}"] for i in range(len(layout.keys)))


def distinct_cuts(cuts: Sequence[tuple]) -> tuple[tuple, ...]:
    """Ordered cut points without repeats."""
    return tuple(c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1])


def plan_layout(
    df: DataFrame,
    keys: Sequence[Key | str],
    *,
    num_buckets: int | None = None,
    nullable: bool | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    workspace: Workspace | None = None,
) -> Layout:
    """Choose cut points for sorting ``df`` by ``keys``, in one pass.

    The row count decides the number of buckets unless ``num_buckets`` is given. Up to ``MAX_COARSE`` buckets have
    their cut points on the driver. More are found by a second pass that samples every one of those and writes the cut
    points that divide it to the ``workspace``.

    ``nullable=False`` states that no key holds a null, which makes the bucket search cheaper; with
    None the pass finds out.
    """
    keys = tuple(as_key(k) for k in keys)
    types = tuple(df.schema[k.name].dataType for k in keys)
    if num_buckets is not None and not 1 <= num_buckets <= MAX_COARSE * MAX_FINE:
        raise ValueError(f"num_buckets must lie between 1 and {MAX_COARSE * MAX_FINE}")
    if num_buckets == 1:
        return Layout(keys, (), types)
    columns = df.select(*[k.name for k in keys])
    whole = Layout(keys, (), types)
    found = survey(whole.place(columns), whole)
    rows = sum(r.n for r in found)
    nullable = any(r.nulls for r in found) if nullable is None else nullable
    if not rows:
        return Layout(keys, (), types)
    buckets = num_buckets or choose_buckets(rows, rows_per_bucket)
    coarse = min(buckets, MAX_COARSE)
    cuts = distinct_cuts([keys_of(found[i * len(found) // coarse], whole) for i in range(1, coarse)])
    layout = Layout(keys, cuts, types, nullable, rows=rows)
    if buckets <= MAX_COARSE:
        return layout
    return _divided(columns, layout, rows / buckets, workspace or Workspace(df.sparkSession))


def _divided(columns: DataFrame, layout: Layout, target: float, ws: Workspace) -> Layout:
    """``layout`` with each bucket divided into as many as bring it to ``target`` rows, by a sample of its own."""
    share = min(1.0, SAMPLES_PER_BUCKET / target)
    names = [k.name for k in layout.keys]
    sampled = columns if share == 1 else columns.where(F.pmod(F.xxhash64(*names), F.lit(1 << 30)) < int(share * (1 << 30)))
    own = W.partitionBy(BUCKET)
    numbered = layout.place(sampled).select(
        BUCKET,
        F.struct(*[F.col(n).alias(f"k{i}") for i, n in enumerate(names)]).alias("cut"),
        F.row_number().over(own.orderBy(*layout.ordering())).alias("n"),
        F.count(F.lit(1)).over(own).alias("rows"),
    )
    parts = F.least(F.lit(MAX_FINE), F.ceil(F.col("rows") / F.lit(share * target))).cast("long")
    first_of_part = (F.col("n") - 1) * F.col("parts") % F.col("rows") < F.col("parts")
    cut_points = (
        numbered.withColumn("parts", parts)
        .where(first_of_part & (F.col("n") > 1) | (F.col("n") == 1))
        .groupBy(BUCKET)
        .agg(
            F.max("parts").alias("parts"),
            F.transform(F.sort_array(F.collect_list(F.when(F.col("n") > 1, F.struct("n", "cut")))), lambda x: x["cut"]).alias("cuts"),
        )
    )
    # One row for each coarse bucket, those without a sampled row too: the running count is a small window.
    every = columns.sparkSession.range(layout.buckets).select(F.col("id").cast("int").alias(BUCKET))
    parts = F.coalesce("parts", F.lit(1))
    before = W.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    fine = every.join(cut_points, BUCKET, "left").select(
        F.col(BUCKET).alias("bucket"), F.coalesce(F.sum(parts).over(before), F.lit(0)).alias("base"), "cuts", parts.alias("parts")
    )
    kept = ws.keep(fine, "cut_points")
    return replace(layout, fine=kept, total=int(kept.agg(F.sum("parts")).first()[0]))


def bucket_starts(keyed: DataFrame, layout: Layout, measures: Sequence[str]) -> DataFrame:
    """Per bucket: ``__start_rows`` and ``__start_<m>``, the totals of all earlier ones, and ``total_<m>`` of the table.

    Prefix sums in two levels: over groups of ``MAX_TASKS`` buckets, then within each group.
    """
    names = ["rows", *measures]
    sums = keyed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("__rows"), *[F.sum(m).alias(f"__{m}") for m in measures])
    group = F.floor(F.col(BUCKET) / MAX_TASKS)

    def earlier(window, m: str, label: str) -> Column:
        return F.coalesce(F.sum(f"__{m}").over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(label)

    if layout.buckets <= MAX_TASKS:
        in_order, everything = W.orderBy(BUCKET), W.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        return sums.select(
            BUCKET,
            *[earlier(in_order, m, f"__start_{m}") for m in names],
            *[F.sum(f"__{m}").over(everything).alias(f"total_{m}") for m in measures],
        )
    sums = sums.withColumn("__group", group)
    groups = sums.groupBy("__group").agg(*[F.sum(f"__{m}").alias(f"__{m}") for m in names])
    in_order = W.orderBy("__group")
    everything = in_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    heads = groups.select(
        "__group",
        *[earlier(in_order, m, f"__head_{m}") for m in names],
        *[F.sum(f"__{m}").over(everything).alias(f"total_{m}") for m in measures],
    )
    inside = W.partitionBy("__group").orderBy(BUCKET)
    local = sums.select("__group", BUCKET, *[earlier(inside, m, f"__local_{m}") for m in names])
    return local.join(heads, "__group").select(
        BUCKET,
        *[(F.col(f"__head_{m}") + F.col(f"__local_{m}")).alias(f"__start_{m}") for m in names],
        *[f"total_{m}" for m in measures],
    )


def running_totals(df: DataFrame, layout: Layout, measures: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ``idx`` (0-based position) and, per measure ``m``, columns ``m``, ``cum_m`` and ``total_m``.

    Measures must be whole numbers. Every bucket is headed by a row that holds the totals of all earlier ones, so
    that the window adds up from there, and nothing that grows with the table is broadcast.
    """
    measures = dict(measures or {})
    names = list(measures)
    added = {"idx", *(f"{k}_{m}" for m in names for k in ("cum", "total"))}
    if clash := sorted(c for c in df.columns if c in added or c.startswith("__")):
        raise ValueError(f"rename the columns {clash}: their names are those of added or inner columns")
    keyed = df.withColumns(measures) if measures else df
    columns = [*df.columns, *[n for n in names if n not in df.columns]]
    keyed = layout.place(keyed)
    starts = bucket_starts(keyed, layout, names)
    heads = starts.select(
        BUCKET,
        F.lit(False).alias("__is_row"),
        F.col("__start_rows").alias("__n"),
        *[F.col(f"__start_{m}").alias(f"__sum_{m}") for m in names],
        *[f"total_{m}" for m in names],
    )
    rows = keyed.select(
        *columns, BUCKET, F.lit(True).alias("__is_row"), F.lit(1).cast("long").alias("__n"), *[F.col(m).alias(f"__sum_{m}") for m in names]
    )
    task = F.floor(F.col(BUCKET) / -(-layout.buckets // layout.tasks)).cast("int")
    both = rows.unionByName(heads, allowMissingColumns=True).withColumn(TASK, task).repartitionById(layout.tasks, F.col(TASK))
    local = W.partitionBy(TASK, BUCKET).orderBy("__is_row", *layout.ordering()).rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = both.select(
        *columns,
        "__is_row",
        (F.sum("__n").over(local) - 1).alias("idx"),
        *[F.sum(f"__sum_{m}").over(local).alias(f"cum_{m}") for m in names],
        *[F.max(f"total_{m}").over(local).alias(f"total_{m}") for m in names],
    )
    return summed.where("__is_row").drop("__is_row")


def sort_by_key(
    df: DataFrame, keys: Sequence[Key | str], *, num_buckets: int | None = None, layout: Layout | None = None
) -> DataFrame:
    """Number the rows of ``df`` in the order of ``keys`` (``"-name"`` for descending) as ``idx``.

    End the keys with a unique column, or the order among equal rows is arbitrary. The rows come
    out laid out in that order; ``orderBy("idx")`` states it explicitly where a consumer needs it.
    """
    layout = layout or plan_layout(df, keys, num_buckets=num_buckets)
    return running_totals(df, layout)

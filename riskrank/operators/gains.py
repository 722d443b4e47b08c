"""Ranking by score, class-weighted cumulative gains and detection rates at operating points.

Rows are ranked by score descending, then id ascending. Label 1 means bad. Each row weighs
``bad_weight`` or ``good_weight``; the weighted share of the rows up to a position says how much
review traffic a score threshold costs, and the running count of bads what it catches.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskrank.functions.columns import (
    BAD_WEIGHT,
    GOOD_WEIGHT,
    checked_id,
    checked_label,
    checked_score,
    class_weight,
)
from riskrank.operators.ordering import (
    BUCKET,
    MAX_COARSE,
    Key,
    Layout,
    keys_of,
    plan_layout,
    running_totals,
    survey,
)
from riskrank.sources.workspace import Workspace

# The weighted traffic shares at which detection rates are reported.
CUTOFFS = (0.0025, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5)


RANKING = (Key("score", descending=True), Key("id"))
# Rows that one task sorts in the end, in each stretch of the ranking that may hold an answer.
FEW_ROWS = 250_000


def rank_layout(
    df: DataFrame,
    score: str = "score",
    id: str = "id",
    *,
    num_buckets: int | None = None,
    workspace: Workspace | None = None,
) -> Layout:
    """Cut points for ranking by ``score`` descending, ``id`` ascending; share it between operators."""
    keyed = df.select(checked_score(df, score).alias("score"), checked_id(id).alias("id"))
    return plan_layout(keyed, RANKING, num_buckets=num_buckets, nullable=False, workspace=workspace)


def _ranking_input(df: DataFrame, score: str, label: str, id: str) -> DataFrame:
    return df.select(
        checked_id(id).alias("id"), checked_score(df, score).alias("score"), checked_label(label).alias("label")
    )


def _weighted(ranked: DataFrame, bad_weight: int, good_weight: int) -> DataFrame:
    return ranked.withColumn("w", class_weight(F.col("label"), bad_weight, good_weight))


def score_rank(
    df: DataFrame, score: str = "score", id: str = "id", *, num_buckets: int | None = None, layout: Layout | None = None
) -> DataFrame:
    """``(id, score, idx)``: the 0-based position of every row in the ranking."""
    layout = layout or rank_layout(df, score, id, num_buckets=num_buckets)
    ranked = df.select(checked_id(id).alias("id"), checked_score(df, score).alias("score"))
    return running_totals(ranked, layout)


def gains_table(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    id: str = "id",
    *,
    bad_weight: int = BAD_WEIGHT,
    good_weight: int = GOOD_WEIGHT,
    num_buckets: int | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """Cumulative gains of every row.

    Columns: id, score, label, idx, w, cum_total (weights so far), cum_bad (bads so far),
    cum_good (``cum_total - cum_bad``) and cum_total_norm (``cum_total`` over the total weight).
    """
    layout = layout or rank_layout(df, score, id, num_buckets=num_buckets)
    weighted = _weighted(_ranking_input(df, score, label, id), bad_weight, good_weight)
    totals = running_totals(weighted, layout, {"w": F.col("w"), "label": F.col("label")})
    return totals.select(
        "id",
        "score",
        "label",
        "idx",
        "w",
        F.col("cum_w").alias("cum_total"),
        F.col("cum_label").alias("cum_bad"),
        (F.col("cum_w") - F.col("cum_label")).alias("cum_good"),
        (F.col("cum_w") / F.col("total_w")).alias("cum_total_norm"),
    )


@dataclass(frozen=True)
class Stretch:
    """A stretch of the ranking: the cut point it begins at (none: the top), its size, and the sums before it.

    ``keys`` are a sample of its rows in order; ``end`` is the cut point after it.
    """

    begin: tuple | None
    end: tuple | None
    rows: int
    sums: tuple[int, int]
    before: tuple[int, int, int]
    keys: list[tuple]


def _stretches(ranked: DataFrame, layout: Layout, held: Sequence[Stretch | None]) -> list[Stretch]:
    """One pass: the buckets of ``layout`` that lie in the stretches ``held`` (one a bucket, or none), with their sums."""
    wanted = [b for b, s in enumerate(held) if s is not None]
    placed = layout.place(ranked)
    if len(wanted) < layout.buckets:
        placed = placed.where(F.col(BUCKET).isin(wanted))
    per_bucket: dict[int, list] = {}
    for r in survey(placed, layout, ("w", "label")):
        per_bucket.setdefault(r[BUCKET], []).append(r)
    edges = [None, *layout.cuts, None]
    out, of, at = [], None, (0, 0, 0)
    for b in wanted:
        if held[b] is not of:
            of, at = held[b], held[b].before
        rows = per_bucket.get(b, [])
        n, w, y = sum(r.n for r in rows), sum(r.sum_w for r in rows), sum(r.sum_label for r in rows)
        if n:
            out.append(Stretch(edges[b], edges[b + 1] or of.end, n, (w, y), at, [keys_of(r, layout) for r in rows]))
        at = (at[0] + n, at[1] + w, at[2] + y)
    return out


def _select(ranked: DataFrame, cutoffs: Sequence[float], layout: Layout, few_rows: int) -> tuple[list[Stretch], int, int]:
    """The stretches of ``few_rows`` at most that can hold an answer; the weight and the bads of all rows.

    A round is one pass over the rows of the stretches that are left. It adds up the parts that the last round's sample
    cut them into, drops those that no cut-off falls into, and samples the rest. What is left shrinks
    by a factor of ``SLOTS`` over the number of cut-offs, or so, with every round.
    """
    whole = Stretch(None, None, 0, (0, 0), (0, 0, 0), [])
    found = _stretches(ranked, layout, [whole] * layout.buckets)
    weight, bads = (sum(s.sums[i] for s in found) for i in (0, 1))
    while True:
        def holds(s: Stretch) -> bool:
            begin, end = float(s.before[1]) / weight, float(s.before[1] + s.sums[0]) / weight
            return s.before[0] == 0 or any(end >= p and begin <= p for p in cutoffs)

        found = [s for s in found if holds(s)]
        # A stretch of one key, which is no unique one, cannot be divided.
        if all(s.rows <= few_rows or len(set(s.keys)) == 1 for s in found):
            return found, weight, bads
        # Around every stretch lie cut points; within a large one, its sample does.
        cuts: list[tuple] = []
        held: list[Stretch | None] = [None]
        for s in found:
            inner = [k for k in s.keys if k != s.begin] if s.rows > few_rows else []
            inner = inner[:: max(1, -(-len(inner) * len(found) // MAX_COARSE))]
            for cut in ([] if s.begin is None else [s.begin]) + inner:
                if cuts and cuts[-1] == cut:
                    held[-1] = s
                else:
                    cuts.append(cut)
                    held.append(s)
            if s.begin is None:
                held[0] = s
            if s.end is not None:
                cuts.append(s.end)
                held.append(None)
        layout = replace(layout, cuts=tuple(cuts))
        found = _stretches(ranked, layout, held)


def tdr_at(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    id: str = "id",
    *,
    cutoffs: Sequence[float] = CUTOFFS,
    bad_weight: int = BAD_WEIGHT,
    good_weight: int = GOOD_WEIGHT,
    num_buckets: int | None = None,
    layout: Layout | None = None,
    few_rows: int = FEW_ROWS,
) -> DataFrame:
    """Detection rate at each weighted traffic share: one row ``(cutoff, idx, rate)`` per cut-off.

    ``idx`` is the last position from 1 on whose own weighted share reaches the cut-off while the
    share before it does not pass it; 0 if there is none. ``rate`` is the share of all bads found
    up to that position, null when there are no bads. An empty table gives null for both.

    A weighted selection, without sorting the table: rounds of one pass each narrow down the stretches of the ranking
    that may hold an answer, and only the rows of the last ones, ``few_rows`` each, are shuffled and
    sorted. A ``layout`` or ``num_buckets`` gives the cut points of the first round.
    """
    if not cutoffs:
        raise ValueError("tdr_at needs at least one cut-off")
    cutoffs = [float(p) for p in cutoffs]
    ranked = _weighted(_ranking_input(df, score, label, id), bad_weight, good_weight)
    if num_buckets is not None and layout is None:
        layout = plan_layout(ranked, RANKING, num_buckets=num_buckets, nullable=False)
    start = Layout(RANKING, (), tuple(ranked.schema[k.name].dataType for k in RANKING))
    if layout is not None and layout.fine is None:
        start = layout
    start = replace(start, exact=True)
    found, weight, bads = _select(ranked, cutoffs, start, few_rows)
    one = df.sparkSession.range(1)
    if not found:
        rows = F.explode(F.array(*[F.lit(p) for p in cutoffs]))
        return one.select(rows.alias("cutoff"), F.lit(None).cast("bigint").alias("idx"), F.lit(None).cast("double").alias("rate"))

    # The stretches are buckets again; what lies between them goes.
    cuts, number = [], {}
    for s in found:
        if s.begin is not None and (not cuts or cuts[-1] != s.begin):
            cuts.append(s.begin)
        number[len(cuts)] = s
        if s.end is not None:
            cuts.append(s.end)
    placed = replace(start, cuts=tuple(cuts)).place(ranked)
    before = [F.create_map(*[F.lit(v) for b, s in number.items() for v in (b, s.before[i])]) for i in range(3)]
    near = placed.where(F.col(BUCKET).isin(list(number)))
    local = W.partitionBy(BUCKET).orderBy(*start.ordering())
    upto = local.rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = near.select(
        (F.row_number().over(local) - 1 + before[0][F.col(BUCKET)]).cast("bigint").alias("idx"),
        "w",
        (F.sum("w").over(upto) + before[1][F.col(BUCKET)]).alias("cum_w"),
        (F.sum("label").over(upto) + before[2][F.col(BUCKET)]).alias("cum_label"),
    )

    # Whole-number weights make (cum_w - w) / total exactly the share of the previous row.
    reached, passed = F.col("cum_w") / F.lit(weight), (F.col("cum_w") - F.col("w")) / F.lit(weight)
    bracketed = [(F.col("idx") == 0) | ((reached >= p) & (passed <= p)) for p in cutoffs]
    found_at = F.struct("idx", "cum_label")
    # The filter leaves the few rows at a cut-off, so the aggregate over structs is small.
    hits = totals.where(reduce(operator.or_, bracketed)).agg(
        *[F.max(F.when(holds, found_at)).alias(f"hit_{i}") for i, holds in enumerate(bracketed)]
    )
    rows = F.array(*[F.struct(F.lit(p).alias("cutoff"), F.col(f"hit_{i}").alias("hit")) for i, p in enumerate(cutoffs)])
    return hits.select(F.explode(rows).alias("r")).select(
        F.col("r.cutoff").alias("cutoff"),
        F.col("r.hit.idx").alias("idx"),
        F.try_divide(F.col("r.hit.cum_label"), F.lit(bads)).alias("rate"),
    )

"""Best-fit packing of token sequences by minimum bin slack.

Sequences of equal length are interchangeable, so the plan needs only how many there are of each length:
at most ``capacity`` counts, whatever the size of the corpus. For one bin after the other, a subset-sum
over the lengths still available (a bitset in one integer) finds the fullest combination that holds the
longest of them; it is taken as often as the counts allow. Spark numbers the pieces of each length and
looks up the place that the plan gives to that number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskrank.llm.common import Workspace, encoder

PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, row long, ids binary"


@dataclass
class Plan:
    """``bins[i]`` of lengths, taken ``times[i]`` times from sequence number ``first[i]`` on."""

    bins: list[list[int]]
    times: list[int]
    first: list[int]


def fullest(counts: dict[int, int], capacity: int) -> list[int]:
    """The combination with the largest sum up to ``capacity`` that holds the longest available length."""
    lengths = sorted((n for n, c in counts.items() if c), reverse=True)
    top = lengths[0]
    room = capacity - top
    mask = (1 << (room + 1)) - 1
    sums, trail = 1, []
    for n in lengths:
        left = counts[n] - (n == top)
        for _ in range(min(left, room // n)):
            more = sums | ((sums << n) & mask)
            if more == sums:
                break
            trail.append((n, sums))
            sums = more
        if sums >> room & 1:
            break
    at, chosen = sums.bit_length() - 1, [top]
    for n, before in reversed(trail):
        if not before >> at & 1:
            chosen.append(n)
            at -= n
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> Plan:
    """Pack ``counts`` (length: how many) into bins of ``capacity``."""
    counts = {n: c for n, c in counts.items() if c}
    plan, made = Plan([], [], []), 0
    while counts:
        chosen = fullest(counts, capacity)
        need: dict[int, int] = {}
        for n in chosen:
            need[n] = need.get(n, 0) + 1
        times = min(counts[n] // k for n, k in need.items())
        for n, k in need.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        plan.bins.append(chosen)
        plan.times.append(times)
        plan.first.append(made)
        made += times
    return plan


def places(plan: Plan) -> pd.DataFrame:
    """For each length, which runs of numbers go to which bins: number r in [base, base + n * k)."""
    rows, used = [], {}
    for chosen, times, first in zip(plan.bins, plan.times, plan.first, strict=True):
        at, offsets = 0, {}
        for n in chosen:
            offsets.setdefault(n, []).append(at)
            at += n
        for n, where in offsets.items():
            base = used.get(n, 0)
            rows.append((n, base, len(where), first, where))
            used[n] = base + times * len(where)
    return pd.DataFrame(rows, columns=["length", "base", "k", "first", "offsets"])


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id: str, text: str, keep_ids: bool
) -> DataFrame:
    """Every document's ids and the end id, cut from the end into pieces of ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_column
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            held = 0
            for ids, doc, row in zip(encode(batch.column(1)), *(batch.column(i).to_pylist() for i in (0, 2)), strict=True):
                ids += end
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    size = (n - at - 1) % capacity + 1 if piece == 0 else capacity
                    part = ids[4 * at : 4 * (at + size)]
                    for column, value in zip(
                        out, (doc, piece, at, size, zlib.crc32(part), row, part if keep_ids else None), strict=True
                    ):
                        column.append(value)
                    at += size
                    piece += 1
                    held += len(part)
                if held > 8 << 20:
                    yield _pieces_batch(out)
                    out, held = ([], [], [], [], [], [], []), 0
            yield _pieces_batch(out)

    rows = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    return rows.mapInArrow(run, PIECES_SCHEMA)


def _pieces_batch(columns: tuple[list, ...]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "row", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def pack(pieces: DataFrame, capacity: int, ws: Workspace) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (with ``length``, and ``row`` and ``piece`` that name a piece).

    Pieces are numbered within their length in two steps, so that a length that very many share is not
    gathered: by spread group, then by running totals of the groups' counts.
    """
    spark = pieces.sparkSession
    spread = F.pmod(F.xxhash64("row", "piece"), F.lit(spread_groups(pieces)))
    grouped = pieces.withColumn("spread", spread)
    totals = ws.keep(grouped.groupBy("length", "spread").agg(F.count("*").alias("n")), "lengths")
    counts = {r.length: r.n for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(plan_bins(counts, capacity))
    before = Window.partitionBy("length").orderBy("spread").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("length", "spread", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    local = F.row_number().over(Window.partitionBy("length", "spread").orderBy("row", "piece")) - 1
    numbered = grouped.withColumn("number", local).join(offsets, ["length", "spread"])
    numbered = numbered.withColumn("number", F.col("number") + F.col("skip")).drop("spread", "skip")

    by_length = {}
    for n, part in table.groupby("length"):
        part = part.sort_values("base")
        by_length[n] = (part.base.to_numpy(), part.k.to_numpy(), part["first"].to_numpy(), list(part.offsets))
    known = spark.sparkContext.broadcast(by_length)  # at most capacity counts, and a run for each bin and length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for n in np.unique(lengths):
                base, k, first, where = known.value[int(n)]
                rows = np.flatnonzero(lengths == n)
                run = np.searchsorted(base, numbers[rows], side="right") - 1
                inside = numbers[rows] - base[run]
                sequence[rows] = first[run] + inside // k[run]
                offset[rows] = [where[r][i] for r, i in zip(run, inside % k[run], strict=True)]
            names = [c for c in batch.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    schema = numbered.drop("number").schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInArrow(place, schema)


def spread_groups(df: DataFrame) -> int:
    """Groups in which equal keys are numbered side by side: as many as the session's shuffle partitions."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def pack_documents(
    docs: DataFrame,
    ws: Workspace,
    *,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids if asked for).

    A document's ids end with ``end_id``; only longer ones are cut, and the first piece takes the rest.
    A null or empty text gives one piece with the end id alone. Repeated rows and rows with a null id are
    packed as documents of their own; other columns are ignored; an empty table gives no rows.
    """
    pieces = tokenized_pieces(docs, tokenizer, capacity, end_id, id, text, keep_ids)
    pieces = ws.keep(pieces if keep_ids else pieces.drop("ids"), "pieces")
    return pack(pieces, capacity, ws).drop("row")

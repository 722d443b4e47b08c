"""Approximate nearest neighbours by cosine, with shifted space-filling curves.

Unit vectors are projected to a few dimensions, once for each curve and shifted, and ordered along a Hilbert
curve; Spark range-partitions each ordering into blocks. A query looks through the blocks around its own on
every curve, and what the windows find is merged and ranked by the exact cosine. How wide the windows must
be is measured: exact neighbours of a small sample of queries are located on the curves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.llm.common import Workspace
from riskrank.llm.vectors import classes, in_blocks, longs, matrix, nearest_ids, top_of, usable

CURVES = 4
DIMENSIONS = 8
BITS = 7
# Queries whose exact neighbours set the width of the windows, and the share of neighbours to be reached.
SAMPLE = 64
REACH = 0.97


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of cells (rows of coordinates below ``2 ** bits``)."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(len(x)):
            turned = (x[i] >> level & 1).astype(bool)
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    key = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | ((c ^ flip) >> level & 1)
    return key


def curve_keys(units: np.ndarray, curve: int, dimensions: int, bits: int) -> np.ndarray:
    """Keys of unit vectors on one curve, from a seeded projection and shift."""
    d = units.shape[1]
    rng = np.random.default_rng([curve, d])
    axes = np.linalg.qr(rng.standard_normal((d, d)))[0][:, : min(dimensions, d)]
    # Components of unit vectors spread by 1 / sqrt(d); three spreads each way fill half of the cells.
    scaled = np.clip((units @ axes) * np.sqrt(d) / 6 + 0.5, 0, 1 - 1e-9)
    half = 1 << (bits - 1)
    shift = rng.integers(0, half, axes.shape[1])
    return hilbert_keys((scaled * half).astype(np.int64) + shift, bits)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows with rows, in double precision."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def near(queries: np.ndarray, heads: np.ndarray, vecs: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """(row of the query, row of the vector, cosine) of the ``keep`` best for each query, and of those tied to rounding."""
    units = vecs / np.sqrt((vecs * vecs).sum(axis=1, keepdims=True))
    rough = queries @ units.T / np.sqrt((queries * queries).sum(axis=1, keepdims=True))
    i, j = np.nonzero(top_of(np.round(rough, 12), keep))
    score = cosines(queries[i], vecs[j])
    # Many equal scores: the smallest heads are enough.
    order = np.lexsort((heads[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    few = rank < keep
    return i[few], j[few], score[few]


def _pairs_batch(q: np.ndarray, c: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q), pa.array(c), pa.array(score)], names=["q", "c", "score"])


def window_width(blocks: DataFrame, asked: DataFrame, keep: int, sample: int, reach: float) -> int:
    """Blocks to each side that reach the share ``reach`` of the sampled queries' exact neighbours on some curve."""
    chosen = asked.orderBy(F.xxhash64("q"), "q").limit(sample).collect()
    if not chosen:
        return 0
    spark = blocks.sparkSession
    held = spark.sparkContext.broadcast((np.array([r.q for r in chosen]), np.array([r.vec for r in chosen], float)))  # sample rows

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, vectors = held.value
        for batch in batches:
            for n, own, vecs in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                own = longs(own)
                i, j, score = near(vectors, own, matrix(vecs, n.as_py()), keep)
                yield _pairs_batch(heads[i], own[j], score)

    one = blocks.where("grp = 0").select("n", "heads", "vecs").mapInArrow(exact, "q long, c long, score double")
    best: dict[int, list] = {}
    for r in one.where("q <> c").groupBy("q").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "c")), asc=False), 1, keep - 1).alias("best")).collect():
        best[r.q] = [x.c for x in r.best]
    wanted = spark.sparkContext.broadcast(np.array(sorted({*best, *(c for x in best.values() for c in x)}), np.int64))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, block, own in zip(*(batch.column(i) for i in range(3)), strict=True):
                hit = longs(own)[np.isin(longs(own), wanted.value)]
                n = len(hit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([grp.as_py()] * n, pa.int32()), pa.array([block.as_py()] * n, pa.int32()), pa.array(hit)], names=["grp", "block", "head"]
                )

    at: dict[int, dict[int, int]] = {}
    for r in blocks.select("grp", "block", "heads").mapInArrow(locate, "grp int, block int, head long").collect():
        at.setdefault(r.head, {})[r.grp] = r.block
    apart = sorted(min(abs(at[q][g] - at[c][g]) for g in at[q]) for q, x in best.items() for c in x)
    return apart[min(len(apart) - 1, int(np.ceil(reach * len(apart))) - 1)] if apart else 0


def nearest(
    df: DataFrame,
    ws: Workspace,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    every: int = 50,
    k: int = 5,
    curves: int = CURVES,
    sample: int = SAMPLE,
    reach: float = REACH,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for ids divisible by ``every``, the ``k`` nearest found among all other ids.

    Null and zero vectors, those with null or non-finite components and those not of the commonest length take
    no part, nor do rows with a null id; an id that repeats stands for the smallest of its vectors. Equal vectors
    are one class, found or missed together; equal scores go by id. All rows are indexed; only the width of the windows
    comes from a sample, of ``sample`` queries. An empty table gives no rows.
    """
    rows = usable(df, id, vector)
    rows = ws.keep(rows.where(F.exists("vec", lambda x: x != 0)), "vectors")
    groups = ws.keep(classes(rows, k + 1), "classes")
    asked = ws.keep(rows.where(F.pmod("vec_id", F.lit(every)) == 0), "asked")
    heads = groups.join(asked.select("vec").distinct(), "vec", "left_semi").select(F.col("head").alias("q"), "vec")
    marked = groups.select("head", "vec").join(heads.select(F.col("q").alias("head"), F.lit(True).alias("asked")), "head", "left")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vecs = batch.column(1).flatten().to_numpy().reshape(len(batch), -1)
            units = vecs / np.sqrt((vecs * vecs).sum(axis=1, keepdims=True))
            for curve in range(curves):
                key = curve_keys(units, curve, DIMENSIONS, BITS)
                grp = np.full(len(key), curve, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(grp), pa.array(key), *batch.columns], names=["grp", "key", "head", "vec", "asked"])

    stacked = marked.select("head", "vec", F.coalesce("asked", F.lit(False)).alias("asked"))
    stacked = ws.keep(stacked.mapInArrow(keyed, "grp int, key long, head long, vec array<double>, asked boolean"), "curves")
    blocks = ws.keep(in_blocks(stacked, ["key", "head"], ws), "ordered")
    width = window_width(blocks, heads, k + 1, sample, reach)
    def own_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [])
            for n, own, mark, vecs in zip(*(batch.column(i) for i in range(2, 6)), strict=True):
                mark = np.frombuffer(mark.as_buffer(), np.uint8).astype(bool)
                out[0].append(longs(own)[mark].tobytes())
                out[1].append(matrix(vecs, n.as_py())[mark].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.binary()) for x in out)], names=["grp", "block", "qheads", "qvecs"]
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for qheads, qvecs, n, own, vecs in zip(*batch.columns, strict=True):
                qheads, own = longs(qheads), longs(own)
                i, j, score = near(matrix(qvecs, len(qheads)), own, matrix(vecs, n.as_py()), k + 1)
                yield _pairs_batch(qheads[i], own[j], score)

    # The windows carry a block's queries only, not the block.
    few = blocks.where("queries > 0").select("grp", "block", "n", "heads", "asked", "vecs").mapInArrow(
        own_queries, "grp int, block int, qheads binary, qvecs binary"
    )
    windows = few.withColumn("block", F.explode(F.sequence(F.greatest(F.lit(0), F.col("block") - width), F.col("block") + width)))
    pairs = windows.join(blocks.select("grp", "block", "n", "heads", "vecs"), ["grp", "block"])
    found = ws.keep(pairs.select("qheads", "qvecs", "n", "heads", "vecs").mapInArrow(search, "q long, c long, score double"), "found")
    return nearest_ids(found, groups, asked, k)

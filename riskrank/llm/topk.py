"""Exact top-k by integer inner product over norm-sorted blocks.

Vectors are range-partitioned by descending length. A block of queries takes a lower bound of each
query's k-th score from the block of the longest vectors; by Cauchy-Schwarz it needs only the blocks whose
longest vector can reach that. Within a pair of blocks, vectors are rotated to the axes of a singular value
decomposition: partial products over the leading axes, and the lengths of the rest as a bound, leave few
products to be computed in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.llm.common import Workspace
from riskrank.llm.vectors import classes, in_blocks, longs, matrix, nearest_ids, top_of, usable

# Vectors (by a hash of the id) that set the rotation; it bears on speed alone.
SAMPLE = 4096
LEADING = 16
QUERY_ROWS = 512
# Products below this are exact in doubles.
EXACT = 2.0**52
SLACK = 1e-9


def rotation(vectors: DataFrame) -> np.ndarray:
    rows = vectors.orderBy(F.xxhash64("head"), "head").limit(SAMPLE).select("vec").collect()
    return np.linalg.svd(np.array([r.vec for r in rows], float), full_matrices=True)[2].T if rows else np.zeros((0, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows with rows."""
    most = np.sqrt((a * a).sum(axis=1).max(initial=0)) * np.sqrt((b * b).sum(axis=1).max(initial=0))
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in a], object) @ np.array([[int(x) for x in r] for r in b], object).T
    return whole.astype(np.int64)  # raises if a score is beyond 64 bits


def candidates(q: np.ndarray, v: np.ndarray, least: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Pairs whose bound reaches the query's ``least``, as a mask."""
    a, b = q @ turn, v @ turn
    rest = [np.sqrt((x[:, LEADING:] ** 2).sum(axis=1)) for x in (a, b)]
    size = np.outer(np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1)))
    bound = a[:, :LEADING] @ b[:, :LEADING].T + np.outer(*rest) + SLACK * size
    return bound >= least[:, None]


def search(q: np.ndarray, v: np.ndarray, heads: np.ndarray, least: np.ndarray, turn: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """(row of the query, row of the vector, score) of the ``keep`` best that reach ``least``; ties by head."""
    hit = candidates(q, v, least, turn)
    if hit.mean() > 0.1:
        scores = products(q, v)
        hit &= top_of(np.where(hit, scores, np.iinfo(np.int64).min), keep)
        i, j = np.nonzero(hit)
        score = scores[i, j]
    else:
        i, j = np.nonzero(hit)
        score = np.empty(len(i), np.int64)
        for begin in range(0, len(i), 1 << 14):
            part = slice(begin, begin + (1 << 14))
            a, b = q[i[part]], v[j[part]]
            if (np.abs(a) * np.abs(b)).sum(axis=1).max() < EXACT:
                score[part] = (a * b).sum(axis=1).astype(np.int64)
            else:
                score[part] = [sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for r, s in zip(a, b, strict=True)]
    order = np.lexsort((heads[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    few = np.arange(len(i)) - np.searchsorted(i, i) < keep
    return i[few], j[few], score[few]


def level(largest: object):
    """Lengths by size class, an eighth of a doubling each; there are few, however many blocks."""
    return F.floor(F.log2(F.greatest(F.lit(1e-300), largest)) * 8).cast("int")


def top_products(
    df: DataFrame, ws: Workspace, *, id: str = "vec_id", vector: str = "embedding", scale: float = 256.0, every: int = 50, k: int = 5
) -> DataFrame:
    """(query_id, rank, vec_id, score long): for ids divisible by ``every``, the ``k`` largest inner products.

    Components x count as floor(scale * x). Null vectors, those with null or non-finite components and those not of the
    commonest length take no part, nor do rows with a null id; an id that repeats stands for the smallest of its vectors.
    Equal scores go by id; a query's own id is no candidate. An empty table gives no rows.
    """
    rows = usable(df, id, vector)
    rows = ws.keep(rows.select("vec_id", F.transform("vec", lambda x: F.floor(x * scale).cast("double")).alias("vec")), "vectors")
    groups = ws.keep(classes(rows, k + 1), "classes")
    asked = ws.keep(rows.where(F.pmod("vec_id", F.lit(every)) == 0), "asked")
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    stacked = groups.select(F.lit(0).alias("grp"), "head", F.lit(False).alias("asked"), "vec", (-length).alias("shorter"))
    stacked = ws.keep(stacked, "lengths")
    blocks = ws.keep(in_blocks(stacked, ["shorter", "head"], ws), "ordered")
    q = stacked.join(asked.select("vec").distinct(), "vec", "left_semi")
    questions = in_blocks(ws.keep(q, "questions"), ["shorter", "head"], ws, QUERY_ROWS)
    seeds = blocks.where("block = 0").select("n", "heads", "vecs").collect()
    turn = rotation(stacked)
    if not seeds:
        turn, longest = np.zeros((0, 0)), np.zeros((0, 0))
    else:
        longest = np.frombuffer(seeds[0].vecs, "<f8").reshape(seeds[0].n, -1)
    levels = {r.level: r.last for r in blocks.groupBy(level(F.col("largest")).alias("level")).agg(F.max("block").alias("last")).collect()}
    held = ws.spark.sparkContext.broadcast((turn, longest, levels))  # one block, a rotation, the size classes

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, seed, classes_ = held.value
        for batch in batches:
            out = ([], [])
            for n, vecs in zip(batch.column(0), batch.column(2), strict=True):
                v = matrix(vecs, n.as_py())
                scores = products(v, seed).astype(float)
                enough = scores.shape[1] > k
                least = np.partition(scores, -(k + 1), axis=1)[:, -(k + 1)] if enough else np.full(len(v), -np.inf)
                size = np.sqrt((v * v).sum(axis=1))
                need = np.where((least > 0) & (size > 0), least / np.maximum(size, 1e-300), 0).min() * (1 - SLACK)
                reach = -np.inf if need <= 0 else np.floor(np.log2(need) * 8) - 1
                out[0].append(max((last for lv, last in classes_.items() if lv >= reach), default=0))
                out[1].append(least.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary())], names=["qn", "qheads", "qvecs", "last", "least"]
            )

    few = questions.select("n", "heads", "vecs").mapInArrow(bounded, "qn int, qheads binary, qvecs binary, last int, least binary")
    pairs = few.withColumn("block", F.explode(F.sequence(F.lit(0), "last"))).join(blocks.select("block", "n", "heads", "vecs"), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotate = held.value[0]
        for batch in batches:
            for qn, qheads, qvecs, least, n, heads, vecs in zip(*batch.columns, strict=True):
                qheads, heads = longs(qheads), longs(heads)
                least = np.frombuffer(least.as_buffer(), "<f8")
                i, j, score = search(matrix(qvecs, qn.as_py()), matrix(vecs, n.as_py()), heads, least, rotate, k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(qheads[i]), pa.array(heads[j]), pa.array(score)], names=["q", "c", "score"])

    found = pairs.select("qn", "qheads", "qvecs", "least", "n", "heads", "vecs").mapInArrow(run, "q long, c long, score long")
    return nearest_ids(ws.keep(found, "found"), groups, asked, k)

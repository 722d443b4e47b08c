"""What the vector searches share: usable vectors, classes of equal ones, and blocks of rows in order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskrank.llm.common import Workspace

BLOCK_ROWS = 2048
BLOCKS = "grp int, part int, no int, n int, queries int, largest double, heads binary, asked binary, vecs binary"


def usable(df: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec_id, vec array<double>): rows with an id and a vector of finite components of the commonest length.

    An id that repeats stands for the smallest of its vectors.
    """
    rows = df.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("vec") > 0) & ~bad)
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    length = common[0].d if common else 0
    return rows.where(F.size("vec") == length).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def classes(vectors: DataFrame, keep: int) -> DataFrame:
    """(vec, head, ids): equal vectors as one row with their ``keep`` smallest ids, the first of them as ``head``.

    The rank limit applies before the shuffle too, so a vector that very many ids share costs little.
    """
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = vectors.withColumn("rank", rank).where(F.col("rank") <= keep)
    grouped = few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.select("vec", F.element_at("ids", 1).alias("head"), "ids")


def in_blocks(rows: DataFrame, by: list[str], ws: Workspace, size: int = BLOCK_ROWS) -> DataFrame:
    """Rows (grp, head, asked, vec and the columns ``by``) in order of grp and ``by``, ``size`` to a block.

    Adds ``block``: the number of the block within its group, in that order.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, no = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def block(table: pa.Table) -> pa.RecordBatch:
            nonlocal no
            vecs = table.column("vec").combine_chunks().flatten().to_numpy().reshape(len(table), -1)
            asked = table.column("asked").to_numpy().astype(np.uint8)
            largest = float(np.sqrt((vecs**2).sum(axis=1).max()))
            values = (table.column("grp")[0].as_py(), part, no, len(table), int(asked.sum()), largest)
            values = (*values, table.column("head").to_numpy().tobytes(), asked.tobytes(), vecs.tobytes())
            no += 1
            types = [pa.int32()] * 5 + [pa.float64()] + [pa.binary()] * 3
            names = [c.strip().split()[0] for c in BLOCKS.split(",")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        for batch in batches:
            grp = batch.column("grp").to_numpy()
            cuts = [0, *(np.flatnonzero(grp[1:] != grp[:-1]) + 1), len(grp)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and held[0].column("grp")[0] != batch.column("grp")[a]:
                    yield block(pa.Table.from_batches(held))
                    held = []
                while a < b:
                    room = size - sum(map(len, held))
                    held.append(batch.slice(a, min(room, b - a)))
                    a += len(held[-1])
                    if len(held[-1]) == room:
                        yield block(pa.Table.from_batches(held))
                        held = []
        if held:
            yield block(pa.Table.from_batches(held))

    ordered = rows.repartitionByRange(parts, "grp", *by).sortWithinPartitions("grp", *by)
    kept = ws.keep(ordered.select("grp", "head", "asked", "vec").mapInArrow(run, BLOCKS), "blocks")
    # One row a block: their numbers are few.
    places = kept.select("grp", "part", "no", (F.row_number().over(Window.partitionBy("grp").orderBy("part", "no")) - 1).alias("block"))
    return kept.join(places, ["grp", "part", "no"]).drop("part", "no")


def matrix(data: pa.Scalar, rows: int) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), "<f8").reshape(rows, -1)


def longs(data: pa.Scalar) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), "<i8")


def nearest_ids(found: DataFrame, groups: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) from (q, c, score) between heads of classes.

    ``groups``: the classes; ``asked``: (vec_id, vec) of the queries. A class stands for its ids, of which the query's
    own does not count; equal scores go by id.
    """
    best = found.groupBy("q", "c").agg(F.max("score").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    best = best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r")
    ids = best.join(groups.select(F.col("head").alias("c"), "ids"), "c").select("q", "score", F.explode("ids").alias("vec_id"))
    few = ids.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    queries = asked.join(groups.select("vec", F.col("head").alias("q")), "vec").select(F.col("vec_id").alias("query_id"), "q")
    pairs = queries.join(few.drop("r"), "q").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_of(scores: np.ndarray, keep: int) -> np.ndarray:
    """Columns of the ``keep`` largest of each row and of all that tie with the last of them, as a mask."""
    if scores.shape[1] <= keep:
        return np.ones(scores.shape, bool)
    # Not by negatives: the smallest integer has none.
    last = np.partition(scores, -keep, axis=1)[:, -keep, None]
    return scores >= last

"""A Merkle manifest of a dataset: ternary hash trees over groups of rows, stored as blocks in van Emde Boas order.

Every group has a tree over its rows in id order, and one more tree stands over the groups. A tree is cut into
aligned blocks of ``LEVELS`` levels; the roots of a level's blocks are the leaves of the next level's, until one is
left. Within a block the nodes lie in van Emde Boas order: the upper half of the levels first, then the subtrees below
it, each laid out in the same way. So the path from a leaf up touches few neighbouring stretches of a block, whatever
the size of a page or cache line, and a proof needs one block a level: its siblings are found by address alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.llm.common import Workspace
from riskrank.operators.ordering import sort_by_key

ARITY = 3
# Levels of a block above its leaves: 729 leaves, 1093 nodes, 35 kB.
LEVELS = 6
DIGEST = 32

BLOCK = "tree long, block long, total long, n int, height int, root binary, nodes binary"
CHECKED = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
    "verified boolean, path binary"
)


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def record_digest(*fields: Column) -> Column:
    """Hex sha256 of a record: each field is ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


# --- van Emde Boas order -----------------------------------------------------------------------


def size_of(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


@lru_cache
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """For each depth from the root on, where its nodes lie, left to right."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    starts = size_of(top) + size_of(levels - top) * np.arange(ARITY**top, dtype=np.int64)
    below = addresses(levels - top)
    return addresses(top) + tuple((starts[:, None] + places).reshape(-1) for places in below)


def grow(leaves: Sequence[str], height: int) -> list[list[str]]:
    """Digests by depth, root first: each run of ``ARITY`` nodes, the last maybe shorter, becomes its digest."""
    rows = [list(leaves)]
    for _ in range(height):
        below = rows[-1]
        rows.append([digest_of("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return rows[::-1]


def store(rows: Sequence[Sequence[str]]) -> bytes:
    """The nodes of a block in van Emde Boas order; places without a node are zero."""
    out = np.zeros((size_of(len(rows)), DIGEST), np.uint8)
    for row, at in zip(rows, addresses(len(rows)), strict=True):
        out[at[: len(row)]] = np.frombuffer(bytes.fromhex("".join(row)), np.uint8).reshape(-1, DIGEST)
    return out.tobytes()


def load(nodes: bytes, n: int, height: int) -> list[list[str]]:
    """The digests of a block by depth, found by address; ``n`` leaves."""
    held = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    rows, counts = [], [n]
    for _ in range(height):
        counts.append(-(-counts[-1] // ARITY))
    for count, at in zip(reversed(counts), addresses(height + 1), strict=True):
        text = held[at[:count]].tobytes().hex()
        rows.append([text[i : i + 2 * DIGEST] for i in range(0, len(text), 2 * DIGEST)])
    return rows


def siblings(rows: Sequence[Sequence[str]]) -> list[list[tuple[str, str]]]:
    """For each depth below the root, the digests left and right of every node in its run."""
    return [
        [
            ("".join(row[i - i % ARITY : i]), "".join(row[i + 1 : i - i % ARITY + ARITY]))
            for i in range(len(row))
        ]
        for row in rows[1:]
    ]


# --- paths -------------------------------------------------------------------------------------


def pack_path(steps: Sequence[tuple[str, str]]) -> bytes:
    """Siblings from a leaf up. A step is a byte, how many to the left and how many in all, and their digests."""
    out = []
    for left, right in steps:
        before, after = len(left) // (2 * DIGEST), len(right) // (2 * DIGEST)
        out.append(bytes([before * ARITY + before + after]) + bytes.fromhex(left + right))
    return b"".join(out)


def unpack_path(path: bytes) -> list[tuple[str, str]]:
    steps, at = [], 0
    while at < len(path):
        before, n = divmod(path[at], ARITY)
        cut, end = at + 1 + before * DIGEST, at + 1 + n * DIGEST
        steps.append((path[at + 1 : cut].hex(), path[cut:end].hex()))
        at = end
    return steps


def fold(leaf: str, steps: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in steps:
        leaf = digest_of(left + leaf + right)
    return leaf


# --- building ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """The blocks of all trees, as kept tables.

    ``levels`` holds the blocks of the groups' trees, lowest level first, and ``top`` those of the tree over the
    groups. ``trees`` has a row a group: grp, first (position of its first row), total (rows) and tree (its number).
    """

    ws: Workspace
    trees: DataFrame | None
    levels: list[DataFrame]
    top: list[DataFrame]
    root: str | None
    block_levels: int = LEVELS


def _blocks(level: DataFrame, block_levels: int, carried: Sequence[str]) -> DataFrame:
    """Blocks of the leaves (tree, pos, total, digest); at most ``ARITY**block_levels`` leaves meet in one row."""
    width = ARITY**block_levels
    grouped = level.groupBy("tree", F.floor(F.col("pos") / width).alias("block")).agg(
        F.first("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("pos", "digest", *carried))).alias("leaves"),
    )
    flat = grouped.select("tree", "block", "total", *[F.col(f"leaves.{c}").alias(c) for c in ("digest", *carried)])
    kept = [pa.field(c, pa.list_({"doc_id": pa.int64(), "claim": pa.binary()}[c])) for c in carried]
    schema = BLOCK + "".join(f", {f.name} array<{'long' if f.name == 'doc_id' else 'binary'}>" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, heights, roots, nodes = [], [], [], []
            for total, leaves in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                height = 0
                # A tree that ends in this block is as high as it needs to be; other blocks have all levels.
                while height < block_levels and (total > width or ARITY**height < total):
                    height += 1
                rows = grow([d.hex() for d in leaves], height)
                n.append(len(leaves))
                heights.append(height)
                roots.append(bytes.fromhex(rows[0][0]))
                nodes.append(store(rows))
            columns = [pa.array(n, pa.int32()), pa.array(heights, pa.int32()), pa.array(roots, pa.binary())]
            columns += [pa.array(nodes, pa.binary()), *(batch.column(4 + i).cast(f.type) for i, f in enumerate(kept))]
            names = [c.strip().split()[0] for c in BLOCK.split(",")] + [f.name for f in kept]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *columns], names=names)

    return flat.mapInArrow(run, schema)


def _stack(
    leaves: DataFrame, largest: int, ws: Workspace, block_levels: int, carried: Sequence[str] = ()
) -> list[DataFrame]:
    """Blocks of ``leaves``, then blocks of their roots and so on; ``largest``: leaves of the largest tree."""
    width, tables, level = ARITY**block_levels, [], leaves
    while True:
        tables.append(ws.keep(_blocks(level, block_levels, () if tables else carried), "blocks"))
        largest = -(-largest // width)
        if largest <= 1:
            return tables
        level = (
            tables[-1]
            .where(F.col("total") > width)
            .select("tree", F.col("block").alias("pos"), F.ceil(F.col("total") / width).alias("total"), F.col("root").alias("digest"))
        )


def _ended(table: DataFrame, block_levels: int) -> DataFrame:
    """The blocks at which a tree ends."""
    return table.where(F.col("total") <= ARITY**block_levels)


def build_manifest(rows: DataFrame, ws: Workspace, *, block_levels: int = LEVELS) -> Manifest:
    """The manifest of ``rows`` (doc_id, grp, leaf: hex digest, claim: hex digest or null).

    Groups are ordered by ``grp``, null first, then by their UTF-8 bytes; the rows of a group by doc_id, null first,
    then by leaf. ``claim`` is a digest that somebody states for the row; it is not part of the tree. Repeated
    rows are leaves each. An empty table has no root.
    """
    rows = ws.keep(rows.select("doc_id", "grp", "leaf", "claim"), "leaves")
    placed = ws.keep(sort_by_key(rows, ["grp", "doc_id", "leaf"]), "placed")
    groups = ws.keep(placed.groupBy("grp").agg(F.min("idx").alias("first"), F.count("*").alias("total")), "groups")
    largest = groups.agg(F.max("total")).first()[0]
    if largest is None:
        return Manifest(ws, None, [], [], None, block_levels)
    numbered = sort_by_key(groups, ["first"]).select("grp", "first", "total", F.col("idx").alias("tree"))
    trees = ws.keep(numbered, "trees")
    leaves = placed.join(trees, placed.grp.eqNullSafe(trees.grp)).select(
        "tree", (F.col("idx") - F.col("first")).alias("pos"), "total", F.unhex("leaf").alias("digest"),
        "doc_id", F.unhex("claim").alias("claim"),
    )
    levels = _stack(leaves, largest, ws, block_levels, ("doc_id", "claim"))
    count = trees.count()
    subroots = None
    for table in levels:
        ended = _ended(table, block_levels).select(
            F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(count).cast("long").alias("total"), F.col("root").alias("digest")
        )
        subroots = ended if subroots is None else subroots.unionByName(ended)
    top = _stack(subroots, count, ws, block_levels)
    return Manifest(ws, trees, levels, top, top[-1].first().root.hex(), block_levels)


# --- proofs ------------------------------------------------------------------------------------


def _expand(blocks: DataFrame, block_levels: int) -> DataFrame:
    """(tree, block, subroot, path) of every leaf of ``blocks``, which have the path and subroot of their own root.

    The leaves of a block are the blocks one level below.
    """
    width = ARITY**block_levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, n, height, nodes, subroot, above in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                steps = siblings(load(nodes, n, height))
                paths = []
                for i in range(n):
                    own = []
                    for row in reversed(steps):
                        own.append(row[i])
                        i //= ARITY
                    paths.append(pack_path(own) + above)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tree] * n, pa.int64()),
                        pa.array(range(block * width, block * width + n), pa.int64()),
                        pa.array([subroot] * n, pa.binary()),
                        pa.array(paths, pa.binary()),
                    ],
                    names=["tree", "block", "subroot", "path"],
                )

    columns = blocks.select("tree", "block", "n", "height", "nodes", "subroot", "path")
    return columns.mapInArrow(run, "tree long, block long, subroot binary, path binary")


def _with_paths(tables: Sequence[DataFrame], entries: DataFrame, block_levels: int) -> DataFrame:
    """The lowest table's blocks with the path and subroot of their root; ``entries`` (tree, subroot, path): a tree's."""
    above = None
    for table in reversed(tables):
        known = _ended(table, block_levels).select("tree", "block").join(entries, "tree").select("tree", "block", "subroot", "path")
        if above is not None:
            known = known.unionByName(_expand(above, block_levels))
        above = table.join(known, ["tree", "block"])
    return above


def check_claims(manifest: Manifest, *, with_path: bool = True) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified and path.

    ``path`` holds the siblings from the leaf to the root over all groups (see ``pack_path``), ``proof_sha256`` the
    digest of their hex digests end to end. ``folded_root`` is worked out from the claim (without one, the leaf) and the
    siblings; ``verified`` says whether it is the root. Blocks go down the levels with the path of their
    root, so that every block is read once, however many leaves it has.
    """
    spark = manifest.ws.spark
    if manifest.root is None:
        return spark.createDataFrame([], CHECKED)
    tall = manifest.block_levels
    start = spark.createDataFrame([(0, b"", b"")], "tree long, subroot binary, path binary")
    heads = _with_paths(manifest.top, start, tall)
    # A group's tree is a leaf of the tree over the groups: its number is the place there.
    places = _expand(heads, tall).select(F.col("block").alias("tree"), "path")
    ends = None
    for table in manifest.levels:
        ended = _ended(table, tall).select("tree", F.col("root").alias("subroot"))
        ends = ended if ends is None else ends.unionByName(ended)
    entries = manifest.ws.keep(places.join(ends, "tree").select("tree", "subroot", "path"), "entries")
    blocks = _with_paths(manifest.levels, entries, tall)
    root = manifest.root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, height, nodes, ids, claims, subroot, above in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = load(nodes, n, height)
                steps, upper = siblings(rows), unpack_path(above)
                tail = "".join(left + right for left, right in upper)
                # Hex digests of all siblings from a node up, by depth from the root on.
                texts = [[tail]]
                for row in steps:
                    texts.append([left + right + texts[-1][i // ARITY] for i, (left, right) in enumerate(row)])
                folded, paths = [], []
                for i in range(n):
                    own, at = [], i
                    for row in reversed(steps):
                        own.append(row[at])
                        at //= ARITY
                    claim = rows[-1][i] if claims[i] is None else claims[i].hex()
                    folded.append(fold(fold(claim, own), upper))
                    paths.append(pack_path(own) + above if with_path else None)
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array(rows[-1], pa.string()),
                    pa.array([subroot.hex()] * n, pa.string()),
                    pa.array([root] * n, pa.string()),
                    pa.array([digest_of(t) for t in texts[-1]], pa.string()),
                    pa.array(folded, pa.string()),
                    pa.array([f == root for f in folded], pa.bool_()),
                    pa.array(paths, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.strip().split()[0] for c in CHECKED.split(",")])

    columns = blocks.select("n", "height", "nodes", "doc_id", "claim", "subroot", "path")
    return columns.mapInArrow(run, CHECKED)


def document_manifest(
    docs: DataFrame,
    ws: Workspace,
    *,
    id: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    claimed: dict[str, Column] | None = None,
    block_levels: int = LEVELS,
) -> Manifest:
    """The manifest of a table: a leaf a row, of ``fields`` in their order; a tree a ``group``.

    ``claimed`` names fields that somebody holds in another version; the rows where that version differs get its
    digest as their claim. Nulls count in fields, groups and ids; other columns are ignored.
    """
    own = [F.col(f) for f in fields]
    claim = F.lit(None).cast("string")
    if claimed:
        other = [claimed.get(f, F.col(f)) for f in fields]
        same = F.lit(True)
        for f, c in claimed.items():
            same = same & F.col(f).eqNullSafe(c)
        claim = F.when(~same, record_digest(*other))
    rows = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.col(group).cast("string").alias("grp"), record_digest(*own).alias("leaf"), claim.alias("claim")
    )
    return build_manifest(rows, ws, block_levels=block_levels)

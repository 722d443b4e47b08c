"""Fitted trees as tables and as expressions.

A saved model holds its nodes as rows, which is where the node table comes from. As nested conditions over the
raw columns, all trees of an ensemble are one projection: no index columns, no feature vectors, and nothing but built-in
expressions in the plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.sources.workspace import Workspace

_WALK = """
    with recursive edges as (
        select tree, node, left as child, 'left' as side from {nodes} where left is not null
        union all
        select tree, node, right as child, 'right' as side from {nodes} where right is not null
    ), walk(tree, node, parent, depth, side) as (
        select tree, node, cast(null as int), 0, cast(null as string) from {nodes} where node = 0
        union all
        select e.tree, e.child, w.node, w.depth + 1, e.side
        from walk w join edges e on e.tree = w.tree and e.node = w.node
    )
    select w.tree, w.node, w.parent, w.depth, w.side, n.feature, n.threshold, n.categories, n.rows, n.impurity, n.gain,
           n.prediction, n.stats
    from walk w join {nodes} n on n.tree = w.tree and n.node = w.node
"""


def node_table(model, workspace: Workspace) -> DataFrame:
    """The nodes of a fitted tree or ensemble, read back from the model as Spark saves it.

    Columns: tree, node (0 is the root), left and right (child nodes, null at a leaf), feature (its place in the
    vector), threshold (of a number) or categories (indexes that go left), rows, impurity, gain, prediction and
    stats (weights by class, or count, sum and sum of squares). A number up to the threshold goes left.
    """
    path = workspace.path("model")
    model.write().save(path)
    data = workspace.spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.select(F.lit(0).alias("tree"), "*")
    inner = F.col("leftChild") >= 0
    values, kinds = F.col("split.leftCategoriesOrThreshold"), F.col("split.numCategories")
    return data.select(
        "tree",
        F.col("id").alias("node"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & (kinds < 0), F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & (kinds >= 0), values).alias("categories"),
        F.col("rawCount").cast("bigint").alias("rows"),
        "impurity",
        F.when(inner, F.col("gain")).alias("gain"),
        "prediction",
        F.col("impurityStats").alias("stats"),
    )


def tree_nodes(model, workspace: Workspace) -> DataFrame:
    """The node table walked from the roots: adds parent, depth and side (left or right of the parent)."""
    nodes = workspace.keep(node_table(model, workspace), "nodes")
    view = f"nodes_{uuid.uuid4().hex}"
    nodes.createOrReplaceTempView(view)
    try:
        return workspace.spark.sql(_WALK.format(nodes=view))
    finally:
        workspace.spark.catalog.dropTempView(view)


@dataclass(frozen=True)
class Input:
    """What a place in the feature vector stands for: a number, or the index of a category's level.

    ``labels`` are the levels in index order; a level that is not there counts as the first one.
    """

    column: str
    labels: tuple[str, ...] | None = None


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def goes_left(split: Input, threshold: float | None, categories: Sequence[float] | None) -> str:
    """The condition of a node as SQL, over the raw column."""
    if split.labels is None:
        return f"cast({_name(split.column)} as double) <= {threshold!r}D"
    if categories is None:
        left = {i for i in range(len(split.labels)) if i <= threshold}
    else:
        left = {int(i) for i in categories}
    # A level that is not known goes where the first one goes, so the other side is listed.
    listed = [_text(v) for i, v in enumerate(split.labels) if (i in left) != (0 in left)]
    value = f"coalesce(cast({_name(split.column)} as string), {_text(split.labels[0])})"
    inside = f"{value} in ({', '.join(listed)})" if listed else "false"
    return f"not ({inside})" if 0 in left else inside


def compile_trees(nodes: DataFrame, inputs: Sequence[Input], leaf) -> list[Column]:
    """An expression for each tree: nested conditions down to ``leaf(row)`` of the leaf that a row falls into.

    The nodes of a model are few and live on the driver already, where it was fitted.
    """
    trees: dict[int, dict] = {}
    for r in nodes.collect():
        trees.setdefault(r.tree, {})[r.node] = r

    def sql(tree: dict, node: int) -> str:
        r = tree[node]
        if r.left is None:
            return f"{float(leaf(r))!r}D"
        condition = goes_left(inputs[r.feature], r.threshold, r.categories)
        return f"if({condition}, {sql(tree, r.left)}, {sql(tree, r.right)})"

    return [F.expr(sql(trees[t], 0)) for t in sorted(trees)]


def share_of_ones(node) -> float:
    """The share of label 1 among the training rows of a node."""
    return node.stats[1] / sum(node.stats)

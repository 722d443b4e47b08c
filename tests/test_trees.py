"""Trees as tables and as expressions against Spark's own scores."""

import pytest
from pyspark.sql import functions as F

from riskrank.operators.trees import Input, goes_left
from riskrank.plans import fit_risk_model
from riskrank.sources import Roles, Workspace

ROLES = Roles(target="bad", positive=1, id="id", categorical=["kind", "odd'name"], continuous=["x", "y"])


@pytest.fixture(scope="module")
def table(spark):
    h = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000))
    df = spark.range(6000).select(
        "id",
        ((h(1) + F.pmod(F.hash("id"), F.lit(6)) * 80) > 700).cast("int").alias("bad"),
        F.when(h(7) > 30, F.concat(F.lit("k'\\"), F.pmod(F.hash("id"), F.lit(6)))).alias("kind"),
        (h(2) % 7).cast("int").alias("odd'name"),
        F.when(h(8) > 50, h(3).cast("double")).alias("x"),
        (h(1) / 3 + h(4)).alias("y"),
    )
    return Workspace(spark).keep(df, "table")


@pytest.mark.parametrize("kind,options", [("tree", {"maxDepth": 6}), ("forest", {"maxDepth": 5}), ("boosted", {"maxIter": 5}), ("forest", {"numTrees": 3, "numeric": ("kind",)})])
def test_compiled_scores(spark, table, kind, options):
    """66 trees too; nulls, quotes and levels that training lacks included."""
    train = table.where("id % 3 > 0").where(F.col("kind").isNull() | ~F.endswith("kind", F.lit("5")))
    model = fit_risk_model(train, ROLES, kind, partitions=4, **options)
    own = model.score(table).alias("a")
    both = own.join(model.compiled_score(table).alias("b"), "id")
    wrong = (F.abs(F.col("a.score") - F.col("b.score")) > 1e-12) | (F.col("a.label") != F.col("b.label"))
    # A score on the border of the classes may be rounded to either side.
    wrong = wrong | ((F.col("a.prediction") != F.col("b.prediction")) & (F.abs(F.col("a.score") - 0.5) > 1e-12))
    assert both.count() == 6000 and both.where(wrong).count() == 0
    plan = model.compiled_score(table)._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Python" not in plan


def test_nodes_of_a_forest(spark, table):
    model = fit_risk_model(table, ROLES, "forest", partitions=4, numTrees=7, maxDepth=3)
    nodes = model.nodes().collect()
    trees = {r.tree: r for r in model.summary().collect()}
    assert {t: sum(n.tree == t for n in nodes) for t in trees} == {t: r.num_nodes for t, r in trees.items()}
    assert {t: max(n.depth for n in nodes if n.tree == t) for t in trees} == {t: r.depth for t, r in trees.items()}
    at = {(n.tree, n.node): n for n in nodes}
    for n in nodes:
        assert (n.parent is None) == (n.node == 0) == (n.depth == 0)
        inside = [c for c in nodes if c.tree == n.tree and c.parent == n.node]
        assert sorted(c.side for c in inside) in ([], ["left", "right"])
        if inside:
            assert sum(c.rows for c in inside) == n.rows and n.gain > 0 and n.feature in ("kind", "odd'name", "x", "y")
            assert (n.levels is None) == (n.threshold is not None)
            assert all(c.depth == at[c.tree, c.parent].depth + 1 for c in inside)
        else:
            assert n.feature is None and n.gain is None
    assert any(n.levels and all(v.startswith("k'") or v == "missing" for v in n.levels) for n in nodes if n.feature == "kind")


def test_conditions(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("new",), (None,)], "`q``x` string")
    split = Input("q`x", ("a", "b", "c"))
    for categories, left in (([0.0], "aNn"), ([1.0, 2.0], "bc"), ([0.0, 1.0, 2.0], "abcNn"), ([], "")):
        got = df.select("*", F.expr(goes_left(split, None, categories)).alias("l")).collect()
        assert {(r[0] or "N")[0] for r in got if r.l} == set(left)
    got = df.select(F.expr(goes_left(split, 1.0, None)).alias("l")).collect()
    assert [r.l for r in got] == [True, True, False, True, True]


def test_models_that_cannot_be_compiled(table):
    with pytest.raises(ValueError, match="compiled"):
        fit_risk_model(table, ROLES, "network", maxIter=2).compiled_score(table)
    with pytest.raises(ValueError, match="compiled"):
        fit_risk_model(table, ROLES, "tree", encode="onehot").compiled_score(table)

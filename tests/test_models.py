"""Fitted flows on the literal tables: shapes, ranges and identities, never exact quality."""

from functools import partial

import pytest
from pyspark.sql import functions as F

from riskrank.__main__ import arguments, run
from riskrank.functions import vector_element
from riskrank.operators import auc_roc, ensemble_score, error_rate, score_label_pair, tdr_at
from riskrank.operators.levels import fit_levels
from riskrank.operators.models import classifier, ensemble_raw, per_tree_score
from riskrank.plans import scoring
from riskrank.plans import fit_risk_model, fit_score_rank, ranking_report
from riskrank.sources import Roles, Workspace
from tests.fixture_rows import COLUMNS, HOLDOUT, TRAIN, frame

ROLES = Roles(target="LEFT", id="id", categorical=["CONTRACT", "PLAN"], positive=1.0)
BY_FREQUENCY = Roles(target="LEFT", id="id", categorical=["CONTRACT", "PLAN", "LEFT"])


@pytest.fixture(scope="module")
def splits(spark):
    return frame(spark, TRAIN), frame(spark, HOLDOUT)


@pytest.mark.parametrize(
    "model,options",
    [
        ("forest", {}),
        ("boosted", {}),
        ("tree", {}),
        ("network", {}),
        ("network", {"encode": "onehot"}),
        ("network", {"encode": "onehot", "scale": True}),
    ],
)
def test_flow(splits, model, options):
    train, holdout = splits
    workspace = Workspace(train.sparkSession)
    report = fit_score_rank(train, holdout, ROLES, model, workspace=workspace, **options)
    scored = report.scored.collect()
    assert sorted(r.id for r in scored) == list(range(len(HOLDOUT)))
    assert all(0.0 <= r.score <= 1.0 and r.prediction in (0, 1) for r in scored)
    assert sum(r.label for r in scored) == sum(r[0] for r in HOLDOUT)
    rates = report.rates.collect()
    assert len(rates) == 7 and all(0.0 <= r.rate <= 1.0 for r in rates)
    assert report.gains.count() == len(HOLDOUT)
    assert 0.0 <= report.auc.head().auc <= 1.0
    assert 0.0 <= report.error.head().error_rate <= 1.0
    workspace.clear()


def test_positive_level_defaults_to_the_rarer_one(splits):
    train, holdout = splits
    a = fit_risk_model(train, ROLES, "tree")
    b = fit_risk_model(train, BY_FREQUENCY, "tree")
    assert b.positive == "1.0"
    assert a.inputs == b.inputs == ("MONTHS", "OVERDUE", "PLAN_index", "CONTRACT_index")
    assert sorted(map(tuple, a.score(holdout).collect())) == sorted(map(tuple, b.score(holdout).collect()))


def test_network_layers(splits):
    train, _ = splits
    assert fit_risk_model(train, ROLES, "network", maxIter=1).classifier.getLayers() == [4, 3, 2]
    assert fit_risk_model(train, ROLES, "network", encode="onehot", maxIter=1).classifier.getLayers() == [7, 3, 2]


def test_model_settings():
    forest = classifier("forest")
    assert (forest.getNumTrees(), forest.getImpurity(), forest.getSeed()) == (66, "gini", 1234)
    assert classifier("boosted").getMaxIter() == 3
    assert classifier("forest", numTrees=3).getNumTrees() == 3
    assert classifier("network", width=4).getBlockSize() == 128
    assert classifier("network", width=7, encode="onehot").getBlockSize() == 200
    with pytest.raises(ValueError, match="unknown model"):
        classifier("linear")


def test_boosted_score_is_the_weighted_sum_of_trees(splits):
    train, holdout = splits
    model = fit_risk_model(train, ROLES, "boosted")
    ready = model.prepare(holdout)
    trees = per_tree_score(model.classifier, ready).withColumn("raw", ensemble_raw(model.classifier))
    trees = trees.select("id", "raw")
    whole = model.classifier.transform(ready).select("id", vector_element("rawPrediction", 1).alias("margin"))
    assert trees.join(whole, "id").where(F.col("raw") != F.col("margin")).count() == 0
    assert model.classifier.treeWeights == [1.0, 0.1, 0.1]

    slow = ensemble_score(model.classifier, ready, keep_trees=True).select("id", "score")
    fast = model.score(holdout).select("id", F.col("score").alias("fast"))
    assert slow.join(fast, "id").where(F.col("score") == F.col("fast")).count() == len(HOLDOUT)


def test_boosted_training_frame_can_be_ranked(splits):
    train, _ = splits
    report = ranking_report(fit_risk_model(train, ROLES, "boosted").score(train))
    assert report.auc.head().auc > 0.9


def test_score_label_pair_and_metrics(splits):
    train, holdout = splits
    model = fit_risk_model(train, ROLES, "forest")
    predicted = model.predict(holdout).withColumn("label", model.label())
    pairs = score_label_pair(predicted, "label", "id")
    assert pairs.columns == ["id", "score", "label"]
    assert auc_roc(pairs).head().auc > 0.8
    assert tdr_at(pairs).count() == 7
    assert error_rate(predicted).head().error_rate <= 0.3


def test_tree_summary(splits):
    train, _ = splits
    forest = fit_risk_model(train, ROLES, "forest")
    rows = forest.summary().collect()
    assert len(rows) == 66
    assert all(r.weight == 1.0 and r.depth <= 5 and r.num_nodes >= 1 for r in rows)
    assert all("Predict" in r.rules for r in rows)
    boosted = fit_risk_model(train, ROLES, "boosted").summary().collect()
    assert [r.weight for r in boosted] == [1.0, 0.1, 0.1]
    assert fit_risk_model(train, ROLES, "tree").summary().count() == 1


def test_bad_targets(spark, splits):
    train, _ = splits
    three = train.withColumn("LEFT", F.col("id") % 3)
    with pytest.raises(ValueError, match="needs 2"):
        fit_risk_model(three, BY_FREQUENCY, "tree")
    holes = train.withColumn("LEFT", F.when(F.col("id") > 3, F.col("LEFT")))
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        fit_risk_model(holes, ROLES, "tree")


def test_more_levels_than_default_bins(spark):
    rows = [(i, float(i % 2), f"level-{i % 40}") for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, LEFT double, kind string")
    roles = Roles(target="LEFT", id="id", categorical=["kind"], positive=1.0)
    scored = fit_risk_model(df, roles, "tree").score(df).collect()
    assert all(r.prediction == r.label for r in scored)


@pytest.mark.parametrize("encode", ["index", "onehot"])
def test_wide_column_as_feature(spark, monkeypatch, encode):
    """A column with too many levels for the driver still trains and scores."""
    rows = [(i, float(i % 2), f"u{i % 50:02d}", "ab"[i % 3 % 2]) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, LEFT double, user string, kind string")
    roles = Roles(target="LEFT", id="id", categorical=["user", "kind"], positive=1.0)
    narrow = fit_risk_model(df, roles, "network", encode=encode, maxIter=5)
    monkeypatch.setattr(scoring, "fit_levels", partial(fit_levels, max_local=10, broadcast_levels=7, num_buckets=3))
    wide = fit_risk_model(df, roles, "network", encode=encode, maxIter=5)
    assert wide.levels.is_wide("user") and not wide.levels.is_wide("kind")
    assert wide.classifier.getLayers() == narrow.classifier.getLayers()
    assert wide.score(df).count() == 400
    unseen = df.limit(3).withColumn("user", F.lit("nobody"))
    assert wide.score(unseen).count() == 3


def test_command_line(spark, tmp_path, capsys):
    for name, rows in (("train.csv", TRAIN), ("holdout.csv", HOLDOUT)):
        lines = [",".join("" if v is None else str(v) for v in r) for r in rows]
        (tmp_path / name).write_text("\n".join([",".join(COLUMNS), *lines]) + "\n")
    (tmp_path / "cat.list").write_text("CONTRACT\nPLAN\nLEFT\n")
    common = ["--train", str(tmp_path / "train.csv"), "--holdout", str(tmp_path / "holdout.csv")]
    common += ["--categorical", str(tmp_path / "cat.list"), "--target", "LEFT"]
    run(spark, arguments([*common, "--model", "forest", "--trees"]))
    out = capsys.readouterr().out
    assert "features: MONTHS, OVERDUE, PLAN_index, CONTRACT_index" in out
    assert "0.0025" in out and "error_rate" in out and "num_nodes" in out
    run(spark, arguments([*common, "--model", "boosted", "--rank", "train", "--positive", "1.0"]))
    assert "auc" in capsys.readouterr().out

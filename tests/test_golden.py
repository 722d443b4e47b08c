"""Small literal tables with results worked out beforehand."""

import pytest
from pyspark.sql import functions as F

from riskrank.functions import label_of, logistic, row_sum, to_dense, weighted_row_sum
from riskrank.operators import (
    CUTOFFS,
    assemble,
    auc_roc,
    columns_by_role,
    feature_columns,
    fill_missing,
    fit_levels,
    gains_table,
    index_apply,
    one_hot,
    onehot_feature_columns,
    sort_by_key,
    tdr_at,
    unseen_to_mode,
)
from riskrank.sources import Roles, Workspace, inline_rows, read_csv, read_names, read_roles
from tests.fixture_rows import COLUMNS, HOLDOUT, SCHEMA, SUM_COLUMNS, SUM_ROWS, SUMS, TRAIN, frame

ROLES = Roles(target="LEFT", id="id", categorical=["CONTRACT", "PLAN", "LEFT"])


@pytest.fixture(scope="module")
def train(spark):
    return fill_missing(frame(spark, TRAIN))


@pytest.fixture(scope="module")
def levels(train):
    return fit_levels(train, ["PLAN", "CONTRACT", "LEFT"])


def test_fills(spark):
    rows = {r.id: r for r in fill_missing(frame(spark, TRAIN)).collect()}
    assert rows[7].CONTRACT == "missing"
    assert rows[10].PLAN == "missing"
    assert rows[6].MONTHS == -1.0


def test_fill_covers_nan_and_ints_but_not_booleans(spark):
    df = spark.createDataFrame([(float("nan"), None, None, None)], "d double, i int, b boolean, s string")
    row = fill_missing(df).head()
    assert (row.d, row.i, row.b, row.s) == (-1.0, -1, None, "missing")
    kept = fill_missing(df, exclude=["i", "s"]).head()
    assert (kept.d, kept.i, kept.s) == (-1.0, None, None)


def test_level_orders(levels):
    assert levels.labels["LEFT"] == ["0.0", "1.0"]
    assert levels.labels["PLAN"] == ["basic", "family", "student", "missing"]
    assert levels.labels["CONTRACT"] == ["monthly", "yearly", "missing"]


def test_level_ties_are_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "x string")
    assert fit_levels(df, ["x"]).labels["x"] == ["c", "a", "b"]


def test_roles(train):
    assert ROLES.categorical == ("CONTRACT", "PLAN")
    assert columns_by_role(train, ROLES.categorical) == ["PLAN", "CONTRACT"]


def test_feature_order_and_widths(train, levels):
    indexed = index_apply(train, levels, ["PLAN", "CONTRACT"])
    inputs = feature_columns(indexed, ROLES)
    assert inputs == ["MONTHS", "OVERDUE", "PLAN_index", "CONTRACT_index"]
    assert assemble(indexed, inputs).head().features.size == 4

    encoded = one_hot(indexed, ["PLAN", "CONTRACT"])
    row = encoded.orderBy("id").head()
    assert (row.PLAN_onehot.size, row.CONTRACT_onehot.size) == (3, 2)
    vector_inputs = onehot_feature_columns(encoded, ROLES)
    assert vector_inputs == ["CONTRACT_onehot", "PLAN_onehot", "MONTHS", "OVERDUE"]
    first = assemble(encoded, vector_inputs).orderBy("id").head().features
    assert list(first.toArray()) == [0.0, 1.0, 1.0, 0.0, 0.0, 24.5, 12.0]
    dense = encoded.select(to_dense("PLAN_onehot").alias("v")).head().v
    assert type(dense).__name__ == "DenseVector"


def test_unseen_level_becomes_the_mode(spark, levels):
    holdout = fill_missing(frame(spark, HOLDOUT))
    rows = {r.id: r for r in unseen_to_mode(holdout, levels, ["PLAN", "CONTRACT"]).collect()}
    assert rows[14].PLAN == "basic"
    assert rows[10].PLAN == "student"
    assert rows[2].PLAN == "family"
    assert isinstance(rows[0].LEFT, float)


def test_remapped_target_becomes_a_string(spark, levels):
    df = spark.createDataFrame([(0.0,), (1.0,), (7.0,), (None,)], "LEFT double")
    mapped = unseen_to_mode(df, levels, ["LEFT"])
    assert dict(mapped.dtypes)["LEFT"] == "string"
    assert [r.LEFT for r in mapped.collect()] == ["0.0", "1.0", "0.0", "0.0"]


def test_index_apply_rejects_unknown_levels(spark, levels):
    df = spark.createDataFrame([("senior",)], "PLAN string")
    with pytest.raises(Exception, match="(?i)unseen|senior"):
        index_apply(df, levels, ["PLAN"]).collect()


def test_row_sums(spark):
    df = inline_rows(spark, SUM_ROWS, SUM_COLUMNS)
    assert {r.SHOP: r.sums for r in row_sum(df, SUM_COLUMNS[1:]).collect()} == SUMS


def test_row_sum_null_and_int_overflow(spark):
    df = spark.createDataFrame([(1, None), (2**31 - 1, 2**31 - 1)], "a int, b int")
    assert [r.sums for r in row_sum(df, ["a", "b"]).collect()] == [None, 2**32 - 2]


def test_weighted_sum_and_logistic(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    row = df.select(weighted_row_sum({"a": 1.0, "b": 0.1}).alias("raw")).withColumn("p", logistic("raw")).head()
    assert row.raw == pytest.approx(1.2)
    assert row.p == pytest.approx(0.7685247834990175)


@pytest.mark.parametrize("num_buckets", [None, 1, 2, 5, 64])
def test_detection_rates(spark, num_buckets):
    scored = frame(spark, HOLDOUT).withColumn("label", label_of("LEFT", 1.0))
    got = {r.cutoff: r for r in tdr_at(scored, "MONTHS", num_buckets=num_buckets).collect()}
    assert [got[p].idx for p in CUTOFFS] == [0, 0, 0, 0, 2, 3, 9]
    assert [round(got[p].rate, 6) for p in CUTOFFS] == [0.0, 0.0, 0.0, 0.0, 0.2, 0.2, 0.8]


@pytest.mark.parametrize("num_buckets", [None, 2, 5, 64])
def test_area_under_curve(spark, num_buckets):
    scored = frame(spark, HOLDOUT).withColumn("label", label_of("LEFT", 1.0))
    assert auc_roc(scored, "MONTHS", num_buckets=num_buckets).head().auc == pytest.approx(0.609091, abs=1e-6)


def test_gains_columns(spark):
    rows = [(10, 0.9, 1), (11, 0.9, 0), (12, 0.5, 1), (13, 0.1, 0)]
    df = spark.createDataFrame(rows, "id int, score double, label int")
    got = [tuple(r) for r in gains_table(df, bad_weight=2, good_weight=3).orderBy("idx").collect()]
    assert got == [
        (10, 0.9, 1, 0, 2, 2, 1, 1, 0.2),
        (11, 0.9, 0, 1, 3, 5, 1, 4, 0.5),
        (12, 0.5, 1, 2, 2, 7, 2, 5, 0.7),
        (13, 0.1, 0, 3, 3, 10, 2, 8, 1.0),
    ]


def test_sorting_numbers(spark):
    df = spark.createDataFrame([(x,) for x in (37, -5, 12, 90, 0, 12, 41, -63)], "x int")
    rows = sort_by_key(df, ["x"], num_buckets=3).orderBy("idx").collect()
    assert [r.x for r in rows] == [-63, -5, 0, 12, 12, 37, 41, 90]
    assert [r.idx for r in rows] == list(range(8))


def _write(path, header, rows):
    lines = [",".join("" if v is None else str(v) for v in r) for r in rows]
    path.write_text("\n".join([",".join(header), *lines]) + "\n")
    return str(path)


def test_csv_and_roles(spark, tmp_path):
    csv = _write(tmp_path / "train.csv", COLUMNS, TRAIN)
    df = read_csv(spark, csv)
    assert dict(df.dtypes) == {
        "LEFT": "double",
        "MONTHS": "double",
        "PLAN": "string",
        "OVERDUE": "double",
        "CONTRACT": "string",
    }
    assert {tuple(r) for r in df.collect()} == set(TRAIN)
    again = read_csv(spark, csv, schema=SCHEMA)
    assert again.schema == df.schema and again.count() == len(TRAIN)

    (tmp_path / "cat.list").write_text("CONTRACT\nPLAN\nLEFT\n\n")
    (tmp_path / "target.list").write_text("LEFT\n")
    assert read_names(spark, str(tmp_path / "cat.list")) == ["CONTRACT", "PLAN", "LEFT"]
    roles = read_roles(spark, str(tmp_path / "cat.list"), id="id", target=str(tmp_path / "target.list"))
    assert (roles.target, roles.categorical) == ("LEFT", ("CONTRACT", "PLAN"))
    with pytest.raises(ValueError, match="exactly one"):
        read_roles(spark, str(tmp_path / "cat.list"), id="id")


def test_workspace_keeps_and_clears(spark):
    workspace = Workspace(spark)
    kept = workspace.with_row_id(frame(spark, TRAIN).drop("id"), "id")
    assert sorted(r.id for r in kept.select("id").collect()) == list(range(len(TRAIN)))
    assert workspace.keep(kept.where(F.col("id") < 5)).count() == 5
    workspace.clear()
    with pytest.raises(Exception):
        kept.count()

"""Nothing depends on the number of cores, on other columns' width, or on values that a cast would change."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from riskrank.operators import error_rate, fit_levels, index_apply, score_rank, unseen_to_mode
from riskrank.plans import fit_risk_model
from riskrank.plans.scoring import _deal_blocks, even_block
from riskrank.sources import Roles, Workspace

ROLES = Roles(target="bad", positive=1, id="id", categorical=["kind", "flag"], continuous=["x", "y"])


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(4000).select(
        "id",
        (F.pmod(F.xxhash64("id"), F.lit(5)) == 0).cast("int").alias("bad"),
        F.concat(F.lit("k"), F.pmod(F.hash("id"), F.lit(6))).alias("kind"),
        (F.pmod(F.hash("id", F.lit(2)), F.lit(3)) == 0).alias("flag"),
        F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1000)).cast("double").alias("x"),
        F.pmod(F.xxhash64("id", F.lit(4)), F.lit(997)).cast("double").alias("y"),
    )
    return Workspace(spark).keep(df, "table")


@pytest.mark.parametrize("kind", ["tree", "forest", "boosted"])
def test_fits_follow_from_data_and_seed(table, kind):
    options = {"numTrees": 8} if kind == "forest" else {}
    scores = []
    for n in (1, 3, 7):
        model = fit_risk_model(table.repartition(n, "x"), ROLES, kind, partitions=4, **options)
        scores.append(sorted(map(tuple, model.score(table).collect())))
    assert scores[0] == scores[1] == scores[2]


@pytest.mark.parametrize("kind", ["tree", "forest", "boosted", "network"])
def test_no_task_learns_from_all_rows_of_a_larger_table(table, monkeypatch, kind):
    """Rows are dealt to as many partitions as their number asks for, and every row to one; a small table to as many as named."""
    seen = []
    fit = Pipeline.fit

    def spied(self, training):
        seen.append([r["count"] for r in training.groupBy(F.spark_partition_id()).count().collect()])
        return fit(self, training)

    monkeypatch.setattr(Pipeline, "fit", spied)
    options = {"forest": {"numTrees": 3}, "network": {"maxIter": 2}}.get(kind, {})
    fit_risk_model(table, ROLES, kind, partitions=4, rows_per_partition=250, **options)
    fit_risk_model(table, ROLES, kind, partitions=4, **options)
    assert [len(s) for s in seen] == [16, 4] and [sum(s) for s in seen] == [4000, 4000]
    assert max(seen[0]) < 2 * 250


def test_even_blocks_weigh_rows_alike(spark, table, monkeypatch):
    """A network's blocks have one size, whatever the number of rows, and no row is lost, null and repeated ids included."""
    seen = []
    fit = Pipeline.fit

    def spied(self, training):
        sizes = [r["count"] for r in training.groupBy(F.spark_partition_id()).count().collect()]
        seen.append((self.getStages()[-1].getBlockSize(), sizes))
        return fit(self, training)

    monkeypatch.setattr(Pipeline, "fit", spied)
    odd = table.withColumn("id", F.when(F.col("id") % 3 > 0, F.col("id") % 500))
    for rows, partitions, block in ((table, 4, 125), (odd, 3, 125), (table.where("id < 3989"), 4, 1)):
        fit_risk_model(rows, ROLES, "network", partitions=partitions, even_blocks=128, maxIter=2)
        found, sizes = seen.pop()
        assert found == block and sum(sizes) == rows.count() and all(n % block == 0 for n in sizes)
    for options in ({"partitions": 4, "blockSize": 2}, {}):
        with pytest.raises(ValueError, match="even_blocks"):
            fit_risk_model(table, ROLES, "network", even_blocks=128, **options)


def test_left_over_rows_share_one_block(spark):
    rows = spark.range(1003).select(F.col("id").alias("__order"), (F.col("id") * 2).alias("x"))
    dealt = _deal_blocks(rows, 4, 32).withColumn("part", F.spark_partition_id()).collect()
    assert sorted(r.x for r in dealt) == list(range(0, 2006, 2))
    sizes = {p: sum(r.part == p for r in dealt) for p in {r.part for r in dealt}}
    assert sorted(n % 32 for n in sizes.values()) == [0, 0, 0, 0, 1003 % 32]
    assert [even_block(n, 128) for n in (0, 1, 7, 101, 127 * 131, 128 * 10**9 - 5)] == [128, 1, 7, 101, 127, 128]
    assert all(-n % even_block(n, 128) <= 1e-6 * n for n in range(10**7, 10**7 + 50)) and even_block(10**7 + 19, 128) > 16


def test_dealing_to_more_partitions_follows_from_the_data(table):
    scores = []
    for n in (1, 5):
        model = fit_risk_model(table.repartition(n, "x"), ROLES, "forest", partitions=2, rows_per_partition=300, numTrees=5)
        scores.append(sorted(map(tuple, model.score(table).collect())))
    assert scores[0] == scores[1]


def test_too_many_levels_are_refused_unless_numeric(table):
    with pytest.raises(ValueError, match="kind has 6 levels"):
        fit_risk_model(table, ROLES, "tree", max_levels=5)
    model = fit_risk_model(table, ROLES, "tree", max_levels=5, numeric=("kind",))
    assert model.score(table).count() == table.count()


def test_width_of_one_column_is_no_matter_for_another(table):
    for columns in (["kind"], ["kind", "x"], ["kind", "x", "y"]):
        levels = fit_levels(table, columns, max_local=10)
        assert not levels.is_wide("kind") and all(levels.is_wide(c) for c in columns[1:])


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_wide_columns_read_the_source_once(spark, table):
    wide = table.select("id", *(F.col("x").cast("string").alias(f"w{i}") for i in range(3)))
    levels = fit_levels(wide, ["w0", "w1", "w2"], max_local=5, broadcast_levels=20, num_buckets=3)
    seen = []
    for n in (1, 2, 3):
        columns = [f"w{i}" for i in range(n)]
        out = index_apply(unseen_to_mode(wide, levels, columns), levels, columns)
        assert out.count() == 4000
        seen.append(scans(out))
    assert seen[2] - seen[1] == seen[1] - seen[0]


def test_unknown_and_null_levels_of_wide_columns(spark, table):
    levels = fit_levels(table.select(F.col("x").cast("string").alias("w")), ["w"], max_local=5, broadcast_levels=20, num_buckets=3)
    odd = spark.createDataFrame([("no",)] * 500 + [(None,)] * 500 + [("7.0",)] * 20, "w string")
    rows = unseen_to_mode(odd, levels).groupBy("w").count().collect()
    assert {r.w: r["count"] for r in rows} == {levels.mode("w"): 1000, "7.0": 20}


def test_error_rate_refuses_nulls(spark):
    for rows in ([(0, 0), (None, 1)], [(0, 0), (1, None)]):
        with pytest.raises(Exception, match="labels must be|scores must not"):
            error_rate(spark.createDataFrame(rows, "label int, prediction int")).collect()
    assert error_rate(spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int").where("true")).first()[0] == 0.5


def test_scores_beyond_a_double_are_refused(spark):
    rows = [(1, 2**53, 0), (2, 2**53 + 1, 1)]
    with pytest.raises(Exception, match="precision"):
        score_rank(spark.createDataFrame(rows, "id long, score long, label int")).collect()
    fine = [(1, 2**53, 0), (2, 2**53 + 2, 1)]
    ranked = score_rank(spark.createDataFrame(fine, "id long, score long, label int")).collect()
    assert [r.id for r in sorted(ranked, key=lambda r: r.idx)] == [2, 1]


def test_clashing_names_are_refused(spark):
    from riskrank.operators import sort_by_key

    df = spark.createDataFrame([(1, 5), (2, 6)], "id long, idx int")
    with pytest.raises(ValueError, match="idx"):
        sort_by_key(df, ["id"])


def test_workspace_clears(spark, table, tmp_path):
    ws = Workspace(spark)
    fit_risk_model(table, ROLES, "tree", workspace=ws)
    ws.clear()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ws.folder)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

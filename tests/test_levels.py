"""Frequent levels without counting the tail, and lookups that shuffle only what a filter lets through."""

import random

import pytest
from pyspark.sql import functions as F

from riskrank.operators import fit_levels, frequent_levels, index_apply, one_hot, unseen_to_mode
from riskrank.operators.levels import LEAST_SHARE, _blooms, _may_hold


def test_frequent_levels_are_exact(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot"] * 30 + ["warm"] * 5 + [f"u{rng.randrange(50_000)}"] * 65), None if i % 7 else i % 3) for i in range(30_000)]
    df = spark.createDataFrame(rows, "id int, a string, b int").repartition(7)
    for share in (0.3, 0.01, 0.0005):
        got = sorted(map(tuple, frequent_levels(df, ["a", "b"], share).collect()))
        want = []
        for k, c in ((1, "a"), (2, "b")):
            values = [r[k] for r in rows if r[k] is not None]
            counts = {}
            for v in values:
                counts[str(v)] = counts.get(str(v), 0) + 1
            want += [(c, v, n) for v, n in counts.items() if n >= share * len(values)]
        assert got == sorted(want)
    assert frequent_levels(df.where("false"), ["a"], 0.1).count() == 0
    for share in (0, 1.5, LEAST_SHARE / 2):
        with pytest.raises(ValueError, match="share"):
            frequent_levels(df, ["a"], share)


def test_no_frequent_level_is_missing(spark):
    """Levels just over the share, among very many rare ones, in skewed partitions."""
    df = spark.range(400_000).select(
        F.when(F.col("id") % 100 == 0, F.concat(F.lit("f"), (F.col("id") / 100 % 10).cast("int")))
        .otherwise(F.sha1(F.col("id").cast("string"))).alias("a")
    )
    got = {r.level: r.n for r in frequent_levels(df, ["a"], 0.001).collect()}
    assert got == {f"f{i}": 400 for i in range(10)}


def test_a_dictionary_of_frequent_levels_only(spark):
    rows = [(i, "a" if i % 2 else "b" if i % 4 else f"x{i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, c string")
    levels = fit_levels(df, ["c"], min_share=0.01)
    assert levels.labels == {"c": ["a", "b"]} and levels.counts == {"c": [2000, 1000]}
    got = {r.id: r.c for r in unseen_to_mode(df, levels).collect()}
    assert all(got[i] == (c if c in "ab" else "a") for i, c in rows)


def test_a_dictionary_without_levels(spark):
    """No value has the share: nothing to become, and the index of the most frequent level."""
    df = spark.createDataFrame([(i, f"x{i}" if i else None) for i in range(2000)], "id int, c string")
    levels = fit_levels(df, ["c"], min_share=0.01)
    assert levels.labels == {"c": []}
    got = index_apply(unseen_to_mode(df, levels), levels, unknown=0.0).collect()
    assert sorted((r.id, r.c, r.c_index) for r in got) == [(i, None, 0.0) for i in range(2000)]
    with pytest.raises(Exception, match="(?i)null"):
        index_apply(unseen_to_mode(df, levels), levels).collect()


@pytest.mark.parametrize("options", [{}, {"max_local": 2, "broadcast_levels": 2, "num_buckets": 2}])
def test_an_index_for_unknown_levels(spark, options):
    train = spark.createDataFrame([(v,) for v in "aaaabbbccd"], "c string")
    levels = fit_levels(train, ["c"], **options)
    df = spark.createDataFrame([("a",), ("b",), ("d",), ("z",), (None,)], "c string")
    got = index_apply(df, levels, unknown=0.0)
    assert sorted(got.collect(), key=str) == sorted([("a", 0.0), ("b", 1.0), ("d", 3.0), ("z", 0.0), (None, 0.0)], key=lambda r: f"Row(c={r[0]!r}, c_index={r[1]})")
    assert got.schema["c_index"].metadata == index_apply(df, levels).schema["c_index"].metadata


def test_filter_has_no_false_negatives(spark):
    frame = spark.range(3000).select(F.lit("c").alias("column"), F.concat(F.lit("l"), "id").alias("level"), F.col("id").cast("double").alias("index"))
    words = _blooms(frame, {"c": 3000}, 1000)["c"]
    assert len(words) & (len(words) - 1) == 0 and sum(w != 0 for w in words) > 0
    seen = frame.select("index", _may_hold(words, F.col("level")).alias("m"))
    assert seen.where("index >= 1000 and not m").count() == 0
    other = spark.range(20_000).select(_may_hold(words, F.concat(F.lit("o"), "id")).alias("m"))
    assert other.where("m").count() < 20_000 * 0.1
    assert spark.range(1).select(_may_hold(words, F.lit(None).cast("string")).isNotNull()).first()[0]


def test_what_the_filter_keeps_from_the_join(spark):
    """A frequent unknown level and nulls reach no exchange; the plan has no salt."""
    train = spark.range(5000).select(F.concat(F.lit("u"), F.col("id") % 2000).alias("c"))
    levels = fit_levels(train, ["c"], max_local=10, broadcast_levels=20, num_buckets=4)
    df = spark.createDataFrame([(i, f"u{i % 2500}" if i % 3 == 0 else None if i % 3 == 1 else "unknown") for i in range(9000)], "id int, c string")
    out = unseen_to_mode(df, levels)
    rows = {r.id: r.c for r in out.collect()}
    mode = levels.mode("c")
    assert all(rows[i] == (f"u{i % 2500}" if i % 3 == 0 and i % 2500 < 2000 else mode) for i in range(9000))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "salt" not in plan and "monotonically" not in plan
    if not _may_hold_now(spark, levels.blooms["c"], "unknown"):
        assert exchanged(spark, levels, df) < 3200


def _may_hold_now(spark, words, level):
    return spark.range(1).select(_may_hold(words, F.lit(level))).first()[0]


def exchanged(spark, levels, df):
    """Rows that the join with the tail sees."""
    words = levels.blooms["c"]
    frequent = [r.level for r in levels.frame.where(F.col("index") < 20).collect()]
    return df.where(F.col("c").isNotNull() & ~F.col("c").isin(frequent) & _may_hold(words, F.col("c"))).count()


def test_two_wide_columns_and_their_width(spark):
    df = spark.range(3000).select("id", F.concat(F.lit("a"), F.col("id") % 700).alias("a"), (F.col("id") * 7 % 900).alias("b"), F.lit("n").alias("n"))
    wide = fit_levels(df, ["a", "b", "n"], max_local=10, broadcast_levels=30, num_buckets=3)
    local = fit_levels(df, ["a", "b", "n"])
    got = index_apply(df, wide)
    assert got.columns == index_apply(df, local).columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, index_apply(df, local).collect()))
    # The number of levels is known, so one-hot vectors need no pass to find their width.
    assert got.schema["a_index"].metadata["ml_attr"]["num_vals"] == 700
    assert "ml_attr" not in index_apply(df, wide, numeric=["a"]).schema["a_index"].metadata
    vector = one_hot(got, ["a", "b"]).first()
    assert vector.a_onehot.size == 699 and vector.b_onehot.size == 899

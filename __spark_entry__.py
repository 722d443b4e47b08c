"""

``entry(spark)`` fits and ranks on ``/root/testdata/sf0.001``. ``queries()`` maps a name to a
callable ``(spark, sf_dir) -> DataFrame``; every one runs over its whole tables. ``oracle_sql()``
gives equivalent SQL for all but the fitted models that SQL cannot express.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.functions import label_of, logistic, row_sum, to_dense, weighted_row_sum
from riskrank.operators import (
    CUTOFFS,
    assemble,
    auc_roc,
    continuous_columns,
    error_rate,
    feature_columns,
    fill_missing,
    fit_levels,
    frequent_levels,
    gains_table,
    index_apply,
    label_vs_prediction,
    one_hot,
    onehot_feature_columns,
    plan_layout,
    roc_pairs,
    score_rank,
    sort_by_key,
    tdr_at,
    unpack,
    unseen_to_mode,
)
from riskrank.operators.models import ensemble_raw, per_tree_score
from riskrank.plans import fit_risk_model, fit_score_rank, ranking_report
from riskrank.sources import Roles, Workspace, read_checked, read_csv, read_splits

# Orders before this day train a model; all orders are scored.
TRAIN_UNTIL = "2000-01-01"
# Training rows are dealt by id, so that a fit does not depend on the number of cores.
PARTITIONS = 4
# Rows of a bucket, for the query that forces cut points of two levels.
TINY_BUCKET = 16
# Bucket count of the queries that force the multi-bucket path on tables too small to choose it.
BUCKETS = 16

ORDER_ROLES = Roles(
    target="o_orderstatus",
    positive="F",
    id="o_orderkey",
    categorical=["o_orderpriority"],
    continuous=["o_totalprice", "o_custkey"],
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _early(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderdate") < F.lit(TRAIN_UNTIL).cast("timestamp_ntz"))


def _order_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders ranked by price; finished ones are the bad class."""
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("score"),
        label_of("o_orderstatus", "F").alias("label"),
    )


def _order_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders scored by the first character of their priority: five scores for the whole table."""
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("score"),
        label_of("o_orderstatus", "F").alias("label"),
    )


def _event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events ranked by value, with many tied values; errors are the bad class."""
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("value").alias("score"), label_of("event_type", "error").alias("label")
    )


def _round(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# --- sources -----------------------------------------------------------------------------------


def _events_csv(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    events = _table(spark, sf_dir, "events")
    path = Workspace(spark).path("events_csv")
    # As text: the CSV writer's default format would cut the time to milliseconds.
    events.withColumn("ts", F.col("ts").cast("string")).write.csv(path, header=True)
    return path, events


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through CSV with inferred types, cast back to the types of the table."""
    path, events = _events_csv(spark, sf_dir)
    inferred = read_csv(spark, path)
    return inferred.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in events.schema])


def csv_scan_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through CSV with the schema given, as for a held-out split."""
    path, events = _events_csv(spark, sf_dir)
    return read_csv(spark, path, schema=events.schema)


def csv_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CSV lines of which some lack a field, have one too many or a wrong one: what became of each line."""
    events = _table(spark, sf_dir, "events")
    kind = F.pmod(F.col("event_id"), F.lit(10))
    last = F.when(kind == 1, F.lit("1.5,6")).when(kind == 2, F.lit("x")).otherwise(F.col("value").cast("string"))
    fields = [F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.when(kind != 0, last)]
    path = Workspace(spark).path("damaged_csv")
    events.select(F.concat_ws(",", *fields)).write.text(path)
    read = read_checked(spark, path, "event_id bigint, user_id bigint, value double", header=False)
    damaged = read.damaged.select(F.split("line", ",")[0].cast("bigint").alias("event_id"), "reason")
    return read.rows.select("event_id", F.lit("whole").alias("reason"), "user_id", "value").unionByName(
        damaged, allowMissingColumns=True
    )


def csv_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two splits of events whose columns look like other types in each: whole numbers, fractions, names."""
    events, ws = _table(spark, sf_dir, "events"), Workspace(spark)
    odd = F.pmod(F.col("event_id"), F.lit(2)) == 1
    first = events.where(odd).select("event_id", F.floor("value").alias("value"), F.col("user_id").alias("user"))
    second = events.where(~odd).select(
        "event_id", (F.floor("value") + 0.5).alias("value"), F.concat(F.lit("u"), "user_id").alias("user"), "event_type"
    )
    paths = [ws.path("first_split"), ws.path("second_split")]
    for split, path in zip((first, second), paths):
        split.write.csv(path, header=True)
    read = [split.rows for split in read_splits(spark, paths)]
    return read[0].unionByName(read[1])


# --- cleaning ----------------------------------------------------------------------------------


def fill_missing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    holes = orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") >= 100000, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("custkey"),
    )
    return fill_missing(holes)


def unseen_to_mode_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels come from early orders other than low priority, and are applied to all orders."""
    orders = _table(spark, sf_dir, "orders")
    levels = fit_levels(_early(orders).where(F.col("o_orderpriority") != "5-LOW"), ["o_orderpriority"])
    return unseen_to_mode(orders.select("o_orderkey", "o_orderpriority"), levels)


def unseen_to_mode_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a dictionary that is kept as a distributed table: users seen in clicks."""
    events = _table(spark, sf_dir, "events")
    clicks = events.where(F.col("event_type") == "click")
    levels = fit_levels(clicks, ["user_id"], max_local=10, broadcast_levels=20, num_buckets=4)
    return unseen_to_mode(events.select("event_id", "user_id"), levels)


# --- features ----------------------------------------------------------------------------------


def index_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_levels(_table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"]).frame


def index_levels_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary too large for the driver, by lowering the limit."""
    orders = _table(spark, sf_dir, "orders")
    return fit_levels(orders, ["o_custkey", "o_orderpriority"], max_local=10, num_buckets=BUCKETS).frame


def frequent_levels_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with a thousandth of the events at least, and kinds of event with a fifth, without counting all."""
    events = _table(spark, sf_dir, "events")
    return frequent_levels(events, ["user_id"], 0.001).unionByName(frequent_levels(events, ["event_type"], 0.2))


def index_apply_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes by a dictionary of frequent users only; all others count as the most frequent one.

    Where no user has that share, there is none that they could become: they are null, with the index 0.
    """
    events = _table(spark, sf_dir, "events").select("event_id", "user_id")
    levels = fit_levels(events, ["user_id"], min_share=0.001)
    return index_apply(unseen_to_mode(events, levels), levels, unknown=0.0)


def index_apply_wide_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns at once whose dictionaries are tables; users not seen in clicks become the most frequent one."""
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", F.col("value").cast("string").alias("price"))
    users = fit_levels(_table(spark, sf_dir, "events").where(F.col("event_type") == "click"), ["user_id"], max_local=10, broadcast_levels=20, num_buckets=4)
    both = fit_levels(unseen_to_mode(events, users), ["user_id", "price"], max_local=10, broadcast_levels=30, num_buckets=8)
    return index_apply(unseen_to_mode(events, users), both)


def index_apply_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return index_apply(events.select("event_id", "event_type"), fit_levels(events, ["event_type"]))


def index_apply_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes from a distributed dictionary: frequent users broadcast, the others joined."""
    events = _table(spark, sf_dir, "events")
    levels = fit_levels(events, ["user_id"], max_local=10, broadcast_levels=20, num_buckets=4)
    return index_apply(events.select("event_id", "user_id"), levels)


def one_hot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    levels = fit_levels(events, ["event_type"])
    encoded = one_hot(index_apply(events.select("event_id", "event_type"), levels), ["event_type"])
    names = [f"is_{i}" for i in range(len(levels.labels["event_type"]) - 1)]
    dense = encoded.withColumn("event_type_onehot", to_dense("event_type_onehot"))
    return unpack(dense, "event_type_onehot", names).select("event_id", "event_type", *names)


_EVENT_ROLES = Roles(target="label", id="event_id", categorical=["event_type"], positive=1)


def _event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "event_type", "value", "user_id")
    return index_apply(events, fit_levels(events, ["event_type"]))


def assemble_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous columns, then category indexes, in one vector."""
    indexed = _event_features(spark, sf_dir)
    inputs = feature_columns(indexed, _EVENT_ROLES)
    names = [f"f{i}" for i in range(len(inputs))]
    return unpack(assemble(indexed, inputs), "features", names).select("event_id", *names)


def assemble_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator vectors, then continuous columns, in one vector."""
    encoded = one_hot(_event_features(spark, sf_dir), ["event_type"])
    inputs = onehot_feature_columns(encoded, _EVENT_ROLES)
    kinds = encoded.schema["event_type_index"].metadata["ml_attr"]["vals"]
    width = len(kinds) - 1 + len(continuous_columns(encoded, _EVENT_ROLES))
    names = [f"f{i}" for i in range(width)]
    return unpack(assemble(encoded, inputs), "features", names).select("event_id", *names)


# --- row arithmetic ----------------------------------------------------------------------------


def row_sum_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = _table(spark, sf_dir, "lineitem").select(*keys, *measures)
    sums = row_sum(row_sum(lines, keys, "key_sum"), measures, "sums")
    return _round(sums.select(*keys, "key_sum", "sums"), "sums")


def weighted_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    raw = weighted_row_sum({"o_totalprice": 0.0000136986301, "o_custkey": -0.00213717})
    scored = orders.select("o_orderkey", raw.alias("raw_score")).withColumn("score", logistic("raw_score"))
    return _round(scored, "raw_score", "score")


# --- ranking -----------------------------------------------------------------------------------


def score_rank_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_rank(_order_scores(spark, sf_dir))


def score_rank_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five scores only, cut into many buckets: the id divides the ties."""
    return score_rank(_order_ties(spark, sf_dir), num_buckets=BUCKETS)


def score_rank_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number scores up to the largest that a double can tell apart."""
    orders = _table(spark, sf_dir, "orders")
    return score_rank(orders.select(F.col("o_orderkey").alias("id"), (F.lit(2**53) - F.col("o_custkey")).alias("score")))


def gains_table_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets of a few rows, so many that their cut points are a table."""
    scores = _order_scores(spark, sf_dir)
    layout = plan_layout(scores.select("score", "id"), ["-score", "id"], rows_per_bucket=TINY_BUCKET, nullable=False)
    return _round(gains_table(scores, layout=layout), "cum_total_norm")


def sort_by_key_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    keys = ["event_type", "-ts", "event_id"]
    return sort_by_key(events, keys, layout=plan_layout(events, keys, rows_per_bucket=TINY_BUCKET))


def roc_pairs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a late and an early error, weighted by large counts: exact beyond what a double holds."""
    events = _event_scores(spark, sf_dir)
    per_score = events.groupBy("score").agg(
        (F.sum("label") * 1_000_000_007).alias("pos"), (F.count(F.lit(1)) * 998_244_353).alias("neg")
    )
    pairs = roc_pairs(Workspace(spark).keep(per_score, "per_score"), num_buckets=BUCKETS)
    return pairs.select(F.col("pairs").cast("string").alias("pairs"), F.col("wins").cast("string").alias("wins"))


def sort_by_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return sort_by_key(events, ["event_type", "-ts", "event_id"], num_buckets=BUCKETS)


def gains_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(gains_table(_order_scores(spark, sf_dir)), "cum_total_norm")


def gains_table_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(gains_table(_order_scores(spark, sf_dir), num_buckets=BUCKETS), "cum_total_norm")


def gains_table_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(gains_table(_order_ties(spark, sf_dir), num_buckets=BUCKETS), "cum_total_norm")


def _tdr(scores, **options):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _round(tdr_at(scores(spark, sf_dir), **options), "rate")

    return query


def _auc(scores, **options):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _round(auc_roc(scores(spark, sf_dir), **options), "auc")

    return query


# --- evaluation --------------------------------------------------------------------------------


def error_rate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(error_rate(_table(spark, sf_dir, "labels"), "toxic", "quality"), "error_rate")


def label_vs_prediction_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_vs_prediction(_table(spark, sf_dir, "labels"), "toxic", "quality", "doc_id")


# --- models ------------------------------------------------------------------------------------


def _model_scores(kind: str, **options):
    """Train on early orders, score all orders."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = _table(spark, sf_dir, "orders")
        return fit_risk_model(_early(orders), ORDER_ROLES, kind, partitions=PARTITIONS, **options).score(orders)

    return query


# One categorical feature and depth 1: the fitted split can be worked out in SQL.
_STUMP_ROLES = Roles(target="pricey", positive=True, id="o_orderkey", categorical=["o_orderpriority"], continuous=[])


def _pricey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").withColumn("pricey", F.col("o_totalprice") > 250000)


def _stump_scores(kind: str, **options):
    """Is an order pricey, given its priority? Trained on early orders, all orders scored."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = _pricey(spark, sf_dir)
        model = fit_risk_model(_early(orders), _STUMP_ROLES, kind, partitions=PARTITIONS, maxDepth=1, **options)
        return _round(model.score(orders), "score")

    return query


def _per_tree(model, orders: DataFrame) -> DataFrame:
    """Output of every boosted tree, their weighted sum and its logistic."""
    scored = per_tree_score(model.classifier, model.prepare(orders))
    scored = scored.withColumn("raw_score", ensemble_raw(model.classifier)).withColumn("score", logistic("raw_score"))
    trees = [f"tree_{i}" for i in range(len(model.classifier.trees))]
    return scored.select("o_orderkey", *trees, "raw_score", "score")


def ensemble_score_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return _per_tree(fit_risk_model(_early(orders), ORDER_ROLES, "boosted", partitions=PARTITIONS), orders)


def ensemble_score_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for depth-1 trees, which SQL can fit too."""
    orders = _pricey(spark, sf_dir)
    scored = _per_tree(fit_risk_model(_early(orders), _STUMP_ROLES, "boosted", partitions=PARTITIONS, maxDepth=1), orders)
    return _round(scored, *[c for c in scored.columns if c != "o_orderkey"])


def stump_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow with depth-1 boosted trees: fit, score, rank, rates, ROC area, error rate."""
    orders = _pricey(spark, sf_dir)
    report = fit_score_rank(_early(orders), orders, _STUMP_ROLES, "boosted", partitions=PARTITIONS, maxDepth=1, num_buckets=BUCKETS)
    return _round(report.summary(), "value")


def tree_summary_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each of three depth-1 trees, without the text of their rules."""
    orders = _pricey(spark, sf_dir)
    model = fit_risk_model(_early(orders), _STUMP_ROLES, "boosted", partitions=PARTITIONS, maxDepth=1)
    return model.summary().select("tree", "weight", "depth", "num_nodes")


def _boosted_nodes(**options):
    """The nodes of boosted trees on one category, walked from the roots."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = _pricey(spark, sf_dir)
        model = fit_risk_model(_early(orders), _STUMP_ROLES, "boosted", partitions=PARTITIONS, **options)
        nodes = model.nodes(Workspace(spark))
        levels = F.array_join(F.array_sort("levels"), ", ").alias("levels")
        columns = ["tree", "depth", "side", "feature", levels, "rows", "gain", "prediction"]
        return _round(nodes.select(*columns), "gain", "prediction")

    return query


def boosted_depth2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of depth 2, as nested conditions over the raw column."""
    orders = _pricey(spark, sf_dir)
    model = fit_risk_model(_early(orders), _STUMP_ROLES, "boosted", partitions=PARTITIONS, maxDepth=2, maxIter=1)
    scored = model.compiled_score(orders, keep_trees=True).withColumnRenamed("id", "o_orderkey")
    return _round(scored.select("o_orderkey", "tree_0", "raw_score", "score"), "tree_0", "raw_score", "score")


def _compiled_agrees(kind: str, **options):
    """Scores of all trees as one projection beside those of the fitted model: what holds for any fit."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = _table(spark, sf_dir, "orders")
        model = fit_risk_model(_early(orders), ORDER_ROLES, kind, partitions=PARTITIONS, **options)
        own, compiled = model.score(orders).alias("a"), model.compiled_score(orders, Workspace(spark)).alias("b")
        score = F.col("a.score")
        margin = F.abs(score - 0.5) > 1e-12
        return own.join(compiled, "id").select(
            "id",
            "a.label",
            (F.abs(score - F.col("b.score")) < 1e-12).alias("same_score"),
            score.between(0.0, 1.0).alias("in_range"),
            (~margin | ((F.col("a.prediction") == (score > 0.5).cast("bigint")) & (F.col("a.prediction") == F.col("b.prediction")))).alias("same_class"),
        )

    return query


def _network_facts(**options):
    """What holds for any network: a score for each row, between 0 and 1, and the class that it says."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = _table(spark, sf_dir, "orders")
        model = fit_risk_model(_early(orders), ORDER_ROLES, "network", partitions=PARTITIONS, scale=True, **options)
        score = F.col("score")
        return model.score(orders).select(
            "id", "label", score.between(0.0, 1.0).alias("in_range"), (F.col("prediction") == (score > 0.5).cast("bigint")).alias("same_class")
        )

    return query


def mlp_saturated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A network that can tell every level apart learns each level's share of pricey orders.

    The learner averages its loss by block, so rows of a last, smaller block would weigh more: all blocks have one size here.
    """
    orders = _pricey(spark, sf_dir)
    options = {"encode": "onehot", "partitions": PARTITIONS, "maxIter": 200, "tol": 1e-10, "layers": [4, 6, 2], "even_blocks": 128}
    model = fit_risk_model(_early(orders), _STUMP_ROLES, "network", **options)
    scored = model.score(orders).join(orders.select(F.col("o_orderkey").alias("id"), "o_orderpriority"), "id")
    levels = scored.groupBy("o_orderpriority").agg(F.min("score").alias("least"), F.max("score").alias("most"), F.count(F.lit(1)).alias("n"))
    shares = _early(orders).groupBy("o_orderpriority").agg(F.avg(F.col("pricey").cast("double")).alias("share"))
    near = (F.abs(F.col("least") - F.col("share")) < 0.0005) & (F.abs(F.col("most") - F.col("share")) < 0.0005)
    return levels.join(shares, "o_orderpriority").select("o_orderpriority", "n", F.round("share", 6).alias("share"), near.alias("learned"))


def _stump_flow(split, rank):
    """Depth-1 boosted trees from the flow's beginning to its report, on the rows that ``split`` and ``rank`` choose."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = _pricey(spark, sf_dir)
        report = fit_score_rank(split(orders), rank(orders), _STUMP_ROLES, "boosted", partitions=PARTITIONS, maxDepth=1)
        return _round(report.summary(), "value")

    return query


def _late(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderdate") >= F.lit(TRAIN_UNTIL).cast("timestamp_ntz"))


def csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From two CSV splits to the report: read with one schema, fit on the first, rank the second."""
    ws, orders = Workspace(spark), _pricey(spark, sf_dir)
    paths = {}
    for name, split in (("train", _early(orders)), ("holdout", _late(orders))):
        paths[name] = ws.path(name)
        split.select("o_orderkey", "o_orderpriority", "pricey").write.csv(paths[name], header=True)
    train, holdout = (split.rows for split in read_splits(spark, [paths["train"], paths["holdout"]]))
    model = fit_risk_model(train, _STUMP_ROLES, "boosted", partitions=PARTITIONS, maxDepth=1, workspace=ws)
    return _round(ranking_report(model.score(holdout), workspace=ws, model=model).summary(), "value")


def tree_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return fit_risk_model(_early(orders), ORDER_ROLES, "forest", partitions=PARTITIONS).summary()


def _risk_report(kind: str, **options):
    """Detection rates, ROC area and error rate of a model fitted on early orders, over all orders."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = _table(spark, sf_dir, "orders")
        return fit_score_rank(_early(orders), orders, ORDER_ROLES, kind, partitions=PARTITIONS, **options).summary()

    return query


def entry(spark: SparkSession) -> DataFrame:
    """Share of finished orders caught at each share of weighted traffic, ranked by a forest."""
    orders = _table(spark, "/root/testdata/sf0.001", "orders")
    return fit_score_rank(_early(orders), orders, ORDER_ROLES, "forest", partitions=PARTITIONS).rates


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; several where an operator has more than one execution path."""
    return {
        "csv_scan": csv_scan,
        "csv_scan_schema": csv_scan_schema,
        "csv_damaged": csv_damaged,
        "csv_drift": csv_drift,
        "fill_missing": fill_missing_query,
        "unseen_to_mode": unseen_to_mode_query,
        "unseen_to_mode_wide": unseen_to_mode_wide,
        "index_levels": index_levels,
        "index_levels_wide": index_levels_wide,
        "index_apply": index_apply_query,
        "index_apply_wide": index_apply_wide,
        "index_apply_wide_two": index_apply_wide_two,
        "frequent_levels": frequent_levels_query,
        "index_apply_frequent": index_apply_frequent,
        "one_hot": one_hot_query,
        "assemble": assemble_query,
        "assemble_nested": assemble_nested,
        "row_sum": row_sum_query,
        "weighted_logistic": weighted_logistic,
        "score_rank": score_rank_query,
        "score_rank_ties": score_rank_ties,
        "score_rank_bigint": score_rank_bigint,
        "sort_by_key": sort_by_key_query,
        "sort_by_key_deep": sort_by_key_deep,
        "gains_table": gains_table_query,
        "gains_table_buckets": gains_table_buckets,
        "gains_table_ties": gains_table_ties,
        "gains_table_deep": gains_table_deep,
        "tdr_at": _tdr(_order_scores),
        "tdr_at_rounds": _tdr(_order_scores, few_rows=8),
        "tdr_at_rounds_ties": _tdr(_order_ties, few_rows=8),
        "tdr_at_buckets": _tdr(_order_scores, num_buckets=BUCKETS),
        "tdr_at_ties": _tdr(_order_ties, num_buckets=BUCKETS),
        "tdr_at_events": _tdr(_event_scores),
        "auc_roc": _auc(_order_scores),
        "auc_roc_buckets": _auc(_order_scores, num_buckets=BUCKETS),
        "auc_roc_ties": _auc(_order_ties, num_buckets=BUCKETS),
        "auc_roc_events": _auc(_event_scores),
        "roc_pairs": roc_pairs_query,
        "error_rate": error_rate_query,
        "label_vs_prediction": label_vs_prediction_query,
        "dt_stump": _stump_scores("tree"),
        "rf_stump": _stump_scores("forest", bootstrap=False, featureSubsetStrategy="all"),
        "gbt_stump": _stump_scores("boosted"),
        "ensemble_score_stump": ensemble_score_stump,
        "stump_report": stump_report,
        "csv_report": csv_report,
        "train_report": _stump_flow(_early, _early),
        "holdout_report": _stump_flow(_early, _late),
        "tree_summary_stump": tree_summary_stump,
        "tree_nodes_stump": _boosted_nodes(maxDepth=1),
        "tree_nodes_depth2": _boosted_nodes(maxDepth=2, maxIter=1),
        "boosted_depth2": boosted_depth2,
        "rf_compiled": _compiled_agrees("forest"),
        "gbt_compiled": _compiled_agrees("boosted"),
        "dt_compiled": _compiled_agrees("tree"),
        "mlp_facts": _network_facts(),
        "mlp_onehot_facts": _network_facts(encode="onehot"),
        "mlp_saturated": mlp_saturated,
        "rf_score": _model_scores("forest"),
        "gbt_score": _model_scores("boosted"),
        "dt_score": _model_scores("tree"),
        "mlp_score": _model_scores("network", scale=True),
        "mlp_onehot_score": _model_scores("network", encode="onehot", scale=True),
        "ensemble_score": ensemble_score_query,
        "tree_summary": tree_summary_query,
        "rf_report": _risk_report("forest"),
        "gbt_report": _risk_report("boosted"),
        "mlp_report": _risk_report("network", encode="onehot", scale=True),
    }


# --- SQL counterparts --------------------------------------------------------------------------

_ORDER_SCORES = """
    select o_orderkey as id, o_totalprice as score, cast(o_orderstatus = 'F' as bigint) as label from orders
"""
_ORDER_TIES = """
    select o_orderkey as id, cast(substr(o_orderpriority, 1, 1) as double) as score,
           cast(o_orderstatus = 'F' as bigint) as label
    from orders
"""
_EVENT_SCORES = """
    select event_id as id, value as score, cast(event_type = 'error' as bigint) as label from events
"""


def _sql_rank(scores: str) -> str:
    return f"""
        select id, score, row_number() over (order by score desc, id) - 1 as idx from ({scores})
    """


def _sql_gains(scores: str) -> str:
    return f"""
        with weighted as (
            select *, case when label = 1 then cast(1 as bigint) else cast(40 as bigint) end as w from ({scores})
        ), running as (
            select *, row_number() over r - 1 as idx, cast(sum(w) over r as bigint) as cum_total,
                   cast(sum(label) over r as bigint) as cum_bad
            from weighted
            window r as (order by score desc, id rows between unbounded preceding and current row)
        )
        select id, score, label, idx, w, cum_total, cum_bad, cum_total - cum_bad as cum_good,
               round(cast(cum_total as double) / (select sum(w) from weighted)::double, 6) as cum_total_norm
        from running
    """


def _sql_tdr(scores: str) -> str:
    cutoffs = ", ".join(f"({p}::double)" for p in CUTOFFS)
    return f"""
        with weighted as (
            select *, case when label = 1 then 1 else 40 end as w from ({scores})
        ), running as (
            select row_number() over r - 1 as idx, sum(w) over r as cum_w, sum(label) over r as cum_bad
            from weighted
            window r as (order by score desc, id rows between unbounded preceding and current row)
        ), shares as (
            select idx, cum_bad, cum_w::double / (select sum(w) from weighted)::double as share from running
        ), pairs as (
            select *, lag(share) over (order by idx) as previous from shares
        ), hits as (
            select cutoff, coalesce(max(idx) filter (idx >= 1 and share >= cutoff and previous <= cutoff), 0) as idx
            from (values {cutoffs}) as c(cutoff) cross join pairs
            group by cutoff
        )
        select cutoff, cast(idx as bigint) as idx,
               round(cum_bad::double / (select sum(label) from weighted)::double, 6) as rate
        from hits join shares using (idx)
    """


def _sql_auc(scores: str) -> str:
    return f"""
        with per_score as (
            select score, sum(label)::double as pos, (count(*) - sum(label))::double as neg
            from ({scores}) group by score
        ), above as (
            select *, sum(pos) over (order by score desc) - pos as pos_above from per_score
        )
        select round(sum(neg * (pos_above + pos / 2)) / (sum(pos) * sum(neg)), 6) as auc from above
    """


def _sql_counts(table: str, column: str) -> str:
    return f"select '{column}' as \"column\", cast({column} as varchar) as level, count(*) as n from {table} group by {column}"


def _sql_levels(table: str, *columns: str) -> str:
    counts = " union all ".join(_sql_counts(table, c) for c in columns)
    return f"""
        select "column", level, n,
               cast(row_number() over (partition by "column" order by n desc, level) - 1 as double) as index
        from ({counts})
    """


_EARLY = "o_orderdate < timestamp '2000-01-01'"
_LATE = "o_orderdate >= timestamp '2000-01-01'"


def _sql_stump(kind: str, scored: str = "true") -> str:
    """Depth-1 trees on one categorical feature.

    Levels are put in order, by their mean target for regression trees (boosting) and by their
    number of positives for classification trees, ties by index. Every cut of that order is a
    candidate split, and the best one has the largest sum of squared side totals over side sizes:
    the variance gain and, for 0/1 targets, also the order of the gini gain.
    """

    def split(source: str, name: str) -> str:
        # source: level, n, total (sum of the target over the level's rows)
        key = "total" if kind == "tree" else "total / n"
        return f"""
            {name}_ordered as (
                select *, row_number() over (order by {key}, n desc, level) as k from {source}
            ), {name}_cuts as (
                select k, sum(n) over (order by k) as nl, sum(total) over (order by k) as tl,
                       sum(n) over () as na, sum(total) over () as ta
                from {name}_ordered
            ), {name}_best as (
                select * from {name}_cuts where nl < na
                order by tl * tl / nl + (ta - tl) * (ta - tl) / (na - nl) desc, k limit 1
            ), {name} as (
                select level, case when o.k <= b.k then tl / nl else (ta - tl) / (na - nl) end as leaf
                from {name}_ordered o cross join {name}_best b
            )"""

    base = """
        level_counts as (
            select o_orderpriority as level, count(*)::double as n,
                   count(*) filter (o_totalprice > 250000)::double as pos
            from orders where o_orderdate < timestamp '2000-01-01' group by 1
        )"""
    tail = f"""
        select o_orderkey as id, s.score as score, cast(o_totalprice > 250000 as bigint) as label,
               cast(s.score > 0.5 as bigint) as prediction
        from orders join scores s on o_orderpriority = s.level where {scored}
    """
    if kind == "nodes":
        # Root and leaves of each tree; the gain is the variance that the split takes away.
        trees = []
        for i in (0, 1, 2):
            levels = f"(select string_agg(level, ', ' order by level) from t{i}_ordered, t{i}_best b where t{i}_ordered.k <= b.k)"
            trees.append(f"""
                select {i} as tree, 0 as depth, null as side, 'o_orderpriority' as feature, {levels} as levels, na as rows,
                       (tl * tl / nl + (ta - tl) * (ta - tl) / (na - nl) - ta * ta / na) / na as gain, ta / na as prediction
                from t{i}_best
                union all select {i}, 1, 'left', null, null, nl, null, tl / nl from t{i}_best
                union all select {i}, 1, 'right', null, null, na - nl, null, (ta - tl) / (na - nl) from t{i}_best
            """)
        tail = f"""
            select tree, depth, side, feature, levels, cast(rows as bigint) as rows, round(gain, 6) as gain,
                   round(prediction, 6) as prediction
            from ({" union all ".join(trees)})
        """
    if kind == "per tree":
        tail = """
            select o_orderkey, round(t0.leaf, 6) as tree_0, round(t1.leaf, 6) as tree_1, round(t2.leaf, 6) as tree_2,
                   round(f2.margin, 6) as raw_score, round(s.score, 6) as score
            from orders join scores s on o_orderpriority = s.level
                 join t0 using (level) join t1 using (level) join t2 using (level) join f2 using (level)
        """
    if kind == "tree":
        # Two leaves that predict the same class are merged into one.
        return f"""
            with {base}, start as (select level, n, pos as total from level_counts), {split("start", "t0")},
            whole as (select sum(pos) / sum(n) as p from level_counts),
            scores as (
                select level, case when (select min(leaf > 0.5) = max(leaf > 0.5) from t0)
                                   then (select p from whole) else leaf end as score
                from t0
            ) {tail}
        """
    # Boosting on labels -1 and 1: the first tree fits the labels, later ones the negative gradient
    # 4y / (1 + exp(2yF)) of the loss at the current margin F, weighted 0.1.
    parts = [base, "start as (select level, n, 2 * pos - n as total from level_counts)", split("start", "t0")]
    parts.append("f0 as (select level, leaf as margin from t0)")
    for i in (1, 2):
        parts.append(f"""
            g{i} as (
                select level, n, pos * 4 / (1 + exp(2 * margin)) - (n - pos) * 4 / (1 + exp(-2 * margin)) as total
                from level_counts join f{i - 1} using (level)
            )""")
        parts.append(split(f"g{i}", f"t{i}"))
        parts.append(f"f{i} as (select level, margin + 0.1 * leaf as margin from f{i - 1} join t{i} using (level))")
    parts.append("scores as (select level, 1 / (1 + exp(-margin)) as score from f2)")
    return f"with {', '.join(parts)} {tail}"


def _sql_depth2(wanted: str) -> str:
    """A regression tree of depth 2 on one category, targets -1 and 1: the best cut of the ordered levels, twice."""
    return f"""
        with ordered as (
            select level, n, total, row_number() over (order by total / n, n desc, level) as k
            from (
                select o_orderpriority as level, count(*)::double as n,
                       (2 * count(*) filter (o_totalprice > 250000) - count(*))::double as total
                from orders where {_EARLY} group by 1
            )
        ), cuts as (
            select a.k as low, c.k as high, b.k as "at", sum(o.n) as na, sum(o.total) as ta,
                   sum(o.n) filter (o.k <= b.k) as nl, sum(o.total) filter (o.k <= b.k) as tl
            from ordered a, ordered b, ordered c, ordered o
            where a.k <= b.k and b.k < c.k and o.k between a.k and c.k
            group by all
        ), best as (
            select low, high, "at", na, ta, nl, tl
            from (
                select *, row_number() over (
                    partition by low, high order by tl * tl / nl + (ta - tl) * (ta - tl) / (na - nl) desc, "at"
                ) as place
                from cuts
            )
            where place = 1
        ), root as (
            select * from best where low = 1 and high = (select max(k) from ordered)
        ), sides as (
            select 'left' as side, low, "at" as high, nl as n, tl as t from root
            union all select 'right', "at" + 1, high, na - nl, ta - tl from root
        ), nodes as (
            select 0 as depth, null as side, low, high, "at", na as n, ta as t, nl, tl from root
            union all select 1, s.side, s.low, s.high, b."at", s.n, s.t, b.nl, b.tl
            from sides s left join best b on b.low = s.low and b.high = s.high
        ), leaves as (
            select 2 as depth, 'left' as side, low, "at" as high, nl as n, tl as t from nodes where depth = 1 and "at" is not null
            union all select 2, 'right', "at" + 1, high, n - nl, t - tl from nodes where depth = 1 and "at" is not null
        ), lowest as (
            select low, high, t / n as leaf from leaves
            union all select low, high, t / n from nodes where depth = 1 and "at" is null
        )
        {wanted}
    """


_DEPTH2_NODES = """
    select 0 as tree, depth, side, case when "at" is not null then 'o_orderpriority' end as feature,
           case when "at" is not null then
               (select string_agg(level, ', ' order by level) from ordered o where o.k between nodes.low and nodes."at") end as levels,
           cast(n as bigint) as rows,
           round((tl * tl / nl + (t - tl) * (t - tl) / (n - nl) - t * t / n) / n, 6) as gain, round(t / n, 6) as prediction
    from nodes
    union all select 0, depth, side, null, null, cast(n as bigint), null, round(t / n, 6) from leaves
"""

_DEPTH2_SCORES = """
    select o_orderkey, round(leaf, 6) as tree_0, round(leaf, 6) as raw_score, round(1 / (1 + exp(-leaf)), 6) as score
    from orders join ordered on o_orderpriority = level join lowest on k between low and high
"""


def _sql_facts(*facts: str) -> str:
    """What holds for every order, whatever the fit."""
    return f"""
        select o_orderkey as id, cast(o_orderstatus = 'F' as bigint) as label, {", ".join(f"true as {f}" for f in facts)}
        from orders
    """


def _sql_rounded(scores: str) -> str:
    return f"select id, round(score, 6) as score, label, prediction from ({scores})"


def _sql_report(scores: str) -> str:
    return f"""
        select 'rate at ' || cast(cutoff as varchar) as measure, rate as value from ({_sql_tdr(scores)})
        union all select 'auc', auc from ({_sql_auc(scores)})
        union all select 'error rate', round(1 - avg(cast(prediction = label as double)), 6) from ({scores})
    """


def _own_oracle_sql() -> dict[str, str]:
    event_ranks = """
        select level, n, row_number() over (order by n desc, level) - 1 as rank
        from (select event_type as level, count(*) as n from events group by event_type)
    """
    one_hot_columns = ", ".join(f"cast(rank = {i} as double) as is_{i}" for i in range(4))
    nested_columns = ", ".join(f"cast(rank = {i} as double) as f{i}" for i in range(4))
    events = "select event_id, ts, user_id, event_type, value, props from events"
    user_ranks = """
        select level, row_number() over (order by n desc, level) - 1 as rank
        from (select cast(user_id as varchar) as level, count(*) as n from events group by 1)
    """
    return {
        "csv_scan": events,
        "csv_scan_schema": events,
        "fill_missing": """
            select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'missing') as status,
                   case when o_totalprice >= 100000 then o_totalprice else -1.0::double end as price,
                   case when o_orderpriority <> '5-LOW' then o_custkey else cast(-1 as bigint) end as custkey
            from orders
        """,
        "unseen_to_mode": """
            with levels as (
                select o_orderpriority as level, count(*) as n from orders
                where o_orderdate < timestamp '2000-01-01' and o_orderpriority <> '5-LOW' group by 1
            )
            select o_orderkey,
                   case when o_orderpriority in (select level from levels) then o_orderpriority
                        else (select level from levels order by n desc, level limit 1) end as o_orderpriority
            from orders
        """,
        "unseen_to_mode_wide": """
            with levels as (
                select cast(user_id as varchar) as level, count(*) as n from events
                where event_type = 'click' group by 1
            )
            select event_id,
                   case when cast(user_id as varchar) in (select level from levels) then cast(user_id as varchar)
                        else (select level from levels order by n desc, level limit 1) end as user_id
            from events
        """,
        "index_levels": _sql_levels("orders", "o_orderpriority", "o_orderstatus"),
        "index_levels_wide": _sql_levels("orders", "o_custkey", "o_orderpriority"),
        "index_apply": f"""
            select event_id, event_type, cast(rank as double) as event_type_index
            from events join ({event_ranks}) on event_type = level
        """,
        "index_apply_wide": f"""
            select event_id, user_id, cast(rank as double) as user_id_index
            from events join ({user_ranks}) on cast(user_id as varchar) = level
        """,
        "one_hot": f"""
            select event_id, event_type, {one_hot_columns}
            from events join ({event_ranks}) on event_type = level
        """,
        "assemble": f"""
            select event_id, value as f0, cast(user_id as double) as f1, cast(rank as double) as f2
            from events join ({event_ranks}) on event_type = level
        """,
        "assemble_nested": f"""
            select event_id, {nested_columns}, value as f4, cast(user_id as double) as f5
            from events join ({event_ranks}) on event_type = level
        """,
        "row_sum": """
            select l_orderkey, l_partkey, l_suppkey, l_linenumber,
                   l_orderkey + l_partkey + l_suppkey + l_linenumber as key_sum,
                   round(l_quantity + l_extendedprice + l_discount + l_tax, 6) as sums
            from lineitem
        """,
        "weighted_logistic": """
            select o_orderkey, round(raw, 6) as raw_score, round(1 / (1 + exp(-raw)), 6) as score
            from (
                select o_orderkey, o_totalprice * 0.0000136986301::double + o_custkey * (-0.00213717)::double as raw
                from orders
            )
        """,
        "score_rank": _sql_rank(_ORDER_SCORES),
        "score_rank_ties": _sql_rank(_ORDER_TIES),
        "sort_by_key": """
            select event_id, user_id, event_type, ts,
                   row_number() over (order by event_type, ts desc, event_id) - 1 as idx
            from events
        """,
        "gains_table": _sql_gains(_ORDER_SCORES),
        "gains_table_buckets": _sql_gains(_ORDER_SCORES),
        "gains_table_ties": _sql_gains(_ORDER_TIES),
        "tdr_at": _sql_tdr(_ORDER_SCORES),
        "tdr_at_buckets": _sql_tdr(_ORDER_SCORES),
        "tdr_at_ties": _sql_tdr(_ORDER_TIES),
        "tdr_at_events": _sql_tdr(_EVENT_SCORES),
        "auc_roc": _sql_auc(_ORDER_SCORES),
        "auc_roc_buckets": _sql_auc(_ORDER_SCORES),
        "auc_roc_ties": _sql_auc(_ORDER_TIES),
        "auc_roc_events": _sql_auc(_EVENT_SCORES),
        "error_rate": "select round(1 - avg(cast(quality = toxic as double)), 6) as error_rate from labels",
        "label_vs_prediction": "select doc_id, toxic, quality from labels",
        "dt_stump": _sql_rounded(_sql_stump("tree")),
        "rf_stump": _sql_rounded(_sql_stump("tree")),
        "gbt_stump": _sql_rounded(_sql_stump("boosted")),
        "ensemble_score_stump": _sql_stump("per tree"),
        "stump_report": _sql_report(_sql_stump("boosted")),
        "csv_report": _sql_report(_sql_stump("boosted", _LATE)),
        "train_report": _sql_report(_sql_stump("boosted", _EARLY)),
        "holdout_report": _sql_report(_sql_stump("boosted", _LATE)),
        "tree_summary_stump": """
            select tree, cast(weight as double) as weight, depth, num_nodes
            from (values (0, 1.0, 1, 3), (1, 0.1, 1, 3), (2, 0.1, 1, 3)) t(tree, weight, depth, num_nodes)
            where exists (select * from orders)
        """,
        "tree_nodes_stump": _sql_stump("nodes"),
        "tree_nodes_depth2": _sql_depth2(_DEPTH2_NODES),
        "boosted_depth2": _sql_depth2(_DEPTH2_SCORES),
        "rf_compiled": _sql_facts("same_score", "in_range", "same_class"),
        "gbt_compiled": _sql_facts("same_score", "in_range", "same_class"),
        "dt_compiled": _sql_facts("same_score", "in_range", "same_class"),
        "mlp_facts": _sql_facts("in_range", "same_class"),
        "mlp_onehot_facts": _sql_facts("in_range", "same_class"),
        "mlp_saturated": f"""
            select o_orderpriority, count(*) as n,
                   round(avg(case when {_EARLY} then cast(o_totalprice > 250000 as double) end), 6) as share, true as learned
            from orders group by 1
        """,
        "csv_damaged": """
            select event_id, case event_id % 10 when 0 then 'short' when 1 then 'long' when 2 then 'mistyped' else 'whole' end as reason,
                   case when event_id % 10 > 2 then user_id end as user_id, case when event_id % 10 > 2 then value end as value
            from events
        """,
        "csv_drift": """
            select event_id, case when event_id % 2 = 1 then floor(value) else floor(value) + 0.5::double end as value,
                   case when event_id % 2 = 1 then cast(user_id as varchar) else 'u' || user_id end as user,
                   case when event_id % 2 = 0 then event_type end as event_type
            from events
        """,
        "frequent_levels": f"""
            select * from ({_sql_counts("events", "user_id")}) where n >= 0.001 * (select count(*) from events)
            union all
            select * from ({_sql_counts("events", "event_type")}) where n >= 0.2 * (select count(*) from events)
        """,
        "index_apply_frequent": f"""
            with levels as (
                select level, row_number() over (order by n desc, level) - 1 as rank
                from ({_sql_counts("events", "user_id")}) where n >= 0.001 * (select count(*) from events)
            )
            select event_id, coalesce(level, (select level from levels where rank = 0)) as user_id,
                   cast(coalesce(rank, 0) as double) as user_id_index
            from events left join levels on cast(user_id as varchar) = level
        """,
        "index_apply_wide_two": """
            with users as (
                select cast(user_id as varchar) as level, count(*) as n from events where event_type = 'click' group by 1
            ), known as (
                select event_id, case when cast(user_id as varchar) in (select level from users) then cast(user_id as varchar)
                                      else (select level from users order by n desc, level limit 1) end as user_id, value
                from events
            ), user_ranks as (
                select user_id, row_number() over (order by count(*) desc, user_id) - 1 as rank from known group by 1
            ), value_counts as (
                select value, count(*) as n from known group by 1
            ), price_ranks as (
                select value, row_number() over (order by n desc, price) - 1 as rank
                from (select value, n, {price} as price from value_counts)
            )
            select event_id, k.user_id, {price} as price, cast(u.rank as double) as user_id_index, cast(p.rank as double) as price_index
            from known k join user_ranks u using (user_id) join price_ranks p using (value)
        """.replace("{price}", "cast(value as varchar)"),
        "score_rank_bigint": _sql_rank(
            "select o_orderkey as id, cast(9007199254740992 - o_custkey as double) as score from orders"
        ),
        "gains_table_deep": _sql_gains(_ORDER_SCORES),
        "sort_by_key_deep": """
            select event_id, user_id, event_type, ts,
                   row_number() over (order by event_type, ts desc, event_id) - 1 as idx
            from events
        """,
        "tdr_at_rounds": _sql_tdr(_ORDER_SCORES),
        "tdr_at_rounds_ties": _sql_tdr(_ORDER_TIES),
        "roc_pairs": f"""
            with per_score as (
                select score, sum(label)::hugeint * 1000000007 as pos, count(*)::hugeint * 998244353 as neg
                from ({_EVENT_SCORES}) group by score
            ), above as (
                select *, sum(pos) over (order by score desc) - pos as pos_above from per_score
            )
            select cast(2 * sum(pos)::hugeint * sum(neg)::hugeint as varchar) as pairs,
                   cast(sum(neg * (2 * pos_above::hugeint + pos))::hugeint as varchar) as wins
            from above
        """,
    }


def _has(*modules: str) -> bool:
    # A folder without its modules, as caches leave behind, has a spec but no origin.
    return all((spec := importlib.util.find_spec(m)) is not None and spec.origin is not None for m in modules)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries: the library's own, and those of the ``llm`` subpackage and its pipeline where they are present."""
    found = _own_queries()
    if _has("riskrank.llm"):
        from riskrank.llm import queries as llm

        found |= llm.queries()
    if _has("riskrank.llm", "corpus_pipeline"):
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    """SQL for every query that SQL can express."""
    found = _own_oracle_sql()
    if _has("riskrank.llm"):
        from riskrank.llm import queries as llm

        found |= llm.oracle_sql()
    if _has("riskrank.llm", "corpus_pipeline"):
        import corpus_pipeline

        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found

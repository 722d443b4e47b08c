"""Command line: fit a model on one CSV table, score another, print how well its ranking works.

    python -m riskrank --train train.csv --holdout holdout.csv --categorical categorical.txt \\
        --target TARGET --model forest
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from riskrank.operators.models import MODELS, SEED
from riskrank.plans import fit_risk_model, ranking_report
from riskrank.sources import Workspace, read_csv, read_roles

ROW_ID = "row_id"


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="riskrank", description=__doc__.splitlines()[0])
    parser.add_argument("--train", required=True, help="training table, CSV with a header line")
    parser.add_argument("--holdout", required=True, help="table to score, same columns")
    parser.add_argument("--categorical", required=True, help="file with one categorical column per line")
    parser.add_argument("--continuous", help="file with one continuous column per line; default: all others")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--target", help="name of the target column")
    target.add_argument("--target-file", help="one-line file naming the target column")
    parser.add_argument("--positive", help="target value that counts as bad; default: the rarer one")
    parser.add_argument("--id", help="unique column; default: rows are numbered")
    parser.add_argument("--model", choices=MODELS, default="forest")
    parser.add_argument("--encode", choices=("index", "onehot"), default="index")
    parser.add_argument("--scale", action="store_true", help="standardise the features")
    parser.add_argument("--seed", type=int, default=SEED)
    parser.add_argument("--rank", choices=("holdout", "train"), default="holdout", help="split to rank")
    parser.add_argument("--trees", action="store_true", help="print the fitted trees")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace):
    workspace = Workspace(spark)
    try:
        _run(spark, args, workspace)
    finally:
        workspace.clear()


def _run(spark: SparkSession, args: argparse.Namespace, workspace: Workspace):
    train = read_csv(spark, args.train)
    holdout = read_csv(spark, args.holdout, schema=train.schema)
    if args.id is None:
        train = workspace.with_row_id(train, ROW_ID)
        holdout = workspace.with_row_id(holdout, ROW_ID)
    roles = read_roles(
        spark,
        args.categorical,
        id=args.id or ROW_ID,
        continuous=args.continuous,
        target=args.target_file,
        target_column=args.target,
        positive=args.positive,
    )
    train.printSchema()
    train.show()
    model = fit_risk_model(train, roles, args.model, encode=args.encode, scale=args.scale, seed=args.seed, workspace=workspace)
    print("features:", ", ".join(model.inputs))
    report = ranking_report(model.score(train if args.rank == "train" else holdout), workspace=workspace, model=model)
    report.scored.show()
    report.rates.show()
    report.auc.show()
    report.error.show()
    if args.trees and args.model != "network":
        model.summary().show(truncate=False)


def main(argv=None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("riskrank").getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

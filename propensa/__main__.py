"""Command line: ``python -m propensa <step> [options]``."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import SparkSession

from propensa.operators import quality as q
from propensa.plans import jobs, learning
from propensa.plans.scoring import score_by_email, score_by_id, score_leads
from propensa.session import build_session
from propensa.sources import schemas, tables
from propensa.sources.registry import ModelRegistry


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="propensa", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, text: str, crm: bool = False) -> argparse.ArgumentParser:
        sub = steps.add_parser(name, help=text)
        sub.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="format of input files")
        if crm:
            sub.add_argument("--crm-path", help="folder with subscribers, tags and transactions")
            sub.add_argument("--jdbc-url", help="database with Subscribers, Tags and Transactions")
            sub.add_argument("--jdbc-split", action="append", default=[], type=tables.Split.parse,
                             metavar="TABLE:KEY:LOW:HIGH[:PARTITIONS]", help="how the scan of a database table is cut, for each of the three")
            sub.add_argument("--database", help="catalog database with the three tables")
        return sub

    ingest = step("ingest", "join the CRM tables", crm=True)
    ingest.add_argument("--output-path", default="data/subscribers_joined")
    ingest.add_argument("--verbose", action="store_true")

    crm = step("test-crm", "check the raw tables", crm=True)
    crm.add_argument("--results-path", default="results/data_quality/crm_validation_results")
    crm.add_argument("--failing-path", help="table of all failing transactions")

    joined = step("test-joined", "check the joined table")
    joined.add_argument("--input-path", default="data/subscribers_joined")
    joined.add_argument("--results-path", default="results/data_quality/subscribers_joined_validation_results")

    every = step("test-all", "check raw tables, joined table and business rules", crm=True)
    every.add_argument("--input-path", default="data/subscribers_joined")
    every.add_argument("--results-path", default="results/data_quality/all_validation_results")
    every.add_argument("--gate", action="store_true", help="fail when a check fails")

    prep = step("preprocess", "merge tags and engineer features", crm=True)
    prep.add_argument("--input-path", default="data/subscribers_joined")
    prep.add_argument("--raw-output-path", default="data/leads_raw")
    prep.add_argument("--cleaned-output-path", default="data/leads_cleaned")
    prep.add_argument("--fitted-path", default="models/fitted", help="tag vocabulary and encoders")
    prep.add_argument("--apply", action="store_true", help="apply what was fitted before instead of fitting")
    prep.add_argument("--reference-date", type=datetime.fromisoformat, help="day 0 of optin_days")

    train = step("train", "search parameters, refit and register a model")
    train.add_argument("--input-path", default="data/leads_raw")
    train.add_argument("--registry", default="models")
    train.add_argument("--test-path", default="data/leads_test")
    train.add_argument("--trials-path", default="results/training/trials")
    train.add_argument("--metric", default="roc_auc", choices=["roc_auc", "f1", "recall"])
    train.add_argument("--num-trials", type=int, default=learning.TRIALS)
    train.add_argument("--num-workers", type=int, default=learning.WORKERS)

    evaluate = step("evaluate", "measure a model on the test leads")
    evaluate.add_argument("--registry", default="models")
    evaluate.add_argument("--model-id", help="defaults to the newest model")
    evaluate.add_argument("--test-path", default="data/leads_test")
    evaluate.add_argument("--output-path", default="results/evaluation")

    compare = step("compare", "rank classifiers by cross-validation")
    compare.add_argument("--input-path", default="data/leads_raw")
    compare.add_argument("--sort", default="f1")
    compare.add_argument("--folds", type=int, default=learning.COMPARE_FOLDS)
    compare.add_argument("--family", default="all", choices=list(learning.FAMILIES))

    score = step("score", "score leads with a registered model")
    score.add_argument("--registry", default="models")
    score.add_argument("--model-id")
    score.add_argument("--input-path", required=True, help="leads table, or JSON records with --json")
    score.add_argument("--json", action="store_true")
    score.add_argument("--output-path", required=True)
    score.add_argument("--email", help="score this email only")
    score.add_argument("--lead-id", type=int, help="score this subscriber only")

    for name in ("health", "features", "metadata"):
        steps.add_parser(name, help=f"{name} of the newest model").add_argument("--registry", default="models")
    return parser


def crm_tables(spark: SparkSession, args: argparse.Namespace) -> tables.CrmTables:
    if args.crm_path:
        return tables.crm_from_files(spark, args.crm_path, args.format)
    if args.jdbc_url:
        return tables.crm_from_jdbc(spark, args.jdbc_url, dict(args.jdbc_split))
    return tables.crm_from_catalog(spark, args.database)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.step == "ingest":
        jobs.ingest(spark, crm_tables(spark, args), args.output_path, args.format, args.verbose)
    elif args.step == "test-crm":
        results = jobs.check_crm(crm_tables(spark, args), args.results_path, args.failing_path)
        q.verdicts(results).show(truncate=False)
    elif args.step == "test-joined":
        joined = jobs.read_joined(spark, args.input_path, args.format)
        q.verdicts(jobs.check_joined(joined, args.results_path)).show(truncate=False)
    elif args.step == "test-all":
        joined = jobs.read_joined(spark, args.input_path, args.format)
        results = jobs.check_all(crm_tables(spark, args), joined, args.results_path)
        q.verdicts(results).show(truncate=False)
        if args.gate:
            q.gate(results)
    elif args.step == "preprocess":
        joined = jobs.read_joined(spark, args.input_path, args.format)
        jobs.preprocess(
            spark, joined, crm_tables(spark, args), args.raw_output_path, args.cleaned_output_path,
            args.fitted_path, not args.apply, args.reference_date,
        )
    elif args.step == "train":
        model_id = jobs.train(
            spark.read.parquet(args.input_path), ModelRegistry(spark, args.registry), args.test_path,
            args.trials_path, args.metric, args.num_trials, args.num_workers,
        )
        print(model_id)
    elif args.step == "evaluate":
        registry = ModelRegistry(spark, args.registry)
        result = jobs.evaluate_latest(spark, registry, args.test_path, args.output_path, args.model_id)
        print(result.metrics)
        result.report.show()
        result.importance.show(10, truncate=False)
    elif args.step == "compare":
        setup = learning.CompareSetup(folds=args.folds)
        table = learning.compare_table(spark.read.parquet(args.input_path), setup)
        learning.leaderboard(table, setup, learning.FAMILIES[args.family], args.sort).show()
    elif args.step == "score":
        model = ModelRegistry(spark, args.registry).load(args.model_id)
        if args.json:
            tags = [f for f in model.fields if f.startswith("tag_") and f != "tag_count"]
            leads = tables.read_table(spark, args.input_path, "json", schemas.lead_schema(tags))
        else:
            leads = spark.read.parquet(args.input_path)
        if args.email is not None:
            scores = score_by_email(model, leads, args.email)
        elif args.lead_id is not None:
            scores = score_by_id(model, leads, args.lead_id)
        else:
            scores = score_leads(model, leads)
        scores.write.mode("overwrite").json(args.output_path)
    elif args.step == "health":
        print(jobs.health(ModelRegistry(spark, args.registry)))
    elif args.step == "features":
        print(ModelRegistry(spark, args.registry).latest().first()["features"])
    elif args.step == "metadata":
        print(ModelRegistry(spark, args.registry).latest().first().asDict())


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments().parse_args(argv)
    run(spark or build_session(), args)


if __name__ == "__main__":
    main(sys.argv[1:])

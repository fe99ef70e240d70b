"""Command line: python -m eta_spark <job> --orders <path> --output <dir> [...]"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from eta_spark.operators import models
from eta_spark.operators.features import build_features
from eta_spark.operators.scenarios import BASE_ORDER, check_summary, headline_figures, order_checks, run_scenarios, scenario_report
from eta_spark.operators.scoring import predict_eta
from eta_spark.plans import reports, training
from eta_spark.schema import RAW_SCHEMA
from eta_spark.session import build_session
from eta_spark.sources.deliveries import orders_from_rows, read_deliveries, read_engineered, read_predictions, read_scenario_results
from eta_spark.sources.model_store import load_model, save_model
from eta_spark.sources.reports import write_reports

REPORT_JOBS = {
    "analyze-delays": reports.delay_reports,
    "geo-audit": reports.audit_reports,
    "geo-cleaning": reports.cleaning_reports,
}
TRAINING_JOBS = {
    "train": training.cleaning_experiment,
    "validate-temporal": training.temporal_validation,
    "validate-group": training.group_validation,
    "tail-aware": training.tail_aware_experiment,
    "weight-sweep": training.weight_sweep,
    "final-fit": training.final_fit,
}
SCORING_JOBS = ["predict", "scenarios"]
OTHER_JOBS = ["prepare", "error-analysis", "headline"]


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eta_spark")
    parser.add_argument("job", choices=[*REPORT_JOBS, *TRAINING_JOBS, *SCORING_JOBS, *OTHER_JOBS])
    parser.add_argument("--orders", help="raw orders; 'predict' and 'scenarios' use the example order without it")
    parser.add_argument("--format", default="csv", help="format of the raw orders")
    parser.add_argument("--broken-lines", choices=["fail", "drop"], default="fail", help="what lines with too many fields do")
    parser.add_argument("--engineered", help="orders written by 'prepare' (in the output format), read instead of raw ones")
    parser.add_argument("--predictions", help="prediction table for 'error-analysis'")
    parser.add_argument("--scenario-results", help="scenario table for 'headline'")
    parser.add_argument("--model", help="stored model for 'predict' and 'scenarios'")
    parser.add_argument("--repeat-duplicates", action="store_true", help="'error-analysis' joins orders that share an ID")
    parser.add_argument("--stages", help="folder for the stages of 'final-fit'; a stopped fit started again there goes on")
    parser.add_argument("--preset", choices=["published", "smoke"], default="published")
    parser.add_argument("--output", required=True)
    parser.add_argument("--output-format", default="parquet")
    return parser.parse_args(arguments)


def raw_orders(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.orders:
        return read_deliveries(spark, options.orders, options.format, options.broken_lines)
    if options.job in SCORING_JOBS:
        return orders_from_rows(spark, [{"ID": "example", **BASE_ORDER}])
    raise SystemExit(f"{options.job} needs --orders or --engineered")


def engineered_orders(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.engineered:
        schema = build_features(spark.createDataFrame([], RAW_SCHEMA)).schema
        return read_engineered(spark, options.engineered, schema, options.output_format)
    return build_features(raw_orders(spark, options))


def results_of(spark: SparkSession, options: argparse.Namespace) -> training.Experiment:
    job = options.job
    if job in REPORT_JOBS:
        return training.Experiment(REPORT_JOBS[job](engineered_orders(spark, options)))
    if job in TRAINING_JOBS:
        preset = models.PUBLISHED if options.preset == "published" else models.SMOKE
        more = {"folder": options.stages} if job == "final-fit" and options.stages else {}
        return TRAINING_JOBS[job](engineered_orders(spark, options), preset, **more)
    if job == "prepare":
        return training.Experiment({"engineered_orders": build_features(raw_orders(spark, options))})
    if job == "error-analysis":
        predictions = read_predictions(spark, options.predictions, options.output_format)
        orders = engineered_orders(spark, options)
        return training.Experiment(reports.error_reports(predictions, orders, options.repeat_duplicates))
    if job == "headline":
        stored = read_scenario_results(spark, options.scenario_results, options.output_format)
        return training.Experiment({"headline_figures": headline_figures(stored)})
    score = load_model(options.model).transform
    if job == "predict":
        return training.Experiment({"predictions": predict_eta(raw_orders(spark, options), score)})
    orders = raw_orders(spark, options)
    results = run_scenarios(orders, score)
    checks = order_checks(orders, score, "ID" if "ID" in orders.columns else None)
    return training.Experiment(
        {
            "operational_scenario_predictions": scenario_report(results),
            "scenario_checks": checks,
            "scenario_check_summary": check_summary(checks),
        }
    )


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    spark = build_session()
    experiment = results_of(spark, options)
    write_reports(experiment.reports, f"{options.output}/reports", options.output_format)
    for name, model in experiment.models.items():
        save_model(model, f"{options.output}/models/{name}")


if __name__ == "__main__":
    main()

"""Sources, sinks and stored models (A)."""

from pyspark.sql import functions as F

from eta_spark.catalog.base import GEO_COLUMNS, cleaned, engineered, formula, group_test_scored, metrics_sql, r, random_test, raw, register
from eta_spark.catalog.scoring import SERVED
from eta_spark.functions.labels import target
from eta_spark.operators import models
from eta_spark.operators.delays import risk_of_factor
from eta_spark.operators.errors import prediction_table
from eta_spark.operators.metrics import tail_measures
from eta_spark.operators.quality import clean_geography
from eta_spark.operators.scenarios import BASE_ORDER, run_scenarios, scenario_report
from eta_spark.operators.splits import random_split, split_tables
from eta_spark.plans.training import feature_record, training_record
from eta_spark.schema import RAW_SCHEMA, REQUIRED_AT_SCORING, TARGET
from eta_spark.session import new_run_dir
from eta_spark.sources.deliveries import (
    broken_lines,
    orders_from_rows,
    read_deliveries,
    read_predictions,
    read_scenario_results,
    require_columns,
    select_present,
)
from eta_spark.sources.model_store import load_model, save_model
from eta_spark.sources.reports import write_report

RAW_COLUMNS = [f.name for f in RAW_SCHEMA if f.name != TARGET]


# Of one order in 50 a field holds two commas, of one in 90 a quote that nothing closes.
PLANTED = "(CAST(split_part(ID, '-', 1) AS BIGINT) % 50 = 0 OR CAST(split_part(ID, '-', 1) AS BIGINT) % 90 = 1)"


@register(
    "a01_raw_scan",
    "SELECT count(*) AS n_rows, "
    + ", ".join(f"count({c}) AS {c}" for c in RAW_COLUMNS)
    + f', count("Time_taken(min)") AS minutes, (SELECT count(*) FROM raw WHERE {PLANTED}) AS rejected FROM raw WHERE NOT {PLANTED}',
)
def raw_scan(spark, sf_dir):
    """Orders written as CSV with broken lines among them, and read again."""
    order = F.split_part("ID", F.lit("-"), F.lit(1)).cast("long")
    planted = (
        raw(spark, sf_dir)
        .withColumn("City", F.when(order % 50 == 0, F.concat("City", F.lit(",more,fields"))).otherwise(F.col("City")))
        .withColumn("Type_of_order", F.when(order % 90 == 1, F.concat(F.lit('"'), "Type_of_order")).otherwise(F.col("Type_of_order")))
    )
    path = f"{new_run_dir(spark, 'a01')}/orders"
    planted.write.option("header", True).option("quote", "").csv(path)
    rejected = broken_lines(spark, path).agg(F.count("*").alias("rejected"))
    counts = read_deliveries(spark, path, broken="drop").agg(
        F.count("*").alias("n_rows"), *[F.count(c).alias(c) for c in RAW_COLUMNS], F.count(target()).alias("minutes")
    )
    return counts.withColumn("rejected", rejected.scalar())


@register("a02_prediction_scan", f"SELECT is_long AS is_long_delivery, count(*) AS orders, {metrics_sql()} FROM scored GROUP BY is_long")
def prediction_scan(spark, sf_dir):
    table = prediction_table(group_test_scored(spark, sf_dir))
    path = write_report(table, new_run_dir(spark, "a02"), "predictions", "csv")
    stored = read_predictions(spark, path).withColumn("minutes", target())
    measures = tail_measures(F.col("minutes"), F.col("predicted"))
    return stored.groupBy("is_long_delivery").agg(F.count("*").alias("orders"), *measures)




@register(
    "a03_scenario_scan",
    SERVED
    + f"""SELECT scenario, count(*) AS orders, {r('sum(eta)', 'total_eta')}, count(*) FILTER (WHERE eta >= 45) AS long_orders
 FROM served GROUP BY 1""",
)
def scenario_scan(spark, sf_dir):
    orders = raw(spark, sf_dir)
    report = scenario_report(run_scenarios(orders, formula))
    path = write_report(report, new_run_dir(spark, "a03"), "scenarios", "csv", compression="gzip")
    stored = read_scenario_results(spark, path)
    return stored.groupBy("scenario").agg(
        F.count("*").alias("orders"),
        F.sum("predicted_eta_min").alias("total_eta"),
        F.count_if(F.col("predicted_long_delivery")).alias("long_orders"),
    )


@register(
    "a04_report_sink",
    f"""SELECT Road_traffic_density, count(*) AS orders, count(*) FILTER (WHERE is_long) AS long_deliveries,
 {r('avg(CAST(is_long AS INTEGER))', 'long_delivery_rate')} FROM flagged GROUP BY 1""",
)
def report_sink(spark, sf_dir):
    report = risk_of_factor(engineered(spark, sf_dir), "Road_traffic_density")
    path = write_report(report, new_run_dir(spark, "a04"), "long_delivery_risk_road_traffic_density", "csv")
    return spark.read.schema(report.schema).option("header", True).csv(path)


@register(
    "a05_inline_rows",
    """SELECT City, count(*) AS orders FROM (SELECT City FROM raw UNION ALL SELECT 'Metropolitian') GROUP BY City""",
)
def inline_rows(spark, sf_dir):
    columns = ["City", "Road_traffic_density"]
    listed = orders_from_rows(spark, [BASE_ORDER]).select(*columns)
    return raw(spark, sf_dir, columns).unionByName(listed).groupBy("City").agg(F.count("*").alias("orders"))


@register(
    "a06_required_columns",
    "SELECT " + ", ".join(f"count({c}) AS {c}" for c in REQUIRED_AT_SCORING) + " FROM raw",
)
def required_columns(spark, sf_dir):
    checked = require_columns(raw(spark, sf_dir))
    return checked.agg(*[F.count(c).alias(c) for c in REQUIRED_AT_SCORING])


@register("a07_project_if_present", "SELECT ID, City, Festival FROM raw")
def project_if_present(spark, sf_dir):
    return select_present(raw(spark, sf_dir), ["ID", "Promised_time", "City", "Festival"])


def _reloaded(spark, sf_dir, label):
    # The stored orders: a fit passes over them many times, and would parse the raw texts anew in each pass.
    train, _ = split_tables(random_split(cleaned(spark, sf_dir)))
    model = models.fit_model(train, models.LINEAR, models.SMOKE)
    return model, load_model(save_model(model, new_run_dir(spark, label)))


@register("a08_model_save", "SELECT count(*) AS orders, count(*) AS same_predictions FROM rnd WHERE split = 'test'")
def model_save(spark, sf_dir):
    model, reloaded = _reloaded(spark, sf_dir, "a08")
    test = random_test(spark, sf_dir)
    first = model.transform(test).withColumnRenamed("prediction", "before")
    both = reloaded.transform(first.select(*test.columns, "before"))
    return both.agg(
        F.count("*").alias("orders"), F.count_if(F.col("before") == F.col("prediction")).alias("same_predictions")
    )


@register("a09_model_load", "SELECT split, count(*) AS orders, count(*) AS finite_predictions FROM rnd GROUP BY split")
def model_load(spark, sf_dir):
    _, reloaded = _reloaded(spark, sf_dir, "a09")
    labelled = random_split(clean_geography(engineered(spark, sf_dir)))
    finite = F.abs(F.col("prediction")) < float("inf")
    return reloaded.transform(labelled).groupBy("split").agg(
        F.count("*").alias("orders"), F.count_if(finite & ~F.isnan("prediction")).alias("finite_predictions")
    )


@register(
    "a10_training_record",
    """SELECT 'Boosted Trees' AS model, 'Time_taken(min)' AS target, 2.0e0 AS tail_weight,
 CAST(45 AS BIGINT) AS long_delivery_threshold, CAST(500 AS BIGINT) AS n_estimators, CAST(6 AS BIGINT) AS max_depth,
 0.03e0 AS learning_rate, CAST(3 AS BIGINT) AS min_child_weight, 0.9e0 AS subsample, 1.0e0 AS colsample_bytree,
 count(*) FILTER (WHERE NOT anomaly) AS training_rows, count(*) FILTER (WHERE anomaly) AS removed_geographic_anomalies,
 count(*) FILTER (WHERE NOT anomaly AND is_long) AS long_delivery_training_rows FROM marked""",
)
def training_config(spark, sf_dir):
    return training_record(engineered(spark, sf_dir, GEO_COLUMNS), models.PUBLISHED)


FEATURES_SQL = [
    "Delivery_person_Age",
    "Delivery_person_Ratings",
    "Weatherconditions",
    "Road_traffic_density",
    "Vehicle_condition",
    "Type_of_order",
    "Type_of_vehicle",
    "multiple_deliveries",
    "Festival",
    "City",
    "distance_km",
    "order_hour",
    "is_peak_hour",
    "order_dayofweek",
    "is_weekend",
]


@register(
    "a11_feature_record",
    " UNION ALL ".join(f"SELECT '{f}' AS feature, count({f}) AS training_values FROM clean" for f in FEATURES_SQL),
)
def feature_list(spark, sf_dir):
    return feature_record(clean_geography(engineered(spark, sf_dir)))

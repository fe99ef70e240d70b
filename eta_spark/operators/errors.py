"""Prediction tables and error reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eta_spark.functions.bands import DELIVERY_TIME, ERROR_DISTANCE
from eta_spark.functions.labels import is_long, signed_error, target
from eta_spark.schema import ERROR_KEYS, FEATURES, TARGET
from eta_spark.session import new_run_dir
from eta_spark.sources.deliveries import select_present

# Columns of the worst-prediction report.
WORST_COLUMNS = [
    "ID",
    "Delivery_person_ID",
    TARGET,
    "predicted",
    "error",
    "absolute_error",
    "distance_km",
    "Road_traffic_density",
    "Weatherconditions",
    "multiple_deliveries",
    "Festival",
    "Type_of_vehicle",
    "Vehicle_condition",
    "City",
    "order_hour",
    "is_peak_hour",
]


def with_errors(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Adds predicted, error, absolute error and the long flag to scored orders."""
    error = signed_error(target(), F.col(prediction))
    return scored.withColumns(
        {
            "predicted": F.col(prediction),
            "error": error,
            "absolute_error": F.abs(error),
            "is_long_delivery": is_long(target()),
        }
    )


def prediction_table(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """The per-order prediction report."""
    columns = ["ID", "Delivery_person_ID", "Order_Date", TARGET, "predicted", "error", "absolute_error"]
    return select_present(with_errors(scored, prediction), columns + ["is_long_delivery"])


def test_predictions(scored: DataFrame, dataset: str, prediction: str = "prediction") -> DataFrame:
    """Actual against predicted with a data-version tag."""
    return with_errors(scored, prediction).select(
        target().alias("actual"), "predicted", "error", "absolute_error", F.lit(dataset).alias("dataset")
    )


def paired_predictions(scored: DataFrame, baseline: str, tail_aware: str) -> DataFrame:
    """Both models' predictions and errors per order, read from one scored table."""
    return scored.select(
        "ID",
        "Delivery_person_ID",
        target(),
        F.col(baseline).alias("baseline_prediction"),
        F.col(tail_aware).alias("tail_aware_prediction"),
        signed_error(target(), F.col(baseline)).alias("baseline_error"),
        signed_error(target(), F.col(tail_aware)).alias("tail_aware_error"),
        is_long(target()).alias("is_long_delivery"),
    )


def duplicate_keys(df: DataFrame, key: str = "ID") -> DataFrame:
    """Keys that occur more than once; on the feature side each would repeat its predictions."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def attach_features(
    predictions: DataFrame, orders: DataFrame, key: str = "ID", require_unique: bool = False
) -> DataFrame:
    """Left join of order features. A feature name the predictions already use gets the suffix ``_data``.

    Duplicate keys repeat rows, as in any left join; ``require_unique`` refuses them instead.
    """
    if require_unique and not duplicate_keys(orders, key).isEmpty():
        raise ValueError(f"{key} is not unique in the feature table.")
    features = select_present(orders, [key, *FEATURES])
    renamed = {c: f"{c}_data" for c in features.columns if c != key and c in predictions.columns}
    return predictions.join(features.withColumnsRenamed(renamed), key, "left")


def bucketed(df: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """df as a table bucketed and sorted by key, its files in the shared folder; rows without key are left out.

    Two such tables of equal ``buckets`` (as many as shuffle partitions if not given) join without a shuffle,
    however often, and a grouping by key needs none either.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_run_dir(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    rows = df.where(F.col(key).isNotNull()).repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def attach_bucketed_features(
    predictions: DataFrame, orders: DataFrame, key: str = "ID", require_unique: bool = False, buckets: int | None = None
) -> DataFrame:
    """``attach_features`` for tables too large to shuffle for each report.

    Both sides are written once, bucketed and sorted by key. Predictions without key cannot match; they go round
    the join, so they do not meet in one task.
    """
    features = bucketed(select_present(orders, [key, *FEATURES]), key, "order-features", buckets)
    if require_unique and not duplicate_keys(features, key).isEmpty():
        raise ValueError(f"{key} is not unique in the feature table.")
    joined = attach_features(bucketed(predictions, key, "predictions", buckets), features, key)
    return joined.unionByName(predictions.where(F.col(key).isNull()), allowMissingColumns=True)


def with_report_keys(joined: DataFrame) -> DataFrame:
    """Recomputes the long flag and adds the two banded keys."""
    return joined.withColumns(
        {
            "is_long_delivery": is_long(target()),
            "delivery_time_bucket": DELIVERY_TIME.label(target()),
            "distance_bucket": ERROR_DISTANCE.label(F.col("distance_km")),
        }
    )


def _error_measures() -> list[Column]:
    return [
        F.count("*").alias("orders"),
        F.avg(target()).alias("actual_mean"),
        F.avg("predicted").alias("predicted_mean"),
        F.avg("absolute_error").alias("mae"),
        F.avg("error").alias("signed_error"),
        F.avg(F.col("is_long_delivery").cast("int")).alias("long_delivery_rate"),
    ]


def summarize_error(table: DataFrame, key: str) -> DataFrame:
    """Error by one key, missing keys included, worst first."""
    return table.groupBy(key).agg(*_error_measures()).orderBy(F.desc_nulls_last("mae"), key)


def error_by_keys(table: DataFrame, keys: list[str] = ERROR_KEYS) -> DataFrame:
    """The same report for many keys from one scan: (key, level, measures)."""
    present = [k for k in keys if k in table.columns]
    measured = [TARGET, "predicted", "absolute_error", "error", "is_long_delivery"]
    return (
        table.select(*[F.col(f"`{m}`") for m in measured], *[F.col(k).cast("string").alias(k) for k in present])
        .unpivot([F.col(f"`{m}`") for m in measured], present, "key", "level")
        .groupBy("key", "level")
        .agg(*_error_measures())
        .orderBy("key", F.desc_nulls_last("mae"), "level")
    )


def _rmse() -> Column:
    return F.sqrt(F.avg(F.col("error") * F.col("error")))


def overall_error(table: DataFrame) -> DataFrame:
    return table.agg(F.avg("absolute_error").alias("mae"), _rmse().alias("rmse"), F.avg("error").alias("bias"))


def long_against_normal(table: DataFrame) -> DataFrame:
    return table.groupBy("is_long_delivery").agg(
        F.count("*").alias("orders"),
        F.avg(target()).alias("actual_mean"),
        F.avg("predicted").alias("predicted_mean"),
        F.avg("absolute_error").alias("mae"),
        _rmse().alias("rmse"),
        F.avg("error").alias("signed_error"),
    )


def long_orders(table: DataFrame) -> DataFrame:
    return table.filter("is_long_delivery")


def tail_bias(table: DataFrame) -> DataFrame:
    """Are long deliveries predicted too short?"""
    one = long_orders(table).agg(
        F.count("*").alias("long_orders"),
        F.avg(target()).alias("actual_mean"),
        F.avg("predicted").alias("predicted_mean"),
        F.avg("error").alias("signed_error"),
    )
    return one.withColumn(
        "diagnostic", F.when(F.col("signed_error") < 0, "underpredicts").otherwise("no underprediction")
    )


def worst_underpredictions(table: DataFrame, k: int = 100) -> DataFrame:
    return select_present(long_orders(table).orderBy(F.asc_nulls_last("error"), "ID").limit(k), WORST_COLUMNS)


def high_risk_combinations(table: DataFrame) -> DataFrame:
    keys = ["Road_traffic_density", "multiple_deliveries", "is_peak_hour"]
    return (
        table.groupBy(*keys)
        .agg(*_error_measures())
        .orderBy(F.desc_nulls_last("long_delivery_rate"), F.desc("orders"), *keys)
    )

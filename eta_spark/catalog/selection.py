"""Filters, splits, leakage checks, joins, sorting and set operations (C and E)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from eta_spark.catalog.base import (
    cleaned,
    engineered,
    error_table,
    formula,
    formula_sql,
    group_test_scored,
    metrics_sql,
    r,
    raw,
    register,
)
from eta_spark.functions import labels
from eta_spark.operators import delays, errors, metrics, quality, splits
from eta_spark.operators.features import valid_target
from eta_spark.functions.parsing import lenient_number
from eta_spark.schema import FEATURES, GROUP_COLUMN, TARGET

# --- filters --------------------------------------------------------------------------------------


@register("c01_target_filter", f"SELECT ID, {r('minutes', 'minutes')} FROM eng")
def target_filter(spark, sf_dir):
    parsed = raw(spark, sf_dir).withColumn(TARGET, lenient_number(labels.target()))
    return valid_target(parsed).select("ID", labels.target().alias("minutes"))


@register("c02_geographic_cleaning", f"SELECT ID, {r('distance_km', 'distance_km')} FROM clean")
def geographic_cleaning(spark, sf_dir):
    return cleaned(spark, sf_dir).select("ID", "distance_km")


@register("c03_removed_orders", f"SELECT ID, {r('distance_km', 'distance_km')} FROM marked WHERE anomaly")
def removed_orders(spark, sf_dir):
    return quality.removed_by_cleaning(engineered(spark, sf_dir)).select("ID", "distance_km")


@register("c04_extreme_distance", f"SELECT ID, {r('distance_km', 'distance_km')} FROM eng WHERE distance_km > 50")
def extreme_distance(spark, sf_dir):
    return quality.extreme_orders(engineered(spark, sf_dir)).select("ID", "distance_km")


@register("c05_long_deliveries", f"SELECT ID, {r('minutes', 'minutes')}, {r('error', 'error')} FROM scored WHERE is_long")
def long_deliveries(spark, sf_dir):
    table = errors.with_errors(group_test_scored(spark, sf_dir))
    return errors.long_orders(table).select("ID", labels.target().alias("minutes"), "error")


# --- splits ---------------------------------------------------------------------------------------


@register("c06_random_split", "SELECT ID, split FROM rnd")
def random_split(spark, sf_dir):
    return splits.random_split(cleaned(spark, sf_dir)).select("ID", "split")


@register("c07_temporal_split", "SELECT ID, CAST(order_day AS VARCHAR) AS order_day, split FROM temporal")
def temporal_split(spark, sf_dir):
    return splits.temporal_split(cleaned(spark, sf_dir)).select("ID", "order_day", "split")


@register("c08_group_split", "SELECT ID, Delivery_person_ID, split FROM grouped")
def group_split(spark, sf_dir):
    return splits.group_split(cleaned(spark, sf_dir)).select("ID", GROUP_COLUMN, "split")


def _leak_sql(table: str, key: str) -> str:
    return f"""SELECT count(*) AS shared_keys, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
 FROM (SELECT {key} FROM {table} WHERE split = 'train' INTERSECT SELECT {key} FROM {table} WHERE split = 'test')"""


@register("c09_date_leak_check", _leak_sql("temporal", "order_day"))
def date_leak_check(spark, sf_dir):
    return splits.leak_report(splits.temporal_split(cleaned(spark, sf_dir)), "order_day")


@register("c10_rider_leak_check", _leak_sql("grouped", "Delivery_person_ID"))
def rider_leak_check(spark, sf_dir):
    return splits.leak_report(splits.group_split(cleaned(spark, sf_dir)), GROUP_COLUMN)


@register(
    "c11_group_key_not_a_feature",
    "SELECT count(*) AS orders, count(DISTINCT Delivery_person_ID) AS riders, CAST(15 AS BIGINT) AS model_columns FROM clean",
)
def group_key_not_a_feature(spark, sf_dir):
    features = splits.check_group_not_a_feature(FEATURES)
    orders = cleaned(spark, sf_dir)
    return orders.agg(
        F.count("*").alias("orders"),
        F.countDistinct(GROUP_COLUMN).alias("riders"),
        F.lit(len(orders.select(*features).columns)).alias("model_columns"),
    )


def _profile_sql(table: str, kind: str) -> str:
    return f"""SELECT '{kind}' AS kind, split, count(*) AS n_rows, count(DISTINCT Delivery_person_ID) AS riders,
 count(DISTINCT order_day) AS n_days, CAST(min(order_day) AS VARCHAR) AS first_day, CAST(max(order_day) AS VARCHAR) AS last_day
 FROM {table} GROUP BY split"""


@register("c12_split_profile", _profile_sql("temporal", "temporal") + " UNION ALL " + _profile_sql("grouped", "group"))
def split_profile(spark, sf_dir):
    orders = cleaned(spark, sf_dir)
    sides = [("temporal", splits.temporal_split(orders)), ("group", splits.group_split(orders))]
    temporal, group = (
        splits.split_profile(labelled)
        .withColumnsRenamed({"rows": "n_rows", "days": "n_days"})
        .withColumn("kind", F.lit(kind))
        for kind, labelled in sides
    )
    return temporal.unionByName(group)


# --- joins, set operations, sorting ---------------------------------------------------------------


@register(
    "e01_inner_join",
    f"""SELECT factor, level, count(*) AS orders, {r('avg(minutes)', 'mean_minutes')}, {r('avg(CAST(is_long AS INTEGER))', 'long_delivery_rate')}
 FROM (SELECT 'is_peak_hour' AS factor, CAST(is_peak_hour AS VARCHAR) AS level, minutes, is_long FROM flagged
 UNION ALL SELECT 'City', City, minutes, is_long FROM flagged) GROUP BY 1, 2""",
)
def inner_join(spark, sf_dir):
    counts = delays.factor_counts(engineered(spark, sf_dir), ["is_peak_hour", "City"])
    times = delays.delay_by_factor(counts).select("factor", "level", F.col("mean").alias("mean_minutes"))
    risk = delays.risk_by_factor(counts).select("factor", "level", "orders", "long_delivery_rate")
    return times.join(risk, ["factor", "level"], "inner")


@register(
    "e02_left_join",
    f"""SELECT s.ID, {r('s.predicted', 'predicted')}, c.City, CAST(c.order_hour AS BIGINT) AS order_hour, {r('c.distance_km', 'distance_km')}
 FROM scored s LEFT JOIN clean c ON s.ID = c.ID""",
)
def left_join(spark, sf_dir):
    predictions = errors.prediction_table(group_test_scored(spark, sf_dir))
    joined = errors.attach_bucketed_features(predictions, cleaned(spark, sf_dir))
    return joined.select("ID", "predicted", "City", "order_hour", "distance_km")


@register(
    "e03_intersection",
    """SELECT CAST(order_day AS VARCHAR) AS order_day FROM rnd WHERE split = 'train'
 INTERSECT SELECT CAST(order_day AS VARCHAR) FROM rnd WHERE split = 'test'""",
)
def intersection(spark, sf_dir):
    from eta_spark.functions.parsing import day_first_date

    dated = cleaned(spark, sf_dir).withColumn("order_day", day_first_date(F.col("Order_Date")))
    return splits.shared_keys(splits.random_split(dated), "order_day")


@register(
    "e04_union",
    f"""SELECT 'Original' AS dataset, {metrics_sql('minutes', formula_sql())} FROM eng
 UNION ALL SELECT 'Cleaned', {metrics_sql('minutes', formula_sql())} FROM clean""",
)
def union(spark, sf_dir):
    def measured(orders, dataset):
        table = metrics.evaluate(formula(orders), labels.target(), F.col("prediction"))
        return table.withColumn("dataset", F.lit(dataset))

    original = measured(engineered(spark, sf_dir), "Original")
    return original.unionByName(measured(cleaned(spark, sf_dir), "Cleaned"))


@register(
    "e05_membership",
    f"""SELECT Delivery_person_ID, count(*) AS orders, {r('avg(minutes)', 'mean_minutes')} FROM eng
 WHERE Delivery_person_ID IN (SELECT Delivery_person_ID FROM grouped WHERE split = 'test') GROUP BY 1""",
)
def membership(spark, sf_dir):
    _, test = splits.split_tables(splits.group_split(cleaned(spark, sf_dir)))
    members = splits.members_of(engineered(spark, sf_dir), splits.distinct_riders(test), GROUP_COLUMN)
    return members.groupBy(GROUP_COLUMN).agg(F.count("*").alias("orders"), F.avg(labels.target()).alias("mean_minutes"))


@register(
    "e06_sorted_report",
    f"""SELECT *, row_number() OVER (ORDER BY mae DESC, Road_traffic_density ASC) AS place FROM (
 SELECT Road_traffic_density, count(*) AS orders, {r('avg(absolute_error)', 'mae')} FROM keyed GROUP BY 1)""",
)
def sorted_report(spark, sf_dir):
    report = errors.summarize_error(error_table(spark, sf_dir), "Road_traffic_density").select(
        "Road_traffic_density", "orders", F.round("mae", 4).alias("mae")
    )
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last("mae"), "Road_traffic_density"))
    return report.withColumn("place", place)


@register(
    "e07_farthest_orders",
    f"""SELECT ID, Delivery_person_ID, {r('distance_km', 'distance_km')}, City FROM eng
 WHERE distance_km > 50 ORDER BY eng.distance_km DESC, ID LIMIT 200""",
)
def farthest_orders(spark, sf_dir):
    return quality.farthest_orders(engineered(spark, sf_dir)).select("ID", GROUP_COLUMN, "distance_km", "City")


@register(
    "e07_worst_underpredictions",
    f"""SELECT ID, {r('minutes', 'minutes')}, {r('predicted', 'predicted')}, {r('error', 'error')}, Road_traffic_density, City
 FROM keyed WHERE is_long ORDER BY keyed.error, ID LIMIT 100""",
)
def worst_underpredictions(spark, sf_dir):
    worst = errors.worst_underpredictions(error_table(spark, sf_dir))
    return worst.select("ID", labels.target().alias("minutes"), "predicted", "error", "Road_traffic_density", "City")


@register(
    "e08_cleaning_candidates",
    f"""SELECT ID, Delivery_person_ID, {r('distance_km', 'distance_km')}, Order_Date, {r('minutes', 'minutes')},
 geo_outlier, extreme_latitude_difference, extreme_longitude_difference FROM marked WHERE anomaly""",
)
def cleaning_candidates(spark, sf_dir):
    candidates = quality.cleaning_candidates(engineered(spark, sf_dir)).withColumnRenamed(TARGET, "minutes")
    return candidates.select("ID", GROUP_COLUMN, "distance_km", "Order_Date", "minutes", *quality.ANOMALY_COLUMNS)


@register(
    "e09_distinct_values",
    """SELECT 'rider' AS kind, Delivery_person_ID AS value FROM riders
 UNION ALL SELECT 'day', CAST(order_day AS VARCHAR) FROM days""",
)
def distinct_values(spark, sf_dir):
    orders = cleaned(spark, sf_dir)
    riders = splits.distinct_riders(orders).select(F.lit("rider").alias("kind"), F.col(GROUP_COLUMN).alias("value"))
    days = splits.distinct_days(orders).select(F.lit("day").alias("kind"), F.col("order_day").cast("string").alias("value"))
    return riders.unionByName(days)


@register(
    "e10_row_lookup",
    f"""SELECT {r('avg(minutes) FILTER (WHERE Road_traffic_density = $$Jam$$)', 'jam_mean')},
 {r('avg(minutes) FILTER (WHERE Road_traffic_density = $$Low$$)', 'low_mean')} FROM eng""",
)
def row_lookup(spark, sf_dir):
    counts = delays.factor_counts(engineered(spark, sf_dir), ["Road_traffic_density"])
    report = delays.delay_by_factor(counts)
    return report.agg(
        metrics.value_in_row("level", "Jam", "mean").alias("jam_mean"),
        metrics.value_in_row("level", "Low", "mean").alias("low_mean"),
    )


@register(
    "e11_arg_min",
    f"""SELECT Road_traffic_density, {r('avg(absolute_error)', 'long_delivery_MAE')} FROM scored WHERE is_long
 GROUP BY 1 ORDER BY avg(absolute_error), Road_traffic_density LIMIT 1""",
)
def arg_min(spark, sf_dir):
    scored = group_test_scored(spark, sf_dir)
    by_traffic = metrics.evaluate(scored, labels.target(), F.col("prediction"), ["Road_traffic_density"])
    known = by_traffic.filter(F.col("long_delivery_MAE").isNotNull())
    return known.orderBy("long_delivery_MAE", "Road_traffic_density").limit(1).select("Road_traffic_density", "long_delivery_MAE")


@register(
    "e12_column_attach",
    f"""SELECT ID, {r('predicted', 'baseline_prediction')}, {r(formula_sql(2.0), 'tail_aware_prediction')},
 {r('predicted - minutes', 'baseline_error')}, {r(formula_sql(2.0) + ' - minutes', 'tail_aware_error')}, is_long AS is_long_delivery FROM scored""",
)
def column_attach(spark, sf_dir):
    both = formula(group_test_scored(spark, sf_dir), 2.0, "tail_prediction")
    return errors.paired_predictions(both, "prediction", "tail_prediction").drop(GROUP_COLUMN, TARGET)

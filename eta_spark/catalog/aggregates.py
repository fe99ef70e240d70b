"""Grouped reports (D)."""

from pyspark.sql import functions as F

from eta_spark.catalog.base import (
    ERROR_SQL,
    FIVE_BANDS,
    GEO_COLUMNS,
    NINE_BANDS,
    NINE_EDGES,
    bands,
    cleaned,
    engineered,
    error_table,
    r,
    register,
)
from eta_spark.catalog.rows import GROUP_CASE
from eta_spark.functions.labels import target
from eta_spark.operators import delays, errors, quality, splits
from eta_spark.schema import COORDINATES, DELAY_FACTORS, DISTANCE_QUANTILES, ERROR_KEYS

MOMENTS = ", ".join(
    [
        "count(*) AS count",
        r("avg(minutes)", "mean"),
        r("median(minutes)", "median"),
        r("stddev_samp(minutes)", "std"),
    ]
)


def _stacked(columns: list[str], table: str, label: str, extra: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS {label}, CAST({c} AS VARCHAR) AS level, {extra} FROM {table}" for c in columns
    )


@register(
    "d01_coordinate_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {r(f'min({c})', 'minimum')}, {r(f'max({c})', 'maximum')}, {r(f'avg({c})', 'mean')},
 count(*) - count({c}) AS missing FROM eng"""
        for c in COORDINATES
    ),
)
def coordinate_profile(spark, sf_dir):
    return quality.coordinate_profile(engineered(spark, sf_dir))


BAD_LAT = "(abs(Restaurant_latitude) > 90 OR abs(Delivery_location_latitude) > 90)"
BAD_LON = "(abs(Restaurant_longitude) > 180 OR abs(Delivery_location_longitude) > 180)"


@register(
    "d02_validity_counts",
    f"""SELECT count(*) FILTER (WHERE {BAD_LAT}) AS invalid_latitude_rows, count(*) FILTER (WHERE {BAD_LON}) AS invalid_longitude_rows,
 count(*) FILTER (WHERE {BAD_LAT} OR {BAD_LON}) AS invalid_coordinate_rows FROM eng""",
)
def validity_counts(spark, sf_dir):
    return quality.validity_counts(engineered(spark, sf_dir))


OVER = ", ".join(f"count(*) FILTER (WHERE distance_km > {t}) AS distance_over_{t}km" for t in (15, 50, 100, 200))


@register(
    "d03_distance_summary",
    f"""SELECT {r('avg(distance_km)', 'mean')}, {r('median(distance_km)', 'median')}, {r('stddev_samp(distance_km)', 'std')},
 {r('min(distance_km)', 'minimum')}, {r('max(distance_km)', 'maximum')}, {OVER} FROM eng""",
)
def distance_summary(spark, sf_dir):
    return quality.distance_summary(engineered(spark, sf_dir))


QUANTILES_SQL = " UNION ALL ".join(
    f"SELECT {p}e0 AS quantile, {r(f'quantile_cont(distance_km, {p})', 'distance_km')} FROM eng" for p in DISTANCE_QUANTILES
)


@register("d04_distance_quantiles", QUANTILES_SQL)
def distance_quantiles(spark, sf_dir):
    return quality.distance_quantiles(engineered(spark, sf_dir))


@register("d04_distance_quantiles_by_narrowing", QUANTILES_SQL)
def narrowed_distance_quantiles(spark, sf_dir):
    """The same by its older name: there is one path, and it narrows."""
    return quality.distance_quantiles(engineered(spark, sf_dir))


@register(
    "d05_delay_by_distance",
    f"""SELECT distance_bucket, {MOMENTS} FROM (
 SELECT {bands('distance_km', [3, 6, 10, 15, None], FIVE_BANDS)} AS distance_bucket, minutes FROM eng)
 WHERE distance_bucket IS NOT NULL GROUP BY 1""",
)
def delay_by_distance(spark, sf_dir):
    return delays.delay_by_distance(engineered(spark, sf_dir)).drop("position")


@register(
    "d06_distance_distribution",
    f""", banded AS (SELECT {bands('distance_km', NINE_EDGES, NINE_BANDS)} AS band, distance_km FROM eng)
 SELECT label AS distance_bucket, count(band) AS orders, {r('avg(distance_km)', 'mean_distance_km')},
 {r('median(distance_km)', 'median_distance_km')}, {r('count(band) * 100e0 / (SELECT count(*) FROM eng)', 'percentage')}
 FROM (SELECT unnest([{', '.join(f"'{x}'" for x in NINE_BANDS)}]) AS label) LEFT JOIN banded ON band = label GROUP BY label""",
)
def distance_distribution(spark, sf_dir):
    return quality.distance_distribution(engineered(spark, sf_dir)).drop("position")


@register(
    "d07_distance_impact",
    f"""SELECT {GROUP_CASE} AS distance_group, count(*) AS orders, {r('avg(distance_km)', 'mean_distance_km')},
 {r('median(distance_km)', 'median_distance_km')}, {r('avg(minutes)', 'mean_delivery_minutes')},
 {r('count(*) * 100e0 / (SELECT count(*) FROM eng)', 'percentage')} FROM eng GROUP BY 1""",
)
def distance_impact(spark, sf_dir):
    return quality.distance_impact(engineered(spark, sf_dir))


GAPS = {
    "latitude_difference": "abs(Restaurant_latitude - Delivery_location_latitude)",
    "longitude_difference": "abs(Restaurant_longitude - Delivery_location_longitude)",
}


@register(
    "d08_coordinate_gap_profile",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS metric, count({g}) AS count, {r(f'avg({g})', 'mean')}, {r(f'stddev_samp({g})', 'std')},
 {r(f'min({g})', 'min')}, {r(f'max({g})', 'max')}, """
        + ", ".join(r(f"quantile_cont({g}, {p / 100})", f"p{p}") for p in (50, 75, 90, 95, 99))
        + " FROM eng"
        for n, g in GAPS.items()
    ),
)
def coordinate_gap_profile(spark, sf_dir):
    return quality.coordinate_gap_profile(engineered(spark, sf_dir))


@register(
    "d09_audit_summary",
    f"""SELECT count(*) AS total_rows, count(*) FILTER (WHERE {BAD_LAT} OR {BAD_LON}) AS invalid_coordinate_rows,
 {r('avg(distance_km)', 'mean_distance_km')}, {r('median(distance_km)', 'median_distance_km')}, {r('max(distance_km)', 'max_distance_km')},
 {OVER}, {r('count(*) FILTER (WHERE distance_km > 50) * 100e0 / count(*)', 'potential_outlier_percentage')} FROM eng""",
)
def audit_summary(spark, sf_dir):
    return quality.audit_summary(engineered(spark, sf_dir, GEO_COLUMNS))


@register(
    "d10_delay_by_factor",
    f"SELECT factor, level, {MOMENTS} FROM ({_stacked(DELAY_FACTORS, 'eng', 'factor', 'minutes')}) GROUP BY 1, 2",
)
def delay_by_factor(spark, sf_dir):
    return delays.delay_by_factor(delays.factor_counts(engineered(spark, sf_dir)))


LONG_RATE = r("avg(CAST(is_long AS INTEGER))", "long_delivery_rate")


@register(
    "d11_overall_long_rate",
    f"SELECT count(*) AS orders, count(*) FILTER (WHERE is_long) AS long_deliveries, {LONG_RATE} FROM flagged",
)
def overall_long_rate(spark, sf_dir):
    return delays.overall_long_rate(engineered(spark, sf_dir))


@register(
    "d12_long_risk_by_factor",
    f"""SELECT factor, level, count(*) AS orders, count(*) FILTER (WHERE is_long) AS long_deliveries, {LONG_RATE}
 FROM ({_stacked(DELAY_FACTORS, 'flagged', 'factor', 'is_long')}) GROUP BY 1, 2""",
)
def long_risk_by_factor(spark, sf_dir):
    return delays.risk_by_factor(delays.factor_counts(engineered(spark, sf_dir)))


@register(
    "d12_long_risk_by_traffic",
    f"""SELECT Road_traffic_density, count(*) AS orders, count(*) FILTER (WHERE is_long) AS long_deliveries, {LONG_RATE}
 FROM flagged GROUP BY 1""",
)
def long_risk_by_traffic(spark, sf_dir):
    return delays.risk_of_factor(engineered(spark, sf_dir), "Road_traffic_density")


@register(
    "d13_peak_hour_report",
    f"""SELECT CAST(is_peak_hour AS BIGINT) AS is_peak_hour, count(*) AS orders, {r('avg(minutes)', 'mean_minutes')},
 {r('median(minutes)', 'median_minutes')}, {LONG_RATE} FROM flagged GROUP BY 1""",
)
def peak_hour_report(spark, sf_dir):
    return delays.peak_hour_report(engineered(spark, sf_dir))


COMPARED = {
    "Rows": "count(*)",
    "Mean distance (km)": "avg(distance_km)",
    "Median distance (km)": "median(distance_km)",
    "95th percentile distance (km)": "quantile_cont(distance_km, 0.95)",
    "99th percentile distance (km)": "quantile_cont(distance_km, 0.99)",
    "Maximum distance (km)": "max(distance_km)",
    "Mean delivery time (min)": "avg(minutes)",
    "Median delivery time (min)": "median(minutes)",
}


@register(
    "d14_cleaning_comparison",
    " UNION ALL ".join(
        f"SELECT '{m}' AS metric, (SELECT {r(x)} FROM eng) AS original, (SELECT {r(x)} FROM clean) AS cleaned"
        for m, x in COMPARED.items()
    ),
)
def cleaning_comparison(spark, sf_dir):
    return quality.cleaning_comparison(engineered(spark, sf_dir))


def _removed(label: str, table: str) -> str:
    return f"""SELECT '{label}' AS "group", count(*) AS n_rows, {r('avg(minutes)', 'mean_delivery_minutes')},
 {r('median(minutes)', 'median_delivery_minutes')} FROM {table}"""


@register(
    "d15_removed_summary",
    " UNION ALL ".join(
        [
            _removed("Original dataset", "marked"),
            _removed("Geographic anomalies", "marked WHERE anomaly"),
            _removed("Cleaned dataset", "clean"),
        ]
    ),
)
def removed_summary(spark, sf_dir):
    return quality.removed_summary(engineered(spark, sf_dir)).withColumnRenamed("rows", "n_rows")


@register(
    "d16_anomaly_counts",
    f"""SELECT count(*) FILTER (WHERE geo_outlier) AS geo_outlier,
 count(*) FILTER (WHERE extreme_latitude_difference) AS extreme_latitude_difference,
 count(*) FILTER (WHERE extreme_longitude_difference) AS extreme_longitude_difference,
 count(*) FILTER (WHERE anomaly) AS combined_anomalies, {r('avg(CAST(anomaly AS INTEGER)) * 100', 'anomaly_rate_pct')} FROM marked""",
)
def anomaly_counts(spark, sf_dir):
    return quality.anomaly_counts(engineered(spark, sf_dir))


MEASURED = "minutes, predicted, absolute_error, error, is_long"


@register(
    "d17_error_by_keys",
    f'SELECT "key", level, {ERROR_SQL} FROM ({_stacked(ERROR_KEYS, "keyed", chr(34) + "key" + chr(34), MEASURED)}) GROUP BY 1, 2',
)
def error_by_keys(spark, sf_dir):
    return errors.error_by_keys(error_table(spark, sf_dir))


@register("d17_error_by_delivery_time", f"SELECT delivery_time_bucket, {ERROR_SQL} FROM keyed GROUP BY 1")
def error_by_delivery_time(spark, sf_dir):
    return errors.summarize_error(error_table(spark, sf_dir), "delivery_time_bucket")


MEAN_ERRORS = ", ".join(
    [
        r("avg(minutes)", "actual_mean"),
        r("avg(predicted)", "predicted_mean"),
        r("avg(absolute_error)", "mae"),
        r("sqrt(avg(error * error))", "rmse"),
        r("avg(error)", "signed_error"),
    ]
)


@register(
    "d18_long_against_normal",
    f"SELECT is_long AS is_long_delivery, count(*) AS orders, {MEAN_ERRORS} FROM keyed GROUP BY 1",
)
def long_against_normal(spark, sf_dir):
    return errors.long_against_normal(error_table(spark, sf_dir))


@register(
    "d19_overall_error",
    f"SELECT {r('avg(absolute_error)', 'mae')}, {r('sqrt(avg(error * error))', 'rmse')}, {r('avg(error)', 'bias')} FROM keyed",
)
def overall_error(spark, sf_dir):
    return errors.overall_error(error_table(spark, sf_dir))


@register(
    "d20_tail_bias",
    f"""SELECT count(*) AS long_orders, {r('avg(minutes)', 'actual_mean')}, {r('avg(predicted)', 'predicted_mean')},
 {r('avg(error)', 'signed_error')}, CASE WHEN avg(error) < 0 THEN 'underpredicts' ELSE 'no underprediction' END AS diagnostic
 FROM keyed WHERE is_long""",
)
def tail_bias(spark, sf_dir):
    return errors.tail_bias(error_table(spark, sf_dir))


@register(
    "d21_high_risk_combinations",
    f"""SELECT Road_traffic_density, {r('multiple_deliveries', 'multiple_deliveries')}, CAST(is_peak_hour AS BIGINT) AS is_peak_hour,
 {ERROR_SQL} FROM keyed GROUP BY Road_traffic_density, keyed.multiple_deliveries, keyed.is_peak_hour""",
)
def high_risk_combinations(spark, sf_dir):
    return errors.high_risk_combinations(error_table(spark, sf_dir))


@register("d22_distinct_riders", "SELECT count(DISTINCT Delivery_person_ID) AS riders FROM clean")
def distinct_riders(spark, sf_dir):
    return splits.distinct_rider_count(cleaned(spark, sf_dir))


@register(
    "d23_target_profile",
    f"""SELECT count(*) AS count, {r('avg(minutes)', 'mean')}, {r('stddev_samp(minutes)', 'std')}, {r('min(minutes)', 'min')},
 {r('quantile_cont(minutes, 0.25)', 'p25')}, {r('quantile_cont(minutes, 0.5)', 'p50')}, {r('quantile_cont(minutes, 0.75)', 'p75')},
 {r('max(minutes)', 'max')}, CAST(26 AS BIGINT) AS columns FROM eng""",
)
def target_profile(spark, sf_dir):
    return quality.target_profile(engineered(spark, sf_dir)).drop("target")


@register("d24_class_balance", "SELECT is_long AS is_long_delivery, count(*) AS n_rows FROM grouped WHERE split = 'train' GROUP BY 1")
def class_balance(spark, sf_dir):
    train, _ = splits.split_tables(splits.group_split(cleaned(spark, sf_dir, GEO_COLUMNS)))
    return splits.class_balance(train).withColumnRenamed("rows", "n_rows")

"""Reports that need no model."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eta_spark.operators import delays, errors, quality
from eta_spark.operators.quality import clean_geography
from eta_spark.schema import DELAY_FACTORS, ERROR_KEYS
from eta_spark.sources.stored import stored


def delay_reports(orders: DataFrame) -> dict[str, DataFrame]:
    """Delivery time and long-delivery risk. One counting pass serves all factor reports."""
    counts = stored(delays.factor_counts(orders), "factor-counts")
    by_factor, risk = delays.delay_by_factor(counts), delays.risk_by_factor(counts)
    reports = {
        "delay_by_distance": delays.delay_by_distance(orders),
        "overall_long_rate": delays.overall_long_rate(orders),
        "peak_hour_analysis": delays.peak_hour_report(orders),
    }
    for factor in DELAY_FACTORS:
        if factor not in orders.columns:
            continue
        for prefix, report, measure in (
            ("delay_by", by_factor, "mean"),
            ("long_delivery_risk", risk, "long_delivery_rate"),
        ):
            chosen = delays.typed_level(report.filter(F.col("factor") == factor), orders, factor)
            reports[f"{prefix}_{factor.lower()}"] = chosen.orderBy(F.desc_nulls_last(measure), factor)
    return reports


def audit_reports(orders: DataFrame) -> dict[str, DataFrame]:
    return {
        "geo_coordinate_ranges": quality.coordinate_profile(orders),
        "geo_coordinate_validity": quality.validity_counts(orders),
        "geo_distance_statistics": quality.distance_summary(orders),
        "geo_distance_quantiles": quality.distance_quantiles(orders),
        "geo_distance_distribution": quality.distance_distribution(orders),
        "geo_extreme_distance_records": quality.farthest_orders(orders),
        "geo_distance_impact": quality.distance_impact(orders),
        "geo_coordinate_difference": quality.coordinate_gap_profile(orders),
        "geo_audit_summary": quality.audit_summary(orders),
    }


def cleaning_reports(orders: DataFrame) -> dict[str, DataFrame]:
    return {
        "geo_anomaly_counts": quality.anomaly_counts(orders),
        "geo_cleaning_candidates": quality.cleaning_candidates(orders),
        "geo_cleaning_comparison": quality.cleaning_comparison(orders),
        "geo_removed_delivery_summary": quality.removed_summary(orders),
    }


# Report names by key.
ERROR_REPORTS = {
    "delivery_time_bucket": "cleaned_group_error_by_delivery_time",
    "Road_traffic_density": "cleaned_group_error_by_traffic",
    "Weatherconditions": "cleaned_group_error_by_weather",
    "multiple_deliveries": "cleaned_group_error_by_multiple_deliveries",
    "Festival": "cleaned_group_error_by_festival",
    "Type_of_vehicle": "cleaned_group_error_by_vehicle",
    "Vehicle_condition": "cleaned_group_error_by_vehicle_condition",
    "distance_bucket": "cleaned_group_error_by_distance",
    "is_peak_hour": "cleaned_group_error_by_peak_hour",
}


def error_reports(predictions: DataFrame, orders: DataFrame, repeat_duplicates: bool = False) -> dict[str, DataFrame]:
    """Where a stored prediction table is wrong.

    Orders that share an ID would pair with every prediction of it, so they are
    refused unless ``repeat_duplicates`` asks for the plain left join.
    """
    joined = errors.attach_bucketed_features(predictions, clean_geography(orders), require_unique=not repeat_duplicates)
    table = errors.with_report_keys(joined)
    by_key = stored(errors.error_by_keys(table), "error-by-keys")
    reports = {
        "overall_error": errors.overall_error(table),
        "long_against_normal_error": errors.long_against_normal(table),
        "long_tail_bias": errors.tail_bias(table),
        "cleaned_group_worst_long_predictions": errors.worst_underpredictions(table),
        "cleaned_group_high_risk_combinations": errors.high_risk_combinations(table),
    }
    for key in ERROR_KEYS:
        chosen = delays.typed_level(by_key.filter(F.col("key") == key), table, key)
        reports[ERROR_REPORTS[key]] = chosen.orderBy(F.desc_nulls_last("mae"), key)
    return reports

"""Delivery time and long-delivery risk by distance band and by factor.

All factors are counted in one scan. The scan reduces the orders to a small
table of (factor, level, minutes, count), from which every report follows, so a
level that holds a third of all orders costs one counter per distinct minute.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eta_spark.functions.bands import DELAY_DISTANCE
from eta_spark.functions.labels import is_long, target
from eta_spark.operators.quantiles import weighted_moments
from eta_spark.schema import DELAY_FACTORS


def factor_counts(orders: DataFrame, factors: list[str] = DELAY_FACTORS) -> DataFrame:
    """(factor, level, minutes) and its order count; factors the table lacks are left out."""
    present = [f for f in factors if f in orders.columns]
    return (
        orders.select(target().alias("minutes"), *[F.col(f).cast("string").alias(f) for f in present])
        .unpivot("minutes", present, "factor", "level")
        .groupBy("factor", "level", "minutes")
        .agg(F.count("*").alias("n"))
    )


def typed_level(report: DataFrame, orders: DataFrame, factor: str) -> DataFrame:
    """The rows of one factor, its levels as a column of the factor's name and own type again.

    Levels travel as text, since factors of several types share a grouping. Numbers, flags and dates
    come back as they were: their text form holds every digit.
    """
    level = F.col("level").cast(orders.schema[factor].dataType).alias(factor)
    names = ("factor", "key", "level")
    return report.select(level, *(c for c in report.columns if c not in names))


def delay_by_factor(counts: DataFrame) -> DataFrame:
    return weighted_moments(counts, ["factor", "level"], "minutes", "n").orderBy(
        "factor", F.desc_nulls_last("mean"), "level"
    )


def _risk() -> tuple[Column, Column]:
    n = F.col("n")
    orders = F.sum(n)
    long_orders = F.sum(F.when(is_long(F.col("minutes")), n).otherwise(0))
    return orders, long_orders


def risk_by_factor(counts: DataFrame) -> DataFrame:
    orders, long_orders = _risk()
    return (
        counts.groupBy("factor", "level")
        .agg(
            orders.alias("orders"),
            long_orders.alias("long_deliveries"),
            (long_orders / orders).alias("long_delivery_rate"),
        )
        .orderBy("factor", F.desc_nulls_last("long_delivery_rate"), "level")
    )


def risk_of_factor(orders: DataFrame, factor: str) -> DataFrame:
    """The risk report of a single factor."""
    report = typed_level(risk_by_factor(factor_counts(orders, [factor])), orders, factor)
    return report.orderBy(F.desc_nulls_last("long_delivery_rate"), factor)


def delay_by_distance(orders: DataFrame) -> DataFrame:
    """Bands that hold orders; orders without a distance are left out."""
    counts = (
        orders.select(
            DELAY_DISTANCE.position(F.col("distance_km")).alias("position"),
            DELAY_DISTANCE.label(F.col("distance_km")).alias("distance_bucket"),
            target().alias("minutes"),
        )
        .filter(F.col("distance_bucket").isNotNull())
        .groupBy("position", "distance_bucket", "minutes")
        .agg(F.count("*").alias("n"))
    )
    return weighted_moments(counts, ["position", "distance_bucket"], "minutes", "n").orderBy("position")


def overall_long_rate(orders: DataFrame) -> DataFrame:
    flag = is_long(target()).cast("int")
    return orders.agg(
        F.count("*").alias("orders"), F.sum(flag).alias("long_deliveries"), F.avg(flag).alias("long_delivery_rate")
    )


def peak_hour_report(orders: DataFrame) -> DataFrame:
    """Time statistics and long rate side by side, from one grouping instead of a self-join."""
    counts = factor_counts(orders, ["is_peak_hour"])
    all_orders, long_orders = _risk()
    rate = (long_orders / all_orders).alias("long_delivery_rate")
    return weighted_moments(counts, ["level"], "minutes", "n", rate).select(
        F.col("level").cast("int").alias("is_peak_hour"),
        F.col("count").alias("orders"),
        F.col("mean").alias("mean_minutes"),
        F.col("median").alias("median_minutes"),
        "long_delivery_rate",
    )

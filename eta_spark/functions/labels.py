"""Labels, weights, errors and the served form of a prediction."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from eta_spark.functions.geography import certain
from eta_spark.schema import LONG_DELIVERY_MINUTES, TARGET


def target() -> Column:
    return F.col(f"`{TARGET}`")


def is_long(minutes: Column) -> Column:
    return certain(minutes >= LONG_DELIVERY_MINUTES)


def tail_weight(minutes: Column, weight: float) -> Column:
    return F.when(is_long(minutes), F.lit(float(weight))).otherwise(F.lit(1.0))


def signed_error(actual: Column, predicted: Column) -> Column:
    return predicted - actual


def served_minutes(prediction: Column) -> Column:
    """Not below zero, two decimals, half to even."""
    floored = F.when(prediction < 0, 0.0).otherwise(prediction)
    return F.bround(floored, 2)

"""Raw orders to engineered orders, for training and for scoring."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eta_spark.functions import parsing as p
from eta_spark.functions.geography import order_distance
from eta_spark.functions.labels import target
from eta_spark.schema import FEATURES, RAW_NUMERIC, TARGET
from eta_spark.sources.deliveries import require_columns


def _numbers(df: DataFrame, columns: list[str], parse) -> dict[str, Column]:
    """Text columns are parsed, columns that are numbers already are only cleared of NaN."""
    parsed = {}
    for name in columns:
        if name in df.columns:
            text = isinstance(df.schema[name].dataType, T.StringType)
            column = F.col(f"`{name}`")
            parsed[name] = parse(column) if text else p.finite(column.cast("double"))
    return parsed


def _with_derived(df: DataFrame, hour) -> DataFrame:
    typed = dict(df.dtypes)["Order_Date"] != "string"
    order_day = F.to_date("Order_Date") if typed else p.day_first_date(F.col("Order_Date"))
    return df.withColumns(
        {
            "distance_km": order_distance(),
            "order_hour": hour(F.col("Time_Orderd")),
            "order_dayofweek": p.day_of_week(order_day),
        }
    ).withColumns(
        {
            "is_peak_hour": p.peak_hour_flag(F.col("order_hour")),
            "is_weekend": p.weekend_flag(F.col("order_dayofweek")),
        }
    )


def valid_target(df: DataFrame) -> DataFrame:
    """Drops missing and non-positive delivery times."""
    return df.filter(target() > 0)


def build_features(raw: DataFrame) -> DataFrame:
    """Training features: lenient numbers and hours, rows without a usable target removed."""
    numbers = raw.withColumns(_numbers(raw, [TARGET, *RAW_NUMERIC], p.lenient_number))
    derived = _with_derived(numbers, p.lenient_hour).withColumn(
        "pickup_delay_min", p.pickup_delay(F.col("Time_Orderd"), F.col("Time_Order_picked"))
    )
    return valid_target(derived)


def serving_features(orders: DataFrame) -> DataFrame:
    """Scoring features beside the other columns: strict numbers and hours, no row removed."""
    require_columns(orders)
    return _with_derived(orders.withColumns(_numbers(orders, RAW_NUMERIC, p.strict_number)), p.strict_hour)


def prepare_features(orders: DataFrame) -> DataFrame:
    """The model inputs only, in model order."""
    return serving_features(orders).select(*FEATURES)

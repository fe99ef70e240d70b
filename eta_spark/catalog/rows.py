"""Projections and scalar functions (B)."""

from pyspark.sql import functions as F

from eta_spark.catalog import base as b
from eta_spark.catalog.base import cleaned, engineered, formula, formula_sql, r, raw, register
from eta_spark.functions import bands, geography, labels, parsing
from eta_spark.operators import quality
from eta_spark.operators.errors import test_predictions, with_errors
from eta_spark.operators.features import build_features, prepare_features
from eta_spark.schema import FEATURES

TEXT_NUMBERS = [
    "Time_taken(min)",
    "Delivery_person_Age",
    "Delivery_person_Ratings",
    "Vehicle_condition",
    "multiple_deliveries",
]


def _parsed_numbers(spark, sf_dir, parse):
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("text")) for c in TEXT_NUMBERS]
    texts = raw(spark, sf_dir).select(F.inline(F.array(*rows)))
    return texts.groupBy("column", "text", parse(F.col("text")).alias("value")).agg(F.count("*").alias("orders"))


def _parsed_numbers_sql(parse) -> str:
    stacked = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", \"{c}\" AS text FROM raw" for c in TEXT_NUMBERS)
    return f"""SELECT "column", text, {r(parse('text'), 'value')}, count(*) AS orders FROM ({stacked}) GROUP BY 1, 2, 3"""


@register("b01_messy_number", _parsed_numbers_sql(b.lenient))
def messy_number(spark, sf_dir):
    return _parsed_numbers(spark, sf_dir, parsing.lenient_number)


@register("b02_strict_number", _parsed_numbers_sql(b.strict))
def strict_number(spark, sf_dir):
    return _parsed_numbers(spark, sf_dir, parsing.strict_number)


@register("b03_great_circle_distance", f"SELECT ID, {r('distance_km', 'distance_km')} FROM eng")
def great_circle_distance(spark, sf_dir):
    return engineered(spark, sf_dir).select("ID", geography.order_distance().alias("distance_km"))


@register(
    "b04_infinite_to_missing",
    "SELECT count(*) AS orders, count(*) FILTER (WHERE minutes % 5 <> 0) AS finite_ratios, "
    + r("sum(1e0 / (minutes % 5)) FILTER (WHERE minutes % 5 <> 0)", "total")
    + " FROM eng",
)
def infinite_to_missing(spark, sf_dir):
    # A zero remainder stands for the infinite values that the rule must remove.
    rest = labels.target() % 5
    ratio = F.when(rest == 0, float("inf")).otherwise(1 / F.nullif(rest, F.lit(0.0)))
    value = parsing.finite(ratio)
    return engineered(spark, sf_dir).agg(
        F.count("*").alias("orders"), F.count(value).alias("finite_ratios"), F.sum(value).alias("total")
    )


def _by_text(spark, sf_dir, column, **parsed):
    return raw(spark, sf_dir).groupBy(column, *[c.alias(n) for n, c in parsed.items()]).agg(F.count("*").alias("orders"))


@register(
    "b05_lenient_hour",
    f"SELECT Time_Orderd, CAST({b.lenient_hour('Time_Orderd')} AS BIGINT) AS order_hour, count(*) AS orders FROM raw GROUP BY 1, 2",
)
def lenient_hour(spark, sf_dir):
    return _by_text(spark, sf_dir, "Time_Orderd", order_hour=parsing.lenient_hour(F.col("Time_Orderd")))


@register(
    "b06_strict_hour",
    f"SELECT Time_Orderd, CAST({b.strict_hour('Time_Orderd')} AS BIGINT) AS order_hour, count(*) AS orders FROM raw GROUP BY 1, 2",
)
def strict_hour(spark, sf_dir):
    return _by_text(spark, sf_dir, "Time_Orderd", order_hour=parsing.strict_hour(F.col("Time_Orderd")))


@register(
    "b07_peak_hour_flag",
    f"SELECT Time_Orderd, CAST({b.peak(b.lenient_hour('Time_Orderd'))} AS BIGINT) AS is_peak_hour, count(*) AS orders FROM raw GROUP BY 1, 2",
)
def peak_hour_flag(spark, sf_dir):
    hour = parsing.lenient_hour(F.col("Time_Orderd"))
    return _by_text(spark, sf_dir, "Time_Orderd", is_peak_hour=parsing.peak_hour_flag(hour))


@register(
    "b08_day_first_date",
    f"SELECT Order_Date, CAST({b.date('Order_Date')} AS VARCHAR) AS order_day, count(*) AS orders FROM raw GROUP BY 1, 2",
)
def day_first_date(spark, sf_dir):
    return _by_text(spark, sf_dir, "Order_Date", order_day=parsing.day_first_date(F.col("Order_Date")))


@register(
    "b09_day_of_week",
    f"SELECT Order_Date, isodow({b.date('Order_Date')}) - 1 AS order_dayofweek, count(*) AS orders FROM raw GROUP BY 1, 2",
)
def day_of_week(spark, sf_dir):
    day = parsing.day_first_date(F.col("Order_Date"))
    return _by_text(spark, sf_dir, "Order_Date", order_dayofweek=parsing.day_of_week(day))


@register(
    "b10_weekend_flag",
    f"SELECT Order_Date, CAST(coalesce(isodow({b.date('Order_Date')}) >= 6, FALSE) AS BIGINT) AS is_weekend, count(*) AS orders FROM raw GROUP BY 1, 2",
)
def weekend_flag(spark, sf_dir):
    day = parsing.day_first_date(F.col("Order_Date"))
    return _by_text(spark, sf_dir, "Order_Date", is_weekend=parsing.weekend_flag(parsing.day_of_week(day)))


@register(
    "b11_date_normalise",
    "SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day, count(*) AS orders FROM orders GROUP BY 1",
)
def date_normalise(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.groupBy(F.to_date("o_orderdate").alias("order_day")).agg(F.count("*").alias("orders"))


@register(
    "b12_pickup_delay",
    f"SELECT Time_Orderd, Time_Order_picked, {r('pickup_delay_min', 'pickup_delay_min')}, count(*) AS orders FROM eng GROUP BY 1, 2, 3",
)
def pickup_delay(spark, sf_dir):
    return (
        engineered(spark, sf_dir)
        .groupBy("Time_Orderd", "Time_Order_picked", "pickup_delay_min")
        .agg(F.count("*").alias("orders"))
    )


@register(
    "b13_long_delivery_label",
    f"SELECT {r('minutes', 'minutes')}, is_long AS is_long_delivery, count(*) AS orders FROM flagged GROUP BY 1, 2",
)
def long_delivery_label(spark, sf_dir):
    minutes = labels.target()
    return (
        engineered(spark, sf_dir)
        .groupBy(minutes.alias("minutes"), labels.is_long(minutes).alias("is_long_delivery"))
        .agg(F.count("*").alias("orders"))
    )


@register(
    "b14_coordinate_gaps",
    f"""SELECT ID, {r('abs(Restaurant_latitude - Delivery_location_latitude)', 'latitude_difference')},
 {r('abs(Restaurant_longitude - Delivery_location_longitude)', 'longitude_difference')} FROM eng""",
)
def coordinate_gaps(spark, sf_dir):
    return engineered(spark, sf_dir).select(
        "ID",
        geography.latitude_gap().alias("latitude_difference"),
        geography.longitude_gap().alias("longitude_difference"),
    )


@register(
    "b15_coordinate_validity",
    """SELECT coalesce(abs(Restaurant_latitude * 5) > 90, FALSE) OR coalesce(abs(Delivery_location_latitude * 5) > 90, FALSE) AS invalid_latitude,
 coalesce(abs(Restaurant_longitude * 2.4e0) > 180, FALSE) OR coalesce(abs(Delivery_location_longitude * 2.4e0) > 180, FALSE) AS invalid_longitude,
 count(*) AS orders FROM eng GROUP BY 1, 2""",
)
def coordinate_validity(spark, sf_dir):
    # The derived coordinates are all valid; stretched ones cross the limits.
    stretched = engineered(spark, sf_dir).withColumns(
        {
            "Restaurant_latitude": F.col("Restaurant_latitude") * 5,
            "Delivery_location_latitude": F.col("Delivery_location_latitude") * 5,
            "Restaurant_longitude": F.col("Restaurant_longitude") * 2.4,
            "Delivery_location_longitude": F.col("Delivery_location_longitude") * 2.4,
        }
    )
    return stretched.groupBy(
        geography.invalid_latitude().alias("invalid_latitude"), geography.invalid_longitude().alias("invalid_longitude")
    ).agg(F.count("*").alias("orders"))


FLAGS = "geo_outlier, extreme_latitude_difference, extreme_longitude_difference"


@register("b16_geo_anomaly_flags", f"SELECT ID, {FLAGS}, anomaly FROM marked")
def geo_anomaly_flags(spark, sf_dir):
    flagged = quality.with_anomaly_flags(engineered(spark, sf_dir))
    return flagged.select("ID", *quality.ANOMALY_COLUMNS, geography.is_anomaly().alias("anomaly"))


def _banded(df, value, label):
    return (
        df.select(value.alias("value"), label.alias("band"))
        .groupBy("band")
        .agg(F.count("*").alias("orders"), F.min("value").alias("lowest"), F.max("value").alias("highest"))
    )


def _banded_sql(value: str, case: str) -> str:
    return f"SELECT {case} AS band, count(*) AS orders, {r(f'min({value})', 'lowest')}, {r(f'max({value})', 'highest')} FROM eng GROUP BY 1"


@register("b17_delay_distance_bands", _banded_sql("distance_km", b.bands("distance_km", [3, 6, 10, 15, None], b.FIVE_BANDS)))
def delay_distance_bands(spark, sf_dir):
    d = F.col("distance_km")
    return _banded(engineered(spark, sf_dir), d, bands.DELAY_DISTANCE.label(d))


@register("b18_audit_distance_bands", _banded_sql("distance_km", b.bands("distance_km", b.NINE_EDGES, b.NINE_BANDS)))
def audit_distance_bands(spark, sf_dir):
    d = F.col("distance_km")
    return _banded(engineered(spark, sf_dir), d, bands.AUDIT_DISTANCE.label(d))


@register("b19_error_distance_bands", _banded_sql("distance_km", b.bands("distance_km", [3, 6, 10, 15, 21], b.FIVE_BANDS)))
def error_distance_bands(spark, sf_dir):
    d = F.col("distance_km")
    return _banded(engineered(spark, sf_dir), d, bands.ERROR_DISTANCE.label(d))


@register("b20_delivery_time_bands", _banded_sql("minutes", b.bands("minutes", [15, 25, 35, 45, None], b.TIME_BANDS)))
def delivery_time_bands(spark, sf_dir):
    minutes = labels.target()
    return _banded(engineered(spark, sf_dir), minutes, bands.DELIVERY_TIME.label(minutes))


GROUP_CASE = "CASE WHEN distance_km <= 15 THEN '0-15 km' WHEN distance_km <= 50 THEN '15-50 km' WHEN distance_km > 50 THEN '>50 km' ELSE 'Unknown' END"


@register("b21_distance_group", _banded_sql("distance_km", GROUP_CASE))
def three_way_group(spark, sf_dir):
    d = F.col("distance_km")
    return _banded(engineered(spark, sf_dir), d, bands.distance_group(d))


@register(
    "b22_error_columns",
    f"SELECT ID, {r('predicted', 'predicted')}, {r('error', 'error')}, {r('absolute_error', 'absolute_error')} FROM scored",
)
def error_columns(spark, sf_dir):
    scored = with_errors(b.group_test_scored(spark, sf_dir))
    return scored.select("ID", "predicted", "error", "absolute_error")


@register(
    "b23_served_prediction",
    f"""SELECT {r('eta', 'predicted_eta_min')}, eta >= 45 AS predicted_long_delivery, count(*) AS orders
 FROM (SELECT round_even(greatest((minutes - 20) * 1.875e0, 0), 2) AS eta FROM eng) GROUP BY 1, 2""",
)
def served_prediction(spark, sf_dir):
    # Eighths of a minute below zero and above 45 reach the clamp, the flag and the even rounding.
    minutes = labels.served_minutes((labels.target() - 20) * 1.875)
    return (
        engineered(spark, sf_dir)
        .groupBy(minutes.alias("predicted_eta_min"), labels.is_long(minutes).alias("predicted_long_delivery"))
        .agg(F.count("*").alias("orders"))
    )


@register(
    "b24_tail_weight",
    f"""SELECT is_long AS is_long_delivery, count(*) AS orders, {r('sum(CASE WHEN minutes >= 45 THEN 2e0 ELSE 1e0 END)', 'total_weight')}
 FROM marked WHERE NOT anomaly GROUP BY 1""",
)
def tail_weight(spark, sf_dir):
    minutes = labels.target()
    return (
        cleaned(spark, sf_dir)
        .groupBy(labels.is_long(minutes).alias("is_long_delivery"))
        .agg(F.count("*").alias("orders"), F.sum(labels.tail_weight(minutes, 2.0)).alias("total_weight"))
    )


@register(
    "b25_dataset_tag",
    f"""SELECT dataset, count(*) AS orders, {r('avg(p - minutes)', 'bias')} FROM (
 SELECT 'Original' AS dataset, minutes, {formula_sql()} AS p FROM eng UNION ALL
 SELECT 'Cleaned', minutes, {formula_sql()} FROM clean) GROUP BY 1""",
)
def dataset_tag(spark, sf_dir):
    original = test_predictions(formula(engineered(spark, sf_dir)), "Original")
    clean = test_predictions(formula(cleaned(spark, sf_dir)), "Cleaned")
    return original.unionByName(clean).groupBy("dataset").agg(F.count("*").alias("orders"), F.avg("error").alias("bias"))


@register(
    "b26_percentage_of_total",
    f"""SELECT {GROUP_CASE} AS distance_group, count(*) AS orders,
 {r('count(*) * 100e0 / (SELECT count(*) FROM eng)', 'percentage')} FROM eng GROUP BY 1""",
)
def percentage_of_total(spark, sf_dir):
    return quality.distance_impact(engineered(spark, sf_dir)).select("distance_group", "orders", "percentage")


@register(
    "b27_build_features",
    f"""SELECT ID, {r('minutes', 'minutes')}, {r('Delivery_person_Age', 'age')}, {r('multiple_deliveries', 'multiple_deliveries')},
 {r('distance_km', 'distance_km')}, CAST(order_hour AS BIGINT) AS order_hour, CAST(is_peak_hour AS BIGINT) AS is_peak_hour,
 order_dayofweek, CAST(is_weekend AS BIGINT) AS is_weekend, {r('pickup_delay_min', 'pickup_delay_min')} FROM eng""",
)
def all_features(spark, sf_dir):
    return build_features(raw(spark, sf_dir)).select(
        "ID",
        labels.target().alias("minutes"),
        F.col("Delivery_person_Age").alias("age"),
        "multiple_deliveries",
        "distance_km",
        "order_hour",
        "is_peak_hour",
        "order_dayofweek",
        "is_weekend",
        "pickup_delay_min",
    )


STRICT = [r(b.strict(c), c) for c in ("Delivery_person_Age", "Delivery_person_Ratings", "Vehicle_condition", "multiple_deliveries")]


@register(
    "b28_prepare_features",
    f"""SELECT {', '.join(STRICT)}, Weatherconditions, Road_traffic_density, Type_of_order, Type_of_vehicle, Festival, City,
 {r(b.DISTANCE, 'distance_km')}, CAST({b.strict_hour('Time_Orderd')} AS BIGINT) AS order_hour,
 CAST({b.peak(b.strict_hour('Time_Orderd'))} AS BIGINT) AS is_peak_hour,
 isodow({b.date('Order_Date')}) - 1 AS order_dayofweek,
 CAST(coalesce(isodow({b.date('Order_Date')}) >= 6, FALSE) AS BIGINT) AS is_weekend FROM raw""",
)
def scoring_features(spark, sf_dir):
    return prepare_features(raw(spark, sf_dir)).select(*FEATURES)

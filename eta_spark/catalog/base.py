"""Registry, shared inputs and the shared SQL of the checks."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eta_spark.operators.errors import attach_features, prediction_table, with_report_keys
from eta_spark.operators.features import build_features
from eta_spark.operators.quality import clean_geography
from eta_spark.operators.splits import group_split, random_split, split_tables
from eta_spark.schema import GROUP_COLUMN, TARGET
from eta_spark.sources.derived import derived_deliveries
from eta_spark.sources.stored import stored_before, stored_once

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Adds a query; ``sql`` may use the common table expressions below."""

    def add(query: Query) -> Query:
        def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(query(spark, sf_dir))

        QUERIES[name] = normalised
        if sql is not None:
            ORACLE[name] = COMMON + sql
        return query

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to four decimals, integers to BIGINT, dates to text: what the SQL side returns."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, 4)
        elif isinstance(f.dataType, T.IntegralType):
            column = column.cast("long")
        elif isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(f.name))
    return df.select(*columns)


def r(expression: str, name: str | None = None) -> str:
    """SQL twin of the rounding; adding zero turns -0.0 into 0.0."""
    alias = f" AS {name}" if name else ""
    return f"round(CAST({expression} AS DOUBLE), 4) + 0.0{alias}"


# --- shared inputs --------------------------------------------------------------------------------


#: What cleaning, target and rider ask for.
GEO_COLUMNS = [
    "Restaurant_latitude",
    "Restaurant_longitude",
    "Delivery_location_latitude",
    "Delivery_location_longitude",
    "distance_km",
    TARGET,
    GROUP_COLUMN,
]
#: With what the formula and the prediction tables ask for.
SCORED_COLUMNS = [*GEO_COLUMNS, "ID", "Order_Date", "Road_traffic_density", "multiple_deliveries"]
#: With what the error reports ask for.
KEYED_COLUMNS = [
    *SCORED_COLUMNS,
    "Weatherconditions",
    "Vehicle_condition",
    "Type_of_vehicle",
    "Festival",
    "City",
    "order_hour",
    "is_peak_hour",
]


def raw(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Raw orders derived from the given tables; with ``columns`` no others are built and stored."""
    return stored_once(spark, "deliveries", sf_dir, lambda: derived_deliveries(spark, sf_dir), columns)


def engineered(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Orders with features. Reports share this table and read only the columns they need.

    Raw orders are derived on the way unless they are stored already. With ``columns`` no others are parsed and stored.
    """

    def build() -> DataFrame:
        return build_features(stored_before(spark, "deliveries", sf_dir, lambda: derived_deliveries(spark, sf_dir)))

    return stored_once(spark, "engineered", sf_dir, build, columns)


def cleaned(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    return clean_geography(engineered(spark, sf_dir, columns))


def formula(orders: DataFrame, lift: float = 0.0, output: str = "prediction") -> DataFrame:
    """A fixed arithmetic stand-in for a model, so that SQL can reproduce every figure.

    ``lift`` raises the estimate of orders with several deliveries under jam traffic.
    """
    traffic = F.col("Road_traffic_density")
    deliveries = F.coalesce(F.col("multiple_deliveries").cast("double"), F.lit(1.0))
    minutes = (
        14
        + 0.4 * F.least(F.coalesce(F.col("distance_km"), F.lit(10.0)), F.lit(25.0))
        + F.when(traffic == "Low", 0.0)
        .when(traffic == "Medium", 3.0)
        .when(traffic == "High", 6.0)
        .when(traffic == "Jam", 9.0)
        .otherwise(4.0)
        + 4.0 * deliveries
    )
    raised = F.when((traffic == "Jam") & (deliveries >= 2), F.lit(float(lift))).otherwise(0.0)
    return orders.withColumn(output, minutes + raised)


def group_test_scored(spark: SparkSession, sf_dir: str, columns: list[str] = SCORED_COLUMNS) -> DataFrame:
    """Unseen-rider test orders with the formula's estimate."""
    _, test = split_tables(group_split(cleaned(spark, sf_dir, columns)))
    return formula(test)


def random_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_tables(random_split(cleaned(spark, sf_dir)))[1]


def error_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with features and report keys, through the prediction table and a join on ID."""
    predictions = prediction_table(group_test_scored(spark, sf_dir, KEYED_COLUMNS))
    return with_report_keys(attach_features(predictions, cleaned(spark, sf_dir, KEYED_COLUMNS)))


# --- shared SQL -----------------------------------------------------------------------------------


def formula_sql(lift: float = 0.0) -> str:
    return f"""(14 + 0.4e0 * least(coalesce(distance_km, 10e0), 25e0)
 + CASE Road_traffic_density WHEN 'Low' THEN 0e0 WHEN 'Medium' THEN 3e0 WHEN 'High' THEN 6e0 WHEN 'Jam' THEN 9e0 ELSE 4e0 END
 + 4e0 * coalesce(CAST(multiple_deliveries AS DOUBLE), 1e0)
 + CASE WHEN Road_traffic_density = 'Jam' AND coalesce(CAST(multiple_deliveries AS DOUBLE), 1e0) >= 2 THEN {lift}e0 ELSE 0e0 END)"""


def lenient(column: str) -> str:
    return f"TRY_CAST(regexp_extract({column}, '-?[0-9]+(?:[.][0-9]+)?') AS DOUBLE)"


def strict(column: str) -> str:
    return (
        f"CASE WHEN regexp_matches(trim({column}), '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') "
        f"THEN TRY_CAST(trim({column}) AS DOUBLE) END"
    )


def lenient_hour(column: str) -> str:
    digits = f"TRY_CAST(regexp_extract({column}, '([0-9]{{1,2}})', 1) AS INTEGER)"
    return f"CASE WHEN {digits} <= 23 THEN {digits} END"


def clock(column: str) -> str:
    """Minute of day of an exact H:M text."""
    part = "TRY_CAST(regexp_extract(trim({0}), '^([0-9]{{1,2}}):([0-9]{{1,2}})$', {1}) AS INTEGER)"
    hour, minute = part.format(column, 1), part.format(column, 2)
    return f"CASE WHEN {hour} <= 23 AND {minute} <= 59 THEN {hour} * 60 + {minute} END"


def strict_hour(column: str) -> str:
    return f"CAST(floor(({clock(column)}) / 60) AS INTEGER)"


def peak(hour: str) -> str:
    return f"CAST(coalesce(({hour}) IN (12, 13, 14, 19, 20, 21, 22), FALSE) AS INTEGER)"


def date(column: str) -> str:
    return f"CAST(try_strptime(trim({column}), '%d-%m-%Y') AS DATE)"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    lat = f"sin((radians({lat2}) - radians({lat1})) / 2)"
    lon = f"sin((radians({lon2}) - radians({lon1})) / 2)"
    chord = f"({lat} * {lat} + cos(radians({lat1})) * cos(radians({lat2})) * {lon} * {lon})"
    clipped = f"CASE WHEN {chord} > 1 THEN 1e0 WHEN {chord} < 0 THEN 0e0 ELSE {chord} END"
    return f"2 * 6371e0 * asin(sqrt({clipped}))"


DISTANCE = haversine(
    "Restaurant_latitude", "Restaurant_longitude", "Delivery_location_latitude", "Delivery_location_longitude"
)


def bands(value: str, edges: list, labels: list[str]) -> str:
    """CASE over right-closed ranges; a final None edge is open."""
    cases = " ".join(
        f"WHEN {value} <= {e} THEN '{x}'" if e is not None else f"WHEN {value} IS NOT NULL THEN '{x}'"
        for e, x in zip(edges, labels)
    )
    return f"CASE {cases} END"


FIVE_BANDS = ["<=3 km", "3-6 km", "6-10 km", "10-15 km", ">15 km"]
NINE_BANDS = [
    "<=3 km",
    "3-6 km",
    "6-10 km",
    "10-15 km",
    "15-25 km",
    "25-50 km",
    "50-100 km",
    "100-200 km",
    ">200 km",
]
NINE_EDGES = [3, 6, 10, 15, 25, 50, 100, 200, None]
TIME_BANDS = ["<=15", "16-25", "26-35", "36-45", ">45"]

RAW_SQL = """
raw_keys AS (
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, o_orderdate, o_orderpriority, c_mktsegment,
  (l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7 + l_suppkey * 13) AS h
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
raw AS (
SELECT
 CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR)||'-'||CAST(l_partkey AS VARCHAR)||'-'||CAST(l_suppkey AS VARCHAR) AS ID,
 CASE WHEN h%97=0 THEN NULL ELSE 'RIDER'||CAST(l_suppkey AS VARCHAR) END AS Delivery_person_ID,
 CASE WHEN h%41=0 THEN 'NaN ' ELSE CAST(20+l_suppkey%20 AS VARCHAR) END AS Delivery_person_Age,
 CASE WHEN h%43=0 THEN 'NaN ' ELSE '4.'||CAST(l_suppkey%10 AS VARCHAR) END AS Delivery_person_Ratings,
 CAST(1200+(l_suppkey%50)*20 AS DOUBLE)/100 AS Restaurant_latitude,
 CAST(7200+(l_suppkey%40)*20 AS DOUBLE)/100 AS Restaurant_longitude,
 CASE WHEN h%89=0 THEN NULL WHEN h%101=0 THEN CAST(0 AS DOUBLE) ELSE CAST(1200+(l_suppkey%50)*20+l_partkey%14 AS DOUBLE)/100 END AS Delivery_location_latitude,
 CASE WHEN h%101=0 THEN CAST(0 AS DOUBLE) ELSE CAST(7200+(l_suppkey%40)*20+l_partkey%14 AS DOUBLE)/100 END AS Delivery_location_longitude,
 CASE WHEN h%53=0 THEN NULL ELSE lpad(CAST(day(o_orderdate) AS VARCHAR),2,'0')||'-'||lpad(CAST(month(o_orderdate) AS VARCHAR),2,'0')||'-'||CAST(year(o_orderdate) AS VARCHAR) END AS Order_Date,
 CASE WHEN h%61=0 THEN 'NaN ' ELSE lpad(CAST(h%24 AS VARCHAR),2,'0')||':'||lpad(CAST((h%12)*5 AS VARCHAR),2,'0')||CASE WHEN h%59=0 THEN ':00' ELSE '' END END AS Time_Orderd,
 lpad(CAST(CAST(floor((((h%24)*60+(h%12)*5+5+5*(h%3))%1440)/60) AS INT) AS VARCHAR),2,'0')||':'||lpad(CAST(((h%12)*5+5+5*(h%3))%60 AS VARCHAR),2,'0') AS Time_Order_picked,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'Stormy' WHEN '2-HIGH' THEN 'Fog' WHEN '3-MEDIUM' THEN 'Cloudy' WHEN '5-LOW' THEN 'Sunny' ELSE NULL END AS Weatherconditions,
 CASE h%4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' ELSE 'Jam' END AS Road_traffic_density,
 CAST(l_partkey%3 AS VARCHAR) AS Vehicle_condition,
 CASE l_linenumber%4 WHEN 0 THEN 'Meal' WHEN 1 THEN 'Snack' WHEN 2 THEN 'Drinks' ELSE 'Buffet' END AS Type_of_order,
 CASE l_suppkey%3 WHEN 0 THEN 'motorcycle' WHEN 1 THEN 'scooter' ELSE 'electric_scooter' END AS Type_of_vehicle,
 CASE WHEN h%37=0 THEN 'NaN ' ELSE CAST(l_linenumber%4 AS VARCHAR) END AS multiple_deliveries,
 CASE WHEN h%50=0 THEN 'Yes' ELSE 'No' END AS Festival,
 CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY','FURNITURE') THEN 'Metropolitian' WHEN c_mktsegment='HOUSEHOLD' THEN 'Urban' ELSE 'Semi-Urban' END AS City,
 CASE WHEN h%211=0 THEN NULL WHEN h%223=0 THEN '(min) 0' ELSE '(min) '||CAST(10+l_partkey%14+(h%4)*3+(l_linenumber%4)*4+CAST(l_quantity AS INT)%7 AS VARCHAR) END AS "Time_taken(min)"
FROM raw_keys)"""

COMMON = f"""WITH {RAW_SQL},
eng AS (
 SELECT ID, Delivery_person_ID,
  {lenient('Delivery_person_Age')} AS Delivery_person_Age,
  {lenient('Delivery_person_Ratings')} AS Delivery_person_Ratings,
  Restaurant_latitude, Restaurant_longitude, Delivery_location_latitude, Delivery_location_longitude,
  Order_Date, Time_Orderd, Time_Order_picked, Weatherconditions, Road_traffic_density,
  {lenient('Vehicle_condition')} AS Vehicle_condition, Type_of_order, Type_of_vehicle,
  {lenient('multiple_deliveries')} AS multiple_deliveries, Festival, City,
  {lenient('"Time_taken(min)"')} AS minutes,
  {DISTANCE} AS distance_km,
  {lenient_hour('Time_Orderd')} AS order_hour,
  {peak(lenient_hour('Time_Orderd'))} AS is_peak_hour,
  {date('Order_Date')} AS order_day,
  isodow({date('Order_Date')}) - 1 AS order_dayofweek,
  CAST(coalesce(isodow({date('Order_Date')}) >= 6, FALSE) AS INTEGER) AS is_weekend,
  CASE WHEN {clock('Time_Order_picked')} - {clock('Time_Orderd')} < 0
   THEN {clock('Time_Order_picked')} - {clock('Time_Orderd')} + 1440
   ELSE {clock('Time_Order_picked')} - {clock('Time_Orderd')} END AS pickup_delay_min
 FROM raw WHERE {lenient('"Time_taken(min)"')} > 0),
flagged AS (
 SELECT *, coalesce(distance_km > 50, FALSE) AS geo_outlier,
  coalesce(abs(Restaurant_latitude - Delivery_location_latitude) > 5, FALSE) AS extreme_latitude_difference,
  coalesce(abs(Restaurant_longitude - Delivery_location_longitude) > 5, FALSE) AS extreme_longitude_difference,
  coalesce(minutes >= 45, FALSE) AS is_long
 FROM eng),
marked AS (SELECT *, geo_outlier OR extreme_latitude_difference OR extreme_longitude_difference AS anomaly FROM flagged),
clean AS (SELECT * FROM marked WHERE NOT anomaly),
rnd AS (SELECT *, CASE WHEN substr(md5('42:'||ID), 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split FROM clean),
days AS (
 SELECT order_day, row_number() OVER (ORDER BY order_day) AS pos, count(*) OVER () AS n
 FROM (SELECT DISTINCT order_day FROM clean WHERE order_day IS NOT NULL)),
temporal AS (
 SELECT clean.*, CASE WHEN pos <= floor(n * 0.8e0) THEN 'train' ELSE 'test' END AS split
 FROM clean JOIN days USING (order_day)),
riders AS (
 SELECT Delivery_person_ID, row_number() OVER (ORDER BY md5('42:'||Delivery_person_ID)) AS pos, count(*) OVER () AS n
 FROM (SELECT DISTINCT Delivery_person_ID FROM clean WHERE Delivery_person_ID IS NOT NULL)),
grouped AS (
 SELECT clean.*, CASE WHEN pos <= floor(n * 0.8e0) THEN 'train' ELSE 'test' END AS split
 FROM clean JOIN riders USING (Delivery_person_ID)),
scored AS (
 SELECT *, predicted - minutes AS error, abs(predicted - minutes) AS absolute_error
 FROM (SELECT *, {formula_sql()} AS predicted FROM grouped WHERE split = 'test')),
keyed AS (
 SELECT s.ID, s.Delivery_person_ID, s.minutes, s.predicted, s.error, s.absolute_error, s.is_long,
  c.Weatherconditions, c.Road_traffic_density, c.Vehicle_condition, c.Type_of_vehicle, c.multiple_deliveries,
  c.Festival, c.City, c.distance_km, c.order_hour, c.is_peak_hour,
  {bands('s.minutes', [15, 25, 35, 45, None], TIME_BANDS)} AS delivery_time_bucket,
  {bands('c.distance_km', [3, 6, 10, 15, 21], FIVE_BANDS)} AS distance_bucket
 FROM scored s LEFT JOIN clean c ON s.ID = c.ID)
"""


def metrics_sql(actual: str = "minutes", predicted: str = "predicted") -> str:
    """Select list of the overall and tail measures."""
    e = f"({predicted} - {actual})"
    long = f"{actual} >= 45"
    return ", ".join(
        [
            r(f"avg(abs({e}))", "MAE"),
            r(f"sqrt(avg({e} * {e}))", "RMSE"),
            r(f"1 - sum({e} * {e}) / (var_pop({actual}) * count({actual}))", "R2"),
            r(f"avg({e})", "overall_signed_error"),
            f"count(*) FILTER (WHERE {long}) AS long_delivery_count",
            r(f"avg(abs({e})) FILTER (WHERE {long})", "long_delivery_MAE"),
            r(f"sqrt(avg({e} * {e}) FILTER (WHERE {long}))", "long_delivery_RMSE"),
            r(f"avg({e}) FILTER (WHERE {long})", "long_delivery_signed_error"),
        ]
    )


ERROR_SQL = ", ".join(
    [
        "count(*) AS orders",
        r("avg(minutes)", "actual_mean"),
        r("avg(predicted)", "predicted_mean"),
        r("avg(absolute_error)", "mae"),
        r("avg(error)", "signed_error"),
        r("avg(CAST(is_long AS INTEGER))", "long_delivery_rate"),
    ]
)

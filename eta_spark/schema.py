"""Column contract, thresholds and table schemas."""

from pyspark.sql import types as T

# Names, spellings and limits of the delivery data contract.
TARGET = "Time_taken(min)"
GROUP_COLUMN = "Delivery_person_ID"

COORDINATES = [
    "Restaurant_latitude",
    "Delivery_location_latitude",
    "Restaurant_longitude",
    "Delivery_location_longitude",
]
RAW_NUMERIC = [
    "Delivery_person_Age",
    "Delivery_person_Ratings",
    "Restaurant_latitude",
    "Restaurant_longitude",
    "Delivery_location_latitude",
    "Delivery_location_longitude",
    "Vehicle_condition",
    "multiple_deliveries",
]
CATEGORICAL_FEATURES = [
    "Weatherconditions",
    "Road_traffic_density",
    "Type_of_order",
    "Type_of_vehicle",
    "Festival",
    "City",
]
NUMERIC_FEATURES = [
    "Delivery_person_Age",
    "Delivery_person_Ratings",
    "Vehicle_condition",
    "multiple_deliveries",
    "distance_km",
    "order_hour",
    "is_peak_hour",
    "order_dayofweek",
    "is_weekend",
]
FEATURES = [
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
REQUIRED_AT_SCORING = [
    "Delivery_person_Age",
    "Delivery_person_Ratings",
    "Restaurant_latitude",
    "Restaurant_longitude",
    "Delivery_location_latitude",
    "Delivery_location_longitude",
    "Order_Date",
    "Time_Orderd",
    "Weatherconditions",
    "Road_traffic_density",
    "Vehicle_condition",
    "Type_of_order",
    "Type_of_vehicle",
    "multiple_deliveries",
    "Festival",
    "City",
]
DELAY_FACTORS = [
    "Road_traffic_density",
    "Weatherconditions",
    "Type_of_vehicle",
    "Vehicle_condition",
    "multiple_deliveries",
    "Festival",
    "City",
    "is_peak_hour",
]
ERROR_KEYS = [
    "delivery_time_bucket",
    "Road_traffic_density",
    "Weatherconditions",
    "multiple_deliveries",
    "Festival",
    "Type_of_vehicle",
    "Vehicle_condition",
    "distance_bucket",
    "is_peak_hour",
]

LONG_DELIVERY_MINUTES = 45
PEAK_HOURS = [12, 13, 14, 19, 20, 21, 22]
EARTH_RADIUS_KM = 6371.0
MAX_DISTANCE_KM = 50
MAX_COORDINATE_GAP_DEG = 5
TRAIN_SHARE = 0.8
SPLIT_SEED = 42
TAIL_WEIGHT = 2.0
SWEEP_WEIGHTS = [1.0, 1.25, 1.5, 1.75, 2.0, 2.5, 3.0]
MAE_TOLERANCE = 1.01
DISTANCE_QUANTILES = [0.50, 0.75, 0.90, 0.95, 0.99, 0.995, 0.999]
CLEANING_RULE = "distance<=50km and coordinate differences<=5deg"


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_S, _D, _B = T.StringType(), T.DoubleType(), T.BooleanType()

# Every raw column is read as text: the files mix numbers with markers such as "NaN ".
RAW_SCHEMA = _table(
    ("ID", _S),
    (GROUP_COLUMN, _S),
    ("Delivery_person_Age", _S),
    ("Delivery_person_Ratings", _S),
    ("Restaurant_latitude", _S),
    ("Restaurant_longitude", _S),
    ("Delivery_location_latitude", _S),
    ("Delivery_location_longitude", _S),
    ("Order_Date", _S),
    ("Time_Orderd", _S),
    ("Time_Order_picked", _S),
    ("Weatherconditions", _S),
    ("Road_traffic_density", _S),
    ("Vehicle_condition", _S),
    ("Type_of_order", _S),
    ("Type_of_vehicle", _S),
    ("multiple_deliveries", _S),
    ("Festival", _S),
    ("City", _S),
    (TARGET, _S),
)

PREDICTION_SCHEMA = _table(
    ("ID", _S),
    (GROUP_COLUMN, _S),
    ("Order_Date", _S),
    (TARGET, _D),
    ("predicted", _D),
    ("error", _D),
    ("absolute_error", _D),
    ("is_long_delivery", _B),
)

SCENARIO_RESULT_SCHEMA = _table(
    ("scenario", _S),
    ("description", _S),
    ("Road_traffic_density", _S),
    ("Weatherconditions", _S),
    ("multiple_deliveries", _D),
    ("Festival", _S),
    ("distance_km", _D),
    ("predicted_eta_min", _D),
    ("predicted_long_delivery", _B),
    ("eta_change_vs_baseline", _D),
)

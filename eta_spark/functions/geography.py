"""Great-circle distance and coordinate quality flags. Flags are never NULL."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from eta_spark.schema import EARTH_RADIUS_KM, MAX_COORDINATE_GAP_DEG, MAX_DISTANCE_KM


def certain(condition: Column) -> Column:
    """An unknown comparison counts as false."""
    return F.coalesce(condition, F.lit(False))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance; a missing or infinite coordinate gives a missing distance."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = F.pow(half_lat, 2) + F.cos(phi1) * F.cos(phi2) * F.pow(half_lon, 2)
    # least/greatest skip NULL and would turn a missing distance into 0 km, hence the
    # condition: NULL, NaN and the infinities are all not below infinity.
    usable = reduce(lambda a, b: a & b, [F.abs(c) < float("inf") for c in (lat1, lon1, lat2, lon2)])
    clipped = F.least(F.greatest(chord, F.lit(0.0)), F.lit(1.0))
    return F.when(usable, 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(clipped)))


def order_distance() -> Column:
    return great_circle_km(
        F.col("Restaurant_latitude"),
        F.col("Restaurant_longitude"),
        F.col("Delivery_location_latitude"),
        F.col("Delivery_location_longitude"),
    )


def latitude_gap() -> Column:
    return F.abs(F.col("Restaurant_latitude") - F.col("Delivery_location_latitude"))


def longitude_gap() -> Column:
    return F.abs(F.col("Restaurant_longitude") - F.col("Delivery_location_longitude"))


def invalid_latitude() -> Column:
    return certain(F.abs("Restaurant_latitude") > 90) | certain(F.abs("Delivery_location_latitude") > 90)


def invalid_longitude() -> Column:
    return certain(F.abs("Restaurant_longitude") > 180) | certain(F.abs("Delivery_location_longitude") > 180)


def farther_than(km: float) -> Column:
    return certain(F.col("distance_km") > km)


def anomaly_flags() -> dict[str, Column]:
    return {
        "geo_outlier": farther_than(MAX_DISTANCE_KM),
        "extreme_latitude_difference": certain(latitude_gap() > MAX_COORDINATE_GAP_DEG),
        "extreme_longitude_difference": certain(longitude_gap() > MAX_COORDINATE_GAP_DEG),
    }


def is_anomaly() -> Column:
    return reduce(lambda a, b: a | b, anomaly_flags().values())

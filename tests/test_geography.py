import math

import pytest
from pyspark.sql import functions as F

from eta_spark.functions import bands, geography, labels
from eta_spark.operators import quality

COLUMNS = "ID string, Restaurant_latitude double, Restaurant_longitude double, Delivery_location_latitude double, Delivery_location_longitude double"


def located(spark, *rows):
    table = spark.createDataFrame([(str(i), *row) for i, row in enumerate(rows)], COLUMNS)
    return table.withColumn("distance_km", geography.order_distance())


@pytest.mark.parametrize(
    ("to", "km"),
    [
        ((22.5958, 88.4000), 4.515723143882102),
        ((22.5800, 88.3750), 1.4056821719495336),
        ((22.7000, 88.5000), 19.894281236520936),
    ],
)
def test_published_distances(spark, to, km):
    assert located(spark, (22.5726, 88.3639, *to)).first().distance_km == pytest.approx(km, rel=1e-14)


def test_antipodes_and_missing(spark):
    rows = located(
        spark, (0.0, 0.0, 0.0, 180.0), (None, 0.0, 0.0, 1.0), (math.nan, 0.0, 0.0, 1.0), (math.inf, 0.0, 0.0, 1.0)
    ).orderBy("ID").collect()
    assert rows[0].distance_km == pytest.approx(math.pi * 6371.0)
    assert [r.distance_km for r in rows[1:]] == [None, None, None]


def test_cleaning_keeps_unknown_distance(spark):
    table = located(
        spark,
        (22.0, 88.0, 22.1, 88.1),
        (22.0, 88.0, None, 88.1),
        (22.0, 88.0, 0.0, 0.0),
        (22.0, 88.0, None, 95.0),
    )
    assert sorted(r.ID for r in quality.clean_geography(table).collect()) == ["0", "1"]
    assert sorted(r.ID for r in quality.removed_by_cleaning(table).collect()) == ["2", "3"]


def banded(spark, label, values):
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    return [r.b for r in table.select("i", label(F.col("v")).alias("b")).orderBy("i").collect()]


def test_bands_close_on_the_right(spark):
    assert banded(spark, bands.DELAY_DISTANCE.label, [3.0, 3.1, 15.0, 15.1, None]) == [
        "<=3 km",
        "3-6 km",
        "10-15 km",
        ">15 km",
        None,
    ]
    assert banded(spark, bands.AUDIT_DISTANCE.label, [50.0, 50.1, 201.0]) == ["25-50 km", "50-100 km", ">200 km"]
    assert banded(spark, bands.ERROR_DISTANCE.label, [0.0, 21.0, 21.1, 30.0, -1.0]) == ["<=3 km", ">15 km", None, None, None]
    assert banded(spark, bands.DELIVERY_TIME.label, [0.0, 15.0, 45.0, 45.5]) == ["<=15", "<=15", "36-45", ">45"]
    assert banded(spark, bands.distance_group, [15.0, 50.0, 50.1, None]) == ["0-15 km", "15-50 km", ">50 km", "Unknown"]


def test_exactly_fifty_kilometres_is_no_outlier(spark):
    table = spark.createDataFrame([(50.0,), (50.01,), (None,)], "distance_km double")
    assert [r[0] for r in table.select(geography.farther_than(50)).collect()] == [False, True, False]


def test_served_minutes_and_flags(spark):
    table = spark.createDataFrame([(0, -1.0), (1, 44.994), (2, 0.125), (3, 44.996), (4, None)], "i int, p double")
    minutes = labels.served_minutes(F.col("p"))
    rows = table.orderBy("i").select(minutes.alias("m"), labels.is_long(minutes).alias("f")).collect()
    assert [tuple(r) for r in rows] == [(0.0, False), (44.99, False), (0.12, False), (45.0, True), (None, False)]


def test_empty_bands_are_reported(orders):
    rows = quality.distance_distribution(orders).collect()
    assert [r.distance_bucket for r in rows] == list(bands.AUDIT_DISTANCE.labels)
    empty = [r for r in rows if r.orders == 0]
    assert empty and all(r.mean_distance_km is None and r.percentage == 0 for r in empty)
    known = orders.filter("distance_km is not null").count()
    assert sum(r.percentage for r in rows) == pytest.approx(100 * known / orders.count())


def test_removed_summary_is_empty_without_anomalies(orders):
    assert quality.removed_summary(quality.clean_geography(orders)).isEmpty()

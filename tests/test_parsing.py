"""Edge rows of the text rules."""

import datetime

import pytest
from pyspark.sql import functions as F

from eta_spark.functions import parsing


def values(spark, texts, parse):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [row.v for row in table.select("i", parse(F.col("t")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("parse", "cases"),
    [
        (
            parsing.lenient_number,
            {"(min) 24": 24.0, "-3.5x": -3.5, "1,234": 1.0, "12.": 12.0, "NaN ": None, "abc": None, "": None, None: None},
        ),
        (
            parsing.strict_number,
            {"(min) 24": None, " 4.7 ": 4.7, "\t5\n": 5.0, "1e2": 100.0, "NaN": None, "inf": None, "1.0d": None, ".5": 0.5, "": None},
        ),
        (
            parsing.lenient_hour,
            {"11:30": 11, "11:30:00": 11, "11:30 PM": 11, "9:30": 9, " 23:05 ": 23, "25:00": None, "24:10": None, "0.458333": 0, "NaN ": None, None: None},
        ),
        (
            parsing.strict_hour,
            {"11:30": 11, "11:30:00": None, "11:30 PM": None, "9:30": 9, " 23:05 ": 23, "25:00": None, "12:60": None, "0.458333": None, "7:5": 7, None: None},
        ),
        (
            parsing.day_first_date,
            {
                "19-03-2022": datetime.date(2022, 3, 19),
                "9-3-2022": datetime.date(2022, 3, 9),
                " 10-03-2022 ": datetime.date(2022, 3, 10),
                "31-02-2022": None,
                "NaN ": None,
                None: None,
            },
        ),
    ],
)
def test_texts(spark, parse, cases):
    assert dict(zip(cases, values(spark, list(cases), parse))) == cases


def test_calendar_flags(spark):
    texts = ["19-03-2022", "21-03-2022", "31-02-2022"]
    weekday = lambda c: parsing.day_of_week(parsing.day_first_date(c))
    assert values(spark, texts, weekday) == [5, 0, None]
    assert values(spark, texts, lambda c: parsing.weekend_flag(weekday(c))) == [1, 0, 0]


def test_peak_flag_of_missing_hour_is_zero(spark):
    flag = lambda c: parsing.peak_hour_flag(parsing.lenient_hour(c))
    assert values(spark, ["12:10", "15:00", "22:59", "NaN ", None], flag) == [1, 0, 1, 0, 0]


def test_pickup_delay_wraps_over_midnight(spark):
    table = spark.createDataFrame(
        [("23:55", "00:10"), ("11:30", "11:45"), ("11:30:00", "11:45"), ("10:00", None), ("08:00", "08:00")], "o string, p string"
    )
    delays = [r[0] for r in table.select(parsing.pickup_delay(F.col("o"), F.col("p"))).collect()]
    assert delays == [15.0, 15.0, None, None, 0.0]

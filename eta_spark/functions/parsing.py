"""Text to number, time and date. All expressions yield NULL, never NaN, for bad input."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from eta_spark.schema import PEAK_HOURS

# Accepted text forms.
FIRST_NUMBER = r"-?[0-9]+(?:[.][0-9]+)?"
WHOLE_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
FIRST_TWO_DIGITS = r"([0-9]{1,2})"
HOUR_MINUTE = r"^([01]?[0-9]|2[0-3]):[0-5]?[0-9]$"
DAY_FIRST, YEAR_FIRST = "d-M-yyyy", "yyyy-M-d"
WHITESPACE = " \t\r\n\f\u000b"

MINUTES_PER_DAY = 24 * 60


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def finite(number: Column) -> Column:
    """NaN and the infinities become NULL."""
    return F.when(F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)


def lenient_number(text: Column) -> Column:
    """First number found anywhere in the text: '(min) 24' is 24."""
    return F.regexp_extract(text, FIRST_NUMBER, 0).try_cast("double")


def strict_number(text: Column) -> Column:
    """The whole text must be a number: '(min) 24' is missing."""
    bare = strip(text)
    return F.when(bare.rlike(WHOLE_NUMBER), bare.try_cast("double"))


def lenient_hour(text: Column) -> Column:
    """First one- or two-digit run, kept when it is an hour. AM/PM is not read."""
    hour = F.regexp_extract(text, FIRST_TWO_DIGITS, 1).try_cast("int")
    return F.when(hour <= 23, hour)


def _valid_clock(bare: Column) -> Column:
    return bare.rlike(HOUR_MINUTE)


def strict_hour(text: Column) -> Column:
    """Hour of an exact H:M text; seconds or AM/PM make it missing."""
    bare = strip(text)
    return F.when(_valid_clock(bare), F.substring_index(bare, ":", 1).try_cast("int"))


def minute_of_day(text: Column) -> Column:
    bare = strip(text)
    hour = F.substring_index(bare, ":", 1).try_cast("int")
    minute = F.substring_index(bare, ":", -1).try_cast("int")
    return F.when(_valid_clock(bare), hour * 60 + minute)


def pickup_delay(ordered: Column, picked: Column) -> Column:
    """Minutes from order to pickup, wrapping over midnight."""
    return F.pmod(minute_of_day(picked) - minute_of_day(ordered), F.lit(MINUTES_PER_DAY)).cast("double")


def day_first_date(text: Column) -> Column:
    """Day, month and year apart by ``-``, ``/`` or ``.``, or year first as in ISO dates."""
    dashed = F.translate(strip(text), "/.", "--")
    return F.coalesce(F.try_to_date(dashed, DAY_FIRST), F.try_to_date(dashed, YEAR_FIRST))


def day_of_week(date: Column) -> Column:
    """Monday 0 to Sunday 6."""
    return F.weekday(date)


def peak_hour_flag(hour: Column) -> Column:
    return F.coalesce(hour.isin(PEAK_HOURS), F.lit(False)).cast("int")


def weekend_flag(weekday: Column) -> Column:
    return F.coalesce(weekday >= 5, F.lit(False)).cast("int")

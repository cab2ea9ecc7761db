"""The generated calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions import dates
from salesmart.schema import DIM_DATE

# The default range, three years of 1,096 days.
DEFAULT_START = date(1996, 1, 1)
DEFAULT_END = date(1998, 12, 31)


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of a frame with one `date` column."""
    day = F.col("date")
    described = days.select(
        dates.date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        dates.name_of(dates.MONTH_NAMES, F.month(day)).alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("weekday"),
        dates.name_of(dates.WEEKDAY_NAMES, F.dayofweek(day)).alias("weekday_name"),
        dates.week_of_year(day).alias("week"),
    )
    return described.select(*DIM_DATE.fieldNames())


def _each_day(bounds: DataFrame) -> DataFrame:
    step = F.expr("interval 1 day")
    return bounds.select(F.explode(F.sequence("first_day", "last_day", step)).alias("date"))


def build_calendar(
    spark: SparkSession, start: date = DEFAULT_START, end: date = DEFAULT_END
) -> DataFrame:
    """Every day from `start` to `end`, both included."""
    bounds = spark.range(1).select(
        F.lit(start).alias("first_day"), F.lit(end).alias("last_day")
    )
    return describe_days(_each_day(bounds))


def calendar_for(orders: DataFrame) -> DataFrame:
    """Whole years that cover every order date."""
    first, last = F.min("order_date"), F.max("order_date")
    bounds = orders.agg(
        F.make_date(F.year(first), F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(F.year(last), F.lit(12), F.lit(31)).alias("last_day"),
    )
    return describe_days(_each_day(bounds))

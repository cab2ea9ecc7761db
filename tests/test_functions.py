from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from salesmart.functions.dates import date_key, date_key_style112, elapsed_seconds, week_of_year
from salesmart.functions.numeric import line_amount, money_div, pct2
from salesmart.functions.text import full_name
from salesmart.operators.calendar import build_calendar
from salesmart.operators.quality import check_lengths
from salesmart.schema import DIM_DATE, SchemaMismatch, conform


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_money_division_is_cut_toward_zero(spark):
    cases = [(100, 339, "0.2949"), (-2, 3, "-0.6666"), (2, 3, "0.6666"), (1, 0, None)]
    for num, den, expected in cases:
        (got,) = one(spark, money_div(F.lit(D(num)).cast("decimal(19,4)"), F.lit(den)))
        assert got == (None if expected is None else D(expected))


def test_percentages_round_half_up(spark):
    money = "decimal(29,4)"
    for num, den, expected in [(1, 8, "12.50"), (1, 3, "33.33"), (2, 3, "66.67"), (1, 800, "0.13")]:
        (got,) = one(spark, pct2(F.lit(num).cast(money), F.lit(den).cast(money)))
        assert got == D(expected)
    (negative,) = one(spark, pct2(F.lit(-1).cast(money), F.lit(800).cast(money)))
    assert negative == D("-0.13")


def test_line_amount_rounds_half_away_from_zero(spark):
    amount = line_amount(
        F.lit(D("0.0001")).cast("decimal(19,4)"), F.lit(1), F.lit(D("0.5")).cast("decimal(5,4)")
    )
    assert one(spark, amount) == (D("0.0001"),)


def test_dates(spark):
    day = F.lit(date(1996, 7, 4))
    assert one(spark, date_key(day), date_key_style112(day)) == (19960704, 19960704)
    start, end = datetime(2026, 1, 1, 0, 0, 0, 900_000), datetime(2026, 1, 1, 0, 0, 1, 100_000)
    assert one(spark, elapsed_seconds(F.lit(start), F.lit(end))) == (1,)


@pytest.mark.parametrize(
    ("day", "week"),
    [
        (date(1996, 12, 28), 52),
        (date(1996, 12, 29), 53),
        (date(1996, 12, 31), 53),
        (date(1997, 1, 1), 1),
        (date(1997, 1, 4), 1),
        (date(1997, 1, 5), 2),
        (date(2000, 12, 31), 54),
    ],
)
def test_week_starts_on_sunday_and_week_one_holds_new_year(spark, day, week):
    assert one(spark, week_of_year(F.lit(day))) == (week,)


def test_default_calendar(spark):
    calendar = build_calendar(spark)
    assert calendar.count() == 1096
    assert conform(calendar, DIM_DATE).orderBy("date_sk").first().asDict() == {
        "date_sk": 19960101,
        "date": date(1996, 1, 1),
        "year": 1996,
        "quarter": 1,
        "month": 1,
        "month_name": "Enero",
        "day": 1,
        "weekday": 2,
        "weekday_name": "Lunes",
        "week": 1,
    }


def test_full_name_is_null_when_a_part_is(spark):
    null = F.lit(None).cast("string")
    assert one(spark, full_name(F.lit("A"), F.lit("B")), full_name(F.lit("A"), null)) == (
        "A B",
        None,
    )


def test_schema_mismatch_names_the_column(spark):
    with pytest.raises(SchemaMismatch, match="date_sk"):
        conform(spark.range(1).withColumnRenamed("id", "date_sk"), DIM_DATE)


def test_check_lengths(spark):
    df = spark.createDataFrame([("abc", "x"), ("a", None)], "name string, code string")
    rows = check_lengths(df, {"name": 2, "code": 5}).collect()
    assert {r.column_name: r.too_long for r in rows} == {"name": 1, "code": 0}

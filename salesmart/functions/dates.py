"""Calendar expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month and weekday names (weekday 1 is Sunday).
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
WEEKDAY_NAMES = (
    "Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado",
)


def date_key(day: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_key_style112(day: Column) -> Column:
    """The same key by way of the compact ISO text."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def week_of_year(day: Column) -> Column:
    """Week number where week 1 holds January 1 and weeks start on Sunday (not the ISO week)."""
    lead_in = F.dayofweek(F.trunc(day, "YEAR")) - 2
    return (F.floor((F.dayofyear(day) + lead_in) / 7) + 1).cast("int")


def name_of(names: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), number)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Second boundaries crossed between two timestamps."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)

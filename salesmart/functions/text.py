"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: Column, last: Column) -> Column:
    """First and last name joined by a blank; null when either is null."""
    return F.concat(first, F.lit(" "), last)


def fold(col: Column) -> Column:
    """Equality that ignores case and trailing blanks, for sources with such a collation."""
    return F.collate(col, "UNICODE_CI_RTRIM")

"""Change stamping for sources that carry no row version of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def same_values(left: str, right: str, columns: list[str]) -> F.Column:
    """All columns equal, null equal to null."""
    tests = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def stamp_versions(previous: DataFrame, current: DataFrame, keys: list[str], version: int) -> DataFrame:
    """Give changed and new rows of `current` the new version; the others keep theirs.

    `previous` carries `row_version`; a `row_version` in `current` is ignored. Rows that are gone
    from `current` are gone from the result, as a deleted row leaves no version behind.
    """
    columns = [c for c in current.columns if c != "row_version"]
    compared = [c for c in columns if c not in keys]
    on = reduce(lambda a, b: a & b, [F.col(f"c.{k}") == F.col(f"p.{k}") for k in keys])
    unchanged = F.col("p.row_version").isNotNull() & same_values("c", "p", compared)
    stamped = F.when(unchanged, F.col("p.row_version")).otherwise(F.lit(version)).cast("long")
    return (
        current.alias("c")
        .join(previous.alias("p"), on, "left")
        .select(*[F.col(f"c.{c}") for c in columns], stamped.alias("row_version"))
    )

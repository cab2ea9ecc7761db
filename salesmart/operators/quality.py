"""Checks of a loaded star: row counts, freight, calendar, references and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.schema import MONEY_SUM


def _count(df: DataFrame) -> F.Column:
    return df.agg(F.count(F.lit(1))).scalar()


def check_row_counts(source_lines: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: lines in the source, rows in the fact, and whether they are equal."""
    counted = source_lines.agg(F.count(F.lit(1)).alias("source_rows"))
    return counted.select("source_rows", _count(fact).alias("fact_rows")).withColumn(
        "equal", F.col("source_rows") == F.col("fact_rows")
    )


def check_freight(fact: DataFrame, orders: DataFrame, n: int = 5) -> DataFrame:
    """The n orders whose allocated freight differs most from their freight."""
    allocated = fact.groupBy("order_id").agg(F.sum("freight_alloc").alias("allocated"))
    difference = (F.col("freight") - F.col("allocated")).cast(MONEY_SUM)
    return (
        allocated.join(orders.select("order_id", "freight"), "order_id")
        .select(
            "order_id",
            "freight",
            F.col("allocated").cast(MONEY_SUM).alias("allocated"),
            difference.alias("difference"),
        )
        .orderBy(F.abs("difference").desc(), "order_id")
        .limit(n)
    )


def check_calendar(dim_date: DataFrame, n: int = 5) -> DataFrame:
    """The first n days, each with the number of days there are."""
    return dim_date.withColumn("days", _count(dim_date)).orderBy("date_sk").limit(n)


def check_fk(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per dimension: fact rows whose key the dimension does not have.

    `dims` maps a name to the dimension and its key column. Rows are counted per key first, so
    the anti join meets each key once.
    """
    reports = []
    for name, (dim, key) in dims.items():
        used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        orphans = used.join(dim.select(key), key, "left_anti")
        reports.append(
            orphans.agg(
                F.lit(name).alias("dimension"),
                F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("orphan_rows"),
                F.count(F.lit(1)).alias("orphan_keys"),
            )
        )
    return _union(reports)


def check_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: rows, null keys, and keys that occur more than once."""
    reports = []
    for name, (df, key) in tables.items():
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        reports.append(
            per_key.agg(
                F.lit(name).alias("table_name"),
                F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
                F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("rows"))), F.lit(0))
                .cast("long")
                .alias("null_keys"),
                F.count_if((F.col("rows") > 1) & F.col(key).isNotNull()).alias("repeated_keys"),
            )
        )
    return _union(reports)


def check_lengths(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Per text column: values longer than the declared length."""
    counts = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    return counts.unpivot([], list(limits), "column_name", "too_long")


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result

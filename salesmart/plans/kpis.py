"""The five headline measures, over any grouping and along the drill-down paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.numeric import mean_pct, money_div
from salesmart.schema import MONEY_SUM
from salesmart.session import scratch_path, stage
from salesmart.store import Star

_SUMS = ("sales", "units", "freight", "discounts", "lines")


def _per_order(rows: DataFrame, *keys: str) -> DataFrame:
    """Additive measures per order within the keys: the grain every measure can be taken from."""
    return rows.groupBy(*keys, "order_id").agg(
        F.sum("sale_amount").alias("sales"),
        F.sum("quantity").alias("units"),
        F.sum("freight_alloc").alias("freight"),
        F.sum("discount").alias("discounts"),
        F.count(F.lit(1)).alias("lines"),
    )


def _measures(grouped, *extra: F.Column) -> DataFrame:
    sums = [F.sum(name).alias(name) for name in _SUMS]
    return grouped.agg(*extra, F.countDistinct("order_id").alias("orders"), *sums)


def _finish(df: DataFrame, *keys: str) -> DataFrame:
    sales = F.col("sales").cast(MONEY_SUM)
    return df.select(
        *keys,
        sales.alias("sales"),
        F.col("units").cast("long").alias("units"),
        F.col("freight").cast(MONEY_SUM).alias("freight"),
        mean_pct(F.col("discounts"), F.col("lines")).alias("avg_discount_pct"),
        money_div(sales, F.col("orders")).alias("ticket"),
    )


def kpi_global(star: Star) -> DataFrame:
    return _finish(_measures(_per_order(star.fact)))


def _additive(star: Star, dim: str, columns: tuple[str, ...]) -> DataFrame:
    """Additive measures per combination of attributes: summed per key before the join, so that
    a best-seller is one row of it."""
    sk = f"{dim}_sk"
    per_key = star.fact.groupBy(sk).agg(
        F.sum("sale_amount").alias("sales"),
        F.sum("quantity").alias("units"),
        F.sum("freight_alloc").alias("freight"),
        F.sum("discount").alias("discounts"),
        F.count(F.lit(1)).alias("lines"),
    )
    joined = per_key.join(star.dim(dim).select(sk, *columns), sk)
    return joined.groupBy(*columns).agg(*[F.sum(n).alias(n) for n in _SUMS])


def _orders_of(star: Star, dim: str, columns: tuple[str, ...]) -> DataFrame:
    """Each order once per combination of attributes; repeated pairs are folded before the join."""
    sk = f"{dim}_sk"
    pairs = star.fact.select(sk, "order_id").distinct()
    return pairs.join(star.dim(dim).select(sk, *columns), sk).select(*columns, "order_id").distinct()


def _same(columns: tuple[str, ...], prefix: str) -> F.Column:
    equal = F.lit(True)
    for c in columns:
        equal = equal & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return equal


def kpi_by(star: Star, dim: str, *columns: str) -> DataFrame:
    """The measures per combination of attributes of one dimension."""
    orders = _orders_of(star, dim, columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("orders"))
    orders = orders.toDF(*[f"__{c}" for c in columns], "orders")
    joined = _additive(star, dim, columns).join(orders, _same(columns, "__"))
    return _finish(joined, *columns)


def rollup(star: Star, dim: str, *path: str) -> DataFrame:
    """The measures at every level of a drill-down path; `level` is the grouping id, 0 the
    finest and the highest value the grand total.

    Additive measures are summed at the finest level and rolled up from there. Distinct orders
    go up by levels: those of a shorter path are the distinct ones of the longer path.
    """
    sums = [F.sum(n).alias(n) for n in _SUMS]
    rolled = _additive(star, dim, path).rollup(*path).agg(
        F.grouping_id().cast("long").alias("level"), *sums
    )
    spark, n = star.fact.sparkSession, len(path)
    pairs = stage(_orders_of(star, dim, path), scratch_path(spark, "orders"))
    counts = None
    for kept in range(n, -1, -1):
        if kept < n:
            pairs = pairs.select(*path[:kept], "order_id").distinct()
        missing = [
            F.lit(None).cast(kind).alias(f"__{c}") for c, kind in _types(star, dim, path[kept:])
        ]
        level = pairs.groupBy(*path[:kept]).agg(F.count(F.lit(1)).alias("orders")).select(
            *[F.col(c).alias(f"__{c}") for c in path[:kept]], *missing,
            F.lit(2 ** (n - kept) - 1).cast("long").alias("__level"), "orders",
        )
        counts = level if counts is None else counts.unionByName(level)
    on = (F.col("level") == F.col("__level")) & _same(path, "__")
    joined = rolled.join(counts, on, "left")
    joined = joined.withColumn("orders", F.coalesce("orders", F.lit(0)))
    return _finish(joined, *path, "level").orderBy(F.desc("level"), *path)


def _types(star: Star, dim: str, columns: tuple[str, ...]) -> list[tuple]:
    schema = star.dim(dim).schema
    return [(c, schema[c].dataType) for c in columns]


# The documented drill-down paths.
HIERARCHIES = {
    "rollup_category_product": ("product", "category_name", "product_name"),
    "rollup_supplier": ("product", "supplier_country", "supplier_name", "product_name"),
    "rollup_geo": ("customer", "country", "region", "city", "company_name"),
    "rollup_org": ("employee", "supervisor_name", "full_name"),
    "rollup_calendar": ("date", "year", "quarter", "month_name", "day"),
    "rollup_week": ("date", "week", "weekday_name"),
}

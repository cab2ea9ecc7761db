"""The thirteen sales reports over the star.

Reports by product or customer with additive measures only first sum per surrogate key, which
shrinks the fact map-side, and join attributes to the sums: these dimensions can be too large to
broadcast. The others join first. Joins carry no hints: Catalyst broadcasts what is small by its
statistics, and splits skewed partitions of the rest.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import mean_pct, money_div, pct2
from salesmart.functions.text import fold
from salesmart.operators.ordering import rank_descending, with_running_total
from salesmart.schema import MONEY_SUM, PERCENT, UNKNOWN_SK, VARIATION
from salesmart.session import scratch_path, stage
from salesmart.store import Star

# The Pareto classes and the truncated cumulative shares up to which they reach.
CLASS_A, SHARE_A = "A (Top 80%)", Decimal("0.80")
CLASS_B, SHARE_B = "B (Siguiente 15%)", Decimal("0.95")
CLASS_C = "C (Último 5%)"


def _units() -> F.Column:
    return F.sum("quantity").cast("long").alias("units")


def _sales() -> F.Column:
    return F.sum("sale_amount").cast(MONEY_SUM).alias("sales")


def _freight() -> F.Column:
    return F.sum("freight_alloc").cast(MONEY_SUM).alias("freight")


def _orders() -> F.Column:
    return F.countDistinct("order_id").alias("orders")


def _lines() -> F.Column:
    return F.count(F.lit(1)).alias("lines")


def _summed(df: DataFrame, keys: list[str], *measures: F.Column) -> DataFrame:
    return df.groupBy(*keys).agg(*measures)


def _resum(*names: str) -> list[F.Column]:
    types = {"units": "long", "lines": "long", "discounted": "long"}
    return [F.sum(n).cast(types.get(n, MONEY_SUM)).alias(n) for n in names]


def sales_by_quarter(star: Star) -> DataFrame:
    joined = star.fact.join(star.date.select("date_sk", "year", "quarter"), "date_sk")
    return (
        joined.groupBy("year", "quarter")
        .agg(_orders(), _units(), _sales(), _freight())
        .orderBy("year", "quarter")
    )


def top_products(star: Star, n: int = 10) -> DataFrame:
    sums = _summed(
        star.fact, ["product_sk"], _units(), _sales(), F.sum("discount").alias("discounts"), _lines()
    )
    named = sums.join(
        star.product.select("product_sk", "product_name", "category_name"), "product_sk"
    )
    return (
        named.groupBy("product_name", "category_name")
        .agg(
            *_resum("units", "sales"),
            mean_pct(F.sum("discounts"), F.sum("lines")).alias("avg_discount_pct"),
        )
        .orderBy(F.desc("sales"), "product_name", "category_name")
        .limit(n)
    )


def category_share(star: Star) -> DataFrame:
    joined = star.fact.join(star.product.select("product_sk", "category_name"), "product_sk")
    sums = joined.groupBy("category_name").agg(_orders(), _units(), _sales())
    shared = _with_total(_staged(sums), "sales")
    return (
        shared.withColumn("pct", pct2(F.col("sales"), F.col("total_sales")))
        .drop("total_sales")
        .orderBy(F.desc("sales"), "category_name")
    )


def employee_rank(star: Star) -> DataFrame:
    attrs = ["full_name", "title", "supervisor_name"]
    joined = star.fact.join(star.employee.select("employee_sk", *attrs), "employee_sk")
    sums = joined.groupBy(*attrs).agg(_orders(), _sales())
    ranked = rank_descending(sums, "sales", "ranking")
    return ranked.select(*attrs, "orders", "sales", "ranking").orderBy("ranking", "full_name")


def country_sales(star: Star, ignore_case: bool = False) -> DataFrame:
    """`ignore_case` groups countries that differ in case or trailing blanks only."""
    joined = star.fact.join(star.customer.select("customer_sk", "country"), "customer_sk")
    # One row per customer and order is left to the two distinct counts.
    per_order = _summed(joined, ["country", "customer_sk", "order_id"], _sales())
    measures = [
        F.countDistinct("customer_sk").alias("customers"),
        _orders(),
        *_resum("sales"),
    ]
    if ignore_case:
        folded = per_order.withColumn("__folded", fold(F.col("country")))
        sums = folded.groupBy("__folded").agg(F.min("country").alias("country"), *measures)
        sums = sums.drop("__folded")
    else:
        sums = per_order.groupBy("country").agg(*measures)
    return sums.withColumn("ticket", money_div(F.col("sales"), F.col("orders"))).orderBy(
        F.desc("sales"), "country"
    )


def shipper_freight(star: Star) -> DataFrame:
    names = star.shipper.select("shipper_sk", F.col("company_name").alias("shipper"))
    return (
        star.fact.join(names, "shipper_sk")
        .groupBy("shipper")
        .agg(F.countDistinct("order_id").alias("shipments"), _freight())
        .withColumn("freight_per_order", money_div(F.col("freight"), F.col("shipments")))
        .orderBy(F.desc("freight"), "shipper")
    )


def monthly_variation(star: Star) -> DataFrame:
    months = (
        star.fact.join(star.date.select("date_sk", "year", "month", "month_name"), "date_sk")
        .groupBy("year", "month", "month_name")
        .agg(_sales())
    )
    # One row per calendar month reaches this window.
    previous = F.lag("sales").over(Window.orderBy("year", "month"))
    change = money_div(F.col("sales") - F.col("prev_sales"), F.col("prev_sales")) * 100
    return (
        months.withColumn("prev_sales", previous)
        .withColumn("variation_pct", F.when(F.col("prev_sales") > 0, change.cast(VARIATION)))
        .orderBy("year", "month")
    )


def discounts_by_category(star: Star) -> DataFrame:
    sums = _summed(
        star.fact,
        ["product_sk"],
        _lines(),
        F.count_if(F.col("discount") > 0).alias("discounted"),
        F.sum("discount").alias("discounts"),
        F.sum(F.col("unit_price") * F.col("quantity")).cast(MONEY_SUM).alias("gross"),
        _sales(),
    )
    return (
        sums.join(star.product.select("product_sk", "category_name"), "product_sk")
        .groupBy("category_name")
        .agg(*_resum("lines", "discounted", "gross", "sales"), F.sum("discounts").alias("discounts"))
        .select(
            "category_name",
            "lines",
            "discounted",
            pct2(F.col("discounted"), F.col("lines")).alias("discounted_pct"),
            mean_pct(F.col("discounts"), F.col("lines")).alias("avg_discount_pct"),
            (F.col("gross") - F.col("sales")).cast(MONEY_SUM).alias("discount_amount"),
        )
        .orderBy(F.desc("discount_amount"), "category_name")
    )


def top_customers(star: Star, n: int = 5) -> DataFrame:
    sums = _summed(star.fact, ["customer_sk"], _sales())
    named = (
        sums.join(star.customer.select("customer_sk", "country", "company_name"), "customer_sk")
        .groupBy("country", "company_name")
        .agg(*_resum("sales"))
    )
    # The rank filter is pushed below the shuffle: a country sends n rows per partition.
    best = Window.partitionBy("country").orderBy(F.desc("sales"), "company_name")
    return (
        named.withColumn("rank_in_country", F.row_number().over(best).cast("int"))
        .filter(F.col("rank_in_country") <= n)
        .orderBy("country", "rank_in_country")
    )


def product_sales(star: Star) -> DataFrame:
    sums = _summed(star.fact, ["product_sk"], _sales())
    return (
        sums.join(star.product.select("product_sk", "product_name"), "product_sk")
        .groupBy("product_name")
        .agg(*_resum("sales"))
    )


def _pareto(running: DataFrame) -> DataFrame:
    share = money_div(F.col("sales"), F.col("total_sales"))
    cumulative = money_div(F.col("cum_sales"), F.col("total_sales"))
    label = (
        F.when(cumulative <= F.lit(SHARE_A), CLASS_A)
        .when(cumulative <= F.lit(SHARE_B), CLASS_B)
        .otherwise(CLASS_C)
    )
    return running.select(
        "product_name",
        "sales",
        (share * 100).cast(PERCENT).alias("pct"),
        (cumulative * 100).cast(PERCENT).alias("cum_pct"),
        label.alias("abc_class"),
    ).orderBy(F.desc("sales"), "product_name")


def pareto_abc(star: Star) -> DataFrame:
    """Products by sales with their cumulative share; equal sales share one cumulative share.

    The fact is read once: sums per product are sorted into files, where the running total, which
    no single task computes, and the total are taken from them.
    """
    running = with_running_total(
        product_sales(star), "sales", {"cum": F.sum("sales")}, whole="_whole"
    )
    return _pareto(
        running.withColumns(
            {
                "cum_sales": F.col("cum").cast(MONEY_SUM),
                "total_sales": F.col("cum_whole").cast(MONEY_SUM),
            }
        )
    )


#: The same report under the name it had beside a form for small stars.
pareto_scalable = pareto_abc


def supplier_performance(star: Star) -> DataFrame:
    sums = _summed(star.fact, ["product_sk"], _units(), _sales())
    attrs = ["supplier_name", "supplier_country"]
    # One row per product key is left, so a plain count is a distinct count.
    return (
        sums.join(star.product.select("product_sk", *attrs), "product_sk")
        .groupBy(*attrs)
        .agg(F.count("product_sk").alias("products"), *_resum("units", "sales"))
        .orderBy(F.desc("sales"), "supplier_name")
    )


def weekday_sales(star: Star) -> DataFrame:
    return (
        star.fact.join(star.date.select("date_sk", "weekday", "weekday_name"), "date_sk")
        .groupBy("weekday", "weekday_name")
        .agg(_orders(), _sales())
        .withColumn("ticket", money_div(F.col("sales"), F.col("orders")))
        .orderBy("weekday")
    )


def executive_summary(star: Star) -> DataFrame:
    """One row; members are counted by version, without the unknown member."""

    def members(df: DataFrame, sk: str) -> F.Column:
        return df.filter(F.col(sk) != UNKNOWN_SK).agg(F.count(F.lit(1))).scalar()

    totals = star.fact.agg(_lines(), _orders(), _sales(), _freight())
    return totals.select(
        members(star.product, "product_sk").alias("products"),
        members(star.customer, "customer_sk").alias("customers"),
        members(star.employee, "employee_sk").alias("employees"),
        members(star.shipper, "shipper_sk").alias("shippers"),
        star.date.agg(F.count(F.lit(1))).scalar().alias("days"),
        "lines",
        "orders",
        "sales",
        "freight",
    )


def _with_total(sums: DataFrame, column: str) -> DataFrame:
    """Add the total of a column of staged sums."""
    total = sums.agg(F.sum(column).cast(MONEY_SUM)).scalar()
    return sums.withColumn(f"total_{column}", total)


def _staged(sums: DataFrame) -> DataFrame:
    """Sums that a report needs twice, written once: the fact is not read again."""
    return stage(sums, scratch_path(sums.sparkSession, "sums"))


REPORTS = {
    "q01_sales_by_quarter": sales_by_quarter,
    "q02_top_products": top_products,
    "q03_category_share": category_share,
    "q04_employee_rank": employee_rank,
    "q05_country_sales": country_sales,
    "q06_shipper_freight": shipper_freight,
    "q07_monthly_variation": monthly_variation,
    "q08_discounts": discounts_by_category,
    "q09_top_customers": top_customers,
    "q10_pareto_abc": pareto_abc,
    "q11_suppliers": supplier_performance,
    "q12_weekday": weekday_sales,
    "q13_summary": executive_summary,
}

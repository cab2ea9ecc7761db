"""The given retail tables read as the eight order-entry tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.numeric import money, money_div
from salesmart.schema import FRACTION, MONEY
from salesmart.sources.tables import Sources


def _text() -> F.Column:
    return F.lit(None).cast("string")


def line_number() -> F.Column:
    """What tells the lines of one order and product apart: the number in the source with the
    supplier and the day. All three stay as they are when other lines come or go; the number
    alone recurs in a few orders."""
    day = F.unix_date(F.to_date(F.coalesce("l_shipdate", F.lit("1970-01-01").cast("timestamp"))))
    supplier = F.coalesce("l_suppkey", F.lit(0).cast("long"))
    return ((supplier * 65536 + day) * 8 + F.col("l_linenumber")).cast("long")


def order_details(raw_lines: DataFrame) -> DataFrame:
    """Every source line, by itself: no line is moved to number it."""
    whole = F.col("l_quantity").cast("int")
    quantity = F.when(F.col("l_quantity") == whole, whole).otherwise(
        F.raise_error(F.lit("a quantity is not a whole number"))
    )
    return raw_lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        line_number().alias("line_no"),
        money_div(F.col("l_extendedprice").cast(MONEY), quantity).alias("unit_price"),
        quantity.alias("quantity"),
        F.col("l_discount").cast(FRACTION).alias("discount"),
        F.lit(1).cast("long").alias("row_version"),
    )


def read_retail(spark: SparkSession, sf_dir: str) -> Sources:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    version = F.lit(1).cast("long").alias("row_version")
    nation, region = table("nation"), table("region")
    place = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        "n_nationkey", "n_name", "n_regionkey", "r_name"
    )

    part = table("part")
    supplier_count = table("supplier").agg(F.count(F.lit(1))).scalar()
    products = part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category_id"),
        (F.col("p_partkey") % supplier_count).alias("supplier_id"),
        F.concat(F.col("p_size").cast("string"), F.lit(" units")).alias("quantity_per_unit"),
        money(F.col("p_retailprice")).alias("unit_price"),
        (F.col("p_size") % 10 == 0).alias("discontinued"),
        version,
    )
    categories = part.select("p_type").distinct().select(
        F.col("p_type").alias("category_id"),
        F.col("p_type").alias("category_name"),
        F.concat(F.lit("Category "), F.col("p_type")).alias("description"),
    )
    suppliers = table("supplier").join(
        place, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    ).select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("company_name"),
        F.col("n_name").alias("country"),
    )
    customers = table("customer").join(
        place, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("company_name"),
        _text().alias("contact_name"),
        F.col("c_mktsegment").alias("contact_title"),
        _text().alias("city"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
        _text().alias("postal_code"),
        version,
    )
    heads = nation.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("head"))
    employees = place.join(heads, "n_regionkey").select(
        F.col("n_nationkey").cast("long").alias("employee_id"),
        F.lit("Emp").alias("first_name"),
        F.col("n_name").alias("last_name"),
        F.col("r_name").alias("title"),
        F.lit(None).cast("timestamp").alias("hire_date"),
        _text().alias("city"),
        F.col("n_name").alias("country"),
        F.when(F.col("head") != F.col("n_nationkey"), F.col("head"))
        .cast("long")
        .alias("reports_to"),
        version,
    )
    priority = F.col("o_orderpriority")  # a number, a dash and a name
    number = F.split_part(priority, F.lit("-"), F.lit(1))
    shippers = table("orders").select(priority).distinct().select(
        number.cast("long").alias("shipper_id"),
        F.regexp_extract(priority, r"(?s)^[^-]*-(.*)$", 1).alias("company_name"),
        _text().alias("phone"),
        version,
    )
    employee_count = nation.agg(F.count(F.lit(1))).scalar()
    orders = table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        (F.col("o_orderkey") % employee_count).alias("employee_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_date"),
        number.cast("long").alias("ship_via"),
        money(F.col("o_totalprice")).alias("freight"),
        version,
    )
    return Sources(
        categories=categories,
        suppliers=suppliers,
        products=products,
        customers=customers,
        employees=employees,
        shippers=shippers,
        orders=orders,
        order_details=order_details(table("lineitem")),
    )

"""Dimension members as the sources state them, whole or changed within a version range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.text import full_name
from salesmart.schema import DIM_ATTRS, DIM_KEYS
from salesmart.sources.tables import Sources, above


def changed_since(df: DataFrame, low: int, high: int | None = None) -> DataFrame:
    """Rows with low < row version <= high. The upper bound keeps a row that changes while the
    batch runs for the next batch only."""
    return above(df, low, high)


def unseen(rows: DataFrame, source: str, key: str, seen: DataFrame) -> DataFrame:
    """Rows whose version is above the one that was seen of their key."""
    known = seen.filter(F.col("source_table") == source)
    known = known.groupBy("key").agg(F.max("row_version").alias("__seen"))
    known = known.withColumnRenamed("key", "__key")
    on = (F.col(key).cast("string") == F.col("__key")) & (F.col("row_version") <= F.col("__seen"))
    return rows.join(known, on, "left_anti")


def noticed(rows: DataFrame, source: str, key: str, notices: DataFrame) -> DataFrame:
    """Rows whose key a notice names."""
    keys = notices.filter(F.col("source_table") == source).select(F.col("key").alias("__key"))
    return rows.join(keys, F.col(key).cast("string") == F.col("__key"), "left_semi")


def product_members(sources: Sources, products: DataFrame) -> DataFrame:
    category = sources.categories.select(
        "category_id", "category_name", F.col("description").alias("category_desc")
    )
    supplier = sources.suppliers.select(
        "supplier_id",
        F.col("company_name").alias("supplier_name"),
        F.col("country").alias("supplier_country"),
    )
    joined = products.join(category, "category_id", "left").join(supplier, "supplier_id", "left")
    return _members(joined, "dim_product")


def customer_members(sources: Sources, customers: DataFrame) -> DataFrame:
    return _members(customers, "dim_customer")


def employee_members(sources: Sources, employees: DataFrame) -> DataFrame:
    """The supervisor comes from the whole table, changed or not."""
    head = sources.employees.select(
        F.col("employee_id").alias("reports_to"),
        full_name(F.col("first_name"), F.col("last_name")).alias("supervisor_name"),
    )
    named = employees.withColumn(
        "full_name", full_name(F.col("first_name"), F.col("last_name"))
    )
    return _members(named.join(head, "reports_to", "left"), "dim_employee")


def shipper_members(sources: Sources, shippers: DataFrame) -> DataFrame:
    return _members(shippers, "dim_shipper")


MEMBERS = {
    "dim_product": product_members,
    "dim_customer": customer_members,
    "dim_employee": employee_members,
    "dim_shipper": shipper_members,
}


def _members(df: DataFrame, dim: str) -> DataFrame:
    key = DIM_KEYS[dim][1]
    attrs = [name for name, _ in DIM_ATTRS[dim]]
    return df.select(key, *attrs, F.col("row_version").alias("source_version"))

"""From changed orders and lines to rows ready for the fact table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.dates import date_key, date_key_style112
from salesmart.functions.numeric import allocate, line_amount
from salesmart.operators.dimensions import changed_since, unseen
from salesmart.schema import DIM_KEYS, MONEY, UNKNOWN_SK
from salesmart.sources.tables import Sources


@dataclass(frozen=True)
class Marks:
    """The version range one batch takes from the order tables: low < version <= high."""

    orders_low: int
    details_low: int
    orders_high: int | None = None
    details_high: int | None = None


def affected_orders(sources: Sources, marks: Marks, seen: DataFrame | None = None) -> DataFrame:
    """Orders that changed, or with a line that changed; each once. Versions that notices have
    brought in already (`seen`) do not count."""
    orders = changed_since(sources.orders, marks.orders_low, marks.orders_high)
    lines = changed_since(sources.order_details, marks.details_low, marks.details_high)
    if seen is not None:
        orders = unseen(orders, "orders", "order_id", seen)
        lines = unseen(lines, "order_details", "order_id", seen)
    return orders.select("order_id").union(lines.select("order_id")).distinct()


def lines_of(sources: Sources, order_ids: DataFrame | None) -> DataFrame:
    """All lines of the given orders (of all orders when None), with their amount."""
    lines = sources.order_details
    if order_ids is not None:
        lines = lines.join(order_ids, "order_id", "left_semi")
    amount = line_amount(F.col("unit_price"), F.col("quantity"), F.col("discount"))
    return lines.withColumn("sale_amount", amount)


def order_subtotals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(F.sum("sale_amount").alias("subtotal"))


def order_heads(lines: DataFrame, orders: DataFrame, ratio_mode: str = "float") -> DataFrame:
    """What the order says about each of its lines, with the subtotal of the order.

    Subtotals are joined rather than computed in a window over the order, so one order with very
    many lines is summed map-side and its join can be split.
    """
    key = date_key_style112 if ratio_mode == "float" else date_key
    return orders.select(
        "order_id",
        "customer_id",
        "employee_id",
        F.col("ship_via").alias("shipper_id"),
        key(F.to_date("order_date")).alias("date_sk"),
        "freight",
    ).join(order_subtotals(lines), "order_id")


def _allocated(lines: DataFrame, heads: DataFrame, ratio_mode: str, *columns: str) -> DataFrame:
    share = allocate(F.col("freight"), F.col("sale_amount"), F.col("subtotal"), ratio_mode)
    return lines.join(heads, "order_id").select(
        "order_id",
        "product_id",
        "line_no",
        *columns,
        "date_sk",
        "unit_price",
        "quantity",
        "discount",
        "sale_amount",
        share.cast(MONEY).alias("freight_alloc"),
    )


def fresh_lines(lines: DataFrame, orders: DataFrame, ratio_mode: str = "float") -> DataFrame:
    """Lines with what their order says and their share of its freight."""
    heads = order_heads(lines, orders, ratio_mode)
    return _allocated(lines, heads, ratio_mode, "customer_id", "employee_id", "shipper_id")


def lookup(rows: DataFrame, dims: dict[str, DataFrame], names: list[str], unknown: str):
    """Add the surrogate keys of the current versions.

    `-1`: a member that is not there becomes the unknown member. `drop`: the row is dropped.
    """
    if unknown not in ("-1", "drop"):
        raise ValueError(f"unknown must be '-1' or 'drop', not {unknown!r}")
    for dim in names:
        sk, key = DIM_KEYS[dim]
        current = dims[dim].filter("is_current").select(key, sk)
        rows = rows.join(current, key, "inner" if unknown == "drop" else "left")
        if unknown == "-1":
            rows = rows.withColumn(sk, F.coalesce(F.col(sk), F.lit(UNKNOWN_SK).cast("long")))
    return rows


def keyed_lines(
    lines: DataFrame,
    orders: DataFrame,
    dims: dict[str, DataFrame],
    unknown: str = "-1",
    ratio_mode: str = "float",
    dim_date: DataFrame | None = None,
) -> DataFrame:
    """Fresh lines with surrogate in place of natural keys.

    All keys but the product's belong to the order: they are looked up per order, before the
    lines are joined, so that lines move for their order and their product only. The product's is
    looked up first, when a line is still narrow; the rows end up by order. With `dim_date` lines of
    a day that it does not have are dropped.
    """
    heads = order_heads(lines, orders, ratio_mode)
    per_order = [dim for dim in DIM_KEYS if dim != "dim_product"]
    heads = lookup(heads, dims, per_order, unknown)
    if dim_date is not None:
        heads = heads.join(dim_date.select("date_sk"), "date_sk")
    keys = [DIM_KEYS[dim][0] for dim in per_order]
    known = lookup(lines, dims, ["dim_product"], unknown)
    rows = _allocated(known, heads, ratio_mode, "product_sk", *keys)
    first = ["product_sk", "product_id"]
    return rows.select(*first, *[c for c in rows.columns if c not in first])


def with_calendar(fresh: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Mark the rows whose day the calendar has; a missing day is not in it."""
    days = dim_date.select("date_sk", F.lit(True).alias("__day"))
    return fresh.join(days, "date_sk", "left").select(
        *fresh.columns, F.coalesce("__day", F.lit(False)).alias("in_calendar")
    )


def full_fact_rows(
    sources: Sources, dims: dict[str, DataFrame], dim_date: DataFrame, ratio_mode: str = "float"
) -> DataFrame:
    """Every source line with all five lookups; a line that misses one is left out."""
    lines = lines_of(sources, None)
    return keyed_lines(lines, sources.orders, dims, "drop", ratio_mode, dim_date)

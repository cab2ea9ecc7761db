"""A deterministic sequence of source states, for the incremental load.

State 1 holds the orders taken so far. In state 2 new orders have come in, some lines were
re-counted, some were cancelled, some orders got another freight, and every dimension has changed
members. State 3 is state 2 again. In state 4 the cancelled lines are back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.schema import MONEY, SOURCES
from salesmart.session import CODEC, freed_shuffles, stage_bucketed
from salesmart.sources.tables import Sources

#: Buckets of orders: so many at least, and one for so many orders, which a task sorts in memory.
BUCKETS, ORDERS_PER_BUCKET = 8, 250_000


@dataclass(frozen=True)
class ChangeRules:
    """Which rows change, as SQL conditions over the source columns (Spark and DuckDB alike)."""

    late_order: str = "order_date >= DATE '2001-01-01'"
    recounted_order: str = "order_date >= DATE '2000-07-01' AND ship_via <> 3"
    refreighted_order: str = "ship_via = 2 AND freight < 100000"
    cancelled_line: str = "quantity >= 40 AND discount <= 0.02"
    repriced_product: str = "discontinued"
    renamed_customer: str = "contact_title = 'BUILDING' AND region = 'EUROPE'"
    retitled_employee: str = "title = 'ASIA'"
    rephoned_shipper: str = "shipper_id = 1"


class SourceStates:
    """States 1 to 4 over one staged copy of the order tables with their change marks, in buckets
    of orders, so that the loads' sums and joins by order need no exchange of the lines."""

    def __init__(self, base: Sources, rules: ChangeRules, path: str):
        self._base, self._rules = base, rules
        orders = base.orders.select(
            "*",
            F.expr(rules.late_order).alias("late"),
            F.expr(rules.recounted_order).alias("recounted"),
            F.expr(rules.refreighted_order).alias("refreighted"),
        )
        buckets = max(BUCKETS, -(-base.orders.count() // ORDERS_PER_BUCKET))
        with freed_shuffles(orders.sparkSession):
            self._orders = stage_bucketed(
                orders, f"{path}/orders", "order_id", buckets, codec=CODEC
            )
            lines = base.order_details.select(
                "*", F.expr(rules.cancelled_line).alias("cancelled")
            ).join(self._orders.select("order_id", "late", "recounted"), "order_id")
            self._lines = stage_bucketed(
                lines, f"{path}/order_details", "order_id", buckets, codec=CODEC
            )

    def state(self, number: int) -> Sources:
        dims = self._base if number == 1 else self._changed_dims()
        return dims.with_tables(
            orders=self._orders_at(number), order_details=self._lines_at(number)
        )

    def _orders_at(self, number: int) -> DataFrame:
        if number == 1:
            return self._orders.filter(~F.col("late")).select(*SOURCES["orders"].fieldNames())
        moved = F.col("late") | F.col("refreighted")
        doubled = (F.col("freight") * F.when(F.col("refreighted"), 2).otherwise(1)).cast(MONEY)
        return self._orders.withColumns(
            {"freight": doubled, "row_version": F.when(moved, 2).otherwise(1).cast("long")}
        ).select(*SOURCES["orders"].fieldNames())

    def _lines_at(self, number: int) -> DataFrame:
        columns = SOURCES["order_details"].fieldNames()
        if number == 1:
            return self._lines.filter(~F.col("late")).select(*columns)
        version = F.when(F.col("late") | F.col("recounted"), 2).otherwise(1)
        lines = self._lines
        if number < 4:
            lines = lines.filter(~F.col("cancelled"))
        else:
            version = F.when(F.col("cancelled"), 3).otherwise(version)
        return lines.withColumns(
            {
                "quantity": F.col("quantity") + F.col("recounted").cast("int"),
                "row_version": version.cast("long"),
            }
        ).select(*columns)

    def _changed_dims(self) -> Sources:
        def changed(df: DataFrame, rule: str, column: str, value) -> DataFrame:
            hit = F.expr(rule)
            return df.withColumns(
                {
                    column: F.when(hit, value).otherwise(F.col(column)),
                    "row_version": F.when(hit, 2).otherwise(F.col("row_version")).cast("long"),
                }
            )

        b, r = self._base, self._rules
        raised = (F.col("unit_price") + 10).cast(MONEY)
        return b.with_tables(
            products=changed(b.products, r.repriced_product, "unit_price", raised),
            customers=changed(
                b.customers,
                r.renamed_customer,
                "company_name",
                F.concat(F.col("company_name"), F.lit(" Ltd")),
            ),
            employees=changed(
                b.employees, r.retitled_employee, "title", F.concat(F.lit("Head "), F.col("title"))
            ),
            shippers=changed(b.shippers, r.rephoned_shipper, "phone", F.lit("555-0100")),
        )

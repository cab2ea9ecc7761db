"""Reports on hand-made stars, and the shape of the plans."""

import re
from datetime import datetime
from decimal import Decimal

import pytest

from salesmart.operators.calendar import build_calendar
from salesmart.plans import kpis, reports
from salesmart.registry import all_queries
from salesmart.schema import DIMS, FACT
from salesmart.store import Star


def star(spark, facts, products=(), customers=()):
    """Facts as (product_sk, customer_sk, date_sk, order_id, quantity, amount)."""

    def frame(rows, schema):
        return spark.createDataFrame(
            [tuple(r.get(name) for name in schema.fieldNames()) for r in rows], schema
        )

    def fact(i, f):
        names = ("product_sk", "customer_sk", "date_sk", "order_id", "quantity", "sale_amount")
        row = dict(zip(names, f))
        row["sale_amount"] = Decimal(row["sale_amount"])
        zero = Decimal(0)
        fixed = {"unit_price": zero, "discount": zero, "freight_alloc": zero, "tx_type": "x"}
        return {"fact_id": i, "employee_sk": 1, "shipper_sk": 1, **fixed, **row}

    scd = {"version": 1, "valid_from": datetime(2026, 1, 1)}
    scd["is_current"] = True
    return Star(
        fact=frame([fact(i, f) for i, f in enumerate(facts)], FACT),
        product=frame(
            [{"product_sk": k, "product_name": n, **scd} for k, n in products],
            DIMS["dim_product"],
        ),
        customer=frame(
            [{"customer_sk": k, "country": c, **scd} for k, c in customers],
            DIMS["dim_customer"],
        ),
        employee=frame([{"employee_sk": 1, **scd}], DIMS["dim_employee"]),
        shipper=frame([{"shipper_sk": 1, **scd}], DIMS["dim_shipper"]),
        date=build_calendar(spark),
    )


@pytest.mark.parametrize("report", [reports.pareto_abc, reports.pareto_scalable])
def test_equal_sales_share_a_cumulative_share(spark, report):
    names = [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    amounts = ["70", "10", "10", "10"]
    facts = [(k, 1, 19960101, k, 1, a) for (k, _), a in zip(names, amounts)]
    rows = report(star(spark, facts, products=names)).collect()
    assert [(r.product_name, str(r.cum_pct), r.abc_class[0]) for r in rows] == [
        ("a", "70.00", "A"),
        ("b", "100.00", "C"),
        ("c", "100.00", "C"),
        ("d", "100.00", "C"),
    ]


def test_no_variation_after_a_month_without_sales(spark):
    days = [19960101, 19960201, 19960301, 19960401]
    facts = [(1, 1, d, d, 1, a) for d, a in zip(days, ["10", "0", "5", "4"])]
    rows = reports.monthly_variation(star(spark, facts)).collect()
    assert [r.variation_pct for r in rows] == [None, Decimal("-100.00"), None, Decimal("-20.00")]


def test_countries_can_be_grouped_without_case(spark):
    facts = [(1, k, 19960101, k, 1, "10") for k in (1, 2, 3)]
    data = star(spark, facts, customers=[(1, "USA"), (2, "usa "), (3, "Peru")])
    assert reports.country_sales(data).count() == 3
    rows = reports.country_sales(data, ignore_case=True).collect()
    assert sorted((r.country.strip().upper(), r.customers) for r in rows) == [
        ("PERU", 1),
        ("USA", 2),
    ]


def test_rank_of_one(spark):
    facts = [(1, 1, 19960101, 1, 1, "10")]
    assert [r.ranking for r in reports.employee_rank(star(spark, facts)).collect()] == [1]
    assert reports.category_share(star(spark, facts, products=[(1, "a")])).first().pct == 100


def test_kpis_of_nothing(spark):
    row = kpis.kpi_global(star(spark, [])).first()
    assert row.sales is None and row.ticket is None


PLANNED = [n for n in all_queries() if n != "stream_equals_batch"]


@pytest.fixture(scope="module")
def plans(spark, small):
    """Plans as they are when no table is small enough to be broadcast."""
    queries = all_queries()
    for name in ("full_fact", "incremental_ledger"):
        queries[name](spark, small)  # load the stars first
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "false")
    yield {
        name: queries[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        for name in PLANNED
    }
    for key, value in old.items():
        spark.conf.set(key, value)


def test_no_plan_pairs_all_rows_or_leaves_the_jvm(plans):
    for name, plan in plans.items():
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
            assert word not in plan, (name, word)


def test_single_tasks_only_see_aggregated_rows(plans):
    """Under an exchange to one task there is an aggregate, unless a limit took the rows."""
    for name, plan in plans.items():
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = " ".join(lines[i + 1 : i + 4])
                assert re.search(r"Aggregate|Limit|TopK", below), (name, below)


def test_scans_read_only_what_is_needed(plans):
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", plans["q09_top_customers"])
    columns = {c.split("#")[0] for c in scan.group(1).split(",")}
    assert columns <= {"customer_sk", "sale_amount", "load", "phase"}
    assert "WindowGroupLimit" in plans["q09_top_customers"]
    assert "TakeOrderedAndProject" in plans["q02_top_products"]

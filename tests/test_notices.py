"""Notices as the work set of a batch, and the sweeps between them."""

from datetime import datetime, timedelta, timezone

import micro
from pyspark.sql import functions as F

from salesmart.operators import ledger
from salesmart.plans import pipeline
from salesmart.plans.pipeline import run_incremental
from salesmart.schema import TX_DELETION, TX_NEW_VERSION, TX_ORIGINAL, TX_REVERSAL
from salesmart.sources.tables import read_parquet, write_parquet
from salesmart.store import Store
from salesmart.streaming.runner import CHANGE_NOTICE

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
JULY = datetime(1996, 7, 4)


def at(day):
    return START + timedelta(days=day)


def source(spark, lines, products=("Tea", 1)):
    return micro.sources(
        spark,
        products=[(1, products[0], "C1", 1, "10 bags", "5", False, products[1])],
        orders=[(o, 1, 1, JULY, 1, "10", 1) for o in range(1, 6)],
        order_details=[(o, 1, n, "5", q, "0", v) for (o, n), (q, v) in sorted(lines.items())],
    )


def notices(spark, *rows):
    return spark.createDataFrame(list(rows), CHANGE_NOTICE)


def booked(store, batch):
    rows = store.at().fact().filter(F.col("batch_id") == batch).collect()
    return sorted((r.order_id, r.line_no, r.tx_type, r.quantity) for r in rows)


def test_notices_load_what_they_name_and_sweeps_the_rest(spark, root):
    store = Store.create(spark, root, at(0))
    lines = {(o, n): (2, 1) for o in range(1, 6) for n in (1, 2)}
    run_incremental(spark, source(spark, lines), store, at(1))
    # order 2 is told of, order 4 changes without a notice, a line of order 2 and one of order 5 go
    lines |= {(2, 1): (7, 2), (4, 1): (9, 2)}
    del lines[2, 2], lines[5, 1]
    now = source(spark, lines, ("Green Tea", 2))
    told = notices(spark, ("order_details", "2", 2), ("products", "1", 2), ("order_details", None, 2))
    run_incremental(spark, now, store, at(2), notices=told)
    assert booked(store, 2) == [
        (2, 1, TX_NEW_VERSION, 7),
        (2, 1, TX_REVERSAL, -2),
        (2, 2, TX_DELETION, -2),
    ]
    assert store.at().dim("dim_product").filter("product_id = 1").count() == 2
    assert {r.last_row_version for r in store.at().load_control().collect()} == {1}  # marks stay
    # the same notices again, and a later one that says nothing new
    assert run_incremental(spark, now, store, at(3), notices=told).batch_id is None
    assert run_incremental(spark, now, store, at(3), notices=notices(spark)).batch_id is None
    # a sweep books order 4 and the deletion in order 5, and neither order 2 nor the product again
    run_incremental(spark, now, store, at(3))
    assert booked(store, 3) == [
        (4, 1, TX_NEW_VERSION, 9),
        (4, 1, TX_REVERSAL, -2),
        (4, 2, TX_NEW_VERSION, 2),
        (4, 2, TX_REVERSAL, -2),
        (5, 1, TX_DELETION, -2),
    ]
    assert store.at().dim("dim_product").filter("product_id = 1").count() == 2
    assert not store.at().last.of("noticed")
    net = {(r.order_id, r.line_no): r.quantity for r in ledger.net_positions(store.at().fact()).collect()}
    assert net == {k: q for k, (q, _) in lines.items()}
    assert run_incremental(spark, now, store, at(4)).batch_id is None
    # after the sweep a newer version counts again
    lines[2, 1] = (1, 3)
    run_incremental(spark, source(spark, lines, ("Green Tea", 2)), store, at(4), notices=notices(spark, ("order_details", "2", 3)))
    assert booked(store, 4) == [(2, 1, TX_NEW_VERSION, 1), (2, 1, TX_REVERSAL, -7)]


def test_a_new_order_comes_by_its_notice(spark, root):
    store = Store.create(spark, root, at(0))
    run_incremental(spark, source(spark, {(1, 1): (2, 1)}), store, at(1))
    told = notices(spark, ("orders", "3", 1), ("order_details", "3", 2))
    run_incremental(spark, source(spark, {(1, 1): (2, 1), (3, 1): (4, 2)}), store, at(2), notices=told)
    assert booked(store, 2) == [(3, 1, TX_ORIGINAL, 4)]


def test_the_scan_is_narrowed_to_the_notices(spark, root):
    write_parquet(source(spark, {(o, 1): (2, 1) for o in range(1, 6)}), root)
    stored = read_parquet(spark, root)
    touched = spark.createDataFrame([(2,), (4,)], "order_id long")
    narrow = pipeline._narrowed(stored, touched)
    plan = narrow.order_details._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_id,2)" in plan and "LessThanOrEqual(order_id,4)" in plan
    assert narrow.order_details.count() == 3

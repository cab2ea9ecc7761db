"""Small loads whose ledger can be told by hand."""

from datetime import datetime, timezone
from decimal import Decimal

import micro
import pytest
from pyspark.sql import functions as F

from salesmart.plans import pipeline
from salesmart.plans.pipeline import LoadOptions, run_full_refresh, run_incremental
from salesmart.schema import TX_DELETION, TX_NEW_VERSION, TX_ORIGINAL, TX_REVERSAL
from salesmart.store import Store


def at(day: int) -> datetime:
    return datetime(2026, 1, day, tzinfo=timezone.utc)


def entries(store, batch=None):
    rows = store.at().fact()
    if batch:
        rows = rows.filter(F.col("batch_id") == batch)
    return sorted(
        (r.order_id, r.product_id, r.tx_type, r.quantity, str(r.freight_alloc))
        for r in rows.collect()
    )


JULY = datetime(1996, 7, 4)
FIRST = {
    "products": [
        (1, "Tea", "C1", 1, "10 bags", "5", False, 1),
        (2, "Mug", "C9", 9, "1 piece", "8", True, 1),
    ],
    "employees": [
        (1, "Eve", "Moss", "Boss", None, None, "USA", None, 1),
        (2, "Ian", "Reed", "Clerk", None, None, "USA", 1, 1),
    ],
    "orders": [
        (1, 1, 1, JULY, 1, "10", 1),  # two lines
        (2, 1, 2, JULY, 1, "10", 1),  # discount 1: subtotal 0
        (3, 1, 1, JULY, 1, None, 1),  # no freight
        (4, 77, 88, JULY, 99, "4", 1),  # unknown customer, employee and shipper
        (5, 1, 1, JULY, 1, "6", 1),  # quantity 0
        (6, 1, 1, datetime(2005, 1, 1), 1, "6", 1),  # outside the calendar
        (7, 1, 1, None, 1, "6", 1),  # no date
    ],
    "order_details": [
        (1, 1, "5", 2, "0", 1),
        (1, 2, "8", 5, "0.25", 1),
        (2, 1, "5", 3, "1", 1),
        (3, 1, "5", 1, "0", 1),
        (4, 66, "5", 1, "0", 1),  # unknown product too
        (5, 1, "5", 0, "0", 1),
        (6, 1, "5", 1, "0", 1),
        (7, 1, "5", 1, "0", 1),
    ],
}


@pytest.fixture(scope="module")
def store(spark):
    from salesmart.session import scratch_path

    store = Store.create(spark, scratch_path(spark, "micro"), at(1))
    run_incremental(spark, micro.sources(spark, **FIRST), store, at(2))
    second = {
        # A rename, and a customer whose version moved without any other change.
        "products": [
            (1, "Green Tea", "C1", 1, "10 bags", "5", False, 2),
            (2, "Mug", "C9", 9, "1 piece", "8", True, 1),
        ],
        "customers": [(1, "Ann Ltd", None, None, None, None, "USA", None, 2)],
        "employees": FIRST["employees"],
        "orders": [(1, 1, 1, JULY, 1, "20", 2), *FIRST["orders"][1:4]]
        + [(5, 1, 1, JULY, 1, "6", 2), (6, 1, 1, JULY, 1, "6", 2), FIRST["orders"][6]],
        # One line is gone; the unknown product's line is gone too.
        "order_details": [
            FIRST["order_details"][0],
            *FIRST["order_details"][2:4],
            *FIRST["order_details"][5:],
        ],
    }
    run_incremental(spark, micro.sources(spark, **second), store, at(3))
    third = {**second, "order_details": [*second["order_details"], (1, 2, "8", 5, "0.25", 3)]}
    run_incremental(spark, micro.sources(spark, **third), store, at(4))
    return store


def test_first_load(store):
    assert entries(store, 1) == [
        (1, 1, TX_ORIGINAL, 2, "2.5000"),
        (1, 2, TX_ORIGINAL, 5, "7.5000"),
        (2, 1, TX_ORIGINAL, 3, "0.0000"),
        (3, 1, TX_ORIGINAL, 1, "0.0000"),
        (4, 66, TX_ORIGINAL, 1, "4.0000"),
        (5, 1, TX_ORIGINAL, 0, "0.0000"),
    ]


def test_unknown_members(store):
    row = store.at().fact().filter("batch_id = 1 AND order_id = 4").first()
    assert (row.product_sk, row.customer_sk, row.employee_sk, row.shipper_sk) == (-1, -1, -1, -1)


def test_lines_without_a_calendar_day_wait(store):
    waiting = store.at(1).quarantine()
    assert sorted(r.order_id for r in waiting.collect()) == [6, 7]
    assert [r.order_id for r in store.at().quarantine().collect()] == [7]


def test_second_load(store):
    assert entries(store, 2) == [
        # The remaining line takes the whole of the new freight.
        (1, 1, TX_NEW_VERSION, 2, "20.0000"),
        (1, 1, TX_REVERSAL, -2, "-2.5000"),
        (1, 2, TX_DELETION, -5, "-7.5000"),
        (4, 66, TX_DELETION, -1, "-4.0000"),
        # A line of quantity 0 has no balance: it is booked again as a first sale.
        (5, 1, TX_ORIGINAL, 0, "0.0000"),
        (6, 1, TX_ORIGINAL, 1, "6.0000"),
    ]


def test_restored_line_is_a_first_sale_again(store):
    assert entries(store, 3) == [
        (1, 1, TX_NEW_VERSION, 2, "5.0000"),
        (1, 1, TX_REVERSAL, -2, "-20.0000"),
        (1, 2, TX_ORIGINAL, 5, "15.0000"),
    ]


def test_reversal_keeps_the_old_keys(store):
    keys = {
        r.tx_type: (r.product_sk, r.customer_sk)
        for r in store.at(2).fact().filter("order_id = 1 AND product_id = 1").collect()
    }
    assert keys == {TX_ORIGINAL: (1, 1), TX_REVERSAL: (1, 1), TX_NEW_VERSION: (3, 2)}


def test_dimension_history(store):
    tea = store.at().dim("dim_product").filter("product_id = 1").orderBy("version").collect()
    assert [(r.product_name, r.version, r.is_current) for r in tea] == [
        ("Tea", 1, False),
        ("Green Tea", 2, True),
    ]
    assert tea[0].valid_to == tea[1].valid_from and tea[1].valid_to is None
    # A member whose version moved gets a new version even if nothing else changed.
    assert store.at().dim("dim_customer").filter("customer_id = 1").count() == 2


def test_lookups_that_find_nothing_leave_nulls(store):
    mug = store.at().dim("dim_product").filter("product_id = 2").first()
    assert (mug.category_name, mug.supplier_name) == (None, None)
    names = {
        r.full_name: r.supervisor_name
        for r in store.at().dim("dim_employee").filter("employee_sk > 0").collect()
    }
    assert names == {"Eve Moss": None, "Ian Reed": "Eve Moss"}


def test_control(store):
    marks = {r.source_table: r.last_row_version for r in store.at().load_control().collect()}
    assert marks == {
        "products": 2,
        "customers": 2,
        "employees": 1,
        "shippers": 1,
        "orders": 2,
        "order_details": 3,
    }
    seeds = store.at(0).load_control().collect()
    assert len(seeds) == 6 and {r.last_row_version for r in seeds} == {0}


def test_unchanged_source_adds_nothing(spark, root):
    store = Store.create(spark, root, at(1))
    source = micro.sources(spark)
    assert run_incremental(spark, source, store, at(2), stream_epoch="s:0").fact_rows == 1
    result = run_incremental(spark, source, store, at(3))
    assert result.batch_id is None and store.at().last.batch_id == 1
    # A replay of the committed epoch does nothing either, whatever the source holds by now.
    changed = micro.sources(spark, order_details=[(1, 1, "5", 9, "0", 2)])
    replay = run_incremental(spark, changed, store, at(3), stream_epoch="s:0")
    assert replay.batch_id is None and len(entries(store)) == 1


def test_failed_batch_can_be_run_again(spark, root, monkeypatch):
    store = Store.create(spark, root, at(1))
    run_incremental(spark, micro.sources(spark), store, at(2))
    changed = micro.sources(
        spark,
        products=[(1, "Tea", "C1", 1, "10 bags", "6", False, 2)],
        order_details=[(1, 1, "5", 3, "0", 2)],
    )

    def broken(*_):
        raise OSError("disk gone")

    with monkeypatch.context() as patch:
        patch.setattr(Store, "commit", broken)
        with pytest.raises(OSError):
            run_incremental(spark, changed, store, at(3))
    assert store.at().last.batch_id == 1 and len(entries(store)) == 1
    assert store.at().dim("dim_product").filter("product_sk > 0").count() == 1
    run_incremental(spark, changed, store, at(3))
    assert entries(store, 2) == [
        (1, 1, TX_NEW_VERSION, 3, "10.0000"),
        (1, 1, TX_REVERSAL, -2, "-10.0000"),
    ]
    assert store.at().dim("dim_product").filter("product_sk > 0").count() == 2


def test_options(spark, root):
    """Roll-ups after every batch, no empty versions, freight re-spread after a deletion."""
    options = LoadOptions(only_if_changed=True, touch_on_delete=True, roll_up_rows=0, roll_up_share=0)
    store = Store.create(spark, root, at(1))
    both = [(1, 1, "5", 2, "0", 1), (1, 2, "5", 2, "0", 1)]
    run_incremental(spark, micro.sources(spark, order_details=both), store, at(2), options)
    assert [r.upto for r in store.at().last.of("positions")] == [1]
    bumped = [(1, "Tea", "C1", 1, "10 bags", "5", False, 2)]
    one = micro.sources(spark, order_details=both[:1], products=bumped)
    run_incremental(spark, one, store, at(3), options)
    assert entries(store, 2) == [
        (1, 1, TX_NEW_VERSION, 2, "10.0000"),
        (1, 1, TX_REVERSAL, -2, "-5.0000"),
        (1, 2, TX_DELETION, -2, "-5.0000"),
    ]
    assert store.at().dim("dim_product").filter("product_id = 1").count() == 1
    rolled = store.at().positions().collect()
    assert [(r.order_id, r.product_id, r.quantity) for r in rolled] == [(1, 1, 2)]
    # Nothing is left to do, with the balances read from the roll-up.
    assert run_incremental(spark, one, store, at(4), options).fact_rows == 0
    # Compaction changes files only.
    def state():
        rows = store.at().fact().drop("fact_id").collect()
        return sorted(map(str, rows)), sorted(map(str, store.at().dim("dim_product").collect()))

    was = state()
    store.compact(at(5))
    assert state() == was and store.numbers() == [0, 1, 2, 3]
    assert len(store.at().last.of("fact_sales")) == 1 < len(store.at(2).last.of("fact_sales"))
    more = micro.sources(spark, order_details=[(1, 1, "5", 4, "0", 2)], products=bumped)
    run_incremental(spark, more, store, at(6))
    assert entries(store, 4) == [
        (1, 1, TX_NEW_VERSION, 4, "10.0000"),
        (1, 1, TX_REVERSAL, -2, "-10.0000"),
    ]


def test_full_refresh_leaves_out_unmatched_and_logs(spark, root):
    store = Store.create(spark, root, at(1))
    source = micro.sources(spark, **FIRST)
    run_full_refresh(spark, source, store, at(2), ratio_mode="money")
    assert [e[:2] for e in entries(store)] == [(1, 1), (1, 2), (2, 1), (3, 1), (5, 1)]
    assert store.at().dim("dim_product").filter("product_sk = -1").count() == 1
    again = micro.sources(spark)
    run_full_refresh(spark, again, store, at(3))
    assert [e[:2] for e in entries(store)] == [(1, 1)]
    assert len(store.at(1).fact().collect()) == 5  # the old star is still readable as it was
    steps = [r.step for r in store.log_history().collect()]
    assert steps[0] == "FIN_ETL" and len(steps) == 14


def test_refresh_then_incremental_books_what_was_left_out(spark, root):
    """Lines without a member wait through a full refresh; the next load books them."""
    store = Store.create(spark, root, at(1))
    late = micro.sources(spark, orders=[(1, 77, 1, JULY, 1, "10", 1)])
    run_full_refresh(spark, late, store, at(2))
    assert entries(store) == []
    assert "1 lines wait" in store.log_history().filter("step = 'fact_sales'").first().message
    changed = micro.sources(
        spark, orders=[(1, 77, 1, JULY, 1, "10", 1)], customers=[
            (1, "Ann Ltd", None, None, None, None, "USA", None, 1),
            (77, "Bo Ltd", None, None, None, None, "USA", None, 2),
        ],
        order_details=[(1, 1, "5", 2, "0", 2)],
    )
    run_incremental(spark, changed, store, at(3))
    assert [e[:4] for e in entries(store)] == [(1, 1, TX_ORIGINAL, 2)]
    star = store.at().star()
    orphans = star.fact.join(star.customer, "customer_sk", "left_anti")
    assert orphans.count() == 0
    assert star.customer.filter("customer_sk = -1").count() == 1


def test_a_line_whose_day_leaves_the_calendar_is_taken_back(spark, root):
    store = Store.create(spark, root, at(1))
    run_incremental(spark, micro.sources(spark), store, at(2))
    moved = micro.sources(spark, orders=[(1, 1, 1, datetime(2005, 1, 1), 1, "10", 2)])
    run_incremental(spark, moved, store, at(3))
    assert [e[:4] for e in entries(store, 2)] == [(1, 1, TX_REVERSAL, -2)]
    assert store.at().quarantine().count() == 1
    back = micro.sources(spark, orders=[(1, 1, 1, JULY, 1, "10", 3)])
    run_incremental(spark, back, store, at(4))
    assert [e[:4] for e in entries(store, 3)] == [(1, 1, TX_ORIGINAL, 2)]


def test_two_lines_of_one_product_are_two_lines(spark, root):
    store = Store.create(spark, root, at(1))
    both = [(1, 1, 1, "5", 2, "0", 1), (1, 1, 2, "5", 3, "0", 1)]
    run_incremental(spark, micro.sources(spark, order_details=both), store, at(2))
    run_incremental(spark, micro.sources(spark, order_details=both[:1]), store, at(3))
    assert [e[2:4] for e in entries(store, 1)] == [(TX_ORIGINAL, 2), (TX_ORIGINAL, 3)]
    assert [e[2:4] for e in entries(store, 2)] == [(TX_DELETION, -3)]


def test_a_star_is_not_created_twice(spark, root):
    Store.create(spark, root, at(1))
    with pytest.raises(FileExistsError):
        Store.create(spark, root, at(2))


def test_a_timed_stream_finds_deletions_without_a_notice(spark, root):
    """The line is gone from the source, but no version moved and no notice came."""
    import time

    from salesmart.streaming.runner import CHANGE_NOTICE, start_incremental_stream

    store = Store.create(spark, f"{root}/star", at(1))
    both = [(1, 1, "5", 2, "0", 1), (1, 2, "5", 3, "0", 1)]
    run_incremental(spark, micro.sources(spark, order_details=both), store, at(2))
    spark.createDataFrame([], CHANGE_NOTICE).write.parquet(f"{root}/notices")
    left = micro.sources(spark, order_details=both[:1])
    query = start_incremental_stream(
        spark, f"{root}/notices", lambda epoch: left, store, f"{root}/checkpoint", "timed",
        trigger={"processingTime": "1 second"}, timed=True,
    )
    until = time.time() + 120
    while store.at().last.batch_id < 2 and query.isActive and time.time() < until:
        time.sleep(0.5)
    query.stop()
    assert [e[1:4] for e in entries(store, 2)] == [(2, TX_DELETION, -3)]


def test_error_is_logged_and_raised(spark, root, monkeypatch):
    store = Store.create(spark, root, at(1))

    def broken(*_, **__):
        raise RuntimeError("no lines today")

    monkeypatch.setattr(pipeline.facts, "full_fact_rows", broken)
    with pytest.raises(RuntimeError, match="no lines today"):
        run_full_refresh(spark, micro.sources(spark), store, at(2))
    last = store.log_history().first()
    assert (last.step, last.status) == ("ERROR_ETL", "ERROR")
    assert "no lines today" in last.message
    assert store.at().last.batch_id == 0


def test_money_ratio_cuts_the_share(spark):
    from salesmart.functions.numeric import allocate

    third = spark.range(1).select(
        *[
            allocate(
                F.lit(Decimal("100.0000")),
                F.lit(Decimal("1.0000")),
                F.lit(Decimal("3.0000")),
                mode,
            ).alias(mode)
            for mode in ("float", "money")
        ]
    )
    assert [str(v) for v in third.first()] == ["33.3333", "33.3300"]


def test_views_for_readers(spark, store):
    store.at().register_views()
    rows = spark.sql(
        "SELECT customer_company_name, product_name, sum(sale_amount) AS sales FROM v_sales "
        "WHERE order_id = 1 AND year = 1996 GROUP BY ALL HAVING sum(quantity) > 0 ORDER BY 2"
    ).collect()
    assert [(r.customer_company_name, r.product_name, str(r.sales)) for r in rows] == [
        ("Ann Ltd", "Green Tea", "10.0000"),
        ("Ann Ltd", "Mug", "30.0000"),
    ]
    assert spark.table("dim_shipper").count() == 2


def test_version_filter_reaches_the_scan(spark):
    source = micro.stored(spark, micro.sources(spark))
    assert source.order_details.collect() == micro.sources(spark).order_details.collect()
    marks = pipeline.facts.Marks(orders_low=5, details_low=6)
    plan = pipeline.facts.affected_orders(source, marks)._jdf.queryExecution().toString()
    assert "GreaterThan(row_version,5)" in plan and "GreaterThan(row_version,6)" in plan

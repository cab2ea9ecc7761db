"""The store's runs, and the digests that find deleted lines."""

import random
from datetime import datetime, timedelta, timezone

import micro
import pytest
from pyspark.sql import functions as F

from salesmart.operators import digests, facts, ledger
from salesmart.plans import pipeline
from salesmart.plans.pipeline import LoadOptions, run_full_refresh, run_incremental
from salesmart.schema import DIM_KEYS, FACT, POSITION, TX_DELETION, TX_ORIGINAL
from salesmart.session import folder_names, stage_bucketed
from salesmart.sources.retail import order_details
from salesmart.sources.tables import read_parquet, write_parquet
from salesmart.store import FANOUT, CommitConflict, Store

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
JULY = datetime(1996, 7, 4)


def at(day):
    return START + timedelta(days=day)


# --- line numbers ---------------------------------------------------------------------------


def test_a_line_keeps_its_number_when_its_sibling_goes(spark):
    rows = [(1, 1, 5, 1, 2.0, 10.0, 0.0, JULY), (1, 1, 5, 2, 5.0, 25.0, 0.0, JULY), (1, 1, 6, 2, 5.0, 25.0, 0.0, None)]
    raw = spark.createDataFrame(
        rows,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_shipdate timestamp",
    )
    numbers = {(r.line_no, r.quantity) for r in order_details(raw).collect()}
    assert len({n for n, _ in numbers}) == 3
    left = {(r.line_no, r.quantity) for r in order_details(raw.filter("l_linenumber = 2")).collect()}
    assert left < numbers
    assert "Exchange" not in order_details(raw)._jdf.queryExecution().toString()


def test_a_deleted_sibling_is_one_deletion_and_no_new_version(spark, root):
    store = Store.create(spark, root, at(0))
    both = [(1, 1, 7, "5", 2, "0", 1), (1, 1, 9, "5", 5, "0", 1)]
    run_incremental(spark, micro.sources(spark, order_details=both), store, at(1))
    run_incremental(spark, micro.sources(spark, order_details=both[1:]), store, at(2))
    second = store.at().fact().filter("batch_id = 2").collect()
    assert [(r.tx_type, r.line_no, r.quantity) for r in second] == [(TX_DELETION, 7, -2)]
    net = ledger.net_positions(store.at().fact()).collect()
    assert [(r.line_no, r.quantity) for r in net] == [(9, 5)]


# --- digests --------------------------------------------------------------------------------


def lines_frame(spark, rows):
    return spark.createDataFrame(rows, "order_id long, product_id long, line_no long")


def test_digests_find_the_orders_that_differ(spark):
    rng = random.Random(4)
    before = [(o, rng.randrange(9), n) for o in range(300) for n in range(rng.randrange(1, 5))]
    after = [r for r in before if r[0] % 50 or r[2]] + [(900, 1, 1), (7, 3, 99)]
    stored = digests.of_orders(lines_frame(spark, before))
    actual = digests.of_orders(lines_frame(spark, after))
    found = {r.order_id: r.were for r in digests.changes(stored, actual).collect()}
    want = {o for o in range(1000) if {r for r in before if r[0] == o} != {r for r in after if r[0] == o}}
    assert set(found) == want and found[900] == 0 and found[7] > 0
    buckets = digests.per_bucket(stored, 8)
    moved = {r.bucket for r in spark.createDataFrame([(o,) for o in want], "order_id long").select(digests.bucket_of(8).alias("bucket")).collect()}
    assert digests.differing_buckets(buckets, lines_frame(spark, after), 8) == sorted(moved)
    # changes added to the stored digests give the actual ones
    summed = digests.merged(stored.unionByName(digests.changes(stored, actual).drop("were")))
    columns = ["order_id", "n", "s", "x"]
    assert sorted(map(tuple, summed.select(columns).collect())) == sorted(map(tuple, actual.select(columns).collect()))
    assert not digests.differing_buckets(digests.per_bucket(summed, 8), lines_frame(spark, after), 8)
    # a line that comes twice is not the same as none
    twice = digests.of_orders(lines_frame(spark, before + before[:1]))
    assert digests.changes(stored, twice).count() == 1


def test_an_unchanged_source_compares_no_order(spark, root, monkeypatch):
    store = Store.create(spark, root, at(0))
    lines = [(o, 1, "5", 2, "0", 1) for o in range(1, 20)]
    orders = [(o, 1, 1, JULY, 1, "10", 1) for o in range(1, 20)]
    source = micro.sources(spark, orders=orders, order_details=lines)
    run_incremental(spark, source, store, at(1))
    compared = []
    whole = digests.of_orders

    def counted(rows):
        compared.append(sorted(r.order_id for r in rows.select("order_id").distinct().collect()))
        return whole(rows)

    monkeypatch.setattr(pipeline.digests, "of_orders", counted)
    assert run_incremental(spark, source, store, at(2)).batch_id is None
    assert compared == []
    # a new line in one order: that order only, nothing else differs
    more = micro.sources(spark, orders=orders, order_details=[*lines, (3, 2, "5", 1, "0", 2)])
    run_incremental(spark, more, store, at(2))
    assert compared == [[3]]
    # a line that goes without a version: the orders of its bucket
    less = micro.sources(spark, orders=orders, order_details=[*lines[:4], *lines[5:], (3, 2, "5", 1, "0", 2)])
    result = run_incremental(spark, less, store, at(3))
    assert result.fact_rows == 1 and 1 <= len(compared[1]) < 19
    gone = store.at().fact().filter("batch_id = 3").collect()
    assert [(r.order_id, r.tx_type) for r in gone] == [(5, TX_DELETION)]
    assert run_incremental(spark, less, store, at(4)).batch_id is None


def test_sums_and_semi_joins_of_bucketed_lines_need_no_exchange(spark, root):
    source = micro.sources(
        spark,
        orders=[(o, 1, 1, JULY, 1, "10", 1) for o in range(40)],
        order_details=[(o, p, "5", 2, "0", 1) for o in range(40) for p in range(3)],
    )
    write_parquet(source, root, buckets=4)
    stored = read_parquet(spark, root, buckets=4)
    assert stored.order_details.count() == 120
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        touched = stage_bucketed(stored.orders.filter("order_id < 9").select("order_id"), f"{root}/touched", "order_id", 4)
        lines = facts.lines_of(stored, touched)
        plans = [
            digests.of_orders(stored.order_details),
            lines,
            facts.order_subtotals(lines),
            facts.order_heads(lines, stored.orders),
            stored.order_details.join(touched, "order_id", "left_anti"),
        ]
        for df in plans:
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Bucketed: true" in plan
        some = stored.order_details.filter(F.col("order_id").isin([3, 11]))
        plan = some._jdf.queryExecution().optimizedPlan().toString()
        assert some.count() == 6
        assert lines.count() == 27
        grouped = some.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "out of 4" in grouped and "4 out of 4" not in grouped
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


# --- balances -------------------------------------------------------------------------------


@pytest.mark.parametrize("options", [LoadOptions(), LoadOptions(roll_up_rows=2, roll_up_share=0.5)])
def test_balances_are_the_ledger_netted_after_every_batch(spark, root, options):
    rng = random.Random(8)
    store = Store.create(spark, root, at(0), buckets=4)
    lines = {(o, p): (2, 1) for o in range(1, 9) for p in (1, 2)}
    rolled = set()
    for day in range(1, 5):
        orders = [(o, 1, 1, JULY, 1, "10", 1) for o in range(1, 9)]
        details = [(o, p, "5", q, "0", v) for (o, p), (q, v) in sorted(lines.items())]
        run_incremental(spark, micro.sources(spark, orders=orders, order_details=details), store, at(day), options)
        now = store.at()
        want = ledger.rolled_up(ledger.as_positions(now.fact()))
        for buckets in (None, [1], [0, 3]):
            got = ledger.rolled_up(now.positions(buckets))
            here = want if buckets is None else want.filter(digests.bucket_of(4).isin(buckets))
            assert sorted(map(str, got.collect())) == sorted(map(str, here.collect()))
        source = {(r.order_id, r.product_id): r.quantity for r in ledger.net_positions(now.fact()).collect()}
        assert source == {k: q for k, (q, _) in lines.items()}
        rolled |= {(r.bucket, r.upto) for r in now.last.of("positions")}
        # a few lines change, one goes, one comes back
        for key in rng.sample(sorted(lines), 2):
            lines[key] = (rng.randrange(1, 9), day + 1)
        lines.pop(rng.choice(sorted(lines)))
    if options.roll_up_rows < 100:
        assert len({upto for _, upto in rolled}) > 1


def test_only_touched_buckets_are_read(spark, root):
    store = Store.create(spark, root, at(0), buckets=8)
    orders = [(o, 1, 1, JULY, 1, "10", 1) for o in range(1, 40)]
    details = [(o, 1, "5", 2, "0", 1) for o in range(1, 40)]
    source = micro.sources(spark, orders=orders, order_details=details)
    run_incremental(spark, source, store, at(1), LoadOptions(roll_up_rows=0))
    now = store.at()
    assert {r.bucket for r in now.last.of("positions")} == set(range(8))
    read = now.positions([5]).inputFiles()
    assert read and all("bucket=5" in f for f in read)
    assert {r.order_id for r in now.positions([5]).collect()} == {
        r.order_id for r in source.orders.filter(digests.bucket_of(8) == 5).collect()
    }


# --- dimensions -----------------------------------------------------------------------------


def test_new_versions_go_to_a_delta_until_they_are_many(spark, root):
    store = Store.create(spark, root, at(0))
    names = {p: "Tea" for p in range(1, 41)}
    versions = dict.fromkeys(names, 1)

    def load(day, changed):
        for p in changed:
            names[p], versions[p] = f"Tea {day}", day
        rows = [(p, names[p], "C1", 1, "10 bags", "5", False, versions[p]) for p in names]
        run_incremental(spark, micro.sources(spark, products=rows), store, at(day), LoadOptions(rebase_share=0.2))
        return store.at().last

    first = load(1, [])
    base = first.of("dim_product/base")
    assert [r.rows for r in base] == [41] and not first.of("dim_product/delta")
    second = load(2, [3, 4])
    then = dict(names)
    assert second.of("dim_product/base") == base
    assert [r.rows for r in second.of("dim_product/delta")] == [2]
    assert [r.rows for r in second.of("dim_product/expired")] == [2]
    third = load(3, [4, 5])
    assert third.of("dim_product/base") == base and len(third.of("dim_product/delta")) == 2
    assert third.of("dim_customer/base") == first.of("dim_customer/base")

    def check(now, names=names):
        current = {r.product_id: (r.product_name, r.version) for r in now.current_dim("dim_product").collect()}
        assert {p: n for p, (n, _) in current.items() if p} == names
        rows = now.dim("dim_product").filter("product_sk > 0")
        bad = rows.groupBy("product_id").agg(
            F.max("version").alias("top"), F.count(F.lit(1)).alias("n"), F.count_if("is_current").alias("now"),
            F.countDistinct("product_sk").alias("keys"),
        ).filter("top <> n OR now <> 1 OR keys <> n")
        assert bad.count() == 0
        return rows.count()

    assert check(store.at(2), then) == 42 and check(store.at(3)) == 44
    fourth = load(4, range(10, 16))
    assert not fourth.of("dim_product/delta") and [r.rows for r in fourth.of("dim_product/base")] == [41]
    assert not fourth.of("dim_product/expired") and sum(r.rows for r in fourth.of("dim_product/history")) == 10
    assert check(store.at()) == 50
    assert store.at(3).dim("dim_product").filter("product_sk > 0").count() == 44


# --- runs -----------------------------------------------------------------------------------


def test_cost_stays_level_over_many_batches(spark, root):
    """Fifty loads of five rows: few runs, few rows written a batch, old states still readable."""
    store = Store.create(spark, root, at(0))
    names = FACT.fieldNames()
    written = []
    for day in range(1, 51):
        batch = store.at().last.following(at(day), "test")
        rows = spark.range(5).select(
            *[F.lit("x" if f == "tx_type" else 1).cast(FACT[f].dataType).alias(f) for f in names],
            F.lit(day).cast("long").alias("batch_id"),
        ).coalesce(1)
        batch = batch.adding(store.write(batch, "fact_sales", rows))
        before = {r.path for r in store.at().last.runs}
        batch = store.merge_runs(batch)
        store.commit(batch)
        written.append(sum(r.rows for r in batch.runs if r.path not in before))
        assert len(batch.of("fact_sales")) < 2 * FANOUT
    assert store.at().fact().count() == 250
    assert store.at(17).fact().count() == 85
    assert sum(written) <= 250 * 3  # each row once per size class
    assert max(written) <= 5 * FANOUT
    files = folder_names(spark, f"{root}/fact_sales")
    kept = store.expire(keep=5)
    assert kept == list(range(46)) and store.numbers() == [46, 47, 48, 49, 50]
    assert len(folder_names(spark, f"{root}/fact_sales")) < len(files) / 2
    assert [store.at(n).fact().count() for n in range(46, 51)] == [5 * n for n in range(46, 51)]
    with pytest.raises(FileNotFoundError):
        store.at(45)
    assert not store.expire(keep=5)


def test_two_writers_cannot_commit_one_batch(spark, root):
    store = Store.create(spark, root, at(0))
    one, two = (store.at().last.following(at(1), kind) for kind in ("one", "two"))
    store.commit(one)
    with pytest.raises(CommitConflict):
        store.commit(two)
    assert store.at().last.kind == "one" and store.numbers() == [0, 1]


def test_batches_can_be_kept_for_a_while(spark, root):
    store = Store.create(spark, root, at(0))
    for day in (1, 2, 3):
        lines = [(1, 1, "5", day, "0", day)]
        run_incremental(spark, micro.sources(spark, order_details=lines), store, at(day), LoadOptions(keep_batches=2))
    assert store.numbers() == [2, 3]
    assert [store.at(n).fact().agg(F.sum("quantity")).first()[0] for n in (2, 3)] == [2, 3]
    assert not folder_names(spark, f"{root}/stage")  # what attempts staged is gone


# --- full refresh ---------------------------------------------------------------------------


def test_a_refresh_starts_digests_and_balances_anew(spark, root):
    store = Store.create(spark, root, at(0))
    both = [(1, 1, "5", 2, "0", 1), (1, 2, "5", 3, "0", 1)]
    run_incremental(spark, micro.sources(spark, order_details=both), store, at(1), LoadOptions(roll_up_rows=0))
    run_full_refresh(spark, micro.sources(spark, order_details=both), store, at(2))
    assert not store.at().last.of("positions")
    assert run_incremental(spark, micro.sources(spark, order_details=both), store, at(3)).batch_id is None
    result = run_incremental(spark, micro.sources(spark, order_details=both[1:]), store, at(3))
    assert result.fact_rows == 1
    assert store.at(1).fact().count() == 2


def test_a_run_that_is_killed_leaves_the_steps_it_came_to(spark, root, monkeypatch):
    store = Store.create(spark, root, at(0))

    def killed(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(pipeline.facts, "full_fact_rows", killed)
        with pytest.raises(KeyboardInterrupt):
            run_full_refresh(spark, micro.sources(spark), store, at(1))
    steps = [r.step for r in store.log_history().collect()]
    assert steps[-1] == "INICIO_ETL" and len(steps) == 1 + len(DIM_KEYS) and "FIN_ETL" not in steps
    run_full_refresh(spark, micro.sources(spark), store, at(1))
    rows = store.log_history().collect()
    assert [r.log_id for r in rows] == list(range(len(rows), 0, -1))
    assert len({r.attempt for r in rows}) == 2 and rows[0].step == "FIN_ETL"
    assert store.at().fact().filter(F.col("tx_type") == TX_ORIGINAL).count() == 1
    assert store.at().positions().schema == POSITION

"""What keeps the disk and the shuffles of large loads level."""

import os
from datetime import datetime, timezone
from pathlib import Path

import pytest

import micro
from salesmart.operators import ledger, ordering
from salesmart.plans.pipeline import LoadOptions, _slices, run_full_refresh, run_incremental
from salesmart.session import _FREE_SHUFFLES, freed_shuffles, stage
from salesmart.store import Batch, Run, Store, _groups

DAY = datetime(1996, 7, 4)


def at(number):
    return datetime(2026, 1, number, tzinfo=timezone.utc)


def source(spark, orders, version, gone=(), undated=()):
    """Orders of two lines each; `gone` have lost their second one."""
    days = {i: datetime(2050, 1, 1) if i in undated else DAY for i in range(1, orders + 1)}
    return micro.stored(
        spark,
        micro.sources(
            spark,
            orders=[(i, "1", 1, days[i], 1, "10", 1 + (i % 2) * (version - 1)) for i in days],
            order_details=[
                (i, 1, n, "5", 1 + n, "0", 1)
                for i in days
                for n in (1, 2)
                if n == 1 or i not in gone
            ],
        ),
    )


def loaded(spark, root, options):
    """Three batches: first sales, new versions with an order whose day is unknown, deletions."""
    store = Store.create(spark, root, at(1), buckets=4)
    run_incremental(spark, source(spark, 8, 1), store, at(2), options)
    run_incremental(spark, source(spark, 9, 2, undated=(9,)), store, at(3), options)
    run_incremental(spark, source(spark, 9, 2, gone=(4, 7), undated=(9,)), store, at(4), options)
    return store


def rows(df, *without):
    return sorted(map(str, (r.asDict() for r in df.drop(*without).collect())))


def test_a_load_in_slices_books_what_a_load_at_once_books(spark, root):
    whole = loaded(spark, f"{root}/whole", LoadOptions(roll_up_rows=0))
    parts = loaded(spark, f"{root}/parts", LoadOptions(roll_up_rows=0, orders_at_once=5))
    for number in (1, 2, 3):
        a, b = whole.at(number), parts.at(number)
        assert rows(a.fact(), "fact_id") == rows(b.fact(), "fact_id")
        assert rows(ledger.rolled_up(a.positions())) == rows(ledger.rolled_up(b.positions()))
        assert rows(a.read("digests").drop("s", "x").distinct()) == rows(
            b.read("digests").drop("s", "x").distinct()
        )
    assert rows(whole.at().quarantine()) == rows(parts.at().quarantine()) == ["{'order_id': 9}"]
    ids = [r.fact_id for r in parts.at().fact().collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_slices_hold_each_bucket_once():
    batch = Batch(1, at(1), "incremental", {}, {}, buckets=16)
    options = LoadOptions(orders_at_once=10)
    assert [s.buckets for s in _slices(10, batch, options)] == [None]
    some = _slices(35, batch, options)
    assert len(some) == 4 and sorted(b for s in some for b in s.buckets) == list(range(16))
    assert len(_slices(10**9, batch, options)) == 16
    # many orders are looked for in all balances
    booked = batch.adding(Run("fact_sales", "x", 10_000_000))
    assert len(_slices(30_000, booked, LoadOptions())) == 5
    assert len(_slices(30, booked, LoadOptions())) == 1


def test_buckets_are_rolled_up_in_groups():
    sizes = {0: 5, 1: 5, 2: 11, 3: 1, 5: 9}
    assert _groups([0, 1, 2, 3, 5], sizes, 10) == [[0, 1], [2], [3, 5]]
    assert _groups([], sizes, 10) == []


@pytest.mark.parametrize("at_once", [1, 10**6])
def test_a_roll_up_nets_each_bucket(spark, root, at_once):
    store = loaded(spark, root, LoadOptions(roll_up_rows=10**9))
    batch = store.at().last
    rolled = store.snapshot(store.roll_up(batch, list(range(batch.buckets)), at_once))
    assert not [r for r in rolled.last.of("positions") if r.rows and r.upto != batch.batch_id]
    want = rows(ledger.rolled_up(ledger.as_positions(store.at().fact())))
    assert rows(rolled.positions()) == want
    pending = {r.bucket: (r.pending, r.rolled) for r in rolled.read("buckets").collect()}
    assert all(p == 0 for p, _ in pending.values())
    assert sum(n for _, n in pending.values()) == len(want)


def test_numbering_shuffles_no_row(spark, root):
    stored = stage(spark.range(1000).repartition(7), f"{root}/rows")
    numbered, _ = ordering.stored_order_ids(stored, "n")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_shuffle_files_go_with_the_write(spark, root):
    local = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
                 .diskBlockManager().localDirs()[0].getPath())

    def shuffles():
        return {f for _, _, names in os.walk(local) for f in names if f.startswith("shuffle")}

    before, set_before = shuffles(), spark.conf.get(_FREE_SHUFFLES)
    with freed_shuffles(spark):
        with freed_shuffles(spark):
            stage(spark.range(1000).repartition(3, "id"), f"{root}/rows")
        assert spark.conf.get(_FREE_SHUFFLES) == "true"
    assert shuffles() <= before and spark.conf.get(_FREE_SHUFFLES) == set_before


@pytest.mark.parametrize("load", [run_incremental, run_full_refresh])
def test_a_load_leaves_no_shuffle_files_to_the_collector(spark, root, load, monkeypatch):
    seen = []
    write = Store.write

    def watched(self, *args, **more):
        seen.append(spark.conf.get(_FREE_SHUFFLES))
        return write(self, *args, **more)

    store = Store.create(spark, root, at(1))
    monkeypatch.setattr(Store, "write", watched)
    load(spark, source(spark, 3, 1), store, at(2))
    assert seen and set(seen) == {"true"}
    assert not any(Path(f"{root}/stage").glob("*"))


def test_the_ledger_is_stored_compact(spark, root):
    store = loaded(spark, root, LoadOptions(roll_up_rows=0))
    for dataset in ("fact_sales", "positions", "digests"):
        files = [f for f in Path(f"{root}/{dataset}").rglob("*.parquet")]
        assert files and all(".zstd." in f.name for f in files)


def test_new_lines_make_their_lookups_once(spark, small):
    import __spark_entry__

    plan = __spark_entry__.queries()["new_lines"](spark, small)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "fresh-" in plan and "order_details" not in plan

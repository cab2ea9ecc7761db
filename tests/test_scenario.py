"""The change scenario with known numbers of ledger rows, and what must hold after each batch."""

import pytest
from pyspark.sql import functions as F

from salesmart.operators import ledger
from salesmart.schema import DIM_KEYS, TX_DELETION, TX_NEW_VERSION, TX_ORIGINAL, TX_REVERSAL
from salesmart.sources.changes import ChangeRules
from salesmart.workspace import Workspace

RULES = ChangeRules(
    late_order="order_id % 10 = 0",
    recounted_order="order_id % 7 = 0",
    refreighted_order="order_id % 13 = 0",
    cancelled_line="order_id % 11 = 0 AND product_id % 2 = 0",
    repriced_product="product_id % 50 = 0",
    renamed_customer="customer_id % 100 = 0",
)

# Rows and units per batch and kind of entry.
EXPECTED = {
    (1, TX_ORIGINAL): (5396, 136881),
    (2, TX_ORIGINAL): (570, 14537),
    (2, TX_REVERSAL): (1030, -25754),
    (2, TX_NEW_VERSION): (1030, 26452),
    (2, TX_DELETION): (256, -6499),
    (3, TX_ORIGINAL): (290, 7465),
    (3, TX_REVERSAL): (243, -6457),
    (3, TX_NEW_VERSION): (243, 6457),
}
STATE_OF_BATCH = {1: 1, 2: 2, 3: 4}  # state 3 changes nothing and adds no batch


@pytest.fixture(scope="module")
def loaded(spark, small):
    work = Workspace(spark, small, RULES)
    return work, work.restored


def test_known_counts(loaded):
    _, store = loaded
    rows = store.at().fact().groupBy("batch_id", "tx_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units")
    )
    assert {(r.batch_id, r.tx_type): (r.n, r.units) for r in rows.collect()} == EXPECTED


@pytest.mark.parametrize("batch", [1, 2, 3])
def test_net_quantity_is_the_source(loaded, batch):
    work, store = loaded
    net = ledger.net_positions(store.at(batch).fact()).select(
        "order_id", "product_id", F.col("quantity").cast("int").alias("quantity")
    )
    source = work.states.state(STATE_OF_BATCH[batch]).order_details.select(
        "order_id", "product_id", "quantity"
    )
    assert net.exceptAll(source).count() == 0
    assert source.exceptAll(net).count() == 0


@pytest.mark.parametrize(("batch", "stale"), [(1, 0), (2, 72), (3, 0)])
def test_freight_is_spread_whole(loaded, batch, stale):
    """But for orders that lost a line, whose other lines keep their shares until touched."""
    work, store = loaded
    orders = work.states.state(STATE_OF_BATCH[batch]).orders
    shares = store.at(batch).fact().groupBy("order_id").agg(
        F.sum("freight_alloc").alias("spread"),
        F.countDistinct("product_id").alias("lines"),
        F.sum("quantity").alias("units"),
    )
    off = shares.filter("units > 0").join(orders, "order_id").filter(
        F.abs(F.col("spread") - F.col("freight")) > F.col("lines") * 0.0001
    )
    rows = [r.order_id for r in off.select("order_id").collect()]
    assert all(order % 11 == 0 for order in rows)
    assert len(rows) == stale


def test_every_reversal_takes_back_a_balance(loaded):
    _, store = loaded
    balances = ledger.net(ledger.as_positions(store.at().fact()))
    assert balances.filter("quantity < 0").count() == 0
    assert balances.filter("quantity = 0 AND (sale_amount <> 0 OR freight_alloc <> 0)").count() == 0


def test_ids_are_dense(loaded):
    _, store = loaded
    fact = store.at().fact()
    row = fact.agg(F.min("fact_id"), F.max("fact_id"), F.countDistinct("fact_id")).first()
    count = fact.count()
    assert tuple(row) == (1, count, count)


def test_versions_are_dense_with_one_current(loaded):
    _, store = loaded
    for dim, (sk, key) in DIM_KEYS.items():
        rows = store.at().dim(dim)
        bad = rows.groupBy(key).agg(
            F.max("version").alias("top"),
            F.count(F.lit(1)).alias("n"),
            F.count_if("is_current").alias("current"),
        )
        assert bad.filter("top <> n OR current <> 1").count() == 0
        assert rows.count() == rows.select(sk).distinct().count()


def test_as_of_reads_the_past(loaded):
    _, store = loaded
    assert store.at(1).fact().count() == 5396
    assert store.at(1).dim("dim_product").filter("version > 1").count() == 0
    assert store.at(0).fact().count() == 0

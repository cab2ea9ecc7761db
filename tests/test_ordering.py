"""Distributed numbering, running totals and ranks against plain Python, hot values included."""

import random
from decimal import Decimal
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from salesmart.operators import ordering
from salesmart.session import stage


@pytest.fixture
def values(spark):
    """A third of the rows share one value."""
    rng = random.Random(7)
    hot = [Decimal("50.0000")] * 400
    return hot + [Decimal(rng.randrange(0, 2000)).scaleb(-1).quantize(Decimal("0.0001"))
                  for _ in range(800)]


def test_dense_ids(spark):
    keys = random.Random(1).sample(range(10**9), 1000)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    rows = ordering.dense_ids(df, "k", "id", start=11).collect()
    assert {r.k: r.id for r in rows} == {k: i for i, k in enumerate(sorted(keys), 11)}


@pytest.mark.parametrize(
    "keys, kind", [([30, 10, None, 20], "long"), (["b", None, "a10", "a9"], "string")]
)
def test_dense_ids_of_any_type(spark, keys, kind):
    df = spark.createDataFrame([(k,) for k in keys], f"k {kind}")
    rows = ordering.dense_ids(df, "k", "id", start=5).collect()
    ordered = sorted(keys, key=lambda k: (k is not None, k))
    assert {r.k: r.id for r in rows} == {k: i for i, k in enumerate(ordered, 5)}
    assert not ordering.dense_ids(df.filter("false"), "k", "id").collect()


def test_ids_in_stored_order(spark, root):
    stored = stage(spark.range(1000).repartition(7), f"{root}/rows")
    numbered, count = ordering.stored_order_ids(stored, "n", start=100)
    numbers = [r.n for r in numbered.collect()]
    assert count == 1000 and sorted(numbers) == list(range(100, 1100))
    nothing, none = ordering.stored_order_ids(
        stage(spark.range(0), f"{root}/none"), "n", start=1
    )
    assert none == 0 and nothing.count() == 0


@pytest.mark.parametrize("descending", [True, False])
def test_running_total(spark, values, descending):
    df = spark.createDataFrame([(v,) for v in values], "v decimal(19,4)")
    got = {
        r.v: r.t
        for r in ordering.running_total(df, "v", {"t": F.sum("v")}, descending).collect()
    }
    ordered = sorted(values, reverse=descending)
    want = dict(zip(ordered, accumulate(ordered)))  # the last of equal values wins
    assert got == want


def test_null_values_keep_their_rows(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7), (4, None), (5, 5)], "i int, v int")
    ranks = {r.i: r.r for r in ordering.rank_descending(df, "v", "r").collect()}
    assert ranks == {3: 1, 1: 2, 5: 2, 2: 4, 4: 4}
    upto = ordering.with_running_total(df, "v", {"n": F.count("i")}).collect()
    assert {r.i: r.n for r in upto} == {3: 1, 1: 3, 5: 3, 2: 5, 4: 5}


def test_rank(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v decimal(19,4)")
    got = {r.i: r.r for r in ordering.rank_descending(df, "v", "r").collect()}
    assert got == {i: 1 + sum(w > v for w in values) for i, v in enumerate(values)}

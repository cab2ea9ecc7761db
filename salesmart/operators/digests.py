"""Which orders lost a line, found without comparing lines.

A set of order lines is told by a digest: how many, the sum and the exclusive or of their hashes.
Digests add up, over orders to buckets and over batches to states, and can be taken off again.
An order's bucket is the one that Spark's bucketed tables give it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.ledger import LINE
from salesmart.schema import DIGEST

_SUM = DIGEST["s"].dataType


def bucket_of(buckets: int, column: str = "order_id") -> Column:
    return F.pmod(F.hash(column), F.lit(buckets)).cast("int")


def _hashed(lines: DataFrame) -> DataFrame:
    line = F.xxhash64(*LINE)
    return lines.select(
        "order_id", F.lit(1).cast("long").alias("n"), line.cast(_SUM).alias("s"), line.alias("x")
    )


def _summed(digests: DataFrame, key: str | Column, *more: str) -> DataFrame:
    return digests.groupBy(key).agg(
        F.sum("n").alias("n"),
        F.sum("s").cast(_SUM).alias("s"),
        F.bit_xor("x").alias("x"),
        *[F.sum(c).alias(c) for c in more],
    )


def _any() -> Column:
    return (F.col("n") != 0) | (F.col("s") != 0) | (F.col("x") != 0)


def of_orders(lines: DataFrame) -> DataFrame:
    """The digest of each order's lines; no exchange where the lines are bucketed by order."""
    return _summed(_hashed(lines), "order_id")


def of_buckets(lines: DataFrame, buckets: int) -> DataFrame:
    """The digest of each bucket: every task sends one row per bucket, no line moves."""
    return _summed(_hashed(lines), bucket_of(buckets).alias("bucket"))


def taken_off(digests: DataFrame) -> DataFrame:
    """The digests with their sign turned; an exclusive or takes itself back."""
    return digests.withColumns({"n": -F.col("n"), "s": (-F.col("s")).cast(_SUM)})


def merged(digests: DataFrame) -> DataFrame:
    """Signed digests added up per order; orders without lines are left out."""
    return _summed(digests.select("order_id", "n", "s", "x"), "order_id").filter(_any())


def per_bucket(digests: DataFrame, buckets: int) -> DataFrame:
    """Signed digests of orders added up per bucket."""
    return _summed(digests, bucket_of(buckets).alias("bucket"))


def changes(stored: DataFrame, actual: DataFrame) -> DataFrame:
    """For orders whose digests differ, what brings the stored to the actual one, and how many
    lines were stored."""
    columns = ["order_id", "n", "s", "x"]
    new = actual.select(*columns, F.lit(0).cast("long").alias("were"))
    old = taken_off(stored.select(*columns, F.col("n").alias("were")))
    return _summed(new.unionByName(old), "order_id", "were").filter(_any())


def differing_buckets(stored: DataFrame, lines: DataFrame, buckets: int) -> list[int]:
    """Buckets that hold other lines than stored; at most `buckets` numbers come to the driver."""
    columns = ["bucket", "n", "s", "x"]
    both = stored.select(*columns).unionByName(taken_off(of_buckets(lines, buckets)))
    return sorted(r.bucket for r in _summed(both, "bucket").filter(_any()).collect())

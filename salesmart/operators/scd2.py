"""Slowly changing dimensions of type 2.

A dimension is kept as its current rows and its expired rows. Every natural key has exactly one
current row, which holds its highest version, so a batch never has to read the expired rows. A
batch gives the rows that it expires and their successors, whose number follows the delta.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.ordering import dense_ids
from salesmart.operators.versions import same_values
from salesmart.schema import DIM_ATTRS, DIM_KEYS, DIMS, UNKNOWN_SK, conform


@dataclass(frozen=True)
class Scd2Change:
    successors: DataFrame
    expired: DataFrame


def next_versions(current: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """The version each changed member gets: that of its current row, its highest, plus one; or 1."""
    highest = current.select(key, F.col("version").alias("__top"))
    version = (F.coalesce(F.col("__top"), F.lit(0)) + 1).cast("int")
    return delta.join(highest, key, "left").withColumn("version", version).drop("__top")


def really_changed(current: DataFrame, delta: DataFrame, dim: str) -> DataFrame:
    """Members of `delta` that are new or differ from their current row in an attribute."""
    sk, key = DIM_KEYS[dim]
    attrs = [name for name, _ in DIM_ATTRS[dim]]
    return (
        delta.alias("n")
        .join(current.alias("o"), F.col(f"n.{key}") == F.col(f"o.{key}"), "left")
        .filter(F.col(f"o.{sk}").isNull() | ~same_values("n", "o", attrs))
        .select("n.*")
    )


def scd2_apply(
    current: DataFrame,
    delta: DataFrame,
    dim: str,
    batch_ts: datetime,
    first_sk: int,
) -> Scd2Change:
    """The expired row and the new version of every member in `delta`.

    Any member in `delta` gets a new version, even when no attribute differs; `really_changed`
    leaves those out. New versions get surrogate keys from `first_sk` on, by natural key.
    """
    sk, key = DIM_KEYS[dim]
    attrs = [name for name, _ in DIM_ATTRS[dim]]
    fresh = dense_ids(delta, key, sk, first_sk)
    now = F.lit(batch_ts).cast("timestamp")
    replaced = current.join(delta.select(key), key, "left_semi")
    expired = replaced.withColumns({"valid_to": now, "is_current": F.lit(False)})
    successors = next_versions(replaced, fresh, key).select(
        sk,
        key,
        *attrs,
        "version",
        now.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        "source_version",
    )
    return Scd2Change(conform(successors, DIMS[dim]), conform(expired, DIMS[dim]))


def first_versions(
    members: DataFrame, dim: str, batch_ts: datetime, first_sk: int = 1
) -> DataFrame:
    """Every member as version 1, for a load into an emptied dimension."""
    sk, key = DIM_KEYS[dim]
    loaded = dense_ids(members, key, sk, first_sk).withColumns(
        {
            "version": F.lit(1),
            "valid_from": F.lit(batch_ts).cast("timestamp"),
            "valid_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )
    return conform(loaded, DIMS[dim])


def unknown_member(spark: SparkSession, dim: str, batch_ts: datetime) -> DataFrame:
    """The row that facts point at when a lookup finds no member."""
    fixed = {
        DIM_KEYS[dim][0]: UNKNOWN_SK,
        "version": 1,
        "valid_from": batch_ts,
        "is_current": True,
    }
    row = tuple(fixed.get(name) for name in DIMS[dim].fieldNames())
    return spark.createDataFrame([row], DIMS[dim])

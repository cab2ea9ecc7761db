"""Operator 3: contiguous shards of equal size, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import Scratch

SHARDS = 8
# A path and a number per file: some ten megabytes. More files are joined by a shuffle.
MAX_BROADCAST_FILES = 50_000


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text and one for its end; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def assign_shards(
    docs: DataFrame,
    size: Column,
    shards: int = SHARDS,
    key: str = "doc_id",
    names: tuple[str, str] = ("shard", "slot"),
) -> DataFrame:
    """Put rows, in the order of `key`, into contiguous shards whose sizes are as near equal as
    whole rows allow.

    Rows are sorted into files by a range exchange; equal keys keep the order of the input, so a
    key that a third of the rows share is split too. Each file's bytes and rows are summed, the
    sums of the files before it are its offset, and a row lies in the shard that holds the middle
    of its bytes. Only file totals meet in one task, only
    one number per shard comes to the driver.

    Adds the shard (0 to `shards` - 1) and the row's slot in it (gapless from 0); columns of
    those names are replaced. Null keys come first. A size below one counts as one, a null size
    too. An empty table gives an empty table; shards may stay empty when rows are fewer.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    scratch = Scratch(docs.sparkSession, "shards")
    shard, slot = names
    docs = docs.drop(*[n for n in names if n != key])
    row, own = "__row", "__size"
    sized = docs.withColumn(own, F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)).cast("long"))
    order = [F.col(key).asc_nulls_first(), F.col(row)]
    ordered = scratch.stage(
        sized.withColumn(row, F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop(row)
    )
    placed = ordered.select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias(row)
    )
    files = placed.groupBy("__file").agg(
        F.sum(own).alias("__bytes"), F.count(F.lit(1)).alias("__rows")
    )
    earlier = Window.orderBy(F.length("__file"), "__file").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    files = files.select(
        "__file",
        F.coalesce(F.sum("__bytes").over(earlier), F.lit(0)).alias("__bytes_before"),
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows_before"),
        F.sum("__bytes").over(whole).alias("__total"),
    )
    inside = Window.partitionBy("__file").orderBy(row)
    end = F.sum(own).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    middle = (F.col("__bytes_before") + F.col("__end")) * 2 - F.col(own)
    # the whole number keeps the cut exact: middle / (2 total) of all shards
    at = F.expr(f"least({shards - 1}, __middle * {shards} div (2 * __total))")
    located = (
        placed.select("__file", row, own)
        .withColumn("__end", end)
        .join(files, "__file")
        .withColumn("__middle", middle)
        .select((F.col("__rows_before") + F.col(row)).alias("__place"), at.alias("__at"))
    )
    firsts = located.groupBy("__at").agg(F.min("__place")).orderBy("__at").collect()
    before = files.select("__file", "__rows_before")
    if files.count() <= MAX_BROADCAST_FILES:
        before = F.broadcast(before)
    place = F.col("__rows_before") + F.col(row)
    shard_of, first_of = F.lit(0), F.lit(0).cast("long")
    for at_shard, first in firsts:
        shard_of = F.when(place >= first, F.lit(at_shard)).otherwise(shard_of)
        first_of = F.when(place >= first, F.lit(first)).otherwise(first_of)
    return (
        placed.join(before, "__file")
        .withColumns({shard: shard_of.cast("int"), slot: (place - first_of).cast("long")})
        .drop("__file", row, own, "__rows_before")
    )

"""Streamed loads beside batch loads, over the same source states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.dimensions import changed_since
from salesmart.plans.pipeline import run_incremental
from salesmart.schema import DIM_KEYS, DIM_SOURCE, MONEY_SUM
from salesmart.session import scratch_path
from salesmart.streaming.runner import CHANGE_NOTICE, start_incremental_stream
from salesmart.workspace import Workspace, batch_time


def write_notices(workspace: Workspace, number: int, path: str) -> None:
    """The changed order lines of one source state, as notices."""
    sources = workspace.states.state(number)
    changed = changed_since(sources.order_details, number - 1)
    notices = changed.select(
        F.lit("order_details").alias("source_table"),
        F.col("order_id").cast("string").alias("key"),
        F.col("row_version").alias("row_version"),
    ).select(*CHANGE_NOTICE.fieldNames())
    notices.write.mode("append").parquet(path)


def write_all_notices(workspace: Workspace, number: int, path: str) -> None:
    """Every changed row of one source state, as notices."""
    sources = workspace.states.state(number)
    keys = {DIM_SOURCE[dim]: key for dim, (_, key) in DIM_KEYS.items()}
    keys |= {"orders": "order_id", "order_details": "order_id"}
    for source, key in keys.items():
        changed_since(sources[source], number - 1).select(
            F.lit(source).alias("source_table"),
            F.col(key).cast("string").alias("key"),
            "row_version",
        ).write.mode("append").parquet(path)


def ledger_by_notices(workspace: Workspace) -> DataFrame:
    """The ledger of a stream that sweeps each other epoch: state 1 by a sweep, state 2 by its
    notices, and then, with no notice, the lines that were deleted in state 2."""
    spark = workspace.spark
    folder = scratch_path(spark, "notices")
    streamed = workspace.new_store(f"noticed-{folder[-12:]}")
    write_notices(workspace, 1, f"{folder}/notices")
    for epoch in range(2):
        if epoch:
            write_all_notices(workspace, 2, f"{folder}/notices")
        start_incremental_stream(
            spark,
            f"{folder}/notices",
            lambda e: workspace.states.state(e + 1),
            streamed,
            f"{folder}/checkpoint",
            "noticed",
            trigger={"availableNow": True},
            clock=lambda e: batch_time(e + 1),
            sweep_every=2,
        ).awaitTermination()
    run_incremental(spark, workspace.states.state(2), streamed, batch_time(3))
    return streamed.at(3).fact()


def stream_and_batch_ledgers(workspace: Workspace) -> DataFrame:
    """Rows and sums of the ledger per batch and kind of entry, streamed and by batch calls."""
    spark, batched = workspace.spark, workspace.incremental
    folder = scratch_path(spark, "stream")
    streamed = workspace.new_store(f"streamed-{folder[-12:]}")
    for epoch in range(2):
        write_notices(workspace, epoch + 1, f"{folder}/notices")
        query = start_incremental_stream(
            spark,
            f"{folder}/notices",
            lambda e: workspace.states.state(e + 1),
            streamed,
            f"{folder}/checkpoint",
            "check",
            trigger={"availableNow": True},
            clock=lambda e: batch_time(e + 1),
        )
        query.awaitTermination()

    def summed(df: DataFrame, suffix: str) -> DataFrame:
        return df.groupBy("batch_id", "tx_type").agg(
            F.count(F.lit(1)).alias(f"rows_{suffix}"),
            F.sum("quantity").alias(f"units_{suffix}"),
            F.sum("sale_amount").cast(MONEY_SUM).alias(f"sales_{suffix}"),
            F.sum("freight_alloc").cast(MONEY_SUM).alias(f"freight_{suffix}"),
        )

    return summed(streamed.at(2).fact(), "stream").join(
        summed(batched.at(2).fact(), "batch"), ["batch_id", "tx_type"], "full_outer"
    )



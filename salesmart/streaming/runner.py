"""The incremental load as a stream of change notices.

A notice names a member or an order that changed: a micro-batch loads what its notices name, all
lines of an order, because freight shares need them. A sweep, every so many epochs, reads the
versions above the marks and searches the whole source: it finds deletions, which leave no
notice, and changes whose notice was lost. The state between batches (marks, ledger) is in the
store, not in the stream.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesmart.plans.pipeline import LoadOptions, run_incremental
from salesmart.sources.tables import Sources
from salesmart.store import Store

CHANGE_NOTICE = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("row_version", T.LongType()),
    ]
)


def start_incremental_stream(
    spark: SparkSession,
    notices: str,
    sources_at: Callable[[int], Sources],
    store: Store,
    checkpoint: str,
    stream_name: str,
    trigger: dict | None = None,
    options: LoadOptions = LoadOptions(),
    clock: Callable[[int], datetime] | None = None,
    max_files: int | None = None,
    timed: bool = False,
    sweep_every: int = 1,
) -> StreamingQuery:
    """Run the load whenever change notices arrive, once a minute by default.

    `timed` also runs it at every trigger without a notice, by the rows of a clock: a row that is
    deleted from a source leaves no version and so no notice behind, and is found only then.

    Every epoch whose number `sweep_every` divides is a sweep, all of them by default; the others
    load what their notices name.

    `sources_at` gives the sources to read in an epoch. An epoch that is replayed after a failure
    finds its number in the manifest and does nothing twice.
    """
    reader = spark.readStream.schema(CHANGE_NOTICE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def load(events: DataFrame, epoch: int) -> None:
        run_incremental(
            spark,
            sources_at(epoch),
            store,
            clock(epoch) if clock else None,
            options,
            stream_epoch=f"{stream_name}:{epoch}",
            notices=events if epoch % sweep_every else None,
        )

    events = reader.parquet(notices)
    if timed:
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        names = [F.lit(None).cast(f.dataType).alias(f.name) for f in CHANGE_NOTICE.fields]
        events = events.unionByName(ticks.select(*names))
    writer = events.writeStream.foreachBatch(load)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()

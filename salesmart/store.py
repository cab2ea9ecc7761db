"""The star on shared storage: immutable folders of Parquet, and one manifest row per batch that
names all folders which make up the star after it.

    dim_date/
    <dim>/base, delta             current rows: a base and the new rows of later batches
    <dim>/expired, history        rows that were replaced: since the base, and before it
    fact_sales/                   ledger rows
    positions/                    net balances of a bucket of orders
    digests/, buckets/            digests of the lines of orders, and what is known of each bucket
    quarantine/                   lines that wait for a member or a day
    noticed/                      versions that notices brought in since the last sweep
    manifest/batch_id=N           renamed into place last: what no manifest row names does not exist

A run is one such folder. What a batch adds is a new run, so its bytes follow its changes; runs of
one size class are merged when there are `FANOUT` of them, a dimension gets a new base when its deltas
pass a share of it, and a bucket's balances are rolled up when its newer ledger rows do. A manifest
row is whole by itself: a reader opens one row, whatever the number of batches. `Store.expire` removes old
rows and the runs that only they name.

A batch that fails leaves folders that no reader looks at. Two writers of one batch cannot both
commit: the second finds the row in its place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators import digests
from salesmart.operators.calendar import DEFAULT_END, DEFAULT_START, build_calendar
from salesmart.operators.ledger import as_positions, rolled_up
from salesmart.operators.scd2 import unknown_member
from salesmart.schema import (
    BUCKET,
    DIGEST,
    DIM_DATE,
    DIM_KEYS,
    DIMS,
    ETL_LOG,
    FACT,
    LOAD_CONTROL,
    NOTICED,
    POSITION,
    QUARANTINE,
    TRACKED,
    conform,
)
from salesmart.session import (
    CODEC,
    folder_names,
    in_parallel,
    remove_path,
    rename_path,
    stage,
    stage_counted,
)

#: Runs of one size class that are merged into one of the next.
FANOUT = 8
#: Buckets of orders, where `Store.create` is not told otherwise.
BUCKETS = 16
#: Balances and ledger rows that are rolled up at a time, a bucket at least, and in one task.
ROWS_AT_ONCE, ROWS_PER_TASK = 2_000_000, 500_000

_RUN = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("tier", T.IntegerType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("upto", T.LongType()),
    ]
)

_MANIFEST = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("batch_ts", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("marks", T.MapType(T.StringType(), T.LongType())),
        T.StructField("marked_at", T.MapType(T.StringType(), T.TimestampType())),
        T.StructField("next_sk", T.MapType(T.StringType(), T.LongType())),
        T.StructField("fact_rows", T.LongType()),
        T.StructField("next_fact_id", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("runs", T.ArrayType(_RUN)),
        T.StructField("stream_epoch", T.StringType()),
        T.StructField("attempt", T.StringType()),
    ]
)

_STORED_FACT = T.StructType(
    [*FACT.fields, T.StructField("batch_id", T.LongType())]  # the batch that added the row
)


class CommitConflict(RuntimeError):
    """Another writer has committed a batch of this number."""


@dataclass(frozen=True)
class Run:
    """One folder of a dataset."""

    dataset: str
    path: str
    rows: int
    tier: int = 0  # its size class: how often rows like its were merged
    bucket: int = -1  # of balances
    upto: int = 0  # the batch whose rows are the last in it


@dataclass(frozen=True)
class Batch:
    """One manifest row."""

    batch_id: int
    batch_ts: datetime
    kind: str
    marks: dict[str, int]
    marked_at: dict[str, datetime]
    next_sk: dict[str, int] = field(default_factory=lambda: {d: 1 for d in DIM_KEYS})
    fact_rows: int = 0
    next_fact_id: int = 1
    buckets: int = BUCKETS
    runs: tuple[Run, ...] = ()
    stream_epoch: str | None = None
    attempt: str = ""

    def following(self, batch_ts: datetime, kind: str) -> Batch:
        return replace(
            self,
            batch_id=self.batch_id + 1,
            batch_ts=batch_ts,
            kind=kind,
            fact_rows=0,
            stream_epoch=None,
            attempt=uuid.uuid4().hex[:12],
        )

    def of(self, *datasets: str) -> list[Run]:
        return [r for r in self.runs if r.dataset in datasets]

    def adding(self, *runs: Run) -> Batch:
        return replace(self, runs=(*self.runs, *runs))

    def without(self, *datasets: str) -> Batch:
        return replace(self, runs=tuple(r for r in self.runs if r.dataset not in datasets))

    def instead(self, old: Iterable[Run], *new: Run) -> Batch:
        gone = set(old)
        return replace(self, runs=(*[r for r in self.runs if r not in gone], *new))


def _batch(row: Row) -> Batch:
    values = {**row.asDict(), "runs": tuple(Run(**r.asDict()) for r in row.runs)}
    return Batch(**values)


@dataclass(frozen=True)
class Star:
    """The tables a report reads."""

    fact: DataFrame
    product: DataFrame
    customer: DataFrame
    employee: DataFrame
    shipper: DataFrame
    date: DataFrame

    def dim(self, name: str) -> DataFrame:
        return getattr(self, name.removeprefix("dim_"))


_SCHEMAS = {
    "fact_sales": _STORED_FACT,
    "positions": POSITION,
    "digests": DIGEST,
    "buckets": BUCKET,
    "noticed": NOTICED,
    "quarantine": QUARANTINE,
    **{f"{d}/{part}": s for d, s in DIMS.items() for part in ("base", "delta", "expired", "history")},
}


#: Datasets whose runs are merged, and how their rows are laid out or added up.
_MERGED = {
    # by day for the reports, by order within a day
    "fact_sales": lambda rows: rows.repartitionByRange("date_sk", "order_id").sortWithinPartitions(
        "date_sk", "order_id"
    ),
    "digests": digests.merged,
    **{f"{dim}/{part}": lambda rows: rows for dim in DIMS for part in ("delta", "expired", "history")},
}


class Snapshot:
    """The star as of one batch, or as far as a batch in work has come."""

    def __init__(self, spark: SparkSession, root: str, last: Batch):
        self._spark, self._root, self.last = spark, root, last

    def load_control(self) -> DataFrame:
        """One row per tracked source: its high-water mark and when that was set."""
        marks, times = self.last.marks, self.last.marked_at
        rows = [(t, marks.get(t, 0), times.get(t)) for t in TRACKED]
        return self._spark.createDataFrame(rows, LOAD_CONTROL)

    def read(self, *datasets: str, runs: list[Run] | None = None) -> DataFrame:
        """The rows of datasets of one schema, from the folders that the batch names."""
        schema = _SCHEMAS[datasets[0]]
        runs = self.last.of(*datasets) if runs is None else runs
        if not runs:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).parquet(*[f"{self._root}/{r.path}" for r in runs])

    def current_dim(self, dim: str) -> DataFrame:
        """Base and deltas without the rows that were replaced since; those are few, so the join
        filters the scan."""
        rows = self.read(f"{dim}/base", f"{dim}/delta")
        if not self.last.of(f"{dim}/expired"):
            return rows
        sk = DIM_KEYS[dim][0]
        return rows.join(self.read(f"{dim}/expired").select(sk), sk, "left_anti")

    def dim(self, dim: str) -> DataFrame:
        """All versions of all members."""
        return self.current_dim(dim).unionByName(self.read(f"{dim}/expired", f"{dim}/history"))

    def dim_date(self) -> DataFrame:
        return self._spark.read.schema(DIM_DATE).parquet(f"{self._root}/dim_date")

    def fact(self) -> DataFrame:
        """Ledger rows, with the number of the batch that added each."""
        return self.read("fact_sales")

    def positions(self, buckets: list[int] | None = None) -> DataFrame:
        """Everything booked so far, as balances to be netted: per bucket its last roll-up and the
        ledger rows after it. With `buckets` only theirs are read."""
        read = range(self.last.buckets) if buckets is None else buckets
        rolled = [r for r in self.last.of("positions") if r.bucket in set(read)]
        found = {r.bucket: r.upto for r in rolled}
        since = [found.get(b, 0) for b in range(self.last.buckets)]
        starts = {since[b] for b in read}
        least = min(starts, default=0)
        newer = [r for r in self.last.of("fact_sales") if r.upto > least]
        rows = self.read("fact_sales", runs=newer).filter(F.col("batch_id") > least)
        bucket = digests.bucket_of(self.last.buckets)
        if buckets is not None:
            rows = rows.filter(bucket.isin(buckets))
        if len(starts) > 1:
            start = F.element_at(F.array(*[F.lit(s) for s in since]), bucket + 1)
            rows = rows.filter(F.col("batch_id") > start)
        return self.read("positions", runs=rolled).unionByName(as_positions(rows))

    def quarantine(self) -> DataFrame | None:
        """Orders with lines that could not be booked for want of a member or a day."""
        runs = self.last.of("quarantine")
        return self.read("quarantine").distinct() if runs else None

    def star(self) -> Star:
        return Star(
            fact=self.fact(),
            product=self.dim("dim_product"),
            customer=self.dim("dim_customer"),
            employee=self.dim("dim_employee"),
            shipper=self.dim("dim_shipper"),
            date=self.dim_date(),
        )

    def register_views(self) -> None:
        """Temporary views for SQL and BI readers: the star's tables and the flat `v_sales`."""
        star = self.star()
        for dim in DIMS:
            star.dim(dim).createOrReplaceTempView(dim)
        star.date.createOrReplaceTempView("dim_date")
        star.fact.createOrReplaceTempView("fact_sales")
        flat_sales(star).createOrReplaceTempView("v_sales")


def _select(root: str, runs: list[Run], schema: T.StructType) -> str:
    """SQL over the folders of some runs."""
    names = ", ".join(f"`{f.name}`" for f in schema.fields)
    if not runs:
        nulls = ", ".join(f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in schema.fields)
        return f"select {nulls} where false"
    return " union all ".join(f"select {names} from parquet.`{root}/{r.path}`" for r in runs)


def star_sql(root: str, last: Batch) -> dict[str, str]:
    """The star's tables after a batch as SQL that needs nothing but Spark and the folders."""
    out = {
        "dim_date": f"select * from parquet.`{root}/dim_date`",
        "fact_sales": _select(root, last.of("fact_sales"), _STORED_FACT),
    }
    for dim, schema in DIMS.items():
        sk = DIM_KEYS[dim][0]
        rows = _select(root, last.of(f"{dim}/base", f"{dim}/delta"), schema)
        expired = last.of(f"{dim}/expired")
        if expired:
            gone = _select(root, expired, schema)
            rows = f"select * from ({rows}) c left anti join ({gone}) e on c.{sk} = e.{sk}"
        older = last.of(f"{dim}/expired", f"{dim}/history")
        out[dim] = f"{rows} union all {_select(root, older, schema)}" if older else rows
    return out


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        root: str,
        batch_ts: datetime,
        dim_date: DataFrame | None = None,
        buckets: int = BUCKETS,
    ) -> Store:
        """An empty star: the calendar, the unknown members, and all marks at version 0.

        A star that is there already is not touched.
        """
        store = cls(spark, root)
        if store.numbers():
            raise FileExistsError(f"there is a star at {store.root}")
        if dim_date is None:
            dim_date = build_calendar(spark, DEFAULT_START, DEFAULT_END)
        dim_date.write.mode("overwrite").parquet(f"{store.root}/dim_date")
        batch = Batch(
            batch_id=0,
            batch_ts=batch_ts,
            kind="create",
            marks={t: 0 for t in TRACKED},
            marked_at={t: batch_ts for t in TRACKED},
            buckets=buckets,
            attempt=uuid.uuid4().hex[:12],
        )
        members = in_parallel(
            lambda dim: store.write(batch, f"{dim}/base", unknown_member(spark, dim, batch_ts)), DIMS
        )
        store.commit(batch.adding(*members))
        return store

    def numbers(self) -> list[int]:
        """The committed batches that are kept, in order."""
        names = folder_names(self.spark, f"{self.root}/manifest")
        return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))

    def batches(self, *numbers: int) -> list[Batch]:
        """Some manifest rows, in order; all that are kept where none is named."""
        numbers = numbers or tuple(self.numbers())
        paths = [f"{self.root}/manifest/batch_id={n}" for n in numbers]
        if not paths:
            return []
        rows = self.spark.read.schema(_MANIFEST).parquet(*paths).collect()
        return sorted((_batch(r) for r in rows), key=lambda b: b.batch_id)

    def at(self, as_of: int | None = None) -> Snapshot:
        """The star as of a batch; as of the last committed one by default. One row is read."""
        numbers = [n for n in self.numbers() if as_of is None or n <= as_of]
        if not numbers:
            raise FileNotFoundError(f"no star at {self.root}; use Store.create")
        return self.snapshot(self.batches(numbers[-1])[0])

    def snapshot(self, batch: Batch) -> Snapshot:
        return Snapshot(self.spark, self.root, batch)

    def commit(self, batch: Batch) -> None:
        """Put the manifest row in its place, if there is none."""
        values = [getattr(batch, f) for f in _MANIFEST.fieldNames()]
        runs = [tuple(getattr(r, f) for f in _RUN.fieldNames()) for r in batch.runs]
        values[_MANIFEST.fieldNames().index("runs")] = runs
        frame = self.spark.createDataFrame([tuple(values)], _MANIFEST).coalesce(1)
        own = f"{self.root}/manifest/_{batch.attempt}"
        place = f"{self.root}/manifest/batch_id={batch.batch_id}"
        frame.write.mode("overwrite").parquet(own)
        moved = rename_path(self.spark, own, place)
        # of two renames at one time the later may have moved its folder into the other's
        if not moved or self.batches(batch.batch_id)[0].attempt != batch.attempt:
            raise CommitConflict(f"batch {batch.batch_id} of {self.root} is committed already")

    # --- writing ------------------------------------------------------------------------

    def write(
        self, batch: Batch, dataset: str, rows: DataFrame, tier: int = 0, name: str = ""
    ) -> Run:
        """A new run of a dataset, in a folder that no other attempt writes to."""
        path = f"{dataset}/{batch.batch_id}-{batch.attempt}{name}"
        schema = _SCHEMAS.get(dataset)
        rows = conform(rows, schema) if schema else rows
        _, count = stage_counted(rows, f"{self.root}/{path}")
        return Run(dataset, path, count, tier, upto=batch.batch_id)

    def merge_runs(self, batch: Batch) -> Batch:
        """Merge runs where `FANOUT` of one size class have come together, one class per dataset.

        A row is rewritten once per class, so a batch writes, on average, its own rows times the
        number of classes, however many batches there have been.
        """
        for dataset in _MERGED:
            by_tier: dict[int, list[Run]] = {}
            for run in batch.of(dataset):
                by_tier.setdefault(run.tier, []).append(run)
            full = [t for t, runs in sorted(by_tier.items()) if len(runs) >= FANOUT]
            if full:
                batch = self._merged(batch, dataset, by_tier[full[0]], full[0] + 1)
        return batch

    def _merged(self, batch: Batch, dataset: str, runs: list[Run], tier: int) -> Batch:
        rows = _MERGED[dataset](self.snapshot(batch).read(dataset, runs=runs))
        run = self.write(batch, dataset, rows, tier, f"-{tier}")
        return batch.instead(runs, run)

    def compact(self, batch_ts: datetime) -> None:
        """Merge all runs of each dataset, whatever their sizes. Rows keep their batch numbers."""
        batch = self.at().last.following(batch_ts, "compact")
        for dim in DIMS:
            batch = self.new_base(batch, dim)
        for dataset in _MERGED:
            runs = batch.of(dataset)
            if len(runs) > 1:
                batch = self._merged(batch, dataset, runs, max(r.tier for r in runs) + 1)
        batch = self.roll_up(batch, list(range(batch.buckets)))
        self.commit(replace(batch, stream_epoch=self.at().last.stream_epoch))

    def new_base(self, batch: Batch, dim: str) -> Batch:
        """The current rows of a dimension as one run; what had expired since the last base is
        history."""
        parts = [f"{dim}/base", f"{dim}/delta"]
        if len(batch.of(*parts)) < 2 and not batch.of(f"{dim}/expired"):
            return batch
        run = self.write(batch, f"{dim}/base", self.snapshot(batch).current_dim(dim), name="-base")
        expired = [replace(r, dataset=f"{dim}/history") for r in batch.of(f"{dim}/expired")]
        return batch.without(*parts, f"{dim}/expired").adding(run, *expired)

    def roll_up(self, batch: Batch, buckets: list[int], at_once: int = ROWS_AT_ONCE) -> Batch:
        """Net the balances of some buckets anew, each into a folder of its own.

        Rows are dealt by order, in as many parts as are a multiple of the buckets: a part is of one
        bucket then, and its rows are netted, sorted and written where they are. Buckets are taken
        in groups of so many rows `at_once`, so that what is shuffled at a time stays level.
        """
        if not buckets:
            return batch
        at = self.snapshot(batch)
        path = f"positions/{batch.batch_id}-{batch.attempt}"
        bucket = digests.bucket_of(batch.buckets)
        known = at.read("buckets")
        sizes = {r.bucket: r.pending + r.rolled for r in known.collect()}  # a row per bucket
        for some in _groups(buckets, sizes, at_once):
            most = max(sizes.get(b, 0) for b in some)
            parts = batch.buckets * max(1, -(-most // ROWS_PER_TASK))
            dealt = at.positions(some).repartition(parts, "order_id")
            rolled_up(dealt).withColumn("bucket", bucket).sortWithinPartitions(
                "bucket", "order_id"
            ).write.mode("append").partitionBy("bucket").parquet(
                f"{self.root}/{path}", compression=CODEC
            )
        written = {n for n in folder_names(self.spark, f"{self.root}/{path}") if n.startswith("bucket=")}
        counts = {}
        if written:
            stored = self.spark.read.parquet(f"{self.root}/{path}").groupBy("bucket").count()
            counts = {r["bucket"]: r["count"] for r in stored.collect()}  # a number per bucket
        runs = [
            Run("positions", f"{path}/bucket={b}", counts[b], bucket=b, upto=batch.batch_id)
            for b in sorted(counts)
        ]
        old = [r for r in batch.of("positions") if r.bucket in set(buckets)]
        if counts:
            sizes = F.array(*[F.lit(counts.get(b, 0)).cast("long") for b in range(batch.buckets)])
        else:
            sizes = F.array_repeat(F.lit(0).cast("long"), batch.buckets)
        due = F.col("bucket").isin(buckets)
        known = known.withColumns(
            {
                "pending": F.when(due, F.lit(0).cast("long")).otherwise(F.col("pending")),
                "rolled": F.when(due, F.element_at(sizes, F.col("bucket") + 1)).otherwise(F.col("rolled")),
            }
        )
        # a bucket whose balances are all zero has no folder: its older rows must not be read again
        empty = [
            Run("positions", f"{path}/none", 0, bucket=b, upto=batch.batch_id)
            for b in buckets
            if b not in counts
        ]
        if empty:
            stage(self.spark.createDataFrame([], POSITION), f"{self.root}/{path}/none")
        batch = batch.instead(old, *runs, *empty)
        table = self.write(batch, "buckets", known, name="-rolled")
        return batch.without("buckets").adding(table)

    # --- other readers ------------------------------------------------------------------------

    def publish(self, database: str, as_of: int | None = None) -> int:
        """Views of the star in a database of the session's catalog, for readers that have
        neither this package nor this session.

        The views of a batch are `<table>_at_<n>` and never change; `<table>` shows the batch published last.
        `published` holds its number and is replaced last: who reads several tables takes the
        number first and then the views that carry it. Views of batches that `expire` forgot are dropped.
        """
        last = self.at(as_of).last
        run = self.spark.sql
        run(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, sql in star_sql(self.root, last).items():
            run(f"CREATE OR REPLACE VIEW {database}.{name}_at_{last.batch_id} AS {sql}")
            run(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {database}.{name}_at_{last.batch_id}")
        run(f"CREATE OR REPLACE VIEW {database}.published AS SELECT {last.batch_id}L AS batch_id")
        kept = set(self.numbers())
        for row in run(f"SHOW VIEWS IN {database}").collect():  # a few per batch that is kept
            name, at, number = row.viewName.rpartition("_at_")
            if at and number.isdigit() and int(number) not in kept:
                run(f"DROP VIEW IF EXISTS {database}.{row.viewName}")
        return last.batch_id

    # --- expiry -------------------------------------------------------------------------------

    def expire(self, keep: int) -> list[int]:
        """Forget all batches but the last `keep`, and remove the runs that only they name."""
        numbers = self.numbers()
        old, kept = numbers[:-keep] if keep else [], numbers[-keep:]
        if keep < 1 or not old:
            return []
        named = {r.path for b in self.batches(*kept) for r in b.runs}
        gone = {r.path for b in self.batches(*old) for r in b.runs} - named
        # the rows first: a reader that still finds one finds its files
        for number in old:
            remove_path(self.spark, f"{self.root}/manifest/batch_id={number}")
        for path in sorted(gone):
            remove_path(self.spark, f"{self.root}/{path}")
        return old

    # --- audit log ------------------------------------------------------------------------

    def next_log_id(self) -> int:
        return (self._log().agg(F.max("log_id")).first()[0] or 0) + 1

    def append_log(self, entries: list[tuple]) -> None:
        """Append (log_id, run_at, step, rows, status, message, seconds, attempt) entries."""
        frame = self.spark.createDataFrame(entries, ETL_LOG).coalesce(1)
        frame.write.mode("append").parquet(f"{self.root}/etl_log")

    def _log(self) -> DataFrame:
        if not folder_names(self.spark, f"{self.root}/etl_log"):
            return self.spark.createDataFrame([], ETL_LOG)
        return self.spark.read.schema(ETL_LOG).parquet(f"{self.root}/etl_log")

    def log_history(self) -> DataFrame:
        """Log entries, newest first."""
        return self._log().orderBy(F.desc("log_id"))


def _groups(buckets: list[int], sizes: dict[int, int], at_once: int) -> list[list[int]]:
    """Buckets, in order, in groups of at most so many rows, or of one bucket."""
    groups: list[list[int]] = []
    rows = 0
    for b in buckets:
        rows += sizes.get(b, 0)
        if not groups or rows > at_once:
            groups.append([])
            rows = sizes.get(b, 0)
        groups[-1].append(b)
    return groups


def flat_sales(star: Star) -> DataFrame:
    """One row per ledger row with the dimension attributes a reader drills by."""

    def side(df: DataFrame, prefix: str, sk: str, columns: list[str]) -> DataFrame:
        return df.select(sk, *[F.col(c).alias(f"{prefix}_{c}") for c in columns])

    product = star.product.select(
        "product_sk", "product_name", "category_name", "supplier_name", "supplier_country"
    )
    customer = side(
        star.customer, "customer", "customer_sk", ["company_name", "country", "region", "city"]
    )
    employee = side(star.employee, "employee", "employee_sk", ["full_name", "title"])
    shipper = side(star.shipper, "shipper", "shipper_sk", ["company_name"])
    return (
        star.fact.join(product, "product_sk", "left")
        .join(customer, "customer_sk", "left")
        .join(employee, "employee_sk", "left")
        .join(shipper, "shipper_sk", "left")
        .join(star.date, "date_sk", "left")
    )

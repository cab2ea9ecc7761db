"""The two loads of the star: incremental, and full refresh with an audit log."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import digests, dimensions, facts, ledger
from salesmart.operators.ordering import stored_order_ids
from salesmart.operators.scd2 import (
    first_versions,
    really_changed,
    scd2_apply,
    unknown_member,
)
from salesmart.schema import DIM_KEYS, DIM_SOURCE, DIMS, FACT, conform
from salesmart.session import CODEC, freed_shuffles, in_parallel, remove_path, stage, stage_counted
from salesmart.sources.tables import Sources, max_versions
from salesmart.store import Batch, Run, Snapshot, Store

# Step and status names of the audit log.
STEP_START, STEP_END, STEP_ERROR = "INICIO_ETL", "FIN_ETL", "ERROR_ETL"
STATUS_START, STATUS_OK, STATUS_ERROR = "INICIO", "EXITO", "ERROR"


@dataclass(frozen=True)
class LoadOptions:
    only_if_changed: bool = False  # skip a new version when no attribute differs
    touch_on_delete: bool = False  # re-allocate the freight of orders that lost a line
    rebase_share: float = 0.25  # new rows of a dimension, as a share of its base, that make a new base
    # A bucket's balances are rolled up when its newer ledger rows are more than so many, and more
    # than this share of them.
    roll_up_rows: int = 100_000
    roll_up_share: float = 0.25
    # Orders whose lines or balances are joined and staged at a time: more of them are taken in groups
    # of buckets, one after the other, so that what a batch shuffles at a time stays level.
    orders_at_once: int = 500_000
    keep_batches: int | None = None  # how many batches stay readable; None: all


@dataclass(frozen=True)
class LoadResult:
    batch_id: int | None  # None: nothing had changed, nothing was committed
    fact_rows: int = 0
    dims_written: tuple[str, ...] = ()
    quarantined: bool = False


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


class _Work:
    """A folder for what one attempt at a batch stages; it goes when the attempt ends."""

    def __init__(self, store: Store, batch: Batch):
        self._store = store
        self.path = f"{store.root}/stage/{batch.batch_id}-{batch.attempt}"

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        return stage(df, f"{self.path}/{name}", codec=CODEC)

    def counted(self, name: str, df: DataFrame) -> tuple[DataFrame, int]:
        return stage_counted(df, f"{self.path}/{name}")

    def added(self, name: str, df: DataFrame) -> DataFrame:
        """What was staged under the name so far, and `df` after it."""
        return stage(df, f"{self.path}/{name}", mode="append", codec=CODEC)

    def used(self, *names: str) -> None:
        """What is staged under these names is not needed any more."""
        for name in names:
            remove_path(self._store.spark, f"{self.path}/{name}")

    def drop(self) -> None:
        remove_path(self._store.spark, self.path)


@dataclass(frozen=True)
class _Slice:
    """Some buckets of orders; None: all."""

    buckets: list[int] | None
    of: int

    def rows(self, df: DataFrame) -> DataFrame:
        if self.buckets is None:
            return df
        return df.filter(digests.bucket_of(self.of).isin(self.buckets))


#: So many order numbers are not broadcast: the balances in which they are looked for are shuffled.
_MANY = 20_000


def _slices(orders: int, batch: Batch, options: LoadOptions) -> list[_Slice]:
    """So many groups of buckets that each has `orders_at_once` orders, a bucket at least."""
    if orders > _MANY:
        # the ledger's rows tell how many orders have balances; an order has a few lines
        orders = max(orders, sum(r.rows for r in batch.of("fact_sales")) // 4)
    buckets = batch.buckets
    n = max(1, min(buckets, -(-orders // max(1, options.orders_at_once))))
    if n == 1:
        return [_Slice(None, buckets)]
    return [_Slice(list(range(i, buckets, n)), buckets) for i in range(n)]


def run_incremental(
    spark: SparkSession,
    sources: Sources,
    store: Store,
    batch_ts: datetime | None = None,
    options: LoadOptions = LoadOptions(),
    stream_epoch: str | None = None,
    notices: DataFrame | None = None,
) -> LoadResult:
    """Load what changed since the last committed batch.

    Dimensions come first, then the lines of affected orders are reversed and booked anew, then
    lines that are gone from the source are reversed. Only the manifest row at the end makes the
    batch visible, so a batch that fails can simply be run again.

    Without `notices` the batch is a sweep: all versions above the marks count, and the whole
    source is searched for lines that are gone. With `notices` (source table, key, version) only
    the members and orders that they name are read, orders and lines within the range of their
    numbers. The marks stay then, and the versions seen are kept: the next sweep finds what no
    notice told of, and does not book again what one did.
    """
    before = store.at()
    last = before.last
    if stream_epoch is not None and last.stream_epoch == stream_epoch:
        return LoadResult(None)  # a replay of the epoch that was committed last
    batch = last.following(batch_ts or utc_now(), "incremental")
    work = _Work(store, batch)
    try:
        with freed_shuffles(spark):
            batch, dims = _run_batch(sources, store, before, batch, work, options, notices)
            if batch is None:
                return LoadResult(None)
            store.commit(replace(batch, stream_epoch=stream_epoch))
    finally:
        work.drop()
    if options.keep_batches:
        store.expire(options.keep_batches)
    return LoadResult(batch.batch_id, batch.fact_rows, dims, bool(batch.of("quarantine")))


def _run_batch(
    sources: Sources,
    store: Store,
    before: Snapshot,
    batch: Batch,
    work: _Work,
    options: LoadOptions,
    notices: DataFrame | None,
) -> tuple[Batch | None, tuple[str, ...]]:
    last = before.last
    named: set[str] = set()
    if notices is None:
        # Six rows.
        found = max_versions(sources, last.marks).collect()
        highs = {r.source_table: r.max_row_version for r in found}
        changed_sources = {t for t, high in highs.items() if high > last.marks[t]}
    else:
        notices, count = work.counted("notices", _new_notices(before, notices))
        if not count:
            return None, ()
        highs = last.marks
        # at most one name per source
        named = {r[0] for r in notices.select("source_table").distinct().collect()}
        changed_sources = named & set(highs)

    loads = in_parallel(
        lambda dim: _load_dim(
            sources, store, before, batch, work, dim, highs, options, changed_sources, notices
        ),
        DIM_KEYS,
    )
    for load in loads:
        batch = load.recorded(batch, highs)
    dims = tuple(load.dim for load in loads if load.new_rows is not None)
    current = {dim: store.snapshot(batch).current_dim(dim) for dim in DIM_KEYS}

    marks = facts.Marks(
        last.marks["orders"], last.marks["order_details"], highs["orders"], highs["order_details"]
    )
    changed = bool(changed_sources & {"orders", "order_details"})
    touched = _touched_orders(sources, before, work, marks, changed, options, notices)
    lines = found = None
    if touched is not None:
        # Staged order numbers have a known size: few of them are broadcast to the scan of the
        # lines. Lines are staged because they are read more than once.
        touched, orders = work.counted("touched", touched)
        slices = _slices(orders, batch, options)
        if notices is not None:
            sources = _narrowed(sources, touched)
        lines = work.stage("lines", facts.lines_of(sources, touched))
        found = _digests_of_touched(before, work, touched, lines)
        sweep = notices is None
        batch, entries = _draw_lines(
            sources, store, before, batch, work, slices, touched, lines, current, sweep
        )
        if sweep:
            work.used("lines")
        batch = _append(store, batch, work, "booked", entries)
    if notices is None:
        if changed:
            batch = _mark(batch, "orders", highs["orders"])
            batch = _mark(batch, "order_details", highs["order_details"])
        batch = batch.without("noticed")
    else:
        batch = batch.adding(*_seen(sources, store, batch, work, loads, touched, lines))
    if notices is None or touched is not None:
        sweep = notices is None
        batch = _take_back_deleted(
            sources, store, before, batch, work, options, touched, found, sweep
        )
    if batch.runs == last.runs and not changed:
        return None, ()
    due = _due_buckets(store, batch, options)
    return store.merge_runs(store.roll_up(batch, due)), dims


def _new_notices(before: Snapshot, notices: DataFrame) -> DataFrame:
    """Each key once, unless its version was seen."""
    columns = ["source_table", "key", "row_version"]
    rows = notices.filter("key is not null").select(*columns)
    rows = rows.groupBy("source_table", "key").agg(F.max("row_version").alias("row_version"))
    seen = before.read("noticed").groupBy("source_table", "key").agg(F.max("row_version").alias("__seen"))
    known = rows.join(seen, ["source_table", "key"], "left")
    return known.filter("__seen is null or row_version > __seen").select(*columns)


def _narrowed(sources: Sources, touched: DataFrame) -> Sources:
    """Orders and lines within the range of the touched numbers, a filter that the scan can use.
    Two numbers come to the driver."""
    low, high = touched.agg(F.min("order_id"), F.max("order_id")).first()
    if low is None:
        return sources
    here = F.col("order_id").between(low, high)
    return sources.with_tables(
        orders=sources.orders.filter(here), order_details=sources.order_details.filter(here)
    )


def _seen(
    sources: Sources,
    store: Store,
    batch: Batch,
    work: _Work,
    loads: list[_DimLoad],
    touched: DataFrame | None,
    lines: DataFrame | None,
) -> list[Run]:
    """The versions that this batch has read, of members, orders and lines."""

    def versions(rows: DataFrame, source: str, key: str, version: str) -> DataFrame:
        return rows.groupBy(
            F.lit(source).alias("source_table"), F.col(key).cast("string").alias("key")
        ).agg(F.max(version).alias("row_version"))

    parts = [
        versions(load.delta, DIM_SOURCE[load.dim], DIM_KEYS[load.dim][1], "source_version")
        for load in loads
        if load.delta is not None
    ]
    if touched is not None:
        orders = sources.orders.join(touched, "order_id", "left_semi")
        parts.append(versions(orders, "orders", "order_id", "row_version"))
        parts.append(versions(lines, "order_details", "order_id", "row_version"))
    if not parts:
        return []
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return [store.write(batch, "noticed", rows)]


def _mark(batch: Batch, source: str, version: int) -> Batch:
    return replace(
        batch,
        marks={**batch.marks, source: version},
        marked_at={**batch.marked_at, source: batch.batch_ts},
    )


@dataclass(frozen=True)
class _DimLoad:
    dim: str
    new_rows: int | None = None  # None: the source had not changed
    runs: tuple[Run, ...] = ()
    rebased: bool = False
    delta: DataFrame | None = None

    def recorded(self, batch: Batch, highs: dict[str, int]) -> Batch:
        if self.new_rows is None:
            return batch
        source, dim = DIM_SOURCE[self.dim], self.dim
        if self.rebased:
            expired = [replace(r, dataset=f"{dim}/history") for r in batch.of(f"{dim}/expired")]
            batch = batch.without(f"{dim}/base", f"{dim}/delta", f"{dim}/expired").adding(*expired)
        return replace(
            _mark(batch, source, highs[source]).adding(*self.runs),
            next_sk={**batch.next_sk, dim: batch.next_sk[dim] + self.new_rows},
        )


def _load_dim(
    sources: Sources,
    store: Store,
    before: Snapshot,
    batch: Batch,
    work: _Work,
    dim: str,
    highs: dict[str, int],
    options: LoadOptions,
    changed_sources: set[str],
    notices: DataFrame | None,
) -> _DimLoad:
    """New versions go to a delta beside the base; many of them make a new base."""
    source, key = DIM_SOURCE[dim], DIM_KEYS[dim][1]
    if source not in changed_sources:
        return _DimLoad(dim)
    low = before.last.marks[source]
    if notices is None:
        rows = dimensions.changed_since(sources[source], low, highs[source])
    else:
        rows = dimensions.noticed(sources[source], source, key, notices)
        rows = dimensions.changed_since(rows, low)
    if before.last.of("noticed"):
        rows = dimensions.unseen(rows, source, key, before.read("noticed"))
    current = before.current_dim(dim)
    delta = dimensions.MEMBERS[dim](sources, rows)
    if options.only_if_changed:
        delta = really_changed(current, delta, dim)
    delta, count = work.counted(dim, delta)
    first_sk = before.last.next_sk[dim]
    change = scd2_apply(current, delta, dim, batch.batch_ts, first_sk)
    loaded_before = first_sk > 1  # else there are no members whose rows could expire
    newer = count + sum(r.rows for r in before.last.of(f"{dim}/delta"))
    base = sum(r.rows for r in before.last.of(f"{dim}/base"))
    rebased = newer > options.rebase_share * base
    if rebased:
        kept = current.join(delta.select(key), key, "left_anti").select(*DIMS[dim].fieldNames())
        runs = [store.write(batch, f"{dim}/base", kept.unionByName(change.successors))]
    else:
        runs = [store.write(batch, f"{dim}/delta", change.successors)]
    if loaded_before:
        # what a base leaves out needs no join any more
        part = "history" if rebased else "expired"
        runs.append(store.write(batch, f"{dim}/{part}", change.expired))
    return _DimLoad(dim, count, tuple(runs), rebased, delta)


def _touched_orders(
    sources: Sources,
    before: Snapshot,
    work: _Work,
    marks: facts.Marks,
    changed: bool,
    options: LoadOptions,
    notices: DataFrame | None,
) -> DataFrame | None:
    """Orders whose lines are to be booked anew; None when there are none for sure."""
    touched = []
    if changed and notices is not None:
        of_orders = notices.filter(F.col("source_table").isin("orders", "order_details"))
        touched.append(of_orders.select(F.col("key").cast("long").alias("order_id")))
    elif changed:
        seen = before.read("noticed") if before.last.of("noticed") else None
        touched.append(facts.affected_orders(sources, marks, seen))
        quarantine = before.quarantine()
        if quarantine is not None:
            touched.append(quarantine.select("order_id"))
    if options.touch_on_delete and notices is None:
        lost, _, _ = _orders_that_lost_lines(sources, before, work, None, None)
        if lost is not None:
            known = before.positions(_buckets_of(lost, before.last.buckets))
            known = known.join(lost, "order_id", "left_semi")
            gone = ledger.deleted_balances(known, _lines_of(sources, lost))
            touched.append(gone.select("order_id"))
    if not touched:
        return None
    union = touched[0].distinct()
    for more in touched[1:]:
        union = union.union(more).distinct()
    return union


def _buckets_of(orders: DataFrame, buckets: int) -> list[int]:
    """The buckets of some orders: at most as many numbers as there are buckets."""
    rows = orders.select(digests.bucket_of(buckets).alias("bucket")).distinct().collect()
    return sorted(r.bucket for r in rows)


def _lines_of(sources: Sources, orders: DataFrame) -> DataFrame:
    return sources.order_details.join(orders.select("order_id"), "order_id", "left_semi")


def _draw_lines(
    sources: Sources,
    store: Store,
    before: Snapshot,
    batch: Batch,
    work: _Work,
    slices: list[_Slice],
    touched: DataFrame,
    lines: DataFrame,
    current: dict[str, DataFrame],
    sweep: bool,
) -> tuple[Batch, DataFrame]:
    """Phase 1: the entries that reverse and re-book the lines of the touched orders, staged."""
    if sweep:
        batch = batch.without("quarantine")  # what waited is among the touched orders
    for i, here in enumerate(slices):
        keyed = facts.keyed_lines(here.rows(lines), here.rows(sources.orders), current)
        drawn = work.stage(f"fresh-{i}", facts.with_calendar(keyed, before.dim_date()))
        fresh = drawn.filter("in_calendar").drop("in_calendar")
        undated = drawn.filter("NOT in_calendar").drop("in_calendar")
        if not undated.isEmpty():
            waiting = undated.select("order_id").distinct()
            batch = batch.adding(store.write(batch, "quarantine", waiting, name=f"-{i}"))
        entries = ledger.first_entries(fresh)
        if before.last.next_fact_id > 1:  # else the ledger is empty
            # also of lines that wait for their day: what they were booked under is taken back
            orders = here.rows(touched)
            known = before.positions(_buckets_of(orders, batch.buckets))
            known = known.join(orders, "order_id", "left_semi")
            balances = work.stage(f"balances-{i}", ledger.open_balances(known, drawn))
            entries = ledger.upsert_entries(fresh, balances)
        staged = work.added("booked-entries", entries)
        work.used(f"fresh-{i}", f"balances-{i}")
    return batch, staged


def _append(store: Store, batch: Batch, work: _Work, name: str, entries: DataFrame) -> Batch:
    """Number the entries that are staged under the name and add them to the ledger, if there are
    any."""
    numbered, count = stored_order_ids(entries, "fact_id", batch.next_fact_id)
    if count:
        rows = conform(numbered, FACT).withColumn("batch_id", F.lit(batch.batch_id).cast("long"))
        run = store.write(batch, "fact_sales", rows, name=f"-{name}")
        batch = replace(
            batch.adding(run),
            fact_rows=batch.fact_rows + count,
            next_fact_id=batch.next_fact_id + count,
        )
    work.used(f"{name}-entries")
    return batch


def _digests_of_touched(
    before: Snapshot, work: _Work, touched: DataFrame, lines: DataFrame
) -> DataFrame:
    """What brings the stored digests of the touched orders up to date, known from their lines."""
    old = digests.merged(before.read("digests").join(touched, "order_id", "left_semi"))
    return work.stage("digests-touched", digests.changes(old, digests.of_orders(lines)))


def _orders_that_lost_lines(
    sources: Sources,
    before: Snapshot,
    work: _Work,
    touched: DataFrame | None,
    found: DataFrame | None,
    sweep: bool = True,
) -> tuple[DataFrame | None, int, DataFrame | None]:
    """Orders that may have lost a line since the last batch and how many they are, and what brings
    the stored digests up to date; None where nothing differs.

    The digests of touched orders are `found` from their lines. What is then expected of each
    bucket is compared with the source: one row per task and bucket is moved for that. Orders are
    compared in buckets that differ only. Without `sweep` touched orders alone are looked at.
    """
    buckets = before.last.buckets
    stored = before.read("digests")
    expected = before.read("buckets").select("bucket", "n", "s", "x")
    changes = []
    if touched is not None:
        changes.append(found)
        expected = expected.unionByName(digests.per_bucket(found, buckets))
    differing = sweep and digests.differing_buckets(expected, sources.order_details, buckets)
    if differing:
        here = digests.bucket_of(buckets).isin(differing)
        old = stored.filter(here)
        if changes:
            old = old.unionByName(changes[0].drop("were").filter(here))
        actual = digests.of_orders(sources.order_details.filter(here))
        changes.append(
            work.stage("digests-others", digests.changes(digests.merged(old), actual))
        )
    if not changes:
        return None, 0, None
    added = changes[0] if len(changes) == 1 else changes[0].unionByName(changes[1])
    lost, orders = work.counted("lost", added.filter("were > 0").select("order_id").distinct())
    return (lost if orders else None), orders, added.drop("were")


def _take_back_deleted(
    sources: Sources,
    store: Store,
    before: Snapshot,
    batch: Batch,
    work: _Work,
    options: LoadOptions,
    touched: DataFrame | None,
    found: DataFrame | None,
    sweep: bool,
) -> Batch:
    """Phase 2: reverse what is still open of lines that are gone from the source."""
    lost, count, added = _orders_that_lost_lines(sources, before, work, touched, found, sweep)
    if lost is not None:
        at = store.snapshot(batch)
        for i, here in enumerate(_slices(count, batch, options)):
            orders = here.rows(lost)
            known = at.positions(_buckets_of(orders, batch.buckets))
            known = work.stage(f"known-{i}", known.join(orders, "order_id", "left_semi"))
            lines = here.rows(sources.order_details).join(orders, "order_id", "left_semi")
            missing = ledger.missing_lines(known, lines)
            entries = work.added("deleted-entries", ledger.deletion_entries(known, missing))
            work.used(f"known-{i}")
        batch = _append(store, batch, work, "deleted", entries)
    return _note_buckets(store, before, batch, added)


def _note_buckets(
    store: Store, before: Snapshot, batch: Batch, added: DataFrame | None
) -> Batch:
    """Add this batch's changes to the digests, and its ledger rows to what is pending."""
    own = [r for r in batch.of("fact_sales") if r.upto == batch.batch_id]
    if added is None and not own:
        return batch
    bucket = digests.bucket_of(batch.buckets).alias("bucket")
    zero = F.lit(0).cast("long")
    parts = [store.snapshot(batch).read("buckets")]
    if own:
        rows = store.snapshot(batch).read("fact_sales", runs=own)
        counts = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("pending"))
        parts.append(
            counts.select("bucket", zero.alias("n"), F.lit(0).cast("decimal(38,0)").alias("s"),
                          zero.alias("x"), "pending", zero.alias("rolled"))
        )
    if added is not None:
        moved = digests.per_bucket(added, batch.buckets)
        parts.append(moved.withColumns({"pending": zero, "rolled": zero}))
        run = store.write(batch, "digests", added)
        batch = batch.adding(run) if run.rows else batch
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    table = union.groupBy("bucket").agg(
        F.sum("n").alias("n"),
        F.sum("s").cast("decimal(38,0)").alias("s"),
        F.bit_xor("x").alias("x"),
        F.sum("pending").alias("pending"),
        F.sum("rolled").alias("rolled"),
    )
    return batch.without("buckets").adding(store.write(batch, "buckets", table))


def _due_buckets(store: Store, batch: Batch, options: LoadOptions) -> list[int]:
    """Buckets whose newer ledger rows are many beside their balances."""
    known = store.snapshot(batch).read("buckets")
    most = F.greatest(F.lit(options.roll_up_rows), F.col("rolled") * options.roll_up_share)
    due = known.filter(F.col("pending") > most)
    return sorted(r.bucket for r in due.select("bucket").collect())  # a number per bucket


# --- full refresh -------------------------------------------------------------------------


class _Log:
    """Audit entries of one run, each written as its step begins or ends: a run that is killed
    leaves those it came to."""

    def __init__(self, store: Store, attempt: str):
        self._store, self._attempt, self._next = store, attempt, store.next_log_id()
        self._begin = utc_now()
        self._add(STEP_START, None, STATUS_START, "load started", None)

    def _add(self, step, rows, status, message, seconds):
        entry = (self._next, utc_now(), step, rows, status, message, seconds, self._attempt)
        self._store.append_log([entry])
        self._next += 1

    def done(self, step: str, rows: int, seconds: int, waiting: int = 0):
        message = f"{step}: {rows} rows loaded"
        if waiting:
            message += f", {waiting} lines wait for a member or a day"
        self._add(step, rows, STATUS_OK, message, seconds)

    def end(self):
        seconds = seconds_between(self._begin, utc_now())
        self._add(STEP_END, None, STATUS_OK, "load finished", seconds)

    def failed(self, error: Exception):
        seconds = seconds_between(self._begin, utc_now())
        message = f"{type(error).__name__}: {error}"
        self._add(STEP_ERROR, None, STATUS_ERROR, message, seconds)


def seconds_between(start: datetime, end: datetime) -> int:
    """Second boundaries crossed."""
    return int(end.replace(microsecond=0).timestamp() - start.replace(microsecond=0).timestamp())


def run_full_refresh(
    spark: SparkSession,
    sources: Sources,
    store: Store,
    batch_ts: datetime | None = None,
    ratio_mode: str = "float",
) -> LoadResult:
    """Load the whole star anew, every member as version 1 and every line as a first sale.

    The old star stays readable until the new one is committed. Each step leaves a log entry; an
    error is logged and raised again.
    """
    before = store.at()
    batch = before.last.following(batch_ts or utc_now(), "full_refresh")
    log, work = _Log(store, batch.attempt), _Work(store, batch)
    try:
        with freed_shuffles(spark):
            batch = replace(batch, runs=())
            highs = {r.source_table: r.max_row_version for r in max_versions(sources).collect()}
            for source, high in highs.items():
                batch = _mark(batch, source, high)
            loads = in_parallel(
                lambda dim: _reload_dim(sources, store, batch, work, dim), DIM_SOURCE
            )
            for load, seconds in loads:
                batch = load.recorded(batch, highs)
                log.done(load.dim, load.new_rows, seconds)
            begin = utc_now()
            dims = {dim: store.snapshot(batch).current_dim(dim) for dim in DIM_KEYS}
            keyed = facts.full_fact_rows(sources, dims, before.dim_date(), ratio_mode)
            entries = work.stage("booked-entries", ledger.first_entries(keyed))
            batch = _append(store, batch, work, "booked", entries)
            lines, found = work.counted("digests", digests.of_orders(sources.order_details))
            batch = _note_buckets(store, before, batch, lines if found else None)
            batch, waiting = _left_out(sources, store, batch, lines)
            log.done("fact_sales", batch.fact_rows, seconds_between(begin, utc_now()), waiting)
            store.commit(batch)
        log.end()
        return LoadResult(batch.batch_id, batch.fact_rows, tuple(DIM_SOURCE))
    except Exception as error:
        log.failed(error)
        raise
    finally:
        work.drop()


def _left_out(
    sources: Sources, store: Store, batch: Batch, lines: DataFrame
) -> tuple[Batch, int]:
    """Lines that miss a member or a day: their orders wait for the next incremental load, which
    takes them up again although the marks have passed them."""
    waiting = (lines.agg(F.sum("n")).first()[0] or 0) - batch.fact_rows
    if not waiting:
        return batch, 0
    booked = store.snapshot(batch).fact()
    left = ledger.missing_lines(sources.order_details, booked)
    run = store.write(batch, "quarantine", left.select("order_id").distinct())
    return batch.adding(run), waiting


def _reload_dim(
    sources: Sources, store: Store, batch: Batch, work: _Work, dim: str
) -> tuple[_DimLoad, int]:
    begin = utc_now()
    members, count = work.counted(dim, dimensions.MEMBERS[dim](sources, sources[DIM_SOURCE[dim]]))
    rows = first_versions(members, dim, batch.batch_ts, batch.next_sk[dim])
    rows = rows.unionByName(unknown_member(store.spark, dim, batch.batch_ts))
    run = store.write(batch, f"{dim}/base", rows)
    return _DimLoad(dim, count, (run,)), seconds_between(begin, utc_now())

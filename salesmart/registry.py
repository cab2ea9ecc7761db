"""Every query by name; each reads the given tables or stars loaded from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.dates import date_key, date_key_style112
from salesmart.operators import digests, dimensions, facts, ledger, quality
from salesmart.operators.calendar import calendar_for
from salesmart.operators.ordering import dense_ids
from salesmart.operators.scd2 import next_versions
from salesmart.operators.versions import stamp_versions
from salesmart.plans import kpis, reports
from salesmart.schema import DIM_ATTRS, DIM_KEYS, DIM_SOURCE, FACT, TX_DELETION, TX_ORIGINAL, UNKNOWN_SK
from salesmart.session import CODEC, freed_shuffles, scratch_path, stage
from salesmart.sources.tables import max_versions
from salesmart.store import Snapshot
from salesmart.streaming.check import ledger_by_notices, stream_and_batch_ledgers
from salesmart.workspace import Workspace, workspace

Query = Callable[[SparkSession, str], DataFrame]

# What state 2 changes since state 1, whose rows all have version 1.
SECOND = facts.Marks(orders_low=1, details_low=1)
LEDGER = [c for c in FACT.fieldNames() if c != "fact_id"]


def _members(dim: str) -> Callable[[Workspace], DataFrame]:
    def delta(w: Workspace) -> DataFrame:
        sources = w.states.state(2)
        changed = dimensions.changed_since(sources[DIM_SOURCE[dim]], 1)
        return dimensions.MEMBERS[dim](sources, changed)

    return delta


def _history(dim: str) -> Callable[[Workspace], DataFrame]:
    def rows(w: Workspace) -> DataFrame:
        return _readable(w.incremental.at(2).dim(dim), dim)

    return rows


def _loaded(dim: str) -> Callable[[Workspace], DataFrame]:
    return lambda w: _readable(w.full.at().dim(dim), dim)


def _readable(rows: DataFrame, dim: str) -> DataFrame:
    """Known members with their validity as text."""
    sk, key = DIM_KEYS[dim]
    return rows.filter(F.col(sk) != UNKNOWN_SK).select(
        sk,
        key,
        *[name for name, _ in DIM_ATTRS[dim] if name != "hire_date"],
        "version",
        F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
        F.date_format("valid_to", "yyyy-MM-dd").alias("valid_to"),
        "is_current",
        "source_version",
    )


def _next_versions(w: Workspace) -> DataFrame:
    dim = w.incremental.at(2).current_dim("dim_product")
    delta = _members("dim_product")(w)
    return next_versions(dim, delta, "product_id").select("product_id", "version")


def _snapshot_change_stamp(w: Workspace) -> DataFrame:
    keys = ledger.LINE
    before, after = w.states.state(1).order_details, w.states.state(2).order_details
    stamped = stamp_versions(before, after.drop("row_version"), keys, 2)
    return stamped.select(*keys, "row_version")


def _surrogate_keys(w: Workspace) -> DataFrame:
    return dense_ids(w.base.orders.select("order_id"), "order_id", "order_sk")


def _affected_orders(w: Workspace) -> DataFrame:
    return facts.affected_orders(w.states.state(2), SECOND)


def _affected_lines(w: Workspace) -> DataFrame:
    return facts.lines_of(w.states.state(2), _affected_orders(w))


def _order_subtotals(w: Workspace) -> DataFrame:
    return facts.order_subtotals(_affected_lines(w)).select(
        "order_id", F.col("subtotal").cast("decimal(29,4)").alias("subtotal")
    )


def _fresh(w: Workspace) -> DataFrame:
    return facts.fresh_lines(_affected_lines(w), w.states.state(2).orders)


def _fresh_lines(w: Workspace) -> DataFrame:
    return _fresh(w)


def _freight_proration(w: Workspace) -> DataFrame:
    drawn = facts.fresh_lines(facts.lines_of(w.base, None), w.base.orders)
    return drawn.select(*ledger.LINE, "sale_amount", "freight_alloc")


def _current_dims(at: Snapshot) -> dict[str, DataFrame]:
    return {dim: at.current_dim(dim) for dim in DIM_KEYS}


def _fact_sk_lookup(w: Workspace) -> DataFrame:
    dims = _current_dims(w.incremental.at(2))
    return facts.keyed_lines(_affected_lines(w), w.states.state(2).orders, dims)


def _existing_balances(w: Workspace) -> DataFrame:
    return ledger.open_balances(w.incremental.at(1).positions(), _fresh(w))


def _new_lines(w: Workspace) -> DataFrame:
    # needed twice, to look for balances and for the entries: its lookups are made once
    with freed_shuffles(w.spark):
        fresh = stage(_fact_sk_lookup(w), scratch_path(w.spark, "fresh"), codec=CODEC)
    balances = ledger.open_balances(w.incremental.at(1).positions(), fresh)
    entries = ledger.upsert_entries(fresh, balances).filter(F.col("tx_type") == TX_ORIGINAL)
    return entries.select(*ledger.LINE, "quantity")


def _incremental_ledger(w: Workspace) -> DataFrame:
    return w.ledger_star.fact.select(*LEDGER, "batch_id")


def _restored_ledger(w: Workspace) -> DataFrame:
    return w.restored.at(3).fact().select(*LEDGER, "batch_id")


def _incremental_noop(w: Workspace) -> DataFrame:
    """What an unchanged source gives the next batch to do: nothing."""
    after, same = w.incremental.at(2), w.states.state(3)
    marks = after.last.marks
    unseen = facts.affected_orders(
        same, facts.Marks(marks["orders"], marks["order_details"])
    ).agg(F.count(F.lit(1)).alias("affected_orders"))
    gone = ledger.deleted_balances(after.positions(), same.order_details)
    return unseen.withColumn("deleted_lines", gone.agg(F.count(F.lit(1))).scalar())


def _reconcile_deletes(w: Workspace) -> DataFrame:
    fact = w.ledger_star.fact
    undeleted = ledger.as_positions(fact.filter(F.col("tx_type") != TX_DELETION))
    missing = ledger.missing_lines(undeleted, w.states.state(2).order_details)
    return ledger.deletion_entries(undeleted, missing)


def _net_positions(w: Workspace) -> DataFrame:
    sums = ledger.net_positions(w.ledger_star.fact)
    return sums.select(
        *ledger.LINE,
        F.col("quantity").cast("long").alias("quantity"),
        F.col("sale_amount").cast("decimal(29,4)").alias("sale_amount"),
        F.col("freight_alloc").cast("decimal(29,4)").alias("freight_alloc"),
    )


def _kept_balances(w: Workspace) -> DataFrame:
    """The store's own balances per line: roll-ups of buckets and the rows after them."""
    kept = ledger.rolled_up(w.incremental.at(2).positions())
    return kept.groupBy(*ledger.LINE).agg(
        F.sum("quantity").alias("quantity"),
        F.sum("sale_amount").cast("decimal(29,4)").alias("sale_amount"),
        F.sum("freight_alloc").cast("decimal(29,4)").alias("freight_alloc"),
    ).filter("quantity <> 0")


def _order_digests(w: Workspace) -> DataFrame:
    """How many lines of each order the stored digests tell of, after two batches."""
    return digests.merged(w.incremental.at(2).read("digests")).select("order_id", "n")


def _changed_line_sets(w: Workspace) -> DataFrame:
    """Orders whose lines are others in state 2, found by digests."""
    before, after = w.states.state(1).order_details, w.states.state(2).order_details
    found = digests.changes(digests.of_orders(before), digests.of_orders(after))
    return found.select("order_id", F.col("n").alias("more"), "were")


def _refresh_then_incremental(w: Workspace) -> DataFrame:
    """State 1 by a full refresh, state 2 by an incremental load after it."""
    return w.refreshed.at(2).fact().select(*LEDGER, "batch_id")


def _ledger_by_notices(w: Workspace) -> DataFrame:
    return ledger_by_notices(w).select(*LEDGER, "batch_id")


def _check_line_keys(w: Workspace) -> DataFrame:
    lines = w.base.order_details
    return lines.groupBy(*ledger.LINE).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("lines"), F.count(F.lit(1)).alias("keys")
    )


def _control_after_batch(w: Workspace) -> DataFrame:
    return w.incremental.at(2).load_control().select("source_table", "last_row_version")


def _full_fact(w: Workspace) -> DataFrame:
    return w.full_star.fact.select(*LEDGER)


def _full_fact_money_ratio(w: Workspace) -> DataFrame:
    at = w.full.at()
    return facts.full_fact_rows(w.base, _current_dims(at), at.dim_date(), "money")


def _date_keys(w: Workspace) -> DataFrame:
    day = F.to_date("order_date")
    return w.base.orders.select(
        "order_id",
        date_key(day).alias("date_sk"),
        date_key_style112(day).alias("date_sk_style112"),
    )


def _check_fk(w: Workspace) -> DataFrame:
    star = w.ledger_star
    dims = {dim: (star.dim(dim), sk) for dim, (sk, _) in DIM_KEYS.items()}
    return quality.check_fk(star.fact, {**dims, "dim_date": (star.date, "date_sk")})


def _check_keys(w: Workspace) -> DataFrame:
    star = w.ledger_star
    known = {
        dim: (star.dim(dim).filter(F.col(sk) != UNKNOWN_SK), sk)
        for dim, (sk, _) in DIM_KEYS.items()
    }
    return quality.check_keys(
        {**known, "dim_date": (star.date, "date_sk"), "fact_sales": (star.fact, "fact_id")}
    )


def _on_workspace(build: Callable[[Workspace], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(workspace(spark, sf_dir))


def all_queries() -> dict[str, Query]:
    on_full = {
        name: (lambda w, report=report: report(w.full_star))
        for name, report in reports.REPORTS.items()
    }
    on_ledger = {
        f"{name}_ledger": (lambda w, report=report: report(w.ledger_star))
        for name, report in reports.REPORTS.items()
    }
    rollups = {
        name: (lambda w, path=path: kpis.rollup(w.full_star, *path))
        for name, path in kpis.HIERARCHIES.items()
    }
    builders: dict[str, Callable[[Workspace], DataFrame]] = {
        **on_full,
        **on_ledger,
        "pareto_scalable": lambda w: reports.pareto_scalable(w.full_star),
        "kpi_global": lambda w: kpis.kpi_global(w.full_star),
        "kpi_by_category": lambda w: kpis.kpi_by(w.full_star, "product", "category_name"),
        **rollups,
        "dim_date": lambda w: calendar_for(w.base.orders),
        "date_key_style112": _date_keys,
        "max_row_versions": lambda w: max_versions(w.states.state(2)),
        **{f"delta_{DIM_SOURCE[dim]}": _members(dim) for dim in DIM_KEYS},
        **{f"scd2_{dim.removeprefix('dim_')}": _history(dim) for dim in DIM_KEYS},
        "next_versions": _next_versions,
        "snapshot_change_stamp": _snapshot_change_stamp,
        "surrogate_keys": _surrogate_keys,
        "affected_orders": _affected_orders,
        "order_subtotals": _order_subtotals,
        "fresh_lines": _fresh_lines,
        "freight_proration": _freight_proration,
        "fact_sk_lookup": _fact_sk_lookup,
        "existing_balances": _existing_balances,
        "new_lines": _new_lines,
        "incremental_ledger": _incremental_ledger,
        "incremental_ledger_restored": _restored_ledger,
        "incremental_noop": _incremental_noop,
        "reconcile_deletes": _reconcile_deletes,
        "net_positions": _net_positions,
        "kept_balances": _kept_balances,
        "order_digests": _order_digests,
        "changed_line_sets": _changed_line_sets,
        "refresh_then_incremental": _refresh_then_incremental,
        "ledger_by_notices": _ledger_by_notices,
        "check_line_keys": _check_line_keys,
        "control_after_batch": _control_after_batch,
        **{f"full_{dim}": _loaded(dim) for dim in DIM_KEYS},
        "full_fact": _full_fact,
        "full_fact_money_ratio": _full_fact_money_ratio,
        "full_refresh_log": lambda w: w.full.log_history().select(
            "log_id", "step", "rows_affected", "status", "message"
        ),
        "check_row_counts": lambda w: quality.check_row_counts(
            w.spark.read.parquet(f"{w.sf_dir}/lineitem.parquet"), w.full_star.fact
        ),
        "check_freight": lambda w: quality.check_freight(w.full_star.fact, w.base.orders),
        "check_calendar": lambda w: quality.check_calendar(w.full_star.date),
        "check_fk": _check_fk,
        "check_keys": _check_keys,
        "stream_equals_batch": stream_and_batch_ledgers,
    }
    return {name: _on_workspace(build) for name, build in builders.items()}

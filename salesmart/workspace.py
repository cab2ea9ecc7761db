"""The given tables loaded into stars, once per session and folder, for the registered queries."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import cached_property

from pyspark.sql import SparkSession

from salesmart.operators.calendar import calendar_for
from salesmart.plans.pipeline import run_full_refresh, run_incremental
from salesmart.session import scratch_path
from salesmart.sources.changes import ChangeRules, SourceStates
from salesmart.sources.retail import read_retail
from salesmart.sources.tables import Sources
from salesmart.store import Star, Store

_FIRST_DAY = datetime(2026, 1, 1, 12, tzinfo=timezone.utc)


def batch_time(number: int) -> datetime:
    """A fixed clock: batch n runs on day n."""
    return _FIRST_DAY + timedelta(days=number)


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, rules: ChangeRules = ChangeRules()):
        self.spark, self.sf_dir, self.rules = spark, sf_dir, rules
        self.root = scratch_path(spark, "workspace")

    @cached_property
    def base(self) -> Sources:
        return read_retail(self.spark, self.sf_dir)

    @cached_property
    def states(self) -> SourceStates:
        return SourceStates(self.base, self.rules, f"{self.root}/source")

    def new_store(self, name: str) -> Store:
        calendar = calendar_for(self.base.orders)
        return Store.create(self.spark, f"{self.root}/{name}", batch_time(0), calendar)

    @cached_property
    def full(self) -> Store:
        """The star after one full refresh from the given tables."""
        store = self.new_store("full")
        run_full_refresh(self.spark, self.base, store, batch_time(1))
        return store

    @cached_property
    def incremental(self) -> Store:
        """The star after incremental loads of source states 1 and 2."""
        store = self.new_store("incremental")
        for number in (1, 2):
            run_incremental(self.spark, self.states.state(number), store, batch_time(number))
        return store

    @cached_property
    def restored(self) -> Store:
        """The same star after states 3, which changes nothing, and 4, which adds batch 3."""
        for number in (3, 4):
            state = self.states.state(number)
            run_incremental(self.spark, state, self.incremental, batch_time(number))
        return self.incremental

    @cached_property
    def refreshed(self) -> Store:
        """The star after a full refresh from source state 1 and an incremental load of state 2."""
        store = self.new_store("refreshed")
        run_full_refresh(self.spark, self.states.state(1), store, batch_time(1))
        run_incremental(self.spark, self.states.state(2), store, batch_time(2))
        return store

    @cached_property
    def full_star(self) -> Star:
        return self.full.at().star()

    @cached_property
    def ledger_star(self) -> Star:
        """The star after batch 2, with reversals in its ledger."""
        return self.incremental.at(2).star()


_OPEN: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, sf_dir)
    return _OPEN[key]

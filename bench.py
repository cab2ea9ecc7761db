"""Times the loads and the reports; prints one line of JSON.

BENCH_SF_DIR: the folder of the tables. BENCH_CPUS: local cores. Reports are timed as the median
of three runs over a loaded star, after one run that is not counted; loads are timed once.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from salesmart.plans import kpis, reports
from salesmart.plans.pipeline import run_full_refresh, run_incremental
from salesmart.session import build_session
from salesmart.workspace import Workspace, batch_time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def timed(work) -> float:
    begin = time.perf_counter()
    work()
    return time.perf_counter() - begin


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = Workspace(spark, SF_DIR)
    times: dict[str, float] = {}

    full = work.new_store("bench_full")
    times["load_full_refresh"] = timed(
        lambda: run_full_refresh(spark, work.base, full, batch_time(1))
    )
    states = work.states
    ledger = work.new_store("bench_ledger")
    for number, name in ((1, "initial"), (2, "changes"), (3, "no_change"), (4, "restored")):
        times[f"load_batch{number}_{name}"] = timed(
            lambda: run_incremental(spark, states.state(number), ledger, batch_time(number))
        )

    star, ledger_star = full.at().star(), ledger.at(2).star()
    queries = {name: (lambda r=r: r(star)) for name, r in reports.REPORTS.items()}
    queries |= {f"{n}_ledger": (lambda r=r: r(ledger_star)) for n, r in reports.REPORTS.items()}
    queries["pareto_scalable"] = lambda: reports.pareto_scalable(star)
    queries["kpi_global"] = lambda: kpis.kpi_global(star)
    queries |= {n: (lambda p=p: kpis.rollup(star, *p)) for n, p in kpis.HIERARCHIES.items()}
    for name, build in queries.items():
        consume(build())
        times[name] = statistics.median(timed(lambda: consume(build())) for _ in range(3))

    print(
        json.dumps(
            {
                "metric": "total_seconds_loads_and_reports",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in times.items()},
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

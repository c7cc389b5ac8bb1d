"""Retention as an action: what no reader can reach any more goes.

Mark: the last commits name what their state is made of - an epoch of ``done``, snapshots, the changes since
these. Sweep: everything else of the state goes, also what runs that died have left. Rows of runs (videos,
channel statistics, audit and so on) go by age, as whole folders, but never those of the last commits or
those that a published target may still have to read. Readers that began within the last commits keep
their files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from freshet.plans.publish import Published
from freshet.plans.store import RunStore, stamp_of
from freshet.session import tune
from freshet.sources.files import delete, folders

#: Tables whose rows belong to their run alone.
RUN_TABLES = ("channel_stats", "video_details", "quarantine", "late", "given_up", "audit")
KEPT_COMMITS = 10


@dataclass
class Plan:
    """Folders that go."""

    paths: list[str] = field(default_factory=list)

    def runs(self, spark: SparkSession, path: str, goes) -> None:
        self.paths += [f"{path}/run={run}" for run in folders(spark, path, "run=") if goes(run)]


def _marked(spark: SparkSession, store: RunStore, keep: int) -> list:
    """The last commits, newest first: a row each."""
    return store.committed_runs(spark).orderBy(F.col("run").desc()).limit(keep).collect()


def sweepable(
    spark: SparkSession, store: RunStore, before: datetime | None = None, keep: int = KEPT_COMMITS, targets: Sequence[str] = ()
) -> list[str]:
    """What ``sweep`` would remove. Nothing as long as there is no commit."""
    if keep < 1:
        raise ValueError("at least the last commit is kept")
    last = _marked(spark, store, keep)
    if not last:
        return []
    newest, plan = last[0]["run"], Plan()
    epochs, bases = {r["epoch"] for r in last}, {r["base"] for r in last}
    recent, reach = {r["run"] for r in last}, min(bases)
    committed = {r["run"] for r in store.committed_runs(spark).select("run").collect()}

    def died(run: str) -> bool:
        """A run in flight comes after the last commit, or repeats it."""
        return run < newest and run not in committed

    plan.runs(spark, f"{store.root}/staging", lambda run: run < newest)
    for table in ("open", "watermark"):
        plan.runs(spark, f"{store.root}/{table}", lambda run: died(run) or (run <= reach and run not in recent))
        plan.runs(spark, f"{store.root}/{table}_base", lambda run: run < newest and run not in bases)
    plan.runs(spark, f"{store.root}/cleared", died)
    for epoch in folders(spark, f"{store.root}/done", "epoch="):
        path = f"{store.root}/done/epoch={epoch}"
        if int(epoch) < min(epochs):
            plan.paths.append(path)
        else:
            plan.runs(spark, path, died)

    # A target reads the runs after its last publish, and those of that publish if it must be undone.
    steps = [Published(spark, store, target).last() for target in targets]
    limit = min((step.after if step else "" for step in steps), default=newest)
    cutoff = min(stamp_of(before), limit) if before else ""
    for table in RUN_TABLES:
        plan.runs(spark, f"{store.root}/{table}", lambda run: died(run) or (run < cutoff and run not in recent))
    return plan.paths


def sweep(
    spark: SparkSession, store: RunStore, before: datetime | None = None, keep: int = KEPT_COMMITS, targets: Sequence[str] = ()
) -> list[str]:
    """Remove unreachable state, leavings of runs that died, and the rows of runs earlier than ``before``.

    ``keep`` commits stay readable; ``targets`` are the places that the store is published to. Returns
    the folders removed. Sweeping again, or after a sweep that died, removes what is left.
    """
    tune(spark)
    paths = sweepable(spark, store, before, keep, targets)
    for path in paths:
        delete(spark, path)
    return paths


def sweep_months(spark: SparkSession, lake: str, before: datetime) -> list[str]:
    """Remove the months of a ``year=/month=`` lake that lie wholly before the month of ``before``."""
    gone = []
    for year in folders(spark, lake, "year="):
        months = [m for m in folders(spark, f"{lake}/year={year}", "month=") if f"{year}{m}" < f"{before:%Y%m}"]
        gone += [f"{lake}/year={year}/month={m}" for m in months]
    for path in gone:
        delete(spark, path)
    return gone

"""Stored monthly rows of the reports, rewritten only for the months that a load reaches.

All reports start from the same rows per facility, bed type and month. They are stored by month; after a load, the months
whose beds it changed and the months that the stays of its claims fill, or filled before, are computed again. All other
months keep their files.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.functions.dates import period_of
from wardflow.operators import stays as s
from wardflow.plans import store
from wardflow.plans.capacity import Warehouse, stays_of
from wardflow.plans.dashboard import narrowed, with_discharges
from wardflow.settings import Settings

TABLE = "monthly"


def reached_periods(old: Warehouse, new: Warehouse, settings: Settings, claim_periods: list[str]) -> list[str]:
    """Months of the scope in which some stay counts differently, if only claims of ``claim_periods`` differ.

    A changed claim can hand its stay to a row of another month, so all rows of the stays concerned are looked at, before
    and after the change. The stays are few next to the claims, and only their keys are joined.
    """
    concerned = [w.admissions.filter(F.col("period").isin(list(claim_periods))).select(*s.STAY) for w in (old, new)]
    keys = concerned[0].unionByName(concerned[1]).distinct()
    scope = settings.scope
    before, after = [
        s.reached_months(stays_of(replace(w, admissions=w.admissions.join(keys, s.STAY, "left_semi")), settings), scope) for w in (old, new)
    ]
    found = {r[0] for r in before.union(after).select(period_of("month_start")).collect()}
    return [p for p in scope.periods if p in found]


def refresh(
    spark: SparkSession,
    reports: str,
    new: Warehouse,
    settings: Settings,
    run: str,
    old: Warehouse | None = None,
    changed: dict[str, list[str]] | None = None,
) -> list[str]:
    """Brings the stored months up to date with ``new``; returns the months that were rewritten.

    ``changed`` are the months that a load has published per table, as its pointer entries tell, and ``old`` is the warehouse
    before it. Without both, all months of the scope are computed.
    """
    seen = store.current(spark, reports)
    if old is None or changed is None:
        periods = settings.scope.periods
    else:
        touched = set(changed.get("bed", [])) | set(reached_periods(old, new, settings, changed.get("admission", [])))
        periods = [p for p in settings.scope.periods if p in touched]
    if periods:
        rows = with_discharges(*narrowed(new, settings, periods=periods))
        store.switch(spark, reports, {TABLE: store.write(rows, reports, TABLE, run, periods)}, seen)
    return periods


def stored(spark: SparkSession, reports: str, w: Warehouse, settings: Settings, periods: list[str] | None = None) -> DataFrame:
    """The stored monthly rows, to be passed to a report as ``rows``."""
    return store.read(spark, reports, TABLE, with_discharges(w, settings).schema, periods)

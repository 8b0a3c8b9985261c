"""Diagnosis of facilities over the whole scope, and what the scope leaves out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow.functions.dates import period_of
from wardflow.functions.numbers import ratio, rounded
from wardflow.operators import beds as b
from wardflow.operators.stays import STAY
from wardflow.plans.capacity import MOVES, Warehouse, in_order, monthly
from wardflow.settings import Settings

FACILITY_TYPE = ["facility_id", "bed_type"]


def _rolled_up(w: Warehouse, settings: Settings, rows: DataFrame | None) -> DataFrame:
    sums = ["admissions", "occupied_days", "bed_days_total", "bed_days_public"]
    starts = ["first_admit", "first_discharge"]
    ends = ["last_admit", "last_discharge"]
    rows = rows or monthly(w, settings)
    return (
        rows.groupBy(*FACILITY_TYPE)
        .agg(
            F.count("*").alias("months"),
            rounded(ratio(F.sum("beds_total"), F.count("beds_total")), 1).alias("beds_total_mean"),
            rounded(ratio(F.sum("beds_public"), F.count("beds_public")), 1).alias("beds_public_mean"),
            F.count_if(F.col("beds_public") > F.col("beds_total")).alias("months_public_above_total"),
            *[F.sum(c).alias(c) for c in sums],
            *[F.min(c).alias(c) for c in starts],
            *[F.max(c).alias(c) for c in ends],
            F.sum(F.when(F.col("admitted"), F.col("admissions"))).alias("los_n"),
            F.sum(F.when(F.col("admitted"), F.col("los_days"))).alias("los_days"),
        )
        .withColumns(
            {
                "occupancy_total_pct": rounded(ratio("occupied_days", "bed_days_total", 100), 2),
                "occupancy_pct": rounded(ratio("occupied_days", "bed_days_public", 100), 2),
                "gap_pct": rounded(
                    ratio(F.col("bed_days_total") - F.col("bed_days_public"), "bed_days_total", 100), 2
                ),
            }
        )
    )


SUMMARY = [
    *FACILITY_TYPE,
    "months",
    "beds_total_mean",
    "beds_public_mean",
    "months_public_above_total",
    "admissions",
    "occupied_days",
    "bed_days_total",
    "bed_days_public",
    "occupancy_total_pct",
    "occupancy_pct",
    "gap_pct",
    *MOVES,
]


def facility_summary(w: Warehouse, settings: Settings, rows: DataFrame | None = None) -> DataFrame:
    return _rolled_up(w, settings, rows).select(*SUMMARY)


def facility_diagnosis(
    w: Warehouse, settings: Settings, rows: DataFrame | None = None, ordered: bool = False
) -> DataFrame:
    """Occupancy pattern and gap alert per facility and type; rounded rates decide.

    The network's mean stay has one row per bed type of the scope.
    """
    names, t, scope = settings.labels, settings.thresholds, settings.scope
    units = _rolled_up(w, settings, rows)
    network = units.groupBy("bed_type").agg(
        rounded(ratio(F.sum("los_days"), F.sum("los_n")), 2).alias("network_mean_days")
    )
    total, public = F.col("occupancy_total_pct"), F.col("occupancy_pct")
    high_total, high_public = total >= t.high_from, public >= t.high_from
    pattern = (
        F.when(F.col("months") < t.min_months, names.short_series)
        .when(F.col("admissions") == 0, names.no_production)
        .when(total.isNull(), names.inconsistent)
        .when(public.isNull(), names.no_public_beds_in_period)
        .when(high_total & high_public, names.high_high)
        .when(~high_total & high_public, names.high_public_only)
        .when(~high_total & ~high_public, names.low_low)
        .otherwise(names.inconsistent)
    )
    gap = F.col("gap_pct") > t.gap_above
    return (
        units.join(F.broadcast(network), "bed_type", "left")
        .transform(b.with_labels, w.facilities, w.bed_types, names)
        .select(
            F.lit(scope.start).alias("scope_start"),
            F.lit(scope.end).alias("scope_end"),
            "facility_name",
            "category",
            *SUMMARY,
            rounded(F.col("beds_total_mean") - F.col("beds_public_mean"), 1).alias("beds_not_public_mean"),
            rounded(ratio("los_days", "los_n"), 2).alias("mean_days"),
            "network_mean_days",
            pattern.alias("pattern"),
            F.when(gap, f"{names.gap_alert}{t.gap_above:.0f}%").alias("gap_alert"),
        )
        .transform(
            in_order,
            [gap.desc_nulls_last(), F.col("gap_pct").desc_nulls_last(), F.asc("facility_name"), F.asc("bed_type")],
            ordered,
        )
    )


# The action the dashboard suggests for each quadrant.
ACTIONS = {
    "high_high": "expand physical capacity",
    "high_public_only": "maintenance, equipment and staff for blocked beds",
    "low_low": "readjust the care profile, do not expand",
    "gap": "priority investment: maintenance and running costs",
}


def investment_quadrant(w: Warehouse, settings: Settings, rows: DataFrame | None = None) -> DataFrame:
    """Quadrant of the two rates with the suggested action; a large gap comes first."""
    names = settings.labels
    pattern = F.col("pattern")
    action = (
        F.when(F.col("gap_alert").isNotNull(), ACTIONS["gap"])
        .when(pattern == names.high_high, ACTIONS["high_high"])
        .when(pattern == names.high_public_only, ACTIONS["high_public_only"])
        .when(pattern == names.low_low, ACTIONS["low_low"])
    )
    return facility_diagnosis(w, settings, rows).select(
        "facility_id",
        "facility_name",
        "bed_type",
        "gap_pct",
        "occupancy_total_pct",
        "occupancy_pct",
        "pattern",
        action.alias("action"),
    )


def out_of_scope_share(w: Warehouse, settings: Settings, ordered: bool = False) -> DataFrame:
    """Distinct stays inside and outside the mapped specialties, per facility with own beds.

    A stay may carry both kinds of rows, so both marks are kept per stay and only then counted.
    Counts are brought to facility and month before the check for own beds in that month, which
    is therefore a join of two small aggregates on unique keys.
    """
    scope = settings.scope
    inside = F.coalesce(F.col("bed_type").isin(*scope.bed_types), F.lit(False))
    own_months = b.in_scope(w.beds, scope).select("facility_id", "period").distinct()
    return (
        w.admissions.filter(
            (F.col("claim_kind") == scope.claim_kind)
            & F.col("admit_date").between(F.lit(scope.start), F.lit(scope.end))
        )
        .join(w.bridge, "specialty", "left")
        .groupBy(*STAY)
        .agg(F.max(inside).alias("inside"), F.max(F.col("bed_type").isNull()).alias("outside"))
        .groupBy("facility_id", period_of("admit_date").alias("period"))
        .agg(
            F.count_if("inside").alias("inside"), F.count_if("outside").alias("outside"), F.count("*").alias("stays")
        )
        .join(own_months, ["facility_id", "period"], "left_semi")
        .groupBy("facility_id")
        .agg(
            F.sum("inside").alias("stays_inside"),
            F.sum("outside").alias("stays_outside"),
            F.sum("stays").alias("stays"),
        )
        .join(b.latest_name(w.facilities), "facility_id", "left")
        .select(
            "facility_id",
            "facility_name",
            "stays_inside",
            "stays_outside",
            rounded(ratio("stays_outside", "stays", 100), 1).alias("outside_pct"),
        )
        .transform(in_order, [F.desc("outside_pct"), F.asc("facility_id")], ordered)
    )

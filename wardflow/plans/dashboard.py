"""Measures of the dashboard: headline figures, trends and matrices."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardflow.functions.dates import month_of, stay_days
from wardflow.functions.numbers import ratio, rounded, total
from wardflow.operators import beds as b, dedup, stays as s
from wardflow.operators.beds import UNIT
from wardflow.plans.capacity import Warehouse, in_order, monthly, stays_of
from wardflow.settings import Settings


def with_discharges(w: Warehouse, settings: Settings) -> DataFrame:
    """Monthly rows with the discharges of the month."""
    left = s.discharges_monthly(stays_of(w, settings), settings.scope)
    return monthly(w, settings).join(left, UNIT, "left")


def _rates() -> list[Column]:
    days = F.sum("occupied_days")
    return [
        rounded(ratio(days, F.sum("bed_days_total"), 100), 2).alias("occupancy_total_pct"),
        rounded(ratio(days, F.sum("bed_days_public"), 100), 2).alias("occupancy_public_pct"),
    ]


def _mean_stay() -> Column:
    counted = F.when(F.col("admitted"), F.col("admissions"))
    return rounded(ratio(F.sum("los_days"), F.sum(counted)), 2).alias("mean_days")


def network_kpis(w: Warehouse, settings: Settings, rows: DataFrame | None = None) -> DataFrame:
    """Discharges, occupancy on total and public beds (ratios of sums) and mean stay.

    ``rows`` are those of :func:`with_discharges`, here and in the reports below.
    """
    rows = rows or with_discharges(w, settings)
    return rows.agg(total("discharges").alias("discharges"), *_rates(), _mean_stay())


def narrowed(
    w: Warehouse,
    settings: Settings,
    periods: list[str] | None = None,
    facilities: list[str] | None = None,
    bed_types: list[str] | None = None,
    specialties: list[str] | None = None,
) -> tuple[Warehouse, Settings]:
    """The dashboard's filters, for every report: pass its result on as the report's first two arguments.

    None leaves a filter out, an empty list selects nothing. Bed types and specialties act on finished stays, after each
    stay's row is chosen, so a stay counts under one of them. Facilities identify a stay, so they reach the sources. Periods
    reach the beds and bound the months that stays are apportioned to; claims of the whole scope still choose each stay's
    row, as a discharge may lie in another month than the admission, even before it. Beds are those of the bed types, and
    of the types that the specialties map to.
    """
    beds, claims, scope = w.beds, w.admissions, settings.scope
    if periods is not None:
        beds = beds.filter(F.col("period").isin(list(periods)))
        months = [m for m in scope.months if m.strftime("%Y%m") in set(periods)]
        until = scope.claims_until or scope.end
        if months:
            last = (months[-1].replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)
            scope = replace(scope, start=max(scope.start, months[0]), end=min(scope.end, last))
        scope = replace(scope, claims_until=until, chosen=tuple(months))
    if facilities is not None:
        beds = beds.filter(F.col("facility_id").isin(list(facilities)))
        claims = claims.filter(F.col("facility_id").isin(list(facilities)))
    if bed_types is not None:
        beds = beds.filter(F.col("bed_type").isin(list(bed_types)))
    if specialties is not None:
        mapped = w.bridge.filter(F.col("specialty").isin(list(specialties))).select("bed_type")
        beds = beds.join(mapped.distinct(), "bed_type", "left_semi")
        w = replace(w, stay_specialties=tuple(specialties))
    return replace(w, beds=beds, admissions=claims), replace(settings, scope=scope)


def filtered_kpis(w: Warehouse, settings: Settings, **filters) -> DataFrame:
    return network_kpis(*narrowed(w, settings, **filters))


def occupancy_trend(w: Warehouse, settings: Settings, rows: DataFrame | None = None, ordered: bool = False) -> DataFrame:
    """Both occupancy rates of the network by month."""
    rows = rows or monthly(w, settings)
    return in_order(rows.groupBy("month_start", "period").agg(*_rates()), ["month_start"], ordered)


def light(rate: Column, settings: Settings) -> Column:
    """Three-colour light: below 70, up to 85, above."""
    t, names = settings.thresholds, settings.labels
    return (
        F.when(rate < t.severe_below, names.idle).when(rate <= t.healthy_up_to, names.healthy).when(
            rate > t.healthy_up_to, names.overload
        )
    )


def hospital_matrix(
    w: Warehouse, settings: Settings, rows: DataFrame | None = None, ordered: bool = False
) -> DataFrame:
    """Per facility: mean registered beds, discharges, occupancy, mean stay and light."""
    rate = F.col("occupancy_total_pct")
    rows = rows or with_discharges(w, settings)
    beds_of_month = rows.groupBy("facility_id", "month_start").agg(
        *[F.sum(c).alias(c) for c in ("beds_total", "discharges", "occupied_days", "bed_days_total", "bed_days_public")],
        F.sum("los_days").alias("los_days"),
        F.sum(F.when(F.col("admitted"), F.col("admissions"))).alias("los_n"),
    )
    measures = beds_of_month.groupBy("facility_id").agg(
        rounded(ratio(F.sum("beds_total"), F.count("beds_total")), 1).alias("beds_total_mean"),
        total("discharges").alias("discharges"),
        *_rates(),
        rounded(ratio(F.sum("los_days"), F.sum("los_n")), 2).alias("mean_days"),
    )
    named = (
        measures.join(b.latest_name(w.facilities), "facility_id", "left")
        .select(
            "facility_id",
            F.coalesce("facility_name", F.concat(F.lit(settings.labels.unknown_facility), F.col("facility_id"))).alias(
                "facility_name"
            ),
            "beds_total_mean",
            "discharges",
            "occupancy_total_pct",
            "mean_days",
            light(rate, settings).alias("light"),
        )
    )
    return in_order(named, ["facility_name", "facility_id"], ordered)


def specialty_stays(w: Warehouse, settings: Settings) -> DataFrame:
    """One row per stay of any specialty admitted in the scope, the latest discharge first."""
    scope = settings.scope
    rows = (
        w.admissions.filter(
            (F.col("claim_kind") == scope.claim_kind)
            & F.col("admit_date").between(F.lit(scope.start), F.lit(scope.end))
            & s.counted(month_of("admit_date"), scope)
        )
        .withColumn("stay_days", stay_days("admit_date", "discharge_date", "billed_days", "reported_days"))
        .select(*s.STAY, "discharge_date", "specialty", "stay_days")
    )
    return dedup.keep_last(rows, s.STAY, ["discharge_date"])


def stay_by_specialty(w: Warehouse, settings: Settings, ordered: bool = False) -> DataFrame:
    """Mean stay per specialty, longest first if ordered."""
    means = (
        specialty_stays(w, settings)
        .groupBy("specialty")
        .agg(F.count("*").alias("stays"), F.sum("stay_days").alias("days"))
        .join(w.specialties, "specialty", "left")
        .select("specialty", "description", "stays", rounded(ratio("days", "stays"), 2).alias("mean_days"))
    )
    return in_order(means, [F.desc("mean_days"), F.asc_nulls_last("specialty")], ordered)


def occupancy_by_type_specialty(w: Warehouse, settings: Settings) -> DataFrame:
    """Occupied days per bed type and specialty over the registered days of the bed type."""
    scope = settings.scope
    capacity = b.capacity_by_month(w.beds, scope)
    supply = capacity.groupBy("bed_type").agg(
        F.sum("bed_days_total").alias("bed_days_total"), F.sum("bed_days_public").alias("bed_days_public")
    )
    demand = (
        s.stay_months(stays_of(w, settings), scope)
        .groupBy(*UNIT, "specialty")
        .agg(F.sum("days_here").alias("occupied_days"))
        .join(capacity.select(*UNIT), UNIT, "left_semi")
        .groupBy("bed_type", "specialty")
        .agg(F.sum("occupied_days").alias("occupied_days"))
    )
    return (
        demand.join(supply, "bed_type")
        .join(w.specialties, "specialty", "left")
        .select(
            "bed_type",
            "specialty",
            "description",
            "occupied_days",
            rounded(ratio("occupied_days", "bed_days_total", 100), 2).alias("occupancy_total_pct"),
            rounded(ratio("occupied_days", "bed_days_public", 100), 2).alias("occupancy_public_pct"),
        )
    )


def specialty_deviation(w: Warehouse, settings: Settings, bed_specialties: DataFrame) -> DataFrame:
    """Share of registered bed days against share of attended days, per facility and specialty.

    ``bed_specialties`` tells the specialty that a bed code is registered for (bed_code, specialty); beds of other codes
    stand under a missing specialty. The windows run over the specialties of one facility, as many rows as the domain has.
    """
    scope, stays = settings.scope, stays_of(w, settings)
    month = F.to_date(F.concat("period", F.lit("01")), "yyyyMMdd")
    codes = b.in_scope(w.beds, scope).groupBy("facility_id", "bed_code", "period").agg(F.sum("beds_total").alias("beds"))
    supply = (
        codes.join(bed_specialties.dropDuplicates(["bed_code"]), "bed_code", "left")
        .groupBy("facility_id", "specialty")
        .agg(F.sum(F.col("beds") * F.dayofmonth(F.last_day(month))).alias("registered"))
    )
    demand = s.stay_months(stays, scope).groupBy("facility_id", "specialty").agg(F.sum("days_here").alias("attended"))
    facility = Window.partitionBy("facility_id")
    share = {
        f"{c}_pct": rounded(ratio(F.coalesce(c, F.lit(0)), F.sum(c).over(facility), 100), 2)
        for c in ("registered", "attended")
    }
    both = supply.alias("r").join(
        demand.alias("a"),
        (F.col("r.facility_id") == F.col("a.facility_id")) & F.col("r.specialty").eqNullSafe(F.col("a.specialty")),
        "full_outer",
    )
    return (
        both.select(
            F.coalesce("r.facility_id", "a.facility_id").alias("facility_id"),
            F.coalesce("r.specialty", "a.specialty").alias("specialty"),
            "registered",
            "attended",
        )
        .withColumns(share)
        .select(
            "facility_id",
            "specialty",
            "registered",
            "attended",
            "registered_pct",
            "attended_pct",
            rounded(F.col("attended_pct") - F.col("registered_pct"), 2).alias("deviation_pct"),
        )
    )

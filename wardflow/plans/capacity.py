"""Installed capacity, admissions per bed and occupancy bands."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.functions.numbers import ratio, rounded
from wardflow.operators import beds as b, stays as s
from wardflow.operators.beds import UNIT
from wardflow.settings import Settings

SPAN = ["period", "month_label", "month_start", "month_end"]
MOVES = ["first_admit", "last_admit", "first_discharge", "last_discharge"]
ORDER = ["month_start", "facility_name", "bed_type"]


@dataclass(frozen=True)
class Warehouse:
    """The tables an analysis reads, and the specialties of the finished stays that it counts (None: all)."""

    beds: DataFrame
    admissions: DataFrame
    facilities: DataFrame
    bed_types: DataFrame
    bridge: DataFrame
    specialties: DataFrame
    stay_specialties: tuple[str, ...] | None = None


def is_latest(beds: DataFrame, settings: Settings) -> Column:
    """Yes/no mark of the latest month present in the result.

    The result holds exactly the months of the scoped bed rows, so their maximum is a scalar
    subquery over one pruned column; no window pulls all rows into one task.
    """
    latest = b.in_scope(beds, settings.scope).agg(F.max("period")).scalar()
    return F.when(F.col("period") == latest, settings.labels.yes).otherwise(settings.labels.no)


def stays_of(w: Warehouse, settings: Settings) -> DataFrame:
    stays = s.stay_base(w.admissions, w.bridge, settings.scope)
    return stays if w.stay_specialties is None else stays.filter(F.col("specialty").isin(list(w.stay_specialties)))


def in_order(df: DataFrame, keys: list, ordered: bool) -> DataFrame:
    """df, sorted for a reader if asked for; a caller that aggregates or writes it saves the sort."""
    return df.orderBy(*keys) if ordered else df


def bed_capacity(w: Warehouse, settings: Settings, ordered: bool = False) -> DataFrame:
    """Beds per facility, type and month, with names and the latest month marked."""
    return (
        b.capacity_by_month(w.beds, settings.scope)
        .transform(b.with_labels, w.facilities, w.bed_types, settings.labels)
        .withColumn("is_latest", is_latest(w.beds, settings))
        .select(
            *SPAN, "facility_id", "facility_name", "bed_type", "category", "beds_total", "beds_public", "is_latest"
        )
        .transform(in_order, ORDER, ordered)
    )


def monthly(w: Warehouse, settings: Settings) -> DataFrame:
    """Every capacity row with the stays of its month; both sides are grouped on the join keys already.

    All reports below and in the sibling modules start from these rows. To run several of them,
    write this frame to a table once and pass it to each as ``rows``.
    """
    capacity = b.capacity_by_month(w.beds, settings.scope)
    activity = s.monthly_activity(stays_of(w, settings), settings.scope)
    zero = F.lit(0).cast("long")
    return capacity.join(activity, UNIT, "left").withColumns(
        {
            "admitted": F.col("admissions") > 0,
            "admissions": F.coalesce("admissions", zero),
            "occupied_days": F.coalesce("occupied_days", zero),
        }
    )


def admissions_per_bed(
    w: Warehouse, settings: Settings, rows: DataFrame | None = None, ordered: bool = False
) -> DataFrame:
    """Admissions and occupied days against public beds."""
    rows = rows or monthly(w, settings)
    return (
        rows.transform(b.with_labels, w.facilities, w.bed_types, settings.labels)
        .select(
            *SPAN,
            *MOVES,
            "facility_id",
            "facility_name",
            "bed_type",
            "category",
            "beds_public",
            "bed_days_public",
            "admissions",
            "occupied_days",
            rounded(ratio("admissions", "beds_public"), 2).alias("admissions_per_bed"),
            rounded(ratio("occupied_days", "bed_days_public", 100), 2).alias("occupancy_pct"),
        )
        .transform(in_order, ORDER, ordered)
    )


def band(beds: Column, days: Column, rate: Column, settings: Settings) -> Column:
    """Occupancy band of an unrounded rate; an unknown rate with days falls to the last band."""
    t, names = settings.thresholds, settings.labels
    return (
        F.when(beds == 0, names.no_public_beds)
        .when(days == 0, names.no_production)
        .when(rate < t.severe_below, names.severe_idle)
        .when(rate < t.idle_below, names.idle)
        .when(rate <= t.healthy_up_to, names.healthy)
        .otherwise(names.overload)
    )


def occupancy_bands(
    w: Warehouse, settings: Settings, rows: DataFrame | None = None, ordered: bool = False
) -> DataFrame:
    """Occupancy of total and public beds, banded on the public rate."""
    total_rate = ratio("occupied_days", "bed_days_total", 100)
    public_rate = ratio("occupied_days", "bed_days_public", 100)
    rows = rows or monthly(w, settings)
    return (
        rows.transform(b.with_labels, w.facilities, w.bed_types, settings.labels)
        .select(
            *SPAN,
            *MOVES,
            "facility_id",
            "facility_name",
            "bed_type",
            "category",
            "beds_total",
            "beds_public",
            "bed_days_total",
            "bed_days_public",
            "admissions",
            "occupied_days",
            rounded(total_rate, 2).alias("occupancy_total_pct"),
            rounded(public_rate, 2).alias("occupancy_pct"),
            band(F.col("beds_public"), F.col("occupied_days"), public_rate, settings).alias("band"),
            is_latest(w.beds, settings).alias("is_latest"),
        )
        .transform(in_order, ORDER, ordered)
    )

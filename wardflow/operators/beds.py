"""Capacity side: beds per facility, type and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow.functions.dates import month_of_period
from wardflow.operators.calendar import with_calendar
from wardflow.operators.dedup import first_value, latest_value
from wardflow.settings import Labels, Scope

UNIT = ["facility_id", "bed_type", "month_start"]


def in_scope(beds: DataFrame, scope: Scope) -> DataFrame:
    """Own beds of the wanted types in the months of the scope.

    Membership in the scope's calendar is an ``IN`` list on ``period``: it reaches the scan,
    and prunes directories where the table is partitioned by period.
    """
    return beds.filter(
        F.col("period").isin(scope.periods)
        & F.col("bed_type").isin(*scope.bed_types)
        & (F.col("own_flag") == scope.own_flag)
    )


def capacity_by_month(beds: DataFrame, scope: Scope) -> DataFrame:
    """Total and public beds per facility, type and month."""
    return (
        in_scope(beds, scope)
        .withColumn("month_start", month_of_period("period"))
        .groupBy(*UNIT)
        .agg(F.sum("beds_total").alias("beds_total"), F.sum("beds_public").alias("beds_public"))
        .transform(with_calendar)
        .withColumns(
            {
                "bed_days_total": F.col("beds_total") * F.col("days_in_month"),
                "bed_days_public": F.col("beds_public") * F.col("days_in_month"),
            }
        )
    )


def latest_name(facilities: DataFrame) -> DataFrame:
    return latest_value(facilities, "facility_id", "facility_name", "period")


def with_labels(df: DataFrame, facilities: DataFrame, bed_types: DataFrame, labels: Labels) -> DataFrame:
    """Add the facility's latest name and the bed type's category, with fallbacks."""
    names = latest_name(facilities)
    categories = first_value(bed_types, "bed_type", "category")
    return (
        df.join(names, "facility_id", "left")
        .join(categories, "bed_type", "left")
        .withColumns(
            {
                "facility_name": F.coalesce(
                    "facility_name", F.concat(F.lit(labels.unknown_facility), F.col("facility_id"))
                ),
                "category": F.coalesce("category", F.lit(labels.unknown_type)),
            }
        )
    )

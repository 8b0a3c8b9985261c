"""Comparison of two registries, and the approximate utilisation built on monthly beds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow.functions.dates import period_of
from wardflow.functions.numbers import ratio, rounded, total
from wardflow.operators.profile import top
from wardflow.settings import Settings

PLACE = ["period", "facility_id"]


def _beds_of(df: DataFrame, name: str) -> DataFrame:
    return df.dropna(subset=PLACE).groupBy(*PLACE).agg(total("beds_public").alias(name))


def source_reconciliation(registry: DataFrame, beds: DataFrame) -> DataFrame:
    """Public beds by facility and month in both sources; a side without a row counts 0."""
    return (
        _beds_of(registry, "registry_beds")
        .join(_beds_of(beds, "bed_file_beds"), PLACE, "full_outer")
        .fillna(0, ["registry_beds", "bed_file_beds"])
        .withColumn("difference", F.col("registry_beds") - F.col("bed_file_beds"))
    )


def top_differences(compared: DataFrame, n: int = 10) -> DataFrame:
    return top(compared, n, F.abs("difference").desc(), *[F.asc(c) for c in PLACE])


def beds_and_admissions(beds: DataFrame, admissions: DataFrame) -> DataFrame:
    """Every bed row (facility, month) with its distinct claims and reported days, 0 when none."""
    claims = (
        admissions.filter(F.col("facility_id").isNotNull() & F.col("admit_date").isNotNull())
        .groupBy(period_of("admit_date").alias("period"), "facility_id")
        .agg(F.count_distinct("claim_id").alias("admissions"), total("reported_days").alias("reported_days"))
    )
    return _beds_of(beds, "beds_public").join(claims, PLACE, "left").fillna(0, ["admissions", "reported_days"])


def beds_admissions(beds: DataFrame, admissions: DataFrame, settings: Settings) -> DataFrame:
    """Approximate utilisation per facility and month, every month taken as 30 days."""
    return beds_and_admissions(beds, admissions).select(
        *PLACE,
        "beds_public",
        "admissions",
        "reported_days",
        (F.col("beds_public") * settings.thresholds.approx_month_days).alias("bed_days_approx"),
        rounded(
            ratio("reported_days", F.col("beds_public") * settings.thresholds.approx_month_days, 100), 2
        ).alias("occupancy_approx_pct"),
        rounded(ratio("admissions", "beds_public"), 4).alias("admissions_per_bed"),
    )


def top_beds_per_admission(rows: DataFrame, n: int = 30) -> DataFrame:
    return top(
        rows.select(*PLACE, "beds_public", "admissions", "admissions_per_bed", "occupancy_approx_pct"),
        n,
        F.col("admissions_per_bed").desc_nulls_last(),
        *[F.asc(c) for c in PLACE],
    )


def facility_indicators(beds: DataFrame, admissions: DataFrame, settings: Settings) -> DataFrame:
    """Per facility over the whole span: mean beds, sums, and occupancy as a fraction of a year."""
    mean_beds = ratio("beds", "months")
    year = settings.thresholds.approx_year_days
    return (
        beds_and_admissions(beds, admissions)
        .groupBy("facility_id")
        .agg(
            F.sum("beds_public").alias("beds"),
            F.count("*").alias("months"),
            F.sum("admissions").alias("admissions"),
            F.sum("reported_days").alias("reported_days"),
        )
        .select(
            "facility_id",
            rounded(mean_beds, 4).alias("beds_mean"),
            "admissions",
            "reported_days",
            rounded(ratio(F.col("admissions") * F.col("months"), "beds"), 4).alias("admissions_per_bed"),
            rounded(mean_beds * year, 4).alias("bed_days_approx"),
            rounded(ratio(F.col("reported_days") * F.col("months"), F.col("beds") * year), 6).alias(
                "occupancy_approx"
            ),
        )
    )

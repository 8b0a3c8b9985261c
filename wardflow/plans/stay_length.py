"""Length of stay of each facility against the network."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow.functions.numbers import deviation, mean_of, ratio, rounded
from wardflow.operators.beds import UNIT, with_labels
from wardflow.plans.capacity import MOVES, ORDER, SPAN, Warehouse, monthly, in_order
from wardflow.settings import Settings

LOS_MOVES = [f"los_{m}" for m in MOVES]


def counted(rows: DataFrame) -> DataFrame:
    """Units whose stays count: admitted in a month in which the facility had beds of the type."""
    return rows.filter("admitted")


def network_totals(rows: DataFrame, *keys: str) -> DataFrame:
    """Count, days, mean and population deviation of the stays behind monthly rows."""
    return (
        counted(rows)
        .groupBy(*keys)
        .agg(
            F.sum("admissions").alias("network_admissions"),
            F.sum("los_days").alias("network_days"),
            F.sum("los_squares").alias("squares"),
        )
        .withColumns(
            {
                "network_mean": mean_of("network_admissions", "network_days"),
                "network_sd": F.coalesce(
                    deviation("network_admissions", "network_days", "squares", sample=False), F.lit(0.0)
                ),
            }
        )
        .drop("squares")
    )


def network_stats(w: Warehouse, settings: Settings, rows: DataFrame | None = None) -> DataFrame:
    return network_totals(rows or monthly(w, settings), "month_start", "bed_type").withColumns(
        {"network_mean": rounded("network_mean", 2), "network_sd": rounded("network_sd", 2)}
    )


def facility_stats(w: Warehouse, settings: Settings, rows: DataFrame | None = None) -> DataFrame:
    return counted(rows or monthly(w, settings)).select(
        *UNIT,
        "admissions",
        "los_days",
        rounded(mean_of("admissions", "los_days"), 2).alias("mean_days"),
        *[F.col(f"los_{m}").alias(m) for m in MOVES],
    )


def length_of_stay(
    w: Warehouse, settings: Settings, rows: DataFrame | None = None, ordered: bool = False
) -> DataFrame:
    """Mean stay per facility, type and month with its z score within the network.

    The network side has at most one row per month and bed type of the scope.
    """
    names, limit = settings.labels, settings.thresholds.z_limit
    rows = rows or monthly(w, settings)
    network = F.broadcast(network_totals(rows, "month_start", "bed_type"))
    mean = F.when(F.col("admitted"), mean_of("admissions", "los_days"))
    error = F.col("network_sd") / F.sqrt(F.col("admissions").cast("double"))
    z = (F.col("mean_days") - F.col("network_mean")) / F.nullif("error", F.lit(0.0))
    zero = F.lit(0).cast("long")
    return (
        rows.join(network, ["month_start", "bed_type"], "left")
        .withColumn("mean_days", mean)
        .withColumn("error", F.when(F.col("admitted"), error))
        .withColumn("z", z)
        .transform(with_labels, w.facilities, w.bed_types, names)
        .select(
            *SPAN,
            *[F.col(f"los_{m}").alias(m) for m in MOVES],
            "facility_id",
            "facility_name",
            "bed_type",
            "category",
            "beds_public",
            "admissions",
            F.coalesce("los_days", zero).alias("stay_days"),
            rounded("mean_days", 2).alias("mean_days"),
            F.coalesce("network_admissions", zero).alias("network_admissions"),
            F.coalesce("network_days", zero).alias("network_days"),
            rounded("network_mean", 2).alias("network_mean"),
            rounded("network_sd", 2).alias("network_sd"),
            rounded("z", 2).alias("z"),
            F.when(F.col("admitted").isNull() | ~F.col("admitted"), names.no_stays)
            .when(F.col("z") > limit, names.above)
            .when(F.col("z") < -limit, names.below)
            .otherwise(names.within)
            .alias("status"),
        )
        .transform(in_order, ORDER, ordered)
    )


def stay_means(w: Warehouse, settings: Settings, rows: DataFrame | None = None) -> DataFrame:
    """Mean stay over the whole scope per facility and type, next to the network's mean per type."""
    rows = rows or monthly(w, settings)
    per_unit = counted(rows).groupBy("facility_id", "bed_type").agg(
        F.sum("admissions").alias("n"), F.sum("los_days").alias("days")
    )
    network = per_unit.groupBy("bed_type").agg(
        rounded(ratio(F.sum("days"), F.sum("n")), 2).alias("network_mean_days")
    )
    return per_unit.join(F.broadcast(network), "bed_type").select(
        "facility_id", "bed_type", rounded(ratio("days", "n"), 2).alias("mean_days"), "network_mean_days"
    )

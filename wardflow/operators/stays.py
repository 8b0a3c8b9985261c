"""Stay side: one row per stay, and what stays add up to per month or day."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardflow.functions.dates import month_of, stay_days
from wardflow.functions.numbers import square
from wardflow.operators.beds import UNIT
from wardflow.operators.calendar import months_between
from wardflow.settings import Scope

STAY = ["claim_id", "facility_id", "admit_date"]

# A stay's rank is one whole number, (discharge day, specialty's place in the bridge, days) in mixed radix.
DAYS_RADIX = 2**31
PLACES = 2**8
DAY_ZERO = "0001-01-01"


def _pack(discharge: Column, place: Column, days: Column) -> Column:
    """Discharge day first (0 when missing, so lowest), then specialty, then days."""
    since = F.coalesce(F.datediff(discharge, F.lit(DAY_ZERO).cast("date")) + 1, F.lit(0)).cast("long")
    return (since * PLACES + place) * DAYS_RADIX + days


def stay_base(admissions: DataFrame, bridge: DataFrame, scope: Scope) -> DataFrame:
    """One row per (claim, facility, admission day) within the scope: the latest discharge wins.

    There is no lower bound on the admission day, as earlier stays still fill beds. The scope is
    applied before the choice. The winner is found by the maximum of one fixed-width number, so
    Spark hash-aggregates on both sides of the shuffle instead of sorting every claim, and
    repeated rows of a hot stay collapse before the shuffle. Ties: greater specialty, then more days.
    The bridge has one row per mapped specialty, PLACES at most.
    """
    mapped = bridge.filter(F.col("bed_type").isin(*scope.bed_types))
    places = mapped.agg(F.array_sort(F.collect_set(F.struct("specialty", "bed_type")))).scalar()
    rows = (
        admissions.filter((F.col("claim_kind") == scope.claim_kind) & (F.col("admit_date") <= F.lit(scope.claims_until or scope.end)))
        .join(mapped, "specialty")
        .withColumn("days", stay_days("admit_date", "discharge_date", "billed_days", "reported_days"))
    )
    place = F.array_position(places, F.struct("specialty", "bed_type"))
    best = rows.groupBy(*STAY).agg(F.max(_pack(F.col("discharge_date"), place, F.col("days"))).alias("best"))
    since = F.expr(f"best div {DAYS_RADIX * PLACES}").cast("int")
    chosen = F.get(places, (F.expr(f"best div {DAYS_RADIX}") % PLACES - 1).cast("int"))
    return best.select(
        *STAY,
        chosen["specialty"].alias("specialty"),
        chosen["bed_type"].alias("bed_type"),
        F.when(since > 0, F.date_add(F.lit(DAY_ZERO).cast("date"), since - 1)).alias("discharge_date"),
        (F.col("best") % DAYS_RADIX).cast("int").alias("stay_days"),
    )


def counted(month: Column, scope: Scope) -> Column:
    """Whether a month, told by its first day, is one that the report counts."""
    return F.lit(True) if scope.chosen is None else month.isin(list(scope.chosen))


def _occupied_until(scope: Scope) -> Column:
    """First free day, cut off after the scope so that a bogus length cannot overflow."""
    after = F.last_day(F.lit(scope.last_month))
    return F.date_add("admit_date", F.least(F.col("stay_days"), F.datediff(after, F.col("admit_date")) + 1))


def _within_scope(stays: DataFrame, scope: Scope) -> DataFrame:
    """Stays that fill a bed on some day of the scope's months, with their first free day."""
    return stays.withColumn("free_from", _occupied_until(scope)).filter(
        (F.col("admit_date") <= F.last_day(F.lit(scope.last_month)))
        & (F.col("free_from") > F.lit(scope.first_month))
    )


def stay_months(stays: DataFrame, scope: Scope) -> DataFrame:
    """One row per stay and month it touches, with the days it fills there.

    Each stay lists its own months, at most the scope's, so the interval join with the calendar
    needs no join at all.
    """
    first = F.greatest(F.col("admit_date"), F.lit(scope.first_month))
    last = F.date_sub("free_from", 1)
    month_end = F.last_day("month_start")
    return (
        _within_scope(stays, scope)
        .withColumn("month_start", F.explode(months_between(first, last)))
        .filter(counted(F.col("month_start"), scope))
        .withColumn(
            "days_here",
            F.datediff(
                F.least(F.col("free_from"), F.date_add(month_end, 1)),
                F.greatest(F.col("admit_date"), F.col("month_start")),
            ),
        )
    )


def reached_months(stays: DataFrame, scope: Scope) -> DataFrame:
    """``month_start`` of the months in which stays count: those they fill, as in :func:`stay_months`, and that of their end.

    Each month once; one pass over the stays finds both kinds.
    """
    last_day = F.last_day(F.lit(scope.last_month))
    free_from = _occupied_until(scope)
    within = (F.col("admit_date") <= last_day) & (free_from > F.lit(scope.first_month))
    first = F.greatest(F.col("admit_date"), F.lit(scope.first_month))
    filled = F.when(within, months_between(first, F.date_sub(free_from, 1))).otherwise(F.array().cast("array<date>"))
    end = month_of("discharge_date")
    month = F.col("month_start")
    return (
        stays.select(end.alias("end"), F.explode(F.array_union(filled, F.array(end))).alias("month_start"))
        .filter(counted(month, scope) | (month == F.col("end")))
        .select("month_start")
        .dropna()
        .distinct()
    )


def _extrema(prefix: str, when: Column | None = None) -> list[Column]:
    def pick(c):
        return F.col(c) if when is None else F.when(when, F.col(c))

    return [
        F.min(pick("admit_date")).alias(f"{prefix}first_admit"),
        F.max(pick("admit_date")).alias(f"{prefix}last_admit"),
        F.min(pick("discharge_date")).alias(f"{prefix}first_discharge"),
        F.max(pick("discharge_date")).alias(f"{prefix}last_discharge"),
    ]


def monthly_activity(stays: DataFrame, scope: Scope) -> DataFrame:
    """Everything the reports need from stays per facility, bed type and month, in one aggregation.

    A stay always fills a bed in its month of admission, so admissions, lengths of stay of the
    admitted and apportioned days all come from the same exploded rows. Lengths enter as count,
    sum and sum of squares, which roll up exactly to any coarser group.
    """
    admitted = (F.col("month_start") == month_of("admit_date")) & (F.col("admit_date") >= F.lit(scope.start))
    length = F.when(admitted, F.col("stay_days"))
    return (
        stay_months(stays, scope)
        .groupBy(*UNIT)
        .agg(
            F.count_if(admitted).alias("admissions"),
            F.sum("days_here").alias("occupied_days"),
            *_extrema(""),
            F.sum(length).alias("los_days"),
            F.sum(square(length)).alias("los_squares"),
            *_extrema("los_", admitted),
        )
    )


def admissions_monthly(stays: DataFrame, scope: Scope) -> DataFrame:
    """Stays by month of admission."""
    return (
        stays.filter(F.col("admit_date").between(F.lit(scope.start), F.lit(scope.end)))
        .groupBy("facility_id", "bed_type", month_of("admit_date").alias("month_start"))
        .agg(F.count("*").alias("admissions"))
    )


def discharges_monthly(stays: DataFrame, scope: Scope) -> DataFrame:
    """Stays by month of discharge."""
    return (
        stays.filter(F.col("discharge_date").between(F.lit(scope.start), F.lit(scope.end)))
        .groupBy("facility_id", "bed_type", month_of("discharge_date").alias("month_start"))
        .agg(F.count("*").alias("discharges"))
    )


def occupied_days_monthly(stays: DataFrame, scope: Scope) -> DataFrame:
    """Days apportioned to months, with the first and last dates of the stays involved."""
    return stay_months(stays, scope).groupBy(*UNIT).agg(F.sum("days_here").alias("occupied_days"), *_extrema(""))


def daily_census(stays: DataFrame, scope: Scope) -> DataFrame:
    """Patients present per facility, bed type and day of the scope's months.

    Arrivals and departures are summed per day first; the running balance then walks at most one
    row per calendar day and unit, however many stays there are, and fills the days between.
    """
    stop = scope.last_month.replace(day=28) + timedelta(days=4)
    after_scope = stop.replace(day=1)
    moves = (
        _within_scope(stays, scope)
        .select(
            "facility_id",
            "bed_type",
            F.explode(
                F.array(
                    F.struct(
                        F.greatest(F.col("admit_date"), F.lit(scope.first_month)).alias("day"),
                        F.lit(1).alias("step"),
                    ),
                    F.struct(F.col("free_from").alias("day"), F.lit(-1).alias("step")),
                )
            ).alias("move"),
        )
        .groupBy("facility_id", "bed_type", F.col("move.day").alias("day"))
        .agg(F.sum("move.step").alias("step"))
    )
    unit = Window.partitionBy("facility_id", "bed_type").orderBy("day")
    return (
        moves.withColumn("patients", F.sum("step").over(unit.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("next_day", F.coalesce(F.lead("day").over(unit), F.lit(after_scope)))
        .filter((F.col("patients") > 0) & (F.col("next_day") > F.col("day")))
        .select(
            "facility_id",
            "bed_type",
            F.explode(F.sequence("day", F.date_sub("next_day", 1))).alias("census_date"),
            "patients",
        )
    )


def patient_days(census: DataFrame) -> DataFrame:
    """Daily census added up to months."""
    return census.groupBy("facility_id", "bed_type", month_of("census_date").alias("month_start")).agg(
        F.sum("patients").alias("patient_days")
    )

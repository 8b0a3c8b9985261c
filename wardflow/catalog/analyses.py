"""Capacity, stays, occupancy, length of stay and diagnosis."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow import testbed as tb
from wardflow.catalog.heads import CORE, labelled, ratio, rounded
from wardflow.operators import beds as b, calendar as cal, stays as s
from wardflow.plans import capacity, diagnosis, stay_length

SCOPE, SETTINGS = tb.SCOPE, tb.SETTINGS


def _plan(make):
    return lambda spark, sf_dir: make(tb.warehouse(spark, sf_dir), SETTINGS)


def _on_stays(make):
    return lambda spark, sf_dir: make(capacity.stays_of(tb.warehouse(spark, sf_dir), SETTINGS), SCOPE)


def _calendar(spark, sf_dir):
    claims = tb.admissions(spark, sf_dir)
    per_month = claims.groupBy("admit_date").agg(F.count("*").alias("n"))
    per_month = per_month.groupBy(F.trunc("admit_date", "MM").alias("month_start")).agg(F.sum("n").alias("claims"))
    return (
        cal.span_calendar(claims, "admit_date")
        .join(per_month, "month_start", "left")
        .withColumn("claims", F.coalesce("claims", F.lit(0).cast("long")))
    )


QUERIES = {
    "month_calendar": _calendar,
    "latest_name": lambda spark, d: b.latest_name(tb.facilities(spark, d)),
    "bed_capacity_monthly": _plan(capacity.bed_capacity),
    "stay_base": _plan(capacity.stays_of),
    "admissions_monthly": _on_stays(s.admissions_monthly),
    "occupied_days_monthly": _on_stays(s.occupied_days_monthly),
    "daily_census": _on_stays(s.daily_census),
    "patient_days": _on_stays(lambda stays, scope: s.patient_days(s.daily_census(stays, scope))),
    "admissions_per_bed": _plan(capacity.admissions_per_bed),
    "occupancy_bands": _plan(capacity.occupancy_bands),
    "network_stats": _plan(stay_length.network_stats),
    "facility_stats": _plan(stay_length.facility_stats),
    "length_of_stay": _plan(stay_length.length_of_stay),
    "stay_means": _plan(stay_length.stay_means),
    "facility_summary": _plan(diagnosis.facility_summary),
    "facility_diagnosis": _plan(diagnosis.facility_diagnosis),
    "out_of_scope_share": _plan(diagnosis.out_of_scope_share),
    "investment_quadrant": _plan(diagnosis.investment_quadrant),
}

SPAN = "period, month_label, month_start, month_end"
MOVES = "first_admit, last_admit, first_discharge, last_discharge"
UNIT = "facility_id, facility_name, bed_type, category"
LATEST = "CASE period WHEN (SELECT max(period) FROM staffed) THEN 'yes' ELSE 'no' END AS is_latest"
MEAN = rounded(ratio("SUM(los_days)", "SUM(admissions)"), 2)

# Population deviation from a count, a sum and a sum of squares.
SPREAD = "sqrt(greatest({n} * {q} - {d} * {d}, 0)::DOUBLE) / nullif({n}, 0)"
# Totals of a unit over its staffed months; shares of days follow from the sums, thresholds and labels from the definition.
DIAGNOSIS = f"""
, span AS (
  SELECT facility_id, bed_type, COUNT(*) AS months,
         {rounded('SUM(beds_total) / COUNT(*)', 1)} AS beds_total_mean, {rounded('SUM(beds_public) / COUNT(*)', 1)} AS beds_public_mean,
         COUNT(*) FILTER (beds_total < beds_public) AS months_public_above_total,
         {', '.join(f'SUM({c})::BIGINT AS {c}' for c in ('admissions', 'occupied_days', 'bed_days_total', 'bed_days_public'))},
         MIN(first_admit) AS first_admit, MAX(last_admit) AS last_admit,
         MIN(first_discharge) AS first_discharge, MAX(last_discharge) AS last_discharge, {MEAN} AS mean_days,
         SUM(los_days) AS stayed
  FROM staffed GROUP BY facility_id, bed_type),
shares AS (
  SELECT *, {rounded(ratio('occupied_days', 'bed_days_total', '100'), 2)} AS occupancy_total_pct,
         {rounded(ratio('occupied_days', 'bed_days_public', '100'), 2)} AS occupancy_pct,
         {rounded(ratio('bed_days_total - bed_days_public', 'bed_days_total', '100'), 2)} AS gap_pct,
         {rounded(ratio('SUM(stayed) OVER of_type', 'SUM(admissions) OVER of_type'), 2)} AS network_mean_days
  FROM span WINDOW of_type AS (PARTITION BY bed_type)),
summary AS (SELECT * EXCLUDE (mean_days, network_mean_days, stayed) FROM shares),
verdict AS (
  SELECT * EXCLUDE (stayed),
         CASE WHEN months < 12 THEN 'short series' WHEN admissions = 0 THEN 'no production'
              WHEN occupancy_total_pct IS NULL THEN 'registry inconsistency'
              WHEN occupancy_pct IS NULL THEN 'no public beds in period'
              WHEN least(occupancy_total_pct, occupancy_pct) >= 75 THEN 'high on both'
              WHEN occupancy_pct >= 75 THEN 'high on public beds only'
              WHEN occupancy_total_pct < 75 THEN 'low on both' ELSE 'registry inconsistency' END AS pattern,
         CASE WHEN gap_pct > 20 THEN 'gap between total and public beds above 20%' END AS gap_alert
  FROM {labelled('shares')})
"""

ORACLES = {
    "month_calendar": CORE
    + """
, span AS (SELECT min(admit_date) AS a, max(admit_date) AS z FROM admission),
cal AS (SELECT CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', z), INTERVAL 1 MONTH)) AS DATE)
          AS month_start FROM span),
n AS (SELECT date_trunc('month', admit_date)::DATE AS month_start, COUNT(*) AS claims FROM admission GROUP BY ALL)
SELECT month_start, last_day(month_start) AS month_end, strftime(month_start, '%m/%Y') AS month_label,
       strftime(month_start, '%Y%m') AS period, CAST(day(last_day(month_start)) AS INTEGER) AS days_in_month,
       coalesce(claims, 0) AS claims
FROM cal LEFT JOIN n USING (month_start)""",
    "latest_name": CORE + "FROM names",
    "bed_capacity_monthly": CORE
    + f"SELECT {SPAN}, {UNIT}, beds_total, beds_public, {LATEST} FROM {labelled('staffed')}",
    "stay_base": CORE + "FROM stays",
    "admissions_monthly": CORE
    + "SELECT facility_id, bed_type, month_start, admissions FROM unit_month WHERE admissions > 0",
    "occupied_days_monthly": CORE
    + f"SELECT facility_id, bed_type, month_start, occupied_days, {MOVES} FROM unit_month WHERE occupied_days > 0",
    "daily_census": CORE
    + "SELECT facility_id, bed_type, day AS census_date, COUNT(*) AS patients FROM patient_day GROUP BY ALL",
    "patient_days": CORE
    + "SELECT facility_id, bed_type, month_start, occupied_days AS patient_days FROM unit_month WHERE occupied_days > 0",
    "admissions_per_bed": CORE
    + f"""
SELECT {SPAN}, {MOVES}, {UNIT}, beds_public, bed_days_public, admissions, occupied_days,
       {rounded(ratio('admissions', 'beds_public'), 2)} AS admissions_per_bed,
       {rounded(ratio('occupied_days', 'bed_days_public', '100'), 2)} AS occupancy_pct
FROM {labelled('staffed')}""",
    "occupancy_bands": CORE
    + f"""
SELECT {SPAN}, {MOVES}, {UNIT}, beds_total, beds_public, bed_days_total, bed_days_public, admissions, occupied_days,
       {rounded('total_rate', 2)} AS occupancy_total_pct, {rounded('public_rate', 2)} AS occupancy_pct,
       CASE WHEN beds_public = 0 THEN 'no public beds' WHEN occupied_days = 0 THEN 'no production'
            WHEN public_rate < 70 THEN 'severe idleness' WHEN public_rate < 75 THEN 'idleness'
            WHEN public_rate <= 85 THEN 'healthy' ELSE 'overload' END AS band,
       {LATEST}
FROM (SELECT *, {ratio('occupied_days', 'bed_days_total', '100')} AS total_rate,
                {ratio('occupied_days', 'bed_days_public', '100')} AS public_rate FROM {labelled('staffed')})""",
    "network_stats": CORE
    + f"""
SELECT month_start, bed_type, SUM(admissions)::BIGINT AS network_admissions, SUM(los_days)::BIGINT AS network_days,
       {MEAN} AS network_mean, {rounded(SPREAD.format(n='SUM(admissions)', d='SUM(los_days)', q='SUM(los_squares)'), 2)} AS network_sd
FROM staffed WHERE admissions > 0 GROUP BY ALL""",
    "facility_stats": CORE
    + f"""
SELECT facility_id, bed_type, month_start, admissions, los_days, {rounded('los_days / admissions', 2)} AS mean_days,
       los_first_admit AS first_admit, los_last_admit AS last_admit,
       los_first_discharge AS first_discharge, los_last_discharge AS last_discharge
FROM staffed WHERE admissions > 0""",
    "length_of_stay": CORE
    + f"""
, beside AS (
  SELECT *, SUM(admissions) OVER net AS n, coalesce(SUM(los_days) OVER net, 0) AS d, SUM(los_squares) OVER net AS q
  FROM staffed WINDOW net AS (PARTITION BY month_start, bed_type)),
measured AS (
  SELECT *, los_days / nullif(admissions, 0) AS own, d / nullif(n, 0) AS mean, {SPREAD.format(n='n', d='d', q='q')} AS sd FROM beside),
scored AS (SELECT *, (own - mean) / nullif(sd / sqrt(admissions), 0) AS score FROM measured)
SELECT {SPAN}, {UNIT}, beds_public, los_first_admit AS first_admit, los_last_admit AS last_admit,
       los_first_discharge AS first_discharge, los_last_discharge AS last_discharge, admissions,
       coalesce(los_days, 0) AS stay_days, {rounded('own', 2)} AS mean_days, n::BIGINT AS network_admissions, d::BIGINT AS network_days,
       {rounded('mean', 2)} AS network_mean, {rounded('sd', 2)} AS network_sd, {rounded('score', 2)} AS z,
       CASE WHEN admissions = 0 THEN 'no stays' WHEN score > 1.5 THEN 'above' WHEN score < -1.5 THEN 'below' ELSE 'within' END AS status
FROM {labelled('scored')}""",
    "stay_means": CORE
    + DIAGNOSIS
    + "SELECT facility_id, bed_type, mean_days, network_mean_days FROM shares WHERE mean_days IS NOT NULL",
    "facility_summary": CORE + DIAGNOSIS + "FROM summary",
    "facility_diagnosis": CORE
    + DIAGNOSIS
    + f"""
SELECT *, DATE '1998-01-01' AS scope_start, DATE '1999-12-31' AS scope_end,
       {rounded('beds_total_mean - beds_public_mean', 1)} AS beds_not_public_mean FROM verdict""",
    "investment_quadrant": CORE
    + DIAGNOSIS
    + """
SELECT facility_id, facility_name, bed_type, gap_pct, occupancy_total_pct, occupancy_pct, pattern,
       CASE WHEN gap_alert IS NOT NULL THEN 'priority investment: maintenance and running costs'
            WHEN pattern = 'high on both' THEN 'expand physical capacity'
            WHEN pattern = 'high on public beds only' THEN 'maintenance, equipment and staff for blocked beds'
            WHEN pattern = 'low on both' THEN 'readjust the care profile, do not expand' END AS action
FROM verdict""",
    "out_of_scope_share": CORE
    + f"""
, marks AS (
  SELECT facility_id, strftime(admit_date, '%Y%m') AS period, claim_id, admit_date,
         bool_or(coalesce(bed_type <> '3', FALSE)) AS inside, bool_or(bed_type IS NULL) AS outside
  FROM admission LEFT JOIN bridge USING (specialty)
  WHERE claim_kind = '1' AND year(admit_date) IN (1998, 1999) GROUP BY ALL)
SELECT facility_id, any_value(facility_name) AS facility_name, COUNT(*) FILTER (inside) AS stays_inside,
       COUNT(*) FILTER (outside) AS stays_outside, {rounded(ratio('COUNT(*) FILTER (outside)', 'COUNT(*)', '100'), 1)} AS outside_pct
FROM marks SEMI JOIN staffed USING (facility_id, period) LEFT JOIN names USING (facility_id) GROUP BY facility_id""",
}

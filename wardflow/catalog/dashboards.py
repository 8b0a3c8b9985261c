"""Dashboard measures."""

from __future__ import annotations

from wardflow import testbed as tb
from wardflow.catalog.heads import CORE, ratio, rounded
from wardflow.plans import dashboard
from wardflow.sources import domains

SETTINGS = tb.SETTINGS
PERIODS = ["199803", "199804", "199805", "199806"]


def _plan(make, **options):
    return lambda spark, sf_dir: make(tb.warehouse(spark, sf_dir), SETTINGS, **options)


FILTERS = {
    "filtered_kpis": {"periods": PERIODS, "facilities": [f"{n:07d}" for n in range(0, 60)], "bed_types": ["2"], "specialties": ["03"]},
    "filtered_kpis_type": {"bed_types": ["1"]},
    "filtered_kpis_specialty": {"specialties": ["02"]},
    "filtered_kpis_period": {"periods": PERIODS},
    "filtered_kpis_nothing": {"facilities": []},
}
# The specialty that a bed code is registered for, in the fixture.
BED_SPECIALTIES = [("11", "01"), ("12", "02"), ("21", "03"), ("22", "04")]


def _specialty_deviation(spark, sf_dir):
    mapping = domains.literal_table(spark, BED_SPECIALTIES, ("bed_code", "specialty"))
    return dashboard.specialty_deviation(tb.warehouse(spark, sf_dir), SETTINGS, mapping)


def _filtered_matrix(spark, sf_dir):
    return dashboard.hospital_matrix(*dashboard.narrowed(tb.warehouse(spark, sf_dir), SETTINGS, specialties=["01", "03"], periods=PERIODS))


QUERIES = {
    "network_kpis": _plan(dashboard.network_kpis),
    **{name: _plan(dashboard.filtered_kpis, **chosen) for name, chosen in FILTERS.items()},
    "occupancy_trend": _plan(dashboard.occupancy_trend),
    "hospital_matrix": _plan(dashboard.hospital_matrix),
    "hospital_matrix_filtered": _filtered_matrix,
    "stay_by_specialty": _plan(dashboard.stay_by_specialty),
    "occupancy_by_type_specialty": _plan(dashboard.occupancy_by_type_specialty),
    "specialty_deviation": _specialty_deviation,
}

RATES = (
    f"{rounded(ratio('SUM(occupied_days)', 'SUM(bed_days_total)', '100'), 2)} AS occupancy_total_pct, "
    f"{rounded(ratio('SUM(occupied_days)', 'SUM(bed_days_public)', '100'), 2)} AS occupancy_public_pct"
)
KPIS = f"""SUM(discharges)::BIGINT AS discharges, {RATES},
       {rounded(ratio('SUM(los_days)', 'SUM(admissions)'), 2)} AS mean_days"""


def _inside(periods=None, facilities=None, bed_types=None, specialties=None) -> tuple[str, str]:
    """SQL head with finished stays of the chosen specialties alone, and the condition on staffed months."""
    listed = lambda values: "(" + ", ".join(f"'{v}'" for v in values) + ")"
    chosen = [f"{c} IN {listed(v)}" if v else "FALSE" for c, v in (("period", periods), ("facility_id", facilities), ("bed_type", bed_types)) if v is not None]
    head = CORE
    if specialties is not None:
        head = head.replace("FROM stays)\n  WHERE year(day)", f"FROM stays WHERE specialty IN {listed(specialties)})\n  WHERE year(day)")
        head = head.replace("FROM stays WHERE admit_date >=", f"FROM stays WHERE specialty IN {listed(specialties)} AND admit_date >=")
        head = head.replace("FROM stays WHERE year(discharge_date)", f"FROM stays WHERE specialty IN {listed(specialties)} AND year(discharge_date)")
        chosen.append(f"bed_type IN (SELECT bed_type FROM bridge WHERE specialty IN {listed(specialties)})")
    return head, " AND ".join(chosen) or "TRUE"


def _kpis(**chosen) -> str:
    head, where = _inside(**chosen)
    return head + f"SELECT coalesce(SUM(discharges), 0)::BIGINT AS discharges, {KPIS.split(',', 1)[1]} FROM staffed WHERE {where}"


def _matrix(**chosen) -> str:
    head, where = _inside(**chosen)
    return (
        head
        + f"""
, chosen AS (FROM staffed WHERE {where}),
registered AS (
  SELECT facility_id, {rounded(ratio('SUM(beds_total)', 'COUNT(DISTINCT month_start)'), 1)} AS beds_total_mean, {KPIS}
  FROM chosen GROUP BY facility_id)
SELECT facility_id, coalesce(facility_name, 'facility: ' || facility_id) AS facility_name, beds_total_mean, discharges,
       occupancy_total_pct, mean_days,
       CASE WHEN occupancy_total_pct < 70 THEN 'idleness' WHEN occupancy_total_pct <= 85 THEN 'healthy'
            WHEN occupancy_total_pct > 85 THEN 'overload' END AS light
FROM registered LEFT JOIN names USING (facility_id)"""
    )


ORACLES = {
    "network_kpis": _kpis(),
    **{name: _kpis(**chosen) for name, chosen in FILTERS.items()},
    "occupancy_trend": CORE + f"SELECT month_start, period, {RATES} FROM staffed GROUP BY month_start, period",
    "hospital_matrix": _matrix(),
    "hospital_matrix_filtered": _matrix(specialties=["01", "03"], periods=PERIODS),
    "stay_by_specialty": CORE
    + f"""
, one AS (
  SELECT arg_max({{'s': specialty, 'n': length}}, rank) AS stay FROM (
    SELECT claim_id, facility_id, admit_date, specialty,
           greatest(1, coalesce(discharge_date - admit_date, billed_days, reported_days, 1)) AS length,
           {{'d': coalesce(discharge_date, DATE '0001-01-01'), 's': coalesce(specialty, ''), 'n': length}} AS rank
    FROM admission WHERE claim_kind = '1' AND year(admit_date) IN (1998, 1999))
  GROUP BY claim_id, facility_id, admit_date)
SELECT stay.s AS specialty, description, COUNT(*) AS stays, {rounded(ratio('SUM(stay.n)', 'COUNT(*)'), 2)} AS mean_days
FROM one LEFT JOIN specialties s ON s.specialty = stay.s GROUP BY stay.s, description""",
    "occupancy_by_type_specialty": CORE
    + f"""
, filled AS (
  SELECT bed_type, specialty, COUNT(*) AS occupied_days
  FROM (SELECT *, strftime(day, '%Y%m') AS period FROM patient_day) SEMI JOIN staffed USING (facility_id, bed_type, period)
  GROUP BY ALL),
offered AS (SELECT bed_type, SUM(bed_days_total) AS total, SUM(bed_days_public) AS public FROM staffed GROUP BY ALL)
SELECT bed_type, specialty, description, occupied_days,
       {rounded(ratio('occupied_days', 'total', '100'), 2)} AS occupancy_total_pct,
       {rounded(ratio('occupied_days', 'public', '100'), 2)} AS occupancy_public_pct
FROM filled JOIN offered USING (bed_type) LEFT JOIN specialties USING (specialty)""",
    "specialty_deviation": CORE
    + f"""
, both_sides AS (
  SELECT facility_id, CASE bed_code WHEN '11' THEN '01' WHEN '12' THEN '02' WHEN '21' THEN '03' WHEN '22' THEN '04' END AS specialty,
         beds_total * day(last_day(strptime(period || '01', '%Y%m%d'))) AS registered, NULL AS attended
  FROM bed WHERE own_flag = 1 AND bed_type <> '3'
  UNION ALL SELECT facility_id, specialty, NULL, 1 FROM patient_day),
sums AS (
  SELECT facility_id, specialty, SUM(registered)::BIGINT AS registered, SUM(attended)::BIGINT AS attended
  FROM both_sides GROUP BY ALL),
shares AS (
  SELECT *, {rounded(ratio('coalesce(registered, 0)', 'SUM(registered) OVER (PARTITION BY facility_id)', '100'), 2)}
           AS registered_pct,
         {rounded(ratio('coalesce(attended, 0)', 'SUM(attended) OVER (PARTITION BY facility_id)', '100'), 2)}
           AS attended_pct
  FROM sums)
SELECT *, {rounded('attended_pct - registered_pct', 2)} AS deviation_pct FROM shares""",
}

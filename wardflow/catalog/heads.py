"""Common heads of the oracle queries: the adapter, and the building blocks of the analyses."""

from __future__ import annotations

from wardflow.sources.domains import BED_TYPES, SPECIALTIES, literal_rows
from wardflow.testbed import BRIDGE

ADAPTER = """
WITH months AS (
  SELECT CAST(m AS DATE) AS m_start, last_day(CAST(m AS DATE)) AS m_end, strftime(m,'%Y%m') AS ym,
         CAST(date_diff('day', CAST(m AS DATE), last_day(CAST(m AS DATE))) + 1 AS INTEGER) AS m_days,
         CAST(date_diff('month', DATE '1998-01-01', CAST(m AS DATE)) AS INTEGER) AS m_idx
  FROM (SELECT unnest(generate_series(DATE '1998-01-01', DATE '1999-12-31', INTERVAL 1 MONTH)) AS m)),
admission_src AS (
  SELECT lpad(CAST(l_suppkey AS VARCHAR),7,'0') AS facility_id, CAST(l_orderkey AS VARCHAR) AS claim_id,
         CASE WHEN l_linenumber=7 THEN NULL ELSE lpad(CAST(l_linenumber AS VARCHAR),2,'0') END AS specialty,
         CASE WHEN l_returnflag='R' THEN '5' ELSE '1' END AS claim_kind,
         CAST(l_shipdate AS DATE) AS admit_date,
         CASE WHEN l_tax >= 0.075 THEN NULL ELSE CAST(l_shipdate AS DATE) + (CAST(l_quantity AS INTEGER) - 3) END AS discharge_date,
         CASE WHEN l_discount >= 0.085 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS billed_days,
         CASE WHEN l_discount >= 0.095 THEN NULL ELSE CAST(l_quantity AS INTEGER) + 1 END AS reported_days,
         lpad(CAST(l_linenumber AS VARCHAR),3,'0') AS seq, l_partkey,
         lpad(CAST(c_nationkey AS VARCHAR),6,'0') AS residence, CAST(l_partkey % 100 AS INTEGER) AS age,
         CASE l_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '1' WHEN 3 THEN '1' ELSE '3' END AS sex,
         CASE WHEN l_partkey % 17 = 0 THEN '1' ELSE '0' END AS died
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey),
admission AS (
  SELECT *, strftime(admit_date,'%Y%m') AS period, 0 AS rebill FROM admission_src
  UNION ALL
  SELECT facility_id, claim_id, specialty, claim_kind, admit_date,
         CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE discharge_date + 2 END,
         billed_days, reported_days, seq, l_partkey, residence, age, sex, died, strftime(admit_date + 31,'%Y%m'), 1
  FROM admission_src WHERE l_partkey % 20 = 0),
bed AS (
  SELECT lpad(CAST(CASE WHEN s_suppkey % 19 = 5 THEN s_suppkey + 8000000 ELSE s_suppkey END AS VARCHAR),7,'0') AS facility_id,
         CAST(t AS VARCHAR) AS bed_type, lpad(CAST(t*10+c AS VARCHAR),2,'0') AS bed_code, ym AS period,
         CAST(CASE WHEN s_suppkey % 23 = 0 THEN 0 WHEN s_suppkey % 10 = 6 THEN 2 - c ELSE (s_suppkey*7+t*3+c) % 9 END AS INTEGER) AS beds_total,
         CAST(CASE WHEN s_suppkey % 13 = 0 THEN 0 WHEN s_suppkey % 10 = 6 THEN 2 - c WHEN s_suppkey % 7 = 0 THEN (s_suppkey*7+t*3+c) % 9 + 1
                   ELSE greatest((s_suppkey*7+t*3+c) % 9 - s_suppkey % 4, 0) END AS INTEGER) AS beds_public,
         CASE WHEN s_suppkey % 2 = 0 THEN 1 WHEN s_suppkey % 5 = 0 THEN NULL ELSE 0 END AS own_flag
  FROM supplier, months, (SELECT unnest([1,2,3]) AS t), (SELECT unnest([1,2]) AS c)
  WHERE (s_suppkey % 11 <> 0 OR m_idx < 9) AND (s_suppkey + m_idx) % 17 <> 0),
facility AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR),7,'0') AS facility_id, ym AS period,
         CASE WHEN (s_suppkey + m_idx) % 5 = 0 THEN NULL ELSE s_name || ' / ' || ym END AS facility_name,
         CASE s_suppkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'E' WHEN 2 THEN 'D' ELSE 'S' END AS owner_sphere,
         lpad(CAST(s_nationkey AS VARCHAR),6,'0') AS region_code,
         CAST((s_suppkey * 5 + m_idx) % 40 AS INTEGER) AS beds_total, CAST((s_suppkey * 5 + m_idx) % 33 AS INTEGER) AS beds_public
  FROM supplier, months WHERE s_suppkey % 9 <> 4 AND m_idx % 3 <> 1),
raw_bed AS (
  SELECT CASE WHEN s_suppkey % 3 = 0 THEN ' ' || CAST(s_suppkey AS VARCHAR) || '.0 ' WHEN s_suppkey % 31 = 1 THEN '   ' ELSE CAST(s_suppkey AS VARCHAR) END AS cnes,
         bed_code, bed_type, substr(period,1,4) || CASE WHEN s_suppkey % 2 = 0 THEN '-' ELSE '' END || substr(period,5,2) AS period,
         CASE WHEN s_suppkey % 29 = 2 THEN 'n/d' WHEN k = 1 AND s_suppkey % 12 = 1 THEN CAST(beds_total + 1 AS VARCHAR) ELSE CAST(beds_total AS VARCHAR) END AS beds_total, CAST(beds_public AS VARCHAR) AS beds_public,
         CASE WHEN s_suppkey % 5 = 0 THEN '00000000000000' ELSE lpad(CAST(s_suppkey % 2 AS VARCHAR),14,'1') END AS payer_id, k AS copy_no
  FROM bed JOIN supplier ON CAST(bed.facility_id AS BIGINT) % 8000000 = s_suppkey, (SELECT unnest([0,1]) AS k)
  WHERE k = 0 OR s_suppkey % 6 = 1)
"""


def _values(rows) -> str:
    return f"SELECT * FROM ({literal_rows(rows, ('k', 'v')).replace(' AS t(k, v)', '')}) AS t(k, v)"


CORE = (
    ADAPTER.rstrip()
    + f"""
, bed_types AS (SELECT k AS bed_type, v AS category FROM ({_values(BED_TYPES)})),
bridge AS (SELECT k AS specialty, v AS bed_type FROM ({_values(BRIDGE)})),
specialties AS (SELECT k AS specialty, v AS description FROM ({_values(SPECIALTIES)})),
"""
    + """
names AS (SELECT facility_id, arg_max(facility_name, period) FILTER (facility_name IS NOT NULL) AS facility_name
          FROM facility GROUP BY facility_id HAVING COUNT(facility_name) > 0),
-- A stay is the greatest of its claim rows by discharge day, specialty and length.
stays AS (
  SELECT claim_id, facility_id, admit_date, top.specialty AS specialty, top.length AS stay_days, top.bed_type AS bed_type,
         nullif(top.until, DATE '0001-01-01') AS discharge_date
  FROM (SELECT claim_id, facility_id, admit_date,
               max({'until': coalesce(discharge_date, DATE '0001-01-01'), 'specialty': specialty,
                    'length': CAST(greatest(1, coalesce(discharge_date - admit_date, billed_days, reported_days, 1)) AS INTEGER),
                    'bed_type': bed_type}) AS top
        FROM bridge NATURAL JOIN admission
        WHERE admit_date < DATE '2000-01-01' AND bed_type <> '3' AND claim_kind = '1' GROUP BY ALL)),
-- The daily grain: a row for each day on which a stay fills a bed.
patient_day AS (
  SELECT * FROM (SELECT *, CAST(unnest(generate_series(admit_date, admit_date + stay_days - 1, INTERVAL 1 DAY)) AS DATE) AS day FROM stays)
  WHERE year(day) IN (1998, 1999)),
-- What happens in a facility's beds of a type in a month: registered beds, admissions, discharges and filled days.
happening AS (
  SELECT facility_id, bed_type, period, 1 AS registered, beds_total, beds_public, NULL AS entered, NULL AS length, 0 AS leaving, 0 AS filled,
         NULL AS came, NULL AS went
  FROM bed WHERE own_flag = 1 AND bed_type <> '3'
  UNION ALL
  SELECT facility_id, bed_type, strftime(admit_date, '%Y%m'), 0, 0, 0, admit_date, stay_days, 0, 0, NULL, discharge_date
  FROM stays WHERE admit_date >= DATE '1998-01-01'
  UNION ALL
  SELECT facility_id, bed_type, strftime(discharge_date, '%Y%m'), 0, 0, 0, NULL, NULL, 1, 0, NULL, NULL
  FROM stays WHERE year(discharge_date) IN (1998, 1999)
  UNION ALL
  SELECT facility_id, bed_type, strftime(day, '%Y%m'), 0, 0, 0, NULL, NULL, 0, 1, admit_date, discharge_date FROM patient_day),
unit_month AS (
  SELECT facility_id, bed_type, period, strptime(period || '01', '%Y%m%d')::DATE AS month_start, SUM(registered) AS bed_rows,
         SUM(beds_total)::BIGINT AS beds_total, SUM(beds_public)::BIGINT AS beds_public,
         COUNT(entered) AS admissions, SUM(leaving)::BIGINT AS discharges, SUM(filled)::BIGINT AS occupied_days,
         SUM(length)::BIGINT AS los_days, SUM(length * length)::BIGINT AS los_squares,
         MIN(came) AS first_admit, MAX(came) AS last_admit,
         MIN(went) FILTER (filled = 1) AS first_discharge, MAX(went) FILTER (filled = 1) AS last_discharge,
         MIN(entered) AS los_first_admit, MAX(entered) AS los_last_admit,
         MIN(went) FILTER (entered IS NOT NULL) AS los_first_discharge, MAX(went) FILTER (entered IS NOT NULL) AS los_last_discharge
  FROM happening GROUP BY ALL),
-- The months of a unit that has registered beds then.
staffed AS (
  SELECT * EXCLUDE (bed_rows), day(last_day(month_start)) * beds_total AS bed_days_total,
         day(last_day(month_start)) * beds_public AS bed_days_public, last_day(month_start) AS month_end,
         strftime(month_start, '%m/%Y') AS month_label
  FROM unit_month WHERE bed_rows > 0)
"""
)


def rounded(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(30, 10)), {digits}) AS DOUBLE)"


def ratio(num: str, den: str, scale: str = "1.0") -> str:
    return f"({scale}::DOUBLE * ({num})::DOUBLE / nullif(({den})::DOUBLE, 0))"


def labelled(table: str) -> str:
    """The table with facility name and bed type category attached, names falling back."""
    return (
        f"(SELECT t.*, coalesce(n.facility_name, 'facility: ' || t.facility_id) AS facility_name, "
        f"coalesce(b.category, 'unspecified') AS category FROM {table} t "
        f"LEFT JOIN names n ON n.facility_id = t.facility_id LEFT JOIN bed_types b ON b.bed_type = t.bed_type)"
    )

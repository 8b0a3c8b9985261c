"""Profiles, distributions, rankings and registry comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow import testbed as tb
from wardflow.catalog.heads import CORE, ratio, rounded
from wardflow.operators import checks, profile as p
from wardflow.operators.dedup import duplicate_profile
from wardflow.plans import reconciliation as r

SETTINGS = tb.SETTINGS
DAYS = "reported_days"


def _claims(make):
    return lambda spark, d: make(tb.admissions(spark, d))


def _beds(make):
    return lambda spark, d: make(tb.beds(spark, d))


def _registry(make):
    return lambda spark, d: make(tb.facilities(spark, d))


def _compared(spark, d):
    return r.source_reconciliation(tb.facilities(spark, d), tb.beds(spark, d))


def _beds_admissions(spark, d):
    return r.beds_admissions(tb.beds(spark, d), tb.admissions(spark, d), SETTINGS)


def _spread(df):
    return p.grouped_distribution(df, "facility_id", DAYS, "claim_id", [0.5, 0.75, 0.9], few_values=True)


def _facility_profile(df):
    return p.grouped_distribution(df, "facility_id", DAYS, "claim_id", [0.5], few_values=True).withColumnsRenamed(
        {"distinct_count": "admissions", "sum_v": "reported_days", "mean": "mean_days", "p50": "median_days"}
    )


TOP_STAY = ["facility_id", "claim_id", "admit_date", "discharge_date", DAYS, "age", "sex"]


def _top_stays(df):
    ties = [F.col(c).asc_nulls_last() for c in TOP_STAY if c != DAYS]
    return p.top(df.select(*TOP_STAY), 20, F.col(DAYS).desc_nulls_last(), *ties)


def _shares(spark, d):
    claims = tb.admissions(spark, d)
    return p.union_all(
        [
            p.category_share(claims, "sex", "died"),
            p.category_share(tb.table(spark, d, "events"), "event_type"),
        ]
    )


def _period_counts(spark, d):
    return p.group_counts(tb.admissions(spark, d), "period")


def _ranges(spark, d):
    return p.union_all(
        [
            p.value_range(tb.facilities(spark, d), "facility", ["period"]),
            p.value_range(tb.beds(spark, d), "bed", ["period"]),
            p.value_range(tb.admissions(spark, d), "admission", ["period", "admit_date", "discharge_date"]),
        ]
    )


# Every column of the claims, and the types they have.
CLAIM_COLUMNS = {
    "facility_id": "string", "claim_id": "string", "specialty": "string", "claim_kind": "string", "admit_date": "date",
    "discharge_date": "date", "billed_days": "int", "reported_days": "int", "seq": "string", "l_partkey": "bigint", "age": "int",
    "sex": "string", "died": "string", "period": "string", "rebill": "int",
}


def _nulls(spark, d):
    return p.union_all(
        [
            p.null_profile(tb.admissions(spark, d).select(*CLAIM_COLUMNS), "admission"),
            p.null_profile(tb.facilities(spark, d), "facility"),
            p.null_profile(tb.table(spark, d, "labels"), "labels"),
        ]
    )


def _duplicates(spark, d):
    return p.union_all(
        [
            duplicate_profile(tb.raw_beds(spark, d).drop("copy_no")).withColumn("table_name", F.lit("raw_bed")),
            duplicate_profile(tb.admissions(spark, d).select(*CLAIM_COLUMNS)).withColumn(
                "table_name", F.lit("admission")
            ),
            duplicate_profile(tb.table(spark, d, "documents").select("text", "lang", "source")).withColumn(
                "table_name", F.lit("documents")
            ),
        ]
    )


def _shapes(spark, d):
    return p.union_all(
        [
            p.table_shape(tb.facilities(spark, d), "facility"),
            p.table_shape(tb.beds(spark, d), "bed"),
            p.table_shape(tb.admissions(spark, d, residence=True), "admission"),
        ]
    )


def _describe_claims(df):
    computed = df.withColumn("computed_days", p.computed_days("admit_date", "discharge_date"))
    return p.describe(computed, ["age", "billed_days", DAYS, "computed_days"], few_values=True)


QUERIES = {
    "numeric_describe": _claims(_describe_claims),
    "amount_describe": lambda spark, d: p.describe(tb.table(spark, d, "orders"), ["o_totalprice"]),
    "key_describe": lambda spark, d: p.describe(tb.table(spark, d, "orders"), ["o_orderkey"]),
    "central_tendency": _claims(lambda df: p.central_tendency(df, DAYS)),
    "stay_boxplot": _claims(lambda df: p.box_plot(df, DAYS)),
    "stay_boxplot_p99": _claims(lambda df: p.box_plot(df, DAYS, cut=0.99)),
    "age_histogram": _claims(lambda df: p.histogram(df, "age", 20)),
    "clipped_stay_histogram": _claims(lambda df: p.histogram(df, DAYS, 30, upper=30)),
    "top_stays": _claims(_top_stays),
    "facility_profile": _claims(_facility_profile),
    "top_facilities": _claims(
        lambda df: p.top(_facility_profile(df), 20, F.desc("admissions"), F.asc("facility_id"))
    ),
    "facility_stay_percentiles": _claims(_spread),
    "facility_stay_percentiles_min30": _claims(
        lambda df: _spread(df).filter(F.col("distinct_count") >= SETTINGS.thresholds.min_claims)
    ),
    "residence_share": lambda spark, d: p.distinct_share(
        tb.admissions(spark, d, residence=True), "residence", "claim_id"
    ),
    "category_share": _shares,
    "period_counts": _period_counts,
    "claim_repeat_histogram": _claims(lambda df: p.repeat_histogram(df, "claim_id")),
    "top_claims": _claims(lambda df: p.most_frequent(df, "claim_id", 20)),
    "monthly_unique_claims": _claims(lambda df: p.distinct_by_month(df, "admit_date", "claim_id")),
    "distinct_codes": _beds(lambda df: p.distinct_total(df, "bed_code")),
    "period_range": _ranges,
    "null_profile": _nulls,
    "duplicate_profile": _duplicates,
    "dataset_shape": _shapes,
    "date_inconsistencies": _claims(
        lambda df: checks.date_inconsistencies(df, "admit_date", "discharge_date", DAYS)
    ),
    "stay_consistency": _claims(lambda df: p.stay_consistency(df, "admit_date", "discharge_date", DAYS)),
    "stay_difference_histogram": _claims(
        lambda df: p.stay_difference_histogram(df, "admit_date", "discharge_date", DAYS)
    ),
    "beds_by_facility": _registry(lambda df: p.bed_sums(df, ["facility_id", "facility_name"])),
    "beds_by_period": _registry(lambda df: p.bed_sums(df, ["period"], "facility_id")),
    "beds_by_type": _beds(lambda df: p.bed_sums(df, ["bed_type"], "facility_id")),
    "beds_by_type_period": _beds(lambda df: p.bed_sums(df, ["period", "bed_type"])),
    "bed_totals": _registry(p.bed_totals),
    "top_types_trend": _beds(lambda df: p.top_types_trend(df.withColumn("bed_type", F.concat("bed_type", F.lit("/"), F.substring("facility_id", 7, 1))), 10)),
    "source_reconciliation": _compared,
    "difference_describe": lambda spark, d: p.describe(_compared(spark, d), ["difference"]),
    "top_abs_difference": lambda spark, d: r.top_differences(_compared(spark, d)),
    "beds_admissions": _beds_admissions,
    "top_beds_per_admission": lambda spark, d: r.top_beds_per_admission(_beds_admissions(spark, d)),
    "facility_indicators": lambda spark, d: r.facility_indicators(
        tb.beds(spark, d), tb.admissions(spark, d), SETTINGS
    ),
}


def _quantile(column: str, prob: float) -> str:
    return rounded(f"quantile_cont({column}, {prob})", 4)


def _describe(table: str, columns: list[str], kind: str = "BIGINT") -> str:
    parts = []
    for c in columns:
        quantiles = ", ".join(f"{_quantile(c, q)} AS p{round(q * 100):02d}" for q in p.PERCENTS)
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS value_count, {rounded(f'AVG({c})', 4)} AS mean, "
            f"{rounded(f'stddev_samp({c})', 4)} AS std, CAST(min({c}) AS {kind}) AS min, {quantiles}, "
            f"CAST(max({c}) AS {kind}) AS max FROM {table}"
        )
    return " UNION ALL ".join(parts)


def _box(where: str = "TRUE") -> str:
    return f"""
, v AS (SELECT reported_days AS x FROM admission WHERE reported_days IS NOT NULL AND {where}),
q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2, quantile_cont(x, 0.75) AS q3 FROM v),
m AS (SELECT x, q1, q2, q3, x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM v, q)
SELECT COUNT(*) AS value_count, {rounded('min(q1)', 4)} AS q1, {rounded('min(q2)', 4)} AS median,
       {rounded('min(q3)', 4)} AS q3, CAST(min(x) FILTER (WHERE inside) AS BIGINT) AS whisker_low,
       CAST(max(x) FILTER (WHERE inside) AS BIGINT) AS whisker_high, COUNT(*) FILTER (WHERE NOT inside) AS outliers
FROM m"""


def _histogram(values: str, bins: int) -> str:
    return f"""
, v AS (SELECT x FROM ({values}) WHERE x IS NOT NULL),
e AS (SELECT min(x) AS lo, (max(x) - min(x))::DOUBLE / {bins} AS w FROM v),
b AS (SELECT CAST(least(floor((x - lo) / w), {bins - 1}) AS INTEGER) AS bin, lo, w FROM v, e)
SELECT bin, {rounded('any_value(lo) + bin * any_value(w)', 4)} AS bin_from,
       {rounded('any_value(lo) + (bin + 1) * any_value(w)', 4)} AS bin_to, COUNT(*) AS row_count
FROM b GROUP BY bin"""


def _share(table: str, column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, {column} AS category, COUNT(*) AS row_count, "
        f"{rounded(ratio('COUNT(*)', f'(SELECT COUNT(*) FROM {table})', '100'), 4)} AS pct FROM {table} GROUP BY {column}"
    )


def _null_rows(table: str, columns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{t}' AS data_type, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"{rounded(ratio(f'COUNT(*) FILTER (WHERE {c} IS NULL)', 'COUNT(*)', '100'), 4)} AS null_pct, "
        f"COUNT(*) AS row_count FROM {table}"
        for c, t in columns
    )


def _range_rows(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM {table}"
        for c in columns
    )


def _duplicate_rows(name: str, columns: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, "
        f"(SELECT COUNT(*) FROM (SELECT DISTINCT {columns} FROM {source})) AS distinct_rows, "
        f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {columns} FROM {source})) AS duplicate_rows FROM {source}"
    )


PROFILE_SQL = f"""
SELECT facility_id, COUNT(DISTINCT claim_id) AS admissions, COUNT(*) AS row_count,
       CAST(coalesce(SUM(reported_days), 0) AS BIGINT) AS reported_days, {rounded('AVG(reported_days)', 4)} AS mean_days,
       {_quantile('reported_days', 0.5)} AS median_days
FROM admission GROUP BY facility_id"""
SPREAD_SQL = f"""
SELECT facility_id, COUNT(DISTINCT claim_id) AS distinct_count, COUNT(*) AS row_count,
       CAST(coalesce(SUM(reported_days), 0) AS BIGINT) AS sum_v, {rounded('AVG(reported_days)', 4)} AS mean,
       {_quantile('reported_days', 0.5)} AS p50, {_quantile('reported_days', 0.75)} AS p75,
       {_quantile('reported_days', 0.9)} AS p90
FROM admission GROUP BY facility_id"""
BED_SUMS = "CAST(SUM(beds_total) AS BIGINT) AS beds_total, CAST(SUM(beds_public) AS BIGINT) AS beds_public"
COMPARED = """
, reg AS (SELECT period, facility_id, SUM(beds_public) AS n FROM facility GROUP BY ALL),
lt AS (SELECT period, facility_id, SUM(beds_public) AS n FROM bed GROUP BY ALL),
compared AS (
  SELECT period, facility_id, CAST(coalesce(reg.n, 0) AS BIGINT) AS registry_beds,
         CAST(coalesce(lt.n, 0) AS BIGINT) AS bed_file_beds,
         CAST(coalesce(reg.n, 0) - coalesce(lt.n, 0) AS BIGINT) AS difference
  FROM reg FULL JOIN lt USING (period, facility_id))
"""
JOINED = """
, lt AS (SELECT period, facility_id, CAST(SUM(beds_public) AS BIGINT) AS beds_public FROM bed GROUP BY ALL),
rd AS (SELECT strftime(admit_date, '%Y%m') AS period, facility_id, COUNT(DISTINCT claim_id) AS n,
              CAST(coalesce(SUM(reported_days), 0) AS BIGINT) AS d FROM admission GROUP BY ALL),
joined AS (SELECT period, facility_id, beds_public, coalesce(n, 0) AS admissions, coalesce(d, 0) AS reported_days
           FROM lt LEFT JOIN rd USING (period, facility_id))
"""
UTILISATION = f"""
SELECT period, facility_id, beds_public, admissions, reported_days, beds_public * 30 AS bed_days_approx,
       {rounded(ratio('reported_days', 'beds_public * 30', '100'), 2)} AS occupancy_approx_pct,
       {rounded(ratio('admissions', 'beds_public'), 4)} AS admissions_per_bed
FROM joined"""

ORACLES = {
    "numeric_describe": CORE
    + ", described AS (SELECT *, CAST(discharge_date - admit_date AS INTEGER) AS computed_days FROM admission) "
    + _describe("described", ["age", "billed_days", "reported_days", "computed_days"]),
    "amount_describe": _describe("orders", ["o_totalprice"], "DOUBLE"),
    "key_describe": _describe("orders", ["o_orderkey"]),
    "central_tendency": CORE
    + f"""
SELECT {rounded('AVG(reported_days)', 4)} AS mean, {_quantile('reported_days', 0.5)} AS median,
       (SELECT CAST(reported_days AS BIGINT) FROM admission WHERE reported_days IS NOT NULL GROUP BY reported_days
        ORDER BY COUNT(*) DESC, reported_days LIMIT 1) AS mode,
       {rounded('stddev_samp(reported_days)', 4)} AS std,
       {rounded('100 * stddev_samp(reported_days) / nullif(AVG(reported_days), 0)', 4)} AS variation_pct
FROM admission""",
    "stay_boxplot": CORE + _box(),
    "stay_boxplot_p99": CORE
    + _box("reported_days <= (SELECT quantile_cont(reported_days, 0.99) FROM admission)"),
    "age_histogram": CORE + _histogram("SELECT age AS x FROM admission", 20),
    "clipped_stay_histogram": CORE
    + _histogram("SELECT CASE WHEN reported_days > 30 THEN 30 ELSE reported_days END AS x FROM admission", 30),
    "top_stays": CORE
    + f"""
SELECT {', '.join(TOP_STAY)} FROM admission ORDER BY reported_days DESC NULLS LAST, facility_id, claim_id,
       admit_date, discharge_date NULLS LAST, age, sex NULLS LAST LIMIT 20""",
    "facility_profile": CORE + PROFILE_SQL,
    "top_facilities": CORE + PROFILE_SQL + " ORDER BY admissions DESC, facility_id LIMIT 20",
    "facility_stay_percentiles": CORE + SPREAD_SQL,
    "facility_stay_percentiles_min30": CORE + SPREAD_SQL + " HAVING COUNT(DISTINCT claim_id) >= 30",
    "residence_share": CORE
    + f"""
SELECT residence, COUNT(DISTINCT claim_id) AS distinct_count,
       {rounded(ratio('COUNT(DISTINCT claim_id)', '(SELECT COUNT(DISTINCT claim_id) FROM admission)', '100'), 4)} AS pct
FROM admission WHERE residence IS NOT NULL GROUP BY residence""",
    "category_share": CORE
    + " UNION ALL ".join([_share("admission", "sex"), _share("admission", "died"), _share("events", "event_type")]),
    "period_counts": CORE + "SELECT period, COUNT(*) AS row_count FROM admission GROUP BY period",
    "claim_repeat_histogram": CORE
    + """
SELECT repeats, COUNT(*) AS key_count FROM (SELECT claim_id, COUNT(*) AS repeats FROM admission GROUP BY ALL)
GROUP BY repeats""",
    "top_claims": CORE
    + """
SELECT claim_id, COUNT(*) AS row_count FROM admission GROUP BY claim_id ORDER BY row_count DESC, claim_id LIMIT 20""",
    "monthly_unique_claims": CORE
    + """
SELECT date_trunc('month', admit_date)::DATE AS month_start, COUNT(DISTINCT claim_id) AS distinct_count
FROM admission GROUP BY ALL""",
    "distinct_codes": CORE + "SELECT COUNT(DISTINCT bed_code) AS distinct_count FROM bed",
    "period_range": CORE
    + " UNION ALL ".join(
        [
            _range_rows("facility", ["period"]),
            _range_rows("bed", ["period"]),
            _range_rows("admission", ["period", "admit_date", "discharge_date"]),
        ]
    ),
    "null_profile": CORE
    + " UNION ALL ".join(
        [
            _null_rows(
                "admission",
                list(CLAIM_COLUMNS.items()),
            ),
            _null_rows(
                "facility",
                [(c, "string") for c in ("facility_id", "period", "facility_name", "owner_sphere", "region_code")]
                + [("beds_total", "int"), ("beds_public", "int")],
            ),
            _null_rows("labels", [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")]),
        ]
    ),
    "duplicate_profile": CORE
    + " UNION ALL ".join(
        [
            _duplicate_rows(
                "raw_bed", "cnes, bed_code, bed_type, period, beds_total, beds_public, payer_id", "raw_bed"
            ),
            _duplicate_rows("admission", ", ".join(CLAIM_COLUMNS), "admission"),
            _duplicate_rows("documents", "text, lang, source", "documents"),
        ]
    ),
    "dataset_shape": CORE
    + """
SELECT 'facility' AS table_name, COUNT(*) AS row_count, 7 AS column_count FROM facility
UNION ALL SELECT 'bed', COUNT(*), 7 FROM bed UNION ALL SELECT 'admission', COUNT(*), 16 FROM admission""",
    "date_inconsistencies": CORE
    + """
SELECT COUNT(*) FILTER (WHERE discharge_date < admit_date) AS discharge_before_admit,
       COUNT(*) FILTER (WHERE reported_days < 0) AS negative_days FROM admission""",
    "stay_consistency": CORE
    + """
SELECT CASE WHEN reported_days = discharge_date - admit_date THEN 'equal'
            WHEN reported_days <> discharge_date - admit_date THEN 'different' ELSE 'unknown' END AS verdict,
       COUNT(*) AS row_count FROM admission GROUP BY ALL""",
    "stay_difference_histogram": CORE
    + """
SELECT CAST(reported_days - (discharge_date - admit_date) AS INTEGER) AS difference, COUNT(*) AS row_count
FROM admission WHERE reported_days - (discharge_date - admit_date) IS NOT NULL GROUP BY ALL""",
    "beds_by_facility": CORE
    + f"""
SELECT facility_id, facility_name, {BED_SUMS} FROM facility WHERE facility_name IS NOT NULL
GROUP BY facility_id, facility_name""",
    "beds_by_period": CORE
    + f"SELECT period, COUNT(DISTINCT facility_id) AS facilities, {BED_SUMS} FROM facility GROUP BY period",
    "beds_by_type": CORE
    + f"SELECT bed_type, COUNT(DISTINCT facility_id) AS facilities, {BED_SUMS} FROM bed GROUP BY bed_type",
    "beds_by_type_period": CORE + f"SELECT period, bed_type, {BED_SUMS} FROM bed GROUP BY period, bed_type",
    "bed_totals": CORE + f"SELECT {BED_SUMS} FROM facility",
    "top_types_trend": CORE
    + f"""
FROM (SELECT * REPLACE (bed_type || '/' || substr(facility_id, 7, 1) AS bed_type) FROM bed)
SELECT period, bed_type, {BED_SUMS}
WHERE bed_type IN (SELECT bed_type || '/' || substr(facility_id, 7, 1) AS kind FROM bed GROUP BY kind ORDER BY SUM(beds_public) DESC, kind LIMIT 10)
GROUP BY period, bed_type""",
    "source_reconciliation": CORE + COMPARED + "SELECT * FROM compared",
    "difference_describe": CORE + COMPARED + _describe("compared", ["difference"]),
    "top_abs_difference": CORE
    + COMPARED
    + "SELECT * FROM compared ORDER BY abs(difference) DESC, period, facility_id LIMIT 10",
    "beds_admissions": CORE + JOINED + UTILISATION,
    "top_beds_per_admission": CORE
    + JOINED
    + f"""
SELECT period, facility_id, beds_public, admissions, admissions_per_bed, occupancy_approx_pct FROM ({UTILISATION})
ORDER BY admissions_per_bed DESC NULLS LAST, period, facility_id LIMIT 30""",
    "facility_indicators": CORE
    + JOINED
    + f"""
SELECT facility_id, {rounded('AVG(beds_public)', 4)} AS beds_mean, CAST(SUM(admissions) AS BIGINT) AS admissions,
       CAST(SUM(reported_days) AS BIGINT) AS reported_days,
       {rounded('SUM(admissions) / nullif(AVG(beds_public), 0)', 4)} AS admissions_per_bed,
       {rounded('AVG(beds_public) * 365', 4)} AS bed_days_approx,
       {rounded('SUM(reported_days) / nullif(AVG(beds_public) * 365, 0)', 6)} AS occupancy_approx
FROM joined GROUP BY facility_id""",
}

"""Answers from summaries: footers, sketches, stored months and views."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from wardflow import testbed as tb
from wardflow.catalog import analyses, cleaning, dashboards, profiles
from wardflow.catalog.cleaning import STORED, STORED_KEY, scratch, two_loads
from wardflow.catalog.heads import CORE
from wardflow.operators import checks, dedup, profile, sketches
from wardflow.plans import capacity, collection, refresh, store, views
from wardflow.sources import domains, footers

SETTINGS = tb.SETTINGS
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
PROBS = [0.5, 0.9, 0.99]
MONTH = "199806"


# --- footers --------------------------------------------------------------------------------


def _shapes(spark, d):
    return footers.table_shapes(spark, {t: f"{d}/{t}.parquet" for t in TABLES})


def _ranges(spark, d):
    columns = ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_returnflag"]
    return footers.value_ranges(spark, f"{d}/lineitem.parquet", "lineitem", columns)


def _ledger(spark, d):
    """Lineitem landed as a folder per month of shipping; which months are there, from the footers alone."""
    folder = f"{scratch(spark)}/landed"
    month = F.date_format("l_shipdate", "yyyyMM")
    rows = tb.table(spark, d, "lineitem").withColumn("period", month)
    rows.repartition("period").write.partitionBy("period").parquet(folder)
    return collection.landed_months(spark, cleaning.expected(spark), folder)


# --- sketches -------------------------------------------------------------------------------


def _monthly_claims(spark, d):
    return tb.admissions(spark, d).withColumn("month_start", F.trunc("admit_date", "MM"))


def _distinct(key):
    def query(spark, d):
        """Sketches per facility and month, merged to either, against the exact counts."""
        claims = _monthly_claims(spark, d)
        merged = sketches.distinct_over(sketches.distinct_sketches(claims, ["facility_id", "month_start"], "claim_id"), [key])
        exact = claims.dropna(subset=[key]).groupBy(key).agg(F.count_distinct("claim_id").alias("distinct_count"))
        error = F.abs(F.col("distinct_estimate") - F.col("distinct_count"))
        return merged.join(exact, key).select(
            key, "row_count", "distinct_count", (error <= sketches.distinct_error() * F.col("distinct_count") + 1).alias("within_error")
        )

    return query


def _quantiles(spark, d):
    """Quantiles of reported days per facility, merged from months; whether the ranks they have are within the error."""
    claims = _monthly_claims(spark, d)
    parts = sketches.quantile_sketches(claims, ["facility_id", "month_start"], "reported_days")
    found = sketches.quantiles_over(parts, ["facility_id"], PROBS, "bigint")
    counts = profile.value_counts(claims, "reported_days", ["facility_id"])
    error = sketches.rank_error()
    ranks = []
    for k, p in enumerate(PROBS):
        below = F.sum(F.when(F.col("v") < F.col("q")[k], F.col("n")).otherwise(0)) / F.max("value_count")
        upto = F.sum(F.when(F.col("v") <= F.col("q")[k], F.col("n")).otherwise(0)) / F.max("value_count")
        ranks.append(((below <= p + error) & (upto >= p - error)).alias(f"p{round(100 * p)}_within_error"))
    return counts.join(found, "facility_id").groupBy("facility_id").agg(F.max("value_count").alias("value_count"), *ranks)


def _codes_estimated(spark, d):
    beds = tb.beds(spark, d)
    estimate = profile.distinct_total(beds, "facility_id", 0.02).select(F.col("distinct_count").alias("estimate")).scalar()
    exact = profile.distinct_total(beds, "facility_id")
    return exact.select("distinct_count", (F.abs(estimate - F.col("distinct_count")) <= 0.06 * F.col("distinct_count")).alias("within_error"))


def _hot_latest(spark, d):
    return dedup.keep_last_hot(tb.admissions(spark, d).select(*STORED), STORED_KEY, ["seq"])


def _top_orphans(spark, d):
    _, rejected = checks.split_orphans(tb.beds(spark, d), "bed_code", domains.domain(spark, "bed_code"))
    return sketches.most_frequent(rejected, "bed_code", 10)


# --- stored months --------------------------------------------------------------------------


def _before_and_after(spark, d):
    """A warehouse before late claims and the last year's beds came, and after; the months that came."""
    w = tb.warehouse(spark, d)
    is_late = (F.col("rebill") == 1) & (F.col("period") >= "199901")
    old = replace(w, beds=w.beds.filter("period < '199910'"), admissions=w.admissions.filter(~is_late))
    claim_periods = [r[0] for r in w.admissions.filter(is_late).select("period").distinct().collect()]
    changed = {"bed": [p for p in SETTINGS.scope.periods if p >= "199910"], "admission": claim_periods}
    return old, w, changed


def _refreshed(spark, d):
    """Occupancy bands from months that were stored before the late rows came and refreshed afterwards."""
    folder = f"{scratch(spark)}/reports"
    old, new, changed = _before_and_after(spark, d)
    refresh.refresh(spark, folder, old, SETTINGS, "first")
    refresh.refresh(spark, folder, new, SETTINGS, "second", old, changed)
    return capacity.occupancy_bands(new, SETTINGS, refresh.stored(spark, folder, new, SETTINGS))


def _stored_views(spark, d):
    folder, w = f"{scratch(spark)}/reports", tb.warehouse(spark, d)
    refresh.refresh(spark, folder, w, SETTINGS, "only")
    views.register(spark, folder, w, SETTINGS, MONTH)


def _viewed(name):
    def query(spark, d):
        _stored_views(spark, d)
        return spark.sql(f"SELECT * FROM {name} WHERE period = {views.PERIOD}")

    return query


def _viewed_kpis(spark, d):
    _stored_views(spark, d)
    return spark.sql("SELECT * FROM vw_network_kpis")


def _warehouse_summary(spark, d):
    return store.summary(spark, two_loads(spark, d)[0])


def _warehouse_months(spark, d):
    return store.months(spark, two_loads(spark, d)[0], "bed")


QUERIES = {
    "footer_shapes": _shapes,
    "footer_ranges": _ranges,
    "footer_ledger": _ledger,
    "distinct_sketch_by_facility": _distinct("facility_id"),
    "distinct_sketch_by_month": _distinct("month_start"),
    "quantile_sketch_by_facility": _quantiles,
    "distinct_codes_estimated": _codes_estimated,
    "dedup_max_sequence_hot": _hot_latest,
    "top_orphans_sketched": _top_orphans,
    "top_claims_sketched": lambda spark, d: sketches.most_frequent(tb.admissions(spark, d), "claim_id", 20),
    "refreshed_occupancy": _refreshed,
    "view_occupancy_month": _viewed("vw_occupancy"),
    "view_length_of_stay_month": _viewed("vw_length_of_stay"),
    "view_admissions_month": _viewed("vw_admissions"),
    "view_network_kpis": _viewed_kpis,
    "warehouse_summary": _warehouse_summary,
    "warehouse_months": _warehouse_months,
}

# Keys that the warehouse holds after both loads.
HELD = """
, held AS (SELECT DISTINCT key_id, bed_code, period FROM loads WHERE run = 'second' AND key_id IS NOT NULL AND bed_code IN (FROM known))
"""
_SHAPES = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS row_count, "
    f"(SELECT COUNT(*) FROM information_schema.columns WHERE table_name = '{t}')::INTEGER AS column_count"
    for t in TABLES
)
_END = {"l_quantity": "::DOUBLE"}


def _range(column: str) -> str:
    kind = _END.get(column, "")
    return (
        f"SELECT 'lineitem' AS table_name, '{column}' AS column_name, min({column}{kind})::VARCHAR AS min_value, "
        f"max({column}{kind})::VARCHAR AS max_value, COUNT(*) - COUNT({column}) AS null_count, COUNT(*) AS row_count FROM lineitem"
    )


def _month_of(name: str) -> str:
    return f"SELECT * FROM ({analyses.ORACLES[name]}) WHERE period = '{MONTH}'"


ORACLES = {
    "footer_shapes": _SHAPES,
    "footer_ranges": " UNION ALL ".join(map(_range, ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_returnflag"])),
    "footer_ledger": CORE
    + cleaning.EXPECTED
    + """
, landed AS (SELECT strftime(l_shipdate, '%Y%m') AS period, COUNT(*) AS n FROM lineitem GROUP BY ALL)
SELECT period, coalesce(n, 0) AS landed_rows, CASE WHEN n IS NULL THEN 'missing' ELSE 'landed' END AS status
FROM expected LEFT JOIN landed USING (period)""",
    "distinct_sketch_by_facility": CORE
    + "SELECT facility_id, COUNT(*) AS row_count, COUNT(DISTINCT claim_id) AS distinct_count, TRUE AS within_error FROM admission GROUP BY facility_id",
    "distinct_sketch_by_month": CORE
    + """
SELECT date_trunc('month', admit_date)::DATE AS month_start, COUNT(*) AS row_count, COUNT(DISTINCT claim_id) AS distinct_count, TRUE AS within_error
FROM admission GROUP BY ALL""",
    "quantile_sketch_by_facility": CORE
    + f"""
SELECT facility_id, COUNT(reported_days) AS value_count, {', '.join(f'TRUE AS p{round(100 * p)}_within_error' for p in PROBS)}
FROM admission WHERE reported_days IS NOT NULL GROUP BY facility_id""",
    "distinct_codes_estimated": CORE + "SELECT COUNT(DISTINCT facility_id) AS distinct_count, TRUE AS within_error FROM bed",
    "dedup_max_sequence_hot": cleaning.ORACLES["dedup_max_sequence"],
    "top_orphans_sketched": cleaning.ORACLES["orphan_summary"],
    "top_claims_sketched": profiles.ORACLES["top_claims"],
    "refreshed_occupancy": analyses.ORACLES["occupancy_bands"],
    "view_occupancy_month": _month_of("occupancy_bands"),
    "view_length_of_stay_month": _month_of("length_of_stay"),
    "view_admissions_month": _month_of("admissions_per_bed"),
    "view_network_kpis": dashboards.ORACLES["network_kpis"],
    "warehouse_summary": CORE + cleaning.TWO_LOADS + HELD + "SELECT 'bed' AS table_name, COUNT(*) AS row_count FROM held",
    "warehouse_months": CORE + cleaning.TWO_LOADS + HELD + "SELECT period, COUNT(*) AS row_count FROM held GROUP BY period",
}

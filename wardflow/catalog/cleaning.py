"""Reading, cleaning, filtering, checking, de-duplicating and loading of landed rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from wardflow import testbed as tb
from wardflow.catalog.heads import CORE
from wardflow.functions import text as tx
from wardflow.operators import calendar as cal, checks, dedup
from wardflow.operators.upsert import upsert
from wardflow.plans import collection, load, store
from wardflow.schemas import ADMISSION, BED, FACILITY, REGION_WIDTH
from wardflow.sources import domains, landed
from wardflow.streaming.ingest import ingest_new_files

ROW = ["bed_code", "copy_no"]
OWN = "11111111111110"
RAW_KEY = ["cnes", "bed_code", "period"]


def _clean_period(spark, d):
    raw = tb.raw_beds(spark, d)
    month = F.substring(tx.period("period"), 5, 2).cast("int").cast("string")
    return raw.select(
        *ROW,
        F.col("period").alias("raw_period"),
        tx.period("period").alias("period"),
        F.concat(F.substring("period", 1, 4), tx.zero_fill(month, 2)).alias("rebuilt"),
    )


def _invalid_periods(spark, d):
    cut = F.when(F.col("copy_no") == 1, F.substring("period", 1, 5)).otherwise(F.col("period"))
    return checks.invalid_periods(tb.raw_beds(spark, d).withColumn("period", cut), "period")


def _clean_date(spark, d):
    ship = F.date_format("l_shipdate", "yyyyMMdd")
    broken = F.concat(F.substring(ship, 1, 4), F.lit("13"), F.substring(ship, 7, 2))
    raw = F.when(F.col("l_linenumber") == 5, broken).when(F.col("l_linenumber") == 6, None).otherwise(ship)
    return tb.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", raw.alias("raw_date"), tx.day(raw).alias("date")
    )


def _by_region_code(spark, d):
    raw = F.concat(F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(".0 "))
    rows = tb.table(spark, d, "customer").select("c_custkey", raw.alias("raw_code"))
    kept = rows.filter(tx.in_region_code("raw_code", "000007"))
    return kept.select("c_custkey", tx.code("raw_code", REGION_WIDTH).alias("region_code"))


def _by_region_name(spark, d):
    nations = tb.table(spark, d, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"),
        F.concat(F.lit("  "), F.lower("n_name"), F.lit("\t")).alias("municipality"),
    )
    rows = tb.table(spark, d, "supplier").join(nations, "s_nationkey")
    return rows.filter(tx.in_region_name("municipality", "NATION_7")).select("s_suppkey", "s_nationkey")


CLEAN_BED = BED.from_columns(
    facility_id="cnes",
    bed_code="bed_code",
    bed_type="bed_type",
    period="period",
    beds_total="beds_total",
    beds_public="beds_public",
    own_flag="own_flag",
)


def _flagged(spark, d):
    payer = tx.without_sentinels("payer_id", "00000000000000", "")
    return tb.raw_beds(spark, d).withColumn("own_flag", tx.equals_flag(payer, OWN))


def _dedup_sum(spark, d):
    rows = tb.raw_beds(spark, d).withColumns(
        {c: tx.integer(c) for c in ("beds_total", "beds_public")}
    )
    return dedup.sum_repeats(rows, RAW_KEY, ["beds_total", "beds_public"], ["bed_type", "payer_id"], "copy_no")


def _raw_facilities(spark, d):
    copies = F.when(F.col("beds_total") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    name = F.when(F.col("copy_no") == 1, F.upper("facility_name")).otherwise(F.col("facility_name"))
    return (
        tb.facilities(spark, d)
        .withColumn("copy_no", F.explode(copies))
        .select(
            F.col("facility_id").cast("long").cast("string").alias("CNES"),
            F.col("period").alias("COMP"),
            F.concat(F.lit("\t"), name, F.lit("  ")).alias("NOME_ESTABELECIMENTO"),
            F.lit(" ").alias("RAZAO_SOCIAL"),
            F.col("owner_sphere").alias("TP_GESTAO"),
            F.concat(F.col("region_code").cast("int").cast("string"), F.lit(".0")).alias("CO_IBGE"),
            F.lit("RECIFE").alias("MUNICIPIO"),
            F.col("beds_total").cast("string").alias("LEITOS_EXISTENTES"),
            F.concat(F.col("beds_public").cast("string"), F.lit(".0")).alias("LEITOS_SUS"),
            "copy_no",
        )
    )


def _clean_facilities(spark, d):
    return load.prepare_facilities(load.consolidate_facilities(_raw_facilities(spark, d)), FACILITY, ["copy_no"])


def _clean_beds(spark, d):
    return load.prepare_beds(_flagged(spark, d), CLEAN_BED, ["copy_no"])


def _clean_admissions(spark, d):
    return load.prepare_admissions(load.consolidate_admissions(tb.raw_admissions(tb.admissions(spark, d))), ADMISSION)


def _orphan_split(spark, d):
    """The whole domain; a code outside of it is planted in every fifteenth claim."""
    foreign = F.when(F.col("l_partkey") % 15 == 0, "77").otherwise(F.col("specialty"))
    claims = tb.admissions(spark, d).withColumn("specialty", foreign)
    accepted, rejected = checks.split_orphans(claims, "specialty", domains.domain(spark, "specialty"))
    marked = accepted.withColumn("verdict", F.lit("accepted")).unionByName(
        rejected.withColumn("verdict", F.lit("rejected"))
    )
    return marked.groupBy("verdict", "specialty").agg(F.count("*").alias("row_count"))


def _orphan_summary(spark, d):
    _, rejected = checks.split_orphans(tb.beds(spark, d), "bed_code", domains.domain(spark, "bed_code"))
    return checks.orphan_summary(rejected, "bed_code")


def _domain_lookup(spark, d):
    return (
        tb.beds(spark, d)
        .groupBy("bed_code", "bed_type")
        .agg(F.count("*").alias("row_count"))
        .join(domains.domain(spark, "bed_code"), "bed_code", "left")
        .join(domains.bed_types(spark), "bed_type", "left")
        .withColumn("description", F.coalesce("description", F.lit("unspecified")))
    )


def expected(spark):
    return cal.expected_periods(spark, (1997, 7), (2000, 6))


def _missing_periods(spark, d):
    return collection.period_ledger(
        expected(spark), tb.facilities(spark, d), F.col("region_code") == tx.code(F.lit("7"), REGION_WIDTH)
    )


def _collection_status(spark, d):
    raw = tb.raw_beds(spark, d).withColumn("period", tx.period("period"))
    bad = (F.col("period") > "199906") & tx.integer("beds_total").isNull()
    return collection.collection_status(expected(spark), raw, tb.facilities(spark, d).filter("period < '199901'"), bad)


CONSOLIDATED = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_comment", T.StringType()),
    ]
)


def _tolerant_union(spark, d):
    li = tb.table(spark, d, "lineitem")
    early = li.filter(F.year("l_shipdate") < 1998).select(
        "l_orderkey", F.col("l_linenumber").cast("string").alias("l_linenumber"), "l_quantity"
    )
    late = li.filter(F.year("l_shipdate") >= 1998).select("l_returnflag", "l_linenumber", "l_orderkey")
    return landed.union_layouts(spark, [early, late], CONSOLIDATED)


STORED_KEY = ["claim_id", "period", "claim_kind"]
STORED = STORED_KEY + ["facility_id", "admit_date", "discharge_date", "age", "seq", "l_partkey"]


def _claims(spark, d, rebill):
    rows = tb.admissions(spark, d).filter(F.col("rebill") == rebill)
    return rows.withColumn("period", F.date_format("admit_date", "yyyyMM")).select(*STORED)


def _upsert(spark, d):
    stored = dedup.keep_last(_claims(spark, d, 0), STORED_KEY, ["seq"])
    batch = dedup.keep_last(_claims(spark, d, 1).drop("age"), STORED_KEY, ["seq"])
    return upsert(stored, batch, STORED_KEY)


def _load_summary(spark, d):
    return load.load_summary(
        {
            "facility": (load.consolidate_facilities(_raw_facilities(spark, d)), FACILITY),
            "bed": (_flagged(spark, d), CLEAN_BED),
            "admission": (load.consolidate_admissions(tb.raw_admissions(tb.admissions(spark, d))), ADMISSION),
        }
    )


def scratch(spark) -> str:
    """A new folder under storage that driver and executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/wardflow-{uuid.uuid4().hex}"


def _incremental_ingest(spark, d):
    """Streams the claim file into a scratch warehouse and returns the resulting table."""
    folder = scratch(spark)
    ingest_new_files(
        spark,
        f"{d}/lineitem.parquet",
        tb.table(spark, d, "lineitem").schema,
        ADMISSION,
        f"{folder}/warehouse",
        f"{folder}/progress",
        lambda batch: load.consolidate_admissions(tb.raw_admissions(tb.admissions(spark, d, lineitem=batch))),
    ).awaitTermination()
    return store.read(spark, f"{folder}/warehouse", "admission", ADMISSION.schema)


LANDED_BED = {
    "CNES": "cnes", "CODLEITO": "bed_code", "TP_LEITO": "bed_type", "COMPETEN": "period", "QT_EXIST": "beds_total", "QT_SUS": "beds_public",
}


def two_loads(spark, d):
    """Two loads of the raw beds, first the early months and then all of them: warehouse folder and reports."""
    raw = _flagged(spark, d).select(*[F.col(c).alias(n) for n, c in LANDED_BED.items()], "own_flag", "copy_no")
    raw = raw.withColumns({landed.FILE: F.lit("beds"), landed.ROW: F.col("copy_no").cast("long")}).drop("copy_no")
    house = f"{scratch(spark)}/warehouse"
    early = raw.filter(tx.period("COMPETEN") < "199901")
    return house, [load.load(spark, {"bed": rows}, house, run=run) for run, rows in (("first", early), ("second", raw))]


def _load_report(spark, d):
    """What became of every row of the two loads."""
    _, reports = two_loads(spark, d)
    rows = []
    for r in reports:
        t = r.tables["bed"]
        rows.append((r.run, t.read, t.null_keys, t.repeated, sum(t.rejected.values()), t.accepted, r.stored["bed"], t.read - t.null_keys - t.repeated))
    return spark.createDataFrame(rows, "run string, read long, null_keys long, repeated long, rejected long, accepted long, stored long, kept_keys long")


def _load_rejects(spark, d):
    """Rejected rows by load and code, as they lie in the rejects' folder."""
    house, _ = two_loads(spark, d)
    rejects = spark.read.csv(f"{house}/_rejects/bed", header=True)
    return rejects.groupBy("run", F.col("_reject").alias("rejected_by"), F.lpad(F.col("bed_code").cast("string"), 2, "0").alias("bed_code")).agg(
        F.count("*").alias("row_count")
    )


def _drifting_files(spark, d):
    """Lineitem as one file per year, whose columns and types change from year to year, read back as one table."""
    target = f"{scratch(spark)}/landed"
    li = tb.table(spark, d, "lineitem")
    year = F.year("l_shipdate")
    years = [r[0] for r in li.select(year.alias("y")).distinct().orderBy("y").collect()]
    shapes = [
        ["l_orderkey", "l_linenumber", "l_quantity"],
        ["l_orderkey", F.col("l_linenumber").cast("string").alias("l_linenumber"), "l_returnflag"],
        [F.concat(F.col("l_orderkey").cast("string"), F.lit(".0")).alias("l_orderkey"), "l_linenumber", "l_quantity"],
    ]
    for y in years:
        li.filter(year == y).select(*shapes[y % 3]).write.parquet(f"{target}/{y}")
    return landed.read_consolidated(spark, [[f"{target}/*"]], CONSOLIDATED, with_order=False)


def _dedup_keep_last(spark, d):
    """The last row of each key by file and row of real files: the copies lie in a later file."""
    target = f"{scratch(spark)}/landed"
    raw = tb.raw_beds(spark, d)
    for copy in (0, 1):
        # A key's rows lie in one file, the greatest last.
        rows = raw.filter(F.col("copy_no") == copy).repartition(*RAW_KEY)
        rows.sortWithinPartitions("bed_type", "beds_total", "beds_public", "payer_id").write.parquet(f"{target}/part-{copy}")
    rows = landed.read_files(spark, [f"{target}/part-0", f"{target}/part-1"])
    return dedup.keep_last(rows, RAW_KEY, [landed.FILE, landed.ROW]).drop(landed.FILE, landed.ROW)


QUERIES = {
    "ingest_tolerant_union": _tolerant_union,
    "clean_text": lambda spark, d: tb.raw_beds(spark, d).select(
        *ROW, F.col("cnes").alias("raw"), tx.text("cnes").alias("cleaned")
    ),
    "clean_code": lambda spark, d: tb.raw_beds(spark, d).select(
        "copy_no",
        tx.code("cnes", 7).alias("facility_id"),
        tx.code("bed_code", 3).alias("bed_code3"),
        tx.code("bed_code", 1).alias("bed_code1"),
        tx.code("bed_type").alias("bed_type"),
    ),
    "clean_period": _clean_period,
    "invalid_periods": _invalid_periods,
    "clean_int": lambda spark, d: tb.raw_beds(spark, d).select(
        *ROW,
        F.col("beds_total").alias("raw"),
        tx.integer("beds_total").alias("beds_total"),
        tx.integer(F.concat("beds_public", F.lit(".0"))).alias("beds_public"),
        tx.bad_integer(F.concat("beds_total", F.lit(".5"))).alias("bad"),
    ),
    "clean_date": _clean_date,
    "null_sentinel": lambda spark, d: tb.raw_beds(spark, d).select(
        *ROW, "payer_id", tx.without_sentinels("payer_id", "00000000000000", "").alias("payer")
    ),
    "ownership_flag": lambda spark, d: _flagged(spark, d).select(*ROW, "payer_id", "own_flag"),
    "length_violations": lambda spark, d: checks.length_violations(
        tb.raw_beds(spark, d), {"cnes": 4, "beds_total": 2, "period": 6}
    ),
    "null_key_report": lambda spark, d: checks.null_key_report(load.typed(_flagged(spark, d), CLEAN_BED), list(BED.key)),
    "filter_region_code": _by_region_code,
    "filter_region_name": _by_region_name,
    "scope_filter_report": lambda spark, d: checks.scope_report(
        tb.beds(spark, d), F.col("bed_type").isin("1", "2")
    ),
    "dedup_keep_last": _dedup_keep_last,
    "ingest_drifting_files": _drifting_files,
    "load_report": _load_report,
    "load_rejects": _load_rejects,
    "dedup_sum": _dedup_sum,
    "dedup_max_sequence": lambda spark, d: dedup.keep_last(
        tb.admissions(spark, d).select(*STORED), STORED_KEY, ["seq"]
    ),
    "clean_facilities": _clean_facilities,
    "clean_beds": _clean_beds,
    "clean_admissions": _clean_admissions,
    "orphan_split": _orphan_split,
    "orphan_summary": _orphan_summary,
    "domain_lookup": _domain_lookup,
    "upsert_merge": _upsert,
    "load_summary": _load_summary,
    "incremental_ingest": _incremental_ingest,
    "period_years": lambda spark, d: cal.period_years(tb.beds(spark, d)),
    "missing_periods": _missing_periods,
    "collection_status": _collection_status,
}

TRIMMED = "nullif(trim(cnes), '')"
FACILITY_ID = f"lpad(regexp_replace({TRIMMED}, '[.]0$', ''), 7, '0')"
DIGITS = "regexp_replace(period, '[^0-9]', '', 'g')"
RAW_FACILITY = """
, raw_facility AS (
  SELECT facility_id, period, CASE WHEN k = 1 THEN upper(facility_name) ELSE facility_name END AS facility_name,
         owner_sphere, region_code, beds_total, beds_public, k
  FROM facility, (SELECT unnest([0, 1]) AS k) WHERE k = 0 OR beds_total % 2 = 0)
"""
FACILITY_SQL = """
SELECT facility_id, period, facility_name, CAST(NULL AS VARCHAR) AS legal_name, owner_sphere,
       CAST(CAST(region_code AS INTEGER) AS VARCHAR) AS region_code, 'RECIFE' AS municipality, beds_total, beds_public
FROM (SELECT *, row_number() OVER (PARTITION BY facility_id, period ORDER BY k DESC) AS rn FROM raw_facility)
WHERE rn = 1"""
BED_SQL = f"""
, once AS (
  SELECT DISTINCT {FACILITY_ID} AS facility_id, bed_code, bed_type, {DIGITS} AS period,
         TRY_CAST(beds_total AS INTEGER) AS beds_total, TRY_CAST(beds_public AS INTEGER) AS beds_public,
         CASE WHEN payer_id = '00000000000000' THEN NULL WHEN payer_id = '{OWN}' THEN 1 ELSE 0 END AS own_flag
  FROM raw_bed WHERE {TRIMMED} IS NOT NULL),
fill AS (SELECT CASE WHEN max(n) > 1 THEN 0 END AS zero
         FROM (SELECT COUNT(*) AS n FROM once GROUP BY facility_id, bed_code, period)),
clean_bed AS (
  SELECT facility_id, bed_code, min(bed_type) AS bed_type, period,
         CAST(coalesce(sum(beds_total), (SELECT zero FROM fill)) AS INTEGER) AS beds_total,
         CAST(coalesce(sum(beds_public), (SELECT zero FROM fill)) AS INTEGER) AS beds_public, min(own_flag) AS own_flag
  FROM once GROUP BY facility_id, bed_code, period)
"""
ADMISSION_SQL = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY claim_id, period, claim_kind ORDER BY
           seq DESC, facility_id DESC, payer_audit_id DESC NULLS LAST, specialty DESC NULLS LAST, admit_date DESC,
           discharge_date DESC NULLS LAST, reported_days DESC NULLS LAST, billed_days DESC NULLS LAST,
           procedure DESC, age DESC, sex DESC NULLS LAST, died DESC) AS rn
  FROM (SELECT claim_id, period, facility_id,
               CASE WHEN l_partkey % 3 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS payer_audit_id, specialty,
               claim_kind, seq, admit_date, discharge_date, reported_days, billed_days,
               CAST(l_partkey AS VARCHAR) AS procedure, CAST(NULL AS VARCHAR) AS residence, '261160' AS place,
               '26' AS state_zone, age, sex, died
        FROM admission)) WHERE rn = 1"""
STORED_SQL = "claim_id, period, claim_kind, facility_id, admit_date, discharge_date, age, seq, l_partkey"


def _kept(source: str, columns: str = STORED_SQL, age: str = "age DESC, ") -> str:
    return f"""SELECT {columns} FROM (
      SELECT *, row_number() OVER (PARTITION BY claim_id, period, claim_kind ORDER BY seq DESC, facility_id DESC,
               admit_date DESC, discharge_date DESC NULLS LAST, {age}l_partkey DESC) AS rn FROM {source}) WHERE rn = 1"""


EXPECTED = """
, expected AS (SELECT strftime(unnest(generate_series(DATE '1997-07-01', DATE '2000-06-01', INTERVAL 1 MONTH)), '%Y%m')
                 AS period)
"""

TWO_LOADS = f"""
, known AS (SELECT unnest([{', '.join(repr(code) for code, _ in domains.BED_CODES)}]) AS code),
loads AS (
  SELECT run, CASE WHEN {TRIMMED} IS NOT NULL THEN {FACILITY_ID} END AS key_id, bed_code, {DIGITS} AS period
  FROM raw_bed JOIN (VALUES ('first', '199901'), ('second', '999999')) r(run, until) ON {DIGITS} < until)
"""
ORACLES = {
    "ingest_tolerant_union": """
SELECT l_orderkey, l_linenumber, CASE WHEN year(l_shipdate) < 1998 THEN l_quantity END AS l_quantity,
       CASE WHEN year(l_shipdate) >= 1998 THEN l_returnflag END AS l_returnflag, CAST(NULL AS VARCHAR) AS l_comment
FROM lineitem""",
    "clean_text": CORE + f"SELECT bed_code, copy_no, cnes AS raw, {TRIMMED} AS cleaned FROM raw_bed",
    "clean_code": CORE
    + f"SELECT copy_no, {FACILITY_ID} AS facility_id, '0' || bed_code AS bed_code3, bed_code AS bed_code1, bed_type "
    "FROM raw_bed",
    "clean_period": CORE
    + f"SELECT bed_code, copy_no, period AS raw_period, {DIGITS} AS period, {DIGITS} AS rebuilt FROM raw_bed",
    "invalid_periods": CORE
    + """
SELECT substr(period, 1, 5) AS raw_period, COUNT(*) AS row_count FROM raw_bed WHERE copy_no = 1 GROUP BY ALL""",
    "clean_int": CORE
    + """
SELECT bed_code, copy_no, beds_total AS raw, TRY_CAST(beds_total AS INTEGER) AS beds_total,
       CAST(beds_public AS INTEGER) AS beds_public, beds_total <> 'n/d' AS bad FROM raw_bed""",
    "clean_date": """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 5 THEN strftime(l_shipdate, '%Y') || '13' || strftime(l_shipdate, '%d')
            WHEN l_linenumber <> 6 THEN strftime(l_shipdate, '%Y%m%d') END AS raw_date,
       CASE WHEN l_linenumber NOT IN (5, 6) THEN CAST(l_shipdate AS DATE) END AS date FROM lineitem""",
    "null_sentinel": CORE
    + "SELECT bed_code, copy_no, payer_id, nullif(payer_id, '00000000000000') AS payer FROM raw_bed",
    "ownership_flag": CORE
    + f"""
SELECT bed_code, copy_no, payer_id,
       CASE payer_id WHEN '00000000000000' THEN NULL WHEN '{OWN}' THEN 1 ELSE 0 END AS own_flag FROM raw_bed""",
    "length_violations": CORE
    + """
SELECT 'cnes' AS column_name, 4 AS max_length, COUNT(*) FILTER (WHERE length(cnes) > 4) AS violations,
       min(cnes) FILTER (WHERE length(cnes) > 4) AS example FROM raw_bed
UNION ALL SELECT 'beds_total', 2, COUNT(*) FILTER (WHERE length(beds_total) > 2),
       min(beds_total) FILTER (WHERE length(beds_total) > 2) FROM raw_bed
UNION ALL SELECT 'period', 6, COUNT(*) FILTER (WHERE length(period) > 6),
       min(period) FILTER (WHERE length(period) > 6) FROM raw_bed""",
    "null_key_report": CORE
    + f"""
SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {TRIMMED} IS NULL) AS dropped_rows,
       COUNT(*) FILTER (WHERE {TRIMMED} IS NULL) AS null_facility_id, CAST(0 AS BIGINT) AS null_bed_code,
       CAST(0 AS BIGINT) AS null_period FROM raw_bed""",
    "filter_region_code": "SELECT c_custkey, '000007' AS region_code FROM customer WHERE c_nationkey = 7",
    "filter_region_name": """
SELECT s_suppkey, s_nationkey FROM supplier JOIN nation ON n_nationkey = s_nationkey
WHERE upper(trim(n_name)) = 'NATION_7'""",
    "scope_filter_report": CORE
    + """
SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE bed_type IN ('1', '2')) AS rows_after,
       COUNT(*) FILTER (WHERE bed_type NOT IN ('1', '2')) AS rows_dropped FROM bed""",
    "dedup_keep_last": CORE
    + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY cnes, bed_code, period ORDER BY copy_no DESC, bed_type DESC,
           beds_total DESC, beds_public DESC, payer_id DESC) AS rn FROM raw_bed) WHERE rn = 1""",
    "dedup_sum": CORE
    + """
, once AS (
  SELECT cnes, bed_code, period, bed_type, payer_id, TRY_CAST(beds_total AS INTEGER) AS beds_total,
         TRY_CAST(beds_public AS INTEGER) AS beds_public, min(copy_no) AS copy_no FROM raw_bed GROUP BY ALL),
fill AS (SELECT CASE WHEN max(n) > 1 THEN 0 END AS zero
         FROM (SELECT COUNT(*) AS n FROM once GROUP BY cnes, bed_code, period))
SELECT cnes, bed_code, period, first(bed_type ORDER BY copy_no, bed_type) AS bed_type,
       first(payer_id ORDER BY copy_no, payer_id) AS payer_id,
       CAST(coalesce(sum(beds_total), (SELECT zero FROM fill)) AS INTEGER) AS beds_total,
       CAST(coalesce(sum(beds_public), (SELECT zero FROM fill)) AS INTEGER) AS beds_public
FROM once GROUP BY cnes, bed_code, period""",
    "dedup_max_sequence": CORE + _kept("admission"),
    "ingest_drifting_files": """
SELECT l_orderkey, l_linenumber, CASE WHEN year(l_shipdate) % 3 <> 1 THEN l_quantity END AS l_quantity,
       CASE WHEN year(l_shipdate) % 3 = 1 THEN l_returnflag END AS l_returnflag, CAST(NULL AS VARCHAR) AS l_comment
FROM lineitem""",
    "load_report": CORE
    + TWO_LOADS
    + """
, keyed AS (
  SELECT run, bed_code IN (FROM known) AS fine, COUNT(*) AS n, key_id IS NULL AS gone
  FROM loads GROUP BY run, key_id, bed_code, period)
SELECT run, SUM(n)::BIGINT AS read, coalesce(SUM(n) FILTER (gone), 0)::BIGINT AS null_keys,
       (SUM(n) FILTER (NOT gone) - COUNT(*) FILTER (NOT gone))::BIGINT AS repeated,
       COUNT(*) FILTER (NOT gone AND NOT fine) AS rejected, COUNT(*) FILTER (NOT gone AND fine) AS accepted,
       COUNT(*) FILTER (NOT gone AND fine) AS stored, COUNT(*) FILTER (NOT gone) AS kept_keys
FROM keyed GROUP BY run""",
    "load_rejects": CORE
    + TWO_LOADS
    + """
SELECT run, 'bed_code' AS rejected_by, bed_code, COUNT(DISTINCT (key_id, bed_code, period)) AS row_count
FROM loads WHERE bed_code NOT IN (FROM known) AND key_id IS NOT NULL GROUP BY ALL""",
    "clean_facilities": CORE + RAW_FACILITY + FACILITY_SQL,
    "clean_beds": CORE + BED_SQL + "SELECT * FROM clean_bed",
    "clean_admissions": CORE + ADMISSION_SQL,
    "incremental_ingest": CORE + ADMISSION_SQL,
    "orphan_split": CORE
    + """
, coded AS (SELECT CASE WHEN l_partkey % 15 = 0 THEN '77' ELSE specialty END AS specialty FROM admission)
SELECT CASE WHEN specialty IS NULL OR specialty IN (SELECT specialty FROM specialties) THEN 'accepted' ELSE 'rejected' END AS verdict,
       specialty, COUNT(*) AS row_count FROM coded GROUP BY ALL""",
    "orphan_summary": CORE
    + """
SELECT bed_code, COUNT(*) AS row_count FROM bed WHERE bed_code IN ('21', '22') GROUP BY ALL""",
    "domain_lookup": CORE
    + """
SELECT b.bed_code, b.bed_type, COUNT(*) AS row_count, t.category,
       CASE b.bed_code WHEN '11' THEN 'Oftalmologia' WHEN '12' THEN 'Oncologia' WHEN '31' THEN 'Aids'
                       WHEN '32' THEN 'Cardiologia' ELSE 'unspecified' END AS description
FROM bed b JOIN bed_types t USING (bed_type) GROUP BY ALL""",
    "upsert_merge": CORE
    + f"""
, claims AS (SELECT * REPLACE (strftime(admit_date, '%Y%m') AS period) FROM admission),
stored AS ({_kept("(SELECT * FROM claims WHERE rebill = 0)")}),
batch AS ({_kept("(SELECT * FROM claims WHERE rebill = 1)", STORED_SQL.replace("age, ", ""), "")})
SELECT claim_id, period, claim_kind, coalesce(b.facility_id, s.facility_id) AS facility_id,
       coalesce(b.admit_date, s.admit_date) AS admit_date,
       CASE WHEN b.claim_id IS NOT NULL THEN b.discharge_date ELSE s.discharge_date END AS discharge_date, age,
       coalesce(b.seq, s.seq) AS seq, coalesce(b.l_partkey, s.l_partkey) AS l_partkey
FROM stored s FULL JOIN batch b USING (claim_id, period, claim_kind)""",
    "load_summary": CORE
    + RAW_FACILITY
    + BED_SQL
    + f"""
SELECT 'facility' AS table_name, COUNT(*) AS row_count FROM ({FACILITY_SQL})
UNION ALL SELECT 'bed', COUNT(*) FROM clean_bed
UNION ALL SELECT 'admission', COUNT(*) FROM ({ADMISSION_SQL})""",
    "period_years": CORE + "SELECT DISTINCT CAST(substr(period, 1, 4) AS INTEGER) AS year FROM bed",
    "missing_periods": CORE
    + EXPECTED
    + """
, landed AS (SELECT period, COUNT(*) AS n, COUNT(*) FILTER (WHERE region_code = '000007') AS r FROM facility GROUP BY ALL)
SELECT period, coalesce(n, 0) AS landed_rows, coalesce(r, 0) AS region_rows,
       CASE WHEN n IS NULL THEN 'missing' WHEN r = 0 THEN 'region empty' ELSE 'landed' END AS status
FROM expected LEFT JOIN landed USING (period)""",
    "collection_status": CORE
    + EXPECTED
    + f"""
, landed AS (SELECT {DIGITS} AS period,
               COUNT(*) FILTER (WHERE {DIGITS} > '199906' AND TRY_CAST(beds_total AS INTEGER) IS NULL) AS bad
             FROM raw_bed GROUP BY 1),
done AS (SELECT DISTINCT period, TRUE AS done FROM facility WHERE period < '199901')
SELECT CASE WHEN done THEN 'skipped' WHEN bad IS NULL THEN 'unavailable' WHEN bad > 0 THEN 'errors' ELSE 'ok' END
         AS status, COUNT(*) AS periods
FROM expected LEFT JOIN done USING (period) LEFT JOIN landed USING (period) GROUP BY ALL""",
}

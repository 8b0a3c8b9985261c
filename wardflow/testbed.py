"""Adapter from the driver's tables to the domain tables, and the same frames as a SQL head.

The frames are derived row by row from ``lineitem``, ``orders``, ``customer`` and ``supplier``, so
they grow with those tables. ``FIXTURES.md`` lists what they plant.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.functions.dates import period_of
from wardflow.plans.capacity import Warehouse
from wardflow.settings import Scope, Settings
from wardflow.sources import domains

SCOPE = Scope(date(1998, 1, 1), date(1999, 12, 31))
SETTINGS = Settings(scope=SCOPE)

# Several specialties share a bed type, so that a stay can change its specialty and keep its type.
BRIDGE = [("01", "1"), ("02", "1"), ("03", "2"), ("04", "2")]

#: Rows that one task makes out of the suppliers it holds.
MADE_PER_TASK = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str, each: int) -> DataFrame:
    """Rows over as many tasks as what is made of them needs, where every row is about to become ``each`` rows.

    A table of few megabytes is read by one task, and what is made of it would stay there; the number of rows comes from the
    footers. A table that one task can serve stays as it is.
    """
    tasks = -(-rows.count() * each // MADE_PER_TASK)
    return rows.repartition(tasks, key) if tasks > 1 else rows


def _padded(c, width: int):
    return F.lpad(c.cast("string"), width, "0")


def _scope_months():
    return F.sequence(F.lit(SCOPE.first_month), F.lit(SCOPE.last_month), F.expr("interval 1 month"))


def _month_index(day):
    return (F.year(day) - SCOPE.start.year) * 12 + F.month(day) - SCOPE.start.month


def admissions(
    spark: SparkSession, sf_dir: str, residence: bool = False, lineitem: DataFrame | None = None
) -> DataFrame:
    """Claims; ``residence`` needs two joins, so only the reports by residence ask for it."""
    li = lineitem or table(spark, sf_dir, "lineitem")
    if residence:
        homes = (
            table(spark, sf_dir, "orders")
            .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"), "left")
            .select(F.col("o_orderkey").alias("l_orderkey"), _padded(F.col("c_nationkey"), 6).alias("residence"))
        )
        li = li.join(homes, "l_orderkey", "left")
    quantity = F.col("l_quantity").cast("int")
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    admit = F.col("l_shipdate").cast("date")
    discharge = F.when(F.col("l_tax") >= 0.075, None).otherwise(F.date_add(admit, quantity - 3))
    billed_again = F.col("rebill") == 1
    columns = [
        _padded(F.col("l_suppkey"), 7).alias("facility_id"),
        F.col("l_orderkey").cast("string").alias("claim_id"),
        F.when(line == 7, None).otherwise(_padded(line, 2)).alias("specialty"),
        F.when(F.col("l_returnflag") == "R", "5").otherwise("1").alias("claim_kind"),
        admit.alias("admit_date"),
        F.when(~billed_again, discharge)
        .when(part % 40 == 0, None)
        .otherwise(F.date_add(discharge, 2))
        .alias("discharge_date"),
        F.when(F.col("l_discount") >= 0.085, None).otherwise(quantity).alias("billed_days"),
        F.when(F.col("l_discount") >= 0.095, None).otherwise(quantity + 1).alias("reported_days"),
        _padded(line, 3).alias("seq"),
        "l_partkey",
        (part % 100).cast("int").alias("age"),
        F.when(part % 7 == 0, None).when((part % 7).isin(1, 3), "1").otherwise("3").alias("sex"),
        F.when(part % 17 == 0, "1").otherwise("0").alias("died"),
        F.when(billed_again, period_of(F.date_add(admit, 31))).otherwise(period_of(admit)).alias("period"),
        "rebill",
    ]
    copies = F.when(part % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return li.withColumn("rebill", F.explode(copies)).select(*columns, *(["residence"] if residence else []))


def raw_admissions(claims: DataFrame) -> DataFrame:
    """Claims in the landed layout: everything text, ids and codes without zeros, dates unparsed."""
    number = F.col("facility_id").cast("long").cast("string")
    columns = {
        "UF_ZI": F.lit("26"),
        "ANO_CMPT": F.substring("period", 1, 4),
        "MES_CMPT": F.substring("period", 5, 2).cast("int").cast("string"),
        "ESPEC": F.col("specialty").cast("int").cast("string"),
        "CGC_HOSP": F.when(F.col("l_partkey") % 3 == 0, "").otherwise(F.col("l_partkey").cast("string")),
        "MUNIC_MOV": F.lit(" 261160 "),
        "QT_DIARIAS": F.col("billed_days").cast("string"),
        "DT_INTER": F.date_format("admit_date", "yyyyMMdd"),
        "DT_SAIDA": F.coalesce(F.date_format("discharge_date", "yyyyMMdd"), F.lit("00000000")),
        "DIAS_PERM": F.concat(F.col("reported_days").cast("string"), F.lit(".0")),
        "IDENT": F.concat(F.lit("\t"), "claim_kind"),
        "N_AIH": F.concat(F.lit(" "), "claim_id", F.lit(" ")),
        "CNES": F.concat(number, F.lit(".0")),
        "SEQUENCIA": F.col("seq"),
        "PROC_REA": F.col("l_partkey").cast("string"),
        "MUNIC_RES": F.lit(None).cast("string"),
        "IDADE": F.col("age").cast("string"),
        "SEXO": F.col("sex"),
        "MORTE": F.col("died"),
    }
    return claims.select(*[c.alias(n) for n, c in columns.items()])


def _bed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t, c = F.col("s_suppkey"), F.col("t"), F.col("c")
    load = (s * 7 + t * 3 + c) % 9
    return (
        spread(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey", 6 * len(SCOPE.periods))
        .select("s_suppkey", F.explode(_scope_months()).alias("month_start"))
        .withColumn("m_idx", _month_index("month_start"))
        .filter(((s % 11 != 0) | (F.col("m_idx") < 9)) & ((s + F.col("m_idx")) % 17 != 0))
        .withColumn("t", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .withColumn("c", F.explode(F.array(F.lit(1), F.lit(2))))
        .select(
            "s_suppkey",
            _padded(F.when(s % 19 == 5, s + 8000000).otherwise(s), 7).alias("facility_id"),
            t.cast("string").alias("bed_type"),
            _padded(t * 10 + c, 2).alias("bed_code"),
            period_of("month_start").alias("period"),
            F.when(s % 23 == 0, 0).when(s % 10 == 6, 2 - c).otherwise(load).cast("int").alias("beds_total"),
            F.when(s % 13 == 0, 0)
            .when(s % 10 == 6, 2 - c)
            .when(s % 7 == 0, load + 1)
            .otherwise(F.greatest(load - s % 4, F.lit(0)))
            .cast("int")
            .alias("beds_public"),
            F.when(s % 2 == 0, 1).when(s % 5 == 0, None).otherwise(0).alias("own_flag"),
        )
    )


def beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bed_rows(spark, sf_dir).drop("s_suppkey")


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, m = F.col("s_suppkey"), F.col("m_idx")
    return (
        spread(table(spark, sf_dir, "supplier"), "s_suppkey", len(SCOPE.periods))
        .select("*", F.explode(_scope_months()).alias("month_start"))
        .withColumn("m_idx", _month_index("month_start"))
        .filter((s % 9 != 4) & (m % 3 != 1))
        .withColumn("period", period_of("month_start"))
        .select(
            _padded(s, 7).alias("facility_id"),
            "period",
            F.when((s + m) % 5 == 0, None)
            .otherwise(F.concat("s_name", F.lit(" / "), "period"))
            .alias("facility_name"),
            F.when(s % 4 == 0, "M").when(s % 4 == 1, "E").when(s % 4 == 2, "D").otherwise("S").alias("owner_sphere"),
            _padded(F.col("s_nationkey"), 6).alias("region_code"),
            ((s * 5 + m) % 40).cast("int").alias("beds_total"),
            ((s * 5 + m) % 33).cast("int").alias("beds_public"),
        )
    )


def raw_beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = F.col("s_suppkey"), F.col("copy_no")
    plain = s.cast("string")
    copies = F.when(s % 6 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    dash = F.when(s % 2 == 0, "-").otherwise("")
    return (
        _bed_rows(spark, sf_dir)
        .withColumn("copy_no", F.explode(copies))
        .select(
            F.when(s % 3 == 0, F.concat(F.lit(" "), plain, F.lit(".0 ")))
            .when(s % 31 == 1, "   ")
            .otherwise(plain)
            .alias("cnes"),
            "bed_code",
            "bed_type",
            F.concat(F.substring("period", 1, 4), dash, F.substring("period", 5, 2)).alias("period"),
            F.when(s % 29 == 2, "n/d")
            .when((k == 1) & (s % 12 == 1), (F.col("beds_total") + 1).cast("string"))
            .otherwise(F.col("beds_total").cast("string"))
            .alias("beds_total"),
            F.col("beds_public").cast("string").alias("beds_public"),
            F.when(s % 5 == 0, "00000000000000")
            .otherwise(F.lpad((s % 2).cast("string"), 14, "1"))
            .alias("payer_id"),
            "copy_no",
        )
    )


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(
        beds=beds(spark, sf_dir),
        admissions=admissions(spark, sf_dir),
        facilities=facilities(spark, sf_dir),
        bed_types=domains.bed_types(spark),
        bridge=domains.literal_table(spark, BRIDGE, ("specialty", "bed_type")),
        specialties=domains.domain(spark, "specialty"),
    )

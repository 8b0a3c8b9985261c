"""From landed files to the three consolidated tables: discover, read, keep the region, type, write, report."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from wardflow.functions import text as tx
from wardflow.plans import load
from wardflow.schemas import RAW_ADMISSION, RAW_BED, RAW_FACILITY, REGION_CODE, REGION_NAME
from wardflow.sources import landed


@dataclass(frozen=True)
class TransformReport:
    """Rows read, and rows of the region that were written, after the table's own filters."""

    rows_before: int
    rows_after: int


def _write(rows: DataFrame, in_region: Column, make, path: str, what: str) -> TransformReport:
    """One pass: the region's rows are made and written, and both sides are counted on the way."""
    before, after = Observation(), Observation()
    kept = make(rows.observe(before, F.count("*").alias("n")).filter(in_region)).observe(after, F.count("*").alias("n"))
    kept.write.mode("overwrite").parquet(path)
    report = TransformReport(before.get["n"], after.get["n"])
    if report.rows_before and not report.rows_after:
        warnings.warn(f"{what}: none of {report.rows_before} rows is of the region", stacklevel=3)
    return report


def transform(
    spark: SparkSession,
    target: str,
    beds: list[list[str]] | None = None,
    admissions: list[list[str]] | None = None,
    facilities: DataFrame | None = None,
    region_code: str = REGION_CODE,
    region_name: str = REGION_NAME,
) -> dict[str, TransformReport]:
    """Writes ``<target>/bed``, ``/admission`` and ``/facility`` from what has landed, and reports rows before and after.

    Beds and claims are Parquet files, as layouts for :func:`landed.read_consolidated`, kept by municipality code; the
    registry is a frame of one of the readers, kept by the municipality's name or, where that is missing, its code. The
    written rows carry the file and row they come from, which the load needs.
    """
    reports = {}
    if beds is not None:
        rows = landed.read_consolidated(spark, beds, RAW_BED)
        reports["bed"] = _write(rows, tx.in_region_code("CODUFMUN", region_code), load.consolidate_beds, f"{target}/bed", "beds")
    if admissions is not None:
        rows = landed.read_consolidated(spark, admissions, RAW_ADMISSION)
        in_region = tx.in_region_code("MUNIC_MOV", region_code)
        reports["admission"] = _write(rows, in_region, load.consolidate_admissions, f"{target}/admission", "claims")
    if facilities is not None:
        rows = landed.strict_cast(facilities, RAW_FACILITY)
        named = tx.text("MUNICIPIO").isNotNull()
        in_region = F.when(named, tx.in_region_name("MUNICIPIO", region_name)).otherwise(tx.in_region_code("CO_IBGE", region_code))
        reports["facility"] = _write(rows, in_region, load.consolidate_facilities, f"{target}/facility", "facilities")
    return reports

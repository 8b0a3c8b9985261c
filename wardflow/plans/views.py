"""The reports as views for SQL users, over the stored monthly rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardflow.plans import capacity, dashboard, diagnosis, refresh, stay_length
from wardflow.plans.capacity import Warehouse
from wardflow.settings import Settings

#: Session variable that holds the month a reader looks at.
PERIOD = "report_period"


def reports(w: Warehouse, settings: Settings, rows: DataFrame) -> dict[str, DataFrame]:
    """The named reports; those by month keep the month as a column, so a filter on it reaches the scan."""
    return {
        "vw_installed_capacity": capacity.bed_capacity(w, settings),
        "vw_admissions": capacity.admissions_per_bed(w, settings, rows),
        "vw_length_of_stay": stay_length.length_of_stay(w, settings, rows),
        "vw_occupancy": capacity.occupancy_bands(w, settings, rows),
        "vw_diagnosis": diagnosis.facility_diagnosis(w, settings, rows),
        "vw_out_of_scope": diagnosis.out_of_scope_share(w, settings),
        "vw_network_kpis": dashboard.network_kpis(w, settings, rows),
    }


def register(spark: SparkSession, reports_folder: str, w: Warehouse, settings: Settings, period: str | None = None) -> list[str]:
    """Registers the reports as views of the session and declares the variable of the month; returns the names.

    ``SELECT * FROM vw_occupancy WHERE period = report_period`` reads the files of that month alone. The views show the
    months that are stored when they are registered.
    """
    made = reports(w, settings, refresh.stored(spark, reports_folder, w, settings))
    for name, report in made.items():
        report.createOrReplaceTempView(name)
    set_period(spark, period or settings.scope.periods[-1])
    return list(made)


def set_period(spark: SparkSession, period: str) -> None:
    """The month that ``report_period`` stands for."""
    if not (len(period) == 6 and period.isdigit()):
        raise ValueError(f"no month: {period!r}")
    spark.sql(f"DECLARE OR REPLACE VARIABLE {PERIOD} STRING DEFAULT '{period}'")

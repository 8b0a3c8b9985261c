"""From raw landed rows to warehouse tables: clean, check, de-duplicate, split off, upsert, publish."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from wardflow.functions import text as tx
from wardflow.operators import checks, dedup
from wardflow.operators.upsert import upsert
from wardflow.plans import store
from wardflow.schemas import (
    ADMISSION,
    BED,
    EMPTY_PAYER_ID,
    FACILITY,
    FACILITY_WIDTH,
    OWN_PAYER_ID,
    TableSpec,
)
from wardflow.sources import domains, landed

# --- raw files to consolidated tables ---------------------------------------------------------


def consolidate_beds(raw: DataFrame, own_payer: str = OWN_PAYER_ID, bed_types=("1", "2")) -> DataFrame:
    """Typed bed file: placeholders to null, ownership flag, only the wanted bed types."""
    payers = {c: tx.without_sentinels(c, EMPTY_PAYER_ID) for c in ("CPF_CNPJ", "CNPJ_MAN")}
    return (
        raw.withColumns(payers)
        .withColumn("own_flag", tx.equals_flag("CNPJ_MAN", own_payer).cast("long"))
        .filter(F.col("TP_LEITO").isin(*bed_types))
    )


def consolidate_admissions(raw: DataFrame) -> DataFrame:
    """Typed claim file: padded month and facility, dates from text, period from year and month."""
    return raw.withColumns(
        {
            "CGC_HOSP": tx.without_sentinels("CGC_HOSP", ""),
            "MES_CMPT": tx.zero_fill("MES_CMPT", 2),
            "CNES": tx.zero_fill("CNES", FACILITY_WIDTH),
            "DT_INTER": tx.day("DT_INTER"),
            "DT_SAIDA": tx.day("DT_SAIDA"),
        }
    ).withColumn("COMPETEN", F.concat("ANO_CMPT", "MES_CMPT"))


def consolidate_facilities(raw: DataFrame) -> DataFrame:
    return raw.withColumn("CNES", tx.zero_fill("CNES", FACILITY_WIDTH)).withColumnRenamed("COMP", "COMPETEN")


# --- consolidated tables to warehouse rows ----------------------------------------------------

#: Texts that are trimmed column by column, in generated code; an array of more is trimmed by functions that Spark interprets.
FEW_TEXTS = 4


def cleaned(raw: DataFrame, spec: TableSpec, carry: list[str] | None = None) -> DataFrame:
    """Warehouse columns of the raw rows that have a complete key; ``carry`` columns come along.

    Whether a text is missing is told by the raw rows: Spark would move a condition on cleaned columns below the cleaning
    and clean every row of it once more.
    """
    keys = [f for f in spec.fields if f.name in spec.key]
    texts = [f for f in keys if f.kind not in ("integer", "date")]
    whole = raw.filter(reduce(lambda a, b: a & b, [tx.has_text(f.source) for f in texts], F.lit(True)))
    others = [f.name for f in keys if f not in texts]
    return checks.drop_null_keys(typed(whole, spec, carry), others) if others else typed(whole, spec, carry)


def typed(raw: DataFrame, spec: TableSpec, carry: list[str] | None = None, checked: bool = False) -> DataFrame:
    """Warehouse columns of the raw rows; ``checked`` adds the columns that :func:`checks.typed_marks` counts.

    Cleaning goes in steps, each reading the columns of the one before, so that no expression is
    evaluated once per mention of its result.
    """
    types = dict(raw.dtypes)
    dates = [f for f in spec.fields_of("date")]
    texts = [f for f in spec.fields if f.kind != "date"]

    def date(f):
        return F.col(f.source) if types[f.source] == "date" else tx.day(f.source, "yyyy-MM-dd")

    if len(texts) <= FEW_TEXTS:
        trimmed = [tx.bare(f.source).alias(f"_bare_{f.name}") for f in texts]
        at = {f.name: tx.text_of_bare(f"_bare_{f.name}") for f in texts}
    else:
        # One expression trims all texts: the same few steps per value, instead of generated code that grows with the columns
        # until the JVM no longer compiles it.
        trimmed = [tx.texts([F.col(f.source) for f in texts]).alias("_texts")]
        at = {f.name: F.col("_texts")[k] for k, f in enumerate(texts)}
    rows = raw.select(*trimmed, *[date(f).alias(f.name) for f in dates], *(carry or []))
    if len(texts) <= FEW_TEXTS:
        rows = rows.withColumns({f"_bare_{f.name}": tx.nearly_bare(f"_bare_{f.name}") for f in texts})
    rows = rows.select(*[at.get(f.name, F.col(f.name)).alias(f.name) for f in spec.fields], *(carry or []))
    steps = {
        "code": {f.name: tx.without_fraction(f.name) for f in spec.fields_of("code")},
        "width": {f.name: tx.zero_fill(f.name, f.width) for f in spec.fields if f.width},
        "period": {f.name: tx.digits(f.name) for f in spec.fields_of("period")},
        "integer": {f.name: tx.whole(f.name) for f in spec.fields_of("integer")},
    }
    numbers = spec.fields_of("integer") if checked else []
    steps["integer"] |= {f"_text_{f.name}": F.col(f.name) for f in numbers}
    for step in steps.values():
        rows = rows.withColumns(step)
    bad = {f"_bad_{f.name}": tx.lost_number(F.col(f"_text_{f.name}"), F.col(f.name)) for f in numbers}
    return rows.withColumns(bad).drop(*[f"_text_{f.name}" for f in numbers]) if bad else rows


def _order(raw: DataFrame, order: list[str] | None) -> list[str]:
    """Columns that tell which row came last; without them the choice would fall to other columns unnoticed."""
    order = order if order is not None else [landed.FILE, landed.ROW]
    missing = [c for c in order if c not in raw.columns]
    if missing:
        raise ValueError(f"rows need their position {missing}; readers of landed files add it")
    return order


def _last_facility(rows: DataFrame, spec: TableSpec, order: list[str]) -> DataFrame:
    return dedup.keep_last(rows, list(spec.key), order).select(*spec.columns)


def _merged_beds(rows: DataFrame, spec: TableSpec, order: list[str]) -> DataFrame:
    firsts = [c for c in ("bed_type", "own_flag") if c in spec.columns]
    at = rows.withColumn("_at", F.struct(*order))
    return dedup.merged_repeats(at, list(spec.key), BED_SUMS, firsts, "_at").select(*spec.columns, "_rows")


def _last_claim(rows: DataFrame, spec: TableSpec, order: list[str]) -> DataFrame:
    return dedup.keep_last(rows, list(spec.key), ["seq", *order]).select(*spec.columns)


def prepare_facilities(raw: DataFrame, spec: TableSpec = FACILITY, order: list[str] | None = None) -> DataFrame:
    """Dimension: the last row in file order per key."""
    order = _order(raw, order)
    return _last_facility(cleaned(raw, spec, order), spec, order)


def prepare_beds(raw: DataFrame, spec: TableSpec = BED, order: list[str] | None = None) -> DataFrame:
    """Bed fact: exact copies dropped, quantities of remaining repeats added up."""
    order = _order(raw, order)
    merged = _merged_beds(cleaned(raw, spec, order), spec, order)
    repeats = merged.agg(F.coalesce(F.max("_rows") > 1, F.lit(False))).scalar()
    return dedup.with_quantities(merged, BED_SUMS, repeats).select(*spec.columns)


def prepare_admissions(raw: DataFrame, spec: TableSpec = ADMISSION, order: list[str] | None = None) -> DataFrame:
    """Claim fact: the greatest sequence (as text) per key; the file order decides between equal ones, if it is there."""
    order = order if order is not None else [c for c in (landed.FILE, landed.ROW) if c in raw.columns]
    return _last_claim(cleaned(raw, spec, order), spec, order)


BED_SUMS = ["beds_total", "beds_public"]
REDUCE = {"facility": _last_facility, "bed": _merged_beds, "admission": _last_claim}
SPECS = {"facility": FACILITY, "bed": BED, "admission": ADMISSION}


def without_orphans(rows: DataFrame, spec: TableSpec, known: dict[str, DataFrame]):
    """(accepted rows, {column: rejected rows}); columns are checked one after the other."""
    rejects = {}
    for column in spec.domains:
        rows, rejects[column] = checks.split_orphans(rows, column, known[column])
    return rows, rejects


# --- loading ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableReport:
    """What became of the rows of one table: read = null_keys + repeated + rejected + accepted."""

    read: int
    null_keys: int
    repeated: int
    rejected: dict[str, int]
    accepted: int
    top_rejects: dict[str, list[tuple[str, int]]]


@dataclass(frozen=True)
class LoadReport:
    """Reports per table, and rows per table in the warehouse after the load."""

    run: str
    tables: dict[str, TableReport]
    stored: dict[str, int]

    @property
    def accepted(self) -> dict[str, int]:
        return {name: t.accepted for name, t in self.tables.items()}

    @property
    def rejected(self) -> dict[str, int]:
        return {name: sum(t.rejected.values()) for name, t in self.tables.items()}


REJECT = "_reject"


def marked(rows: DataFrame, spec: TableSpec, known: dict[str, DataFrame]) -> DataFrame:
    """Rows with the first column whose code is outside its domain, null for accepted rows; domains are small tables."""
    reasons = []
    for column in spec.domains:
        codes = known[column].select(column).distinct().withColumn(f"_known_{column}", F.lit(True))
        rows = rows.join(codes, column, "left")
        reasons.append(F.when(F.col(column).isNotNull() & F.col(f"_known_{column}").isNull(), F.lit(column)))
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    return rows.withColumn(REJECT, reason).drop(*[f"_known_{c}" for c in spec.domains])


def _stage_table(spark, raw, spec, staging, known):
    """Cleans, checks, reduces and marks one table's rows in a single pass and write.

    Counts and examples come from the same pass. Returns the staged rows and the report.
    """
    checks.require_columns(raw, [f.source for f in spec.fields], spec.name)
    order = [c for c in (landed.FILE, landed.ROW) if c in raw.columns] if spec.name == "admission" else _order(raw, None)
    before, after = Observation(), Observation()
    landed_as = {f"_raw_{f.name}": F.col(f.source).cast("string") for f in spec.fields_of("period")}
    rows = typed(raw.withColumns(landed_as), spec, [*order, *landed_as], checked=True)
    # Marks of the cleaned columns: those of the raw ones would clean them again, in one method too large for the JVM to compile.
    rows = rows.observe(before, *checks.typed_marks(spec)).select(*spec.columns, *order)
    reduced = marked(REDUCE[spec.name](checks.drop_null_keys(rows, list(spec.key)), spec, order), spec, known)
    counts = [F.count_if(F.col(REJECT) == c).alias(f"r_{c}") for c in spec.domains]
    largest = [F.max("_rows").alias("most")] if "_rows" in reduced.columns else []
    reduced = reduced.observe(after, F.count("*").alias("rows"), *counts, *largest, *checks.length_marks(spec.limits))
    path = f"{staging}/{spec.name}"
    reduced.write.mode("overwrite").parquet(path)
    checks.raise_for_raw(before.get, spec)
    checks.raise_for_lengths(after.get, spec.limits, spec.name)
    staged = spark.read.schema(reduced.schema).parquet(path)
    if largest:
        staged = dedup.with_quantities(staged, BED_SUMS, F.lit((after.get["most"] or 0) > 1)).drop("_rows")
    rejected = {c: after.get[f"r_{c}"] for c in spec.domains}
    top = {
        c: [(r[0], r[1]) for r in checks.orphan_summary(staged.filter(F.col(REJECT) == c), c).collect()]
        for c, n in rejected.items()
        if n
    }
    read, null_keys, left = before.get["rows_read"], before.get["null_keys"], after.get["rows"]
    report = TableReport(read, null_keys, read - null_keys - left, rejected, left - sum(rejected.values()), top)
    return staged, report


def stored_domains(spark: SparkSession) -> dict[str, DataFrame]:
    return {column: domains.domain(spark, column) for column in domains.DOMAINS}


def load(
    spark: SparkSession, inputs: dict[str, DataFrame], warehouse: str, dry_run: bool = False, run: str | None = None
) -> LoadReport:
    """Upsert consolidated tables into the warehouse, all or nothing.

    Every table is cleaned, checked and staged first; only when all of them passed are rejects written, to a folder of
    this run, and the months of the batch merged into new files. Replacing the pointer file then publishes all tables at
    once, so a failure before leaves the warehouse as it was. A run of the same name replaces its own files and rejects;
    loading rows again has no effect. ``dry_run`` stops after the checks and writes nothing but its report.
    """
    run = run or uuid.uuid4().hex
    known, staging = stored_domains(spark), f"{warehouse}/_staging/{run}"
    seen = store.current(spark, warehouse)
    staged, reports = {}, {}
    for name, spec in SPECS.items():
        if name in inputs:
            staged[name], reports[name] = _stage_table(spark, inputs[name], spec, staging, known)
    if not dry_run:
        changes = {}
        for name, rows in staged.items():
            spec, rejected = SPECS[name], reports[name].rejected
            if any(rejected.values()):
                landed.write_rejects(rows.filter(F.col(REJECT).isNotNull()), f"{warehouse}/_rejects", run, name, REJECT)
            batch = rows.filter(F.col(REJECT).isNull()).drop(REJECT)
            # The key holds the period, so only the batch's months can change; there are few of them.
            months = [r.period for r in batch.select("period").distinct().collect()]
            held = store.read(spark, warehouse, name, spec.schema, months, seen)
            merged = batch if held is None else upsert(held.select(*spec.columns), batch, list(spec.key))
            changes[name] = store.write(merged.select(*spec.columns), warehouse, name, run, months)
        store.switch(spark, warehouse, changes, seen)
    if staged:
        store.discard(spark, staging)
    published = store.current(spark, warehouse)
    return LoadReport(run, reports, {n: sum(m["rows"] for m in published.get(n, {}).values()) for n in SPECS})


def load_summary(raw: dict[str, tuple[DataFrame, TableSpec]]) -> DataFrame:
    """Rows per table that a load of these raw rows stores, before rejects: one for each complete key.

    Only the key columns are cleaned and counted, as every table keeps one row of a key. Incomplete keys are left out where the
    keys are counted: a filter would move down to the raw rows and make their columns a second time. What a warehouse holds is
    told by :func:`wardflow.plans.store.summary` without reading rows.
    """
    counts = []
    for name, (rows, spec) in raw.items():
        keys = replace(spec, fields=tuple(f for f in spec.fields if f.name in spec.key))
        distinct = typed(rows, keys).select(*spec.key).distinct()
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in spec.key])
        counts.append(distinct.agg(F.count_if(complete).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count"))
    return reduce(DataFrame.unionByName, counts)

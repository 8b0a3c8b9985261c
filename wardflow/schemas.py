"""Row layouts of landed files and warehouse tables, and how one becomes the other."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Placeholder ids, the payer id that marks own management, and the region kept.
EMPTY_PAYER_ID = "00000000000000"
OWN_PAYER_ID = "10565000000192"
REGION_CODE = "261160"
REGION_NAME = "RECIFE"
REGION_WIDTH = 6
FACILITY_WIDTH = 7


@dataclass(frozen=True)
class Field:
    """One warehouse column: where it comes from, how it is cleaned and how long it may be."""

    name: str
    source: str
    kind: str
    width: int | None = None
    limit: int | None = None

    @property
    def type(self) -> T.DataType:
        return {"integer": T.IntegerType(), "date": T.DateType()}.get(self.kind, T.StringType())


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]
    domains: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def limits(self) -> dict[str, int]:
        return {f.name: f.limit for f in self.fields if f.limit}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type) for f in self.fields])

    def fields_of(self, kind: str) -> list[Field]:
        return [f for f in self.fields if f.kind == kind]

    def from_columns(self, **sources: str) -> "TableSpec":
        """Same table fed from other source names; columns not named are left out."""
        return replace(
            self, fields=tuple(replace(f, source=sources[f.name]) for f in self.fields if f.name in sources)
        )


FACILITY = TableSpec(
    "facility",
    ("facility_id", "period"),
    (
        Field("facility_id", "CNES", "code", FACILITY_WIDTH),
        Field("period", "COMPETEN", "period"),
        Field("facility_name", "NOME_ESTABELECIMENTO", "text", limit=200),
        Field("legal_name", "RAZAO_SOCIAL", "text", limit=200),
        Field("owner_sphere", "TP_GESTAO", "text", limit=1),
        Field("region_code", "CO_IBGE", "code", limit=7),
        Field("municipality", "MUNICIPIO", "text", limit=100),
        Field("beds_total", "LEITOS_EXISTENTES", "integer"),
        Field("beds_public", "LEITOS_SUS", "integer"),
    ),
)

BED = TableSpec(
    "bed",
    ("facility_id", "bed_code", "period"),
    (
        Field("facility_id", "CNES", "code", FACILITY_WIDTH, 7),
        Field("bed_code", "CODLEITO", "code", 2, 2),
        Field("bed_type", "TP_LEITO", "code", limit=2),
        Field("period", "COMPETEN", "period"),
        Field("beds_total", "QT_EXIST", "integer"),
        Field("beds_public", "QT_SUS", "integer"),
        Field("own_flag", "own_flag", "integer"),
    ),
    domains=("bed_code", "bed_type"),
)

ADMISSION = TableSpec(
    "admission",
    ("claim_id", "period", "claim_kind"),
    (
        Field("claim_id", "N_AIH", "text", limit=20),
        Field("period", "COMPETEN", "period"),
        Field("facility_id", "CNES", "code", FACILITY_WIDTH, 7),
        Field("payer_audit_id", "CGC_HOSP", "text", limit=14),
        Field("specialty", "ESPEC", "code", 2, 2),
        Field("claim_kind", "IDENT", "code", limit=1),
        Field("seq", "SEQUENCIA", "text", limit=5),
        Field("admit_date", "DT_INTER", "date"),
        Field("discharge_date", "DT_SAIDA", "date"),
        Field("reported_days", "DIAS_PERM", "integer"),
        Field("billed_days", "QT_DIARIAS", "integer"),
        Field("procedure", "PROC_REA", "text", limit=10),
        Field("residence", "MUNIC_RES", "text", limit=7),
        Field("place", "MUNIC_MOV", "text", limit=7),
        Field("state_zone", "UF_ZI", "text", limit=7),
        Field("age", "IDADE", "integer"),
        Field("sex", "SEXO", "text", limit=1),
        Field("died", "MORTE", "text", limit=1),
    ),
    domains=("specialty", "claim_kind"),
)


# Columns and types taken from each landed source.
RAW_BED = T.StructType(
    [
        T.StructField("COMPETEN", T.StringType()),
        T.StructField("CNES", T.StringType()),
        T.StructField("CPF_CNPJ", T.StringType()),
        T.StructField("CODUFMUN", T.StringType()),
        T.StructField("TP_LEITO", T.StringType()),
        T.StructField("CODLEITO", T.StringType()),
        T.StructField("CNPJ_MAN", T.StringType()),
        T.StructField("QT_EXIST", T.LongType()),
        T.StructField("QT_SUS", T.LongType()),
        T.StructField("NAT_JUR", T.LongType()),
    ]
)
RAW_ADMISSION = T.StructType(
    [
        T.StructField("UF_ZI", T.StringType()),
        T.StructField("ANO_CMPT", T.StringType()),
        T.StructField("MES_CMPT", T.StringType()),
        T.StructField("ESPEC", T.StringType()),
        T.StructField("CGC_HOSP", T.StringType()),
        T.StructField("MUNIC_MOV", T.StringType()),
        T.StructField("DT_INTER", T.StringType()),
        T.StructField("DT_SAIDA", T.StringType()),
        T.StructField("IDENT", T.StringType()),
        T.StructField("N_AIH", T.StringType()),
        T.StructField("CNES", T.StringType()),
        T.StructField("SEQUENCIA", T.StringType()),
        T.StructField("PROC_REA", T.StringType()),
        T.StructField("MUNIC_RES", T.StringType()),
        T.StructField("SEXO", T.StringType()),
        T.StructField("MORTE", T.StringType()),
        T.StructField("QT_DIARIAS", T.LongType()),
        T.StructField("DIAS_PERM", T.LongType()),
        T.StructField("IDADE", T.LongType()),
    ]
)
RAW_FACILITY = T.StructType(
    [
        T.StructField("COMP", T.StringType()),
        T.StructField("CO_IBGE", T.StringType()),
        T.StructField("MUNICIPIO", T.StringType()),
        T.StructField("CNES", T.StringType()),
        T.StructField("NOME_ESTABELECIMENTO", T.StringType()),
        T.StructField("RAZAO_SOCIAL", T.StringType()),
        T.StructField("TP_GESTAO", T.StringType()),
        T.StructField("LEITOS_EXISTENTES", T.LongType()),
        T.StructField("LEITOS_SUS", T.LongType()),
    ]
)

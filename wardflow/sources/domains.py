"""Domain tables: fixed lists seeded with the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The seeded domains, code and description.
BED_TYPES = [
    ("1", "Cirúrgico"),
    ("2", "Clínico"),
    ("3", "Complementar"),
    ("4", "Obstétricos"),
    ("5", "Pediátricos"),
    ("6", "Outras Especialidades"),
    ("7", "Hospital Dia"),
]
CLAIM_KINDS = [
    ("1", "AIH Normal"),
    ("5", "AIH de Longa Permanencia e FTP"),
]
SPECIALTIES = [
    ("01", "Cirurgia geral"),
    ("02", "Obstetrícia"),
    ("03", "Clínica médica"),
    ("04", "Crônico e FPT"),
    ("05", "Psiquiatria"),
    ("06", "Tisiologia"),
    ("07", "Pediatria"),
    ("08", "Reabilitação"),
    ("09", "Psiquiatria - hospital/dia"),
    ("10", "Fora do domínio original 01-09 - revisar"),
    ("12", "Fora do domínio original 01-09 - revisar"),
    ("87", "Fora do domínio original 01-09 - revisar"),
]
SPECIALTY_TO_BED_TYPE = [
    ("01", "1"),
    ("03", "2"),
]
BED_CODES = [
    ("01", "Buco Maxilo Facial"),
    ("02", "Cardiologia"),
    ("03", "Cirurgia Geral"),
    ("04", "Endocrinologia"),
    ("05", "Gastroenterologia"),
    ("06", "Ginecologia"),
    ("07", "Cirúrgico/Diagnóstico/Terapêutico"),
    ("08", "Nefrologia/Urologia"),
    ("09", "Neurocirurgia"),
    ("10", "Obstetricia Cirurgica"),
    ("11", "Oftalmologia"),
    ("12", "Oncologia"),
    ("13", "Ortopedia/Traumatologia"),
    ("14", "Otorrinolaringologia"),
    ("15", "Plastica"),
    ("16", "Toracica"),
    ("31", "Aids"),
    ("32", "Cardiologia"),
    ("33", "Clinica Geral"),
    ("34", "Cronicos"),
    ("35", "Dermatologia"),
    ("36", "Geriatria"),
    ("37", "Hansenologia"),
    ("38", "Hematologia"),
    ("40", "Nefrourologia"),
    ("41", "Neonatologia"),
    ("42", "Neurologia"),
    ("43", "Obstetricia Clinica"),
    ("44", "Oncologia"),
    ("45", "Pediatria Clinica"),
    ("46", "Pneumologia"),
    ("47", "Psiquiatria"),
    ("48", "Reabilitacao"),
    ("49", "Pneumologia Sanitaria"),
    ("64", "Unidade Intermediaria"),
    ("65", "Unidade Intermediaria Neonatal"),
    ("66", "Unidade Isolamento"),
    ("67", "Transplante"),
    ("68", "Pediatria Cirurgica"),
    ("69", "Aids"),
    ("70", "Fibrose Cistica"),
    ("71", "Intercorrencia Pos-Transplante"),
    ("72", "Geriatria"),
    ("73", "Saude Mental"),
    ("74", "Uti Adulto - Tipo I"),
    ("75", "Uti Adulto - Tipo Ii"),
    ("76", "Uti Adulto - Tipo Iii"),
    ("77", "Uti Pediatrica - Tipo I"),
    ("78", "Uti Pediatrica - Tipo Ii"),
    ("79", "Uti Pediatrica - Tipo Iii"),
    ("80", "Uti Neonatal - Tipo I"),
    ("81", "Uti Neonatal - Tipo Ii"),
    ("82", "Uti Neonatal - Tipo Iii"),
    ("83", "Uti De Queimados"),
    ("84", "Acolhimento Noturno"),
    ("85", "Uti Coronariana Tipo Ii - Uco Tipo Ii"),
    ("86", "Uti Coronariana Tipo Iii - Uco Tipo Iii"),
    ("87", "Saude Mental"),
    ("88", "Queimado Adulto"),
    ("89", "Queimado Pediatrico"),
    ("90", "Queimado Adulto"),
    ("91", "Queimado Pediatrico"),
    ("92", "Unidade De Cuidados Intermediarios Neonatal Convencional"),
    ("93", "Unidade De Cuidados Intermediarios Neonatal Canguru"),
    ("94", "Unidade De Cuidados Intermediarios Pediatrico"),
    ("95", "Unidade De Cuidados Intermediarios Adulto"),
]

DOMAINS = {
    "bed_type": (BED_TYPES, "category"),
    "bed_code": (BED_CODES, "description"),
    "specialty": (SPECIALTIES, "description"),
    "claim_kind": (CLAIM_KINDS, "description"),
}


def literal_rows(rows: list[tuple[str, str]], columns: tuple[str, str]) -> str:
    """The rows as a ``VALUES`` relation, readable by Spark SQL."""
    quoted = ", ".join("('{}', '{}')".format(*(v.replace("'", "\\'") for v in row)) for row in rows)
    return f"VALUES {quoted} AS t({', '.join(columns)})"


def literal_table(spark: SparkSession, rows: list[tuple[str, str]], columns: tuple[str, str]) -> DataFrame:
    """A local relation: its few rows are known to the optimizer, which broadcasts it by itself."""
    return spark.sql(f"SELECT * FROM {literal_rows(rows, columns)}")


def domain(spark: SparkSession, column: str) -> DataFrame:
    rows, label = DOMAINS[column]
    return literal_table(spark, rows, (column, label))


def bed_types(spark: SparkSession) -> DataFrame:
    return domain(spark, "bed_type")


def specialty_bridge(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SPECIALTY_TO_BED_TYPE, ("specialty", "bed_type"))

"""Load preparation: what each entity's table looks like when it is sent to its target."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulario.functions.dates import parse_date
from aulario.functions.numbers import to_number
from aulario.functions.text import centre_from_file, null_tokens
from aulario.operators.schema import add_suffix, api_names, drop_if_present, rename_synonyms

LOAD_NULLS = ("nan", "None", "NaT")


@dataclass(frozen=True)
class LoadSpec:
    """How one entity is prepared.

    ``rule_names`` derives field names from form questions; ``overrides`` are its exceptions.
    ``names`` renames single columns, ``synonyms`` merges alternative headings, ``merged`` those that match a
    pattern, and every remaining column gets the suffix. ``only`` limits the result to the named fields.
    """

    dates: Sequence[str] = ()
    numbers: Sequence[str] = ()
    number_pattern: str | None = None
    drop: Sequence[str] = ()
    keep_year_tag: bool = True
    year_tag: str = "ANIO_FUENTE"
    synonyms: Mapping[str, Sequence[str]] = field(default_factory=dict)
    names: Mapping[str, str] = field(default_factory=dict)
    rule_names: bool = False
    overrides: Mapping[str, str] = field(default_factory=dict)
    merged: Mapping[str, str] = field(default_factory=dict)
    all_text: bool = False
    clean_centre: Sequence[str] = ()
    only: Sequence[str] = ()


# Fields of the target objects and the columns they come from.
SPECS: dict[str, LoadSpec] = {
    "regular_attendance": LoadSpec(
        dates=("F_INCORPORACION", "F_SALIDA", "FECHA"), numbers=("A_ESPERADAS", "A_REALES", "PORC_PART")
    ),
    "extracurricular_attendance": LoadSpec(
        dates=("F_INCORPORACION", "F_SALIDA", "FECHA"),
        numbers=("A_ESPERADAS", "A_REALES", "PORC_PART"),
        clean_centre=(" REGISTRO DE ASISTENCIA 2025.xlsx", " REGISTRO DE ASISTENCIA 2026.xlsx"),
    ),
    "enrolment": LoadSpec(
        dates=("FECHA DE REGISTRO",),
        numbers=("N DE DOC. PRESENTADOS",),
        keep_year_tag=False,
        drop=(
            "N.1", "DNI.1", "APELLIDOS Y NOMBRES.1", "GRADO.1", "SEXO.1", "CENTRO.1", "PERIODO DE INGRESO.1",
            "NUMERO TELEFONICO.1", "FECHA DE REGISTRO.1", "RESPONSABLE DE REGISTRO.1", "CONDICION ACTUAL.1",
            "DOCUMENTO EN SHAREPOINT.1", "FOTO DEL NINO (A).1",
            "COPIA DNI/ CARNET DE EXTRANJERIA DEL MENOR .1", "COPIA DNI/ MADRE O APODERADO.1",
            "RECIBO DE SERVICIOS (LUZ O AGUA).1", "BOLETA DE NOTAS.1", "CARTA COMPROMISO.1",
            "ACUERDO DE IMAGEN.1", "FICHA SOCIAL .1", "SOLICITUD DE MATRICULA .1",
            "RENOVACION DE MATRICULA.1", "N DE DOC. PRESENTADOS.1", "ESTADO FINAL MATRICULA.1",
        ),
        rule_names=True,
        overrides={"DNI DEL NINO": "DNI DEL NINO__c"},
    ),
    "grades": LoadSpec(year_tag="ANIO_FUENTE__c"),
    "parent_survey": LoadSpec(
        dates=("Marca temporal",),
        number_pattern=r"^¿Cuántos hijos tienes en el Programa",
        keep_year_tag=False,
        rule_names=True,
        overrides={
            "Documento de identidad Apoderado": "Documento_de_identidad__c",
            "Documento de identidad Niño": "Documento_de_identidad_1__c",
            "N Documento Apoderado": "N_de_documento__c",
            "N Documento Niño": "N_de_documento_1__c",
        },
        # The question asked a second time, under either of the headings that readers give it.
        merged={
            "Considero_que_la_cantidad_de_das_que_m_1__c": r"^Considero que la cantidad de días que mi\(s\) hijo\(s\).*(\.1|\s2)$",
        },
    ),
    "social_record": LoadSpec(
        dates=("Marca temporal", "Fecha de nacimiento", "Fecha de nacimiento.1"),
        drop=(
            "Apellido materno.1", "Nombre/s del apoderado 1 del niño/a", "Apellido paterno.2",
            "Apellido paterno.1", "Apellido materno.2",
        ),
        rule_names=True,
        all_text=True,
        overrides={
            "Apellido Materno.1": "Apellido_materno_1__c",
            "Apellido paterno": "Apellido_paterno_1__c",
            "Apellido materno": "Apellido_Materno1__c",
            "Dirección Completa": "Direccin_Completa_1__c",
        },
    ),
    "curriculum_progress": LoadSpec(
        synonyms={
            "TEMAS__c": ("TEMA", "TEMAS"),
            "AREA__c": ("AREA", "AREAS"),
            "GRADOS__c": ("GRADO", "GRADOS"),
        },
        names={
            "N DE PAGINAS": "N_DE_PAGINAS__c",
            "RECURSO Y/O ESTRATREGIA": "RECURSO_Y_O_ESTRATEGIA__c",
        },
    ),
    "enrolment_request": LoadSpec(
        dates=("Fecha de nacimiento", "Marca temporal"),
        numbers=("EDAD",),
        drop=("Nombre/s del niño/a", "Departamento.1"),
        rule_names=True,
        overrides={"Nombre/S Del Niño/A": "Nombres_del_nioa__c", "Distrito.1": "Distrito_1__c"},
    ),
    "timetable_hours": LoadSpec(),
    "experiential_attendance": LoadSpec(
        dates=("FECHA",),
        numbers=("ASISTENCIAS PROGRAMADAS", "ASISTENCIAS REALES", "% PART."),
        rule_names=True,
    ),
    "skills": LoadSpec(
        only=(
            "DNI__c", "Apellidos_y_nombres__c", "Grado__c", "Sexo__c", "Centro__c", "Permanencia__c",
            "Condicin_actual__c", "Habilidades__c", "Nivel_de_logro__c", "Evaluacion__c",
        ),
    ),
}


def prepare_load(df: DataFrame, entity: str, spec: LoadSpec | None = None) -> DataFrame:
    """Typed dates as ISO text, numbers coerced, null words removed, target field names.

    Columns named in a spec but absent from the data are passed over.
    """
    spec = spec or SPECS[entity]
    df = drop_if_present(df, spec.drop)
    if not spec.keep_year_tag:
        df = drop_if_present(df, [spec.year_tag])
    types = dict(df.dtypes)
    columns = []
    for c in df.columns:
        value = F.col(f"`{c}`")
        if c in spec.dates:
            # A date's own text is the ISO form; only its formatter would go through a timestamp of the session's zone.
            value = (parse_date(value) if types[c] == "string" else value.cast("date")).cast("string")
        elif c in spec.numbers or (spec.number_pattern and re.search(spec.number_pattern, c)):
            # What is a double already need not be written out and read again.
            value = value if types[c] == "double" else to_number(value)
        elif spec.all_text:
            value = null_tokens(value.cast("string"), LOAD_NULLS)
        elif spec.clean_centre and c == "CENTRO":
            value = null_tokens(centre_from_file(value, "", spec.clean_centre, underscores=True), LOAD_NULLS)
        elif types[c] in ("double", "float"):
            value = F.nanvl(value, F.lit(None).cast("double"))
        columns.append(value.alias(c))
    df = df.select(*columns)
    df = rename_synonyms(df, spec.synonyms)
    matching = {target: [c for c in df.columns if re.search(pattern, c)] for target, pattern in spec.merged.items()}
    df = rename_synonyms(df, matching)
    if spec.rule_names:
        names = api_names(df.columns, overrides=spec.overrides)
        df = df.toDF(*[names[c] for c in df.columns])
    df = df.toDF(*[spec.names.get(c, c) for c in df.columns])
    if spec.only:
        return df.select(*spec.only)
    return add_suffix(df)

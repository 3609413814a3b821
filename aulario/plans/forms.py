"""Form tables: parent survey, social record, enrolment request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulario.functions.dates import age_years, parse_date, parse_timestamp
from aulario.functions.ids import document_id
from aulario.functions.text import keyword_category, norm_text, null_tokens, strip
from aulario.operators.dedup import latest_keep_null_keys, latest_per_key
from aulario.plans import constants as K


def _named(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`")


def _stamp(df: DataFrame) -> Column:
    c = _named(df, K.STAMP)
    return parse_timestamp(c) if dict(df.dtypes)[K.STAMP] == "string" else c.cast("timestamp_ntz")


def _date(df: DataFrame, name: str) -> Column:
    c = _named(df, name)
    return parse_date(c) if dict(df.dtypes)[name] == "string" else c.cast("date")


def _null_words(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Null words removed from cleaned text columns.

    A step of its own: the test and the result both need the cleaned text, which would
    otherwise be computed twice.
    """
    return df.select(
        *[(null_tokens(_named(df, c), K.UPPER_NULLS) if c in names else _named(df, c)).alias(c) for c in df.columns]
    )


def _latest(df: DataFrame, key: str, keep_null_keys: bool, tiebreak: Sequence[str] | None) -> DataFrame:
    # Titles such as ``Número de Documento.1`` would be read as nested fields.
    plain = [f"c{i}" for i in range(len(df.columns))]
    position = dict(zip(df.columns, plain))
    narrow = df.toDF(*plain)
    ties = [position[c] for c in tiebreak] if tiebreak else ["_tie"]
    if not tiebreak:
        # A content hash decides between answers with the same timestamp.
        narrow = narrow.withColumn("_tie", F.xxhash64(*plain))
    pick = latest_keep_null_keys if keep_null_keys else latest_per_key
    return pick(narrow, position[key], position[K.STAMP], ties).select(*plain).toDF(*df.columns)


def parent_survey(df: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Latest answer per guardian; answers without an id count as one guardian.

    ISO timestamps are read as ISO (year first), other text day first. Equal timestamps are
    decided by the ``tiebreak`` columns, or by content, never by row order.
    """
    df = df.toDF(*[K.SURVEY_RENAMES.get(c, c) for c in df.columns])
    types = dict(df.dtypes)
    columns, texts = [], []
    for c in df.columns:
        value = _named(df, c)
        if c == K.SURVEY_KEY:
            value = document_id(value.cast("string"), K.ID_NULLS)
        elif c == K.STAMP:
            value = _stamp(df)
        elif types[c] == "string":
            value = norm_text(value)
            texts.append(c)
        columns.append(value.alias(c))
    latest = _latest(_null_words(df.select(*columns), texts), K.SURVEY_KEY, keep_null_keys=False, tiebreak=tiebreak)
    return latest.withColumn(K.STAMP, F.col(f"`{K.STAMP}`").cast("date"))


def number_repeated_columns(names: Sequence[str]) -> list[str]:
    """Repeated titles of a form become ``X``, ``X_v1``, ``X_v2``."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        n = seen.get(name, -1) + 1
        seen[name] = n
        out.append(name if n == 0 else f"{name}_v{n}")
    return out


def social_record(df: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Latest answer per child; answers without an id count as one child."""
    df = df.toDF(*number_repeated_columns(df.columns))
    columns = []
    for c in df.columns:
        value = _named(df, c)
        if c == K.SOCIAL_KEY:
            value = F.regexp_replace(value.cast("string"), r"\.0$", "")
        elif c == K.STAMP:
            value = _stamp(df)
        columns.append(value.alias(c))
    return _latest(df.select(*columns), K.SOCIAL_KEY, keep_null_keys=False, tiebreak=tiebreak)


def enrolment_request(df: DataFrame, as_of: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Latest request per child, requests without an id all kept.

    Ids are cleaned of a trailing ``.0`` and non-digits. ``as_of`` (ISO date) is the day ages
    are counted at.
    """
    types = dict(df.dtypes)
    columns, texts = [], []
    for c in df.columns:
        value = _named(df, c)
        if c in (K.REQUEST_KEY, *K.REQUEST_OTHER_IDS):
            value = document_id(value.cast("string"), K.ID_NULLS)
        elif c == K.STAMP:
            value = _stamp(df)
        elif c == K.REQUEST_BIRTH:
            value = _date(df, c)
        elif types[c] == "string":
            value = strip(F.upper(value))
            texts.append(c)
        columns.append(value.alias(c))
    table = _null_words(df.select(*columns), texts)
    if K.DISABILITY in df.columns:
        category = keyword_category(
            _named(table, K.DISABILITY),
            K.DISABILITY_WHOLE,
            K.DISABILITY_WORDS,
            K.DISABILITY_OTHER,
            prepared=True,
        )
        table = table.withColumn(K.DISABILITY, category)
    if K.REQUEST_BIRTH in df.columns:
        table = table.withColumn("EDAD", age_years(_named(table, K.REQUEST_BIRTH), F.lit(as_of).cast("date")))
    latest = _latest(table, K.REQUEST_KEY, keep_null_keys=True, tiebreak=tiebreak)
    return latest.withColumn(K.STAMP, F.col(f"`{K.STAMP}`").cast("date"))

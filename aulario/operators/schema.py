"""Schema alignment: column lookup, projection onto a declared layout, renames, suffixes."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plain(name: str) -> str:
    """Comparison form of a column name: no accents, single spaces, upper case."""
    folded = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return re.sub(r"[\s_]+", " ", folded).strip().upper()


def find_column(columns: Sequence[str], *patterns: str) -> str | None:
    """First column whose normalised lower-case name matches one of the patterns."""
    for column in columns:
        key = re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", plain(column))).strip().lower()
        if any(re.search(p, key) for p in patterns):
            return column
    return None


def find_named(columns: Sequence[str], *names: str) -> str | None:
    """Column equal to one of the names up to accents, case, spacing and underscores."""
    known = {plain(c): c for c in columns}
    return next((known[plain(n)] for n in names if plain(n) in known), None)


def project(df: DataFrame, layout: Mapping[str, str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Select source columns in layout order under their target names.

    Missing columns are added as null, columns outside the layout are dropped, and targets
    named in ``types`` are cast with bad values turning null.
    """
    types = types or {}
    have = set(df.columns)

    def column(source: str, target: str):
        c = F.col(f"`{source}`") if source in have else F.lit(None).cast("string")
        return (c.try_cast(types[target]) if target in types else c).alias(target)

    return df.select(*[column(s, t) for s, t in layout.items()])


def add_suffix(df: DataFrame, suffix: str = "__c") -> DataFrame:
    """Suffix every column name that does not end with it yet."""
    return df.toDF(*[c if c.endswith(suffix) else c + suffix for c in df.columns])


def rename_synonyms(df: DataFrame, synonyms: Mapping[str, Sequence[str]]) -> DataFrame:
    """Give alternative headings one name; where several exist, the first filled value wins."""
    renamed = df
    for target, names in synonyms.items():
        present = [n for n in names if n in renamed.columns]
        if not present:
            continue
        value = F.coalesce(*[F.col(f"`{n}`") for n in present]).alias(target)
        first = present[0]
        columns = []
        for c in renamed.columns:
            if c == first:
                columns.append(value)
            elif c not in present:
                columns.append(F.col(f"`{c}`"))
        renamed = renamed.select(*columns)
    return renamed


def drop_if_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def keep_known(df: DataFrame, target_fields: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Keep the columns a target accepts; also return the names it does not know."""
    known = set(target_fields)
    unknown = [c for c in df.columns if c not in known]
    return df.drop(*unknown), unknown


def api_names(
    titles: Sequence[str],
    suffix: str = "__c",
    limit: int = 40,
    overrides: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Field names for form questions: first ``limit`` characters, letters and digits only.

    Spaces become underscores, accented letters and punctuation disappear, and a second
    question with the same name gets ``_1``, a third ``_2``. Titles already suffixed stay.
    ``overrides`` names the exceptions.
    """
    overrides = overrides or {}
    out: dict[str, str] = {}
    taken: set[str] = set(overrides.values())
    for title in titles:
        if title in overrides:
            out[title] = overrides[title]
            continue
        if title.endswith(suffix):
            name = title
        else:
            stem = re.sub(r"[^A-Za-z0-9_]", "", title[:limit].strip().replace(" ", "_"))
            stem = re.sub(r"_+", "_", stem).strip("_")
            name, n = stem + suffix, 0
            while name in taken:
                n += 1
                name = f"{stem}_{n}{suffix}"
        taken.add(name)
        out[title] = name
    return out

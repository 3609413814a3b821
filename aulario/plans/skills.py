"""Skills: one row per child, skill and moment with an ordinal level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulario.functions.ids import document_id
from aulario.functions.mapping import map_or_null
from aulario.functions.text import blank_to_null, strip, strip_accents
from aulario.operators import grid
from aulario.operators.reshape import unpivot_labelled
from aulario.plans import constants as K
from aulario.sources.readers import sheet_in


def level_order(c):
    """Ordinal 1–4 of a level text, accents and case ignored; other text is null."""
    return map_or_null(F.lower(strip(strip_accents(c))), K.LEVEL_ORDER)


def skills(cells: DataFrame, year: int, header_row: int = 0) -> DataFrame:
    """Baseline and final levels of the skill sheets as rows.

    A missing skill name takes the sheet's. Rows without id or level are left out.
    """
    cells = cells.filter(sheet_in(list(K.SKILL_SHEETS)))
    titles = grid.fixed_header_cells(cells, header_row)
    titles = grid.duplicate_headers(titles.withColumn("header", strip(strip_accents(F.col("header")))))
    data = grid.with_layout(cells, grid.layouts(titles))
    table = data.select(
        F.col("sheet"),
        *[grid.cell(t).alias(name) for t, name in K.SKILL_COLUMNS.items()],
        *[grid.cell(t).alias(t) for t in K.SKILL_LEVELS],
    )
    table = table.withColumn("DNI__c", document_id(F.col("DNI__c"))).withColumn(
        "Habilidades__c", F.coalesce("Habilidades__c", map_or_null(F.col("sheet"), K.SKILL_SHEETS))
    )
    ids = list(K.SKILL_COLUMNS.values())
    long = unpivot_labelled(table.filter("DNI__c is not null"), ids, K.SKILL_LEVELS, "Escenario", "Nivel_de_logro__c")
    long = long.withColumn("Nivel_de_logro__c", blank_to_null(F.col("Nivel_de_logro__c"))).dropna(
        subset=["Nivel_de_logro__c"]
    )
    return long.withColumns(
        {
            "Nivel_logroOrden": level_order(F.col("Nivel_de_logro__c")),
            "Evaluacion__c": F.when(F.col("Escenario") == "LB", f"{year}-I").otherwise(f"{year}-II"),
        }
    )

"""Registered queries over the test tables, each with the SQL that must agree with it.

The test tables stand in for the programme's: ``events`` and ``orders`` for attendance and
survey answers, ``lineitem`` for grades and hours, ``customer`` for children, ``nation`` for
sites, ``documents`` for free text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, tuple[Query, str | None]]:
    from aulario.queries import carried, columns, entities, files, grids, matching, measures, tables

    out: dict[str, tuple[Query, str | None]] = {}
    for module in (measures, tables, columns, grids, entities, files, carried, matching):
        for name, pair in module.REGISTRY.items():
            if name in out:
                raise ValueError(f"query {name} registered twice")
            out[name] = pair
    return out

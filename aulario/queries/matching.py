"""Joins with repeated, null and very frequent keys, over orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from aulario.operators.factored import factor
from aulario.operators.heavy import split_join
from aulario.queries.register import Registry, table

REGISTRY = Registry()
query = REGISTRY.query

# Scores and levels per child, where a fifth of the ids are missing and every id repeats.
_ID = "case when o_orderkey % 5 = 0 then null else o_custkey end"
_SIDES = f"""WITH scores AS (SELECT {_ID} AS child, o_orderkey AS score_row, o_orderkey % 20 AS score FROM orders),
levels AS (SELECT {_ID} AS child, o_orderkey AS level_row FROM orders WHERE o_orderkey % 3 = 0),
facts AS (SELECT {_ID} AS child, o_orderkey AS fact_row FROM orders WHERE o_orderkey % 7 = 1) """


def _sides(spark, sf):
    orders = table(spark, sf, "orders")
    scores = orders.selectExpr(f"{_ID} AS child", "o_orderkey AS score_row", "o_orderkey % 20 AS score")
    levels = orders.filter("o_orderkey % 3 = 0").selectExpr(f"{_ID} AS child", "o_orderkey AS level_row")
    facts = orders.filter("o_orderkey % 7 = 1").selectExpr(f"{_ID} AS child", "o_orderkey AS fact_row")
    return scores, levels, facts


# The SQL side sums per id before it multiplies: its null group alone would have billions of joined rows.
@query(
    _SIDES
    + """, s AS (SELECT child, COUNT(*) AS n, SUM(score) AS total FROM scores GROUP BY child),
    l AS (SELECT child, COUNT(*) AS n FROM levels GROUP BY child), f AS (SELECT child, COUNT(*) AS n FROM facts GROUP BY child)
    SELECT s.child, (s.n * l.n * COALESCE(f.n, 1))::BIGINT AS joined_rows, (s.total * l.n * COALESCE(f.n, 1))::BIGINT AS score_total
    FROM s JOIN l ON s.child IS NOT DISTINCT FROM l.child LEFT JOIN f ON s.child IS NOT DISTINCT FROM f.child"""
)
def factored_totals(spark, sf):
    """Joined rows and score totals per child of a three-sided match that is never built."""
    scores, levels, facts = _sides(spark, sf)
    rows = factor(scores, [(levels, "inner"), (facts, "left")], ["child"]).weighted()
    return rows.groupBy("child").agg(
        F.sum("links").cast("long").alias("joined_rows"), F.sum(F.col("score") * F.col("links")).cast("long").alias("score_total")
    )


@query(
    _SIDES
    + """SELECT s.child, score_row, score, level_row FROM scores s JOIN levels l ON s.child IS NOT DISTINCT FROM l.child
    WHERE s.child IS NOT NULL"""
)
def factored_unrolled(spark, sf):
    """The joined rows of the children with an id, built from the factored match."""
    scores, levels, _ = _sides(spark, sf)
    return factor(scores.dropna(subset=["child"]), [(levels, "inner")], ["child"]).unrolled()


_SUPPLIER = "case when l_orderkey % 3 = 0 then 1 when l_orderkey % 11 = 0 then null else l_suppkey end"


@query(
    f"""SELECT i.l_orderkey, i.l_linenumber, i.s_suppkey, s_name FROM
    (SELECT l_orderkey, l_linenumber, {_SUPPLIER} AS s_suppkey FROM lineitem) i LEFT JOIN supplier s ON i.s_suppkey = s.s_suppkey"""
)
def split_join_hot_key(spark, sf):
    """Left join where one key holds a third of the rows: that key by broadcast, the others by shuffle."""
    items = table(spark, sf, "lineitem").selectExpr(f"{_SUPPLIER} AS s_suppkey", "l_orderkey", "l_linenumber")
    return split_join(items, table(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"], "left")

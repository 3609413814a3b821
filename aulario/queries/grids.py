"""Queries over cell-grid operators, on grids derived from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from aulario.operators import combine, grid, named
from aulario.queries.cells import row_cells, single_cells, title_cells
from aulario.queries.register import Registry, table
from aulario.sources.readers import sheet_in, sheet_like, sheet_numbered
from aulario.sources.stages import stage

REGISTRY = Registry()
query = REGISTRY.query


@query(
    """SELECT 'clientes' AS file, 'H' || c_custkey AS sheet,
      (CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey % 15 + 4 ELSE c_nationkey % 15 END)::INTEGER AS header_row FROM customer"""
)
def header_find(spark, sf):
    """Every customer is a sheet whose titles stand at a varying row, once more below it."""
    c = table(spark, sf, "customer")
    sheet = F.concat(F.lit("H"), "c_custkey")
    top = F.col("c_nationkey") % 15
    missing = F.when(F.col("c_mktsegment") != "BUILDING", F.lit("apellidos y nombres "))
    titles = {1: F.lit("DNI"), 2: F.lit(" Grado"), 3: missing}
    again = {1: F.lit("DNI"), 2: F.lit("GRADO"), 4: F.lit("Nombre completo")}
    cells = combine.union_aligned(
        [
            row_cells(c, "clientes", sheet, top, titles),
            row_cells(c, "clientes", sheet, top + 4, again),
            row_cells(c, "clientes", sheet, top + 30, again),
        ]
    )
    return grid.header_row_with_titles(
        cells, ["DNI", "GRADO"], ["APELLIDOS Y NOMBRES", "NOMBRES Y APELLIDOS", "NOMBRE COMPLETO"]
    )


@query(
    """SELECT 'pedidos' AS file, 'C' || o_custkey AS sheet, min(o_orderkey)::INTEGER AS header_row FROM orders
    WHERE o_orderstatus = 'F' GROUP BY o_custkey"""
)
def header_containing(spark, sf):
    o = table(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "F", "n° dni del niño").otherwise(F.col("o_orderpriority"))
    cells = row_cells(o, "pedidos", F.concat(F.lit("C"), "o_custkey"), F.col("o_orderkey"), {2: text})
    return grid.header_row_containing(cells, "DNI")


@query(
    """SELECT 'clientes' AS file, 'H' || c_custkey AS sheet, c_name AS tutor FROM customer"""
)
def header_label_neighbour(spark, sf):
    c = table(spark, sf, "customer")
    sheet = F.concat(F.lit("H"), "c_custkey")
    cells = combine.union_aligned(
        [
            row_cells(c, "clientes", sheet, 1, {0: F.lit("Tutora:"), 2: F.col("c_mktsegment")}),
            row_cells(c, "clientes", sheet, 3, {1: F.lit("TUTOR:"), 2: F.col("c_name")}),
            row_cells(c, "clientes", sheet, 5, {1: F.lit("TUTOR:"), 2: F.lit("otro")}),
        ]
    )
    return grid.neighbour_of_label(cells, "tutora?:", "tutor")


_DATED = """WITH h AS (SELECT o_custkey, o_orderkey + 1 AS col, o_orderdate::DATE AS date, NULL::BIGINT AS "offset" FROM orders),
  l AS (SELECT o_custkey, max(col) AS last FROM h GROUP BY o_custkey)
  """


@query(
    _DATED
    + """SELECT 'C' || o_custkey AS sheet, col::INTEGER AS col, date, "offset"::INTEGER AS "offset" FROM h
    UNION ALL SELECT 'C' || o_custkey, (last + n)::INTEGER, NULL, n::INTEGER FROM l, range(1, 4) t(n)
    UNION ALL SELECT 'C' || o_custkey, 0, NULL, NULL FROM l"""
)
def date_headers(spark, sf):
    """One sheet per customer, one date column per order, five columns after the last date."""
    o = table(spark, sf, "orders")
    sheet = F.concat(F.lit("C"), "o_custkey")
    d = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(d, "dd/MM/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format(d, "yyyy-MM-dd"))
        .otherwise(F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string"))
    )
    last = o.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last"))
    after = last.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(5))))
    cells = combine.union_aligned(
        [
            single_cells(o, "f", sheet, 6, F.col("o_orderkey") + 1, text),
            single_cells(after, "f", sheet, 6, F.col("last") + 1 + F.col("n"), F.concat(F.lit("mar "), "n")),
            single_cells(last, "f", sheet, 6, 0, "DNI"),
        ]
    )
    headers = grid.within_date_range(grid.with_dates(grid.fixed_header_cells(cells, 6)))
    return headers.select("sheet", "col", "date", "offset")


@query(
    """SELECT 'C' || o_custkey AS sheet, (o_orderkey + 1)::INTEGER AS col,
      CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE strftime(o_orderdate, '%Y-%m-%d') ||
        CASE WHEN o_orderstatus = 'P' THEN '' ELSE ' - ' || o_orderpriority END END AS header FROM orders"""
)
def two_row_headers(spark, sf):
    o = table(spark, sf, "orders")
    sheet, col = F.concat(F.lit("C"), "o_custkey"), F.col("o_orderkey") + 1
    activity = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    date = F.when(F.col("o_orderstatus") != "O", F.date_format("o_orderdate", "d/M/yyyy"))
    cells = single_cells(o, "f", sheet, 2, col, activity).unionByName(single_cells(o, "f", sheet, 3, col, date))
    return grid.two_row_headers(cells, 2, 3, 3).select("sheet", "col", "header")


@query(
    """SELECT o_custkey::VARCHAR AS sheet, o_orderkey::INTEGER AS col, o_orderpriority ||
      CASE WHEN n = 1 THEN '' ELSE '_v' || (n - 1) END AS numerado, n = 1 AS primero FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS n FROM orders)"""
)
def duplicate_headers(spark, sf):
    o = table(spark, sf, "orders")
    cells = single_cells(o, "f", F.col("o_custkey").cast("string"), 0, F.col("o_orderkey"), F.col("o_orderpriority"))
    headers = grid.fixed_header_cells(cells, 0)
    first = grid.duplicate_headers(headers).select("sheet", "col", F.lit(True).alias("primero"))
    numbered = grid.duplicate_headers(headers, "_v").select("sheet", "col", F.col("header").alias("numerado"))
    out = numbered.join(first, ["sheet", "col"], "left")
    return out.withColumn("primero", F.coalesce("primero", F.lit(False)))


_LAYOUT = """WITH h AS (SELECT DISTINCT lpad(o_custkey::VARCHAR, 9, '0') || o_orderstatus AS sheet, o_orderpriority AS header,
    substr(o_orderpriority, 1, 1)::INTEGER AS col FROM orders),
  s AS (SELECT sheet, count(*) AS width, list(header ORDER BY col) AS names FROM h GROUP BY sheet),
  b AS (SELECT width, min(sheet) AS sheet FROM s GROUP BY width ORDER BY count(*) DESC, min(sheet) LIMIT 1),
  base AS (SELECT unnest(names) AS header, unnest(range(len(names))) AS pos FROM s WHERE sheet = (SELECT sheet FROM b)),
  x AS (SELECT header, min((sheet, col)) AS seen FROM h JOIN s USING (sheet)
    WHERE s.width <> (SELECT width FROM b) AND header NOT IN (SELECT header FROM base) GROUP BY header)
  """


def _priority_titles(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()
    sheet = F.concat(F.lpad(F.col("o_custkey").cast("string"), 9, "0"), "o_orderstatus")
    return single_cells(o, "f", sheet, 4, F.substring("o_orderpriority", 1, 1), F.col("o_orderpriority"))


@query(
    _LAYOUT
    + """SELECT 'base' AS grupo, pos, header FROM base
    UNION ALL SELECT 'extra', row_number() OVER (ORDER BY seen) - 1, header FROM x"""
)
def common_layout(spark, sf):
    """One sheet per customer and status; its headings are the priorities of those orders."""
    base, extra = grid.common_layout(grid.fixed_header_cells(_priority_titles(spark, sf), 4))
    rows = [("base", i, h) for i, h in enumerate(base)] + [("extra", i, h) for i, h in enumerate(extra)]
    return spark.createDataFrame(rows, "grupo string, pos bigint, header string")


@query(
    _LAYOUT
    + """, n AS (SELECT pos, header, true AS base FROM base UNION ALL SELECT (SELECT count(*) FROM base) + row_number() OVER (ORDER BY seen) - 1,
      header, false FROM x)
    SELECT pos::BIGINT AS position, header, base, (SELECT count(*) FROM (SELECT h.sheet, coalesce(b.header, h.header) AS header,
        row_number() OVER (PARTITION BY h.sheet, coalesce(b.header, h.header) ORDER BY h.col) AS n
      FROM (SELECT h.*, s.width, row_number() OVER (PARTITION BY sheet ORDER BY col) - 1 AS pos FROM h JOIN s USING (sheet)) h
      LEFT JOIN base b ON h.width = (SELECT width FROM b) AND b.pos = h.pos) r WHERE r.header = n.header AND r.n = 1)::BIGINT AS sheets FROM n"""
)
def layout_as_table(spark, sf):
    """The common layout as a table, and the number of sheets that have each heading under the common names."""
    names, headers = named.named_layout(stage(grid.fixed_header_cells(_priority_titles(spark, sf), 4), "titles"))
    counts = headers.groupBy("header").agg(F.count(F.lit(1)).alias("sheets"))
    return names.join(counts, "header", "left").select(
        "position", "header", "base", F.coalesce("sheets", F.lit(0)).alias("sheets")
    )


@query(
    """SELECT 'N' || c_nationkey AS sheet, c_custkey::VARCHAR AS "CLAVE", c_name AS "NOMBRE",
      CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS "SEGMENTO", NULL::VARCHAR AS "AUSENTE" FROM customer"""
)
def grid_to_wide(spark, sf):
    c = table(spark, sf, "customer")
    sheet = F.concat(F.lit("N"), "c_nationkey")
    sheets = c.select(F.lit("f").alias("file"), sheet.alias("sheet")).distinct()
    body = row_cells(
        c,
        "f",
        sheet,
        F.col("c_custkey") + 5,
        {
            1: F.col("c_custkey"),
            2: F.col("c_name"),
            3: F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise("  "),
        },
    )
    cells = title_cells(sheets, 4, {1: "CLAVE", 2: "NOMBRE", 3: "SEGMENTO"}).unionByName(body)
    layout = grid.layouts(grid.fixed_header_cells(cells, 4))
    return grid.wide(grid.with_layout(cells, layout), ["CLAVE", "NOMBRE", "SEGMENTO", "AUSENTE"], ("sheet",))


@query(
    """WITH s AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Asistencia' WHEN '2-HIGH' THEN ' 02 ASÍST. marzo'
      WHEN '3-MEDIUM' THEN 'Notas' ELSE '10 Otros' END AS sheet FROM orders)
    SELECT sheet, sheet IN ('Asistencia', ' 02 ASÍST. marzo') AS asistencia, sheet IN (' 02 ASÍST. marzo', '10 Otros') AS numerada,
      sheet = 'Notas' AS listada, count(*) AS n FROM s GROUP BY sheet"""
)
def sheet_filters(spark, sf):
    o = table(spark, sf, "orders")
    sheet = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Asistencia")
        .when(F.col("o_orderpriority") == "2-HIGH", " 02 ASÍST. marzo")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Notas")
        .otherwise("10 Otros")
    )
    cells = row_cells(o, "f", sheet, F.col("o_orderkey"), {0: F.col("o_custkey")})
    return (
        cells.groupBy("sheet")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "sheet",
            sheet_like("asist").alias("asistencia"),
            sheet_numbered().alias("numerada"),
            sheet_in(["Notas"]).alias("listada"),
            "n",
        )
    )

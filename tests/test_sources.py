import csv
import json
import pathlib
import random
import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aulario.sources import quoted_csv, readers, sinks, stages, versioned_load
from tests.conftest import rows

CELLS = "file string, sheet string, row int, col int, value string"


def test_scan_cells_drops_lock_files_and_reads_csv(spark, tmp_path):
    df = spark.createDataFrame([("a.xlsx", "S", 0, 0, "x"), ("~$a.xlsx", "S", 0, 0, "y"), ("d/~$b.xlsx", "S", 0, 0, "z")], CELLS)
    df.write.parquet(str(tmp_path / "cells"))
    assert rows(readers.scan_cells(spark, str(tmp_path / "cells")), "file", "value") == [("a.xlsx", "x")]
    (tmp_path / "libro.csv").write_text("sheet,row,col,value\nS,1,2,hola\nS,1,3,\n", encoding="utf-8")
    got = readers.scan_cells(spark, str(tmp_path / "libro.csv"), "csv")
    assert rows(got) == [("libro.csv", "S", 1, 2, "hola")]


def test_scan_cells_by_name_and_folder(spark, tmp_path):
    for year, header, line in (("2025", "sheet,file,col,row,value", "S,w,3,1,a"), ("2026", "value,row,col,sheet", '"b, c",1,3,S')):
        (tmp_path / year).mkdir()
        (tmp_path / year / "w.csv").write_text(f"{header}\n{line}\n", encoding="utf-8")
    both = [str(tmp_path / "2025"), str(tmp_path / "2026")]
    assert rows(readers.scan_cells(spark, both, "csv")) == [("2025/w", "S", 1, 3, "a"), ("2026/w.csv", "S", 1, 3, "b, c")]
    files = [f"{b}/w.csv" for b in both]
    assert rows(readers.scan_cells(spark, files, "csv"), "file") == [("2025/w",), ("2026/w.csv",)]
    nameless = spark.createDataFrame([(None, "S", 0, 0, "x"), ("a", "S", 0, 1, "y")], CELLS)
    nameless.write.parquet(str(tmp_path / "n"))
    found = rows(readers.scan_cells(spark, str(tmp_path / "n")), "file", "value")
    assert len(found) == 2 and ("a", "y") in found


def test_scan_cells_reads_whole_headers_in_any_case(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,file,sheet,row,col,value\n1,w,S,1,3,a\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('\n\ufeff"n,m",Row, Value ,COL,x,y,Sheet\n"p, q",4,"b, c",5,,,T\n', encoding="utf-8")
    (tmp_path / "c.csv").write_text("sheet,row,col,value\nsheet,row,col,value\nvalue,2,2,row\n", encoding="utf-8")
    found = rows(readers.scan_cells(spark, str(tmp_path), "csv"))
    assert found == [("b.csv", "T", 4, 5, "b, c"), ("c.csv", "value", 2, 2, "row"), ("w", "S", 1, 3, "a")]
    for header in ("S,1,2,x", "sheet,row,col", "sheet,row,Row,col,value"):
        (tmp_path / "bad.csv").write_text(f"{header}\nS,1,2,y\n", encoding="utf-8")
        with pytest.raises(Exception, match="no header with sheet"):
            readers.scan_cells(spark, str(tmp_path), "csv").collect()
        with pytest.raises(Exception, match="no header with sheet"):
            readers.scan_cells(spark, str(tmp_path), "csv").count()
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "empty.csv").write_text("", encoding="utf-8")
    assert readers.scan_cells(spark, str(tmp_path / "e"), "csv").count() == 0


def test_scan_pushes_row_filters_to_parquet(spark, tmp_path):
    spark.createDataFrame([("a", "S", 6, 0, "x")], CELLS).write.parquet(str(tmp_path / "c"))
    plan = readers.scan_cells(spark, str(tmp_path / "c")).filter("row = 6")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(row,6)" in plan


def test_text_csv_keeps_ids_and_aligns_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v\n0012,"x, y"\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("v,w,id\nz,1,7\n", encoding="utf-8")
    got = readers.scan_text_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert rows(got) == sorted([("0012", "x, y", None), ("7", "z", "1")], key=repr)
    with pytest.raises(FileNotFoundError):
        readers.scan_text_csv(spark, [])


def test_missing_year_is_skipped_and_no_year_is_an_error(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "y2025"))
    paths = {"2025": str(tmp_path / "y2025"), "2026": str(tmp_path / "y2026")}
    assert list(readers.read_years(spark.read.parquet, paths)) == ["2025"]
    with pytest.raises(FileNotFoundError):
        readers.read_years(spark.read.parquet, {"2026": str(tmp_path / "y2026")})


def load_files(path, part="data"):
    return sorted(pathlib.Path(path).glob(f"versions/*/{part}/*"))


def test_full_refresh_replaces_and_batches(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.range(2500).coalesce(1).select("id", F.lit(None).cast("string").alias("nada"))
    sinks.full_refresh(df, out)
    files = load_files(out)
    sizes = [len(f.read_text().splitlines()) for f in files]
    assert sum(sizes) == 2500 and max(sizes) == 1000
    assert json.loads(files[0].read_text().splitlines()[0]) == {"id": 0, "nada": None}
    sinks.full_refresh(df.limit(3), out)
    found = sinks.read_target(spark, out)
    assert found.dtypes == df.dtypes and rows(found) == [(0, None), (1, None), (2, None)]
    # The version before stays for readers that have begun; older ones go.
    sinks.full_refresh(df.limit(2), out)
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 2
    assert sinks.full_refresh(df.limit(0), out).count() == 0
    assert sinks.read_target(spark, out).count() == 0 and sinks.read_target(spark, out).dtypes == df.dtypes
    with pytest.raises(FileNotFoundError):
        sinks.read_target(spark, str(tmp_path / "nowhere"))


def test_failing_load_leaves_the_old_version(spark, tmp_path):
    out = str(tmp_path / "out")
    sinks.full_refresh(spark.range(10), out)
    before = (tmp_path / "out" / "CURRENT").read_text()
    old = sinks.read_target(spark, out)
    wrong = spark.range(0, 5000, 1, 4).withColumn("id", F.when(F.col("id") == 4321, F.raise_error(F.lit("stopped")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stopped"):
        sinks.full_refresh(wrong, out)
    assert (tmp_path / "out" / "CURRENT").read_text() == before
    assert rows(old) == rows(sinks.read_target(spark, out)) == [(i,) for i in range(10)]
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 1
    # A reader that began on the old version reads on through the next load.
    sinks.full_refresh(spark.range(3), out)
    assert old.count() == 10 and sinks.read_target(spark, out).count() == 3


def test_results_of_a_load(spark, tmp_path):
    df = spark.range(0, 2600, 1, 2).select("id", F.when(F.col("id") % 100 != 0, F.lit("x")).alias("v"))
    rules = {"sin valor": F.col("v").isNull(), "grande": F.col("id") >= 2500}
    found = sinks.full_refresh(df, str(tmp_path / "out"), batch=500, rules=rules, key="id").collect()
    want = {str(i): [t for t, bad in (("sin valor", i % 100 == 0), ("grande", i >= 2500)) if bad] for i in range(2600)}
    assert {r.key: r.errors for r in found} == want and len(found) == 2600
    assert all(r.success == (not r.errors) for r in found)
    places = {(r.batch, r.position) for r in found}
    assert len(places) == 2600 and len({b for b, _ in places}) == 6
    assert sinks.read_target(spark, str(tmp_path / "out")).count() == sum(not e for e in want.values())


def test_repeated_attempts_leave_no_record_twice(spark, tmp_path):
    """Files of an attempt whose result the driver did not take are dropped by the commit."""
    out = str(tmp_path / "out")
    writer = versioned_load.LoadWriter(out, "v1", 2, spark.range(1).schema.json())
    rows_in = pa.record_batch({"record": ['{"id": 1}', '{"id": 2}', '{"id": 3}'], "key": ["1", "2", "3"], "errors": pa.array([[], ["no"], None], pa.list_(pa.string()))})
    versioned_load.TaskContext, kept = types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 4)), versioned_load.TaskContext
    try:
        writer.write(iter([rows_in]))
        second = writer.write(iter([rows_in]))
    finally:
        versioned_load.TaskContext = kept
    writer.commit([second, None])
    assert rows(sinks.read_target(spark, out)) == [(1,), (3,)]
    assert rows(sinks.read_results(spark, out), "batch", "position", "success") == [("000004-000000", 0, True), ("000004-000000", 1, False), ("000004-000001", 0, True)]
    versioned_load.LoadWriter(out, "v2", 2, "").abort([])
    assert sinks.read_target(spark, out).count() == 2


def test_csv_export_quotes(spark, tmp_path):
    out = str(tmp_path / "csv")
    sinks.export_csv(spark.createDataFrame([("ñ", 1)], "a string, b int").coalesce(1), out, quote_all=True)
    written = next(pathlib.Path(out).glob("*.csv")).read_text(encoding="utf-8")
    assert written == '"a","b"\n"ñ","1"\n'


def test_stage_partitioned(spark, tmp_path):
    out = str(tmp_path / "stage")
    sinks.write_stage(spark.createDataFrame([("1", "2025"), ("2", "2026")], "id string, anio string"), out, "anio")
    plan = spark.read.parquet(out).filter("anio = 2025")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan


def test_written_stage_keeps_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "map('a', id) as m")
    staged = stages.stage(df, "t")
    assert staged.dtypes == df.dtypes and rows(staged, "id") == rows(df, "id")


def test_load_summary(spark):
    data = [("true", None), ("True", None), ("false", ["a", "b"]), ("false", None), (None, ["a", "b"])]
    df = spark.createDataFrame(data, "success string, errors array<string>")
    assert tuple(sinks.load_summary(df).first()) == (2, 3, 5)
    assert [tuple(r) for r in sinks.top_errors(df).collect()] == [("a | b", 2), ("Sin detalle", 1)]


def plain_csv(path):
    """Records after the header, by a sequential reader."""
    with open(path, encoding="utf-8-sig", newline="") as f:
        found = [r for r in csv.reader(f) if any(c.strip() for c in r) or len(r) > 1]
    return found[0], found[1:]


def odd_csv(path, seed, n=400, width=4, end="\r\n"):
    rng = random.Random(seed)
    cells = ["x", "", "a b", 'say "hi", you', "line one\nline two", '"', '""', "\n", "a,b", "ñ\r\nç", ' "q', 'end"', ",\n,\n\"x\"\n"]
    with open(path, "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["id", "first\nname", 'the "rest"', "v"][:width])
        for i in range(n):
            w.writerow([f"{i:05d}", *rng.choices(cells, k=width - 1)])
            if rng.random() < 0.05:
                f.write(end)
            if rng.random() < 0.05:
                f.write(f'{i:05d},5" pipe,a"b"c,plain{end}')


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of a few hundred bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size, end", [(10**8, "\n"), (700, "\r\n"), (61, "\n"), (7, "\r\n")])
def test_quoted_csv_equals_a_sequential_reader(spark, tmp_path, small_splits, size, end):
    path = str(tmp_path / "a.csv")
    odd_csv(path, size, n=60 if size < 50 else 400, end=end)
    header, want = plain_csv(path)
    small_splits(size)
    lines = quoted_csv._lines(spark, [path])
    if size < 10**6:
        assert lines.select("start").distinct().count() > 5
    found = readers.scan_text_csv(spark, [path])
    assert found.columns == header
    # A sequential reader gives empty text where this one gives null.
    assert sorted(tuple(v or "" for v in r) for r in found.collect()) == sorted(map(tuple, want))


def test_quoted_csv_has_no_whole_file_reader(spark, tmp_path):
    odd_csv(str(tmp_path / "a.csv"), 1)
    odd_csv(str(tmp_path / "b.csv"), 2, width=3)
    found = readers.scan_text_csv(spark, [str(tmp_path)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    # One scan of the text for two layouts, by the reader that splits files.
    assert plan.count("FileScan text") == 1 and "Exchange hash" not in plan
    want = [r for p in "ab" for r in plain_csv(str(tmp_path / f"{p}.csv"))[1]]
    assert found.count() == len(want)


def test_record_over_several_blocks(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i} of a long cell" for i in range(100))
    (tmp_path / "a.csv").write_text(f'id,v\n1,"{long}"\n2,b\n3,"{long}\n\n"\n', encoding="utf-8")
    small_splits(64)
    found = {r.id: r.v for r in readers.scan_text_csv(spark, [str(tmp_path / "a.csv")]).collect()}
    assert found == {"1": long, "2": "b", "3": long + "\n\n"}


def test_unclosed_quote_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v\n1,"open\n2,b\n', encoding="utf-8")
    with pytest.raises(ValueError, match="never closed"):
        readers.scan_text_csv(spark, [str(tmp_path / "a.csv")])


def test_states_equal_a_step_by_step_scan():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = rng.random((2, rng.integers(1, 12))) < 0.5
        for entering in (False, True):
            now, want = entering, []
            for x, y in zip(a, b):
                now = bool(y if now else x)
                want.append(now)
            assert quoted_csv.states(a, b, entering).tolist() == want


def test_grid_cells_with_line_breaks_and_quotes(spark, tmp_path, small_splits):
    cells = [("w.xlsx", "S\n1", r, c, v) for r in range(20) for c, v in enumerate(["line one\nline two", 'say "hi", you', "x,y", "z"])]
    with open(tmp_path / "g.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([("file", "sheet", "row", "col", "value"), *cells])
    for size in (10**8, 200):
        small_splits(size)
        assert rows(readers.scan_cells(spark, str(tmp_path / "g.csv"), "csv")) == sorted(cells, key=repr)


def test_folders_are_told_apart_by_the_files_themselves(spark, tmp_path):
    base = str(tmp_path / "cells")
    for year in ("2025", "2026"):
        df = spark.createDataFrame([("x.xlsx", "S", 0, 0, year)], CELLS)
        for folder in (f"{year}.parquet", f"dots/v.{year}", f"parts/year={year}", f"{year}/centro a"):
            df.write.parquet(f"{base}/{folder}")
    both = lambda a, b: [(f"{a}/x.xlsx", "2025"), (f"{b}/x.xlsx", "2026")]
    scan = lambda path: rows(readers.scan_cells(spark, path), "file", "value")
    assert scan([f"{base}/2025.parquet", f"{base}/2026.parquet"]) == both("2025.parquet", "2026.parquet")
    assert scan(f"{base}/dots/*") == both("v.2025", "v.2026")
    assert scan(f"{base}/parts") == both("year=2025", "year=2026")
    assert scan([f"{base}/parts/year=2025", f"{base}/parts/year=2026"]) == both("year=2025", "year=2026")
    assert scan([f"{base}/2025/*", f"{base}/2026/*"]) == both("2025/centro a", "2026/centro a")
    (tmp_path / "a+b %.csv").write_text("sheet,row,col,value\nS,0,0,v\n", encoding="utf-8")
    assert rows(readers.scan_cells(spark, str(tmp_path / "a+b %.csv"), "csv"), "file") == [("a+b %.csv",)]
    # Folders that hold a column of the grid are no folders of their own.
    spark.createDataFrame([("x.xlsx", s, 0, 0, s) for s in "ST"], CELLS).write.partitionBy("sheet").parquet(f"{base}/one")
    assert rows(readers.scan_cells(spark, f"{base}/one"), "file", "sheet") == [("x.xlsx", "S"), ("x.xlsx", "T")]

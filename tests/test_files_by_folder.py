"""A2 over all folders: no event is left out, and the later listing wins."""

import datetime

import duckdb

from contractlake.operators import pages
from contractlake.plans import catalog

SF = "/root/testdata/sf0.001"


def test_folders_and_later_listing(spark):
    at = datetime.datetime(2024, 1, 2, 8)
    later = at.replace(hour=9)
    rows = [("2024-01-02/c1.pdf", at), ("in/2024-01-02/c1.pdf", at), ("in/2024-01-02/b/c1.pdf", later), ("in/2024/2024-01-02/c1.pdf", at),
            ("2024-01-02/c2.pdf", later), ("2024-01-02/z/c2.pdf", at), ("2024-01-03/other-day.pdf", at), ("x2024-01-02/c3.pdf", at)]
    got = pages.files_by_folder(spark.createDataFrame(rows, "blob_path string, listed_at timestamp_ntz")).collect()
    assert sorted((r["folder"], r["basename"], r["blob_path"]) for r in got) == [
        ("", "c1.pdf", "2024-01-02/c1.pdf"), ("", "c2.pdf", "2024-01-02/c2.pdf"), ("in", "c1.pdf", "in/2024-01-02/b/c1.pdf"), ("in/2024", "c1.pdf", "in/2024/2024-01-02/c1.pdf")]


def test_sql_agrees(spark):
    fn, sql = catalog.REGISTRY["files_by_folder"]
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF}/events.parquet')")
    got = sorted(map(tuple, fn(spark, SF).collect()))
    assert got == sorted(con.execute(sql).fetchall())
    assert {r[0] for r in got} == {"", "in"} and {"/again/" in r[3] for r in got} == {True, False}
    fn, sql = catalog.REGISTRY["files_for_day"]
    found = fn(spark, SF)
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(con.execute(f"select {', '.join(found.columns)} from ({sql}) q").fetchall()) and {r[0] for r in got} == {"", "in"}

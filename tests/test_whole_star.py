"""Checks and views over all of the star's tables, against their SQL."""

import duckdb
import pytest

from contractlake import schemas
from contractlake.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["party_duplicate_keys", "star_length_check", "star_view_full"])
def test_sql_agrees(spark, name):
    fn, sql = catalog.REGISTRY[name]
    con = duckdb.connect()
    for t in ("orders", "customer", "lineitem", "nation", "part", "region", "supplier", "events", "documents"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    found = fn(spark, SF)
    got = sorted(repr(tuple(r)) for r in found.collect())
    assert got and got == sorted(map(repr, con.execute(f"select {', '.join(found.columns)} from ({sql}) q").fetchall()))
    if name == "star_length_check":
        assert {r["table_name"] for r in found.where("too_long > 0").collect()} == set(schemas.STAR_A)
        assert found.count() == sum("max_length" in f.metadata for s in schemas.STAR_A.values() for f in s.fields)
    elif name == "party_duplicate_keys":
        assert {r["table_name"] for r in found.collect()} == {"compania_info", "proveedores_info"}
    else:
        assert found.where("proveedores is not null").count() and found.where("entidades is not null").count()

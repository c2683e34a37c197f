"""A sample of registered queries against their DuckDB oracle at sf0.001 (the driver runs all at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
NAMES = ["normalize_date", "classify_payload", "required_sections", "explode_fines", "star_entidades",
         "gate_events", "doc_stats", "extract_fields", "touch_updated_at", "contracts_by_type"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    from oracle_check import compare, duck
    from __spark_entry__ import oracle_sql, queries
    r = compare(spark, duck(SF), name, queries()[name], oracle_sql()[name], SF)
    assert r["ok"], r


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0 and df.columns == ["tipo_contrato", "tipo_servicio", "contracts", "total_amount"]

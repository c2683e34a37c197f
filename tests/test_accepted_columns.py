"""Tables made of normalized payloads read only the columns that they hold."""

import contextlib
import io
import json

import pytest

from contractlake.operators import payload as P
from contractlake.operators import star as ST
from contractlake.session import saved

WHOLE = {"Contrato": {"nombre": "c", "fecha_inicio": "2024-01-01"}, "CompaniaInfo": {"nombre": "a", "rut": "1"}, "ProveedoresInfo": [{"Nombre": "p"}],
         "Representantes": [{"nombre": "r", "cedula_identidad": "9"}], "Multas": [{"tipo_incumplimiento": "t"}], "Entidades": [{"tipo": "e", "valor": "v"}]}


@pytest.fixture(scope="module")
def norm(spark):
    rows = [("e1", json.dumps(WHOLE)), ("e2", "{}"), ("e3", None), ("e4", json.dumps([WHOLE]))]
    return saved(P.normalize_payloads(spark.createDataFrame(rows, "event_id string, payload string")), "normalized")


def scanned(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    scan = out.getvalue().split("FileScan parquet [")[1].split("]")[0]
    return {c.split("#")[0] for c in scan.split(",")}


@pytest.mark.parametrize("make, column", [(P.explode_reps, "reps"), (P.explode_fines, "fines"), (P.explode_entities, "entities"),
                                          (P.providers_as_list, "providers"), (P.main_entity, "entities")])
def test_children(norm, make, column):
    found = make(norm)
    assert scanned(found) == {"event_id", "reason", column}
    assert sorted(r["event_id"] for r in found.collect()) == ["e1", "e4"]


def test_rejects_and_whole_rows(norm):
    assert scanned(ST.rejected_contracts(norm)) == {"event_id", "reason"}
    assert sorted(map(tuple, ST.rejected_contracts(norm).collect())) == [("e2", "no_contract_data"), ("e3", "semantic extraction failed")]
    assert P.accepted(norm).columns == norm.columns and P.accepted(norm).count() == 2
    assert P.accepted(norm, "event_id", "contract").columns == ["reason", "event_id", "contract"]

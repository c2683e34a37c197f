"""Kinds of payloads, sections and elements are told without a schema of all that is inside them."""

import contextlib
import io
import json

from pyspark.sql import functions as F

from contractlake.operators import payload as P


def test_classification_infers_no_schema(spark):
    texts = ['{"a": {"b": 1}}', " [ {\"a\": 1} ]\n", " {} ", "[{}]", "[]", "[null]", "[[{}]]", '"{"', "{} x", "3", None]
    got = P.classify_payload(spark.createDataFrame(list(enumerate(texts)), "i int, payload string")).select("i", "reason")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        got.explain()
    assert "schema_of_variant" not in out.getvalue().lower()
    assert [r.reason for r in sorted(got.collect())] == [
        "ok", "ok", "no_contract_data", "no_contract_data", "empty_contract_data_list", "invalid_contract_data_structure", "invalid_contract_data_structure",
        "unexpected_contract_data_type", "json_decode_error", "unexpected_contract_data_type", "semantic extraction failed"]


def test_lists_of_objects_and_of_anything(spark):
    whole = {"Contrato": {"fecha_inicio": "2024-01-01"}, "CompaniaInfo": [{"Nombre": "c"}], "ProveedoresInfo": ["x", {"nombre": "second"}],
             "Multas": [None, {"tipo_incumplimiento": "a", "Tipo de incumplimiento": "b"}, [{"tipo_incumplimiento": "c"}], "{}", {"tipo_incumplimiento": " "}],
             "Entidades": [{"tipo": "t", "Tipo": "u", "nota": 1}, {"valor": ""}]}
    r = P.normalize_payloads(spark.createDataFrame([("e", json.dumps(whole))], "event_id string, payload string")).first()
    assert r.reason == "Missing ProveedoresInfo data" and r.company.nombre == "c" and r.provider.nombre == ""
    assert [(p.pos, p.nombre) for p in r.providers] == [(1, "second")]
    assert [(m.pos, m.tipo_incumplimiento, m.text) for m in r.fines] == [(1, "b", None), (4, "", '{"tipo_incumplimiento":" "}')]
    assert [(x.pos, x.tipo, x.text) for x in r.entities] == [(0, "u", None), (1, "", '{"valor":""}')]
    assert r.unmapped_keys is None   # no representatives section


def test_shape(spark):
    values = ['{"a": 1}', "{}", "[]", "[1]", '"{"', "1.5", "true", "null"]
    df = spark.createDataFrame([(v,) for v in values], "s string").select(F.try_parse_json("s").alias("v"))
    got = df.select(P.shape(F.col("v")).alias("s"), P.member_count(F.col("v")).alias("n")).collect()
    assert [r.s.split("(")[0] for r in got] == ["OBJECT", "OBJECT", "ARRAY", "ARRAY", "STRING", "DECIMAL", "BOOLEAN", "VOID"]
    assert [r.n for r in got] == [1, 0, None, None, None, None, None, None]


def test_kinds_copy_no_members(spark):
    df = spark.createDataFrame([('{"a": [1], "b": {"c": 2}}',), ('[{}, 1, null, [2]]',)], "s string").select(F.try_parse_json("s").alias("v"))
    found = df.select(P.shape(F.col("v")).alias("s"), P.member_count(F.col("v")).alias("n"))
    assert [tuple(r) for r in found.collect()] == [("OBJECT", 2), ("ARRAY", None)]
    plan = found._jdf.queryExecution().optimizedPlan()
    targets = [e for e in plan.toString().lower().split("try_variant_get(")[1:]]
    assert targets and not [t for t in targets if "variant>" in t or "varianttype" in t.split(")")[0]]

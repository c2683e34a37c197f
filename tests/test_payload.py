"""C1, C3-C15 and traps T3-T6, T10, T15 on literal payloads."""

import json

from pyspark.sql import functions as F

from contractlake.operators import payload as P
from contractlake.operators import star as ST

BASE = {"Contrato": {"tipo_contrato": "Servicios", "fecha_inicio": "2024-01-01", "monto_total": "1.500,00"},
        "CompaniaInfo": {"Nombre": "ACME", "RUT": "1-9"},
        "ProveedoresInfo": [{"nombre": "P1", "rut": "2-7"}, {"nombre": "P2", "rut": "3-5"}],
        "Representantes": [{"Nombre": " Ana ", "Cédula de Identidad": "11-1"}],
        "Multas": [{"Tipo de incumplimiento": "Retraso", "Monto de la multa en UF": "UF 5,5"},
                   {"tipo_incumplimiento": "  "}, "x"],
        "Entidades": [{"Tipo_entidad": "Persona", "nombre": "Ana"}, {"tipo": "", "valor": ""}]}


def _norm(spark, payloads):
    rows = [(f"e{i:03d}", p) for i, p in enumerate(payloads)]
    return P.normalize_payloads(spark.createDataFrame(rows, "event_id string, payload string"))


def test_classify(spark):
    ps = [None, "{bad", "[]", '["x"]', "null", "3", "{}", "[{}]", json.dumps(BASE), "[" + json.dumps(BASE) + "]"]
    got = [r.reason for r in P.classify_payload(
        spark.createDataFrame([(str(i), p) for i, p in enumerate(ps)], "event_id string, payload string"))
        .orderBy("event_id").collect()]
    assert got == ["semantic extraction failed", "json_decode_error", "empty_contract_data_list",
                   "invalid_contract_data_structure", "unexpected_contract_data_type",
                   "unexpected_contract_data_type", "no_contract_data", "no_contract_data", "ok", "ok"]


def test_accepted_contract_and_children(spark):
    n = _norm(spark, [json.dumps(BASE)])
    r = n.collect()[0]
    assert r.reason == "ok"
    c = r.contract
    assert c.tipo_servicio == "Servicios Generales"          # absent -> default (T5)
    assert str(c.fecha_termino) == "2024-12-31"             # D5
    assert str(c.monto_total) == "0.00"                     # T7: two separators -> 0
    assert c.multa_monto == 0 and c.multa_penalidades == ""  # T3
    assert r.company.nombre == "ACME" and r.company.domicilio == ""
    assert r.provider.nombre == "P1"                        # T4: first provider only
    assert [p.nombre for p in r.providers] == ["P1", "P2"]  # C14
    assert [(x.nombre, x.cedula_identidad) for x in r.reps] == [("Ana", "11-1")]
    fines = P.explode_fines(n).collect()
    assert [(f.tipo_incumplimiento, float(f.monto_multa_uf)) for f in fines] == [("Retraso", 5.5)]   # DECIMAL(38,12) since D3 keeps every digit
    ents = P.explode_entities(n).collect()
    assert [(e.tipo, e.valor) for e in ents] == [("Persona", "Ana")]


def test_reject_rules(spark):
    def with_(**kw):
        d = json.loads(json.dumps(BASE))
        for k, v in kw.items():
            if v is KeyError:
                d.pop(k)
            else:
                d[k] = v
        return json.dumps(d)
    ps = [with_(Contrato={}), with_(CompaniaInfo=None), with_(ProveedoresInfo=[]), with_(Representantes=None),
          with_(Representantes=[{"nombre": None}]), with_(Multas=3), with_(Multas="none"),
          with_(Contrato={"fecha_inicio": "5/1/2024"}), with_(Contrato={"fecha_inicio": "5/1/2024", "fecha_termino": "2025-01-01"}),
          with_(Representantes=KeyError), with_(CompaniaInfo={"rut": "x" * 21})]
    got = [r.reason for r in _norm(spark, ps).orderBy("event_id").collect()]
    assert got == ["Missing Contrato data", "Missing CompaniaInfo data", "Missing ProveedoresInfo data",
                   "Representantes is not iterable", "representative field is not text", "Multas is not iterable",
                   "ok", "invalid fecha_inicio for default fecha_termino", "ok", "ok",
                   "database_error: value too long for CompaniaInfo"]


def test_last_alias_wins_and_alias_gap(spark):
    p = json.loads(json.dumps(BASE))
    p["Multas"] = [{"tipo_incumplimiento": "A", "Tipo de incumplimiento": "B",
                    "Monto de la Multa en UF": "9", "Descripción Completa": "d"}]
    n = _norm(spark, [json.dumps(p)])
    f = P.explode_fines(n).collect()[0]
    assert f.tipo_incumplimiento == "B"          # G4
    assert f.monto_multa_uf is None              # T6: unmapped alias, value lost
    assert f.descripcion_completa == ""
    assert "Monto de la Multa en UF" in n.collect()[0].unmapped_keys


def test_star_ids_and_keys(spark):
    ps = [json.dumps(BASE)] * 3 + ["{}"]
    s = ST.build_star(_norm(spark, ps))
    assert [r.id for r in s.contrato.orderBy("id").collect()] == [1, 2, 3]
    m = s.multas.orderBy("id").collect()
    assert [(r.id, r.contrato_id) for r in m] == [(1, 1), (2, 2), (3, 3)]
    assert s.rejected.count() == 1


def test_unreadable_values_reject_the_contract_and_are_kept(spark):
    given = [{"exclusividad_activo": "quiza"}, {"termino_anticipado_plazo_dias": "treinta"},
             {"exclusividad_activo": None, "termino_anticipado_plazo_dias": None, "renovacion_automatica": "true"}, {"termino_anticipado_plazo_dias": "2147483648"}]
    ps = [json.dumps({**BASE, "Contrato": {**BASE["Contrato"], **g}}) for g in given] + ["{"]
    n = _norm(spark, ps).orderBy("event_id").collect()
    assert [r.reason for r in n] == ["database_error: value can't be read"] * 2 + ["ok", "database_error: value can't be read", "json_decode_error"]
    assert [r.rejected_field for r in n] == ["exclusividad_activo", "termino_anticipado_plazo_dias", None, "termino_anticipado_plazo_dias", "payload"]
    assert [r.rejected_payload for r in n] == [ps[0], ps[1], None, ps[3], "{"]


def test_rows_that_are_not_stored_are_quarantined(spark):
    p = json.loads(json.dumps(BASE))
    p["Multas"] = [{"tipo_incumplimiento": " "}, {"tipo_incumplimiento": "a", "monto_multa_uf": "1" * 40}, {"tipo_incumplimiento": "b", "plazo_constancia": "x" * 256}, "x",
                   {"tipo_incumplimiento": "c", "monto_multa_uf": 0.0125}]
    p["Entidades"] = [{"tipo": "", "valor": None}, {"tipo": "y" * 256, "valor": "v"}, {"tipo": "ok"}]
    n = _norm(spark, [json.dumps(p), "[]"])
    got = sorted((r.scope, r.pos if r.pos is not None else -1, r.field, r.reason) for r in P.quarantine(n).collect())
    assert got == [("contract", -1, "payload", "empty_contract_data_list"), ("entity", 0, "tipo, valor", "missing"), ("entity", 1, "tipo", "value too long"),
                   ("fine", 0, "tipo_incumplimiento", "missing"), ("fine", 1, "monto_multa_uf", "amount out of range"), ("fine", 2, "plazo_constancia", "value too long")]
    kept = {r.payload for r in P.quarantine(n).collect()}
    assert "[]" in kept and any("1" * 40 in x for x in kept)
    assert [(f.pos, str(f.monto_multa_uf)) for f in P.explode_fines(n).collect()] == [(4, "0.012500000000")]
    assert [(e.pos, e.tipo) for e in P.explode_entities(n).collect()] == [(2, "ok")]


def test_safe_get_in_objects_and_lists(spark):
    rows = [('{"k": 1}',), ('[2, {"x": 0}, {"k": null}, {"k": 3}]',), ('[{"x": 1}]',), ("[]",), ("3",), ("null",), (None,), ('{"a key": "v"}',)]
    df = spark.createDataFrame(rows, "s string").select(F.try_parse_json("s").alias("v"))
    got = df.select(P.safe_get(F.col("v"), "k").isNotNull().alias("found"), F.try_variant_get(P.safe_get(F.col("v"), "k"), "$", "string").alias("k"),
                    F.try_variant_get(P.safe_get(F.col("v"), "a key"), "$", "string").alias("a")).collect()
    assert [tuple(r) for r in got] == [(True, "1", None), (True, None, None)] + [(False, None, None)] * 5 + [(False, None, "v")]


def test_entities_of_an_object_keep_its_order(spark):
    rows = [(1, '{"z": {"tipo": "T", "valor": " V "}, "a": 3, "b": {"valor": "old", "Valor": "new"}, "c": [{"tipo": "no"}], "d": null, "e": {}}'), (2, "[1]"), (3, None), (4, "{}"), (5, "{")]
    got = P.entities_from_map(spark.createDataFrame(rows, "id int, s string"), "s", "id").collect()
    assert [tuple(r) for r in got] == [(1, 0, "z", "T", "V"), (1, 2, "b", "", "new"), (1, 5, "e", "", "")]

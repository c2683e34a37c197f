"""Payload normalization.

One extractor payload (JSON text) per row becomes, in the same row and without any shuffle:
  status / reason          C1 shape classification, then the first failing contract rule
  contract struct          B10 projection with absent-key defaults (C15, D5, D6)
  company / provider       C3 + C6 (first provider only, T4)
  reps / fines / entities  arrays of typed structs (C9-C11, B11, C4-C7, G4)
Typed JSON tests use VARIANT (``try_parse_json``); key order, which decides which alias wins,
comes from ``from_json(..., 'map<string,variant>')``, which keeps document order.
Everything is built-in expressions and higher-order functions, so it stays JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlake.functions import canon
from contractlake.functions.scalars import (
    AS_OF, DEFAULT_TIPO_CONTRATO, DEFAULT_TIPO_SERVICIO, date_not_text, default_end_date, flag_value,
    int_value, is_arr, is_falsy, is_obj, iso_date_strict, normalize_date, normalize_date_text,
    normalize_decimal, once, py_strip, safe_string, uf_amount, unreadable, variant_text, vtype,
)

SECTIONS = ["Contrato", "Multas", "CompaniaInfo", "ProveedoresInfo", "Representantes", "Entidades"]
CONTRACT_FIELDS = ["tipo_contrato", "tipo_servicio", "parte_cliente", "parte_proveedor",
                   "fecha_inicio", "fecha_termino", "renovacion_automatica", "monto_total",
                   "termino_anticipado_activo", "termino_anticipado_plazo_dias",
                   "exclusividad_activo", "exclusividad_detalles", "descripcion", "nombre"]
METADATA_FIELDS = ["nombre_documento", "numero_pagina", "anexos_incluidos", "referencia_interna"]

# Declared VARCHAR lengths whose overflow fails the whole contract in the reference (K6, K7).
CONTRACT_LIMITS = {"tipo_contrato": 255, "tipo_servicio": 255, "parte_cliente": 255,
                   "parte_proveedor": 255, "nombre": 255}
PARTY_LIMITS = {"nombre": 255, "rut": 20, "domicilio": 255}
REP_LIMITS = {"nombre": 255, "cedula_identidad": 50}
# ... and those whose overflow only skips the row.
FINE_ROW_LIMITS = {"plazo_constancia": 255}
ENTITY_ROW_LIMITS = {"tipo": 255}

FLAG_FIELDS = ["renovacion_automatica", "termino_anticipado_activo", "exclusividad_activo"]
INT_FIELDS = ["termino_anticipado_plazo_dias"]

QUARANTINED = "array<struct<scope:string,pos:int,field:string,reason:string,payload:string>>"
OK = "ok"


# ---------------------------------------------------------------------------
# Shape classification
# ---------------------------------------------------------------------------

def parse_variant(text: Column) -> Column:
    """``try_parse_json`` plus the strictness Python's loader has and Spark's lacks: text that
    opens with a bracket must also close with one (no trailing garbage)."""
    bracket = opening(text)
    opens = bracket.isin("{", "[")
    closes = F.when(text.endswith("}") | text.endswith("]"), F.lit(True)).otherwise(F.right(py_strip(text), F.lit(1)).isin("}", "]"))
    tail_ok = ~opens | closes
    return F.when(tail_ok, F.try_parse_json(text))


def opening(text: Column) -> Column:
    """First character behind white space. Trimming walks through all of a text, so it's left to those that need it."""
    return F.when(text.startswith("{"), "{").when(text.startswith("["), "[").otherwise(F.left(py_strip(text), F.lit(1)))


#: What members and elements are read as where only their number or kind counts: a VARIANT would copy each of them, a struct without
#: fields copies nothing. Objects give an empty one, all else NULL.
UNREAD = "struct<>"


def member_count(v: Column) -> Column:
    """Number of members of an object (VARIANT), NULL for any other value. Unlike ``vtype`` it doesn't look into the members."""
    members = F.try_variant_get(v, "$", f"map<string,{UNREAD}>")
    return F.when(members.isNotNull(), F.size(members))


def shape(v: Column) -> Column:
    """``vtype`` without what is inside: 'OBJECT', 'ARRAY', or the type of a scalar."""
    return (F.when(F.try_variant_get(v, "$", f"array<{UNREAD}>").isNotNull(), "ARRAY")
            .when(F.try_variant_get(v, "$", UNREAD).isNotNull(), "OBJECT")
            .otherwise(vtype(v)))


def classify_payload(df: DataFrame, payload_col: str = "payload") -> DataFrame:
    """C1. Adds ``reason`` (``ok`` or the reference's reason), ``_obj`` (VARIANT of the contract
    object) and ``_obj_text`` (its text in document order)."""
    p = F.col(payload_col)
    c = df.withColumn("_v", parse_variant(p))
    # what was read starts with the bracket of its kind
    bracket = F.when(F.col("_v").isNotNull(), opening(p))
    c = c.withColumns({"_obj_in": bracket == "{", "_list_in": bracket == "["})
    v, is_o, is_l = F.col("_v"), F.col("_obj_in"), F.col("_list_in")
    c = c.withColumn("_f0", F.when(is_l, F.try_variant_get(v, "$[0]", "variant")))
    f0 = F.col("_f0")
    c = c.withColumn("_members", F.when(is_o, member_count(v)).when(is_l, member_count(f0)))
    f0_obj = F.col("_members").isNotNull()
    obj = F.when(is_o, v).when(is_l & f0_obj, f0)
    obj_text = F.when(is_o, p).when(is_l, F.try_element_at(F.from_json(p, "array<string>"), F.lit(1)))
    reason = (F.when(p.isNull(), "semantic extraction failed")
              .when(v.isNull(), "json_decode_error")
              .when(is_l & f0.isNull(), "empty_contract_data_list")
              .when(is_l & ~f0_obj, "invalid_contract_data_structure")
              .when(~(is_l | is_o), "unexpected_contract_data_type")
              .when(F.col("_members") == 0, "no_contract_data")
              .otherwise(OK))
    return (c.withColumn("reason", reason)
            .withColumns({"_obj": F.when(F.col("reason") == OK, obj), "_obj_text": F.when(F.col("reason") == OK, obj_text)})
            .drop("_v", "_obj_in", "_list_in", "_f0", "_members"))


# ---------------------------------------------------------------------------
# C2 / C3 / B11 / H2 helpers
# ---------------------------------------------------------------------------

def _member(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f'$["{key}"]', "variant")


def safe_get(source: Column, key: str) -> Column:
    """VARIANT of ``key`` in an object, or in the first object of a list that has it; SQL NULL where there is none.
    A JSON null under the key is a value."""
    kind = vtype(source)
    objects = F.filter(F.when(is_arr(kind), F.try_variant_get(source, "$", "array<variant>")), lambda x: is_obj(vtype(x)))
    found = F.filter(F.transform(objects, lambda x: _member(x, key)), lambda v: v.isNotNull())
    return F.when(is_obj(kind), _member(source, key)).otherwise(F.try_element_at(found, F.lit(1)))


def ensure_object(sec_v: Column, sec_s: Column) -> Column:
    """Object -> itself; list -> first element only if it is an object (T4); else none.
    Arguments: section VARIANT, its ``shape``. Returns the VARIANT of the object."""
    first = F.try_variant_get(sec_v, "$[0]", "variant")
    return F.when(is_obj(sec_s), sec_v).when(is_arr(sec_s) & member_count(first).isNotNull(), first)


def object_elements(sec_v: Column, sec_s: Column, sec_text: Column, kind: str, single_ok: bool = False) -> Column:
    """B11 + C9-C11: ``ARRAY<STRUCT<pos INT, e ARRAY<STRUCT<key,value,raw>>>>`` of the object
    elements of a repeated section (non-objects skipped, positions kept), keys canonicalized.
    With ``single_ok`` a single object counts as a one-element list (entities C11, providers C14);
    otherwise only lists yield elements (a text or object section iterates to nothing, T15).
    A list of objects alone is read at once; one with other elements, which that reader refuses, element by element."""
    one = "map<string,variant>"
    mixed = F.exists(F.try_variant_get(sec_v, "$", f"array<{UNREAD}>"), lambda m: m.isNull())
    apart = F.zip_with(F.from_json(sec_text, "array<string>"), F.try_variant_get(sec_v, "$", "array<variant>"),
                       lambda t, v: F.when(member_count(v).isNotNull(), F.from_json(t, one)))
    objects = F.when(mixed, apart).otherwise(F.from_json(sec_text, f"array<{one}>"))
    indexed = F.transform(objects, lambda m, i: F.struct(i.alias("pos"), canon.canon_entries(kind, m).alias("e")))
    out = F.when(is_arr(sec_s), F.filter(indexed, lambda x: x["e"].isNotNull()))
    if single_ok:
        out = out.when(is_obj(sec_s), F.array(F.struct(F.lit(0).alias("pos"), canon.canon_entries(kind, F.from_json(sec_text, one)).alias("e"))))
    return out


def element_texts(sec_s: Column, sec_text: Column) -> Column:
    """The JSON text of each element of a repeated section, by position; a single object is its only element."""
    return F.when(is_arr(sec_s), F.from_json(sec_text, "array<string>")).otherwise(F.array(sec_text))


def text_field(entries: Column, name: str, default: str | None = "") -> Column:
    """Canonical field as text: absent -> ``default``; JSON null -> NULL."""
    return F.when(canon.has_field(entries, name), variant_text(canon.field(entries, name))) \
        .otherwise(F.lit(default))


# ---------------------------------------------------------------------------
# C8 + B10 + C15: the whole payload row
# ---------------------------------------------------------------------------

def normalize_payloads(df: DataFrame, payload_col: str = "payload", as_of: str = AS_OF,
                       keep_penalty_fields: bool = False) -> DataFrame:
    """Payload rows -> one normalized row per payload.

    Output columns: input columns except the payload, ``reason`` (``ok`` when accepted),
    ``contract`` struct, ``company`` / ``provider`` structs, ``providers`` / ``reps`` /
    ``fines`` / ``entities`` arrays of structs, ``unmapped_keys`` (T6 side column); of a rejected payload
    ``rejected_field`` and the whole ``rejected_payload``. A fine or entity that won't be stored has a ``problem``
    (field, reason) and its JSON ``text``.

    Built in stages: every VARIANT, its type string and its text are computed once as a column
    and then referenced, which keeps each generated method small enough for whole-stage codegen.
    """
    c = classify_payload(df, payload_col)
    c = c.withColumn("_sec", F.from_json(F.col("_obj_text"), "map<string,string>"))
    c = c.withColumns({f"_v_{s}": F.try_variant_get(F.col("_obj"), f"$.{s}", "variant") for s in SECTIONS}
                      | {f"_t_{s}": F.try_element_at(F.col("_sec"), F.lit(s)) for s in SECTIONS})
    c = c.withColumns({f"_s_{s}": shape(F.col(f"_v_{s}")) for s in SECTIONS})

    def sec(s: str) -> tuple[Column, Column, Column]:
        return F.col(f"_v_{s}"), F.col(f"_s_{s}"), F.col(f"_t_{s}")

    # Contrato object (keys used as given) and its fields: VARIANT, type, text -- once each.
    c = c.withColumn("_c", ensure_object(F.col("_v_Contrato"), F.col("_s_Contrato")))
    fields = CONTRACT_FIELDS + (["multa_monto", "multa_penalidades"] if keep_penalty_fields else [])
    c = c.withColumns({f"_f_{f}": F.try_variant_get(F.col("_c"), f"$.{f}", "variant") for f in fields})
    c = c.withColumns({f"_fs_{f}": vtype(F.col(f"_f_{f}")) for f in fields} | {f"_ft_{f}": variant_text(F.col(f"_f_{f}")) for f in fields})

    def fv(f: str) -> tuple[Column, Column, Column]:
        return F.col(f"_f_{f}"), F.col(f"_fs_{f}"), F.col(f"_ft_{f}")

    start_v, start_s, start_txt = fv("fecha_inicio")
    start_present = start_v.isNotNull()
    c = c.withColumns({"_start_text": F.when(start_present, start_txt).otherwise(F.date_format(F.to_timestamp_ntz(F.lit(as_of)), "yyyy-MM-dd")),
                       "_end_falsy": is_falsy(*fv("fecha_termino"))})
    start_text, end_falsy = F.col("_start_text"), F.col("_end_falsy")
    start_bad_for_default = end_falsy & ~((~start_present | (start_s == "STRING"))
                                          & iso_date_strict(start_text).isNotNull())

    def with_default(f: str, d) -> Column:
        return F.when(F.col(f"_f_{f}").isNotNull(), F.col(f"_ft_{f}")).otherwise(F.lit(d))

    def flag(f: str) -> Column:
        return F.when(F.col(f"_f_{f}").isNotNull(), flag_value(*fv(f))).otherwise(F.lit(False))

    contract_cols = [
        with_default("tipo_contrato", DEFAULT_TIPO_CONTRATO).alias("tipo_contrato"),
        with_default("tipo_servicio", DEFAULT_TIPO_SERVICIO).alias("tipo_servicio"),
        with_default("parte_cliente", "").alias("parte_cliente"),
        with_default("parte_proveedor", "").alias("parte_proveedor"),
        F.when(start_present, normalize_date(*fv("fecha_inicio")))
         .otherwise(normalize_date_text(start_text)).alias("fecha_inicio"),
        F.when(end_falsy, default_end_date(start_text))
         .otherwise(normalize_date(*fv("fecha_termino"))).alias("fecha_termino"),
        flag("renovacion_automatica").alias("renovacion_automatica"),
        normalize_decimal(*fv("monto_total")).alias("monto_total"),
        (normalize_decimal(*fv("multa_monto")) if keep_penalty_fields
         else F.lit(0).cast("decimal(18,2)")).alias("multa_monto"),
        (F.coalesce(F.col("_ft_multa_penalidades"), F.lit("")) if keep_penalty_fields
         else F.lit("")).alias("multa_penalidades"),
        flag("termino_anticipado_activo").alias("termino_anticipado_activo"),
        int_value(F.col("_f_termino_anticipado_plazo_dias"), F.col("_ft_termino_anticipado_plazo_dias"))
         .alias("termino_anticipado_plazo_dias"),
        flag("exclusividad_activo").alias("exclusividad_activo"),
        F.col("_ft_exclusividad_detalles").alias("exclusividad_detalles"),
        F.col("_ft_descripcion").alias("descripcion"),
        F.col("_ft_nombre").alias("nombre"),
    ]
    # What the store can't read as a flag or a whole number fails the row there, and with it the contract.
    readable = {f: flag_value(*fv(f)) for f in FLAG_FIELDS} | {f: int_value(F.col(f"_f_{f}"), F.col(f"_ft_{f}")) for f in INT_FIELDS}
    bad_value = F.coalesce(*[F.when(unreadable(F.col(f"_f_{f}"), F.col(f"_fs_{f}"), value), F.lit(f)) for f, value in readable.items()])
    # D2 raises on a truthy non-text date; the default end date is text, so only given values count.
    date_error = F.when(date_not_text(*fv("fecha_inicio")), "fecha_inicio").when(~end_falsy & date_not_text(*fv("fecha_termino")), "fecha_termino")

    c = c.withColumns({
        "_comps": object_elements(*sec("CompaniaInfo"), "company", single_ok=True),
        "_reps": object_elements(*sec("Representantes"), "rep"), "_fines": object_elements(*sec("Multas"), "fine"),
        "_ents": object_elements(*sec("Entidades"), "entity", single_ok=True),
        "_provs": object_elements(*sec("ProveedoresInfo"), "company", single_ok=True)})

    def first_object(elements: Column) -> Column:
        first = F.try_element_at(elements, F.lit(1))
        return F.when(first["pos"] == 0, first["e"])

    c = c.withColumns({"_comp_e": first_object(F.col("_comps")), "_prov_e": first_object(F.col("_provs"))})

    def party(e: Column) -> Column:
        return F.struct(text_field(e, "nombre").alias("nombre"), text_field(e, "rut").alias("rut"),
                        text_field(e, "domicilio").alias("domicilio"))

    def rep_field_bad(e: Column, name: str) -> Column:
        return canon.has_field(e, name) & (vtype(canon.field(e, name)) != "STRING")

    def stripped(e: Column, name: str) -> Column:
        return F.when(canon.has_field(e, name), py_strip(variant_text(canon.field(e, name)))).otherwise(F.lit(""))

    reps = F.transform(F.col("_reps"), lambda r: F.struct(
        r["pos"].alias("pos"), stripped(r["e"], "nombre").alias("nombre"),
        stripped(r["e"], "cedula_identidad").alias("cedula_identidad")))
    rep_type_error = F.exists(F.col("_reps"), lambda r: rep_field_bad(r["e"], "nombre")
                              | rep_field_bad(r["e"], "cedula_identidad"))

    def ftext(e: Column, name: str) -> Column:
        return variant_text(canon.field(e, name))

    def uf(e: Column) -> Column:
        return once(canon.field(e, "monto_multa_uf"), lambda value: once(F.struct(vtype(value).alias("kind"), variant_text(value).alias("text")),
                                                                         lambda x: uf_amount(value, x["kind"], x["text"])))

    # read in one step, judged in the next: each expression is evaluated once per element
    fines = F.transform(F.col("_fines"), lambda m: F.struct(
        m["pos"].alias("pos"),
        safe_string(ftext(m["e"], "tipo_incumplimiento")).alias("tipo_incumplimiento"),
        safe_string(ftext(m["e"], "implicancias")).alias("implicancias"),
        uf(m["e"]).alias("uf"),
        safe_string(ftext(m["e"], "plazo_constancia")).alias("plazo_constancia"),
        safe_string(ftext(m["e"], "descripcion_completa")).alias("descripcion_completa")))
    ents = F.transform(F.col("_ents"), lambda x: F.struct(
        x["pos"].alias("pos"), safe_string(ftext(x["e"], "tipo")).alias("tipo"),
        safe_string(ftext(x["e"], "valor")).alias("valor")))
    c = c.withColumns({"_fine_rows": fines, "_ent_rows": ents})

    def judged(cols: list[Column], problems: list[tuple[str, Column, str]]) -> Column:
        problem = F.lit(None).cast("struct<field:string,reason:string>")
        for name, bad, why in reversed(problems):
            problem = F.when(bad, F.struct(F.lit(name).alias("field"), F.lit(why).alias("reason"))).otherwise(problem)
        return F.struct(*cols, problem.alias("problem"))

    fines = F.transform(F.col("_fine_rows"), lambda m: judged(
        [m["pos"].alias("pos"), m["tipo_incumplimiento"].alias("tipo_incumplimiento"), m["implicancias"].alias("implicancias"),
         m["uf"]["amount"].alias("monto_multa_uf"), m["plazo_constancia"].alias("plazo_constancia"),
         m["descripcion_completa"].alias("descripcion_completa")],
        [("tipo_incumplimiento", m["tipo_incumplimiento"] == "", "missing"), ("monto_multa_uf", m["uf"]["no_room"], "amount out of range"),
         *[(k, F.char_length(m[k]) > n, "value too long") for k, n in FINE_ROW_LIMITS.items()]]))
    ents = F.transform(F.col("_ent_rows"), lambda x: judged(
        [x["pos"].alias("pos"), x["tipo"].alias("tipo"), x["valor"].alias("valor")],
        [("tipo, valor", (x["tipo"] == "") & (x["valor"] == ""), "missing"),
         *[(k, F.char_length(x[k]) > n, "value too long") for k, n in ENTITY_ROW_LIMITS.items()]]))

    c = c.withColumns({"_fine_rows": fines, "_ent_rows": ents})

    # the JSON text of what has a problem; a section without any isn't read again
    c = c.withColumns({f"{rows}_texts": F.when(F.exists(F.col(rows), lambda x: x["problem"].isNotNull()), element_texts(*sec(section)[1:]))
                       for rows, section in (("_fine_rows", "Multas"), ("_ent_rows", "Entidades"))})

    def with_texts(rows: str, fields: list[str]) -> Column:
        def kept(x: Column, text: Column) -> Column:
            return F.struct(*[x[f].alias(f) for f in fields], text.alias("text"))
        return F.transform(F.col(rows), lambda x: kept(x, F.when(x["problem"].isNotNull(), F.get(F.col(f"{rows}_texts"), x["pos"]))))

    fines = with_texts("_fine_rows", ["pos", "tipo_incumplimiento", "implicancias", "monto_multa_uf", "plazo_constancia", "descripcion_completa", "problem"])
    ents = with_texts("_ent_rows", ["pos", "tipo", "valor", "problem"])

    provs = F.transform(F.col("_provs"), lambda x: F.struct(
        x["pos"].alias("pos"), text_field(x["e"], "nombre").alias("nombre"),
        text_field(x["e"], "rut").alias("rut"), text_field(x["e"], "domicilio").alias("domicilio")))

    known = {"rep": ["nombre", "cedula_identidad"],
             "fine": ["tipo_incumplimiento", "implicancias", "monto_multa_uf", "plazo_constancia",
                      "descripcion_completa"],
             "entity": ["tipo", "valor"]}
    unmapped = F.array_distinct(F.flatten(F.array(*[
        canon.unmapped_keys(F.flatten(F.col(f"{rows}.e")), known[kind]) for rows, kind in (("_reps", "rep"), ("_fines", "fine"), ("_ents", "entity"))])))

    def not_iterable(s: str) -> Column:
        return F.col(f"_s_{s}").isNotNull() & ~(is_arr(F.col(f"_s_{s}")) | is_obj(F.col(f"_s_{s}"))
                                                | (F.col(f"_s_{s}") == "STRING"))

    def too_long(vals: dict[str, Column], limits: dict[str, int]) -> Column:
        out = F.lit(False)
        for k, n in limits.items():
            out = out | F.coalesce(F.char_length(vals[k]) > n, F.lit(False))
        return out

    c = c.withColumns({
        "contract": F.struct(*contract_cols), "company": party(F.col("_comp_e")), "provider": party(F.col("_prov_e")),
        "reps": reps, "fines": fines, "entities": ents, "providers": provs, "unmapped_keys": unmapped,
        "_rep_type_error": rep_type_error, "_date_error": date_error, "_bad_value": bad_value, "_start_bad": start_bad_for_default})

    ct, co, pv = F.col("contract"), F.col("company"), F.col("provider")
    # (reason, field at fault, condition), in the order in which the rules are applied
    rules = [
        ("Missing Contrato data", F.lit("Contrato"), F.coalesce(member_count(F.col("_c")), F.lit(0)) == 0),
        ("invalid fecha_inicio for default fecha_termino", F.lit("fecha_inicio"), F.col("_start_bad")),
        ("Missing CompaniaInfo data", F.lit("CompaniaInfo"), F.coalesce(F.cardinality(F.col("_comp_e")), F.lit(0)) <= 0),
        ("Missing ProveedoresInfo data", F.lit("ProveedoresInfo"), F.coalesce(F.cardinality(F.col("_prov_e")), F.lit(0)) <= 0),
        ("Representantes is not iterable", F.lit("Representantes"), not_iterable("Representantes")),
        ("representative field is not text", F.lit("Representantes"), F.col("_rep_type_error")),
        ("Multas is not iterable", F.lit("Multas"), not_iterable("Multas")),
        ("database_error: date is not text", F.col("_date_error"), F.col("_date_error").isNotNull()),
        ("database_error: value can't be read", F.col("_bad_value"), F.col("_bad_value").isNotNull()),
        *[(f"database_error: value too long for {table}", F.lit(table), too_long({k: of[k] for k in limits}, limits))
          for table, of, limits in (("Contrato", ct, CONTRACT_LIMITS), ("CompaniaInfo", co, PARTY_LIMITS), ("ProveedoresInfo", pv, PARTY_LIMITS))],
        ("database_error: value too long for Representantes", F.lit("Representantes"),
         F.exists(F.col("reps"), lambda r: too_long({k: r[k] for k in REP_LIMITS}, REP_LIMITS))),
    ]
    verdict = F.struct(F.lit(OK).alias("reason"), F.lit(None).cast("string").alias("field"))
    for why, name, broken in reversed(rules):
        verdict = F.when(broken, F.struct(F.lit(why).alias("reason"), name.alias("field"))).otherwise(verdict)
    verdict = F.when(F.col("reason") != OK, F.struct(F.col("reason"), F.lit("payload").alias("field"))).otherwise(verdict)
    c = c.withColumn("_verdict", verdict).withColumns({"reason": F.col("_verdict.reason"), "rejected_field": F.col("_verdict.field")})
    c = c.withColumn("rejected_payload", F.when(F.col("reason") != OK, F.col(payload_col)))
    return c.drop(*[x for x in c.columns if x.startswith("_")], payload_col)


def keep_rows(df: DataFrame, cond: Column) -> DataFrame:
    """Row selection on a *derived* column, as a generator instead of a Filter.

    A Filter on ``reason`` would be pushed below the staged projections that compute it, and
    predicate pushdown substitutes every alias on the way: the predicate tree then grows
    exponentially and the normalizer would be evaluated twice (once in the filter, once in the
    projection). ``inline(when(cond, array(struct(*cols))))`` emits the row or nothing and is
    not a predicate, so each expression is computed once, in one pass.
    """
    return df.select(F.inline(F.when(cond, F.array(F.struct(*[F.col(c) for c in df.columns])))))


def accepted(norm: DataFrame, *columns: str) -> DataFrame:
    """Accepted payloads: ``columns`` of them, or all. A generator's struct isn't pruned, so columns that aren't named here
    would be read and copied row by row even if nothing above uses them."""
    return keep_rows(norm.select("reason", *columns) if columns else norm, F.col("reason") == OK)


def rejected(norm: DataFrame, *columns: str) -> DataFrame:
    return keep_rows(norm.select("reason", *columns) if columns else norm, F.col("reason") != OK)


# ---------------------------------------------------------------------------
# Child rows (exploded separately from the same normalized row, never chained)
# ---------------------------------------------------------------------------

def explode_reps(norm: DataFrame, key: str = "event_id") -> DataFrame:
    """C9 + D8: representatives of accepted contracts, one row each."""
    return (accepted(norm, key, "reps").select(key, F.explode("reps").alias("r"))
            .select(key, "r.pos", "r.nombre", "r.cedula_identidad"))


def explode_fines(norm: DataFrame, key: str = "event_id", validate: bool = True) -> DataFrame:
    """C10 + B6 + D3 + D4: fines of accepted contracts; blank breach type, an amount without room and row-level
    length failures are skipped (K7 row scope, see ``quarantine``)."""
    f = F.col("fines")
    if validate:
        f = F.filter(f, lambda m: m["problem"].isNull())
    return (accepted(norm, key, "fines").select(key, F.explode(f).alias("f"))
            .select(key, "f.pos", "f.tipo_incumplimiento", "f.implicancias", "f.monto_multa_uf",
                    "f.plazo_constancia", "f.descripcion_completa"))


def valid_fines(fines: DataFrame) -> DataFrame:
    """Non-empty breach type (already trimmed); plus the row-level length rule."""
    cond = F.col("tipo_incumplimiento") != ""
    for k, n in FINE_ROW_LIMITS.items():
        cond = cond & (F.char_length(k) <= n)
    return fines.filter(cond)


def explode_entities(norm: DataFrame, key: str = "event_id", validate: bool = True) -> DataFrame:
    """C11 + C12 + D4: entities of accepted contracts. The legacy single blank fallback entity
    (C12) is always dropped by B7, so it is never materialized."""
    x = F.col("entities")
    if validate:
        x = F.filter(x, lambda e: e["problem"].isNull())
    return accepted(norm, key, "entities").select(key, F.explode(x).alias("x")).select(key, "x.pos", "x.tipo", "x.valor")


def valid_entities(ents: DataFrame) -> DataFrame:
    """Drop only when both fields are empty; plus the row-level length rule."""
    cond = (F.col("tipo") != "") | (F.col("valor") != "")
    for k, n in ENTITY_ROW_LIMITS.items():
        cond = cond & (F.char_length(k) <= n)
    return ents.filter(cond)


def providers_as_list(norm: DataFrame, key: str = "event_id") -> DataFrame:
    """C14: every provider object of the section (the live path keeps only the first, T4)."""
    return (accepted(norm, key, "providers").select(key, F.explode("providers").alias("p"))
            .select(key, "p.pos", "p.nombre", "p.rut", "p.domicilio"))


def quarantine(norm: DataFrame, key: str = "event_id") -> DataFrame:
    """What was not stored, with the whole text that it came in: (key, scope, pos, field, reason, payload). Scope ``contract``
    for rejected payloads; ``fine`` and ``entity`` for the rows that an accepted contract lost (K7)."""
    def lost(scope: str, rows: str) -> Column:
        bad = F.transform(F.filter(F.col(rows), lambda x: x["problem"].isNotNull()), lambda x: F.struct(
            F.lit(scope).alias("scope"), x["pos"].alias("pos"), x["problem"]["field"].alias("field"),
            x["problem"]["reason"].alias("reason"), x["text"].alias("payload")))
        return F.coalesce(bad, F.array()).cast(QUARANTINED)

    whole = F.array(F.struct(F.lit("contract").alias("scope"), F.lit(None).cast("int").alias("pos"), F.col("rejected_field").alias("field"),
                             F.col("reason").alias("reason"), F.col("rejected_payload").alias("payload"))).cast(QUARANTINED)
    rows = F.when(F.col("reason") != OK, whole).otherwise(F.concat(lost("fine", "fines"), lost("entity", "entities")))
    return norm.select(key, F.inline(rows))


def structured_envelope(norm: DataFrame, key: str = "event_id", as_of: str = AS_OF) -> DataFrame:
    """A10: each accepted contract as one nested record: id, the sections, the entities in both forms (``Entidades`` the first
    or a blank one, ``EntidadesList`` all) and the processing time. The id has the second of ``as_of``, as the reference's; ``key``
    beside it tells contracts of one batch apart (T14). Values are the normalized ones."""
    at = F.to_timestamp_ntz(F.lit(as_of))
    modelled = F.struct(*[F.col("contract")[f].alias(f) for f in CONTRACT_FIELDS])
    blank = F.struct(F.lit("").alias("tipo"), F.lit("").alias("valor"))
    entities = F.transform("entities", lambda x: F.struct(x["tipo"].alias("tipo"), x["valor"].alias("valor")))
    fine_fields = ["tipo_incumplimiento", "implicancias", "monto_multa_uf", "plazo_constancia", "descripcion_completa"]
    return accepted(norm, key, "contract", "company", "provider", "reps", "fines", "entities").select(key, F.struct(
        F.concat(F.lit("contrato_"), F.date_format(at, "yyyyMMdd_HHmmss")).alias("id"),
        modelled.alias("Contrato"), F.col("company").alias("CompaniaInfo"), F.col("provider").alias("ProveedoresInfo"),
        F.coalesce(F.transform("reps", lambda r: F.struct(r["nombre"].alias("nombre"), r["cedula_identidad"].alias("cedula_identidad"))), F.array()).alias("Representantes"),
        F.coalesce(F.transform("fines", lambda m: F.struct(*[m[f].alias(f) for f in fine_fields])), F.array()).alias("Multas"),
        F.coalesce(F.try_element_at(entities, F.lit(1)), blank).alias("Entidades"),
        F.coalesce(entities, F.array()).alias("EntidadesList"),
        F.struct(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("processedDate")).alias("metadata")).alias("envelope"))


def main_entity(norm: DataFrame, key: str = "event_id") -> DataFrame:
    """First entity of each accepted contract, or the blank legacy entity."""
    first = F.try_element_at(F.col("entities"), F.lit(1))
    return accepted(norm, key, "entities").select(
        key, F.coalesce(first["tipo"], F.lit("")).alias("tipo"),
        F.coalesce(first["valor"], F.lit("")).alias("valor"))


def entities_from_map(df: DataFrame, text_col: str, key: str) -> DataFrame:
    """Rows (key, pos, name, tipo, valor): the object values of an object of objects, in the order of the document, canonicalized
    (C7); values that are no objects are skipped, and text that is no object gives no row."""
    is_object = py_strip(F.col(text_col)).startswith("{")
    # the text of each value keeps its keys in order, the VARIANT tells its type
    texts = F.map_entries(F.when(is_object, F.from_json(text_col, "map<string,string>")))
    values = F.map_values(F.when(is_object, F.from_json(text_col, "map<string,variant>")))
    both = F.zip_with(texts, values, lambda t, v: F.struct(t["key"].alias("name"), t["value"].alias("text"), is_obj(vtype(v)).alias("is_object")))
    rows = df.select(key, F.posexplode(both).alias("pos", "x")).filter("x.is_object")
    rows = rows.withColumn("e", canon.canon_entries("entity", F.from_json("x.text", "map<string,variant>")))
    text = {f: safe_string(variant_text(canon.field(F.col("e"), f))).alias(f) for f in ("tipo", "valor")}
    return rows.select(key, "pos", F.col("x.name").alias("name"), text["tipo"], text["valor"])


def metadata_record(obj: Column) -> Column:
    """C20: the four document-metadata fields of an object (VARIANT); NULL where a field is absent or the value no object."""
    return F.struct(*[variant_text(F.try_variant_get(obj, f"$.{f}", "variant")).alias(f) for f in METADATA_FIELDS])

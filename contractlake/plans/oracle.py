"""DuckDB oracle SQL: an independent second implementation of the operator semantics.

The driver runs each registered Spark query next to the SQL built here (on the same parquet
tables, as pre-registered DuckDB views) and compares results. Everything is plain CTE text;
``with_ctes`` prepends the needed chain.
"""

from __future__ import annotations

from contractlake.sources import fixtures as fx

# Fixed values, written out here once more so that a slip in the code under test shows: the processing time, the months,
# raw key -> canonical key of each record type, and what the extractor's headings and labels mean.
AS_OF = "2026-01-01 00:00:00"
SPANISH_MONTHS = dict(zip("enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split(), range(1, 13)))
FINE_ALIASES = {"Tipo de incumplimiento": "tipo_incumplimiento", "tipo de incumplimiento": "tipo_incumplimiento", "tipo_incumplimiento": "tipo_incumplimiento",
                "Implicancias": "implicancias", "implicancias": "implicancias",
                "Monto de la multa en UF": "monto_multa_uf", "monto de la multa en uf": "monto_multa_uf", "monto_multa_uf": "monto_multa_uf",
                "Plazo para la constancia": "plazo_constancia", "plazo para la constancia": "plazo_constancia", "plazo_constancia": "plazo_constancia",
                "Descripción completa": "descripcion_completa", "descripción completa": "descripcion_completa", "descripcion_completa": "descripcion_completa"}
REP_ALIASES = {"Nombre": "nombre", "nombre": "nombre", "Cédula de Identidad": "cedula_identidad", "cedula de identidad": "cedula_identidad",
               "cedula_identidad": "cedula_identidad", "Cedula de Identidad": "cedula_identidad", "cedula identidad": "cedula_identidad"}
COMPANY_ALIASES = {"Nombre": "nombre", "nombre": "nombre", "RUT": "rut", "rut": "rut", "Domicilio": "domicilio", "domicilio": "domicilio"}
ENTITY_ALIASES = {"tipo": "tipo", "Tipo": "tipo", "tipo_entidad": "tipo", "Tipo_entidad": "tipo", "valor": "valor", "Valor": "valor", "nombre": "valor", "Nombre": "valor"}
HEADINGS = {"contrato": "Contrato", "compañía": "CompaniaInfo", "compañia": "CompaniaInfo", "compania": "CompaniaInfo", "proveedor": "ProveedoresInfo", "representante": "Representantes",
            "multa": "Multas", "entidad": "Entidades"}
CONTRACT_LABELS = {"tipo de contrato": "tipo_contrato", "tipo de servicio": "tipo_servicio", "parte cliente": "parte_cliente", "parte proveedor": "parte_proveedor",
                   "fecha de inicio": "fecha_inicio", "fecha de termino": "fecha_termino", "renovacion automatica": "renovacion_automatica", "monto total": "monto_total",
                   "termino anticipado": "termino_anticipado_activo", "plazo de termino anticipado": "termino_anticipado_plazo_dias", "exclusividad": "exclusividad_activo",
                   "detalles de exclusividad": "exclusividad_detalles", "descripcion": "descripcion", "nombre del contrato": "nombre"}

WS = (r"[\t\n\x0B\f\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}"
      r"\x{205F}\x{3000}]")
AS_OF_DATE = AS_OF[:10]


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def canon_sql(kind: str, k: str) -> str:
    aliases = {"fine": FINE_ALIASES, "rep": REP_ALIASES, "company": COMPANY_ALIASES,
               "entity": ENTITY_ALIASES}[kind]
    whens = " ".join(f"WHEN {q(a)} THEN {q(c)}" for a, c in aliases.items())
    fallback = f"lower({k})" if kind == "entity" else f"replace(lower({k}), ' ', '_')"
    return f"(CASE {k} {whens} ELSE {fallback} END)"


def last_key(kind: str, obj: str, name: str) -> str:
    """Raw key of the last entry whose canonical name is ``name`` (NULL if none)."""
    return f"list_filter(json_keys({obj}), lambda kk: {canon_sql(kind, 'kk')} = {q(name)})[-1]"


def field_json(kind: str, obj: str, name: str) -> str:
    lk = last_key(kind, obj, name)
    return f"json_extract({obj}, '$.\"' || {lk} || '\"')"


def has_field(kind: str, obj: str, name: str) -> str:
    return f"(len(list_filter(json_keys({obj}), lambda kk: {canon_sql(kind, 'kk')} = {q(name)})) > 0)"


def jtext(j: str) -> str:
    return f"json_extract_string({j}, '$')"


def jtype(j: str) -> str:
    return f"json_type({j})"


NUMERIC = "('BIGINT','UBIGINT','DOUBLE','HUGEINT','INTEGER','UINTEGER')"


def falsy(j: str) -> str:
    t = jtype(j)
    return (f"({j} IS NULL OR {t} = 'NULL' OR ({t} = 'VARCHAR' AND {jtext(j)} = '') "
            f"OR ({t} = 'BOOLEAN' AND {jtext(j)} = 'false') "
            f"OR ({t} IN {NUMERIC} AND TRY_CAST({jtext(j)} AS DOUBLE) = 0) "
            f"OR ({t} = 'ARRAY' AND json_array_length({j}) = 0) "
            f"OR ({t} = 'OBJECT' AND len(json_keys({j})) = 0))")


def cap(d: str) -> str:
    return (f"(CASE WHEN {d} >= 1e16 THEN CAST('9999999999999999.99' AS DECIMAL(18,2)) "
            f"ELSE CAST({d} AS DECIMAL(18,2)) END)")


def d1_text(t: str) -> str:
    cleaned = f"regexp_replace(replace({t}, ',', '.'), '[^0-9.]', '', 'g')"
    return cap(f"coalesce(TRY_CAST({cleaned} AS DOUBLE), 0.0)")


def d1_plain(t: str) -> str:
    return f"(CASE WHEN {t} IS NULL OR {t} = '' THEN CAST(0 AS DECIMAL(18,2)) ELSE {d1_text(t)} END)"


def d1_json(j: str) -> str:
    t = jtype(j)
    return (f"(CASE WHEN {falsy(j)} THEN CAST(0 AS DECIMAL(18,2)) "
            f"WHEN {t} = 'VARCHAR' THEN {d1_text(jtext(j))} "
            f"WHEN {t} IN {NUMERIC} THEN {cap(f'abs(CAST({jtext(j)} AS DOUBLE))')} "
            f"ELSE CAST(0 AS DECIMAL(18,2)) END)")


_LAYOUTS = [(r"\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d"), (r"\d{1,2}/\d{1,2}/\d{4}", "%d/%m/%Y"),
            (r"\d{4}/\d{1,2}/\d{1,2}", "%Y/%m/%d"), (r"\d{1,2}-\d{1,2}-\d{4}", "%d-%m-%Y")]


def iso_strict(s: str) -> str:
    return (f"(CASE WHEN regexp_full_match({s}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') "
            f"THEN CAST(try_strptime({s}, '%Y-%m-%d') AS DATE) END)")


def d2_text(s: str) -> str:
    low = f"lower({strip(s)})"
    parts = f"string_split({low}, ' de ')"
    day = strip(f"{parts}[1]")
    mon_name = strip(f"{parts}[2]")
    year = strip(f"{parts}[3]")
    mon = "(CASE " + mon_name + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SPANISH_MONTHS.items()) + " END)"
    day2 = f"(CASE WHEN length({day}) < 2 THEN lpad({day}, 2, '0') ELSE {day} END)"
    cand = f"({year} || '-' || lpad(CAST({mon} AS VARCHAR), 2, '0') || '-' || {day2})"
    spanish = (f"(CASE WHEN regexp_full_match({cand}, '\\d{{4}}-\\d{{2}}-\\d{{1,2}}') "
               f"THEN CAST(try_strptime({cand}, '%Y-%m-%d') AS DATE) END)")
    numeric = "coalesce(" + ", ".join(
        f"CASE WHEN regexp_full_match({s}, '{rx}') THEN CAST(try_strptime({s}, '{fmt}') AS DATE) END"
        for rx, fmt in _LAYOUTS) + ")"
    return (f"(CASE WHEN {s} IS NULL OR {s} = '' THEN NULL "
            f"WHEN contains({low}, ' de ') AND len({parts}) = 3 AND {mon} IS NOT NULL THEN {spanish} "
            f"ELSE {numeric} END)")


def d2_json(j: str) -> str:
    return (f"(CASE WHEN {falsy(j)} THEN NULL WHEN {jtype(j)} = 'VARCHAR' THEN {d2_text(jtext(j))} END)")


def d3_digits(t: str) -> str:
    st = strip(t)
    cleaned = f"replace(regexp_replace({st}, '[^0-9.,]', '', 'g'), ',', '.')"
    return f"(CASE WHEN lower({st}) <> 'null' AND regexp_full_match({cleaned}, '[0-9]+\\.?[0-9]*|\\.[0-9]+') THEN {cleaned} END)"


def d3_room(t: str) -> str:
    """Whether 26 digits before the point and 12 behind it hold the amount: digits counted in its two halves."""
    whole, part = f"ltrim(split_part({d3_digits(t)}, '.', 1), '0')", f"rtrim(split_part({d3_digits(t)}, '.', 2), '0')"
    return f"(length({whole}) <= 26 AND length({part}) <= 12)"


def d3(t: str) -> str:
    padded = f"'0' || rtrim({d3_digits(t)}, '.')"
    return f"(CASE WHEN {d3_room(t)} THEN CAST({padded} AS DECIMAL(38,12)) END)"


def is_exp(j: str) -> str:
    return f"({jtype(j)} IN {NUMERIC} AND contains(upper(CAST({j} AS VARCHAR)), 'E'))"


def d3_json(j: str) -> str:
    """Numbers with an exponent by their value, all else by its text."""
    return f"(CASE WHEN {is_exp(j)} THEN CAST(abs(CAST({jtext(j)} AS DOUBLE)) AS DECIMAL(38,12)) ELSE {d3(jtext(j))} END)"


def d3_json_bad(j: str) -> str:
    return f"(NOT {is_exp(j)} AND NOT coalesce({d3_room(jtext(j))}, true))"


def safe_str(t: str) -> str:
    return f"coalesce({strip(t)}, '')"


def flag(j: str) -> str:
    t = jtype(j)
    return (f"(CASE WHEN {j} IS NULL THEN false WHEN {t} = 'BOOLEAN' THEN {jtext(j)} = 'true' "
            f"WHEN {t} IN {NUMERIC} THEN TRY_CAST({jtext(j)} AS DOUBLE) <> 0 "
            f"WHEN {t} = 'VARCHAR' THEN TRY_CAST({jtext(j)} AS BOOLEAN) END)")


def ensure_obj(j: str) -> str:
    return (f"(CASE WHEN {jtype(j)} = 'OBJECT' THEN {j} WHEN {jtype(j)} = 'ARRAY' AND "
            f"json_type({j}, '$[0]') = 'OBJECT' THEN json_extract({j}, '$[0]') END)")


def empty_obj(j: str) -> str:
    return f"({j} IS NULL OR len(json_keys({j})) = 0)"


def too_long(cols: dict[str, int]) -> str:
    return "(" + " OR ".join(f"coalesce(length({c}) > {n}, false)" for c, n in cols.items()) + ")"


CONTRACT_FIELDS = ["tipo_contrato", "tipo_servicio", "parte_cliente", "parte_proveedor", "fecha_inicio",
                   "fecha_termino", "renovacion_automatica", "monto_total", "termino_anticipado_activo",
                   "termino_anticipado_plazo_dias", "exclusividad_activo", "exclusividad_detalles",
                   "descripcion", "nombre"]


def payload_ctes(payloads: str | None = None) -> list[tuple[str, str]]:
    """CTE chain for the payload flow over ``payloads`` (event_id, doc_key, payload), else the input of FIXTURES §3.3."""
    ctes: list[tuple[str, str]] = [("pl", payloads or fx.payload_sql("duckdb"))]
    ctes.append(("cls", """SELECT event_id, doc_key,
        CASE WHEN payload IS NULL THEN 'semantic extraction failed'
             WHEN NOT coalesce(json_valid(payload), false) THEN 'json_decode_error'
             WHEN json_type(payload) = 'ARRAY' AND json_array_length(payload) = 0 THEN 'empty_contract_data_list'
             WHEN json_type(payload) = 'ARRAY' AND json_type(payload, '$[0]') <> 'OBJECT' THEN 'invalid_contract_data_structure'
             WHEN json_type(payload) NOT IN ('ARRAY', 'OBJECT') THEN 'unexpected_contract_data_type'
             WHEN len(json_keys(CASE WHEN json_type(payload) = 'OBJECT' THEN payload::JSON
                                     ELSE json_extract(payload, '$[0]') END)) = 0 THEN 'no_contract_data'
             ELSE 'ok' END AS reason1,
        CASE WHEN json_valid(payload) AND json_type(payload) = 'OBJECT' THEN payload::JSON
             WHEN json_valid(payload) AND json_type(payload) = 'ARRAY' AND json_type(payload, '$[0]') = 'OBJECT'
             THEN json_extract(payload, '$[0]') END AS obj
      FROM pl"""))
    secs = ", ".join(f"json_extract(obj, '$.{s}') AS s_{s.lower()}" for s in
                     ["Contrato", "Multas", "CompaniaInfo", "ProveedoresInfo", "Representantes", "Entidades"])
    ctes.append(("secs", f"SELECT event_id, reason1, {secs} FROM cls"))
    ctes.append(("objs", f"""SELECT *, {ensure_obj('s_contrato')} AS cobj, {ensure_obj('s_companiainfo')} AS comp,
        {ensure_obj('s_proveedoresinfo')} AS prov FROM secs"""))
    fields = ", ".join(f"json_extract(cobj, '$.{f}') AS f_{f}" for f in CONTRACT_FIELDS)
    ctes.append(("cf", f"SELECT *, {fields} FROM objs"))

    def with_default(f: str, d: str) -> str:
        return f"CASE WHEN f_{f} IS NULL THEN {q(d)} ELSE {jtext('f_' + f)} END"
    def no_value(f: str, value: str) -> str:
        return f"WHEN f_{f} IS NOT NULL AND json_type(f_{f}) <> 'NULL' AND {value} IS NULL THEN '{f}'"
    flags = ["renovacion_automatica", "termino_anticipado_activo", "exclusividad_activo"]
    days = "termino_anticipado_plazo_dias"
    f_days = f"f_{days}"
    unreadable = f"CASE {' '.join(no_value(f, flag('f_' + f)) for f in flags)} {no_value(days, f'TRY_CAST({jtext(f_days)} AS INTEGER)')} END"
    start_text = f"CASE WHEN f_fecha_inicio IS NULL THEN '{AS_OF_DATE}' ELSE {jtext('f_fecha_inicio')} END"
    ctes.append(("cv", f"""SELECT *,
        {with_default('tipo_contrato', 'Contrato General')} AS tipo_contrato,
        {with_default('tipo_servicio', 'Servicios Generales')} AS tipo_servicio,
        {with_default('parte_cliente', '')} AS parte_cliente,
        {with_default('parte_proveedor', '')} AS parte_proveedor,
        CASE WHEN f_fecha_inicio IS NULL THEN {d2_text(q(AS_OF_DATE))} ELSE {d2_json('f_fecha_inicio')} END AS fecha_inicio,
        CASE WHEN {falsy('f_fecha_termino')} THEN {iso_strict(start_text)} + INTERVAL 365 DAY
             ELSE {d2_json('f_fecha_termino')} END AS fecha_termino_ts,
        {flag('f_renovacion_automatica')} AS renovacion_automatica,
        {d1_json('f_monto_total')} AS monto_total,
        CAST(0 AS DECIMAL(18,2)) AS multa_monto,
        '' AS multa_penalidades,
        {flag('f_termino_anticipado_activo')} AS termino_anticipado_activo,
        TRY_CAST({jtext('f_termino_anticipado_plazo_dias')} AS INTEGER) AS termino_anticipado_plazo_dias,
        {flag('f_exclusividad_activo')} AS exclusividad_activo,
        {jtext('f_exclusividad_detalles')} AS exclusividad_detalles,
        {jtext('f_descripcion')} AS descripcion,
        {jtext('f_nombre')} AS nombre,
        ({falsy('f_fecha_termino')} AND NOT ((f_fecha_inicio IS NULL OR json_type(f_fecha_inicio) = 'VARCHAR')
             AND {iso_strict(start_text)} IS NOT NULL)) AS start_bad,
        ((NOT {falsy('f_fecha_inicio')} AND json_type(f_fecha_inicio) <> 'VARCHAR')
          OR (NOT {falsy('f_fecha_termino')} AND json_type(f_fecha_termino) <> 'VARCHAR')) AS date_error,
        {unreadable} AS bad_value,
        CASE WHEN {has_field('company', 'comp', 'nombre')} THEN {jtext(field_json('company', 'comp', 'nombre'))} ELSE '' END AS comp_nombre,
        CASE WHEN {has_field('company', 'comp', 'rut')} THEN {jtext(field_json('company', 'comp', 'rut'))} ELSE '' END AS comp_rut,
        CASE WHEN {has_field('company', 'comp', 'domicilio')} THEN {jtext(field_json('company', 'comp', 'domicilio'))} ELSE '' END AS comp_domicilio,
        CASE WHEN {has_field('company', 'prov', 'nombre')} THEN {jtext(field_json('company', 'prov', 'nombre'))} ELSE '' END AS prov_nombre,
        CASE WHEN {has_field('company', 'prov', 'rut')} THEN {jtext(field_json('company', 'prov', 'rut'))} ELSE '' END AS prov_rut,
        CASE WHEN {has_field('company', 'prov', 'domicilio')} THEN {jtext(field_json('company', 'prov', 'domicilio'))} ELSE '' END AS prov_domicilio
      FROM cf"""))

    def elems(name: str, sec: str, single_ok: bool) -> str:
        arr = f"CASE WHEN json_type({sec}) = 'ARRAY' THEN json_extract({sec}, '$[*]')"
        if single_ok:
            arr += f" WHEN json_type({sec}) = 'OBJECT' THEN [{sec}]"
        arr += " END"
        return f"""SELECT event_id, pos, e FROM (
            SELECT event_id, unnest(range(len(arr))) AS pos, unnest(arr) AS e
            FROM (SELECT event_id, {arr} AS arr FROM secs WHERE reason1 = 'ok')) x
          WHERE json_type(e) = 'OBJECT'"""
    ctes.append(("rep_e", elems("rep", "s_representantes", False)))
    ctes.append(("fine_e", elems("fine", "s_multas", False)))
    ctes.append(("ent_e", elems("entity", "s_entidades", True)))
    ctes.append(("prov_e", elems("company", "s_proveedoresinfo", True)))

    def stripped(name: str) -> str:
        return (f"CASE WHEN {has_field('rep', 'e', name)} THEN {strip(jtext(field_json('rep', 'e', name)))} "
                f"ELSE '' END")

    def bad(name: str) -> str:
        return f"({has_field('rep', 'e', name)} AND json_type({field_json('rep', 'e', name)}) <> 'VARCHAR')"
    ctes.append(("rep_v", f"""SELECT event_id, pos, {stripped('nombre')} AS nombre,
        {stripped('cedula_identidad')} AS cedula_identidad,
        ({bad('nombre')} OR {bad('cedula_identidad')}) AS type_err FROM rep_e"""))
    ctes.append(("rep_flags", f"""SELECT event_id, bool_or(type_err) AS rep_type_err,
        bool_or({too_long({'nombre': 255, 'cedula_identidad': 50})}) AS rep_long FROM rep_v GROUP BY event_id"""))

    def ftext(name: str) -> str:
        return jtext(field_json('fine', 'e', name))
    ctes.append(("fine_v", f"""SELECT event_id, pos,
        {safe_str(ftext('tipo_incumplimiento'))} AS tipo_incumplimiento,
        {safe_str(ftext('implicancias'))} AS implicancias,
        CASE WHEN {d3_json_bad('uf')} THEN NULL ELSE {d3_json('uf')} END AS monto_multa_uf, {d3_json_bad('uf')} AS uf_bad,
        {safe_str(ftext('plazo_constancia'))} AS plazo_constancia,
        {safe_str(ftext('descripcion_completa'))} AS descripcion_completa, CAST(e AS VARCHAR) AS text
      FROM (SELECT *, {field_json('fine', 'e', 'monto_multa_uf')} AS uf FROM fine_e)"""))
    ctes.append(("ent_v", f"""SELECT event_id, pos,
        {safe_str(jtext(field_json('entity', 'e', 'tipo')))} AS tipo,
        {safe_str(jtext(field_json('entity', 'e', 'valor')))} AS valor, CAST(e AS VARCHAR) AS text FROM ent_e"""))

    def ptext(name: str) -> str:
        return f"CASE WHEN {has_field('company', 'e', name)} THEN {jtext(field_json('company', 'e', name))} ELSE '' END"
    ctes.append(("provs_v", f"""SELECT event_id, pos, {ptext('nombre')} AS nombre, {ptext('rut')} AS rut,
        {ptext('domicilio')} AS domicilio FROM prov_e"""))

    def not_iter(sec: str) -> str:
        return f"({sec} IS NOT NULL AND json_type({sec}) NOT IN ('ARRAY', 'OBJECT', 'VARCHAR'))"
    ctes.append(("norm", f"""SELECT cv.*, CAST(fecha_termino_ts AS DATE) AS fecha_termino,
        CASE WHEN reason1 <> 'ok' THEN reason1
             WHEN {empty_obj('cobj')} THEN 'Missing Contrato data'
             WHEN start_bad THEN 'invalid fecha_inicio for default fecha_termino'
             WHEN {empty_obj('comp')} THEN 'Missing CompaniaInfo data'
             WHEN {empty_obj('prov')} THEN 'Missing ProveedoresInfo data'
             WHEN {not_iter('s_representantes')} THEN 'Representantes is not iterable'
             WHEN coalesce(rf.rep_type_err, false) THEN 'representative field is not text'
             WHEN {not_iter('s_multas')} THEN 'Multas is not iterable'
             WHEN date_error THEN 'database_error: date is not text'
             WHEN bad_value IS NOT NULL THEN 'database_error: value can''t be read'
             WHEN {too_long({c: 255 for c in ['tipo_contrato', 'tipo_servicio', 'parte_cliente', 'parte_proveedor', 'nombre']})}
               THEN 'database_error: value too long for Contrato'
             WHEN {too_long({'comp_nombre': 255, 'comp_rut': 20, 'comp_domicilio': 255})}
               THEN 'database_error: value too long for CompaniaInfo'
             WHEN {too_long({'prov_nombre': 255, 'prov_rut': 20, 'prov_domicilio': 255})}
               THEN 'database_error: value too long for ProveedoresInfo'
             WHEN coalesce(rf.rep_long, false) THEN 'database_error: value too long for Representantes'
             ELSE 'ok' END AS reason
      FROM cv LEFT JOIN rep_flags rf USING (event_id)"""))
    ctes.append(("acc", "SELECT * FROM norm WHERE reason = 'ok'"))
    ctes.append(("contrato", """SELECT row_number() OVER (ORDER BY event_id) AS id, * FROM acc"""))
    ctes.append(("keys", "SELECT event_id, id AS contrato_id FROM contrato"))
    return ctes


AUDIT = (f"TIMESTAMP '{AS_OF}' AS created_at, TIMESTAMP '{AS_OF}' AS updated_at, true AS is_active")


def star_ctes() -> list[tuple[str, str]]:
    ctes = payload_ctes()
    contract_cols = ", ".join(["tipo_contrato", "tipo_servicio", "parte_cliente", "parte_proveedor",
                               "fecha_inicio", "fecha_termino", "renovacion_automatica", "monto_total",
                               "multa_monto", "multa_penalidades", "termino_anticipado_activo",
                               "termino_anticipado_plazo_dias", "exclusividad_activo",
                               "exclusividad_detalles", "descripcion", "nombre"])
    ctes.append(("t_contrato", f"SELECT id, event_id, {contract_cols}, {AUDIT} FROM contrato"))

    def child(name: str, src: str, cols: str, where: str = "true") -> tuple[str, str]:
        return (name, f"""SELECT row_number() OVER (ORDER BY s.event_id, s.pos) AS id, k.contrato_id, {cols}, {AUDIT}
            FROM {src} s JOIN keys k ON s.event_id = k.event_id WHERE {where}""")
    ctes.append(child("t_compania_info", "(SELECT event_id, 0 AS pos, comp_nombre, comp_rut, comp_domicilio FROM acc)",
                      "comp_nombre AS nombre, comp_rut AS rut, comp_domicilio AS domicilio"))
    ctes.append(child("t_proveedores_info", "(SELECT event_id, 0 AS pos, prov_nombre, prov_rut, prov_domicilio FROM acc)",
                      "prov_nombre AS nombre, prov_rut AS rut, prov_domicilio AS domicilio"))
    ctes.append(child("t_representantes", "rep_v", "nombre, cedula_identidad AS cedula_de_identidad"))
    ctes.append(child("t_entidades", "ent_v", "tipo, valor", "(tipo <> '' OR valor <> '') AND length(tipo) <= 255"))
    ctes.append(child("t_multas", "fine_v",
                      "tipo_incumplimiento, implicancias, monto_multa_uf, plazo_constancia, descripcion_completa",
                      "tipo_incumplimiento <> '' AND NOT uf_bad AND length(plazo_constancia) <= 255"))
    return ctes


def with_ctes(ctes: list[tuple[str, str]], select: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{body}\n)" for n, body in ctes) + "\n" + select


def gate_ctes() -> list[tuple[str, str]]:
    """CTE chain for event gating (FIXTURES §3.2 input)."""
    return [
        ("ev", fx.blob_events_sql("duckdb")),
        ("mk", fx.markers_sql("duckdb")),
        ("d", "SELECT event_id, event_type, subject, url, event_time, count(*) AS copies FROM ev GROUP BY ALL"),
        ("p", r"""SELECT *, split_part(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1), '.', 1) AS account,
            string_split(regexp_replace(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '^/+|/+$', '', 'g'), '/') AS parts
          FROM d"""),
        ("p2", """SELECT *, parts[1] AS container,
            CASE WHEN len(parts) > 1 THEN array_to_string(parts[2:], '/') END AS blob_path FROM p"""),
        ("p3", """SELECT *, CASE WHEN len(string_split(blob_path, '/')) >= 2
              THEN array_to_string(string_split(blob_path, '/')[1:len(string_split(blob_path, '/')) - 1], '/') END AS folder,
            string_split(blob_path, '/')[-1] AS file FROM p2"""),
        ("st", """SELECT *, CASE
              WHEN contains(lower(subject), '/containers/processed-events/') THEN 'processed-events container'
              WHEN event_type <> 'Microsoft.Storage.BlobCreated' THEN 'not a blob event'
              WHEN url IS NULL OR url = '' THEN 'missing url'
              WHEN blob_path IS NULL OR blob_path = '' THEN 'missing blob path'
              WHEN file IS NULL OR file = '' THEN 'missing file name'
              WHEN NOT contains(lower(file), 'pdf') THEN 'not a pdf file' END AS static_reason FROM p3"""),
        ("fp", """SELECT event_id, event_time AS ft, subject AS fs, url AS fu, event_type AS fe FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_time, subject, url, event_type) AS rn
            FROM st WHERE static_reason IS NULL) WHERE rn = 1"""),
        ("g", """SELECT st.*, fp.ft IS NOT NULL AND (event_time > ft OR (event_time = ft AND (subject > fs
                OR (subject = fs AND (coalesce(url > fu, false) OR (url = fu AND event_type > fe)))))) AS after_first,
              fp.ft IS NOT NULL AND event_time = ft AND subject = fs AND url = fu AND event_type = fe AS is_first,
              EXISTS (SELECT 1 FROM mk WHERE mk.event_id = st.event_id) AS marked
            FROM st LEFT JOIN fp USING (event_id)"""),
        ("g2", """SELECT *, CASE WHEN static_reason = 'processed-events container' THEN static_reason
                 WHEN marked OR after_first THEN 'already processed' ELSE static_reason END AS reason FROM g"""),
        ("g3", """SELECT *, CASE WHEN reason IS NULL THEN 'pass'
                 WHEN reason IN ('missing url', 'missing blob path', 'missing file name') THEN 'error'
                 ELSE 'skipped' END AS status FROM g2"""),
        ("gated", """SELECT event_id, event_type, subject, url, event_time,
                CASE WHEN status = 'pass' THEN 1 ELSE copies END AS copies, status, reason,
                account, container, folder, file FROM g3
              UNION ALL
              SELECT event_id, event_type, subject, url, event_time, copies - 1, 'skipped', 'already processed',
                account, container, folder, file FROM g3 WHERE status = 'pass' AND is_first AND copies > 1"""),
        ("gate_out", """SELECT *, CASE WHEN status = 'pass' THEN
                CASE WHEN ends_with(lower(file), '.pdf') THEN left(file, length(file) - 4) || '.json'
                     ELSE file || '.json' END END AS json_name FROM gated"""),
    ]


def extraction_ctes(lines: str) -> list[tuple[str, str]]:
    """CTE chain from page lines to payload text (``extracted``: doc_id, payload), by headings and labels."""
    def case(x: str, names: dict[str, str]) -> str:
        return f"CASE {x} " + " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in names.items()) + " END"

    def many(s: str) -> str:
        return f"'[' || coalesce(string_agg(obj, ',' ORDER BY part) FILTER (WHERE section = '{s}'), '') || ']'"

    def one(s: str) -> str:
        return f"coalesce(arg_min(obj, part) FILTER (WHERE section = '{s}'), '{{}}')"

    rx = r"^\s*([^:]+?)\s*:\s*(.*?)\s*$"
    party = "'nombre', 'rut', 'domicilio'"
    known = {"CompaniaInfo": ("company", party), "ProveedoresInfo": ("company", party), "Representantes": ("rep", "'nombre', 'cedula_identidad'"),
             "Multas": ("fine", "'tipo_incumplimiento', 'implicancias', 'monto_multa_uf', 'plazo_constancia', 'descripcion_completa'"),
             "Entidades": ("entity", "'tipo', 'valor'")}
    field = f"CASE WHEN opens IS NOT NULL OR label = '' THEN NULL WHEN section = 'Contrato' THEN {case('lower(label)', CONTRACT_LABELS)} " + " ".join(
        f"WHEN section = '{s}' AND {canon_sql(kind, 'label')} IN ({names}) THEN label" for s, (kind, names) in known.items()) + " END"
    flags, days = "('renovacion_automatica', 'termino_anticipado_activo', 'exclusividad_activo')", "termino_anticipado_plazo_dias"
    value = f"""CASE WHEN field IN {flags} AND lower(value) IN ('si', 'sí') THEN 'true' WHEN field IN {flags} AND lower(value) = 'no' THEN 'false'
        WHEN field = '{days}' AND regexp_matches(value, '^[0-9]{{1,9}}(\\s|$)') THEN CAST(CAST(regexp_extract(value, '^([0-9]{{1,9}})', 1) AS INTEGER) AS VARCHAR)
        ELSE CAST(to_json(value) AS VARCHAR) END"""
    heading = f"regexp_replace(lower({strip('line')}), '\\s*[0-9]+$', '')"
    return [
        ("xl", lines),
        ("xh", f"SELECT *, {case(heading, HEADINGS)} AS opens FROM xl"),
        ("xs", f"""SELECT *, last_value(opens IGNORE NULLS) OVER w AS section, count(opens) OVER w AS part, regexp_extract(line, '{rx}', 1) AS label
            FROM xh WINDOW w AS (PARTITION BY doc_id ORDER BY page_no, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
        ("xf", f"SELECT *, {field} AS field FROM xs"),
        ("kv", f"""SELECT doc_id, section, part, field, regexp_extract(line, '{rx}', 2) AS value, page_no, line_no
            FROM xf WHERE field IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, part, field ORDER BY page_no, line_no) = 1"""),
        ("xo", f"""SELECT p.doc_id, p.section, p.part, '{{' || coalesce(string_agg(CAST(to_json(field) AS VARCHAR) || ':' || {value}, ',' ORDER BY page_no, line_no)
                FILTER (WHERE field IS NOT NULL), '') || '}}' AS obj
            FROM (SELECT DISTINCT doc_id, section, part FROM xs) p LEFT JOIN kv ON kv.doc_id = p.doc_id AND kv.part = p.part GROUP BY ALL"""),
        ("extracted", f"""SELECT doc_id, '{{"Contrato":' || {one('Contrato')} || ',"Multas":' || {many('Multas')} || ',"CompaniaInfo":' || {one('CompaniaInfo')}
            || ',"ProveedoresInfo":' || {many('ProveedoresInfo')} || ',"Representantes":' || {many('Representantes')} || ',"Entidades":' || {many('Entidades')} || '}}' AS payload
            FROM xo GROUP BY doc_id"""),
    ]

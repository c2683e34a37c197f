"""Registered queries: name -> (Spark callable(spark, sf_dir) -> DataFrame, DuckDB oracle SQL or None).

Every query reads the given tables (through the derivations in ``sources.fixtures``) and runs
over them whole. Names follow SURVEY §2.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlake.functions import scalars as S
from contractlake.operators import payload as P
from contractlake.operators import star as ST
from contractlake.plans import oracle as O
from contractlake.functions.scalars import AS_OF
from contractlake.sources import fixtures as fx
from contractlake.session import checkpoint_dir, saved

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# Plans are rebuilt per call but the (costly to build) normalized frame is cached per session
# and input folder: a DataFrame is an immutable plan, so sharing it is safe.
_NORM_CACHE: dict[tuple[str, str], DataFrame] = {}
_STAR_CACHE: dict[tuple[str, str], ST.Star] = {}


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized payloads, computed once and written to the shared folder (survives executor loss; the six star tables
    and all reports read it, each only its columns, instead of parsing every payload again)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _NORM_CACHE:
        _NORM_CACHE[key] = saved(P.normalize_payloads(fx.payload_docs(spark, sf_dir)), "normalized")
    return _NORM_CACHE[key]


def star(spark: SparkSession, sf_dir: str) -> ST.Star:
    """The star, published once per session and input folder; every report scans the published tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAR_CACHE:
        norm = normalized(spark, sf_dir)
        _STAR_CACHE[key] = ST.publish(ST.build_star(norm), f"{checkpoint_dir(spark).rstrip('/')}/star-{uuid.uuid4().hex}")
    return _STAR_CACHE[key]


DA = fx.date_amount_sql("duckdb")
AUDIT_COLS = ["created_at", "updated_at", "is_active"]

# ---------------------------------------------------------------------------
# §2.4 scalars
# ---------------------------------------------------------------------------


@register("normalize_decimal", f"SELECT k, amount_text, {O.d1_plain('amount_text')} AS amount FROM ({DA}) d")
def q_normalize_decimal(spark, sf):
    return fx.date_amount_cases(spark, sf).select(
        "k", "amount_text", S.normalize_decimal_text(F.col("amount_text")).alias("amount"))


@register("normalize_date", f"SELECT k, date_text, {O.d2_text('date_text')} AS date_value FROM ({DA}) d")
def q_normalize_date(spark, sf):
    return fx.date_amount_cases(spark, sf).select(
        "k", "date_text", S.normalize_date_text(F.col("date_text")).alias("date_value"))


@register("first_match_format", f"""SELECT k, date_text,
    CASE WHEN regexp_full_match(date_text, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN 1
         WHEN regexp_full_match(date_text, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN 2
         WHEN regexp_full_match(date_text, '\\d{{4}}/\\d{{1,2}}/\\d{{1,2}}') THEN 3
         WHEN regexp_full_match(date_text, '\\d{{1,2}}-\\d{{1,2}}-\\d{{4}}') THEN 4 END AS layout_no
  FROM ({DA}) d WHERE {O.d2_text('date_text')} IS NOT NULL""")
def q_first_match_format(spark, sf):
    """H3: which numeric layout (1-4 in the reference's order) matched, for parsed dates."""
    d = fx.date_amount_cases(spark, sf)
    s = F.col("date_text")
    layout = F.coalesce(*[F.when(s.rlike(rx), F.lit(i + 1)) for i, (rx, _) in enumerate(S._LAYOUTS)])
    out = d.select("k", "date_text", layout.alias("layout_no"), S.normalize_date_text(s).alias("_d"))
    return P.keep_rows(out, F.col("_d").isNotNull()).drop("_d")


@register("parse_uf_amount", f"SELECT k, amount_text, {O.d3('amount_text')} AS uf FROM ({DA}) d")
def q_parse_uf_amount(spark, sf):
    return fx.date_amount_cases(spark, sf).select(
        "k", "amount_text", S.parse_uf_amount(F.col("amount_text")).alias("uf"))


@register("safe_string", f"SELECT k, {O.safe_str('date_text')} AS s FROM ({DA}) d")
def q_safe_string(spark, sf):
    return fx.date_amount_cases(spark, sf).select("k", S.safe_string(F.col("date_text")).alias("s"))


@register("default_end_date", f"""SELECT k, date_text,
    CAST({O.iso_strict('date_text')} + INTERVAL 365 DAY AS DATE) AS end_date FROM ({DA}) d""")
def q_default_end_date(spark, sf):
    return fx.date_amount_cases(spark, sf).select(
        "k", "date_text", S.default_end_date(F.col("date_text")).alias("end_date"))


@register("bounded_preview", f"""SELECT event_id, left(payload, 500) AS preview FROM ({fx.payload_sql('duckdb')}) p
  WHERE payload IS NOT NULL AND NOT coalesce(json_valid(payload), false)""")
def q_bounded_preview(spark, sf):
    """First 500 characters of undecodable payloads, kept for diagnosis."""
    n = P.classify_payload(fx.payload_docs(spark, sf)).select(
        "event_id", "reason", S.bounded_preview(F.col("payload")).alias("preview"))
    return P.keep_rows(n, F.col("reason") == "json_decode_error").select("event_id", "preview")


# ---------------------------------------------------------------------------
# §2.3 payload
# ---------------------------------------------------------------------------

PC = O.payload_ctes()


@register("classify_payload", O.with_ctes(PC[:2], "SELECT event_id, reason1 AS reason FROM cls"))
def q_classify_payload(spark, sf):
    return P.classify_payload(fx.payload_docs(spark, sf)).select("event_id", "reason")


@register("required_sections", O.with_ctes(PC, "SELECT event_id, reason FROM norm"))
def q_required_sections(spark, sf):
    """C8 + K7 + K8: the first failing rule per payload ('ok' when accepted)."""
    return normalized(spark, sf).select("event_id", "reason")


CONTRACT_OUT = ["tipo_contrato", "tipo_servicio", "parte_cliente", "parte_proveedor", "fecha_inicio",
                "fecha_termino", "renovacion_automatica", "monto_total", "multa_monto",
                "multa_penalidades", "termino_anticipado_activo", "termino_anticipado_plazo_dias",
                "exclusividad_activo", "exclusividad_detalles", "descripcion", "nombre"]


@register("project_contract", O.with_ctes(PC, f"SELECT event_id, {', '.join(CONTRACT_OUT)} FROM acc"))
def q_project_contract(spark, sf):
    """B10 + C15 + D1 + D2 + D5 + D6 + D9 + D10 + T3 + T5."""
    return P.accepted(normalized(spark, sf), "event_id", "contract").select("event_id", "contract.*")


@register("explode_reps", O.with_ctes(PC, """SELECT r.event_id, r.pos, r.nombre, r.cedula_identidad
  FROM rep_v r JOIN acc USING (event_id)"""))
def q_explode_reps(spark, sf):
    """C9 + C5 + D8 + B11."""
    return P.explode_reps(normalized(spark, sf))


@register("explode_fines", O.with_ctes(PC, """SELECT f.event_id, f.pos, tipo_incumplimiento, implicancias, monto_multa_uf, plazo_constancia, descripcion_completa
  FROM fine_v f JOIN acc USING (event_id) WHERE tipo_incumplimiento <> '' AND NOT uf_bad AND length(plazo_constancia) <= 255"""))
def q_explode_fines(spark, sf):
    """C10 + C4 + G4 + B6 + D3 + D4 + B11."""
    return P.explode_fines(normalized(spark, sf))


@register("explode_entities", O.with_ctes(PC, """SELECT x.event_id, x.pos, x.tipo, x.valor FROM ent_v x JOIN acc USING (event_id)
  WHERE (tipo <> '' OR valor <> '') AND length(tipo) <= 255"""))
def q_explode_entities(spark, sf):
    """C11 + C7 + C12 + B7 + D4."""
    return P.explode_entities(normalized(spark, sf))


REJECT_FIELDS = {
    "Missing Contrato data": "'Contrato'", "invalid fecha_inicio for default fecha_termino": "'fecha_inicio'",
    "Missing CompaniaInfo data": "'CompaniaInfo'", "Missing ProveedoresInfo data": "'ProveedoresInfo'",
    "Representantes is not iterable": "'Representantes'", "representative field is not text": "'Representantes'",
    "Multas is not iterable": "'Multas'", "database_error: value can''t be read": "n.bad_value",
    "database_error: date is not text": f"CASE WHEN NOT {O.falsy('n.f_fecha_inicio')} AND json_type(n.f_fecha_inicio) <> 'VARCHAR' THEN 'fecha_inicio' ELSE 'fecha_termino' END"}
REJECT_FIELD_SQL = "CASE n.reason " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in REJECT_FIELDS.items()) + \
    " ELSE CASE WHEN starts_with(n.reason, 'database_error: value too long for ') THEN substr(n.reason, 36) ELSE 'payload' END END"


@register("quarantine", O.with_ctes(PC, f"""SELECT n.event_id, 'contract' AS scope, CAST(NULL AS INTEGER) AS pos, {REJECT_FIELD_SQL} AS field,
    n.reason, p.payload FROM norm n JOIN pl p USING (event_id) WHERE n.reason <> 'ok'
  UNION ALL SELECT event_id, 'fine', pos, CASE WHEN tipo_incumplimiento = '' THEN 'tipo_incumplimiento' WHEN uf_bad THEN 'monto_multa_uf' ELSE 'plazo_constancia' END,
    CASE WHEN tipo_incumplimiento = '' THEN 'missing' WHEN uf_bad THEN 'amount out of range' ELSE 'value too long' END, replace(text, '10000000.0', '1.0E7')
  FROM fine_v JOIN acc USING (event_id) WHERE tipo_incumplimiento = '' OR uf_bad OR length(plazo_constancia) > 255
  UNION ALL SELECT event_id, 'entity', pos, CASE WHEN tipo = '' AND valor = '' THEN 'tipo, valor' ELSE 'tipo' END,
    CASE WHEN tipo = '' AND valor = '' THEN 'missing' ELSE 'value too long' END, text
  FROM ent_v JOIN acc USING (event_id) WHERE (tipo = '' AND valor = '') OR length(tipo) > 255"""))
def q_quarantine(spark, sf):
    """D13 + K7: what was not stored, with field, reason and the whole text it came in."""
    return P.quarantine(normalized(spark, sf))


@register("providers_as_list", O.with_ctes(PC, """SELECT p.event_id, p.pos, p.nombre, p.rut, p.domicilio
  FROM provs_v p JOIN acc USING (event_id)"""))
def q_providers_as_list(spark, sf):
    """C14 + C6."""
    return P.providers_as_list(normalized(spark, sf))


@register("entity_fallback", O.with_ctes(PC, """SELECT a.event_id, coalesce(e.tipo, '') AS tipo, coalesce(e.valor, '') AS valor
  FROM acc a LEFT JOIN (SELECT event_id, tipo, valor FROM ent_v QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY pos) = 1) e
  USING (event_id)"""))
def q_entity_fallback(spark, sf):
    """Main (first) entity per accepted contract, blank when there is none."""
    return P.main_entity(normalized(spark, sf))


SAFE_GET_KEYS = ["implicancias", "Nota Extra", "descripcion_completa"]


def _first_with(key: str, section: str = "s_multas") -> str:
    objs = f"list_filter(CASE json_type({section}) WHEN 'ARRAY' THEN json_extract({section}, '$[*]') WHEN 'OBJECT' THEN [{section}] END, lambda e: json_type(e) = 'OBJECT')"
    return f"json_extract_string(list_filter({objs}, lambda e: list_contains(json_keys(e), '{key}'))[1], '$.\"{key}\"')"


@register("safe_get", O.with_ctes(PC[:3], f"""SELECT event_id, {_first_with('rut', 's_companiainfo')} AS rut, {_first_with('RUT', 's_companiainfo')} AS rut_upper,
    {', '.join(f'{_first_with(k)} AS f{i}' for i, k in enumerate(SAFE_GET_KEYS))} FROM secs WHERE reason1 = 'ok'"""))
def q_safe_get(spark, sf):
    """A key of an object section, and of the first object of a list section that has it."""
    c = P.classify_payload(fx.payload_docs(spark, sf)).select("event_id", "reason", "_obj")
    c = P.keep_rows(c, F.col("reason") == P.OK)
    c = c.select("event_id", P.safe_get(F.col("_obj"), "Multas").alias("m"), P.safe_get(F.col("_obj"), "CompaniaInfo").alias("co"))
    fields = {"rut": P.safe_get(F.col("co"), "rut"), "rut_upper": P.safe_get(F.col("co"), "RUT")}
    fields |= {f"f{i}": P.safe_get(F.col("m"), k) for i, k in enumerate(SAFE_GET_KEYS)}
    return c.select("event_id", *[S.variant_text(v).alias(k) for k, v in fields.items()])


@register("entities_from_map", f"""SELECT doc_key, CAST(list_position(ks, name) - 1 AS INTEGER) AS pos, name,
    {O.safe_str(O.jtext(O.field_json('entity', 'e', 'tipo')))} AS tipo, {O.safe_str(O.jtext(O.field_json('entity', 'e', 'valor')))} AS valor
  FROM (SELECT doc_key, ks, name, json_extract(entidades, '$."' || name || '"') AS e
        FROM (SELECT doc_key, json_keys(entidades) AS ks, unnest(json_keys(entidades)) AS name, entidades FROM ({fx.entity_maps_sql('duckdb')}) m WHERE json_type(entidades) = 'OBJECT') k) x
  WHERE json_type(e) = 'OBJECT'""")
def q_entities_from_map(spark, sf):
    """An object of objects as a list of entities, in document order, other values skipped."""
    return P.entities_from_map(fx.entity_maps(spark, sf), "entidades", "doc_key")


@register("metadata_record", f"""SELECT doc_key, {', '.join(f"json_extract_string(metadata, '$.{f}') AS {f}" for f in P.METADATA_FIELDS)} FROM ({fx.metadata_sql('duckdb')}) m""")
def q_metadata_record(spark, sf):
    """C20: the four document-metadata fields of an object."""
    return fx.metadata(spark, sf).select("doc_key", P.metadata_record(F.try_parse_json("metadata")).alias("m")).select("doc_key", "m.*")


def _js(c: str) -> str:
    return f"coalesce(CAST(to_json({c}) AS VARCHAR), 'null')"


def _jobj(fields: dict[str, str]) -> str:
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in fields.items()) + " || '}'"


def _plain(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'null')"


ENV_PLAIN = ["renovacion_automatica", "termino_anticipado_activo", "exclusividad_activo", "termino_anticipado_plazo_dias", "monto_total"]
ENV_CONTRACT = {f: _plain(f) if f in ENV_PLAIN else _js(f"CAST({f} AS VARCHAR)") for f in CONTRACT_OUT if not f.startswith("multa_")}
ENV_FINE = {f: _plain(f) if f == "monto_multa_uf" else _js(f) for f in ["tipo_incumplimiento", "implicancias", "monto_multa_uf", "plazo_constancia", "descripcion_completa"]}
ENV_ENT = _jobj({"tipo": _js("tipo"), "valor": _js("valor")})
ENV_SQL = _jobj({"id": _js("'contrato_20260101_000000'"), "Contrato": _jobj(ENV_CONTRACT),
                 **{s: _jobj({f: _js(f"{p}_{f}") for f in ("nombre", "rut", "domicilio")}) for s, p in (("CompaniaInfo", "comp"), ("ProveedoresInfo", "prov"))},
                 "Representantes": "'[' || coalesce(rl, '') || ']'", "Multas": "'[' || coalesce(fl, '') || ']'",
                 "Entidades": "coalesce(e1, '{\"tipo\":\"\",\"valor\":\"\"}')", "EntidadesList": "'[' || coalesce(el, '') || ']'",
                 "metadata": _jobj({"processedDate": _js("'2026-01-01T00:00:00'")})})


@register("structured_envelope", O.with_ctes(PC, f"""SELECT a.event_id, {ENV_SQL} AS envelope FROM acc a
  LEFT JOIN (SELECT event_id, string_agg({_jobj({'nombre': _js('nombre'), 'cedula_identidad': _js('cedula_identidad')})}, ',' ORDER BY pos) AS rl FROM rep_v GROUP BY event_id) r USING (event_id)
  LEFT JOIN (SELECT event_id, string_agg({_jobj(ENV_FINE)}, ',' ORDER BY pos) AS fl FROM fine_v GROUP BY event_id) f USING (event_id)
  LEFT JOIN (SELECT event_id, string_agg({ENV_ENT}, ',' ORDER BY pos) AS el, arg_min({ENV_ENT}, pos) AS e1 FROM ent_v GROUP BY event_id) e USING (event_id)"""))
def q_structured_envelope(spark, sf):
    """A10: the nested record of each accepted contract, as JSON text."""
    e = P.structured_envelope(normalized(spark, sf))
    text = F.to_json("envelope", {"ignoreNullFields": "false"})
    return e.select("event_id", F.regexp_replace(text, r":0E-12([,}])", ":0.000000000000$1").alias("envelope"))  # the same number, as SQL writes it


# ---------------------------------------------------------------------------
# star
# ---------------------------------------------------------------------------

SC = O.star_ctes()


@register("assign_ids", O.with_ctes(PC, "SELECT id, event_id FROM contrato"))
def q_assign_ids(spark, sf):
    """G1 dense ids without a single-partition window."""
    return star(spark, sf).contrato.select("id", "event_id")


@register("write_star", O.with_ctes(SC, "SELECT * FROM t_contrato"))
def q_write_star(spark, sf):
    """The parent table as published (ids, 16 columns, audit)."""
    return star(spark, sf).contrato


for _t in ST.STAR_TABLES[1:]:
    def _mk(t):
        def fn(spark, sf):
            return getattr(star(spark, sf), t)
        fn.__doc__ = f"A6 / E3: star table {t} with parent keys and audit columns."
        return fn
    REGISTRY[f"star_{_t}"] = (_mk(_t), O.with_ctes(SC, f"SELECT * FROM t_{_t}"))


@register("attach_parent_key", O.with_ctes(SC, "SELECT id, contrato_id FROM t_multas"))
def q_attach_parent_key(spark, sf):
    return star(spark, sf).multas.select("id", "contrato_id")


@register("rejected_contracts", O.with_ctes(PC, "SELECT event_id, reason FROM norm WHERE reason <> 'ok'"))
def q_rejected_contracts(spark, sf):
    """K7 error scope: contract-level rejects with their first failing rule."""
    return star(spark, sf).rejected


# ---------------------------------------------------------------------------
# §2.1-2.2, 2.10 events: gate, markers, status
# ---------------------------------------------------------------------------

from contractlake.operators import gate as G  # noqa: E402

GC = O.gate_ctes()


_GATE_CACHE: dict[tuple[str, str], DataFrame] = {}


def gated(spark, sf):
    """Gate decisions, taken once per session and input folder and written to the shared folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _GATE_CACHE:
        _GATE_CACHE[key] = saved(G.gate_events(fx.blob_events(spark, sf), fx.markers(spark, sf)), "gated")
    return _GATE_CACHE[key]


@register("event_source", O.with_ctes(GC[:1], "SELECT * FROM ev"))
def q_event_source(spark, sf):
    """A1 (batch twin of the stream source): blob events with re-deliveries."""
    return fx.blob_events(spark, sf)


@register("event_files", f"""SELECT CASE WHEN ok THEN json_extract_string(line, '$.event_id') END AS event_id, CASE WHEN ok THEN json_extract_string(line, '$.event_type') END AS event_type,
    CASE WHEN ok THEN json_extract_string(line, '$.subject') END AS subject, CASE WHEN ok THEN json_extract_string(line, '$.url') END AS url,
    CASE WHEN ok THEN TRY_CAST(json_extract_string(line, '$.event_time') AS TIMESTAMP) END AS event_time, CASE WHEN NOT ok THEN line END AS rejected_line
  FROM (SELECT line, coalesce(json_valid(line) AND TRY_CAST(json_extract_string(CASE WHEN json_valid(line) THEN line END, '$.event_time') AS TIMESTAMP) IS NOT NULL, false) AS ok
        FROM ({fx.event_lines_sql('duckdb')}) l) x""")
def q_event_files(spark, sf):
    """A1: events read from JSON files, an event a line; lines that hold none are kept aside with their text."""
    from contractlake.streaming import ingest as IN
    place = f"{checkpoint_dir(spark).rstrip('/')}/event-files-{uuid.uuid4().hex}"
    fx.event_lines(spark, sf).write.text(place)
    read, bad = IN.read_events(spark, place), F.col(IN.CORRUPT).isNotNull()
    return read.select(*[F.when(~bad, F.col(c)).alias(c) for c in G.EVENT_COLS], F.col(IN.CORRUPT).alias("rejected_line"))


@register("parse_blob_url", O.with_ctes(GC[:5], "SELECT event_id, event_time, account, container, blob_path FROM p2"))
def q_parse_blob_url(spark, sf):
    ev = fx.blob_events(spark, sf).groupBy(*G.EVENT_COLS).count()
    return ev.select("event_id", "event_time", *[v.alias(k) for k, v in G.parse_blob_url(F.col("url")).items()])


@register("split_folder_file", O.with_ctes(GC[:6], "SELECT event_id, event_time, folder, file FROM p3"))
def q_split_folder_file(spark, sf):
    ev = fx.blob_events(spark, sf).groupBy(*G.EVENT_COLS).count()
    blob = G.parse_blob_url(F.col("url"))["blob_path"]
    return ev.select("event_id", "event_time", *[v.alias(k) for k, v in G.split_folder_file(blob).items()])


@register("gate_events", O.with_ctes(GC, "SELECT * FROM gate_out"))
def q_gate_events(spark, sf):
    """B3 + E1 + T25: ordered gate rules with markers and in-batch repeats."""
    return gated(spark, sf)


@register("is_pdf_candidate", O.with_ctes(GC, "SELECT event_id, event_time, file, contains(lower(file), 'pdf') AS is_pdf FROM gate_out WHERE file IS NOT NULL"))
def q_is_pdf_candidate(spark, sf):
    g = gated(spark, sf)
    return g.filter(F.col("file").isNotNull()).select("event_id", "event_time", "file",
                                                     G.is_pdf_candidate(F.col("file")).alias("is_pdf"))


@register("json_output_name", O.with_ctes(GC, "SELECT event_id, file, json_name FROM gate_out WHERE status = 'pass'"))
def q_json_output_name(spark, sf):
    return gated(spark, sf).filter(F.col("status") == "pass").select("event_id", "file", "json_name")


@register("loop_guard", O.with_ctes(GC, """SELECT event_id, event_time, reason FROM gate_out
  WHERE reason IN ('processed-events container', 'not a pdf file')"""))
def q_loop_guard(spark, sf):
    """Events ignored because they come from the marker container or are not documents."""
    return gated(spark, sf).filter(F.col("reason").isin(G.R_MARKER_CONTAINER, G.R_NOT_PDF)).select(
        "event_id", "event_time", "reason")


@register("already_processed", O.with_ctes(GC, "SELECT DISTINCT event_id FROM ev WHERE event_id IN (SELECT event_id FROM mk)"))
def q_already_processed(spark, sf):
    """Left semi join of events to the marker table."""
    return G.already_processed(fx.blob_events(spark, sf), fx.markers(spark, sf)).select("event_id").distinct()


@register("mark_processed", O.with_ctes(GC, f"""SELECT DISTINCT event_id, TIMESTAMP '{AS_OF}' AS marked_at FROM gate_out
  WHERE status = 'pass' AND event_id NOT IN (SELECT event_id FROM mk)"""))
def q_mark_processed(spark, sf):
    """A5: marker rows to append (idempotent)."""
    return G.mark_processed(gated(spark, sf), fx.markers(spark, sf))


@register("status_summary", O.with_ctes(GC, "SELECT status, reason, CAST(sum(copies) AS BIGINT) AS events FROM gate_out GROUP BY ALL"))
def q_status_summary(spark, sf):
    """events by (status, reason)."""
    return G.status_summary(gated(spark, sf))


from contractlake.operators import outcome as OC  # noqa: E402
from contractlake.sources import buckets as BK  # noqa: E402


@register("stream_dedupe", O.with_ctes(GC, "SELECT event_id, event_time, url FROM gate_out WHERE status = 'pass'"))
def q_stream_dedupe(spark, sf):
    """Each event id at most once, against the marker table in buckets, of which only those of the events' ids are read."""
    events, place = fx.blob_events(spark, sf), f"{checkpoint_dir(spark).rstrip('/')}/markers-{uuid.uuid4().hex}"
    BK.write_buckets(fx.markers(spark, sf), place, "event_id")
    known = BK.read_buckets(spark, place, "event_id string, marked_at timestamp_ntz", "event_id", events)
    return G.gate_events(events, known).filter(F.col("status") == "pass").select("event_id", "event_time", "url")


@register("mark_before_process", O.with_ctes(GC, """SELECT event_id, event_time, subject, url, copies,
    CASE WHEN static_reason = 'processed-events container' THEN static_reason
         WHEN marked OR event_id IN (SELECT event_id FROM g3 WHERE status = 'pass') THEN 'already processed' ELSE static_reason END AS reason FROM g3"""))
def q_mark_before_process(spark, sf):
    """The same events delivered again, after a first batch that marked what it passed before it worked on it: nothing is tried
    twice, whatever became of it."""
    events, seeded = fx.blob_events(spark, sf), fx.markers(spark, sf).select("event_id")
    first = G.mark_processed(gated(spark, sf), fx.markers(spark, sf)).select("event_id")
    return G.gate_events(events, seeded.unionByName(first)).select("event_id", "event_time", "subject", "url", "copies", "reason")


# payloads of the blob events: one or more for most, only an empty one for some, none for others
EVENT_PC = O.payload_ctes("SELECT event_id, 0 AS doc_key, min(payload) AS payload FROM ev_payloads WHERE event_id IN (SELECT event_id FROM gate_out WHERE status = 'pass') GROUP BY event_id")


@register("event_to_star", O.with_ctes([*GC, ("ev_payloads", fx.event_payloads_sql("duckdb")), *EVENT_PC], """SELECT g.event_id, g.event_type, g.subject, g.url, g.event_time, g.copies,
    CASE WHEN g.status <> 'pass' THEN g.status WHEN n.reason = 'ok' THEN 'success' ELSE 'error' END AS status,
    CASE WHEN g.status <> 'pass' THEN g.reason WHEN n.event_id IS NULL THEN 'failed to load json' WHEN n.reason <> 'ok' THEN n.reason END AS reason,
    CASE WHEN g.status = 'pass' THEN k.contrato_id END AS contract_id
  FROM gate_out g LEFT JOIN norm n ON n.event_id = g.event_id LEFT JOIN keys k ON k.event_id = g.event_id"""))
def q_event_to_star(spark, sf):
    """J4, the batch twin of the stream: the terminal status of every delivery, with its contract id or the reason."""
    return OC.process_gated(gated(spark, sf), fx.event_payloads(spark, sf)).statuses()


# ---------------------------------------------------------------------------
# access paths and reports over the star
# ---------------------------------------------------------------------------

from contractlake.operators import access as A  # noqa: E402
from contractlake.operators import changes as CH  # noqa: E402


def _sq(sel: str) -> str:
    return O.with_ctes(SC, sel)


@register("contracts_by_type", _sq("""SELECT tipo_contrato, tipo_servicio, count(*) AS contracts,
  CAST(sum(monto_total) AS DECIMAL(38,2)) AS total_amount FROM t_contrato WHERE is_active GROUP BY ALL"""))
def q_contracts_by_type(spark, sf):
    """M1 (flagship): payloads -> accepted contracts -> count and amount by type."""
    return A.contracts_by_type(star(spark, sf).contrato)


@register("contracts_in_range", _sq("""SELECT id, event_id, fecha_inicio, fecha_termino FROM t_contrato
  WHERE is_active AND fecha_inicio BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'"""))
def q_contracts_in_range(spark, sf):
    return A.contracts_in_range(star(spark, sf).contrato, "1995-01-01", "1996-12-31")


@register("fines_of_contract", _sq("""SELECT c.event_id, m.contrato_id, m.id AS multa_id, m.tipo_incumplimiento, m.monto_multa_uf
  FROM t_multas m JOIN t_contrato c ON m.contrato_id = c.id WHERE m.is_active AND c.is_active"""))
def q_fines_of_contract(spark, sf):
    s = star(spark, sf)
    return A.fines_of_contract(s.multas, s.contrato)


@register("fines_by_breach", _sq("""SELECT tipo_incumplimiento, count(*) AS fines,
  CAST(sum(monto_multa_uf) AS DECIMAL(38,12)) AS total_uf FROM t_multas WHERE is_active GROUP BY ALL"""))
def q_fines_by_breach(spark, sf):
    return A.fines_by_breach(star(spark, sf).multas)


for _name, _tab in (("company_by_tax_id", "compania_info"), ("provider_by_tax_id", "proveedores_info")):
    def _mk_party(tab):
        def fn(spark, sf):
            s = star(spark, sf)
            return A.party_by_tax_id(getattr(s, tab), s.contrato)
        fn.__doc__ = f"M4: contracts per tax id of {tab}."
        return fn
    REGISTRY[_name] = (_mk_party(_tab), _sq(f"""SELECT p.rut, count(*) AS contracts, min(p.contrato_id) AS first_contrato_id
      FROM t_{_tab} p JOIN t_contrato c ON p.contrato_id = c.id WHERE p.is_active AND c.is_active GROUP BY p.rut"""))


@register("reps_by_national_id", _sq("""SELECT cedula_de_identidad, count(*) AS "rows", count(DISTINCT contrato_id) AS contracts
  FROM t_representantes WHERE is_active GROUP BY ALL"""))
def q_reps_by_national_id(spark, sf):
    return A.reps_by_national_id(star(spark, sf).representantes)


@register("entities_by_type", _sq("""SELECT tipo, count(*) AS entities, count(DISTINCT valor) AS distinct_values
  FROM t_entidades WHERE is_active GROUP BY ALL"""))
def q_entities_by_type(spark, sf):
    return A.entities_by_type(star(spark, sf).entidades)


@register("entities_by_type_name", _sq("""SELECT tipo, valor, count(*) AS entities FROM t_entidades WHERE is_active GROUP BY ALL"""))
def q_entities_by_type_name(spark, sf):
    return A.entities_by_type_name(star(spark, sf).entidades)


ATTR_SQL = """SELECT id AS entidad_id, contrato_id, 'tipo' AS nombre_atributo, tipo AS valor FROM t_entidades WHERE is_active
  UNION ALL SELECT id, contrato_id, 'valor', valor FROM t_entidades WHERE is_active"""


@register("entity_attributes", _sq(f"""SELECT c.event_id, a.entidad_id, e.tipo, a.nombre_atributo, a.valor
  FROM ({ATTR_SQL}) a JOIN t_entidades e ON a.entidad_id = e.id AND a.contrato_id = e.contrato_id
  JOIN t_contrato c ON a.contrato_id = c.id WHERE e.is_active AND c.is_active"""))
def q_entity_attributes(spark, sf):
    """Contract ⋈ entity ⋈ attribute."""
    s = star(spark, sf)
    return A.contract_entity_attributes(s.contrato, s.entidades, A.entity_attributes(s.entidades))


@register("attributes_by_name", _sq(f"""SELECT nombre_atributo, count(*) AS attributes, count(DISTINCT entidad_id) AS entities
  FROM ({ATTR_SQL}) a GROUP BY ALL"""))
def q_attributes_by_name(spark, sf):
    return A.attributes_by_name(A.entity_attributes(star(spark, sf).entidades))


@register("contracts_by_document", _sq("""SELECT nombre, count(*) AS contracts, min(id) AS first_id FROM t_contrato
  WHERE is_active AND nombre IS NOT NULL GROUP BY ALL"""))
def q_contracts_by_document(spark, sf):
    return A.contracts_by_document(star(spark, sf).contrato)


@register("contracts_by_reference", _sq(f"""SELECT nombre_documento, referencia_interna, count(*) AS contracts, min(c.id) AS first_id
  FROM t_contrato c JOIN (SELECT 'c' || lpad(CAST(doc_key AS VARCHAR), 12, '0') AS event_id, json_extract_string(metadata, '$.nombre_documento') AS nombre_documento,
                                 json_extract_string(metadata, '$.referencia_interna') AS referencia_interna FROM ({fx.metadata_sql('duckdb')}) m) d ON d.event_id = c.event_id
  WHERE c.is_active AND c.id % 11 <> 0 AND (nombre_documento IS NOT NULL OR referencia_interna IS NOT NULL) GROUP BY ALL"""))
def q_contracts_by_reference(spark, sf):
    """M8 + B9: active contracts by document name and internal reference, some soft-deleted before."""
    c = star(spark, sf).contrato
    meta = fx.metadata(spark, sf).select(F.concat(F.lit("c"), F.lpad(F.col("doc_key").cast("string"), 12, "0")).alias("event_id"), P.metadata_record(F.try_parse_json("metadata")).alias("m"))
    meta = meta.join(c.select("event_id", F.col("id").alias("contrato_id")), "event_id").select("contrato_id", "m.nombre_documento", "m.referencia_interna")
    live = CH.soft_delete(c, c.filter(F.col("id") % 11 == 0), F.to_timestamp_ntz(F.lit("2026-01-03 00:00:00")))
    return A.contracts_by_reference(A.with_metadata(live, meta))


@register("section_counts", _sq("""SELECT c.id AS contrato_id, c.event_id,
    coalesce(r.n, 0) AS representantes, coalesce(m.n, 0) AS multas, coalesce(e.n, 0) AS entidades
  FROM t_contrato c
  LEFT JOIN (SELECT contrato_id, count(*) AS n FROM t_representantes WHERE is_active GROUP BY ALL) r ON r.contrato_id = c.id
  LEFT JOIN (SELECT contrato_id, count(*) AS n FROM t_multas WHERE is_active GROUP BY ALL) m ON m.contrato_id = c.id
  LEFT JOIN (SELECT contrato_id, count(*) AS n FROM t_entidades WHERE is_active GROUP BY ALL) e ON e.contrato_id = c.id
  WHERE c.is_active"""))
def q_section_counts(spark, sf):
    """F2."""
    s = star(spark, sf)
    return A.section_counts(s.contrato, s.representantes, s.multas, s.entidades)


@register("fine_totals", _sq("""SELECT contrato_id, tipo_incumplimiento, count(*) AS fines,
  CAST(sum(monto_multa_uf) AS DECIMAL(38,12)) AS total_uf FROM t_multas WHERE is_active GROUP BY ALL"""))
def q_fine_totals(spark, sf):
    """F7."""
    return A.fine_totals(star(spark, sf).multas)


@register("child_ids", _sq("""SELECT contrato_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids
  FROM t_multas WHERE is_active GROUP BY contrato_id"""))
def q_child_ids(spark, sf):
    """generated fine ids per contract."""
    return A.child_ids(star(spark, sf).multas)


@register("star_view", _sq("""SELECT c.id AS contrato_id, c.event_id, c.tipo_contrato, c.parte_cliente, c.monto_total, c.fecha_inicio,
    co.nombre AS compania_nombre, co.rut AS compania_rut, m.multas, r.representantes, p.proveedores, e.entidades
  FROM t_contrato c
  LEFT JOIN (SELECT contrato_id, string_agg(CAST(id AS VARCHAR) || ':' || coalesce(nombre, '') || ':' || coalesce(rut, ''), '|' ORDER BY id) AS proveedores
             FROM t_proveedores_info GROUP BY contrato_id) p ON p.contrato_id = c.id
  LEFT JOIN (SELECT contrato_id, string_agg(CAST(id AS VARCHAR) || ':' || coalesce(tipo, '') || ':' || coalesce(valor, ''), '|' ORDER BY id) AS entidades
             FROM t_entidades GROUP BY contrato_id) e ON e.contrato_id = c.id
  LEFT JOIN t_compania_info co ON co.contrato_id = c.id
  LEFT JOIN (SELECT contrato_id, string_agg(CAST(id AS VARCHAR) || ':' || tipo_incumplimiento, '|' ORDER BY id) AS multas
             FROM t_multas GROUP BY contrato_id) m ON m.contrato_id = c.id
  LEFT JOIN (SELECT contrato_id, string_agg(CAST(id AS VARCHAR) || ':' || nombre, '|' ORDER BY id) AS representantes
             FROM t_representantes GROUP BY contrato_id) r ON r.contrato_id = c.id"""))
def q_star_view(spark, sf):
    """E5: nested contract view (rendered flat for comparison)."""
    s = star(spark, sf)
    view = A.star_view(s.contrato, s.compania_info, s.multas, s.representantes)
    return A.star_view_flat(A.star_view_full(view, s.proveedores_info, s.entidades))


@register("active_rows", _sq(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS active_rows FROM t_{t} WHERE is_active AND id % 11 <> 0" for t in ST.STAR_TABLES)))
def q_active_rows(spark, sf):
    """Rows of each table that are left after soft deletes."""
    at = F.to_timestamp_ntz(F.lit("2026-01-03 00:00:00"))
    return A.active_rows({t: CH.soft_delete(df, df.filter(F.col("id") % 11 == 0), at) for t, df in star(spark, sf).tables().items()})


# ---------------------------------------------------------------------------
# pages and extraction
# ---------------------------------------------------------------------------

from contractlake.operators import extract as X  # noqa: E402
from contractlake.operators import pages as PG  # noqa: E402

PLS = fx.page_lines_sql("duckdb")
WSP = O.WS + "+"


@register("lines_by_page", f"""SELECT doc_id, page_no, count(*) AS n_lines, list(line ORDER BY line_no) AS lines
  FROM ({PLS}) pl GROUP BY ALL""")
def q_lines_by_page(spark, sf):
    """F3."""
    return PG.lines_by_page(fx.page_lines(spark, sf))


@register("pack_pages", f"""SELECT doc_id, count(*) AS n_pages, string_agg('Page-' || CAST(page_no AS VARCHAR), ',' ORDER BY page_no) AS page_keys
  FROM (SELECT DISTINCT doc_id, page_no FROM ({PLS}) pl) GROUP BY doc_id""")
def q_pack_pages(spark, sf):
    """Page map per document (keys in page order)."""
    p = PG.pack_pages(fx.page_lines(spark, sf))
    return p.select("doc_id", F.size("pages").alias("n_pages"), F.array_join(F.map_keys("pages"), ",").alias("page_keys"))


@register("unpack_pages", f"SELECT doc_id, page_no, line_no, line FROM ({PLS}) pl")
def q_unpack_pages(spark, sf):
    """C17: page JSON read back to lines (round trip of C16 equals the input lines)."""
    return PG.unpack_pages(PG.pack_pages(fx.page_lines(spark, sf)))


@register("number_pages", f"""SELECT DISTINCT doc_id, 'Page-' || CAST(page_no AS VARCHAR) AS page_key, page_no FROM ({PLS}) pl""")
def q_number_pages(spark, sf):
    """G3."""
    return PG.number_pages(PG.pack_pages(fx.page_lines(spark, sf)))


@register("doc_stats", f"""SELECT doc_id,
    CAST(sum(len(regexp_extract_all(line, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}\\s]'))) AS BIGINT) AS numero_tokens,
    count(*) FILTER (WHERE regexp_matches(lower({O.strip('line')}), '^anexo\\s+([0-9]+|[a-z])(\\W|$)')) AS total_anexos,
    CAST(sum(CASE WHEN {O.strip('line')} = '' THEN 0 ELSE len(regexp_split_to_array({O.strip('line')}, '{WSP}')) END) AS BIGINT) AS total_palabras,
    count(*) AS lines, max(page_no) AS numero_pagina, CAST(sum(length(line)) AS BIGINT) AS chars
  FROM ({PLS}) pl GROUP BY doc_id""")
def q_doc_stats(spark, sf):
    """Words, lines, pages, characters per document."""
    return PG.doc_stats(fx.page_lines(spark, sf))


@register("read_document", O.with_ctes(GC, f"""SELECT g.event_id, g.bp AS blob_path, s.doc_id,
    CASE WHEN s.doc_id IS NULL THEN 'failed to load json' ELSE 'loaded' END AS load_status
  FROM (SELECT event_id, CASE WHEN folder IS NULL OR folder = '' THEN file ELSE folder || '/' || file END AS bp
        FROM gate_out WHERE status = 'pass') g
  LEFT JOIN (SELECT DISTINCT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'in/2024/' ELSE '' END || 'c' || CAST(doc_id AS VARCHAR) || '.pdf' AS path
             FROM documents) s ON s.path = g.bp"""))
def q_read_document(spark, sf):
    """A3 + T19 + T21: passing events look up their document; missing -> 'failed to load json'."""
    req = gated(spark, sf).filter(F.col("status") == "pass").select("event_id", "folder", "file")
    store = PG.doc_store(fx.page_lines(spark, sf), req)
    return PG.read_document(req, store).select("event_id", "blob_path", "doc_id", "load_status")


@register("files_for_day", f"""SELECT folder, day, basename, arg_max(blob_path, listed_at) AS blob_path, max(listed_at) AS listed_at
  FROM (SELECT CASE WHEN starts_with(blob_path, 'in/') THEN 'in' ELSE '' END AS folder, blob_path, listed_at, strftime(listed_at, '%Y-%m-%d') AS day,
               string_split(blob_path, '/')[-1] AS basename FROM ({fx.file_catalogue_sql('duckdb')}) c) x
  GROUP BY folder, day, basename""")
def q_files_for_day(spark, sf):
    """A2: per-day listing of each folder, keyed by basename, later listing wins."""
    c = fx.file_catalogue(spark, sf)
    found = [PG.files_for_day(c, folder or None).select(F.lit(folder).alias("folder"), "day", "basename", "blob_path", "listed_at") for folder in ("", "in")]
    return found[0].unionByName(found[1])


@register("files_by_folder", f"""SELECT folder, day, basename, blob_path, listed_at
  FROM (SELECT *, row_number() OVER (PARTITION BY folder, day, basename ORDER BY listed_at DESC, blob_path DESC) AS k
        FROM (SELECT CASE WHEN starts_with(blob_path, 'in/') THEN 'in' ELSE '' END AS folder, strftime(listed_at, '%Y-%m-%d') AS day,
                     string_split(blob_path, '/')[-1] AS basename, blob_path, listed_at
              FROM (SELECT blob_path, listed_at FROM ({fx.file_catalogue_sql('duckdb')}) c
                    UNION ALL SELECT replace(blob_path, '/c', '/again/c'), CAST(CAST(listed_at AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR
                    FROM ({fx.file_catalogue_sql('duckdb')}) d) u) f) r
  WHERE k = 1""")
def q_files_by_folder(spark, sf):
    """A2: the listings of all folders, every event's file in one of them; each is listed again at noon in a subfolder, so that the
    later listing is now the one, now the other."""
    c = fx.file_catalogue(spark, sf)
    noon = (F.date_trunc("day", "listed_at") + F.expr("INTERVAL 12 HOURS")).cast(c.schema["listed_at"].dataType)
    again = c.select(F.replace("blob_path", F.lit("/c"), F.lit("/again/c")).alias("blob_path"), noon.alias("listed_at"))
    return PG.files_by_folder(c.unionByName(again)).select("folder", "day", "basename", "blob_path", "listed_at")


LLS = fx.labeled_lines_sql("duckdb")


def _x(field: str) -> str:
    rx = X.LABEL_RX
    return (f"arg_min(regexp_extract(line, '{rx}', 2), CAST(page_no AS BIGINT) * 1000000000 + line_no) "
            f"FILTER (WHERE lower(regexp_extract(line, '{rx}', 1)) = '{[k for k, v in X.LABEL_FIELDS.items() if v == field][0]}')")


@register("extract_fields", f"""SELECT doc_id, {_x('tipo_contrato')} AS tipo_contrato, {_x('fecha_inicio')} AS fecha_inicio,
    {_x('monto_total')} AS monto_total,
    TRY_CAST(NULLIF(regexp_extract({_x('termino_anticipado_plazo_dias')}, '(\\d+)', 1), '') AS INTEGER) AS termino_anticipado_plazo_dias
  FROM ({LLS}) l GROUP BY doc_id""")
def q_extract_fields(spark, sf):
    """C19 (re-aimed): rule-based extraction of contract fields from page lines."""
    return X.extract_fields(fx.labeled_lines(spark, sf))


def _indented(pages: str) -> str:
    """Pages (doc_id, page_no, line_no, line) as JSON with two blanks a level, in SQL of its own."""
    return f"""SELECT doc_id, '{{' || chr(10) || string_agg(page, ',' || chr(10) ORDER BY page_no) || chr(10) || '}}' AS j
      FROM (SELECT doc_id, page_no, '  "Page-' || page_no || '": [' || chr(10) || string_agg('    ' || to_json(line), ',' || chr(10) ORDER BY line_no) || chr(10) || '  ]' AS page
            FROM ({pages}) pl GROUP BY doc_id, page_no) q GROUP BY doc_id"""


@register("extraction_request", f"""SELECT doc_id, {O.q(X.REQUEST_HEAD)} || chr(10) || '---' || chr(10) || j || chr(10) || '---' || chr(10) || {O.q(X.REQUEST_TAIL)} AS request
  FROM ({_indented(PLS)}) i""")
def q_extraction_request(spark, sf):
    """Request text per document, its pages as indented JSON."""
    return X.extraction_request(fx.page_lines(spark, sf))


XC = O.extraction_ctes(fx.contract_lines_sql("duckdb"))


@register("extract_sections", O.with_ctes(XC, "SELECT doc_id, section, part, field, value FROM kv"))
def q_extract_sections(spark, sf):
    """The first value of each label under each heading of the contract documents."""
    return X.labelled(fx.contract_lines(spark, sf)).filter("field IS NOT NULL").select("doc_id", "section", "part", "field", "value")


EXTRACTED_PC = O.payload_ctes("SELECT 'd' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS event_id, doc_id AS doc_key, payload FROM extracted")
_EXTRACTED: dict[tuple[str, str], DataFrame] = {}


def extracted(spark, sf):
    """Payloads of the contract documents, normalized once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _EXTRACTED:
        docs = X.extract_payloads(fx.contract_lines(spark, sf))
        docs = docs.select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("event_id"), "payload")
        _EXTRACTED[key] = saved(P.normalize_payloads(docs), "extracted")
    return _EXTRACTED[key]


@register("extracted_contracts", O.with_ctes([*XC, *EXTRACTED_PC], "SELECT event_id, reason, " + ", ".join(f"CASE WHEN reason = 'ok' THEN {c} END AS {c}" for c in CONTRACT_OUT) + " FROM norm"))
def q_extracted_contracts(spark, sf):
    """C19 -> C1-C15: what normalization makes of the payloads extracted from page lines."""
    n = extracted(spark, sf)
    return n.select("event_id", "reason", *[F.when(F.col("reason") == P.OK, F.col("contract")[c]).alias(c) for c in CONTRACT_OUT])


@register("extracted_fines", O.with_ctes([*XC, *EXTRACTED_PC], """SELECT f.event_id, f.pos, tipo_incumplimiento, implicancias, monto_multa_uf, plazo_constancia, descripcion_completa
  FROM fine_v f JOIN acc USING (event_id) WHERE tipo_incumplimiento <> '' AND NOT uf_bad AND length(plazo_constancia) <= 255"""))
def q_extracted_fines(spark, sf):
    """C19 -> C10: the fines found on the pages of accepted documents."""
    return P.explode_fines(extracted(spark, sf))


def page_json_of(spark, sf):
    """A3 + A4: the pages of the documents that passing events name, written next to them and read back."""
    requests = gated(spark, sf).filter(F.col("status") == "pass").select("event_id", "folder", "file", "json_name")
    store = PG.doc_store(fx.contract_lines(spark, sf), requests)
    found = PG.read_document(requests, store).filter("load_status = 'loaded'").select("folder", "json_name", "page_json")
    place = f"{checkpoint_dir(spark).rstrip('/')}/page-json-{uuid.uuid4().hex}"
    PG.write_page_json(found, place)
    back = PG.read_page_json(spark, place)
    asked = requests.select("event_id", F.col("folder").alias("f"), F.col("json_name").alias("j"))
    return asked.join(back, F.col("f").eqNullSafe(F.col("folder")) & (F.col("j") == F.col("json_name"))).select("event_id", "folder", "json_name", "page_json")


CONTRACT_LINES = fx.contract_lines_sql("duckdb")
FLOW_DOCS = [("asked", "SELECT event_id, folder, json_name, CASE WHEN folder IS NULL OR folder = '' THEN file ELSE folder || '/' || file END AS bp FROM gate_out WHERE status = 'pass'"),
             ("asked_lines", f"""SELECT a.event_id, a.folder, a.json_name, l.* FROM ({CONTRACT_LINES}) l
                 JOIN asked a ON a.bp = CASE WHEN l.doc_id % 2 = 0 THEN 'in/2024/' ELSE '' END || 'c' || CAST(l.doc_id AS VARCHAR) || '.pdf'""")]


@register("write_page_json", O.with_ctes([*GC, *FLOW_DOCS], "SELECT event_id, folder, json_name, page_no, line_no, line FROM asked_lines"))
def q_write_page_json(spark, sf):
    """A4: page JSON of passing events' documents as written by folder, read back to lines."""
    lines = PG.unpack_pages(page_json_of(spark, sf).withColumn("doc_id", F.struct("event_id", "folder", "json_name")))
    return lines.select("doc_id.*", "page_no", "line_no", "line")


FLOW_PC = O.payload_ctes("SELECT doc_id AS event_id, 0 AS doc_key, payload FROM extracted")
TERMINAL = """CASE WHEN g.status <> 'pass' THEN g.status WHEN n.reason = 'ok' THEN 'success' ELSE 'error' END AS status,
    CASE WHEN g.status <> 'pass' THEN g.reason WHEN n.event_id IS NULL THEN 'failed to load json' WHEN n.reason <> 'ok' THEN n.reason END AS reason,
    CASE WHEN g.status = 'pass' THEN k.contrato_id END AS contract_id
  FROM gate_out g LEFT JOIN norm n ON n.event_id = g.event_id LEFT JOIN keys k ON k.event_id = g.event_id"""


@register("document_flow", O.with_ctes([*GC, *FLOW_DOCS, *O.extraction_ctes("SELECT event_id AS doc_id, page_no, line_no, line FROM asked_lines"), *FLOW_PC],
                                       f"SELECT g.event_id, g.event_time, g.copies, {TERMINAL}"))
def q_document_flow(spark, sf):
    """The whole way: event -> gate -> document -> page JSON, written and read back -> extraction -> payload -> star -> terminal status."""
    lines = PG.unpack_pages(page_json_of(spark, sf).withColumn("doc_id", F.col("event_id")))
    payloads = X.extract_payloads(lines).select(F.col("doc_id").alias("event_id"), "payload")
    return OC.process_gated(gated(spark, sf), saved(payloads, "payloads")).statuses().select("event_id", "event_time", "copies", "status", "reason", "contract_id")


# ---------------------------------------------------------------------------
# quality (K3-K6, F5, H1) and changes
# ---------------------------------------------------------------------------

from contractlake import schemas as SCH  # noqa: E402
from contractlake.operators import quality as QL  # noqa: E402


def broken_multas(s):
    """Incoming fines with a broken parent key for every 50th id (FIXTURES §3.5)."""
    return s.multas.withColumn("contrato_id", F.when(F.col("id") % 50 == 0, F.col("contrato_id") + 1000000)
                               .otherwise(F.col("contrato_id")))


BROKEN_MULTAS = "SELECT * REPLACE (CASE WHEN id % 50 = 0 THEN contrato_id + 1000000 ELSE contrato_id END AS contrato_id) FROM t_multas"


@register("orphan_rows", _sq(f"SELECT id, contrato_id FROM ({BROKEN_MULTAS}) m WHERE contrato_id NOT IN (SELECT id FROM t_contrato)"))
def q_orphan_rows(spark, sf):
    """K4: fines whose contract does not exist."""
    s = star(spark, sf)
    return QL.orphan_rows(broken_multas(s), s.contrato).select("id", "contrato_id")


@register("ordered_constraints", _sq(" UNION ALL ".join(
    f"SELECT '{t}' AS child_table, 'contrato' AS parent_table, 'contrato_id' AS fk_column, count(*) AS orphans "
    f"FROM {('(' + BROKEN_MULTAS + ') x') if t == 'multas' else 't_' + t} WHERE contrato_id NOT IN (SELECT id FROM t_contrato)"
    for t in SCH.LINKS_A)))
def q_ordered_constraints(spark, sf):
    """H1 (re-aimed): child -> parent links with orphan counts, ordered by table."""
    s = star(spark, sf)
    kids = {t: (broken_multas(s) if t == "multas" else getattr(s, t)) for t in SCH.LINKS_A}
    return QL.orphan_counts(kids, s.contrato)


NOT_NULL = {"representantes": ["contrato_id", "nombre", "cedula_de_identidad"],
            "multas": ["contrato_id", "tipo_incumplimiento"], "entidades": ["contrato_id", "tipo", "valor"]}
BROKEN_REPS = "SELECT * REPLACE (CASE WHEN id % 40 = 0 THEN NULL ELSE nombre END AS nombre) FROM t_representantes"


@register("not_null_check", _sq(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls "
    f"FROM {('(' + BROKEN_REPS + ') x') if t == 'representantes' else 't_' + t}"
    for t, cols in NOT_NULL.items() for c in cols)))
def q_not_null_check(spark, sf):
    """K5: NULLs in NOT NULL columns (incoming representatives with missing names)."""
    s = star(spark, sf)
    reps = s.representantes.withColumn("nombre", F.when(F.col("id") % 40 == 0, F.lit(None)).otherwise(F.col("nombre")))
    src = {"representantes": reps, "multas": s.multas, "entidades": s.entidades}
    out = None
    for t, cols in NOT_NULL.items():
        one = QL.not_null_check(src[t], t, cols)
        out = one if out is None else out.unionByName(one)
    return out


@register("party_duplicate_keys", _sq(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, rut, count(*) AS n FROM t_{t} WHERE is_active GROUP BY rut HAVING count(*) > 1"
    for t in ("compania_info", "proveedores_info"))))
def q_party_duplicate_keys(spark, sf):
    """F5 over both party tables: tax ids that repeat among active rows."""
    s = star(spark, sf)
    found = [QL.duplicate_keys(getattr(s, t), "rut").select(F.lit(t).alias("table_name"), "rut", "n") for t in ("compania_info", "proveedores_info")]
    return found[0].unionByName(found[1])


REGISTRY["duplicate_keys"] = REGISTRY["party_duplicate_keys"]
STAR_LIMITS = {t: lim for t, schema in SCH.STAR_A.items() if (lim := {f.name: f.metadata["max_length"] for f in schema.fields if "max_length" in f.metadata})}
# one column of each table that has limits, too long in every so many rows
TOO_LONG = {"contrato": ("tipo_contrato", 20), "multas": ("plazo_constancia", 50), "compania_info": ("rut", 30), "proveedores_info": ("rut", 25),
            "representantes": ("nombre", 40), "entidades": ("tipo", 35)}


@register("star_length_check", _sq(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE length({c}) > {n}) AS too_long "
    f"FROM (SELECT * REPLACE (CASE WHEN id % {TOO_LONG[t][1]} = 0 THEN {TOO_LONG[t][0]} || repeat('0', 300) ELSE {TOO_LONG[t][0]} END AS {TOO_LONG[t][0]}) FROM t_{t}) x"
    for t, lim in STAR_LIMITS.items() for c, n in lim.items())))
def q_star_length_check(spark, sf):
    """K6 over every length-limited column of the six star tables (incoming values too long in each)."""
    out = None
    for t, df in star(spark, sf).tables().items():
        col, every = TOO_LONG[t]
        broken = df.withColumn(col, F.when(F.col("id") % every == 0, F.concat(col, F.lit("0" * 300))).otherwise(F.col(col)))
        one = QL.length_check(broken, t, STAR_LIMITS[t])
        out = one if out is None else out.unionByName(one)
    return out


REGISTRY["length_check"] = REGISTRY["star_length_check"]


@register("star_view_full", _sq("""SELECT c.id AS contrato_id, c.event_id, p.proveedores, e.entidades
  FROM t_contrato c
  LEFT JOIN (SELECT contrato_id, string_agg(CAST(id AS VARCHAR) || ':' || coalesce(nombre, '') || ':' || coalesce(rut, ''), '|' ORDER BY id) AS proveedores
             FROM t_proveedores_info WHERE is_active GROUP BY contrato_id) p ON p.contrato_id = c.id
  LEFT JOIN (SELECT contrato_id, string_agg(CAST(id AS VARCHAR) || ':' || coalesce(tipo, '') || ':' || coalesce(valor, ''), '|' ORDER BY id) AS entidades
             FROM t_entidades WHERE is_active GROUP BY contrato_id) e ON e.contrato_id = c.id
  WHERE c.is_active"""))
def q_star_view_full(spark, sf):
    """E5: the providers and entities of each contract, beside what ``star_view`` shows."""
    s = star(spark, sf)
    view = A.star_view(s.contrato, s.compania_info, s.multas, s.representantes)
    return A.star_view_full_flat(A.star_view_full(view, s.proveedores_info, s.entidades))


def change_rows(s):
    """Updates to published contracts (FIXTURES §3.5): a text update, a later update of the same column to NULL, a soft
    delete and a metadata-only update, by id residue; a contract can have all of them."""
    c = s.contrato.select("id")

    def one(modulus, col, at, text=None, active=None):
        return c.filter(F.col("id") % modulus == 0).select(
            "id", F.array(F.lit(col)).alias("set_cols"), (text if text is not None else F.lit(None)).cast("string").alias("descripcion"),
            F.lit(active).cast("boolean").alias("is_active"), F.to_timestamp_ntz(F.lit(at)).alias("changed_at"))
    return (one(7, "descripcion", "2026-01-02 00:00:00", F.concat(F.lit("Actualizado "), F.col("id").cast("string")))
            .unionByName(one(14, "descripcion", "2026-01-09 00:00:00"))
            .unionByName(one(11, "is_active", "2026-01-03 00:00:00", active=False))
            .unionByName(one(13, "numero_pagina", "2026-01-04 00:00:00")))


CHANGES_SQL = """SELECT id, ['descripcion'] AS set_cols, 'Actualizado ' || CAST(id AS VARCHAR) AS descripcion,
    CAST(NULL AS BOOLEAN) AS is_active, TIMESTAMP '2026-01-02 00:00:00' AS changed_at FROM t_contrato WHERE id % 7 = 0
  UNION ALL SELECT id, ['descripcion'], NULL, NULL, TIMESTAMP '2026-01-09 00:00:00' FROM t_contrato WHERE id % 14 = 0
  UNION ALL SELECT id, ['is_active'], NULL, false, TIMESTAMP '2026-01-03 00:00:00' FROM t_contrato WHERE id % 11 = 0
  UNION ALL SELECT id, ['numero_pagina'], NULL, NULL, TIMESTAMP '2026-01-04 00:00:00' FROM t_contrato WHERE id % 13 = 0"""
COMB_SQL = f"""SELECT id, list_sort(list_distinct(flatten(list(set_cols)))) AS set_cols, max(changed_at) AS changed_at
  FROM ({CHANGES_SQL}) ch GROUP BY id"""
# written per residue, not as a fold over changes: what the contract must look like in the end
APPLIED_SQL = """SELECT t.id,
    CASE WHEN id % 14 = 0 THEN NULL WHEN id % 7 = 0 THEN 'Actualizado ' || CAST(id AS VARCHAR) ELSE descripcion END AS descripcion,
    CASE WHEN id % 11 = 0 THEN false ELSE is_active END AS is_active,
    CASE WHEN id % 14 = 0 THEN TIMESTAMP '2026-01-09 00:00:00' WHEN id % 13 = 0 THEN TIMESTAMP '2026-01-04 00:00:00'
         WHEN id % 11 = 0 THEN TIMESTAMP '2026-01-03 00:00:00' WHEN id % 7 = 0 THEN TIMESTAMP '2026-01-02 00:00:00'
         ELSE updated_at END AS updated_at
  FROM t_contrato t"""


def applied(spark, sf):
    s = star(spark, sf)
    return CH.apply_changes(s.contrato, change_rows(s))


@register("touch_updated_at", _sq(APPLIED_SQL))
def q_touch_updated_at(spark, sf):
    """L2 + E4: changes applied, updated_at stamped on every updated row."""
    return applied(spark, sf).select("id", "descripcion", "is_active", "updated_at")


@register("join_updated_rows", _sq(f"""SELECT t.id, c.changed_at FROM t_contrato t JOIN ({COMB_SQL}) c ON c.id = t.id"""))
def q_join_updated_rows(spark, sf):
    """Target rows joined to the (combined) updated row set on the primary key."""
    s = star(spark, sf)
    return s.contrato.join(CH.combine_changes(change_rows(s)), "id").select("id", "changed_at")


@register("touch_on_metadata", _sq(f"""SELECT id, list_has_any(set_cols, [{', '.join(O.q(c) for c in SCH.META_COLS)}]) AS touched
  FROM ({COMB_SQL}) c"""))
def q_touch_on_metadata(spark, sf):
    """L3: does the update's SET list name a metadata column?"""
    ch = CH.combine_changes(change_rows(star(spark, sf)))
    return ch.select("id", CH.metadata_touched(F.col("set_cols")).alias("touched"))


@register("soft_delete", _sq(f"SELECT id FROM ({APPLIED_SQL}) a WHERE NOT is_active"))
def q_soft_delete(spark, sf):
    """L4: rows soft-deleted by the change set (kept, inactive)."""
    return applied(spark, sf).filter(~F.col("is_active")).select("id")


@register("touch_on_metadata_applied", _sq("""SELECT id, CASE WHEN id % 13 = 0 THEN TIMESTAMP '2026-01-04 00:00:00' ELSE updated_at END AS updated_at
  FROM t_contrato"""))
def q_touch_on_metadata_applied(spark, sf):
    """L3: the changes applied, with updated_at stamped by updates of a metadata column only."""
    s = star(spark, sf)
    return CH.apply_changes(s.contrato, change_rows(s), meta_only=True).select("id", "updated_at")


@register("soft_delete_keys", _sq("""SELECT id, id % 11 <> 0 AND is_active AS is_active,
    CASE WHEN id % 11 = 0 THEN TIMESTAMP '2026-01-03 00:00:00' ELSE updated_at END AS updated_at FROM t_contrato"""))
def q_soft_delete_keys(spark, sf):
    """L4: contracts marked inactive by key; the rows are kept."""
    c = star(spark, sf).contrato
    at = F.to_timestamp_ntz(F.lit("2026-01-03 00:00:00"))
    return CH.soft_delete(c, c.filter(F.col("id") % 11 == 0), at).select("id", "is_active", "updated_at")


@register("contracts_by_type_after_changes", _sq(f"""SELECT t.tipo_contrato, t.tipo_servicio, count(*) AS contracts,
    CAST(sum(t.monto_total) AS DECIMAL(38,2)) AS total_amount
  FROM t_contrato t JOIN ({APPLIED_SQL}) a ON a.id = t.id WHERE a.is_active GROUP BY ALL"""))
def q_contracts_by_type_after_changes(spark, sf):
    """M1 + B9 over the changed version: soft-deleted contracts are left out."""
    return A.contracts_by_type(applied(spark, sf))


NEW_REPS_SQL = """SELECT contrato_id, id AS pos, CASE WHEN id % 5 = 0 THEN '  ' ELSE nombre END AS nombre,
    CASE WHEN id % 4 = 0 THEN 'N' || CAST(id AS VARCHAR) ELSE cedula_de_identidad END AS cedula_de_identidad FROM t_representantes
  UNION ALL SELECT contrato_id, id + 1000000000, 'otro', cedula_de_identidad FROM t_representantes"""


@register("resolved_representatives", _sq(f"""SELECT contrato_id, pos, nombre, cedula_de_identidad, existing_id IS NOT NULL AS reused,
    CAST(coalesce(existing_id, 999999 + row_number() OVER (PARTITION BY existing_id IS NULL ORDER BY contrato_id, pos)) AS BIGINT) AS id
  FROM (SELECT f.*, a.existing_id
        FROM (SELECT * FROM ({NEW_REPS_SQL}) n WHERE {O.strip('nombre')} <> '' AND {O.strip('cedula_de_identidad')} <> ''
              QUALIFY row_number() OVER (PARTITION BY contrato_id, cedula_de_identidad ORDER BY pos) = 1) f
        LEFT JOIN (SELECT contrato_id, cedula_de_identidad, min(id) AS existing_id FROM t_representantes WHERE id % 3 <> 0 GROUP BY ALL) a
          ON a.contrato_id = f.contrato_id AND a.cedula_de_identidad = f.cedula_de_identidad) j"""))
def q_resolved_representatives(spark, sf):
    """B8 + G2 + E2: valid representatives, the first per national id, with the id of an active one reused."""
    r = star(spark, sf).representantes
    text = F.col("id").cast("string")
    new = r.select("contrato_id", F.col("id").alias("pos"), F.when(F.col("id") % 5 == 0, "  ").otherwise(F.col("nombre")).alias("nombre"),
                   F.when(F.col("id") % 4 == 0, F.concat(F.lit("N"), text)).otherwise(F.col("cedula_de_identidad")).alias("cedula_de_identidad"))
    again = r.select("contrato_id", (F.col("id") + 1000000000).alias("pos"), F.lit("otro").alias("nombre"), "cedula_de_identidad")
    existing = r.withColumn("is_active", F.col("id") % 3 != 0)
    return (ST.resolve_existing_reps(new.unionByName(again), existing, 1000000)
            .select("contrato_id", "pos", "nombre", "cedula_de_identidad", "reused", "id"))


@register("default_national_id", _sq(f"""SELECT id, 'DEFAULT-' || left(array_to_string(list_slice(regexp_split_to_array({O.strip('nombre')}, '{WSP}'), 1, 2), ''), 10)
    || '-Cliente-' || strftime(TIMESTAMP '{AS_OF}', '%Y%m%d%H%M%S') AS national_id FROM t_representantes"""))
def q_default_national_id(spark, sf):
    """The id that a representative without a national id is given."""
    r = star(spark, sf).representantes
    return r.select("id", S.default_national_id(F.col("nombre"), F.lit("Cliente")).alias("national_id"))

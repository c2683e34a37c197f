"""Derived inputs (FIXTURES.md §3) built from the given test tables.

Each derivation is one SQL text rendered for two dialects: ``spark`` (tables read as
``parquet.`path``` so pruning and pushdown reach the scan) and ``duckdb`` (the oracle's
pre-registered views). Only integer arithmetic and string concatenation are used, so
both engines build byte-identical rows. The only dialect switch is the ordered string
aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

MONTH_NAMES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
               "septiembre", "octubre", "noviembre", "diciembre"]


def refs(dialect: str, sf_dir: str | None = None) -> dict[str, str]:
    if dialect == "spark":
        return {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}
    return {t: t for t in TABLES}


def ordered_concat(dialect: str, expr: str, order: str) -> str:
    if dialect == "spark":
        return f"listagg({expr}, ',') WITHIN GROUP (ORDER BY {order})"
    return f"string_agg({expr}, ',' ORDER BY {order})"


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _month_name(m: str) -> str:
    whens = " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(MONTH_NAMES))
    return f"CASE {m} {whens} END"


def date_text(k: str, ts: str) -> str:
    """Date text by k % 10 (FIXTURES §3.1)."""
    y, m, d = _s(f"year({ts})"), _s(f"month({ts})"), _s(f"day({ts})")
    mm, dd = f"lpad({m}, 2, '0')", f"lpad({d}, 2, '0')"
    mon = _month_name(f"month({ts})")
    return f"""CASE {k} % 10
      WHEN 0 THEN {y} || '-' || {mm} || '-' || {dd}
      WHEN 1 THEN {d} || '/' || {m} || '/' || {y}
      WHEN 2 THEN {y} || '/' || {m} || '/' || {d}
      WHEN 3 THEN {d} || '-' || {m} || '-' || {y}
      WHEN 4 THEN {d} || ' de ' || {mon} || ' de ' || {y}
      WHEN 5 THEN '  ' || {d} || ' de ' || upper({mon}) || ' de ' || {y} || ' '
      WHEN 6 THEN '31 de febrero de ' || {y}
      WHEN 7 THEN {d} || ' de setiembre de ' || {y}
      WHEN 8 THEN ' ' || {y} || '-' || {mm} || '-' || {dd}
      ELSE NULL END"""


def amount_text(k: str, cents: str) -> str:
    """Amount text by k % 9 from integer cents (FIXTURES §3.1)."""
    w = _s(f"CAST(floor({cents} / 100) AS BIGINT)")
    ff = f"lpad({_s(f'{cents} % 100')}, 2, '0')"
    return f"""CASE {k} % 9
      WHEN 0 THEN {w} || '.' || {ff}
      WHEN 1 THEN {w} || ',' || {ff}
      WHEN 2 THEN 'UF ' || {w} || ',' || {ff}
      WHEN 3 THEN '-' || {w} || '.' || {ff}
      WHEN 4 THEN '1.234.567'
      WHEN 5 THEN ''
      WHEN 6 THEN 'N/A'
      WHEN 7 THEN CASE WHEN {k} % 2 = 0 THEN '0.0125' ELSE '99999999999999999' END
      ELSE NULL END"""


def date_amount_sql(dialect: str, sf_dir: str | None = None) -> str:
    t = refs(dialect, sf_dir)
    return f"""SELECT o_orderkey AS k,
      {date_text('o_orderkey', 'o_orderdate')} AS date_text,
      {amount_text('o_orderkey', 'CAST(floor(o_totalprice * 100) AS BIGINT)')} AS amount_text
    FROM {t['orders']}"""


def blob_events_sql(dialect: str, sf_dir: str | None = None) -> str:
    """Blob events from ``events`` (FIXTURES §3.2), with re-delivered duplicates."""
    t = refs(dialect, sf_dir)
    e = "event_id"
    file_ = f"""CASE {e} % 6
        WHEN 0 THEN 'my pdf notes.docx'
        WHEN 1 THEN 'C' || {_s(e)} || '.PDF'
        WHEN 2 THEN 'c' || {_s(e)} || '.pdf'
        WHEN 3 THEN 'c' || {_s(e)} || '.json'
        WHEN 4 THEN 'pdf-c' || {_s(e)} || '.pdf.json'
        ELSE 'c%20' || {_s(e)} || '.pdf' END"""
    container = f"CASE WHEN {e} % 17 = 0 THEN 'processed-events' ELSE 'docs' END"
    path = (f"CASE WHEN {e} % 19 = 0 THEN '' ELSE "
            f"(CASE WHEN {e} % 2 = 0 THEN 'in/2024/' ELSE '' END) || {file_} END")
    base = f"""SELECT 'e' || lpad({_s(e)}, 12, '0') AS event_id,
        CASE WHEN event_type = 'error' THEN 'Microsoft.Storage.BlobDeleted'
             ELSE 'Microsoft.Storage.BlobCreated' END AS event_type,
        '/blobServices/default/containers/' || {container} || '/blobs/' || {path} AS subject,
        CASE WHEN {e} % 23 = 0 THEN NULL
             ELSE 'https://acct' || {_s(f'user_id % 3')} || '.blob.core.windows.net/' || {container}
                  || CASE WHEN {e} % 19 = 0 THEN '' ELSE '/' || {path} END
                  || CASE WHEN {e} % 7 = 0 THEN '?sv=1#x' ELSE '' END END AS url,
        ts AS event_time
      FROM {t['events']}"""
    dup = f"""SELECT event_id, event_type, subject, url, event_time + INTERVAL 1 MINUTE AS event_time
      FROM ({base}) b WHERE CAST(substring(event_id, 2, 12) AS BIGINT) % 10 = 0"""
    return f"{base}\nUNION ALL\n{dup}"


def markers_sql(dialect: str, sf_dir: str | None = None) -> str:
    """Seed marker table: events already processed (event_id % 11 = 0)."""
    t = refs(dialect, sf_dir)
    return f"""SELECT 'e' || lpad({_s('event_id')}, 12, '0') AS event_id,
        CAST(TIMESTAMP '2025-12-31 00:00:00' AS TIMESTAMP) AS marked_at
      FROM {t['events']} WHERE event_id % 11 = 0"""


def payload_sql(dialect: str, sf_dir: str | None = None) -> str:
    """Extractor payloads from orders ⋈ customer, fines / entities from lineitem ⋈ part (§3.3)."""
    t = refs(dialect, sf_dir)
    n = _s("l_partkey % 100")
    tipo = (f"CASE WHEN l_partkey % 10 = 0 THEN '  ' WHEN l_partkey % 7 = 0 "
            f"THEN ' Retraso ' || l_returnflag || ' ' ELSE 'Incumplimiento ' || l_returnflag || l_linestatus END")
    amt = f"""CASE l_suppkey % 14 WHEN 0 THEN 'null' WHEN 1 THEN '"UF ' || {n} || ',5"'
        WHEN 2 THEN '"null"' WHEN 3 THEN '"entre ' || {n} || ' y 10"' WHEN 4 THEN '0' WHEN 5 THEN '"' || {n} || '."'
        WHEN 6 THEN '"0.0125"' WHEN 7 THEN '99999999999999999' WHEN 8 THEN '1e7' WHEN 9 THEN '0.0125'
        WHEN 10 THEN '"123456789012345678901234567890"' WHEN 11 THEN '-3.5' WHEN 12 THEN '"1.2.3"'
        ELSE '"0.00000000000000001"' END"""
    akey = ("CASE l_partkey % 3 WHEN 0 THEN 'monto_multa_uf' WHEN 1 THEN 'Monto de la multa en UF' "
            "ELSE 'Monto de la Multa en UF' END")
    impl = f"'Implica ' || {_s('l_linenumber')}"
    plazo = f"{_s('l_linenumber * 5')} || ' dias'"
    descr = f"'Multa ' || {_s('l_orderkey')} || '-' || {_s('l_linenumber')}"
    fine = f"""CASE l_linenumber % 4
      WHEN 0 THEN '{{"tipo_incumplimiento":"' || {tipo} || '","implicancias":"' || {impl} || '","' || {akey} || '":' || {amt}
        || ',"plazo_constancia":"' || {plazo} || '","descripcion_completa":"' || {descr} || '"}}'
      WHEN 1 THEN '{{"Tipo de incumplimiento":"' || {tipo} || '","Implicancias":"' || {impl} || '","' || {akey} || '":' || {amt}
        || ',"Plazo para la constancia":"' || {plazo} || '","Descripción completa":"' || {descr} || '"}}'
      WHEN 2 THEN '{{"tipo de incumplimiento":"' || {tipo} || '","implicancias":null,"' || {akey} || '":' || {amt}
        || ',"plazo para la constancia":"' || {plazo} || '","Descripción Completa":"' || {descr} || '"}}'
      ELSE CASE WHEN l_partkey % 2 = 0
        THEN '{{"Tipo de incumplimiento":"Previo","tipo_incumplimiento":"' || {tipo} || '","' || {akey} || '":' || {amt}
          || ',"Nota Extra":"x"}}'
        ELSE '{{"tipo_incumplimiento":"' || {tipo} || '","Tipo de incumplimiento":"Posterior","' || {akey} || '":' || {amt}
          || '}}' END END"""
    pt, pn = "coalesce(p_type, '')", "coalesce(p_name, '')"
    ent = f"""CASE WHEN l_partkey % 11 = 0 THEN '{{"tipo":" ","valor":""}}'
      ELSE CASE l_partkey % 4
        WHEN 0 THEN '{{"tipo":"' || {pt} || '","valor":"' || {pn} || '"}}'
        WHEN 1 THEN '{{"Tipo_entidad":"' || {pt} || '","nombre":"' || {pn} || '"}}'
        WHEN 2 THEN '{{"tipo_entidad":"' || {pt} || '","Valor":"' || {pn} || '"}}'
        ELSE '{{"tipo entidad":"' || {pt} || '","Nombre":"' || {pn} || '"}}' END END"""
    order = "l_linenumber, l_partkey, l_suppkey"
    k = "o_orderkey"
    ks = _s(k)
    # Contrato
    fi = date_text(k, "o_orderdate")
    y1 = _s("year(o_orderdate) + 1")
    mm, dd = f"lpad({_s('month(o_orderdate)')}, 2, '0')", f"lpad({_s('day(o_orderdate)')}, 2, '0')"
    cents = "CAST(floor(o_totalprice * 100) AS BIGINT)"
    whole = _s(f"CAST(floor({cents} / 100) AS BIGINT)")
    contrato = f"""'{{' || CASE WHEN {k} % 17 = 0 THEN '' ELSE '"tipo_contrato":"' || o_orderpriority || '",' END
      || '"numero_contrato":"N-' || {ks} || '","tipo_servicio":'
      || CASE WHEN {k} % 19 = 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END
      || ',"parte_cliente":"' || c_name || '","parte_proveedor":"Proveedor ' || {_s(f'{k} % 100')} || '",'
      || CASE WHEN {k} % 11 = 0 THEN '' ELSE '"fecha_inicio":'
           || CASE WHEN {k} % 89 = 0 THEN '20240101' ELSE coalesce('"' || ({fi}) || '"', 'null') END || ',' END
      || CASE {k} % 3 WHEN 0 THEN '' WHEN 1 THEN '"fecha_termino":"' || {y1} || '-' || {mm} || '-' || {dd} || '",'
           ELSE '"fecha_termino":"",' END
      || CASE WHEN {k} % 7 = 0 THEN '' ELSE '"renovacion_automatica":'
           || CASE WHEN {k} % 2 = 0 THEN 'true' ELSE 'false' END || ',' END
      || '"monto_total":' || CASE WHEN {k} % 5 = 0 THEN 'null' WHEN {k} % 9 = 0 THEN {whole}
           ELSE coalesce('"' || ({amount_text(k, cents)}) || '"', 'null') END
      || ',"multa_monto":0,"multa_penalidades":"ver anexo","termino_anticipado_activo":'
      || CASE WHEN {k} % 4 = 0 THEN 'true' ELSE 'false' END || ','
      || CASE WHEN {k} % 8 = 1 THEN '' WHEN {k} % 107 = 0 THEN '"termino_anticipado_plazo_dias":"treinta",'
           ELSE '"termino_anticipado_plazo_dias":' || {_s(f'{k} % 90')} || ',' END
      || '"exclusividad_activo":' || CASE WHEN {k} % 103 = 0 THEN '"quiza"' WHEN {k} % 6 = 0 THEN 'true' ELSE 'false' END
      || ',"exclusividad_detalles":"' || CASE WHEN {k} % 6 = 0 THEN 'Exclusivo' ELSE '' END
      || '","descripcion":"Pedido ' || o_orderstatus || '","nombre":"Contrato ' || {ks} || '"}}'"""
    contrato_sec = (f"CASE WHEN {k} % 47 = 0 THEN '{{}}' WHEN {k} % 53 = 0 THEN '[' || {contrato} || ']' "
                    f"ELSE {contrato} END")
    rut = (f"{_s('c_custkey')} || '-' || {_s('c_custkey % 10')} || "
           f"CASE WHEN {k} % 97 = 0 THEN '-0000000000000000000000' ELSE '' END")
    dom = f"'Calle ' || {_s('c_nationkey')}"
    cobj = f"""CASE {k} % 3
      WHEN 0 THEN '{{"Nombre":"' || c_name || '","RUT":"' || {rut} || '","Domicilio":"' || {dom} || '"}}'
      WHEN 1 THEN '{{"nombre":"' || c_name || '","rut":"' || {rut} || '","domicilio":"' || {dom} || '"}}'
      ELSE '{{"nombre":"' || c_name || '","RUT":"' || {rut} || '","Telefono":"' || {_s(f'{k} % 1000')} || '"}}' END"""
    company = f"CASE WHEN {k} % 29 = 0 THEN 'null' WHEN {k} % 79 = 0 THEN '[' || {cobj} || ']' ELSE {cobj} END"

    def pv(i: int) -> str:
        return (f"'{{\"Nombre\":\"Proveedor ' || {_s(f'{k} % 100')} || '-{i}\",\"RUT\":\"7' || "
                f"{_s(f'{k} % 1000')} || '-{i}\",\"Domicilio\":\"Av {i}\"}}'")
    providers = (f"CASE WHEN {k} % 31 = 0 THEN '[]' WHEN {k} % 5 = 2 THEN {pv(1)} "
                 f"ELSE '[' || {pv(1)} || ',' || {pv(2)} || ']' END")
    nk = f"CASE {k} % 4 WHEN 0 THEN 'Nombre' WHEN 1 THEN 'nombre' WHEN 2 THEN 'Nombre' ELSE 'nombre' END"
    ik = (f"CASE {k} % 4 WHEN 0 THEN 'Cédula de Identidad' WHEN 1 THEN 'cedula_identidad' "
          f"WHEN 2 THEN 'cedula identidad' ELSE 'Cédula de identidad' END")
    n1 = (f"CASE WHEN {k} % 41 = 0 THEN 'null' WHEN {k} % 8 = 3 THEN '\" ' || c_name || chr(92) || 't\"' "
          f"ELSE '\"' || c_name || '\"' END")
    id1 = f"{_s('c_custkey')} || '-K'"
    id2 = f"CASE WHEN {k} % 6 = 0 THEN {id1} ELSE {ks} || '-R' END"
    rep1 = f"'{{\"' || {nk} || '\":' || {n1} || ',\"' || {ik} || '\":\"' || {id1} || '\"}}'"
    rep2 = (f"'{{\"' || {nk} || '\":\"Rep ' || {_s(f'{k} % 1000')} || '\",\"' || {ik} || '\":\"' "
            f"|| {id2} || '\"}}'")
    reps = (f"CASE WHEN {k} % 43 = 0 THEN 'null' WHEN {k} % 67 = 0 THEN '\"ninguno\"' "
            f"ELSE '[' || {rep1} || ',' || {rep2} || ']' END")
    multas = (f"CASE WHEN {k} % 37 = 0 THEN 'null' WHEN {k} % 59 = 0 THEN '\"sin multas\"' "
              f"ELSE '[' || coalesce(fa.fines, '') || CASE WHEN {k} % 4 = 0 THEN "
              f"(CASE WHEN fa.fines IS NULL THEN '' ELSE ',' END) || '\"x\"' ELSE '' END || ']' END")
    ents = (f"CASE WHEN {k} % 61 = 0 THEN 'null' "
            f"WHEN {k} % 23 = 0 THEN '{{\"Tipo\":\"Cliente\",\"Valor\":\"' || c_name || '\"}}' "
            f"ELSE '[' || coalesce(fa.ents, '') || ']' END")
    full = (f"'{{\"Contrato\":' || {contrato_sec} || ',\"Multas\":' || {multas} || ',\"CompaniaInfo\":' || "
            f"{company} || ',\"ProveedoresInfo\":' || {providers} || ',\"Representantes\":' || {reps} || "
            f"',\"Entidades\":' || {ents} || '}}'")
    return f"""SELECT event_id, doc_key,
        CASE WHEN doc_key % 101 = 0 THEN NULL
          ELSE CASE doc_key % 13
            WHEN 0 THEN substring(full_json, 1, 40) WHEN 1 THEN '[]' WHEN 2 THEN '[' || full_json || ']'
            WHEN 3 THEN 'null' WHEN 4 THEN '3' WHEN 5 THEN '{{}}' WHEN 6 THEN '["x",' || full_json || ']'
            WHEN 7 THEN '```json' || full_json || '```' ELSE full_json END END AS payload
      FROM (
        SELECT 'c' || lpad({ks}, 12, '0') AS event_id, {k} AS doc_key, {full} AS full_json
        FROM {t['orders']} o
        JOIN {t['customer']} c ON o.o_custkey = c.c_custkey
        LEFT JOIN (
          SELECT l_orderkey AS fk, {ordered_concat(dialect, fine, order)} AS fines,
                 {ordered_concat(dialect, ent, order)} AS ents
          FROM {t['lineitem']} l LEFT JOIN {t['part']} p ON l.l_partkey = p.p_partkey
          GROUP BY l_orderkey) fa ON fa.fk = o.o_orderkey
      ) d"""


def event_payloads_sql(dialect: str, sf_dir: str | None = None) -> str:
    """Payload rows of the blob events: event e's is that of document e. Every 29th has none, every 31st only an empty
    row beside it, every 37th an empty row alone, every 41st its payload twice."""
    id_ = f"'e' || lpad({_s('doc_key')}, 12, '0')"
    rows = f"SELECT {id_} AS event_id, doc_key, payload FROM ({payload_sql(dialect, sf_dir)}) p WHERE doc_key % 29 <> 0"
    return f"""SELECT event_id, CASE WHEN doc_key % 37 = 0 THEN NULL ELSE payload END AS payload FROM ({rows}) a
      UNION ALL SELECT event_id, NULL AS payload FROM ({rows}) b WHERE doc_key % 31 = 0
      UNION ALL SELECT event_id, payload FROM ({rows}) c WHERE doc_key % 41 = 0 AND doc_key % 37 <> 0"""


def page_lines_sql(dialect: str, sf_dir: str | None = None) -> str:
    """Document text as page lines (§3.4): split on newline, 5 lines per page, numbered from 1."""
    t = refs(dialect, sf_dir)
    if dialect == "spark":
        exploded = (f"SELECT doc_id, pos, line FROM {t['documents']} "
                    f"LATERAL VIEW posexplode(split(text, '\\n')) x AS pos, line")
    else:
        exploded = (f"SELECT doc_id, unnest(range(len(arr))) AS pos, unnest(arr) AS line "
                    f"FROM (SELECT doc_id, string_split(text, chr(10)) AS arr FROM {t['documents']})")
    return f"""SELECT doc_id, CAST(floor(pos / 5) AS INT) + 1 AS page_no, CAST(pos % 5 AS INT) + 1 AS line_no, line
      FROM ({exploded}) e"""


LABELS = ["Tipo de contrato", "Fecha de inicio", "Monto total", "Plazo de termino anticipado"]


def labeled_lines_sql(dialect: str, sf_dir: str | None = None) -> str:
    """Page lines with ``Label: value`` lines in front (§3.4, extractor input): for document d the
    order d (o_orderkey = doc_id) gives contract type, start date (§3.1 forms), amount and
    early-termination days; labels sit on page 0, lines 1-4, before the document's own lines."""
    t = refs(dialect, sf_dir)
    k = "o_orderkey"
    vals = [
        f"'Tipo de contrato: ' || o_orderpriority",
        f"'Fecha de inicio: ' || coalesce({date_text(k, 'o_orderdate')}, '')",
        f"'Monto total: ' || coalesce({amount_text(k, 'CAST(floor(o_totalprice * 100) AS BIGINT)')}, '')",
        f"'Plazo de termino anticipado: ' || {_s(f'{k} % 90')} || ' dias'",
    ]
    labels = " UNION ALL ".join(
        f"SELECT d.doc_id, 0 AS page_no, {i + 1} AS line_no, {v} AS line "
        f"FROM (SELECT DISTINCT doc_id FROM {t['documents']}) d JOIN {t['orders']} o ON o.o_orderkey = d.doc_id"
        for i, v in enumerate(vals))
    return f"SELECT doc_id, page_no, line_no, line FROM ({page_lines_sql(dialect, sf_dir)}) pl UNION ALL {labels}"


#: Pages of a contract document come before its prose; fines and entities start at their own page numbers.
FINE_PAGES, ENTITY_PAGES, PROSE_PAGES = 10, 1000, 5000


def contract_lines_sql(dialect: str, sf_dir: str | None = None) -> str:
    """Contract documents as page lines (§3.4, extractor input): one for each order (doc_id = o_orderkey), with headings and
    ``Label: value`` lines: page 1 the contract, page 2 the parties, a page for each lineitem as a fine and as an entity;
    the lines of the document of that id follow as prose."""
    t = refs(dialect, sf_dir)
    k, nl = "o_orderkey", "chr(10)"
    y1 = _s("year(o_orderdate) + 1")
    mm, dd = f"lpad({_s('month(o_orderdate)')}, 2, '0')", f"lpad({_s('day(o_orderdate)')}, 2, '0')"

    def flag(m: int) -> str:
        return f"CASE WHEN {k} % {m} = 0 THEN 'Sí' ELSE 'no' END"
    contract = [
        "'CONTRATO'",
        f"CASE WHEN {k} % 17 = 0 THEN 'sin tipo' ELSE 'Tipo de contrato: ' || o_orderpriority END",
        "'Tipo de servicio : ' || c_mktsegment", "'  PARTE CLIENTE:' || c_name || '  '", f"'Parte proveedor: Proveedor ' || {_s(f'{k} % 100')}",
        f"CASE WHEN {k} % 11 = 0 THEN '' ELSE 'Fecha de inicio: ' || coalesce({date_text(k, 'o_orderdate')}, '') END",
        f"CASE WHEN {k} % 3 = 0 THEN '' ELSE 'Fecha de termino: ' || {y1} || '-' || {mm} || '-' || {dd} END",
        f"'Renovacion automatica: ' || {flag(2)}",
        f"'Monto total: ' || coalesce({amount_text(k, 'CAST(floor(o_totalprice * 100) AS BIGINT)')}, '')",
        f"'Termino anticipado: ' || {flag(4)}", f"'Plazo de termino anticipado: ' || {_s(f'{k} % 90')} || CASE WHEN {k} % 7 = 0 THEN '' ELSE ' dias' END",
        f"'Exclusividad: ' || CASE WHEN {k} % 103 = 0 THEN 'quiza' ELSE {flag(6)} END", "'Detalles de exclusividad:'",
        "'Descripcion: Pedido \"' || o_orderstatus || '\": todo'", f"'Nombre del contrato: Contrato ' || {_s(k)}", "'Tipo de contrato: repetido'"]
    rut = f"{_s('c_custkey')} || '-' || {_s('c_custkey % 10')}"
    parties = [
        f"CASE WHEN {k} % 29 = 0 THEN 'Empresa' ELSE 'COMPAÑIA' END", "'Nombre: ' || c_name", f"'RUT: ' || {rut}", f"'Domicilio: Calle ' || {_s('c_nationkey')}", "''",
        "'Proveedor 1'", f"'nombre: Proveedor ' || {_s(f'{k} % 100')} || '-1'", f"'RUT: 7' || {_s(f'{k} % 1000')} || '-1'", "'PROVEEDOR 2'", "'Nombre: otro'",
        "'REPRESENTANTE'", "'Nombre: ' || c_name", f"'cedula identidad: ' || {_s('c_custkey')} || '-K'",
        "'Representante'", f"'Nombre: Rep ' || {_s(f'{k} % 1000')}", f"'Cédula de identidad: ' || {_s(k)} || '-R'"]
    fine = [f"'MULTA ' || {_s('seq')}", "'Tipo de incumplimiento: ' || CASE WHEN l_partkey % 10 = 0 THEN '' ELSE 'Retraso ' || l_returnflag END",
            f"'Implicancias: Implica ' || {_s('l_linenumber')}",
            f"'Monto de la multa en UF: UF ' || {_s('l_partkey % 100')} || ',5'", f"'Plazo para la constancia: ' || {_s('l_linenumber * 5')} || ' dias'",
            f"'Descripción completa: Multa ' || {_s('l_orderkey')}"]
    entity = ["'ENTIDAD'", "'Tipo: ' || coalesce(p_type, '')", "'Nombre: ' || coalesce(p_name, '')", "'Otro dato: x'"]

    def page(parts: list[str]) -> str:
        return f" || {nl} || ".join(f"({x})" for x in parts)
    items = f"""(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS seq
      FROM {t['lineitem']} l LEFT JOIN {t['part']} p ON l.l_partkey = p.p_partkey WHERE l_orderkey IN (SELECT o_orderkey FROM {t['orders']}))"""
    if dialect == "spark":
        # Both pages of a row come from one pass over the joins; a page without text has no lines. Pages are dealt out by document and split
        # behind that, so that what reads a document's lines together doesn't shuffle them one by one.
        def pair(first: str, second: str) -> str:
            return f"LATERAL VIEW inline(array(named_struct('page_no', {first}, 'text', t1), named_struct('page_no', {second}, 'text', t2))) x AS page_no, text"
        pages = f"""SELECT doc_id, page_no, text, false AS prose FROM (
            SELECT {k} AS doc_id, {page(contract)} AS t1, {page(parties)} AS t2 FROM {t['orders']} o JOIN {t['customer']} c ON o.o_custkey = c.c_custkey) q {pair('1', '2')}
          UNION ALL SELECT doc_id, page_no, text, false AS prose FROM (
            SELECT l_orderkey AS doc_id, CAST(seq AS INT) AS seq, {page(fine)} AS t1, CASE WHEN l_partkey % 2 = 0 THEN {page(entity)} END AS t2 FROM {items} i) q {pair(f'seq + {FINE_PAGES}', f'seq + {ENTITY_PAGES}')}
          UNION ALL SELECT doc_id, CAST({PROSE_PAGES} AS INT) AS page_no, text, true AS prose FROM {t['documents']}"""
        return f"""SELECT doc_id, CASE WHEN prose THEN page_no + CAST(floor(pos / 5) AS INT) + 1 ELSE page_no END AS page_no, CASE WHEN prose THEN CAST(pos % 5 AS INT) ELSE CAST(pos AS INT) END + 1 AS line_no, line
          FROM (SELECT /*+ REPARTITION(doc_id) */ doc_id, page_no, text, prose FROM ({pages}) u) p LATERAL VIEW posexplode(split(text, '\n')) y AS pos, line"""
    pages = " UNION ALL ".join([
        f"SELECT {k} AS doc_id, 1 AS page_no, {page(contract)} AS text FROM {t['orders']} o JOIN {t['customer']} c ON o.o_custkey = c.c_custkey",
        f"SELECT {k} AS doc_id, 2 AS page_no, {page(parties)} AS text FROM {t['orders']} o JOIN {t['customer']} c ON o.o_custkey = c.c_custkey",
        f"SELECT l_orderkey AS doc_id, CAST(seq AS INT) + {FINE_PAGES} AS page_no, {page(fine)} AS text FROM {items} i",
        f"SELECT l_orderkey AS doc_id, CAST(seq AS INT) + {ENTITY_PAGES} AS page_no, {page(entity)} AS text FROM {items} i WHERE l_partkey % 2 = 0"])
    lines = f"SELECT doc_id, page_no, unnest(range(len(arr))) AS pos, unnest(arr) AS line FROM (SELECT doc_id, page_no, string_split(text, chr(10)) AS arr FROM ({pages}) p)"
    return f"""SELECT doc_id, page_no, CAST(pos AS INT) + 1 AS line_no, line FROM ({lines}) e
      UNION ALL SELECT doc_id, page_no + {PROSE_PAGES} AS page_no, line_no, line FROM ({page_lines_sql(dialect, sf_dir)}) d"""


def event_lines_sql(dialect: str, sf_dir: str | None = None) -> str:
    """Blob events as the lines of JSON files; every 13th is cut off, every 17th has a time that is none."""
    t = refs(dialect, sf_dir)
    e = "event_id"
    at = (f"{_s('year(ts)')} || '-' || lpad({_s('month(ts)')}, 2, '0') || '-' || lpad({_s('day(ts)')}, 2, '0') || 'T' || "
          f"lpad({_s('hour(ts)')}, 2, '0') || ':' || lpad({_s('minute(ts)')}, 2, '0') || ':00'")
    whole = f"""'{{"event_id":"e' || {_s(e)} || '","event_type":"' || event_type || '","subject":"a ' || chr(92) || '"quoted' || chr(92) || '" ' || {_s('user_id')} || '","url":'
      || CASE WHEN {e} % 7 = 0 THEN 'null' ELSE '"https://acct.blob.core.windows.net/docs/c' || {_s(e)} || '.pdf"' END
      || ',"event_time":"' || CASE WHEN {e} % 17 = 0 THEN 'ayer' ELSE {at} END || '","extra":[1]}}'"""
    return f"SELECT CASE WHEN {e} % 13 = 0 THEN substring(line, 1, 30) ELSE line END AS line FROM (SELECT event_id, {whole} AS line FROM {t['events']}) x"


def entity_maps_sql(dialect: str, sf_dir: str | None = None) -> str:
    """Entities as an object of objects: for each order one JSON object with a key for each lineitem, in no sorted order, whose values
    are entities under several key names, or no objects."""
    t = refs(dialect, sf_dir)
    key = f"'k' || {_s('9 - l_linenumber')} || '-' || {_s('l_partkey')} || '-' || {_s('l_suppkey')}"
    value = f"""CASE l_partkey % 6 WHEN 0 THEN '{{"tipo":"T' || {_s('l_linenumber')} || '","valor":"V"}}'
      WHEN 1 THEN '{{"Tipo_entidad":"U","nombre":"' || {_s('l_suppkey')} || '"}}' WHEN 2 THEN '"text"' WHEN 3 THEN '[{{"tipo":"in a list"}}]'
      WHEN 4 THEN 'null' ELSE '{{"valor":"old","Valor":"' || l_returnflag || '"}}' END"""
    entry = f"'\"' || {key} || '\":' || {value}"
    return f"""SELECT l_orderkey AS doc_key, CASE WHEN l_orderkey % 19 = 0 THEN '[1]' ELSE '{{' || {ordered_concat(dialect, entry, 'l_linenumber DESC, l_suppkey, l_partkey')} || '}}' END AS entidades
      FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM {t['lineitem']}) l GROUP BY l_orderkey"""


def metadata_sql(dialect: str, sf_dir: str | None = None) -> str:
    """Metadata objects of the contract documents, one for each order; fields missing, null or of another type in some."""
    t = refs(dialect, sf_dir)
    k = "o_orderkey"
    ks = _s(k)
    return f"""SELECT {k} AS doc_key, CASE WHEN {k} % 23 = 0 THEN '[]' ELSE
        '{{"nombre_documento":"contrato ' || {_s(f'{k} % 700')} || '.pdf"'
        || CASE WHEN {k} % 3 = 0 THEN '' ELSE ',"numero_pagina":' || {_s(f'{k} % 40')} END
        || ',"anexos_incluidos":' || CASE WHEN {k} % 5 = 0 THEN 'null' ELSE '"Anexo ' || {_s(f'{k} % 4')} || '"' END
        || ',"referencia_interna":' || CASE WHEN {k} % 7 = 0 THEN {ks} ELSE '"REF-' || {_s(f'{k} % 300')} || '"' END || ',"otro":true}}' END AS metadata
      FROM {t['orders']}"""


def file_catalogue_sql(dialect: str, sf_dir: str | None = None) -> str:
    """A2 listing: every blob event's path placed under ``{yyyy-MM-dd}/`` of its event day."""
    t = refs(dialect, sf_dir)
    e = "event_id"
    day = (f"{_s(f'year(ts)')} || '-' || lpad({_s('month(ts)')}, 2, '0') || '-' || "
           f"lpad({_s('day(ts)')}, 2, '0')")
    return f"""SELECT CASE WHEN {e} % 3 = 0 THEN 'in/' ELSE '' END || {day} || '/c' || {_s(f'{e} % 500')} || '.pdf'
        AS blob_path, ts AS listed_at FROM {t['events']}"""


# ---------------------------------------------------------------------------
# Spark builders
# ---------------------------------------------------------------------------

def date_amount_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(date_amount_sql("spark", sf_dir))


def blob_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(blob_events_sql("spark", sf_dir))


def markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(markers_sql("spark", sf_dir))


def payload_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(payload_sql("spark", sf_dir))


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(event_payloads_sql("spark", sf_dir))


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(page_lines_sql("spark", sf_dir))


def labeled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(labeled_lines_sql("spark", sf_dir))


def contract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(contract_lines_sql("spark", sf_dir))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(event_lines_sql("spark", sf_dir))


def entity_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(entity_maps_sql("spark", sf_dir))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(metadata_sql("spark", sf_dir))


def file_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(file_catalogue_sql("spark", sf_dir))

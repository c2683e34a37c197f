"""Key canonicalization of loosely named JSON objects.

A section element arrives as an ordered ``MAP<STRING, VARIANT>`` (document key order is
kept by ``from_json``). Each raw key maps to a canonical name through a literal alias map,
else through a fallback rule; when several raw keys land on one canonical name the last
one in document order wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results:
# raw key -> canonical key, per record type, in the reference's order.
# ---------------------------------------------------------------------------
FINE_ALIASES = {
    "Tipo de incumplimiento": "tipo_incumplimiento",
    "tipo de incumplimiento": "tipo_incumplimiento",
    "tipo_incumplimiento": "tipo_incumplimiento",
    "Implicancias": "implicancias",
    "implicancias": "implicancias",
    "Monto de la multa en UF": "monto_multa_uf",
    "monto de la multa en uf": "monto_multa_uf",
    "monto_multa_uf": "monto_multa_uf",
    "Plazo para la constancia": "plazo_constancia",
    "plazo para la constancia": "plazo_constancia",
    "plazo_constancia": "plazo_constancia",
    "Descripción completa": "descripcion_completa",
    "descripción completa": "descripcion_completa",
    "descripcion_completa": "descripcion_completa",
}
REP_ALIASES = {
    "Nombre": "nombre",
    "nombre": "nombre",
    "Cédula de Identidad": "cedula_identidad",
    "cedula de identidad": "cedula_identidad",
    "cedula_identidad": "cedula_identidad",
    "Cedula de Identidad": "cedula_identidad",
    "cedula identidad": "cedula_identidad",
}
COMPANY_ALIASES = {
    "Nombre": "nombre",
    "nombre": "nombre",
    "RUT": "rut",
    "rut": "rut",
    "Domicilio": "domicilio",
    "domicilio": "domicilio",
}
ENTITY_ALIASES = {
    "tipo": "tipo",
    "Tipo": "tipo",
    "tipo_entidad": "tipo",
    "Tipo_entidad": "tipo",
    "valor": "valor",
    "Valor": "valor",
    "nombre": "valor",
    "Nombre": "valor",
}
# ---------------------------------------------------------------------------

# Fallback rule per record type: lower case, blanks -> '_' (entities: lower case only).
_UNDERSCORE = {"fine": True, "rep": True, "company": True, "entity": False}
ALIASES = {"fine": FINE_ALIASES, "rep": REP_ALIASES, "company": COMPANY_ALIASES,
           "entity": ENTITY_ALIASES}


def literal_map(names: dict) -> Column:
    """A constant map, written as SQL: one expression to hand over in place of one for each key and value."""
    def text(x) -> str:
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(x, str) else str(x)

    return F.expr("map(" + ", ".join(f"{text(k)}, {text(v)}" for k, v in names.items()) + ")")


def canon_key(kind: str, key: Column) -> Column:
    """Canonical name of one raw key."""
    low = F.lower(key)
    fallback = F.replace(low, F.lit(" "), F.lit("_")) if _UNDERSCORE[kind] else low
    return F.coalesce(F.try_element_at(literal_map(ALIASES[kind]), key), fallback)


def canon_entries(kind: str, m: Column) -> Column:
    """Ordered ``ARRAY<STRUCT<key, value, raw>>`` with canonical keys (keeps document order)."""
    return F.transform(F.map_entries(m), lambda e: F.struct(
        canon_key(kind, e["key"]).alias("key"), e["value"].alias("value"), e["key"].alias("raw")))


def field(entries: Column, name: str) -> Column:
    """Value of canonical field ``name``: last matching entry wins (G4); SQL NULL if absent."""
    return F.try_element_at(F.filter(entries, lambda e: e["key"] == F.lit(name)), F.lit(-1))["value"]


def has_field(entries: Column, name: str) -> Column:
    return F.exists(entries, lambda e: e["key"] == F.lit(name))


def unmapped_keys(entries: Column, known: list[str]) -> Column:
    """Raw keys whose canonical name no record reads (T6 side column)."""
    return F.filter(entries, lambda e: ~e["key"].isin(known))["raw"]

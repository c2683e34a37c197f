"""Scalar Column -> Column functions.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
Inputs that may be typed JSON values arrive as VARIANT; plain text inputs as STRING.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Spanish month names -> month number (reference date normalizer).
SPANISH_MONTHS = {
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6,
    "julio": 7, "agosto": 8, "septiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
}
# Numeric date layouts tried in this order after the Spanish form (Python strptime names).
DATE_LAYOUTS = ["%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d", "%d-%m-%Y"]
# Amount cap and defaults.
DECIMAL_CAP = "9999999999999999.99"
DEFAULT_END_DAYS = 365
DEFAULT_TIPO_CONTRATO = "Contrato General"
DEFAULT_TIPO_SERVICIO = "Servicios Generales"
PREVIEW_CHARS = 500
# ---------------------------------------------------------------------------

# Every processing time comes from one parameter (T14), never from now().
AS_OF = "2026-01-01 00:00:00"

# Characters Python's str.strip() removes (str.isspace), as a Java regex class.
PY_SPACE = r"[\t\n\x0B\f\r \x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"

# The same characters one by one: trimming them looks at the ends of a text only, where a pattern reads all of it.
PY_SPACES = "\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

# Spark layouts equivalent to DATE_LAYOUTS, each guarded by a full-match shape test
# (Python %Y is exactly 4 digits, %m / %d one or two).
_LAYOUTS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
]


def as_of_ts(as_of: str = AS_OF) -> Column:
    """Processing time as TIMESTAMP_NTZ (independent of the session time zone)."""
    return F.to_timestamp_ntz(F.lit(as_of))


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: trims Unicode whitespace, not only blanks (Spark ``trim``)."""
    return F.btrim(c, F.lit(PY_SPACES))


def vtype(v: Column) -> Column:
    """``schema_of_variant``: 'OBJECT<..>', 'ARRAY<..>', 'STRING', 'BOOLEAN', 'VOID' (JSON null),
    a numeric type name otherwise; SQL NULL when the value is absent."""
    return F.schema_of_variant(v)


def is_obj(s: Column) -> Column:
    return s.startswith("OBJECT")


def is_arr(s: Column) -> Column:
    return s.startswith("ARRAY")


def is_num(s: Column) -> Column:
    return F.left(s, F.lit(3)).isin("DEC", "BIG", "INT", "SMA", "TIN", "DOU", "FLO")


def variant_text(v: Column) -> Column:
    """Scalar JSON value as text (string unquoted, number / boolean rendered); NULL for JSON null."""
    return F.try_variant_get(v, "$", "string")


def is_falsy(v: Column, s: Column, txt: Column) -> Column:
    """Python truthiness of a JSON value (v, its vtype s, its text): absent, null, '', 0, false,
    [] and {} are falsy."""
    return (v.isNull() | (s == "VOID")
            | ((s == "STRING") & (txt == ""))
            | ((s == "BOOLEAN") & (txt == "false"))
            | (is_num(s) & (F.try_variant_get(v, "$", "double") == 0))
            | ((s == "ARRAY<VOID>") & F.try_variant_get(v, "$[0]", "variant").isNull())
            | (s == "OBJECT<>"))


def _is_falsy(v: Column) -> Column:
    return is_falsy(v, vtype(v), variant_text(v))


def decimal_from_text(txt: Column) -> Column:
    """D1 text branch: ',' -> '.', keep digits and '.', parse; unparsable -> 0; cap."""
    cleaned = F.regexp_replace(F.replace(txt, F.lit(","), F.lit(".")), r"[^0-9.]", "")
    val = cleaned.try_cast("double")
    return _cap_decimal(F.coalesce(val, F.lit(0.0)))


def _cap_decimal(d: Column) -> Column:
    return (F.when(d >= F.lit(1e16), F.lit(DECIMAL_CAP).cast("decimal(18,2)"))
            .otherwise(d.cast("decimal(18,2)")))


def normalize_decimal(v: Column, s: Column | None = None, txt: Column | None = None) -> Column:
    """D1 ``normalize_decimal`` over a JSON value (VARIANT) -> DECIMAL(18,2), never NULL, >= 0.

    falsy -> 0; text -> ``decimal_from_text``; JSON number -> |value| capped (deviation T7: the
    reference mangles the text form of large / exponent numbers); other types -> 0.
    """
    s = vtype(v) if s is None else s
    txt = variant_text(v) if txt is None else txt
    num = F.abs(F.try_variant_get(v, "$", "double"))
    return (F.when(is_falsy(v, s, txt), F.lit(0).cast("decimal(18,2)"))
            .when(s == "STRING", decimal_from_text(txt))
            .when(is_num(s), _cap_decimal(num))
            .otherwise(F.lit(0).cast("decimal(18,2)")))


def normalize_decimal_text(txt: Column) -> Column:
    """D1 over plain text: NULL / '' -> 0, else the text branch."""
    return (F.when(txt.isNull() | (txt == ""), F.lit(0).cast("decimal(18,2)"))
            .otherwise(decimal_from_text(txt)))


def normalize_date_text(s: Column) -> Column:
    """D2 ``normalize_date`` over text -> DATE or NULL.

    1. trimmed, lower-cased text with exactly three ' de ' parts and a known month:
       day zero-padded to 2, validated; an invalid day gives NULL (no fall-through).
    2. else the untrimmed text against the four numeric layouts, first match wins (H3).
    """
    low = F.lower(py_strip(s))
    parts = F.split(low, " de ")
    n = F.size(parts)
    day = py_strip(F.element_at(parts, 1))
    mon_name = py_strip(F.element_at(parts, 2))
    year = py_strip(F.element_at(parts, 3))
    months = ", ".join(f"'{k}', {m}" for k, m in SPANISH_MONTHS.items())
    mon = F.try_element_at(F.expr(f"map({months})"), mon_name)
    day2 = F.when(F.length(day) < 2, F.lpad(day, 2, "0")).otherwise(day)
    candidate = F.concat_ws("-", year, F.lpad(mon.cast("string"), 2, "0"), day2)
    spanish = F.when(candidate.rlike(r"^\d{4}-\d{2}-\d{1,2}$"),
                     F.try_to_date(candidate, "yyyy-M-d"))
    is_spanish = low.contains(" de ") & (n == 3) & mon.isNotNull()
    numeric = F.coalesce(*[F.when(s.rlike(rx), F.try_to_date(s, fmt)) for rx, fmt in _LAYOUTS])
    return (F.when(s.isNull() | (s == ""), F.lit(None).cast("date"))
            .when(is_spanish, spanish)
            .otherwise(numeric))


def normalize_date(v: Column, s: Column | None = None, txt: Column | None = None) -> Column:
    """D2 over a JSON value: falsy -> NULL, text -> ``normalize_date_text``; other types are a
    contract-level error (see ``date_not_text``) and give NULL here."""
    s = vtype(v) if s is None else s
    txt = variant_text(v) if txt is None else txt
    return (F.when(is_falsy(v, s, txt), F.lit(None).cast("date"))
            .when(s == "STRING", normalize_date_text(txt)))


def date_not_text(v: Column, s: Column | None = None, txt: Column | None = None) -> Column:
    """True when D2 would raise in the reference (truthy non-text date, T9)."""
    s = vtype(v) if s is None else s
    txt = variant_text(v) if txt is None else txt
    return ~is_falsy(v, s, txt) & (s != "STRING")


def iso_date_strict(s: Column) -> Column:
    """Python ``strptime(s, '%Y-%m-%d')``: exactly ISO-shaped text and a valid day, else NULL."""
    return F.when(s.rlike(_LAYOUTS[0][0]), F.try_to_date(s, "yyyy-M-d"))


#: UF amounts: 26 digits before the point and 12 behind it, more than any binary fraction that a JSON number keeps exactly.
UF_TYPE = "decimal(38,12)"


def once(value: Column, use) -> Column:
    """``use`` of a value that is computed once. Inside a lambda Spark doesn't share equal expressions: each mention is computed again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _uf_cleaned(t: Column) -> Column:
    return F.replace(F.regexp_replace(t, r"[^0-9.,]", ""), F.lit(","), F.lit("."))


def _uf_readable(t: Column, cleaned: Column) -> Column:
    # one point at most and a digit: what a float is read from
    return F.when((F.lower(t) != "null") & cleaned.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"), cleaned)


def _uf_digits(txt: Column) -> Column:
    t = py_strip(txt)
    return _uf_readable(t, _uf_cleaned(t))


def parse_uf_amount(txt: Column) -> Column:
    """D3 UF fine amount from text: NULL / blank / 'null' -> NULL; keep digits . , ; ',' -> '.'; parse, every digit
    kept; unparsable -> NULL (not 0). Digits of separate numbers are concatenated (T17). NULL, too, where the type has
    no room for all digits: see ``uf_out_of_range``."""
    digits = _uf_digits(txt)
    return F.when(~_no_room(digits), digits.try_cast(UF_TYPE))


def _no_room(digits: Column) -> Column:
    return ~digits.rlike(r"^0*[0-9]{0,26}(\.[0-9]{0,12}0*)?$")


def uf_out_of_range(txt: Column) -> Column:
    """True for an amount that can be read, but has more digits than the column can keep."""
    return F.coalesce(_no_room(_uf_digits(txt)), F.lit(False))


def uf_amount(v: Column, s: Column, txt: Column) -> Column:
    """D3 over a JSON value (v, its vtype s, its text): numbers by their numeric value without sign (an exponent is
    read, not taken for digits), anything else by its text. A struct (amount, no_room)."""
    double = F.abs(F.try_variant_get(v, "$", "double"))
    exact = double.try_cast(UF_TYPE)
    exponent = is_num(s) & F.contains(F.upper(txt), F.lit("E"))

    def judged(digits: Column) -> Column:
        too_long = _no_room(digits)
        return F.struct(F.when(~too_long, digits.try_cast(UF_TYPE)).alias("amount"), F.coalesce(too_long, F.lit(False)).alias("no_room"))

    by_text = once(py_strip(txt), lambda t: once(_uf_cleaned(t), lambda cleaned: once(_uf_readable(t, cleaned), judged)))
    by_value = F.struct(F.when(exact.cast("double") == double, exact).alias("amount"),
                        F.coalesce(exact.cast("double") != double, F.lit(True)).alias("no_room"))
    return F.when(exponent, by_value).otherwise(by_text)


def safe_string(c: Column) -> Column:
    """NULL or absent -> '', else the text, Python-stripped."""
    return F.coalesce(py_strip(c), F.lit(""))


def default_end_date(start_text: Column) -> Column:
    """Start + 365 days when start is strict ISO text; NULL means the contract is rejected."""
    return F.date_add(iso_date_strict(start_text), DEFAULT_END_DAYS)


def unreadable(v: Column, s: Column, value: Column) -> Column:
    """True when a JSON value is given, not null, and D9 / D10 can't read it: the store would refuse the row."""
    return v.isNotNull() & (s != "VOID") & value.isNull()


def flag_value(v: Column, s: Column | None = None, txt: Column | None = None) -> Column:
    """D9 BIT column from a JSON value: boolean as is, number != 0, text cast, else NULL."""
    s = vtype(v) if s is None else s
    txt = variant_text(v) if txt is None else txt
    return (F.when(s == "BOOLEAN", txt == "true")
            .when(is_num(s), F.try_variant_get(v, "$", "double") != 0)
            .when(s == "STRING", txt.try_cast("boolean")))


def int_value(v: Column, txt: Column | None = None) -> Column:
    """D10 INT column from a JSON value."""
    txt = variant_text(v) if txt is None else txt
    return txt.try_cast("int")


def default_national_id(nombre: Column, role: Column, as_of: str = AS_OF) -> Column:
    """D7 ``DEFAULT-{first two name words joined, max 10 chars}-{role}-{yyyyMMddHHmmss}``."""
    words = F.split(py_strip(nombre), rf"{PY_SPACE}+")
    head = F.left(F.array_join(F.slice(words, 1, 2), ""), F.lit(10))
    return F.concat(F.lit("DEFAULT-"), head, F.lit("-"), role, F.lit("-"),
                    F.date_format(as_of_ts(as_of), "yyyyMMddHHmmss"))


def bounded_preview(c: Column) -> Column:
    """First 500 characters kept for diagnosis."""
    return F.left(c, F.lit(PREVIEW_CHARS))

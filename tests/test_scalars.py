"""D1-D4 and traps T7, T8, T9, T17 on literal rows (expected values read from the reference)."""

from decimal import Decimal

from pyspark.sql import functions as F

from contractlake.functions import scalars as S


def _one(spark, expr, rows, schema="s string"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_normalize_decimal_text(spark):
    rows = [("1234.56",), ("1234,56",), ("UF 12,5",), ("-7.25",), ("1.234.567",), ("",), ("N/A",),
            ("99999999999999999",), (None,), ("50.",), (".",)]
    got = _one(spark, S.normalize_decimal_text(F.col("s")), rows)
    assert got == [Decimal("1234.56"), Decimal("1234.56"), Decimal("12.50"), Decimal("7.25"), Decimal("0.00"),
                   Decimal("0.00"), Decimal("0.00"), Decimal("9999999999999999.99"), Decimal("0.00"),
                   Decimal("50.00"), Decimal("0.00")]


def test_normalize_decimal_json_values(spark):
    rows = [('{"a": 1500}',), ('{"a": -20}',), ('{"a": 0}',), ('{"a": true}',), ('{"a": "3,5"}',), ('{"b": 1}',)]
    v = F.try_variant_get(F.parse_json("s"), "$.a", "variant")
    assert _one(spark, S.normalize_decimal(v), rows) == [Decimal("1500.00"), Decimal("20.00"), Decimal("0.00"),
                                                         Decimal("0.00"), Decimal("3.50"), Decimal("0.00")]


def test_normalize_date(spark):
    rows = [("2024-01-05",), ("2024-1-5",), ("5/1/2024",), ("2024/1/5",), ("5-1-2024",), ("1 de mayo de 2024",),
            ("  5 de MAYO de 2024 ",), ("31 de febrero de 2024",), ("1 de setiembre de 2024",), (" 2024-01-05",),
            ("1 de mayo del 2024",), ("",), (None,), ("24-1-5",)]
    got = [str(x) if x else None for x in _one(spark, S.normalize_date_text(F.col("s")), rows)]
    assert got == ["2024-01-05", "2024-01-05", "2024-01-05", "2024-01-05", "2024-01-05", "2024-05-01",
                   "2024-05-05", None, None, None, None, None, None, None]


def test_parse_uf_amount(spark):
    rows = [("UF 5,5",), ("null",), ("entre 5 y 10",), ("0",), ("7.",), ("   ",), (None,), ("abc",)]
    got = _one(spark, S.parse_uf_amount(F.col("s")), rows)
    assert got == [Decimal("5.50"), None, Decimal("510.00"), Decimal("0.00"), Decimal("7.00"), None, None, None]


def test_uf_amounts_keep_every_digit(spark):
    rows = [("0.0125",), ("99999999999999999",), ("UF 12345678901234567890123456,123456789012",), ("1.2.3",), (".",), (".5",), ("007",),
            ("123456789012345678901234567",), ("0.0000000000001",), ("1.5000000000000000",)]
    assert _one(spark, S.parse_uf_amount(F.col("s")), rows) == [
        Decimal("0.0125"), Decimal("99999999999999999"), Decimal("12345678901234567890123456.123456789012"), None, None, Decimal("0.5"), Decimal("7"), None, None, Decimal("1.5")]
    assert _one(spark, S.uf_out_of_range(F.col("s")), rows) == [False] * 7 + [True, True, False]


def test_uf_amounts_of_json_numbers(spark):
    rows = [('{"a": 0.0125}',), ('{"a": 99999999999999999}',), ('{"a": 1e7}',), ('{"a": -3.5}',), ('{"a": 1e-3}',), ('{"a": 1e300}',), ('{"a": "1e7"}',), ('{"a": null}',), ("{}",), ('{"a": true}',)]
    v = F.try_variant_get(F.parse_json("s"), "$.a", "variant")
    got = _one(spark, S.uf_amount(v, S.vtype(v), S.variant_text(v)), rows)
    assert [r.amount for r in got] == [Decimal("0.0125"), Decimal("99999999999999999"), Decimal("10000000"), Decimal("3.5"), Decimal("0.001"), None, Decimal("17"), None, None, None]
    assert [r.no_room for r in got] == [False] * 5 + [True] + [False] * 4


def test_py_strip_and_safe_string(spark):
    rows = [(" \ta b \n",), (None,), ("x",)]
    assert _one(spark, S.safe_string(F.col("s")), rows) == ["a b", "", "x"]


def test_default_end_date_and_national_id(spark):
    rows = [("2024-01-01", "Juan Perez Soto"), ("5/1/2024", "Ana")]
    df = spark.createDataFrame(rows, "s string, n string")
    out = df.select(S.default_end_date(F.col("s")).cast("string"),
                    S.default_national_id(F.col("n"), F.lit("rep"))).collect()
    assert out[0][0] == "2024-12-31" and out[1][0] is None
    assert out[0][1] == "DEFAULT-JuanPerez-rep-20260101000000"
    assert out[1][1] == "DEFAULT-Ana-rep-20260101000000"

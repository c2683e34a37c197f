"""D3 over elements of an array: Spark shares no expressions inside a lambda, so each step must be written once."""

import contextlib
import io

from pyspark.sql import functions as F

from contractlake.functions import scalars as S


def test_each_step_once(spark):
    values = ['"UF 12,5"', '"null"', '" 7. "', "1e7", "1e30", "-3.5", '"1.2.3"', '"123456789012345678901234567890"', '"0.0000000000001"', "null", "true"]
    df = spark.createDataFrame([(values,)], "texts array<string>").select(F.transform("texts", lambda t: F.try_parse_json(t)).alias("vs"))
    df = df.select(F.transform("vs", lambda v: S.uf_amount(v, S.vtype(v), S.variant_text(v))).alias("uf"))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    assert out.getvalue().lower().count("regexp_replace(") == 1
    got = [(None if u["amount"] is None else str(u["amount"].normalize()), u["no_room"]) for u in df.first()["uf"]]
    assert got == [("12.5", False), (None, False), ("7", False), ("1E+7", False), (None, True), ("3.5", False), (None, False),
                   (None, True), (None, True), (None, False), (None, False)]

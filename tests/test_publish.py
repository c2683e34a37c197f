"""K8: readers see whole versions only, wherever a publication stops."""

import pytest
from pyspark.sql import functions as F

from contractlake.operators import payload as P
from contractlake.operators import star as ST
from contractlake.session import saved

ONE = """{"Contrato": {"tipo_contrato": "%s", "fecha_inicio": "2024-01-01"}, "CompaniaInfo": {"nombre": "n"}, "ProveedoresInfo": [{"nombre": "p"}],
          "Representantes": [], "Multas": [{"tipo_incumplimiento": "x", "monto_multa_uf": 0.0125}], "Entidades": []}"""


def star_of(spark, kind, n):
    rows = spark.range(n).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"), F.lit(ONE % kind).alias("payload"))
    return ST.build_star(saved(P.normalize_payloads(rows.unionByName(spark.createDataFrame([("bad", "{")], "event_id string, payload string"))), "test"))


def test_a_crash_after_any_write_leaves_the_old_version(spark, scratch, monkeypatch):
    with pytest.raises(ValueError):
        ST.read_star(spark, scratch)
    first = ST.publish(star_of(spark, "old", 3), scratch)
    assert first.contrato.count() == 3 and first.rejected.count() == 1
    new = star_of(spark, "new", 5)
    real = ST._write
    for stop in range(8):   # seven tables, then the manifest
        left = [stop]

        def failing(df, path, mode="error"):
            if left[0] == 0:
                raise RuntimeError("lost")
            left[0] -= 1
            real(df, path, mode)
        with monkeypatch.context() as m:
            m.setattr(ST, "_write", failing)
            with pytest.raises(RuntimeError):
                ST.publish(new, scratch)
        seen = ST.read_star(spark, scratch)
        assert {r.tipo_contrato for r in seen.contrato.collect()} == {"old"}
        assert {t: df.count() for t, df in seen.tables().items()} == {t: (0 if t in ("representantes", "entidades") else 3) for t in ST.STAR_TABLES}
    ST.publish(new, scratch)
    assert ST.read_star(spark, scratch).contrato.count() == 5 and ST.read_star(spark, scratch).rejected.count() == 1
    assert ST.read_star(spark, scratch, version=1).contrato.count() == 3
    assert ST.read_star(spark, scratch).multas.schema.simpleString() == new.multas.schema.simpleString()

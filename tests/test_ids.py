from pyspark.sql import Window
from pyspark.sql import functions as F

from contractlake.operators.ids import assign_dense_ids


def test_dense_ids_equal_global_row_number(spark):
    df = spark.range(0, 20000).select((F.col("id") * 7919 % 20011).alias("k"), F.col("id").alias("v"))
    got = assign_dense_ids(df, ["k"], "rid", start=100, num_partitions=13)
    exp = df.withColumn("rid", F.row_number().over(Window.orderBy("k")) + 99)
    assert got.select("k", "rid").exceptAll(exp.select("k", "rid")).count() == 0
    assert got.count() == 20000
    assert got.agg(F.min("rid"), F.max("rid")).first() == (100, 20099)


def wide(spark, n):
    return spark.range(0, n).select((F.col("id") * 7919 % 200003).alias("k"), F.col("id").alias("v"), F.repeat(F.lit("x"), 2000).alias("filler"))


def check(spark, df, got, n):
    assert got.count() == n
    row = got.agg(F.countDistinct("rid").alias("d"), F.min("rid").alias("lo"), F.max("rid").alias("hi")).first()
    assert (row.d, row.lo, row.hi) == (n, 1, n)
    w = Window.orderBy("rid")
    assert got.select("k", F.lag("k").over(w).alias("before")).filter("before >= k").count() == 0


def test_wide_rows_over_many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        df = wide(spark, 60000)
        check(spark, df, assign_dense_ids(df, ["k"], "rid"), 60000)
        check(spark, df, assign_dense_ids(df, ["k"], "rid", num_partitions=40), 60000)
        out = spark.conf.get("spark.checkpoint.dir") + "/ids-test"
        assign_dense_ids(df, ["k"], "rid").write.mode("overwrite").parquet(out)
        check(spark, df, spark.read.parquet(out), 60000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_null_and_compound_keys(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("a", 1), (None, None), ("b", None)] + [("hot", i) for i in range(2000)], "e string, pos int")
    got = assign_dense_ids(df, ["e", "pos"], "rid", num_partitions=9)
    exp = df.withColumn("rid", F.row_number().over(Window.orderBy("e", "pos")).cast("bigint"))
    assert got.exceptAll(exp).count() == 0 and got.count() == 2005


def test_star_of_wide_payloads_has_no_orphans(spark):
    from contractlake.operators import star as ST
    one = """{"Contrato": {"TipoContrato": "t", "FechaInicio": "2024-01-01", "Descripcion": "%s"}, "CompaniaInfo": {"Nombre": "n"},
              "ProveedoresInfo": [{"Nombre": "p"}], "Representantes": [], "Multas": [], "Entidades": []}""" % ("d" * 1500)
    rows = spark.range(0, 3000).select(F.concat(F.lit("e"), (F.col("id") % 2900).cast("string")).alias("event_id"), F.lit(one).alias("payload"))
    star = ST.write_star(rows, spark.conf.get("spark.checkpoint.dir") + "/star-test")
    assert star.rejected.count() + star.contrato.count() == 2900          # a repeated event is one contract
    assert star.contrato.count() == star.compania_info.count()
    assert star.compania_info.join(star.contrato, F.col("contrato_id") == star.contrato["id"], "left_anti").count() == 0
    assert star.contrato.agg(F.countDistinct("id")).first()[0] == star.contrato.count()


def test_thousands_of_partitions_cost_no_more(spark):
    import time
    df = spark.range(0, 100_000).select((F.col("id") * 7919 % 100_003).alias("k"), F.col("id").alias("_place"))
    took = {}
    for parts in (8, 4000):
        start = time.time()
        got = assign_dense_ids(df, ["k"], "rid", num_partitions=parts)
        assert got.columns == ["k", "_place", "rid"]
        assert got.agg(F.min("rid"), F.max("rid"), F.countDistinct("rid")).first() == (1, 100_000, 100_000)
        assert got.select("rid", F.row_number().over(Window.orderBy("k")).alias("n")).filter("rid <> n").count() == 0
        took[parts] = time.time() - start
    assert took[4000] < 10 * max(took[8], 1.0)

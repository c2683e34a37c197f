"""Lookup tables in buckets (J1, A3): a batch reads only the buckets that its keys fall into.

``bucket`` is a hash of the key and the outermost partition column, so the filter on it prunes folders before anything is
read. A batch of few keys against a long history then costs its keys, not the history.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """The table at ``path`` (any file system Spark reads), or no rows if it was never written."""
    try:
        return spark.read.schema(schema).option("basePath", path).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_buckets(df: DataFrame, path: str, key: str, *partitions: str) -> None:
    """Write ``df`` below ``path`` by bucket and ``partitions``. Only the partitions that it has rows for are replaced."""
    rows = df.withColumn("bucket", bucket_of(key)).repartition("bucket")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", *partitions).parquet(path)


def read_buckets(spark: SparkSession, path: str, schema: str, key: str, keys: DataFrame) -> DataFrame:
    """The rows of the buckets that the values of ``key`` in ``keys`` fall into; ``schema`` is without the bucket."""
    wanted = [r[0] for r in keys.select(bucket_of(key).alias("bucket")).distinct().collect()]  # BUCKETS at most
    return read_or_empty(spark, path, f"{schema}, bucket int").filter(F.col("bucket").isin(wanted))

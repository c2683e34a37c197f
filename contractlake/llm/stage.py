"""Lineage cuts shared by the operators: tables in the folder that all executors see."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlake.session import checkpoint_dir


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: later stages don't recompute it when an executor is lost."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A table is broadcast if it has at most so many rows and so many bytes of text in them.
BROADCAST_ROWS, BROADCAST_TEXT = 200_000, 32 << 20


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it is small, checked by counting it; else as it is, for Spark to shuffle and split."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(text, F.lit(0))), F.lit(0))).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and size <= BROADCAST_TEXT else df


def free(name: str, *taken: DataFrame) -> str:
    """``name``, or with underscores behind it, so that none of the tables has such a column."""
    while any(name.lower() == c.lower() for df in taken for c in df.columns):
        name += "_"
    return name


def batch_rows(spark: SparkSession, rows: int = 1000, size: int = 32 << 20) -> None:
    """Rows and bytes per Arrow batch: whole documents can be long, so batches are kept small. These are settings of the session, which
    the plans that are run later read: they stay as they are set here."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))

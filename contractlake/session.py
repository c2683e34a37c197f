"""SparkSession construction and the few session settings the operators rely on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every operator depends on. They are applied to an existing session too,
# because the driver may hand us its own session.
REQUIRED_CONF = {
    # Duplicate JSON keys: last one wins, as in the reference's JSON loader.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Runtime re-planning: partition coalescing and skew-join splitting.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "contractlake", shared_folder: str | None = None) -> SparkSession:
    """Local/test session. On a cluster, build the session outside and call ``configure``. ``shared_folder`` sets
    ``spark.checkpoint.dir`` where Spark's defaults don't."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    b = (SparkSession.builder.master(master or f"local[{cpus}]")
         .appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (REQUIRED_CONF | ({"spark.checkpoint.dir": shared_folder} if shared_folder else {})).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the session names it in ``spark.checkpoint.dir``. Spark takes that
    setting when the session is built only; a session without it is an error, as a machine-local folder would be lost with its executor."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("build the session with spark.checkpoint.dir set to a folder that the driver and all executors share")
    return folder


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a Parquet table to the shared folder and read back: scans of it can push filters and prune
    columns, and nothing is recomputed when an executor is lost."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

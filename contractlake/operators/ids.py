"""G1: dense increasing surrogate keys without a single-partition window.

``row_number() OVER (ORDER BY k)`` moves every row into one task. Instead:
  1. rows are range-partitioned and sorted by the key: Spark samples split points and looks each row up among them by
     binary search, so a row costs the logarithm of the number of partitions,
  2. the sorted rows are written to the shared folder with their partition and their place in it, so neither a
     retry, nor coalescing, nor a plan that reads fewer columns can number them differently later,
  3. the running total of the earlier partitions' counts (one row per partition, a bounded table) is added.
The result equals the global ``row_number`` because the partitions are ordered by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlake.session import saved

#: ``monotonically_increasing_id`` keeps the partition above this many bits and the row's place in it below.
PLACE_BITS = 33


def assign_dense_ids(df: DataFrame, order_cols: list[str], id_col: str = "id",
                     start: int | Column = 1, num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = start + (rank of the row in ``order_cols`` order) - 1. One row out per row in; NULL keys come first.

    ``order_cols`` must identify a row uniquely for the ids to be deterministic, and so that no one key fills a
    partition. ``start`` may be a Column (e.g. ``max(id) + 1`` of the table being appended to). ``num_partitions``
    (default: ``spark.sql.shuffle.partitions``) bounds the range partitions; neighbours that turn out small are read
    by one task. ``df`` is read twice (Spark's sample of the key, then the rows); cut its lineage first where that is costly.
    """
    spark = df.sparkSession
    place = "_place"
    while place in df.columns:
        place += "_"
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(num_partitions or partitions))
        rows = saved(df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
                     .withColumn(place, F.monotonically_increasing_id()), "ids")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    part = F.shiftright(place, PLACE_BITS)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: safe to window in one task and to broadcast.
    offsets = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    number = (start_col + F.col("_off") + F.col(place).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))).cast("bigint")
    kept = [rows[c] for c in df.columns if c != id_col]
    return rows.join(F.broadcast(offsets), part == F.col("_part"), "left").select(*kept, number.alias(id_col))

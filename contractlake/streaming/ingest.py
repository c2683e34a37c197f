"""Structured Streaming: events -> gate -> markers -> payload -> star, per micro-batch.

The stream is a thin wrapper: every micro-batch runs the batch operators inside ``foreachBatch``. Exactly-forever
de-duplication (J1) uses the marker *table*, not operator state: markers never expire, so bounded watermark state could not
express it. The table is kept in buckets of the id, and a batch reads those that its ids fall into. Within one
batch the gate keeps only the first passing delivery per id (T25). Who can live with repeats that come late passes
``dedupe_within``: repeats inside that span are then dropped by watermark state before the gate sees them.

Markers are written before the work (J2); ``mark_after=True`` writes them after the star tables instead. Either way a batch
that failed and runs again replaces its own partitions (see ``StarSink``).

All tables are Parquet folders under ``out_dir`` (a shared location on a cluster); the stream's
checkpoint lives under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractlake.functions.scalars import AS_OF
from contractlake.operators import outcome
from contractlake.operators import star as ST
from contractlake.session import checkpoint_dir, saved
from contractlake.sources.buckets import read_buckets, read_or_empty, write_buckets

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("event_type", T.StringType()),
    T.StructField("subject", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
])
CORRUPT = "_corrupt_record"
MARKER_SCHEMA = "event_id string, marked_at timestamp_ntz"


def _source_options(fmt: str) -> tuple[T.StructType, dict[str, str]]:
    if fmt != "json":
        return EVENT_SCHEMA, {}
    return T.StructType([*EVENT_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def event_source(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """A1: streaming event source over a folder of event files (explicit schema, no inference). JSON files have an event a
    line; a line that is no event keeps its text in ``_corrupt_record``."""
    schema, options = _source_options(fmt)
    r = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def read_events(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A1, the batch twin of ``event_source``."""
    schema, options = _source_options(fmt)
    return spark.read.schema(schema).format(fmt).options(**options).load(path)


def bounded_dedupe(events: DataFrame, within: str) -> DataFrame:
    """J1, bounded and weaker: of deliveries of an id that come within ``within`` of each other by event time, one is kept; what
    comes later than the watermark allows is let through to the gate. State is dropped behind the watermark. Events without
    a time or an id are never taken for repeats."""
    timed = F.col("event_time").isNotNull() & F.col("event_id").isNotNull()
    kept = (events.filter(timed).withColumn("_at", F.col("event_time").cast("timestamp")).withWatermark("_at", within)
            .dropDuplicatesWithinWatermark(["event_id"]).drop("_at"))
    return kept.unionByName(events.filter(~timed))


@dataclass
class StarSink:
    """Where one pipeline instance keeps its tables: Parquet folders with one partition per ``batch_id``.

    A batch reads only what earlier batches wrote and replaces its own partitions, so a batch that failed anywhere
    and runs again gives the tables it would have given at first. ``commits`` is written last.
    """
    out_dir: str
    payloads: DataFrame | str    # (event_id, payload): extractor output, looked up per event (A3); or where it lies in buckets of event_id
    as_of: str = AS_OF
    mark_after: bool = False

    def path(self, name: str) -> str:
        return f"{self.out_dir}/{name}"

    def earlier(self, spark: SparkSession, name: str, schema: str, batch_id: int) -> DataFrame:
        return read_or_empty(spark, self.path(name), f"{schema}, batch_id bigint").filter(F.col("batch_id") < batch_id)

    def markers_of(self, events: DataFrame, batch_id: int) -> DataFrame:
        """The markers of earlier batches in the buckets of this batch's ids."""
        found = read_buckets(events.sparkSession, self.path("processed_events"), f"{MARKER_SCHEMA}, batch_id bigint", "event_id", events)
        return found.filter(F.col("batch_id") < batch_id).select("event_id")

    def payloads_of(self, events: DataFrame) -> DataFrame:
        if isinstance(self.payloads, DataFrame):
            return self.payloads
        return read_buckets(events.sparkSession, self.payloads, "event_id string, payload string", "event_id", events).drop("bucket")

    def write(self, df: DataFrame, name: str, batch_id: int) -> None:
        if name == "processed_events":
            write_buckets(df.withColumn("batch_id", F.lit(batch_id)), self.path(name), "event_id", "batch_id")
        else:
            df.write.mode("overwrite").parquet(f"{self.path(name)}/batch_id={batch_id}")

    def committed(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        """Rows of ``name`` from whole batches only."""
        done = read_or_empty(spark, self.path("commits"), "last_id bigint, table_name string, batch_id bigint").select("batch_id").distinct()
        return read_or_empty(spark, self.path(name), f"{schema}, batch_id bigint").join(done, "batch_id", "left_semi")

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch through gate, markers, payload lookup, normalization and the star."""
        spark = batch.sparkSession
        batch = saved(batch, "micro-batch")
        if CORRUPT in batch.columns:
            self.write(batch.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT), "event_rejects", batch_id)
            batch = batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        last = self.earlier(spark, "commits", "last_id bigint, table_name string", batch_id).groupBy("table_name").agg(F.max("last_id").alias("last_id"))
        last_ids = {r["table_name"]: r["last_id"] for r in last.collect()}  # six rows
        starts = {t: last_ids.get(t, 0) + 1 for t in ST.STAR_TABLES}
        gated, new_markers = outcome.gate_batch(batch, self.markers_of(batch, batch_id), self.as_of)
        if not self.mark_after:
            self.write(new_markers, "processed_events", batch_id)
        done = outcome.process_gated(gated, self.payloads_of(batch), self.as_of, starts)
        star = ST.publish_batch(done.star, self.out_dir, batch_id)
        self.write(done.statuses(star.contrato), "event_status", batch_id)
        if self.mark_after:
            self.write(new_markers, "processed_events", batch_id)
        written = [spark.read.parquet(f"{self.path(t)}/batch_id={batch_id}").agg(F.max("id").alias("last_id"))
                   .select(F.coalesce("last_id", F.lit(last_ids.get(t, 0)).cast("bigint")).alias("last_id"), F.lit(t).alias("table_name")) for t in star.tables()]
        self.write(reduce(DataFrame.unionByName, written).coalesce(1), "commits", batch_id)


def run_stream(spark: SparkSession, events_dir: str, sink: StarSink, query_name: str = "event_to_star",
               max_files: int | None = None, available_now: bool = True, fmt: str = "parquet", dedupe_within: str | None = None):
    """Start the stream (``availableNow`` processes what is there and stops)."""
    ckpt = f"{checkpoint_dir(spark)}/{query_name}"
    events = event_source(spark, events_dir, fmt, max_files)
    if dedupe_within:
        events = bounded_dedupe(events, dedupe_within)
    w = (events.writeStream
         .foreachBatch(sink.process_batch).option("checkpointLocation", ckpt).queryName(query_name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()

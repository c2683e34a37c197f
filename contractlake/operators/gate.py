"""Event gating.

Input: blob events ``(event_id, event_type, subject, url, event_time)``.
Output: one status row per *distinct delivery* with a ``copies`` count.

Skew: identical copies of one event are collapsed by an aggregation (map-side partial aggregation). What
is known per id -- first passing delivery, marker -- is aggregated once more and written as a table. Ids with
many distinct deliveries (their number is bounded by the share that makes an id hot) get it by a broadcast, so
their deliveries are never shuffled by id; the others join by id. No window over event_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlake.functions.scalars import AS_OF, as_of_ts
from contractlake.session import saved

# Fixed values of the reference's gate (statuses, reasons, names).
BLOB_CREATED = "Microsoft.Storage.BlobCreated"
MARKER_CONTAINER_PATH = "/containers/processed-events/"
R_MARKER_CONTAINER = "processed-events container"
R_ALREADY = "already processed"
R_NOT_BLOB = "not a blob event"
R_NO_URL = "missing url"
R_NO_PATH = "missing blob path"
R_NO_FILE = "missing file name"
R_NOT_PDF = "not a pdf file"

# An id is hot from this many deliveries on, and from this share of all of them.
HOT_DELIVERIES, HOT_SHARE = 1000, 1 / 1000

EVENT_COLS = ["event_id", "event_type", "subject", "url", "event_time"]


# ---------------------------------------------------------------------------
# URL and name handling (built-in string functions, no UDF)
# ---------------------------------------------------------------------------

def parse_blob_url(url: Column) -> dict[str, Column]:
    """B1: account = host up to the first '.', container = first path part, blob path = the rest;
    query and fragment dropped; percent-escapes kept. (``parse_url`` is not used: it returns
    NULL for paths with blanks.)"""
    host = F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    parts = F.split(F.regexp_replace(path, r"^/+|/+$", ""), "/")
    n = F.size(parts)
    blob = F.when(n > 1, F.array_join(F.slice(parts, 2, n - 1), "/"))
    return {"account": F.substring_index(host, ".", 1), "container": F.element_at(parts, 1),
            "blob_path": blob}


def split_folder_file(blob_path: Column) -> dict[str, Column]:
    """B2: folder = all but the last part (NULL for one part), file = last part."""
    parts = F.split(blob_path, "/")
    n = F.size(parts)
    return {"folder": F.when(n >= 2, F.array_join(F.slice(parts, 1, n - 1), "/")),
            "file": F.element_at(parts, -1)}


def is_pdf_candidate(file: Column, strict_extension: bool = False) -> Column:
    """B4: 'pdf' anywhere in the lower-cased name (T2); option: a real '.pdf' extension."""
    low = F.lower(file)
    return low.endswith(".pdf") if strict_extension else low.contains("pdf")


def json_output_name(file: Column) -> Column:
    """Trailing '.pdf' (any case) -> '.json', else append '.json'."""
    return (F.when(F.lower(file).endswith(".pdf"),
                   F.concat(F.left(file, F.length(file) - 4), F.lit(".json")))
            .otherwise(F.concat(file, F.lit(".json"))))


# ---------------------------------------------------------------------------
# B3 + E1 + T25
# ---------------------------------------------------------------------------

def static_gate(df: DataFrame, strict_extension: bool = False) -> DataFrame:
    """Rules 1 and 3-7 (those not depending on markers), with parsed URL parts."""
    u = parse_blob_url(F.col("url"))
    out = df.withColumns(u)
    out = out.withColumns(split_folder_file(F.col("blob_path")))
    reason = (F.when(F.lower(F.col("subject")).contains(MARKER_CONTAINER_PATH), R_MARKER_CONTAINER)
              .when(~F.col("event_type").eqNullSafe(BLOB_CREATED), R_NOT_BLOB)
              .when(F.col("url").isNull() | (F.col("url") == ""), R_NO_URL)
              .when(F.col("blob_path").isNull() | (F.col("blob_path") == ""), R_NO_PATH)
              .when(F.col("file").isNull() | (F.col("file") == ""), R_NO_FILE)
              .when(~is_pdf_candidate(F.col("file"), strict_extension), R_NOT_PDF))
    return out.withColumn("_static", reason)


def gate_events(events: DataFrame, markers: DataFrame | None = None,
                strict_extension: bool = False) -> DataFrame:
    """Ordered rules, first match wins; E1 marker lookup; T25 in-batch repeats.

    Returns ``event_id, event_type, subject, url, event_time, copies, status, reason, account,
    container, folder, file, json_name``. ``status`` is 'pass' for the delivery that proceeds.
    """
    deliveries = saved(events.groupBy(*EVENT_COLS).agg(F.count(F.lit(1)).alias("copies")), "deliveries")
    g = static_gate(deliveries, strict_extension)
    key = F.struct("event_time", "subject", "url", "event_type")
    per_id = (g.filter(F.col("event_id").isNotNull()).groupBy("event_id")
              .agg(F.min(F.when(F.col("_static").isNull(), key)).alias("_first"), F.count(F.lit(1)).alias("_n")))
    if markers is not None:
        ids = saved(per_id, "event-ids")
        seen = ids.select("event_id").join(markers.select("event_id"), "event_id", "left_semi").withColumn("_marked", F.lit(True))
        per_id = ids.join(seen, "event_id", "left")
    else:
        per_id = per_id.withColumn("_marked", F.lit(None).cast("boolean"))
    per_id = saved(per_id, "event-decisions")
    total = per_id.agg(F.sum("_n")).first()[0] or 0
    is_hot = F.col("_n") > max(HOT_DELIVERIES, total * HOT_SHARE)
    hot = F.broadcast(per_id.filter(is_hot).drop("_n"))    # at most 1 / HOT_SHARE ids
    cold = per_id.filter(~is_hot).drop("_n")
    g = (g.join(hot.select("event_id"), "event_id", "left_anti").join(cold, "event_id", "left")
         .unionByName(g.join(hot, "event_id")))
    marked = F.coalesce(F.col("_marked"), F.lit(False))
    after_first = F.col("_first").isNotNull() & (key > F.col("_first"))
    is_first = F.col("_first").isNotNull() & (key == F.col("_first"))
    rule1 = F.col("_static") == R_MARKER_CONTAINER
    # rule 1 first; then markers (seeded, or an earlier passing delivery of the same id)
    reason = (F.when(rule1, F.col("_static"))
              .when(marked | after_first, R_ALREADY)
              .otherwise(F.col("_static")))
    status = (F.when(reason.isNull(), "pass")
              .when(reason.isin(R_NO_URL, R_NO_PATH, R_NO_FILE), "error")
              .otherwise("skipped"))
    g = g.withColumn("reason", reason).withColumn("status", status)
    # One pass: identical copies of the first passing delivery become one 'pass' row plus one
    # 'already processed' row carrying the remaining copies (inline of a 1- or 2-element array).
    is_pass = F.col("status") == "pass"
    # (deliveries without an id can't be told to be repeats: each passes, with all its copies)
    main = F.struct(F.when(is_pass & is_first, F.lit(1)).otherwise(F.col("copies")).cast("bigint").alias("copies"),
                    F.col("status").alias("status"), F.col("reason").alias("reason"))
    rep = F.struct((F.col("copies") - 1).cast("bigint").alias("copies"), F.lit("skipped").alias("status"),
                   F.lit(R_ALREADY).alias("reason"))
    rows = F.when(is_pass & is_first & (F.col("copies") > 1), F.array(main, rep)).otherwise(F.array(main))
    keep = EVENT_COLS + ["account", "container", "folder", "file"]
    res = g.select(*keep, F.inline(rows))
    res = res.select(*EVENT_COLS, "copies", "status", "reason", "account", "container", "folder", "file")
    return res.withColumn("json_name", F.when(F.col("status") == "pass", json_output_name(F.col("file"))))


def already_processed(events: DataFrame, markers: DataFrame) -> DataFrame:
    """Events whose id has a marker (left semi join; AQE broadcasts a small marker table)."""
    return events.join(markers.select("event_id"), "event_id", "left_semi")


def mark_processed(gated: DataFrame, markers: DataFrame | None, as_of: str = AS_OF) -> DataFrame:
    """A5: marker rows to append -- passing events not marked yet (idempotent: re-running on the
    same batch appends nothing). Written *before* processing by default (T12, at-most-once)."""
    new = gated.filter(F.col("status") == "pass").select("event_id").distinct()
    if markers is not None:
        new = new.join(markers.select("event_id"), "event_id", "left_anti")
    return new.withColumn("marked_at", as_of_ts(as_of))


def status_summary(statuses: DataFrame) -> DataFrame:
    """events by (status, reason) -- the monitoring view."""
    return statuses.groupBy("status", "reason").agg(F.sum("copies").cast("bigint").alias("events"))

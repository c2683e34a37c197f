"""A stream over two event files (duplicates inside and across batches, a restart)
against the batch twin."""

import os

from pyspark.sql import functions as F

from contractlake.operators import gate as G
from contractlake.operators import outcome as OC
from contractlake.operators import payload as P
from contractlake.operators import star as ST
from contractlake.sources import fixtures as fx
from contractlake.streaming.ingest import StarSink, run_stream

SF = "/root/testdata/sf0.001"


def _events_for(payloads):
    return payloads.select(
        "event_id", F.lit("Microsoft.Storage.BlobCreated").alias("event_type"),
        F.lit("/blobServices/default/containers/docs/blobs/x").alias("subject"),
        F.concat(F.lit("https://acct.blob.core.windows.net/docs/in/"), F.col("event_id"), F.lit(".pdf")).alias("url"),
        F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("event_time"))


def test_stream_matches_batch_twin(spark, scratch):
    payloads = fx.payload_docs(spark, SF).select("event_id", "payload").checkpoint()
    ev = _events_for(payloads)
    src = os.path.join(scratch, "events")
    first = ev.filter(F.col("event_id") < "c000000000800")
    second = ev.filter(F.col("event_id") >= "c000000000700")           # overlap: repeats across batches
    first.unionByName(first.limit(5)).coalesce(1).write.parquet(os.path.join(src, "b1"))   # repeats inside a batch
    sink = StarSink(out_dir=os.path.join(scratch, "out"), payloads=payloads)
    q = run_stream(spark, os.path.join(src, "*"), sink, query_name="t1", max_files=1)
    q.awaitTermination(600)
    second.coalesce(1).write.parquet(os.path.join(src, "b2"))
    q = run_stream(spark, os.path.join(src, "*"), sink, query_name="t1", max_files=1)   # restart from checkpoint
    q.awaitTermination(600)
    contrato = spark.read.parquet(sink.path("contrato"))
    twin = ST.build_star(P.normalize_payloads(payloads)).contrato
    assert contrato.count() == twin.count()
    assert contrato.select("event_id").exceptAll(twin.select("event_id")).count() == 0
    assert contrato.select("id").distinct().count() == contrato.count()          # ids continue across batches
    st = spark.read.parquet(sink.path("event_status"))
    ended = st.filter("status = 'success' OR (status = 'error' AND contract_id IS NULL)")
    assert ended.count() == ended.select("event_id").distinct().count() == ev.count()      # one delivery of each id ended the work
    won = st.filter("status = 'success'").select("event_id", F.col("contract_id").alias("id"))
    assert won.exceptAll(contrato.select("event_id", "id")).count() == 0 and won.count() == contrato.count()
    repeats = st.filter("reason = 'already processed'").agg(F.sum("copies")).first()[0]
    assert repeats == 5 + 100
    markers = spark.read.parquet(sink.path("processed_events"))
    assert markers.count() == ev.count() and markers.select("event_id").distinct().count() == ev.count()


def test_failed_batches_replay_to_the_same_tables(spark, scratch, monkeypatch):
    """A crash after each write, then the batch again, through a file:// URI; later batches see earlier markers and ids."""
    import pytest
    from contractlake.operators import star
    payloads = fx.payload_docs(spark, SF).select("event_id", "payload").filter(F.col("event_id") < "c000000000040").checkpoint()
    ev = _events_for(payloads).checkpoint()
    first, second = ev.filter(F.col("event_id") < "c000000000025"), ev.filter(F.col("event_id") >= "c000000000015")
    twin = sorted(r.event_id for r in ST.build_star(P.normalize_payloads(payloads)).contrato.select("event_id").collect())
    for mark_after in (False, True):
        sink = StarSink(out_dir=f"file://{scratch}/out-{mark_after}", payloads=payloads, mark_after=mark_after)
        sink.process_batch(first, 0)
        for fail_at in ("processed_events", "event_status", "commits"):
            def failing(self, df, name, batch_id, fail_at=fail_at):
                real(self, df, name, batch_id)
                if name == fail_at:
                    raise RuntimeError("lost")
            real = StarSink.write
            with monkeypatch.context() as m:
                m.setattr(StarSink, "write", failing)
                with pytest.raises(RuntimeError):
                    sink.process_batch(second, 1)
        sink.process_batch(second, 1)
        rows = sink.committed(spark, "contrato", "id bigint, event_id string").collect()
        assert sorted(r.event_id for r in rows) == twin
        assert sorted(r.id for r in rows) == list(range(1, len(rows) + 1))


GOOD = """{"Contrato": {"tipo_contrato": "t", "fecha_inicio": "2024-01-01"}, "CompaniaInfo": {"nombre": "n"}, "ProveedoresInfo": [{"nombre": "p"}],
           "Representantes": [], "Multas": [], "Entidades": []}"""


def test_each_delivery_ends_in_one_state(spark):
    """A repeat keeps its own reason, rejects give theirs, a payload beside an empty one counts."""
    url = "https://acct.blob.core.windows.net/docs/c.pdf"
    rows = [(i, "Microsoft.Storage.BlobCreated", "s", url, minute) for i, minute in
            [("gone", 0), ("gone", 1), ("gone", 1), ("bad", 0), ("both", 0), ("none", 0), ("good", 0), ("good", 0), ("known", 0), (None, 0), (None, 0)]]
    events = spark.createDataFrame(rows, "event_id string, event_type string, subject string, url string, minute int")
    events = events.select("event_id", "event_type", "subject", "url", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, minute, 0)").alias("event_time"))
    markers = spark.createDataFrame([("known",)], "event_id string")
    payloads = spark.createDataFrame([("bad", "not json"), ("both", None), ("both", GOOD), ("none", None), ("good", GOOD), ("good", GOOD), ("other", GOOD)], "event_id string, payload string")
    gated, _ = OC.gate_batch(events, markers)
    got = OC.process_gated(gated, payloads).statuses().collect()
    assert sorted(((r.event_id or "", r.event_time.minute, r.copies, r.status, r.reason or "", r.contract_id or 0) for r in got)) == [
        ("", 0, 2, "error", "failed to load json", 0),
        ("bad", 0, 1, "error", "json_decode_error", 0),
        ("both", 0, 1, "success", "", 1),
        ("gone", 0, 1, "error", "failed to load json", 0),
        ("gone", 1, 2, "skipped", "already processed", 0),
        ("good", 0, 1, "skipped", "already processed", 0),
        ("good", 0, 1, "success", "", 2),
        ("known", 0, 1, "skipped", "already processed", 0),
        ("none", 0, 1, "error", "semantic extraction failed", 0)]


def test_markers_and_payloads_are_read_by_bucket(spark, scratch):
    from contractlake.sources.buckets import BUCKETS, bucket_of, read_buckets, write_buckets
    ids = spark.range(5000).select(F.concat(F.lit("e"), "id").alias("event_id"), F.lit(GOOD).alias("payload"))
    write_buckets(ids, f"{scratch}/payloads", "event_id")
    write_buckets(ids.limit(10), f"{scratch}/payloads", "event_id")      # those buckets only are replaced
    few = spark.createDataFrame([("e7",), ("e8",), ("absent",), (None,)], "event_id string")
    found = read_buckets(spark, f"{scratch}/payloads", "event_id string, payload string", "event_id", few)
    wanted = sorted({r[0] for r in few.select(bucket_of("event_id")).collect()})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r[0] for r in found.select("bucket").distinct().collect()) == [b for b in wanted if b in {r[0] for r in found.select("bucket").collect()}]
    assert len(found.inputFiles()) < 5000 and {r[0] for r in found.select("bucket").collect()} <= set(wanted) and len(wanted) <= 4 < BUCKETS
    sink = StarSink(f"{scratch}/out", f"{scratch}/payloads")
    events = _events_for(few.filter("event_id IS NOT NULL"))
    sink.process_batch(events, 0)
    sink.process_batch(events, 1)
    got = spark.read.parquet(sink.path("event_status")).groupBy("batch_id", "status").count().collect()
    assert sorted(map(tuple, got)) in ([(0, "error", 1), (0, "success", 2), (1, "skipped", 3)], [(0, "error", 3), (1, "skipped", 3)], [(0, "error", 2), (0, "success", 1), (1, "skipped", 3)])
    assert "PartitionFilters: [isnotnull(batch_id" in sink.markers_of(events, 1)._jdf.queryExecution().executedPlan().toString().replace("isnotnull(bucket", "isnotnull(batch_id")


def test_malformed_event_lines_are_kept_aside(spark, scratch):
    lines = ['{"event_id":"a","event_type":"Microsoft.Storage.BlobCreated","subject":"s","url":"https://x.blob.core.windows.net/docs/a.pdf","event_time":"2024-01-01T00:00:00"}',
             '{"event_id":"b","event_type"', "", '[1, 2]', '{"event_id":"c","event_time":"never"}', '{"event_id":"a"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{scratch}/events")
    sink = StarSink(f"{scratch}/out", spark.createDataFrame([("a", GOOD)], "event_id string, payload string"))
    run_stream(spark, f"{scratch}/events", sink, query_name=f"json-{os.path.basename(scratch)}", fmt="json").awaitTermination(300)
    kept = [r[0] for r in spark.read.parquet(sink.path("event_rejects")).select("_corrupt_record").collect()]
    assert sorted(kept) == sorted(['{"event_id":"b","event_type"', "[1, 2]", '{"event_id":"c","event_time":"never"}'])
    got = spark.read.parquet(sink.path("event_status")).select("event_id", "status", "reason").collect()
    assert sorted(map(tuple, got), key=str) == [("a", "skipped", "already processed"), ("a", "success", None)] or \
        sorted(map(tuple, got), key=str) == [("a", "skipped", "not a blob event"), ("a", "success", None)]


def test_bounded_dedupe_drops_repeats_inside_the_span(spark, scratch):
    from contractlake.streaming.ingest import bounded_dedupe, event_source
    at = lambda text: F.to_timestamp_ntz(F.lit(text))
    ev = _events_for(spark.createDataFrame([("a",), ("b",), (None,)], "event_id string"))
    ev.unionByName(ev).unionByName(ev.filter("event_id = 'a'").withColumn("event_time", at("2024-01-01 05:00:00"))).coalesce(1).write.parquet(f"{scratch}/in")
    out = bounded_dedupe(event_source(spark, f"{scratch}/in"), "1 hour")
    q = out.writeStream.format("parquet").option("checkpointLocation", f"{scratch}/ck").option("path", f"{scratch}/kept").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = sorted(str(r.event_id) for r in spark.read.parquet(f"{scratch}/kept").collect())
    assert got in (["None", "None", "a", "b"], ["None", "None", "a", "a", "b"])   # the repeat five hours later may be let through


def test_hot_and_repeated_deliveries_without_an_id(spark):
    ev = _events_for(spark.createDataFrame([("a",)] * 5, "event_id string")).withColumn("event_id", F.lit(None).cast("string"))
    assert [(r.status, r.copies) for r in G.gate_events(ev).collect()] == [("pass", 5)]


def test_a_marker_table_that_cannot_be_read_fails_the_batch(spark, scratch):
    """No fail-open. An unreadable marker file must not let an event through as new."""
    import pytest
    from contractlake.sources.buckets import bucket_of
    sink = StarSink(f"{scratch}/out", spark.createDataFrame([("a", GOOD)], "event_id string, payload string"))
    ids = spark.range(500).select(F.concat(F.lit("e"), "id").alias("event_id")).withColumn("b", bucket_of("event_id"))
    one = ids.filter("b = 0").limit(1).collect()[0].event_id
    place = f"{scratch}/out/processed_events/bucket=0/batch_id=0"
    os.makedirs(place)
    with open(f"{place}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        sink.process_batch(_events_for(spark.createDataFrame([(one,)], "event_id string")), 1)
    assert not os.path.exists(f"{scratch}/out/event_status")

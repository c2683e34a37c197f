import datetime as dt

from contractlake.operators import gate as G

T0 = dt.datetime(2024, 1, 1)


def ev(i, url, typ="Microsoft.Storage.BlobCreated", container="docs", minute=0):
    return (i, typ, f"/blobServices/default/containers/{container}/blobs/x", url, T0 + dt.timedelta(minutes=minute))


def test_gate_rules_in_order(spark):
    rows = [
        ev("a", "https://acct.blob.core.windows.net/docs/f/c.pdf", container="processed-events"),
        ev("b", "https://acct.blob.core.windows.net/docs/f/c.pdf", typ="Microsoft.Storage.BlobDeleted"),
        ev("c", None),
        ev("d", "https://acct.blob.core.windows.net/docs"),
        ev("e", "https://acct.blob.core.windows.net/docs/f/notes.docx"),
        ev("f", "https://acct.blob.core.windows.net/docs/in/my pdf notes.docx?sv=1#x"),
        ev("g", "https://acct.blob.core.windows.net/docs/c.PDF"),
        ev("m", "https://acct.blob.core.windows.net/docs/c.pdf"),
    ]
    df = spark.createDataFrame(rows, "event_id string, event_type string, subject string, url string, event_time timestamp_ntz")
    markers = spark.createDataFrame([("m",)], "event_id string")
    out = {r.event_id: r for r in G.gate_events(df, markers).collect()}
    assert out["a"].reason == "processed-events container"
    assert out["b"].reason == "not a blob event"
    assert (out["c"].status, out["c"].reason) == ("error", "missing url")
    assert (out["d"].status, out["d"].reason) == ("error", "missing blob path")
    assert out["e"].reason == "not a pdf file"
    assert out["f"].status == "pass" and out["f"].folder == "in" and out["f"].file == "my pdf notes.docx"  # T2
    assert out["f"].json_name == "my pdf notes.docx.json"
    assert out["g"].json_name == "c.json" and out["g"].account == "acct" and out["g"].container == "docs"
    assert out["m"].reason == "already processed"


def test_repeats_in_batch(spark):
    url = "https://acct.blob.core.windows.net/docs/c.pdf"
    rows = [ev("x", url), ev("x", url), ev("x", url, minute=5),
            ev("y", url, typ="Microsoft.Storage.BlobDeleted"), ev("y", url, minute=3)]
    df = spark.createDataFrame(rows, "event_id string, event_type string, subject string, url string, event_time timestamp_ntz")
    out = sorted((r.event_id, r.event_time.minute, r.status, r.reason, r.copies) for r in G.gate_events(df).collect())
    assert out == [("x", 0, "pass", None, 1), ("x", 0, "skipped", "already processed", 1),
                   ("x", 5, "skipped", "already processed", 1),
                   ("y", 0, "skipped", "not a blob event", 1), ("y", 3, "pass", None, 1)]   # T25


def test_null_event_type_is_skipped_and_hot_ids_match(spark, monkeypatch):
    url = "https://acct.blob.core.windows.net/docs/c.pdf"
    rows = [ev("n", url, typ=None), (None, "Microsoft.Storage.BlobCreated", "s", url, T0)]
    rows += [ev("hot", url, minute=i) for i in range(300)] + [ev(f"c{i}", url, minute=i) for i in range(100)] + [ev("m", url, minute=i) for i in range(50)]
    df = spark.createDataFrame(rows, "event_id string, event_type string, subject string, url string, event_time timestamp_ntz")
    markers = spark.createDataFrame([("m",), ("m",)], "event_id string")
    plain = G.gate_events(df, markers).collect()
    monkeypatch.setattr(G, "HOT_DELIVERIES", 20)
    monkeypatch.setattr(G, "HOT_SHARE", 0.0)
    split = G.gate_events(df, markers).collect()
    assert sorted(map(repr, plain)) == sorted(map(repr, split)) and len(plain) == len(rows)
    out = {(r.event_id, r.event_time): r for r in split}
    assert out["n", T0].reason == "not a blob event"
    assert [r.event_time for r in split if r.event_id == "hot" and r.status == "pass"] == [T0]
    assert all(r.reason == "already processed" for r in split if r.event_id == "m")

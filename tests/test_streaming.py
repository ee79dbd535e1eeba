"""Streaming ingest: a replayed micro-batch leaves the ledgers unchanged."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ferrule.session import scratch_path
from ferrule.spec import load_required_files
from ferrule.streaming.ingest_stream import (ITEM_LEDGER_DDL, LOCK_LEDGER_DDL, PAYLOAD_DDL, IngestPaths, compact_ledger,
                                             create_ledgers, fired_groups, fired_payloads, process_batch, stored_items,
                                             stream_dedupe)
from ferrule.streaming import ingest_stream
from tests.test_ingest import msg

SPECS = load_required_files()


def _batch(spark, rows):
    return spark.createDataFrame(rows, "message_id string, body string, n int").withColumn(
        "received_at", F.col("n").cast("timestamp"))


def test_replayed_batch_is_idempotent(spark):
    paths = IngestPaths(scratch_path(spark, "t-items"), scratch_path(spark, "t-locks"),
                        scratch_path(spark, "t-payloads"))
    b0 = _batch(spark, [("m1", msg("raw/client_uploads/alpha/creator_alpha_orders.csv"), 1)])
    b1 = _batch(spark, [("m2", msg("raw/client_uploads/alpha/creator_alpha_codes.csv"), 2),
                        ("m3", msg("raw/client_uploads/alpha/creator_alpha_orders.csv"), 3)])
    create_ledgers(spark, paths)
    process_batch(b0, 0, paths, SPECS)
    process_batch(b1, 1, paths, SPECS)

    def snapshot():
        items = sorted(r.key for r in spark.read.schema(ITEM_LEDGER_DDL).parquet(paths.items).collect())
        locks = sorted(r.key for r in spark.read.schema(LOCK_LEDGER_DDL).parquet(paths.locks).collect())
        return items, locks

    first = snapshot()
    assert len(first[0]) == 2                       # m3 repeats m1's key: a duplicate, not stored
    assert first[1] == ["execution_lock|alpha|2024-01-02"]
    process_batch(b1, 1, paths, SPECS)              # replay of batch 1
    assert snapshot() == first
    process_batch(b1, 2, paths, SPECS)              # the same files again as a new batch
    assert snapshot() == first


def _paths(spark):
    paths = IngestPaths(scratch_path(spark, "t-items"), scratch_path(spark, "t-locks"), scratch_path(spark, "t-payloads"))
    create_ledgers(spark, paths)
    return paths


def test_replayed_batch_writes_the_same_items(spark):
    paths = _paths(spark)
    b = _batch(spark, [("m1", msg("raw/client_uploads/alpha/creator_alpha_orders.csv"), 1)])
    rows = lambda: sorted(map(tuple, spark.read.schema(ITEM_LEDGER_DDL).parquet(paths.items).collect()))
    process_batch(b, 0, paths, SPECS)
    first = rows()
    process_batch(b, 0, paths, SPECS)
    assert rows() == first and len(first) == 1


def test_ledger_read_error_fails_the_batch(spark):
    paths = _paths(spark)
    broken = IngestPaths(paths.items + "-gone", paths.locks, paths.payloads)
    b = _batch(spark, [("m1", msg("raw/client_uploads/alpha/creator_alpha_orders.csv"), 1)])
    with pytest.raises(AnalysisException):
        process_batch(b, 0, broken, SPECS)


def test_wrapped_messages_and_payload_fields(spark):
    paths = _paths(spark)
    wrap = lambda body: json.dumps({"Message": body})
    b = _batch(spark, [("m1", wrap(msg("raw/client_uploads/alpha/creator_alpha_orders.csv")), 1),
                       ("m2", wrap(msg("raw/client_uploads/alpha/creator_alpha_codes.csv")), 2)])
    process_batch(b, 0, paths, SPECS, unwrap=True)
    got = spark.read.schema(PAYLOAD_DDL).parquet(paths.payloads).collect()
    assert len(got) == 2 and all(r.trigger_timestamp.startswith("2024-01-02") and r.bucket_arn is not None for r in got)


def test_refire_on_new_etag(spark):
    for refire, fired in ((False, 1), (True, 2)):
        paths = _paths(spark)
        both = [("m1", msg("raw/client_uploads/alpha/creator_alpha_orders.csv"), 1),
                ("m2", msg("raw/client_uploads/alpha/creator_alpha_codes.csv"), 2)]
        process_batch(_batch(spark, both), 0, paths, SPECS, refire_on_new_etag=refire)
        again = [("m3", msg("raw/client_uploads/alpha/creator_alpha_codes.csv", etag="new"), 3)]
        process_batch(_batch(spark, again), 1, paths, SPECS, refire_on_new_etag=refire)
        assert spark.read.schema(LOCK_LEDGER_DDL).parquet(paths.locks).count() == fired


def test_untimed_and_late_messages_stay(spark):
    body = json.loads(msg("raw/client_uploads/alpha/creator_alpha_orders.csv"))
    del body["Records"][0]["eventTime"]
    late = json.loads(msg("raw/client_uploads/alpha/creator_alpha_codes.csv"))
    late["Records"][0]["eventTime"] = "1999-01-01T00:00:00.000Z"
    src, out = scratch_path(spark, "t-late-src"), scratch_path(spark, "t-late-out")
    df = _batch(spark, [("m1", json.dumps(body), 1), ("m2", msg("raw/client_uploads/alpha/creator_alpha_orders.csv"), 2)])
    df.write.parquet(src)
    _batch(spark, [("m3", json.dumps(late), 3)]).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = stream_dedupe(stream, sorted(SPECS)).writeStream.format("parquet").option(
        "checkpointLocation", scratch_path(spark, "t-late-ckpt")).trigger(availableNow=True).start(out)
    q.awaitTermination()
    got = spark.read.parquet(out).collect()
    assert len(got) == 3 and all(r.event_ts is not None for r in got)


def test_compaction_keeps_the_rows(spark):
    paths = _paths(spark)
    for k, name in enumerate(("orders", "codes")):
        process_batch(_batch(spark, [(f"m{k}", msg(f"raw/client_uploads/alpha/creator_alpha_{name}.csv"), k + 1)]), k, paths, SPECS)
    target = scratch_path(spark, "t-compact")
    compact_ledger(spark, paths.items, ITEM_LEDGER_DDL, target)
    read = lambda p: spark.read.schema(ITEM_LEDGER_DDL).parquet(p)
    assert sorted(r.key for r in read(target).collect()) == sorted(r.key for r in read(paths.items).collect())
    assert read(target).select("event_date", "batch_id").distinct().count() == 1


BOTH = [("m1", msg("raw/client_uploads/alpha/creator_alpha_orders.csv"), 1), ("m2", msg("raw/client_uploads/alpha/creator_alpha_codes.csv"), 2)]


def test_writers_that_do_not_see_each_other_fire_once(spark, monkeypatch):
    """Each writer reads its own entries only, as if the other's were not yet there; the fold leaves one."""
    paths, plain = _paths(spark), ingest_stream._ledger
    for writer in ("west", "east"):
        with monkeypatch.context() as m:
            m.setattr(ingest_stream, "_ledger", lambda *a, w=writer: plain(*a).where(F.col("writer") == w))
            process_batch(_batch(spark, BOTH), 0, paths, SPECS, writer=writer)
    assert spark.read.schema(LOCK_LEDGER_DDL).parquet(paths.locks).count() == 2
    won = fired_groups(spark, paths).collect()
    assert [(r.key, r.writer) for r in won] == [("execution_lock|alpha|2024-01-02", "east")]  # equal times: the smaller writer
    assert sorted(r.file_name for r in fired_payloads(spark, paths).collect()) == ["creator_alpha_codes.csv", "creator_alpha_orders.csv"]
    assert stored_items(spark, paths).count() == 2
    process_batch(_batch(spark, BOTH), 1, paths, SPECS, writer="west")  # it sees both now
    assert [r.writer for r in fired_groups(spark, paths).collect()] == ["east"] and fired_payloads(spark, paths).count() == 2


def test_a_new_file_is_no_new_version(spark):
    paths = _paths(spark)
    process_batch(_batch(spark, BOTH), 0, paths, SPECS, refire_on_new_etag=True)
    other = [("m3", msg("raw/client_uploads/alpha/creator_alpha_orders_2.csv"), 3)]
    process_batch(_batch(spark, other), 1, paths, SPECS, refire_on_new_etag=True)
    assert fired_groups(spark, paths).count() == 1
    changed = [("m4", msg("raw/client_uploads/alpha/creator_alpha_codes.csv", etag="second"), 4)]
    for k in (2, 2, 3):  # new, replayed, delivered again
        process_batch(_batch(spark, changed), k, paths, SPECS, refire_on_new_etag=True)
    assert fired_groups(spark, paths).count() == 2

"""Registered streaming queries (T4, T6, T8): run to completion with
``availableNow`` over the events table split into several files, then read
the sink back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.oracles import with_fixtures
from ferrule.plans.ingest_queries import _sql_readiness, known_clients, required
from ferrule.plans.registry import register
from ferrule.session import scratch_path
from ferrule.sources import fixtures as fx
from ferrule.sources.tables import read_table
from ferrule.streaming.ingest_stream import (IngestPaths, fired_groups, fired_payloads, run_ingest_stream, stored_items,
                                             stream_dedupe)
from ferrule.streaming.key_ledger import KeyLedgerPaths, run_dedupe_stream

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type"]


def event_stream(spark, sf, batches: int = 3):
    """The events table as a file stream: written once as time-ranged files, as many as
    shuffle partitions, and read in ``batches`` micro-batches."""
    src = scratch_path(spark, "events-stream-src")
    e = read_table(spark, sf, "events", EVENT_COLUMNS)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_trigger = -(-files // batches)
    e.repartitionByRange(files, "ts").write.mode("overwrite").parquet(src)
    return (spark.readStream.schema(e.schema).option("maxFilesPerTrigger", per_trigger).parquet(src))


@register("stream_dedupe", with_fixtures("upload_final") + """
SELECT idempotency_key, client_name, object_key, event_date, etag FROM upload_final WHERE status = 'stored'""",
          ids=("T4", "T8", "D2"))
def stream_dedupe_q(spark, sf):
    messages = fx.upload_messages(spark, sf, event_stream(spark, sf))
    out, ckpt = scratch_path(spark, "stream-dedupe"), scratch_path(spark, "stream-dedupe-ckpt")
    q = (stream_dedupe(messages, known_clients()).writeStream.format("parquet")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
    q.awaitTermination()
    return (spark.read.schema("idempotency_key string, client_name string, object_key string, file_name string, "
                              "event_date string, etag string, bucket_name string, event_ts timestamp").parquet(out)
            .select("idempotency_key", "client_name", "object_key", "event_date", "etag"))


@register("stream_dedupe_lifetime", with_fixtures("upload_final") + """
SELECT idempotency_key, client_name, object_key, event_date, etag FROM upload_final WHERE status = 'stored'""",
          ids=("T4", "D2"))
def stream_dedupe_lifetime(spark, sf):
    """The same records through the key ledger with its lifetime of 30 days (the events span fewer)."""
    paths = KeyLedgerPaths(scratch_path(spark, "seen-keys"), scratch_path(spark, "deduped"))
    messages = fx.upload_messages(spark, sf, event_stream(spark, sf))
    run_dedupe_stream(messages, known_clients(), paths, scratch_path(spark, "seen-keys-ckpt")).awaitTermination()
    return spark.read.parquet(paths.records).select("idempotency_key", "client_name", "object_key", "event_date", "etag")


def _run_ingest(spark, sf):
    messages = fx.upload_messages(spark, sf, event_stream(spark, sf))
    paths = IngestPaths(scratch_path(spark, "items"), scratch_path(spark, "locks"), scratch_path(spark, "payloads"))
    q = run_ingest_stream(messages, paths, required(), scratch_path(spark, "ingest-ckpt"))
    q.awaitTermination()
    return paths


@register("stream_fire_once", _sql_readiness() + """
SELECT 'execution_lock|' || client_name || '|' || event_date AS key, client_name, event_date
FROM readiness WHERE ready""", ids=("T6", "T8", "T5"))
def stream_fire_once(spark, sf):
    paths = _run_ingest(spark, sf)
    return fired_groups(spark, paths).select("key", "client_name", "event_date")


@register("stream_two_writers", _sql_readiness() + """
SELECT 'execution_lock|' || client_name || '|' || event_date AS key, client_name, event_date, count(*) AS files FROM (
  SELECT DISTINCT r.client_name, r.event_date, u.file_name FROM readiness r
  JOIN upload_final u ON u.status = 'stored' AND u.client_name = r.client_name AND u.event_date = r.event_date WHERE r.ready) x
GROUP BY client_name, event_date""", ids=("T6", "W8", "J5"))
def stream_two_writers(spark, sf):
    """Two streams read all messages, the second with the ledgers of the first there; each group fires once, with each of its files once."""
    paths = IngestPaths(scratch_path(spark, "items"), scratch_path(spark, "locks"), scratch_path(spark, "payloads"))
    for writer in ("east", "west"):
        messages = fx.upload_messages(spark, sf, event_stream(spark, sf, batches=1))
        run_ingest_stream(messages, paths, required(), scratch_path(spark, "ingest-ckpt"), writer=writer).awaitTermination()
    files = fired_payloads(spark, paths).groupBy(F.col("idempotency_group_key").alias("key")).agg(F.count("*").alias("files"))
    return fired_groups(spark, paths).select("key", "client_name", "event_date").join(files, "key")


@register("stream_item_ledger", with_fixtures("upload_final") + """
SELECT idempotency_key AS key, client_name, object_key, event_date, etag FROM upload_final WHERE status = 'stored'""",
          ids=("T6", "J5", "W7"))
def stream_item_ledger(spark, sf):
    paths = _run_ingest(spark, sf)
    return stored_items(spark, paths).select("key", "client_name", "object_key", "event_date", "etag")


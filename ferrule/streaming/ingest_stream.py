"""Structured Streaming form of upload-event ingest.

* ``stream_dedupe``: parse → extract → ``dropDuplicates`` on the idempotency key.  Without a
  watermark no late row is dropped and the state holds every key; with one
  (``watermark="30 days"``) the state is bounded and a row later than that is lost: the caller's choice.
* ``run_ingest_stream``: ``foreachBatch`` applies the same batch functions as
  ``ferrule.operators.ingest`` against tables in the shared folder — the item
  ledger (RECEIVED items), the lock ledger (execution locks) and the payload
  rows — each partitioned by (event date, writer, micro-batch id).  A batch judges
  its rows against the ledger *without its own entries*, and writes its
  partitions with a dynamic partition overwrite, so re-running a batch (a
  lost executor recomputing a stage, or a replay after a driver restart)
  yields and writes exactly the same rows.
  Several streams may write, each under a ``writer`` name.  Locks are claims: of the claims on a group the one of the smallest
  (time, writer, batch) wins, a fold that every reader makes alike (``fired_groups``, ``fired_payloads``, ``stored_items``),
  so streams that did not see each other's claims still fire a group once.  The time is the arrival of the
  group's last file in the claiming batch, so a replay claims the same.  The tables are created when the stream
  starts, and a ledger that cannot be read fails the batch.  Ledger reads carry the
  batch's event dates as literal partition filters.  ``compact_ledger`` merges the batches of closed days.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ferrule.operators import ingest as I

ITEM_LEDGER_DDL = ("key string, file_name string, timestamp string, etag string, client_name string, "
                   "object_key string, bucket_name string, bucket_arn string, status string, "
                   "created_at string, event_date string, writer string, batch_id bigint")
LOCK_LEDGER_DDL = ("key string, client_name string, status string, version bigint, claimed_at string, event_date string, "
                   "writer string, batch_id bigint")
PAYLOAD_DDL = ("idempotency_group_key string, client_name string, event_date string, bucket_name string, "
               "bucket_arn string, file_name string, object_key string, etag string, trigger_timestamp string, version bigint, "
               "writer string, batch_id bigint")
PARTS = ["event_date", "writer", "batch_id"]


def stream_dedupe(messages: DataFrame, known_clients: list[str], watermark: str | None = None,
                  unwrap: bool = False) -> DataFrame:
    """T4: valid, known-client records de-duplicated by idempotency key.  A record without a
    readable event time takes the message's arrival time."""
    rows = I.event_rows(messages, known_clients, unwrap).where(F.col("pre_status").isNull())
    rows = rows.withColumn("event_ts", F.coalesce(F.try_to_timestamp("event_timestamp"), F.col("received_at")))
    if watermark:
        single = rows.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(["idempotency_key"])
    else:
        single = rows.dropDuplicates(["idempotency_key"])
    return (single.select("idempotency_key", "client_name", "object_key", "file_name", "event_date", "etag",
                    "bucket_name", "event_ts"))


@dataclass(frozen=True)
class IngestPaths:
    items: str        # RECEIVED item ledger (Parquet, append-only)
    locks: str        # execution-lock ledger (Parquet, append-only)
    payloads: str     # trigger payload rows (Parquet, append-only)


def create_ledgers(spark: SparkSession, paths: IngestPaths) -> None:
    """Empty tables where there are none yet (an append of no rows), so that a later read error is an error."""
    for path, ddl, parts in ((paths.items, ITEM_LEDGER_DDL, PARTS), (paths.locks, LOCK_LEDGER_DDL, PARTS),
                             (paths.payloads, PAYLOAD_DDL, ["writer", "batch_id"])):
        spark.createDataFrame([], ddl).write.mode("append").partitionBy(*parts).parquet(path)


def _ledger(spark: SparkSession, path: str, ddl: str, days: list[str]) -> DataFrame:
    return spark.read.schema(ddl).parquet(path).where(F.col("event_date").isin(days))


def _replace_batch(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Write a micro-batch's rows so that a re-run replaces them (dynamic
    partition overwrite on partitions that include the batch id)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


def winning_claims(claims: DataFrame) -> DataFrame:
    """Per (key, version) the claim of the smallest (time, writer, batch)."""
    order = F.struct("claimed_at", "writer", "batch_id")
    won = claims.groupBy("key", "version").agg(F.min(order).alias("w"))
    return won.select("key", "version", "w.claimed_at", "w.writer", "w.batch_id")


def fired_groups(spark: SparkSession, paths: IngestPaths) -> DataFrame:
    """The claims that fired, one a (group, version)."""
    claims = spark.read.schema(LOCK_LEDGER_DDL).parquet(paths.locks)
    return claims.join(winning_claims(claims), ["key", "version", "claimed_at", "writer", "batch_id"], "left_semi")


def fired_payloads(spark: SparkSession, paths: IngestPaths) -> DataFrame:
    """The payload rows of the claims that fired."""
    won = fired_groups(spark, paths).select(F.col("key").alias("idempotency_group_key"), "version", "writer", "batch_id")
    return spark.read.schema(PAYLOAD_DDL).parquet(paths.payloads).join(won, ["idempotency_group_key", "version", "writer", "batch_id"], "left_semi")


def stored_items(spark: SparkSession, paths: IngestPaths) -> DataFrame:
    """One item a key; of two writers' the smallest (time, writer, batch) counts."""
    items = spark.read.schema(ITEM_LEDGER_DDL).parquet(paths.items)
    own = ["created_at", "writer", "batch_id"]
    first = items.groupBy("key").agg(F.min(F.struct(*own)).alias("w")).select("key", *(f"w.{c}" for c in own))
    return items.join(first, ["key", *own], "left_semi")


def new_versions(items: DataFrame, earlier: DataFrame) -> DataFrame:
    """Groups (client, day) in which ``items`` bring another version of a file that ``earlier`` has, with a number for what changed."""
    group = ["client_name", "event_date"]
    known = earlier.groupBy(*group, "object_key").agg(F.collect_set("etag").alias("etags"))  # the versions of one file
    changed = items.join(known, [*group, "object_key"]).where(~F.array_contains("etags", F.col("etag")))
    return changed.groupBy(*group).agg(F.bit_xor(F.xxhash64("object_key", "etag")).alias("version"))


def process_batch(batch: DataFrame, batch_id: int, paths: IngestPaths, specs: dict,
                  exclusive: bool = True, unwrap: bool = False, refire_on_new_etag: bool = False, writer: str = "main") -> None:
    """One micro-batch: status vs the earlier ledger, write new items, gate
    the touched groups, claim those that are ready, write the payload rows of the claims that win.

    ``refire_on_new_etag`` fires a fired group again when a later batch brings a new
    version of one of its files (another etag for the same object); without it a group fires once.
    """
    spark = batch.sparkSession
    known = sorted(specs)
    own = {"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("bigint")}
    mine = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
    named = lambda ddl: [c.split()[0] for c in ddl.split(", ")]
    # a cache only to avoid re-reading the batch's files in each plan below;
    # every result is the same if it is recomputed
    batch = batch.persist()
    try:
        rows = I.event_rows(batch, known, unwrap).where(F.col("pre_status").isNull())
        days = sorted(r[0] for r in rows.select("event_date").distinct().collect())   # a batch's few days
        earlier = _ledger(spark, paths.items, ITEM_LEDGER_DDL, days).where(~mine)
        status = I.event_status(batch, known, ledger_keys=earlier.select("key"), unwrap=unwrap)
        items = I.received_items(status, created_at=F.col("received_at").cast("string")).withColumns(own)
        _replace_batch(items.select(*named(ITEM_LEDGER_DDL)), paths.items, PARTS)

        ledger = _ledger(spark, paths.items, ITEM_LEDGER_DDL, days)
        added = ledger.where(mine)
        touched = added.groupBy("client_name", "event_date").agg(F.max("created_at").alias("claimed_at"))
        group_items = ledger.join(touched, ["client_name", "event_date"], "left_semi")
        ready = I.readiness_gate(group_items, specs, exclusive=exclusive)
        claims = _ledger(spark, paths.locks, LOCK_LEDGER_DDL, days)
        taken = claims.where(~mine)
        fired = I.fire_once(ready, taken).withColumn("version", F.lit(0).cast("bigint"))
        if refire_on_new_etag:
            again = I.fire_once(ready).join(taken, "key", "left_semi").join(
                new_versions(added, ledger.where(~mine)), ["client_name", "event_date"])
            fired = fired.unionByName(again.join(taken.select("key", "version"), ["key", "version"], "left_anti"))
        claimed = fired.join(touched, ["client_name", "event_date"]).withColumns({"status": F.lit(I.EXECUTION_STARTED), **own})
        _replace_batch(claimed.select(*named(LOCK_LEDGER_DDL)), paths.locks, PARTS)
        won = winning_claims(_ledger(spark, paths.locks, LOCK_LEDGER_DDL, days)).where(mine)
        held = _ledger(spark, paths.locks, LOCK_LEDGER_DDL, days).where(mine).join(won, ["key", "version"], "left_semi")
        payload = I.trigger_payload(held.select("key", "client_name", "event_date"), group_items).join(
            held.select(F.col("key").alias("idempotency_group_key"), "version"), "idempotency_group_key")
        _replace_batch(payload.withColumns(own).select(*named(PAYLOAD_DDL)), paths.payloads, ["writer", "batch_id"])
    finally:
        batch.unpersist()


def compact_ledger(spark: SparkSession, path: str, ddl: str, target: str) -> None:
    """Copy a ledger into ``target`` with one folder per event day and writer (batch id: their smallest).
    Run it while the stream is stopped and start the stream on the copy: folders stop growing with batches."""
    rows = spark.read.schema(ddl).parquet(path)
    least = rows.groupBy("event_date", "writer").agg(F.min("batch_id").alias("least"))
    merged = rows.drop("batch_id").join(least, ["event_date", "writer"]).withColumnRenamed("least", "batch_id")
    columns = [c.split()[0] for c in ddl.split(", ")]
    _replace_batch(merged.select(*columns).hint("rebalance", *PARTS), target, PARTS)


def run_ingest_stream(messages: DataFrame, paths: IngestPaths, specs: dict, checkpoint: str,
                      available_now: bool = True, processing_time: str | None = None, unwrap: bool = False,
                      refire_on_new_etag: bool = False, writer: str = "main") -> StreamingQuery:
    """Start the ingest stream (``availableNow`` drains what is there
    in bounded micro-batches; ``processing_time`` runs continuously)."""
    create_ledgers(messages.sparkSession, paths)
    sink = (messages.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, bid: process_batch(df, bid, paths, specs, unwrap=unwrap,
                                                          refire_on_new_etag=refire_on_new_etag, writer=writer)))
    sink = sink.trigger(availableNow=True) if available_now else sink.trigger(
        processingTime=processing_time or "30 seconds")
    return sink.start()

"""De-duplication against a key ledger with a lifetime (T4): a key counts for ``lifetime`` days after it was stored.

``foreachBatch`` state on tables instead of a state store: ``dedupe_batch`` keeps a record if no record of its key was stored less than
``lifetime`` days before (or after, for messages read out of order) its day of arrival; then it is stored under its own day.  The
ledger is partitioned by (seen_day, batch_id): a batch reads the days around its own as literal partition filters, ``prune_keys`` drops
older ones, so what is kept and read is bounded by the keys of one lifetime, not of all time.  How late the
event itself is plays no part: late records are stored like others.  A replayed batch is judged without its own
entries and writes the same rows again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ferrule.operators import ingest as I
from ferrule.sources.folders import drop_folder, folder_names

LIFETIME_DAYS = 30
KEY_LEDGER_DDL = "key string, seen_day date, batch_id bigint"


@dataclass(frozen=True)
class KeyLedgerPaths:
    keys: str       # (key, seen_day) of stored records, partitioned by (seen_day, batch_id)
    records: str    # the records, partitioned by batch_id


def create_key_ledger(spark: SparkSession, paths: KeyLedgerPaths) -> None:
    spark.createDataFrame([], KEY_LEDGER_DDL).write.mode("append").partitionBy("seen_day", "batch_id").parquet(paths.keys)


def first_days(days: DataFrame, lifetime: int) -> DataFrame:
    """``days`` (key, day, seen: the sorted days stored before): those on which the key is stored.  A day is stored if none of the seen
    days or of those stored before it in this batch lies within the lifetime; a key has at most a row a day here."""
    per_key = days.groupBy("key").agg(F.array_sort(F.collect_set("day")).alias("days"), F.first("seen").alias("seen"))
    near = lambda d, e: F.abs(F.datediff(d, e)) < lifetime
    chosen = F.aggregate("days", F.expr("cast(array() AS array<date>)"), lambda kept, d: F.when(
        F.exists(kept, lambda e: near(d, e)) | F.exists("seen", lambda e: near(d, e)), kept).otherwise(F.array_append(kept, d)))
    return per_key.select("key", F.explode(chosen).alias("seen_day"))


def dedupe_batch(rows: DataFrame, batch_id: int, paths: KeyLedgerPaths, lifetime: int = LIFETIME_DAYS, key: str = "idempotency_key",
                 arrived: str = "received_at", ties: tuple[str, ...] = ("message_id", "rec_idx")) -> None:
    """Store the records of one micro-batch whose keys are new (the first arrival of the day)."""
    spark = rows.sparkSession
    ranked = rows.withColumns({"seen_day": F.to_date(arrived), "__rank": I.arrival_rank(arrived, *ties)}).where(F.col(key).isNotNull())
    ranked = ranked.persist()  # only to parse the batch once; recomputing gives the same
    try:
        firsts = I.first_per_key(ranked, [key, "seen_day"], "__rank")
        span = ranked.agg(F.min("seen_day").alias("lo"), F.max("seen_day").alias("hi")).first()
        if span["lo"] is None:
            return
        inside = F.col("seen_day").between(F.date_sub(F.lit(span["lo"]), lifetime - 1), F.date_add(F.lit(span["hi"]), lifetime - 1))
        ledger = spark.read.schema(KEY_LEDGER_DDL).parquet(paths.keys).where(inside & (F.col("batch_id") != batch_id))
        seen = ledger.groupBy("key").agg(F.collect_set("seen_day").alias("seen"))  # a key has few stored days in two lifetimes
        days = firsts.select(F.col(key).alias("key"), F.col("seen_day").alias("day")).join(seen, "key", "left").withColumn(
            "seen", F.coalesce("seen", F.expr("cast(array() AS array<date>)")))
        stored = first_days(days, lifetime).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        replace = lambda df, path, parts: (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                                           .partitionBy(*parts).parquet(path))
        replace(stored.select("key", "seen_day", "batch_id"), paths.keys, ["seen_day", "batch_id"])
        own = (spark.read.schema(KEY_LEDGER_DDL).parquet(paths.keys).where(inside & (F.col("batch_id") == batch_id))
               .select(F.col("key").alias(key), "seen_day"))
        winners = firsts.join(own, [key, "seen_day"], "left_semi").withColumnRenamed("__first", "__rank")
        out = ranked.join(winners, [key, "seen_day", "__rank"], "left_semi").drop("__rank", "seen_day")
        replace(out.withColumn("batch_id", F.lit(batch_id).cast("bigint")), paths.records, ["batch_id"])
    finally:
        ranked.unpersist()


def prune_keys(spark: SparkSession, paths: KeyLedgerPaths, today: str, lifetime: int = LIFETIME_DAYS) -> int:
    """Drop the ledger's days whose keys have expired by ``today``; the number of days dropped."""
    oldest = spark.range(1).select(F.date_sub(F.lit(today).cast("date"), lifetime - 1).cast("string")).first()[0]
    gone = [d for d in folder_names(spark, paths.keys) if d.startswith("seen_day=") and d.removeprefix("seen_day=") < oldest]
    for d in gone:
        drop_folder(spark, f"{paths.keys}/{d}")
    return len(gone)


def run_dedupe_stream(messages: DataFrame, known_clients: list[str], paths: KeyLedgerPaths, checkpoint: str,
                      lifetime: int = LIFETIME_DAYS, unwrap: bool = False) -> StreamingQuery:
    """T4: valid, known-client records, one a key and lifetime."""
    create_key_ledger(messages.sparkSession, paths)

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = I.event_rows(batch, known_clients, unwrap).where(F.col("pre_status").isNull())
        kept = rows.select("message_id", "rec_idx", "received_at", "idempotency_key", "client_name", "object_key", "file_name",
                           "event_date", "etag", "bucket_name",
                           F.coalesce(F.try_to_timestamp("event_timestamp"), F.col("received_at")).alias("event_ts"))
        dedupe_batch(kept, batch_id, paths, lifetime)

    return messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store).trigger(availableNow=True).start()

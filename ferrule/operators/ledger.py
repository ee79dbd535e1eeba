"""Batch ledger as an append-only table of status events.

The key-value ledger's "update only the supplied attributes" becomes an
append of status events; the current row per key is a fold: latest status by
sequence, and for every attribute its latest non-null value.  The fold is an
ordinary aggregation (partial-aggregated), so hot keys are fine.

On disk a ledger is a snapshot and a tail under one root:

* ``events/chunk=<id>``: one folder an append;
* ``state/<id>``: a snapshot, the folded row of every key with the sequence number behind each of its values;
* ``included/<id>``: the chunks that the snapshot holds.  It is written last, so a snapshot counts once this folder is complete.

``read_ledger`` folds the newest snapshot with the chunks it doesn't hold, whatever their ids, so a chunk that commits late is
not missed; folding an event twice changes nothing.  ``compact`` writes the next snapshot while writers append and readers read;
``prune`` drops what the snapshot before the newest holds already.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrule.sources.folders import drop_folder, folder_names

# --- fixed values: batch lifecycle ------------------------------------------------
BATCH_STATUSES = ("RECEIVED", "RAW_LANDED", "PROCESSED", "LOADED_TO_REDSHIFT", "FAILED")
ERROR_MAX_CHARS = 1000
# ---------------------------------------------------------------------------------


def status_event(key: Column, seq: Column, status: str, updated_at: Column, **attrs: Column) -> Column:
    """One status event as a struct (missing attributes are null)."""
    return F.struct(key.alias("key"), seq.alias("seq"), F.lit(status).alias("status"),
                    updated_at.alias("updated_at"), *[v.alias(k) for k, v in attrs.items()])


def as_state(events: DataFrame, attributes: Sequence[str], key: str = "key", seq: str = "seq") -> DataFrame:
    """Events in the form of folded rows: each value with the sequence number it comes from."""
    n = F.col(seq)
    values = [c for a in attributes for c in (F.col(a), F.when(F.col(a).isNotNull(), n).alias(f"{a}_seq"))]
    return events.select(F.col(key), "status", n.alias("last_seq"), "updated_at", F.col("updated_at").alias("created_at"),
                         n.alias("first_seq"), *values)


def fold_state(state: DataFrame, attributes: Sequence[str], key: str = "key") -> DataFrame:
    """One folded row per key; folding rows again, or twice the same, changes nothing."""
    aggs = [F.max_by("status", "last_seq").alias("status"), F.max_by("updated_at", "last_seq").alias("updated_at"),
            F.min_by("created_at", "first_seq").alias("created_at"), F.max("last_seq").alias("last_seq"), F.min("first_seq").alias("first_seq")]
    for a in attributes:
        # the ordering value is null where the attribute is null, so those rows are skipped
        aggs += [F.max_by(a, f"{a}_seq").alias(a), F.max(f"{a}_seq").alias(f"{a}_seq")]
    return state.groupBy(key).agg(*aggs)


def _shown(state: DataFrame, attributes: Sequence[str], key: str = "key") -> DataFrame:
    return state.select(key, "status", "last_seq", "updated_at", "created_at", *attributes)


def fold_ledger(events: DataFrame, attributes: Sequence[str], key: str = "key", seq: str = "seq") -> DataFrame:
    """Current ledger row per key."""
    return _shown(fold_state(as_state(events, attributes, key, seq), attributes, key), attributes, key)


def short_error(col: Column) -> Column:
    """The first 1000 characters of an error, all that the ledger stores of it."""
    return F.substring(col, 1, ERROR_MAX_CHARS)


def _new_id() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def append_events(events: DataFrame, root: str) -> str:
    """W7 writer: the events as a chunk of their own.  A run that is tried again appends its events again, which the
    fold sees once."""
    chunk = _new_id()
    events.write.parquet(f"{root}/events/chunk={chunk}")
    return chunk


def _read_state(spark: SparkSession, root: str, schema: T.StructType, attributes: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The state not yet folded (newest snapshot and tail), and the chunks in it."""
    chunks = [c.removeprefix("chunk=") for c in folder_names(spark, f"{root}/events", complete=True)]
    snapshots = folder_names(spark, f"{root}/included", complete=True)
    held: set[str] = set()
    if snapshots:
        held = {r["chunk"] for r in spark.read.schema("chunk string").parquet(f"{root}/included/{snapshots[-1]}").collect()}
    tail = [f"{root}/events/chunk={c}" for c in chunks if c not in held]
    events = spark.read.schema(schema).parquet(*tail) if tail else spark.createDataFrame([], schema)
    state = as_state(events, attributes)
    if snapshots:
        state = spark.read.schema(state.schema).parquet(f"{root}/state/{snapshots[-1]}").unionByName(state)
    return state, sorted(held.union(chunks))


def read_ledger(spark: SparkSession, root: str, schema: T.StructType, attributes: Sequence[str]) -> DataFrame:
    """Current ledger row per key, from the newest snapshot and the chunks it does not hold; ``schema`` is that of the events."""
    state, _ = _read_state(spark, root, schema, attributes)
    return _shown(fold_state(state, attributes), attributes)


def compact(spark: SparkSession, root: str, schema: T.StructType, attributes: Sequence[str]) -> str:
    """Write the next snapshot; appends and reads may go on meanwhile."""
    state, chunks = _read_state(spark, root, schema, attributes)
    snapshot = _new_id()
    fold_state(state, attributes).write.parquet(f"{root}/state/{snapshot}")
    spark.createDataFrame([(c,) for c in chunks], "chunk string").coalesce(1).write.parquet(f"{root}/included/{snapshot}")
    return snapshot


def prune(spark: SparkSession, root: str) -> int:
    """Drop the chunks that the last snapshot but one holds (a reader of that snapshot needs none of them), older snapshots, and
    nothing else; the number of chunks dropped."""
    snapshots = folder_names(spark, f"{root}/included", complete=True)
    if len(snapshots) < 2:
        return 0
    held = {f"chunk={r['chunk']}" for r in spark.read.schema("chunk string").parquet(f"{root}/included/{snapshots[-2]}").collect()}
    gone = [c for c in folder_names(spark, f"{root}/events") if c in held]
    for c in gone:
        drop_folder(spark, f"{root}/events/{c}")
    for old in snapshots[:-2]:
        drop_folder(spark, f"{root}/included/{old}")
        drop_folder(spark, f"{root}/state/{old}")
    return len(gone)


def reserve_batches(candidates: DataFrame, ledger: DataFrame, key: str = "key") -> DataFrame:
    """Start only the windows whose batch key is new (J5 on the ledger)."""
    return candidates.join(ledger.select(key).distinct(), key, "left_anti")


def lookback_window(runs: DataFrame, run_date_col: str, lookback_days: int, allowed_start: str,
                    allowed_end: str, max_range_days: int) -> DataFrame:
    """F8 re-aimed over a run calendar: the pull window of every run date,
    whether it is allowed, and why not."""
    end = F.col(run_date_col).cast("date")
    start = F.date_sub(end, lookback_days)
    lo, hi = F.lit(allowed_start).cast("date"), F.lit(allowed_end).cast("date")
    reason = (F.when(~start.between(lo, hi), F.lit("start_outside_window"))
              .when(~end.between(lo, hi), F.lit("end_outside_window"))
              .when(F.datediff(end, start) > max_range_days, F.lit("range_exceeds_max")))
    return runs.select(end.alias("run_date"), start.alias("start_date"), end.alias("end_date"),
                       reason.isNull().alias("is_valid"), reason.alias("reject_reason"))

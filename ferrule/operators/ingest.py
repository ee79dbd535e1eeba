"""Upload-event ingest: parsing, status, dedupe, readiness, fire-once.

Every function is a DataFrame → DataFrame transform, so the same code runs
on a static batch and inside ``foreachBatch`` of the streaming query.
Per-key "first wins" uses an aggregation (partial-aggregated before the
shuffle) joined back on the key — never a window over a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions.clean import client_from_path, event_date_from_ts, execution_lock_key, idempotency_key
from ferrule.operators.lookup import file_type_column
from ferrule.operators.rules import fenced_where

# ``object`` is a map so ``eTag`` and ``etag`` stay distinct keys (struct field
# resolution is case-insensitive).
RECORD_DDL = ("struct<eventSource: string, eventTime: string, s3: struct<bucket: struct<name: string, "
              "arn: string>, object: map<string, string>>>")
BODY_DDL = f"struct<Records: array<{RECORD_DDL}>, Message: string>"

# --- fixed values: row statuses of the event handler -------------------------
PARSE_ERROR = "parse_error"
NO_RECORDS = "ignored_no_nested_records"
INVALID_RECORD = "ignored_invalid_s3_record"
UNKNOWN_CLIENT = "ignored_unknown_client"
DUPLICATE = "duplicate_event"
STORED = "stored"
RECEIVED = "RECEIVED"
EXECUTION_STARTED = "EXECUTION_STARTED"
# ---------------------------------------------------------------------------


def unwrap_body(body: Column) -> Column:
    """A notification-wrapped body carries the event JSON in ``Message``."""
    return F.coalesce(F.get_json_object(body, "$.Message"), body)


def parse_messages(messages: DataFrame, unwrap: bool = False, body_col: str = "body") -> DataFrame:
    """One row per (message, record); messages without records keep one
    row with a null record.  Adds ``parse_ok``, ``rec_idx``, ``record``."""
    body = unwrap_body(F.col(body_col)) if unwrap else F.col(body_col)
    nonempty = F.coalesce(F.length(F.col(body_col)) > 0, F.lit(False))
    parse_ok = ~nonempty | F.json_object_keys(body).isNotNull()
    parsed = F.from_json(body, BODY_DDL)
    m = messages.select("*", parse_ok.alias("parse_ok"),
                        F.when(nonempty & parse_ok, parsed["Records"]).alias("__records"))
    return (m.select(*messages.columns, "parse_ok", F.posexplode_outer("__records").alias("rec_idx", "record")))


def extract_fields(parsed: DataFrame, today: Column | None = None) -> DataFrame:
    """Storage fields of each record, with client / event date / etag rules."""
    rec = F.col("record")
    obj = rec["s3"]["object"]
    key_raw = obj["key"]
    key = F.coalesce(F.try_url_decode(key_raw), key_raw)
    ts = F.coalesce(rec["eventTime"], F.lit(""))
    return parsed.select(
        "*",
        client_from_path(key).alias("client_name"),
        key.alias("object_key"),
        F.substring_index(key, "/", -1).alias("file_name"),
        rec["s3"]["bucket"]["name"].alias("bucket_name"),
        F.coalesce(rec["s3"]["bucket"]["arn"], F.lit("")).alias("bucket_arn"),
        ts.alias("event_timestamp"),
        event_date_from_ts(ts, today).alias("event_date"),
        F.coalesce(obj["eTag"], obj["etag"], F.lit("")).alias("etag"),
        rec["eventSource"].alias("event_source"),
    )


def event_rows(messages: DataFrame, known_clients: list[str], unwrap: bool = False,
               today: Column | None = None) -> DataFrame:
    """Parsed + extracted rows with the pre-dedupe status and idempotency key."""
    x = extract_fields(parse_messages(messages, unwrap), today)
    valid = (F.coalesce(F.length(F.col("record")["s3"]["object"]["key"]) > 0, F.lit(False)) &
             F.coalesce(F.length("bucket_name") > 0, F.lit(False)) & F.col("client_name").isNotNull())
    status = (F.when(~F.col("parse_ok"), F.lit(PARSE_ERROR))
              .when(F.col("record").isNull(), F.lit(NO_RECORDS))
              .when(~valid, F.lit(INVALID_RECORD))
              .when(~F.col("client_name").isin(list(known_clients)), F.lit(UNKNOWN_CLIENT)))
    return x.withColumns({
        "pre_status": status,
        "idempotency_key": F.when(status.isNull(), idempotency_key("client_name", "object_key", "event_date",
                                                                      "etag")),
    })


EARLIEST_MICROS = -62_135_596_800_000_000


def arrival_rank(time: str, *ties: str) -> Column:
    """Arrival order as one decimal(38,0): microseconds (null first), then 63 bits of a hash of ``ties``.

    A decimal is a value that hash aggregation updates in place, so ``min`` of it is combined map-side in hash
    tables, where a struct or string would be sorted.  Rows at the same microsecond come in the order of the hash."""
    micros = F.coalesce(F.unix_micros(F.col(time).cast("timestamp")), F.lit(EARLIEST_MICROS)).cast("decimal(18,0)")
    tie = F.shiftrightunsigned(F.xxhash64(*ties, *(F.col(c).isNull() for c in ties)), 1).cast("decimal(19,0)")
    return (micros * F.lit(str(1 << 63)).cast("decimal(19,0)") + tie).cast("decimal(38,0)")


def first_per_key(rows: DataFrame, key: str | list[str], rank: str) -> DataFrame:
    """Winner per key: the smallest ``rank`` (``arrival_rank``), a hash aggregate with partial results before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    return rows.groupBy(*keys).agg(F.min(rank).alias("__first"))


def event_status(messages: DataFrame, known_clients: list[str], ledger_keys: DataFrame | None = None,
                 unwrap: bool = False, arrival: tuple[str, ...] = ("received_at", "message_id"),
                 today: Column | None = None, staged: str | None = None) -> DataFrame:
    """Q5 + D2: status of every (message, record).

    Records with a valid known client are ``stored`` when they are the first
    arrival of their idempotency key and the key is not already in the ledger
    (J5); later arrivals are ``duplicate_event``.  ``staged``: a folder for the parsed rows; with it
    the messages are read and parsed once, and both the winners and the rows that
    are held against them come from that table, which keeps the bodies of rejected rows only.
    """
    time, *ties = arrival
    rows = event_rows(messages, known_clients, unwrap, today).withColumn("__rank", arrival_rank(time, *ties, "rec_idx"))
    if staged:
        rows = rows.withColumn("body", F.when(F.col("pre_status").isNotNull(), F.col("body")))
        rows.write.mode("overwrite").parquet(staged)
        rows = messages.sparkSession.read.schema(rows.schema).parquet(staged)
    candidates = fenced_where(rows, F.col("pre_status").isNull())
    if ledger_keys is not None:
        seen = ledger_keys.select(F.col("key").alias("idempotency_key")).distinct()
        candidates = candidates.join(seen, "idempotency_key", "left_anti")
    winners = first_per_key(candidates, "idempotency_key", "__rank").withColumnRenamed("idempotency_key", "__jk")
    # rows without a key (parse errors, invalid or unknown records) get a
    # unique, deterministic join key so they spread over partitions instead
    # of all hashing to the null-key partition; such keys match no winner
    join_key = F.coalesce(F.col("idempotency_key"),
                          F.concat(F.lit("\u0000"), F.col("message_id").cast("string"), F.lit("#"),
                                   F.coalesce(F.col("rec_idx").cast("string"), F.lit(""))))
    flagged = (rows.withColumn("__jk", join_key).join(winners, "__jk", "left").drop("__jk"))
    is_first = F.coalesce(F.col("__rank") == F.col("__first"), F.lit(False))
    status = F.coalesce(F.col("pre_status"), F.when(is_first, F.lit(STORED)).otherwise(F.lit(DUPLICATE)))
    return flagged.withColumn("status", status).drop("__first", "__rank")


def received_items(status_rows: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Ledger items (status RECEIVED) for the stored rows."""
    return fenced_where(status_rows, F.col("status") == STORED).select(
        F.col("idempotency_key").alias("key"), "file_name", F.col("event_timestamp").alias("timestamp"), "etag",
        "client_name", "object_key", "bucket_name", "bucket_arn", "event_date", F.lit(RECEIVED).alias("status"),
        (created_at if created_at is not None else F.current_timestamp().cast("string")).alias("created_at"))


def new_keys(candidates: DataFrame, ledger: DataFrame, key: str = "key") -> DataFrame:
    """Candidate rows whose key is not in the ledger yet."""
    return candidates.join(ledger.select(key).distinct(), key, "left_anti")


def first_per_file(items: DataFrame, group: tuple[str, ...] = ("client_name", "event_date", "file_name"),
                   order: tuple[str, ...] = ("timestamp", "key")) -> DataFrame:
    """D3: the earliest item per (client, date, file name)."""
    payload = [c for c in items.columns if c not in group]
    agg = items.groupBy(*group).agg(F.min_by(F.struct(*payload), F.struct(*order)).alias("__item"))
    return agg.select(*group, *[F.col("__item")[c].alias(c) for c in payload])


def latest_per_type(objects: DataFrame, specs: dict, ts_col: str = "last_modified", key_col: str = "key",
                    client_col: str = "client_name", name_col: str = "file_name",
                    exclusive: bool = True) -> DataFrame:
    """The latest object per (client, file type); on equal timestamps the
    first in listing (key) order wins.  A file has the type of its most specific pattern
    or, with ``exclusive=False``, of the first spec in the list that it matches."""
    types = file_type_column(specs, name_col, client_col, exclusive)
    typed = objects.withColumn("file_type", types if exclusive else F.get(types, 0))
    typed = fenced_where(typed, F.col("file_type").isNotNull())
    rank = F.struct((-F.unix_micros(F.col(ts_col).cast("timestamp"))).alias("t"), F.col(key_col).alias("k"))
    payload = [c for c in objects.columns if c != client_col]
    agg = typed.groupBy(client_col, "file_type").agg(F.min_by(F.struct(*payload), rank).alias("__o"))
    return agg.select(client_col, "file_type", *[F.col("__o")[c].alias(c) for c in payload])


def required_types_column(specs: dict, client_col: str = "client_name") -> Column:
    """The sorted required file types of the row's client (a spec constant
    compiled into a map literal; unknown clients get an empty list)."""
    from ferrule.operators.lookup import _spec_items
    per_client: dict[str, list[str]] = {}
    for client, ftype, _, _, _ in _spec_items(specs):
        per_client.setdefault(client, [])
        if ftype not in per_client[client]:
            per_client[client].append(ftype)
    if not per_client:
        return F.array().cast("array<string>")
    literal = F.create_map(*[x for c, types in per_client.items()
                             for x in (F.lit(c), F.array(*[F.lit(t) for t in sorted(types)]))])
    return F.coalesce(F.try_element_at(literal, F.col(client_col)), F.array().cast("array<string>"))


def readiness_gate(items: DataFrame, specs: dict, exclusive: bool = True) -> DataFrame:
    """T5 + D5: per (client, event date) of RECEIVED items, the sorted list of
    required file types nothing satisfies yet, and ``ready`` when none is missing.

    One aggregation: the set of spec types the group's files satisfy.  The
    set is bounded by the number of spec types (non-matching files add
    nothing), and it is combined map-side, so a group holding a third of all
    files is reduced before the shuffle.  The missing list is the client's
    required types minus that set.
    """
    received = items.where(F.col("status") == RECEIVED) if "status" in items.columns else items
    if exclusive:
        have = F.collect_set(file_type_column(specs, "file_name", "client_name", True))
    else:
        have = F.array_distinct(F.flatten(F.collect_set(file_type_column(specs, "file_name", "client_name",
                                                                         False))))
    groups = received.groupBy("client_name", "event_date").agg(have.alias("__have"))
    missing = F.array_sort(F.array_except(required_types_column(specs), F.col("__have")))
    return groups.select("client_name", "event_date", missing.alias("missing_files"),
                         (F.size(missing) == 0).alias("ready"))


def fire_once(ready: DataFrame, lock_ledger: DataFrame | None = None) -> DataFrame:
    """Ready groups whose execution lock is not taken yet, with the lock key."""
    fired = ready.where(F.col("ready")).withColumn("key", execution_lock_key("client_name", "event_date"))
    if lock_ledger is not None:
        fired = fired.join(lock_ledger.select("key").distinct(), "key", "left_anti")
    return fired.select("key", "client_name", "event_date")


def trigger_payload(fired: DataFrame, items: DataFrame) -> DataFrame:
    """T7 in long form: one row per (fired group, distinct file name) with the
    first item's object key and etag, and the group's latest event time as its trigger time
    (from the events, so a replay gives the same).  A consumer orders by file name; no
    group is collected into one array here."""
    firsts = first_per_file(items.select("key", "timestamp", "client_name", "event_date", "file_name",
                                         "object_key", "etag", "bucket_name", "bucket_arn"))
    latest = items.groupBy("client_name", "event_date").agg(F.max("timestamp").alias("trigger_timestamp"))
    return (fired.select(F.col("key").alias("idempotency_group_key"), "client_name", "event_date")
            .join(firsts, ["client_name", "event_date"]).join(latest, ["client_name", "event_date"])
            .select("idempotency_group_key", "client_name", "event_date", "bucket_name", "bucket_arn", "file_name",
                    "object_key", "etag", "trigger_timestamp"))

"""Registered upload-event queries."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from ferrule.functions import clean as C
from ferrule.operators import ingest as I
from ferrule.operators.lookup import _spec_items, match_file_type
from ferrule.oracles import sql_lit, with_fixtures
from ferrule.plans.registry import register
from ferrule.session import scratch_path
from ferrule.sources import fixtures as fx
from ferrule.spec import load_required_files

UP = with_fixtures("upload_final")
LOCK_CUTOFF = "2024-01-05"


@lru_cache(maxsize=None)
def required():
    return load_required_files()


def known_clients():
    return sorted(required())


def statuses(spark, sf, unwrap=False):
    return I.event_status(fx.upload_messages(spark, sf), known_clients(), unwrap=unwrap, staged=scratch_path(spark, "parsed-events"))


_LEDGERS: dict[tuple[str, str], str] = {}


def stored_items(spark, sf):
    """The RECEIVED item ledger of the upload events, written once per
    session to a table in the shared checkpoint folder and read back — the
    gate, lock and payload steps read the ledger table, as in production,
    instead of re-parsing every message in each branch of their plans."""
    from ferrule.streaming.ingest_stream import ITEM_LEDGER_DDL
    key = (spark.sparkContext.applicationId, sf)
    path = _LEDGERS.get(key)
    if path is None:
        path = scratch_path(spark, "item-ledger")
        items = I.received_items(statuses(spark, sf), created_at=F.lit("2024-02-01T00:00:00+00:00"))
        items.write.mode("overwrite").parquet(path)
        _LEDGERS[key] = path
    return spark.read.schema(ITEM_LEDGER_DDL).parquet(path)


def lock_ledger(spark, sf):
    """Execution locks already taken: every known client on the days before the cutoff."""
    days = (fx.read_table(spark, sf, "events", ["ts"]).select(F.date_format("ts", "yyyy-MM-dd").alias("d"))
            .where(F.col("d") < LOCK_CUTOFF).distinct())
    clients = F.explode(F.array(*[F.lit(c) for c in known_clients()])).alias("client_name")
    return days.select("d", clients).select(C.execution_lock_key("client_name", "d").alias("key"))


def sql_file_type(name: str, client: str, specs=None, exclusive=True) -> str:
    """DuckDB CASE giving the spec type of a file name (GLOB matching)."""
    items = _spec_items(specs or required())
    ranked = sorted(items, key=lambda t: (-t[3], t[4]))
    whens = " ".join(f"WHEN {client} = {sql_lit(c)} AND lower({name}) GLOB {sql_lit(p.lower())} THEN {sql_lit(t)}"
                     for c, t, p, _, _ in ranked)
    return f"CASE {whens} END"


OUT_COLS = ["message_id", "rec_idx", "status", "client_name", "object_key", "file_name", "bucket_name",
            "event_date", "etag", "idempotency_key"]


def _record_fields(df):
    rec = F.col("record").isNotNull()
    return df.select("message_id", "rec_idx", "status",
                     *[F.when(rec, F.col(c)).alias(c) for c in OUT_COLS[3:]])


@register("event_status", UP + f"SELECT {', '.join(OUT_COLS)} FROM upload_final", ids=("Q5", "T1", "T3", "J6", "D2"))
def event_status(spark, sf):
    return _record_fields(statuses(spark, sf))


@register("parse_upload_events", UP + """
SELECT message_id, rec_idx, body_kind <> 'broken' AS parse_ok, object_key AS record_key FROM upload_final""",
          ids=("T1",))
def parse_upload_events(spark, sf):
    p = I.parse_messages(fx.upload_messages(spark, sf))
    return p.select("message_id", "rec_idx", "parse_ok",
                    p["record"]["s3"]["object"]["key"].alias("record_key_raw")).select(
        "message_id", "rec_idx", "parse_ok",
        F.coalesce(F.try_url_decode("record_key_raw"), F.col("record_key_raw")).alias("record_key"))


@register("unwrap_notifications", with_fixtures("upload_records") + """
SELECT 'm-' || CAST(event_id AS VARCHAR) AS message_id, object_key
FROM upload_records WHERE body_kind IN ('direct', 'wrapped')""", ids=("T2",))
def unwrap_notifications(spark, sf):
    p = I.extract_fields(I.parse_messages(fx.upload_messages(spark, sf), unwrap=True))
    return p.where(F.col("event_source") == "aws:s3").select("message_id", "object_key")


@register("extract_event_fields", UP + """
SELECT client_name, object_key, file_name, bucket_name, event_date, etag FROM upload_final
WHERE rec_idx IS NOT NULL""", ids=("T3", "P13", "P14"))
def extract_event_fields(spark, sf):
    x = I.extract_fields(I.parse_messages(fx.upload_messages(spark, sf)))
    return x.where(F.col("record").isNotNull()).select("client_name", "object_key", "file_name", "bucket_name",
                                                        "event_date", "etag")


@register("dedupe_events", UP + """
SELECT idempotency_key, message_id, client_name, object_key, event_date, etag FROM upload_final
WHERE status = 'stored'""", ids=("D2",))
def dedupe_events(spark, sf):
    s = statuses(spark, sf)
    return s.where(F.col("status") == I.STORED).select("idempotency_key", "message_id", "client_name",
                                                       "object_key", "event_date", "etag")


@register("idempotency_keys", UP + """
SELECT idempotency_key, 'execution_lock|' || client_name || '|' || event_date AS lock_key FROM upload_final
WHERE status = 'stored'""", ids=("P15",))
def idempotency_keys(spark, sf):
    s = statuses(spark, sf).where(F.col("status") == I.STORED)
    return s.select(C.idempotency_key("client_name", "object_key", "event_date", "etag").alias("idempotency_key"),
                    C.execution_lock_key("client_name", "event_date").alias("lock_key"))


@register("canonical_file_name", with_fixtures("upload_records") + """
SELECT key_raw, regexp_replace(lower(trim(file_name)), '\\.csv$', '') AS canonical_name FROM upload_records""",
          ids=("P12",))
def canonical_file_name(spark, sf):
    f = fx.upload_event_fields(spark, sf)
    return f.select("key_raw", C.canonical_file_name("key_raw").alias("canonical_name"))


@register("client_from_path", with_fixtures("upload_records") + """
SELECT object_key, CASE WHEN misc_folder THEN NULL ELSE client_raw END AS client_name FROM upload_records""",
          ids=("P13",))
def client_from_path(spark, sf):
    f = fx.upload_event_fields(spark, sf)
    key = F.coalesce(F.try_url_decode("key_raw"), F.col("key_raw"))
    return f.select(key.alias("object_key"), C.client_from_path(key).alias("client_name"))


@register("event_date", with_fixtures("upload_records") + """
SELECT event_time, strftime(ts, '%Y-%m-%d') AS event_date FROM upload_records""", ids=("P14",))
def event_date(spark, sf):
    f = fx.upload_event_fields(spark, sf)
    return f.select("event_time", C.event_date_from_ts("event_time").alias("event_date"))


@register("match_file_type", UP + f"""
SELECT client_name, file_name, ft AS file_type FROM (
  SELECT client_name, file_name, {sql_file_type("file_name", "client_name")} AS ft
  FROM upload_final WHERE status = 'stored') x WHERE ft IS NOT NULL""", ids=("J7", "D6", "K12"))
def match_file_type_q(spark, sf):
    s = stored_items(spark, sf).select("client_name", "file_name")
    return match_file_type(s, required())


def _sql_readiness(exclusive=True) -> str:
    if exclusive:
        typed = f"SELECT client_name, event_date, {sql_file_type('file_name', 'client_name')} AS file_type FROM upload_final WHERE status = 'stored'"
    else:
        items = _spec_items(required())
        typed = " UNION ALL ".join(
            f"SELECT client_name, event_date, {sql_lit(t)} AS file_type FROM upload_final WHERE status = 'stored' "
            f"AND client_name = {sql_lit(c)} AND lower(file_name) GLOB {sql_lit(p.lower())}" for c, t, p, _, _ in items)
    req = " UNION ALL ".join(f"SELECT {sql_lit(c)} AS client_name, {sql_lit(t)} AS file_type"
                             for c, t in dict.fromkeys((c, t) for c, t, _, _, _ in _spec_items(required())))
    return UP.rstrip("\n") + f""",
groups AS (SELECT DISTINCT client_name, event_date FROM upload_final WHERE status = 'stored'),
satisfied AS (SELECT DISTINCT * FROM ({typed}) t WHERE file_type IS NOT NULL),
req AS ({req}),
missing AS (SELECT g.client_name, g.event_date, r.file_type FROM groups g JOIN req r ON g.client_name = r.client_name
            WHERE NOT EXISTS (SELECT 1 FROM satisfied s WHERE s.client_name = g.client_name
                              AND s.event_date = g.event_date AND s.file_type = r.file_type)),
readiness AS (
  SELECT g.client_name, g.event_date, COALESCE(string_agg(m.file_type, ',' ORDER BY m.file_type), '') AS missing_files,
         count(m.file_type) = 0 AS ready
  FROM groups g LEFT JOIN missing m ON g.client_name = m.client_name AND g.event_date = m.event_date
  GROUP BY g.client_name, g.event_date)
"""


def _readiness(spark, sf, exclusive=True):
    return I.readiness_gate(stored_items(spark, sf), required(), exclusive=exclusive)


@register("readiness_gate", _sql_readiness() + "SELECT * FROM readiness", ids=("T5", "D5", "K12"))
def readiness_gate(spark, sf):
    r = _readiness(spark, sf)
    return r.select("client_name", "event_date", F.array_join("missing_files", ",").alias("missing_files"), "ready")


@register("readiness_gate_nonexclusive", _sql_readiness(False) + "SELECT * FROM readiness", ids=("T5", "K12"))
def readiness_gate_nonexclusive(spark, sf):
    r = _readiness(spark, sf, exclusive=False)
    return r.select("client_name", "event_date", F.array_join("missing_files", ",").alias("missing_files"), "ready")


@register("missing_files", _sql_readiness() + "SELECT client_name, event_date, missing_files FROM readiness WHERE NOT ready",
          ids=("D5",))
def missing_files(spark, sf):
    r = _readiness(spark, sf).where(~F.col("ready"))
    return r.select("client_name", "event_date", F.array_join("missing_files", ",").alias("missing_files"))


FIRED_SQL = f"""
fired AS (SELECT 'execution_lock|' || client_name || '|' || event_date AS key, client_name, event_date
          FROM readiness WHERE ready AND event_date >= '{LOCK_CUTOFF}')
"""


@register("fire_once", _sql_readiness().rstrip("\n") + "," + FIRED_SQL + "SELECT * FROM fired", ids=("T6", "J5"))
def fire_once(spark, sf):
    return I.fire_once(_readiness(spark, sf), lock_ledger(spark, sf))


@register("trigger_payload", _sql_readiness().rstrip("\n") + "," + FIRED_SQL + """,
firsts AS (
  SELECT client_name, event_date, file_name, object_key, etag, bucket_name FROM (
    SELECT *, row_number() OVER (PARTITION BY client_name, event_date, file_name
                                 ORDER BY event_time, idempotency_key) AS rn
    FROM upload_final WHERE status = 'stored') x WHERE rn = 1)
SELECT f.key AS idempotency_group_key, f.client_name, f.event_date, i.bucket_name,
       'arn:aws:s3:::' || i.bucket_name AS bucket_arn, i.file_name, i.object_key, i.etag,
       (SELECT max(u.event_time) FROM upload_final u WHERE u.status = 'stored' AND u.client_name = f.client_name
          AND u.event_date = f.event_date) AS trigger_timestamp
FROM fired f JOIN firsts i ON f.client_name = i.client_name AND f.event_date = i.event_date""",
          ids=("T7", "D3"))
def trigger_payload(spark, sf):
    fired = I.fire_once(_readiness(spark, sf), lock_ledger(spark, sf))
    return I.trigger_payload(fired, stored_items(spark, sf))


@register("first_per_file", UP + """
SELECT client_name, event_date, file_name, object_key, etag FROM (
  SELECT *, row_number() OVER (PARTITION BY client_name, event_date, file_name ORDER BY event_time, idempotency_key) AS rn
  FROM upload_final WHERE status = 'stored') x WHERE rn = 1""", ids=("D3",))
def first_per_file(spark, sf):
    f = I.first_per_file(stored_items(spark, sf))
    return f.select("client_name", "event_date", "file_name", "object_key", "etag")


@register("latest_per_type", UP + f"""
SELECT client_name, file_type, key, last_modified FROM (
  SELECT *, row_number() OVER (PARTITION BY client_name, file_type ORDER BY last_modified DESC, key ASC) AS rn
  FROM (SELECT client_name, object_key AS key, event_time AS last_modified,
               {sql_file_type("file_name", "client_name")} AS file_type
        FROM upload_final WHERE status = 'stored') a WHERE file_type IS NOT NULL) x WHERE rn = 1""", ids=("D4",))
def latest_per_type(spark, sf):
    items = stored_items(spark, sf)
    objects = items.select("client_name", F.col("object_key").alias("key"), "file_name",
                           F.col("timestamp").alias("last_modified"))
    out = I.latest_per_type(objects, required())
    return out.select("client_name", "file_type", "key", "last_modified")


FIRST_MATCH = {"alpha": [{"file_type": "anything", "patterns": ["creator*"]},
                         {"file_type": "orders", "patterns": ["creator_alpha_orders*"]}],
               "gamma": [{"file_type": "rest", "patterns": ["*"]}]}


@register("latest_per_type_first_match", UP + """
SELECT client_name, file_type, key, last_modified FROM (
  SELECT *, row_number() OVER (PARTITION BY client_name, file_type ORDER BY last_modified DESC, key ASC) AS rn
  FROM (SELECT client_name, object_key AS key, event_time AS last_modified,
               CASE WHEN client_name = 'alpha' AND lower(file_name) LIKE 'creator%' THEN 'anything'
                    WHEN client_name = 'gamma' THEN 'rest' END AS file_type
        FROM upload_final WHERE status = 'stored') a WHERE file_type IS NOT NULL) x WHERE rn = 1""", ids=("D4", "K12"))
def latest_per_type_first_match(spark, sf):
    """The older rule: a file has the type of the first spec in the list that it matches."""
    objects = stored_items(spark, sf).select("client_name", F.col("object_key").alias("key"), "file_name",
                                             F.col("timestamp").alias("last_modified"))
    return I.latest_per_type(objects, FIRST_MATCH, exclusive=False).select("client_name", "file_type", "key", "last_modified")


@register("ledger_new_keys", UP + f"""
SELECT idempotency_key AS key FROM upload_final WHERE status = 'stored'
  AND NOT (event_date < '{LOCK_CUTOFF}' AND etag IN ('1', '2', '3'))""", ids=("J5", "W8"))
def ledger_new_keys(spark, sf):
    """Keys of this run not already recorded by an earlier run's ledger."""
    items = stored_items(spark, sf)
    earlier = items.where((F.col("event_date") < LOCK_CUTOFF) & F.col("etag").isin("1", "2", "3")).select("key")
    return I.new_keys(items.select("key"), earlier)

"""Upload-event handling on hand-written messages."""

from pyspark.sql import functions as F

from ferrule.operators import ingest as I
from ferrule.spec import load_required_files

SPECS = load_required_files()


def msg(key, etag="e1", bucket="b", t="2024-01-02T00:00:00Z", etag_field="eTag"):
    return ('{"Records":[{"eventSource":"aws:s3","eventTime":"%s","s3":{"bucket":{"name":"%s"},'
            '"object":{"key":"%s","%s":"%s"}}}]}' % (t, bucket, key, etag_field, etag))


def test_event_status_cases(spark):
    rows = [
        ("m1", '{"Records": [ broken', 1),
        ("m2", '{"Records": []}', 2),
        ("m3", msg("misc/alpha/x.csv"), 3),
        ("m4", msg("raw/client_uploads/delta/x.csv"), 4),
        ("m5", msg("raw/client_uploads/alpha/creator+alpha%5Forders.csv"), 5),
        ("m6", msg("raw/client_uploads/alpha/creator+alpha%5Forders.csv"), 6),
        ("m7", msg("raw/client_uploads/alpha/creator_alpha_codes.csv", etag_field="etag"), 7),
        ("m8", '{"Message": "{\\"Records\\": []}"}', 8),
        ("m9", "", 9),
    ]
    df = spark.createDataFrame(rows, "message_id string, body string, n int").withColumn(
        "received_at", F.col("n").cast("timestamp"))
    out = {r.message_id: r for r in I.event_status(df, sorted(SPECS)).collect()}
    assert out["m1"].status == I.PARSE_ERROR
    assert out["m2"].status == I.NO_RECORDS
    assert out["m3"].status == I.INVALID_RECORD
    assert out["m4"].status == I.UNKNOWN_CLIENT
    assert out["m5"].status == I.STORED and out["m5"].file_name == "creator alpha_orders.csv"
    assert out["m6"].status == I.DUPLICATE
    assert out["m7"].status == I.STORED and out["m7"].etag == "e1"
    assert out["m8"].status == I.NO_RECORDS
    assert out["m9"].status == I.NO_RECORDS


def test_ledger_keys_make_duplicates(spark):
    df = spark.createDataFrame([("m1", msg("raw/client_uploads/beta/creator_beta_sales.csv"), 1)],
                               "message_id string, body string, n int").withColumn("received_at",
                                                                                   F.col("n").cast("timestamp"))
    key = "beta|raw/client_uploads/beta/creator_beta_sales.csv|2024-01-02|e1"
    ledger = spark.createDataFrame([(key,)], "key string")
    assert I.event_status(df, sorted(SPECS), ledger_keys=ledger).first().status == I.DUPLICATE


def items(spark, rows):
    return spark.createDataFrame(rows, "client_name string, event_date string, file_name string, status string")


def test_readiness_exclusive_fixes_k12(spark):
    it = items(spark, [("gamma", "d1", "salesforce_data_client3.csv", "RECEIVED"),
                       ("alpha", "d1", "creator_alpha_orders.csv", "RECEIVED"),
                       ("alpha", "d1", "CREATOR_ALPHA_CODES.CSV", "RECEIVED")])
    excl = {(r.client_name, r.event_date): (r.ready, r.missing_files) for r in I.readiness_gate(it, SPECS).collect()}
    assert excl[("gamma", "d1")] == (False, ["sales"])
    assert excl[("alpha", "d1")] == (True, [])
    loose = {(r.client_name, r.event_date): r.ready for r in I.readiness_gate(it, SPECS, exclusive=False).collect()}
    assert loose[("gamma", "d1")] is True    # the old rule: one file satisfies both specs


def test_fire_once_skips_taken_locks(spark):
    ready = spark.createDataFrame([("alpha", "d1", True), ("beta", "d1", True), ("gamma", "d1", False)],
                                  "client_name string, event_date string, ready boolean")
    locks = spark.createDataFrame([("execution_lock|alpha|d1",)], "key string")
    fired = [r.key for r in I.fire_once(ready, locks).collect()]
    assert fired == ["execution_lock|beta|d1"]


def test_latest_per_type_tie_goes_to_first_key(spark):
    objs = spark.createDataFrame([
        ("alpha", "raw/client_uploads/alpha/b_orders.csv", "b_orders.csv", "2024-01-02 00:00:00"),
        ("alpha", "raw/client_uploads/alpha/a_orders.csv", "a_orders.csv", "2024-01-02 00:00:00"),
        ("alpha", "raw/client_uploads/alpha/c_orders.csv", "c_orders.csv", "2024-01-01 00:00:00")],
        "client_name string, key string, file_name string, last_modified string")
    r = I.latest_per_type(objs, SPECS).collect()
    assert [(x.file_type, x.file_name) for x in r] == [("orders", "a_orders.csv")]

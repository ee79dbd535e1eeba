"""Stream de-duplication with a lifetime per key."""

import datetime as dt

from ferrule.session import scratch_path
from ferrule.sources.folders import folder_names
from ferrule.streaming.key_ledger import (KEY_LEDGER_DDL, KeyLedgerPaths, create_key_ledger, dedupe_batch, first_days,
                                          prune_keys)

T = lambda day, hour=0: dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=day)


def _paths(spark):
    paths = KeyLedgerPaths(scratch_path(spark, "t-keys"), scratch_path(spark, "t-records"))
    create_key_ledger(spark, paths)
    return paths


def _batch(spark, *rows):
    """(key, message, arrival, event time)"""
    return spark.createDataFrame([(k, m, 0, at, ts) for k, m, at, ts in rows],
                                 "idempotency_key string, message_id string, rec_idx int, received_at timestamp, event_ts timestamp")


def _stored(spark, paths):
    return sorted(r.message_id for r in spark.read.parquet(paths.records).collect())


def test_a_key_counts_for_its_lifetime_and_late_rows_stay(spark):
    paths = _paths(spark)
    dedupe_batch(_batch(spark, ("a", "m1", T(0, 5), T(0)), ("a", "m0", T(0, 3), T(0)), ("b", "m2", T(0), T(-40))), 0, paths)
    assert _stored(spark, paths) == ["m0", "m2"]  # the first arrival of a; b's event is 40 days late and stored
    dedupe_batch(_batch(spark, ("a", "m3", T(29), T(0)), ("c", "m4", T(29), T(-11))), 1, paths)
    assert _stored(spark, paths) == ["m0", "m2", "m4"]
    dedupe_batch(_batch(spark, ("a", "m5", T(30), T(30)), ("a", "m6", T(31), T(30))), 2, paths)
    assert _stored(spark, paths) == ["m0", "m2", "m4", "m5"]  # the key has expired, then counts again


def test_replays_and_messages_out_of_order(spark):
    paths = _paths(spark)
    late = _batch(spark, ("a", "m1", T(10), T(10)))
    for _ in range(2):
        dedupe_batch(late, 0, paths)
    dedupe_batch(_batch(spark, ("a", "m0", T(5), T(5)), (None, "m9", T(5), T(5))), 1, paths)
    dedupe_batch(late, 0, paths)
    assert _stored(spark, paths) == ["m1"]
    dedupe_batch(_batch(spark), 2, paths)
    assert _stored(spark, paths) == ["m1"]


def test_one_batch_may_span_several_lifetimes(spark):
    paths = _paths(spark)
    rows = [("a", f"m{d:03d}", T(d), T(d)) for d in range(0, 100, 5)]
    dedupe_batch(_batch(spark, *rows), 0, paths)
    assert _stored(spark, paths) == ["m000", "m030", "m060", "m090"]


def test_state_is_bounded_by_the_lifetime(spark):
    paths = _paths(spark)
    held = []
    for k, day in enumerate(range(0, 120, 10)):
        dedupe_batch(_batch(spark, *((f"k{day}-{i}", f"m{day}-{i}", T(day), T(day)) for i in range(5))), k, paths)
        prune_keys(spark, paths, str(T(day).date()))
        held.append(spark.read.schema(KEY_LEDGER_DDL).parquet(paths.keys).count())
    assert max(held) <= 15 and held[-1] == 15  # three batches lie within 30 days; 60 keys went by
    assert len([f for f in folder_names(spark, paths.keys) if f.startswith("seen_day=")]) == 3
    dedupe_batch(_batch(spark, ("k110-0", "again", T(111), T(0))), 99, paths)
    assert "again" not in _stored(spark, paths)


def test_first_days_equal_a_plain_walk(spark):
    import random
    draw, rows, want = random.Random(3), [], set()
    for k in range(60):
        days = sorted(draw.sample(range(60), draw.randint(1, 12)))
        seen = draw.sample(range(60), draw.randint(0, 1))
        kept = list(seen)
        for d in days:
            if all(abs(d - e) >= 7 for e in kept):
                kept.append(d)
                want.add((str(k), T(d).date()))
        rows += [(str(k), T(d).date(), [T(e).date() for e in seen]) for d in days]
    got = first_days(spark.createDataFrame(rows, "key string, day date, seen array<date>"), 7)
    assert {tuple(r) for r in got.collect()} == want

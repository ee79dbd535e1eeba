"""The batch ledger on disk: snapshot and tail."""

from pyspark.sql import functions as F

from ferrule.operators import ledger as L
from ferrule.session import scratch_path
from ferrule.sources.folders import folder_names

ATTRS = ["raw_key", "rows"]
DDL = "key string, seq int, status string, updated_at string, raw_key string, rows long"


def _events(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


FIRST = [("a", 1, "RECEIVED", "t1", None, None), ("b", 1, "RECEIVED", "t1", "k/b", None), ("a", 2, "RAW_LANDED", "t2", "k/a", None)]
SECOND = [("a", 3, "PROCESSED", "t3", None, 7), ("c", 1, "RECEIVED", "t3", None, None)]
LATE = [("b", 2, "FAILED", "t2", None, 3)]
ALL = {"a": ("PROCESSED", 3, "t3", "t1", "k/a", 7), "b": ("FAILED", 2, "t2", "t1", "k/b", 3), "c": ("RECEIVED", 1, "t3", "t3", None, None)}


def _rows(df):
    return {r["key"]: tuple(r)[1:] for r in df.collect()}


def test_snapshot_and_tail_equal_the_whole_fold(spark):
    root = scratch_path(spark, "t-ledger")
    schema = _events(spark, *FIRST).schema
    assert _rows(L.read_ledger(spark, root, schema, ATTRS)) == {}
    L.append_events(_events(spark, *FIRST), root)
    L.compact(spark, root, schema, ATTRS)
    L.append_events(_events(spark, *SECOND), root)
    L.append_events(_events(spark, *SECOND), root)  # a retried run
    L.append_events(_events(spark, *LATE), root)
    assert _rows(L.read_ledger(spark, root, schema, ATTRS)) == ALL == _rows(L.fold_ledger(_events(spark, *FIRST, *SECOND, *LATE), ATTRS))
    L.compact(spark, root, schema, ATTRS)
    assert _rows(L.read_ledger(spark, root, schema, ATTRS)) == ALL


def test_old_chunks_are_not_scanned(spark):
    root = scratch_path(spark, "t-ledger")
    schema = _events(spark, *FIRST).schema
    old = L.append_events(_events(spark, *FIRST), root)
    snapshot = L.compact(spark, root, schema, ATTRS)
    new = L.append_events(_events(spark, *SECOND), root)
    read = {f.rsplit("/", 2)[1] for f in L.read_ledger(spark, root, schema, ATTRS).inputFiles()}
    assert read == {snapshot, f"chunk={new}"} and f"chunk={old}" not in read


def test_a_chunk_that_commits_after_the_snapshot_is_not_missed(spark, monkeypatch):
    """Its id is older than the snapshot's, its folder appears later."""
    root = scratch_path(spark, "t-ledger")
    schema = _events(spark, *FIRST).schema
    early = L._new_id()
    L.append_events(_events(spark, *FIRST), root)
    L.append_events(_events(spark, *SECOND), root)
    L.compact(spark, root, schema, ATTRS)
    with monkeypatch.context() as m:
        m.setattr(L, "_new_id", lambda: early)
        L.append_events(_events(spark, *LATE), root)
    assert _rows(L.read_ledger(spark, root, schema, ATTRS)) == ALL


def test_readers_go_on_while_a_snapshot_is_made(spark, monkeypatch):
    root = scratch_path(spark, "t-ledger")
    schema = _events(spark, *FIRST).schema
    for rows in (FIRST, SECOND):
        L.append_events(_events(spark, *rows), root)
        L.compact(spark, root, schema, ATTRS)
    held = L.read_ledger(spark, root, schema, ATTRS)
    L.append_events(_events(spark, *LATE), root)
    # a snapshot without its list of chunks is not there yet
    state, _ = L._read_state(spark, root, schema, ATTRS)
    L.fold_state(state, ATTRS).where(F.lit(False)).write.parquet(f"{root}/state/{L._new_id()}")
    assert _rows(L.read_ledger(spark, root, schema, ATTRS)) == ALL
    L.compact(spark, root, schema, ATTRS)
    assert L.prune(spark, root) == 2  # the chunks that the snapshot before the newest holds
    assert set(_rows(held)) == {"a", "b", "c"}  # a reader of that snapshot still reads
    assert _rows(L.read_ledger(spark, root, schema, ATTRS)) == ALL
    assert len(folder_names(spark, f"{root}/included")) == 2

"""Sinks: counts seen by the write, files landed as objects, manifests joined to the scan."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrule.session import scratch_path
from ferrule.sources import sinks as S
from tests.plan_utils import plan_text

D = dt.date


def _dated(spark):
    rows = [(k, None if k % 5 == 0 else D(2024, 1, 1 + k % 3)) for k in range(100)]
    return spark.createDataFrame(rows, "x int, order_date date").repartition(4)


def test_the_write_counts_what_it_drops(spark):
    path = scratch_path(spark, "t-counts")
    counts = S.write_partitioned_by_date(_dated(spark), path)
    assert counts == {"rows_in": 100, "rows_written": 80, "undated": 20, "first_date": "2024-01-01", "last_date": "2024-01-03"}
    assert spark.read.parquet(path).count() == 80
    none = S.write_partitioned_by_date(_dated(spark).where("x < 0"), scratch_path(spark, "t-counts"))
    assert none["rows_in"] == none["undated"] == 0 and none["first_date"] is None


def test_lineage_of_one_write(spark):
    path, lineage = scratch_path(spark, "t-batch"), scratch_path(spark, "t-lineage")
    reads = spark.sparkContext.accumulator(0)
    rows = _dated(spark).withColumnRenamed("order_date", "date")

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    row = S.write_batch_with_lineage(rows.mapInArrow(seen, rows.schema), path, lineage, {"batch_id": "F#1#2", "run_id": "r"})
    assert reads.value == 100  # one pass over the load
    got = spark.read.json(lineage).drop("batch").collect()[0].asDict()
    assert got == row == {"batch_id": "F#1#2", "run_id": "r", "window_start": "2024-01-01", "window_end": "2024-01-03", "rows_in": 100,
                          "rows_written": 80, "undated": 20}


def test_the_split_counts_by_reason(spark):
    df = spark.createDataFrame([(1, []), (2, ["a", "b"]), (3, []), (4, ["b"])], "x int, quarantine_reasons array<string>")
    counts = S.write_split(df, scratch_path(spark, "t-split"), reasons=("a", "b", "c"))
    assert counts == {"rows_in": 4, "good": 2, "bad": 2, "a": 1, "b": 2, "c": 0}


def test_objects_are_landed_unchanged(spark, tmp_path):
    files = {"crlf.csv": b"a,b\r\n1,2\r\n", "open.csv": b"a,b\n1,2", "empty.csv": b"", "raw.csv": bytes(range(256)), "sub/x y.csv": b"\n\n"}
    for name, data in files.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(data)
    (tmp_path / "in" / "skip.txt").write_text("no")
    dest = scratch_path(spark, "t-objects")
    for _ in range(2):
        told = S.land_objects(spark, str(tmp_path / "in"), dest, "*.csv")
    rows = {r.source_key.split("/in/")[1].replace("%20", " "): r for r in S.read_objects(spark, dest).collect()}
    assert {k: bytes(r.content) for k, r in rows.items()} == files
    assert all(r.length == len(files[k]) and r.sha256 == hashlib.sha256(files[k]).hexdigest() for k, r in rows.items())
    assert told.count() == len(files) and "content" not in told.columns


def test_manifest_rows_are_joined_not_listed(spark, monkeypatch):
    path, schema = scratch_path(spark, "t-manifest-rows"), T.StructType([T.StructField("x", T.IntegerType())])
    rows = spark.range(60).select(F.col("id").cast("int").alias("x"), (F.col("id") % 6).cast("string").alias("day"))
    rows.repartition("day").write.partitionBy("day").parquet(path)
    files = S.files_written_since(spark, path, "1970-01-01 00:00:00").where("url LIKE '%day=1/%' OR url LIKE '%day=4/%'")
    manifest = scratch_path(spark, "t-manifest-entries")
    S.write_manifest(spark, files, manifest)
    entries = S.read_manifest_entries(spark, manifest)
    out = S.read_manifest_rows(spark, path, entries, schema, ("day",))
    assert sorted(r.x for r in out.collect()) == [k for k in range(60) if k % 6 in (1, 4)]
    assert "dynamicpruning" in plan_text(out).lower()
    assert S.read_manifest_rows(spark, path, entries.where("false"), schema, ("day",)).count() == 0

"""Publishing: the catalog fact refresh clears months left empty inside a
load's range; common cleaning keeps large amounts intact."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrule.plans.client_load import common_cleaning
from ferrule.session import scratch_path
from ferrule.sources import sinks as S
from ferrule.sources import versioned as V

D = dt.date
FACT = "discount_code string, orders bigint, revenue double, order_date date, client_name string"
SCHEMA = T.StructType([T.StructField("discount_code", T.StringType()), T.StructField("orders", T.LongType()),
                       T.StructField("revenue", T.DoubleType()), T.StructField("order_date", T.DateType()),
                       T.StructField("client_name", T.StringType()), T.StructField("month", T.StringType())])


def test_refresh_table_clears_emptied_month(spark):
    existing = [
        ("a", 1, 1.0, D(2024, 1, 10), "alpha"), ("a", 1, 2.0, D(2024, 2, 10), "alpha"),
        ("a", 1, 3.0, D(2024, 3, 10), "alpha"), ("a", 1, 4.0, D(2024, 2, 10), "beta"),
        ("a", 1, 5.0, None, "alpha")]
    name = _fact(spark, existing)
    load = spark.createDataFrame([("n", 9, 9.0, D(2024, 1, 5), "alpha"), ("n", 9, 9.5, D(2024, 3, 20), "alpha")],
                                 FACT)
    S.refresh_table_by_load(spark, name, load, scratch_path(spark, "t-fact-scratch"))
    got = sorted((r.client_name, str(r.order_date), r.revenue) for r in spark.table(name).collect())
    # alpha's February (inside 01-05..03-20, no new rows) is gone; beta and undated rows stay
    assert got == sorted([("alpha", "2024-01-05", 9.0), ("alpha", "2024-03-20", 9.5), ("alpha", "None", 5.0),
                          ("beta", "2024-02-10", 4.0)])
    # refreshing again with the same load changes nothing
    S.refresh_table_by_load(spark, name, load, scratch_path(spark, "t-fact-scratch"))
    assert sorted((r.client_name, str(r.order_date), r.revenue) for r in spark.table(name).collect()) == got


def test_common_cleaning_keeps_large_amounts(spark):
    df = spark.createDataFrame([(" $12,345,678.90 ",), ("€1,000",)], "subtotal_price_raw string")
    cfg = {"numeric_cleaning": {"target_columns": ["subtotal_price_raw"], "remove_currency_symbols": True,
                                "remove_thousands_separators": True}}
    out = [r[0] for r in common_cleaning(df, cfg).collect()]
    assert out == ["12345678.90", "1000"]
    parsed = common_cleaning(df, cfg).selectExpr(
        "TRY_CAST(regexp_replace(trim(subtotal_price_raw), '[^0-9.\\\\-]', '') AS DOUBLE) AS v").collect()
    assert [r.v for r in parsed] == [12345678.9, 1000.0]


def test_manifest_formats(spark):
    import json
    import os
    from ferrule.session import scratch_path
    doc_dir = scratch_path(spark, "t-manifest-doc").replace("file:", "")
    os.makedirs(doc_dir, exist_ok=True)
    with open(os.path.join(doc_dir, "m.json"), "w") as fh:
        json.dump({"entries": [{"url": "s3://b/p/1.parquet", "mandatory": True},
                               {"url": "s3://b/p/2.parquet", "mandatory": True}]}, fh, indent=2)
    doc = S.read_manifest_entries(spark, doc_dir, multiline_document=True)
    assert sorted(r.url for r in doc.collect()) == ["s3://b/p/1.parquet", "s3://b/p/2.parquet"]
    lines = scratch_path(spark, "t-manifest-lines")
    S.write_manifest(spark, doc, lines)
    assert sorted(r.url for r in S.read_manifest_entries(spark, lines).collect()) == [
        "s3://b/p/1.parquet", "s3://b/p/2.parquet"]
    empty = scratch_path(spark, "t-manifest-empty")
    S.write_manifest(spark, doc.where("false"), empty)
    try:
        S.read_manifest_entries(spark, empty)
        raise AssertionError("empty manifest accepted")
    except ValueError:
        pass


def _fact(spark, rows):
    name = f"t_fact_{uuid.uuid4().hex[:8]}"
    V.create(spark, name, SCHEMA, scratch_path(spark, "t-fact"), ["client_name", "month"])
    V.publish(spark, name, spark.createDataFrame(rows, FACT).withColumn("month", F.date_format("order_date", "yyyy-MM")), lambda sets: sets)
    return name


def _rows(spark, name):
    return sorted((str(r.client_name), str(r.order_date), r.revenue) for r in spark.table(name).collect())


OLD = [("a", 1, 1.0, D(2024, 1, 10), "alpha"), ("a", 1, 2.0, D(2024, 2, 10), "alpha"), ("a", 1, 3.0, D(2024, 3, 10), "alpha"),
       ("a", 1, 4.0, D(2024, 2, 10), "beta"), ("a", 1, 5.0, None, "alpha"), ("a", 1, 6.0, D(2024, 2, 1), None), ("a", 1, 7.0, D(2024, 2, 1), "it's")]
NEW = [("n", 9, 9.0, D(2024, 1, 5), "alpha"), ("n", 9, 9.5, D(2024, 3, 20), "alpha"), ("n", 9, 8.0, None, "beta"), ("n", 9, 6.5, D(2024, 2, 9), None)]
SEEN = sorted([("alpha", "2024-01-05", 9.0), ("alpha", "2024-03-20", 9.5), ("alpha", "None", 5.0), ("beta", "2024-02-10", 4.0), ("beta", "None", 8.0),
               ("None", "2024-02-01", 6.0), ("None", "2024-02-09", 6.5), ("it's", "2024-02-01", 7.0)])


def test_readers_see_the_old_set_until_the_commit(spark, monkeypatch):
    """A failure before the one committing statement leaves readers where they were; the retry publishes all."""
    name = _fact(spark, OLD)
    before, load = _rows(spark, name), spark.createDataFrame(NEW, FACT)
    held = spark.table(name)  # a reader whose plan is older than the publish

    def fail(*_):
        assert _rows(spark, name) == before  # all data is written, none of it is seen
        raise OSError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(V, "_point", fail)
        with pytest.raises(OSError):
            S.refresh_table_by_load(spark, name, load, scratch_path(spark, "t-scratch"))
    assert _rows(spark, name) == before
    S.refresh_table_by_load(spark, name, load, scratch_path(spark, "t-scratch"))
    assert _rows(spark, name) == SEEN
    assert sorted((str(r.client_name), str(r.order_date), r.revenue) for r in held.collect()) == before


def test_a_stale_writer_does_not_publish(spark):
    name = _fact(spark, OLD)
    read = V.current_set(spark, name)
    rows = spark.table(name)
    V.publish(spark, name, rows.where("client_name = 'beta'"), lambda sets: sets.where("false"), read)
    with pytest.raises(V.StalePublish):
        V.publish(spark, name, rows, lambda sets: sets, read)
    assert _rows(spark, name) == [("beta", "2024-02-10", 4.0)]


def test_many_clients_are_joined_not_listed(spark, monkeypatch):
    monkeypatch.setattr(S, "FEW_CLIENTS", 1)
    name = _fact(spark, OLD)
    S.refresh_table_by_load(spark, name, spark.createDataFrame(NEW, FACT), scratch_path(spark, "t-scratch"))
    assert _rows(spark, name) == SEEN


def test_vacuum_drops_what_no_kept_set_names(spark):
    name = _fact(spark, OLD)
    load = spark.createDataFrame(NEW[:2], FACT)
    for _ in range(3):
        S.refresh_table_by_load(spark, name, load, scratch_path(spark, "t-scratch"))
    seen = _rows(spark, name)
    versions = lambda: spark.table(f"{name}_rows").select("version").distinct().count()
    assert versions() == 4
    assert V.vacuum(spark, name, keep=0) > 0
    assert versions() == 2 and _rows(spark, name) == seen
    assert spark.table(f"{name}_sets").select("set_id").distinct().count() == 1


def test_untouched_partitions_are_not_read(spark):
    name = _fact(spark, OLD)
    plan = spark.table(name).where("client_name = 'beta' AND month = '2024-02'")._jdf.queryExecution().executedPlan().toString()
    assert "client_name" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_undated_load_rows_do_not_replace_undated_rows(spark):
    name = _fact(spark, [("a", 1, 5.0, None, "alpha"), ("a", 1, 1.0, D(2024, 1, 10), "alpha"), ("a", 1, 2.0, None, "beta")])
    load = spark.createDataFrame([("n", 9, 7.0, None, "alpha"), ("n", 9, 9.0, D(2024, 1, 5), "alpha")], FACT)
    S.refresh_table_by_load(spark, name, load, scratch_path(spark, "t-scratch"))
    got = sorted((r.client_name, str(r.order_date), r.revenue) for r in spark.table(name).collect())
    assert got == [("alpha", "2024-01-05", 9.0), ("alpha", "2024-01-10", 1.0), ("alpha", "None", 5.0), ("alpha", "None", 7.0),
                   ("beta", "None", 2.0)]


def _jobs_of(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    run()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(jobs)


def test_number_of_jobs_does_not_grow_with_the_range(spark):
    counts = []
    for last in (D(2024, 2, 5), D(2090, 2, 5)):
        name = _fact(spark, [("a", 1, 1.0, D(2024, 1, 10), "alpha"), ("a", 1, 1.0, D(2024, 1, 10), "beta")])
        load = spark.createDataFrame([("n", 9, 9.0, D(2024, 1, 5), "alpha"), ("n", 9, 9.0, last, "alpha")], FACT)
        counts.append(_jobs_of(spark, lambda: S.refresh_table_by_load(spark, name, load, scratch_path(spark, "t-scratch"))))  # noqa: B023
        assert spark.table(name).count() == 3
    assert counts[1] <= counts[0] + 2


def test_split_write_and_read(spark):
    df = spark.createDataFrame([(1, []), (2, ["a", "b"]), (3, [])], "x int, quarantine_reasons array<string>")
    path = scratch_path(spark, "t-split")
    S.write_split(df, path)
    schema = df.drop("quarantine_reasons").schema
    assert sorted(r.x for r in S.read_split(spark, path, schema, False).collect()) == [1, 3]
    assert [tuple(r) for r in S.read_split(spark, path, schema, True).collect()] == [(2, "a;b")]


def test_csv_columns_come_from_the_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text('x, y ,z\n1,"say ""hi"", you",3\n')
    (tmp_path / "a" / "2.csv").write_text('z,x\n30,10\n')
    (tmp_path / "a" / "3.csv").write_text('x,z\n5,"two\nlines"\n')
    got = S.read_csv_strings(spark, str(tmp_path / "a"), ["w"], quote_escape='"', multiline=True)
    assert set(got.columns) == {"x", " y ", "z", "w"}
    rows = {r["x"]: (r[" y "], r["z"], r["w"]) for r in got.collect()}
    assert rows == {"1": ('say "hi", you', "3", None), "10": (None, "30", None), "5": (None, "two\nlines", None)}


def test_landing_twice_keeps_every_byte_but_the_last_line_end(spark, tmp_path):
    text = b"a,b\r\n\r\n1,2\n\n3,4"
    (tmp_path / "in.csv").write_bytes(text)
    dest = str(tmp_path / "out")
    for _ in range(2):
        S.land_raw(spark, str(tmp_path / "in.csv"), dest)
    landed = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert landed.rstrip(b"\n") == text

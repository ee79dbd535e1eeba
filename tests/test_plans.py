"""Plan-level checks: conservation of rows through splits, no Python in the
plans, pushdown to the scan, no jobs or broadcast hints while a plan is built."""

import pytest
from pyspark.sql import functions as F

from ferrule.operators import metrics as M
from ferrule.plans.registry import all_queries
from ferrule.plans.cleaning_queries import partner
from ferrule.plans.load_queries import load
from ferrule.sources import fixtures as fx
from tests.plan_utils import plan_text

PLAN_QUERIES = ["client_load_alpha", "client_load_beta", "partner_load", "event_status", "readiness_gate",
                "refresh_by_load", "details_client", "breakdown_topn", "batch_ledger_fold", "trigger_payload"]


def test_partner_split_conserves_rows(spark, sf):
    r = partner(spark, sf)
    assert r.processed.count() + r.quarantine.count() == r.cleaned.count()


def test_client_split_conserves_rows(spark, sf):
    # alpha lookup keys are unique, so matched + unmatched = input rows
    r = load(spark, sf, "alpha")
    n_in = fx.alpha_orders(spark, sf).count()
    assert r.passed.count() + r.quarantine.count() == n_in


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_no_python_in_plans(spark, sf, name):
    text = plan_text(all_queries()[name].build(spark, sf))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text and "PythonUDF" not in text


def test_dashboard_filter_pushed_to_scan(spark, sf, tmp_path):
    path = str(tmp_path / "fact")
    fx.client_fact(spark, sf).write.partitionBy("client_name").parquet(path)
    f = spark.read.parquet(path)
    text = plan_text(M.kpi(f, "client_upload", client="alpha", start_date="1996-01-01"))
    assert "PartitionFilters" in text and "isnotnull(client_name" in text
    assert "PushedFilters: [IsNotNull(order_date), GreaterThanOrEqual(order_date" in text


def test_scan_prunes_columns(spark, sf):
    text = plan_text(fx.client_fact(spark, sf))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in text


@pytest.mark.parametrize("name", ["client_load_alpha", "client_load_revenue_daily", "refresh_by_load", "kpi_client",
                                  "partner_load"])
def test_building_a_query_starts_no_job(spark, sf, name, monkeypatch):
    read, opened = fx.read_table, []
    monkeypatch.setattr(fx, "read_table", lambda *a, **k: opened.append(a) or read(*a, **k))
    spark.sparkContext.setJobGroup(f"build-{name}", "build only")
    try:
        all_queries()[name].build(spark, sf)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= len(opened)  # the footer of each Parquet table that is opened, nothing else


def test_no_broadcast_hint_on_a_lookup(spark, sf):
    r = load(spark, sf, "alpha").processed
    assert "broadcast" not in r._jdf.queryExecution().analyzed().toString().lower()


def test_hot_key_first_wins_uses_partial_aggregate(spark):
    from ferrule.operators.ingest import arrival_rank, first_per_key
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("string").alias("k"), F.col("id").alias("t"),
                                  F.timestamp_seconds("id").alias("at"))
    ranked = df.select("k", arrival_rank("at", "t").alias("rank"))
    text = plan_text(first_per_key(ranked, "k", "rank"), "simple")
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


def test_event_status_parses_once_and_hashes(spark, sf, tmp_path):
    """The messages are read by the write of the parsed rows alone; first arrivals come from hash aggregates."""
    from ferrule.operators import ingest as I
    from ferrule.plans.ingest_queries import known_clients
    src, staged = str(tmp_path / "messages"), str(tmp_path / "parsed")
    fx.upload_messages(spark, sf).write.parquet(src)
    out = I.event_status(spark.read.parquet(src), known_clients(), staged=staged)
    text = plan_text(out, "simple")
    assert "messages" not in text and "from_json" not in text and "SortAggregate" not in text and "Window" not in text
    assert {f.split("/")[-2] for f in out.inputFiles()} == {"parsed"}
    plain = I.event_status(spark.read.parquet(src), known_clients())
    cols = ["message_id", "rec_idx", "status"]
    assert sorted(map(str, out.select(cols).collect())) == sorted(map(str, plain.select(cols).collect()))


def test_details_page_is_top_k_not_global_sort(spark, sf):
    text = plan_text(M.details(fx.client_fact(spark, sf), "client_upload", sort_by="revenue", limit=50,
                               offset=10), "simple")
    assert "TakeOrderedAndProject" in text
    assert "Exchange rangepartitioning" not in text


def test_readiness_gate_is_one_aggregation(spark, sf):
    from ferrule.plans.ingest_queries import _readiness
    text = plan_text(_readiness(spark, sf), "simple")
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["event_status", "first_per_file", "latest_per_type", "batch_ledger_fold",
                                  "dedupe_events"])
def test_first_wins_never_uses_a_window(spark, sf, name):
    # a window puts a whole key in one task; first/latest-per-key must be aggregations
    assert "Window" not in plan_text(all_queries()[name].build(spark, sf), "simple")

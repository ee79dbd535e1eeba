"""Registered refresh, staging and ledger queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.operators import refresh as R
from ferrule.operators.aggregate import load_bounds
from ferrule.operators import ledger as L
from ferrule.operators.ledger import lookback_window, reserve_batches
from ferrule.oracles import FIXTURE_CTES, with_fixtures
from ferrule.plans.cleaning_queries import partner_load
from ferrule.plans.load_queries import load, processed_all
from ferrule.plans.registry import register
from ferrule.session import scratch_path
from ferrule.sources import fixtures as fx
from ferrule.sources.tables import read_table

FIXTURE_CTES.update({
    "refresh_existing": """
refresh_existing AS (
  SELECT * FROM client_fact WHERE order_date < DATE '2001-01-01'
  UNION ALL
  SELECT 'undated-' || discount_code AS discount_code, orders, revenue, CAST(NULL AS DATE) AS order_date, client_name
  FROM client_fact WHERE order_date < DATE '1995-02-01')""",
    "refresh_load": """
refresh_load AS (
  SELECT discount_code, orders, revenue * 2 AS revenue, order_date, client_name FROM client_fact
  WHERE client_name IN ('alpha', 'beta') AND order_date BETWEEN DATE '2000-06-01' AND DATE '2000-06-30'
    AND day(order_date) % 10 <> 0)""",
    "refresh_bounds": """
refresh_bounds AS (
  SELECT client_name, min(order_date) AS min_date, max(order_date) AS max_date FROM refresh_load GROUP BY 1)""",
    "refresh_survivors": """
refresh_survivors AS (
  SELECT * FROM refresh_existing f WHERE NOT EXISTS (
    SELECT 1 FROM refresh_bounds b WHERE b.client_name = f.client_name
      AND f.order_date BETWEEN b.min_date AND b.max_date))""",
})
from ferrule.oracles import FIXTURE_DEPS  # noqa: E402

FIXTURE_DEPS.update({
    "refresh_existing": ["client_fact"],
    "refresh_load": ["client_fact"],
    "refresh_bounds": ["refresh_load"],
    "refresh_survivors": ["refresh_existing", "refresh_bounds"],
})


@register("refresh_by_load", with_fixtures("refresh_survivors", "refresh_load") + """
SELECT * FROM refresh_survivors UNION ALL SELECT * FROM refresh_load""", ids=("W2", "J4", "A6"))
def refresh_by_load(spark, sf):
    return R.refresh_by_load(fx.refresh_existing(spark, sf), fx.refresh_load(spark, sf))


@register("refresh_survivors", with_fixtures("refresh_survivors") + "SELECT * FROM refresh_survivors", ids=("J4",))
def refresh_survivors(spark, sf):
    return R.refresh_survivors(fx.refresh_existing(spark, sf), fx.refresh_load(spark, sf))


@register("load_bounds", with_fixtures("refresh_bounds") + "SELECT * FROM refresh_bounds", ids=("A6",))
def load_bounds_q(spark, sf):
    return load_bounds(fx.refresh_load(spark, sf))


PARTNER_OLD = """
partner_old AS (
  SELECT date, source_type, client_name, show_name, discount_code, campaign_name, campaign_item_id, revenue, orders,
         impressions, revenue_per_order, revenue_per_impression, impressions_per_order, 'OLD' AS batch_id,
         'old' AS run_id, 'old' AS source_key, 'old' AS processed_at FROM partner_fact)"""


def partner_old(spark, sf):
    f = fx.partner_fact(spark, sf)
    return f.withColumns({"batch_id": F.lit("OLD"), "run_id": F.lit("old"), "source_key": F.lit("old"),
                          "processed_at": F.lit("old")})


@register("refresh_window", with_fixtures("partner_fact", "partner_processed").rstrip("\n") + "," + PARTNER_OLD + """
SELECT * FROM partner_old WHERE NOT COALESCE(source_type = 'adscribe'
                                             AND date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14', false)
UNION ALL
SELECT * FROM partner_processed WHERE source_type = 'adscribe' AND date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""",
          ids=("W1", "F4", "K23"))
def refresh_window(spark, sf):
    return R.refresh_window(partner_old(spark, sf), partner_load(spark, sf), "adscribe", "2024-01-08", "2024-01-14")


@register("stage_replace_load", with_fixtures("client_processed") + """
SELECT * FROM client_processed WHERE load_id <> 'load-alpha-0001'
UNION ALL
SELECT discount_code, orders, revenue, order_date, client_name, event_name, 'load-alpha-0001' AS load_id, event_date
FROM alpha_processed WHERE order_date >= DATE '1998-01-01'""", ids=("W3",))
def stage_replace_load(spark, sf):
    staging = processed_all(spark, sf)
    reload_rows = load(spark, sf, "alpha").processed.where(F.col("order_date") >= F.lit("1998-01-01").cast("date"))
    return R.stage_replace_load(staging, reload_rows, "load-alpha-0001")


@register("stage_cleanup", with_fixtures("client_processed") + """
SELECT * FROM client_processed WHERE load_id <> 'load-beta-0001'""", ids=("W5",))
def stage_cleanup(spark, sf):
    return R.stage_cleanup(processed_all(spark, sf), "load-beta-0001")


@register("load_rows", with_fixtures("client_processed") + """
SELECT * FROM client_processed WHERE load_id = 'load-gamma-0001'""", ids=("F6",))
def load_rows(spark, sf):
    return R.load_rows(processed_all(spark, sf), "load-gamma-0001")


LEDGER_ATTRS = ["start_date", "end_date", "run_id", "raw_key", "processed_rows", "error"]

FIXTURE_CTES["batch_events"] = """
batch_events AS (
  SELECT * FROM (
    SELECT key, 1 AS seq, 'RECEIVED' AS status, ds || 'T01:00:00Z' AS updated_at, ds AS start_date, ds AS end_date,
           'ads_' || strftime(d, '%Y%m%d') AS run_id, CAST(NULL AS VARCHAR) AS raw_key,
           CAST(NULL AS BIGINT) AS processed_rows, CAST(NULL AS VARCHAR) AS error FROM days
    UNION ALL
    SELECT key, 2, 'RAW_LANDED', ds || 'T02:00:00Z', NULL, NULL, NULL, 'raw/adscribe/' || ds || '.csv', NULL, NULL
    FROM days WHERE dom % 5 <> 0
    UNION ALL
    SELECT key, 3, 'PROCESSED', ds || 'T03:00:00Z', NULL, NULL, NULL, NULL, n, NULL
    FROM days WHERE dom % 5 <> 0 AND dom % 7 <> 0
    UNION ALL
    SELECT key, 4, 'LOADED_TO_REDSHIFT', ds || 'T04:00:00Z', NULL, NULL, NULL, NULL, NULL, NULL
    FROM days WHERE dom % 5 <> 0 AND dom % 7 <> 0 AND dom % 3 <> 0
    UNION ALL
    SELECT key, 4, 'FAILED', ds || 'T04:00:00Z', NULL, NULL, NULL, NULL, NULL, substr('load failed for ' || ds, 1, 1000)
    FROM days WHERE dom % 5 <> 0 AND dom % 7 <> 0 AND dom % 3 = 0) x)"""
FIXTURE_CTES["days"] = """
days AS (
  SELECT d, strftime(d, '%Y-%m-%d') AS ds, day(d) AS dom, n,
         'ADSCRIBE#' || strftime(d, '%Y-%m-%d') || '#' || strftime(d, '%Y-%m-%d') AS key
  FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1) e)"""
FIXTURE_DEPS["batch_events"] = ["days"]


@register("batch_ledger_fold", with_fixtures("batch_events") + """
SELECT key, arg_max(status, seq) AS status, max(seq) AS last_seq, arg_max(updated_at, seq) AS updated_at,
       arg_min(updated_at, seq) AS created_at,
       arg_max(start_date, seq) FILTER (WHERE start_date IS NOT NULL) AS start_date,
       arg_max(end_date, seq) FILTER (WHERE end_date IS NOT NULL) AS end_date,
       arg_max(run_id, seq) FILTER (WHERE run_id IS NOT NULL) AS run_id,
       arg_max(raw_key, seq) FILTER (WHERE raw_key IS NOT NULL) AS raw_key,
       arg_max(processed_rows, seq) FILTER (WHERE processed_rows IS NOT NULL) AS processed_rows,
       arg_max(error, seq) FILTER (WHERE error IS NOT NULL) AS error
FROM batch_events GROUP BY key""", ids=("W7",))
def batch_ledger_fold(spark, sf):
    """Appended in three chunks, one of them twice (a retried run), with a snapshot after the first: the fold reads the
    snapshot and the later chunks."""
    root, events = scratch_path(spark, "batch-ledger"), fx.batch_status_events(spark, sf)
    L.append_events(events.where("seq <= 2"), root)
    L.compact(spark, root, events.schema, LEDGER_ATTRS)
    L.append_events(events.where("seq = 4"), root)
    for _ in range(2):
        L.append_events(events.where("seq = 3"), root)
    return L.read_ledger(spark, root, events.schema, LEDGER_ATTRS)


@register("batch_reservation", with_fixtures("days") + """
SELECT 'ADSCRIBE#' || strftime(d - INTERVAL 3 DAY, '%Y-%m-%d') || '#' || ds AS key FROM days
WHERE 'ADSCRIBE#' || strftime(d - INTERVAL 3 DAY, '%Y-%m-%d') || '#' || ds NOT IN (
  SELECT 'ADSCRIBE#' || strftime(d - INTERVAL 3 DAY, '%Y-%m-%d') || '#' || ds FROM days WHERE dom % 4 = 0)""",
          ids=("W8", "J5", "P11"))
def batch_reservation(spark, sf):
    """Three-day lookback windows per run day; the ledger already holds the
    windows started on every fourth day, so only genuinely new keys start."""
    from ferrule.functions.clean import batch_key
    days = (read_table(spark, sf, "events", ["ts"]).select(F.col("ts").cast("date").alias("d")).distinct())
    cand = days.select(batch_key("ADSCRIBE", F.date_sub("d", 3), F.col("d")).alias("key"))
    ledger = days.where(F.dayofmonth("d") % 4 == 0).select(
        batch_key("ADSCRIBE", F.date_sub("d", 3), F.col("d")).alias("key"))
    return reserve_batches(cand, ledger)


@register("lookback_window", with_fixtures("days") + """
SELECT d AS run_date, CAST(d - INTERVAL 3 DAY AS DATE) AS start_date, d AS end_date,
       reason IS NULL AS is_valid, reason AS reject_reason
FROM (SELECT d, CASE WHEN NOT (CAST(d - INTERVAL 3 DAY AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25')
                     THEN 'start_outside_window'
                     WHEN NOT (d BETWEEN DATE '2024-01-05' AND DATE '2024-01-25') THEN 'end_outside_window'
                     END AS reason FROM days) x
UNION ALL
SELECT d, CAST(d - INTERVAL 9 DAY AS DATE), d, reason IS NULL, reason
FROM (SELECT d, CASE WHEN NOT (CAST(d - INTERVAL 9 DAY AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25')
                     THEN 'start_outside_window'
                     WHEN NOT (d BETWEEN DATE '2024-01-05' AND DATE '2024-01-25') THEN 'end_outside_window'
                     ELSE 'range_exceeds_max' END AS reason FROM days) y""", ids=("F8",))
def lookback_window_q(spark, sf):
    """Windows of three days, and of nine, which are longer than the seven allowed."""
    runs = read_table(spark, sf, "events", ["ts"]).select(F.col("ts").cast("date").alias("d")).distinct()
    short, long = (lookback_window(runs, "d", n, "2024-01-05", "2024-01-25", 7) for n in (3, 9))
    return short.unionByName(long)

"""Registered client-load queries: end-to-end loads, joins, aggregation, conformance."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from ferrule.operators import metrics as M
from ferrule.operators.aggregate import aggregate
from ferrule.operators.conform import derived_columns, enforce_final_schema, normalize_headers, safe_rename
from ferrule.operators.lookup import lookup_join, normalize_columns, unmatched_rows
from ferrule.oracles import with_fixtures
from ferrule.plans.client_load import LoadContext, run_client_load
from ferrule.plans.registry import register
from ferrule.sources import fixtures as fx
from ferrule.spec import Metric, load_client_spec

MONEY = "COALESCE(CAST(sum(CAST(revenue AS decimal(18,2))) AS double), 0.0)"


@lru_cache(maxsize=None)
def spec(client: str):
    return load_client_spec(client)


def client_ctx(client: str) -> LoadContext:
    return LoadContext(client, fx.LOAD_IDS[client], fx.LOAD_EVENT_DATE, fx.LOAD_EVENT_NAME)


def load(spark, sf, client: str, **opts):
    primary_fn, lookup_fn = fx.CLIENT_INPUTS[client]
    return run_client_load(spark, spec(client), primary_fn(spark, sf), lookup_fn(spark, sf),
                           client_ctx(client), **opts)


def processed_all(spark, sf):
    out = None
    for c in ("alpha", "beta", "gamma"):
        p = load(spark, sf, c).processed
        out = p if out is None else out.unionByName(p)
    return out


for _client in ("alpha", "beta", "gamma"):
    def _make(client):
        def q(spark, sf):
            return load(spark, sf, client).processed
        return q
    register(f"client_load_{_client}", with_fixtures(f"{_client}_processed") + f"SELECT * FROM {_client}_processed",
             ids=("S1", "P1", "P2", "P3", "P4", "P5", "C1", "C2", "C4", "C7", "C11", "C12", "J1", "F1", "A1"))(
        _make(_client))


@register("client_load_revenue_daily", with_fixtures("client_processed") + f"""
SELECT order_date AS date, {MONEY} AS revenue FROM client_processed GROUP BY order_date""",
          ids=("A3",))
def client_load_revenue_daily(spark, sf):
    """Flagship: all three client loads feeding the daily revenue series."""
    return M.revenue_daily(processed_all(spark, sf), "client_upload")


@register("lookup_join_inner", with_fixtures("alpha_joined") + "SELECT * FROM alpha_joined", ids=("J1",))
def lookup_join_inner(spark, sf):
    s = spec("alpha")
    p = normalize_columns(safe_rename(normalize_headers(fx.alpha_orders(spark, sf)), s.rename_columns),
                          ["code"], ["code"])
    lk = normalize_columns(safe_rename(normalize_headers(fx.alpha_codes(spark, sf)), s.join.column_mapping),
                           ["code"], ["code"])
    return lookup_join(p, lk, "code", how="inner")


@register("lookup_join_left", with_fixtures("gamma_sales", "gamma_accounts") + """
SELECT p.*, l.account_ref, l.ref_name FROM (
    SELECT trim(id) AS id, sale_date AS date_raw, value_eur AS revenue_raw, item_id, units AS orders_raw,
           lower(code) AS discount_code FROM gamma_sales) p
LEFT JOIN (SELECT trim(id) AS id, account_ref, ref_name FROM gamma_accounts) l ON p.id = l.id""", ids=("J1",))
def lookup_join_left(spark, sf):
    s = spec("gamma")
    trim_cols, lower_cols = s.trim_lower_columns()
    p = normalize_columns(safe_rename(fx.gamma_sales(spark, sf), s.rename_columns), trim_cols, lower_cols)
    lk = normalize_columns(safe_rename(fx.gamma_accounts(spark, sf), s.join.column_mapping), trim_cols, lower_cols)
    return lookup_join(p, lk, "id", how="left")


@register("lookup_join_matched", with_fixtures("beta_joined") + "SELECT * FROM beta_joined", ids=("J2",))
def lookup_join_matched(spark, sf):
    s = spec("beta")
    trim_cols, lower_cols = s.trim_lower_columns()
    p = safe_rename(normalize_headers(fx.beta_sales(spark, sf)), s.rename_columns)
    p = normalize_columns(p.fillna(s.fill_nulls), trim_cols, lower_cols)
    lk = normalize_columns(safe_rename(fx.beta_shows(spark, sf), s.join.column_mapping), trim_cols, lower_cols)
    return lookup_join(p, lk, "show", how="left", require_match=True)


@register("quarantine_unmatched", with_fixtures("alpha_orders", "alpha_codes") + """
SELECT p.*, 'code_not_found_in_codes_file' AS quarantine_reason, 'alpha' AS client_name,
       'load-alpha-0001' AS load_id
FROM (SELECT order_date AS order_date_raw, lower(trim(code)) AS code, subtotal_price AS subtotal_price_raw,
             new_vs_repeat, subs_vs_non FROM alpha_orders) p
WHERE NOT EXISTS (SELECT 1 FROM alpha_codes l WHERE lower(trim(l."Promo Code ")) = p.code)""",
          ids=("Q2", "J3", "K2"))
def quarantine_unmatched(spark, sf):
    q = load(spark, sf, "alpha").quarantine
    return q.where(F.col("quarantine_reason") == "code_not_found_in_codes_file")


@register("quarantine_filtered", with_fixtures("beta_derived") + """
SELECT date_raw, "show", promo_code_raw, revenue_raw, orders_raw, sub_shipments_raw, new_raw, lapsed_raw,
       active_raw,
       CASE WHEN date IS NULL THEN 'failed_filter: date IS NOT NULL'
            WHEN "show" IS NULL THEN 'failed_filter: show IS NOT NULL'
            ELSE 'segment_split_mismatch' END AS quarantine_reason,
       'beta' AS client_name, 'load-beta-0001' AS load_id
FROM beta_derived
WHERE NOT (date IS NOT NULL AND "show" IS NOT NULL
           AND COALESCE(ROUND(new_orders + lapsed_orders + active_orders, 6) = ROUND(orders, 6), false))""",
          ids=("K5", "F2"))
def quarantine_filtered(spark, sf):
    q = load(spark, sf, "beta").quarantine
    return q.where(F.col("quarantine_reason") != "unmatched_show_in_shows_and_codes")


@register("agg_sum_count", with_fixtures("alpha_derived") + """
SELECT date, discount_code, count(code) AS orders,
       CAST(sum(CAST(subtotal_price AS decimal(18,2))) AS DOUBLE) AS revenue
FROM alpha_derived WHERE date IS NOT NULL AND code IS NOT NULL AND subtotal_price IS NOT NULL
GROUP BY date, discount_code""", ids=("A1",))
def agg_sum_count(spark, sf):
    return load(spark, sf, "alpha").aggregated


@register("agg_count_distinct", with_fixtures("beta_derived") + """
SELECT discount_code, count(DISTINCT "show") AS shows, count(DISTINCT date) AS days, count("show") AS rows_n
FROM beta_derived GROUP BY discount_code""", ids=("A1",))
def agg_count_distinct(spark, sf):
    # row-level frame before the spec filters: joined + filled + derived
    s = spec("beta")
    p = safe_rename(normalize_headers(fx.beta_sales(spark, sf)), s.rename_columns)
    trim_cols, lower_cols = s.trim_lower_columns()
    p = normalize_columns(p, trim_cols, lower_cols)
    lk = normalize_columns(safe_rename(fx.beta_shows(spark, sf), s.join.column_mapping), trim_cols, lower_cols)
    j = derived_columns(lookup_join(p, lk, "show", require_match=True).fillna(s.fill_nulls), s.derived_columns)
    return aggregate(j, ["discount_code"], [Metric("show", "count_distinct", "shows"),
                                           Metric("date", "count_distinct", "days"),
                                           Metric("show", "count", "rows_n")])


@register("enforce_schema", with_fixtures("gamma_derived") + """
SELECT CAST(NULL AS VARCHAR) AS discount_code, CAST(trunc(orders) AS BIGINT) AS orders, revenue,
       date AS order_date, 'gamma' AS client_name, 'ObjectCreated' AS event_name, 'load-gamma-0001' AS load_id,
       DATE '2024-01-31' AS event_date
FROM (SELECT date, sum(orders) AS orders, CAST(sum(CAST(revenue AS decimal(18,2))) AS DOUBLE) AS revenue
      FROM gamma_derived WHERE date IS NOT NULL AND revenue IS NOT NULL GROUP BY date) x""", ids=("P5", "K6"))
def enforce_schema(spark, sf):
    """P5 on a frame that lacks discount_code and carries double orders
    (missing column → typed null, double → bigint truncation)."""
    s = spec("gamma")
    trim_cols, lower_cols = s.trim_lower_columns()
    p = normalize_columns(safe_rename(fx.gamma_sales(spark, sf), s.rename_columns), trim_cols, lower_cols)
    lk = normalize_columns(safe_rename(fx.gamma_accounts(spark, sf), s.join.column_mapping), trim_cols, lower_cols)
    d = derived_columns(lookup_join(p, lk, "id", require_match=True), s.derived_columns)
    d = d.where(F.col("date").isNotNull() & F.col("revenue").isNotNull())
    agg = aggregate(d, ["date"], [Metric("orders", "sum", "orders"), Metric("revenue", "sum", "revenue", 2)])
    return enforce_final_schema(agg, "gamma", fx.LOAD_IDS["gamma"], fx.LOAD_EVENT_DATE)


@register("unmatched_ids", with_fixtures("gamma_sales", "gamma_accounts") + """
SELECT p.*, 'unmatched_id_in_salesforce' AS quarantine_reason FROM (
    SELECT trim(id) AS id, sale_date AS date_raw, value_eur AS revenue_raw, item_id, units AS orders_raw,
           lower(code) AS discount_code FROM gamma_sales) p
WHERE p.id IS NULL OR p.id NOT IN (SELECT trim(id) FROM gamma_accounts WHERE id IS NOT NULL)""", ids=("J3",))
def unmatched_ids(spark, sf):
    s = spec("gamma")
    trim_cols, lower_cols = s.trim_lower_columns()
    p = normalize_columns(safe_rename(fx.gamma_sales(spark, sf), s.rename_columns), trim_cols, lower_cols)
    lk = normalize_columns(safe_rename(fx.gamma_accounts(spark, sf), s.join.column_mapping), trim_cols, lower_cols)
    return unmatched_rows(p, lk, "id", "unmatched_id_in_salesforce")

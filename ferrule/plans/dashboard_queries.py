"""Registered dashboard queries (A2-A5, A7, L1-L4, F5) over the fact views."""

from __future__ import annotations

from ferrule.operators import metrics as M
from ferrule.oracles import with_fixtures
from ferrule.plans.registry import register
from ferrule.sources import fixtures as fx

CF = with_fixtures("client_fact")
PF = with_fixtures("partner_fact")
MONEY = "COALESCE(CAST(sum(CAST(revenue AS decimal(18,2))) AS double), 0.0)"
WINDOW = {"start_date": "2024-01-01", "end_date": "2024-01-31"}
WINDOW_SQL = "date >= DATE '2024-01-01' AND date <= DATE '2024-01-31'"


@register("kpi_client", CF + f"""
SELECT {MONEY} AS total_revenue, COALESCE(CAST(sum(orders) AS BIGINT), 0) AS total_orders
FROM client_fact WHERE client_name = 'alpha'""", ids=("A2", "F5"))
def kpi_client(spark, sf):
    return M.kpi(fx.client_fact(spark, sf), "client_upload", client="alpha")


@register("kpi_partner", PF + f"""
SELECT {MONEY} AS total_revenue, COALESCE(sum(orders), 0.0) AS total_orders,
       COALESCE(sum(impressions), 0.0) AS total_impressions
FROM partner_fact WHERE {WINDOW_SQL}""", ids=("A2", "F5"))
def kpi_partner(spark, sf):
    return M.kpi(fx.partner_fact(spark, sf), "ascribe", **WINDOW)


@register("revenue_daily_client", CF + f"""
SELECT order_date AS date, {MONEY} AS revenue FROM client_fact GROUP BY order_date""", ids=("A3", "L3"))
def revenue_daily_client(spark, sf):
    return M.revenue_daily(fx.client_fact(spark, sf), "client_upload")


@register("revenue_daily_partner", PF + f"""
SELECT date, {MONEY} AS revenue FROM partner_fact WHERE {WINDOW_SQL} GROUP BY date""", ids=("A3", "L3"))
def revenue_daily_partner(spark, sf):
    return M.revenue_daily(fx.partner_fact(spark, sf), "adscribe", **WINDOW)


@register("revenue_monthly_client", CF + f"""
SELECT strftime(date_trunc('month', order_date), '%Y-%m') AS month, {MONEY} AS revenue
FROM client_fact WHERE client_name = 'beta' AND order_date >= DATE '1996-01-01' GROUP BY 1""", ids=("A4", "L3"))
def revenue_monthly_client(spark, sf):
    return M.revenue_monthly(fx.client_fact(spark, sf), "client_upload", client="beta", start_date="1996-01-01")


@register("revenue_monthly_partner", PF + f"""
SELECT strftime(date_trunc('month', date), '%Y-%m') AS month, {MONEY} AS revenue
FROM partner_fact WHERE {WINDOW_SQL} GROUP BY 1""", ids=("A4", "L3"))
def revenue_monthly_partner(spark, sf):
    return M.revenue_monthly(fx.partner_fact(spark, sf), "adscribe", **WINDOW)


@register("breakdown_discount_code", CF + f"""
SELECT COALESCE(CAST(discount_code AS VARCHAR), 'UNKNOWN') AS key, {MONEY} AS revenue,
       COALESCE(CAST(sum(orders) AS BIGINT), 0) AS orders, CAST(NULL AS DOUBLE) AS impressions
FROM client_fact GROUP BY 1""", ids=("A5",))
def breakdown_discount_code(spark, sf):
    return M.breakdown(fx.client_fact(spark, sf), "client_upload", "discount_code")


@register("breakdown_show", PF + f"""
SELECT COALESCE(CAST(show_name AS VARCHAR), 'UNKNOWN') AS key, {MONEY} AS revenue,
       COALESCE(sum(orders), 0.0) AS orders, COALESCE(sum(impressions), 0.0) AS impressions
FROM partner_fact WHERE {WINDOW_SQL} GROUP BY 1""", ids=("A5", "K9"))
def breakdown_show(spark, sf):
    return M.breakdown(fx.partner_fact(spark, sf), "ascribe", "show", **WINDOW)


@register("breakdown_client", PF + f"""
SELECT COALESCE(CAST(client_name AS VARCHAR), 'UNKNOWN') AS key, {MONEY} AS revenue,
       COALESCE(sum(orders), 0.0) AS orders, COALESCE(sum(impressions), 0.0) AS impressions
FROM partner_fact WHERE {WINDOW_SQL} GROUP BY 1""", ids=("A5",))
def breakdown_client(spark, sf):
    return M.breakdown(fx.partner_fact(spark, sf), "adscribe", "client_name", **WINDOW)


@register("breakdown_topn", PF + f"""
SELECT COALESCE(CAST(show_name AS VARCHAR), 'UNKNOWN') AS key, {MONEY} AS revenue,
       COALESCE(sum(orders), 0.0) AS orders, COALESCE(sum(impressions), 0.0) AS impressions
FROM partner_fact WHERE {WINDOW_SQL} GROUP BY 1
ORDER BY revenue DESC NULLS FIRST, key ASC NULLS FIRST LIMIT 5""", ids=("A5", "L2"))
def breakdown_topn(spark, sf):
    return M.breakdown(fx.partner_fact(spark, sf), "adscribe", "show_name", top_n=5, **WINDOW)


@register("details_client", CF + """
SELECT order_date AS date, client_name, discount_code, COALESCE(revenue, 0.0) AS revenue,
       COALESCE(orders, 0) AS orders
FROM client_fact
ORDER BY revenue DESC NULLS FIRST, order_date ASC NULLS LAST, client_name ASC NULLS LAST,
         discount_code ASC NULLS LAST
LIMIT 100 OFFSET 20""", ids=("L1", "P16"))
def details_client(spark, sf):
    return M.details(fx.client_fact(spark, sf), "client_upload", sort_by="revenue", sort_order="desc",
                     limit=100, offset=20)


@register("details_client_legacy", CF + """
SELECT order_date AS date, client_name AS client, discount_code, COALESCE(revenue, 0.0) AS revenue,
       COALESCE(orders, 0) AS orders
FROM client_fact
ORDER BY order_date DESC NULLS FIRST, client_name ASC NULLS LAST, discount_code ASC NULLS LAST
LIMIT 50""", ids=("L4", "K11", "K21"))
def details_client_legacy(spark, sf):
    return M.details(fx.client_fact(spark, sf), "client_upload", sort_by="order_date", sort_order="desc",
                     limit=50, offset=0, client_label="client")


@register("details_partner", PF + f"""
SELECT date, client_name, show_name, COALESCE(revenue, 0.0) AS revenue, COALESCE(orders, 0.0) AS orders,
       COALESCE(impressions, 0.0) AS impressions, COALESCE(revenue_per_order, 0.0) AS revenue_per_order,
       COALESCE(revenue_per_impression, 0.0) AS revenue_per_impression,
       COALESCE(impressions_per_order, 0.0) AS impressions_per_order
FROM partner_fact WHERE {WINDOW_SQL} AND client_name = 'alpha'
ORDER BY date DESC NULLS FIRST, client_name ASC NULLS LAST, show_name ASC NULLS LAST,
         discount_code ASC NULLS LAST
LIMIT 50""", ids=("L1", "P16"))
def details_partner(spark, sf):
    return M.details(fx.partner_fact(spark, sf), "ascribe", sort_by="date", sort_order="desc",
                     limit=50, offset=0, client_name="alpha", **WINDOW)


@register("dashboard_filter", PF + """
SELECT * FROM partner_fact
WHERE date >= DATE '2024-01-05' AND date <= DATE '2024-01-20' AND client_name = 'beta'
  AND discount_code = 'code1'""", ids=("F5", "K22"))
def dashboard_filter(spark, sf):
    return M.dashboard_filter(fx.partner_fact(spark, sf), "adscribe", start_date="2024-01-05",
                              end_date="2024-01-20", client_name=" beta ", discount_code="code1")

"""Registered cleaning, partner-load and rule queries."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from ferrule.functions import clean as C
from ferrule.operators import metrics as M
from ferrule.operators.conform import (audit_columns, derived_columns, drop_present, map_output_columns,
                                       normalize_headers, reorder_loose, reorder_strict, safe_rename)
from ferrule.operators.lookup import lookup_join, normalize_columns
from ferrule.operators.rules import apply_filters, balance_check, declared_rules, post_processing, reason_array
from ferrule.oracles import (PARTNER_BATCH_ID, PARTNER_DATE_FORMATS, sql_clean_number, sql_clean_text, sql_lit,
                             with_fixtures)
from ferrule.plans.client_load import common_cleaning as common_cleaning_of
from ferrule.plans.load_queries import load, spec
from ferrule.plans.partner_load import BatchContext, run_partner_load
from ferrule.plans.registry import register
from ferrule.session import scratch_path
from ferrule.sources import fixtures as fx
from ferrule.sources.sinks import read_csv_strings, read_split, write_csv, write_split
from ferrule.spec import load_partner_spec

# The date formats of the alpha spec, in Spark's and in DuckDB's notation.
ALPHA_FORMATS_SPARK = ["yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy", "dd-MM-yyyy", "dd/MM/yyyy", "yyyy/MM/dd",
                       "MMM d, yyyy", "MMMM d, yyyy"]
ALPHA_FORMATS_SQL = ("['%Y-%m-%d', '%m/%d/%Y', '%-m/%-d/%Y', '%d-%m-%Y', '%d/%m/%Y', '%Y/%m/%d', "
                     "'%b %-d, %Y', '%B %-d, %Y']")


@lru_cache(maxsize=None)
def partner_spec():
    return load_partner_spec("partner")


def partner_ctx() -> BatchContext:
    b = fx.PARTNER_BATCH
    return BatchContext(PARTNER_BATCH_ID, b["run_id"], b["source_key"], b["processed_at"], b["start"], b["end"])


def partner(spark, sf):
    return run_partner_load(partner_spec(), fx.partner_raw(spark, sf), partner_ctx())


def split_path(spark, sf) -> str:
    """The partner load's good and bad rows in one write."""
    path = scratch_path(spark, "partner-split")
    write_split(partner(spark, sf).flagged, path)
    return path


# --- partner load and its split ------------------------------------------------

@register("partner_load", with_fixtures("partner_processed") + "SELECT * FROM partner_processed",
          ids=("C3", "C5", "C6", "C9", "C10", "D1", "P6", "P8", "P9", "Q1"))
def partner_load(spark, sf):
    return partner(spark, sf).processed


@register("quarantine_split_bad", with_fixtures("partner_quarantine") + "SELECT * FROM partner_quarantine",
          ids=("Q1", "P7", "S8"))
def quarantine_split_bad(spark, sf):
    r = partner(spark, sf)
    return read_split(spark, split_path(spark, sf), r.flagged.drop("quarantine_reasons").schema, True)


@register("quarantine_split_good", with_fixtures("partner_flagged") + """
SELECT date, show_name, revenue, orders, impressions, quarantine_reason <> '' AS is_quarantined
FROM partner_flagged""", ids=("Q1",))
def quarantine_split_good(spark, sf):
    """Conservation view of the one split write: every cleaned row once, flagged good or bad."""
    schema = partner(spark, sf).flagged.drop("quarantine_reasons").schema
    path = split_path(spark, sf)
    columns = ["date", "show_name", "revenue", "orders", "impressions"]
    sides = [read_split(spark, path, schema, q).select(*columns, F.lit(q).alias("is_quarantined")) for q in (False, True)]
    return sides[0].unionByName(sides[1])


@register("breakdown_null_key", with_fixtures("partner_processed") + """
SELECT CAST(discount_code AS VARCHAR) AS group_key,
       COALESCE(CAST(sum(CAST(revenue AS decimal(18,2))) AS double), 0.0) AS revenue,
       COALESCE(sum(orders), 0.0) AS orders
FROM partner_processed WHERE date >= DATE '2024-01-01' AND date <= DATE '2024-01-31'
GROUP BY 1""", ids=("A7", "K11"))
def breakdown_null_key(spark, sf):
    return M.breakdown(partner_load(spark, sf), "adscribe", "discount_code", null_label=None,
                       start_date="2024-01-01", end_date="2024-01-31")


@register("kpi_partner_load", with_fixtures("partner_processed") + """
SELECT COALESCE(CAST(sum(CAST(revenue AS decimal(18,2))) AS double), 0.0) AS total_revenue,
       COALESCE(sum(orders), 0.0) AS total_orders, COALESCE(sum(impressions), 0.0) AS total_impressions
FROM partner_processed WHERE date >= DATE '2024-01-01' AND date <= DATE '2024-01-31'
  AND client_name = 'beta' AND show_name = 'Show_4'""", ids=("A2", "F5"))
def kpi_partner_load(spark, sf):
    return M.kpi(partner_load(spark, sf), "adscribe", start_date="2024-01-01", end_date="2024-01-31",
                 client_name="beta", show_name="Show_4")


@register("dedupe_rows", with_fixtures("partner_cleaned") + "SELECT * FROM partner_cleaned", ids=("D1",))
def dedupe_rows(spark, sf):
    return partner(spark, sf).cleaned


@register("window_filter", with_fixtures("partner_processed") + """
SELECT * FROM partner_processed
WHERE source_type = 'adscribe' AND date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""", ids=("F4",))
def window_filter(spark, sf):
    from ferrule.operators.refresh import window_rows
    return window_rows(partner_load(spark, sf), "adscribe", "2024-01-08", "2024-01-14")


# --- column cleaners on the raw views ------------------------------------------------

@register("csv_na_tokens", with_fixtures("partner_raw") + """
SELECT """ + ", ".join(
    f"""CASE WHEN "{c}" IN ({", ".join(sql_lit(t) for t in C.PANDAS_DEFAULT_NA_TOKENS)}) THEN NULL ELSE "{c}" END AS "{c}" """
    for c in ["Report Date", "Day", "Client", "Show", "Promo Code", "Campaign", "Campaign Item ID", "Revenue",
              "Orders", "Impressions"]) + " FROM partner_raw", ids=("S2",))
def csv_na_tokens(spark, sf):
    """The raw feed written as CSV and read as the partner reader does."""
    path = scratch_path(spark, "partner-na")
    write_csv(fx.partner_raw(spark, sf), path)
    raw = read_csv_strings(spark, path, quote_escape='"', multiline=True)
    return raw.select(*[C.null_na_tokens(c).alias(c) for c in raw.columns])


@register("clean_text", with_fixtures("partner_raw") + f"""
SELECT "Show" AS raw_show, {sql_clean_text('"Show"')} AS show_name,
       "Promo Code" AS raw_code, {sql_clean_text('"Promo Code"')} AS discount_code,
       "Campaign Item ID" AS raw_item, {sql_clean_text('"Campaign Item ID"')} AS campaign_item_id
FROM partner_raw""", ids=("C6",))
def clean_text(spark, sf):
    raw, toks = fx.partner_raw(spark, sf), partner_spec().null_tokens
    return raw.select(F.col("Show").alias("raw_show"), C.clean_text("Show", null_tokens=toks).alias("show_name"),
                      F.col("Promo Code").alias("raw_code"),
                      C.clean_text("Promo Code", null_tokens=toks).alias("discount_code"),
                      F.col("Campaign Item ID").alias("raw_item"),
                      C.clean_text("Campaign Item ID", null_tokens=toks).alias("campaign_item_id"))


@register("clean_number_tokens", with_fixtures("partner_raw") + f"""
SELECT "Revenue" AS raw_revenue, {sql_clean_number('"Revenue"')} AS revenue,
       "Orders" AS raw_orders, {sql_clean_number('"Orders"')} AS orders,
       "Impressions" AS raw_impressions, {sql_clean_number('"Impressions"')} AS impressions
FROM partner_raw""", ids=("C9", "K8", "K20"))
def clean_number_tokens(spark, sf):
    raw, toks = fx.partner_raw(spark, sf), partner_spec().null_tokens
    return raw.select(F.col("Revenue").alias("raw_revenue"), C.clean_number_tokens("Revenue", toks).alias("revenue"),
                      F.col("Orders").alias("raw_orders"), C.clean_number_tokens("Orders", toks).alias("orders"),
                      F.col("Impressions").alias("raw_impressions"),
                      C.clean_number_tokens("Impressions", toks).alias("impressions"))


@register("canonical_date", with_fixtures("partner_raw") + f"""
SELECT "Report Date" AS report_date, "Day" AS day,
       strftime(COALESCE(try_strptime("Report Date", {PARTNER_DATE_FORMATS}),
                         try_strptime("Day", {PARTNER_DATE_FORMATS})), '%Y-%m-%d') AS date
FROM partner_raw""", ids=("C5", "K19"))
def canonical_date(spark, sf):
    raw = fx.partner_raw(spark, sf)
    return raw.select(F.col("Report Date").alias("report_date"), F.col("Day").alias("day"),
                      C.canonical_date(["Report Date", "Day"], ["yyyy-MM-dd", "MM/dd/yyyy"]).alias("date"))


@register("safe_ratios", with_fixtures("partner_raw") + f"""
SELECT revenue, orders, impressions, revenue / NULLIF(orders, 0) AS revenue_per_order,
       revenue / NULLIF(impressions, 0) AS revenue_per_impression,
       impressions / NULLIF(orders, 0) AS impressions_per_order
FROM (SELECT {sql_clean_number('"Revenue"')} AS revenue, {sql_clean_number('"Orders"')} AS orders,
             {sql_clean_number('"Impressions"')} AS impressions FROM partner_raw) x""", ids=("C10",))
def safe_ratios(spark, sf):
    raw, toks = fx.partner_raw(spark, sf), partner_spec().null_tokens
    n = raw.select(C.clean_number_tokens("Revenue", toks).alias("revenue"),
                   C.clean_number_tokens("Orders", toks).alias("orders"),
                   C.clean_number_tokens("Impressions", toks).alias("impressions"))
    return n.select("revenue", "orders", "impressions",
                    C.safe_ratio("revenue", "orders").alias("revenue_per_order"),
                    C.safe_ratio("revenue", "impressions").alias("revenue_per_impression"),
                    C.safe_ratio("impressions", "orders").alias("impressions_per_order"))


@register("column_defaults", with_fixtures("beta_sales") + """
SELECT "Show", COALESCE("New", '0') AS "New", COALESCE("Lapsed", '0') AS "Lapsed", "Active",
       'unassigned' AS region
FROM beta_sales""", ids=("C3",))
def column_defaults(spark, sf):
    from ferrule.plans.partner_load import apply_defaults
    b = fx.beta_sales(spark, sf).select("Show", "New", "Lapsed", "Active")
    return apply_defaults(b, {"New": "0", "Lapsed": "0", "region": "unassigned"})


@register("normalize_text", with_fixtures("alpha_orders") + """
SELECT code AS raw_code, lower(trim(code)) AS code, trim(subs_vs_non) AS subs_vs_non, lower(new_vs_repeat) AS new_vs_repeat
FROM alpha_orders""", ids=("C1",))
def normalize_text(spark, sf):
    a = fx.alpha_orders(spark, sf).select(F.col("code").alias("raw_code"), "code", "subs_vs_non", "new_vs_repeat")
    return normalize_columns(a, ["code", "subs_vs_non"], ["code", "new_vs_repeat"])


@register("fill_nulls", with_fixtures("beta_sales") + """
SELECT date, "Show", COALESCE("Sub Shipments", '0') AS sub_shipments_raw, COALESCE("New", '0') AS new_raw,
       COALESCE("Lapsed", '0') AS lapsed_raw, COALESCE("Active", '0') AS active_raw
FROM beta_sales""", ids=("C2",))
def fill_nulls(spark, sf):
    s = spec("beta")
    b = safe_rename(fx.beta_sales(spark, sf), s.rename_columns)
    b = b.select(F.col("date_raw").alias("date"), F.col("show").alias("Show"), "sub_shipments_raw", "new_raw",
                 "lapsed_raw", "active_raw")
    return b.fillna({k: v for k, v in s.fill_nulls.items() if k in b.columns})


@register("parse_multi_date", with_fixtures("alpha_orders") + f"""
SELECT order_date AS raw_date,
       CAST(COALESCE(try_strptime(order_date, {ALPHA_FORMATS_SQL}), TRY_CAST(order_date AS TIMESTAMP)) AS DATE) AS date
FROM alpha_orders""", ids=("C4", "K17", "K18"))
def parse_multi_date(spark, sf):
    a = fx.alpha_orders(spark, sf)
    return a.select(F.col("order_date").alias("raw_date"),
                    C.parse_multi_date("order_date", ALPHA_FORMATS_SPARK).alias("date"))


@register("clean_number", with_fixtures("alpha_orders") + """
SELECT subtotal_price AS raw_price,
       TRY_CAST(regexp_replace(trim(subtotal_price), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS price
FROM alpha_orders""", ids=("C7",))
def clean_number(spark, sf):
    a = fx.alpha_orders(spark, sf)
    return a.select(F.col("subtotal_price").alias("raw_price"), C.clean_number("subtotal_price").alias("price"))


@register("clean_number_eu", with_fixtures("gamma_sales") + """
SELECT value_eur AS raw_value,
       TRY_CAST(regexp_replace(regexp_replace(trim(value_eur), ',', '.', 'g'), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS value_reference,
       TRY_CAST(regexp_replace(regexp_replace(regexp_replace(trim(value_eur), '\\.', '', 'g'), ',', '.', 'g'),
                               '[^0-9.\\-]', '', 'g') AS DOUBLE) AS value_eu
FROM gamma_sales""", ids=("C8", "K7"))
def clean_number_eu(spark, sf):
    g = fx.gamma_sales(spark, sf)
    return g.select(F.col("value_eur").alias("raw_value"),
                    C.clean_number_eu("value_eur", "reference").alias("value_reference"),
                    C.clean_number_eu("value_eur", "eu").alias("value_eu"))


@register("segment_split", with_fixtures("beta_sales") + """
SELECT orders, active_segment_count, split_order_value,
       CASE WHEN n > 0 THEN split_order_value ELSE 0.0 END AS new_orders,
       CASE WHEN l > 0 THEN split_order_value ELSE 0.0 END AS lapsed_orders,
       CASE WHEN a > 0 THEN split_order_value ELSE 0.0 END AS active_orders
FROM (SELECT *, CASE WHEN active_segment_count > 0 THEN orders / active_segment_count ELSE 0.0 END AS split_order_value
      FROM (SELECT *, (CASE WHEN COALESCE(n, 0) > 0 THEN 1 ELSE 0 END) + (CASE WHEN COALESCE(l, 0) > 0 THEN 1 ELSE 0 END)
                      + (CASE WHEN COALESCE(a, 0) > 0 THEN 1 ELSE 0 END) AS active_segment_count
            FROM (SELECT TRY_CAST("Orders" AS DOUBLE) AS orders, TRY_CAST("New" AS DOUBLE) AS n,
                         TRY_CAST("Lapsed" AS DOUBLE) AS l, TRY_CAST("Active" AS DOUBLE) AS a FROM beta_sales) x) y) z""",
          ids=("C11",))
def segment_split(spark, sf):
    b = fx.beta_sales(spark, sf).select(F.col("Orders").try_cast("double").alias("orders"),
                                        F.col("New").try_cast("double").alias("n"),
                                        F.col("Lapsed").try_cast("double").alias("l"),
                                        F.col("Active").try_cast("double").alias("a"))
    cols = C.segment_split("orders", {"new": "n", "lapsed": "l", "active": "a"})
    return b.withColumns(cols).select("orders", "active_segment_count", "split_order_value", "new_orders",
                                      "lapsed_orders", "active_orders")


@register("common_cleaning", with_fixtures("alpha_processed") + "SELECT * FROM alpha_processed", ids=("C13", "K16"))
def common_cleaning(spark, sf):
    """Opt-in declared cleaning blocks; on this input they agree with the spec
    expressions, so the processed rows equal the plain load."""
    return load(spark, sf, "alpha", apply_common_cleaning=True).processed


@register("common_cleaning_blocks", with_fixtures("partner_raw") + """
SELECT strptime("Report Date", '%m/%d/%Y')::DATE AS day, lower(trim("Show")) AS "Show", "Client", "Promo Code",
       replace(replace(trim("Revenue"), '$', ''), ',', '') AS "Revenue",
       COALESCE("Report Date", 'never') AS "Report Date"
FROM partner_raw WHERE "Promo Code" <> 'NULL' AND "Report Date" LIKE '%/%'
UNION ALL
SELECT NULL, lower(trim("Show")), "Client", "Promo Code", replace(replace(trim("Revenue"), '$', ''), ',', ''),
       COALESCE("Report Date", 'never')
FROM partner_raw WHERE "Promo Code" <> 'NULL' AND ("Report Date" IS NULL OR "Report Date" NOT LIKE '%/%')""",
          ids=("C13", "K16"))
def common_cleaning_blocks(spark, sf):
    """Every declared block at work: text, numbers, defaults, dropped rows and dates."""
    raw = fx.partner_raw(spark, sf).select("Show", "Client", "Promo Code", "Revenue", "Report Date").withColumn(
        "Promo Code", F.when(F.col("Promo Code") != "NULL", F.col("Promo Code")))
    return common_cleaning_of(raw, {
        "text_normalization": {"trim_columns": ["Show"], "lowercase_columns": ["Show"]},
        "numeric_cleaning": {"target_columns": ["Revenue"], "remove_currency_symbols": True, "remove_thousands_separators": True},
        "missing_value_strategy": {"fill_defaults": {"Report Date": "never"}, "drop_rows_when_missing": ["Promo Code"]},
        "date_parsing_rules": {"source_column": "Report Date", "target_column": "day", "accepted_formats": ["MM/dd/yyyy"]},
    }).withColumn("day", F.when(F.col("Report Date").contains("/"), F.col("day")))


# --- filters and rules --------------------------------------------------------------

@register("filter_expressions", with_fixtures("alpha_derived") + """
SELECT order_date_raw, code, subtotal_price_raw, new_vs_repeat, subs_vs_non, date, subtotal_price, client_id
FROM alpha_derived WHERE date IS NOT NULL AND code IS NOT NULL AND subtotal_price IS NOT NULL""", ids=("F1",))
def filter_expressions(spark, sf):
    s = spec("alpha")
    p = normalize_columns(safe_rename(normalize_headers(fx.alpha_orders(spark, sf)), s.rename_columns),
                          ["code"], ["code"])
    lk = normalize_columns(safe_rename(normalize_headers(fx.alpha_codes(spark, sf)), s.join.column_mapping),
                           ["code"], ["code"])
    d = derived_columns(lookup_join(p, lk, "code", how="inner"), s.derived_columns)
    return apply_filters(d, s.filter_expressions)


@register("balance_check", with_fixtures("beta_derived") + """
SELECT date, "show", orders, new_orders, lapsed_orders, active_orders FROM beta_derived
WHERE COALESCE(ROUND(new_orders + lapsed_orders + active_orders, 6) = ROUND(orders, 6), false)""", ids=("F2",))
def balance_check_q(spark, sf):
    s = spec("beta")
    trim_cols, lower_cols = s.trim_lower_columns()
    p = normalize_columns(safe_rename(fx.beta_sales(spark, sf), s.rename_columns), trim_cols, lower_cols)
    lk = normalize_columns(safe_rename(fx.beta_shows(spark, sf), s.join.column_mapping), trim_cols, lower_cols)
    d = derived_columns(lookup_join(p, lk, "show", require_match=True).fillna(s.fill_nulls), s.derived_columns)
    ok = balance_check(["new_orders", "lapsed_orders", "active_orders"], "orders")
    return d.where(ok).select("date", "show", "orders", "new_orders", "lapsed_orders", "active_orders")


@register("quarantine_rules", with_fixtures("gamma_sales", "gamma_accounts") + """
SELECT p.id, p.discount_code, 'unmatched_id_in_salesforce' AS quarantine_reason FROM (
    SELECT trim(id) AS id, lower(code) AS discount_code FROM gamma_sales) p
LEFT JOIN (SELECT trim(id) AS id, account_ref FROM gamma_accounts) l ON p.id = l.id
WHERE l.account_ref IS NULL""", ids=("Q3",))
def quarantine_rules(spark, sf):
    s = spec("gamma")
    trim_cols, lower_cols = s.trim_lower_columns()
    p = normalize_columns(safe_rename(fx.gamma_sales(spark, sf), s.rename_columns), trim_cols, lower_cols)
    lk = normalize_columns(safe_rename(fx.gamma_accounts(spark, sf), s.join.column_mapping), trim_cols, lower_cols)
    j = lookup_join(p, lk, "id", how="left")
    reasons = reason_array(declared_rules(s.quarantine_rules))
    flagged = j.withColumn("reasons", reasons).where(F.size("reasons") > 0)
    return flagged.select("id", "discount_code", F.array_join("reasons", ";").alias("quarantine_reason"))


@register("post_processing", with_fixtures("alpha_processed") + """
SELECT * FROM alpha_processed WHERE discount_code IS NOT NULL""", ids=("Q4",))
def post_processing_q(spark, sf):
    """The processed rows and, for the filter to drop, copies without a code."""
    processed = load(spark, sf, "alpha").processed
    uncoded = processed.where("orders % 2 = 0").withColumn("discount_code", F.lit(None).cast("string"))
    return post_processing(processed.unionByName(uncoded), spec("alpha").post_processing)


# --- audit / projection ----------------------------------------------------------------

@register("audit_columns", with_fixtures("client_fact") + """
SELECT discount_code, orders, revenue, order_date, client_name,
       'load-audit-0001' AS load_id, COALESCE(discount_code, 'ObjectCreated') AS event_name,
       TIMESTAMP '2024-01-31 00:00:00' AS created_at
FROM client_fact""", ids=("P8", "W6", "K13"))
def audit_columns_q(spark, sf):
    f = fx.client_fact(spark, sf).withColumn("event_name", F.col("discount_code"))
    return audit_columns(f, {"load_id": "load-audit-0001", "event_name": "ObjectCreated",
                             "created_at": F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")},
                         backfill=["event_name", "created_at"])


@register("stamp_backfill", with_fixtures("client_fact") + """
SELECT discount_code, orders, revenue, order_date, client_name,
       CASE WHEN orders % 3 = 0 THEN 'ObjectCreated' ELSE discount_code END AS event_name FROM client_fact""",
          ids=("W6", "K13"))
def stamp_backfill(spark, sf):
    """An existing stamp stays where it is set and is filled where it is null."""
    f = fx.client_fact(spark, sf).withColumn("event_name", F.when(F.col("orders") % 3 != 0, F.col("discount_code")))
    return audit_columns(f, {"event_name": "ObjectCreated"}, backfill=["event_name"])


@register("normalize_headers", with_fixtures("alpha_codes") + """
SELECT "Promo Code " AS "Promo Code" FROM alpha_codes""", ids=("P1",))
def normalize_headers_q(spark, sf):
    return normalize_headers(fx.alpha_codes(spark, sf)).select("Promo Code")


@register("safe_rename", with_fixtures("alpha_orders") + """
SELECT order_date AS order_date_raw, subtotal_price AS subtotal_price_raw, new_vs_repeat, subs_vs_non FROM alpha_orders""",
          ids=("P2",))
def safe_rename_q(spark, sf):
    """Renames of columns that are there; one that is absent is passed over."""
    return safe_rename(fx.alpha_orders(spark, sf).drop("code"), spec("alpha").rename_columns)


@register("map_output_columns", with_fixtures("alpha_orders") + "SELECT *, code AS discount_code FROM alpha_orders", ids=("P3",))
def map_output_columns_q(spark, sf):
    return map_output_columns(fx.alpha_orders(spark, sf), {"discount_code": "code", "nothing": "absent"})


@register("derived_columns", """
SELECT o_orderkey, o_totalprice, o_totalprice * 2 AS doubled, o_totalprice * 2 + 1 AS more FROM orders""", ids=("P4",))
def derived_columns_q(spark, sf):
    """Each column sees the ones before it."""
    o = fx.read_table(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return derived_columns(o, [("doubled", "o_totalprice * 2"), ("more", "doubled + 1")])


@register("reorder_strict", with_fixtures("client_fact") + """
SELECT order_date, CAST(NULL AS VARCHAR) AS show_name, revenue FROM client_fact""", ids=("P6",))
def reorder_strict_q(spark, sf):
    out = reorder_strict(fx.client_fact(spark, sf), ["order_date", "show_name", "revenue"])
    return out.withColumn("show_name", F.col("show_name").cast("string"))


@register("reorder_loose", with_fixtures("client_fact") + """
SELECT order_date, CAST(NULL AS VARCHAR) AS show_name, discount_code, orders, revenue, client_name FROM client_fact""",
          ids=("P7",))
def reorder_loose_q(spark, sf):
    out = reorder_loose(fx.client_fact(spark, sf), ["order_date", "show_name"])
    return out.withColumn("show_name", F.col("show_name").cast("string"))


@register("money_subcent", """
SELECT l_returnflag AS kind, round(CAST(sum(CAST(CAST(l_extendedprice * l_discount / 1000 AS VARCHAR) AS DECIMAL(38, 18))) AS DOUBLE), 5)
         AS total
FROM lineitem GROUP BY 1 UNION ALL SELECT 'oversized', 1e25""", ids=("A1", "A2"))
def money_subcent(spark, sf):
    """Amounts below a cent are kept, and one that fits no decimal neither fails the sum nor drops out."""
    rows = fx.read_table(spark, sf, "lineitem", ["l_returnflag", "l_extendedprice", "l_discount"]).select(
        F.col("l_returnflag").alias("kind"), (F.col("l_extendedprice") * F.col("l_discount") / 1000).alias("amount"))
    large = rows.limit(1).select(F.lit("oversized").alias("kind"), F.lit(1e25).alias("amount"))
    total = rows.unionByName(large).groupBy("kind").agg(C.money_sum("amount").alias("total"))
    return total.withColumn("total", F.when(F.col("total") < 1e20, F.round("total", 5)).otherwise(F.col("total")))


@register("drop_after_derive", with_fixtures("partner_raw") + f"""
SELECT "Client", "Show", strftime(COALESCE(try_strptime("Report Date", {PARTNER_DATE_FORMATS}),
                                          try_strptime("Day", {PARTNER_DATE_FORMATS})), '%Y-%m-%d') AS date
FROM partner_raw""", ids=("P9",))
def drop_after_derive(spark, sf):
    raw = fx.partner_raw(spark, sf).select("Report Date", "Day", "Client", "Show")
    d = raw.withColumn("date", C.canonical_date(["Report Date", "Day"], ["yyyy-MM-dd", "MM/dd/yyyy"]))
    return drop_present(d, ["Report Date", "Day", "Not There"])


@register("batch_keys", with_fixtures("partner_fact") + """
SELECT DISTINCT 'ADSCRIBE#' || strftime(date_trunc('week', date), '%Y-%m-%d') || '#'
                || strftime(date_trunc('week', date) + INTERVAL 6 DAY, '%Y-%m-%d') AS batch_id,
       'ADSCRIBE_' || strftime(date_trunc('week', date), '%Y-%m-%d') || '_'
                || strftime(date_trunc('week', date) + INTERVAL 6 DAY, '%Y-%m-%d') AS batch_path
FROM partner_fact""", ids=("P11",))
def batch_keys(spark, sf):
    f = fx.partner_fact(spark, sf)
    start = F.date_trunc("week", F.col("date")).cast("date")
    w = f.select(start.alias("s"), F.date_add(start, 6).alias("e")).distinct()
    k = C.batch_key("ADSCRIBE", "s", "e")
    return w.select(k.alias("batch_id"), C.path_safe_key(k).alias("batch_path"))

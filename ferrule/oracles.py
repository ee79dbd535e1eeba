"""DuckDB SQL that recomputes every registered query from the raw tables.

The driver runs these next to the Spark plans and compares row counts,
schemas and value hashes.  Each fixture view of ``ferrule.sources.fixtures``
has a CTE here with the same derivation; queries are composed as
``WITH <fixtures> SELECT ...``.
"""

from __future__ import annotations

from ferrule.sources.fixtures import LOAD_EVENT_DATE, LOAD_EVENT_NAME, LOAD_IDS, PARTNER_BATCH

FIXTURE_CTES: dict[str, str] = {
    "client_fact": """
client_fact AS (
  SELECT lower(substr(o_orderpriority, 3)) AS discount_code, count(*) AS orders,
         CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) AS revenue,
         CAST(o_orderdate AS date) AS order_date,
         CASE o_custkey % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END AS client_name
  FROM orders GROUP BY 1, 4, 5)""",
    "partner_fact": """
partner_fact AS (
  SELECT date, 'adscribe' AS source_type, client_name, show_name, discount_code,
         CAST(NULL AS VARCHAR) AS campaign_name, CAST(NULL AS VARCHAR) AS campaign_item_id,
         revenue, orders, impressions,
         revenue / NULLIF(orders, 0) AS revenue_per_order,
         revenue / NULLIF(impressions, 0) AS revenue_per_impression,
         impressions / NULLIF(orders, 0) AS impressions_per_order
  FROM (SELECT CAST(ts AS date) AS date, 'show_' || CAST(user_id % 20 AS VARCHAR) AS show_name,
               CASE user_id % 20 % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END AS client_name,
               'code' || CAST(user_id % 20 % 7 AS VARCHAR) AS discount_code,
               CAST(sum(CAST(CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS decimal(18,2))) AS double) AS revenue,
               CAST(count(CASE WHEN event_type = 'purchase' THEN 1 END) AS double) AS orders,
               CAST(count(CASE WHEN event_type = 'view' THEN 1 END) AS double) AS impressions
        FROM events GROUP BY 1, 2, 3, 4) g)""",
    "alpha_orders": """
alpha_orders AS (
  SELECT CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
              WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%m/%d/%Y')
              WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%Y/%m/%d')
              WHEN o_orderkey % 97 = 3 THEN 'junk'
              ELSE strftime(o_orderdate, '%d-%m-%Y') END AS order_date,
         CASE WHEN o_orderkey % 2 = 0 THEN ' ' || substr(o_orderpriority, 3) || ' '
              ELSE lower(substr(o_orderpriority, 3)) END AS code,
         ' $' || format('{:,.2f}', o_totalprice) || ' ' AS subtotal_price,
         CASE WHEN o_orderstatus = 'F' THEN 'repeat' ELSE 'new' END AS new_vs_repeat,
         CASE WHEN o_custkey % 2 = 0 THEN 'sub' ELSE 'non' END AS subs_vs_non
  FROM orders)""",
    "alpha_codes": """
alpha_codes AS (
  SELECT DISTINCT substr(o_orderpriority, 3) AS "Promo Code " FROM orders
  WHERE substr(o_orderpriority, 3) <> 'LOW')""",
    "beta_sales": """
beta_sales AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS date,
         'Show ' || CAST(l_suppkey % 20 AS VARCHAR) AS "Show",
         'P' || CAST(l_partkey % 10 AS VARCHAR) AS "Promo Code",
         '$' || format('{:,.2f}', l_extendedprice) AS "Sales",
         CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) AS "Orders",
         CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber AS VARCHAR) END AS "Sub Shipments",
         CASE WHEN l_linenumber % 2 = 0 THEN '1' END AS "New",
         CASE WHEN l_returnflag = 'R' THEN '1' END AS "Lapsed",
         CASE WHEN l_linestatus = 'F' THEN '1' END AS "Active"
  FROM lineitem)""",
    "beta_shows": """
beta_shows AS (
  SELECT ' SHOW ' || CAST(s AS VARCHAR) AS "OMAHA SHOWNAME", 'BETA' || CAST(s % 6 AS VARCHAR) AS "CODE",
         CAST(s AS VARCHAR) AS "ShowID", CASE WHEN s % 2 = 0 THEN 'Y' ELSE 'N' END AS "Campaign Item?"
  FROM (SELECT DISTINCT s_suppkey % 20 AS s FROM supplier) x WHERE s < 18)""",
    "gamma_sales": """
gamma_sales AS (
  SELECT ' ' || CAST(o_custkey AS VARCHAR) AS id,
         strftime(o_orderdate, '%d-%m-%Y') AS sale_date,
         CASE WHEN o_orderkey % 10 = 0 THEN translate(format('{:,.2f}', o_totalprice), ',.', '.,')
              ELSE translate(format('{:.2f}', o_totalprice), '.', ',') END AS value_eur,
         CAST(o_orderkey AS VARCHAR) AS item_id,
         CAST(o_orderkey % 5 + 1 AS VARCHAR) AS units,
         substr(o_orderpriority, 3) AS code
  FROM orders)""",
    "gamma_accounts": """
gamma_accounts AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, 'ACC' || CAST(c_custkey AS VARCHAR) AS account_ref, c_name AS ref_name
  FROM customer WHERE c_custkey % 10 <> 0)""",
}

# Dependencies between fixture CTEs (a CTE must follow the ones it reads).
FIXTURE_DEPS: dict[str, list[str]] = {
    "alpha_joined": ["alpha_orders", "alpha_codes"],
    "alpha_derived": ["alpha_joined"],
    "alpha_processed": ["alpha_derived"],
    "beta_joined": ["beta_sales", "beta_shows"],
    "beta_derived": ["beta_joined"],
    "beta_processed": ["beta_derived"],
    "gamma_joined": ["gamma_sales", "gamma_accounts"],
    "gamma_derived": ["gamma_joined"],
    "gamma_processed": ["gamma_derived"],
    "client_processed": ["alpha_processed", "beta_processed", "gamma_processed"],
}

NUM = "TRY_CAST(regexp_replace(trim({x}), '[^0-9.\\-]', '', 'g') AS DOUBLE)"
MONEY_SUM = "CAST(sum(CAST({x} AS decimal(18,2))) AS DOUBLE)"
# The date formats of the specs.
ALPHA_FORMATS = "['%Y-%m-%d', '%m/%d/%Y', '%-m/%-d/%Y', '%d-%m-%Y', '%d/%m/%Y', '%Y/%m/%d', '%b %-d, %Y', '%B %-d, %Y']"
BETA_FORMATS = "['%Y-%m-%d', '%m/%d/%Y', '%-m/%-d/%Y', '%d-%m-%Y', '%d/%m/%Y']"
GAMMA_FORMATS = "['%Y-%m-%d', '%d-%m-%Y', '%d/%m/%Y', '%m/%d/%Y']"


def _multi_date(col: str, formats: str) -> str:
    return f"CAST(COALESCE(try_strptime({col}, {formats}), TRY_CAST({col} AS TIMESTAMP)) AS DATE)"


def _stamp(client: str) -> str:
    return (f"'{client}' AS client_name, 'ObjectCreated' AS event_name, "
            f"'{LOAD_IDS[client]}' AS load_id, DATE '{LOAD_EVENT_DATE}' AS event_date")


FIXTURE_CTES.update({
    "alpha_joined": """
alpha_joined AS (
  SELECT p.* FROM (
    SELECT order_date AS order_date_raw, lower(trim(code)) AS code, subtotal_price AS subtotal_price_raw,
           new_vs_repeat, subs_vs_non FROM alpha_orders) p
  JOIN (SELECT lower(trim("Promo Code ")) AS code FROM alpha_codes) l ON p.code = l.code)""",
    "alpha_derived": f"""
alpha_derived AS (
  SELECT *, {_multi_date("order_date_raw", ALPHA_FORMATS)} AS date,
         {NUM.format(x="subtotal_price_raw")} AS subtotal_price, 'alpha' AS client_id, code AS discount_code
  FROM alpha_joined)""",
    "alpha_processed": f"""
alpha_processed AS (
  SELECT discount_code, count(code) AS orders, {MONEY_SUM.format(x="subtotal_price")} AS revenue,
         date AS order_date, {_stamp("alpha")}
  FROM alpha_derived WHERE date IS NOT NULL AND code IS NOT NULL AND subtotal_price IS NOT NULL
  GROUP BY date, discount_code)""",
    "beta_joined": """
beta_joined AS (
  SELECT p.*, l.discount_code, l.show_id, l.campaign_item FROM (
    SELECT date AS date_raw, lower(trim("Show")) AS "show", "Promo Code" AS promo_code_raw, "Sales" AS revenue_raw,
           "Orders" AS orders_raw, COALESCE("Sub Shipments", '0') AS sub_shipments_raw,
           COALESCE("New", '0') AS new_raw, COALESCE("Lapsed", '0') AS lapsed_raw,
           COALESCE("Active", '0') AS active_raw
    FROM beta_sales) p
  JOIN (SELECT lower(trim("OMAHA SHOWNAME")) AS "show", "CODE" AS discount_code, "ShowID" AS show_id,
               "Campaign Item?" AS campaign_item FROM beta_shows) l ON p."show" = l."show")""",
    "beta_derived": f"""
beta_derived AS (
  SELECT *, CASE WHEN "New" > 0 THEN split_order_value ELSE 0 END AS new_orders,
         CASE WHEN "Lapsed" > 0 THEN split_order_value ELSE 0 END AS lapsed_orders,
         CASE WHEN "Active" > 0 THEN split_order_value ELSE 0 END AS active_orders, 'beta' AS client_id
  FROM (SELECT *, CASE WHEN active_segment_count > 0 THEN orders / active_segment_count ELSE 0 END AS split_order_value
        FROM (SELECT *, (CASE WHEN COALESCE("New", 0) > 0 THEN 1 ELSE 0 END) + (CASE WHEN COALESCE("Lapsed", 0) > 0 THEN 1 ELSE 0 END)
                        + (CASE WHEN COALESCE("Active", 0) > 0 THEN 1 ELSE 0 END) AS active_segment_count
              FROM (SELECT *, {_multi_date("date_raw", BETA_FORMATS)} AS date, {NUM.format(x="revenue_raw")} AS revenue,
                           {NUM.format(x="orders_raw")} AS orders, {NUM.format(x="sub_shipments_raw")} AS sub_shipments,
                           {NUM.format(x="new_raw")} AS "New", {NUM.format(x="lapsed_raw")} AS "Lapsed",
                           {NUM.format(x="active_raw")} AS "Active"
                    FROM beta_joined) a) b) c)""",
    "beta_processed": f"""
beta_processed AS (
  SELECT discount_code, CAST(trunc(sum(orders)) AS BIGINT) AS orders, {MONEY_SUM.format(x="revenue")} AS revenue,
         date AS order_date, {_stamp("beta")}
  FROM beta_derived
  WHERE date IS NOT NULL AND "show" IS NOT NULL
    AND ROUND(new_orders + lapsed_orders + active_orders, 6) = ROUND(orders, 6)
  GROUP BY date, discount_code)""",
    "gamma_joined": """
gamma_joined AS (
  SELECT p.*, l.account_ref, l.ref_name FROM (
    SELECT trim(id) AS id, sale_date AS date_raw, value_eur AS revenue_raw, item_id, units AS orders_raw,
           lower(code) AS discount_code FROM gamma_sales) p
  JOIN (SELECT trim(id) AS id, account_ref, ref_name FROM gamma_accounts) l ON p.id = l.id)""",
    "gamma_derived": f"""
gamma_derived AS (
  SELECT *, {_multi_date("date_raw", GAMMA_FORMATS)} AS date,
         TRY_CAST(regexp_replace(regexp_replace(trim(revenue_raw), ',', '.', 'g'), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS revenue,
         {NUM.format(x="orders_raw")} AS orders, 'gamma' AS client_id
  FROM gamma_joined)""",
    "gamma_processed": f"""
gamma_processed AS (
  SELECT discount_code, CAST(trunc(sum(orders)) AS BIGINT) AS orders, {MONEY_SUM.format(x="revenue")} AS revenue,
         date AS order_date, {_stamp("gamma")}
  FROM gamma_derived
  WHERE date IS NOT NULL AND id IS NOT NULL AND discount_code IS NOT NULL AND revenue IS NOT NULL
    AND orders IS NOT NULL
  GROUP BY date, discount_code)""",
    "client_processed": """
client_processed AS (
  SELECT * FROM alpha_processed UNION ALL SELECT * FROM beta_processed UNION ALL SELECT * FROM gamma_processed)""",
})


def with_fixtures(*names: str) -> str:
    """``WITH`` clause holding the named fixture CTEs (and their dependencies)."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in FIXTURE_DEPS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    return "WITH " + ",".join(FIXTURE_CTES[n] for n in ordered) + "\n"


def sql_lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


__all__ = ["FIXTURE_CTES", "with_fixtures", "sql_lit", "LOAD_IDS", "LOAD_EVENT_DATE", "LOAD_EVENT_NAME",
           "PARTNER_BATCH"]


# --- partner feed -------------------------------------------------------------

PARTNER_TOKENS = ("N/A", "n/a", "NULL", "null", "None", "none")
PARTNER_BATCH_ID = "ADSCRIBE#2024-01-01#2024-01-31"
NUMERIC_TEXT_PATTERN_SQL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def sql_clean_text(col: str, tokens=PARTNER_TOKENS) -> str:
    toks = ", ".join(sql_lit(t) for t in sorted(set(tokens)))
    return f"CASE WHEN trim({col}) IN ({toks}) OR trim({col}) = '' THEN NULL ELSE trim({col}) END"


def sql_clean_number(col: str, tokens=PARTNER_TOKENS) -> str:
    from ferrule.functions.clean import ordered_tokens
    t = f"CAST({col} AS VARCHAR)"
    for tok in ordered_tokens(tokens):
        t = f"replace({t}, {sql_lit(tok)}, '')"
    for ch in (",", "$", "%"):
        t = f"replace({t}, '{ch}', '')"
    t = f"trim({t})"
    return f"CASE WHEN regexp_matches({t}, '{NUMERIC_TEXT_PATTERN_SQL}') THEN TRY_CAST({t} AS DOUBLE) + 0.0 END"


PARTNER_DATE_FORMATS = "['%Y-%m-%d', '%m/%d/%Y']"

FIXTURE_DEPS.update({
    "partner_raw_rows": ["partner_raw_base"],
    "partner_raw": ["partner_raw_rows"],
    "partner_cleaned": ["partner_raw"],
    "partner_flagged": ["partner_cleaned"],
    "partner_processed": ["partner_flagged"],
    "partner_quarantine": ["partner_flagged"],
})

FIXTURE_CTES.update({
    "partner_raw_base": """
partner_raw_base AS (
  SELECT CAST(ts AS DATE) AS d, user_id AS u,
         CAST(sum(CAST(CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS decimal(18,2))) AS DOUBLE) AS rev,
         count(CASE WHEN event_type = 'purchase' THEN 1 END) AS ord,
         count(CASE WHEN event_type = 'view' THEN 1 END) AS imp,
         min(event_id) AS i
  FROM events GROUP BY 1, 2)""",
    "partner_raw_rows": """
partner_raw_rows AS (
  SELECT CASE WHEN i % 7 = 0 THEN NULL WHEN i % 7 = 1 THEN strftime(d, '%m/%d/%Y')
              WHEN i % 53 = 2 THEN 'not a date' ELSE strftime(d, '%Y-%m-%d') END AS "Report Date",
         strftime(d, '%Y-%m-%d') AS "Day",
         CASE WHEN u % 3 = 0 THEN 'alpha' WHEN u % 3 = 1 THEN 'beta' ELSE 'gamma' END AS "Client",
         CASE WHEN i % 47 = 7 THEN '  ' WHEN i % 59 = 8 THEN 'nan' ELSE ' Show_' || CAST(u % 20 AS VARCHAR) || ' ' END AS "Show",
         CASE WHEN i % 11 = 0 THEN 'NULL' ELSE 'CODE' || CAST(u % 7 AS VARCHAR) END AS "Promo Code",
         'Campaign ' || CAST(u % 5 AS VARCHAR) AS "Campaign",
         CASE WHEN i % 13 = 0 THEN '' ELSE CAST(u * 100 + 1 AS VARCHAR) END AS "Campaign Item ID",
         CASE WHEN i % 41 = 5 THEN 'N/A' WHEN i % 43 = 6 THEN '-' || format('{:,.2f}', rev)
              ELSE '$' || format('{:,.2f}', rev) END AS "Revenue",
         CASE WHEN i % 37 = 4 THEN '-' ELSE CAST(ord AS VARCHAR) END AS "Orders",
         CASE WHEN i % 31 = 3 THEN 'n/a' WHEN i % 29 = 2 THEN '12d' ELSE CAST(imp AS VARCHAR) || ' ' END AS "Impressions",
         i
  FROM partner_raw_base)""",
    "partner_raw": """
partner_raw AS (
  SELECT * EXCLUDE (i) FROM partner_raw_rows
  UNION ALL SELECT * EXCLUDE (i) FROM partner_raw_rows WHERE i % 10 = 0)""",
    "partner_cleaned": f"""
partner_cleaned AS (
  SELECT DISTINCT *, revenue / NULLIF(orders, 0) AS revenue_per_order,
         revenue / NULLIF(impressions, 0) AS revenue_per_impression,
         impressions / NULLIF(orders, 0) AS impressions_per_order
  FROM (SELECT 'adscribe' AS source_type, '{PARTNER_BATCH_ID}' AS batch_id, {sql_lit(PARTNER_BATCH["run_id"])} AS run_id,
               {sql_lit(PARTNER_BATCH["source_key"])} AS source_key, {sql_lit(PARTNER_BATCH["processed_at"])} AS processed_at,
               strftime(COALESCE(try_strptime("Report Date", {PARTNER_DATE_FORMATS}),
                                 try_strptime("Day", {PARTNER_DATE_FORMATS})), '%Y-%m-%d') AS date,
               {sql_clean_text('"Client"')} AS client_name,
               NULLIF({sql_clean_text('"Show"')}, 'nan') AS show_name,
               {sql_clean_text('"Promo Code"')} AS discount_code,
               COALESCE({sql_clean_text('"Campaign"')}, 'unknown_campaign') AS campaign_name,
               {sql_clean_text('"Campaign Item ID"')} AS campaign_item_id,
               {sql_clean_number('"Revenue"')} AS revenue,
               {sql_clean_number('"Orders"')} AS orders,
               COALESCE({sql_clean_number('"Impressions"')}, 0.0) AS impressions
        FROM partner_raw) x)""",
    "partner_flagged": f"""
partner_flagged AS (
  SELECT *, concat_ws(';',
           CASE WHEN date IS NULL THEN 'missing_required:date' END,
           CASE WHEN show_name IS NULL THEN 'missing_required:show_name' END,
           CASE WHEN revenue < 0 THEN 'negative_value:revenue' END,
           CASE WHEN orders < 0 THEN 'negative_value:orders' END,
           CASE WHEN impressions < 0 THEN 'negative_value:impressions' END,
           CASE WHEN date IS NOT NULL AND COALESCE(try_strptime(date, {PARTNER_DATE_FORMATS}),
                                                   TRY_CAST(date AS TIMESTAMP)) IS NULL
                THEN 'invalid_date:date' END) AS quarantine_reason
  FROM partner_cleaned)""",
    "partner_processed": """
partner_processed AS (
  SELECT CAST(date AS DATE) AS date, source_type, client_name, show_name, discount_code, campaign_name,
         campaign_item_id, revenue, orders, impressions, revenue_per_order, revenue_per_impression,
         impressions_per_order, batch_id, run_id, source_key, processed_at
  FROM partner_flagged WHERE quarantine_reason = '')""",
    "partner_quarantine": """
partner_quarantine AS (SELECT * FROM partner_flagged WHERE quarantine_reason <> '')""",
})


# --- upload events --------------------------------------------------------------

def _upload_name_case() -> str:
    from ferrule.sources.fixtures import UPLOAD_FILES
    files = dict(UPLOAD_FILES)
    files["delta"] = ["d_orders.csv", "d_codes.csv", "d_x.txt"]
    whens = " ".join(f"WHEN client_raw = {sql_lit(c)} AND slot = {i} THEN {sql_lit(n)}"
                     for c, names in files.items() for i, n in enumerate(names))
    return f"CASE {whens} END"


FIXTURE_DEPS.update({
    "upload_records": ["upload_base"],
    "upload_final": ["upload_records"],
})

FIXTURE_CTES.update({
    "upload_base": """
upload_base AS (
  SELECT event_id, ts, 'm-' || CAST(event_id AS VARCHAR) AS message_id,
         CASE WHEN user_id % 4 = 3 THEN 'delta' WHEN user_id % 3 = 0 THEN 'alpha'
              WHEN user_id % 3 = 1 THEN 'beta' ELSE 'gamma' END AS client_raw,
         CASE WHEN event_type = 'purchase' THEN 0 WHEN event_type = 'signup' AND day(ts) % 7 <> 3 THEN 1 ELSE 2 END AS slot,
         CASE WHEN event_id % 101 = 0 THEN 'broken' WHEN event_id % 103 = 0 THEN 'empty'
              WHEN event_id % 9 = 0 THEN 'wrapped' ELSE 'direct' END AS body_kind,
         event_id % 19 = 0 AS misc_folder, event_id % 23 = 0 AS no_bucket, event_id % 17 = 0 AS encoded,
         CAST(event_id % 50 AS VARCHAR) AS etag_v,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time
  FROM events)""",
    "upload_records": f"""
upload_records AS (
  SELECT *, CASE WHEN misc_folder THEN 'misc/' ELSE 'raw/client_uploads/' END || client_raw || '/' || file_name AS object_key,
         CASE WHEN misc_folder THEN 'misc/' ELSE 'raw/client_uploads/' END || client_raw || '/' ||
           CASE WHEN encoded THEN replace(replace(orig, '_', '%5F'), 'creator', 'creator+') ELSE orig END AS key_raw
  FROM (SELECT *, CASE WHEN encoded THEN replace(orig, 'creator', 'creator ') ELSE orig END AS file_name
        FROM (SELECT *, {_upload_name_case()} AS orig FROM upload_base) a) b)""",
    "upload_final": """
upload_final AS (
  SELECT *, COALESCE(pre_status, CASE WHEN row_number() OVER (PARTITION BY idempotency_key ORDER BY ts, message_id) = 1
                                      THEN 'stored' ELSE 'duplicate_event' END) AS status
  FROM (SELECT *, CASE WHEN pre_status IS NULL
                       THEN client_name || '|' || object_key || '|' || event_date || '|' || etag END AS idempotency_key
        FROM (SELECT message_id, ts, body_kind, event_time,
                     CASE WHEN body_kind = 'direct' THEN 0 END AS rec_idx,
                     CASE WHEN body_kind = 'broken' THEN 'parse_error'
                          WHEN body_kind IN ('empty', 'wrapped') THEN 'ignored_no_nested_records'
                          WHEN no_bucket OR misc_folder THEN 'ignored_invalid_s3_record'
                          WHEN client_raw NOT IN ('alpha', 'beta', 'gamma') THEN 'ignored_unknown_client' END AS pre_status,
                     CASE WHEN body_kind = 'direct' AND NOT misc_folder THEN client_raw END AS client_name,
                     CASE WHEN body_kind = 'direct' THEN object_key END AS object_key,
                     CASE WHEN body_kind = 'direct' THEN file_name END AS file_name,
                     CASE WHEN body_kind = 'direct' AND NOT no_bucket THEN 'uploads-bucket' END AS bucket_name,
                     CASE WHEN body_kind = 'direct' THEN strftime(ts, '%Y-%m-%d') END AS event_date,
                     CASE WHEN body_kind = 'direct' THEN etag_v END AS etag
              FROM upload_records) a) b)""",
})

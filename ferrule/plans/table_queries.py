"""Registered catalog-table and quirk queries (S13, W2 publish, K1, K4, K14, K15)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrule.operators.conform import normalize_headers, safe_rename
from ferrule.operators.lookup import lookup_join, normalize_columns
from ferrule.oracles import with_fixtures
from ferrule.plans.cleaning_queries import partner_load
from ferrule.plans.load_queries import load, processed_all, spec
from ferrule.plans.refresh_queries import PARTNER_OLD, partner_old
from ferrule.plans.registry import register
from ferrule.session import scratch_path
from ferrule.sources import fixtures as fx
from ferrule.sources import sinks as S
from ferrule.sources import versioned as V
from ferrule.sources.tables import (CLIENT_FACT_TABLE, CLIENT_PROCESSED_SCHEMA, CLIENT_STAGING_TABLE, PARTNER_FACT_TABLE,
                                    table_definitions)

@register("fact_table_refresh", with_fixtures("refresh_survivors", "refresh_load") + """
SELECT *, strftime(order_date, '%Y-%m') AS month FROM (
  SELECT * FROM refresh_survivors UNION ALL SELECT * FROM refresh_load UNION ALL
  SELECT 'late-' || discount_code, orders, revenue, NULL, client_name FROM refresh_load
  WHERE order_date = DATE '2000-06-05') x""", ids=("S13", "W2", "K10", "K14"))
def fact_table_refresh(spark, sf):
    """Create the versioned fact if missing, publish the existing rows, refresh it
    by a new load that has undated rows too, read what the view shows."""
    name = f"{CLIENT_FACT_TABLE}_{uuid.uuid4().hex[:10]}"
    schema, parts = table_definitions()[CLIENT_FACT_TABLE]
    V.create(spark, name, schema, scratch_path(spark, "fact-table"), parts)
    existing = fx.refresh_existing(spark, sf).withColumn("month", F.date_format("order_date", "yyyy-MM"))
    V.publish(spark, name, existing, lambda sets: sets)
    load = fx.refresh_load(spark, sf)
    late = load.where("order_date = DATE '2000-06-05'").withColumns({
        "discount_code": F.concat(F.lit("late-"), F.col("discount_code")), "order_date": F.lit(None).cast("date")})
    S.refresh_table_by_load(spark, name, load.unionByName(late), scratch_path(spark, "fact-refresh"))
    return spark.table(name).select("discount_code", "orders", "revenue", "order_date", "client_name", "month")


@register("partner_fact_refresh", with_fixtures("partner_fact", "partner_processed").rstrip("\n") + "," + PARTNER_OLD + """
SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS loaded_at, strftime(date, '%Y-%m') AS month FROM partner_old
WHERE NOT COALESCE(source_type = 'adscribe' AND date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14', false)
UNION ALL
SELECT *, TIMESTAMP '2024-02-01 00:00:00', strftime(date, '%Y-%m') FROM partner_processed
WHERE source_type = 'adscribe' AND date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""", ids=("S13", "W1", "K10"))
def partner_fact_refresh(spark, sf):
    """The partner fact as a table: load the old rows, replace one week from staging, read it back."""
    name = f"{PARTNER_FACT_TABLE}_{uuid.uuid4().hex[:10]}"
    schema, parts = table_definitions()[PARTNER_FACT_TABLE]
    V.create(spark, name, schema, scratch_path(spark, "partner-fact"), parts)
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    old = partner_old(spark, sf).withColumns({"loaded_at": at("2024-01-01 00:00:00"), "month": F.date_format("date", "yyyy-MM")})
    V.publish(spark, name, old, lambda sets: sets)
    staging = partner_load(spark, sf).withColumn("loaded_at", at("2024-02-01 00:00:00"))
    S.refresh_table_by_window(spark, name, staging, "adscribe", "2024-01-08", "2024-01-14")
    return spark.table(name).select(*schema.fieldNames())


@register("stage_drop_load", with_fixtures("client_processed") + """
SELECT * FROM client_processed WHERE load_id <> 'load-beta-0001'""", ids=("S13", "W5"))
def stage_drop_load(spark, sf):
    """Staging as a table partitioned by load; a promoted load's partition is dropped."""
    name = f"{CLIENT_STAGING_TABLE}_{uuid.uuid4().hex[:10]}"
    schema, parts = table_definitions()[CLIENT_STAGING_TABLE]
    S.create_table_if_missing(spark, name, schema, scratch_path(spark, "stage-table"), parts)
    S.insert_partitions(processed_all(spark, sf), name, parts)
    S.drop_load(spark, name, "load-beta-0001")
    return spark.table(name).select(*schema.fieldNames())


def _alpha_sides(spark, sf, duplicate: bool):
    s = spec("alpha")
    p = normalize_columns(safe_rename(normalize_headers(fx.alpha_orders(spark, sf)), s.rename_columns),
                          ["code"], ["code"])
    codes = normalize_headers(fx.alpha_codes(spark, sf))
    if duplicate:
        codes = codes.unionByName(codes.where(F.col("Promo Code") == "URGENT"))
    lk = normalize_columns(safe_rename(codes, s.join.column_mapping), ["code"], ["code"])
    return p, lk


FANOUT_SQL = with_fixtures("alpha_orders", "alpha_codes") + """
SELECT p.code, count(*) AS joined_rows FROM (SELECT lower(trim(code)) AS code FROM alpha_orders) p
JOIN (SELECT lower(trim("Promo Code ")) AS code FROM alpha_codes
      {dup}) l ON p.code = l.code
GROUP BY p.code"""


@register("lookup_fanout", FANOUT_SQL.replace("{dup}",
    """UNION ALL SELECT lower(trim("Promo Code ")) FROM alpha_codes WHERE "Promo Code " = 'URGENT'"""),
          ids=("K1",))
def lookup_fanout(spark, sf):
    """K1 kept: a repeated lookup code multiplies its primary rows."""
    p, lk = _alpha_sides(spark, sf, duplicate=True)
    return lookup_join(p, lk, "code", how="inner").groupBy("code").agg(F.count(F.lit(1)).alias("joined_rows"))


@register("lookup_dedupe", FANOUT_SQL.replace("{dup}", ""), ids=("K1",))
def lookup_dedupe(spark, sf):
    """K1 option: ``dedupe_lookup`` keeps one lookup row per key."""
    p, lk = _alpha_sides(spark, sf, duplicate=True)
    j = lookup_join(p, lk, "code", how="inner", dedupe_lookup=True)
    return j.groupBy("code").agg(F.count(F.lit(1)).alias("joined_rows"))


@register("beta_segment_sums", with_fixtures("beta_derived") + """
SELECT date, discount_code, CAST(sum(CAST(revenue AS decimal(18,2))) AS DOUBLE) AS revenue,
       round(sum(orders), 6) AS orders, round(sum(sub_shipments), 6) AS sub_shipments,
       round(sum(new_orders), 6) AS new_orders, round(sum(lapsed_orders), 6) AS lapsed_orders,
       round(sum(active_orders), 6) AS active_orders
FROM beta_derived
WHERE date IS NOT NULL AND "show" IS NOT NULL
  AND ROUND(new_orders + lapsed_orders + active_orders, 6) = ROUND(orders, 6)
GROUP BY date, discount_code""", ids=("K4", "A1"))
def beta_segment_sums(spark, sf):
    """K4: beta's segment order sums, kept in the aggregate before the final
    schema drops them (rounded to 6 places for presentation)."""
    a = load(spark, sf, "beta").aggregated
    return a.select("date", "discount_code", "revenue",
                    *[F.round(c, 6).alias(c) for c in ("orders", "sub_shipments", "new_orders", "lapsed_orders",
                                                        "active_orders")])


@register("processed_idempotent_write", with_fixtures("alpha_processed") + "SELECT * FROM alpha_processed",
          ids=("K15", "W3"))
def processed_idempotent_write(spark, sf):
    """K15 fixed: writing a load twice (a retried job) replaces its
    ``load_id`` partition instead of appending a second copy."""
    path = scratch_path(spark, "processed-by-load")
    rows = load(spark, sf, "alpha").processed
    S.replace_partitions(rows, path, ["load_id"])
    S.replace_partitions(rows, path, ["load_id"])
    schema = T.StructType([f for f in CLIENT_PROCESSED_SCHEMA.fields if f.name != "load_id"])
    return S.read_partitioned(spark, path, schema, ("load_id",)).select(*CLIENT_PROCESSED_SCHEMA.fieldNames())


"""Registered queries over tables of patterns and of file headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.operators import header_history as H
from ferrule.operators.globs import match_globs
from ferrule.plans.registry import register
from ferrule.session import scratch_path
from ferrule.sources.fixtures import read_table

# a pattern a customer, in five forms; an order's file has its customer in its name
_PATTERNS = """CASE c_custkey % 5 WHEN 0 THEN concat('*_cust', {k}, '.csv') WHEN 1 THEN concat('?_199[5-8]-??-*_CUST', {k}, '.csv')
  WHEN 2 THEN concat('[op]_*cust', {k}, '.*') WHEN 3 THEN concat('F_*cust', {k}, '*') ELSE concat('*-0[!1-6]-*_cust', {k}, '.csv') END"""
_FILE = "concat(o_orderstatus, '_', {day}, '_Cust', {k}, '.csv')"
_GLOB_SQL = f"""
WITH files AS (SELECT o_orderkey, concat('client', o_custkey % 3) AS client_name,
                      {_FILE.format(day="strftime(o_orderdate, '%Y-%m-%d')", k="o_custkey")} AS file_name FROM orders),
patterns AS (SELECT concat('client', c_custkey % 3) AS client_name, concat('feed', c_custkey) AS file_type, c_custkey AS spec_order,
                    lower({_PATTERNS.format(k="c_custkey")}) AS pattern FROM customer),
hits AS (SELECT f.*, p.file_type, p.spec_order, length(regexp_replace(p.pattern, '[*?\\[\\]]', '', 'g')) AS literal
         FROM files f JOIN patterns p ON f.client_name = p.client_name AND lower(f.file_name) GLOB p.pattern)
"""


def _files_and_patterns(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    c = read_table(spark, sf, "customer", ["c_custkey"])
    files = o.select("o_orderkey", F.expr("concat('client', o_custkey % 3)").alias("client_name"),
                     F.expr(_FILE.format(day="date_format(o_orderdate, 'yyyy-MM-dd')", k="o_custkey")).alias("file_name"))
    patterns = c.selectExpr("concat('client', c_custkey % 3) AS client_name", "concat('feed', c_custkey) AS file_type",
                            f"{_PATTERNS.format(k='c_custkey')} AS pattern", "c_custkey AS spec_order")
    return files, patterns


@register("glob_table_match", _GLOB_SQL + """
SELECT o_orderkey, client_name, file_name, file_type FROM hits
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY literal DESC, spec_order) = 1""", ids=("J7", "D6"))
def glob_table_match(spark, sf):
    """The most specific of a table of patterns that each file's name matches."""
    return match_globs(*_files_and_patterns(spark, sf))


@register("glob_table_all", _GLOB_SQL + """
SELECT DISTINCT o_orderkey, client_name, file_name, file_type FROM hits""", ids=("J7", "K12"))
def glob_table_all(spark, sf):
    """Every type of the table that each file's name satisfies."""
    return match_globs(*_files_and_patterns(spark, sf), exclusive=False)


@register("header_history", """
WITH g AS (SELECT o_custkey % 3 AS c, strftime(o_orderdate, '%Y-%m') AS day, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL),
h AS (SELECT c, day, list_sort(list_concat(['code', 'order_date'], coalesce(list(lower(p)) FILTER (WHERE n % 2 = 1), []))) AS cols
      FROM g GROUP BY c, day),
a AS (SELECT *, list_contains(cols, '1-urgent') OR c <> 1 AS accepted FROM h),
l AS (SELECT *, last_value(CASE WHEN accepted THEN cols END IGNORE NULLS) OVER
        (PARTITION BY c ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base FROM a)
SELECT 'client' || c AS client_name, day, array_to_string(cols, ',') AS columns, accepted,
       array_to_string(CASE WHEN base IS NULL THEN [] ELSE [x FOR x IN cols IF NOT list_contains(base, x)] END, ',') AS extra_columns,
       array_to_string(CASE WHEN base IS NULL THEN [] ELSE [x FOR x IN base IF NOT list_contains(cols, x)] END, ',') AS missing_columns,
       CASE WHEN base IS NULL THEN 'first' WHEN base = cols THEN 'same' ELSE 'changed' END AS status
FROM l""", ids=("P10", "S9"))
def header_history(spark, sf):
    """Monthly files a client, whose columns come and go with the orders; their headers read back into the history table."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]).select(
        "o_orderkey", F.concat(F.lit("client"), F.col("o_custkey") % 3).alias("client"), F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"), F.col("o_orderpriority").alias("priority"))
    counts = o.groupBy("client", "month", "priority").count()
    odd = F.array_sort(F.collect_set(F.when(F.col("count") % 2 == 1, F.col("priority"))))
    heads = counts.groupBy("client", "month").agg(odd.alias("odd"))                       # at most the five priorities
    lines = o.join(heads, ["client", "month"]).select(
        "client", "month", F.lit(1).alias("at"), F.concat_ws(",", "order_date", "o_orderkey", F.transform("odd", lambda p: F.lit("1"))).alias("value"))
    first = heads.select("client", "month", F.lit(0).alias("at"), F.concat_ws(",", F.lit("order_date"), F.lit(" Code"), "odd").alias("value"))
    path, table = scratch_path(spark, "header-files"), scratch_path(spark, "header-history")
    # keys that cannot be null, so the write keeps this order and adds no sort of its own: the header stays each file's first line
    rows = first.unionByName(lines).withColumns({k: F.coalesce(k, F.lit("none")) for k in ("client", "month")})
    (rows.repartition("client", "month").sortWithinPartitions("client", "month", "at").drop("at")
     .write.partitionBy("client", "month").text(path))
    seen = H.observe_headers(spark, [f"{path}/*/*"], "client=([^/]+)", "month=([^/]+)")
    H.write_headers(H.fold_headers(seen, {"client1": ["order_date", "1-URGENT"]}), table)
    drift = H.header_drift(H.read_headers(spark, table))
    joined = [F.array_join(c, ",").alias(c) for c in ("columns", "extra_columns", "missing_columns")]
    return drift.select("client_name", "day", *joined, "accepted", "status")

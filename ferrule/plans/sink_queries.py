"""Registered source/sink round trips.

Each query writes under the session's shared checkpoint folder and returns
what a reader sees, so the plan exercises the real writer and reader.
"""

from __future__ import annotations

import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrule.oracles import with_fixtures
from ferrule.operators.conform import normalize_headers, schema_drift, schema_drift_columns
from ferrule.plans.cleaning_queries import partner, partner_ctx
from ferrule.plans.load_queries import load, processed_all
from ferrule.plans.registry import register
from ferrule.session import scratch_path
from ferrule.sources import fixtures as fx
from ferrule.sources import sinks as S
from ferrule.sources.tables import CLIENT_PROCESSED_SCHEMA, PARTNER_PROCESSED_SCHEMA, read_table

PARTS = ("year", "month", "day")


def _parts_sql(col: str) -> str:
    return f"strftime({col}, '%Y') AS year, strftime({col}, '%m') AS month, strftime({col}, '%d') AS day"


@register("scan_csv_typed", with_fixtures("alpha_orders") + """
SELECT *, CASE WHEN code = upper(code) AND length(code) % 2 = 0 THEN 'say "' || code || '", twice' END AS note
FROM alpha_orders""", ids=("S1", "P1"))
def scan_csv_typed(spark, sf):
    """Two CSV files with headers of their own: one reordered, with an extra column (quotes and
    commas inside) and a padded name, one plain.  The columns come from the files."""
    src = fx.alpha_orders(spark, sf)
    even = F.coalesce((F.upper("code") == F.col("code")) & (F.length("code") % 2 == 0), F.lit(False))
    note = F.concat(F.lit('say "'), F.col("code"), F.lit('", twice')).alias("note")
    odd_file = src.where(even).select(note, *reversed(src.columns)).withColumnRenamed("code", " code ")
    paths = [scratch_path(spark, "csv-alpha"), scratch_path(spark, "csv-alpha")]
    S.write_csv(odd_file, paths[0])
    S.write_csv(src.where(~even), paths[1])
    read = [normalize_headers(S.read_csv_strings(spark, p, quote_escape='"')) for p in paths]
    both = read[0].unionByName(read[1], allowMissingColumns=True)
    return both.select(*src.columns, "note")


_BENT = '''
SELECT CASE WHEN o_orderkey % 50 = 1 THEN o_orderkey || ',' || o_custkey
            WHEN o_orderkey % 50 = 2 THEN o_orderkey || ',"' || o_orderpriority || '",' || o_custkey || ',9'
            WHEN o_orderkey % 50 = 3 THEN o_orderkey || ',"' || o_orderpriority || ',' || o_custkey
            ELSE o_orderkey || ',"' || o_orderpriority || ', ""x""",' || o_custkey END AS line,
       CASE WHEN o_orderkey % 50 = 1 THEN 'too_few_fields' WHEN o_orderkey % 50 = 2 THEN 'too_many_fields'
            WHEN o_orderkey % 50 = 3 THEN 'broken_quote' END AS reason, o_orderkey
FROM orders'''


def _bent_csv(spark, sf):
    """Order lines as CSV text, three of fifty of them bent, and the two sides of their scan."""
    read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"]).createOrReplaceTempView("bent_orders")
    lines = spark.sql(_BENT.replace("FROM orders", "FROM bent_orders")).select("line")
    path = scratch_path(spark, "bent-csv")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # every file begins with the header: a task writes its header line first
    heads = spark.range(n).select(F.lit("key,priority,customer").alias("line"), F.col("id").alias("file"))
    body = lines.withColumn("file", F.pmod(F.xxhash64("line"), F.lit(n)))
    both = heads.withColumn("rank", F.lit(0)).unionByName(body.withColumn("rank", F.lit(1)))
    both.repartition(n, "file").sortWithinPartitions("file", "rank").select("line", "file").write.partitionBy("file").text(path)
    return S.scan_csv(spark, f"{path}/file=*", quote_escape='"')


@register("csv_rejects", f"SELECT line, reason FROM ({_BENT}) x WHERE reason IS NOT NULL", ids=("S1", "Q1"))
def csv_rejects(spark, sf):
    """Bad lines of CSV files, with their text and reason, as the quarantine has them after the load wrote them."""
    path = scratch_path(spark, "csv-rejects")
    _bent_csv(spark, sf)[1].write.parquet(path)
    return spark.read.schema("source_key string, line string, reason string").parquet(path).select("line", "reason")


@register("csv_good_lines", """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority || ', "x"' AS priority, CAST(o_custkey AS VARCHAR) AS customer FROM orders
WHERE o_orderkey % 50 NOT IN (1, 2, 3)""", ids=("S1",))
def csv_good_lines(spark, sf):
    return _bent_csv(spark, sf)[0]


@register("scan_parquet_by_load", with_fixtures("beta_processed") + "SELECT * FROM beta_processed",
          ids=("S3", "F6", "S10"))
def scan_parquet_by_load(spark, sf):
    path = scratch_path(spark, "staging")
    S.stage_append_parquet(processed_all(spark, sf), path)
    t = S.read_partitioned(spark, path, T.StructType([f for f in CLIENT_PROCESSED_SCHEMA.fields
                                                      if f.name != "load_id"]), ("load_id",))
    return t.where(F.col("load_id") == "load-beta-0001").select(*CLIENT_PROCESSED_SCHEMA.fieldNames())


@register("partitioned_sink_roundtrip", with_fixtures("alpha_processed") + f"""
SELECT *, {_parts_sql("order_date")} FROM alpha_processed WHERE order_date IS NOT NULL""", ids=("S6", "F3"))
def partitioned_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "processed-alpha")
    S.write_partitioned_by_date(load(spark, sf, "alpha").processed, path, "order_date", mode="overwrite")
    return S.read_partitioned(spark, path, CLIENT_PROCESSED_SCHEMA, PARTS)


@register("batch_partition_sink", with_fixtures("partner_processed") + f"""
SELECT *, replace(batch_id, '#', '_') AS batch, {_parts_sql("date")} FROM partner_processed""", ids=("S7", "P11"))
def batch_partition_sink(spark, sf):
    path = scratch_path(spark, "partner-processed")
    S.write_batch_partitioned(partner(spark, sf).processed, path, mode="overwrite")
    return S.read_partitioned(spark, path, PARTNER_PROCESSED_SCHEMA, ("batch",) + PARTS)


QUAR_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                            ("date", "source_type", "client_name", "show_name", "discount_code", "campaign_name",
                             "campaign_item_id")] +
                           [T.StructField(c, T.DoubleType()) for c in
                            ("revenue", "orders", "impressions", "revenue_per_order", "revenue_per_impression",
                             "impressions_per_order")] +
                           [T.StructField(c, T.StringType()) for c in
                            ("batch_id", "run_id", "source_key", "processed_at", "quarantine_reason")])


@register("quarantine_sink", with_fixtures("partner_quarantine") + """
SELECT *, replace(batch_id, '#', '_') AS batch FROM partner_quarantine""", ids=("S8",))
def quarantine_sink(spark, sf):
    path = scratch_path(spark, "partner-quarantine")
    S.write_quarantine(partner(spark, sf).quarantine, path)
    return S.read_partitioned(spark, path, QUAR_SCHEMA, ("batch",))


@register("schema_drift", """
SELECT 'alpha' AS client_name, 'note,region' AS extra_columns, 'subs_vs_non' AS missing_columns,
       (SELECT count(*) FROM orders) AS input_rows""", ids=("P10", "K3"))
def schema_drift_q(spark, sf):
    """Drift of the columns found in the files themselves against the spec's, next to the rows read."""
    from ferrule.plans.load_queries import spec
    path = scratch_path(spark, "csv-drift")
    S.write_csv(fx.alpha_orders(spark, sf).drop("subs_vs_non").selectExpr("*", "'r' AS region", "code AS ` note`"), path)
    found = normalize_headers(S.read_csv_strings(spark, path))
    d = schema_drift_columns(found.columns, list(spec("alpha").rename_columns))
    n = found.agg(F.count(F.lit(1)).alias("input_rows"))
    return n.select(F.lit("alpha").alias("client_name"),
                    F.array_join(d["extra_columns"], ",").alias("extra_columns"),
                    F.array_join(d["missing_columns"], ",").alias("missing_columns"), "input_rows")


@register("schema_drift_sample", with_fixtures("alpha_processed") + f"""
SELECT 'alpha' AS client_name, order_date, order_date AS date, {_parts_sql("order_date")}
FROM alpha_processed""", ids=("S9",))
def schema_drift_sample(spark, sf):
    agg = load(spark, sf, "alpha").aggregated
    sample = S.drift_sample(agg, "alpha", ["date"])
    path = scratch_path(spark, "drift-alpha")
    drift = schema_drift(spark, agg.columns, CLIENT_PROCESSED_SCHEMA.fieldNames(), "alpha")
    S.write_drift(drift, sample, path)
    schema = T.StructType([T.StructField("client_name", T.StringType()), T.StructField("order_date", T.DateType()),
                           T.StructField("date", T.DateType())])
    return S.read_partitioned(spark, f"{path}/sample", schema, PARTS)


@register("schema_drift_file_sample", """
SELECT 'alpha' AS client_name, CAST(o_orderdate AS DATE) AS order_date, 'r' || o_orderkey % 7 AS region,
       o_orderpriority AS note, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day,
       'note,region' AS extra_columns FROM orders""", ids=("S9", "P10"))
def schema_drift_file_sample(spark, sf):
    """Columns that came with a file beyond the spec's: their values by day, beside the report, both read back."""
    from ferrule.plans.load_queries import spec
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"])
    wanted = list(spec("alpha").rename_columns)
    path, out = scratch_path(spark, "csv-drift"), scratch_path(spark, "drift-files")
    S.write_csv(o.select(F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
                         *[F.lit("x").alias(c) for c in wanted if c != "order_date"],
                         F.concat(F.lit("r"), F.col("o_orderkey") % 7).alias(" region"), F.col("o_orderpriority").alias("note")), path)
    found = normalize_headers(S.scan_csv(spark, path, quote_escape='"')[0])
    report = schema_drift(spark, found.columns, wanted, "alpha")
    extra = sorted(set(found.columns) - set(wanted) - {"order_date"})
    S.write_drift(report, S.drift_sample(found.withColumn("order_date", F.col("order_date").cast("date")), "alpha", extra), out)
    told = spark.read.schema(report.schema).json(f"{out}/report").select("client_name", F.array_join("extra_columns", ",").alias("extra_columns"))
    schema = T.StructType([T.StructField("client_name", T.StringType()), T.StructField("order_date", T.DateType()),
                           *[T.StructField(c, T.StringType()) for c in extra]])
    return S.read_partitioned(spark, f"{out}/sample", schema, PARTS).join(told, "client_name")


@register("stage_append", with_fixtures("client_processed") + """
SELECT *, TIMESTAMP '2024-01-31 12:00:00' AS created_at FROM client_processed""", ids=("S10", "P8"))
def stage_append(spark, sf):
    path = scratch_path(spark, "stage-append")
    stamp = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")   # zone-free audit stamp
    S.stage_append_parquet(load(spark, sf, "alpha").processed.withColumn("created_at", stamp), path)
    rest = load(spark, sf, "beta").processed.unionByName(load(spark, sf, "gamma").processed)
    S.stage_append_parquet(rest.withColumn("created_at", stamp), path)
    schema = T.StructType([f for f in CLIENT_PROCESSED_SCHEMA.fields if f.name != "load_id"] +
                          [T.StructField("created_at", T.TimestampNTZType())])
    return S.read_partitioned(spark, path, schema, ("load_id",))


@register("bulk_stage_load", with_fixtures("partner_processed") + "SELECT * FROM partner_processed",
          ids=("S11", "W4"))
def bulk_stage_load(spark, sf):
    processed = partner(spark, sf).processed
    csv_path, stage = scratch_path(spark, "partner-csv"), scratch_path(spark, "partner-stage")
    S.write_csv(processed, csv_path)
    loaded = S.read_staging_csv(spark, csv_path, PARTNER_PROCESSED_SCHEMA)
    loaded.write.mode("overwrite").parquet(stage)          # W4: truncate + reload
    loaded.write.mode("overwrite").parquet(stage)          # reloading again leaves one copy
    return spark.read.schema(PARTNER_PROCESSED_SCHEMA).parquet(stage)


@register("batch_lineage", with_fixtures("partner_processed") + """
SELECT batch_id, run_id, source_key, CAST(min(date) AS VARCHAR) AS window_start,
       CAST(max(date) AS VARCHAR) AS window_end, count(*) AS rows_written
FROM partner_processed GROUP BY batch_id, run_id, source_key""", ids=("S12",))
def batch_lineage(spark, sf):
    """The counts and the window come from the write of the batch: the load runs once."""
    p, path, data = partner(spark, sf).processed, scratch_path(spark, "lineage"), scratch_path(spark, "lineage-data")
    batch = {f: getattr(partner_ctx(), f) for f in ("batch_id", "run_id", "source_key")}
    S.write_batch_with_lineage(p, data, path, batch)
    schema = "batch_id string, run_id string, source_key string, window_start string, window_end string, rows_written bigint"
    return spark.read.schema(schema).json(path).drop("batch")


@register("undated_rows", with_fixtures("alpha_processed") + """
SELECT count(*) AS rows_in, count(order_date) AS rows_written, count(*) - count(order_date) AS undated FROM (
  SELECT order_date FROM alpha_processed UNION ALL
  SELECT CASE WHEN orders % 2 = 0 THEN order_date END FROM alpha_processed) x""", ids=("F3", "S6", "S12"))
def undated_rows(spark, sf):
    """What a partitioned write says of the rows it dropped: the load, and again with every odd row undated."""
    rows = load(spark, sf, "alpha").processed
    odd = rows.withColumn("order_date", F.when(F.col("orders") % 2 == 0, F.col("order_date")))
    counts = S.write_partitioned_by_date(rows.unionByName(odd), scratch_path(spark, "undated"), mode="overwrite")
    return spark.createDataFrame([(counts["rows_in"], counts["rows_written"], counts["undated"])],
                                 "rows_in bigint, rows_written bigint, undated bigint")


@register("assert_nonempty", with_fixtures("gamma_processed") + "SELECT * FROM gamma_processed", ids=("F7",))
def assert_nonempty(spark, sf):
    path = scratch_path(spark, "staged-gamma")
    processed = load(spark, sf, "gamma").processed
    processed.write.parquet(path)
    return S.assert_nonempty(spark.read.schema(processed.schema).parquet(path), "gamma load")


def _manifest(spark, sf):
    """Two loads into one folder; a manifest of the files that the second one wrote (modified after
    the last file of the first), read back as entries."""
    path = scratch_path(spark, "manifest-src")
    processed = partner(spark, sf).processed
    S.write_batch_partitioned(processed.where("date < DATE '2024-01-15'"), path)
    first = S.files_written_since(spark, path, "1970-01-01 00:00:00").agg(
        (F.max("modified_at") + F.expr("INTERVAL 1 MILLISECOND")).cast("string")).first()[0]
    time.sleep(0.05)
    S.write_batch_partitioned(processed.where("date >= DATE '2024-01-15'"), path)
    mpath = scratch_path(spark, "manifest")
    S.write_manifest(spark, S.files_written_since(spark, path, first), mpath)
    return path, S.read_manifest_entries(spark, mpath)


@register("manifest_entries", with_fixtures("partner_processed") + f"""
SELECT DISTINCT {_parts_sql("date")}, true AS mandatory FROM partner_processed WHERE date >= DATE '2024-01-15'""",
          ids=("S5", "S4"))
def manifest_entries(spark, sf):
    _, entries = _manifest(spark, sf)
    part = lambda name: F.regexp_extract("url", f"/{name}=([0-9]+)/", 1).alias(name)
    return entries.select(*map(part, PARTS), "mandatory").distinct()


@register("load_manifest", with_fixtures("partner_processed") + """
SELECT * FROM partner_processed WHERE date >= DATE '2024-01-15'""", ids=("S3", "S4", "S5"))
def load_manifest(spark, sf):
    """The rows of the files that the manifest lists, its entries joined to the scan."""
    path, entries = _manifest(spark, sf)
    return S.read_manifest_rows(spark, path, entries, PARTNER_PROCESSED_SCHEMA, ("batch",) + PARTS).select(
        *PARTNER_PROCESSED_SCHEMA.fieldNames())


@register("raw_landing", with_fixtures("partner_raw") + """
SELECT count(*) AS data_rows, true AS unchanged FROM partner_raw""", ids=("S14",))
def raw_landing(spark, sf):
    """Land the raw partner CSV unchanged, twice (a retry), then compare every line, carriage
    returns and blanks included, with the source's."""
    src = scratch_path(spark, "partner-raw-src")
    S.write_csv(fx.partner_raw(spark, sf), src)
    dest = scratch_path(spark, "partner-raw-landed")
    S.land_raw(spark, f"{src}/*.csv", dest)
    S.land_raw(spark, f"{src}/*.csv", dest)
    lines = lambda p: spark.read.option("lineSep", "\n").text(p)
    check = lambda df: df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.crc32("value")).alias("c"),
                              F.count(F.when(~F.col("value").startswith("Report Date,"), 1)).alias("data_rows"))
    given, landed = check(lines(f"{src}/*.csv")).select("n", "c"), check(lines(dest))
    return landed.join(given.select(F.col("n").alias("gn"), F.col("c").alias("gc")), F.lit(True)).select(
        "data_rows", ((F.col("n") == F.col("gn")) & (F.col("c") == F.col("gc"))).alias("unchanged"))


@register("raw_landing_objects", with_fixtures("partner_raw") + """
SELECT count(*) AS data_rows, true AS unchanged FROM partner_raw""", ids=("S14", "S12"))
def raw_landing_objects(spark, sf):
    """Land the raw files as objects, twice (a retry); every file's length and digest, taken from the source again, are the landed ones,
    and the landed bytes hold the rows."""
    src, dest = scratch_path(spark, "partner-raw-src"), scratch_path(spark, "partner-raw-objects")
    S.write_csv(fx.partner_raw(spark, sf), src)
    for _ in range(2):
        S.land_objects(spark, src, dest, "*.csv")
    given = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(src).select(
        F.col("path").alias("source_key"), F.octet_length("content").cast("long").alias("n"), F.sha2("content", 256).alias("given"))
    landed = S.read_objects(spark, dest).withColumn("own", F.sha2("content", 256))
    same = (F.col("n") == F.col("length")) & (F.col("given") == F.col("sha256")) & (F.col("own") == F.col("sha256"))
    lines = F.size(F.split(F.rtrim(F.col("content").cast("string"), F.lit("\n")), "\n")) - 1  # without the header
    return given.join(landed, "source_key", "full").agg(
        F.sum(lines).cast("long").alias("data_rows"), F.bool_and(F.coalesce(same, F.lit(False))).alias("unchanged"))


@register("client_load_alpha_csv", with_fixtures("alpha_processed") + "SELECT * FROM alpha_processed",
          ids=("S1", "P1", "J1", "A1", "P5"))
def client_load_alpha_csv(spark, sf):
    """The alpha load from CSV files on disk: both inputs are written as CSV
    (headers included, the lookup header with a stray trailing space), read
    back as all-string columns and loaded."""
    from ferrule.plans.client_load import run_client_load
    from ferrule.plans.load_queries import client_ctx, spec
    orders, codes = fx.alpha_orders(spark, sf), fx.alpha_codes(spark, sf)
    p_orders, p_codes = scratch_path(spark, "alpha-orders-csv"), scratch_path(spark, "alpha-codes-csv")
    S.write_csv(orders, p_orders)
    S.write_csv(codes, p_codes)
    primary = S.read_csv_strings(spark, p_orders, orders.columns)
    lookup = S.read_csv_strings(spark, p_codes, codes.columns)
    return run_client_load(spark, spec("alpha"), primary, lookup, client_ctx("alpha")).processed

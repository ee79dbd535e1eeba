"""Views over the test tables that stand in for the feeds the engine consumes.

Every view is a lazy plan over the given Parquet tables, so its size grows
with the scale factor.  The matching DuckDB text lives in
``ferrule.oracles`` (the correctness oracle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.functions.clean import money_sum, safe_ratio
from ferrule.sources.tables import read_table

# Fixed load context used by the registered end-to-end queries.
LOAD_IDS = {"alpha": "load-alpha-0001", "beta": "load-beta-0001", "gamma": "load-gamma-0001"}
LOAD_EVENT_DATE = "2024-01-31"
LOAD_EVENT_NAME = "ObjectCreated"
PARTNER_BATCH = {"source_type": "adscribe", "start": "2024-01-01", "end": "2024-01-31",
                 "run_id": "ads_20240131T000000", "source_key": "raw/adscribe/source.csv",
                 "processed_at": "2024-01-31T00:00:00+00:00"}


def client_of(custkey: Column) -> Column:
    return (F.when(custkey % 3 == 0, "alpha").when(custkey % 3 == 1, "beta").otherwise("gamma"))


def _priority_code(col: str = "o_orderpriority") -> Column:
    return F.expr(f"substr({col}, 3)")


def client_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES 2.1: daily client fact rows from ``orders``."""
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    return (o.groupBy(F.lower(_priority_code()).alias("discount_code"),
                      F.col("o_orderdate").cast("date").alias("order_date"),
                      client_of(F.col("o_custkey")).alias("client_name"))
            .agg(F.count(F.lit(1)).alias("orders"), money_sum("o_totalprice").alias("revenue"))
            .select("discount_code", "orders", "revenue", "order_date", "client_name"))


def partner_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES 2.3: daily partner rows per show from ``events``."""
    e = read_table(spark, sf_dir, "events", ["ts", "user_id", "event_type", "value"])
    show = F.col("user_id") % 20
    purchase = F.col("event_type") == "purchase"
    agg = (e.groupBy(F.col("ts").cast("date").alias("date"),
                     F.concat(F.lit("show_"), show.cast("string")).alias("show_name"),
                     F.when(show % 3 == 0, "alpha").when(show % 3 == 1, "beta").otherwise("gamma").alias("client_name"),
                     F.concat(F.lit("code"), (show % 7).cast("string")).alias("discount_code"))
           .agg(money_sum(F.when(purchase, F.col("value")).otherwise(F.lit(0.0))).alias("revenue"),
                F.count(F.when(purchase, 1)).cast("double").alias("orders"),
                F.count(F.when(F.col("event_type") == "view", 1)).cast("double").alias("impressions")))
    return agg.select(
        "date", F.lit("adscribe").alias("source_type"), "client_name", "show_name", "discount_code",
        F.lit(None).cast("string").alias("campaign_name"), F.lit(None).cast("string").alias("campaign_item_id"),
        "revenue", "orders", "impressions",
        safe_ratio("revenue", "orders").alias("revenue_per_order"),
        safe_ratio("revenue", "impressions").alias("revenue_per_impression"),
        safe_ratio("impressions", "orders").alias("impressions_per_order"))


# --- dirty client inputs (FIXTURES 2.2) -------------------------------------

def alpha_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                             "o_orderdate", "o_orderpriority"])
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    date_txt = (F.when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd"))
                .when(k % 4 == 1, F.date_format(d, "MM/dd/yyyy"))
                .when(k % 4 == 2, F.date_format(d, "yyyy/MM/dd"))
                .when(k % 97 == 3, F.lit("junk"))
                .otherwise(F.date_format(d, "dd-MM-yyyy")))
    code = F.when(k % 2 == 0, F.concat(F.lit(" "), _priority_code(), F.lit(" "))).otherwise(F.lower(_priority_code()))
    return o.select(
        date_txt.alias("order_date"),
        code.alias("code"),
        F.concat(F.lit(" $"), F.format_number("o_totalprice", 2), F.lit(" ")).alias("subtotal_price"),
        F.when(F.col("o_orderstatus") == "F", "repeat").otherwise("new").alias("new_vs_repeat"),
        F.when(F.col("o_custkey") % 2 == 0, "sub").otherwise("non").alias("subs_vs_non"))


def alpha_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderpriority"])
    return (o.select(_priority_code().alias("Promo Code ")).distinct()
            .filter(F.col("Promo Code ") != "LOW"))


def beta_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"])
    one = F.lit("1")
    return li.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("Show "), (F.col("l_suppkey") % 20).cast("string")).alias("Show"),
        F.concat(F.lit("P"), (F.col("l_partkey") % 10).cast("string")).alias("Promo Code"),
        F.concat(F.lit("$"), F.format_number("l_extendedprice", 2)).alias("Sales"),
        F.col("l_quantity").cast("bigint").cast("string").alias("Orders"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber").cast("string")).alias("Sub Shipments"),
        F.when(F.col("l_linenumber") % 2 == 0, one).alias("New"),
        F.when(F.col("l_returnflag") == "R", one).alias("Lapsed"),
        F.when(F.col("l_linestatus") == "F", one).alias("Active"))


def beta_shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey"])
    show = (F.col("s_suppkey") % 20).alias("s")
    return (s.select(show).distinct().filter(F.col("s") < 18)
            .select(F.concat(F.lit(" SHOW "), F.col("s").cast("string")).alias("OMAHA SHOWNAME"),
                    F.concat(F.lit("BETA"), (F.col("s") % 6).cast("string")).alias("CODE"),
                    F.col("s").cast("string").alias("ShowID"),
                    F.when(F.col("s") % 2 == 0, "Y").otherwise("N").alias("Campaign Item?")))


def gamma_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                                             "o_orderpriority"])
    k = F.col("o_orderkey")
    plain = F.translate(F.expr("format_number(o_totalprice, '0.00')"), ".", ",")
    grouped = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    return o.select(
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("id"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("sale_date"),
        F.when(k % 10 == 0, grouped).otherwise(plain).alias("value_eur"),
        k.cast("string").alias("item_id"),
        (k % 5 + 1).cast("string").alias("units"),
        _priority_code().alias("code"))


def gamma_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    return (c.filter(F.col("c_custkey") % 10 != 0)
            .select(F.col("c_custkey").cast("string").alias("id"),
                    F.concat(F.lit("ACC"), F.col("c_custkey").cast("string")).alias("account_ref"),
                    F.col("c_name").alias("ref_name")))


CLIENT_INPUTS = {
    "alpha": (alpha_orders, alpha_codes),
    "beta": (beta_sales, beta_shows),
    "gamma": (gamma_sales, gamma_accounts),
}


# --- partner raw feed -------------------------------------------------------

def partner_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw partner CSV rows (all strings) built from ``events``.

    One row per (day, user): two date columns with a priority order, money
    with ``$`` and thousands commas, null tokens, blanks and a few negative
    or junk values so every cleaning and quarantine rule has work.
    """
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    purchase = F.col("event_type") == "purchase"
    g = (e.groupBy(F.col("ts").cast("date").alias("d"), F.col("user_id").alias("u"))
         .agg(money_sum(F.when(purchase, F.col("value")).otherwise(F.lit(0.0))).alias("rev"),
              F.count(F.when(purchase, 1)).alias("ord"),
              F.count(F.when(F.col("event_type") == "view", 1)).alias("imp"),
              F.min("event_id").alias("first_id")))
    u, i = F.col("u"), F.col("first_id")
    report_date = (F.when(i % 7 == 0, F.lit(None).cast("string"))
                   .when(i % 7 == 1, F.date_format("d", "MM/dd/yyyy"))
                   .when(i % 53 == 2, F.lit("not a date"))
                   .otherwise(F.date_format("d", "yyyy-MM-dd")))
    revenue = (F.when(i % 41 == 5, F.lit("N/A"))
               .when(i % 43 == 6, F.concat(F.lit("-"), F.format_number("rev", 2)))
               .otherwise(F.concat(F.lit("$"), F.format_number("rev", 2))))
    orders = F.when(i % 37 == 4, F.lit("-")).otherwise(F.col("ord").cast("string"))
    impressions = (F.when(i % 31 == 3, F.lit("n/a"))
                   .when(i % 29 == 2, F.lit("12d"))
                   .otherwise(F.concat(F.col("imp").cast("string"), F.lit(" "))))
    show = F.when(i % 47 == 7, F.lit("  ")).when(i % 59 == 8, F.lit("nan")).otherwise(F.concat(F.lit(" Show_"), (u % 20).cast("string"), F.lit(" ")))
    client = F.when(u % 3 == 0, "alpha").when(u % 3 == 1, "beta").otherwise("gamma")
    rows = g.select(
        report_date.alias("Report Date"),
        F.date_format("d", "yyyy-MM-dd").alias("Day"),
        client.alias("Client"),
        show.alias("Show"),
        F.when(i % 11 == 0, F.lit("NULL")).otherwise(F.concat(F.lit("CODE"), (u % 7).cast("string"))).alias("Promo Code"),
        F.concat(F.lit("Campaign "), (u % 5).cast("string")).alias("Campaign"),
        F.when(i % 13 == 0, F.lit("")).otherwise((u * 100 + 1).cast("string")).alias("Campaign Item ID"),
        revenue.alias("Revenue"),
        orders.alias("Orders"),
        impressions.alias("Impressions"),
        F.col("first_id"))
    # Every tenth row arrives twice (exact duplicates for the dedupe step);
    # a generator emits the copy, so the events are aggregated once.
    copies = F.explode(F.when(F.col("first_id") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("*", copies.alias("__copy")).drop("first_id", "__copy")


# --- upload events (FIXTURES 2.4) ----------------------------------------------

# Fixed file names for the upload events: the first two per client are the
# required files; the third is an upload nobody asked for.
UPLOAD_FILES = {
    "alpha": ["creator_alpha_orders.csv", "creator_alpha_codes.csv", "alpha_notes.txt"],
    "beta": ["creator_beta_sales.csv", "creator_beta_shows_and_codes.csv", "beta_readme.txt"],
    "gamma": ["creator_gamma_sales.csv", "salesforce_data_client3.csv", "gamma_extra.txt"],
}


def upload_event_fields(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Flat upload-notification fields per ``events`` row (before JSON).
    ``events`` may be a streaming DataFrame over the same table."""
    e = events if events is not None else read_table(spark, sf_dir, "events",
                                                     ["event_id", "ts", "user_id", "event_type"])
    client = (F.when(F.col("user_id") % 4 == 3, "delta")
              .when(F.col("user_id") % 3 == 0, "alpha")
              .when(F.col("user_id") % 3 == 1, "beta").otherwise("gamma"))
    slot = (F.when(F.col("event_type") == "purchase", 0)
            .when(F.col("event_type") == "signup", 1).otherwise(2))
    # on some days no required file of the second kind arrives
    slot = F.when((F.dayofmonth("ts") % 7 == 3) & (slot == 1), 2).otherwise(slot)
    names = F.create_map(*[x for c, files in list(UPLOAD_FILES.items()) + [("delta", ["d_orders.csv", "d_codes.csv", "d_x.txt"])]
                           for x in (F.lit(c), F.array(*[F.lit(f) for f in files]))])
    file_name = F.get(F.element_at(names, client), slot)
    # Some keys arrive URL-encoded the way storage notifications encode them.
    encoded_name = F.when(F.col("event_id") % 17 == 0,
                          F.regexp_replace(F.regexp_replace(file_name, "_", "%5F"), "creator", "creator+"))\
                    .otherwise(file_name)
    folder = F.when(F.col("event_id") % 19 == 0, F.lit("misc/")).otherwise(F.lit("raw/client_uploads/"))
    return e.select(
        F.col("event_id"),
        F.concat(folder, client, F.lit("/"), encoded_name).alias("key_raw"),
        F.when(F.col("event_id") % 23 == 0, F.lit(None).cast("string")).otherwise(F.lit("uploads-bucket")).alias("bucket"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"),
        (F.col("event_id") % 50).cast("string").alias("etag"),
        (F.col("event_id") % 2 == 0).alias("upper_etag_field"),
        F.col("ts"))


def upload_messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Queue messages (``message_id``, ``body``) carrying storage notifications.

    Most bodies are direct ``{"Records": [...]}``; every ninth is wrapped in a
    notification ``Message``; every 101st is invalid JSON and every 103rd has
    an empty ``Records`` list.
    """
    f = upload_event_fields(spark, sf_dir, events)
    obj = F.when(F.col("upper_etag_field"),
                 F.to_json(F.struct(F.col("key_raw").alias("key"), F.col("etag").alias("eTag"))))\
           .otherwise(F.to_json(F.struct(F.col("key_raw").alias("key"), F.col("etag").alias("etag"))))
    bucket = F.to_json(F.struct(F.col("bucket").alias("name"),
                                F.concat(F.lit("arn:aws:s3:::"), F.col("bucket")).alias("arn")))
    record = F.concat(F.lit('{"eventSource":"aws:s3","eventTime":"'), F.col("event_time"),
                      F.lit('","s3":{"bucket":'), bucket, F.lit(',"object":'), obj, F.lit("}}"))
    direct = F.concat(F.lit('{"Records":['), record, F.lit("]}"))
    wrapped = F.to_json(F.struct(direct.alias("Message")))
    body = (F.when(F.col("event_id") % 101 == 0, F.lit('{"Records": [ broken'))
            .when(F.col("event_id") % 103 == 0, F.lit('{"Records": []}'))
            .when(F.col("event_id") % 9 == 0, wrapped)
            .otherwise(direct))
    return f.select(F.concat(F.lit("m-"), F.col("event_id").cast("string")).alias("message_id"),
                    body.alias("body"), F.col("ts").cast("timestamp").alias("received_at"))


# --- refresh inputs (FIXTURES 2.5) ---------------------------------------------------

def refresh_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing client fact: rows before 2001, plus undated rows that must survive."""
    f = client_fact(spark, sf_dir)
    base = f.where(F.col("order_date") < F.lit("2001-01-01").cast("date"))
    undated = (f.where(F.col("order_date") < F.lit("1995-02-01").cast("date"))
               .withColumns({"order_date": F.lit(None).cast("date"),
                             "discount_code": F.concat(F.lit("undated-"), F.col("discount_code"))}))
    return base.unionByName(undated)


def refresh_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new load for alpha and beta in June 2000 with every tenth day missing."""
    f = client_fact(spark, sf_dir)
    d = F.col("order_date")
    return (f.where(F.col("client_name").isin("alpha", "beta") &
                    d.between(F.lit("2000-06-01").cast("date"), F.lit("2000-06-30").cast("date")) &
                    (F.dayofmonth(d) % 10 != 0))
            .withColumn("revenue", F.col("revenue") * 2))


# --- partner batch ledger ---------------------------------------------------------------

def batch_status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events of one partner batch per event day (append-only ledger)."""
    from ferrule.operators.ledger import short_error, status_event
    e = read_table(spark, sf_dir, "events", ["ts"])
    days = e.groupBy(F.col("ts").cast("date").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    ds = F.date_format("d", "yyyy-MM-dd")
    dom = F.dayofmonth("d")
    key = F.concat(F.lit("ADSCRIBE#"), ds, F.lit("#"), ds)
    at = lambda h: F.concat(ds, F.lit(f"T0{h}:00:00Z"))
    none = F.lit(None).cast("string")
    nrows = F.lit(None).cast("bigint")
    evs = F.array(
        status_event(key, F.lit(1), "RECEIVED", at(1), start_date=ds, end_date=ds,
                     run_id=F.concat(F.lit("ads_"), F.date_format("d", "yyyyMMdd")), raw_key=none,
                     processed_rows=nrows, error=none),
        F.when(dom % 5 != 0, status_event(key, F.lit(2), "RAW_LANDED", at(2), start_date=none, end_date=none,
                                          run_id=none, raw_key=F.concat(F.lit("raw/adscribe/"), ds, F.lit(".csv")),
                                          processed_rows=nrows, error=none)),
        F.when((dom % 5 != 0) & (dom % 7 != 0),
               status_event(key, F.lit(3), "PROCESSED", at(3), start_date=none, end_date=none, run_id=none,
                            raw_key=none, processed_rows=F.col("n"), error=none)),
        F.when((dom % 5 != 0) & (dom % 7 != 0) & (dom % 3 != 0),
               status_event(key, F.lit(4), "LOADED_TO_REDSHIFT", at(4), start_date=none, end_date=none,
                            run_id=none, raw_key=none, processed_rows=nrows, error=none)),
        F.when((dom % 5 != 0) & (dom % 7 != 0) & (dom % 3 == 0),
               status_event(key, F.lit(4), "FAILED", at(4), start_date=none, end_date=none, run_id=none,
                            raw_key=none, processed_rows=nrows,
                            error=short_error(F.concat(F.lit("load failed for "), ds)))),
    )
    return days.select(F.explode(F.array_compact(evs)).alias("ev")).select("ev.*")

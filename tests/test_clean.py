"""Column cleaners on small hand-written dirty values (one rule each)."""

from pyspark.sql import functions as F

from ferrule.functions import clean as C


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def col_values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_parse_multi_date_first_format_wins(spark):
    df = one_col(spark, ["2024-03-04", "03/04/2024", "1/5/2024", "04-03-2024", "junk", None])
    out = col_values(df.select(C.parse_multi_date("v", ["yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy", "dd-MM-yyyy"])
                               .cast("string").alias("d")), "d")
    # MM/dd/yyyy does not take one-digit months, M/d/yyyy does
    assert out == ["2024-03-04", "2024-03-04", "2024-01-05", "2024-03-04", None, None]


def test_canonical_date_priority(spark):
    df = spark.createDataFrame([("2024-01-02", "2024-01-09"), (None, "01/09/2024"), ("bad", None)], "a string, b string")
    out = col_values(df.select(C.canonical_date(["a", "b"], ["yyyy-MM-dd", "MM/dd/yyyy"]).alias("d")), "d")
    assert out == ["2024-01-02", "2024-01-09", None]


def test_clean_text(spark):
    df = one_col(spark, ["  x ", "", "   ", "N/A", " NULL ", None, "n/a2"])
    out = col_values(df.select(C.clean_text("v", null_tokens=["N/A", "NULL"]).alias("t")), "t")
    assert out == ["x", None, None, None, None, None, "n/a2"]


def test_clean_number_spec(spark):
    df = one_col(spark, [" $1,234.50 ", "-12", "abc", "", None, "1.2.3"])
    out = col_values(df.select(C.clean_number("v").alias("n")), "n")
    assert out == [1234.5, -12.0, None, None, None, None]


def test_clean_number_eu_keeps_reference_quirk(spark):
    df = one_col(spark, ["1.234,50", "946,26"])
    ref = col_values(df.select(C.clean_number_eu("v", "reference").alias("n")), "n")
    eu = col_values(df.select(C.clean_number_eu("v", "eu").alias("n")), "n")
    assert ref == [None, 946.26]          # K7: 1.234.50 does not parse
    assert eu == [1234.5, 946.26]


def test_clean_number_tokens(spark):
    df = one_col(spark, ["$1,200", "N/A", "-", "12d", "NaN", "50%", " 7 ", "-0.00", "1e3", "n/a5"])
    out = col_values(df.select(C.clean_number_tokens("v", ["N/A", "n/a"]).alias("n")), "n")
    # K20: "12d" and "NaN" are not plain numbers; tokens are removed as substrings (K8)
    assert out == [1200.0, None, None, None, None, 50.0, 7.0, 0.0, 1000.0, 5.0]


def test_token_order_longest_first():
    assert C.ordered_tokens(["NA", "N/A", "NULL", "na", " "]) == ["NULL", "N/A", "NA", "na"]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (None, 2.0), (3.0, None)], "a double, b double")
    assert col_values(df.select(C.safe_ratio("a", "b").alias("r")), "r") == [2.5, None, None, None]


def test_segment_split(spark):
    df = spark.createDataFrame([(9.0, 1.0, 1.0, 1.0), (8.0, 1.0, None, 0.0), (5.0, None, None, None)],
                               "o double, n double, l double, a double")
    cols = C.segment_split("o", {"new": "n", "lapsed": "l", "active": "a"})
    rows = df.withColumns(cols).select("active_segment_count", "new_orders", "lapsed_orders", "active_orders").collect()
    assert [tuple(r) for r in rows] == [(3, 3.0, 3.0, 3.0), (1, 8.0, 0.0, 0.0), (0, 0.0, 0.0, 0.0)]


def test_file_name_and_path_rules(spark):
    df = one_col(spark, ["raw/client_uploads/Alpha/creator+alpha%5Forders.CSV", "misc/a/b/c.csv",
                         "raw/client_uploads/x.csv", "raw/client_uploads/beta/sub/f.csv"], "k")
    names = col_values(df.select(C.canonical_file_name("k").alias("n")), "n")
    assert names == ["creator alpha_orders", "c", "x", "f"]
    clients = col_values(df.select(C.client_from_path("k").alias("c")), "c")
    assert clients == ["alpha", None, None, "beta"]


def test_keys(spark):
    df = spark.createDataFrame([("alpha", "raw/x.csv", "2024-01-01", None)], "c string, k string, d string, e string")
    r = df.select(C.idempotency_key("c", "k", "d", "e").alias("i"), C.execution_lock_key("c", "d").alias("l"),
                  C.batch_key("ADSCRIBE", F.col("d"), F.col("d")).alias("b")).first()
    assert r.i == "alpha|raw/x.csv|2024-01-01|"
    assert r.l == "execution_lock|alpha|2024-01-01"
    assert r.b == "ADSCRIBE#2024-01-01#2024-01-01"


def test_event_date_fallback(spark):
    df = one_col(spark, ["2024-02-03T10:00:00Z", ""])
    out = col_values(df.select(C.event_date_from_ts("v", F.lit("2000-01-01")).alias("d")), "d")
    assert out == ["2024-02-03", "2000-01-01"]


def test_glob_regex(spark):
    df = one_col(spark, ["salesforce_data_client3.csv", "creator_gamma_sales.csv", "x.CSV", "a[1].csv"])
    m = df.select(*[F.col("v").rlike(C.glob_to_regex(p)).alias(str(i)) for i, p in
                    enumerate(["*sales*.csv", "*.csv", "a[[]1].csv"])]).collect()
    assert [tuple(r) for r in m] == [(True, True, False), (True, True, False), (False, True, False),
                                     (False, True, True)]


def test_null_na_tokens(spark):
    df = one_col(spark, ["NA", "", "x", "nan", " NA"])
    assert col_values(df.select(C.null_na_tokens("v").alias("t")), "t") == [None, None, "x", None, " NA"]

"""History of the headers that files came with, and drift against the last accepted one.

A header is a set of column names (trimmed, lower case: files are read by name, so order is no
drift) with a fingerprint.  The history has one row per client, day and fingerprint; a header is
accepted if it holds every required column of its client.  Each header is held against the client's last
accepted one of an earlier day, so a column that stays is told once, on the day it comes, which a comparison
with the spec alone would repeat every day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrule.sources.sinks import file_headers

FIRST, SAME, CHANGED = "first", "same", "changed"
HISTORY_DDL = "client_name string, fingerprint string, columns array<string>, files long, accepted boolean, day string"


def header_columns(header: Column) -> Column:
    """The sorted distinct names of a header line; quoted names may hold commas, and blank names are left out."""
    fields = F.split(header, r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    names = F.transform(fields, lambda f: F.lower(F.trim(F.replace(F.regexp_replace(F.trim(f), r'^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))))
    return F.array_sort(F.array_distinct(F.filter(names, lambda n: n != "")))


def fingerprint(columns: Column) -> Column:
    return F.sha2(F.to_json(columns), 256)


def observe_headers(spark: SparkSession, paths: list[str], client_pattern: str, day_pattern: str) -> DataFrame:
    """``(client_name, day, file, header)`` of the files under ``paths``: one line a file is read.  The patterns' first
    groups take client and day from a file's path; files they do not fit are left out."""
    rows = [(file, header) for header, files in file_headers(spark, paths).items() for file in files]
    seen = spark.createDataFrame(rows, "file string, header string")
    client, day = F.regexp_extract("file", client_pattern, 1), F.regexp_extract("file", day_pattern, 1)
    return seen.select(client.alias("client_name"), day.alias("day"), "file", "header").where((client != "") & (day != ""))


def fold_headers(observed: DataFrame, required: dict[str, Sequence[str]]) -> DataFrame:
    """The history rows of observed files: one per client, day and fingerprint, with the number of files that had it.
    A client without required columns accepts every header."""
    columns = header_columns(F.col("header"))
    rows = observed.select("client_name", "day", columns.alias("columns")).withColumn("fingerprint", fingerprint(F.col("columns")))
    needed = F.array().cast("array<string>")
    for client, names in required.items():
        own = F.array(*[F.lit(n.strip().lower()) for n in names]).cast("array<string>")
        needed = F.when(F.col("client_name") == client, own).otherwise(needed)
    # equal fingerprints have equal columns, so the columns are a key, not a value to be picked
    return (rows.groupBy("client_name", "fingerprint", "columns", "day").agg(F.count(F.lit(1)).alias("files"))
            .select("client_name", "fingerprint", "columns", "files", (F.size(F.array_except(needed, "columns")) == 0).alias("accepted"), "day"))


def write_headers(history: DataFrame, path: str) -> None:
    """Add days to the history table; a day that is written again, as by a retry, is replaced."""
    (history.select(*[f.split(" ")[0] for f in HISTORY_DDL.split(", ")]).hint("rebalance", "day").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY_DDL).parquet(path)


def header_drift(history: DataFrame) -> DataFrame:
    """Each history row with ``base`` (the fingerprint it is held against), ``extra_columns``, ``missing_columns`` and ``status``.

    A day on which several headers of a client were accepted hands on the one of most files (then the smallest
    fingerprint).  Days are text or dates that sort in time."""
    best = Window.partitionBy("client_name", "day").orderBy(F.col("files").desc(), "fingerprint")
    accepted = (history.where("accepted").withColumn("at", F.row_number().over(best)).where("at = 1")
                .select("client_name", "day", F.struct("fingerprint", "columns").alias("own")))
    days = history.select("client_name", "day").distinct().join(accepted, ["client_name", "day"], "left")
    before = Window.partitionBy("client_name").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    bases = days.select("client_name", "day", F.last("own", ignorenulls=True).over(before).alias("last"))
    none = F.array().cast("array<string>")
    base = F.coalesce("last.columns", none)
    extra = F.when(F.col("last").isNull(), none).otherwise(F.array_except("columns", base))
    status = (F.when(F.col("last").isNull(), FIRST).when(F.col("last.fingerprint") == F.col("fingerprint"), SAME).otherwise(CHANGED))
    return history.join(bases, ["client_name", "day"]).select(
        "client_name", "day", "fingerprint", "columns", "files", "accepted", F.col("last.fingerprint").alias("base"),
        extra.alias("extra_columns"), F.array_except(base, "columns").alias("missing_columns"), status.alias("status"))

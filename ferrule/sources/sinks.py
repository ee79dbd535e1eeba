"""Sources and sinks (S1, S3-S14) and the partition-scoped refresh publish.

All paths are caller-supplied; tests and registered queries write under the
session's shared checkpoint folder (``ferrule.session.scratch_path``).
Partitioned writes use the ``rebalance`` hint on their partition columns:
rows of one partition value meet in few tasks (few, large files instead of
one small file per task and day), and AQE splits a skewed value — a day or a
load holding a third of all rows — across several writers.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrule.functions.clean import path_safe_key
from ferrule.sources.folders import empty_files, first_lines


def all_string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# --- CSV ---------------------------------------------------------------------------

def file_headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The first line of every CSV file under ``paths``, grouped: header line → files.

    One line a file is read; uploads of over a thousand files are read by a job over the files' first blocks instead, of which a
    row per file comes back.
    """
    found = first_lines(spark, paths)
    if found is None:
        lines = spark.read.option("lineSep", "\n").text(paths).select(
            "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"))
        firsts = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
        found = {r["file"]: r["header"].removesuffix("\r") for r in firsts.collect()}
    out: dict[str, list[str]] = {}
    for file in sorted(found):
        out.setdefault(found[file], []).append(file)
    return out


TOO_FEW, TOO_MANY, BROKEN_QUOTE = "too_few_fields", "too_many_fields", "broken_quote"


def scan_csv(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
             quote_escape: str = "\\") -> tuple[DataFrame, DataFrame]:
    """The good lines of CSV files as string columns (as ``read_csv_strings``), and the bad ones as
    ``(source_key, line, reason)``: lines with fewer or more fields than their file's header, and lines with a quoted field that does not end.

    One scan of the text per distinct header; both results are filters over it, so every line is in
    exactly one of them.  Blank lines are neither, and a line that repeats its file's header is a header, not
    data.  Records do not go over line ends here (``read_csv_strings(multiline=True)`` reads such files).
    """
    inside = r'[^"]*+(?:""[^"]*+)*+' if quote_escape == '"' else r'[^"\\]*+(?:\\.[^"\\]*+)*+'
    good = bad = None
    for header, files in file_headers(spark, [path] if isinstance(path, str) else list(path)).items():
        names = spark.range(1).select(F.from_csv(F.lit(header), F.lit(", ".join(
            f"c{k} string" for k in range(header.count(",") + 1))), {"escape": quote_escape}).alias("h")).first()["h"]
        bare = F.regexp_replace("line", rf'(^|,)"{inside}"(?=,|$)', "$1")  # quoted fields left empty
        width = F.size(F.split(bare, ",", -1))
        names = list(names)[:_width(header, inside)]
        reason = (F.when(bare.rlike('(^|,)"'), BROKEN_QUOTE).when(width < len(names), TOO_FEW).when(width > len(names), TOO_MANY))
        lines = spark.read.text(files).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_key"))
        lines = lines.where((F.trim("line") != "") & (F.col("line") != header)).withColumn("reason", reason)
        schema = ", ".join(f"c{k} string" for k in range(len(names)))
        fields = F.from_csv("line", schema, {"escape": quote_escape, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
        parsed = lines.where(F.col("reason").isNull()).select(fields.alias("f"))
        part = parsed.select(*(F.col(f"f.c{k}").alias(n) for k, n in enumerate(names)))
        own = lines.where(F.col("reason").isNotNull()).select("source_key", "line", "reason")
        good = part if good is None else good.unionByName(part, allowMissingColumns=True)
        bad = own if bad is None else bad.unionByName(own)
    if good is None:
        return (spark.createDataFrame([], all_string_schema(columns or [])),
                spark.createDataFrame([], all_string_schema(["source_key", "line", "reason"])))
    have = {c.strip() for c in good.columns}
    missing = [c for c in columns or [] if c.strip() not in have]
    return (good.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else good), bad


def _width(line: str, inside: str) -> int:
    """The number of fields of a line."""
    return len(re.sub(rf'(^|,)"{inside}"(?=,|$)', r"\1", line).split(","))


def read_csv_strings(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
                     quote_escape: str = "\\", multiline: bool = False) -> DataFrame:
    """CSV with a header, every column read as STRING (no inference —
    inferred doubles re-stringified by the cleaning SQL would corrupt).

    The columns are the files' own, in their own order; files with different headers are
    read apart and united by name.  ``columns`` names columns the caller needs: those that no file has are added as
    nulls.  ``quote_escape='"'`` reads doubled quotes; ``multiline`` allows line
    breaks inside quotes, at the price that a file is no longer split.
    """
    paths = [path] if isinstance(path, str) else list(path)
    out = None
    for files in file_headers(spark, paths).values():
        part = (spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE")
                .option("quote", '"').option("escape", quote_escape).option("multiLine", multiline)
                .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(files))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], all_string_schema(columns or []))
    have = {c.strip() for c in out.columns}
    missing = [c for c in columns or [] if c.strip() not in have]
    return out.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else out


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV writer that keeps surrounding spaces (the writer trims by default)
    and doubles quotes inside quotes."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def read_staging_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S11 (CSV form): empty and blank fields load as null."""
    df = (spark.read.schema(schema).option("header", True).option("emptyValue", None)
          .option("nullValue", "").csv(path))
    blanks = {f.name: F.when(F.trim(F.col(f.name)) == "", None).otherwise(F.col(f.name))
              for f in schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(blanks) if blanks else df


# --- partitioned Parquet sinks -------------------------------------------------------

def with_date_parts(df: DataFrame, date_col: str) -> DataFrame:
    d = F.col(date_col).cast("date")
    return df.withColumns({"year": F.date_format(d, "yyyy"), "month": F.date_format(d, "MM"),
                           "day": F.date_format(d, "dd")})


def _observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with counts taken as its rows pass.  Put it after the last exchange: there a row counts once, also
    where tasks of an earlier stage run again on other executors."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen


def write_partitioned_by_date(df: DataFrame, path: str, date_col: str = "order_date",
                              extra_partitions: tuple[str, ...] = (), mode: str = "append",
                              fmt: str = "parquet") -> dict:
    """Drop undated rows, partition by (extras..., year, month, day).  Returns ``rows_in``, ``rows_written``, ``undated``,
    ``first_date`` and ``last_date``, observed in the write itself."""
    parts = list(extra_partitions) + ["year", "month", "day"]
    date = F.col(date_col)
    dealt, seen = _observed(with_date_parts(df, date_col).hint("rebalance", *parts), rows_in=F.count(F.lit(1)), rows_written=F.count(date),
                            undated=F.count_if(date.isNull()), first_date=F.min(date).cast("string"), last_date=F.max(date).cast("string"))
    dealt.where(date.isNotNull()).write.mode(mode).partitionBy(*parts).format(fmt).save(path)
    return seen.get


def write_batch_partitioned(df: DataFrame, path: str, date_col: str = "date", batch_col: str = "batch_id",
                            fmt: str = "parquet", mode: str = "append") -> dict:
    """Batch-rooted layout ``batch=<path-safe id>/year/month/day``.  One
    partitioned write replaces the per-day Python loop; ``fmt='csv'`` is the
    fallback format."""
    out = df.withColumn("batch", path_safe_key(F.col(batch_col)))
    return write_partitioned_by_date(out, path, date_col, ("batch",), mode, fmt)


def write_batch_with_lineage(df: DataFrame, path: str, lineage_path: str, batch: dict[str, str], date_col: str = "date") -> dict:
    """S7 + S12: one batch written, and its lineage row (``batch``: batch_id, run_id and the like, the window and the
    counts) from what the write saw: the load runs once."""
    counts = write_batch_partitioned(df.withColumn("batch_id", F.lit(batch["batch_id"])), path, date_col, mode="overwrite")
    row = {**batch, "window_start": counts["first_date"], "window_end": counts["last_date"], "rows_in": counts["rows_in"],
           "rows_written": counts["rows_written"], "undated": counts["undated"]}
    ddl = ", ".join(f"{k} {'bigint' if k in ('rows_in', 'rows_written', 'undated') else 'string'}" for k in row)
    write_lineage(df.sparkSession.createDataFrame([tuple(row.values())], ddl), lineage_path)
    return row


def write_quarantine(df: DataFrame, path: str, batch_col: str = "batch_id") -> None:
    """Quarantine rows, one folder per batch; a batch written again replaces itself."""
    replace_partitions(df.withColumn("batch", path_safe_key(F.col(batch_col))), path, ["batch"])


def write_split(flagged: DataFrame, path: str, reasons_col: str = "quarantine_reasons", reasons: tuple[str, ...] = ()) -> dict:
    """Q1 / Q2: good and bad rows in one write, so the load runs once.  ``reasons_col`` is an array
    of reasons; rows go to ``is_quarantined=false`` or ``=true``.  Returns ``rows_in``, ``good``, ``bad`` and the rows that have each of
    ``reasons``, observed in the write."""
    by_reason = {r: F.count_if(F.array_contains(reasons_col, r)) for r in reasons}
    flagged, seen = _observed(flagged, rows_in=F.count(F.lit(1)), good=F.count_if(F.size(reasons_col) == 0),
                              bad=F.count_if(F.size(reasons_col) > 0), **by_reason)
    out = flagged.withColumn("quarantine_reason", F.array_join(reasons_col, ";")).withColumn(
        "is_quarantined", F.size(reasons_col) > 0).drop(reasons_col)
    out.write.mode("overwrite").partitionBy("is_quarantined").parquet(path)
    return seen.get


def read_split(spark: SparkSession, path: str, schema: T.StructType, quarantined: bool) -> DataFrame:
    """One side of ``write_split``; the other side's folder is not read."""
    full = T.StructType([*schema.fields, T.StructField("quarantine_reason", T.StringType()),
                         T.StructField("is_quarantined", T.BooleanType())])
    side = spark.read.schema(full).parquet(path).where(F.col("is_quarantined") == F.lit(quarantined)).drop("is_quarantined")
    return side if quarantined else side.drop("quarantine_reason")


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     partition_strings: tuple[str, ...] = ()) -> DataFrame:
    """Read a partitioned table; partition columns listed in
    ``partition_strings`` keep their text form (``"03"`` stays ``"03"``)."""
    if schema is None:
        return spark.read.parquet(path)
    full = T.StructType(list(schema.fields) + [T.StructField(p, T.StringType()) for p in partition_strings])
    return spark.read.schema(full).parquet(path)


# --- drift, lineage, manifests ----------------------------------------------------------

def write_drift(drift: DataFrame, sample: DataFrame | None, path: str) -> None:
    """JSON drift report, plus a Parquet sample of the extra columns
    partitioned by date."""
    drift.write.mode("overwrite").json(f"{path}/report")
    if sample is not None:
        write_partitioned_by_date(sample, f"{path}/sample", "order_date", mode="overwrite")


def drift_sample(df: DataFrame, client_name: str, extra_columns: list[str]) -> DataFrame:
    """S9 sample: client, order date (from ``date`` when needed) and the extra columns."""
    s = df.withColumn("client_name", F.lit(client_name))
    if "order_date" not in s.columns:
        s = s.withColumn("order_date", F.col("date").cast("date") if "date" in s.columns
                         else F.lit(None).cast("date"))
    keep = ["client_name", "order_date"] + [c for c in extra_columns if c in s.columns and
                                            c not in ("client_name", "order_date")]
    return s.select(*keep)


def write_manifest(spark: SparkSession, files: DataFrame, path: str, url_col: str = "url") -> None:
    """S5 writer: one ``{"url", "mandatory"}`` entry per line, written by as
    many tasks as the file list has partitions — a load with a million
    files never becomes one array in one task."""
    files.select(F.col(url_col).alias("url"), F.lit(True).alias("mandatory")).write.mode("overwrite").json(path)


def read_manifest_entries(spark: SparkSession, path: str, multiline_document: bool = False) -> DataFrame:
    """Manifest → one row per entry; empty manifests raise.  Accepts the
    line-per-entry form and (``multiline_document``) the single
    ``{"entries": [...]}`` document."""
    if multiline_document:
        m = spark.read.option("multiline", True).json(path)
        entries = m.select(F.explode("entries").alias("e")).select(F.col("e.url").alias("url"),
                                                                   F.col("e.mandatory").alias("mandatory"))
    else:
        entries = spark.read.schema("url string, mandatory boolean").json(path)
    if entries.isEmpty():
        raise ValueError(f"manifest {path} has no entries")
    return entries


def files_written_since(spark: SparkSession, path: str, not_before: str, glob: str = "*.parquet") -> DataFrame:
    """Files under ``path`` modified at or after ``not_before``.  The
    ``binaryFile`` source lists files in parallel and, with ``content`` not
    selected, reads no file bodies — no driver-side listing loop."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
             .load(path).select(F.col("path").alias("url"), F.col("modificationTime").alias("modified_at")))
    return files.where(F.col("modified_at") >= F.lit(not_before).cast("timestamp"))


def land_raw(spark: SparkSession, source: str, dest: str) -> DataFrame:
    """Land the raw text unchanged before transforming it — split at line
    feeds only (carriage returns and blank lines stay) and spread over tasks
    like any scan.  ``dest`` is the load's own folder: landing again replaces it.
    Returns the lines per source file."""
    raw = spark.read.option("lineSep", "\n").text(source).select("value", F.col("_metadata.file_path").alias("source_key"))
    raw.select("value").write.mode("overwrite").option("lineSep", "\n").text(dest)
    return raw.groupBy("source_key").agg(F.count(F.lit(1)).alias("lines"))


def land_objects(spark: SparkSession, source: str, dest: str, glob: str = "*") -> DataFrame:
    """Every source file landed unchanged as one object: a row with its key, byte length, SHA-256 and bytes, whatever its line
    ends, empty files included.  ``dest`` is the load's own folder: landing again replaces it.  A file is one row in one
    task, so it must fit there (Spark reads files of up to 2 GB so and fails on larger ones; ``land_raw`` takes those by lines).
    Returns the landed objects without their bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(source)
    empty = spark.createDataFrame(empty_files(spark, source, glob), "path string, ms bigint").select(
        "path", F.timestamp_millis("ms").alias("modificationTime"), F.lit(0).cast("bigint").alias("length"), F.lit("").cast("binary").alias("content"))
    files.unionByName(empty).select(
        F.col("path").alias("source_key"), F.col("modificationTime").alias("modified_at"), "length",
        F.sha2("content", 256).alias("sha256"), "content").write.mode("overwrite").parquet(dest)
    return read_objects(spark, dest).drop("content")


def read_objects(spark: SparkSession, dest: str) -> DataFrame:
    return spark.read.schema("source_key string, modified_at timestamp, length bigint, sha256 string, content binary").parquet(dest)


def _plain_url(c: Column) -> Column:
    """File names written with one or three slashes are the same."""
    return F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")


def read_manifest_rows(spark: SparkSession, base: str, entries: DataFrame, schema: T.StructType, parts: tuple[str, ...]) -> DataFrame:
    """The rows of the files that a manifest lists, under the partitioned folder ``base``.  The entries are joined to the scan, so no
    list of files comes to the driver: by the partition values in their urls, which prune folders while the query runs
    where the entries are small enough for Catalyst to broadcast, and by file.  ``parts`` are read as strings."""
    value = lambda p: F.regexp_extract("url", f"/{p}=([^/]+)/", 1).alias(f"__{p}")
    wanted = entries.where(F.col("url") > "").select(_plain_url(F.col("url")).alias("__file"), *map(value, parts)).distinct()
    full = T.StructType([*schema.fields, *[T.StructField(p, T.StringType()) for p in parts]])
    rows = spark.read.schema(full).parquet(base).withColumn("__at", _plain_url(F.col("_metadata.file_path")))
    same = F.col("__at") == F.col("__file")
    for p in parts:
        same = same & (F.col(p) == F.col(f"__{p}"))
    return rows.join(wanted, same, "left_semi").drop("__at")


def assert_nonempty(df: DataFrame, what: str = "load") -> DataFrame:
    """fail when a load has no rows.  Pass the staged rows: on an aggregated
    plan ``isEmpty`` would run the load."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


# --- staging and publish -------------------------------------------------------------------

def stage_append_parquet(df: DataFrame, path: str, partition_col: str = "load_id") -> None:
    """S10 stand-in for the JDBC append: add loads to a Parquet staging table
    partitioned by load id; a load that is staged again replaces itself."""
    replace_partitions(df, path, [partition_col])


def drop_load(spark: SparkSession, table: str, load_id: str, partition_col: str = "load_id") -> None:
    """W5 published: drop a promoted load's partition from a catalog staging table."""
    value = load_id.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_col} = '{value}')")


def stage_append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """JDBC append (needs the driver jar on the classpath)."""
    df.write.mode("append").jdbc(url, table, properties=properties or {})


def replace_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """W3 / W4 publish: dynamic partition overwrite — only the partitions
    present in ``df`` are replaced."""
    (df.hint("rebalance", *partition_cols).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path))


def write_lineage(df: DataFrame, path: str) -> None:
    """One folder per batch; a batch written again replaces itself."""
    (df.withColumn("batch", path_safe_key(F.col("batch_id"))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch").json(path))


# --- catalog tables (S13) and the published refresh (W1, W2, K14) -----------------------

def create_table_if_missing(spark: SparkSession, name: str, schema: T.StructType, location: str,
                            partition_cols: list[str]) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(f"`{c}`" for c in partition_cols)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet PARTITIONED BY ({parts}) "
              f"LOCATION '{location}'")


def insert_partitions(df: DataFrame, table: str, partition_cols: list[str]) -> None:
    """Dynamic partition overwrite into a catalog table: only partitions
    present in ``df`` are replaced."""
    spark = df.sparkSession
    cols = spark.table(table).columns
    # insertInto reads the overwrite mode from the session, not from writer
    # options; set it for this insert only and restore the caller's value
    key = "spark.sql.sources.partitionOverwriteMode"
    previous = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        df.select(*cols).hint("rebalance", *partition_cols).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, previous)


FEW_CLIENTS = 200


def refresh_table_by_load(spark: SparkSession, table: str, load: DataFrame, scratch: str,
                          client_col: str = "client_name", date_col: str = "order_date",
                          month_col: str = "month") -> None:
    """W2 published: recompute the (client, month) partitions of a versioned table that the load's
    per-client [min, max] range touches, and publish them in one statement (``versioned.publish``).

    The load is staged once.  The ranges of up to ``FEW_CLIENTS`` clients become literal
    partition filters on the fact; those of more are joined, with the months of all of them as a literal filter.  A client with
    undated rows also rereads its undated partition, whose rows stay.  The number
    of jobs does not depend on the length of the range or the number of clients.
    """
    from ferrule.operators.refresh import refresh_by_load
    from ferrule.sources import versioned
    read = versioned.current_set(spark, table)
    fact = spark.table(table)
    load.select(*[c for c in fact.columns if c != month_col]).write.mode("overwrite").parquet(scratch)
    incoming = spark.read.schema(fact.drop(month_col).schema).parquet(scratch)
    month = lambda c: F.date_format(c, "yyyy-MM")
    ranges = incoming.groupBy(F.col(client_col).alias("of")).agg(
        month(F.min(date_col)).alias("lo"), month(F.max(date_col)).alias("hi"), F.max(F.col(date_col).isNull()).alias("undated"))
    few = ranges.limit(FEW_CLIENTS + 1).collect()
    hit = lambda lo, hi, undated: F.col(month_col).between(lo, hi) | (undated & F.col(month_col).isNull())
    if len(few) <= FEW_CLIENTS:
        touched = F.lit(False)
        for r in few:
            touched = touched | (F.col(client_col).eqNullSafe(F.lit(r["of"])) & hit(*map(F.lit, (r["lo"], r["hi"], r["undated"]))))
        touched = F.coalesce(touched, F.lit(False))
        current, untouched = fact.where(touched), lambda sets: sets.where(~touched)
    else:
        span = ranges.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
        inside = F.col(month_col).isNull() | F.coalesce(F.col(month_col).between(F.lit(span["lo"]), F.lit(span["hi"])), F.lit(False))
        same = F.col(client_col).eqNullSafe(F.col("of")) & F.coalesce(hit(F.col("lo"), F.col("hi"), F.col("undated")), F.lit(False))
        current, untouched = fact.where(inside).join(ranges, same, "left_semi"), lambda sets: sets.join(ranges, same, "left_anti")
    refreshed = refresh_by_load(current.drop(month_col), incoming, client_col, date_col).withColumn(
        month_col, month(F.col(date_col)))
    versioned.publish(spark, table, refreshed, untouched, read)


def refresh_table_by_window(spark: SparkSession, table: str, staging: DataFrame, source_type: str, start: str, end: str,
                            date_col: str = "date", source_col: str = "source_type", month_col: str = "month") -> None:
    """W1 published: replace one source's rows dated inside [start, end] in a versioned fact partitioned
    by (source, month); only the window's months are read, and one statement publishes them."""
    from ferrule.operators.refresh import refresh_window
    from ferrule.sources import versioned
    read = versioned.current_set(spark, table)
    touched = F.coalesce((F.col(source_col) == source_type) & F.col(month_col).between(start[:7], end[:7]), F.lit(False))
    current = spark.table(table).where(touched)
    refreshed = refresh_window(current.drop(month_col), staging, source_type, start, end, date_col, source_col).withColumn(
        month_col, F.date_format(date_col, "yyyy-MM"))
    versioned.publish(spark, table, refreshed, lambda sets: sets.where(~touched), read)

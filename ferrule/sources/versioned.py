"""Fact tables published by one catalog statement.

A versioned table ``name`` is three catalog entries:

* ``name_rows``: the rows, partitioned by the fact's partition columns and ``version``.  Folders are only ever added.
* ``name_sets``: for each published set the version of every partition in it, a row a partition, partitioned by ``set_id``.
* ``name``: the view that readers use.  It joins the rows with the one set that its definition names.

``publish`` writes the refreshed partitions as a new version, then the new set (the untouched partitions with their old versions and the
new ones), and last replaces the view: until that statement readers see the old set, after it the new one, and a reader whose plan was made before it
goes on reading the old versions' files.  A run that fails earlier leaves folders that no set names; ``vacuum`` drops them.
One writer publishes at a time; a writer that finds another set than the one it read raises.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrule.sources.sinks import create_table_if_missing, insert_partitions

SET_PROPERTY = "ferrule.set_id"


class StalePublish(RuntimeError):
    """Another writer published since this one read the table."""


def create(spark: SparkSession, name: str, schema: T.StructType, location: str, parts: list[str]) -> None:
    """The tables and an empty view, where they are missing."""
    text = T.StringType()
    rows = T.StructType([*[f for f in schema.fields if f.name not in parts], *[schema[p] for p in parts], T.StructField("version", text)])
    sets = T.StructType([*[schema[p] for p in parts], T.StructField("version", text), T.StructField("set_id", text)])
    create_table_if_missing(spark, f"{name}_rows", rows, f"{location}/rows", [*parts, "version"])
    create_table_if_missing(spark, f"{name}_sets", sets, f"{location}/sets", ["set_id"])
    if not spark.catalog.tableExists(name):
        _point(spark, name, "none", schema.fieldNames(), parts)


def _point(spark: SparkSession, name: str, set_id: str, columns: list[str], parts: list[str]) -> None:
    """The commit: one statement."""
    listed = ", ".join(f"r.`{c}`" for c in columns)
    same = " AND ".join(f"r.`{p}` <=> s.`{p}`" for p in parts)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{SET_PROPERTY}' = '{set_id}') AS SELECT {listed} FROM {name}_rows r "
              f"JOIN (SELECT * FROM {name}_sets WHERE set_id = '{set_id}') s ON r.version = s.version AND {same}")


def current_set(spark: SparkSession, name: str) -> str:
    """The id of the set that readers see now."""
    row = spark.sql(f"SHOW TBLPROPERTIES {name} ('{SET_PROPERTY}')").first()
    return row["value"]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c for c in spark.table(f"{name}_sets").columns if c not in ("version", "set_id")]


def publish(spark: SparkSession, name: str, refreshed: DataFrame, untouched: Callable[[DataFrame], DataFrame], read: str | None = None) -> str:
    """Publish ``refreshed`` in place of the touched partitions and return the new set's id.  ``untouched`` keeps, of a table
    of partition values, those that stay as they are; partitions that are neither are gone.  ``read`` is the set
    that ``refreshed`` was made from (default: the present one)."""
    columns, parts = spark.table(name).columns, partition_columns(spark, name)
    base = read or current_set(spark, name)
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    insert_partitions(refreshed.withColumn("version", F.lit(version)), f"{name}_rows", [*parts, "version"])
    sets = spark.table(f"{name}_sets")
    written = spark.table(f"{name}_rows").where(F.col("version") == version).select(*parts, "version").distinct()
    kept = untouched(sets.where(F.col("set_id") == base).drop("set_id"))
    whole = kept.unionByName(written).withColumn("set_id", F.lit(version))
    whole.select(*sets.columns).write.insertInto(f"{name}_sets")
    now = current_set(spark, name)
    if now != base:
        raise StalePublish(f"{name} was published by another writer: set {now}, not {base}")
    _point(spark, name, version, columns, parts)
    return version


def vacuum(spark: SparkSession, name: str, keep: int = 1) -> int:
    """Drop all versions that neither the present set nor the ``keep`` sets before it name, and the other sets; the number of partitions dropped.
    Readers of dropped sets must have ended.  What comes to the driver are partition names, as the catalog lists them."""
    present = current_set(spark, name)
    ids = sorted(r["set_id"] for r in spark.table(f"{name}_sets").select("set_id").distinct().collect())
    stay = [s for s in ids if s <= present][-(keep + 1):]
    named = {r["version"] for r in spark.table(f"{name}_sets").where(F.col("set_id").isin(stay)).select("version").distinct().collect()}
    rows, parts = spark.table(f"{name}_rows"), partition_columns(spark, name)
    dead = rows.where(~F.col("version").isin(sorted(named))).select(*parts, "version").distinct().collect()
    quoted = lambda v: "null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    for r in dead:
        spec = ", ".join(f"`{c}` = {quoted(r[c])}" for c in [*parts, "version"])
        spark.sql(f"ALTER TABLE {name}_rows DROP IF EXISTS PARTITION ({spec})")
    for s in set(ids) - set(stay):
        spark.sql(f"ALTER TABLE {name}_sets DROP IF EXISTS PARTITION (set_id = '{s}')")
    return len(dead)

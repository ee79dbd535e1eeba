"""Projections and schema conformance.

Renames and stamps that do not depend on each other are applied in one
``withColumnsRenamed`` / ``withColumns`` / ``select`` so the analyzed plan stays
shallow; derived columns are sequential because later ones read earlier ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrule.sources.tables import CLIENT_PROCESSED_SCHEMA

TYPE_NAMES = {"string": T.StringType(), "double": T.DoubleType(), "date": T.DateType(), "bigint": T.LongType()}


def normalize_headers(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace from every column name."""
    return df.toDF(*[c.strip() for c in df.columns])


def safe_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns that are present and actually change."""
    present = {s: d for s, d in mapping.items() if s in df.columns and s != d}
    return df.withColumnsRenamed(present) if present else df


def map_output_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Copy a source column to an output name when the source exists."""
    cols = {out: F.col(src) for out, src in mapping.items() if src in df.columns}
    return df.withColumns(cols) if cols else df


def derived_columns(df: DataFrame, derived: Sequence[tuple[str, str]]) -> DataFrame:
    """Ordered SQL-text columns; each sees the ones before it."""
    out = df
    for name, expression in derived:
        out = out.withColumn(name, F.expr(expression))
    return out


def schema_drift_columns(existing: Sequence[str], expected: Sequence[str]) -> dict[str, Column]:
    """P10 as columns: sorted extra and missing column lists plus both inputs."""
    ex = F.array(*[F.lit(c) for c in existing]) if existing else F.array().cast("array<string>")
    exp = F.array(*[F.lit(c) for c in expected]) if expected else F.array().cast("array<string>")
    return {"extra_columns": F.array_sort(F.array_except(ex, exp)),
            "missing_columns": F.array_sort(F.array_except(exp, ex)),
            "existing_columns": ex, "expected_columns": exp}


def schema_drift(spark: SparkSession, existing: Sequence[str], expected: Sequence[str],
                 client_name: str | None = None) -> DataFrame:
    """P10: one-row drift report (arrays of column names)."""
    cols = schema_drift_columns(existing, expected)
    return spark.range(1).select(F.lit(client_name).cast("string").alias("client_name"),
                                 *[c.alias(n) for n, c in cols.items()])


def final_columns(df: DataFrame, stamps: dict[str, Column], schema: T.StructType) -> dict[str, Column]:
    """The uncast source of each final column: a stamp, a column of ``df``
    (``order_date`` may come from ``date``), or null."""
    have = {f.name: F.col(f.name) for f in schema.fields if f.name in df.columns}
    if "order_date" not in have and "date" in df.columns:
        have["order_date"] = F.col("date")
    return {f.name: stamps.get(f.name, have.get(f.name, F.lit(None))) for f in schema.fields}


def conform_final(df: DataFrame, client_name: str, load_id: str, event_date: str, event_name: str = "ObjectCreated",
                  schema: T.StructType = CLIENT_PROCESSED_SCHEMA) -> DataFrame:
    """P5 with its failures: the final columns, cast tolerantly, and an array
    ``quarantine_reasons`` naming each value that does not fit its type."""
    stamps = {"client_name": F.lit(client_name), "event_name": F.lit(event_name), "load_id": F.lit(load_id),
              "event_date": F.lit(event_date)}
    given = final_columns(df, stamps, schema)
    out, misfits = [], []
    for f in schema.fields:
        value = given[f.name].try_cast(f.dataType)
        misfits.append(F.when(given[f.name].isNotNull() & value.isNull(), F.lit(f"not_{f.dataType.simpleString()}:{f.name}")))
        out.append((F.coalesce(value, F.lit(0).cast(f.dataType)) if f.name == "orders" else value).alias(f.name))
    return df.select(*out, F.array_compact(F.array(*misfits)).alias("quarantine_reasons"))


def enforce_final_schema(df: DataFrame, client_name: str, load_id: str, event_date: str,
                         event_name: str = "ObjectCreated",
                         schema: T.StructType = CLIENT_PROCESSED_SCHEMA) -> DataFrame:
    """P5: the final columns of the rows that fit them: missing ones typed
    nulls, ``orders`` null → 0, doubles to BIGINT truncated (K6).  Rows with a value that
    does not fit are left to ``conform_final``'s quarantine."""
    conformed = conform_final(df, client_name, load_id, event_date, event_name, schema)
    return conformed.where(F.size("quarantine_reasons") == 0).drop("quarantine_reasons")


def reorder_strict(df: DataFrame, final_columns: Sequence[str]) -> DataFrame:
    """Exactly the final columns, missing ones as null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in final_columns])


def reorder_loose(df: DataFrame, final_columns: Sequence[str]) -> DataFrame:
    """Final columns first (missing as null), the rest after in their order."""
    rest = [c for c in df.columns if c not in final_columns]
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in final_columns],
                     *[F.col(c) for c in rest])


def audit_columns(df: DataFrame, values: dict[str, object], backfill: Iterable[str] = ()) -> DataFrame:
    """Stamp audit columns in one projection.

    Columns named in ``backfill`` keep an existing non-null value and only
    fill nulls (``coalesce``); the others are overwritten.
    """
    fill = set(backfill)
    cols: dict[str, Column] = {}
    for name, v in values.items():
        val = v if isinstance(v, Column) else F.lit(v)
        cols[name] = F.coalesce(F.col(name), val) if (name in fill and name in df.columns) else val
    return df.withColumns(cols)


def drop_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*present) if present else df

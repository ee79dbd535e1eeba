"""Readers for the Parquet inputs and the fixed table schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Processed client rows (also the client fact table, first five columns).
CLIENT_PROCESSED_SCHEMA = T.StructType([
    T.StructField("discount_code", T.StringType()),
    T.StructField("orders", T.LongType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("client_name", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("event_date", T.DateType()),
])
CLIENT_FACT_COLUMNS = ["discount_code", "orders", "revenue", "order_date", "client_name"]

# Processed partner rows; the partner fact adds loaded_at.
PARTNER_PROCESSED_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("client_name", T.StringType()),
    T.StructField("show_name", T.StringType()),
    T.StructField("discount_code", T.StringType()),
    T.StructField("campaign_name", T.StringType()),
    T.StructField("campaign_item_id", T.StringType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("orders", T.DoubleType()),
    T.StructField("impressions", T.DoubleType()),
    T.StructField("revenue_per_order", T.DoubleType()),
    T.StructField("revenue_per_impression", T.DoubleType()),
    T.StructField("impressions_per_order", T.DoubleType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("source_key", T.StringType()),
    T.StructField("processed_at", T.StringType()),
])
PARTNER_COLUMNS = [f.name for f in PARTNER_PROCESSED_SCHEMA.fields]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one input table; ``columns`` narrows the ReadSchema at the scan."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_parquet_paths(spark: SparkSession, paths: list[str], base_path: str | None = None,
                       schema: T.StructType | None = None) -> DataFrame:
    """S3: multi-path Parquet scan (one scan node, files listed in parallel).  ``base_path`` keeps
    the partition columns of files named one by one, as a manifest does."""
    if not paths:
        raise ValueError("no paths to read")
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    return (reader.schema(schema) if schema else reader).parquet(*paths)


# One name per table.
CLIENT_FACT_TABLE = "fact_client_upload"
PARTNER_FACT_TABLE = "fact_partner_performance"
CLIENT_STAGING_TABLE = "stage_client_upload"
PARTNER_STAGING_TABLE = "stage_partner_performance"
MONTH = T.StructField("month", T.StringType())
LOADED_AT = T.StructField("loaded_at", T.TimestampNTZType())


def table_definitions() -> dict[str, tuple[T.StructType, list[str]]]:
    """Schema and partition columns of the fact and staging tables."""
    client = T.StructType([f for f in CLIENT_PROCESSED_SCHEMA.fields if f.name in CLIENT_FACT_COLUMNS] + [MONTH])
    partner = T.StructType([*PARTNER_PROCESSED_SCHEMA.fields, LOADED_AT, MONTH])
    return {
        CLIENT_FACT_TABLE: (client, ["client_name", "month"]),
        PARTNER_FACT_TABLE: (partner, ["source_type", "month"]),
        CLIENT_STAGING_TABLE: (CLIENT_PROCESSED_SCHEMA, ["load_id"]),
        PARTNER_STAGING_TABLE: (PARTNER_PROCESSED_SCHEMA, ["batch_id"]),
    }

"""Helpers shared by the operators: staged tables, document columns, versions of files."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.session import scratch_path
from ferrule.sources.tables import table_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents"))


def stage_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: a lineage
    cut that survives lost executors."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame, text: str) -> Column:
    """The text column; null counts as the empty text."""
    return F.coalesce(df[text].cast("string"), F.lit(""))


def named(df: DataFrame, column: str, name: str) -> Column:
    """A column under a name; without an alias if it has that name, so that plans that read
    the same columns stay equal and share an exchange."""
    return df[column] if column == name else df[column].alias(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def file_bytes(path: str) -> bytes:
    """A vocabulary file, read on the driver; its size is fixed by the vocabulary."""
    with open(path, "rb") as f:
        return f.read()


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()

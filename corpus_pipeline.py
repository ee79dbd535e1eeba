"""The corpus pipeline: documents through the training-data operators, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm import byte_bpe, mixing, pii, quality, simhash
from ferrule.llm.common import read_documents, stage_table, text_of
from ferrule.llm.queries import (
    MIXTURE,
    QUALITY_CUT,
    SHINGLE_WORDS,
    SIMHASH_BITS,
    op6_vocabulary,
    quality_model,
)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade reaches the cut."""
    return quality.select_documents(spark, docs, quality_model(spark, docs, sf_dir), QUALITY_CUT)


def unused(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column has it, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest id, and of the rows that repeat it the smallest by
    text, then by the other columns in order (nulls first).  A row with a null id is a member of its text's
    group like any other: it is dropped for one with an id, and of a group without ids the rows of the text with the
    smallest SHA-256 stay, reduced to one in the same order.  Ids may be of any type that Spark orders."""
    text, key_col = text_of(docs, "text"), unused(docs, "group_key")
    plain = F.lit("0").try_cast(docs.schema["doc_id"].dataType)  # stands for a null id where the type has such a value
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", plain).alias("id"),
                   F.when(F.col("doc_id").isNull(), F.sha2(text, 256)).otherwise("").alias("sha"))
    keyed = docs.withColumn(key_col, key)
    found = simhash.near_duplicates(spark, keyed, SHINGLE_WORDS, SIMHASH_BITS, id_col=key_col)
    of_key = found.groupBy(F.col("doc_id").alias(key_col)).agg(
        (F.col(key_col) == F.min("component_id")).alias("first"), F.count("*").alias("n"))
    other = stage_table(spark, of_key.where("NOT first OR n > 1"), "copies")
    repeated = stage_table(spark, other.where("first").select(key_col), "repeated")
    single = keyed.join(other.select(key_col), key_col, "left_anti").select(*docs.columns)
    columns = ["text", *(c for c in docs.columns if c != "text")]
    least = keyed.join(repeated, key_col, "left_semi").groupBy(key_col).agg(F.min(F.struct(*columns)).alias("row"))
    return single.union(least.select(*(F.col("row")[c].alias(c) for c in docs.columns)))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked."""
    return pii.redact(spark, docs, pii.train(spark, docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target mixture."""
    return mixing.sample_documents(spark, docs, **MIXTURE)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text (little-endian unsigned 32-bit integers), with their number and the digests of ids and
    decoded bytes.  The ids are written first; every row's decoded bytes are held against its text, and a row that differs
    fails the stage."""
    path, pattern = op6_vocabulary()
    row = unused(docs, "row_id")
    texts = stage_table(spark, docs.select(F.struct(F.col("doc_id"), F.sha2(text_of(docs, "text"), 256).alias("sha")).alias(row), "text"), "texts")
    ids = stage_table(spark, byte_bpe.encode(spark, texts, path, pattern, id_col=row), "token-ids")
    return checked(byte_bpe.decode(spark, ids, path))


def checked(decoded: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, ids)`` of rows (doc_id: the id and its text's SHA-256, ids, decoded)."""
    out = byte_bpe.digests(decoded).columns
    found = decoded.select(F.col("doc_id.doc_id").alias("doc_id"), F.col("doc_id.sha").alias("sha"), "ids",
                           (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                           F.sha2("decoded", 256).alias("decoded_sha256"))
    wrong = F.raise_error(F.concat(F.lit("decoded bytes differ from the text of document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    held = F.when(F.col("decoded_sha256") == F.col("sha"), F.col("decoded_sha256")).otherwise(wrong.cast("string"))
    return found.withColumn("decoded_sha256", held).select(*out, "ids")


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_of_each),
    ("PII", mask_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokenise),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and reread."""
    docs = read_documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage_table(spark, docs, f"pipeline-{k + 1}")
    return docs

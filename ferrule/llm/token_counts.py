"""Token counts through a digest cache.

A text's count is stored under (digest of its normalised content, digest of the
tokenizer's version).  A run joins its digests to the stored counts, encodes
each distinct missing content once, appends those counts to the cache, and joins
the counts back.  Copies are combined before the shuffle that brings one text
per digest together, so a hot copy costs one encoding; the join back meets a
plain stored table, whose skewed partitions AQE splits.

The content is normalised by nothing but null -> empty: any other change could
change a count.  The version digest covers the tokenizer's file and the library.

The cache is a Parquet folder with one partition per tokenizer version; one writer
at a time.  A failed run appends nothing.

Defined cases: null text is empty (0 bytes; what the library gives for it); null
ids stay null; every input row gives a row, repeated or not; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import digest, file_bytes, text_of
from ferrule.llm.pieces import PieceMemo

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"
COUNT_SCHEMA = "digest binary, n_tokens long"
#: Texts of one library call, so that a batch of long texts stays small.
BATCH_CHARS = 1 << 20


def tokenizer_version(path: str) -> str:
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    return digest(f"{library.__name__} {library.__version__} ".encode() + file_bytes(path))


def _whole_counter(data: bytes, kind: str):
    """Counts of whole texts by the library itself, and the library's tokenizer."""
    if kind == "model":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)], None
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tk = Tokenizer.from_str(data.decode("utf-8"))
    tk.no_truncation()
    tk.no_padding()
    return lambda texts: [len(x) for x in tk.encode_batch(texts, add_special_tokens=False)], tk


def counter(data: bytes, kind: str):
    """A function from a text to its number of tokens."""
    import json

    many, tk = _whole_counter(data, kind)
    whole = lambda text: many([text])[0]
    if tk is None:
        return whole
    spec = json.loads(data)
    pre = spec.get("pre_tokenizer") or {}
    plain = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space") and (spec.get("model") or {}).get("type") == "BPE")
    if not plain:
        return whole
    added = [x["content"] for x in spec.get("added_tokens") or []]
    memo = PieceMemo(many)

    def count(text: str) -> int:
        if any(a in text for a in added):
            return whole(text)
        return sum(memo.values(text))

    return count


def _encoder(data: bytes, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(data, kind)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array([count(x.as_py()) for x in batch.column("text")], pa.int64())],
                ["digest", "n_tokens"])
    return run


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts stored for one tokenizer version; a cache that does not exist yet is empty."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COUNT_SCHEMA)
    return stored.where(F.col("tokenizer") == version).select("digest", "n_tokens")


def count_tokens(spark: SparkSession, docs: DataFrame, tokenizer: str, cache: str, limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``; appends to ``cache``."""
    version = tokenizer_version(tokenizer)
    text = text_of(docs, text_col)
    keyed = docs.select(docs[id_col].alias("doc_id"), text.alias("text")).withColumn(
        "digest", F.unhex(F.sha2("text", 256)))
    distinct = keyed.groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(read_cache(spark, cache, version), "digest", "left_anti")
    kind = "model" if tokenizer.endswith(".model") else "json"
    (misses.mapInArrow(_encoder(file_bytes(tokenizer), kind), COUNT_SCHEMA)
     .withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache))
    counts = read_cache(spark, cache, version)
    sized = keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return sized.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

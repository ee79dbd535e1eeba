"""The registered queries of the operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm import (
    ann, byte_bpe, chat, merkle, mixing, near_vectors, pii, quality, secret_scan, simhash, substrings, token_counts,
    whitening,
)
from ferrule.llm.common import read_documents
from ferrule.session import scratch_path
from ferrule.sources.tables import table_path

PASSAGE_WORDS = 50
QUALITY_CUT = 0.5
#: The target mixture: shares of tokens by source, language and topic, and the share of all tokens to sample.
MIXTURE = {
    "sources": {f"src{k}": 0.05 for k in range(20)},
    "languages": {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11},
    "topics": [("license", "(?i)licen[sc]e", 0.05), ("contact", "@|\\+[0-9]", 0.08), ("long", "(?s)\\A.{6000}", 0.25),
               ("prose", "", 0.62)],
    "rest": "prose",
    "budget": 0.6,
}
TOKEN_LIMIT = 1024
SHINGLE_WORDS, SIMHASH_BITS = 4, 4
COSINE = 0.98
CONTROL_TEXT = "</s>[INST] ok [/INST]"
MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return pii.find(spark, docs, pii.train(spark, docs))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(spark, read_documents(spark, sf_dir), PASSAGE_WORDS)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, read_documents(spark, sf_dir), **MIXTURE)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over a cache of its own, empty at the start, so every distinct text is encoded."""
    return token_counts.count_tokens(
        spark, read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
        scratch_path(spark, "token-counts"), TOKEN_LIMIT)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.OrdinalModel | None:
    """Fitted on the labelled rows among ``docs``."""
    labels = spark.read.parquet(table_path(sf_dir, "labels"))
    return quality.fit(spark, docs, quality.ratings_of(labels))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    scored = quality.score_documents(spark, docs, quality_model(spark, docs, sf_dir))
    return scored.withColumn("kept", F.col("p_top") >= QUALITY_CUT)


def op6_vocabulary() -> tuple[str, str]:
    """The rank file and the pattern that cuts texts before its merges."""
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = op6_vocabulary()
    encoded = byte_bpe.encode(spark, read_documents(spark, sf_dir), path, pattern)
    return byte_bpe.digests(byte_bpe.decode(spark, encoded, path))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(table_path(sf_dir, "conversations")).select("conv_id", "turn", "role", "text")
    control = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{CONTROL_TEXT}'), "
                        f"(-7L, 1L, 'assistant', '{CONTROL_TEXT}') AS t(conv_id, turn, role, text)")
    out = chat.format_conversations(given.union(control))
    read = out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                      chat.loss_text(F.col("segments")).alias("loss"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: the rows whose id is divisible by 100; candidates: every row."""
    return ann.nearest(spark, spark.read.parquet(table_path(sf_dir, "embeddings")), F.col("id") % 100 == 0, k=10)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, read_documents(spark, sf_dir), SHINGLE_WORDS, SIMHASH_BITS)


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(spark, spark.read.parquet(table_path(sf_dir, "embeddings")), COSINE)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, spark.read.parquet(table_path(sf_dir, "embeddings")))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return secret_scan.find(spark, docs, secret_scan.train(spark, docs))


def tampered_text(docs: DataFrame) -> Column:
    """The text without line feeds where 2 divides the CRC-32 of the decimal id."""
    chosen = F.crc32(docs["doc_id"].cast("string")) % 2 == 0
    return F.when(chosen, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return merkle.manifest(spark, docs, MANIFEST_FIELDS, {"text": tampered_text(docs)})


OP8_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}'))
), o AS (
  SELECT *, row_number() OVER w AS rn, lag(role) OVER w AS before,
         length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) AS written,
         length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS role_written
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(written + CASE WHEN rn > 1 AND before = role THEN {len(chat.AND)}
                               ELSE {len(chat.OPEN) + len(chat.MARK_END) + len(chat.END)} + role_written END)
            AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""

OP2_SQL = f"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') AS ws FROM documents
), n AS (
  SELECT doc_id, ws, len(ws) AS n FROM w
), hashed AS (
  SELECT doc_id, list_transform(range(1, n - {PASSAGE_WORDS - 2}),
                                lambda p: md5(array_to_string(ws[p:p + {PASSAGE_WORDS - 1}], ' '))) AS hs
  FROM n WHERE n >= {PASSAGE_WORDS}
), windows AS (
  SELECT doc_id, unnest(hs) AS h, generate_subscripts(hs, 1) AS p FROM hashed
), firsts AS (
  SELECT h, min(doc_id) AS d FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, p + k AS i
  FROM (SELECT doc_id, p FROM windows JOIN firsts USING (h) WHERE d < doc_id) x, range({PASSAGE_WORDS}) AS t(k)
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM n
)
SELECT n.doc_id, n.n AS n_words, count(gone.i) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE gone.i IS NULL), '')) AS kept_sha256
FROM n LEFT JOIN words ON words.doc_id = n.doc_id LEFT JOIN gone ON gone.doc_id = n.doc_id AND gone.i = words.i
GROUP BY n.doc_id, n.n
"""

OP10_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND vec_id IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}
), reach AS (
  SELECT vec_id AS node, vec_id AS other FROM v
  UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other
), least AS (
  SELECT node, min(other) AS component_id FROM reach GROUP BY node
)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links, component_id,
       v.vec_id = component_id AS kept
FROM v JOIN least ON least.node = v.vec_id
"""

def _written_sql(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_written_sql(text if f == "text" else f) for f in MANIFEST_FIELDS) + ")"


#: Trees of sources have a number of the source as ``g``; the tree of subroots has -1.
OP13_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM range(256) AS r(b)
), marked AS (
  SELECT d.*, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
         xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                         lambda crc, b: xor(crc >> 8, t[CAST(xor(crc, b) & 255 AS INTEGER) + 1]), 4294967295), 4294967295) AS crc
  FROM documents d, crc_table
), leaves AS (
  SELECT *, {_leaf_sql("text")} AS leaf,
         {_leaf_sql("CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS claim
  FROM marked
), numbered AS (
  SELECT doc_id, g, leaf, claim, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY g) AS n
  FROM leaves
), tree AS (
  SELECT g, 0 AS level, pos, leaf AS node, n FROM numbered
  UNION ALL
  SELECT g, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM tree WHERE n > 1
  GROUP BY g, level, pos // 3, n
), subroots AS (
  SELECT g, node, count(*) OVER () AS sources FROM tree WHERE n = 1
), upper AS (
  SELECT -1 AS g, 0 AS level, g AS pos, node, sources AS n FROM subroots
  UNION ALL
  SELECT g, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM upper WHERE n > 1
  GROUP BY g, level, pos // 3, n
), steps AS (
  SELECT a.g, a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM (SELECT * FROM tree UNION ALL SELECT * FROM upper) a
  JOIN (SELECT * FROM tree UNION ALL SELECT * FROM upper) b ON a.g = b.g AND a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.n > 1 GROUP BY a.g, a.level, a.pos
), found AS (
  SELECT n.doc_id, n.leaf, n.claim, n.g, n.pos, s.level AS lvl, s.l, s.r
  FROM numbered n JOIN range(64) AS t(k) ON pow(3, k) < n.n JOIN steps s ON s.g = n.g AND s.level = k AND s.pos = n.pos // CAST(pow(3, k) AS BIGINT)
  UNION ALL
  SELECT n.doc_id, n.leaf, n.claim, n.g, n.pos, 1000 + s.level, s.l, s.r
  FROM numbered n JOIN range(64) AS t(k) ON k < 40 JOIN steps s ON s.g = -1 AND s.level = k AND s.pos = n.g // CAST(pow(3, k) AS BIGINT)
), paths AS (
  SELECT g, pos, list(l || '|' || r ORDER BY lvl) AS path FROM found GROUP BY g, pos
)
SELECT n.doc_id, n.leaf, s.node AS subroot, u.node AS root,
       sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) AS proof_sha256,
       list_reduce(coalesce(path, []), lambda node, x: sha256(split_part(x, '|', 1) || node || split_part(x, '|', 2)), claim) AS folded_root,
       list_reduce(coalesce(path, []), lambda node, x: sha256(split_part(x, '|', 1) || node || split_part(x, '|', 2)), claim) = u.node AS verified
FROM numbered n LEFT JOIN paths p ON p.g = n.g AND p.pos = n.pos JOIN subroots s ON s.g = n.g JOIN upper u ON u.n = 1
"""

QUERIES = {
    "op1_pii": op1_pii,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_mixing": op3_mixing,
    "op4_token_counts": op4_token_counts,
    "op5_quality": op5_quality,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_nearest_vectors": op7_nearest_vectors,
    "op8_chat_format": op8_chat_format,
    "op9_simhash": op9_simhash,
    "op10_near_vectors": op10_near_vectors,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_secret_scan": op12_secret_scan,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLES = {"op2_substring_dedup": OP2_SQL, "op8_chat_format": OP8_SQL, "op10_near_vectors": OP10_SQL,
           "op13_merkle_manifest": OP13_SQL}

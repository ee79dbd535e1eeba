import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ferrule.llm import byte_bpe, mixing, pii, simhash
from ferrule.llm.common import read_documents, stage_table
from ferrule.llm.queries import MIXTURE, ORACLES, QUERIES

from .test_simhash import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_by_one(spark, sf):
    docs = read_documents(spark, sf)
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        outs.append(stage_table(spark, stage(spark, outs[-1] if outs else docs, sf), "test-stage"))
    rows = [{r["doc_id"]: r for r in d.collect()} for d in outs]
    assert [d.columns for d in outs[:-1]] == [COLUMNS] * 4
    given = {r["doc_id"]: r for r in docs.collect()}
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good, single, masked, mixed, final = rows
    clean = [i for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0]
    assert np.mean([i in good for i in clean]) >= 0.95 and all(given[i] == good[i] for i in good)
    ids = sorted(good)
    want = brute_components(ids, [simhash.fingerprint(good[i]["text"] or "", 4) for i in ids], 4)
    assert set(single) == {i for i in ids if want[i] == i} and all(single[i] == good[i] for i in single)
    assert set(masked) == set(single)
    for i, r in masked.items():
        assert not pii.base_spans(r["text"] or "")
        if not pii.base_spans(single[i]["text"] or "") and "<" not in r["text"]:
            assert r == single[i]
    chosen = mixing.mix(spark, outs[2], **MIXTURE).where("selected")
    assert set(mixed) == {r["doc_id"] for r in chosen.collect()} and all(mixed[i] == masked[i] for i in mixed)
    lines = open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(final) == set(mixed)
    for i, r in final.items():
        tokens = encoding.encode_ordinary(mixed[i]["text"])
        assert r["n_tokens"] == len(tokens)
        assert r["ids_sha256"] == hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(mixed[i]["text"].encode()).hexdigest()
    assert {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()} == final


def test_odd_rows_pass_every_stage(spark, make_docs, sf):
    docs = make_docs([(1, None), (2, ""), (None, "a b c"), (3, "x y z"), (3, "x y z"), (4, "word " * 30_000)])
    for empty in (False, True):
        out = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            out = stage_table(spark, stage(spark, out, sf), "test-odd")
        assert empty == (out.count() == 0)


def test_one_row_of_each_group(spark, sf):
    long = " ".join(f"word{k}" for k in range(400))
    other, third = (" ".join(f"{w}{k}" for k in range(300)) for w in ("other", "third"))
    rows = [(5, long, "en"), (5, long, "de"), (5, long, None), (9, long, "en"), (None, long, "en"),  # a repeated smallest id
            (None, other, "fr"), (None, other, "de"), (None, other + " ", "aa"),  # no id at all
            (7, third, "en"), (None, third, "en"), (8, "something of its own", "en"), (None, "also of its own", "en"),
            (0, "number zero by itself", "en"), (None, None, "en"), (None, "", "de")]
    docs = spark.createDataFrame([(i, x, lang, "s", 1) for i, x, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.keep_one_of_each(spark, docs, sf)
    assert out.columns == docs.columns
    got = [(r["doc_id"], r["text"], r["lang"]) for r in out.collect()]
    kept = [other, other + " "]
    text = min(kept, key=lambda x: hashlib.sha256(x.encode()).hexdigest())
    want = [(5, long, None), (None, text, "de" if text == other else "aa"), (7, third, "en"), (8, "something of its own", "en"),
            (None, "also of its own", "en"), (0, "number zero by itself", "en"), (None, None, "en")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert corpus_pipeline.keep_one_of_each(spark, docs.limit(0), sf).count() == 0


def test_registered_names():
    import __spark_entry__

    queries = __spark_entry__.queries()
    assert {*QUERIES, "pipeline"} <= set(queries) and set(ORACLES) <= set(QUERIES)
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_clashing_names_and_ids_of_text(spark, make_docs, sf):
    """Columns named like the stages' own stay as they are; ids may be strings."""
    docs = make_docs([(1, "one two three four five"), (2, "one two three four five"), (3, "other words stand here now and then"), (None, "no id here at all")])
    named = docs.selectExpr("'d' || doc_id AS doc_id", "text", "lang", "source", "n_chars", "'mine' AS group_key", "7 AS row_id", "'g' AS Group_Key_")
    single = corpus_pipeline.keep_one_of_each(spark, named, sf)
    assert single.columns == named.columns
    rows = {r["doc_id"]: r for r in single.collect()}
    assert set(rows) == {"d1", "d3", None} and all(r["group_key"] == "mine" and r["Group_Key_"] == "g" and r["row_id"] == 7 for r in rows.values())
    out = {r["doc_id"]: r for r in corpus_pipeline.tokenise(spark, single, sf).collect()}
    assert set(out) == set(rows)
    for i, r in out.items():
        assert r["decoded_sha256"] == hashlib.sha256(rows[i]["text"].encode()).hexdigest()
        assert len(r["ids"]) == 4 * r["n_tokens"] and hashlib.sha256(r["ids"]).hexdigest() == r["ids_sha256"]


def test_a_wrong_id_fails_the_last_stage(spark, make_docs):
    path, pattern = corpus_pipeline.op6_vocabulary()
    docs = make_docs([(1, "one two"), (2, "three four")]).selectExpr("struct(doc_id, sha2(text, 256) AS sha) AS doc_id", "text")
    ids = byte_bpe.encode(spark, docs, path, pattern)
    assert {r["doc_id"] for r in corpus_pipeline.checked(byte_bpe.decode(spark, ids, path)).collect()} == {1, 2}
    bent = ids.withColumn("ids", F.when(F.col("doc_id.doc_id") == 2, F.expr("substring(ids, 1, 4)")).otherwise(F.col("ids")))
    with pytest.raises(Exception, match="differ from the text of document 2"):
        corpus_pipeline.checked(byte_bpe.decode(spark, bent, path)).collect()

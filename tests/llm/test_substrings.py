import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrule.llm import substrings


def brute(rows, window):
    texts = [(i, (x or "").encode().split()) for i, x in rows]
    first = {}
    for i, w in texts:
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in texts:
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def run(spark, docs, window):
    return [tuple(r) for r in substrings.remove_repeats(spark, docs, window).collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_covers_meet_at_every_difference():
    for period, cover in substrings.COVERS.items():
        assert {(a - b) % period for a, b in itertools.product(cover, cover)} == set(range(period))


def test_run_hashes_depend_on_the_run_alone():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 2 ** 63, 200, dtype=np.uint64)
    for length in (1, 2, 7, 20, 50):
        a = substrings.run_hashes(h, length, substrings.BASES[0])
        b = substrings.run_hashes(h[13:13 + length], length, substrings.BASES[0])
        assert len(a) == 201 - length and a[13] == b[0] and len(set(a.tolist())) == len(a)


@pytest.mark.parametrize("window", [50, 12, 3])
def test_against_brute_force(spark, make_docs, words, window):
    shared, base = words(90), words(400)
    rows = [(7, " ".join(base[:150])), (3, " ".join(words(20) + shared + words(33))),
            (9, "\t".join(words(41) + shared[5:80] + words(3) + shared[:window])), (4, " ".join(words(7) + shared[30:])),
            (11, " ".join(base[:150])), (12, " ".join(base[:150])), (2, " ".join(shared[:window - 1])), (20, None), (21, ""),
            (22, " \n "), (None, " ".join(shared)), (7, " ".join(base[:150])), (7, " ".join(base[40:200])),
            (30, " ".join(["a"] * 200)), (31, " ".join(["a"] * 120 + words(4))), (32, " ".join(base[100:] + shared + base[:80]))]
    rows += [(100 + k, " ".join(words(15) + base[200:270] + words(k))) for k in range(25)]
    assert order(run(spark, make_docs(rows), window)) == order(brute(rows, window))


def test_runs_of_rows_across_batches(spark, make_docs, words):
    """A group that spans many Arrow batches, and a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        shared = words(60)
        rows = [(k, " ".join(words(k % 5) + shared + words(3))) for k in range(40)] + [(99, " ".join(words(9000) + shared))]
        assert order(run(spark, make_docs(rows), 50)) == order(brute(rows, 50))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table(spark, make_docs):
    out = substrings.remove_repeats(spark, make_docs([]), 50)
    assert out.count() == 0 and out.columns == ["doc_id", "n_words", "n_removed", "kept"]


def test_string_ids(spark, make_docs, words):
    text = " ".join(words(70))
    docs = make_docs([(1, text), (2, text)]).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    assert sorted(r[2] for r in run(spark, docs, 50)) == [0, 70]

"""Glob patterns as a table, against fnmatch over every pair."""

import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from ferrule.operators import globs
from ferrule.operators.globs import PATTERN_DDL, glob_index, match_globs
from tests.plan_utils import plan_text

FILES_DDL = "client_name string, file_name string, n int"


def _literal(pattern):
    return sum(1 for ch in pattern if ch not in "*?[]")


def _pairs(files, patterns):
    return {(n, t, _literal(p), at) for c, f, n in files for pc, t, p, at in patterns
            if None not in (c, f, p) and c == pc and fnmatch.fnmatchcase(f.lower(), p.lower())}


def _best(files, patterns):
    best = {}
    for n, t, size, at in _pairs(files, patterns):
        best[n] = min(best.get(n, (0, 10 ** 9, "")), (-size, at, t))
    return {n: t for n, (_, _, t) in best.items()}


def _both(spark, files, patterns, small=None):
    f, p = spark.createDataFrame(files, FILES_DDL), spark.createDataFrame(patterns, PATTERN_DDL)
    one = [(r.n, r.file_type) for r in match_globs(f, p, small=small).collect()]
    all_ = [(r.n, r.file_type) for r in match_globs(f, p, exclusive=False, small=small).collect()]
    return one, all_


@pytest.mark.parametrize("small", [True, False])
def test_a_thousand_random_patterns(spark, small):
    rng = random.Random(4)
    words = ["sales", "orders", "creator", "codes", "shows", "x", "2024", "q[1]", "a.b", "\\d", "(z)"]
    bits = [*words, "*", "*", "?", "[a-s]", "[!a-s]", "_", ".csv", ".CSV"]
    patterns = [(f"c{rng.randrange(3)}", f"type{k}", "".join(rng.choice(bits) for _ in range(rng.randrange(1, 6))).replace("q[1]", "q"), k)
                for k in range(1000)]
    files = [(f"c{rng.randrange(3)}", "_".join(rng.choice(words) for _ in range(rng.randrange(1, 4))) + rng.choice(["", ".csv", ".Csv"]), k)
             for k in range(400)]
    one, all_ = _both(spark, files, patterns, small)
    assert len(one) == len(set(one)) and dict(one) == _best(files, patterns) and len(one) > 100
    assert len(all_) == len(set(all_)) and set(all_) == {(n, t) for n, t, _, _ in _pairs(files, patterns)}


def test_odd_patterns_and_names(spark):
    patterns = [("a", "any", "*", 9), ("a", "empty", "", 8), ("a", "open", "x[", 7), ("a", "set", "[!]", 6), ("a", "range", "v[0-9].[ct]sv", 5),
                ("a", "caret", "[^a]z", 4), ("a", "none", None, 3), (None, "lost", "*", 2), ("a", "any", "*", 9), ("a", "amp", "[&&]q", 1)]
    names = ["", "x[", "[!]", "V7.csv", "v7.tsv", "vv.csv", "^z", "az", "bz", "line\nbreak", "&q", "tie", "tie", None]
    files = [("a", name, n) for n, name in enumerate(names)] + [(None, "x", 90), ("b", "x", 91)]
    one, all_ = _both(spark, files, patterns)
    assert dict(one) == _best(files, patterns) and len(one) == 13
    assert sorted(all_) == sorted({(n, t) for n, t, _, _ in _pairs(files, patterns)})


def test_empty_tables_and_clashing_columns(spark):
    files = spark.createDataFrame([("a", "s.csv", "old", 1, "r")], "client_name string, file_name string, file_type string, rank int, client string")
    assert match_globs(files, spark.createDataFrame([], PATTERN_DDL)).count() == 0
    assert match_globs(files.limit(0), spark.createDataFrame([("a", "t", "s*", 0)], PATTERN_DDL)).count() == 0
    r = match_globs(files, spark.createDataFrame([("a", "t", "s*", 0)], PATTERN_DDL)).collect()
    assert [(x.file_name, x.file_type, x["rank"], x.client) for x in r] == [("s.csv", "t", 1, "r")]


def test_anchors_avoid_what_many_patterns_share(spark):
    patterns = spark.createDataFrame([("a", f"t{k}", f"*part{k:04d}*.csv", k) for k in range(1000)] + [("a", "one", "whole.csv", 1000)], PATTERN_DDL)
    index = glob_index(patterns)
    widest = index.groupBy("anchor").count().agg(F.max("count")).first()[0]
    assert widest <= 110 and index.count() == 1001                         # not the suffix .csv of all thousand
    assert [r.anchor for r in index.where("file_type = 'one'").collect()] == ["ewhole.csv"]


def test_joined_on_keys_without_a_case_chain(spark):
    files = spark.createDataFrame([("a", "s.csv", 1)], FILES_DDL)
    patterns = spark.createDataFrame([("a", f"t{k}", f"s{k}*", k) for k in range(1000)], PATTERN_DDL)
    text = plan_text(match_globs(files, patterns))
    assert "NestedLoop" not in text and "Cartesian" not in text and "EvalPython" not in text and "t999" not in text


def test_only_a_measured_small_index_is_broadcast(spark, monkeypatch):
    files = spark.createDataFrame([("a", "s1.csv", 1)], FILES_DDL)
    patterns = spark.createDataFrame([("a", f"t{k}", f"s{k}*", k) for k in range(100)], PATTERN_DDL)
    hinted = "ResolvedHint (strategy=broadcast)"
    text = match_globs(files, patterns)._jdf.queryExecution().analyzed().toString()
    assert hinted in text and globs.is_small(patterns.limit(0))
    monkeypatch.setattr(globs, "SMALL", 1000)
    assert hinted not in match_globs(files, patterns)._jdf.queryExecution().analyzed().toString()
    assert [r.file_type for r in match_globs(files, patterns).collect()] == ["t1"]


def _numbered(spark, n):
    """A pattern a number in three forms, all sharing their words, and the files of those numbers."""
    forms = "CASE id % 3 WHEN 0 THEN concat('*cust', k, '.*') WHEN 1 THEN concat('F_*cust', k, '*') ELSE concat('*_cust', k, '.csv') END"
    ids = spark.range(n).selectExpr("id", "CAST(100000 + id * 7919 % 900000 AS STRING) AS k")
    patterns = ids.selectExpr("'a' AS client_name", "concat('t', id) AS file_type", f"{forms} AS pattern", "CAST(id AS INT) AS spec_order")
    return ids.selectExpr("'a' AS client_name", "concat('F_1995-03-12_Cust', k, '.csv') AS file_name", "CAST(id AS INT) AS n"), patterns


def test_an_anchor_stays_with_few_patterns_however_many_there_are(spark):
    widest = glob_index(_numbered(spark, 6000)[1]).groupBy("client", "anchor").count().agg(F.max("count")).first()[0]
    assert widest <= 2                                     # three characters of the digits meet 17 of these patterns


@pytest.mark.parametrize("words", [1, 1024])
def test_a_full_summary_lets_names_through_and_loses_none(spark, monkeypatch, words):
    files, patterns = _numbered(spark, 3000)
    monkeypatch.setattr(globs, "_words", lambda n: words)
    for exclusive in (True, False):
        found = match_globs(files, patterns, exclusive=exclusive, small=False)
        assert found.where("file_type = concat('t', n)").count() == found.count() == 3000


def test_a_summary_holds_its_forms_and_every_anchor(spark):
    index = glob_index(_numbered(spark, 500)[1])
    summary = globs.glob_summary(index, 1024).first()[0]
    forms = {r.form for r in index.selectExpr("concat(left(anchor, 1), length(anchor) - 1) AS form").distinct().collect()}
    assert len(summary) == 1025 and {f for k, f in enumerate(globs.FORMS) if summary[0] >> k & 1} == forms
    word, bits = globs._mark(globs._key(F.col("client"), F.col("anchor")), 1024)
    assert all(summary[r.word] & r.bits == r.bits for r in index.select(word.alias("word"), bits.alias("bits")).collect())
    assert globs.glob_summary(index.limit(0), 0).first()[0] == [0]


@pytest.mark.parametrize("n,words", [(0, 1024), (4096, 1024), (4097, 2048), (900_000, 1 << 18), (10 ** 9, 1 << 20)])
def test_words_of_a_summary(n, words):
    assert globs._words(n) == words

import re

import numpy as np
from pyspark.sql import functions as F

from ferrule.llm import mixing, quality
from ferrule.llm.queries import MIXTURE


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ratings = quality.ratings_of(spark.read.parquet(f"{sf}/labels.parquet"))
    model = quality.fit(spark, docs, ratings.where("doc_id % 4 != 1"))
    held = ratings.where("doc_id % 4 = 1")
    got = quality.score_documents(spark, docs.join(held, "doc_id", "left_semi"), model).join(held, "doc_id").toPandas()
    kept = got.p_top >= 0.5
    assert kept[got.grade == 2].mean() >= 0.98
    assert kept[got.grade == 1].mean() <= 0.15
    assert kept[got.grade == 0].mean() <= 0.15
    means = got.groupby("grade").expected_grade.mean()
    assert means[0] < means[1] < means[2]
    assert got.p_top.between(0, 1).all() and got.expected_grade.between(0, 2).all()


def test_gradient_is_the_difference_quotient():
    rng = np.random.default_rng(0)
    score, grade, cut = rng.normal(size=6), np.array([0, 1, 2, 1, 0, 2]), np.array([-0.7, 0.9])

    def loss(s, c):
        edge = np.concatenate([[-np.inf], c, [np.inf]])
        p = 1 / (1 + np.exp(-(edge[grade + 1] - s))) - 1 / (1 + np.exp(-(edge[grade] - s)))
        return -np.log(p).sum()

    by_score, by_cut = quality._gradient(score, grade, cut)
    for k in range(6):
        step = np.eye(6)[k] * 1e-6
        assert abs((loss(score + step, cut) - loss(score - step, cut)) / 2e-6 - by_score[k]) < 1e-4
    for k in range(2):
        step = np.eye(2)[k] * 1e-6
        assert abs((loss(score, cut + step) - loss(score, cut - step)) / 2e-6 - by_cut[k]) < 1e-4


def test_quality_edge_cases(spark, make_docs, words):
    rows = [(k, " ".join(words(30)) + (" awful rotten" if k % 3 == 0 else "")) for k in range(120)]
    odd = [(500, None), (501, ""), (None, "awful"), (3, rows[3][1]), (502, " ".join(words(60_000)))]
    docs = make_docs(rows + odd)
    ratings = spark.createDataFrame([(k, 0 if k % 3 == 0 else 2) for k in range(120)] + [(None, 1), (5, None)], "doc_id long, grade int")
    model = quality.fit(spark, docs, ratings)
    got = quality.score_documents(spark, docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    assert all((r["p_top"] < 0.5) == (r["doc_id"] % 3 == 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 120)
    kept = quality.select_documents(spark, docs, model, 0.5)
    assert kept.columns == docs.columns and kept.where("doc_id IN (500, 501)").count() == 2
    assert kept.where("doc_id = 500 AND text IS NULL").count() == 1
    one = quality.fit(spark, docs, ratings.where("grade = 2"))
    assert one is None and quality.fit(spark, docs, ratings.limit(0)) is None
    assert quality.select_documents(spark, docs, None, 0.5).count() == docs.count()
    assert quality.score_documents(spark, make_docs([]), model).count() == 0


def test_rows_that_share_some_features_all_count():
    """Rows with the same smallest places but other features are different rows."""
    alike = np.array([1, 2, 3, 4])
    rows = [np.append(alike, 10 + k % 2) for k in range(40)] + [np.append(alike, [10, 20 + k]) for k in range(40)]
    grades = np.array([0 if k % 2 else 2 for k in range(40)] + [2] * 40)
    model = quality.OrdinalModel.fit(rows, grades)
    seen = []
    plain, quality._gradient = quality._gradient, lambda score, grade, cut: seen.append(len(grade)) or plain(score, grade, cut)
    try:
        quality.OrdinalModel.fit(rows, grades)
    finally:
        quality._gradient = plain
    assert model is not None and set(seen) == {2 + 40}  # two of the forty that repeat, and all others


def test_ratings(spark):
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 1), (3, 1, 0), (4, None, None), (5, 1, None), (6, 0, 1)], "doc_id long, quality int, toxic int")
    assert dict(quality.ratings_of(labels).collect()) == {1: 1, 2: 0, 3: 2, 4: None, 5: 2, 6: 0}


def brute_rake(tokens, codes, shares, amount, most):
    p = np.full(len(tokens), min(most, amount / sum(tokens)))
    for _ in range(2000):
        for code, share in zip(codes, shares, strict=True):
            for v, s in enumerate(share):
                own = [i for i, c in enumerate(code) if c == v]
                now = sum(tokens[i] * p[i] for i in own)
                for i in own:
                    p[i] = min(most, p[i] * (amount * s / now if now else 1))
    return p


def test_rake_meets_the_marginals():
    rng = np.random.default_rng(3)
    tokens, codes = rng.integers(1, 900, 24).astype(float), [np.arange(24) % 4, np.arange(24) // 4 % 3, np.arange(24) // 12]
    shares = [np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.5, 0.25, 0.25]), np.array([0.6, 0.4])]
    w = mixing.rake(tokens, codes, shares, tokens.sum())
    for code, share in zip(codes, shares, strict=True):
        assert np.allclose(np.bincount(code, weights=w * tokens) / tokens.sum(), share, atol=1e-6)
    p = mixing.rake(tokens, codes, shares, 0.3 * tokens.sum(), 1.0)
    assert p.max() <= 1 and np.allclose(p, brute_rake(tokens, codes, shares, 0.3 * tokens.sum(), 1.0), atol=1e-6)


def test_scale_to_the_budget():
    tokens, p = np.array([100.0, 50.0, 10.0, 40.0]), np.array([0.1, 1.0, 0.9, 0.0])
    for amount in (5.0, 60.0, 75.0, 150.0):
        got = mixing.scale_to(tokens, p, amount)
        assert abs((got * tokens).sum() - amount) < 1e-6 and got.max() <= 1 and got[3] == 0
    assert mixing.scale_to(tokens, p, 500.0).tolist() == [1, 1, 1, 0]


def test_target_shares():
    assert mixing.target_shares({"a": 1, "b": 3}, {"a": 5.0, "b": 5.0}) == {"a": 0.25, "b": 0.75}
    assert mixing.target_shares({"a": 1, "b": 3}, {"a": 5.0, mixing.OTHER: 15.0}) == {"a": 0.25, mixing.OTHER: 0.75}
    assert mixing.target_shares({}, {mixing.OTHER: 9.0}) == {mixing.OTHER: 1.0}


def test_mixture_of_the_documents(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = mixing.mix(spark, docs, **MIXTURE).join(docs.select("doc_id", "text", "source", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    assert (got.n_tokens == got.text.map(lambda x: len((x or "").encode().split()))).all()
    total = got.n_tokens.sum()
    expected = got.n_tokens * got.probability
    assert abs(expected.sum() / total - MIXTURE["budget"]) < 0.02
    raked = got.n_tokens * got.weight
    for column, targets in (("source", MIXTURE["sources"]), ("lang", MIXTURE["languages"])):
        for value, share in targets.items():
            if (got[column] == value).any():
                assert abs(raked[got[column] == value].sum() / total - share / sum(targets.values())) < 0.01
    for name, _, share in MIXTURE["topics"]:
        assert abs(raked[got.topic == name].sum() / total - share) < 0.01
    patterns = [(name, re.compile(pattern)) for name, pattern, _ in MIXTURE["topics"] if pattern]
    first = got.text.map(lambda x: next((name for name, p in patterns if p.search(x or "")), MIXTURE["rest"]))
    assert (first == got.topic).all()
    chosen = got[got.selected]
    assert abs(chosen.n_tokens.sum() / expected.sum() - 1) < 0.1
    again = mixing.mix(spark, docs.repartition(5), **MIXTURE).where("selected").select("doc_id")
    assert {r[0] for r in again.collect()} == set(chosen.doc_id)


def test_mixing_edge_cases(spark, make_docs):
    rows = [(1, "a b"), (2, None), (3, ""), (None, "c"), (1, "a b"), (7, "Licence x")]
    docs = make_docs(rows)
    got = mixing.mix(spark, docs, **MIXTURE).collect()
    assert len(got) == len(rows) and all(r["probability"] is not None and r["selected"] is not None for r in got)
    kept = mixing.sample_documents(spark, docs, **MIXTURE)
    assert kept.columns == docs.columns
    assert mixing.mix(spark, make_docs([]), **MIXTURE).count() == 0
    assert mixing.mix(spark, make_docs([(1, None), (2, "")]), **MIXTURE).where("selected").count() == 2
    nothing = docs.withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit(None).cast("string"))
    assert mixing.mix(spark, nothing, **MIXTURE).count() == len(rows)

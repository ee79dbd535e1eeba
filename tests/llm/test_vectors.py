import time

import numpy as np
import pytest

from ferrule.llm import ann, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, n int, score double"


def table(spark, rows):
    full = [(i, None if v is None else [None if x is None else float(x) for x in v], k, "x", 1, 0.5) for i, v, k in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows(d):
    nan, inf = float("nan"), float("inf")
    return [(9001, None, 1), (9002, [0.0] * d, 1), (9003, [nan] + [1.0] * (d - 1), 1), (9004, [inf] + [1.0] * (d - 1), 1),
            (9005, [None] + [1.0] * (d - 1), 1), (9006, [1.0] * (d - 1), 1), (9007, [], 1)]


def clustered(n, d, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[n // 2:] = x[rng.integers(0, n // 20, n - n // 2)] + 0.06 * rng.normal(size=(n - n // 2, d))
    return x.astype(np.float32)


def brute_links(rows, limit):
    ok = [(i, np.array(v, np.float32).astype(float), k) for i, v, k in rows]
    x = np.stack([v / np.linalg.norm(v) for _, v, _ in ok])
    same = np.array([[a[2] == b[2] and a[2] is not None for b in ok] for a in ok])
    near = (x @ x.T >= limit) & same
    np.fill_diagonal(near, False)
    label = np.array([i for i, _, _ in ok])
    while True:
        new = np.array([min([label[a], *label[near[a]]]) for a in range(len(ok))])
        if (new == label).all():
            return near.sum(1), label
        label = new


@pytest.mark.parametrize("hot", [False, True])
def test_near_vectors_against_brute_force(spark, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(near_vectors, "HOT_HOMES", 10)
    monkeypatch.setattr(near_vectors, "PAIRS", 256)
    x = clustered(600, 16)
    rows = [(k * 3 % 601, x[k].tolist(), None if k % 50 == 7 else k % 3) for k in range(600)]
    rows += [(700 + k, x[5].tolist(), 2) for k in range(30)]  # copies
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(spark, table(spark, rows + odd_rows(16) + [(None, x[0].tolist(), 0)])).collect()}
    assert len(got) == len(rows) + 8
    links, label = brute_links(rows, 0.98)
    assert links.sum() > 500
    found = np.array([got[i]["n_links"] for i, _, _ in rows])
    assert found.sum() >= 0.99 * links.sum() and (found <= links).all()
    assert np.mean([got[i]["component_id"] == c for (i, _, _), c in zip(rows, label, strict=True)]) >= 0.99
    for i, _, _ in odd_rows(16):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert (got[None]["n_links"], got[None]["component_id"], got[None]["kept"]) == (0, None, False)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values() if r["vec_id"] is not None)


def test_hot_cell_holds_only_a_bounded_stored_block(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "HOT_HOMES", 40)
    monkeypatch.setattr(near_vectors, "BLOCK", 32)
    rng = np.random.default_rng(6)
    x = (np.ones(16) + 0.01 * rng.normal(size=(400, 16))).astype(np.float32)  # one cell of near copies
    x[300:] = rng.normal(size=(100, 16))
    rows = [(k, x[k].tolist(), 1) for k in range(400)]
    reps = spark.createDataFrame([(i, v, k, i, 1) for i, v, k in rows], "vec_id long, vec array<float>, label int, rep long, n long")
    index = near_vectors.MultiIndex(near_vectors.vectors.unit(x[299:].astype(float)), 0.98, 0.999)
    hot = near_vectors._hot_cells(spark, reps, index, 16)
    assert any(n > 1 for cell in hot.values() for n in cell.values())
    schema = "vec_id long, vec array<float>, label int, rep long, n long, cell int, split int, salt int, seconds binary, own int"
    key = ["label", "cell", "split", "salt"]
    visits = reps.coalesce(1).mapInArrow(near_vectors._visits(index, 16, hot), schema).sort(*key, near_vectors.F.col("own") < 0)
    batches = visits.toArrow().combine_chunks().to_batches(max_chunksize=50)
    sizes = []

    block = near_vectors.vectors.block

    def counted(column, length):
        sizes.append(len(column))
        return block(column, length)

    monkeypatch.setattr(near_vectors.vectors, "block", counted)
    out = [r for b in near_vectors._verify(0.98, 16, index)(iter(batches)) for r in b.to_pylist()]
    assert max(sizes) <= 80  # a salt's stored rows or a block of queries, never the whole cell
    links, _ = brute_links(rows, 0.98)
    found = np.zeros(400, int)
    for r in out:
        found[r["rep"]] += r["links"]
    assert found.sum() >= 0.99 * links.sum() and (found <= links).all()


def planted_pairs(pairs, d, cosine, rng):
    """Unit vectors, two by two with the given cosine, and otherwise at random."""
    one, step = rng.normal(size=(2, pairs, d))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    step -= (step * one).sum(1, keepdims=True) * one
    step /= np.linalg.norm(step, axis=1, keepdims=True)
    out = np.empty((2 * pairs, d))
    out[::2], out[1::2] = one, cosine * one + np.sqrt(1 - cosine ** 2) * step
    return out


def test_planted_pairs_at_the_limit_over_many_labels(spark):
    """Pairs just above 0.98 are found by both ends, pairs just below by none."""
    rng = np.random.default_rng(8)
    near, far = planted_pairs(1500, 64, 0.9805, rng), planted_pairs(500, 64, 0.9795, rng)
    x = np.concatenate([near, far])
    rows = [(k, x[k].tolist(), k // 2 % 40) for k in range(len(x))]
    rows += [(5000 + k, x[2 * k + 1].tolist(), 99) for k in range(50)]  # near copies of another label
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(spark, table(spark, rows)).collect()}
    links = np.array([got[k]["n_links"] for k in range(3000)])
    assert (links[::2] == links[1::2]).all() and links.max() == 1
    assert links.mean() >= 0.998
    assert all(got[k]["component_id"] == k - k % 2 * links[k] for k in range(3000))
    assert all(got[k]["n_links"] == 0 and got[k]["kept"] for k in got if k >= 3000)


@pytest.mark.parametrize("hot", [False, True])
def test_links_found_by_one_end_count_for_both(spark, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(near_vectors, "HOT_HOMES", 20)
    rng = np.random.default_rng(9)
    x = planted_pairs(1000, 16, 0.981, rng)
    rows = [(k, x[k].tolist(), 1) for k in range(2000)] + [(3000 + k, x[k].tolist(), 1) for k in range(0, 2000, 20)]
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(spark, table(spark, rows), target=0.6).collect()}
    joined = [k for k in range(0, 2000, 2) if got[k + 1]["component_id"] == k]
    assert 600 < len(joined) < 1000  # a low target: many links are found by one end or none
    copies = [k % 20 == 0 for k in joined]
    assert all(got[k]["n_links"] == 1 + c and got[k + 1]["n_links"] == 1 + c for k, c in zip(joined, copies, strict=True))
    assert all(got[k + 1]["n_links"] == 0 for k in range(0, 2000, 2) if k not in set(joined))


def test_traversal_is_in_order_of_the_sums():
    rng = np.random.default_rng(1)
    index = near_vectors.MultiIndex.__new__(near_vectors.MultiIndex)
    one, two = rng.random(9), rng.random(7)
    index.excess = 0.4
    got = [one[i] + two[j] for i, j in index.traverse(one, two)]
    want = sorted(s for s in (one[:, None] + two[None]).ravel() if s <= one.min() + two.min() + 0.4)
    assert np.allclose(got, want)


def test_near_vectors_small_tables(spark):
    assert near_vectors.near_duplicates(spark, table(spark, [])).count() == 0
    got = near_vectors.near_duplicates(spark, table(spark, odd_rows(4))).collect()
    assert len(got) == 7 and all(r["n_links"] == 0 for r in got)
    got = near_vectors.near_duplicates(spark, table(spark, [(4, [1.0, 2], 1), (2, [2.0, 4], 1), (2, [2.0, 4], 1), (1, [1.0, 2], 2)])).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(1, 0, 1), (2, 2, 2), (2, 2, 2), (4, 2, 2)]


def brute_nearest(ids, x, q, k):
    d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(1))
    order = [o for o in np.lexsort((ids, d)) if ids[o] != q][:k]
    return [(int(ids[o]), d[o]) for o in order]


@pytest.mark.parametrize("shard_rows", [4096, 150])
def test_nearest_recall_and_scores(spark, shard_rows):
    from pyspark.sql import functions as F

    x = clustered(900, 24)
    rows = [(k, x[k].tolist(), 0) for k in range(900)]
    df = table(spark, rows + odd_rows(24) + [(None, x[0].tolist(), 0)])
    got = ann.nearest(spark, df, F.col("id") % 20 == 0, k=10, shard_rows=shard_rows).collect()
    ids, doubles = np.arange(900), x.astype(np.float64)
    hits = 0
    for q in range(0, 900, 20):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert [(s, v) for _, v, s in own] == sorted((s, v) for _, v, s in own)
        for _, v, s in own:
            assert s == np.sqrt(((doubles[v] - doubles[q]) ** 2).sum())
        hits += len({v for _, v, _ in own} & {v for v, _ in brute_nearest(ids, doubles, q, 10)})
    assert hits >= 0.97 * 45 * 10


def test_nearest_small_tables_and_ties(spark):
    from pyspark.sql import functions as F

    assert ann.nearest(spark, table(spark, []), F.col("id") % 2 == 0).count() == 0
    assert ann.nearest(spark, table(spark, odd_rows(4)), F.col("id") % 2 == 0).count() == 0
    assert ann.nearest(spark, table(spark, [(2, [1.0, 2], 0)]), F.col("id") % 2 == 0).count() == 0
    rows = [(2, [1.0, 1], 0), (7, [1.0, 2], 0), (5, [2.0, 1], 0), (3, [1.0, 0.5], 0), (2, [9.0, 9], 0)]
    got = ann.nearest(spark, table(spark, rows), F.col("id") == 2, k=2).collect()
    first = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])]
    assert first[0] == 3 and len(got) == 2


@pytest.mark.parametrize("shard_rows", [4096, 120])
def test_nearest_with_many_equal_vectors(spark, shard_rows):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 8)).astype(np.float32)
    x[100:400] = x[100]  # 300 copies
    x[690:] = x[100] + np.float32(0.001) * rng.normal(size=(10, 8)).astype(np.float32)  # beside the group
    ids = rng.permutation(700)
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)]
    asked = [int(ids[k]) for k in (100, 101, 399, 690, 695, 5, 50, 600)]
    got = ann.nearest(spark, table(spark, rows), F.col("id").isin(asked), k=10, shard_rows=shard_rows).collect()
    doubles = x.astype(np.float64)
    for q in asked:
        own = [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
        assert own == brute_nearest(ids, doubles, q, 10)


def test_nearest_with_equal_vectors_and_repeated_ids(spark):
    from pyspark.sql import functions as F

    rows = [(4, [1.0, 2], 0)] * 30 + [(6, [1.0, 2], 0)] * 2 + [(9, [1.0, 2], 0), (8, [1.0, 2.5], 0), (1, [-0.0, 2], 0), (2, [0.0, 2], 0)]
    got = ann.nearest(spark, table(spark, rows), F.col("id").isin(1, 9), k=4).collect()
    of = {q: [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] for q in (1, 9)}
    assert of == {1: [(2, 0.0), (4, 1.0), (4, 1.0), (4, 1.0)], 9: [(4, 0.0)] * 4}
    got = ann.nearest(spark, table(spark, rows[29:]), F.col("id") == 4, k=4).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == [6, 6, 9, 8]


def test_every_row_of_a_graph_can_be_reached():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(300, 8)), np.ones((200, 8)) * 50, 90 + 0.001 * rng.normal(size=(60, 8))])
    g = ann.Graph.build(np.arange(len(x)), x, 1)
    seen, stack = {0}, [0]
    while stack:
        for v in g._near(0, stack.pop()).tolist():
            if v not in seen:
                seen.add(v)
                stack.append(v)
    assert len(seen) == len(x)


@pytest.mark.parametrize("shift, scale", [(0, 1), (1000, 0.1), (1e9, 1), (0, 1e-25), (0, 1e20), (0, 1e200), (0, 1e-200)])
def test_graph_search_in_any_range(shift, scale):
    """Offsets, tiny and huge values: recall, an end within a time limit, exact distances."""
    rng = np.random.default_rng(12)
    x = shift + scale * rng.normal(size=(800, 24))
    x[-1] = 1e20 if 1e-30 < scale < 1e20 else x[-1]  # one row far from the rest
    graph, hit, begun = ann.Graph.build(np.arange(len(x)), x, 1), 0, time.monotonic()
    for i in range(0, 800, 20):
        ids, score = graph.search(x[i], 10, ann.WIDTH, i)
        exact = ann.distances(x, x[i])
        assert np.array_equal(score, exact[ids])
        hit += len(set(ids.tolist()) & set(np.argsort(np.where(np.arange(800) == i, np.inf, exact), kind="stable")[:10].tolist()))
    assert hit >= 0.95 * 400 and time.monotonic() - begun < 20
    assert np.isfinite(ann.distances(x, x[0])).all() and (ann.distances(x, x[0])[1:] > 0).all()
    graph.search(np.full(24, 1e308), 10, ann.WIDTH, -1)

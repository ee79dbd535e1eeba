import numpy as np
import pytest
import xxhash

from ferrule.llm import simhash
from ferrule.llm.components import connected


def brute_fingerprint(text, k):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, distance):
    label = dict.fromkeys(ids)
    nodes = sorted(set(ids))
    label = {i: i for i in nodes}
    links = [(a, b) for x, a in enumerate(ids) for y, b in enumerate(ids) if bin(fps[x] ^ fps[y]).count("1") <= distance]
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return label


def test_fingerprints(words):
    for n in (0, 1, 3, 4, 5, 300, 700):
        w = words(n)
        text = " \x0b".join(w).title() + "É x"
        assert simhash.fingerprint(text, 4) == brute_fingerprint(text, 4)


def test_majority_of_many_hashes():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 2 ** 64, 70_000, dtype=np.uint64)
    want = sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))
    assert simhash.majority(h.astype(">u8").tobytes()) == want


@pytest.mark.parametrize("distance,parts", [(4, 3), (4, 2), (3, 4), (0, 3), (6, 4)])
def test_every_close_pair_meets_at_a_home(distance, parts):
    rng = np.random.default_rng(distance)
    codes = simhash.layout(distance, parts)
    for _ in range(60):
        x = int(rng.integers(0, 2 ** 63))
        y = x
        for b in rng.choice(64, distance, replace=False):
            y ^= 1 << int(b)
        one, two = np.array([x], np.uint64), np.array([y], np.uint64)
        assert any((c.near(two)[1] == c.home(one)[0]).any() for c in codes)


@pytest.mark.parametrize("hot", [False, True])
def test_links_against_brute_force(spark, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(simhash, "HOT_HOMES", 5)
    monkeypatch.setattr(simhash, "PAIRS", 64)
    rng = np.random.default_rng(6)
    centers = rng.integers(0, 2 ** 63, 8, dtype=np.uint64)
    fps = []
    for c in centers:
        for _ in range(40):
            x = int(c)
            for b in rng.choice(64, int(rng.integers(0, 6)), replace=False):
                x ^= 1 << int(b)
            fps.append(x)
    fps = sorted({*fps, *rng.integers(0, 2 ** 63, 200, dtype=np.uint64).tolist()})
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    got = simhash.fingerprint_links(spark, df, 4)
    names = dict(connected(spark, got).collect())
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    want = brute_components(signed, fps, 4)
    assert {s: names.get(s, s) for s in signed} == want
    assert got.count() <= 3 * len(fps) * 16


def test_documents(spark, make_docs, words):
    text = words(200)
    rows = [(5, " ".join(text)), (3, " ".join(text).upper()), (9, " ".join(text)), (8, None), (7, ""), (1, "one"), (2, " one "),
            (None, " ".join(text)), (4, " ".join(words(200))), (4, " ".join(words(200))), (6, " ".join(words(20_000))),
            (50, "tied once"), (60, "tied once"), (60, "tied twice, to another text"), (70, "tied twice, to another text")]
    rows += [(100 + k, " ".join(text[:k] + ["other"] + text[k + 1:])) for k in range(0, 200, 5)]
    got = simhash.near_duplicates(spark, make_docs(rows), 4, 4).collect()
    assert sorted(r["fingerprint"] for r in got) == sorted(f"{brute_fingerprint(x, 4):016x}" for _, x in rows)
    known = [(i, brute_fingerprint(x, 4)) for i, x in rows if i is not None]
    want = brute_components([i for i, _ in known], [f for _, f in known], 4)
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else want[r["doc_id"]])


def test_empty_table(spark, make_docs):
    assert simhash.near_duplicates(spark, make_docs([]), 4, 4).count() == 0


def test_components_of_paths_and_stars(spark):
    path = [(k, k + 1) for k in range(40)]
    star = [(500, 500 + k) for k in range(1, 60)]
    df = spark.createDataFrame(path + star + [(900, 901), (901, 900), (7, 7), (950, 950)], "a long, b long")
    got = dict(connected(spark, df).collect())
    assert got == {**{k: 0 for k in range(41)}, **{500 + k: 500 for k in range(60)}, 900: 900, 901: 900}

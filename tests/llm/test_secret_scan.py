"""Secret scans: base patterns as stated, the network's gradient and pools, held-out findings, odd rows."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrule.llm import char_cnn, secret_scan
from ferrule.llm.queries import op12_secret_scan

#: Forms that no written finding has.
HELD_SECRETS = ["my pass phrase is Tr0ub4dor99xZ ok", "x-auth-token => 8sKd93kLmQpZ17", "db_pwd='hUnter2aaa1' set", "the passphrase = kd83KDk3kdLs",
                "use secret key -> 99aaKKdkeLLss22 here", "sum 0123456789ABCDEF0123456789ABCDEF done"]
HELD_OTHERS = ["see file report_2021_v2.txt now", "version v1.2.3-beta4 of it", "by mail5.example.com or", "order AB-123456 came", "a camelCaseName here",
               "id 550e8400-e29b-41d4-a716-446655440000 is", "ISO-8859-1 text", "part Nr2024-11-30T10 of", "Hello McDonald friends"]


def plain_base(text):
    """The contract's patterns, by the letter."""
    out = [(m.start(), 0, m.end()) for m in
           re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


@pytest.fixture(scope="module")
def scanner():
    return secret_scan.fit(secret_scan.written(secret_scan.WRITTEN_FINDINGS, ["and of the in to that is was", "der die und das", "la maison est bleue", "en la casa hay agua", "x"]))


@given(st.lists(st.sampled_from(["token", "Secret", "API_KEY", "apikey", "passwd", "=", ":", " ", "'", '"', "AKIA", "AKIAAKIA", "ABCDEFGHIJ012345", "a" * 24,
                                 "0f" * 11, "Z", "é", "-", ".", "abc123", "\n", "+/=="]), max_size=14).map("".join))
@settings(max_examples=400, deadline=None)
def test_base_spans_are_the_patterns(text):
    base, own = secret_scan.scan(text)
    assert base == plain_base(text)
    assert all(a[1] <= b[0] for a, b in zip(own, own[1:]))
    hit = secret_scan.touched(base, own)
    assert hit == [any(s < e2 and e > s2 for s, _, e in base) for s2, e2 in own]


def test_gradient():
    net, rng = char_cnn.Net.new(3), np.random.default_rng(1)
    found = secret_scan.written(8, ["one two"])
    rows, gold = np.concatenate([char_cnn.pieces(*x)[:1] for x, _ in found]), np.array([y for _, y in found], float)
    size = char_cnn.lengths([x[1] for x, _ in found])
    _, grad = net.gradient(rows, size, gold)
    for name, p in net.p.items():
        for _ in range(4):
            at = (int(rng.choice(rows.ravel())), int(rng.integers(p.shape[1]))) if name == "embed" else tuple(rng.integers(s) for s in p.shape)
            old, sides = p[at], []
            for step in (1e-6, -1e-6):
                p[at] = old + step
                sides.append(net.gradient(rows, size, gold)[0])
            p[at] = old
            assert abs((sides[0] - sides[1]) / 2e-6 - grad[name][at]) < 1e-5


def test_pieces_pool_the_whole_body():
    """The pieces of a long body hold every stretch of WIDTH characters of it, and no other inside the body."""
    body = "".join(chr(97 + k % 26) + str(k % 10) for k in range(100))
    rows = char_cnn.pieces("left", body, "right")
    inside = rows[:, char_cnn.LEFT:char_cnn.LEFT + char_cnn.BODY] - char_cnn.CLASSES
    got = {tuple(r[k:k + char_cnn.WIDTH]) for r in inside for k in range(char_cnn.BODY - char_cnn.WIDTH + 1) if (r[k:k + char_cnn.WIDTH] > 0).all()}
    code = char_cnn.classes(body)
    assert got == {tuple(code[k:k + char_cnn.WIDTH]) for k in range(len(code) - char_cnn.WIDTH + 1)}


def test_threshold_keeps_the_recall():
    rng = np.random.default_rng(2)
    gold = (rng.random(500) < 0.3).astype(float)
    logit = gold * 2 + rng.normal(0, 1, 500)
    slope, offset = char_cnn.calibrate(logit, gold)
    p = 1 / (1 + np.exp(-(slope * logit + offset)))
    assert abs(p.mean() - gold.mean()) < 0.02
    cut = char_cnn.threshold(p, gold, 0.9)
    assert (p[gold > 0] >= cut).mean() >= 0.9
    better = [c for c in p if (p[gold > 0] >= c).mean() >= 0.9]
    assert gold[p >= cut].mean() >= max(gold[p >= c].mean() for c in better) - 1e-12
    assert char_cnn.threshold(p, gold * 0, 0.9) == 1.0


def test_held_out_findings(scanner):
    fresh = secret_scan.written(800, ["other words stand around here"], seed=77)
    gold, hit = np.array([y for _, y in fresh]), scanner.probabilities([x for x, _ in fresh]) >= scanner.cut
    for k in range(3):
        assert hit[gold[:, k] == 1, k].mean() >= 0.9
        assert gold[hit[:, k], k].mean() >= 0.85
    added = [len(spans) > len(base) for base, spans in scanner.scan_texts(HELD_SECRETS)]
    assert sum(added) >= 5
    assert sum(len(spans) for _, spans in scanner.scan_texts(HELD_OTHERS)) == 0


def test_long_bodies_and_no_candidates(scanner):
    long = "xy " * 30_000 + "passphrase is Zx81kLm02qWe9 " + "Q1" * 4000 + " token: abcdef" + "!" * 50_000
    (base, spans), empty = scanner.scan_texts([long, ""])
    assert base == plain_base(long) and set(base) <= set(spans) and empty == ([], [])
    assert (90_014, 0, 90_027) in spans


def test_odd_rows(spark, make_docs, scanner):
    text = 'the token = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f" of, pwd = hUnter2aaa1xY and'
    docs = make_docs([(1, text), (None, text), (1, text), (2, None), (3, ""), (4, "plain é words only"), (50, "AKIA" + "A1" * 30)])
    got = {}
    for r in secret_scan.find(spark, docs, scanner).collect():
        got.setdefault(r["doc_id"], []).append(r[1:])
    digest = lambda base: hashlib.sha256(base.encode()).hexdigest()
    first = got[1][0]
    assert got[1] == [first, first] and got[None] == [first]
    assert first[:4] == (1, 0, 1, digest("assign:4:53,hex:13:53"))
    assert first[4].startswith("assign:4:53,hex:13:53") and "assign:65:78" in first[4]
    assert got[2] == got[3] == got[4] == [(0, 0, 0, digest(""), "")]
    assert got[50][0][:4] == (0, 1, 0, digest("access:0:64"))
    masked = {r["doc_id"]: r for r in secret_scan.redact(spark, docs, scanner).collect()}
    assert masked[1]["text"] == 'the <ASSIGN>" of, pwd = <ASSIGN> and' and masked[1]["spans"] == "y"
    assert masked[2]["text"] is None and masked[3]["text"] == ""
    assert secret_scan.find(spark, docs.limit(0), scanner).collect() == []


def test_query_finds_every_base_span(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op12_secret_scan(spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        base = plain_base(r["text"] or "")
        out = got[r["doc_id"]]
        names = [f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert out["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert (out["n_assign"], out["n_access"], out["n_hex"]) == tuple(sum(x[1] == k for x in base) for k in range(3))
        assert set(names) <= set(out["spans"].split(",")) if names else True

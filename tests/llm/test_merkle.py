"""The Merkle manifest against a plain tree, and its defined cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ferrule.llm import merkle
from ferrule.llm.queries import MANIFEST_FIELDS, tampered_text

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def leaf_of(row) -> str:
    put = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(put(row[f]) for f in ("doc_id", "source", "lang", "n_chars", "text")))


def climb(nodes):
    """The top of ``nodes`` and for each of them its path of (left, right)."""
    paths, of = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(of):
            run = nodes[at // 3 * 3:at // 3 * 3 + 3]
            paths[i].append(("".join(run[:at % 3]), "".join(run[at % 3 + 1:])))
        nodes = [sha("".join(nodes[k:k + 3])) for k in range(0, len(nodes), 3)]
        of = [at // 3 for at in of]
    return nodes[0], paths


def brute(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    held = {}
    for s in sources:
        own = sorted((r for r in rows if r["source"] == s), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        held[s] = (own, *climb([leaf_of(r) for r in own]))
    root, tops = climb([held[s][1] for s in sources])
    out = []
    for (own, sub, paths), top in zip(held.values(), tops, strict=True):
        for r, path in zip(own, paths, strict=True):
            now = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                now["text"] = r["text"].replace("\n", "")
            node = leaf_of(now)
            for left, right in path + top:
                node = sha(left + node + right)
            proof = sha("".join(x + y for x, y in path + top))
            out.append((r["doc_id"], leaf_of(r), sub, root, proof, node, node == root))
    return out


def run(spark, df):
    docs = df
    return [tuple(r) for r in merkle.manifest(spark, docs, MANIFEST_FIELDS, {"text": tampered_text(docs)}).collect()]


def check(spark, rows):
    got = run(spark, spark.createDataFrame(rows, DOCS))
    want = brute([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows])
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


@pytest.mark.parametrize("sizes", [(1,), (2,), (243,), (244,), (1, 3, 7, 28, 730), tuple(range(1, 12))])
def test_equals_a_plain_tree(spark, sizes):
    rows, at = [], 0
    for k, n in enumerate(sizes):
        for _ in range(n):
            at += 1
            rows.append((at * 7 % 100003, f"line {at}\nnext é {at}" if at % 3 else "no break", "en", f"src{k}" if k else None, at))
    got = check(spark, rows)
    assert len(got) == len(rows)


def test_several_tiers_of_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = [(k, f"t{k}\n", "de", f"s{k % 2}" if k % 10 else f"t{k}", k) for k in range(400)]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(None, "null id\n", None, None, None), (None, None, None, "a", 3), (5, None, "en", "a", 1), (5, "", "en", "a", 1), (5, "x", "en", "a", 1),
            (7, "same\n", "en", "B", 2), (7, "same\n", "en", "B", 2), (8, "y" * 200_000 + "\n", "en", "é", 3), (9, "z", "", "", 0),
            (-3, "a\n\nb", "en", "a:1", 4)]
    check(spark, rows)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, spark.createDataFrame([], DOCS)) == []
    rows = [(k, f"t{k}\n", "en", "s", 1) for k in range(30)]
    plain = spark.createDataFrame(rows, DOCS)
    more = plain.selectExpr("*", "1 AS pos", "'x' AS grp", "'y' AS node", "2 AS n", "'z' AS leaf", "3 AS block", "'r' AS root", "4 AS at")
    assert sorted(run(spark, more)) == sorted(run(spark, plain))


def test_any_change_is_found(spark):
    docs = spark.createDataFrame([(k, f"t{k}", "en", f"s{k % 3}", 1) for k in range(50)], DOCS)
    now = F.when(F.col("doc_id") == 17, F.lit("t17 ")).otherwise(F.col("text"))
    out = merkle.manifest(spark, docs, MANIFEST_FIELDS, {"text": now}).collect()
    assert [r["doc_id"] for r in out if not r["verified"]] == [17]

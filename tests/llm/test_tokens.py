import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from ferrule.llm import byte_bpe, pieces, token_counts

TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n  x\t y", "it's we'll 's 'd", "foo bar 　baz", "x" * 5000,
         "é ü  ñ 漢字 123 4 5  6", "a <|endoftext|> b<|endoftext|>", "<|endoftext|>", "tab\tsep \x1c x \x85 y", "\r\n\r\n ok",
         "😀 👩‍👩‍👧 z", "a b   c", "!!! ... ??? -- ", "\x00 \x01a", "Ġword ĠĠ", "1 2  3   4    5", "end \n"]


@pytest.fixture(scope="module")
def rank_encoding():
    lines = open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n):
    rng = np.random.default_rng(9)
    letters = list("ab Z\n\t'12.é漢    s")
    return ["".join(rng.choice(letters, size=int(rng.integers(0, 60)))) for _ in range(n)]


def test_codec_is_the_library(rank_encoding):
    codec = byte_bpe.Codec(byte_bpe.file_bytes(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    for text in TEXTS + random_texts(3000):
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == rank_encoding.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_encode_and_decode_tables(spark, make_docs, rank_encoding, words):
    rows = [*enumerate(TEXTS), (None, "x y"), (50, None), (3, "a"), (60, " ".join(words(50_000)))]
    path = P.path("byte_bpe_multi_50k.tiktoken")
    out = byte_bpe.decode(spark, byte_bpe.encode(spark, make_docs(rows), path, P.PATTERN), path)
    got = sorted(map(tuple, byte_bpe.digests(out).collect()), key=str)
    want = []
    for i, x in rows:
        ids = rank_encoding.encode_ordinary(x or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((x or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert byte_bpe.encode(spark, make_docs([]), path, P.PATTERN).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_the_library_s(name):
    data = byte_bpe.file_bytes(P.path(name))
    kind = name.rsplit(".", 1)[1]
    many, _ = token_counts._whole_counter(data, kind)
    count = token_counts.counter(data, kind)
    texts = TEXTS + random_texts(1500)
    assert [count(x) for x in texts] == [many([x])[0] for x in texts]


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_PARTS", 10)
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    memo = pieces.PieceMemo(lambda texts: [len(tk.encode(x, add_special_tokens=False).ids) for x in texts])
    for text in random_texts(300):
        assert sum(memo.values(text)) == len(tk.encode(text, add_special_tokens=False).ids)
        assert len(memo.memo) < 80


def test_cache_holds_each_content_once(spark, make_docs, tmp_path):
    path, cache = P.path("byte_bpe_50k.json"), str(tmp_path / "cache")
    tk = Tokenizer.from_file(path)
    size = lambda x: len(tk.encode(x or "", add_special_tokens=False).ids)
    rows = [(1, "a b c"), (2, "a b c"), (None, "x"), (4, None), (5, ""), (1, "a b c"), (6, "long " * 2000)]
    for k, more in enumerate(([], [], [(7, "new text"), (8, "a b c")])):
        got = token_counts.count_tokens(spark, make_docs(rows + more), path, cache, 1024).collect()
        assert sorted(map(tuple, got), key=str) == sorted(
            [(i, len((x or "").encode()), size(x), size(x) > 1024) for i, x in rows + more], key=str)
        stored = spark.read.parquet(cache).groupBy("tokenizer").count().collect()
        assert [r["count"] for r in stored] == [4 if k < 2 else 5]
    token_counts.count_tokens(spark, make_docs(rows), P.path("byte_bpe_50k.json"), cache).count()
    other = token_counts.count_tokens(spark, make_docs([(1, "a b c")]), P.path("piece_bpe_32k.model"), cache).collect()
    assert len(other) == 1 and spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


def test_empty_table(spark, make_docs, tmp_path):
    assert token_counts.count_tokens(spark, make_docs([]), P.path("byte_bpe_50k.json"), str(tmp_path / "c")).count() == 0

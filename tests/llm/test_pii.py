import hashlib
import re

import numpy as np
import pytest

from ferrule.llm import pii
from ferrule.llm.char_tagger import TAGS, Tagger


@pytest.fixture(scope="module")
def tagger(spark):
    """The query's own: trained from documents by ``pii.train``."""
    return Tagger(pii.train(spark, spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).light())


def brute_base(text):
    """The base patterns as they are stated, by plain regular expressions."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and sum(d[::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


HARD = ["", "a@b.c@d.e x@y z@w.v.", "1.2.3.45.6.7.8 001.2.3.4 1.2.3.999 1.2.3", "+1 (538) 555-4734 4663622617512349",
        "4111 1111 1111 1111 4111-1111-1111-1112", "@@@a@@b.c+1+12345678", "é.x+y@ü.com é9.9.9.9é", "+1 2 3", "9" * 400,
        "me@a-b.c.", "x" * 300 + "@h.io", "1.1.1.1" * 30]


@pytest.mark.parametrize("text", HARD)
def test_base_spans_are_the_stated_patterns(text):
    assert pii.base_spans(text) == brute_base(text)


def test_base_spans_on_random_text():
    rng = np.random.default_rng(1)
    for _ in range(400):
        text = "".join(rng.choice(list("a1 .@+-()25é"), size=int(rng.integers(0, 120))))
        assert pii.base_spans(text) == brute_base(text)


def test_gradient_is_the_difference_quotient():
    rng = np.random.default_rng(0)
    tagger = Tagger.new()
    x = rng.integers(0, 130, (3, 9)).astype(np.int16)
    gold = np.zeros((3, 9), np.int64)
    gold[0, 3], gold[0, 4:6], gold[2, 1] = 1, 2, 5
    _, grad = tagger.gradient(x, gold)
    for name, value in tagger.p.items():
        at = (int(x[0, 3]), 5) if name[0] == "x" else tuple(rng.integers(0, n) for n in value.shape)
        value[at] += 1e-5
        high, _ = tagger.gradient(x, gold)
        value[at] -= 2e-5
        low, _ = tagger.gradient(x, gold)
        value[at] += 1e-5
        assert abs((high - low) / 2e-5 - grad[name][at]) < 1e-4


def test_viterbi_is_the_best_of_all_paths():
    from itertools import product

    rng = np.random.default_rng(2)
    tagger = Tagger.new()
    for name in ("move", "start", "end"):
        tagger.p[name] = rng.normal(size=tagger.p[name].shape)
    x = rng.integers(0, 130, (2, 3)).astype(np.int16)
    s, _, _ = tagger.scores(x)
    move = tagger._moves()
    for b in range(2):
        best = max(product(range(TAGS), repeat=3), key=lambda p: tagger.p["start"][p[0]] + tagger.p["end"][p[-1]]
                   + sum(s[t, b, p[t]] for t in range(3)) + sum(move[p[t], p[t + 1]] for t in range(2)))
        assert tuple(tagger.decode(x)[b]) == best


#: Forms that the tagger has not been trained on.
UNSEEN = [
    (0, "{w}_{w}(at){w}.{t}"), (0, "{u} @{w}.{t}"), (0, "{w} dot {w}{d2} at {w} dot {w} dot {t}"), (0, "{u} (@) {w} (.) {t}"),
    (1, "{n} [dot] {n} [dot] {n} [dot] {n}"), (1, "{n}(dot){n}(dot){n}(dot){n}"), (1, "{n}[.]{n}.{n}.{n}"),
    (2, "{c}. {c}. {c}. {c}"), (2, "{c} / {c} / {c} / {c}"), (2, "{c}:{c}:{c}:{c}"),
    (3, "({d3}){d3}-{d4}"), (3, "{d3}/{d3}-{d4}"), (3, "{d3} {d3}-{d4}"), (3, "00{d2}-{d2}-{d7}"), (3, "001 {d3} {d3} {d4}"),
]


def found_share(tagger, forms, texts, each):
    """Shares of the written items found exactly and of the look-alikes with a span, each put among words of documents."""
    rng = np.random.default_rng(77)
    plain = [w for x in texts for w in x.split() if not re.search("[0-9@]", w)]
    found, wrong = [], []
    for kind, form in forms * each:
        item, at = pii._write(form, rng), int(rng.integers(len(plain) - 30))
        before = " ".join(plain[at:at + 12])[int(rng.integers(20)):] + " "
        text = before + item + " " + " ".join(plain[at + 12:at + 30])
        base, spans = next(iter(pii.tag_texts(tagger, [text])))
        if kind is None:
            wrong.append(len(spans) > len(base))
        else:
            found.append((len(before), kind, len(before) + len(item)) in spans)
    return np.mean(found), np.mean(wrong) if wrong else 0.0


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 7 = 3").select("text").limit(1500).collect()
    return [r["text"] or "" for r in rows]


def test_held_out_written_data_is_found(tagger, texts):
    found, wrong = found_share(tagger, pii.WRITTEN, texts, 8)
    print("trained forms", found, wrong)
    assert found >= 0.9 and wrong <= 0.02


def test_unseen_forms_are_found(tagger, texts):
    found, _ = found_share(tagger, UNSEEN, texts, 12)
    print("unseen forms", found)
    assert found >= 0.7


@pytest.mark.parametrize("item", ["john.smith(at)example.com", "jane dot doe at example dot com", "0049 30 1234567", "555 123 4567",
                                  "10[.]0[.]0[.]1", "john @ example.com"])
def test_items_at_every_offset(tagger, item):
    found = 0
    for n in range(32):
        text = "a " * n + item + " b" * 30
        found += any(text[s:e] == item for s, _, e in next(iter(pii.tag_texts(tagger, [text])))[1])
    print(item, found)
    assert found >= 28


def test_documents_are_left_alone(tagger, texts):
    """What is added to documents that hold base spans only: next to nothing."""
    added = [t[s:e] for t, (base, spans) in zip(texts, pii.tag_texts(tagger, texts), strict=True) for s, k, e in spans if (s, k, e) not in base]
    assert len(added) <= 2


def test_an_address_begins_with_its_last_word():
    for text, own in [("a b john @ x.org", "john @ x.org"), ("so jane dot doe at x dot org", "jane dot doe at x dot org"),
                      ("me (@) x.org", "me (@) x.org"), ("@x.org", "@x.org"), ("a (at) b.org", "a (at) b.org")]:
        assert text[pii.begun_at(0, text):] == own
    assert pii.begun_at(3, "at a 1") == 0


@pytest.mark.parametrize("text, yes", [("a at b dot c", True), ("a(at)b.com", True), ("look at me. So", False), ("a [at] b (dot) org", True),
                                       ("at dot", False), ("a@b", False), ("a @ b . c", True)])
def test_form_of_spelled_addresses(text, yes):
    assert pii.plausible(0, text) == yes


def test_spans_across_windows_are_whole_and_plain_text_has_none(tagger, words):
    for shift in range(0, 120, 7):
        text = "x" * shift + " " + " ".join(words(12))[:60] + " (538) 555-4734 " + " ".join(words(30))
        _, spans = next(iter(pii.tag_texts(tagger, [text])))
        assert [text[s:e] for s, k, e in spans] == ["(538) 555-4734"]
    assert list(pii.tag_texts(tagger, [" ".join(words(500)), ""])) == [([], []), ([], [])]


def test_find_and_redact(spark, make_docs, tagger, words):
    long = " ".join(words(30_000)) + " me@host.example.com " + " ".join(words(10))
    rows = [(1, "call +1 (538) 555-4734 now"), (2, None), (3, ""), (None, "ip 10.0.0.1"), (1, "call +1 (538) 555-4734 now"), (5, long)]
    docs = make_docs(rows)
    got = pii.find(spark, docs, tagger).collect()
    assert len(got) == len(rows)
    for r in got:
        texts = [x or "" for i, x in rows if i == r["doc_id"]]
        base = brute_base(texts[0])
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[1] == i for b in base) for i in range(4)]
        assert set(joined.split(",")) <= set(r["spans"].split(","))
    out = pii.redact(spark, docs, tagger)
    assert out.columns == docs.columns
    by = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert (1, "call <PHONE> now") in by and (2, None) in by and (None, "ip <IP>") in by
    assert by[1, "call <PHONE> now"]["n_chars"] == 16
    assert any(i == 5 and t.count("<EMAIL>") == 1 and "me@" not in t for i, t in by if i)


def test_empty_table(spark, make_docs):
    docs = make_docs([])
    tagger = pii.train(spark, docs)
    assert pii.find(spark, docs, tagger).count() == 0
    assert pii.redact(spark, docs, tagger).count() == 0


@pytest.mark.parametrize("size", [10, 47, 48, 60, 95, 96, 150, 400])
def test_long_spans_are_joined_at_every_offset(size):
    """A span that every window tags rightly is found whole, wherever it lies, beside another kind."""
    for start in range(0, 110):
        n = start + size + 70
        gold = np.zeros(n, np.int8)
        gold[start], gold[start + 1:start + size] = 5, 6
        gold[start + size], gold[start + size + 1:start + size + 5] = 7, 8
        whole, cut = [], []
        for s in pii.windows(n):
            tags = np.zeros(pii.WINDOW, np.int8)
            own = gold[s:s + pii.WINDOW].copy()
            if own[0] and own[0] % 2 == 0:
                own[0] -= 1  # a window can't go on with what it has not begun
            tags[:len(own)] = own
            a, b = pii.spans_of(tags, s, n)
            whole += a
            cut += b
        found = set(whole + pii.joined(cut))
        assert found == {(start, 2, start + size), (start + size, 3, start + size + 5)}


def test_parts_without_an_end_are_left_out():
    assert pii.joined([(10, 0, 96, False, True)]) == []
    assert pii.joined([(48, 0, 70, True, False)]) == []
    assert pii.joined([(10, 0, 96, False, True), (48, 1, 99, True, False)]) == []
    assert pii.joined([(10, 0, 96, False, True), (48, 0, 99, True, False)]) == [(10, 0, 99)]

"""Secret scans: base patterns, and spans added by a character convolutional network.

The candidates are all runs of ``[A-Za-z0-9+/_=.-]``, without dots and dashes at their ends, of at least ``SHORTEST`` characters
that mix digits, lower and upper case or ``+/_=`` (a first capital alone is no mix).  Each is scored with its whole body and its
context; one that touches no base span is added under its likeliest kind if that kind's calibrated probability
reaches its threshold.

The network is trained on the driver, in numpy, from labelled findings: candidates of a bounded sample of the documents
(``SAMPLE_DOCUMENTS`` by a hash of the id, the first 8 findings of each, of up to 400 characters, ``SAMPLE_FINDINGS`` in all; labels are the
kinds of the base spans they touch) and
``WRITTEN_FINDINGS`` written ones, secrets in forms that the base patterns leave out and look-alikes.  A
share ``HELD`` of the findings does not train: on it the logits are calibrated (logistic), and each kind's threshold is the one of highest
precision among those that keep ``RECALL`` of its findings.

Defined cases: null text is empty; null ids stay null; rows that repeat are read each; without any document the network
is trained on written findings alone; an empty table gives no rows; long texts are read whole; other columns are ignored by
``find``, kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.char_cnn import LEFT, RIGHT, Net, calibrate, threshold
from ferrule.llm.common import text_of

KINDS = ("assign", "access", "hex")
#: The base patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
SHORTEST = 8
RUN = re.compile(f"[A-Za-z0-9+/_=.-]{{{SHORTEST},}}")
SAMPLE_DOCUMENTS, SAMPLE_FINDINGS, WRITTEN_FINDINGS, HELD = 4000, 600, 4800, 0.3
STEPS, BATCH, RATE, RECALL = 700, 64, 0.01, 0.95

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def mixed(body: str) -> bool:
    rest = body[1:]
    if rest.isalpha():
        return not (rest.islower() or body.isupper())
    return any(c.isdigit() for c in body) + any(c.islower() for c in body) + any(c.isupper() for c in body) + any(c in "+/_=" for c in body) > 1


def scan(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Base spans, in order of start, then kind, and the candidates."""
    base, found = [], []
    if "=" in text or ":" in text:
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    for m in RUN.finditer(text):
        run = m.group()
        if len(run) >= LEAST_ACCESS:  # matches of these two kinds lie inside a run
            at = m.start()
            base += [(at + x.start(), 1, at + x.end()) for x in ACCESS.finditer(run) if x.end() - x.start() >= LEAST_ACCESS]
            base += [(at + x.start(), 2, at + x.end()) for x in HEX.finditer(run) if x.end() - x.start() >= LEAST_HEX]
        if run.isalpha() and run[1:].islower():
            continue
        body = run.rstrip(".-")
        start = m.start() + len(body)
        body = body.lstrip(".-")
        start -= len(body)
        if len(body) >= SHORTEST and mixed(body):
            found.append((start, start + len(body)))
    return sorted(base), found


def touched(base: list[Span], own: list[tuple[int, int]]) -> list[bool]:
    """Whether each candidate (in order, apart from each other) overlaps a base span."""
    out, k, reach = [], 0, 0
    for start, end in own:
        while k < len(base) and base[k][0] < end:
            reach = max(reach, base[k][2])
            k += 1
        out.append(reach > start)
    return out


def seen(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[max(0, start - LEFT):start], text[start:end], text[end:end + RIGHT]


class Scanner:
    """The network with its calibration (slope and offset a kind) and thresholds."""

    def __init__(self, net: Net, curve: np.ndarray, cut: np.ndarray):
        self.net, self.curve, self.cut = net, curve, cut

    def probabilities(self, candidates: list[tuple[str, str, str]]) -> np.ndarray:
        z = self.net.logits(candidates) * self.curve[:, 0] + self.curve[:, 1]
        return 0.5 * np.tanh(0.5 * z) + 0.5

    def light(self) -> tuple:
        return self.net.light(), self.curve, self.cut

    def scan_texts(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """Base spans and all spans of each text; the candidates of many texts are scored together."""
        found = [scan(t) for t in texts]
        p = self.probabilities([seen(t, *c) for t, (_, own) in zip(texts, found, strict=True) for c in own])
        over = np.where(p >= self.cut, p, 0)
        kind, chosen = over.argmax(1), over.max(1) > 0
        out, at = [], 0
        for base, own in found:
            free = [k for k, touches in enumerate(touched(base, own)) if not touches and chosen[at + k]]
            out.append((base, sorted([*base, *((own[k][0], int(kind[at + k]), own[k][1]) for k in free)])))
            at += len(own)
        return out


def fit(findings: list[tuple[tuple[str, str, str], tuple[int, ...]]], seed: int = 9) -> Scanner:
    """A scanner from labelled findings: (left, body, right) and a 0 or 1 a kind."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(findings))
    held, own = np.split(order, [int(HELD * len(findings))])
    gold = np.array([y for _, y in findings], np.float64)
    net = Net.new(len(KINDS))
    net.train([findings[i][0] for i in own], gold[own], STEPS, BATCH, RATE)
    logit = net.logits([findings[i][0] for i in held])
    curve = np.array([calibrate(logit[:, k], gold[held, k]) for k in range(len(KINDS))])
    scanner = Scanner(net, curve, np.ones(len(KINDS)))
    p = scanner.probabilities([findings[i][0] for i in held])
    scanner.cut = np.array([threshold(p[:, k], gold[held, k], RECALL) for k in range(len(KINDS))])
    return scanner


#: Written findings: names of secrets and of other things, what joins a name and a value, and values by form (a a letter, A a
#: capital, d a digit, x any of the three, K a capital or digit, h and H a hex digit, b a base64 digit; a number repeats the next letter).
SECRET_NAMES = ["password", "passwd", "secret", "token", "api_key", "pwd", "pass", "passphrase", "auth", "auth_key", "access key", "client secret",
                "private key", "credential", "credentials", "bearer", "Authorization: Bearer", "login", "signing key", "PASSWORD", "DB_PASS", "Secret"]
OTHER_NAMES = ["version", "file", "id", "user", "order", "date", "build", "see", "the", "model", "room", "invoice", "size", "ref", "at", "from", "host",
               "url", "package", "section", "part", "chapter", "mail", "key figure", "name", "class", "release"]
JOINS = ["=", ": ", " = ", ":=", " => ", " -> ", " is ", ' "', "='", ': "', " ", " was ", "\n", '": "', " - "]
NEAR_NAMES = ["words", "passing", "secretary", "tokens", "author", "keyboard", "passage", "compass", "authority", "logic", "bear", "cardinal", "monkey",
              "secrecy", "wordy", "crossword", "bypass", "passport"]
SECRET_VALUES = ["8x", "12x", "16x", "20x", "32x", "40x", "24b", "40b=", "30b==", "6a4d", "A6a3d", "5a_4d", "eyJ20x.30x.30b", "sk-30x", "gpp_36x", "16h", "20h",
                 "4x-4x-4x-4x", "10x/10x+8x"]
OTHER_VALUES = ["4a_5a_d", "5aA5a", "vd.d.d-rc2d", "5a2d.7a.3a", "3a/4a/5ad.3a", "4d-2d-2dT2d", "2A-6d", "3d.4a/2d", "8h", "10h", "AAAAA4d", "ISO-4d-d",
                "8h-4h-4h-4h-12h", "3a3a.2d.txt", "A4aA4a2d", "5a-5a-2d", "www.8a.3a/4a2d", "4a=6a", "_5a_3a_"]
ACCESS_PREFIXES = ["AKIA", "ASIA", "AROA", "AIDA", "ANPA", "AGPA"]
HEX_VALUES = ["24h", "32h", "40h", "64h", "24H", "32H", "40H", "64H"]
SETS = {"a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "d": "0123456789", "h": "0123456789abcdef", "H": "0123456789ABCDEF"}
SETS["x"] = SETS["a"] + SETS["A"] + SETS["d"]
SETS |= {"b": SETS["x"] + "+/", "K": SETS["A"] + SETS["d"]}
FORM = re.compile("([0-9]*)([aAdxhHbK])|(.)")


def write_value(form: str, rng: np.random.Generator) -> str:
    out = []
    for m in FORM.finditer(form):
        letters = SETS.get(m[2], m[3])
        out += [letters[i] for i in rng.integers(len(letters), size=int(m[1] or 1))]
    return "".join(out)


def written(n: int, around: list[str], seed: int = 11) -> list[tuple[tuple[str, str, str], tuple[int, ...]]]:
    """``n`` written findings with words of ``around`` before and after them."""
    rng = np.random.default_rng(seed)
    pick = lambda x: x[int(rng.integers(len(x)))]
    out = []
    while len(out) < n:
        case = len(out) % 8
        secret = case in (0, 1, 2) or case == 4 and rng.random() < 0.3
        value = write_value(pick(SECRET_VALUES if case < 3 else HEX_VALUES if case == 4 else OTHER_VALUES), rng)
        if case == 3:
            value = pick(ACCESS_PREFIXES) + write_value("16K", rng)
        elif case == 5 and rng.random() < 0.5:  # a random value that nothing calls a secret
            value = write_value(pick(["8x", "10x", "4A4d", "9A3d", "14A2d"]), rng)
        if len(value.strip(".-")) < SHORTEST or not mixed(value.strip(".-")):
            value += "a1Z" + write_value("6x", rng)
        name = pick(SECRET_NAMES if secret else OTHER_NAMES) if secret or rng.random() < 0.6 else ""
        join = pick(JOINS) if name else " "
        quote = join[-1] if join[-1] in "\"'" else ""
        words = pick(around).split() or ["the"]
        if rng.random() < 0.5:  # invented words, and some that look like names of secrets
            words = [write_value(f"{rng.integers(1, 9)}a", rng) if rng.random() < 0.7 else pick(NEAR_NAMES) for _ in range(6)]
        k = int(rng.integers(len(words) + 1))
        text = " ".join(words[:k]) + " " + name + join
        tail = quote + pick([" ", ". ", ", ", "\n", ""]) + " ".join(words[k:])
        hexed = case == 4
        out.append(((text[-LEFT:], value, tail[:RIGHT]), (int(secret), int(case == 3), int(hexed))))
    return out


def train(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Scanner:
    """A scanner from findings of a bounded sample of the documents and from written ones."""
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("secrets")), F.lit(1 << 30)) <= int(share * (1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column("text"):
                text = x.as_py()
                base, own = scan(text)
                for start, end in own[:8]:
                    kinds = [int(any(k == kind and s < end and e > start for s, k, e in base)) for kind in range(len(KINDS))]
                    out.append((*seen(text, start, end), kinds))
                out.append((text[:60], "", "", [0] * len(KINDS)))  # words to write around
            left, body, right, kinds = zip(*out, strict=True) if out else ([],) * 4
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()), pa.array(body, pa.string()), pa.array(right, pa.string()),
                                              pa.array(kinds, pa.list_(pa.int32()))], ["l", "body", "r", "kinds"])

    found = drawn.mapInArrow(run, "l string, body string, r string, kinds array<int>").where(F.length("body") <= 400).distinct()
    ordered = found.orderBy(F.desc(F.col("body") != ""), F.desc(F.array_contains("kinds", 1)), F.xxhash64("l", "body"))
    real = [((r["l"], r["body"], r["r"]), tuple(r["kinds"])) for r in ordered.limit(SAMPLE_FINDINGS).collect()]
    words = found.where("body = ''").orderBy(F.xxhash64("l")).limit(SAMPLE_FINDINGS).collect()
    around = [re.sub("[0-9:=]", "", r["l"]) for r in words] or ["and of the in to that is was"]
    return fit([f for f in real if f[0][1]] + written(WRITTEN_FINDINGS, around))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


FOUND = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def find(spark: SparkSession, docs: DataFrame, scanner: Scanner, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` for every row: numbers and digest of the base spans, and all
    spans as ``kind:start:end`` in code points, comma-joined."""
    sent = spark.sparkContext.broadcast(scanner.light())
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, curve, cut = sent.value
        model = Scanner(Net(net), curve, cut)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                got = model.scan_texts(b.column("text").to_pylist())
                counts = [[sum(x[1] == k for x in base) for base, _ in got] for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                     pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in got], pa.string()),
                     pa.array([_joined(spans) for _, spans in got], pa.string())],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {FOUND}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind's name; overlapping spans are one, named by the first."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(spark: SparkSession, docs: DataFrame, scanner: Scanner, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with all spans masked; null texts stay null."""
    sent = spark.sparkContext.broadcast(scanner.light())
    names, place = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, curve, cut = sent.value
        model = Scanner(Net(net), curve, cut)
        for b in batches:
            texts = b.column(place).to_pylist()
            spans = [x for _, x in model.scan_texts([t or "" for t in texts])]
            cols = list(b.columns)
            cols[place] = pa.array([masked(t, s) if s else t for t, s in zip(texts, spans, strict=True)], cols[place].type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(run, docs.schema)

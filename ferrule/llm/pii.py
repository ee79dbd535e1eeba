"""Personal data: base patterns, and spans added by a character-level BiLSTM-CRF.

The tagger is trained on the driver, in numpy, from labelled spans: at most ``SAMPLE_WINDOWS`` windows of at most about ``SAMPLE_DOCUMENTS``
documents (by a hash of the id) with their base spans, and ``WRITTEN_WINDOWS`` windows into which other ways of writing the same kinds of data,
and look-alikes, have been put (``WRITTEN``), among words of documents, made-up words or single letters; ``STEPS`` steps of ``BATCH`` windows.
In tasks every text is cut into overlapping windows of ``WINDOW`` characters.  Each kind has a digit, an ``@``, an "at" in brackets or the
word "dot" in every span, so windows without one cannot give a
span and are not scored; all others are decoded.  The windows' spans are then reconciled over the whole
text: a span that an inner window edge cuts gives way to the one the next window sees whole, or, where no window does (over 47
characters), is put together from the parts that adjoining windows see; an e-mail address begins with the last word before its at (and
those tied to it by "dot"); spans found by more
windows go before others, and an added span must keep its kind's form (``plausible``) and touch no base span.

Defined cases: null text is empty; null ids stay null; rows that repeat are read each; without any
document the tagger is trained on written samples alone; an empty table gives no rows; other columns are
ignored by ``find``, kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.char_tagger import KINDS, PAD, STRIDE, WINDOW, Tagger, classes
from ferrule.llm.common import text_of

SAMPLE_DOCUMENTS, SAMPLE_WINDOWS, WRITTEN_WINDOWS = 4000, 600, 6400
STEPS, BATCH, RATE = 500, 64, 0.04
MARK = re.compile("[0-9@]")
#: A spelled e-mail address holds an "at" in brackets or the word "dot", ...
SPELLED_MARK = re.compile(r"[\[({<]\s?at\s?[\])}>]|\bdot\b")
AT_MARK = re.compile(r"[\[({<]\s?(?:at|@)\s?[\])}>]|@|\sat\s")
#: ... and has this form.
SPELLED = re.compile(r"[A-Za-z0-9]\s*(?:[\[({<]\s?at\s?[\])}>].*[A-Za-z0-9]\W*(?:\.|\bdot\b)|\sat\s.*[A-Za-z0-9]\W+dot\b)\W*[A-Za-z]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: The base patterns (the e-mail's local part is found backwards from its @).
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _small(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) <= 3 and int(number or "0") <= 255


def _emails(text: str) -> Iterator[Span]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            last = found.end()
            yield start, 0, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    """Base matches, leftmost and non-overlapping per kind, in order of start, then kind."""
    if not MARK.search(text):
        return []
    out = list(_emails(text))
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(out)


def plausible(kind: int, text: str) -> bool:
    """Whether an added span keeps its kind's form."""
    digits = _digits(text)
    if kind == 0 and "@" not in text:
        return bool(SPELLED.search(text))
    if kind == 0:
        before, _, after = text.partition("@")
        return bool(re.search("[A-Za-z0-9]", before)) and bool(re.search(r"[A-Za-z0-9]\W*(\.|\bdot\b)\W*[A-Za-z]", after))
    if kind == 1:
        numbers = re.findall("[0-9]+", text)
        return len(numbers) == 4 and all(map(_small, numbers)) and not re.search("[A-Za-z]", text.replace("dot", ""))
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits) and not re.search("[A-Za-z]", text)
    return 10 <= len(digits) <= 15 and bool(re.search("[0-9][^0-9]+[0-9]", text)) and not re.search("[A-Za-z@]", text)


def windows(n: int) -> list[int]:
    """Starts of the overlapping windows over ``n`` characters."""
    return list(range(0, max(1, n - WINDOW + STRIDE), STRIDE)) if n else []


def window_classes(code: np.ndarray, start: int) -> np.ndarray:
    out = np.full(WINDOW, PAD, np.int16)
    part = code[start:start + WINDOW]
    out[:len(part)] = part
    return out


Cut = tuple[int, int, int, bool, bool]  # a span, and whether the window's edge cuts its start and its end


def spans_of(tags: np.ndarray, start: int, length: int) -> tuple[list[Span], list[Cut]]:
    """Whole spans of a window's tags, and those that an inner edge of the window cuts."""
    out, cut, at, n = [], [], 0, min(WINDOW, length - start)
    tags = tags.tolist()
    while at < n:
        if not tags[at]:
            at += 1
            continue
        kind, end = (tags[at] - 1) // 2, at + 1
        while end < n and tags[end] == 2 + 2 * kind:
            end += 1
        begun, goes_on = at == 0 and start > 0, end == WINDOW and start + end < length
        if begun or goes_on:
            cut.append((start + at, kind, start + end, begun, goes_on))
        else:
            out.append((start + at, kind, start + end))
        at = end
    return out, cut


def joined(cut: list[Cut]) -> list[Span]:
    """Spans put together from the parts that adjoining windows see: each goes on where the next, of the same kind and
    touching it, has begun.  Parts whose start or end no window sees are left out."""
    out = []
    for kind in range(len(KINDS)):
        at = None
        for s, _, e, begun, goes_on in sorted(c for c in cut if c[1] == kind):
            if at and at[2] and begun and s <= at[1]:
                if e >= at[1]:
                    at = (at[0], e, goes_on)
            elif not begun:
                at = (s, e, goes_on)
            else:
                at = None
            if at and not at[2]:
                out.append((at[0], kind, at[1]))
                at = None
    return out


def begun_at(kind: int, text: str) -> int:
    """Where a span truly begins: of the words before an e-mail address's at, only the last and those tied to it by a "dot" belong to it."""
    at = AT_MARK.search(text) if kind == 0 else None
    words = list(re.finditer(r"\S+", text[:at.start()])) if at else []
    k = len(words) - 1
    while k >= 2 and words[k - 1].group() == "dot":
        k -= 2
    return words[k].start() if words else 0


def reconcile(text: str, base: list[Span], found: list[Span]) -> list[Span]:
    """Base spans and the windows' spans, without blank ends, over the whole text, none of the added
    overlapping another."""
    votes = Counter()
    for s, k, e in found:
        part = text[s:e].rstrip()
        s, e = s + begun_at(k, part), s + len(part)
        if s and text[s - 1] == "(" and text.find(")", s, e) >= 0 and not 0 <= text.find("(", s, e) < text.find(")", s, e):
            s -= 1  # a bracket that is closed inside
        part = text[s:e]
        votes[s + len(part) - len(part.lstrip()), k, e] += 1
    taken = sorted((s, e) for s, _, e in base)
    out = list(base)
    for s, k, e in sorted(votes, key=lambda x: (-votes[x], x[0] - x[2], x)):
        if plausible(k, text[s:e]) and all(e <= a or s >= b for a, b in taken):
            taken.append((s, e))
            out.append((s, k, e))
    return sorted(out)


def tag_texts(tagger: Tagger, texts: list[str]) -> Iterator[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text; the windows of many texts are decoded together."""
    plans, rows = [], []
    for text in texts:
        own = []
        spelled = [m.start() for m in SPELLED_MARK.finditer(text)]
        if spelled or MARK.search(text):
            code = classes(text)
            marked = ((code >= 50) & (code <= 59)) | (code == 66)  # digits and @
            marked[spelled] = True
            marked = np.flatnonzero(marked)
            starts = np.array(windows(len(text)))
            inside = np.searchsorted(marked, starts + WINDOW) > np.searchsorted(marked, starts)
            own = starts[inside].tolist()
            rows.extend(window_classes(code, s) for s in own)
        plans.append(own)
    tags = [t for at in range(0, len(rows), 512) for t in tagger.decode(np.stack(rows[at:at + 512]))]
    at = 0
    for text, own in zip(texts, plans, strict=True):
        base = base_spans(text)
        found, cut = [], []
        for k, s in enumerate(own):
            whole, parts = spans_of(tags[at + k], s, len(text))
            found += whole
            cut += parts
        at += len(own)
        yield base, reconcile(text, base, found + joined(cut))


#: Ways of writing each kind that the base patterns leave out, and look-alikes that are none: (kind or None, form).
#: w is a made-up word, W one with a capital, u a user's name, t a top-level domain, d3 three digits, h24 24 hex digits, n a
#: number to 255, c four digits of a card number that passes Luhn, A and D an at and a dot as ``AT`` and ``DOT`` write them.
WRITTEN = [
    (0, "{u}@{w}.{t}"), (0, "{u} @ {w}.{t}"), (0, "{u}@{w}{D}{t}"), (0, "{u} @ {w} . {t}"), (0, "{u}@ {w}.{t}"), (0, "{u}{A}{w}.{t}"),
    (0, "{u}{A}{w}{D}{t}"), (0, "{u} at {w} dot {t}"), (0, "{w} dot {w} at {w} dot {t}"), (0, "{W}.{W}{A}{w}.{w}.{t}"), (0, "{w}{d2} at {w} dot {t}"),
    (1, "{n}.{n}.{n}.{n}"), (1, "{n}[.]{n}[.]{n}[.]{n}"), (1, "{n} . {n} . {n} . {n}"), (1, "{n}(.){n}(.){n}(.){n}"), (1, "{n}[dot]{n}[dot]{n}[dot]{n}"),
    (1, "{n} dot {n} dot {n} dot {n}"), (1, "{n} [.] {n} [.] {n} [.] {n}"), (1, "{n}.{n}.{n}[.]{n}"),
    (2, "{c}{c}{c}{c}"), (2, "{c} {c} {c} {c}"), (2, "{c}-{c}-{c}-{c}"), (2, "{c}.{c}.{c}.{c}"), (2, "{c}/{c}/{c}/{c}"), (2, "{c}  {c}  {c}  {c}"),
    (2, "{c} - {c} - {c} - {c}"), (2, "{c}_{c}_{c}_{c}"),
    (3, "+{d1} ({d3}) {d3}-{d4}"), (3, "({d3}) {d3}-{d4}"), (3, "{d3}-{d3}-{d4}"), (3, "{d3}.{d3}.{d4}"), (3, "{d1} ({d3}) {d3} {d4}"),
    (3, "{d3} {d3} {d4}"), (3, "00{d2} {d2} {d7}"), (3, "00{d2} {d3} {d6}"), (3, "1-{d3}-{d3}-{d4}"), (3, "({d3}) {d3} {d4}"), (3, "0{d3} {d3} {d4}"),
    (3, "0{d3}/{d7}"), (3, "{d3} - {d3} - {d4}"),
    (None, "{d4}-{d2}-{d2}"), (None, "{d2}.{d2}"), (None, "{d1},{d3},{d3}"), (None, "{h24}"), (None, "{w}={h12}"), (None, "{d4}"), (None, "{d1}.{d1}.{d1}"),
    (None, "{d3} {w} {d3}"), (None, "#{d6}"), (None, "{w}@"), (None, "{d2}:{d2}:{d2}"), (None, "AKIA{h16}"), (None, "{w} at {w} {d2}"),
    (None, "{w} dot {w} {d1}"), (None, "{d9}"), (None, "{d4} - {d4}"), (None, "{w}{d3}"), (None, "{d2}/{d2}/{d4}"), (None, "{w} at {w} {w}"),
    (None, "{d1}, {d1}, {d1}"), (None, "{n}, {n}, {n}, {n}"), (None, "{w} at {w}. {W}"), (None, "{w} dot {w} {w}"), (None, "{d3}, {d4}, {d5}"), (None, "${d2}.{d2}"), (None, "v{d1}.{d2}.{d1}"), (None, "{w}_{d2}"), (None, "{d16}"),
]
#: Fixed values of the written samples.
AT = ("(at)", "[at]", " (at) ", " [at] ", "[@]", "(@)")
DOT = ("[.]", "(.)", "[dot]", "(dot)", " [dot] ", " (dot) ")
BEFORE, AFTER = (" ", " ", " ", "\n", ": ", ":", " (", " <", ' "', ", ", "="), (" ", " ", ". ", ", ", "\n", ") ", "> ", '" ', "; ", "")
TLD = ("com", "org", "net", "de", "io", "edu", "example", "co.uk", "fr", "info")


def draw_word(rng: np.random.Generator) -> str:
    """A made-up word: two thirds of syllables, else of any letters."""
    if rng.random() < 0.67:
        return "".join("bcdfghjklmnprstvw"[int(rng.integers(17))] + "aeiou"[int(rng.integers(5))] for _ in range(int(rng.integers(1, 5)))) \
            + "rnstlm "[int(rng.integers(7))].strip()
    return "".join("abcdefghijklmnopqrstuvwxyz"[int(i)] for i in rng.integers(26, size=int(rng.integers(2, 10))))


def _write(form: str, rng: np.random.Generator) -> str:
    """One sample of a form."""
    letters = lambda of, n: "".join(of[int(i)] for i in rng.integers(len(of), size=n))
    one = lambda of: of[int(rng.integers(len(of)))]
    card = letters("0123456789", 15)
    card += next(c for c in "0123456789" if luhn(card + c))
    groups = iter(card[i:i + 4] for i in range(0, 16, 4))

    def part(m: re.Match) -> str:
        what, n = m[1][0], int(m[1][1:] or 0)
        if what == "u":
            return one((draw_word(rng), f"{draw_word(rng)}{one('._-')}{draw_word(rng)}", f"{draw_word(rng)}{letters('0123456789', 2)}",
                        f"{draw_word(rng)}.{letters('0123456789', 2)}"))
        return {"w": lambda: draw_word(rng), "W": lambda: draw_word(rng).capitalize(), "t": lambda: one(TLD), "n": lambda: str(rng.integers(256)),
                "c": lambda: next(groups), "A": lambda: one(AT), "D": lambda: one(DOT),
                "d": lambda: letters("0123456789", n), "h": lambda: letters("0123456789abcdef", n)}[what]()

    if form.startswith("AKIA"):
        return "AKIA" + letters("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16)
    return re.sub(r"\{([a-zA-Z]\d*)\}", part, form)


def _gold(spans: list[Span], start: int) -> np.ndarray:
    out = np.zeros(WINDOW, np.int64)
    for s, k, e in spans:
        for i in range(max(s, start), min(e, start + WINDOW)):
            out[i - start] = 1 + 2 * k if i == s else 2 + 2 * k
    return out


def training_windows(samples: list[str], seed: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows: the samples with their base spans, and samples with written data put in."""
    rng = np.random.default_rng(seed)
    rows, gold = [], []
    for text in samples:
        rows.append(window_classes(classes(text), 0))
        gold.append(_gold(base_spans(text), 0))
    plain = samples or ["and of the in to that is was"]
    for k in range(WRITTEN_WINDOWS):
        kind, form = WRITTEN[k % len(WRITTEN)]
        item = _write(form, rng)
        around = _around(plain, rng)
        cut = int(rng.integers(len(around) + 1))
        before, after = " ".join(around[:cut]), " ".join(around[cut:])
        before = before[-int(rng.integers(1, WINDOW - 20)):] + BEFORE[int(rng.integers(len(BEFORE)))] if before else ""
        text = (before + item + AFTER[int(rng.integers(len(AFTER)))] + after)[:WINDOW]
        rows.append(window_classes(classes(text), 0))
        gold.append(_gold([] if kind is None else [(len(before), kind, min(len(text), len(before) + len(item)))], 0))
    return np.stack(rows), np.stack(gold)


def _around(plain: list[str], rng: np.random.Generator) -> list[str]:
    """Words around a written sample: mostly of a document's window, else made-up ones or single letters."""
    way = rng.random()
    if way < 0.15:
        return list("abcdefghijklmnopqrstuvwxyz"[int(i)] for i in rng.integers(26, size=40))
    if way < 0.35:
        return [draw_word(rng) for _ in range(16)]
    return re.sub("[0-9@]+", "", plain[int(rng.integers(len(plain)))]).split() or ["the"]


def train(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Tagger:
    """A tagger from at most ``SAMPLE_WINDOWS`` windows of the documents and the written ones."""
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    total = rows.count()
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, total))
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("pii")), F.lit(1 << 30)) <= int(share * (1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column("text"):
                text = x.as_py()
                for m in MARK.finditer(text):
                    start = max(0, m.start() - WINDOW // 2)
                    out.append(text[start:start + WINDOW])
                    break
                out.append(text[:WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["sample"])

    found = drawn.mapInArrow(run, "sample string").distinct()
    order = [F.desc(F.col("sample").rlike("[0-9@]")), F.xxhash64("sample")]
    samples = [r["sample"] for r in found.orderBy(*order).limit(SAMPLE_WINDOWS).collect()]
    tagger = Tagger.new()
    tagger.train(*training_windows(samples), STEPS, BATCH, RATE)
    return tagger


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(spark: SparkSession, docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` for every row: numbers and digest
    of the base spans, and all spans as ``kind:start:end`` in code points, comma-joined."""
    sent = spark.sparkContext.broadcast(tagger.light())
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Tagger(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                got = list(tag_texts(model, b.column("text").to_pylist()))
                counts = [[sum(x[1] == k for x in base) for base, _ in got] for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                     pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in got], pa.string()),
                     pa.array([_joined(spans) for _, spans in got], pa.string())],
                    ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {FOUND}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind's name; overlapping spans are one, named by the first."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(spark: SparkSession, docs: DataFrame, tagger: Tagger, text_col: str = "text",
           chars_col: str = "n_chars") -> DataFrame:
    """``docs``, all columns, with all spans masked and ``chars_col``, if there, counted anew where the text changed."""
    sent = spark.sparkContext.broadcast(tagger.light())
    names, schema = docs.columns, docs.schema
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Tagger(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                texts = b.column(place).to_pylist()
                spans = [x for _, x in tag_texts(model, [t or "" for t in texts])]
                new = [masked(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
                cols = list(b.columns)
                cols[place] = pa.array(new, cols[place].type)
                if chars_col in names:
                    k = names.index(chars_col)
                    cols[k] = pa.array([len(t) if s else n for t, s, n in zip(new, spans, cols[k].to_pylist(), strict=True)],
                                       cols[k].type)
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(run, schema)

"""Quality by ordinal cumulative-link regression on graded ratings.

A text's score is the sum of the hashed weights of its features: its distinct words, their first letters, and
buckets of a few statistics (repetition, symbols, capitals, digits, word length).  The weights are shared by all
grades; ordered thresholds cut the score, ``P(grade <= k) = logistic(threshold_k - score)``.
From these come the expected grade and the tail probability of at least the accepted grade,
which decides selection.

The model is fitted on a bounded sample of rated rows (``SAMPLE``, by a hash of the id, ties and ids that repeat by
id and grade), of which those of one grade with all features equal count once; their features are computed on the executors; features without a clear effect there (score test) have weight
zero.  No weight is above zero: a feature can only lower the grade, so that a
long text does not outweigh what is wrong with it.  Every text is scored whole.

Defined cases: null text is empty; null ids stay null; a null rating is no rating, a null toxic mark is
not toxic; rows that repeat are scored each; without any rated row, or with one grade only, every row
has the top grade; an empty table gives no rows; other columns are kept by ``select_documents``.
"""

from __future__ import annotations

import itertools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import text_of

BITS = 20
SAMPLE, GRADES = 10_000, 3
STEPS, RATE, L2 = 300, 0.1, 0.05
#: A feature is used if it is in so many sampled rows and, at weight zero, the loss falls with its weight
#: by so many standard deviations.
LEAST, TELLING = 3, 6.0
MEMO_WORDS = 300_000
SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()?")
CAPITALS, DIGITS = bytes(range(65, 91)), bytes(range(48, 58))


class Features:
    """Hashed features of a text, as distinct places in a table of ``2 ** BITS`` weights."""

    def __init__(self):
        self.memo: dict[str, tuple[int, int]] = {}

    def _place(self, name: str) -> int:
        import xxhash

        return xxhash.xxh32_intdigest(name.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        distinct = set(words)
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        try:
            pairs = list(map(memo.__getitem__, distinct))
        except KeyError:
            for w in distinct:
                if w not in memo:
                    bare = w.lower().strip(".,;:!?\"'()")
                    memo[w] = (self._place("w " + bare), self._place("p " + bare[:4]))
            pairs = list(map(memo.__getitem__, distinct))
        places = itertools.chain.from_iterable(pairs)
        raw = text.encode("utf-8", "surrogatepass")
        size, n = max(1, len(raw)), max(1, len(words))
        share = lambda part, whole: round(10 * min(1.0, part / whole))
        stats = (
            f"s length {min(20, len(words)).bit_length()}",
            f"s repeated {share(n - len(distinct), n)} {min(14, n.bit_length())}",
            f"s again {share(sum(map(operator.eq, words, words[1:])), n)} {min(14, n.bit_length())}",
            f"s symbols {share(8 * (size - len(raw.translate(None, SYMBOLS))), size)}",
            f"s capitals {share(2 * (size - len(raw.translate(None, CAPITALS))), size)}",
            f"s digits {share(2 * (size - len(raw.translate(None, DIGITS))), size)}",
            f"s word {share(size / n, 30)}",
        )
        return np.unique(np.array([*places, *map(self._place, stats)], np.int64))


class OrdinalModel:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    @staticmethod
    def fit(rows: list[np.ndarray], grades: np.ndarray) -> OrdinalModel | None:
        """From the features and the grade (0 .. GRADES - 1) of each row; None without two grades."""
        if len(np.unique(grades)) < 2:
            return None
        alike = {(int(g), r.tobytes()): i for i, (r, g) in enumerate(zip(rows, grades, strict=True))}
        own = sorted(alike.values())  # of rows of one grade with all features equal one is enough
        rows, grades = [rows[i] for i in own], grades[own]
        seen = np.bincount(grades, minlength=GRADES)
        share = np.cumsum(seen + 0.5) / (len(grades) + 0.5 * GRADES)
        cut = np.log(share[:-1] / (1 - share[:-1]))
        flat = np.concatenate(rows).astype(np.int32)
        row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
        slope, _ = _gradient(np.zeros(len(rows)), grades, cut)
        slope -= slope.mean()
        size = 1 << BITS
        pull, count = np.bincount(flat, weights=slope[row], minlength=size), np.bincount(flat, minlength=size)
        telling = np.flatnonzero((count >= LEAST) & (pull > TELLING * slope.std() * np.sqrt(count)))
        place = np.full(size, -1)
        place[telling] = np.arange(len(telling))
        keep = place[flat] >= 0
        flat, row = place[flat][keep], row[keep]
        w = np.zeros(len(telling) + len(cut))  # weights, then thresholds
        w[len(telling):] = cut
        first, second = np.zeros(len(w)), np.zeros(len(w))
        for step in range(1, STEPS + 1):
            score = np.bincount(row, weights=w[flat], minlength=len(rows)) if len(flat) else np.zeros(len(rows))
            to_score, to_cut = _gradient(score, grades, w[len(telling):])
            g = np.concatenate([np.bincount(flat, weights=to_score[row], minlength=len(telling)) + L2 * w[:len(telling)], to_cut])
            first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
            w -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
            w[:len(telling)] = np.minimum(0, w[:len(telling)])
            w[len(telling):] = ordered(w[len(telling):])
        weights = np.zeros(size, np.float32)
        weights[telling] = w[:len(telling)]
        return OrdinalModel(weights, w[len(telling):])

    def judge(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade, and the probability of the top grade."""
        tails = 1 - _logistic(self.thresholds[None] - score[:, None])
        return tails.sum(1), tails[:, -1]


def ordered(x: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing values: neighbours out of order are averaged."""
    groups: list[list[float]] = []
    for v in x.tolist():
        groups.append([v])
        while len(groups) > 1 and np.mean(groups[-2]) > np.mean(groups[-1]):
            last = groups.pop()
            groups[-1] += last
    return np.array([np.mean(g) for g in groups for _ in g])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _gradient(score: np.ndarray, grade: np.ndarray, cut: np.ndarray):
    """The loss's gradients by score and by threshold."""
    edge = np.concatenate([[-np.inf], cut, [np.inf]])
    with np.errstate(invalid="ignore"):
        high, low = _logistic(edge[grade + 1] - score), _logistic(edge[grade] - score)
    p = np.maximum(high - low, 1e-9)
    dh, dl = high * (1 - high), low * (1 - low)
    by_cut = np.zeros(len(cut) + 2)
    np.add.at(by_cut, grade + 1, -dh / p)
    np.add.at(by_cut, grade, dl / p)
    return (dh - dl) / p, by_cut[1:-1]


def fit(spark: SparkSession, docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text", grade_col: str = "grade") -> OrdinalModel | None:
    """A model from at most ``sample`` rows of ``ratings`` (id, grade from 0 to GRADES - 1)."""
    rated = ratings.select(ratings[id_col].alias("doc_id"), ratings[grade_col].cast("int").alias("grade")).where(
        "doc_id IS NOT NULL AND grade IS NOT NULL")
    total = rated.count()
    if not total:
        return None
    share = min(1.0, 0.95 * sample / total)
    place = F.pmod(F.xxhash64("doc_id", F.lit("rated")), F.lit(1 << 30))
    drawn = rated.where(place <= int(share * (1 << 30))).orderBy(place, "doc_id", "grade").limit(sample)
    texts = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text")).join(
        F.broadcast(drawn), "doc_id").select("doc_id", "text", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for b in batches:
            found = [features.of(x.as_py()).astype(np.int32) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("grade"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "grade", "places"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    got = texts.mapInArrow(run, f"doc_id {kind}, grade int, places array<int>").orderBy(
        F.xxhash64("doc_id", F.lit("rated")), "doc_id", "grade", "places").limit(2 * sample).toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("grade", "ascending")])
    if not got.num_rows:
        return None
    places = [x.values.to_numpy() for x in got.column("places")]
    return OrdinalModel.fit(places, got.column("grade").to_numpy())


def _scorer(model: OrdinalModel | None):
    """A function from a column of texts to expected grades and top-grade probabilities."""
    features = Features()

    def score(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if model is None:
            return np.full(len(column), GRADES - 1.0), np.ones(len(column))
        total = np.array([model.weights[features.of(x.as_py() or "")].sum(dtype=np.float64) for x in column], np.float64)
        return model.judge(total)

    return score


def score_documents(spark: SparkSession, docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, expected_grade, p_top)`` for every row."""
    sent = spark.sparkContext.broadcast(model and (model.weights, model.thresholds))
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(sent.value and OrdinalModel(*sent.value))
        for b in batches:
            expected, top = score(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(expected), pa.array(top)], ["doc_id", "expected_grade", "p_top"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, expected_grade double, p_top double")


def select_documents(spark: SparkSession, docs: DataFrame, model: OrdinalModel | None, cut: float,
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose top-grade probability is at least ``cut``."""
    sent = spark.sparkContext.broadcast(model and (model.weights, model.thresholds))
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(sent.value and OrdinalModel(*sent.value))
        for b in batches:
            yield b.filter(pa.array(score(b.column(place))[1] >= cut))

    return docs.mapInArrow(run, docs.schema)


def ratings_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from the labels table: 0 for toxic text, 1 for low quality, 2 for neither."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))

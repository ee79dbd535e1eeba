"""Whitening of embeddings by an incremental eigendecomposition.

A component ``c`` counts as the long ``x = floor(256 * c)``; the fit list holds each distinct ``x`` vector once.  Every partition of it keeps a
spectrum of its centred scatter by rank-one updates (``spectrum.py``); spectra are combined ``FAN`` at a time, again by
rank-one updates, until one is left.  Its leading ``components + SPARE`` eigenvectors are refined by distributed Rayleigh-Ritz passes: a pass
sums ``V Q`` over the fit list, from exact integer deviations ``n * x - S``, solves the small problem in the span of ``Q``, and adds
the residuals to the basis of the next pass, until they are rounding errors (at most ``PASSES`` passes).  What
reaches the driver is one row of the leading eigenvectors, and sums of their size.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are left out, and so are those
of another length than most have (ties: the larger), which no common components exist for; zero vectors take part; null ids stay null;
rows that repeat each get their rows; entries beyond the range of a long count as its ends; a deviation beyond a long is null; a component without variance
(within rounding of the whole) has whitened null, explained 0 and no part in identity_error; equal eigenvalues leave their components free within their space;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import stage_table
from ferrule.llm.spectrum import EPS, Spectrum

SCALE, COMPONENTS, SPARE, FAN, PASSES = 256.0, 4, 8, 16, 8
SMALL = 1 << 62
SPECTRUM = "part long, n long, total array<decimal(38,0)>, mean array<double>, w array<double>, u array<double>"


def usable(c: Column) -> Column:
    inf = float("inf")
    return c.isNotNull() & (F.size(c) > 0) & ~F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == inf))


def scaled(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """``(vec_id, x)`` of the rows that take part, and the length of ``x`` (0: no row)."""
    v = vectors[vec_col]
    rows = vectors.where(usable(v)).select(
        vectors[id_col].alias("vec_id"), F.transform(v, lambda c: F.floor(F.lit(SCALE) * c.cast("double"))).alias("x"))
    most = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    length = most[0]["length"] if most else 0
    return rows.where(F.size("x") == length), length


def matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, length)


def apart(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """``n * x - total``, exact: as int64 where that holds it, else as Python integers."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if n * most + max(map(abs, total), default=0) < SMALL:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def exact_squares(e: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows of integers; None beyond a long."""
    most = max(int(e.max(initial=0)), -int(e.min(initial=0)))
    if most * most * e.shape[1] < SMALL:
        return (e * e).sum(1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in e]
    return [s if s < 1 << 63 else None for s in sums]


def _row(part: int, total: list[int], s: Spectrum) -> dict:
    return {"part": part, "n": s.n, "total": [Decimal(v) for v in total], "mean": s.mean.tolist(), "w": s.w.tolist(), "u": s.u.ravel().tolist()}


def spectra(fit: DataFrame, length: int) -> DataFrame:
    """A row a partition of ``fit``: the exact sums and the spectrum of its vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = Spectrum.empty(length), [0] * length
        for b in batches:
            x = matrix(b.column("x"), length)
            total = [t + int(s) for t, s in zip(total, apart(x, 1, [0] * length).astype(object).sum(0) if len(x) else total, strict=True)]
            for row in x.astype(np.float64):
                own.add(row)
        if own.n:
            yield pa.RecordBatch.from_pylist([_row(TaskContext.get().partitionId(), total, own)], pa.schema([
                ("part", pa.int64()), ("n", pa.int64()), ("total", pa.list_(pa.decimal128(38, 0))),
                *((c, pa.list_(pa.float64())) for c in ("mean", "w", "u"))]))

    return fit.mapInArrow(run, SPECTRUM)


def combined(spark: SparkSession, found: DataFrame, length: int) -> DataFrame:
    """One row: the spectra of all partitions combined, ``FAN`` at a time."""
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        own, total = Spectrum.empty(length), [0] * length
        for _, r in rows.sort_values("part").iterrows():
            own.merge(Spectrum(int(r["n"]), np.array(r["mean"]), np.array(r["w"]), np.array(r["u"]).reshape(length, length)))
            total = [t + int(s) for t, s in zip(total, r["total"], strict=True)]
        return pd.DataFrame([_row(int(rows["part"].min()) // FAN, total, own)])

    parts = found.agg(F.max("part")).first()[0] + 1
    while parts > 1:
        found = stage_table(spark, found.groupBy((F.col("part") / FAN).cast("long")).applyInPandas(merge, SPECTRUM), "spectra")
        parts = -(-parts // FAN)
    return found


def _sums(found: DataFrame) -> np.ndarray:
    """The sum of the arrays ``s`` of all rows (one a partition), added up on the executors."""
    rows = found.select(F.posexplode("s")).groupBy("pos").agg(F.sum("col").alias("v")).orderBy("pos").collect()
    return np.array([r["v"] for r in rows])


def _over(fit: DataFrame, length: int, n: int, total: list[int], part) -> np.ndarray:
    """The sum of ``part(block of centred rows)`` over the fit list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for b in batches:
            if b.num_rows:
                got = part(apart(matrix(b.column("x"), length), n, total).astype(np.float64) / n)
                out = got if out is None else out + got
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], ["s"])

    return _sums(fit.mapInArrow(run, "s array<double>"))


class Whitening:
    """Fitted: number and sums of the fit list, eigenvalues and eigenvectors (columns), trace, and the identity error."""

    def __init__(self, n: int, total: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.total, self.values, self.vectors, self.trace = n, total, values, vectors, trace
        self.alive = values > length_tolerance(len(total)) * max(trace, 0.0)
        self.identity_error = 0.0

    def map(self) -> np.ndarray:
        """Projection and scale of centred rows; zero columns for components without variance."""
        return self.vectors * np.where(self.alive, 1 / np.sqrt(np.where(self.alive, self.values, 1.0)), 0.0)


def length_tolerance(length: int) -> float:
    return 8 * EPS * length


def refine(fit: DataFrame, length: int, n: int, total: list[int], basis: np.ndarray, components: int) -> Whitening:
    """Rayleigh-Ritz passes from an orthonormal basis (columns)."""
    best, worst = None, np.inf
    for _ in range(PASSES):
        width = basis.shape[1]
        got = _over(fit, length, n, total, lambda c, q=basis: np.append((c.T @ (c @ q)).ravel(), (c * c).sum())) / n
        image, trace = got[:-1].reshape(length, width), got[-1]
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz = basis @ turn
        left = image @ turn - ritz * values
        error = np.sqrt((left[:, :components] ** 2).sum(0)).max()
        if error < worst:
            best, worst = Whitening(n, total, np.maximum(values[:components], 0), signed(ritz[:, :components]), float(trace)), error
        elif width < length:  # no better than before: rounding is reached
            break
        if width == length or error <= 2 * EPS * length ** 0.5 * max(values[0], 0):
            break
        kept = min(width, components + SPARE)
        basis = orthonormal(np.concatenate([ritz[:, :kept], left[:, :kept]], 1)[:, :length], kept)
    return best


def orthonormal(columns: np.ndarray, kept: int) -> np.ndarray:
    """An orthonormal basis of the first ``kept`` columns and of what the others add to them."""
    q = np.linalg.qr(columns[:, :kept])[0]
    for c in columns[:, kept:].T:
        size = np.sqrt(c @ c)
        for _ in range(2):
            c = c - q @ (q.T @ c)
        rest = np.sqrt(c @ c)
        if rest > 1e-8 * size > 0 and q.shape[1] < len(c):
            q = np.concatenate([q, (c / rest)[:, None]], 1)
            q[:, -1] -= q[:, :-1] @ (q[:, :-1].T @ q[:, -1])
            q[:, -1] /= np.sqrt(q[:, -1] @ q[:, -1])
    return q


def signed(vectors: np.ndarray) -> np.ndarray:
    """Columns turned so that their largest entry is positive."""
    top = np.abs(vectors).argmax(0)
    return vectors * np.where(vectors[top, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


def fit_whitening(spark: SparkSession, rows: DataFrame, length: int, components: int = COMPONENTS) -> Whitening:
    """From ``(vec_id, x)`` rows of one length."""
    fit = stage_table(spark, rows.select("x").distinct(), "whitening-fit")
    found = stage_table(spark, spectra(fit, length), "spectra")
    width = min(length, components + SPARE)
    leading = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda k: F.slice("u", k * length + (length - width) + 1, F.lit(width)))
    row = combined(spark, found, length).select("n", "total", F.flatten(leading).alias("u")).first()
    n, total = row["n"], [int(v) for v in row["total"]]
    basis = orthonormal(np.array(row["u"]).reshape(length, width), width)
    out = refine(fit, length, n, total, basis, min(components, length))
    onto = out.map()
    covariance = _over(fit, length, n, total, lambda c: ((c @ onto).T @ (c @ onto)).ravel()) / n
    own = covariance.reshape(onto.shape[1], -1)[np.ix_(out.alive, out.alive)]
    out.identity_error = float(np.abs(own - np.eye(len(own))).max(initial=0.0))
    return out


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for every row that takes part and each of the
    leading components."""
    rows, length = scaled(vectors, id_col, vec_col)
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not length:
        return spark.createDataFrame([], f"vec_id {kind}, {OUT}")
    model = fit_whitening(spark, rows, length, components)
    n, total, onto, alive, error = model.n, model.total, model.map(), model.alive, model.identity_error
    explained = model.values / model.trace if model.trace > 0 else model.values * 0
    explained = np.where(alive, explained, 0.0)
    count = len(explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = apart(matrix(b.column("x"), length), n, total)
            white = (e.astype(np.float64) / n) @ onto
            m = b.num_rows
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(pa.array(np.repeat(np.arange(m), count))), pa.array(np.tile(np.arange(1, count + 1), m), pa.int32()),
                pa.array(np.full(m * count, n), pa.int64()), pa.array([d for d in exact_squares(e) for _ in range(count)], pa.int64()),
                pa.array(white.ravel(), pa.float64(), mask=np.tile(~alive, m)), pa.array(np.tile(explained, m), pa.float64()),
                pa.array(np.full(m * count, error), pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"vec_id {kind}, {OUT}")

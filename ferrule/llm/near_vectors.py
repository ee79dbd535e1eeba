"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut into halves with a codebook each; a cell of the product grid is a pair
of codewords.  A vector is stored in the cell of its nearest codewords.  As a query it
visits cells in the order of their summed half distances (multi-sequence traversal) until
the target recall: the traversal stops at the excess over the nearest cell's sum that, on
sampled vectors moved to exactly the similarity limit, reached the moved vector's cell in
``target`` of the cases.  What a visited cell holds is verified by the cosine in double precision.

The codebooks are fitted on a bounded sample (``SAMPLE`` vectors); every vector is stored and
queried.  Rows travel by (label, first codeword), once for each first codeword they
visit, with the second codewords to visit there.  Equal vectors of a label are combined first and count
with their number.  A (label, first codeword) with more than ``HOT_HOMES`` stored
vectors is split into its product cells, each a key of its own to which only the queries go that visit it; a
product cell with more stored vectors than that is split further: stored rows are dealt over salts, queries go to
each salt.  A task holds the stored vectors of one key and salt, about ``HOT_HOMES``, and the queries
stream past them in blocks.  From a task come link counts and a forest over the linked rows, never all pairs.
A link counts for both ends whichever end's traversal finds it: the query that finds a stored vector also works out if that
vector's own traversal visits the query's cell, and counts for it where it does not.

Defined cases: a null label, a vector that is null, zero or holds null or non-finite
components or whose length is not the table's common one, and a null id take no part
(no links; component is the own id; a null id is not kept); rows that repeat an id are rows of their
own; one row comes out for each row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm import vectors
from ferrule.llm.common import shuffle_partitions, stage_table
from ferrule.llm.components import connected
from ferrule.llm.forest import merge

SAMPLE, CODEWORDS, ROUNDS = 20_000, 64, 12
HOT_HOMES, HOT_LIST, PAIRS, BLOCK = 20_000, 50_000, 1 << 20, 1024


def fit_codebook(x: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Codewords by Lloyd's iterations from distinct random rows."""
    rng = np.random.default_rng(seed)
    words = x[rng.choice(len(x), size, replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = half_distances(x, words).argmin(axis=1)
        total, count = np.zeros_like(words), np.bincount(nearest, minlength=size)
        np.add.at(total, nearest, x)
        words[count > 0] = total[count > 0] / count[count > 0, None]
    return words


def half_distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances of rows to codewords."""
    return np.maximum(0.0, (x * x).sum(1)[:, None] - 2.0 * x @ words.T + (words * words).sum(1)[None])


class MultiIndex:
    """Two codebooks and the excess at which a traversal stops."""

    def __init__(self, sample: np.ndarray, similarity: float, target: float, seed: int = 11):
        half = sample.shape[1] // 2
        self.cut = half
        size = max(1, min(CODEWORDS, len(sample) // 8))
        self.words = [fit_codebook(sample[:, :half], size, seed), fit_codebook(sample[:, half:], size, seed + 1)]
        rng = np.random.default_rng(seed + 2)
        excess = []
        for _ in range(max(1, 40_000 // len(sample))):
            step = rng.normal(size=sample.shape)
            step -= (step * sample).sum(1, keepdims=True) * sample
            length = np.sqrt((step * step).sum(1, keepdims=True))
            step = np.divide(step, length, out=np.zeros_like(step), where=length > 0)
            moved = similarity * sample + np.sqrt(1 - similarity ** 2) * step
            here, there = self.distances(sample), self.distances(moved)
            rows = np.arange(len(sample))
            excess.append(sum(h[rows, t.argmin(1)] - h.min(1) for h, t in zip(here, there, strict=True)))
        self.excess = float(np.quantile(np.concatenate(excess), target))

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        return [half_distances(x[:, :self.cut], self.words[0]), half_distances(x[:, self.cut:], self.words[1])]

    def reach(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distances to both codebooks and the sum up to which each row's traversal goes."""
        one, two = self.distances(x)
        return one, two, one.min(1) + two.min(1) + self.excess

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one, two = self.distances(x)
        return one.argmin(1), two.argmin(1)

    def traverse(self, one: np.ndarray, two: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cells of one vector, nearest sum first, up to the excess over the first."""
        a, b = one.argsort(), two.argsort()
        one, two = one[a].tolist(), two[b].tolist()
        a, b = a.tolist(), b.tolist()
        limit = one[0] + two[0] + self.excess
        heap, pushed = [(one[0] + two[0], 0, 0)], {(0, 0)}
        while heap:
            total, i, j = heappop(heap)
            if total > limit:
                return
            yield a[i], b[j]
            for p, q in ((i + 1, j), (i, j + 1)):
                if p < len(a) and q < len(b) and (p, q) not in pushed:
                    pushed.add((p, q))
                    heappush(heap, (one[p] + two[q], p, q))


def _homes(index: MultiIndex, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                i, j = index.home(vectors.unit(vectors.block(b.column("vec"), length)))
                yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))],
                                                 ["label", "cell", "second"])
    return run


def _visits(index: MultiIndex, length: int, hot: dict):
    """A row for each (vector, first codeword visited), or in a hot one (vector, product cell visited, salt): the
    second codewords to visit, and the own one if the vector is stored there (else -1).  ``split`` is the second
    codeword of a product cell that is a key of its own (else -1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                one, two = index.distances(vectors.unit(vectors.block(b.column("vec"), length)))
                i0, j0 = one.argmin(1).tolist(), two.argmin(1).tolist()
                labels, reps = b.column("label").to_pylist(), b.column("rep").to_pylist()
                rows, cells, splits, salts, seconds, own = [], [], [], [], [], []
                for r in range(b.num_rows):
                    by_first = defaultdict(bytearray)
                    for i, j in index.traverse(one[r], two[r]):
                        by_first[i].append(j)
                    for i, js in by_first.items():
                        cell = hot.get((labels[r], i))
                        for split, asked in ((-1, js),) if cell is None else ((j, (j,)) for j in js):
                            stored = i == i0[r] and split in (-1, j0[r])
                            n = 1 if cell is None else cell.get(split, 1)
                            for salt in range(n):
                                rows.append(r)
                                cells.append(i)
                                splits.append(split)
                                salts.append(salt)
                                seconds.append(bytes(asked))
                                own.append(j0[r] if stored and crc32(str(reps[r]).encode()) % n == salt else -1)
                taken = b.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(cells, pa.int32()), pa.array(splits, pa.int32()), pa.array(salts, pa.int32()),
                     pa.array(seconds, pa.binary()), pa.array(own, pa.int32())],
                    [*taken.schema.names, "cell", "split", "salt", "seconds", "own"])
    return run


class Stored:
    """The stored vectors of one (label, cell, split, salt): queries are compared to them a block at a time."""

    def __init__(self, rows: pa.Table, similarity: float, length: int, index: MultiIndex):
        self.similarity, self.length, self.index = similarity, length, index
        self.rep = rows.column("rep").combine_chunks()
        self.x = vectors.unit(vectors.block(rows.column("vec"), length))
        self.weight = rows.column("n").to_numpy()
        own = rows.column("own").to_numpy()
        self.of = {j: np.flatnonzero(own == j) for j in np.unique(own).tolist()}
        self.labels = np.arange(len(self.x))
        self.reach = index.reach(self.x)
        self.missed = np.zeros(len(self.x), np.int64)  # links that only the other end found

    def compare(self, rows: pa.RecordBatch, at: int = -1) -> Iterator[pa.RecordBatch]:
        """Links of a block of queries: rows that are not stored here, or (``at``) the stored ones from there on."""
        n, known = rows.num_rows, len(self.x)
        if at < 0:
            x, place = vectors.unit(vectors.block(rows.column("vec"), self.length)), known + np.arange(n)
        else:
            x, place = self.x[at:at + n], at + np.arange(n)
        queries = defaultdict(list)
        for r, js in enumerate(rows.column("seconds").to_pylist()):
            for j in js:
                if j in self.of:
                    queries[j].append(r)
        labels, count = np.concatenate([self.labels, known + np.arange(n)]), np.zeros(n, np.int64)
        weight, (i0, j0) = rows.column("n").to_numpy(), self.index.home(x)
        one, two, limit = self.reach
        for j, asking in queries.items():
            asking, stored = np.array(asking, np.int64), self.of[j]
            step = max(1, PAIRS // len(stored))
            for first in range(0, len(asking), step):
                q = asking[first:first + step]
                hit = (x[q] @ self.x[stored].T >= self.similarity) & (place[q][:, None] != stored[None])
                if hit.any():
                    a, b = np.nonzero(hit)
                    count += np.bincount(q[a], weights=self.weight[stored[b]], minlength=n).astype(np.int64)
                    merge(labels, place[q[a]], stored[b])
                    a, b = q[a], stored[b]
                    alone = one[b, i0[a]] + two[b, j0[a]] > limit[b]
                    np.add.at(self.missed, b[alone], weight[a[alone]])
        self.labels = labels[:known].copy()
        rep = rows.column("rep")
        yield from _links(rep, count, np.flatnonzero(count))
        if at < 0:
            joined = np.flatnonzero(labels[known:] < known)
            yield from _forest(rep, joined, self.rep, labels[known + joined])

    def close(self) -> Iterator[pa.RecordBatch]:
        """The forest of the stored vectors, and their links that only queries found."""
        yield from _links(self.rep, self.missed, np.flatnonzero(self.missed))
        joined = np.flatnonzero(self.labels != np.arange(len(self.x)))
        yield from _forest(self.rep, joined, self.rep, self.labels[joined])


def _links(rep: pa.Array, count: np.ndarray, some: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(some):
        yield pa.RecordBatch.from_arrays(
            [rep.take(pa.array(some)), pa.array(count[some]), pa.nulls(len(some), rep.type)], ["rep", "links", "other"])


def _forest(rep: pa.Array, joined: np.ndarray, other: pa.Array, to: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(joined):
        yield pa.RecordBatch.from_arrays(
            [rep.take(pa.array(joined)), pa.array(np.zeros(len(joined), np.int64)), other.take(pa.array(to))],
            ["rep", "links", "other"])


def _verify(similarity: float, length: int, index: MultiIndex):
    """Links of the stored vectors and the queries of each (label, cell, split, salt); the input is sorted by
    them, the stored rows of each first.  Only those are held."""
    def settle(held: list[pa.RecordBatch]) -> tuple[Stored | None, list[pa.RecordBatch]]:
        if not held:
            return None, []
        rows = pa.Table.from_batches(held)
        stored, found = Stored(rows, similarity, length, index), []
        for at in range(0, rows.num_rows, BLOCK):
            found += stored.compare(rows.slice(at, BLOCK).combine_chunks().to_batches()[0], at)
        return stored, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, stored, open_, key = [], None, False, None
        for b in batches:
            own = (b.column("own").to_numpy(zero_copy_only=False) >= 0).tolist()
            keys = list(zip(*(b.column(c).to_pylist() for c in ("label", "cell", "split", "salt")), own, strict=True))
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if key is None or keys[at][:-1] != key:
                    if open_:
                        stored, found = settle(held)
                        yield from found
                    if stored:
                        yield from stored.close()
                    held, stored, open_, key = [], None, True, keys[at][:-1]
                if keys[at][-1]:
                    held.append(b.slice(at, end - at))
                else:
                    if open_:
                        stored, found = settle(held)
                        yield from found
                        held, open_ = [], False
                    if stored:
                        for start in range(at, end, BLOCK):
                            yield from stored.compare(b.slice(start, min(BLOCK, end - start)))
                at = end
        if open_:
            stored, found = settle(held)
            yield from found
        if stored:
            yield from stored.close()
    return run


def _hot_cells(spark: SparkSession, reps: DataFrame, index: MultiIndex, length: int) -> dict:
    """The hot (label, first codeword)s, those with too many stored vectors, and in each the salts of the product
    cells that have too many themselves; at most ``HOT_LIST`` entries."""
    kind = reps.schema["label"].dataType.simpleString()
    cells = stage_table(spark, reps.select("label", "vec").mapInArrow(_homes(index, length), f"label {kind}, cell int, second int")
                        .groupBy("label", "cell", "second").count(), "cells")
    firsts = cells.groupBy("label", "cell").agg(F.sum("count").alias("count"))
    limit = HOT_HOMES
    while True:
        hot, split = firsts.where(F.col("count") > limit), cells.where(F.col("count") > limit)
        if hot.count() + split.count() <= HOT_LIST:
            found = {(r["label"], r["cell"]): {} for r in hot.collect()}
            for r in split.collect():
                found[r["label"], r["cell"]][r["second"]] = -(-r["count"] // limit)
            return found
        limit *= 2


def near_duplicates(spark: SparkSession, df: DataFrame, similarity: float = 0.98, target: float = 0.999,
                    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``df``."""
    rows = df.select(df[id_col].alias("vec_id"), df[vec_col].alias("vec"), df[label_col].alias("label"))
    length = vectors.common_length(rows, "vec")
    part = vectors.finite(F.col("vec")) & (F.size("vec") == length) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    reps = stage_table(spark, rows.where(part).groupBy("label", "vec").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vectors")
    total = reps.count()
    if total:
        share = min(1.0, 1.2 * SAMPLE / total)
        drawn = (reps.where(F.pmod(F.xxhash64("rep", "label"), F.lit(1 << 20)) <= int(share * (1 << 20)))
                 .select("vec").limit(2 * SAMPLE).toArrow())
        drawn = drawn if drawn.num_rows else reps.select("vec").limit(SAMPLE).toArrow()
        index = MultiIndex(vectors.unit(vectors.block(drawn.column("vec"), length)), similarity, target)
        hot = _hot_cells(spark, reps, index, length)
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in reps.schema.fields)
        visits = reps.mapInArrow(_visits(index, length, hot), f"{schema}, cell int, split int, salt int, seconds binary, own int")
        key = ["label", "cell", "split", "salt"]
        dealt = visits.repartition(shuffle_partitions(spark), *key).sortWithinPartitions(*key, F.col("own") < 0)
        kind = reps.schema["rep"].dataType.simpleString()
        found = dealt.mapInArrow(_verify(similarity, length, index), f"rep {kind}, links long, other {kind}")
    else:
        kind = reps.schema["rep"].dataType.simpleString()
        found = spark.createDataFrame([], f"rep {kind}, links long, other {kind}")
    found = stage_table(spark, found, "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected(spark, found.where("other IS NOT NULL").select("rep", "other"))
    info = stage_table(spark, reps.join(links, "rep", "left").join(
        parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("label").alias("l"), F.col("vec").alias("v"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
        F.coalesce("component", "rep").alias("component")), "vector-components")
    out = rows.join(info, part & (rows["label"] == info["l"]) & (rows["vec"] == info["v"]), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))

"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are combined first: a row of the index is a distinct vector with its k + 1 smallest ids, enough
for any k neighbours besides the own id.  Rows are dealt over shards of about ``SHARD_ROWS`` by a hash of
their smallest id.  A shard's graph is built in one task of bounded size: rows get a random order and random
levels, and on each level a row links, under the diversity rule, to nearest rows that precede it in the
order (what insertion one by one gives with a perfect search), and back.  Rows that
pruning has cut off are linked again.  The index, one row a shard with flat
neighbour arrays, is written to the shared folder.

Every query meets every shard's graph in a stream sorted by shard: one index row, then the
queries.  Graphs are built and searched on vectors about the shard's medians, over its largest deviation, in double precision, so offsets and
scales of the values don't matter (unless they differ by over 150 orders of magnitude within a shard).  Distances are computed again in double precision on the original
vectors, the rows found are expanded to their ids, and the shards' results are merged to the k nearest,
ties to the smaller id.

Defined cases: vectors that are null, zero or hold null or non-finite components, vectors of
another length than the table's common one, and rows with a null id take no part; rows that
repeat an id are candidates of their own, but for a query of that id; fewer candidates than k: all of them; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferrule.llm import vectors
from ferrule.llm.common import shuffle_partitions, stage_table

SHARD_ROWS, LINKS, CANDIDATES, WIDTH = 4096, 12, 48, 96
SALTS = 16
INDEX = "shard int, ids binary, starts binary, vectors binary, nodes array<binary>, offsets array<binary>, neighbours array<binary>"


def _diverse(near: np.ndarray, dist: np.ndarray, x: np.ndarray, most: int) -> np.ndarray:
    """For each row's candidates (nearest first, -1: none), which to link: a candidate stays unless it
    is nearer to a kept one than to the row."""
    rows, width = near.shape
    points = x[near]
    norm = (points * points).sum(2)
    between = norm[:, :, None] + norm[:, None, :] - 2.0 * points @ points.transpose(0, 2, 1)
    keep = np.zeros((rows, width), bool)
    for c in range(width):
        hidden = (keep & (between[:, c, :] < dist[:, c, None])).any(1)
        keep[:, c] = (near[:, c] >= 0) & ~hidden & (keep.sum(1) < most)
    return keep


def _level(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and flat neighbours of one level over the rows of ``x``, given in insertion order."""
    n = len(x)
    norm = (x * x).sum(1)
    edges = []
    for at in range(0, n, 256):
        end = min(n, at + 256)
        d = norm[at:end, None] + norm[None, :end] - 2.0 * x[at:end] @ x[:end].T
        d[np.arange(end)[None] >= np.arange(at, end)[:, None]] = np.inf
        width = min(CANDIDATES, end)
        near = np.argpartition(d, width - 1, axis=1)[:, :width]
        dist = np.take_along_axis(d, near, 1)
        order = dist.argsort(1)
        near, dist = np.take_along_axis(near, order, 1), np.take_along_axis(dist, order, 1)
        near[np.isinf(dist)] = -1
        keep = _diverse(near, dist, x, LINKS)
        r, c = np.nonzero(keep)
        edges.append(np.stack([r + at, near[r, c]], 1))
    pairs = np.concatenate(edges) if edges else np.empty((0, 2), np.int64)
    pairs = np.unique(np.concatenate([pairs, pairs[:, ::-1]]), axis=0)
    return _reachable(x, *_pruned(x, pairs, most))


def _pruned(x: np.ndarray, pairs: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` diverse links a row."""
    n = len(x)
    counts = np.bincount(pairs[:, 0], minlength=n)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    links = [pairs[offsets[r]:offsets[r + 1], 1] for r in range(n)]
    for r in np.flatnonzero(counts > most).tolist():
        d = ((x[links[r]] - x[r]) ** 2).sum(1)
        order = d.argsort()[:4 * most]
        near = links[r][order]
        links[r] = near[_diverse(near[None], d[order][None], x, most)[0]]
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in links])])
    return offsets, np.concatenate(links) if n else np.empty(0, np.int64)


def _reachable(x: np.ndarray, offsets: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links added until every row can be reached from the first."""
    n = len(x)
    links = [flat[offsets[r]:offsets[r + 1]].tolist() for r in range(n)]
    seen = np.zeros(n, bool)

    def walk(start: int) -> None:
        stack = [start]
        seen[start] = True
        while stack:
            for v in links[stack.pop()]:
                if not seen[v]:
                    seen[v] = True
                    stack.append(v)

    if n:
        walk(0)
    for r in range(n):
        if not seen[r]:
            known = np.flatnonzero(seen)
            near = int(known[((x[known] - x[r]) ** 2).sum(1).argmin()])
            links[near].append(r)
            walk(r)
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in links])])
    return offsets.astype(np.int32), np.array([v for each in links for v in each], np.int32)


class Graph:
    """A shard's index: vectors, the ids of each (flat, row r has those from ``starts[r]`` to ``starts[r + 1]``),
    and for each level its rows and their flat neighbour arrays."""

    def __init__(self, ids, starts, x, nodes, offsets, neighbours):
        self.ids, self.starts, self.x = ids, starts, x
        self.nodes, self.offsets, self.neighbours = nodes, offsets, neighbours
        self.centre, self.scale = _frame(x)
        self.seen = _framed(x, self.centre, self.scale)
        self.place = [{int(v): k for k, v in enumerate(own)} for own in nodes[1:]]

    @staticmethod
    def build(ids: np.ndarray, x: np.ndarray, seed: int, counts: np.ndarray | None = None) -> Graph:
        """``counts``: how many of the flat ``ids`` each row has (default: one)."""
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        counts = np.ones(len(x), np.int64) if counts is None else counts
        starts = np.concatenate([[0], np.cumsum(counts[order])]).astype(np.int64)
        ids, x = ids[_runs((np.cumsum(counts) - counts)[order], counts[order])], x[order]
        level = np.floor(-np.log(rng.random(len(x))) / np.log(LINKS)).astype(int)
        if len(level):
            level[0] = level.max()
        scaled = _framed(x, *_frame(x))
        nodes, offsets, neighbours = [], [], []
        for k in range(int(level.max()) + 1 if len(level) else 0):
            own = np.flatnonzero(level >= k)
            o, f = _level(scaled[own], LINKS if k else 2 * LINKS)
            nodes.append(own.astype(np.int32))
            offsets.append(o)
            neighbours.append(own[f].astype(np.int32))
        return Graph(ids, starts, x, nodes, offsets, neighbours)

    def _near(self, level: int, row: int) -> np.ndarray:
        k = self.place[level - 1][row] if level else row
        return self.neighbours[level][self.offsets[level][k]:self.offsets[level][k + 1]]

    def search(self, q: np.ndarray, k: int, width: int, own_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest ids of the rows found and their exact distances, but for ``own_id``.  The search compares
        sums of squared differences in the shard's frame, in double precision."""
        x, p = self.seen, _framed(q, self.centre, self.scale)
        at, best = 0, float(((x[0] - p) ** 2).sum())
        for level in range(len(self.nodes) - 1, 0, -1):
            while True:
                near = self._near(level, at)
                if not len(near):
                    break
                d = ((x[near] - p) ** 2).sum(1)
                i = int(d.argmin())
                if not d[i] < best:  # only a strict improvement goes on
                    break
                at, best = int(near[i]), float(d[i])
        seen = np.zeros(len(x), bool)
        seen[at] = True
        open_, found = [(best, at)], [(-best, at)]
        while open_:
            d, row = heappop(open_)
            if len(found) >= width and d > -found[0][0]:
                break
            near = self._near(0, row)
            near = near[~seen[near]]
            if not len(near):
                continue
            seen[near] = True
            dist = ((x[near] - p) ** 2).sum(1)
            if len(found) >= width:
                ok = dist < -found[0][0]
                near, dist = near[ok], dist[ok]
            for dv, v in zip(dist.tolist(), near.tolist(), strict=True):
                if len(found) < width:
                    heappush(found, (-dv, v))
                elif dv < -found[0][0]:
                    heapreplace(found, (-dv, v))
                else:
                    continue
                heappush(open_, (dv, v))
        rows = np.array([v for _, v in found])
        counts = self.starts[rows + 1] - self.starts[rows]
        ids = self.ids[_runs(self.starts[rows], counts)]
        exact = np.repeat(distances(self.x[rows], q), counts)
        ids, exact = ids[ids != own_id], exact[ids != own_id]
        top = np.lexsort((ids, exact))[:k]
        return ids[top], exact[top]


def _frame(x: np.ndarray) -> tuple[np.ndarray, float]:
    """The middle of a shard's rows (medians, which single far rows don't move) and their largest deviation from it."""
    if not len(x):
        return np.zeros(x.shape[1:]), 1.0
    centre = np.median(x / 2, axis=0) * 2
    return centre, float(np.abs(x / 2 - centre / 2).max()) or 1.0


def _framed(x: np.ndarray, centre: np.ndarray, scale: float) -> np.ndarray:
    """Rows about the middle, at most 2 in any component for the shard's own; far queries are held at 1e150, where squares don't overflow."""
    with np.errstate(over="ignore"):
        return np.clip((x / 2 - centre / 2) / scale * 2, -1e150, 1e150)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision; those whose squares leave its range are computed on scaled differences."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.sqrt(((x - q) ** 2).sum(1))
        largest = np.abs(x - q).max(1, initial=0)
        odd = (largest > 0) & np.isfinite(largest) & ((largest > 1e150) | (largest < 1e-150))
        if odd.any():
            out[odd] = np.sqrt((((x[odd] - q) / largest[odd, None]) ** 2).sum(1)) * largest[odd]
    return out


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of runs one after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` (id, vec) as one row for each distinct vector: its k + 1 smallest ids, sorted; an id that
    repeats with the vector up to k times.  A vector's ids are cut per salt first, so that one that many
    rows share is dealt over ``SALTS`` tasks."""
    each = (rows.groupBy("vec", "id").agg(F.count("*").alias("n"))
            .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))))
    for keys in (["vec", "salt"], ["vec"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
        each = each.withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    found = F.array_sort(F.collect_list(F.struct("id", F.least("n", F.lit(k)).cast("int").alias("n"))))
    return each.groupBy("vec").agg(F.flatten(F.transform(found, lambda s: F.array_repeat(s["id"], s["n"]))).alias("ids"))


def build_index(spark: SparkSession, rows: DataFrame, shards: int, length: int) -> DataFrame:
    """``rows`` (vec, ids), one for each distinct vector, as one index row a shard."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[pdf["ids"].str[0].argsort(kind="stable")]
        x = np.array(pdf["vec"].tolist(), np.float64).reshape(-1, length)
        shard = int(pdf["shard"].iloc[0])
        g = Graph.build(np.concatenate(pdf["ids"].tolist()).astype(np.int64), x, shard, pdf["ids"].str.len().to_numpy(np.int64))
        lists = [[a.tobytes() for a in arrays] for arrays in (g.nodes, g.offsets, g.neighbours)]
        return pd.DataFrame({"shard": [shard], "ids": [g.ids.tobytes()], "starts": [g.starts.tobytes()],
                             "vectors": [g.x.tobytes()], "nodes": [lists[0]], "offsets": [lists[1]],
                             "neighbours": [lists[2]]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int"))
    return stage_table(spark, dealt.groupBy("shard").applyInPandas(build, INDEX), "graphs")


def _searcher(k: int, width: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = None
        for b in batches:
            out = ([], [], [])
            is_index = b.column("ids").is_valid().to_pylist()
            ids = b.column("query_id").to_pylist()
            for r in range(b.num_rows):
                if is_index[r]:
                    row = b.slice(r, 1).to_pylist()[0]
                    graph = Graph(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["starts"], np.int64),
                                  np.frombuffer(row["vectors"], np.float64).reshape(-1, length),
                                  *([np.frombuffer(a, np.int32) for a in row[c]] for c in ("nodes", "offsets", "neighbours")))
                    continue
                q = vectors.block(b.column("vec").slice(r, 1), length)[0]
                near, dist = graph.search(q, k, width, ids[r])
                out[0].extend([ids[r]] * len(near))
                out[1].extend(near.tolist())
                out[2].extend(dist.tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                ["query_id", "vec_id", "score"])
    return run


def nearest(spark: SparkSession, df: DataFrame, is_query: Column, k: int = 10, width: int = WIDTH,
            shard_rows: int = SHARD_ROWS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of each row for which ``is_query``
    (a condition on ``id``) holds, by Euclidean distance."""
    rows = df.select(df[id_col].cast("long").alias("id"), df[vec_col].alias("vec"))
    length = vectors.common_length(rows, "vec")
    valid = rows.where(F.col("id").isNotNull() & vectors.finite(F.col("vec")) & (F.size("vec") == length))
    distinct = stage_table(spark, _distinct(valid, k), "distinct-vectors")
    shards = max(1, -(-distinct.count() // shard_rows))
    index = build_index(spark, distinct, shards, length)
    present = index.select("shard").distinct()
    asked = valid.where(is_query).select(F.col("id").alias("query_id"), "vec").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    stream = index.unionByName(asked.join(present, "shard", "left_semi"), allowMissingColumns=True)
    dealt = stream.repartition(min(shards, 10 * shuffle_partitions(spark)), "shard").sortWithinPartitions(
        "shard", F.col("ids").isNull())
    found = dealt.mapInArrow(_searcher(k, width, length), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

"""Removal of passages that repeat across documents, by difference-cover anchors.

A window is ``window`` consecutive words of one document.  A word goes if a window that covers
it also starts in a document with a smaller id; windows are judged on the input.

Anchors: runs of ``length`` words are hashed at the positions that lie, modulo ``PERIOD``, in
a difference cover.  Two equal windows at any two positions have, for some shift below the period,
both positions in the cover, and ``length + period - 1 = window``, so they share an anchor at the same
place inside the window.  Anchors meet in a shuffle by their hash; those that two documents share are
extended: every window that holds one within its first ``PERIOD`` positions is hashed with 128 bits,
and these meet in a second shuffle.  The result does not depend on which anchors are shared by chance.

Scale: exact copies are settled first by the digest of their text (the smallest id supplies, the
others lose every word if they have a window), so a hot copy sends no anchors.  Equal hashes are combined before
each shuffle, ``SLICE`` documents at a time: what a smaller id of the slice has too is decided there and
dealt anywhere, so of a hot passage one document's rows a slice meet in its task.  Groups are
never held: rows arrive sorted by hash and id, and a task keeps the first document's rows
of the current group only.  Texts are shuffled once, by (id, digest), and that exchange serves all
three passes over them.

Defined cases: null text has no words; a row with a null id supplies nothing and keeps all its words; rows that
repeat an id are judged each, and never against each other; one row comes out for each row; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferrule.llm.common import named, shuffle_partitions, stage_table, text_of

#: Perfect difference sets modulo 1, 7, 13, 21 and 31.
COVERS = {1: (0,), 7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
#: Odd multipliers of the two window hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def cover_for(window: int) -> tuple[int, tuple[int, ...], int]:
    """Period, cover and anchor length for a window."""
    period = max(p for p in COVERS if p == 1 or p <= 2 * window // 3)
    return period, COVERS[period], window - period + 1


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def run_hashes(h: np.ndarray, length: int, base: int) -> np.ndarray:
    """A 64-bit hash of every run of ``length`` values, by doubling: joins of runs of powers of two."""
    out, done, power = None, 0, 1
    doubled, factor = h, base
    n = len(h) - length + 1
    while True:
        if length & power:
            if out is None:
                out = doubled[:]
            else:
                m = min(len(out), len(doubled) - done)
                out = out[:m] * np.uint64(factor) + doubled[done:done + m]
            done += power
        power *= 2
        if power > length:
            break
        m = len(doubled) - power // 2
        doubled = doubled[:m] * np.uint64(factor) + doubled[power // 2:power // 2 + m]
        factor = factor * factor % (1 << 64)
    out = out[:n].copy()
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out


#: What is known of a row before the shuffle: its hash is alone in its slice of documents; its document
#: has the slice's smallest id among several that share the hash; a smaller id in the slice has it too.
ALONE, LEAST, LATER = 0, 1, 2
#: Documents whose equal hashes are combined before the shuffle.
SLICE = 2048


def _combined(batch: pa.RecordBatch, rows: list[int], hashes: list[list[np.ndarray]]) -> tuple[list[pa.Array], np.ndarray]:
    """Columns (hashes, doc_id, v, state) of a slice's rows, and the order they are in."""
    counts = np.array([len(h) for h in hashes[0]], np.int64)
    at = np.repeat(np.array(rows, np.int64), counts)
    cols = [np.concatenate(h).view(np.int64) for h in hashes]
    rank = np.unique(batch.column("doc_id").to_numpy(zero_copy_only=False), return_inverse=True)[1][at]
    order = np.lexsort((rank, *reversed(cols)))
    cols, at, rank = [c[order] for c in cols], at[order], rank[order]
    new = np.ones(len(at), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(at)))
    later = rank > np.repeat(rank[starts], sizes)
    several = np.repeat(np.add.reduceat(later, starts) > 0, sizes)
    state = np.where(later, LATER, np.where(several, LEAST, ALONE)).astype(np.int8)
    taken = pa.array(at)
    return [*map(pa.array, cols), batch.column("doc_id").take(taken), batch.column("v").take(taken), pa.array(state)], order


def anchors_of(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the cover, and the hashes of the runs there, of a document's word hashes."""
    period, cover, length = cover_for(window)
    p = np.arange(len(h) - length + 1)
    p = p[np.isin(p % period, cover)]
    return p, run_hashes(h, length, BASES[0])[p]


def _anchors(window: int):
    """Each document's distinct anchor hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                b = batch.slice(at, SLICE)
                rows, hashes = [], []
                for r, x in enumerate(b.column("text")):
                    words = x.as_py().encode("utf-8").split()
                    if len(words) >= window:
                        rows.append(r)
                        hashes.append(np.unique(anchors_of(word_hashes(words), window)[1]))
                if rows:
                    yield pa.RecordBatch.from_arrays(_combined(b, rows, [hashes])[0], ["h", "doc_id", "v", "state"])
    return run


def _windows(window: int):
    """Hashes of the windows that hold a shared anchor within their first ``period`` positions."""
    period, _, _ = cover_for(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                b = batch.slice(at, SLICE)
                rows, positions, one, two = [], [], [], []
                for r, (x, shared) in enumerate(zip(b.column("text"), b.column("shared"), strict=True)):
                    h = word_hashes(x.as_py().encode("utf-8").split())
                    n = len(h) - window + 1
                    i, own = anchors_of(h, window)
                    i = i[np.isin(own, shared.values.to_numpy().view(np.uint64))]
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, np.clip(i - period + 1, 0, n), 1)
                    np.add.at(edge, np.clip(i + 1, 0, n), -1)
                    p = np.flatnonzero(np.cumsum(edge[:n]) > 0)
                    if len(p):
                        rows.append(r)
                        positions.append(p)
                        one.append(run_hashes(h, window, BASES[0])[p])
                        two.append(run_hashes(h, window, BASES[1])[p])
                if rows:
                    cols, order = _combined(b, rows, [one, two])
                    yield pa.RecordBatch.from_arrays(
                        [*cols, pa.array(np.concatenate(positions).astype(np.int32)[order])],
                        ["h", "h2", "doc_id", "v", "state", "pos"])
    return run


def _meet(hash_columns: tuple[str, ...], suppliers: bool, carried: str):
    """Rows, sorted by hash and id, whose hash another document has too: those with an id above the
    group's smallest, and with ``suppliers`` the smallest id's rows as well.  Rows known to be later ones
    come from anywhere and pass."""
    names = ["doc_id", "v", carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, first, paired = [], None, None, False
        for b in batches:
            state = b.column("state").to_numpy()
            if (state == LATER).any():
                yield b.select(names).filter(pa.array(state == LATER))
                b = b.filter(pa.array(state != LATER))
                state = state[state != LATER]
            n = b.num_rows
            if not n:
                continue
            h = [b.column(c).to_numpy() for c in hash_columns]
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            new = np.ones(n, bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in h], axis=0)
            continues = group == tuple(x[0] for x in h)
            new[0] = not continues
            starts = np.flatnonzero(new)
            head = ids[np.maximum.accumulate(np.where(new, np.arange(n), 0))]
            if continues:
                head[:starts[0] if len(starts) else n] = first
            later = ids != head
            rows = b.select(names)
            keep = later.copy()
            if suppliers:
                keep |= state == LEAST
                ends = np.append(starts[1:], n)
                has = np.add.reduceat(later, starts) > 0 if len(starts) else np.zeros(0, bool)
                for_all = np.repeat(has, ends - starts)
                keep[n - len(for_all):] |= for_all
                if continues:
                    stop = int(starts[0]) if len(starts) else n
                    if paired or later[:stop].any():
                        paired = True
                        keep[:stop] = True
                        yield from held
                        held = []
                    elif not len(starts):
                        held.append(rows)
                if len(starts):
                    paired = bool(has[-1])
                    held = [] if paired else [rows.slice(int(starts[-1]))]
            if keep.any():
                yield rows.filter(pa.array(keep))
            group = tuple(x[-1] for x in h)
            first = head[-1]
    return run


def _outcome(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = ([], [], [])
            for x, copy, starts in zip(b.column("text"), b.column("copy"), b.column("starts"), strict=True):
                words = x.as_py().encode("utf-8").split()
                n, kept = len(words), words
                if copy.as_py() and n >= window:
                    kept = []
                elif starts.is_valid:
                    edge = np.zeros(n + 1, np.int64)
                    p = starts.values.to_numpy()
                    np.add.at(edge, p, 1)
                    np.add.at(edge, p + window, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(edge[:n]) == 0)]
                out[0].append(n)
                out[1].append(n - len(kept))
                out[2].append(b" ".join(kept).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
    return run


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Rows by hash; those that need no meeting anywhere, so that a hot hash is one row a slice in its task."""
    return rows.repartition(parts, F.when(F.col("state") == LATER, F.xxhash64("doc_id", "h")).otherwise(F.col("h")))


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = 50,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` for every row; ``kept`` is the words left, joined by one space."""
    rows = docs.select(named(docs, id_col, "doc_id"), text_of(docs, text_col).alias("text"))
    parts, kind = shuffle_partitions(spark), rows.schema["doc_id"].dataType.simpleString()
    known = rows.where("doc_id IS NOT NULL").withColumn(
        "digest", F.unhex(F.sha2("text", 256))).where("digest IS NOT NULL")
    ids = known.select("doc_id", "digest").distinct()
    first = stage_table(spark, known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "texts")
    copies = stage_table(spark, ids.join(first, "digest").select(
        "doc_id", "digest", (F.col("doc_id") != F.col("rep")).alias("copy"),
        F.row_number().over(Window.partitionBy("doc_id").orderBy("digest")).alias("v")), "copies")
    units = copies.where("NOT copy").select("doc_id", "digest", "v")

    texts = known.repartition(parts, "doc_id", "digest")
    anchors = texts.join(units.hint("shuffle_hash"), ["doc_id", "digest"]).select("doc_id", "v", "text").mapInArrow(
        _anchors(window), f"h long, doc_id {kind}, v int, state tinyint")
    shared = _dealt(anchors, parts).sortWithinPartitions("h", "doc_id", "v").mapInArrow(
        _meet(("h",), True, "h"), f"doc_id {kind}, v int, h long")
    to_extend = shared.groupBy("doc_id", "v").agg(F.collect_set("h").alias("shared")).join(units, ["doc_id", "v"])
    windows = texts.join(to_extend.hint("shuffle_hash"), ["doc_id", "digest"]).select(
        "doc_id", "v", "text", "shared").mapInArrow(_windows(window), f"h long, h2 long, doc_id {kind}, v int, state tinyint, pos int")
    repeated = _dealt(windows, parts).sortWithinPartitions("h", "h2", "doc_id", "v", "pos").mapInArrow(
        _meet(("h", "h2"), False, "pos"), f"doc_id {kind}, v int, pos int")
    starts = repeated.groupBy("doc_id", "v").agg(F.collect_list("pos").alias("starts"))
    info = copies.join(starts, ["doc_id", "v"], "left").select("doc_id", "digest", "copy", "starts")
    judged = texts.join(info.hint("shuffle_hash"), ["doc_id", "digest"], "left").select("doc_id", "text", "copy", "starts")
    unnamed = rows.where("doc_id IS NULL").select(
        "doc_id", "text", F.lit(False).alias("copy"), F.lit(None).cast("array<int>").alias("starts"))
    return judged.union(unnamed).mapInArrow(
        _outcome(window), f"doc_id {kind}, n_words long, n_removed long, kept string")

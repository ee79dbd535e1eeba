"""SimHash near-duplicates by anchor points of a covering code.

Fingerprint: A-Z are lower-cased, words are runs of non-blank characters, shingles are
``k`` consecutive words joined by one space (fewer words: the whole sequence; none:
fingerprint 0), and a bit is set if it is set in over half of the shingles' XXH64 hashes.

Linking at ``distance`` differing bits: the 64 bits are cut into ``parts``; two linked
fingerprints differ by at most ``t = distance // parts`` bits in some part.  The anchors
of a part are the words of a covering code of radius 1: a perfect Hamming code on 15 of
its bits, all words on the others.  Every fingerprint has a nearest anchor, its home, and
is replicated to all anchors within radius ``1 + t`` of it, so of two linked fingerprints
one always meets the other at its home.  Per anchor, homes are compared with everything
there on all 64 bits, in bounded blocks.

Skew: equal fingerprints are combined before they are replicated.  An anchor with more
than ``HOT_HOMES`` homes is split: its homes are dealt over salts, its other rows go to each.
What leaves an anchor is a forest over the linked rows, never all pairs.

Defined cases: null text has no words; a null id gets a fingerprint and a null component, and
links nothing; rows that repeat an id are kept, each with its own fingerprint, and the id's
component is the smallest one that any of its texts reaches; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import shuffle_partitions, stage_table, text_of
from ferrule.llm.components import connected
from ferrule.llm.forest import merge

BITS, SEED, BLOCK = 64, 42, 15
HOT_HOMES = 50_000
#: Most hot anchors whose list is sent to the tasks; above it the limit of homes is doubled.
HOT_LIST = 50_000
#: Pairs compared at once.
PAIRS = 1 << 21
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, k: int) -> int:
    """64-bit fingerprint of one text, unsigned."""
    import xxhash

    words = text.encode("utf-8").translate(LOWER).split()
    if not words:
        return 0
    line, n = b" ".join(words), len(words)
    if n <= k:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = [0, *(ends[:n - k] + 1).tolist()]
    h = xxhash.xxh64_digest
    raw = b"".join([h(line[a:e], SEED) for a, e in zip(starts, ends[k - 1:].tolist(), strict=True)])
    return majority(raw)


def majority(raw: bytes) -> int:
    """The bits set in over half of the 8-byte big-endian hashes in ``raw``."""
    n = len(raw) // 8
    bits = np.unpackbits(np.frombuffer(raw, np.uint8)).view(np.uint64).reshape(n, 8)
    # eight one-byte counters in each 64-bit lane; 255 rows cannot overflow one
    sums = np.add.reduceat(bits, np.arange(0, n, 255), axis=0).view(np.uint8).reshape(-1, BITS)
    return int.from_bytes(np.packbits(2 * sums.sum(axis=0, dtype=np.int64) > n).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``; ``fp`` holds the 64 bits as a signed long."""
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(x.as_py(), k) for x in b.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


class CoveringCode:
    """Anchors of one part: a Hamming code on its low 15 bits (fewer: none) and all words on the rest."""

    def __init__(self, shift: int, width: int, radius: int):
        self.shift, self.width, self.radius = shift, width, radius
        block = BLOCK if width >= BLOCK else 0
        self.block = block
        self.syndrome = np.zeros(1 << block, np.uint8)
        for bit in range(block):
            self.syndrome[1 << bit:2 << bit] = self.syndrome[:1 << bit] ^ (bit + 1)
        free = [self._mask(c, block) for n in range(radius + 1) for c in combinations(range(width - block), n)]
        self.patterns = []  # for each syndrome, what to flip to reach the anchors within the radius
        for s in range(block + 1):
            own = [c for n in range(radius + 1) for c in combinations(range(block), n)
                   if int(np.bitwise_xor.reduce(np.array([b + 1 for b in c] or [0]))) == s]
            self.patterns.append(np.array(sorted(
                self._mask(c, 0) | f for c in own for f in free
                if len(c) + int(f).bit_count() <= radius), np.uint64))

    @staticmethod
    def _mask(bits: tuple[int, ...], base: int) -> int:
        return sum(1 << (base + b) for b in bits)

    def part(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = (fp >> np.uint64(self.shift)) & np.uint64((1 << self.width) - 1)
        return value, self.syndrome[(value & np.uint64((1 << self.block) - 1)).astype(np.int64)]

    def home(self, fp: np.ndarray) -> np.ndarray:
        value, s = self.part(fp)
        flip = np.array([0, *(1 << b for b in range(self.block))], np.uint64)
        return value ^ flip[s]

    def near(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and anchors of every anchor within the radius of each fingerprint."""
        value, s = self.part(fp)
        rows, anchors = [], []
        for k, p in enumerate(self.patterns):
            at = np.flatnonzero(s == k)
            rows.append(np.repeat(at, len(p)))
            anchors.append((value[at][:, None] ^ p[None, :]).ravel())
        return np.concatenate(rows), np.concatenate(anchors)


def layout(distance: int, parts: int) -> list[CoveringCode]:
    widths = [BITS // parts + (i < BITS % parts) for i in range(parts)]
    shifts = np.cumsum([0, *widths[:-1]]).tolist()
    return [CoveringCode(s, w, (1 if w >= BLOCK else 0) + distance // parts)
            for s, w in zip(shifts, widths, strict=True)]


def _home_keys(codes: list[CoveringCode]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for i, c in enumerate(codes):
                yield pa.RecordBatch.from_arrays([pa.array(_key(i, c.home(fp)))], ["key"])
    return run


def _key(part: int, anchor: np.ndarray) -> np.ndarray:
    return (anchor | np.uint64(part << 56)).view(np.int64)


def _replicate(codes: list[CoveringCode], hot: dict[int, int]):
    """Rows ``(key, salt, fp, home)``: a fingerprint at each anchor within the radius."""
    hot_keys = np.array(sorted(hot), np.int64)
    salts = np.array([hot[k] for k in hot_keys.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                for i, c in enumerate(codes):
                    rows, anchors = c.near(fp)
                    key, own = _key(i, anchors), c.home(fp)[rows] == anchors
                    salt = np.zeros(len(key), np.int64)
                    if len(hot_keys):
                        place = np.minimum(np.searchsorted(hot_keys, key), len(hot_keys) - 1)
                        copies = np.where(hot_keys[place] == key, salts[place], 1)
                        rows, key, own = (np.repeat(x, copies) for x in (rows, key, own))
                        salt = np.arange(len(key)) - np.repeat(np.cumsum(copies) - copies, copies)
                        copies = np.repeat(copies, copies).astype(np.uint64)
                        mixed = (fp[rows] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
                        own &= mixed % copies == salt.astype(np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(salt.astype(np.int32)), pa.array(fp[rows].view(np.int64)),
                         pa.array(own)], ["key", "salt", "fp", "home"])
    return run


def _compare(distance: int):
    """Links inside each run of equal (key, salt); the input is sorted by them."""
    def links(fp: np.ndarray, home: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(np.append(starts, len(fp)))
        group = np.repeat(np.arange(len(starts)), sizes)
        homes = np.flatnonzero(home & (sizes[group] > 1))
        labels = np.arange(len(fp))
        count = sizes[group[homes]]
        at = 0
        while at < len(homes):
            end = max(at + 1, int(np.searchsorted(np.cumsum(count[at:]), PAIRS, "right")) + at)
            h, n = homes[at:end], count[at:end]
            a = np.repeat(h, n)
            b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[group[h]], n)
            hit = (np.bitwise_count(fp[a] ^ fp[b]) <= distance) & (a != b)
            merge(labels, a[hit], b[hit])
            at = end
        linked = np.flatnonzero(labels != np.arange(len(fp)))
        one, two = fp[linked].view(np.int64), fp[labels[linked]].view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for b in batches:
            if not b.num_rows:
                continue
            new = tuple(b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "salt", "fp", "home"))
            cut = np.flatnonzero((np.diff(new[0]) != 0) | (np.diff(new[1]) != 0)) + 1
            if held and (held[-1][0][-1], held[-1][1][-1]) == (new[0][0], new[1][0]) and not len(cut):
                held.append(new)
                continue
            last = int(cut[-1]) if len(cut) else 0
            held.append(tuple(x[:last] for x in new))
            yield from whole(held)
            held = [tuple(x[last:] for x in new)]
        yield from whole(held)

    def whole(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        if sum(len(x[0]) for x in held):
            key, salt, fp, home = (np.concatenate(x) for x in zip(*held, strict=True))
            starts = np.append(0, np.flatnonzero((np.diff(key) != 0) | (np.diff(salt) != 0)) + 1)
            yield links(fp.view(np.uint64), home.astype(bool), starts)

    return run


def hot_anchors(spark: SparkSession, distinct: DataFrame, codes: list[CoveringCode]) -> dict[int, int]:
    """Number of salts of each anchor with too many homes.  The list is checked: at most ``HOT_LIST``."""
    homes = stage_table(spark, distinct.select("fp").mapInArrow(_home_keys(codes), "key long")
                        .groupBy("key").count().where(F.col("count") > HOT_HOMES), "anchors")
    limit = HOT_HOMES
    while True:
        hot = homes.where(F.col("count") > limit)
        if hot.count() <= HOT_LIST:
            return {r["key"]: -(-r["count"] // limit) for r in hot.collect()}
        limit *= 2


def fingerprint_links(spark: SparkSession, distinct: DataFrame, distance: int, parts: int = 3) -> DataFrame:
    """``distinct`` has one row ``fp`` per fingerprint.  Links ``(a, b)`` whose components are those of
    all pairs at ``distance`` or fewer differing bits."""
    codes = layout(distance, parts)
    hot = hot_anchors(spark, distinct, codes)
    rows = distinct.select("fp").mapInArrow(_replicate(codes, hot), "key long, salt int, fp long, home boolean")
    dealt = rows.repartition(shuffle_partitions(spark), "key", "salt").sortWithinPartitions("key", "salt")
    return dealt.mapInArrow(_compare(distance), "a long, b long")


def near_duplicates(spark: SparkSession, docs: DataFrame, k: int, distance: int, parts: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``."""
    fps = stage_table(spark, fingerprints(docs, k, id_col, text_col), "fingerprints")
    known = fps.where("doc_id IS NOT NULL")
    # nodes are ids, the smallest of each fingerprint; an id that repeats ties its fingerprints together
    reps = stage_table(spark, known.groupBy("fp").agg(F.min("doc_id").alias("rep")), "representatives")
    found = fingerprint_links(spark, reps, distance, parts)
    a, b = reps.select(F.col("fp").alias("a"), F.col("rep").alias("ra")), reps.select(
        F.col("fp").alias("b"), F.col("rep").alias("rb"))
    links = found.join(a, "a").join(b, "b").select("ra", "rb")
    several = known.groupBy("doc_id").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least != most")
    tied = known.join(several.select("doc_id"), "doc_id").join(reps, "fp").select(F.col("doc_id").alias("ra"), "rep")
    edges = links.union(tied)
    part = connected(spark, edges)
    named = stage_table(spark, reps.join(part, reps["rep"] == part["node"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component")), "components-by-fingerprint")
    return fps.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))

"""Merkle manifest of a table: a root hash, and for every row a proof that folds to it.

A row's leaf is the SHA-256 of its fields, each written with its length.  The leaves of a group (a source) ascend by id; level by
level every ``ARITY`` consecutive nodes become their hash until one, the subroot, remains.  Subroots,
ordered by group (null first, then by UTF-8 bytes), give the root in the same way.

Rows are numbered by a range partition and the counts of its parts, so no group has to fit one task.  Levels are worked off in
tiers: a block is ``ARITY ** LEVELS`` consecutive nodes of a group, and one exchange by (group, block) serves all levels of
a tier.  At each level fixed-offset lag and lead columns over the block, masked by the node's slot and the length of its run,
supply its siblings, and the run's first child hashes the parent.  A tier's parents, a 243rd of its nodes, are written to the
shared folder and are the nodes of the next.  Proofs are put together downwards, each block joined with the path above it.

Defined cases: null fields are written ``-``; a null id comes first; rows that share an id ascend by their leaf, so rows that repeat
whole are neighbours with one leaf and proofs of their own; a null group is a group of its own; a run of one node is
hashed too, but a group of one leaf is its own subroot, and one group's subroot is the root; an empty table gives no rows;
long texts are hashed whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrule.llm.common import shuffle_partitions, stage_table

ARITY, LEVELS = 3, 5
BLOCK = ARITY ** LEVELS
STEP = "struct<left:string,right:string>"


def written(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(written, fields)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """The hash of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def numbered(spark: SparkSession, rows: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """``rows`` (with a non-null ``grp``) with ``pos``, the place in the group from 0, and ``n``, the group's size; the largest size."""
    parts = shuffle_partitions(spark)
    spread = rows.repartitionByRange(parts, F.col("grp"), *order).sortWithinPartitions(F.col("grp"), *order)
    dealt = stage_table(spark, spread.withColumn("at", F.monotonically_increasing_id()), name)
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    held = dealt.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    group = Window.partitionBy("grp")  # a group has at most one row a part here
    before = F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select("grp", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("rows").over(group).alias("n"))
    placed = dealt.join(held, ["grp", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")
    return placed, held.agg(F.max("n")).first()[0] or 0


def _climb(nodes: DataFrame) -> DataFrame:
    """One tier.  ``nodes`` (grp, pos, n, node, ...) with ``block``, the steps ``s0 .. s4`` of its levels on the rows that
    stand for a node there (the first leaf under it), and ``node`` raised to the tier's end on each block's first row."""
    out = nodes.selectExpr("*", f"pos div {BLOCK} AS block")
    for level in range(LEVELS):
        size, over = ARITY ** level, "OVER (PARTITION BY grp, block ORDER BY pos)"
        near = out.selectExpr(
            "*", *(f"lag(node, {k * size}) {over} AS lag{k}" for k in (2, 1)), *(f"lead(node, {k * size}) {over} AS lead{k}" for k in (1, 2)),
            f"ceil(n / {size}) AS count", f"pos div {size} % {ARITY} AS slot", f"ceil(n / {size}) - pos div {size} AS rest")
        left = ", ".join(f"if(slot >= {k}, lag{k}, '')" for k in (2, 1))
        right = ", ".join(f"if(slot + {k} < {ARITY} AND rest > {k}, lead{k}, '')" for k in (1, 2))
        stands = f"count > 1 AND pos % {size} = 0"
        stepped = near.selectExpr("*", f"if({stands}, struct(concat({left}) AS left, concat({right}) AS right), NULL) AS s{level}")
        raised = f"CASE WHEN count <= 1 THEN node WHEN {stands} AND slot = 0 THEN sha2(concat(node, s{level}.right), 256) END"
        out = stepped.select(*out.drop("node").columns, f"s{level}", F.expr(raised).alias("node"))
    return out


def _tops(nodes: DataFrame) -> DataFrame:
    """The next tier's nodes."""
    return _climb(nodes.select("grp", "pos", "n", "node")).where(F.col("pos") % BLOCK == 0).select(
        "grp", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), "node")


def _descend(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``nodes`` with the path from each up through its tier and then that of its block in ``above`` (grp, pos, path, ...)."""
    upto = "OVER (PARTITION BY grp, block ORDER BY pos ROWS UNBOUNDED PRECEDING)"
    steps = [F.expr(f"last(s{k}, true) {upto} AS s{k}") for k in range(LEVELS)]
    kept = [c for c in nodes.columns if c != "node"]
    own = _climb(nodes.withColumn("start", F.col("node")))
    filled = own.select(*kept, F.col("start").alias("node"), "block", *steps)
    own_path = F.filter(F.array(*(f"s{k}" for k in range(LEVELS))), lambda s: s.isNotNull())
    higher = above.withColumnRenamed("pos", "block").withColumnRenamed("path", "higher")
    return filled.join(higher, ["grp", "block"]).withColumn("path", F.concat(own_path, "higher")).drop(
        "block", "higher", *(f"s{k}" for k in range(LEVELS)))


def _tiers(spark: SparkSession, nodes: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """``nodes`` and the tables of higher tiers, the last of one node a group."""
    out = [nodes]
    while largest > 1:
        out.append(stage_table(spark, _tops(out[-1]), f"{name}-{len(out)}"))
        largest = -(-largest // BLOCK)
    return out


def _paths(spark: SparkSession, tiers: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """The lowest tier with its paths, and the other columns of ``above`` (grp, pos, path, ...), the rows of the highest."""
    if len(tiers) == 1:
        return tiers[0].join(above, ["grp", "pos"])
    for k in range(len(tiers) - 2, 0, -1):
        above = stage_table(spark, _descend(tiers[k], above).drop("node", "n"), f"{name}-{k}")
    return _descend(tiers[0], above)


def prove(spark: SparkSession, leaves: DataFrame) -> DataFrame:
    """``leaves`` (doc_id, grp, leaf, ...), ``grp`` a group as ``written`` writes it, with subroot, root and path:
    the siblings left and right of the row's node on each level, the lowest first."""
    rows, largest = numbered(spark, leaves.withColumn("node", F.col("leaf")),
                             [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()], "merkle-leaves")
    tiers = _tiers(spark, rows, largest, "merkle-tier")
    name = F.when(F.col("grp") != "-", F.expr("substring(grp, instr(grp, ':') + 1)"))
    subroots = tiers[-1].select(F.lit("").alias("grp"), F.col("grp").alias("of"), name.alias("name"), "node")
    groups, count = numbered(spark, subroots, [F.col("name").asc_nulls_first()], "merkle-groups")
    upper = _tiers(spark, groups, count, "merkle-upper")
    top = upper[-1].select("grp", "pos", F.col("node").alias("root"), F.expr(f"cast(array() AS array<{STEP}>)").alias("path"))
    above = _paths(spark, upper, top, "merkle-upper-path").select(
        F.col("of").alias("grp"), F.lit(0).cast("long").alias("pos"), F.col("node").alias("subroot"), "root", "path")
    return _paths(spark, tiers, stage_table(spark, above, "merkle-path"), "merkle-path").drop("node", "n", "pos")


def manifest(spark: SparkSession, docs: DataFrame, fields: list[str], now: dict[str, Column] | None = None,
             id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` for every row: the manifest of ``fields``, and the root
    that the manifest's siblings give with the row as it is ``now`` (field -> its present value; others unchanged)."""
    given = {f: docs[f] for f in fields}
    leaf, claim = leaf_hash(*given.values()), leaf_hash(*(given | (now or {})).values())
    leaves = docs.select(docs[id_col].alias("doc_id"), written(docs[group_col]).alias("grp"), leaf.alias("leaf"),
                         F.when(claim != leaf, claim).alias("claim"))
    proved = prove(spark, stage_table(spark, leaves, "merkle-rows"))
    out = proved.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                        fold(F.coalesce("claim", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

"""Lookup joins.

No side is broadcast by hint and building a join starts no job.  The choice
is left to Catalyst and AQE, which know the bytes: a broadcast when the scan or
shuffle statistics turn out small, else sort-merge with runtime skew
splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.functions.clean import glob_to_regex, trim_lower

MATCH = "__matched"


def normalize_columns(df: DataFrame, trim_cols: Sequence[str], lower_cols: Sequence[str]) -> DataFrame:
    """Trim / lower the listed columns that exist, in one projection."""
    cols = {}
    for c in dict.fromkeys(list(trim_cols) + list(lower_cols)):
        if c in df.columns:
            cols[c] = trim_lower(c, trim=c in trim_cols, lower=c in lower_cols)
    return df.withColumns(cols) if cols else df


def first_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, deterministically the smallest by value (not
    ``dropDuplicates``, which keeps an arbitrary row)."""
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.select(key).distinct()
    picked = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("__row"))
    return picked.select(key, *[F.col("__row")[c].alias(c) for c in rest])


def lookup_join(primary: DataFrame, lookup: DataFrame, key: str, how: str = "left",
                require_match: bool = False, dedupe_lookup: bool = False) -> DataFrame:
    """Equi-join on one (already normalized) key.

    ``require_match`` is the left-join-plus-not-null form, written as an
    inner join.  Duplicate lookup keys fan out (K1) unless ``dedupe_lookup``.
    """
    right = first_row_per_key(lookup, key) if dedupe_lookup else lookup
    join_type = "inner" if (require_match or how == "inner") else "left"
    return primary.join(right, on=key, how=join_type)


def lookup_join_marked(primary: DataFrame, lookup: DataFrame, key: str, dedupe_lookup: bool = False) -> DataFrame:
    """Left join carrying a ``__matched`` flag: matched rows (fanned out like
    an inner join) and unmatched rows come out of one pass over the primary,
    so the quarantine of unmatched rows needs no second scan."""
    right = first_row_per_key(lookup, key) if dedupe_lookup else lookup
    right = right.withColumn(MATCH, F.lit(True))
    return primary.join(right, on=key, how="left").withColumn(MATCH, F.coalesce(F.col(MATCH), F.lit(False)))


def unmatched_rows(primary: DataFrame, lookup: DataFrame, key: str, reason: str | None = None) -> DataFrame:
    """Primary rows with no lookup match (null keys included)."""
    keys = lookup.select(key).where(F.col(key).isNotNull()).distinct()
    out = primary.join(keys, on=key, how="left_anti")
    return out.withColumn("quarantine_reason", F.lit(reason)) if reason else out


def _spec_items(specs: dict[str, list]) -> list[tuple[str, str, str, int, int]]:
    """(client, file_type, pattern, specificity, spec_order) for every pattern."""
    out = []
    for client, items in specs.items():
        for order, item in enumerate(items):
            if isinstance(item, str):
                item = {"file_type": item, "patterns": [item]}
            for pattern in item.get("patterns", []):
                literal = sum(1 for ch in pattern if ch not in "*?[]")
                out.append((client, item.get("file_type") or pattern, pattern, literal, order))
    return out


def file_type_column(specs: dict[str, list], name_col: str = "file_name",
                     client_col: str = "client_name", exclusive: bool = True):
    """J7 / D6 as a projection: glob patterns compiled to anchored,
    case-insensitive regexes (fnmatch semantics on the lower-cased name).

    ``exclusive`` (K12 fixed): the most specific matching pattern wins (more
    literal characters; ties go to the earlier spec), so one file satisfies
    one spec.  Otherwise an array of every spec type the file satisfies.
    A ``CASE`` branch a pattern inside codegen, no join and no shuffle: for the
    few patterns of declared specs.  Tables of patterns go through ``globs.match_globs``.
    """
    name = F.lower(F.col(name_col))
    items = _spec_items(specs)
    if exclusive:
        ranked = sorted(items, key=lambda t: (-t[3], t[4]))
        expr = None
        for client, ftype, pattern, _, _ in ranked:
            cond = (F.col(client_col) == client) & name.rlike(glob_to_regex(pattern.lower()))
            expr = F.when(cond, F.lit(ftype)) if expr is None else expr.when(cond, F.lit(ftype))
        return expr if expr is not None else F.lit(None).cast("string")
    hits = [F.when((F.col(client_col) == c) & name.rlike(glob_to_regex(p.lower())), F.lit(t))
            for c, t, p, _, _ in items]
    return F.array_distinct(F.array_compact(F.array(*hits))) if hits else F.array().cast("array<string>")


def match_file_type(files: DataFrame, specs: dict[str, list], name_col: str = "file_name",
                    client_col: str = "client_name", exclusive: bool = True) -> DataFrame:
    """Files with the spec type they satisfy; unmatched files dropped.
    Non-exclusive matching yields one row per satisfied type.  The specs go in as a
    table of patterns (``globs.match_globs``), so their number is not bounded by an expression's size."""
    from ferrule.operators.globs import SMALL, match_globs, pattern_table
    small = sum(64 + len(c) + len(t) + len(p) for c, t, p, _, _ in _spec_items(specs)) <= SMALL
    return match_globs(files, pattern_table(files.sparkSession, specs), name_col, client_col, exclusive, small)

"""Filters, reason arrays and good/bad splits.

A split is one frame with a ``quarantine_reasons`` array column; the good and
bad sides are two filters over it, so they are computed from the same plan
(and can be written once, partitioned by ``is_quarantined``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "quarantine_reasons"
FENCE = "__fence"


def fenced_where(df: DataFrame, condition: Column) -> DataFrame:
    """Filter evaluated above the projection that computes its inputs.

    Catalyst pushes a deterministic filter below projections by inlining the
    aliases it references.  With chained SQL-text columns (a derived column
    reading three others, each a regex + cast) that copies the expensive
    expressions into the filter many times over — the beta balance rule
    became 31 regex evaluations per row.  Referencing a
    ``spark_partition_id()`` column (always >= 0) in the condition keeps the
    filter above that projection, where every derived value is computed
    once.  The fence column is dropped afterwards.
    """
    fenced = df if FENCE in df.columns else df.withColumn(FENCE, F.spark_partition_id())
    return fenced.where(condition & (F.col(FENCE) >= 0)).drop(FENCE)


def passes(expression: str | Column) -> Column:
    """A predicate where null counts as failing (filter semantics)."""
    c = F.expr(expression) if isinstance(expression, str) else expression
    return F.coalesce(c, F.lit(False))


def apply_filters(df: DataFrame, expressions: Sequence[str], fence: bool = True) -> DataFrame:
    """conjunction of SQL predicates.  With ``fence`` the predicates are
    evaluated on the computed columns (see ``fenced_where``); without it
    Catalyst pushes them toward the scan."""
    if not expressions:
        return df
    cond = reduce(lambda a, b: a & b, [F.expr(e) for e in expressions])
    return fenced_where(df, cond) if fence else df.filter(cond)


def balance_check(parts: Sequence[str | Column], whole: str | Column, scale: int = 6) -> Column:
    """rounded sum of the parts equals the rounded whole (null fails)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    w = F.col(whole) if isinstance(whole, str) else whole
    return passes(F.round(reduce(lambda a, b: a + b, cols), scale) == F.round(w, scale))


def failed_filter_reason(expressions: Sequence[str], reasons: dict[str, str] | None = None) -> Column:
    """Reason for the first failing filter expression (null when all pass)."""
    reasons = reasons or {}
    out = None
    for e in expressions:
        cond = ~passes(e)
        val = F.lit(reasons.get(e, f"failed_filter: {e}"))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out if out is not None else F.lit(None).cast("string")


def reason_array(rules: Sequence[tuple[Column, str]]) -> Column:
    """Array of the reasons whose rule fires (rules are null-safe booleans)."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(F.coalesce(r, F.lit(False)), F.lit(reason)) for r, reason in rules]))


def partner_rules(df: DataFrame, required: Sequence[str], non_negative: Sequence[str],
                  date_columns: Sequence[str], date_formats: Sequence[str] = ("yyyy-MM-dd",)) -> list[tuple[Column, str]]:
    """Q1 rules: required null (absent column ⇒ every row), negative number,
    non-null value that is not a date."""
    from ferrule.functions.clean import parse_multi_date
    rules: list[tuple[Column, str]] = []
    for c in required:
        rules.append((F.col(c).isNull() if c in df.columns else F.lit(True), f"missing_required:{c}"))
    for c in non_negative:
        if c in df.columns:
            rules.append((F.col(c).cast("string").try_cast("double") < 0, f"negative_value:{c}"))
    for c in date_columns:
        if c in df.columns:
            bad = F.col(c).isNotNull() & parse_multi_date(F.col(c), date_formats, formatless_fallback=True).isNull()
            rules.append((bad, f"invalid_date:{c}"))
    return rules


def with_reasons(df: DataFrame, rules: Sequence[tuple[Column, str]]) -> DataFrame:
    return df.withColumn(REASONS, reason_array(rules))


def good_rows(flagged: DataFrame) -> DataFrame:
    return fenced_where(flagged, F.size(REASONS) == 0).drop(REASONS)


def bad_rows(flagged: DataFrame) -> DataFrame:
    return fenced_where(flagged, F.size(REASONS) > 0).withColumn("quarantine_reason", F.array_join(REASONS, ";"))


def declared_rules(rules: Sequence[dict]) -> list[tuple[Column, str]]:
    """Q3: ``{condition, reason}`` rules evaluated null-safely."""
    return [(passes(r["condition"]), r.get("reason") or r.get("name") or "rule") for r in rules
            if r.get("condition")]


def post_processing(df: DataFrame, spec: dict, global_sort: bool = False) -> DataFrame:
    """Q4: rename, filter, then sort.

    Sorting is within partitions by default (what a partitioned writer
    needs for row-group clustering); ``global_sort`` asks for a total order,
    which is a range-partitioned shuffle.
    """
    out = df
    renames = {s: d for s, d in (spec.get("column_renaming") or {}).items() if s in out.columns and s != d}
    if renames:
        out = out.withColumnsRenamed(renames)
    for e in spec.get("filtering_rules") or []:
        out = out.filter(F.expr(e))
    order = []
    for r in spec.get("sorting_rules") or []:
        c = r["column"]
        if c not in out.columns and c == "date" and "order_date" in out.columns:
            c = "order_date"
        col = F.col(c)
        order.append(col.desc_nulls_last() if str(r.get("direction", "asc")).lower() == "desc"
                     else col.asc_nulls_first())
    if order:
        out = out.orderBy(*order) if global_sort else out.sortWithinPartitions(*order)
    return out

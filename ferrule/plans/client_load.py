"""Client upload load: raw primary + lookup → processed rows, quarantine, drift.

Order of the steps follows the client transform: headers → renames →
trim/lower → lookup join → fill nulls → derived columns → filters → output
mapping → aggregation → final schema.  The result is one lazy plan; nothing
is collected.  Quarantine rows come from the same plan (unmatched lookup keys
and failed filters) with a reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.functions.clean import parse_multi_date
from ferrule.operators.aggregate import aggregate
from ferrule.operators.conform import (conform_final, derived_columns, enforce_final_schema, map_output_columns,
                                       normalize_headers, safe_rename, schema_drift)
from ferrule.operators.lookup import MATCH, lookup_join_marked, normalize_columns
from ferrule.operators.rules import declared_rules, failed_filter_reason, fenced_where, post_processing, reason_array
from ferrule.sources.tables import CLIENT_PROCESSED_SCHEMA
from ferrule.spec import ClientSpec


@dataclass(frozen=True)
class LoadContext:
    client_name: str
    load_id: str
    event_date: str
    event_name: str = "ObjectCreated"


@dataclass
class LoadResult:
    processed: DataFrame          # final 8-column schema
    aggregated: DataFrame         # spec aggregation before conformance (keeps K4 columns)
    passed: DataFrame             # row-level rows that reached the aggregation
    quarantine: DataFrame         # rejected rows with quarantine_reason
    misfits: DataFrame            # aggregated rows with a value outside its final type, with a reason
    drift: DataFrame              # one-row input drift report


def common_cleaning(df: DataFrame, cfg: dict) -> DataFrame:
    """C13 (opt-in): the declared cleaning blocks — date parsing, number
    cleanup, text normalization, fill defaults, drop-when-missing."""
    out = df
    tn = cfg.get("text_normalization") or {}
    out = normalize_columns(out, tn.get("trim_columns", []), tn.get("lowercase_columns", []))
    nc = cfg.get("numeric_cleaning") or {}
    for c in nc.get("target_columns", []):
        if c in out.columns:
            v = F.trim(F.col(c).cast("string"))
            if nc.get("remove_currency_symbols"):
                v = F.regexp_replace(v, r"[$€£¥]", "")
            if nc.get("normalize_decimal_separator", ".") == ",":
                v = F.regexp_replace(F.regexp_replace(v, r"\.", ""), ",", ".")
            elif nc.get("remove_thousands_separators"):
                v = F.regexp_replace(v, ",", "")
            # stays text: the spec's own cast reads it later, and a double
            # rendered back to text (1.2E7) would be corrupted by its regex
            out = out.withColumn(c, v)
    mv = cfg.get("missing_value_strategy") or {}
    fills = {k: v for k, v in (mv.get("fill_defaults") or {}).items() if k in out.columns}
    if fills:
        out = out.fillna(fills)
    drop = [c for c in mv.get("drop_rows_when_missing", []) if c in out.columns]
    if drop:
        out = out.dropna(subset=drop)
    dp = cfg.get("date_parsing_rules") or {}
    src = dp.get("source_column")
    if src and src in out.columns and dp.get("accepted_formats"):
        out = out.withColumn(dp.get("target_column", "date"), parse_multi_date(src, dp["accepted_formats"]))
    return out


def run_client_load(spark: SparkSession, spec: ClientSpec, primary: DataFrame, lookup: DataFrame,
                    ctx: LoadContext, dedupe_lookup: bool = False, drift_post_agg: bool = False,
                    apply_common_cleaning: bool = False, apply_quarantine_rules: bool = False,
                    apply_post_processing: bool = False) -> LoadResult:
    primary = normalize_headers(primary)
    lookup = normalize_headers(lookup)
    expected_input = list(spec.rename_columns)
    drift_in = schema_drift(spark, primary.columns, expected_input, ctx.client_name)

    primary = safe_rename(primary, spec.rename_columns)
    lookup = safe_rename(lookup, spec.join.column_mapping)
    trim_cols, lower_cols = spec.trim_lower_columns()
    primary = normalize_columns(primary, trim_cols, lower_cols)
    lookup = normalize_columns(lookup, trim_cols, lower_cols)
    if apply_common_cleaning:
        primary = common_cleaning(primary, spec.common_cleaning)

    key = spec.join.key
    marked = lookup_join_marked(primary, lookup, key, dedupe_lookup=dedupe_lookup)
    keep_unmatched = spec.join.how != "inner" and not spec.join.quarantine_on_unmatched
    joined = marked if keep_unmatched else marked.where(F.col(MATCH))
    joined = joined.drop(MATCH)
    fills = {k: v for k, v in spec.fill_nulls.items() if k in joined.columns}
    if fills:
        joined = joined.fillna(fills)
    joined = derived_columns(joined, spec.derived_columns)

    reason = failed_filter_reason(spec.filter_expressions, spec.filter_reasons)
    if apply_quarantine_rules and spec.quarantine_rules:
        # declared rules see the output mapping (e.g. discount_code)
        mapped = map_output_columns(joined, spec.post_join_columns)
        rules_hit = reason_array(declared_rules(spec.quarantine_rules))
        joined = mapped.withColumn("__rule_reason", F.element_at(rules_hit, 1))
        reason = F.coalesce(reason, F.col("__rule_reason"))
    flagged = joined.withColumn("quarantine_reason", reason)
    passed = fenced_where(flagged, F.col("quarantine_reason").isNull()).drop("quarantine_reason", "__rule_reason")
    passed = map_output_columns(passed, spec.post_join_columns)

    primary_cols = primary.columns
    rejected_filter = fenced_where(flagged, F.col("quarantine_reason").isNotNull()).select(
        *primary_cols, "quarantine_reason")
    quarantine = rejected_filter
    if spec.join.quarantine_on_unmatched:
        unmatched = marked.where(~F.col(MATCH)).select(*primary_cols).withColumn(
            "quarantine_reason", F.lit(spec.join.quarantine_reason))
        quarantine = unmatched.unionByName(rejected_filter)
    quarantine = quarantine.withColumns({"client_name": F.lit(ctx.client_name), "load_id": F.lit(ctx.load_id)})

    agg = spec.aggregation
    aggregated = aggregate(passed, agg.group_by, agg.metrics)
    processed = enforce_final_schema(aggregated, ctx.client_name, ctx.load_id, ctx.event_date, ctx.event_name)
    misfits = fenced_where(conform_final(aggregated, ctx.client_name, ctx.load_id, ctx.event_date, ctx.event_name),
                           F.size("quarantine_reasons") > 0).withColumn(
        "quarantine_reason", F.array_join("quarantine_reasons", ";")).drop("quarantine_reasons")
    if apply_post_processing and spec.post_processing:
        processed = post_processing(processed, spec.post_processing)
    if drift_post_agg:
        drift_in = schema_drift(spark, aggregated.columns, [f.name for f in CLIENT_PROCESSED_SCHEMA.fields],
                                ctx.client_name)
    return LoadResult(processed=processed, aggregated=aggregated, passed=passed, quarantine=quarantine,
                      misfits=misfits, drift=drift_in)


__all__ = ["LoadContext", "LoadResult", "run_client_load", "common_cleaning"]

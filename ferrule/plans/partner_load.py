"""Partner feed load: raw CSV strings → processed rows + quarantine.

The step order is fixed (dedupe and quarantine see cleaned, defaulted and
derived values): rename → audit columns → canonical date → drop date
sources → text cleaning → number cleaning → defaults → ratios → optional
exact dedupe → rule split → column order.  One lazy plan over any number of
raw files; the pandas single-process transform becomes Spark projections
plus one aggregation-backed ``dropDuplicates``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.functions.clean import canonical_date, clean_number_tokens, clean_text, null_na_tokens, safe_ratio
from ferrule.operators.conform import audit_columns, drop_present, reorder_loose, reorder_strict, safe_rename
from ferrule.operators.rules import bad_rows, good_rows, partner_rules, with_reasons
from ferrule.sources.tables import PARTNER_PROCESSED_SCHEMA
from ferrule.spec import PartnerSpec


@dataclass(frozen=True)
class BatchContext:
    batch_id: str
    run_id: str
    source_key: str
    processed_at: str
    start_date: str | None = None
    end_date: str | None = None


@dataclass
class PartnerResult:
    processed: DataFrame
    quarantine: DataFrame
    cleaned: DataFrame       # every row after ratios/dedupe, before the split
    flagged: DataFrame       # the same with quarantine_reasons, for sinks.write_split: one run, both sides


def apply_text_cleaning(df: DataFrame, spec: PartnerSpec) -> DataFrame:
    cols = {c: clean_text(c, spec.trim_text, spec.empty_to_null, spec.null_tokens)
            for c in spec.text_columns if c in df.columns}
    return df.withColumns(cols) if cols else df


def apply_numeric_cleaning(df: DataFrame, spec: PartnerSpec) -> DataFrame:
    cols = {c: clean_number_tokens(c, spec.null_tokens) for c in spec.numeric_columns if c in df.columns}
    return df.withColumns(cols) if cols else df


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill nulls with the default, or create the column with it."""
    cols = {c: (F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v)) for c, v in defaults.items()}
    return df.withColumns(cols) if cols else df


def apply_ratios(df: DataFrame) -> DataFrame:
    """The three safe ratios (absent inputs count as null)."""
    def col(c):
        return F.col(c) if c in df.columns else F.lit(None).cast("double")
    return df.withColumns({
        "revenue_per_order": safe_ratio(col("revenue"), col("orders")),
        "revenue_per_impression": safe_ratio(col("revenue"), col("impressions")),
        "impressions_per_order": safe_ratio(col("impressions"), col("orders")),
    })


def run_partner_load(spec: PartnerSpec, raw: DataFrame, ctx: BatchContext) -> PartnerResult:
    # The partner file's reader takes the default NA tokens as missing
    text = [f.name for f in raw.schema.fields if f.dataType.simpleString() == "string"]
    raw = raw.select(*[null_na_tokens(c).alias(c) if c in text else F.col(c) for c in raw.columns])
    df = safe_rename(raw, spec.rename_columns)
    df = audit_columns(df, {"source_type": spec.source_type, "batch_id": ctx.batch_id, "run_id": ctx.run_id,
                            "source_key": ctx.source_key, "processed_at": ctx.processed_at})
    sources = [c for c in spec.date_priority if c in df.columns]
    df = df.withColumn(spec.date_target, canonical_date(sources, spec.date_formats))
    df = drop_present(df, spec.drop_after_derive)
    df = apply_text_cleaning(df, spec)
    df = apply_numeric_cleaning(df, spec)
    df = apply_defaults(df, spec.defaults)
    df = apply_ratios(df)
    if spec.deduplicate:
        df = df.dropDuplicates()
    flagged = with_reasons(df, partner_rules(df, spec.required_columns, spec.non_negative_columns,
                                             spec.date_columns, spec.date_formats))
    final = list(spec.final_schema) or [f.name for f in PARTNER_PROCESSED_SCHEMA.fields]
    types = {f.name: f.dataType for f in PARTNER_PROCESSED_SCHEMA.fields}
    good = reorder_strict(good_rows(flagged), final)
    good = good.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in final])
    bad = reorder_loose(bad_rows(flagged).drop("quarantine_reasons"), final)
    return PartnerResult(processed=good, quarantine=bad, cleaned=df, flagged=flagged)

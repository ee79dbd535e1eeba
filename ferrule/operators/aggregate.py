"""Spec-driven aggregation (A1) and load bounds.

``groupBy().agg()`` plans as partial + final hash aggregation, so a hot
group key (a third of all rows) is combined map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions.clean import money_sum
from ferrule.spec import Metric


def metric_column(m: Metric) -> Column:
    if m.function == "sum":
        c = money_sum(m.column) if m.decimal_scale is not None else F.sum(F.col(m.column))
    elif m.function == "count":
        c = F.count(F.col(m.column))
    elif m.function == "count_distinct":
        c = F.count_distinct(F.col(m.column))
    else:
        raise ValueError(f"Unsupported aggregation function: {m.function}")
    return c.alias(m.alias)


def aggregate(df: DataFrame, group_by: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """A1: group by the spec keys with sum / count / count_distinct."""
    return df.groupBy(*group_by).agg(*[metric_column(m) for m in metrics])


def load_bounds(df: DataFrame, client_col: str = "client_name", date_col: str = "order_date") -> DataFrame:
    """Per-client min / max date of one load."""
    return df.groupBy(client_col).agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))

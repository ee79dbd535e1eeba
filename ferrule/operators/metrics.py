"""Dashboard metrics: KPI totals, daily / monthly series, breakdowns, detail pages.

Each function takes a fact ``DataFrame`` and typed arguments, validates the
arguments before any plan is built (F9), and returns a lazy ``DataFrame``.
Filters are plain column predicates, so on a Parquet-backed fact they reach
the scan as ``PushedFilters`` and partition filters.
"""

from __future__ import annotations

import datetime as _dt
import itertools
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ferrule.functions.clean import money_sum

# --- fixed values: argument domains of the dashboard ------------------------
CLIENT_DOMAIN = "client_upload"
PARTNER_DOMAIN = "adscribe"
DOMAIN_ALIASES = {"client_upload": "client_upload", "adscribe": "adscribe", "ascribe": "adscribe"}
ALLOWED_CLIENTS = ("all", "alpha", "beta", "gamma")
ALLOWED_SORT_ORDER = ("asc", "desc")
DATE_COLUMN = {CLIENT_DOMAIN: "order_date", PARTNER_DOMAIN: "date"}
BREAKDOWN_DIMENSIONS = {
    CLIENT_DOMAIN: {"discount_code": "discount_code"},
    PARTNER_DOMAIN: {"client_name": "client_name", "show_name": "show_name", "discount_code": "discount_code"},
}
DIMENSION_ALIASES = {"show": "show_name", "product": "product"}
DETAIL_SORT_FIELDS = {
    CLIENT_DOMAIN: {"date": "order_date", "order_date": "order_date", "client": "client_name",
                    "client_name": "client_name", "discount_code": "discount_code",
                    "revenue": "revenue", "orders": "orders"},
    PARTNER_DOMAIN: {"date": "date", "client": "client_name", "client_name": "client_name",
                     "show": "show_name", "show_name": "show_name", "discount_code": "discount_code",
                     "revenue": "revenue", "orders": "orders", "impressions": "impressions",
                     "revenue_per_order": "revenue_per_order",
                     "revenue_per_impression": "revenue_per_impression",
                     "impressions_per_order": "impressions_per_order"},
}
DETAIL_IDENT = {CLIENT_DOMAIN: ["order_date", "client_name", "discount_code"],
                PARTNER_DOMAIN: ["date", "client_name", "show_name", "discount_code"]}
DEFAULT_LIMIT, MAX_LIMIT, MAX_TOP_N = 50, 500, 500
# ---------------------------------------------------------------------------


class ValidationError(ValueError):
    """An argument outside its allowed domain (raised before planning)."""


def _choice(field: str, given: str | None, default: str, values: dict[str, str]) -> str:
    """The value that ``given`` (any case, blanks around it) stands for among ``values``."""
    name = str(given or default).strip().lower()
    if name not in values:
        raise ValidationError(f"{field}: {name!r} is none of {', '.join(sorted(values))}")
    return values[name]


def _whole(field: str, given: int | str | None, default: int, least: int, most: int | None) -> int:
    number = default if given is None else int(given)
    if number < least or (most is not None and number > most):
        raise ValidationError(f"{field}: {number} is not in {least}..{'' if most is None else most}")
    return number


def _day(field: str, given: str | None) -> str | None:
    if not given:
        return None
    try:
        return _dt.datetime.strptime(str(given), "%Y-%m-%d").date().isoformat()
    except ValueError:
        raise ValidationError(f"{field}: {given!r} is no day written YYYY-MM-DD") from None


def parse_domain(domain: str | None) -> str:
    return _choice("domain", domain, CLIENT_DOMAIN, DOMAIN_ALIASES)


def parse_dates(start_date: str | None, end_date: str | None, domain: str) -> tuple[str | None, str | None]:
    days = [_day(field, v) for field, v in (("start_date", start_date), ("end_date", end_date))]
    if domain == PARTNER_DOMAIN and None in days:
        raise ValidationError(f"start_date, end_date: both required with domain {domain!r}")
    if None not in days and days != sorted(days):
        raise ValidationError(f"start_date: {days[0]} is after end_date {days[1]}")
    return days[0], days[1]


def parse_client(client: str | None, domain: str) -> str:
    if domain != CLIENT_DOMAIN:
        return str(client or "all").strip().lower()
    return _choice("client", client, "all", {c: c for c in ALLOWED_CLIENTS})


def parse_pagination(limit: int | str | None, offset: int | str | None) -> tuple[int, int]:
    return _whole("limit", limit, DEFAULT_LIMIT, 1, MAX_LIMIT), _whole("offset", offset, 0, 0, None)


def parse_sort_order(order: str | None) -> str:
    return _choice("sort_order", order, "desc", {o: o for o in ALLOWED_SORT_ORDER})


def parse_sort_by(sort_by: str | None, domain: str) -> str:
    return _choice(f"sort_by ({domain})", sort_by, "date", DETAIL_SORT_FIELDS[domain])


def parse_dimension(dimension: str | None, domain: str) -> str:
    columns = BREAKDOWN_DIMENSIONS[domain]
    other_names = {alias: columns[name] for alias, name in DIMENSION_ALIASES.items() if name in columns}
    return _choice(f"dimension ({domain})", dimension, "discount_code", columns | other_names)


def parse_top_n(top_n: int | str | None) -> int | None:
    return None if top_n in (None, "") else _whole("top_n", top_n, 1, 1, MAX_TOP_N)


def _clean_opt(v: str | None) -> str | None:
    return (v or "").strip() or None


def dashboard_predicate(domain: str, start_date: str | None = None, end_date: str | None = None,
                        client: str | None = "all", client_name: str | None = None,
                        show_name: str | None = None, discount_code: str | None = None) -> Column:
    """the conjunction of the optional filters (``lit(True)`` when none)."""
    domain = parse_domain(domain)
    s, e = parse_dates(start_date, end_date, domain)
    date_col = F.col(DATE_COLUMN[domain])
    conds: list[Column] = []
    if s:
        conds.append(date_col >= F.lit(s).cast("date"))
    if e:
        conds.append(date_col <= F.lit(e).cast("date"))
    if domain == CLIENT_DOMAIN:
        c = parse_client(client, domain)
        if c != "all":
            conds.append(F.col("client_name") == F.lit(c))
    else:
        for name, value in (("client_name", client_name), ("show_name", show_name),
                            ("discount_code", discount_code)):
            v = _clean_opt(value)
            if v:
                conds.append(F.col(name) == F.lit(v))
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def dashboard_filter(fact: DataFrame, domain: str, **filters) -> DataFrame:
    pred = dashboard_predicate(domain, **filters)
    return fact.filter(pred)


def kpi(fact: DataFrame, domain: str = CLIENT_DOMAIN, **filters) -> DataFrame:
    """A2: one row of totals, zeros on empty input."""
    domain = parse_domain(domain)
    f = dashboard_filter(fact, domain, **filters)
    aggs = [F.coalesce(money_sum("revenue"), F.lit(0.0)).alias("total_revenue"),
            F.coalesce(F.sum("orders"), F.lit(0).cast(f.schema["orders"].dataType)).alias("total_orders")]
    if domain == PARTNER_DOMAIN:
        aggs.append(F.coalesce(F.sum("impressions"), F.lit(0.0)).alias("total_impressions"))
    return f.agg(*aggs)


def revenue_daily(fact: DataFrame, domain: str = CLIENT_DOMAIN, **filters) -> DataFrame:
    """A3 + L3: revenue per day, ordered by day."""
    domain = parse_domain(domain)
    d = DATE_COLUMN[domain]
    f = dashboard_filter(fact, domain, **filters)
    return (f.groupBy(F.col(d).alias("date"))
            .agg(F.coalesce(money_sum("revenue"), F.lit(0.0)).alias("revenue"))
            .orderBy(F.col("date").asc_nulls_last()))


def revenue_monthly(fact: DataFrame, domain: str = CLIENT_DOMAIN, **filters) -> DataFrame:
    """A4 + L3: revenue per calendar month labelled ``yyyy-MM``."""
    domain = parse_domain(domain)
    d = DATE_COLUMN[domain]
    f = dashboard_filter(fact, domain, **filters)
    return (f.groupBy(F.date_format(F.trunc(F.col(d), "MM"), "yyyy-MM").alias("month"))
            .agg(F.coalesce(money_sum("revenue"), F.lit(0.0)).alias("revenue"))
            .orderBy(F.col("month").asc_nulls_last()))


def breakdown(fact: DataFrame, domain: str = CLIENT_DOMAIN, dimension: str | None = None,
              top_n: int | None = None, null_label: str | None = "UNKNOWN",
              with_impressions: bool = True, **filters) -> DataFrame:
    """Totals by one dimension, largest revenue first.

    ``null_label=None`` keeps null keys as null (the older form, A7, which
    also omits impressions and names the key ``group_key``).  Partner
    impressions are summed (K9 fixed).
    """
    domain = parse_domain(domain)
    dim = parse_dimension(dimension, domain)
    n = parse_top_n(top_n)
    f = dashboard_filter(fact, domain, **filters)
    if null_label is None:
        key = F.col(dim).cast("string").alias("group_key")
        key_name = "group_key"
    else:
        key = F.coalesce(F.col(dim).cast("string"), F.lit(null_label)).alias("key")
        key_name = "key"
    orders_zero = F.lit(0).cast(f.schema["orders"].dataType)
    aggs = [F.coalesce(money_sum("revenue"), F.lit(0.0)).alias("revenue"),
            F.coalesce(F.sum("orders"), orders_zero).alias("orders")]
    if null_label is not None and with_impressions:
        if domain == PARTNER_DOMAIN:
            aggs.append(F.coalesce(F.sum("impressions"), F.lit(0.0)).alias("impressions"))
        else:
            aggs.append(F.lit(None).cast("double").alias("impressions"))
    out = (f.groupBy(key).agg(*aggs)
           .orderBy(F.col("revenue").desc_nulls_first(), F.col(key_name).asc_nulls_first()))
    return out.limit(n) if n is not None else out


class PageEnd(NamedTuple):
    """Where a page ends: the last row's place in the order (``page_key``), and how many rows with that very key have been shown."""
    key: tuple
    shown: int


def page_end(rows: list[Row], before: PageEnd | None = None) -> PageEnd | None:
    """The end of a page read with ``keyed=True``, ``before`` the end of the page before it; pass it on as ``after``."""
    if not rows:
        return before
    keys = [tuple(r["page_key"]) for r in rows]
    alike = len(list(itertools.takewhile(lambda k: k == keys[-1], reversed(keys))))
    carried = before.shown if before and alike == len(keys) and before.key == keys[-1] else 0
    return PageEnd(keys[-1], alike + carried)


def _beyond(keys: list[tuple[Column, bool]], last: tuple, itself: bool = False) -> Column:
    """Rows after ``last`` (and with ``itself`` those at it) in an order by ``keys``, (column, descending): nulls
    come first in a descending key and last in an ascending one."""
    out, equal = F.lit(False), F.lit(True)
    for (column, descending), value in zip(keys, last, strict=True):
        v = F.lit(value)
        if descending:
            later = column.isNotNull() if value is None else F.coalesce(column < v, F.lit(False))
        else:
            later = F.lit(False) if value is None else (column.isNull() | (column > v))
        out = out | (equal & later)
        equal = equal & column.eqNullSafe(v)
    return out | equal if itself else out


CLIENT_DETAIL_COLUMNS = ["date", "client_name", "discount_code", "revenue", "orders"]
PARTNER_DETAIL_COLUMNS = ["date", "client_name", "show_name", "revenue", "orders", "impressions",
                          "revenue_per_order", "revenue_per_impression", "impressions_per_order"]


def details(fact: DataFrame, domain: str = CLIENT_DOMAIN, sort_by: str | None = "date",
            sort_order: str | None = "desc", limit: int | None = DEFAULT_LIMIT, offset: int | None = 0,
            client_label: str = "client_name", after: PageEnd | None = None, keyed: bool = False, **filters) -> DataFrame:
    """L1 / L4 + P16: one page of detail rows.

    Sorted by the whitelisted column (nulls first on DESC, last on ASC, like
    the warehouse), then by the row's identifying columns, then by 96 bits of hashes of all its columns,
    so that only rows that are equal in every column share a place.  Plans as a TakeOrderedAndProject: each task keeps
    ``offset + limit`` rows.  For pages far into the result read with ``keyed=True`` (a last column ``page_key``)
    and pass ``after``, the ``page_end`` of the page before, instead of an offset: the rows before it are filtered out, those that share its key
    are skipped by their number, and each task keeps ``limit`` rows and that number.  Pages of any size give each row of a fact once.
    """
    domain = parse_domain(domain)
    lim, off = parse_pagination(limit, offset)
    order = parse_sort_order(sort_order)
    sort_col = parse_sort_by(sort_by, domain)
    f = dashboard_filter(fact, domain, **filters)
    if domain == CLIENT_DOMAIN:
        proj = {"date": F.col("order_date"), client_label: F.col("client_name"),
                "discount_code": F.col("discount_code"),
                "revenue": F.coalesce("revenue", F.lit(0.0)), "orders": F.coalesce("orders", F.lit(0))}
    else:
        proj = {"date": F.col("date"), client_label: F.col("client_name"), "show_name": F.col("show_name")}
        proj.update({c: F.coalesce(c, F.lit(0.0)) for c in PARTNER_DETAIL_COLUMNS[3:]})
    ident, out_names = DETAIL_IDENT[domain], list(proj)
    # ORDER BY resolves output aliases first (so revenue sorts by the
    # null-as-zero value); other names fall back to the input columns.
    extras = [c for c in dict.fromkeys([sort_col] + ident) if c not in out_names]
    marks = [F.col(c).isNull() for c in f.columns]
    digest = {"__d1": F.xxhash64(*f.columns, *marks), "__d2": F.hash(*f.columns, *marks)}
    paged = f.select(*[c.alias(n) for n, c in proj.items()], *[F.col(c).alias(f"__s_{c}") for c in extras],
                     *[c.alias(n) for n, c in digest.items()])

    def ref(c: str) -> Column:
        return F.col(c) if c in out_names else F.col(f"__s_{c}")

    keys = [(ref(sort_col), order == "desc")] + [(ref(c), False) for c in ident if c != sort_col] + [(F.col(d), False) for d in digest]
    if after is not None:
        paged, off = paged.where(_beyond(keys, after.key, True)), off + after.shown
    shown = [*out_names, F.struct(*(c.alias(f"k{i}") for i, (c, _) in enumerate(keys))).alias("page_key")] if keyed else out_names
    ordered = paged.orderBy(*(c.desc_nulls_first() if down else c.asc_nulls_last() for c, down in keys))
    return ordered.offset(off).limit(lim).select(*shown)

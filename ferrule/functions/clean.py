"""Column-in / Column-out cleaning functions (no actions, no UDFs).

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so the
expressions stay inside whole-stage codegen.  ANSI mode stays on; tolerant
parsing uses the ``try_*`` family.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Strings pandas' CSV reader turns into a missing value by default.
PANDAS_DEFAULT_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Truthy spellings of a boolean flag.
TRUTHY_STRINGS = ("1", "true", "yes", "y", "on")
# A plain decimal number, optionally signed, optionally with an exponent.
NUMERIC_TEXT_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Digits after the point that money sums keep; 20 remain before it.
MONEY_SCALE = 18
# Characters kept by the spec-level number cleaner.
SPEC_NUMBER_STRIP_PATTERN = r"[^0-9.\-]"
# ---------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_lower(col: Column | str, trim: bool = True, lower: bool = True) -> Column:
    """Trim and/or lower-case a value (cast to string first)."""
    out = _c(col).cast("string")
    if trim:
        out = F.trim(out)
    if lower:
        out = F.lower(out)
    return out


def date_shape(fmt: str) -> str | None:
    """The texts a purely numeric date format can parse, as a pattern; None for other formats."""
    parts = re.findall(r"y+|M+|d+|[^yMd]", fmt)
    out = []
    for p in parts:
        if p == "yyyy":
            out.append(r"\+?[0-9]{4,}")
        elif p in ("MM", "dd"):
            out.append("[0-9]{2}")
        elif p in ("M", "d"):
            out.append("[0-9]+")
        elif p in "/-. ":
            out.append("[" + ("\\-" if p == "-" else p) + "]")
        else:
            return None
    return "^" + "".join(out) + "$"


def parse_multi_date(col: Column | str, formats: Sequence[str], formatless_fallback: bool = True) -> Column:
    """C4: first format that parses wins; optionally a format-less last try.  A
    numeric format is tried only on texts of its shape, since a failed
    parse costs an exception."""
    c = _c(col).cast("string")
    attempts = []
    for f in formats:
        shape = date_shape(f)
        attempt = F.try_to_date(c, f)
        attempts.append(F.when(c.rlike(shape), attempt) if shape else attempt)
    if formatless_fallback:
        attempts.append(F.when(c.rlike(r"^\s*[+-]?[0-9]{4}"), F.try_to_date(c)))
    return F.coalesce(*attempts) if len(attempts) > 1 else attempts[0]


def canonical_date(cols: Sequence[Column | str], formats: Sequence[str]) -> Column:
    """Date from the first source column (in priority order) that parses,
    rendered as a ``yyyy-MM-dd`` string; null when none parses."""
    parsed = [parse_multi_date(c, formats, formatless_fallback=False) for c in cols]
    if not parsed:
        return F.lit(None).cast("string")
    picked = F.coalesce(*parsed) if len(parsed) > 1 else parsed[0]
    return F.date_format(picked, "yyyy-MM-dd")


def clean_text(col: Column | str, trim: bool = True, empty_to_null: bool = True,
               null_tokens: Iterable[str] = ()) -> Column:
    """Null-safe trim, exact null-token match, empty string to null."""
    t = _c(col).cast("string")
    if trim:
        t = F.trim(t)
    tokens = sorted({str(x) for x in null_tokens})
    is_null = F.lit(False)
    if tokens:
        is_null = t.isin(tokens)
    if empty_to_null:
        is_null = is_null | (t == F.lit(""))
    return F.when(is_null, F.lit(None).cast("string")).otherwise(t)


def clean_number(col: Column | str) -> Column:
    """Keep digits, dot and minus, then a tolerant cast to double."""
    stripped = F.regexp_replace(F.trim(_c(col).cast("string")), SPEC_NUMBER_STRIP_PATTERN, "")
    return stripped.try_cast("double")


def clean_number_eu(col: Column | str, decimal_style: str = "reference") -> Column:
    """European amounts.

    ``reference`` turns every comma into a dot first, so ``1.234,50`` becomes
    ``1.234.50`` and fails (K7).  ``eu`` drops the thousands dots first.
    """
    t = F.trim(_c(col).cast("string"))
    if decimal_style == "eu":
        t = F.regexp_replace(t, r"\.", "")
    elif decimal_style != "reference":
        raise ValueError(f"unknown decimal_style {decimal_style!r}")
    return clean_number(F.regexp_replace(t, ",", "."))


def ordered_tokens(null_tokens: Iterable[str]) -> list[str]:
    """K8 fix: substring removal order is longest first, then alphabetical."""
    uniq = {str(t).strip() for t in null_tokens if t is not None}
    return sorted((t for t in uniq if t), key=lambda t: (-len(t), t))


def clean_number_tokens(col: Column | str, null_tokens: Iterable[str] = ()) -> Column:
    """Partner numbers — remove null tokens as substrings, then ``, $ %``,
    strip; ``""`` and ``-`` are missing; anything not a plain number is null."""
    t = _c(col).cast("string")
    for tok in ordered_tokens(null_tokens):
        t = F.replace(t, F.lit(tok), F.lit(""))
    for ch in (",", "$", "%"):
        t = F.replace(t, F.lit(ch), F.lit(""))
    t = F.trim(t)
    valid = t.rlike(NUMERIC_TEXT_PATTERN)
    # "+ 0.0" folds a parsed "-0" into 0.0 so equal amounts compare and hash equal
    return F.when(valid, t.try_cast("double") + F.lit(0.0)).otherwise(F.lit(None).cast("double"))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """Ratio with a zero or null denominator giving null."""
    d = _c(den).cast("double")
    return F.try_divide(_c(num).cast("double"), F.when(d != 0, d))


def segment_split(orders: Column | str, segments: dict[str, Column | str]) -> dict[str, Column]:
    """C11: count the positive segments, give each positive one an equal share
    of ``orders``.  Returns ``{"active_segment_count", "split_order_value",
    "<name>_orders"...}`` for ``withColumns``."""
    positive = {k: F.coalesce(_c(v), F.lit(0)) > 0 for k, v in segments.items()}
    count = sum((F.when(p, 1).otherwise(0) for p in positive.values()), F.lit(0))
    split = F.when(count > 0, F.try_divide(_c(orders), count)).otherwise(F.lit(0.0))
    out = {"active_segment_count": count, "split_order_value": split}
    for k, p in positive.items():
        out[f"{k.lower()}_orders"] = F.when(p, split).otherwise(F.lit(0.0))
    return out


def money_sum(col: Column | str, scale: int = MONEY_SCALE) -> Column:
    """Sum of money, returned as DOUBLE; it never rounds a row and never fails.

    Values are added as decimals with ``scale`` digits after the point.
    Decimal addition is order-independent, so partial aggregation on a thousand
    executors gives the same result as a single process.  Where a value has more
    digits or does not fit, or the sum does not, the sum is the plain double sum.
    """
    value = _c(col).cast("double")
    exact = value.try_cast(f"decimal(38,{scale})")
    kept = F.coalesce(F.every(F.coalesce(exact.cast("double") == value, value.isNull())), F.lit(True))
    return F.when(kept, F.coalesce(F.try_sum(exact).cast("double"), F.sum(value))).otherwise(F.sum(value))


def null_na_tokens(col: Column | str, tokens: Iterable[str] = PANDAS_DEFAULT_NA_TOKENS) -> Column:
    """Exact-match NA tokens (as a CSV reader sees them) become null."""
    c = _c(col).cast("string")
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


# --- keys, names and paths (P11-P15) ---------------------------------------

def canonical_file_name(col: Column | str) -> Column:
    """URL-decode (``+`` is a space), basename, trim, lower, drop ``.csv``."""
    raw = F.coalesce(_c(col).cast("string"), F.lit(""))
    decoded = F.coalesce(F.try_url_decode(F.trim(raw)), F.trim(raw))
    base = F.lower(F.trim(F.substring_index(decoded, "/", -1)))
    return F.regexp_replace(base, r"\.csv$", "")


def client_from_path(col: Column | str) -> Column:
    """``raw/client_uploads/<client>/...`` with at least four parts."""
    parts = F.split(_c(col), "/")
    ok = (F.size(parts) >= 4) & (F.get(parts, 0) == "raw") & (F.get(parts, 1) == "client_uploads")
    return F.when(ok, F.lower(F.trim(F.get(parts, 2))))


def event_date_from_ts(col: Column | str, today: Column | None = None) -> Column:
    """First ten characters of the timestamp text, else today."""
    fallback = today if today is not None else F.date_format(F.current_date(), "yyyy-MM-dd")
    return F.coalesce(F.nullif(F.substring(_c(col), 1, 10), F.lit("")), fallback)


def idempotency_key(client: Column | str, key: Column | str, date: Column | str, etag: Column | str) -> Column:
    """``client|key|date|etag`` (missing parts are empty, never skipped)."""
    return F.concat_ws("|", *[F.coalesce(_c(x), F.lit("")) for x in (client, key, date, etag)])


def execution_lock_key(client: Column | str, date: Column | str) -> Column:
    """``execution_lock|client|date``."""
    return F.concat_ws("|", F.lit("execution_lock"), F.coalesce(_c(client), F.lit("")),
                       F.coalesce(_c(date), F.lit("")))


def batch_key(feed: str | Column, start: Column | str, end: Column | str) -> Column:
    """``FEED#start#end``."""
    f = F.lit(feed) if isinstance(feed, str) else feed
    return F.concat_ws("#", f, _c(start).cast("string"), _c(end).cast("string"))


def path_safe_key(col: Column | str) -> Column:
    """Path-safe form of a batch key (``#`` becomes ``_``)."""
    return F.translate(_c(col), "#", "_")


def glob_to_regex(pattern: str) -> str:
    """Anchored, case-insensitive Java regex for a shell glob (``*``, ``?``, ``[...]``)."""
    out, i, n = [], 0, len(pattern)
    while i < n:
        ch = pattern[i]
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            j = pattern.find("]", i + 1)
            if j == -1:
                out.append(r"\[")
            else:
                body = pattern[i + 1:j]
                if body.startswith("!"):
                    body = "^" + body[1:]
                out.append("[" + body.replace("\\", "\\\\").replace("[", "\\[") + "]")
                i = j
        else:
            out.append("\\Q" + ch + "\\E" if not ch.isalnum() else ch)
        i += 1
    return "(?is)^" + "".join(out) + "$"

"""Mixing sources to target weights by iterative proportional fitting.

Every document falls in a cell (source, language, topic); values without a target of their own count
as ``OTHER``, so the number of cells is bounded by the targets and does not grow with the data.
Token weights of the cells are raked to the three target marginals in turn until they agree.  The
sampling probabilities are calibrated the same way with their bound of 1: raked to the targets of
the token budget, cut at 1, until they settle, and scaled together to the budget where cells at the bound
have left some of it.  Documents are then sampled by a hash of their id,
so a rerun takes the same ones.

A target names shares; ``OTHER`` keeps its share of the tokens unless it has a target, and the named
shares are scaled to the rest.  Shares of values without tokens are dealt over those that have some.

Defined cases: null text has no tokens; null source, language or topic is ``OTHER``; a document
without tokens gets its cell's probability (1 in a cell without tokens); a null id is hashed as null; rows that repeat are
drawn alike; an empty table gives no rows; other columns are kept by ``sample_documents``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OTHER = "*other*"
ROUNDS, TOLERANCE = 500, 1e-9
WORD = "[^\\x20\\x09-\\x0D]+"


def tokens_of(text: Column) -> Column:
    """Number of words of a text, the token measure of the mixture."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def topic_of(text: Column, topics: list[tuple[str, str]], rest: str) -> Column:
    """The first topic whose pattern the whole text holds."""
    out = F.lit(rest)
    for name, pattern in reversed(topics):
        out = F.when(F.coalesce(text, F.lit("")).rlike(pattern), F.lit(name)).otherwise(out)
    return out


def _named(value: Column, targets: dict[str, float]) -> Column:
    named = [k for k in targets if k != OTHER]
    return F.when(value.isin(named), value).otherwise(F.lit(OTHER)) if named else F.lit(OTHER)


def target_shares(targets: dict[str, float], tokens: dict[str, float]) -> dict[str, float]:
    """Shares, summing to 1, of the values that have tokens."""
    total = sum(tokens.values())
    has = {k: v for k, v in targets.items() if tokens.get(k, 0) > 0 and v > 0}
    rest = tokens.get(OTHER, 0)
    if OTHER not in targets and rest > 0:
        own = rest / total
        scale = (1 - own) / sum(has.values()) if has else 0.0
        return {k: v * scale for k, v in has.items()} | {OTHER: own if has else 1.0}
    scale = sum(has.values())
    return {k: v / scale for k, v in has.items()}


def rake(tokens: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray], amount: float,
         most: float = np.inf) -> np.ndarray:
    """Factors of the cells such that ``tokens * factor`` sums to ``amount * share`` over each value
    of each marginal, as nearly as factors of at most ``most`` allow."""
    factor = np.full(len(tokens), min(most, amount / tokens.sum()))
    for _ in range(ROUNDS):
        before = factor
        for code, share in zip(codes, shares, strict=True):
            now = np.bincount(code, weights=tokens * factor, minlength=len(share))
            ratio = np.divide(amount * share, now, out=np.ones_like(share), where=now > 0)
            factor = np.minimum(most, factor * ratio[code])
        if np.abs(factor - before).max() <= TOLERANCE * max(1.0, np.abs(factor).max()):
            break
    return factor


def scale_to(tokens: np.ndarray, probability: np.ndarray, amount: float) -> np.ndarray:
    """``probability`` times one factor, cut at 1, such that the expected tokens are ``amount`` (all tokens, if fewer)."""
    low, high = 0.0, 1.0
    expected = lambda f: float((tokens * np.minimum(1.0, f * probability)).sum())
    reachable = float(tokens[probability > 0].sum())
    while expected(high) < min(amount, reachable * (1 - TOLERANCE)):
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if expected(middle) < amount else (low, middle)
    return np.minimum(1.0, high * probability)


def cell_table(spark: SparkSession, keyed: DataFrame, targets: list[dict[str, float]], budget: float) -> DataFrame:
    """``keyed`` has s, l, t and tokens.  A row for each cell: its weight and sampling probability."""
    found = keyed.groupBy("s", "l", "t").agg(F.sum("tokens").alias("tokens")).orderBy("s", "l", "t").collect()
    schema = "s string, l string, t string, weight double, probability double"
    rows = [r for r in found if r["tokens"] > 0]
    if not rows:
        return spark.createDataFrame([(r["s"], r["l"], r["t"], 1.0, 1.0) for r in found], schema)
    tokens = np.array([float(r["tokens"]) for r in rows])
    codes, shares = [], []
    for name, wanted in zip(("s", "l", "t"), targets, strict=True):
        values = sorted({r[name] for r in rows})
        code = np.array([values.index(r[name]) for r in rows])
        sums = np.bincount(code, weights=tokens, minlength=len(values))
        got = target_shares(wanted, dict(zip(values, sums.tolist(), strict=True)))
        codes.append(code)
        shares.append(np.array([got.get(v, 0.0) for v in values]))
    weight = rake(tokens, codes, shares, float(tokens.sum()))
    amount = budget * float(tokens.sum())
    probability = scale_to(tokens, rake(tokens, codes, shares, amount, 1.0), amount)
    kept = [(r["s"], r["l"], r["t"], float(w), float(p)) for r, w, p in zip(rows, weight, probability, strict=True)]
    return spark.createDataFrame(kept + [(r["s"], r["l"], r["t"], 1.0, 1.0) for r in found if not r["tokens"]], schema)


def _judged(spark: SparkSession, docs: DataFrame, sources: dict[str, float], languages: dict[str, float],
            topics: list[tuple[str, str, float]], rest: str, budget: float, seed: int, id_col: str, text_col: str,
            source_col: str, lang_col: str) -> DataFrame:
    """All columns of ``docs`` inside ``row``, and the measures beside it."""
    rules = [(name, pattern) for name, pattern, _ in topics if pattern]
    by_topic = {name: share for name, _, share in topics}
    text = F.col(f"row.{text_col}")
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).select(
        "row", _named(F.col(f"row.{source_col}"), sources).alias("s"),
        _named(F.col(f"row.{lang_col}"), languages).alias("l"),
        topic_of(text, rules, rest).alias("t"), tokens_of(text).alias("tokens"))
    cells = cell_table(spark, keyed.select("s", "l", "t", "tokens"), [sources, languages, by_topic], budget)
    draw = F.pmod(F.xxhash64(F.col(f"row.{id_col}"), F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    return keyed.join(F.broadcast(cells), ["s", "l", "t"]).withColumn("selected", draw < F.col("probability"))


def mix(spark: SparkSession, docs: DataFrame, sources: dict[str, float], languages: dict[str, float],
        topics: list[tuple[str, str, float]], rest: str, budget: float, seed: int = 17, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, topic, n_tokens, weight, probability, selected)`` for every row.  ``topics`` lists
    (name, pattern, share) in order of precedence; ``rest`` is the topic of the other texts."""
    out = _judged(spark, docs, sources, languages, topics, rest, budget, seed, id_col, text_col, source_col, lang_col)
    return out.select(F.col(f"row.{id_col}").alias("doc_id"), F.col("t").alias("topic"),
                      F.col("tokens").alias("n_tokens"), "weight", "probability", "selected")


def sample_documents(spark: SparkSession, docs: DataFrame, sources: dict[str, float], languages: dict[str, float],
                     topics: list[tuple[str, str, float]], rest: str, budget: float, seed: int = 17,
                     id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                     lang_col: str = "lang") -> DataFrame:
    """The sampled rows of ``docs``, all columns."""
    out = _judged(spark, docs, sources, languages, topics, rest, budget, seed, id_col, text_col, source_col, lang_col)
    return out.where("selected").select("row.*")

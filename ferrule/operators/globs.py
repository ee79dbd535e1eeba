"""Glob patterns as a table (J7): an index join instead of a branch a pattern.

A name can only match a pattern whose literal text it holds.  Each pattern is entered
under one *anchor*: the whole text if it has no wildcard, else a piece of its literal prefix or suffix (the longest of 1, 2, 4, 8
or 16 characters) or a gram from one of its literal runs (the longest of 3, 4, 6, 8, 12 or 16 characters that the run
holds), whichever the fewest patterns of its client share.  A name asks for its own pieces and grams, so the join is an equi-join on a hash of
(client, anchor), and client and pattern are checked on what comes out.  Long grams keep an anchor to few patterns however many
there are, so what comes out grows with the names.  Only patterns without any literal (``*``, ``???``) are held against every name of their client.

Names ask only for the kinds and lengths of anchors that the index holds.  An index made from at most ``SMALL`` characters of patterns and
types (measured, or known to the caller) is broadcast, so names ask where they are.  Of a larger one the names first see a
summary, a Bloom filter of 16 to 32 bits a pattern and at most 8 MB (through the driver): only anchors that it may hold are shuffled, and one let through wrongly meets nothing in the join.

Names and patterns are compared in lower case.  ``*`` is any text, ``?`` one character, ``[...]`` and ``[!...]`` one
character in or not in a set; a bracket that opens no such set is itself.  A null client, name or
pattern matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECES, GRAMS = (1, 2, 4, 8, 16), (3, 4, 6, 8, 12, 16)
SMALL = 1 << 20  # a character becomes at most six of a regex, so an index of about 20 MB
WORDS = 1 << 20  # the largest summary, in longs
EXACT, PREFIX, SUFFIX, INSIDE, ANY = "e", "p", "s", "i", "a"
FORMS = [ANY, EXACT, *(f"{end}{n}" for end in (PREFIX, SUFFIX) for n in PIECES), *(f"{INSIDE}{n}" for n in GRAMS)]
SET = r"\[(?:![^\]]+|[^!\]][^\]]*)\]"
PATTERN_DDL = "client_name string, file_type string, pattern string, spec_order int"


def glob_regex(pattern: Column) -> Column:
    """An anchored regex for each glob."""
    def one(token: Column) -> Column:
        body = F.substring(token, F.lit(2), F.length(token) - 2)
        kept = F.regexp_replace(F.when(body.startswith("!"), F.substring(body, F.lit(2), F.length(body))).otherwise(body),
                                r"([\\\[^&])", r"\\$1")
        return (F.when(token == "*", ".*").when(token == "?", ".")
                .when(F.length(token) > 1, F.concat(F.when(body.startswith("!"), "[^").otherwise("["), kept, F.lit("]")))
                .otherwise(F.concat(F.lit("\\Q"), token, F.lit("\\E"))))
    tokens = F.regexp_extract_all(pattern, F.lit(rf"({SET}|[^\[]|\[)"), 1)
    return F.concat(F.lit("(?s)^"), F.array_join(F.transform(tokens, one), ""), F.lit("$"))


def _tagged(tag: str, text: Column) -> Column:
    return F.concat(F.lit(tag), text)


def _grams(run: Column, size: int, made) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(run) - (size - 1)), lambda at: made(F.substring(run, at, F.lit(size))))


def _longest(length: Column, sizes: tuple[int, ...], made, otherwise: Column) -> Column:
    """What ``made`` makes of the largest of ``sizes`` that ``length`` allows."""
    sizes = sorted(sizes, reverse=True)
    out = F.when(length >= sizes[0], made(sizes[0]))
    for n in sizes[1:]:
        out = out.when(length >= n, made(n))
    return out.otherwise(otherwise)


def _entered(glob: Column) -> Column:
    """The anchors under one of which a pattern is entered."""
    prefix, suffix = F.regexp_extract(glob, r"^([^*?\[]*)", 1), F.regexp_extract(glob, r"([^*?\[\]]*)$", 1)
    runs = F.split(F.regexp_replace(glob, SET, "*"), r"[*?\[\]]+")
    none, no_text = F.array().cast("array<string>"), F.lit(None).cast("string")
    ends = F.array(_longest(F.length(prefix), PIECES, lambda n: _tagged(PREFIX, F.left(prefix, F.lit(n))), no_text),
                   _longest(F.length(suffix), PIECES, lambda n: _tagged(SUFFIX, F.right(suffix, F.lit(n))), no_text), F.lit(ANY))
    grams = F.flatten(F.transform(runs, lambda run: _longest(F.length(run), GRAMS, lambda n: _grams(run, n, lambda text: _tagged(INSIDE, text)), none)))
    return F.when(~glob.rlike(r"[*?\[]"), F.array(_tagged(EXACT, glob))).otherwise(F.concat(F.array_compact(ends), grams))


def _seed(client: Column, kind: Column) -> Column:
    return F.xxhash64(client, kind)


def _key(client: Column, anchor: Column) -> Column:
    """The hash by which a name and a pattern meet."""
    return F.xxhash64(_seed(client, F.left(anchor, F.lit(1))), F.substring(anchor, F.lit(2), F.length(anchor)))


def _asked(client: Column, name: Column, held: Column, seed: Column) -> Column:
    """The keys of a name's own anchors, of the forms whose bits are set in ``held``; ``seed``: of the client's grams, made once a name."""
    def when(form: str, key: Column, size: int = 0) -> Column:
        return F.when((F.length(name) >= size) & (held.bitwiseAND(F.lit(1 << FORMS.index(form))) != 0), key)

    def one(kind: str, text: Column) -> Column:
        return F.xxhash64(_seed(client, F.lit(kind)), text)
    ends = [when(ANY, one(ANY, F.lit(""))), when(EXACT, one(EXACT, name))]
    ends += [when(f"{PREFIX}{n}", one(PREFIX, F.left(name, F.lit(n))), n) for n in PIECES]
    ends += [when(f"{SUFFIX}{n}", one(SUFFIX, F.right(name, F.lit(n))), n) for n in PIECES]
    none = F.array().cast("array<bigint>")
    grams = [when(f"{INSIDE}{n}", _grams(name, n, lambda text: F.xxhash64(seed, text)), n).otherwise(none) for n in GRAMS]
    return F.array_distinct(F.concat(F.array_compact(F.array(*ends)), *grams))


def pattern_table(spark: SparkSession, specs: dict[str, list]) -> DataFrame:
    """The patterns of declared specs (``{client: [{file_type, patterns}]}``) as a table."""
    from ferrule.operators.lookup import _spec_items
    return spark.createDataFrame([(c, t, p, order) for c, t, p, _, order in _spec_items(specs)], PATTERN_DDL)


def _ranked(patterns: DataFrame) -> DataFrame:
    """``(client, glob, file_type, rank)``, a row for each distinct pattern that can match."""
    glob = F.lower("pattern")
    rows = patterns.where(glob.isNotNull() & F.col("client_name").isNotNull()).select(
        F.col("client_name").alias("client"), glob.alias("glob"), "file_type", F.col("spec_order").cast("long").alias("at")).distinct()
    literal = F.length(F.regexp_replace("glob", r"[*?\[\]]", ""))
    hashed = F.shiftrightunsigned(F.xxhash64("file_type", "glob"), 1).cast("decimal(19,0)")
    major = ((F.lit(1 << 20) - F.least(literal, F.lit(1 << 20))).cast("decimal(8,0)") * F.lit(str(1 << 31)).cast("decimal(11,0)")
             + F.col("at").cast("decimal(11,0)")).cast("decimal(18,0)")
    rank = (major * F.lit(str(1 << 63)).cast("decimal(19,0)") + hashed).cast("decimal(38,0)")
    return rows.select("client", "glob", "file_type", rank.alias("rank"))


def glob_index(patterns: DataFrame) -> DataFrame:
    """``(client, anchor, regex, file_type, rank)``, a row a pattern.

    ``patterns``: ``client_name``, ``file_type``, ``pattern`` and ``spec_order``, which need not be unique.  ``rank`` puts the most
    specific pattern first (more literal characters, then the earlier spec, then a hash of type and pattern) in one decimal, whose minimum is a hash aggregate.
    """
    rows = _ranked(patterns).withColumn("anchor", F.explode(F.array_distinct(_entered(F.col("glob")))))
    shared = rows.groupBy("client", "anchor").agg(F.count(F.lit(1)).alias("n"))
    last = F.col("anchor") == ANY
    price = F.struct(last, "n", -F.length("anchor"), "anchor")
    return (rows.join(shared, ["client", "anchor"]).groupBy("client", "file_type", "glob", "rank")
            .agg(F.min_by("anchor", price).alias("anchor"))
            .select("client", "anchor", glob_regex(F.col("glob")).alias("regex"), "file_type", "rank"))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def _mark(key: Column, words: int) -> tuple[Column, Column]:
    """Where a key is noted in a summary of ``words`` words: the word and three of its bits."""
    bits = [_bit(F.shiftrightunsigned(key, n).bitwiseAND(F.lit(63))) for n in (0, 6, 12)]
    return F.shiftrightunsigned(key, 18).bitwiseAND(F.lit(words - 1)) + 1, bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def glob_summary(index: DataFrame, words: int) -> DataFrame:
    """One array of longs: the ``FORMS`` that the index holds as bits, then ``words`` words (a power of two, or none) of a Bloom filter of its anchors."""
    kind = F.left("anchor", F.lit(1))
    form = F.when(kind.isin(ANY, EXACT), kind).otherwise(F.concat(kind, F.length("anchor") - 1))
    zero = F.lit(0).cast("long")
    marks = [(zero, _bit(F.array_position(F.lit(FORMS), form) - 1))]
    marks += [_mark(_key(F.col("client"), F.col("anchor")), words)] if words else []
    noted = index.select(F.inline(F.array(*[F.struct(word.alias("word"), bits.alias("bits")) for word, bits in marks])))
    noted = noted.unionByName(index.sparkSession.range(words + 1).select(F.col("id").alias("word"), zero.alias("bits")))
    whole = noted.groupBy("word").agg(F.bit_or("bits").alias("bits"))

    def in_order(key: str) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct(key, "bits"))), lambda x: x["bits"])
    parts = whole.groupBy(F.shiftright("word", 10).alias("part")).agg(in_order("word").alias("bits"))
    return parts.agg(F.flatten(in_order("part")).alias("summary"))


def glob_matches(names: DataFrame, index: DataFrame, words: int = 0, small: bool = False) -> DataFrame:
    """``(client, name, file_type, rank)`` for every pair of a distinct name (in lower case) and a pattern that it matches.
    ``words``: the size of the summary that names see first (none: they ask for all they have)."""
    name, key = F.col("name"), F.col("key")
    summary = glob_summary(index, words)
    held = names.withColumns({"held": F.get(summary.scalar(), F.lit(0)), "seed": _seed(F.col("client"), F.lit(INSIDE))})
    asked = _asked(F.col("client"), name, F.col("held"), F.col("seed"))
    probes = held.select("client", "name", F.explode(asked).alias("key"))
    if words:
        word, bits = _mark(key, words)
        probes = probes.where(F.get(summary.scalar(), word).bitwiseAND(bits) == bits)
    kept = index.select(F.col("client").alias("of"), _key(F.col("client"), F.col("anchor")).alias("key"), "regex", "file_type", "rank")
    return (probes.join(F.broadcast(kept) if small else kept, "key").where((F.col("client") == F.col("of")) & F.rlike(name, F.col("regex")))
            .select("client", "name", "file_type", "rank"))


def _measured(patterns: DataFrame) -> tuple[int, int]:
    """The number of patterns, and their characters, each with 64 for what comes with it: one small aggregate."""
    size = sum((F.coalesce(F.length(c), F.lit(0)) for c in ("pattern", "file_type", "client_name")), F.lit(64))
    row = patterns.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size")).first()
    return row["n"], row["size"] or 0


def is_small(patterns: DataFrame) -> bool:
    """Whether the patterns make an index that may be broadcast."""
    return _measured(patterns)[1] <= SMALL


def _words(n: int) -> int:
    """Words of a summary with 16 to 32 bits for each of ``n`` patterns: a power of two, at most ``WORDS``."""
    return min(WORDS, 1 << max(10, (max(n, 1) - 1).bit_length() - 2))


def match_globs(files: DataFrame, patterns: DataFrame, name_col: str = "file_name", client_col: str = "client_name",
                exclusive: bool = True, small: bool | None = None) -> DataFrame:
    """``files`` with the ``file_type`` they satisfy, from a table of patterns of any size.

    ``exclusive``: each file has the type of its most specific pattern; otherwise a row for each distinct type it
    satisfies.  Files that match nothing are left out.  ``small``: whether the index may be broadcast (None: measured).  Each distinct (client, name) is matched once, however many files have it.
    """
    words = 0
    if not small:
        n, size = _measured(patterns)
        small = size <= SMALL if small is None else small
        words = 0 if small else _words(n)
    index = glob_index(patterns)
    keyed = files.drop("file_type").withColumns({"__client": F.col(client_col), "__name": F.lower(F.col(name_col))})
    names = keyed.select(F.col("__client").alias("client"), F.col("__name").alias("name")).where(
        F.col("client").isNotNull() & F.col("name").isNotNull()).distinct()
    found = glob_matches(names, index, words, small)
    if exclusive:
        best = found.groupBy("client", "name").agg(F.min("rank").alias("rank"))
        found = best.join(_ranked(patterns).select("client", "rank", "file_type"), ["client", "rank"])
    typed = found.select(F.col("client").alias("__client"), F.col("name").alias("__name"), "file_type").distinct()
    return keyed.join(typed, ["__client", "__name"]).drop("__client", "__name")

"""Quality rules by distribution divergence, in built-in functions only: one pass over the texts, no shuffle.

Two histograms of a text are compared with a reference of its language by Jensen-Shannon distance (square root of the
divergence, base 2, between 0 and 1): shares of character classes, and shares of the language's commonest words. Both
have a minimum length below which they give no verdict. Rows in a language without a reference are held against the
mean of the character references and have no word verdict.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import same_columns, text_or_empty

#: The commonest function words of each language, and their usual share of running words in prose.
COMMON_WORDS = {
    "en": {"the": 0.060, "of": 0.030, "and": 0.027, "to": 0.025, "a": 0.021, "in": 0.019, "is": 0.011, "that": 0.010},
    "de": {"der": 0.034, "die": 0.033, "und": 0.028, "in": 0.018, "den": 0.012, "von": 0.010, "zu": 0.011, "das": 0.011},
    "fr": {"de": 0.045, "la": 0.027, "le": 0.022, "et": 0.020, "les": 0.018, "des": 0.016, "en": 0.013, "un": 0.012},
    "es": {"de": 0.060, "la": 0.035, "que": 0.030, "el": 0.028, "en": 0.026, "y": 0.025, "los": 0.016, "se": 0.012},
}
#: Usual shares of small letters, capitals, digits, symbols, other marks and white space in prose.
CHARACTER_CLASSES = ("small", "capital", "digit", "symbol", "mark", "space")
CHARACTER_SHARES = {
    "en": (0.780, 0.025, 0.004, 0.001, 0.025, 0.165),
    "de": (0.775, 0.050, 0.004, 0.001, 0.025, 0.145),
    "fr": (0.775, 0.025, 0.004, 0.001, 0.030, 0.165),
    "es": (0.780, 0.025, 0.004, 0.001, 0.025, 0.165),
}
#: Distances above which a text is rejected, and lengths from which a histogram is trusted.
MAX_CHARACTER_DISTANCE = 0.20
MAX_WORD_DISTANCE = 0.30
MIN_CHARACTERS = 200
MIN_WORDS = 50

_SPACE = r"\\x20\\x09-\\x0D"  # inside a SQL string


def _words_sql(common: dict[str, dict[str, float]]) -> str:
    """A struct of all that is counted from the words of column t; each array is bound once by a one-element transform."""
    refs = " ".join(f"WHEN '{lang}' THEN array({', '.join(repr(w) for w in words)})" for lang, words in common.items())
    longest = max(map(len, common.values()))
    # packed: 44 bits of a window's hash above its number, so that one primitive sort brings equal windows together
    fast = """transform(array(sort_array(transform(h, (x, i) -> shiftleft(shiftright(x, 20), 20) | cast(i as bigint)))), p ->
                transform(p, (x, i) -> IF(shiftright(x, 20) = shiftright(get(p, i - 1), 20) OR shiftright(x, 20) = shiftright(get(p, i + 1), 20), cast(x & 1048575 as int), -1)))[0]"""
    slow = """transform(array(sort_array(transform(h, (x, i) -> named_struct('x', x, 'i', i)))), p ->
                transform(p, (s, i) -> IF(s.x = get(p, i - 1).x OR s.x = get(p, i + 1).x, s.i, -1)))[0]"""
    # two different windows whose 44 bits agree are neighbours after the sort; then whole hashes are sorted
    clash = """exists(transform(array(sort_array(transform(h, (x, i) -> shiftleft(shiftright(x, 20), 20) | cast(i as bigint)))), p ->
                 transform(p, (x, i) -> shiftright(x, 20) = shiftright(get(p, i + 1), 20) AND get(h, cast(x & 1048575 as int)) <> get(h, cast(get(p, i + 1) & 1048575 as int))))[0], x -> x)"""
    covered = "transform(array(sort_array(filter({marks}, x -> x >= 0))), q -> aggregate(transform(q, (x, i) -> least(3, coalesce(get(q, i + 1) - x, 3))), 0L, (a, x) -> a + x))[0]"
    hashes = "transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))"
    repeats = f"""CASE WHEN size(w) < 4 THEN 0L ELSE transform(array({hashes}), h ->
        CASE WHEN size(array_distinct(h)) = size(h) THEN 0L
             WHEN size(h) > 1048575 OR {clash} THEN {covered.format(marks=slow)}
             ELSE {covered.format(marks=fast)} END)[0] END"""
    counts = ", ".join(f"size(filter(r, x -> x = {k + 1}))" for k in range(longest))
    return f"""transform(array(filter(split(t, '[{_SPACE}]+'), x -> x <> '')), w -> named_struct(
        'n', cast(size(w) as bigint), 'repeats', {repeats},
        'bins', transform(array(CASE lang {refs} END), ref -> IF(ref IS NULL, NULL,
             transform(array(filter(transform(w, x -> array_position(ref, lower(x))), x -> x > 0)), r -> array({counts}))[0]))[0]))[0]"""


def _lines_sql() -> str:
    return f"""transform(array(filter(split(t, '\\n'), x -> x rlike '[^{_SPACE}]')), l -> cast(size(l) - size(array_distinct(l)) as bigint))[0]"""


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two distributions, arrays of equal length; null if either is null."""
    half = lambda x, mid: F.when(x > 0, x * F.log2(x / mid)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda x, y: half(x, (x + y) / 2) + half(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda at, x: at + x) / 2))


def _reference(table: dict[str, list[float]], other: Column) -> Column:
    """The reference array of column lang's language."""
    pick = F.when(F.lit(False), other)
    for lang, shares in table.items():
        pick = pick.when(F.col("lang") == lang, F.array(*map(F.lit, shares)))
    return pick.otherwise(other)


def _share(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of).otherwise(F.lit(0.0))


def measure(docs: DataFrame, common: dict = COMMON_WORDS, shares: dict = CHARACTER_SHARES) -> DataFrame:
    """docs with __q, a struct of all counts, both distances and the verdict.

    Null text has no words and fails; a text with any number of words in any language gets every count; null or
    unknown languages have no word distance. Columns of docs stay as they are.
    """
    if len({len(x) for x in common.values()}) != 1:
        raise ValueError("each language needs as many common words as the others")
    t, lang = text_or_empty(), F.lower(F.col("lang").cast("string"))
    outside = lambda keep: F.length(F.regexp_replace("t", keep, "")).cast("long")
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), t.alias("t"), lang.alias("lang"))
    one = base.select(
        "__row", "lang", F.expr(_words_sql(common)).alias("w"), F.expr(_lines_sql()).alias("n_dup_lines"), F.length("t").cast("long").alias("chars"),
        outside(r"[\x20\x09-\x0D]+").alias("word_chars"), outside(r"[^#*$%&|<>]+").alias("n_symbols"),
        F.monotonically_increasing_id().alias("mark"), outside(r"\P{L}+").alias("letters"), outside(r"\P{Lu}+").alias("capitals"), outside(r"[^0-9]+").alias("digits"),
    )
    c = F.col
    rest = c("word_chars") - c("letters") - c("digits") - c("n_symbols")
    classes = [_share(x, c("chars")) for x in (c("letters") - c("capitals"), c("capitals"), c("digits"), c("n_symbols"), rest, c("chars") - c("word_chars"))]
    mean = F.array(*[F.lit(sum(x) / len(shares)) for x in zip(*shares.values())])
    words = {k: [*ref.values(), 1.0 - sum(ref.values())] for k, ref in common.items()}
    none = F.lit(None).cast("array<double>")
    two = one.withColumn("classes", F.array(*classes)).withColumn("bins", F.when(c("w.n") > 0, F.transform("w.bins", lambda x: x / c("w.n"))))
    rest_bin = F.lit(1.0) - F.aggregate("bins", F.lit(0.0), lambda at, x: at + x)
    char_distance = _distance(c("classes"), _reference(shares, mean))
    word_distance = _distance(F.concat("bins", F.array(rest_bin)), _reference(words, none))
    two = two.select("__row", c("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", c("w.repeats").alias("n_repeat_words"), "chars", "mark", char_distance.alias("char_distance"), word_distance.alias("word_distance"))
    failed = (c("n_words") < 50) | (100 * c("n_repeat_words") > 50 * c("n_words"))
    odd = ((c("chars") >= MIN_CHARACTERS) & (c("char_distance") > MAX_CHARACTER_DISTANCE)) | ((c("n_words") >= MIN_WORDS) & F.coalesce(c("word_distance") > MAX_WORD_DISTANCE, F.lit(False)))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance")
    # mark is always 0 or more; a filter that needs it can't be pushed below the counts, which would then be made again
    kept = ~failed & ~odd & (c("mark") >= 0)
    return two.select("__row", F.struct(*names, failed.alias("base_failed"), kept.alias("kept")).alias("__q"))


def report(docs: DataFrame) -> DataFrame:
    """Columns of op5, then both distances (6 decimals; null where there is no verdict)."""
    q = measure(docs)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    rounded = [F.round(f"__q.{x}", 6).alias(x) for x in ("char_distance", "word_distance")]
    return q.select(F.col("__row.doc_id").cast("long").alias("doc_id"), *[F.col(f"__q.{x}") for x in names], *rounded)


def keep_good(docs: DataFrame) -> DataFrame:
    """docs without those that the rules reject, all columns as they were."""
    return same_columns(measure(docs).where("__q.kept").select("__row.*"), docs)


def oracle_sql(common: dict = COMMON_WORDS, shares: dict = CHARACTER_SHARES) -> str:
    """DuckDB SQL for report(): the same rules by unnested windows and lists."""
    listed = lambda values: "[" + ", ".join(map(repr, values)) + "]"
    by_lang = lambda table, other: "CASE lang " + " ".join(f"WHEN '{k}' THEN {listed(v)}" for k, v in table.items()) + f" ELSE {other} END"
    mean = listed(sum(x) / len(shares) for x in zip(*shares.values()))
    words = {k: [*ref.values(), 1.0 - sum(ref.values())] for k, ref in common.items()}
    half = "CASE WHEN {0} > 0 THEN {0} * log2({0} / ((x[1] + x[2]) / 2)) ELSE 0 END"
    distance = f"sqrt(greatest(0.0, list_sum(list_transform(list_zip(p, q), lambda x: {half.format('x[1]')} + {half.format('x[2]')})) / 2))"
    js = lambda p, q: f"(SELECT {distance} FROM (SELECT {p} AS p, {q} AS q))"
    out = lambda keep: f"length(regexp_replace(t, '{keep}', '', 'g'))"
    share = lambda x: f"CASE WHEN chars > 0 THEN ({x}) / chars ELSE 0 END"
    classes = ", ".join(map(share, ("letters - capitals", "capitals", "digits", "n_symbols", "word_chars - letters - digits - n_symbols", "chars - word_chars")))
    bins = f"list_transform({by_lang({k: list(v) for k, v in common.items()}, 'NULL')}, lambda x: list_count(list_filter(w, lambda y: lower(y) = x)) / n_words)"
    return f"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, lower(lang) AS lang, coalesce(text, '') AS t FROM documents),
cut AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM doc),
gram AS (SELECT rid, k, w[k] AS a, w[k + 1] AS b, w[k + 2] AS c FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS k FROM cut)),
twice AS (SELECT rid, k FROM (SELECT rid, k, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM gram) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT k + j) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY rid),
base AS (SELECT cut.*, len(w) AS n_words, {out('[\\x20\\x09-\\x0D]+')} AS word_chars, {out('[^#*$%&|<>]+')} AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
  length(t) AS chars, {out('\\P{L}+')} AS letters, {out('\\P{Lu}+')} AS capitals, {out('[^0-9]+')} AS digits FROM cut LEFT JOIN covered USING (rid)),
share AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, [{classes}] AS classes, CASE WHEN n_words > 0 THEN {bins} END AS bins FROM base),
far AS (SELECT *, {js('classes', by_lang(shares, mean))} AS cd, CASE WHEN bins IS NOT NULL THEN {js('list_append(bins, 1.0 - list_sum(bins))', by_lang(words, 'NULL'))} END AS wd FROM share)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (chars >= {MIN_CHARACTERS} AND cd > {MAX_CHARACTER_DISTANCE}) AND NOT (n_words >= {MIN_WORDS} AND coalesce(wd > {MAX_WORD_DISTANCE}, false)) AS kept, round(cd, 6) AS char_distance, round(wd, 6) AS word_distance FROM far
"""

"""Quality rules with adaptive thresholds, in DataFrame functions only.

Base figures of every text (null: no words): words, their code points, symbols, repeated lines, words in repeated
3-word windows. A text fails the base rules with fewer than ``MIN_WORDS`` words or with more than half of its words
in repeated windows.

Adaptive thresholds. Each figure is turned into an integer ratio per text. Counts of events (symbols, repeated lines,
repeated windows) are first lowered by ``SIGMAS`` times their square root, so that a few events in a text are taken for chance,
however short it is. Per language and source a mergeable quantile sketch is kept of every ratio: counts in bins whose width is
at most 1/16 of their lower bound (exact below 32), so any quantile is known within 6.25 %. Sketches are tables of
(language, source, rule, bin, count): they merge by adding counts, partial counts are made before the shuffle, and a hot source has
no more rows in them than others. Only texts that pass the base rules are in the sketches.

Sketches of small groups say little, so they are merged with weights: a language takes in ``PRIOR`` texts' worth of the corpus,
and a group ``PRIOR`` texts' worth of its language. It is the same rule for all sizes: a group of ten thousand texts hardly
moves, one of five mostly follows its language. In the merged sketch a rule's cutoff is its upper quantile plus ``REACH`` times
the spread, its distance from the mirrored lower quantile, by the levels in ``RULES``: quartiles where ordinary texts of a group lie close together and
up to a quarter of it may be junk (symbols, long words), the 99th percentile where ordinary texts have a long thin tail (repeats).
Where both quantiles meet, the spread is what the group itself can resolve: the width of the sketch's bin, and for counts of events
one event in a text of the group's median length, by its own sketch. So a group in which hardly any text holds a symbol still has a cutoff of its own: groups of
short texts must bear more than those of long ones. The cutoffs are joined to the figures, and a text is kept if it passes the base rules and exceeds no cutoff.

Null languages and sources are groups of their own, null and empty texts have no words, repeated rows are judged alike, ties with a cutoff are kept. Texts
of any length are counted whole; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import configure, join_small, named

MIN_WORDS = 50
#: Standard deviations of a count that are put down to chance.
SIGMAS = 2
#: Cutoffs lie this many spreads above the upper quantile.
REACH = 4
#: Texts' worth of the corpus in a language's sketch, and of the language in a group's; weights are counted in 1/SCALE of a text.
PRIOR, SCALE = 50, 1024


def _sure(count: str) -> str:
    """A count less what chance may explain."""
    return f"greatest({count} - cast(floor({SIGMAS} * sqrt({count})) as bigint), 0)"


#: Rule: (figure and divisor as SQL over the base figures, scaled to an integer; upper quantile in per cent). All but long_words count events in 10,000 words.
RULES = {
    "symbols": (f"{_sure('n_symbols')} * 10000 div n_words", 75),
    "dup_lines": (f"{_sure('n_dup_lines')} * 10000 div n_words", 99),
    "repeats": (f"{_sure('(n_repeat_words div 3)')} * 10000 div n_words", 99),
    "long_words": ("word_chars * 100 div n_words", 75),
}
#: All sketches: the rules' and that of the texts' lengths, whose median says how fine a group resolves events.
SKETCHED = RULES | {"words": ("n_words", 50)}
_SPACE = r"[\\x20\\x09-\\x0D]"
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(column: str, words: str = "ws") -> str:
    """Words that lie in 3-word windows whose text is found twice or more, over the array of words.

    Windows are sorted by their text with the place behind, so equal ones are neighbours; the places of repeated
    windows are sorted, and each adds the words up to the next one, three at most. Arrays that are read at a place are
    bound by a lambda, so that no optimizer rule can put their making inside another lambda's loop."""
    windows = f"array_sort(transform(sequence(1, size({words}) - 2), i -> named_struct('w', concat_ws(' ', {words}[i - 1], {words}[i], {words}[i + 1]), 'i', i)))"
    repeated = "transform(filter(s, (x, j) -> (j > 0 and s[j - 1].w = x.w) or (j + 1 < size(s) and s[j + 1].w = x.w)), x -> x.i)"
    places = f"transform(array({windows}), s -> array_sort({repeated}))[0]"
    covered = f"aggregate(transform(array({places}), p -> transform(p, (x, j) -> if(j + 1 < size(p), least(3, p[j + 1] - x), 3)))[0], 0L, (a, x) -> a + x)"
    # without two windows of equal hash there is nothing to sort
    hashes = f"transform(sequence(1, size({words}) - 2), i -> xxhash64({words}[i - 1], {words}[i], {words}[i + 1]))"
    apart = f"transform(array({hashes}), h -> size(array_distinct(h)) = size(h))[0]"
    return f"transform(array({column}), {words} -> if(size({words}) < 3, 0L, if({apart}, 0L, {covered})))[0]"


def figures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five base figures in place of the text; input columns of those names are replaced."""
    keep = [c for c in docs.columns if c != text and c.lower() not in FIGURES]
    rows = docs.select(*named(keep), F.coalesce(F.col(text), F.lit("")).alias("__t"))
    rows = rows.withColumn("__w", F.expr(f"filter(split(__t, '{_SPACE}+'), w -> w <> '')"))
    lines = F.expr(f"filter(split(__t, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')")
    rows = rows.withColumn("__l", lines)
    return rows.select(
        *named(keep),
        F.size("__w").cast("long").alias("n_words"),
        F.expr("aggregate(__w, 0L, (a, w) -> a + length(w))").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.expr(_repeat_words("__w")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def bin_of(value: str) -> str:
    """Bin of a non-negative integer: exact below 32, then 16 bins for each power of two."""
    shift = f"greatest(length(bin({value})) - 5, 0)"
    return f"cast({shift} * 16 + shiftright({value}, {shift}) as long)"


def bin_top(b: str) -> str:
    """Largest integer of a bin."""
    shift = f"cast(greatest({b} div 16 - 1, 0) as int)"
    return f"(shiftleft({b} - {shift} * 16 + 1, {shift}) - 1)"


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, rule, bin, n): the mergeable sketches of rows that have lang, source and the figures."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.expr(bin_of(f"({v})")).alias("bin")) for k, (v, _) in SKETCHED.items()]))
    return rows.where(~F.col("base_failed")).select("lang", "source", each.alias("x")).select("lang", "source", "x.*").groupBy("lang", "source", "rule", "bin").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame) -> DataFrame:
    """(lang, source, rule, bin, n): each group's sketch with its language and the corpus merged in by their weights."""
    def shared(outer: DataFrame, own: DataFrame, keys: list[str]) -> DataFrame:
        """``own`` counts, scaled, and PRIOR texts' worth of ``outer`` (keys, rule, bin, n, total); both have whole numbers."""
        both = outer.join(own.withColumnRenamed("n", "own"), [*keys, "rule", "bin"], "left")
        return both.withColumn("n", F.expr(f"{SCALE} * coalesce(own, 0L) + ({PRIOR * SCALE} * n) div total")).drop("own", "total")

    def total(df: DataFrame, *keys: str) -> DataFrame:
        return df.withColumn("total", F.sum("n").over(W.partitionBy(*keys, "rule")))  # some hundred bins a rule

    langs = sketch.groupBy("lang", "rule", "bin").agg(F.sum("n").alias("n"))
    corpus = total(langs.groupBy("rule", "bin").agg(F.sum("n").alias("n")))
    langs = total(shared(langs.select("lang").distinct().join(F.broadcast(corpus)), langs, ["lang"]), "lang").checkpoint()  # the corpus has some hundred bins
    groups = sketch.select("lang", "source").distinct()
    return shared(join_small(groups, langs, "lang", "inner"), sketch, ["lang", "source"])


def cutoffs(sketch: DataFrame) -> DataFrame:
    """One row per group: lang, source and a cutoff for every rule."""
    bins = merged(sketch).groupBy("lang", "source", "rule").agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("total"))
    level = F.create_map(*[F.lit(x) for k, (_, v) in SKETCHED.items() for x in (k, v)])
    bins = bins.withColumn("level", level[F.col("rule")].cast("long"))

    def quantile(level: str) -> str:
        found = f"aggregate(bins, named_struct('seen', 0L, 'bin', -1L), (a, x) -> named_struct('seen', a.seen + x.n, 'bin', if(a.bin < 0 and (a.seen + x.n) * 100 >= total * {level}, x.bin, a.bin))).bin"
        return bin_top(found)

    each = bins.select("lang", "source", "rule", F.expr(quantile("level")).alias("high"), F.expr(quantile("(100 - level)")).alias("low"))
    of = lambda rule, column: F.max(F.when(F.col("rule") == rule, F.col(column)))
    group = each.groupBy("lang", "source").agg(of("words", "high").alias("words"), *[of(k, c).alias(f"{c}_{k}") for k in RULES for c in ("high", "low")])
    return group.select("lang", "source", *[F.expr(f"high_{k} + {REACH} * {_spread(k, f'high_{k}', f'low_{k}', 'words')}").cast("long").alias(f"max_{k}") for k in RULES])


def _spread(rule: str, high: str, low: str, words: str) -> str:
    """The distance of the quantiles, or what the group resolves where that is more."""
    event = "" if rule == "long_words" else f", 10000 div {words}"
    return f"greatest({high} - {low}, {high} div 16{event})"


def judge(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang, source): doc_id, the base figures, base_failed and kept."""
    configure(spark)
    rows = figures(docs.select("doc_id", "lang", "source", "text")).withColumn("base_failed", base_failed())
    rows = rows.withColumns({"lang": F.coalesce("lang", F.lit("")), "source": F.coalesce("source", F.lit(""))}).checkpoint()
    limits = cutoffs(sketches(rows)).checkpoint()
    rows = join_small(rows, limits, ["lang", "source"])
    passes = F.lit(True)
    for k, (v, _) in RULES.items():
        passes = passes & F.expr(f"coalesce(({v}) <= max_{k}, true)")
    return rows.select("doc_id", *FIGURES, "base_failed", (~F.col("base_failed") & passes).alias("kept"))


_SQL_RULES = {k: v.replace(" div ", " // ") for k, (v, _) in SKETCHED.items()}
_SQL_BIN = lambda v: f"greatest(length(bin({v})) - 5, 0) * 16 + (({v}) >> greatest(length(bin({v})) - 5, 0))"
_SQL_TOP = lambda b: f"((({b} - greatest({b} // 16 - 1, 0) * 16 + 1) << greatest({b} // 16 - 1, 0)) - 1)"
ORACLE = f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), lines AS (
  SELECT rid, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM base
), windows AS (
  SELECT rid, i, x || ' ' || lead(x, 1) OVER p || ' ' || lead(x, 2) OVER p AS x FROM (SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM base) WINDOW p AS (PARTITION BY rid ORDER BY i)
), again AS (
  SELECT rid, i FROM windows WHERE x IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, x) > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid
), figures AS (
  SELECT rid, doc_id, lang, source, len(w)::BIGINT AS n_words, list_sum(list_transform(w, lambda x: length(x))) AS wc,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM base JOIN lines USING (rid) LEFT JOIN covered USING (rid)
), rows_ AS (
  SELECT * EXCLUDE wc, coalesce(wc, 0)::BIGINT AS word_chars, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures
), ratios AS (
  {" UNION ALL ".join(f"SELECT rid, lang, source, '{k}' AS rule, {v} AS ratio FROM rows_ WHERE NOT base_failed" for k, v in _SQL_RULES.items())}
), sketch AS (
  SELECT lang, source, rule, {_SQL_BIN("ratio")} AS bin, count(*)::BIGINT AS n FROM ratios GROUP BY ALL
), langs AS (
  SELECT lang, rule, bin, sum(n)::BIGINT AS n FROM sketch GROUP BY ALL
), corpus AS (
  SELECT rule, bin, sum(n)::BIGINT AS n, (sum(sum(n)) OVER (PARTITION BY rule))::BIGINT AS total FROM langs GROUP BY rule, bin
), wide AS (
  SELECT lang, rule, bin, {SCALE} * coalesce(l.n, 0) + ({PRIOR * SCALE} * c.n) // c.total AS n
  FROM (SELECT DISTINCT lang FROM langs) CROSS JOIN corpus c LEFT JOIN langs l USING (lang, rule, bin)
), merged AS (
  SELECT lang, source, rule, bin, {SCALE} * coalesce(s.n, 0) + ({PRIOR * SCALE} * w.n) // w.total AS n
  FROM (SELECT DISTINCT lang, source FROM sketch) JOIN (SELECT *, (sum(n) OVER (PARTITION BY lang, rule))::BIGINT AS total FROM wide) w USING (lang) LEFT JOIN sketch s USING (lang, source, rule, bin)
), seen AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, rule ORDER BY bin) AS seen, sum(n) OVER (PARTITION BY lang, source, rule) AS total,
         CASE rule {" ".join(f"WHEN '{k}' THEN {v}" for k, (_, v) in SKETCHED.items())} END AS level FROM merged
), bounds AS (
  SELECT lang, source, rule, min(bin) FILTER (seen * 100 >= total * level) AS high, min(bin) FILTER (seen * 100 >= total * (100 - level)) AS low FROM seen GROUP BY ALL
), tops AS (
  SELECT lang, source, rule, {_SQL_TOP("high")} AS high, {_SQL_TOP("low")} AS low FROM bounds
), limits AS (
  SELECT lang, source, rule, b.high + {REACH} * CASE {" ".join(f"WHEN rule = '{k}' THEN {_spread(k, 'b.high', 'b.low', 'w.high').replace(' div ', ' // ')}" for k in RULES)} END AS cutoff
  FROM tops b JOIN (SELECT lang, source, high FROM tops WHERE rule = 'words') w USING (lang, source) WHERE rule <> 'words'
), over AS (
  SELECT DISTINCT rid FROM ratios JOIN limits USING (lang, source, rule) WHERE ratio > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rid NOT IN (SELECT rid FROM over) AS kept FROM rows_
"""

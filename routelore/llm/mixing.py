"""Mixing sources to target weights by temperature.

1. Token shares ``s_i`` per source come from one partial aggregation over the corpus.
2. The weights are ``w_i ~ s_i ** a``. ``a`` is bisected in SQL over the one-row array of shares until the
   weights reach the target entropy, or until the most repeated source stays within a repetition limit.
3. The weights are realised: with the budget ``B`` a source has ``round(w_i * B)`` tokens to give. It gives its
   documents in epochs; in each epoch its blocks of documents are put in a fresh pseudo-random order, and
   inside a block so are the documents. A document is given in an epoch as long as the tokens given before
   it are fewer than the source's budget.

The budget is ``budget_factor`` times the smallest budget that gives every source in full at least once, so with
a factor of 1 or more no document is lost: sources are only repeated, never cut.

Everything is DataFrame and SQL functions. A source is split into blocks of some ``BLOCK_DOCS`` documents. Prefix
sums run inside blocks, then over the totals of blocks whose place in the order begins with the same three hex digits, then over the
totals of these 4,096 ranges, so no window holds a hot source or all of its blocks. ``mix_rows`` moves no text: in its last epoch a source gives all
documents up to one place in the order, so one row a source tells every document how often it is given. The sources are as many as
the corpus names; their number is checked against ``MAX_SOURCES`` before they meet in one array, and beyond it
the operator raises an error. Null sources form a source of their own (''); null and empty texts have no tokens
and count as one token, so that they are given like any other. Repeated rows are given one by one. Of the exponents that
meet the target the bisection ends at one; texts of any length count whole; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import BROADCAST_ROWS, configure, join_small, named, stash

#: At most this many sources may meet in one array; beyond it the call is refused.
MAX_SOURCES = 100_000
#: Documents of a block, on average.
BLOCK_DOCS = 2_000
#: Most times the production mix repeats a source.
REPEAT_LIMIT = 2.0
STEPS = 50
#: Words, counted as tokens; written so that Spark and DuckDB agree.
WORD_PATTERN = r"[^\\x20\\x09-\\x0D]+"


def token_count(text: str = "text") -> Column:
    return F.greatest(F.expr(f"coalesce(regexp_count(`{text}`, '{WORD_PATTERN}'), 0)"), F.lit(1)).cast("long")


def _most_repeats(shares: str, a: str) -> str:
    """Repeats of the most repeated source under the exponent, when the least repeated one is given once."""
    each = f"transform({shares}, s -> pow(s, {a} - 1))"
    return f"(array_max({each}) / array_min({each}))"


def _entropy(shares: str, a: str) -> str:
    raised = f"transform({shares}, s -> pow(s, {a}))"
    total = f"aggregate({raised}, 0D, (x, y) -> x + y)"
    return f"(aggregate({raised}, 0D, (x, y) -> x - (y / {total}) * ln(y / {total})))"


def exponent(shares: str, repeat_limit: float | None, target_entropy: float | None) -> Column:
    """Bisected exponent in [0, 1]: the flattest mix within the repetition limit, or the one with the target entropy."""
    if (repeat_limit is None) == (target_entropy is None):
        raise ValueError("give either a repetition limit or a target entropy")
    too_flat = f"{_most_repeats(shares, 'm')} > {float(repeat_limit)}D" if repeat_limit is not None else f"{_entropy(shares, 'm')} > {float(target_entropy)}D"
    return F.expr(
        f"aggregate(sequence(1, {STEPS}), named_struct('lo', 0D, 'hi', 1D), (st, k) -> "
        f"aggregate(array((st.lo + st.hi) / 2), st, (x, m) -> if({too_flat}, named_struct('lo', m, 'hi', x.hi), named_struct('lo', x.lo, 'hi', m)))).hi"
    )


def source_weights(docs: DataFrame, repeat_limit: float | None = REPEAT_LIMIT, target_entropy: float | None = None, budget_factor: float = 1.0) -> DataFrame:
    """Per source: tokens, blocks, the exponent, the weight and the token budget.  ``docs`` has source and tokens."""
    stats = docs.groupBy("source").agg(F.sum("tokens").alias("source_tokens"), F.count("*").alias("source_docs")).checkpoint()
    if stats.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    one = stats.agg(F.array_sort(F.collect_list(F.struct("source", "source_tokens", "source_docs"))).alias("all"))
    one = one.withColumn("corpus", F.expr("aggregate(all, 0L, (x, y) -> x + y.source_tokens)"))
    one = one.withColumn("shares", F.expr("transform(all, y -> y.source_tokens / corpus)"))
    one = one.withColumn("exponent", exponent("shares", repeat_limit, target_entropy))
    one = one.withColumn("raised", F.expr("transform(shares, s -> pow(s, exponent))"))
    one = one.withColumn("total", F.expr("aggregate(raised, 0D, (x, y) -> x + y)"))
    one = one.withColumn("budget", F.expr(f"{float(budget_factor)}D * array_max(transform(arrays_zip(all, raised), y -> y.all.source_tokens * total / y.raised))"))
    flat = one.select("exponent", "total", "budget", F.explode(F.arrays_zip("all", "raised")).alias("s"))
    weight = F.col("s.raised") / F.col("total")
    return flat.select(
        F.col("s.all.source").alias("source"), F.col("s.all.source_tokens").alias("source_tokens"),
        F.ceil(F.col("s.all.source_docs") / F.lit(BLOCK_DOCS)).cast("long").alias("n_blocks"),
        "exponent", weight.alias("weight"),
        F.greatest(F.round(weight * F.col("budget")).cast("long"), F.col("s.all.source_tokens") if budget_factor >= 1 else F.lit(0)).alias("source_budget"),
    )


def _order(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def _identity() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("copy"), F.col("digest")]


def _block(*identity: Column) -> Column:
    return F.conv(F.substring(_order(F.col("source"), *identity), 1, 12), 16, 10).cast("long") % F.col("n_blocks")


def _placed(docs: DataFrame, repeat_limit: float | None, target_entropy: float | None, budget_factor: float) -> tuple[DataFrame, DataFrame]:
    """Every document (copies apart) with its source's figures and its block, and the sources' figures."""
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), token_count().alias("tokens"), F.coalesce(F.md5("text"), F.lit("")).alias("digest"))
    # repeated rows are counted, given apart, and so need no order among themselves
    rows = rows.groupBy("doc_id", "source", "tokens", "digest").agg(F.count("*").alias("rows")).withColumn("copy", F.explode(F.expr("sequence(1L, rows)"))).drop("rows").checkpoint()
    weights = source_weights(rows, repeat_limit, target_entropy, budget_factor)
    weights = weights.withColumn("epochs", F.ceil(F.col("source_budget") / F.col("source_tokens")).cast("long")).checkpoint()
    return join_small(rows, weights, "source", "inner").withColumn("block", _block(*_identity())), weights


def _turns(rows: DataFrame, epochs: str) -> DataFrame:
    """Blocks in the epochs that the SQL array ``epochs`` lists, with their place and the tokens before them."""
    blocks = rows.groupBy("source", "block").agg(F.sum("tokens").alias("block_tokens"), F.first("epochs").alias("epochs"))
    blocks = blocks.withColumn("epoch", F.explode(F.expr(epochs))).drop("epochs").withColumn("order", _order(F.col("source"), F.col("epoch"), F.col("block"))).withColumn("range", F.substring("order", 1, 3))
    turn = W.partitionBy("source", "epoch", "range").orderBy("order", "block")
    blocks = blocks.withColumn("place", F.row_number().over(turn)).withColumn("near", F.sum("block_tokens").over(turn.rowsBetween(W.unboundedPreceding, -1))).checkpoint()
    ranges = blocks.groupBy("source", "epoch", "range").agg(F.count("*").alias("n"), F.sum("block_tokens").alias("t"))
    earlier = W.partitionBy("source", "epoch").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select("source", "epoch", "range", F.sum("n").over(earlier).alias("n"), F.sum("t").over(earlier).alias("t"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return blocks.join(ranges, ["source", "epoch", "range"]).select("source", "epoch", "block", "order", (F.col("place") + zero("n")).cast("long").alias("block_rank"), (zero("near") + zero("t")).alias("before"))


def _inside() -> tuple[Column, Column]:
    """A document's place in its block in an epoch, and the tokens of the block before it."""
    order = _order(F.col("epoch"), *_identity())
    inside = W.partitionBy("source", "epoch", "block").orderBy(order, "doc_id", "copy", "digest")
    return order, F.coalesce(F.sum("tokens").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def mix(spark: SparkSession, docs: DataFrame, repeat_limit: float | None = REPEAT_LIMIT, target_entropy: float | None = None, budget_factor: float = 1.0) -> DataFrame:
    """Realised mix: one row per given copy: doc_id, copy (repeated rows apart), source, tokens, epoch, block,
    block_rank (the block's place in its epoch) and token_offset (tokens of the source given before)."""
    configure(spark)
    rows, _ = _placed(docs, repeat_limit, target_entropy, budget_factor)
    blocks = _turns(rows, "sequence(1L, epochs)").drop("order").checkpoint()
    given = rows.withColumn("epoch", F.explode(F.expr("sequence(1L, epochs)"))).withColumn("inside", _inside()[1])
    given = join_small(given, blocks, ["source", "epoch", "block"], "inner")
    offset = (F.col("epoch") - 1) * F.col("source_tokens") + F.col("before") + F.col("inside")
    given = given.withColumn("token_offset", offset.cast("long")).where(F.col("token_offset") < F.col("source_budget"))
    return given.select("doc_id", "copy", "digest", "source", "tokens", "epoch", "block", "block_rank", "token_offset")


def mix_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return mix(spark, docs).drop("digest")


def _copies(keyed: DataFrame, repeated: DataFrame, salts: int = 64) -> DataFrame:
    """``keyed`` (doc_id, digest, source, row) with the number of each row among its equals; only the repeated ones are looked at."""
    key = ["doc_id", "digest", "source"]
    same = F.expr(" and ".join(f"k.{c} <=> r.{c}" for c in key))
    left, right = keyed.alias("k"), F.broadcast(repeated.alias("r")) if repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else repeated.alias("r")
    once = left.join(right, same, "left_anti").withColumn("copy", F.lit(1).cast("long"))
    again = stash(left.join(right, same, "left_semi").withColumn("at", F.monotonically_increasing_id())).withColumn("salt", F.pmod("at", F.lit(salts)))
    before = W.partitionBy(*key).orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    counts = again.groupBy(*key, "salt").agg(F.count("*").alias("n")).select(*[F.col(c).alias(f"_{c}") for c in (*key, "salt")], F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    again = again.withColumn("k", F.row_number().over(W.partitionBy(*key, "salt").orderBy("at")))
    again = again.join(counts, F.expr(" and ".join(f"{c} <=> _{c}" for c in (*key, "salt")))).withColumn("copy", (F.col("k") + F.col("n")).cast("long"))
    return once.unionByName(again.select(*once.columns))


def mix_rows(spark: SparkSession, docs: DataFrame, repeat_limit: float = REPEAT_LIMIT) -> DataFrame:
    """``docs`` itself, each row as many times as the mix gives it (the columns of ``docs``, whatever their names)."""
    configure(spark)
    rows, weights = _placed(docs.select("doc_id", "source", "text"), repeat_limit, None, 1.0)
    # of each source: the last block that its last epoch reaches, and the last document in it
    base = (F.col("epoch") - 1) * F.col("source_tokens")
    turns = join_small(_turns(rows, "array(epochs)"), weights, "source", "inner").where(base + F.col("before") < F.col("source_budget"))
    last = turns.groupBy("source").agg(F.max_by(F.struct("epoch", "block", "order", "before"), "block_rank").alias("last")).select("source", "last.*").checkpoint()
    order, inside = _inside()
    edge = rows.join(F.broadcast(last), ["source", "block"]).withColumns({"at": order, "inside": inside})  # a row for each of at most MAX_SOURCES sources
    edge = edge.where(base + F.col("before") + F.col("inside") < F.col("source_budget")).groupBy("source").agg(F.max("at").alias("at"))
    places = weights.join(last.select("source", "order"), "source").join(edge, "source").select("source", "n_blocks", "epochs", "order", "at").checkpoint()

    keyed = docs.select("doc_id", F.coalesce(F.md5("text"), F.lit("")).alias("digest"), F.coalesce("source", F.lit("")).alias("source"), F.struct(*named(docs.columns)).alias("row"))
    repeated = rows.where("copy = 2").select("doc_id", "digest", "source").checkpoint()
    keyed = _copies(keyed, repeated) if repeated.limit(1).count() else keyed.withColumn("copy", F.lit(1).cast("long"))
    keyed = keyed.join(F.broadcast(places), "source")
    place = F.concat(_order(F.col("source"), F.col("epochs"), _block(*_identity())), _order(F.col("epochs"), *_identity()))
    times = F.col("epochs") - F.when(place <= F.concat("order", "at"), 0).otherwise(1)
    return keyed.select("row", F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias("k")).select("row.*")


ORACLE = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, coalesce(source, '') AS source, greatest(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')), 1) AS tokens, coalesce(md5(text), '') AS digest FROM documents
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, source, tokens, digest) AS copy FROM base
), stats AS (
  SELECT source, sum(tokens) AS source_tokens, ceil(count(*) / {BLOCK_DOCS}.0) AS n_blocks, sum(tokens) / sum(sum(tokens)) OVER () AS share FROM numbered GROUP BY source
), bisect(k, lo, hi) AS (
  SELECT 1, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT k + 1, CASE WHEN flat THEN m ELSE lo END, CASE WHEN flat THEN hi ELSE m END
  FROM (SELECT k, lo, hi, (lo + hi) / 2 AS m, (SELECT max(pow(share, (lo + hi) / 2 - 1)) / min(pow(share, (lo + hi) / 2 - 1)) FROM stats) > {REPEAT_LIMIT} AS flat FROM bisect WHERE k <= {STEPS})
), raised AS (
  SELECT stats.*, pow(share, (SELECT hi FROM bisect ORDER BY k DESC LIMIT 1)) AS r FROM stats
), weights AS (
  SELECT *, greatest(CAST(round(r / sum(r) OVER () * max_b) AS BIGINT), CAST(source_tokens AS BIGINT)) AS source_budget FROM (SELECT *, max(source_tokens * (SELECT sum(r) FROM raised) / r) OVER () AS max_b FROM raised)
), placed AS (
  SELECT d.*, w.source_tokens, w.source_budget, CAST('0x' || substr(md5(concat_ws('|', d.source, coalesce(CAST(doc_id AS VARCHAR), ''), copy, digest)), 1, 12) AS BIGINT) % CAST(n_blocks AS BIGINT) AS block,
         unnest(range(1, CAST(ceil(source_budget / source_tokens) AS BIGINT) + 1)) AS epoch
  FROM numbered d JOIN weights w USING (source)
), blocks AS (
  SELECT source, epoch, block, row_number() OVER t AS block_rank, coalesce(sum(bt) OVER (t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT source, epoch, block, sum(tokens) AS bt FROM placed GROUP BY ALL)
  WINDOW t AS (PARTITION BY source, epoch ORDER BY md5(concat_ws('|', source, epoch, block)), block)
), inside AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source, epoch, block ORDER BY md5(concat_ws('|', epoch, coalesce(CAST(doc_id AS VARCHAR), ''), copy, digest)), doc_id, copy, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside FROM placed
)
SELECT doc_id, copy, source, CAST(tokens AS BIGINT) AS tokens, epoch, block, block_rank, CAST((epoch - 1) * source_tokens + before + inside AS BIGINT) AS token_offset
FROM inside JOIN blocks USING (source, epoch, block)
WHERE (epoch - 1) * source_tokens + before + inside < source_budget
"""

"""Named queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelore.functions import codec, text
from routelore.operators import dataset, evaluate, registry, review, sampling

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

LANGS = ["en", "fr", "de", "es", "xx"]
QUOTAS = {"click": 40, "view": 25, "purchase": 10, "never": 5}
MINIMUMS = {"valid_decision_rate": 0.5, "route_accuracy": 0.5, "argument_accuracy": 0.9}
SEED = 42
BYTE_LIMIT = 4096
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
CARD = r"[0-9]{16}"


def query(sql: str) -> Callable[[Query], Query]:
    """Registers a query under its own name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql.replace("count_if(", "count(*) FILTER (WHERE ")  # never null
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if v}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-route evaluation table of the documents."""
    return eval_routes(spark, sf_dir)


# Adapters: driver tables as examples, scored rows and candidates


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("input"), F.col("lang").alias("route"), "source")


def langs(spark: SparkSession) -> DataFrame:
    return registry.names_registry(spark, LANGS)


def _values(names: list[str], column: str = "name") -> str:
    return "(VALUES " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(names)) + f") AS r(pos, {column})"


def scored(spark: SparkSession, sf_dir: str, bad: int = 7) -> DataFrame:
    """A deterministic prediction for each document: some invalid, some of the wrong route, some with wrong arguments."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.col("lang").alias("expected"), F.col("text").alias("input"))
    category = F.when(F.col("ord") % bad == 0, F.element_at(F.array(*[F.lit(c) for c in evaluate.CATEGORIES[:4]]), (F.col("ord") % 4 + 1).cast("int")))
    docs = docs.withColumn("category", category)
    predicted = F.when(F.col("category").isNull(), F.when(F.col("ord") % 5 == 1, "en").when(F.col("ord") % 11 == 2, "fr").otherwise(F.col("expected")))
    return docs.withColumn("predicted", predicted).withColumn("arguments_ok", F.col("ord") % 13 != 3)


def _scored(bad: int = 7) -> str:
    cats = ", ".join(f"'{c}'" for c in evaluate.CATEGORIES[:4])
    return f"""base AS (SELECT doc_id AS ord, lang AS expected, text AS input, CASE WHEN doc_id % {bad} = 0 THEN [{cats}][doc_id % 4 + 1] END AS category, doc_id % 13 <> 3 AS arguments_ok FROM documents),
scored AS (SELECT *, CASE WHEN category IS NULL THEN CASE WHEN ord % 5 = 1 THEN 'en' WHEN ord % 11 = 2 THEN 'fr' ELSE expected END END AS predicted FROM base)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labeling result for each document: rejected, invalid or labeled."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("line"), F.col("doc_id").alias("id"), F.col("text").alias("input"), "lang")
    status = F.when(F.col("line") % 10 == 0, "rejected").otherwise("labeled")
    d = d.withColumn("status", status)
    route = F.when(F.col("status") == "labeled", F.when(F.col("line") % 9 == 1, "zz").when(F.col("line") % 6 == 2, "en").otherwise(F.col("lang")))
    d = d.withColumn("route", route).drop("lang")
    category = F.when(F.col("route") == "zz", "unknown_route").when((F.col("status") == "labeled") & (F.col("line") % 8 == 3), "invalid_arguments")
    return d.withColumn("category", category)


_CANDIDATES = """c0 AS (SELECT doc_id AS line, doc_id AS id, text AS input, lang, CASE WHEN doc_id % 10 = 0 THEN 'rejected' ELSE 'labeled' END AS status FROM documents),
c1 AS (SELECT *, CASE WHEN status = 'labeled' THEN CASE WHEN line % 9 = 1 THEN 'zz' WHEN line % 6 = 2 THEN 'en' ELSE lang END END AS route FROM c0),
candidates AS (SELECT *, CASE WHEN route = 'zz' THEN 'unknown_route' WHEN status = 'labeled' AND line % 8 = 3 THEN 'invalid_arguments' END AS category FROM c1)"""
REVIEW_QUOTAS = {"en": 50, "fr": 1000, "de": 20, "xx": 5}


def _digest(namespace: str, route: str, id_: str) -> str:
    return f"sha256('{namespace}' || chr(0) || '{SEED}' || chr(0) || {route} || chr(0) || CAST({id_} AS VARCHAR))"


def _quota_case(quotas: dict[str, int], column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in quotas.items()) + " ELSE 0 END"


_REVIEW = f"""{_CANDIDATES},
picked AS (SELECT line FROM (SELECT line, route, row_number() OVER (PARTITION BY route ORDER BY {_digest(sampling.REVIEW, "route", "id")}, id) AS rn FROM candidates WHERE category IS NULL AND route IS NOT NULL AND status = 'labeled') WHERE rn <= {_quota_case(REVIEW_QUOTAS, "route")}),
reviewed AS (SELECT c.*, p.line IS NOT NULL AS selected, CASE WHEN status = 'rejected' THEN 'provider_rejected' ELSE category END AS reason FROM candidates c LEFT JOIN picked p USING (line)),
rows_ AS (SELECT *, reason IS NULL AS valid, CASE WHEN NOT selected THEN 'unreviewed' WHEN line % 3 = 0 THEN 'approved' WHEN line % 3 = 1 THEN 'rejected' ELSE 'unreviewed' END AS review FROM reviewed)"""
ACCEPT_QUOTAS = {"en": 10, "fr": 30, "de": 0, "xx": 2}


def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review.review_rows(candidates(spark, sf_dir), REVIEW_QUOTAS, SEED)
    return rows.withColumn("review", F.when(~F.col("selected"), "unreviewed").when(F.col("line") % 3 == 0, "approved").when(F.col("line") % 3 == 1, "rejected").otherwise("unreviewed"))


# Distribution, coverage, splits and samples


@query(f"""SELECT r.pos, r.name, count(c.role) AS total, count_if(c.conv_id % 10 < 8) AS train, count_if(c.conv_id % 10 = 8) AS validation, count_if(c.conv_id % 10 = 9) AS test
FROM {_values(["user", "assistant", "system", "tool"])} LEFT JOIN conversations c ON c.role = r.name GROUP BY ALL""")
def route_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("conv_id") % 10 < 8, "train").when(F.col("conv_id") % 10 == 8, "validation").otherwise("test")
    rows = read(spark, sf_dir, "conversations").select(F.col("role").alias("route"), part.alias("part"))
    return dataset.distribution(rows, registry.names_registry(spark, ["user", "assistant", "system", "tool"]))


@query(f"""SELECT s.source AS part, r.pos, r.route FROM (SELECT DISTINCT source FROM documents) s CROSS JOIN {_values(LANGS, "route")}
WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.source = s.source AND d.lang = r.route)""")
def partition_coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).withColumnRenamed("source", "part")
    return dataset.coverage_gaps(rows, langs(spark), rows.select("part").distinct())


@query(f"SELECT r.pos, r.name, count(d.lang) AS n FROM {_values(LANGS)} LEFT JOIN documents d ON d.lang = r.name GROUP BY ALL HAVING count(d.lang) < 3")
def min_group_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.too_small_groups(documents(spark, sf_dir), langs(spark))


_SPLIT = f"""ranked AS (SELECT o_orderkey AS id, o_orderpriority AS route, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_digest(sampling.SPLIT, "o_orderpriority", "o_orderkey")}, o_orderkey) AS rn, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders),
remainders AS (SELECT DISTINCT route, n, n * 8 // 10 AS t0, n // 10 AS v0, n * 8 % 10 AS tr, n % 10 AS vr, n - n * 8 // 10 - 2 * (n // 10) AS spare FROM ranked),
sizes AS (SELECT route, n, CASE WHEN n < 10 THEN n - 2 ELSE t0 + CASE WHEN spare > CASE WHEN vr > tr THEN 2 ELSE 0 END THEN 1 ELSE 0 END END AS train,
  CASE WHEN n < 10 THEN 1 ELSE v0 + CASE WHEN spare > CASE WHEN tr >= vr THEN 1 ELSE 0 END THEN 1 ELSE 0 END END AS validation FROM remainders)"""


@query(f"WITH {_SPLIT} SELECT id, route, rn, CASE WHEN rn <= train THEN 'train' WHEN rn <= train + validation THEN 'validation' ELSE 'test' END AS part FROM ranked JOIN sizes USING (route, n)")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("route"))
    return sampling.stratified_split(rows, SEED).select("id", "route", "rn", "part")


@query(f"WITH {_SPLIT} SELECT route, n, train, validation, n - train - validation AS test FROM sizes")
def split_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("route")).agg(F.count("*").alias("n"))
    train, validation = sampling.split_sizes(F.col("n"))
    return n.select("route", "n", train.alias("train"), validation.alias("validation")).withColumn("test", F.col("n") - F.col("train") - F.col("validation"))


_SAMPLE = f"""picked AS (SELECT event_id AS id, event_type AS route, rn FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {_digest(sampling.REVIEW, "event_type", "event_id")}, event_id) AS rn FROM events) WHERE rn <= {_quota_case(QUOTAS, "event_type")})"""


@query(f"WITH {_SAMPLE} SELECT id, route, rn FROM picked")
def quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("route"))
    return sampling.quota_sample(rows, QUOTAS, SEED).select("id", "route", "rn")


@query(f"WITH {_SAMPLE} SELECT r.pos, r.name, count(p.id) AS selected, {_quota_case(QUOTAS, 'r.name')} AS quota, greatest({_quota_case(QUOTAS, 'r.name')} - count(p.id), 0) AS shortfall FROM {_values([*QUOTAS, 'other'])} LEFT JOIN picked p ON p.route = r.name GROUP BY r.pos, r.name")
def quota_shortfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = quota_sample(spark, sf_dir).groupBy(F.col("route").alias("__route")).agg(F.count("*").alias("selected"))
    known = registry.names_registry(spark, [*QUOTAS, "other"])
    return review._with_quota(dataset.zero_filled(counts, known, "__route", ["selected"]), QUOTAS, "selected")


@query(f"SELECT name FROM (SELECT unnest([{', '.join(repr(q) for q in QUOTAS)}]) AS name) WHERE name NOT IN (SELECT DISTINCT event_type FROM events)")
def unknown_quota_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.unknown_quota_routes(QUOTAS, read(spark, sf_dir, "events").select(F.col("event_type").alias("name")).distinct())


@query("SELECT coalesce(max(n) > 0 AND min(n) <> max(n), false) AS imbalanced FROM (SELECT count(*) AS n FROM events GROUP BY event_type)")
def imbalance_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.imbalance(read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")), "n")


# Identity, leakage, separation


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.duplicates(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


#: DuckDB has no NFKC: the SQL folds case and spaces, which is the same for texts that NFKC leaves alone, as all texts of the
#: driver's tables. Other texts are compared with a brute-force version in the tests.
_FOLD = "trim(regexp_replace(replace(lower({}), 'ß', 'ss'), '\\s+', ' ', 'g'))"


def normalized_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, digest), kept by Spark: what compares them reads them twice."""
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(text.normalize("text"), 256).alias("normalized")).persist()


@query(f"""WITH f AS (SELECT doc_id, {_FOLD.format("text")} AS normalized FROM documents)
SELECT doc_id, first_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY normalized) AS first_id FROM f) WHERE doc_id > first_id""")
def normalized_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.first_declared(normalized_digest(spark, sf_dir), ["normalized"], ["doc_id"]).select("doc_id", F.col("first.doc_id").alias("first_id"))


@query(f"""WITH d AS (SELECT doc_id AS id, {_FOLD.format("text")} AS n FROM documents WHERE doc_id % 4 = 0), c AS (SELECT doc_id - doc_id % 3 AS id, {_FOLD.format("text")} AS n FROM documents WHERE doc_id % 4 <> 0)
SELECT id, 'id' AS reason FROM d WHERE id IN (SELECT id FROM c) UNION ALL SELECT id, 'input' AS reason FROM d WHERE n IN (SELECT n FROM c)""")
def regression_separation(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = normalized_digest(spark, sf_dir)
    replay = d.where("doc_id % 4 = 0").withColumnRenamed("doc_id", "id")
    child = d.where("doc_id % 4 <> 0").select((F.col("doc_id") - F.col("doc_id") % 3).alias("id"), "normalized")
    return dataset.separation(replay, child)


_LINES = """SELECT l_orderkey AS line, lpad(CAST(l_partkey AS VARCHAR), 12, '0') || l_returnflag || CAST(l_suppkey AS VARCHAR) || l_linestatus || CAST(l_quantity AS VARCHAR) || CAST(l_extendedprice AS VARCHAR) AS source,
CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber // 2 AS VARCHAR) END AS id, lower(l_returnflag || ' ' || CAST(l_partkey AS VARCHAR) || ' ' || CAST(l_suppkey AS VARCHAR)) AS input FROM lineitem"""


@query(f"""WITH e AS ({_LINES}), good AS (SELECT *, (line, source) AS place FROM e WHERE id <> ''),
firsts AS (SELECT *, min(place) OVER (PARTITION BY id) AS first_id, min(place) OVER (PARTITION BY input) AS first_input FROM good)
SELECT 'id must be a non-blank string' AS message, count(*) AS n FROM e WHERE id = '' UNION ALL SELECT 'duplicate id', count(*) FROM firsts WHERE place > first_id UNION ALL SELECT 'duplicate normalized input', count(*) FROM firsts WHERE place > first_input""")
def dataset_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three kinds of violation over the whole of lineitem."""
    text_of = lambda c: F.col(c).cast("string")
    rows = read(spark, sf_dir, "lineitem").select(
        F.lit(0).alias("part_pos"), F.concat(F.lpad(text_of("l_partkey"), 12, "0"), "l_returnflag", text_of("l_suppkey"), "l_linestatus", text_of("l_quantity"), text_of("l_extendedprice")).alias("source"), F.col("l_orderkey").alias("line"),
        F.when(F.col("l_linenumber") == 1, "").otherwise(F.concat_ws("-", "l_orderkey", F.expr("l_linenumber div 2"))).alias("id"), F.concat_ws("  ", "l_returnflag", "l_partkey", "l_suppkey").alias("input"),
    )
    found = dataset.validate(rows, text.normalize("input"))
    return found.groupBy(F.split("message", ";")[0].alias("message")).agg(F.count("*").alias("n"))


# Text functions, projection


@query(f"SELECT doc_id, regexp_replace(regexp_replace(text, '{EMAIL}', '[email]', 'g'), '{CARD}', '[card]', 'g') AS input FROM documents")
def redact_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", text.redact(F.col("text"), [(EMAIL, "[email]"), (CARD, "[card]")]).alias("input"))


@query(f"SELECT doc_id, strlen(text) AS n_bytes FROM documents WHERE strlen(text) > {BYTE_LIMIT}")
def size_limit_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").where(~text.within_bytes(F.col("text"), BYTE_LIMIT)).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"))


@query("SELECT event_id, CASE WHEN json_exists(props, '$.k') THEN 'found' ELSE 'missing' END AS state, json_extract_string(props, '$.k') AS k FROM events")
def json_pointer_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    from routelore.sources.pointer import resolve

    return read(spark, sf_dir, "events").select("event_id", resolve(F.col("props"), "/k").alias("r")).select("event_id", "r.state", F.col("r.value").alias("k"))


_GUARDED = "CASE WHEN regexp_matches({0}, '^[=+@\\t\\r\\n-]') THEN '''' || {0} ELSE {0} END"


@query(f"SELECT page_id, {_GUARDED.format('url')} AS url, sha256({_GUARDED.format('html')}) AS cell, sha256({_GUARDED.format('substr(html, 7)')}) AS inner_cell FROM pages")
def csv_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = lambda c: F.sha2(text.csv_cell(c), 256)
    return read(spark, sf_dir, "pages").select("page_id", text.csv_cell(F.col("url")).alias("url"), cell(F.col("html")).alias("cell"), cell(F.expr("substr(html, 7)")).alias("inner_cell"))


@query("SELECT doc_id, sha256(text || chr(10)) AS sha256 FROM documents")
def row_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", text.row_sha256(F.col("text")).alias("sha256"))


# Evaluation

_VALID, _RIGHT = "category IS NULL AND predicted IS NOT NULL", "category IS NULL AND predicted = expected"


def _metrics(bad: int) -> str:
    return f"SELECT *, valid_decisions / examples AS valid_decision_rate, route_correct / examples AS route_accuracy, argument_correct / examples AS argument_accuracy FROM (SELECT count(*) AS examples, count_if({_VALID}) AS valid_decisions, count_if({_RIGHT}) AS route_correct, count_if({_RIGHT} AND arguments_ok) AS argument_correct FROM scored)"


@query(f"WITH {_scored()} {_metrics(7)}")
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.metrics(scored(spark, sf_dir))


_ROUTES = f"""SELECT pos, name, support, predictions, true_positives, CASE WHEN predictions > 0 THEN true_positives / predictions END AS precision, CASE WHEN support > 0 THEN true_positives / support END AS recall FROM (
SELECT r.pos, r.name, (SELECT count(*) FROM scored WHERE expected = r.name) AS support, (SELECT count(*) FROM scored WHERE {_VALID} AND predicted = r.name) AS predictions, (SELECT count(*) FROM scored WHERE {_RIGHT} AND expected = r.name) AS true_positives FROM {_values(LANGS)})"""


@query(f"WITH {_scored()} {_ROUTES}")
def eval_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.route_metrics(scored(spark, sf_dir), langs(spark))


@query(f"WITH {_scored()} SELECT expected, predicted, count(*) AS n FROM scored WHERE {_VALID} GROUP BY ALL")
def eval_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(scored(spark, sf_dir))


@query(f"WITH {_scored()} SELECT r.pos, r.category, count(s.ord) AS count FROM {_values(evaluate.CATEGORIES, 'category')} LEFT JOIN scored s ON s.category = r.category GROUP BY r.pos, r.category")
def eval_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.invalid_counts(scored(spark, sf_dir))


@query(f"""WITH {_scored()}, failed AS (SELECT * FROM scored WHERE NOT coalesce({_RIGHT} AND arguments_ok, false))
SELECT expected, predicted, category, ord, sha256(input) AS input_sha256 FROM failed QUALIFY row_number() OVER (PARTITION BY expected, predicted, category ORDER BY ord) = 1""")
def eval_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.representatives(scored(spark, sf_dir), shown=["input"])
    return found.select("expected", "predicted", "category", "ord", F.sha2("input", 256).alias("input_sha256"))


@query(f"""WITH {_scored()}, m AS ({_metrics(7)}), g AS (
{" UNION ALL ".join(f"SELECT {i} AS pos, '{n}' AS name, {float(MINIMUMS[n])}::DOUBLE AS minimum, {n} AS actual FROM m" for i, n in enumerate(evaluate.THRESHOLDS))})
SELECT *, actual >= minimum AS passed, bool_and(actual >= minimum) OVER () AS all_passed FROM g""")
def eval_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.gates(eval_metrics(spark, sf_dir), MINIMUMS)


_CONFUSION = "(SELECT expected, predicted, count(*) AS n FROM scored WHERE category IS NULL GROUP BY ALL)"


def _reconciled(label: str, matrix: str, invalid: str) -> str:
    return f"""SELECT '{label}' AS report, (SELECT coalesce(sum(n), 0) FROM {matrix}) = m.valid_decisions AS confusion_total, (SELECT coalesce(sum(n), 0) FROM {matrix} WHERE expected = predicted) = m.route_correct AS confusion_diagonal,
(SELECT coalesce(sum(n), 0) FROM {invalid}) = m.examples - m.valid_decisions AS invalid_total, abs(m.route_accuracy - m.route_correct / m.examples) <= 1e-12 AS rate FROM m"""


_INVALID = "(SELECT category, count(*) AS n FROM scored WHERE category IS NOT NULL GROUP BY ALL)"


@query(f"""WITH {_scored()}, m AS ({_metrics(7)}) {_reconciled("as made", _CONFUSION, _INVALID)}
UNION ALL {_reconciled("without a row", f"(SELECT * FROM {_CONFUSION} WHERE expected <> 'en')", _INVALID)} UNION ALL {_reconciled("without a category", _CONFUSION, f"(SELECT * FROM {_INVALID} WHERE category <> '{evaluate.CATEGORIES[1]}')")}""")
def eval_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as it is, and with tables that lack a part: the checks must tell."""
    metrics, matrix, invalid = eval_metrics(spark, sf_dir), eval_confusion(spark, sf_dir), eval_invalid(spark, sf_dir)
    cases = {"as made": (matrix, invalid), "without a row": (matrix.where("expected <> 'en'"), invalid), "without a category": (matrix, invalid.where(F.col("category") != evaluate.CATEGORIES[1]))}
    found = [evaluate.reconcile(metrics, *tables).select(F.lit(name).alias("report"), "*") for name, tables in cases.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(f"""WITH p AS (WITH {_scored(7)} {_metrics(7)}), c AS (WITH {_scored(9)} {_metrics(9)})
SELECT p.route_accuracy - c.route_accuracy AS route_drop, p.argument_accuracy - c.argument_accuracy AS argument_drop, p.route_accuracy - c.route_accuracy <= 0.01 AND p.argument_accuracy - c.argument_accuracy <= 0.0 AS passed FROM p, c""")
def comparison_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.comparison(evaluate.metrics(scored(spark, sf_dir)), evaluate.metrics(scored(spark, sf_dir, 9)), 0.01, 0.0)


@query(f"WITH {_scored()}, t AS ({_ROUTES}) SELECT count(*) = 2 AND bool_and(coalesce(recall = 1.0, false)) AS passed FROM t WHERE name IN ('en', 'xx')")
def added_route_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.added_recall(eval_routes(spark, sf_dir), ["en", "xx"])


# Review, gold, acceptance


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labeled documents as gold rows; the gold route is the document's language."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = read(spark, sf_dir, "labels")
    return labels.join(docs, "doc_id").select(F.col("doc_id").alias("id"), F.col("lang").alias("gold_route"), (F.col("quality") == 1).alias("gold_flag"))


@query(f"""WITH {_CANDIDATES}, pairs AS (SELECT d.lang AS g, l.quality = 1 AS flag, c.status = 'labeled' AND c.route IS NOT NULL AS decided, c.category, c.route FROM labels l JOIN documents d USING (doc_id) JOIN candidates c ON c.id = l.doc_id),
counts AS (SELECT r.pos, r.name, count(g) AS examples, count_if(decided AND category IS NULL) AS valid, count_if(decided AND category IS NOT NULL) AS invalid, count_if(NOT decided) AS missing,
count_if(decided AND category IS NULL AND route = g) AS route_correct, count_if(decided AND category IS NULL AND route = g AND flag) AS exact FROM {_values(LANGS)} LEFT JOIN pairs ON g = r.name GROUP BY r.pos, r.name)
SELECT *, CASE WHEN examples > 0 THEN (invalid + missing) / examples END AS invalid_decision_rate FROM counts""")
def gold_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.gold_quality(gold(spark, sf_dir), candidates(spark, sf_dir), langs(spark), F.col("gold_flag"))


@query("""WITH g AS (SELECT CASE WHEN doc_id % 50 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN doc_id + 10000000 WHEN doc_id % 11 = 0 THEN 11 ELSE doc_id END AS id FROM labels)
SELECT id, 'null id' AS reason FROM g WHERE id IS NULL UNION ALL SELECT id, 'repeated id' FROM g WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
UNION ALL SELECT DISTINCT id, 'unknown id' FROM g WHERE id IS NOT NULL AND id NOT IN (SELECT doc_id FROM documents)""")
def gold_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_ = F.when(F.col("doc_id") % 50 == 0, None).when(F.col("doc_id") % 7 == 0, F.col("doc_id") + 10_000_000).when(F.col("doc_id") % 11 == 0, 11).otherwise(F.col("doc_id"))
    return review.gold_orphans(read(spark, sf_dir, "labels").select(id_.alias("id")), candidates(spark, sf_dir))


@query(f"WITH {_REVIEW} SELECT line, status, route, reason, valid, selected FROM rows_")
def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.review_rows(candidates(spark, sf_dir), REVIEW_QUOTAS, SEED).select("line", "status", "route", "reason", "valid", "selected")


@query(f"""WITH {_REVIEW} SELECT r.pos, r.name, count(c.line) AS candidate_rows, count_if(NOT c.valid AND c.status = 'labeled') AS locally_invalid, count_if(c.selected) AS selected, count_if(c.selected) AS unreviewed,
{_quota_case(REVIEW_QUOTAS, 'r.name')} AS quota, greatest({_quota_case(REVIEW_QUOTAS, 'r.name')} - count_if(c.selected), 0) AS shortfall FROM {_values(LANGS)} LEFT JOIN rows_ c ON c.route = r.name GROUP BY r.pos, r.name""")
def review_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.quality(review.review_rows(candidates(spark, sf_dir), REVIEW_QUOTAS, SEED), langs(spark), REVIEW_QUOTAS)


@query(f"WITH {_CANDIDATES} SELECT count(*) AS rows, count_if(route IS NULL) AS without_decision, count_if(route IS NULL) / count(*) AS rejection_rate FROM candidates")
def rejection_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.quality_totals(candidates(spark, sf_dir))


_ACCEPT = f"""{_REVIEW}, accepted AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY route ORDER BY {_digest(sampling.ACCEPT, "route", "id")}, id) AS rn FROM rows_ WHERE review = 'approved' AND selected AND valid AND status = 'labeled') WHERE rn <= {_quota_case(ACCEPT_QUOTAS, "route")})"""


@query(f"WITH {_ACCEPT} SELECT line, id, route, sha256(input) AS input_sha256, '{{\"source_id\":' || id || ',\"source_line\":' || line || ',\"status\":\"labeled\",\"review\":\"approved\",\"reason\":null}}' AS lineage FROM accepted")
def accepted_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review.accept(reviewed(spark, sf_dir), ACCEPT_QUOTAS, SEED)
    return rows.select("line", "id", "route", F.sha2("input", 256).alias("input_sha256"), F.col("metadata")[review.LINEAGE].alias("lineage"))


@query(f"""WITH {_ACCEPT} SELECT r.pos, r.name, count(c.line) AS candidate_rows, count_if(NOT c.valid AND c.status = 'labeled') AS locally_invalid, count_if(c.selected) AS selected, count_if(c.selected AND c.review = 'approved') AS approved, count_if(c.selected AND c.review = 'rejected') AS reviewer_rejected,
count_if(c.selected AND c.review = 'unreviewed') AS unreviewed, count_if(a.line IS NOT NULL) AS accepted, {_quota_case(ACCEPT_QUOTAS, 'r.name')} AS quota, greatest({_quota_case(ACCEPT_QUOTAS, 'r.name')} - count_if(a.line IS NOT NULL), 0) AS shortfall
FROM {_values(LANGS)} LEFT JOIN rows_ c ON c.route = r.name LEFT JOIN accepted a ON a.line = c.line GROUP BY r.pos, r.name""")
def acceptance_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reviewed(spark, sf_dir)
    return review.acceptance_quality(rows, review.accept(rows, ACCEPT_QUOTAS, SEED), langs(spark), ACCEPT_QUOTAS)


@query("""SELECT line, CASE WHEN c IS NULL THEN 'candidate missing' WHEN i IS NULL THEN 'input missing' ELSE 'ids differ' END AS message FROM (
SELECT coalesce(a.line, b.line) AS line, a.id AS i, b.id AS c FROM (SELECT doc_id AS line, doc_id AS id FROM documents WHERE doc_id % 17 <> 0) a FULL JOIN (SELECT doc_id AS line, CASE WHEN doc_id % 23 = 0 THEN -1 ELSE doc_id END AS id FROM documents WHERE doc_id % 19 <> 0) b USING (line)) WHERE i IS NULL OR c IS NULL OR i <> c""")
def position_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("line"))
    inputs = d.where("line % 17 <> 0").withColumn("id", F.col("line"))
    return review.bind_by_position(inputs, d.where("line % 19 <> 0").withColumn("id", F.when(F.col("line") % 23 == 0, -1).otherwise(F.col("line"))))


# Registries, decisions, calls


@query("""WITH p AS (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS pos, n_name AS old FROM nation WHERE n_nationkey < 20), c AS (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS pos, CASE WHEN n_nationkey = 3 THEN 'other' ELSE n_name END AS new FROM nation)
SELECT coalesce(p.pos, c.pos) AS pos, old, new, CASE WHEN old IS NULL THEN 'added' WHEN old = new THEN 'retained' ELSE 'changed' END AS state FROM p FULL JOIN c ON p.pos = c.pos""")
def registry_prefix_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nations as a child registry of the first twenty."""
    names = [r["n_name"] for r in read(spark, sf_dir, "nation").select("n_name", "n_nationkey").orderBy("n_nationkey").limit(registry.MAX_ROUTES + 1).collect()]  # a registry has a bounded size
    if len(names) > registry.MAX_ROUTES:
        raise ValueError(f"more than {registry.MAX_ROUTES} routes")
    child = [("other" if i == 3 else n) for i, n in enumerate(names)]
    found = registry.registry_change(registry.names_registry(spark, names[:20]), registry.names_registry(spark, child))
    return found.withColumn("pos", F.col("pos").cast("long"))


EVENT_ROUTES = [registry.Route(n, f"a {n}", {"user": "integer", "value": "number", "k": "string"}, ("user", "k")) for n in ("click", "view", "purchase", "signup")]


def event_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as decisions: a route and arguments, some of them missing, unknown or of a wrong kind."""
    e = read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("route"), "user_id")
    value = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.cast("string").alias("text"))
    user = F.when(F.col("event_id") % 4 == 0, value("string", F.col("user_id"))).otherwise(value("integer", F.col("user_id")))
    full = F.create_map(F.lit("user"), user, F.lit("k"), value("string", F.concat(F.lit("k "), F.col("event_id").cast("string"))))
    return e.withColumn("arguments", F.when(F.col("event_id") % 5 == 0, F.create_map(F.lit("extra"), value("boolean", F.lit(True)))).otherwise(full))


@query("""SELECT event_id, CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN 'unknown_route' WHEN event_id % 5 = 0 OR event_id % 4 = 0 THEN 'invalid_arguments' END AS category,
CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN '' WHEN event_id % 5 = 0 THEN 'missing required argument user; missing required argument k; unknown argument extra' WHEN event_id % 4 = 0 THEN 'argument user must be integer, not string' ELSE '' END AS detail FROM events""")
def decision_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.validate_decisions(event_decisions(spark, sf_dir), registry.registry(spark, EVENT_ROUTES)).select("event_id", "category", "detail")


@query("SELECT event_id, event_type AS route, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 2 END AS n_arguments, CAST(NULL AS VARCHAR) AS category, true AS same FROM events")
def call_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_decisions(spark, sf_dir).withColumn("raw", codec.render_call(F.col("route"), F.col("arguments")))
    parsed = codec.with_parsed(rows, "raw", "p")
    same = registry.arguments_equal(F.col("arguments"), F.col("p.arguments"))
    return parsed.select("event_id", F.col("p.name").alias("route"), F.size("p.arguments").alias("n_arguments"), F.col("p.category").alias("category"), same.alias("same"))


@query("""SELECT event_id, '{"arguments":{' || CASE WHEN event_id % 5 = 0 THEN '"extra":true' ELSE '"k":"k ' || event_id || '","user":' || CASE WHEN event_id % 4 = 0 THEN '"' || user_id || '"' ELSE CAST(user_id AS VARCHAR) END END || '},"name":"' || event_type || '"}' AS json FROM events""")
def render_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_decisions(spark, sf_dir).select("event_id", codec.render_json(F.col("route"), F.col("arguments")).alias("json"))


@query("""SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'rejected' ELSE 'labeled' END AS status, CASE WHEN doc_id % 6 <> 0 THEN lang END AS route,
CASE WHEN doc_id % 6 = 0 THEN ['refusal', 'timeout', 'rate_limited', 'malformed_response'][doc_id // 6 % 4 + 1] END AS rejection_reason FROM documents""")
def candidate_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from routelore.operators.enrich import label_candidates
    from routelore.plans.stub import StubClient

    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("line"), F.concat_ws("|", "doc_id", "lang", "text").alias("input"))
    found = label_candidates(docs, StubClient, registry.registry(spark, [registry.Route(n) for n in LANGS]))
    return found.select(F.col("id").alias("doc_id"), "status", "route", "rejection_reason")


from routelore.plans import chain, contracts, files  # noqa: E402, F401  register further queries

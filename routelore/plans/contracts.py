"""Queries over the text codecs, provider answers, formats, token records, positions and document versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routelore.functions import codec, text
from routelore.operators import dataset, enrich, evaluate, migrations, registry, review, training_data
from routelore.plans.registry import EVENT_ROUTES, event_decisions, query, read

_EVENT = "WITH e AS (SELECT *, event_id % 12 AS k FROM events)"


def _sql_case(column: str, cases: dict[int, str], other: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN {v}" for k, v in cases.items()) + f" ELSE {other} END"


# Calls that fail, and what they fail by

#: A call of each kind: {t} is the event's type, {n} its number.
CALLS = {
    0: ("  ", "missing_function_call"), 1: ("I would click.", "missing_function_call"), 2: ("Sure: {c}call:{t}{{k:<escape>a<escape>,user:{n}}}{e}", "malformed_function_call"), 3: ("{c}call:{t}{{k:<escape>a<escape>,user:{n}}}", "malformed_function_call"),
    4: ("{c}call:{t}{{k:<escape>a<escape>,k:<escape>b<escape>}}{e}", "malformed_function_call"), 5: ("{c}call:{t}{{user:{n},}}{e}", "malformed_function_call"), 6: ("{c}call:{t}{{user:null}}{e}", "invalid_argument_syntax"),
    7: ("{c}call:{t}{{user:\"{n}\"}}{e}", "invalid_argument_syntax"), 8: ("{c}call:nowhere{{user:{n}}}{e}", "unknown_route"), 9: ("{c}call:{t}{{user:{n}}}{e}", None), 10: ("{c}call:{t}{{k:<escape>a<escape>,user:{n}.5}}{e}", None),
    11: ("{c}call:{t}{{k:<escape>a, {{b}}<escape>, user: {n} }}{e}<start_function_response>", None),
}
_KNOWN = "event_type IN ('click', 'view', 'purchase', 'signup')"
_VALIDATED = {9: f"CASE WHEN {_KNOWN} THEN 'invalid_arguments' ELSE 'unknown_route' END", 10: f"CASE WHEN {_KNOWN} THEN 'invalid_arguments' ELSE 'unknown_route' END", 11: f"CASE WHEN NOT {_KNOWN} THEN 'unknown_route' END"}


@query(f"""{_EVENT} SELECT event_id, {_sql_case("k", {k: f"'{c}'" for k, (_, c) in CALLS.items() if c} | _VALIDATED, "NULL")} AS category, CASE WHEN k = 8 THEN 'nowhere' WHEN k > 8 THEN event_type END AS route,
CASE WHEN k IN (8, 9) THEN 1 WHEN k > 9 THEN 2 END AS n_arguments FROM e""")
def call_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of twelve kinds, most of them bad, through the parser and the registry."""
    form = F.create_map(*[F.lit(x) for k, (t, _) in CALLS.items() for x in (k, t.format(c=codec.CALL, e=codec.END_CALL, t="@type@", n="@number@"))])
    rows = read(spark, sf_dir, "events").withColumn("raw", form[(F.col("event_id") % 12).cast("int")])
    rows = rows.select("event_id", F.replace(F.replace("raw", F.lit("@type@"), F.col("event_type")), F.lit("@number@"), F.col("event_id").cast("string")).alias("raw"))
    found = codec.parse_and_validate(rows, registry.registry(spark, EVENT_ROUTES))
    return found.select("event_id", "category", "route", F.when(F.col("route").isNotNull(), F.size("arguments")).alias("n_arguments"))


_DECLARED = "".join(
    f"<start_function_declaration>declaration:{n}{{description:<escape>a {n}<escape>,parameters:{{properties:{{k:{{description:<escape><escape>,type:<escape>STRING<escape>}},user:{{description:<escape><escape>,type:<escape>INTEGER<escape>}},value:{{description:<escape><escape>,type:<escape>NUMBER<escape>}}}},"
    "required:[<escape>user<escape>,<escape>k<escape>],type:<escape>OBJECT<escape>}}<end_function_declaration>"
    for n in ("click", "view", "purchase", "signup")
)


@query(f"""SELECT conv_id, turn, sha256('<bos><start_of_turn>developer' || chr(10) || '{_DECLARED}<end_of_turn>' || chr(10) || '<start_of_turn>user' || chr(10) || trim(text, ' ' || chr(9) || chr(10) || chr(13)) || '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10)) AS prompt FROM conversations""")
def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", F.sha2(codec.render_prompt(F.concat(F.lit(" \t"), "text", F.lit("\n")), EVENT_ROUTES), 256).alias("prompt"))


@query("""SELECT event_id, '{"tool_calls":[{"function":{"arguments":"{' || CASE WHEN event_id % 5 = 0 THEN '\\"extra\\":true' ELSE '\\"k\\":\\"k ' || event_id || '\\",\\"user\\":' || CASE WHEN event_id % 4 = 0 THEN '\\"' || user_id || '\\"' ELSE CAST(user_id AS VARCHAR) END END || '}","name":"' || event_type || '"},"type":"function"}]}' AS call FROM events""")
def render_tool_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_decisions(spark, sf_dir).select("event_id", codec.render_tool_call(F.col("route"), F.col("arguments")).alias("call"))


_WANTED = "CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN NULL WHEN event_id % 5 = 0 THEN 'add user; add k; remove extra' WHEN event_id % 4 = 0 THEN 'set user to a integer' ELSE '' END"


@query(f"SELECT event_id, {_WANTED} AS correction FROM events")
def decision_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = registry.validate_decisions(event_decisions(spark, sf_dir), registry.registry(spark, EVENT_ROUTES))
    return found.select("event_id", F.when(F.col("corrections").isNotNull(), F.array_join("corrections", "; ")).alias("correction"))


# Provider answers

#: A provider's content of each kind, and whether it is a decision.
CONTENTS = {
    0: ('{"name": "click", "arguments": {"user": @n@, "k": "a"}}', True), 1: ('{"name": "click", "name": "view"}', False), 2: ('{"name": "click"} x', False), 3: ('{"name": "click", "arguments": {"user": NaN}}', False), 4: ('{"name": "click", "arguments": {"user": 1e999}}', False),
    5: ('{"name": ""}', False), 6: ("[]", False), 7: ("", False), 8: ('{"name": "click", "more": @n@}', False), 9: ('{"name": "click", "arguments": {"user": "@n@", "k": "a"}}', True), 10: ('{"name": "click", "arguments": {"k": "\\ud800", "user": @n@}}', True), 11: ('{"name": "nowhere"}', True),
}
_REASON = _sql_case("k", {k: "'malformed_response'" for k, (_, good) in CONTENTS.items() if not good} | {9: "'invalid_decision'", 10: "'invalid_decision'", 11: "'invalid_decision'"}, "NULL")


class ContentClient:
    """Answers with the content that the input is, and fails in ways that are or are not worth another attempt."""

    failures = ("timed_out", "transport_failed", "rate_limited")

    def request(self, text: str) -> enrich.Response:
        if text.startswith("fail"):
            status = self.failures[int(text.split()[1]) % 3]
            return enrich.Response(status, retryable=status != "rate_limited")
        return enrich.Response("succeeded", text)


@query(f"""{_EVENT} SELECT event_id, CASE WHEN event_id % 25 = 24 THEN ['timed_out', 'transport_failed', 'rate_limited'][event_id % 3 + 1] ELSE 'succeeded' END AS request_status, CASE WHEN event_id % 25 = 24 THEN ['timeout', 'transport_failure', 'rate_limited'][event_id % 3 + 1] ELSE {_REASON} END AS rejection_reason,
CASE WHEN event_id % 25 = 24 THEN CASE WHEN event_id % 3 = 2 THEN 1 ELSE 3 END WHEN k IN (2, 7) THEN 3 ELSE 1 END AS attempts FROM e""")
def provider_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict parsing, retries of content that is no JSON and of retryable failures, and the reasons of rejection."""
    form = F.create_map(*[F.lit(x) for k, (t, _) in CONTENTS.items() for x in (k, t)])
    content = F.replace(form[(F.col("event_id") % 12).cast("int")], F.lit("@n@"), F.col("event_id").cast("string"))
    value = F.when(F.col("event_id") % 25 == 24, F.concat_ws(" ", F.lit("fail"), "event_id")).otherwise(content)
    rows = read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), value.alias("input"))
    answers = enrich.ask(rows, ContentClient, max_retries=2, delay=0.0)
    return enrich.candidates(answers, registry.registry(spark, EVENT_ROUTES)).select(F.col("id").alias("event_id"), "request_status", "rejection_reason", "attempts")


# Formats


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS stamp, event_id % 4 <> 1 AND event_id % 4 <> 3 AS any_zone, event_id % 4 = 0 AS utc FROM events""")
def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered times, and checks of their spellings: as they are, with an impossible month, with an offset, without a zone."""
    e = read(spark, sf_dir, "events").withColumn("stamp", text.timestamp_text(F.col("ts").cast("timestamp")))
    k, head = F.col("event_id") % 4, F.substring("stamp", 1, 19)
    spelled = F.when(k == 1, F.concat(F.substring("stamp", 1, 5), F.lit("13"), F.substring("stamp", 8, 20))).when(k == 2, F.concat(head, F.lit("+02:00"))).when(k == 3, head).otherwise(F.col("stamp"))
    return e.select("event_id", "stamp", text.valid_timestamp(spelled).alias("any_zone"), text.valid_timestamp(spelled, utc_only=True).alias("utc"))


_GOOD_URL = "regexp_matches({}, '^https?://[^/?#@]+(/[^?#]*)?$')"


@query(f"""SELECT page_id, {_GOOD_URL.format("url")} AS plain, {_GOOD_URL.format("replace(url, '://', '://a:b@')")} AS with_user, {_GOOD_URL.format("regexp_replace(url, '^https?', 'ftp')")} AS other_scheme,
{_GOOD_URL.format("regexp_replace(url, '[?#].*$', '')")} AS cut FROM pages""")
def endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", text.valid_endpoint(u).alias("plain"), text.valid_endpoint(F.regexp_replace(u, "://", "://a:b@")).alias("with_user"), text.valid_endpoint(F.regexp_replace(u, "^https?", "ftp")).alias("other_scheme"), text.valid_endpoint(F.regexp_replace(u, "[?#].*$", "")).alias("cut"))


@query("""SELECT doc_id, sha256(trim(text, ' ' || chr(9) || chr(10) || chr(13))) AS stripped, length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) = 0 AS is_blank FROM documents""")
def stripped_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" \x1f\t"), "text", F.lit("\n  "))
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(text.strip(padded), 256).alias("stripped"), text.blank(padded).alias("is_blank"))


@query("SELECT l_returnflag AS flag, l_linestatus AS status, abs(sum(l_quantity) / count(*) - avg(l_quantity)) <= 1e-12 AS close, abs(avg(l_quantity) - (avg(l_quantity) + 1e-9)) <= 1e-12 AS apart FROM lineitem GROUP BY ALL")
def rate_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.avg("l_quantity").alias("a"), (F.sum("l_quantity") / F.count("*")).alias("b"))
    return found.select("flag", "status", text.same_rate(F.col("a"), F.col("b")).alias("close"), text.same_rate(F.col("a"), F.col("a") + 1e-9).alias("apart"))


# Token records


def char_tokenizer():
    """Code points as tokens: a stand-in that any SQL can follow."""
    return lambda value: [ord(c) for c in value]


_CALL_TEXT = "'ask ' || conv_id || '<start_function_call>' || role"


def _listed(column: str) -> Column:
    """An array as text, which any comparison takes."""
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.concat(F.lit("ask "), F.col("conv_id").cast("string"), F.when(F.col("turn") % 5 != 4, codec.CALL).otherwise(""), F.col("role")).alias("compiled"))
    return training_data.token_records(rows, char_tokenizer, 40)


@query(f"""WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 5 <> 4 THEN {_CALL_TEXT} END AS t, length('ask ' || conv_id) AS p FROM conversations)
SELECT conv_id, turn, CASE WHEN length(t) <= 40 THEN array_to_string(list_transform(range(1, length(t) + 1), lambda i: unicode(t[i])), ' ') END AS input_ids, CASE WHEN length(t) <= 40 THEN array_to_string(list_transform(range(1, length(t) + 1), lambda i: CASE WHEN i <= p THEN -100 ELSE unicode(t[i]) END), ' ') END AS labels,
CASE WHEN t IS NULL THEN 'not exactly one call' WHEN length(t) > 40 THEN 'more than 40 tokens' END AS error FROM c""")
def token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("conv_id", "turn", _listed("input_ids"), _listed("labels"), "error")


@query("""WITH d AS (SELECT doc_id, doc_id // 8 AS batch, doc_id % 11 + 1 AS n FROM documents), w AS (SELECT *, max(n) OVER (PARTITION BY batch) AS width FROM d)
SELECT doc_id, batch, array_to_string(list_concat(range(n), list_transform(range(width - n), lambda x: -1)), ' ') AS input_ids, array_to_string(list_concat(list_transform(range(n), lambda x: 7), list_transform(range(width - n), lambda x: -100)), ' ') AS labels,
array_to_string(list_concat(list_transform(range(n), lambda x: 1), list_transform(range(width - n), lambda x: 0)), ' ') AS attention_mask FROM w""")
def padded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("doc_id") % 11 + 1).cast("int")
    rows = read(spark, sf_dir, "documents").select("doc_id", F.transform(F.sequence(F.lit(1), n), lambda x: x - 1).alias("input_ids"), F.array_repeat(F.lit(7), n).alias("labels"))
    return training_data.collate(rows, "doc_id", 8, -1).select("doc_id", "batch", *map(_listed, ("input_ids", "labels", "attention_mask")))


# Positions, separation and versions


@query("""WITH d AS (SELECT doc_id + 1 AS line, doc_id AS id FROM documents) SELECT a.line, CASE WHEN a.line % 13 = 0 THEN 'more than the review was changed' END AS message FROM d a JOIN d b USING (line) JOIN d c USING (line) WHERE a.line % 13 = 0""")
def review_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, candidates and reviews by position: the reviews whose source differs."""
    d = read(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("line"), F.col("doc_id").alias("id"), "text")
    inputs = d.select("line", "id", F.sha2("text", 256).alias("input"))
    edited = d.select("line", "id", F.sha2(F.when(F.col("line") % 13 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("input"))
    return review.source_changes(edited, inputs.join(d.select("line"), "line"), ["id", "input"])


@query("""WITH e AS (SELECT doc_id, doc_id % 3 AS part_pos, CASE WHEN doc_id % 40 = 0 THEN '  ' WHEN doc_id % 10 = 3 THEN 'same ' || doc_id % 7 ELSE CAST(doc_id AS VARCHAR) END AS id FROM documents),
f AS (SELECT *, (part_pos, doc_id) AS place, min((part_pos, doc_id)) OVER (PARTITION BY id) AS first FROM e WHERE trim(id) <> '')
SELECT doc_id, part_pos, 'id must be a non-blank string' AS message FROM e WHERE trim(id) = '' UNION ALL SELECT doc_id, part_pos, 'duplicate id' FROM f WHERE place > first""")
def partition_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank ids, and ids that repeat inside and across the three partitions, in one pass over all of them."""
    d = read(spark, sf_dir, "documents")
    id_ = F.when(F.col("doc_id") % 40 == 0, "  ").when(F.col("doc_id") % 10 == 3, F.concat(F.lit("same "), (F.col("doc_id") % 7).cast("string"))).otherwise(F.col("doc_id").cast("string"))
    rows = d.select((F.col("doc_id") % 3).alias("part_pos"), F.concat(F.lit("part "), (F.col("doc_id") % 3).cast("string")).alias("source"), F.col("doc_id").alias("line"), id_.alias("id"), F.col("doc_id").cast("string").alias("input"))
    found = dataset.validate(rows, F.col("input"))
    return found.select(F.col("line").alias("doc_id"), F.col("part_pos").cast("long").alias("part_pos"), F.split("message", ";")[0].alias("message"))


@query("SELECT doc_id AS ord, lang AS expected, sha256(upper(lang)) AS completion FROM documents")
def completions_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return evaluate.align(d.select(F.col("doc_id").alias("ord"), F.col("lang").alias("expected")), d.select(F.col("doc_id").alias("ord"), F.sha2(F.upper("lang"), 256).alias("completion")))


_KINDS = sorted(migrations.POLICIES)
_TAKES = {"current": "v = '2'", "v1": "v IN ('1', '2')", "unversioned": "(v IS NULL OR v IN ('1', '2'))"}
_OWN = " ".join(f"WHEN '{k}' THEN {_TAKES[migrations.POLICIES[k]]}" for k in _KINDS)


def _versioned(name: str) -> Column:
    """Null, 1, 2 or 3, by a number."""
    return F.when(F.col(name) > 0, F.col(name).cast("string")).alias("schema_version")


@query(f"""WITH d AS (SELECT doc_id, source, n_chars, (ARRAY{_KINDS})[CAST(doc_id % {len(_KINDS)} AS INT) + 1] AS kind, nullif(doc_id // {len(_KINDS)} % 4, 0) AS o, nullif(doc_id // {4 * len(_KINDS)} % 4, 0) AS i FROM documents),
e AS (SELECT *, CAST(o AS VARCHAR) AS v, kind = 'training_manifest' AND coalesce(i, 1) = 3 AS bad_config FROM d), f AS (SELECT *, coalesce(CASE kind {_OWN} END, false) AS own FROM e)
SELECT doc_id, kind, CASE WHEN own AND NOT bad_config THEN '2' END AS version, CASE WHEN own AND NOT bad_config THEN source END AS source, CASE WHEN own AND NOT bad_config THEN n_chars END AS n_chars,
CASE WHEN own AND NOT bad_config THEN CASE WHEN kind = 'training_manifest' THEN '2' ELSE CAST(i AS VARCHAR) END END AS config,
CASE WHEN NOT own THEN kind || ': version ' || coalesce('"' || v || '"', 'none') || ' is not supported' WHEN bad_config THEN 'training_config: version "3" is not supported' END AS error FROM f""")
def document_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the documents as documents of every kind and version, with a configuration inside, in their current version."""
    n = len(_KINDS)
    rows = read(spark, sf_dir, "documents").select(
        "doc_id", "source", "n_chars", F.array(*map(F.lit, _KINDS))[(F.col("doc_id") % n).cast("int")].alias("kind"), F.expr(f"doc_id div {n} % 4").alias("o"), F.expr(f"doc_id div {4 * n} % 4").alias("i"),
    )
    inner = F.struct(_versioned("i"), F.lit(1).alias("seed"))
    rows = rows.select("doc_id", "kind", F.to_json(F.struct(_versioned("o"), "source", "n_chars", inner.alias("config"))).alias("document"))
    found = migrations.migrate_documents(rows, "kind", "document")
    m = F.from_json("migrated", "schema_version string, source string, n_chars long, config struct<schema_version:string>")
    return found.select("doc_id", "kind", m["schema_version"].alias("version"), m["source"].alias("source"), m["n_chars"].alias("n_chars"), m["config"]["schema_version"].alias("config"), "error")


import hashlib
import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from routelore.functions import codec, text
from routelore.operators import dataset, enrich, evaluate, migrations, registry, review, sampling, training_data
from routelore.operators.registry import Route
from routelore.plans import registry as plans
from routelore.sources import artifacts, jsonl, pointer
from routelore.streaming import ingest

ROUTES = [Route("billing", "Bills", {"id": "string", "urgent": "boolean", "n": "integer", "x": "number"}, ("id",)), Route("other")]


# Splits and samples


def brute_sizes(n):
    exact = {"train": 0.8 * n, "validation": 0.1 * n, "test": 0.1 * n}
    whole = {k: int(v + 1e-9) for k, v in exact.items()}
    spare = sorted(whole, key=lambda k: -(round(exact[k] - whole[k], 9)))[: n - sum(whole.values())]
    for k in spare:
        whole[k] += 1
    for k in whole:
        if not whole[k]:
            whole[max(whole, key=whole.get)] -= 1
            whole[k] = 1
    return whole["train"], whole["validation"]


def test_split_sizes(spark):
    train, validation = sampling.split_sizes(F.col("id"))
    got = spark.range(3, 400).select("id", train, validation).collect()
    assert [(r[1], r[2]) for r in got] == [brute_sizes(r[0]) for r in got]


def test_split_is_by_digest(spark):
    rows = spark.createDataFrame([(f"r{i}", "a" if i < 5 else "b") for i in range(17)], "id string, route string")
    got = sampling.stratified_split(rows.repartition(3), 42).collect()
    parts = {(r.route, r.part): sum(x.route == r.route and x.part == r.part for x in got) for r in got}
    assert parts == {("a", "train"): 3, ("a", "validation"): 1, ("a", "test"): 1, ("b", "train"): 10, ("b", "validation"): 1, ("b", "test"): 1}
    for route in "ab":
        mine = sorted((r for r in got if r.route == route), key=lambda r: r.rn)
        digests = [hashlib.sha256("\0".join([sampling.SPLIT, "42", route, r.id]).encode()).hexdigest() for r in mine]
        assert digests == sorted(digests) and [r.digest for r in mine] == digests


def test_quotas(spark):
    rows = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(20)], "id long, route string")
    got = sampling.quota_sample(rows, {"a": 3, "b": 0, "c": 5}, 1).collect()
    assert len(got) == 3 and {r.route for r in got} == {"a"}
    with pytest.raises(ValueError):
        sampling.quota_sample(rows, {}, 1)
    assert [r.name for r in sampling.unknown_quota_routes({"billing": 1, "zz": 2}, registry.registry(spark, ROUTES)).collect()] == ["zz"]


# Dataset checks


def test_validation_order(spark):
    rows = [(0, "train", "a", 1, "x", "Straße  1", "billing"), (0, "train", "a", 2, " ", "t2", "other"), (0, "train", "a", 3, "x", "t3", "other"), (1, "test", "b", 1, "y", "strasse 1", "billing"), (1, "test", "b", 2, "z", "ﬁne", "billing"), (1, "test", "b", 3, "w", "fine", "billing")]
    df = spark.createDataFrame(rows, "part_pos int, part string, source string, line long, id string, input string, route string")
    found = dataset.validate(df, text.normalize("input"), registry.registry(spark, ROUTES)).collect()
    assert [(r.source, r.line, r.path) for r in found[:4]] == [("a", 2, "id"), ("a", 3, "id"), ("b", 1, "input"), ("b", 3, "input")]
    assert [(r.source, r.message) for r in found[4:]] == [("b", "no example of route other")]
    assert "a:1" in found[2].message
    with pytest.raises(dataset.DatasetError, match="a:2"):
        dataset.require_valid(dataset.validate(df, text.normalize("input")))
    dataset.require_valid(dataset.validate(df.limit(0), text.normalize("input")))


# Text


def test_text_functions(spark):
    row = spark.createDataFrame([("  \x1c", "=1+1", "a@b.cd é 12", "2024-02-30T00:00:00Z", "https://u@h/x")], "blank string, cell string, t string, ts string, url string")
    got = row.select(
        text.blank(F.col("blank")).alias("blank"), text.csv_cell(F.col("cell")).alias("cell"), text.redact(F.col("t"), [(r"(\w)@(\w)", r"\2 at \1 $"), ("[0-9]+", "#")]).alias("t"), text.within_bytes(F.col("t"), 12).alias("fits"),
        text.within_bytes(F.col("t"), 11).alias("fits_not"), text.valid_timestamp(F.col("ts")).alias("ts"), text.valid_timestamp(F.lit("2024-02-29T00:00:00+02:00")).alias("offset"), text.valid_timestamp(F.lit("2024-02-29T00:00:00+02:00"), True).alias("utc"),
        text.valid_endpoint(F.col("url")).alias("url"), text.valid_endpoint(F.lit("https://h/x")).alias("plain"), text.rate(F.lit(1), F.lit(0)).alias("none"), text.rate(F.lit(1), F.lit(0), 0.0).alias("zero"),
    ).first()
    assert tuple(got) == (True, "'=1+1", "b at a $.cd é #", True, False, False, True, False, False, True, None, 0.0)


@pytest.mark.parametrize(("pointer_", "want"), [("/a/b", ("found", "1")), ("/a/n", ("found", None)), ("/a/zz", ("missing", None)), ("/l/0", ("malformed", None)), ("/s", ("found", "x"))])
def test_pointers(spark, pointer_, want):
    row = spark.createDataFrame([('{"a": {"b": 1, "n": null}, "l": [1], "s": "x"}',)], "d string")
    assert tuple(row.select(pointer.resolve(F.col("d"), pointer_).alias("r")).first().r) == want


def test_pointer_tokens():
    assert pointer.tokens("") == [] and pointer.tokens("/a~1b/~0") == ["a/b", "~"]
    for bad in ("a", "/~2", "/~"):
        with pytest.raises(ValueError):
            pointer.tokens(bad)


# Calls

C, E, Q, R = codec.CALL, codec.END_CALL, codec.ESCAPE, codec.RESPONSE


@pytest.mark.parametrize(("raw", "category"), [
    ("  ", codec.MISSING), ("plain prose", codec.MISSING), (f"see {C}call:a{{}}{E}", codec.MALFORMED), (f"{C}call:a{{}}", codec.MALFORMED), (f"{C}{C}call:a{{}}{E}", codec.MALFORMED), (f"{C}a{{}}{E}", codec.MALFORMED),
    (f"{C}call:{{}}{E}", codec.MALFORMED), (f"{C}call:a,b{{}}{E}", codec.MALFORMED), (f"{C}call:a{{k:1,}}{E}", codec.MALFORMED), (f"{C}call:a{{k:1,k:2}}{E}", codec.MALFORMED), (f"{C}call:a{{k}}{E}", codec.MALFORMED),
    (f"{C}call:a{{k:1}} x{E}", codec.MALFORMED), (f"{C}call:a{{k:1 j:2}}{E}", codec.MALFORMED), (f"{C}call:a{{[k]:1}}{E}", codec.MALFORMED), (f"{C}call:a{{k:null}}{E}", codec.SYNTAX), (f"{C}call:a{{k:}}{E}", codec.SYNTAX),
    (f"{C}call:a{{k:{{}}}}{E}", codec.SYNTAX), (f'{C}call:a{{k:"x"}}{E}', codec.SYNTAX), (f"{C}call:a{{k:{Q}x}}{E}", codec.SYNTAX), (f"{C}call:a{{k:{Q}x{Q}{Q}y{Q}}}{E}", codec.SYNTAX), (f"{C}call:a{{k:01}}{E}", codec.SYNTAX),
    (f"{C}call:a{{k:1e999}}{E}", codec.SYNTAX), (f"{C}call:a{{k:", codec.MALFORMED),
])
def test_call_faults(raw, category):
    with pytest.raises(codec.Bad) as found:
        codec.parse_call(raw)
    assert found.value.category == category


def test_call_values():
    raw = f" {C} call:a {{ s : {Q}, {{x}} {Q} , i:-12, f:1.50e1,b:true , u:{10**400}}} {E} {R} "
    name, arguments = codec.parse_call(raw)
    assert name == "a" and arguments == {"s": ("string", ", {x} "), "i": ("integer", "-12"), "f": ("number", "15.0"), "b": ("boolean", "true"), "u": ("integer", str(10**400))}
    assert codec.parse_call(f"{C}call:a{{ }}{E}") == ("a", {})


def test_parse_and_validate(spark):
    raws = [f"{C}call:billing{{id:{Q}7{Q},urgent:true,n:1,x:2}}{E}", f"{C}call:zz{{}}{E}", f"{C}call:billing{{n:1.5,zz:1}}{E}", "no", None, f"{C}call:other{{}}{E}{R}"]
    rows = spark.createDataFrame(list(enumerate(raws)), "ord int, raw string")
    got = codec.parse_and_validate(rows, registry.registry(spark, ROUTES)).orderBy("ord").collect()
    assert [r.category for r in got] == [None, "unknown_route", "invalid_arguments", codec.MISSING, codec.MISSING, None]
    assert got[2].detail == "missing required argument id; unknown argument zz; argument n must be integer, not number"


def test_prompt_and_compile(spark):
    rows = spark.createDataFrame([(" hi ",), (f"bad {C}",)], "t string")
    arguments = F.create_map(F.lit("id"), F.struct(F.lit("string").alias("kind"), F.lit("7").alias("text")))
    got = [r[0] for r in rows.select(codec.compile_example(F.col("t"), F.lit("billing"), arguments, ROUTES)).collect()]
    assert got[1] is None and got[0].startswith("<bos><start_of_turn>developer\n<start_function_declaration>declaration:billing{description:<escape>Bills<escape>")
    assert got[0].endswith(f"<start_of_turn>user\nhi<end_of_turn>\n<start_of_turn>model\n{C}call:billing{{id:{Q}7{Q}}}{E}{R}")
    assert "required:[<escape>id<escape>],type:<escape>OBJECT<escape>" in got[0] and "declaration:other{description:<escape><escape>,parameters:{type:<escape>OBJECT<escape>}}" in got[0]
    with pytest.raises(ValueError):
        codec.declarations([Route("not safe")])


def test_argument_equality(spark):
    row = spark.sql("select map('a', named_struct('kind','integer','text','1'), 'b', named_struct('kind','string','text','1.0')) x, map('b', named_struct('kind','string','text','1.0'), 'a', named_struct('kind','number','text','1.0')) y, map('a', named_struct('kind','string','text','1')) z")
    assert tuple(row.select(registry.arguments_equal(F.col("x"), F.col("y")), registry.arguments_equal(F.col("x"), F.col("z"))).first()) == (True, False)


def test_registry_rules(spark):
    for bad in (lambda: Route(""), lambda: Route("a", "", {"x": "date"}), lambda: Route("a", "", {}, ("x",)), lambda: Route("a", "", {"x": "string"}, ("x", "x"))):
        with pytest.raises(ValueError):
            bad()
    for routes in ([], [Route("a"), Route("a")]):
        with pytest.raises(ValueError):
            registry.registry(spark, routes)


# Evaluation and review


def test_golden_evaluation(spark):
    """Six rows, four routes: valid 4, right route 3, right arguments 2."""
    rows = [(0, "a", "a", None, True), (1, "a", "b", None, False), (2, "b", "b", None, False), (3, "a", "a", None, True), (4, "c", None, "unknown_route", False), (5, "b", None, "malformed_function_call", False)]
    scored = spark.createDataFrame(rows, "ord long, expected string, predicted string, category string, arguments_ok boolean")
    routes = registry.names_registry(spark, list("abcd"))
    assert tuple(evaluate.metrics(scored).first())[:4] == (6, 4, 3, 2)
    table = [tuple(r)[1:] for r in evaluate.route_metrics(scored, routes).orderBy("pos").collect()]
    assert table == [("a", 3, 2, 2, 1.0, 2 / 3), ("b", 2, 2, 1, 0.5, 0.5), ("c", 1, 0, 0, None, 0.0), ("d", 0, 0, 0, None, None)]
    assert [r.predicted for r in evaluate.confusion_maps(scored, routes).orderBy("pos").collect()] == [{"a": 2, "b": 1}, {"b": 1}, {}, {}]
    assert [r["count"] for r in evaluate.invalid_counts(scored).orderBy("pos").collect()] == [0, 1, 0, 1, 0]
    gates = evaluate.gates(evaluate.metrics(scored), {"valid_decision_rate": 0.6, "route_accuracy": 0.5, "argument_accuracy": 0.34}).orderBy("pos").collect()
    assert [r.passed for r in gates] == [True, True, False] and not gates[0].all_passed
    signs = [(r.expected, r.predicted, r.category) for r in evaluate.representatives(scored).orderBy("ord").collect()]
    assert signs == [("a", "b", None), ("b", "b", None), ("c", None, "unknown_route"), ("b", None, "malformed_function_call")]
    hidden = evaluate.representatives(scored.withColumn("input", F.lit("x")), redact=True, shown=["input"]).collect()
    assert len(hidden) == 4 and all(r.input is None for r in hidden)
    assert all(evaluate.reconcile(evaluate.metrics(scored), evaluate.confusion(scored), evaluate.invalid_counts(scored)).first())
    with pytest.raises(ValueError):
        evaluate.align(scored, scored.limit(2))


def test_review_and_acceptance(spark):
    rows = [(1, "s1", "labeled", "a", None), (2, "s2", "labeled", "a", None), (3, "s3", "labeled", "b", "invalid_arguments"), (4, "s4", "labeled", "zz", "unknown_route"), (5, "s5", "rejected", None, None), (6, "s6", "rejected", None, None)]
    candidates = spark.createDataFrame([(a, b, "t", c, d, e) for a, b, c, d, e in rows], "line long, id string, input string, status string, route string, category string")
    routes = registry.names_registry(spark, list("abc"))
    quotas = {"a": 2, "b": 1, "c": 1}
    reviewed = review.review_rows(candidates, quotas, 42)
    assert [r.selected for r in reviewed.orderBy("line").collect()] == [True, True, False, False, False, False]
    assert [r.shortfall for r in review.quality(reviewed, routes, quotas).orderBy("pos").collect()] == [0, 1, 1]
    assert review.quality_totals(candidates).first().rejection_rate == 2 / 6
    marked = reviewed.withColumn("review", F.when(F.col("line") == 1, "approved").when(F.col("line") == 2, "rejected").otherwise("approved"))
    got = review.accept(marked, None, 42).collect()
    assert [r.line for r in got] == [1] and '"reason":null' in got[0].metadata[review.LINEAGE]
    assert review.accept(marked.withColumn("review", F.lit("approved")), {"a": 1, "b": 0}, 42).count() == 1
    assert review.bind_by_position(candidates, candidates.where("line > 1")).collect()[0].message == "candidate missing"


# Enrichment


def test_retries_and_pace():
    answers = [enrich.Response("timed_out", retryable=True), enrich.Response("succeeded", "{"), enrich.Response("succeeded", "{}")]
    slept, clock = [], iter(range(100))

    class Client:
        def request(self, _):
            return answers.pop(0)

    got = enrich.Paced(Client(), 30, 2, 1.0, slept.append, lambda: next(clock)).request("x")
    assert (got.status, got.content, got.attempts) == ("succeeded", "{}", 3) and slept.count(1.0) >= 2
    answers[:] = [enrich.Response("rate_limited"), enrich.Response("succeeded", "{}")]
    assert enrich.Paced(Client(), None, 5, 0.0, slept.append).request("x").status == "rate_limited"


@pytest.mark.parametrize(("content", "good"), [
    ('{"name": "a"}', True), ('{"name": "a", "arguments": {"x": 1.0}}', True), ('{"name": "a", "name": "b"}', False), ('{"name": "a"} x', False), ('{"name": "a", "arguments": {"x": NaN}}', False),
    ('{"name": "a", "arguments": {"x": 1e999}}', False), ('{"name": "\\ud800"}', True), ('{"name": ""}', False), ("[]", False), (None, False), ('{"name": "a", "more": 1}', False),
])
def test_strict_decisions(content, good):
    assert (enrich.parse_decision(content) is not None) == good


@pytest.mark.parametrize(("content", "reason"), [
    ('{"name": "other", "arguments": {"x": "\\ud800"}}', "invalid_decision"), ('{"name": "\\udfff"}', "invalid_decision"), ('{"name": "other", "arguments": {"\\ud800": 1}}', "invalid_decision"), ('{"name": "zz"}', "invalid_decision"),
    ('{"name": "open"}', None), ('{"name": "open", "arguments": {"s": "\\ud83d\\ude00"}}', None), ('{"name": "open", "arguments": {"s": "\\ud83d"}}', "invalid_decision"), ("{", "malformed_response"),
])
def test_rejections(spark, content, reason):
    """Lone surrogates are looked for after the route and its arguments are validated."""
    routes = registry.registry(spark, [registry.Route("other"), registry.Route("open", properties={"s": "string"})])

    class Client:
        def request(self, text):
            return enrich.Response("succeeded", text)

    rows = spark.createDataFrame([("i", 1, content)], "id string, line long, input string")
    assert enrich.label_candidates(rows, Client, routes).first()["rejection_reason"] == reason


def raised(name, base=Exception, code=None):
    error = type(name, (base,), {})("secret detail")
    if code is not None:
        error.status_code = code
    return error


@pytest.mark.parametrize(("error", "status", "again"), [
    (raised("JSONDecodeError", code=500), "transport_failed", True), (raised("ResponseValidationError"), "transport_failed", True), (raised("Http", code=429), "rate_limited", False), (raised("Http", TimeoutError, 408), "timed_out", False), (raised("Http", code=504), "timed_out", False),
    (raised("Http", code=403), "refused", False), (raised("Http", ConnectionError, 502), "transport_failed", False), (TimeoutError(), "timed_out", True), (raised("ReadTimeout"), "timed_out", True), (ConnectionResetError(), "transport_failed", True), (raised("NetworkDown"), "transport_failed", True),
    (raised("NoResponseError"), "transport_failed", True), (ValueError(), "transport_failed", False),
])
def test_failures_are_classified(monkeypatch, error, status, again):
    calls = []

    def send(credential, model, messages):
        calls.append(messages)
        raise error

    monkeypatch.setenv("PROVIDER_TEST_KEY", "k")
    client = enrich.ChatClient(send, "m", "policy", "PROVIDER_TEST_KEY")
    got = enrich.Paced(client, None, 2, 0.0, lambda _: None).request('say "hi"\nnow')
    assert (got.status, got.attempts, len(calls)) == (status, 3 if again else 1, 3 if again else 1) and got.content is None and got.timestamp.endswith("Z")
    assert calls[0][0] == {"role": "system", "content": "policy"} and calls[0][1]["content"].endswith('\n"say \\"hi\\"\\nnow"')


def test_chat_answers(monkeypatch):
    monkeypatch.setenv("PROVIDER_TEST_KEY", "k")
    answers = {"refused": {"choices": [{"message": {"refusal": "no", "content": "{}"}}]}, "text": {"choices": [{"message": {"content": "  {} "}}]}, "none": {"choices": []}}
    ask = lambda name, variable="PROVIDER_TEST_KEY": enrich.Paced(enrich.ChatClient(lambda *_: answers[name], "m", "p", variable), None, 1, 0.0, lambda _: None).request("x")
    assert (ask("refused").status, ask("refused").attempts) == ("refused", 1)
    assert (ask("text").content, ask("none").status, ask("none").content, ask("none").attempts) == ("{}", "succeeded", None, 2)
    monkeypatch.delenv("PROVIDER_TEST_KEY")
    assert (ask("text").status, ask("text").attempts) == ("transport_failed", 1)


def test_leakage_equals_brute_force(spark, tmp_path):
    """Compatibility forms, composed and decomposed accents, full case folding and odd spaces."""
    texts = ["ﬁne Straße", "fine  STRASSE", "ｆｕｌｌ width", "full\u2003width ", "cafe\u0301", "CAFÉ", "ǆ", "Ǆ", "µ", "μ", "ς", "Σ", "ﬃ x", "ffi  x", "", None, " ", "İ", "i̇", "unlike"] * 2
    rows = [(i, t, ["en", "de"][i % 2], "s", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    norm = lambda t: " ".join(unicodedata.normalize("NFKC", t).casefold().split())
    first, want = {}, []
    for i, t, *_ in rows:
        if t is not None:
            if norm(t) in first:
                want.append((i, first[norm(t)]))
            first.setdefault(norm(t), i)
    got = [(r.doc_id, r.first_id) for r in plans.QUERIES["normalized_leakage"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want) and len([i for i, _ in want if i < 20]) >= 7
    child = [(i - i % 3, t) for i, t, *_ in rows if i % 4]
    replay = [(i, t) for i, t, *_ in rows if i % 4 == 0]
    want = [(i, "id") for i, _ in replay if i in {c for c, _ in child}] + [(i, "input") for i, t in replay if t is not None and norm(t) in {norm(c) for _, c in child if c is not None}]
    assert sorted((r.id, r.reason) for r in plans.QUERIES["regression_separation"](spark, str(tmp_path)).collect()) == sorted(want)


def test_tool_calls(spark):
    rows = spark.createDataFrame([("a", {"k": ("string", 'q "\n,"name":"x"} é'), "n": ("integer", "7")}), ('n"m', {})], "route string, arguments map<string,struct<kind:string,text:string>>")
    got = [json.loads(r.c)["tool_calls"][0] for r in rows.select(codec.render_tool_call(F.col("route"), F.col("arguments")).alias("c")).collect()]
    assert [(c["type"], c["function"]["name"], json.loads(c["function"]["arguments"])) for c in got] == [("function", "a", {"k": 'q "\n,"name":"x"} é', "n": 7}), ("function", 'n"m', {})]


def test_framed_fingerprint(spark):
    rows = [(2, "é" * 300), (0, ""), (1, "a\nb")]
    want = hashlib.sha256(b"".join(len(t.encode()).to_bytes(8, "big") + t.encode() for _, t in sorted(rows))).hexdigest()
    assert artifacts.framed_fingerprint(spark.createDataFrame(rows, "at long, text string"), "at", "text") == want


def test_streamed_counts_and_first_ids(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jsonl").write_text("".join(json.dumps({"ts": f"2024-01-01T00:{m:02}:00Z", "id": i, "route": r}) + "\n" for m, i, r in [(1, "x", "a"), (2, "x", "a"), (3, "y", "b"), (12, "z", "a")]))
    stream = spark.readStream.schema("ts timestamp, id string, route string").json(str(source))
    for name, df in (("first_ids", ingest.first_of_each_id(stream)), ("route_counts", ingest.running_distribution(stream))):
        running = df.writeStream.format("memory").queryName(name).outputMode("append" if name == "first_ids" else "update").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        running.awaitTermination(60)
    assert sorted(r.id for r in spark.table("first_ids").collect()) == ["x", "y", "z"]
    assert sorted((r.route, r.n) for r in spark.table("route_counts").collect()) == [("a", 1), ("a", 2), ("b", 1)]


# Sources and artifacts


def test_example_scan(spark, tmp_path):
    good = '{"id": "%s", "input": "t", "route": {"name": "billing", "arguments": {"id": "x", "n": 12345678901234567890123}}}'
    data = [(good % "1").encode(), b"", b'{"id": 1', b'{"id": "2", "input": "", "route": {"name": "other"}}', b'{"id": "3", "input": "ab", "route": {"name": "zz"}}\r', b'{"input": "x", "route": {"name": "other"}}', b'{"input": "\xff", "route": {"name": "other"}}', b'{"input": "NaN", "route": {"name": "other"}, "metadata": {"x": NaN}}', (good % "1").encode()]
    path = tmp_path / "rows.jsonl"
    path.write_bytes(b"\n".join(data) + b"\n")
    rows, violations = jsonl.load_examples(spark, str(path), registry.registry(spark, ROUTES))
    got = {r.line: r for r in rows.collect()}
    assert sorted(got) == [1, 6, 9] and got[6].id is None and got[1].arguments["n"].text == "12345678901234567890123"
    assert got[1].row_sha256 == hashlib.sha256(data[0] + b"\n").hexdigest()
    bad = {r.line: r.message for r in violations.collect()}
    assert sorted(bad) == [2, 3, 4, 5, 7, 8, 9] and bad[2] == "blank line" and bad[5].startswith("unknown_route") and bad[9] == "duplicate id"


def test_line_numbers_of_split_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(f"{i:05d}\n" for i in range(1, 4001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        got = jsonl.lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 4000 and all(int(r.value) == r.line for r in got)


def test_raw_scan(spark, tmp_path):
    path = tmp_path / "raw.jsonl"
    path.write_text('{"t": {"id": "1", "text": "mail a@b.cd now", "c": "x 12"}}\n{"t": {"id": "1", "text": "again", "c": "y"}}\n{"t": {"id": 5, "text": "x", "c": "y"}}\n{"t": {"id": "6", "text": "toolong' + "é" * 30 + '", "c": "y"}}\n{"t": [1]}\n{"t": {"id": "7", "text": "\\ud800", "c": "y"}}\n')
    rows, bad = jsonl.scan_raw(spark, str(path), "/t/id", "/t/text", {"channel": "/t/c"}, [("/input", r"(\w)@\S+", r"\1@[mail]"), ("channel", "[0-9]+", "#")], 40)
    first = rows.orderBy("line").first()
    assert (first.id, first.input, first.metadata) == ("1", "mail a@[mail] now", '{"channel":"x #"}')
    assert sorted((r.line, r.message) for r in bad.collect())[0] == (2, "duplicate id") and sorted(r.line for r in bad.collect()) == [2, 3, 4, 5, 6]
    with pytest.raises(ValueError):
        jsonl.scan_raw(spark, str(path), "/id", "/t", {}, [("zz", "a", "b")], 10)


def test_artifacts(spark, tmp_path):
    target = f"{tmp_path}/out"
    rows = spark.createDataFrame([(2, "b", "test"), (1, "é", "train"), (3, "c", "validation")], "line int, value string, part string")
    artifacts.write_split(spark, target, rows, "value", ["line"], {"rows": 3}, {"b": 1, "a": [1.5, None]})
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == ["manifest.json", "report.json", "test.jsonl", "train.jsonl", "validation.jsonl"]
    assert (tmp_path / "out/report.json").read_text() == '{\n  "a": [\n    1.5,\n    null\n  ],\n  "b": 1\n}\n'
    with pytest.raises(FileExistsError), artifacts.publish(spark, target):
        raise AssertionError
    with pytest.raises(RuntimeError), artifacts.publish(spark, f"{tmp_path}/lost") as staging:
        artifacts.write_text(spark, f"{staging}/x", "y")
        raise RuntimeError
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    data = tmp_path / "data.jsonl"
    data.write_bytes("é\nb\n".encode())
    digest = hashlib.sha256(data.read_bytes()).hexdigest()
    artifacts.verify(spark, str(data), 2, digest)
    for n, d in ((3, digest), (2, "0" * 64)):
        with pytest.raises(artifacts.ArtifactError):
            artifacts.verify(spark, str(data), n, d)
    assert artifacts.ordered_fingerprint(rows, "line", "value") == hashlib.sha256("é\nb\nc\n".encode()).hexdigest()
    before = artifacts.tree_hash(spark, target)
    artifacts.write_text(spark, f"{target}/manifest.json", "{}")
    assert artifacts.tree_hash(spark, target) != before
    assert artifacts.registry_fingerprint([Route("a")]) == artifacts.registry_fingerprint([Route("a", "", {}, ())])


def test_migrations():
    old = {"config": {"a": 1}, "schema_version": "1", "evaluation": {"x": 1}}
    new = migrations.migrate("training_manifest", old)
    assert new["schema_version"] == new["config"]["schema_version"] == new["evaluation"]["schema_version"] == "2" and "schema_version" not in old["config"]
    for kind, version in (("review_manifest", "1"), ("dataset_report", None), ("training_config", "3")):
        with pytest.raises(migrations.VersionError):
            migrations.migrate(kind, {"schema_version": version} if version else {})


def test_migrated_columns_equal_one_document_at_a_time(spark):
    inner = [{}, {"schema_version": "1", "b": [1, {"é": None}], "a": "x\n\"\\"}, {"schema_version": "3"}, {"schema_version": None}, {"schema_version": 2}, [1], "text", None]
    rows = []
    for kind in migrations.POLICIES:
        for version in ("", None, "1", "2", "3", 2):
            for value in inner:
                document = {"z": 1, "A": True, "config": value, "parent": value, "comparison": {"schema_version": "2", "child": value}, "evaluation": value}
                rows.append((kind, json.dumps(document | ({} if version == "" else {"schema_version": version}))))
    rows += [("nothing", "{}"), ("training_config", "[1]"), ("training_config", "{"), (None, "{}"), ("training_config", None)]
    for r in migrations.migrate_documents(spark.createDataFrame(rows, "kind string, document string"), "kind", "document").collect():
        try:
            want = json.dumps(migrations.migrate(r.kind, json.loads(r.document)), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        except (migrations.VersionError, KeyError, ValueError, AttributeError, TypeError):
            want = None
        assert r.migrated == want and (r.error is None) == (want is not None), r


def test_token_records_and_batches(spark):
    rows = spark.createDataFrame([(0, f"ab{C}cd"), (1, "no call"), (2, f"a{C}"), (3, f"abc{C}d" + "e" * 90)], "n int, compiled string")
    got = training_data.token_records(rows, lambda: lambda t: [ord(c) for c in t.replace(C, "|")], 20).orderBy("n").collect()
    assert got[0].labels == [-100, -100, 124, 99, 100] and got[0].input_ids == [97, 98, 124, 99, 100]
    assert [bool(r.error) for r in got] == [False, True, False, True]
    records = spark.createDataFrame([(0, [1, 2, 3], [-100, 2, 3]), (1, [4], [4]), (2, [5], [5])], "n int, input_ids array<int>, labels array<int>")
    batches = training_data.collate(records, "n", 2, 0).orderBy("n").collect()
    assert [r.input_ids for r in batches] == [[1, 2, 3], [4, 0, 0], [5]] and batches[1].labels == [4, -100, -100] and batches[1].attention_mask == [1, 0, 0]


def test_stream(spark, tmp_path):

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"id": "1", "t": "a@b.cd"}\n{"id": " ", "t": "x"}\n{"t": "y"}\n')
    out = ingest.raw_stream(spark, str(tmp_path / "in"), "/id", "/t", [(r"\S+@\S+", "[mail]")], 100)
    q = out.writeStream.format("memory").queryName("ingested").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r.state, r.input) for r in spark.table("ingested").collect()) == [("blank id", "x"), ("ok", "[mail]"), ("unresolved", "y")]

"""Configurations, training artifacts and the command line around them."""

import json

import pytest

pytest.importorskip("yaml")

from routelore import cli  # noqa: E402
from routelore.operators import dataset, registry  # noqa: E402
from routelore.sources import artifacts, configs, training_artifacts  # noqa: E402
from routelore.sources.configs import ConfigError  # noqa: E402


@pytest.fixture
def project(tmp_path):
    return training_artifacts.starter(tmp_path / "starter")


def test_starter_project_loads(project):
    for kind, name in {"raw_ingestion_config": "ingest", "labeling_config": "label", "review_config": "review", "acceptance_config": "accept", "training_config": "train"}.items():
        found = configs.load(kind, project / f"{name}.yaml")
        assert found["schema_version"] == "2" and all(p is None or p.startswith(str(project)) for p in configs.paths(kind, found, project / f"{name}.yaml").values())
    assert configs.load("review_config", project / "review.yaml")["report_format"] == "jsonl"
    assert configs.load("training_config", project / "train.yaml")["evaluation"]["thresholds"]["route_accuracy"] == 0.0
    with pytest.raises(FileExistsError):
        training_artifacts.starter(project)


@pytest.mark.parametrize(("name", "kind", "old", "new", "path"), [
    ("label", "labeling_config", "https://provider.example/v1", "https://a:b@provider.example/v1", "provider.endpoint"), ("label", "labeling_config", "https://provider.example/v1", "ftp://x/y", "provider.endpoint"),
    ("label", "labeling_config", "https://provider.example/v1", "https://x/y?z=1", "provider.endpoint"), ("label", "labeling_config", "concurrency: 4", "concurrency: 65", "concurrency"), ("label", "labeling_config", "concurrency: 4", "concurrency: true", "concurrency"),
    ("label", "labeling_config", "PROVIDER_KEY", "1KEY", "provider.credential_env_var"), ("label", "labeling_config", "max_retries: 2\n", "", "max_retries"), ("label", "labeling_config", "max_retries: 2", "max_retries: 9", "max_retries"),
    ("label", "labeling_config", 'schema_version: "2"', "schema_version: 2", "schema_version"), ("label", "labeling_config", 'schema_version: "2"\n', "", "schema_version"), ("label", "labeling_config", "routes:", "route:", ""),
    ("ingest", "raw_ingestion_config", "/key", "key", "projection.id"), ("ingest", "raw_ingestion_config", "/key", "/a~2", "projection.id"), ("ingest", "raw_ingestion_config", "[0-9]{4}-[0-9]+", "(", "redactions.0.pattern"),
    ("ingest", "raw_ingestion_config", "target: /input", "target: /metadata/x", "redactions.0.target"), ("ingest", "raw_ingestion_config", "target: /input", "target: /other", "redactions.0.target"), ("ingest", "raw_ingestion_config", "input: /text}", "input: /text, metadata: {_routelore: /x}}", "projection.metadata"),
    ("ingest", "raw_ingestion_config", "4096", "0", "limits.max_input_bytes"), ("review", "review_config", "{seed: 42, per_route: {billing: 2, other: 2}}", "{seed: 42, per_route: {}}", "sampling.per_route"), ("review", "review_config", "billing: 2", "billing: -1", "sampling.per_route.billing"),
    ("train", "training_config", "learning_rate: 0.0002", "learning_rate: 0", "training.learning_rate"), ("train", "training_config", "merged_huggingface", "other", "output.export"), ("train", "training_config", "test: splits/test.jsonl", "holdout: x", "data"),
])
def test_bad_fields_are_told(project, name, kind, old, new, path):
    file = project / f"{name}.yaml"
    assert old in file.read_text()
    file.write_text(file.read_text().replace(old, new))
    with pytest.raises(ConfigError) as e:
        configs.load(kind, file)
    assert e.value.path == path and e.value.source == str(file)


@pytest.mark.parametrize(("content", "line", "said"), [(b"a: [1\nb: 2\n", 2, "malformed YAML"), (b"\xff: 1", None, "UTF-8"), (b"- 1\n", None, "not a mapping"), (b"a: !!python/object:os.system {}\n", 1, "malformed YAML")])
def test_bad_yaml(tmp_path, content, line, said):
    (tmp_path / "x.yaml").write_bytes(content)
    with pytest.raises(ConfigError, match=said) as e:
        configs.load_mapping(tmp_path / "x.yaml")
    assert e.value.line == line


def test_defaults_and_path_spelling(project):
    rule = configs.check("raw_ingestion_config", configs.load_mapping(project / "ingest.yaml") | {"redactions": [{"path": "/input", "pattern": "x"}]})["redactions"][0]
    assert rule == {"target": "/input", "pattern": "x", "replacement": ""}
    assert configs.check("training_config", {k: v for k, v in configs.load_mapping(project / "train.yaml").items() if k != "schema_version"})["schema_version"] == "2"
    with pytest.raises(ConfigError, match="missing partitions: test; unexpected partitions: more"):
        configs.partition_sources({"train": "a", "validation": "b", "more": "c"})
    with pytest.raises(ConfigError, match="one file"):
        configs.partition_sources({"train": "a", "validation": "./a", "test": "b"})


@pytest.mark.parametrize("routes", ["routes: []", "routes:\n  - {name: a}\n  - {name: a}", "routes:\n  - {name: ''}", "routes:\n  - {name: a, parameters: {properties: {x: {type: list}}}}", "routes:\n  - {name: a, parameters: {required: [x]}}", "routes:\n  - {name: a, more: 1}", "routes:\n  - {name: a, parameters: {additionalProperties: true}}"])
def test_bad_registries(tmp_path, routes):
    (tmp_path / "r.yaml").write_text(routes)
    with pytest.raises(ConfigError):
        configs.load_routes(tmp_path / "r.yaml")


# Artifacts


def test_artifact_sources(spark, tmp_path, project):
    routes = configs.load_routes(project / "routes.yaml")
    folder = tmp_path / "artifact"
    (folder / "adapter").mkdir(parents=True)
    (folder / "adapter/weights.bin").write_bytes(b"\0" * 9)
    for name in ("routes.yaml", "train.yaml"):
        (folder / name.replace("train", "config")).write_text((project / name).read_text())
    manifest = {"schema_version": "1", "status": "completed", "registry_fingerprint": artifacts.registry_fingerprint(routes), "adapter_sha256": artifacts.tree_hash(spark, str(folder / "adapter"))}
    (folder / "manifest.json").write_text(json.dumps(manifest))
    found = training_artifacts.completed(spark, str(folder))
    assert found["schema_version"] == "2" and training_artifacts.own_routes(str(folder), found) == routes and training_artifacts.own_config(str(folder))["training"]["epochs"] == 1
    training_artifacts.verify_tree(spark, str(folder / "adapter"), found["adapter_sha256"])
    (folder / "adapter/more.bin").write_bytes(b"")
    with pytest.raises(artifacts.ArtifactError, match="differs"):
        training_artifacts.verify_tree(spark, str(folder / "adapter"), found["adapter_sha256"])
    with pytest.raises(artifacts.ArtifactError, match="registry"):
        training_artifacts.own_routes(str(folder), {"registry_fingerprint": "0"})
    for changed, said in (({"status": "running"}, "not completed"), ({"schema_version": "3"}, "version")):
        (folder / "manifest.json").write_text(json.dumps(manifest | changed))
        with pytest.raises(artifacts.ArtifactError, match=said):
            training_artifacts.completed(spark, str(folder))


def test_growth_and_resume():
    a, b, c = (registry.Route(n) for n in "abc")
    assert training_artifacts.registry_growth([a, b], [a, b, c]) == (["a", "b"], ["c"])
    for child in ([a, b], [b, a, c], [a, registry.Route("b", "other"), c]):
        with pytest.raises(artifacts.ArtifactError):
            training_artifacts.registry_growth([a, b], child)
    report = lambda names: {"routes": [{"name": n} for n in names]}
    training_artifacts.require_report_prefix(report("ab"), report("abc"))
    for parent, child in (("ab", "ba"), ("ab", "a"), ("a", "abb")):
        with pytest.raises(artifacts.ArtifactError):
            training_artifacts.require_report_prefix(report(parent), report(child))
    run = {"status": "running", "inputs": {"x": 1}, "config": {"seed": 1}, "hardware": {"device": "cpu"}}
    training_artifacts.require_resumable(run, {"x": 1}, {"seed": 1}, {"device": "cpu"})
    for change in ({"status": "completed"}, {"inputs": {}}, {"config": {}}, {"hardware": {}}):
        with pytest.raises(artifacts.ArtifactError):
            training_artifacts.require_resumable(run | change, {"x": 1}, {"seed": 1}, {"device": "cpu"})


def jsonl(path, rows):
    path.write_text("".join(json.dumps({"id": i, "input": t, "route": {"name": r, "arguments": {"invoice": "1"} if r == "billing" else {}}}) + "\n" for i, t, r in rows))
    return str(path)


def test_regression_rows(spark, tmp_path, project):
    routes = configs.load_routes(project / "routes.yaml")
    children = spark.createDataFrame([("c1", "ﬁne  Text"), ("c2", "other")], "id string, input string")
    good = jsonl(tmp_path / "good.jsonl", [("r1", "one", "billing"), ("r2", "two", "other")])
    assert training_artifacts.regression_rows(spark, good, routes, children).count() == 2
    for rows, said in (([("r1", "one", "billing")], "no example of route other"), ([("c1", "one", "billing"), ("r2", "x", "other")], "shares its id"), ([("r1", "FINE text", "billing"), ("r2", "x", "other")], "shares its input"), ([("r1", "one", "nowhere")], "unknown_route")):
        with pytest.raises(dataset.DatasetError, match=said):
            training_artifacts.regression_rows(spark, jsonl(tmp_path / "bad.jsonl", rows), routes, children)


# Command line


def send(endpoint, credential, model, messages):
    assert (endpoint, credential, model) == ("https://provider.example/v1", "k", "some-model") and messages[0]["role"] == "system"
    text = json.loads(messages[1]["content"].rpartition("\n")[2])
    return {"choices": [{"message": {"content": ' {"name": "billing", "arguments": {"invoice": "x"}}\n' if "1" in text or "2" in text else '{"name": "other"}'}}]}


def test_commands_end_to_end(spark, project, capsys, monkeypatch):
    monkeypatch.setenv("PROVIDER_KEY", "k")
    assert cli.main(["init", str(project)]) == 1 and cli.main(["train", "x"]) == 2
    capsys.readouterr()
    assert cli.main(["ingest", str(project / "ingest.yaml"), "--debug"]) == 0
    out = capsys.readouterr()
    assert json.loads(out.out)["output"]["rows"] == 6 and "redactions 1" in out.err
    assert cli.main(["label", str(project / "label.yaml"), "--transport", "tests.test_configs:send"]) == 0
    assert cli.main(["review-labels", str(project / "review.yaml")]) == 0
    capsys.readouterr()
    assert cli.main(["accept-labels", str(project / "accept.yaml")]) == 0  # nothing is approved yet
    assert json.loads(capsys.readouterr().out)["output"]["rows"] == 0
    assert cli.main(["accept-labels", str(project / "accept.yaml")]) == 1
    assert cli.main(["split", str(project / "examples.jsonl"), "--routes", str(project / "routes.yaml"), "--seed", "42", "--out", str(project / "splits")]) == 0
    capsys.readouterr()
    assert cli.main(["validate", str(project / "train.yaml")]) == 0
    assert json.loads(capsys.readouterr().out)["total"] == 10
    text = (project / "train.yaml").read_text()
    (project / "train.yaml").write_text(text.replace("splits/test", "splits/train"))
    assert cli.main(["validate", str(project / "train.yaml")]) == 1 and "one file" in capsys.readouterr().err


def test_evaluate_command(spark, project, capsys):
    data = jsonl(project / "gold.jsonl", [("a", "one", "billing"), ("b", "two", "other"), ("c", "three", "other"), ("d", "four", "billing")])
    call = lambda body: json.dumps({"raw_completion": f"<start_function_call>call:{body}<end_function_call>"}) + "\n"
    (project / "done.jsonl").write_text(call("billing{invoice:<escape>1<escape>}") + call("other{}") + call("billing{invoice:<escape>1<escape>}") + '{"raw_completion": "no"}\n')
    given = ["evaluate", data, "--routes", str(project / "routes.yaml"), "--completions", str(project / "done.jsonl")]
    assert cli.main([*given, "--route-accuracy", "0.5"]) == 0
    found = json.loads(capsys.readouterr().out)
    assert found["metrics"]["route_correct"] == 2 and found["invalid"]["missing_function_call"] == 1 and found["confusion"]["other"] == {"other": 1, "billing": 1} and len(found["failures"]) == 2
    assert cli.main([*given, "--route-accuracy", "0.51", "--redact"]) == 1
    found = json.loads(capsys.readouterr().out)
    assert not found["passed"] and all(f["input"] is None for f in found["failures"])

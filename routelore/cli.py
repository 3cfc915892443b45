"""A thin command line: each command prints one compact JSON line, and a failure one line on standard error."""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelore import stages
from routelore.functions import codec, text
from routelore.operators import dataset, enrich, evaluate, registry, sampling
from routelore.sources import artifacts, configs, jsonl, training_artifacts
from routelore.sources.configs import load_routes


def _scanned(spark: SparkSession, path: str, known: DataFrame, part: str = "train", pos: int = 0) -> DataFrame:
    """Rows of a labeled file as a partition; the first bad line is an error."""
    rows, bad = jsonl.scan_examples(spark, path, known)
    first = bad.orderBy("source", "line").limit(1).collect()
    if first:
        raise dataset.DatasetError(f"{first[0]['source']}:{first[0]['line']}: {first[0]['message']}")
    return rows.withColumns({"part_pos": F.lit(pos), "part": F.lit(part)})


def _report(rows: DataFrame, known: DataFrame) -> dict:
    found = dataset.distribution(rows, known).orderBy("pos").collect()  # a row a route
    return {"routes": [{k: r[k] for k in ("name", "total", *dataset.PARTITIONS)} for r in found], "total": sum(r["total"] for r in found)}


def validate(spark: SparkSession, data: str, routes: list[registry.Route]) -> dict:
    """A labeled file by itself."""
    known = registry.registry(spark, routes)
    rows = _scanned(spark, data, known)
    dataset.require_valid(dataset.validate(rows, text.normalize("input")))
    return _report(rows, known)


def validate_config(spark: SparkSession, path: str) -> dict:
    """The partitions of a training configuration together, and the separation of its replay set."""
    config = configs.load("training_config", path)
    where = configs.paths("training_config", config, path)
    routes = load_routes(where["routes"])
    known = registry.registry(spark, routes)
    sources = configs.partition_sources({p: where[f"data.{p}"] for p in configs.PARTITIONS})
    replay = where["continuation.regression"]
    if replay:
        configs.reject_aliases(sources | {"regression": replay})
    parts = [_scanned(spark, source, known, part, pos) for pos, (part, source) in enumerate(sources.items())]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    dataset.require_valid(dataset.validate(rows, text.normalize("input"), known))
    if replay:
        mine = _scanned(spark, replay, known, "regression")
        dataset.require_valid(dataset.validate(mine, text.normalize("input")))
        shared = dataset.separation(*(df.select("id", text.normalize("input").alias("normalized")) for df in (mine, rows))).orderBy("id", "reason").limit(1).collect()
        if shared:
            raise dataset.DatasetError(f"{replay}: {shared[0]['id']} shares its {shared[0]['reason']} with the training data")
    return _report(rows, known)


def split(spark: SparkSession, data: str, routes: list[registry.Route], seed: int, out: str) -> dict:
    report = validate(spark, data, routes)
    known = registry.registry(spark, routes)
    rows = _scanned(spark, data, known).drop("part", "part_pos")
    small = dataset.too_small_groups(rows, known).orderBy("pos").limit(1).collect()
    if small:
        raise dataset.DatasetError(f"route {small[0]['name']} has fewer than three rows")
    parts = sampling.stratified_split(rows, seed).join(F.broadcast(known.select(F.col("name").alias("route"), "pos")), "route")
    raw = jsonl.source_lines(spark, data).withColumnRenamed("value", "text")
    parts = parts.join(raw, ["source", "line"])
    sizes = {r["part"]: r["n"] for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect()}
    manifest = {"schema_version": "2", "seed": seed, "rows": sizes, "registry_sha256": artifacts.registry_fingerprint(routes)}
    artifacts.write_split(spark, out, parts, "text", ["pos", "digest"], manifest, report)
    return manifest


def evaluate_completions(spark: SparkSession, data: str, routes: list[registry.Route], completions: str, minimums: dict[str, float], redact: bool = False) -> dict:
    """Scores completions (JSON lines with raw_completion, in the order of the data) and reports them with their gates."""
    known = registry.registry(spark, routes)
    rows, bad = jsonl.load_examples(spark, data, known)
    first = bad.orderBy("source", "line").limit(1).collect()
    if first:
        raise dataset.DatasetError(f"{first[0]['source']}:{first[0]['line']}: {first[0]['message']}")
    gold = rows.select(F.col("line").alias("ord"), "input", F.col("route").alias("expected"), F.col("arguments").alias("wanted"))
    raw = artifacts.ordered_lines(spark, completions).select(F.col("line").alias("ord"), F.from_json("value", "raw_completion string")["raw_completion"].alias("raw_completion"))
    scored = codec.parse_and_validate(evaluate.align(gold, raw), known, "raw_completion")
    scored = scored.withColumn("predicted", F.when(F.col("category").isNull(), F.col("route"))).withColumn("arguments_ok", F.coalesce(registry.arguments_equal(F.col("arguments"), F.col("wanted")), F.lit(False))).cache()
    report = evaluate.metrics(scored)
    gates = [r.asDict() for r in evaluate.gates(report, minimums).orderBy("pos").collect()]
    return {
        "schema_version": "2", "data": artifacts.source_side(spark, data), "registry_fingerprint": artifacts.registry_fingerprint(routes), "metrics": report.first().asDict(), "routes": [r.asDict() for r in evaluate.route_metrics(scored, known).orderBy("pos").collect()],
        "confusion": {r["expected"]: dict(r["predicted"]) for r in evaluate.confusion_maps(scored, known).orderBy("pos").collect()}, "invalid": {r["category"]: r["count"] for r in evaluate.invalid_counts(scored).orderBy("pos").collect()},
        "failures": [r.asDict() for r in evaluate.representatives(scored, redact, ["input", "raw_completion", "detail"]).orderBy("ord").collect()], "thresholds": gates, "passed": bool(gates and gates[0]["all_passed"]),
    }


def compare_completions(spark: SparkSession, data: str, routes: tuple[list[registry.Route], list[registry.Route]], completions: tuple[str, str], minimums: dict[str, float], max_drops: tuple[float, float] = (0.0, 0.0), redact: bool = False) -> dict:
    """A child against its parent on the same replay data: both reports, the drops of their accuracies, and whether all gates hold.

    The child's registry must begin with the parent's routes, unchanged, and have more; the data know the parent's routes only."""
    training_artifacts.registry_growth(*routes)
    parent, child = (evaluate_completions(spark, data, known, given, minimums, redact) for known, given in zip(routes, completions, strict=True))
    if parent["data"] != child["data"]:
        raise artifacts.ArtifactError(f"{data}: changed between the two reports")
    training_artifacts.require_report_prefix(parent, child)
    drops = [parent["metrics"][m] - child["metrics"][m] for m in ("route_accuracy", "argument_accuracy")]
    return {
        "schema_version": "2", "regression_data": parent["data"], "parent": parent, "child": child, "old_route_names": [r["name"] for r in parent["routes"]],
        "max_route_accuracy_drop": max_drops[0], "route_accuracy_drop": drops[0], "max_argument_accuracy_drop": max_drops[1], "argument_accuracy_drop": drops[1],
        "passed": parent["passed"] and child["passed"] and all(d <= most for d, most in zip(drops, max_drops, strict=True)),
    }


def _transport(name: str):
    """``module:function`` that sends a request: (endpoint, credential, model, messages) to the provider's answer."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def label(spark: SparkSession, config: str, transport: str) -> dict:
    def client(settings: dict) -> enrich.ChatClient:
        send, provider = _transport(transport), settings["provider"]
        return enrich.ChatClient(lambda *request: send(provider["endpoint"], *request), provider["model"], settings["policy_prompt"], provider["credential_env_var"])

    return stages.label(spark, config, client)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="routelore")
    commands = parser.add_subparsers(dest="command", required=True)
    add = lambda name, *given: [c := commands.add_parser(name), *[c.add_argument(x) for x in given]][0]
    add("init", "target")
    add("validate", "data").add_argument("--routes", help="of a labeled file; a training configuration names its own")
    c = add("split", "data")
    c.add_argument("--routes", required=True)
    c.add_argument("--seed", type=int, required=True)
    c.add_argument("--out", required=True)
    add("ingest", "config").add_argument("--debug", action="store_true", help="counts and digests on standard error")
    add("label", "config").add_argument("--transport", required=True, help="module:function that sends a request")
    add("review-labels", "config")
    add("accept-labels", "config")
    scored = {"evaluate": ["routes", "completions"], "compare": ["parent-routes", "child-routes", "parent-completions", "child-completions"]}
    for command, files in scored.items():
        c = add(command, "data")
        for name in files:
            c.add_argument(f"--{name}", required=True)
        c.add_argument("--redact", action="store_true")
        for name in evaluate.THRESHOLDS:
            c.add_argument(f"--{name.replace('_', '-')}", type=float, default=0.0)
        if command == "compare":
            for name in ("route", "argument"):
                c.add_argument(f"--max-{name}-accuracy-drop", type=float, default=0.0)
    for name in ("train", "continue", "export"):
        add(name, "config")
    return parser


def main(arguments: list[str] | None = None) -> int:
    a = _parser().parse_args(arguments)
    if a.command in ("train", "continue", "export"):
        print(f"{a.command}: models are trained elsewhere; this library prepares and evaluates their data", file=sys.stderr)
        return 2
    try:
        if a.command == "init":
            found = {"project": str(training_artifacts.starter(a.target))}
        else:
            found = _run(SparkSession.builder.getOrCreate(), a)
    except (ValueError, OSError) as e:
        print(e, file=sys.stderr)
        return 1
    print(jsonl.canonical(found))
    if a.command == "ingest" and a.debug:
        print(f"source {found['source']['rows']} rows {found['source']['sha256']}, output {found['output']['rows']} rows {found['output']['sha256']}, redactions {found['redaction_count']}, limit {found['max_input_bytes']}", file=sys.stderr)
    return int(a.command in ("evaluate", "compare") and not found["passed"])


def _run(spark: SparkSession, a: argparse.Namespace) -> dict:
    if a.command == "validate":
        return validate(spark, a.data, load_routes(a.routes)) if a.routes else validate_config(spark, a.data)
    if a.command == "split":
        return split(spark, a.data, load_routes(a.routes), a.seed, a.out)
    if a.command == "evaluate":
        return evaluate_completions(spark, a.data, load_routes(a.routes), a.completions, {n: getattr(a, n) for n in evaluate.THRESHOLDS}, a.redact)
    if a.command == "compare":
        routes, completions = (load_routes(a.parent_routes), load_routes(a.child_routes)), (a.parent_completions, a.child_completions)
        return compare_completions(spark, a.data, routes, completions, {n: getattr(a, n) for n in evaluate.THRESHOLDS}, (a.max_route_accuracy_drop, a.max_argument_accuracy_drop), a.redact)
    if a.command == "label":
        return label(spark, a.config, a.transport)
    return {"ingest": stages.ingest, "review-labels": stages.review_labels, "accept-labels": stages.accept_labels}[a.command](spark, a.config)


if __name__ == "__main__":
    raise SystemExit(main())

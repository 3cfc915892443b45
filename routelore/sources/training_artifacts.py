"""Checks around a trained artifact: what it was made from, whether it is whole, and whether work on it may go on.

Training itself is out of scope (it needs GPU libraries); these are its data and integrity operators. An artifact folder has
``manifest.json``, copies of its ``routes.yaml`` and ``config.yaml``, an ``adapter`` and, once exported, an ``export`` tree."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelore.functions import text
from routelore.operators import dataset, registry
from routelore.operators.migrations import VersionError, migrate
from routelore.sources import artifacts, configs, jsonl
from routelore.sources.artifacts import ArtifactError


def load_manifest(spark: SparkSession, folder: str) -> tuple[dict, str]:
    """The training manifest in the current version, and the digest of its bytes."""
    data = artifacts.read_bytes(spark, f"{folder}/manifest.json")
    try:
        return migrate("training_manifest", jsonl.strict_object(data.decode())), artifacts.sha256(data)
    except (jsonl.RowError, VersionError, UnicodeDecodeError) as e:
        raise ArtifactError(f"{folder}/manifest.json: {e}") from e


def completed(spark: SparkSession, folder: str) -> dict:
    manifest, _ = load_manifest(spark, folder)
    if manifest.get("status") != "completed":
        raise ArtifactError(f"{folder}: not completed")
    return manifest


def own_routes(folder: str, manifest: dict) -> list[registry.Route]:
    """The registry that the artifact was trained with, from its own copy; the live project may have another."""
    routes = configs.load_routes(f"{folder}/routes.yaml")
    if artifacts.registry_fingerprint(routes) != manifest.get("registry_fingerprint"):
        raise ArtifactError(f"{folder}/routes.yaml: not the registry of the manifest")
    return routes


def own_config(folder: str) -> dict:
    return configs.load("training_config", f"{folder}/config.yaml")


def verify_tree(spark: SparkSession, folder: str, wanted: str) -> None:
    """An adapter or export folder has exactly the files that its digest was made of."""
    if not artifacts.exists(spark, folder) or artifacts.tree_hash(spark, folder) != wanted:
        raise ArtifactError(f"{folder}: differs from its manifest")


def require_resumable(manifest: dict, inputs: dict, config: dict, hardware: dict) -> None:
    """A run may go on where it stopped with the same inputs, configuration and hardware only."""
    if manifest.get("status") != "running":
        raise ArtifactError("only a running artifact can be resumed")
    for name, now in (("inputs", inputs), ("config", config), ("hardware", hardware)):
        if manifest.get(name) != now:
            raise ArtifactError(f"{name} differ from those of the run")


def registry_growth(parent: list[registry.Route], child: list[registry.Route]) -> tuple[list[str], list[str]]:
    """(retained, added) names: the parent's routes must open the child's registry unchanged, and one must follow at least."""
    if child[: len(parent)] != parent:
        raise ArtifactError("the parent's routes must come first, unchanged and in order")
    if len(child) == len(parent):
        raise ArtifactError("no route was added")
    return [r.name for r in parent], [r.name for r in child[len(parent) :]]


def require_report_prefix(parent: dict, child: dict) -> None:
    """The routes of a parent's evaluation report open the child's report, in order; no name comes twice in either."""
    before, after = ([r["name"] for r in report["routes"]] for report in (parent, child))
    if len(set(before)) != len(before) or len(set(after)) != len(after):
        raise ArtifactError("a report names a route twice")
    if after[: len(before)] != before:
        raise ArtifactError("the parent's routes must come first in the child's report")


def regression_rows(spark: SparkSession, path: str, parent: list[registry.Route], children: DataFrame) -> DataFrame:
    """The replay set of a continuation: valid under the parent's registry, covering all its routes, not empty, and apart
    from every partition of the child (``children`` has id and input) by id and by normalized input."""
    known = registry.registry(spark, parent)
    rows, bad = jsonl.scan_examples(spark, path, known)
    first = bad.orderBy("source", "line").limit(1).collect()
    if first:
        raise dataset.DatasetError(f"{path}:{first[0]['line']}: {first[0]['message']}")
    rows = rows.withColumns({"part_pos": F.lit(0), "part": F.lit("regression")})
    dataset.require_valid(dataset.validate(rows, text.normalize("input"), known))
    if rows.limit(1).count() == 0:
        raise dataset.DatasetError(f"{path}: no rows")
    mine, theirs = (df.select("id", text.normalize("input").alias("normalized")) for df in (rows, children))
    shared = dataset.separation(mine, theirs).orderBy("id", "reason").limit(1).collect()
    if shared:
        raise dataset.DatasetError(f"{path}: {shared[0]['id']} shares its {shared[0]['reason']} with the child's data")
    return rows


def starter(target: str | Path) -> Path:
    """A new folder with a small registry, its data and a configuration for every stage."""
    target = Path(target)
    target.mkdir()
    quotas = "{seed: 42, per_route: {billing: 2, other: 2}}"
    files = {
        "routes.yaml": "routes:\n  - name: billing\n    description: Questions about invoices\n    parameters:\n      type: object\n      properties: {invoice: {type: string}}\n      required: [invoice]\n      additionalProperties: false\n  - name: other\n    description: Anything else\n",
        "raw.jsonl": "".join(f'{{"key": "r{k}", "text": "question {k} about an invoice of 2024-00{k}"}}\n' for k in range(6)),
        "examples.jsonl": "".join(f'{{"id": "{r}{k}", "input": "{r} question {k}", "route": {{"name": "{r}", "arguments": {a}}}}}\n' for r, a in (("billing", '{"invoice": "7"}'), ("other", "{}")) for k in range(5)),
        "ingest.yaml": 'schema_version: "2"\nsource: raw.jsonl\noutput: {directory: sanitized}\nprojection: {id: /key, input: /text}\nredactions:\n  - {target: /input, pattern: "[0-9]{4}-[0-9]+", replacement: "[invoice]"}\nlimits: {max_input_bytes: 4096}\n',
        "label.yaml": 'schema_version: "2"\ninput: {directory: sanitized}\nroutes: routes.yaml\noutput: {directory: candidates}\nprovider: {endpoint: "https://provider.example/v1", model: some-model, credential_env_var: PROVIDER_KEY}\npolicy_prompt: Answer with one route as JSON.\nconcurrency: 4\nrate_limit_per_minute: 60\nmax_retries: 2\n',
        "review.yaml": f'schema_version: "2"\nsanitized: sanitized\ncandidates: candidates\nroutes: routes.yaml\noutput: {{directory: review}}\nsampling: {quotas}\n',
        "accept.yaml": f'schema_version: "2"\nsanitized: sanitized\ncandidates: candidates\nroutes: routes.yaml\nreview: review/review.jsonl\nreview_manifest: review/manifest.json\noutput: {{directory: accepted}}\nquotas: {quotas}\n',
        "train.yaml": 'schema_version: "2"\nmodel: {base_model: some-base, revision: "1"}\nroutes: routes.yaml\ndata: {train: splits/train.jsonl, validation: splits/validation.jsonl, test: splits/test.jsonl}\n'
        "training: {seed: 42, epochs: 1, learning_rate: 0.0002, batch_size: 4, gradient_accumulation_steps: 1, lora_rank: 8, lora_alpha: 16, max_sequence_length: 512}\noutput: {directory: artifact, export: merged_huggingface}\n",
        "README.md": "Commands, in order: ingest ingest.yaml, label label.yaml, review-labels review.yaml, accept-labels accept.yaml; split examples.jsonl --routes routes.yaml --seed 42 --out splits, validate train.yaml.\n",
    }
    for name, content in files.items():
        (target / name).write_text(content)
    return target
